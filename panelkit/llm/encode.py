"""SentencePiece encoding and decoding, and count-only tokenization.

``encode`` gives the ids of the best segmentation of each whole text under the
pieces and scores of a model file, ``decode`` gives the text back, and
``count_tokens`` gives the number of ids without keeping any segmentation (see
``panelkit.llm.pieces`` for the automaton, the ties and the units).

The vocabulary (some ten thousand pieces, a fixed file) goes to the tasks with
the function; each Python worker builds the automaton once. Tasks read a text
column in slices, and no shuffle is needed.

Inputs: a null text counts as empty and has no ids. Decoding is exact for every
text. Other columns are carried unchanged, also under clashing names (a column
``ids`` or ``n_pieces`` of the input is replaced). Ids of a later version of the
vocabulary decode to nothing; bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.pieces import Decoder, Vocabulary, automaton
from panelkit.llm.tables import read
from panelkit.llm.text import free_name, give_back, slices, text_buffer, worker_cache

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Larger slices repeat more units, and a repeated unit costs one look-up.
ENCODE_BYTES = 2 << 20


def _added(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    names = {f.name for f in fields}
    return T.StructType([*[f for f in schema.fields if f.name not in names], *fields])


def _run(docs: DataFrame, fields: list[T.StructField], make, text_col: str, drop: bool) -> DataFrame:
    names = {f.name for f in fields}
    carry = [c for c in docs.columns if c not in names and not (drop and c == text_col)]
    schema = T.StructType([*[docs.schema[c] for c in carry], *fields])

    def task(batches):
        for batch in batches:
            for piece in slices(batch, len(carry), ENCODE_BYTES):
                cols = make(piece.column(len(carry)))
                for lo in range(0, piece.num_rows, 1000):
                    part = piece.slice(lo, 1000)
                    yield pa.RecordBatch.from_arrays([*[part.column(k) for k in range(len(carry))],
                                                      *[x.slice(lo, 1000) for x in cols]], [*carry, *[f.name for f in fields]])

    # the text goes last and is told by its place, so no column of the input clashes with it
    last = free_name(carry, "encoded_text")
    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col(text_col).alias(last)).mapInArrow(task, schema)


def encode(docs: DataFrame, vocab: Vocabulary, key: str, text_col: str = "text", drop: bool = True) -> DataFrame:
    """Add ``ids`` and ``n_pieces``; the text goes unless ``drop`` is False."""
    def make(texts):
        offsets, ids = automaton(vocab, key).encode(*text_buffer(texts))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
        return [lists, pa.array(np.diff(offsets))]

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())]
    return _run(docs, fields, make, text_col, drop)


def count_tokens(docs: DataFrame, vocab: Vocabulary, key: str, text_col: str = "text", drop: bool = True) -> DataFrame:
    """Add ``n_tokens``: the pieces of the best segmentation, only counted."""
    def make(texts):
        return [pa.array(automaton(vocab, key).counts(*text_buffer(texts)))]

    return _run(docs, [T.StructField("n_tokens", T.LongType())], make, text_col, drop)


def decode(coded: DataFrame, vocab: Vocabulary, key: str, into: str = "text") -> DataFrame:
    """Add the text of ``ids`` as column ``into``; null ids count as none."""
    carry = [c for c in coded.columns if c != into]
    schema = _added(T.StructType([coded.schema[c] for c in carry]), T.StructField(into, T.StringType()))

    def task(batches):
        kept = worker_cache()
        if ("decoder", key) not in kept:
            kept["decoder", key] = Decoder(vocab)
        decoder = kept["decoder", key]
        for batch in batches:
            lists = batch.column("ids")
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(size)])
            for lo in range(0, batch.num_rows, 1000):
                part = at[lo:lo + 1001]
                offsets, data = decoder.decode(part - part[0], ids[part[0]:part[-1]])
                raw = data.tobytes()
                text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(lo, 1000) for c in carry], pa.array(text, pa.string())], [*carry, into])
            give_back()

    return coded.mapInArrow(task, schema)


def op2_sentencepiece(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    """The ids of every whole text, and the digest of what they decode to."""
    vocab = Vocabulary.load(model)
    coded = encode(read(spark, sf_dir, "documents").select("doc_id", "text"), vocab, model)
    back = decode(coded, vocab, model, "back")
    return back.select("doc_id", "n_pieces", "ids", F.sha2("back", 256).alias("decoded_sha256"))


def op10_token_counts(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    """The number of pieces of every whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, Vocabulary.load(model), model)
