"""Cross-tokenizer alignment: two tokenizations of each text, cut where both end a token.

Tokenizer A is a byte-level BPE (a ``tokenizers`` JSON file) over a space and the
text, B a SentencePiece model over the text (it adds that space itself). Special
tokens are never added, and their strings inside texts are plain text. Both
sequences spell the same bytes; a text that is null, empty, or that one of them
spells differently (U+2581 reads as a space in B) has no tokens.

Method: divide and conquer at shared cuts. The ends of the tokens are byte
offsets in order. An interval of A tokens looks for an end near its middle that
bisecting the ends of B finds there too, and both halves go on; an interval
without one is a leaf group. The recursion runs level by level over all
intervals of a slice of texts, so it is numpy work however the texts are cut.
Two tokens are linked if their byte ranges overlap.

``align`` returns ids and group ends of each row; ``summaries`` also meets each
link with the number of documents that hold its id pair linked.

Scale: tokenizing is per row. What a text links is kept as its distinct id pairs
in one table, so no text is tokenized twice, and counting pairs adds up within a
batch before the shuffle. The most frequent pairs (at most ``HEAVY``, 16 MB) go to
all tasks; the rare rest of a text's pairs meets its counts in a join by pair,
which no frequent pair enters. A text is handled whole.

Inputs: null, empty and repeated rows give rows of their own; ``align`` carries
other columns and replaces columns named like its results; an empty table gives an
empty result. Long stretches without a space go through the library of the JSON
file itself, which stays fast there.
"""

from __future__ import annotations

import hashlib
import json
from collections import namedtuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import slices, worker_cache

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the pre-tokenizing pattern of byte-level BPE.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Text bytes aligned together; probes around a middle before an interval is searched whole.
SLICE, NEAR = 2 << 20, 32
#: Bytes without a space, or of spaces, from which the JSON file's own library tokenizes.
LONG = 400
#: Id pairs (long, long) that go to all tasks.
HEAVY = 1_000_000

#: Ids of all tokens, where each row's begin (and the end), the last token of each group.
Aligned = namedtuple("Aligned", "a a_first b b_first a_last b_last")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class ByteBpe:
    """Ids of texts under a byte-level BPE file, and the bytes of each id."""

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec)
        self.library.encode_special_tokens = True
        made = json.loads(spec)
        vocab, back = made["model"]["vocab"], byte_alphabet()
        special = {t["content"] for t in made["added_tokens"]}
        self.bytes: list[bytes] = [b""] * (1 + max([*vocab.values(), *[t["id"] for t in made["added_tokens"]]]))
        for token, k in vocab.items():
            self.bytes[k] = token.encode() if token in special else bytes(back[c] for c in token)
        # ids in the order of the merges are ranks: then the faster library gives the same ids
        merges = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        pre = made["pre_tokenizer"] or {}
        ranked = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and made["normalizer"] is None
                  and pre.get("use_regex", True) and all(vocab.get(x + y) == 256 + k for k, (x, y) in enumerate(merges)))
        ranks = {self.bytes[k]: k for token, k in vocab.items() if token not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if ranked else None

    def encode(self, text: str, raw: bytes) -> np.ndarray:
        if self.fast is not None and not _stretch(raw):
            return np.array(self.fast.encode_ordinary(" " + text), np.int32)
        return np.array(self.library.encode(" " + text, add_special_tokens=False).ids, np.int32)


def _stretch(raw: bytes) -> bool:
    """Whether a text holds ``LONG`` bytes in a row without a space, or of white space."""
    space = np.frombuffer(raw, np.uint8) <= 32
    turn = np.flatnonzero(space[1:] != space[:-1])
    return bool(np.diff(turn, prepend=-1, append=len(space) - 1).max(initial=0) >= LONG)


class Pieces:
    """Ids of texts under a SentencePiece model, and the bytes of each id."""

    def __init__(self, proto: bytes):
        from sentencepiece import SentencePieceProcessor
        self.library = p = SentencePieceProcessor(model_proto=proto)
        self.bytes = [bytes([int(p.id_to_piece(k)[3:5], 16)]) if p.is_byte(k) else
                      p.id_to_piece(k).replace("▁", " ").encode() for k in range(p.get_piece_size())]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


class Pair:
    """The two tokenizers of a worker."""

    def __init__(self, spec: str, proto: bytes):
        self.a, self.b = ByteBpe(spec), Pieces(proto)
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)

    def encode(self, texts: list[str]):
        """(ids of A, of B) of each text; none where the bytes differ."""
        none = np.zeros(0, np.int32)
        out = []
        for text, b in zip(texts, self.b.encode(texts)):
            raw = text.encode()
            a = self.a.encode(text, raw) if text else none
            want = b" " + raw
            if not text or b"".join([self.a.bytes[k] for k in a.tolist()]) != want or (
                    b"".join([self.b.bytes[k] for k in b]) != want):
                out.append((none, none))
            else:
                out.append((a, np.array(b, np.int32)))
        return out

    def align(self, texts: list[str]) -> Aligned:
        coded = self.encode(texts)
        a, b = (np.concatenate([x[s] for x in coded]) for s in (0, 1))
        a_first, b_first = (np.concatenate([[0], np.cumsum([len(x[s]) for x in coded])]) for s in (0, 1))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        some = a_first[1:] > a_first[:-1]
        a_last = common_ends(end_a, end_b, a_first[:-1][some], a_first[1:][some])
        return Aligned(a, a_first, b, b_first, a_last, np.searchsorted(end_b, end_a[a_last]))

    def links(self, x: Aligned) -> tuple[np.ndarray, np.ndarray]:
        """Positions (in A, in B) of all tokens whose byte ranges overlap."""
        end_a, end_b = np.cumsum(self.size_a[x.a]), np.cumsum(self.size_b[x.b])
        first = np.searchsorted(end_b, end_a - self.size_a[x.a], side="right")
        n = np.searchsorted(end_b - self.size_b[x.b], end_a, side="left") - first
        i = np.repeat(np.arange(len(x.a)), n)
        return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n - first, n)


def _ends_there(ends: np.ndarray, offset: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ends, offset)
    return ends[np.minimum(at, len(ends) - 1)] == offset


def common_ends(end_a: np.ndarray, end_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The last A token of each group, in order; the intervals [lo, hi) of A tokens end in both."""
    found = [hi - 1]
    while True:
        on = hi - lo > 1
        lo, hi = lo[on], hi[on]
        if not len(lo):
            return np.sort(np.concatenate(found))
        middle, cut, left = (lo + hi - 2) // 2, np.full(len(lo), -1), np.arange(len(lo))
        for d in range(NEAR):
            for probe in (middle[left] + d, middle[left] - d):
                inside = (probe >= lo[left]) & (probe <= hi[left] - 2) & (cut[left] < 0)
                k, probe = left[inside], probe[inside]
                hit = _ends_there(end_b, end_a[probe])
                cut[k[hit]] = probe[hit]
            left = left[(cut[left] < 0) & ((middle[left] + d + 1 <= hi[left] - 2) | (middle[left] - d - 1 >= lo[left]))]
            if not len(left):
                break
        for k in left.tolist():  # nothing near the middle: all ends of the interval
            inner = np.arange(lo[k], hi[k] - 1)
            inner = inner[_ends_there(end_b, end_a[inner])]
            if len(inner):
                cut[k] = inner[np.argmin(np.abs(inner - middle[k]))]
        split = cut >= 0
        found.append(cut[split])
        lo, hi = (np.concatenate(x) for x in ((lo[split], cut[split] + 1), (cut[split] + 1, hi[split])))


def spelled(x: Aligned) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each row: the decimal ids of its groups."""
    ids = np.empty(len(x.a) + len(x.b), np.int64)
    after = np.full(len(ids), ord(","), np.uint8)
    n_a, n_b = np.diff(x.a_last, prepend=-1), np.diff(x.b_last, prepend=-1)
    in_a = np.arange(len(x.a)) + np.repeat(x.b_last + 1 - n_b, n_a)
    in_b = np.arange(len(x.b)) + np.repeat(x.a_last + 1, n_b)
    ids[in_a], ids[in_b] = x.a, x.b
    after[in_a[x.a_last]], after[in_b[x.b_last]] = ord("|"), ord(";")
    width = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, len(str(ids.max(initial=0)))))
    end = np.cumsum(width + 1)
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    out[end - 1] = after
    for k in range(int(width.max(initial=0))):
        on = width > k
        out[end[on] - 2 - k] = ids[on] // 10 ** k % 10 + ord("0")
    edge = np.concatenate([[0], end])[x.a_first + x.b_first]
    raw = out.tobytes()
    return [raw[p:max(p, q - 1)] for p, q in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _files(model_a: str, model_b: str) -> tuple[str, bytes]:
    with open(model_a, encoding="utf-8") as f, open(model_b, "rb") as g:
        return f.read(), g.read()


def _worker(spec: str, proto: bytes) -> Pair:
    kept, key = worker_cache(), ("align", hash(spec), hash(proto))
    if key not in kept:
        kept[key] = Pair(spec, proto)
    return kept[key]


def _texts(piece: pa.RecordBatch, at) -> list[str]:
    return [t or "" for t in piece.column(at).to_pylist()]


def _shipped(df: DataFrame, model_a: str, model_b: str):
    return df.sparkSession.sparkContext.broadcast(_files(model_a, model_b))


def align(docs: DataFrame, text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """Add ``a_ids``, ``b_ids`` and ``a_ends``, ``b_ends`` (tokens up to the end of each group); the text goes."""
    names = ["a_ids", "b_ids", "a_ends", "b_ends"]
    carry = [c for c in docs.columns if c not in names and c != text_col]
    schema = T.StructType([*[docs.schema[c] for c in carry], *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])
    files = _shipped(docs, model_a, model_b)

    def lists(values, first):
        return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.astype(np.int32)))

    def task(batches):
        pair = _worker(*files.value)
        for batch in batches:
            for piece in slices(batch, len(carry), SLICE):
                x = pair.align(_texts(piece, len(carry)))
                group = np.searchsorted(x.a_last, x.a_first)
                row = np.repeat(np.arange(piece.num_rows), np.diff(group))
                cols = [lists(x.a, x.a_first), lists(x.b, x.b_first),
                        lists(x.a_last + 1 - x.a_first[row], group), lists(x.b_last + 1 - x.b_first[row], group)]
                yield pa.RecordBatch.from_arrays([*[piece.column(k) for k in range(len(carry))], *cols], [*carry, *names])

    return docs.select(*carry, text_col).mapInArrow(task, schema)


def _linked_rows(docs: DataFrame, text_col: str, files) -> DataFrame:
    """Per row its numbers, its digest, and its distinct linked id pairs with how often they are linked."""
    def task(batches):
        pair = _worker(*files.value)
        wide = len(pair.b.bytes)
        for batch in batches:
            for piece in slices(batch, "_text", SLICE):
                x = pair.align(_texts(piece, "_text"))
                n_a, n_b = np.diff(x.a_first), np.diff(x.b_first)
                n_groups = np.diff(np.searchsorted(x.a_last, x.a_first))
                i, j = pair.links(x)
                row = np.repeat(np.arange(piece.num_rows), n_a)[i]
                n_links = np.bincount(row, minlength=piece.num_rows)
                codes = x.a[i].astype(np.int64) * wide + x.b[j]
                full = len(pair.a.bytes) * wide
                distinct, times = np.unique(row * full + codes, return_counts=True)
                first = np.searchsorted(distinct, np.arange(piece.num_rows + 1) * full).astype(np.int32)
                sha = [hashlib.sha256(s).hexdigest() if s else "" for s in spelled(x)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), piece.column("doc_id"), *[pa.array(c) for c in (n_a, n_b, n_groups, n_links)],
                     pa.array(sha), pa.ListArray.from_arrays(pa.array(first), pa.array(distinct % full)),
                     pa.ListArray.from_arrays(pa.array(first), pa.array(times.astype(np.int32)))],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col(text_col).alias("_text"))
    return rows.mapInArrow(task, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                 "groups_sha256 string, pairs array<long>, times array<int>")


def _count_task(batches):
    """(pair, docs): in how many rows of the batch each pair is linked."""
    for batch in batches:
        pairs, docs = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
        for lo in range(0, len(pairs), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[lo:lo + 100_000]), pa.array(docs[lo:lo + 100_000])],
                                             ["pair", "docs"])


def pair_counts(rows: DataFrame, wide: int) -> DataFrame:
    """(pair, docs, best): the documents that hold each id pair linked, and whether no pair of its A id has more."""
    counts = rows.select("pairs").mapInArrow(_count_task, "pair long, docs long").groupBy("pair").agg(
        F.sum("docs").alias("docs"))
    counts = cut_lineage(counts)
    a_id = F.floor(F.col("pair") / wide)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("most"))
    return cut_lineage(counts.withColumn("a", a_id).join(F.broadcast(most), "a")  # a row per id of A's vocabulary
                       .select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")))


def _least_heavy(counts: DataFrame) -> int:
    """The least count from which on at most ``HEAVY`` pairs have it."""
    step = F.floor(F.log2("docs") * 16)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("docs").alias("docs")).collect(),
                    key=lambda r: -r.step):
        total += r.n
        if total > HEAVY:
            break
        least = r.docs
    return least if least is not None else 1 << 62


def summaries(docs: DataFrame, text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """Per row (doc_id) its tokens, groups and links, and what its links' id pairs count corpus-wide."""
    files = _shipped(docs, model_a, model_b)
    wide = len(Pieces(files.value[1]).bytes)
    rows = cut_lineage(_linked_rows(docs, text_col, files))
    counts = pair_counts(rows, wide)
    least = _least_heavy(counts)
    heavy = counts.filter(F.col("docs") >= least).toArrow().sort_by("pair")
    table = docs.sparkSession.sparkContext.broadcast(
        tuple(heavy.column(c).to_numpy() for c in ("pair", "docs", "best")))

    def task(batches):
        key, count, best = table.value
        for batch in batches:
            pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
            row = np.repeat(np.arange(batch.num_rows), batch.column("pairs").value_lengths().to_numpy())
            at = np.searchsorted(key, pairs)
            known = np.zeros(len(pairs), bool)
            inside = at < len(key)
            known[inside] = key[at[inside]] == pairs[inside]
            at, of, n = at[known], row[known], times[known].astype(np.int64)
            sums = np.zeros(batch.num_rows, np.int64)
            bests = np.zeros(batch.num_rows, np.int64)
            np.add.at(sums, of, n * count[at])
            np.add.at(bests, of, n * best[at])
            first = np.searchsorted(row[~known], np.arange(batch.num_rows + 1)).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(first), pa.array(x[~known])) for x in (pairs, times)]
            keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(bests), pa.array(sums), *rest],
                                             [*keep, "n_best", "count_sum", "pairs", "times"])

    out = rows.mapInArrow(task, "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, n_best long, count_sum long, pairs array<long>, times array<int>")
    light = counts.filter(F.col("docs") < least)
    if light.isEmpty():
        return out.drop("row", "pairs", "times")
    out = cut_lineage(out)
    rest = out.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    rest = rest.join(light, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("docs")).alias("more_sum"), F.sum(F.col("times") * F.col("best").cast("int")).alias("more_best"))
    out = out.drop("pairs", "times").join(rest, "row", "left")
    return out.withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))).withColumn(
        "count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).drop("row", "more_best", "more_sum")


def op12_alignment(spark, sf_dir: str, model_a: str = MODEL_A, model_b: str = MODEL_B) -> DataFrame:
    """Groups and links of the two tokenizations of every whole text, with the counts of its linked id pairs."""
    return summaries(read(spark, sf_dir, "documents"), model_a=model_a, model_b=model_b)
