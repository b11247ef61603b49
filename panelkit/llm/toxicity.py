"""Toxicity by multiple-instance learning: noisy-or over sentences.

A document is a bag of sentences and only the bag is labelled. A sentence is
offending with p = sigmoid(b + the weights of its terms); a document is toxic
with 1 - prod(1 - p) (noisy-or). The weights are fitted to the document labels
by gradient steps on the log loss; afterwards p itself locates the offending
sentences.

Terms are lower-cased words (runs of letters) and their first 4, 5 and 6
characters, so inflected forms share a term. Candidate terms are chosen by
their labels: terms in at least ``MIN_DOCS`` labelled documents whose share of
toxic ones is well above the whole share (``MIN_Z`` standard errors).

Learning uses at most ``LABELLED`` labelled documents, those with the smallest
hash of their id. That is a bounded sample, as is the term list (``TERMS``);
scoring covers every whole text. Ids of the sample and the model go to the
tasks (both bounded), so no text is shuffled; only texts of the sample are
looked at for learning.

Sentences end at ``.``, ``!``, ``?`` and line breaks. A null text is empty and
has no sentences: its score is 0. A null label is no label; of a repeated label
the largest is used. Repeated documents count as often as they occur. Without
labels of both classes no term is chosen and every score is 0. Extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.tables import read
from panelkit.llm.text import FOLD, HashIndex, bucket_of, mix, slices, span_hashes, text_buffer, _spans

LABELLED = 60_000
TERMS = 4096
MIN_DOCS, MIN_Z = 3, 4.0
PREFIXES = (4, 5, 6)
EPOCHS, RATE, RIDGE = 300, 0.3, 1e-3

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
ENDS = np.zeros(256, bool)
ENDS[list(b".!?\n")] = True


def terms(data: np.ndarray, offsets: np.ndarray):
    """(term hash, sentence number) of each term, and the sentence starts.

    Sentences are numbered through all rows; a row starts a new one.
    """
    folded = FOLD[data]
    starts, ends = _spans(LETTER[data], offsets)
    cut = ENDS[data].copy()
    edge = offsets[1:][np.diff(offsets) > 0] - 1
    cut[edge] = True
    number = np.cumsum(cut) - cut  # the sentence of each byte
    begin = np.concatenate([[0], np.flatnonzero(cut) + 1])
    sentence = number[starts]
    lead = np.cumsum((data & 0xC0) != 0x80) if len(data) else np.zeros(0, np.int64)
    where = np.flatnonzero((data & 0xC0) != 0x80)
    out = [span_hashes(folded, starts, ends)]
    sent = [sentence]
    first = lead[starts] - 1  # the number of the word's first character
    where = np.append(where, len(data))
    for k in PREFIXES:
        # the byte where the character after the first k starts
        stop = where[np.minimum(first + k, len(where) - 1)]
        long_ = stop <= ends
        out.append(mix(span_hashes(folded, starts[long_], stop[long_]) + np.uint64(k)))
        sent.append(sentence[long_])
    return np.concatenate(out), np.concatenate(sent), begin


def _row(offsets: np.ndarray, begin: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    return np.searchsorted(offsets, begin[sentence], side="right") - 1


def sample(docs: DataFrame, labels: DataFrame, held_out: int, folds: int) -> dict:
    """Id to label of the documents to learn from: at most ``LABELLED``."""
    known = labels.filter(F.col("toxic").isNotNull()).filter(bucket_of(F.col("doc_id"), folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    return {i: int(y) for i, y in known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED).collect()}


def chosen(docs: DataFrame, known: dict) -> DataFrame:
    """(text, label) of the documents of the sample. The ids are broadcast: ``LABELLED`` rows at most."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(list(known.items()), f"doc_id {kind}, label long")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "label")


def _pieces(batches):
    """(slice, labels) of rows (text, label)."""
    for batch in batches:
        for piece in slices(batch, "text"):
            yield piece, piece.column("label").to_numpy()


def candidate_terms(rows: DataFrame, known: dict) -> np.ndarray:
    """Sorted hashes of the terms that speak for toxicity, from the sample's rows (text, label)."""
    def count(batches):
        for piece, label in _pieces(batches):
            data, offsets = text_buffer(piece.column("text"))
            h, sentence, begin = terms(data, offsets)
            h, row = _distinct(h, _row(offsets, begin, np.arange(len(begin) - 1))[sentence])
            u, at, n = np.unique(h, return_inverse=True, return_counts=True)
            bad = np.bincount(at, label[row], len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(bad)], ["h", "n", "bad"])

    sums = rows.mapInArrow(count, "h long, n long, bad long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    share = sum(known.values()) / max(len(known), 1)
    expect = F.col("n") * F.lit(share)
    z = (F.col("bad") - expect) / F.sqrt(expect * F.lit(1 - share) + 0.25)
    best = sums.filter((F.col("n") >= MIN_DOCS) & (z >= MIN_Z)).orderBy(z.desc(), "h").limit(TERMS).select("h").collect()
    return np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))


def _distinct(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def _hits(index: HashIndex, data, offsets):
    """(sentence, row, term) of distinct candidate terms in sentences, and the sentence starts."""
    h, sentence, begin = terms(data, offsets)
    at = index.find(h)
    on = at >= 0
    key = np.unique(sentence[on] * np.int64(len(index.keys) + 1) + at[on])
    sentence, term = key // (len(index.keys) + 1), key % (len(index.keys) + 1)
    return sentence, _row(offsets, begin, sentence), term, begin


def _bags(rows: DataFrame, keys: np.ndarray) -> DataFrame:
    """(label, bag): a row per labelled document, the candidate terms of each sentence that has any."""
    def task(batches):
        index = HashIndex(keys)
        for piece, label in _pieces(batches):
            sentence, row, term, _ = _hits(index, *text_buffer(piece.column("text")))
            bags: list[dict] = [{} for _ in label]
            for s, r, t in zip(sentence.tolist(), row.tolist(), term.tolist()):
                bags[r].setdefault(s, []).append(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array(label, pa.int64()), pa.array([list(b.values()) for b in bags], pa.list_(pa.list_(pa.int64())))],
                ["label", "bag"])

    return rows.mapInArrow(task, "label long, bag array<array<long>>")


class Model:
    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def probabilities(self, sentence: np.ndarray, term: np.ndarray):
        """Distinct sentences and their p."""
        s, at = np.unique(sentence, return_inverse=True)
        return s, 1 / (1 + np.exp(-(self.bias + np.bincount(at, self.weights[term], len(s)))))


def fit(bags: pa.Table, keys: np.ndarray, n_docs: int) -> Model:
    """Adam steps on the noisy-or log loss over ``n_docs`` documents, of which ``bags`` has those with a
    candidate term. Sentences without one count as not offending."""
    bags = bags.combine_chunks()
    label = bags.column("label").to_numpy().astype(float)
    outer = pa.concat_arrays(bags.column("bag").chunks) if bags.num_rows else pa.array([], pa.list_(pa.list_(pa.int64())))
    inner = outer.flatten()
    n = len(inner)
    doc = np.repeat(np.arange(len(outer)), outer.value_lengths().to_numpy(zero_copy_only=False))
    sent = np.repeat(np.arange(n), inner.value_lengths().to_numpy(zero_copy_only=False))
    term = inner.flatten().to_numpy(zero_copy_only=False)
    theta = np.zeros(len(keys) + 1)
    theta[:-1], theta[-1] = 1.0, -2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, EPOCHS + 1):
        z = theta[-1] + np.bincount(sent, theta[term], n)
        p = np.clip(1 / (1 + np.exp(-z)), 1e-9, 1 - 1e-9)
        clean = np.bincount(doc, np.log1p(-p), len(label))  # log of the chance that no sentence offends
        toxic = np.maximum(-np.expm1(clean), 1e-6)
        # d loss / d z: for a label 1 pulled up by its share of the document's clean chance, for a 0 down
        g = np.where(label[doc] > 0, -p * np.exp(np.minimum(clean[doc], 0)) / toxic[doc], p)
        grad = np.append(np.bincount(term, g[sent], len(keys)), g.sum()) / max(n_docs, 1)
        grad[:-1] += RIDGE * theta[:-1] / max(len(keys), 1)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(keys, theta[:-1], float(theta[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_offending, offending): the sentences with p of 0.5 or more, as
    (start, length, p), in bytes of the UTF-8 text."""
    def task(batches):
        index = HashIndex(model.keys)
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offsets = text_buffer(piece.column("text"))
                sentence, row, term, begin = _hits(index, data, offsets)
                s, p = model.probabilities(sentence, term)
                of = np.searchsorted(offsets, begin[s], side="right") - 1
                clean = np.bincount(of, np.log1p(-np.minimum(p, 1 - 1e-12)), piece.num_rows)
                found: list[list] = [[] for _ in range(piece.num_rows)]
                for k in np.flatnonzero(p >= 0.5):
                    r, a = int(of[k]), int(begin[s[k]])
                    found[r].append({"start": a - int(offsets[r]), "length": int(begin[s[k] + 1]) - a, "p": float(p[k])})
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("p", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(-np.expm1(clean)), pa.array([len(x) for x in found], pa.int64()),
                     pa.array(found, kind)], ["doc_id", "score", "n_offending", "offending"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        task, f"doc_id {kind}, score double, n_offending long, "
              "offending array<struct<start: long, length: long, p: double>>")


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 0, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_offending, offending) of every document."""
    known = sample(docs, labels, held_out, folds)
    keys = np.zeros(0, np.uint64)
    if len(set(known.values())) > 1:
        rows = chosen(docs, known)
        keys = candidate_terms(rows, known)
    model = Model(keys, np.zeros(0), -9.0)
    if len(keys):
        bags = _bags(rows, keys).filter(F.size("bag") > 0)
        model = fit(bags.toArrow(), keys, len(known))  # at most LABELLED rows of term numbers
    return score(docs, model).select("doc_id", (bucket_of(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_offending", "offending")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document, and its offending sentences."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
