"""Quality classifier: random Fourier features, ridge by normal equations, isotonic calibration.

Each text is described by document statistics (shares of character classes,
word lengths, repetition, lines; never its label, language, source or id). The
standardised statistics go through ``FEATURES`` random cosines, which
approximate a Gaussian kernel. Tasks add up the normal equations of their
labelled rows by fold; the sums are added again in Spark, row of the matrix by
row, and a ridge solution comes out per left-out fold and for all folds. The
out-of-fold scores, counted in ``BINS`` bins, give the isotonic (pool adjacent
violators) map from score to probability.

Scale: texts are read once; what remains is a narrow table. The sums have a
fixed size (``FOLDS`` matrices of ``FEATURES``^2 numbers a task, added up by
matrix row in between), and the model is some thousand numbers. Labels meet
the statistics in a narrow join.

Inputs: a null text is empty and gets a score like any other; a null label is
no label; of a repeated label the largest is used; without labelled rows, or
with one class only, the score is the share of good labels (0.5 without any), and
``good_documents`` keeps every document.
Extra columns are carried by ``good_documents``. An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import bucket_of, slices, text_buffer, words

FEATURES, WIDTH, RIDGE = 160, 3.0, 1.0
FOLDS, BINS, SEED = 4, 1000, 5
THRESHOLD = 0.7
#: Text bytes described together; some forty bytes of arrays go with each.
SLICE = 1 << 20
CLASSES = ("upper", "lower", "digit", "newline", "symbol", "stop", "shout", "pipe", "comma", "high", "other")
N_STATS = len(CLASSES) + 7


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)),
                        ("newline", b"\n\r"), ("symbol", b"#*$%&<>@^~=+_\\{}[]"), ("stop", b".?:;"), ("shout", b"!"),
                        ("pipe", b"|"), ("comma", b","), ("high", range(128, 256))):
        table[list(chars)] = CLASSES.index(name)
    return table


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``N_STATS`` numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _class_table()[data]
    row = np.repeat(np.arange(n, dtype=np.int64), size)
    counts = np.bincount(row * len(CLASSES) + kind, minlength=n * len(CLASSES)).reshape(n, -1).astype(float)
    hashes, first, starts, ends = words(data, offsets)
    n_words = np.diff(first).astype(float)
    doc = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(float)
    w = n_words + 5.0
    again = np.zeros(len(hashes), bool)  # equal to the word before it
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    distinct = np.bincount(d[new], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    top = np.zeros(n)
    np.maximum.at(top, d[new], runs)
    pairs = np.zeros(len(hashes), np.uint64)  # pairs of words, for repeated phrases
    pairs[1:] = hashes[1:] * np.uint64(3) + hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    order = np.lexsort((pairs, doc))
    p, d2 = pairs[order], doc[order]
    new2 = np.ones(len(p), bool)
    new2[1:] = (p[1:] != p[:-1]) | (d2[1:] != d2[:-1])
    phrases = np.bincount(d2[new2], minlength=n)
    chars = np.bincount(doc, length, n)
    squares = np.bincount(doc, length * length, n)
    mean = (chars + 25.0) / w
    extra = [np.log1p(n_words) / 4, mean / 5, np.sqrt(np.maximum(0, (squares + 150.0) / w - mean * mean)) / 5,
             (distinct + 5) / w, np.bincount(doc[again], minlength=n) / w, (top + 1) / w, (phrases + 5) / w]
    share = np.sqrt(counts / (size + 30.0)[:, None])
    return np.column_stack([share, *extra])


def document_statistics(docs: DataFrame, *carry: str) -> DataFrame:
    """(*carry, stats array<double>) of each text."""
    def task(batches):
        for batch in batches:
            for piece in slices(batch, "_text", SLICE):
                stats = statistics(*text_buffer(piece.column("_text")))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), N_STATS).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in carry], lists], [*carry, "stats"])

    src = docs.select(*carry, F.col("text").alias("_text"))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return src.mapInArrow(task, f"{fields}, stats array<double>")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, N_STATS)


class Kernel:
    """The standardisation and the random cosines."""

    def __init__(self, mean, scale):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = np.array(mean), np.maximum(np.array(scale), 1e-3)
        self.turn = rng.normal(size=(N_STATS, FEATURES)) / WIDTH
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.turn + self.phase) * np.sqrt(2.0 / FEATURES)
        return np.column_stack([np.ones(len(z)), waves])


def normal_equations(rows: DataFrame, kernel: Kernel) -> np.ndarray:
    """Per fold the matrix [features | label]' [features | label], from rows (stats, label, fold)."""
    n = FEATURES + 2

    def add(batches):
        total = np.zeros((FOLDS, n, n))
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([kernel(_matrix(batch.column("stats"))), batch.column("label").to_numpy()])
                fold = batch.column("fold").to_numpy()
                for f in range(FOLDS):
                    total[f] += x[fold == f].T @ x[fold == f]
        yield from _rows(total)

    def _rows(total):
        lists = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), n).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FOLDS * n)), lists], ["i", "v"])

    def again(batches):
        total = {}
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            for i, v in zip(batch.column("i").to_pylist(), flat):
                total[i] = total.get(i, 0.0) + v
        if total:
            lists = pa.array([total[i].tolist() for i in total], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(total)), lists], ["i", "v"])

    parts = rows.select("stats", F.col("label").cast("double").alias("label"), "fold").mapInArrow(
        add, "i long, v array<double>")
    sums = parts.repartition(32, "i").mapInArrow(again, "i long, v array<double>")
    out = np.zeros((FOLDS * n, n))
    for i, v in sums.collect():  # FOLDS * n rows
        out[i] += v
    return out.reshape(FOLDS, n, n)


def _ridge(sums: np.ndarray) -> np.ndarray:
    a, b = sums[:-1, :-1], sums[:-1, -1]
    penalty = np.full(len(a), RIDGE)
    penalty[0] = 1e-6
    return np.linalg.solve(a + np.diag(penalty), b)


def isotonic(count: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The non-decreasing fit to the shares good / count (pool adjacent violators).

    Each block is drawn towards the whole share by one row, so no block says 0 or 1.
    """
    blocks: list[list[float]] = []
    for c, g in zip(count, good):
        blocks.append([c, g, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            c2, g2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + c2, blocks[-1][1] + g2, blocks[-1][2] + k2]
    share = good.sum() / max(count.sum(), 1)
    return np.concatenate([np.full(int(k), (g + share) / (c + 1)) for c, g, k in blocks])


class Model:
    def __init__(self, kernel, weights, by_fold, curve=None, low=0.0, high=1.0):
        self.kernel, self.weights, self.by_fold = kernel, weights, by_fold
        self.curve, self.low, self.high = curve, low, high

    def raw(self, stats: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        x = self.kernel(stats)
        if fold is None:
            return x @ self.weights
        return np.einsum("ij,ij->i", x, self.by_fold[fold])

    @staticmethod
    def bin(raw: np.ndarray) -> np.ndarray:
        """Bins over [-0.5, 1.5]; scores of a fit to 0 and 1 lie about there, the rest in the outer bins."""
        return np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = self.raw(stats)
        # within a block of the calibration the raw score still orders the rows
        return np.clip(self.curve[self.bin(raw)] + 1e-6 * np.clip(raw, -1, 2), 0.0, 1.0)


def fit(rows: DataFrame) -> Model | float:
    """The model of labelled rows (stats, label, fold); a number if there is nothing to tell apart."""
    at = [F.element_at("stats", i + 1) for i in range(N_STATS)]
    first = rows.agg(F.count("*"), F.sum("label"), *[F.avg(a) for a in at], *[F.stddev_pop(a) for a in at]).first()
    n, good, moments = first[0], first[1] or 0, first[2:]
    if not n or good in (0, n):
        return good / n if n else 0.5
    kernel = Kernel(moments[:N_STATS], moments[N_STATS:])
    sums = normal_equations(rows, kernel)
    total = sums.sum(axis=0)
    model = Model(kernel, _ridge(total), np.array([_ridge(total - sums[f]) for f in range(FOLDS)]))

    def binned(batches):
        count, good_ = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if batch.num_rows:
                b = Model.bin(model.raw(_matrix(batch.column("stats")), batch.column("fold").to_numpy()))
                count += np.bincount(b, minlength=BINS)
                good_ += np.bincount(b, batch.column("label").to_numpy(), BINS)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), pa.array(good_[some])],
                                         ["bin", "count", "good"])

    counted = rows.select("stats", F.col("label").cast("double").alias("label"), F.col("fold").cast("int")).mapInArrow(
        binned, "bin long, count double, good double").groupBy("bin").agg(F.sum("count"), F.sum("good")).collect()
    count, good_ = np.zeros(BINS), np.zeros(BINS)
    for b, c, g in counted:  # at most BINS rows
        count[b], good_[b] = c, g
    model.curve = isotonic(count, good_)
    return model


def _labelled(stats: DataFrame, labels: DataFrame, column: str, held_out: int, folds: int) -> DataFrame:
    known = labels.filter(F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))
    rows = stats.filter(bucket_of(F.col("doc_id"), folds) != held_out).join(known, "doc_id")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")
    return cut_lineage(rows.select("stats", "label", fold.alias("fold")))


def score(stats: DataFrame, model: Model | float) -> DataFrame:
    """Replace ``stats`` by ``score``."""
    carry = [c for c in stats.columns if c != "stats"]
    if not isinstance(model, Model):
        return stats.select(*carry, F.lit(float(model)).alias("score"))

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                s = model.score(_matrix(batch.column("stats")))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(s)], [*carry, "score"])

    fields = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in carry)
    return stats.select(*carry, "stats").mapInArrow(task, f"{fields}, score double")


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; learns from labels of other rows than ``held_out``."""
    stats = cut_lineage(document_statistics(docs, "doc_id"))
    model = fit(_labelled(stats, labels, "quality", held_out, folds))
    return score(stats, model).select("doc_id", (bucket_of(F.col("doc_id"), folds) == held_out).alias("held_out"),
                                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns; all where no model can be fitted."""
    stats = cut_lineage(document_statistics(docs, "doc_id"))
    model = fit(_labelled(stats, labels, "quality", 2, 4))
    if not isinstance(model, Model):
        return docs
    text = docs.columns.index("text")

    def task(batches):  # statistics, score and verdict of a slice together; a row is there once
        for batch in batches:
            for piece in slices(batch, text, SLICE):
                good = model.score(statistics(*text_buffer(piece.column(text)))) >= THRESHOLD
                yield piece.filter(pa.array(good))

    return docs.mapInArrow(task, docs.schema)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
