"""N-gram Jaccard join with Bayesian candidate pruning.

Two texts are linked if the sets of their 5-word shingles (A-Z lower-cased; a
text of one to four words is one shingle) have a Jaccard similarity of 0.8 or
more. Texts that are equal after lower-casing are copies: they form a class
that is joined once, and they link to one another without being paired.

1. Every text gets ``HASHES`` MinHash values. Texts that agree in all ``ROWS``
   values of one of the ``BANDS`` bands are candidates; a pair at 0.8 misses
   all bands with a chance below 10^-6.
2. Candidates are compared ``STEP`` values at a time. After n values with m
   matches the posterior of the similarity (uniform prior) is Beta(m + 1, n - m
   + 1); a pair is dropped when the chance of 0.8 or more falls below
   ``TOLERANCE``. Only a forest over the surviving pairs leaves the task; in a
   large bucket a text that the forest has reached meets only those it hasn't.
3. Within the components of these pairs, all pairs are compared in the same
   way, and what is left is verified exactly on the whole shingle sets. A task
   returns counts of links and a forest over the linked, never pairs.

Scale: a large bucket or component is dealt as pairs of blocks of at most
``BLOCK`` members (and ``BLOCK_BYTES`` of text), each pair of blocks a task's
group, so no task sees more than two blocks and no pair is left out. Only
members of buckets with two or more classes carry their MinHash values, and
only members of candidate components carry their text. The work on a group of
m similar texts that all differ grows with m^2, as the exact number of links
asks for.

Result: a row per document: ``class_id``, the smallest id of all that links
connect; ``copy_of``, the smallest id of equal texts; ``n_links``, the number of
other documents it is linked with. Inputs: a text without words (null, empty)
links only to its copies; null ids are below no id and take part; a repeated row
is a copy; an empty table gives an empty result; extra columns are ignored.
Texts and shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.components import components, local_labels
from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import fold_case, free_name, give_back, mix, slices, text_buffer, words

N, THRESHOLD = 5, 0.8
BANDS, ROWS = 36, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 20, 1e-6
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Groups of more rows are walked instead of paired in the candidate stage.
WIDE = 64
#: Rows of (long, long) that may be broadcast: 16 MB.
SMALL = 1_000_000
SEED = 11
#: Text bytes that a task sketches together.
SLICE = 1 << 20


def shingles(data: np.ndarray, offsets: np.ndarray):
    """(shingle hashes, where each text's shingles begin); repeats stay."""
    h, first, _, _ = words(data, offsets)
    n = np.diff(first)
    count = np.where(n >= N, n - N + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    last = np.repeat(first[1:], count)
    padded = np.append(h, np.zeros(N, np.uint64))
    out = np.zeros(len(at), np.uint64)
    for k in range(N):
        out = out * np.uint64(0x9FB21C651E98DF25) + np.where(at + k < last, padded[at + k], np.uint64(k + 1))
    return mix(out), begin


def _permutations():
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minhash(shingle: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The MinHash values (a row per text) of texts that have shingles."""
    out = np.empty((len(begin) - 1, HASHES), np.uint64)
    for k, (a, b) in enumerate(zip(*_permutations())):
        out[:, k] = np.minimum.reduceat(shingle * a + b, begin[:-1])
    return mix(out)


def least_matches() -> np.ndarray:
    """For n values compared, the matches below which a pair is dropped.

    The posterior chance of a similarity of at least t after m of n matches is
    that of at most m successes in n + 1 trials of chance t.
    """
    out = np.zeros(HASHES + 1, np.int64)
    for n in range(1, HASHES + 1):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * THRESHOLD ** m * (1 - THRESHOLD) ** (n + 1 - m)
            if total >= TOLERANCE:
                break
            m += 1
        out[n] = m
    return out


LEAST = least_matches()


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that the incremental comparison doesn't drop."""
    match = np.zeros(len(i), np.int32)
    for k in range(0, HASHES, STEP):
        if not len(i):
            break
        match += (sig[i, k:k + STEP] == sig[j, k:k + STEP]).sum(axis=1, dtype=np.int32)
        on = match >= LEAST[k + STEP]
        i, j, match = i[on], j[on], match[on]
    return i, j


def _sketch_task(batches):
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            s, begin = shingles(*text_buffer(piece.column("text")))
            some = np.flatnonzero(np.diff(begin))
            sigs: list = [None] * piece.num_rows
            bands: list = [[]] * piece.num_rows
            if len(some):
                full = minhash(s, np.append(begin[:-1][some], begin[-1]))
                keys = np.zeros((len(some), BANDS), np.uint64)
                for r in range(ROWS):
                    keys = mix(keys * np.uint64(31) + full[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
                low = (full >> np.uint64(48)).astype(np.uint16)
                for k, row in enumerate(some):
                    sigs[row], bands[row] = low[k].tobytes(), keys[k].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("node"), piece.column("doc_id"), pa.array(sigs, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["node", "doc_id", "sig", "bands"])


def _nodes(docs: DataFrame) -> DataFrame:
    """(node, doc_id, text): ``node`` is the hash of the text that copies share."""
    return docs.select(F.xxhash64(fold_case(F.col("text"))).alias("node"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))


def _blocks(rows: DataFrame, group: str, blocks) -> DataFrame:
    """A row for each pair of blocks that a member takes part in: (group, bi, bj, own)."""
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", group), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    return rows.withColumn("other", other).withColumn("bi", F.least("own", "other")).withColumn(
        "bj", F.greatest("own", "other")).drop("other")


def _runs(batches, group: str, limit: int):
    """Record batches cut at the ends of groups (group, bi, bj): lists of slices that make up whole groups."""
    held, last, size = [], None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.column_stack([batch.column(c).to_numpy() for c in (group, "bi", "bj")])
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if last is not None and (key[0] != last).any():
            cut = np.append(0, cut)
        last = key[-1]
        size += batch.num_rows
        if len(cut) and size >= limit:  # hand on all groups that have ended
            if cut[-1]:
                held.append(batch.slice(0, int(cut[-1])))
            if held:
                yield pa.Table.from_batches(held)
            held, size = [], batch.num_rows - int(cut[-1])
            batch = batch.slice(int(cut[-1]))
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _groups(table: pa.Table, group: str) -> list[tuple[int, int, bool]]:
    """First row and end of each group (group, bi, bj) of a table, and whether it is two blocks."""
    key = np.column_stack([table.column(c).to_numpy() for c in (group, "bi", "bj")])
    edge = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1))), len(key)).tolist()
    return [(a, b, bool(key[a, 1] != key[a, 2])) for a, b in zip(edge[:-1], edge[1:])]


def _pairs(own: np.ndarray, a: int, b: int, two: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the rows a to b: of one block, or of one with the other."""
    if not two:
        i, j = np.triu_indices(b - a, 1)
        return a + i, a + j
    first = own[a:b] == own[a]
    left, right = a + np.flatnonzero(first), a + np.flatnonzero(~first)
    return np.repeat(left, len(right)), np.tile(right, len(left))


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, HASHES)


def _walk(sig: np.ndarray, side: np.ndarray, two: bool) -> tuple[np.ndarray, np.ndarray]:
    """Surviving pairs that connect what all surviving pairs connect.

    A row that is reached meets only the rows that aren't reached yet, so a group
    of near copies takes about one comparison a row. With two sides (blocks of
    a bucket) only rows of different sides meet.
    """
    free = np.ones(len(side), bool)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in np.argsort(side, kind="stable").tolist():
        if not free[start]:
            continue
        free[start] = False
        reached = [start]
        while reached:
            i = reached.pop()
            others = np.flatnonzero(free & (side != side[i]) if two else free)
            _, j = surviving(sig, np.full(len(others), i), others)
            free[j] = False
            reached += j.tolist()
            left.append(np.full(len(j), i))
            right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _candidate_task(batches):
    """Forests over the surviving pairs of buckets."""
    for table in _runs(batches, "band", 4096):
        sig, node = _signatures(table), table.column("node").to_numpy()
        own = table.column("own").to_numpy()
        held_i, held_j, n = [], [], 0

        def leave():
            i, j = surviving(sig, np.concatenate(held_i), np.concatenate(held_j))
            if not len(i):
                return None
            rows, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            # one node may be in many buckets: join its rows first
            nodes, of = np.unique(node[rows], return_inverse=True)
            at = of[at]
            label = local_labels(at[:len(i)], at[len(i):], len(nodes))
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["a", "b"])

        for a, b, two in _groups(table, "band"):
            if b - a > WIDE:
                i, j = (x + a for x in _walk(sig[a:b], own[a:b], two))
            else:
                i, j = _pairs(own, a, b, two)
            held_i.append(i)
            held_j.append(j)
            n += len(i)
            if n > 1 << 18:
                if (out := leave()) is not None:
                    yield out
                held_i, held_j, n = [], [], 0
        if n and (out := leave()) is not None:
            yield out
    give_back()


def _verify_task(batches):
    """Per member of a block pair: the copies it is linked with, and the root of its links."""
    for table in _runs(batches, "comp", 256):
        sig, node, copies = _signatures(table), table.column("node").to_numpy(), table.column("copies").to_numpy()
        text = table.column("text").combine_chunks()
        block = table.column("own").to_numpy()
        for a, b, two in _groups(table, "comp"):
            i, j = surviving(sig, *_pairs(block, a, b, two))
            if not len(i):
                continue
            s, begin = shingles(*text_buffer(text.slice(a, b - a)))
            i, j = _exact(s, begin, i - a, j - a)
            if not len(i):
                continue
            own, n = node[a:b], copies[a:b]
            links = np.bincount(i, n[j], b - a) + np.bincount(j, n[i], b - a)
            label = local_labels(i, j, b - a)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(own[label[some]]),
                                              pa.array(links[some].astype(np.int64))], ["node", "root", "links"])
    give_back()


def _exact(s: np.ndarray, begin: np.ndarray, i: np.ndarray, j: np.ndarray):
    """The pairs whose shingle sets have a Jaccard similarity of the threshold or more."""
    _, code = np.unique(s, return_inverse=True)
    sets = [np.unique(code[x:y]) for x, y in zip(begin[:-1], begin[1:])]
    size = np.array([len(x) for x in sets])
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    mark = np.zeros(int(code.max()) + 1 if len(code) else 1, bool)
    common = np.zeros(len(i), np.int64)
    edge = np.append(np.flatnonzero(np.append(True, i[1:] != i[:-1])), len(i))
    for x, y in zip(edge[:-1], edge[1:]):
        mark[sets[i[x]]] = True
        others = [sets[k] for k in j[x:y]]
        at = np.concatenate([[0], np.cumsum([len(o) for o in others])])
        common[x:y] = np.add.reduceat(mark[np.concatenate(others)], at[:-1], dtype=np.int64)
        mark[sets[i[x]]] = False
    # 0.8 as a whole-number test: 5 * common >= 4 * union
    on = 5 * common >= 4 * (size[i] + size[j] - common)
    return i[on], j[on]


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, copy_of, n_links) of every row of ``docs``."""
    base = _nodes(docs)
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = base.mapInArrow(_sketch_task, "node long, doc_id long, sig binary, bands array<long>")
    classes = cut_lineage(made.groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("sig").alias("sig"),
        F.first("bands").alias("bands")))

    def blocks(n):
        return F.ceil(F.col(n) / BLOCK).cast("int")

    bands = classes.select("node", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = bands.join(shared, "band").join(classes.select("node", "sig"), "node")
    members = _blocks(members, "band", blocks("n")).select("band", "bi", "bj", "own", "node", "sig")
    dealt = members.repartition(partitions, "band", "bi", "bj").sortWithinPartitions("band", "bi", "bj")
    near = cut_lineage(components(dealt.mapInArrow(_candidate_task, "a long, b long")).withColumnRenamed("root", "comp"))

    inside = near.join(classes.select("node", "rep", "copies", "sig"), "node")
    n_near = near.count()
    narrow = inside.select("node", "rep")
    texts = base.join(F.broadcast(narrow) if n_near <= SMALL else narrow, "node").filter(
        F.col("doc_id").eqNullSafe(F.col("rep")))
    # rows that repeat an id and its text are one
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    inside = cut_lineage(inside.join(texts, "node"))
    sizes = inside.groupBy("comp").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("held"))
    sizes = sizes.select("comp", F.greatest(blocks("n"), F.ceil(F.col("held") / BLOCK_BYTES).cast("int")).alias("b"))
    inside = _blocks(inside.join(sizes, "comp"), "comp", F.col("b")).select(
        "comp", "bi", "bj", "own", "node", "copies", "sig", "text")
    dealt = inside.repartition(partitions, "comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj")
    linked = cut_lineage(dealt.mapInArrow(_verify_task, "node long, root long, links long"))

    groups = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    found = cut_lineage(classes.select("node", "rep", "copies").join(groups.join(links, "node", "left"), "node", "left")
                        .filter("copies > 1 OR root IS NOT NULL").withColumn("root", F.coalesce("root", "node")))
    least = found.groupBy("root").agg(F.min("rep").alias("class_id"))
    found = found.join(least, "root").select(
        "node", "rep", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = base.select("node", "doc_id").join(found, "node", "left")
    alone = F.col("n_links").isNull()
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("copy_of"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their group; texts without words stay."""
    own = free_name(docs.columns, "kept_id")
    keep = near_groups(docs).filter((F.col("doc_id") <= F.col("class_id")) | F.col("doc_id").isNull()
                                    | F.col("class_id").isNull()).select(F.col("doc_id").alias(own)).distinct()
    return docs.join(keep, F.col("doc_id").eqNullSafe(F.col(own)), "left_semi")


def op6_jaccard(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document and the number of its links."""
    return near_groups(read(spark, sf_dir, "documents"))
