"""MinHash near-dedup with SetSketch registers.

Two texts are linked if the sets of their distinct 4-word shingles (A-Z
lower-cased; a text of one to three words is one shingle) have a Jaccard
similarity of 0.8 or more.

1. **Registers.** For each of ``REGISTERS`` hash functions the least hash h of a
   set, read as an exponential variable of rate ``RATE``, is kept as the
   truncated exponent ``floor(1 - log_B h)`` in 0..``TOP``. The registers of a
   union are the maxima of the registers (``merge``), and two sets agree in a
   register about as often as their similarity says.
2. **Bands.** Sets that agree in all ``ROWS`` registers of one of ``BANDS`` bands
   are candidates; at 0.8 a pair misses all bands with a chance below 10^-6. The
   bands go in waves: a bucket whose members the bands before have connected
   isn't looked at again, so a large group of near copies meets in a few bands only.
3. **Joint likelihood.** How many registers of a pair are larger, smaller and
   equal is multinomial, with chances that follow from the two (known) set
   sizes and the similarity. The similarity that makes the counts likeliest is
   found by Fisher scoring. A pair is dropped if it is below 0.8 and 0.8 is so
   much less likely (ratio ``RATIO``) that chance gives it about once in 10^6.
4. **Verification.** What is left is compared on the complete shingle sets.

Components are what links connect, so a member of a group that is reached
meets only members that aren't connected with it yet (``walk``). A group of
more than ``BLOCK`` members (or ``BLOCK_BYTES`` of sets) is first dealt into random
blocks, again and again with new salts while that connects more; so a huge
group of near copies collapses in work in proportion to its size. Only what is
still unconnected then meets the rest, as pairs of blocks (``_cross``); blocks of
one component don't meet. No task sees more than two blocks, and no pair of
members that aren't connected is left out. The same steps serve the buckets
(test: likelihood) and the candidate components (test: likelihood, then sets).

Result: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id that links reach),
``kept``. Inputs: a text without words (null, empty) has no set and links with
nothing; equal sets are one node; a null id is larger than every id, takes part,
and has a null component only if all its component's ids are null (then it is
kept); rows that repeat an id all count as that id; an empty table gives an empty
result; other columns are ignored. Shingles and sets are told apart by 64-bit
hashes. A text is handled whole, so the longest one must fit a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.components import components
from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import mix, slices, text_buffer, words

N, PERCENT = 4, 80
BANDS, ROWS = 36, 5
REGISTERS = BANDS * ROWS
B, RATE, TOP = 1.001, 20.0, 65_535
#: The bands go in waves (first band of each, and the end): what the first wave connects needs no later buckets.
WAVES = (0, 6, BANDS)
#: Twice the log likelihood ratio beyond which a pair is dropped.
RATIO = 28.0
BLOCK, BLOCK_BYTES = 512, 8 << 20
#: Groups of at most so many members compare their pairs together with those of other groups.
NARROW = 48
#: Rows of (long, long) that may be broadcast: 16 MB.
SMALL = 1_000_000
SEED = 13


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, first, _, _ = words(data, offsets)
    padded = np.append(h, np.zeros(N, np.uint64))
    grams = np.zeros(len(h), np.uint64)
    for k in range(N):
        grams = mix(grams * np.uint64(0xD1342543DE82EF95) + padded[k:k + len(h)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= N:
            out.append(np.unique(grams[a:b - N + 1]))
        elif b > a:  # the whole sequence; its length keeps it apart from longer ones
            one = np.array([b - a], np.uint64)
            for k in range(a, b):
                one = mix(one * np.uint64(0xD1342543DE82EF95) + h[k:k + 1])
            out.append(one)
        else:
            out.append(h[:0])
    return out


def registers(flat: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The registers (a row per set) of sets that aren't empty: truncated minima in powers of ``B``."""
    rng = np.random.default_rng(SEED)
    scale = rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
    least = np.empty((len(begin) - 1, REGISTERS), np.uint64)
    for k in range(REGISTERS):
        least[:, k] = np.minimum.reduceat(flat * scale[k] + shift[k], begin[:-1])
    h = -np.log1p(-(least.astype(np.float64) + 0.5) * 2.0 ** -64 * (1 - 2.0 ** -53)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(B)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The registers of the union of two sets."""
    return np.maximum(a, b)


def _chance(x: np.ndarray) -> np.ndarray:
    """The chance that a register is larger for a set whose own elements are a share x."""
    return np.maximum(-np.log1p(-x * (B - 1) / B) / np.log(B), 1e-12)


def _slope(x: np.ndarray) -> np.ndarray:
    return (B - 1) / B / (1 - x * (B - 1) / B) / np.log(B)


def _likelihood(j, u, v, more, less):
    up, down = _chance(u - v * j), _chance(v - u * j)
    same = np.maximum(1 - up - down, 1e-12)
    return more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(same)


def estimate(size_a: np.ndarray, size_b: np.ndarray, more: np.ndarray, less: np.ndarray):
    """(likeliest similarity, its log likelihood less that of the threshold) of pairs.

    ``more`` and ``less`` count the registers that are larger for the first and for
    the second set. The similarity is at most the ratio of the sizes.
    """
    u = size_a / (size_a + size_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    j = np.minimum(PERCENT / 100, most)
    at = _likelihood(j, u, v, more, less)
    for _ in range(6):
        a, b = u - v * j, v - u * j
        up, down, du, dd = _chance(a), _chance(b), v * _slope(a), u * _slope(b)
        same = np.maximum(1 - up - down, 1e-12)
        score = -more * du / up - less * dd / down + (REGISTERS - more - less) * (du + dd) / same
        info = REGISTERS * (du * du / up + dd * dd / down + (du + dd) ** 2 / same)
        j = np.clip(j + score / info, 0.0, most)
    return j, _likelihood(j, u, v, more, less) - at


def likely(sig: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether each pair may reach the threshold: possible by size, and not far less likely than another similarity."""
    on = 100 * np.minimum(size[i], size[j]) >= PERCENT * np.maximum(size[i], size[j])
    for lo in range(0, len(i), 1 << 15):
        part = lo + np.flatnonzero(on[lo:lo + (1 << 15)])
        a, b = i[part], j[part]
        more, less = (sig[a] > sig[b]).sum(axis=1), (sig[a] < sig[b]).sum(axis=1)
        best, gain = estimate(size[a].astype(float), size[b].astype(float), more, less)
        on[part] = (best >= PERCENT / 100) | (2 * gain <= RATIO)
    return on


def walk(label: np.ndarray, side: np.ndarray | None, test):
    """Pairs (i, j) that connect, with the labels, all members that the links of ``test`` connect.

    ``test(i, others)`` says with which others a member is linked. Members of one
    label are connected already; with two sides only members of different sides meet.
    """
    _, code = np.unique(label, return_inverse=True)
    order = np.argsort(code, kind="stable")
    edge = np.searchsorted(code[order], np.arange(code.max() + 2))
    free, left = np.ones(len(code), bool), len(code)
    for start in range(len(code)):
        if not free[start]:
            continue
        todo = order[edge[code[start]]:edge[code[start] + 1]].tolist()
        free[todo] = False
        left -= len(todo)
        while todo and left:
            i = todo.pop()
            others = np.flatnonzero(free if side is None else free & (side != side[i]))
            if not len(others):
                continue
            hit = others[test(i, others)]
            for c in np.unique(code[hit]).tolist():
                reached = order[edge[c]:edge[c + 1]]
                yield i, int(hit[np.argmax(code[hit] == c)])
                free[reached] = False
                left -= len(reached)
                todo += reached.tolist()


def _whole_groups(batches, keys: list[str]):
    """Tables of whole groups (rows come sorted by the keys), with the groups' first rows and the end."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        key = np.column_stack([held.column(c).to_numpy() for c in keys])
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        if len(cut):
            yield held.slice(0, int(cut[-1])), np.append(0, cut)
            held = held.slice(int(cut[-1]))
    if held is not None:
        key = np.column_stack([held.column(c).to_numpy() for c in keys])
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        yield held, np.concatenate([[0], cut, [held.num_rows]])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _link_task(batches, exact: bool):
    """Edges (a, b) of nodes that connect what the links within each group (grp, bi, bj) connect."""
    for table, edge in _whole_groups(batches, ["grp", "bi", "bj"]):
        sig, node, label = _matrix(table.column("sig")), table.column("node").to_numpy(), table.column("label").to_numpy()
        size, own = table.column("n").to_numpy(), table.column("own").to_numpy()
        two = table.column("bi").to_numpy() != table.column("bj").to_numpy()
        packed = table.column("shingles").to_pylist() if exact else None
        found: list[tuple[int, int]] = []
        i_all, j_all = [], []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if (label[a:b] == label[a]).all():
                continue
            if not exact and b - a <= NARROW:
                i, j = np.triu_indices(b - a, 1)
                on = (label[a + i] != label[a + j]) & (~two[a] | (own[a + i] != own[a + j]))
                i_all.append(a + i[on])
                j_all.append(a + j[on])
                continue
            sets = [np.frombuffer(x, np.uint64) for x in packed[a:b]] if exact else None

            def test(i, others):
                on = likely(sig, size, np.full(len(others), a + i), a + others)
                if exact and on.any():
                    on[on] = _reach(sets[i], [sets[k] for k in others[on]])
                return on

            found += [(a + i, a + j) for i, j in walk(label[a:b], own[a:b] if two[a] else None, test)]
        if i_all:
            i, j = np.concatenate(i_all), np.concatenate(j_all)
            on = likely(sig, size, i, j)
            found += zip(i[on].tolist(), j[on].tolist())
        if found:
            at = np.array(found)
            pairs = np.unique(np.sort(node[at], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _reach(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Whether the similarity of a set with each other one is the threshold or more, on the complete sets."""
    size = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    at = np.searchsorted(own, flat)
    at[at == len(own)] = 0
    common = np.add.reduceat(own[at] == flat, np.cumsum(size) - size, dtype=np.int64)
    return 100 * common >= PERCENT * (len(own) + size - common)


def _sketch_task(batches):
    """Rows (doc_id, text) to (doc_id, node, n, sig, bands); a text without words has a null node."""
    for batch in batches:
        for piece in slices(batch, "text"):
            sets = shingle_sets(*text_buffer(piece.column("text")))
            size = np.array([len(x) for x in sets], np.int64)
            some = np.flatnonzero(size)
            node = np.zeros(len(sets), np.uint64)
            sigs: list = [None] * len(sets)
            bands: list = [[]] * len(sets)
            if len(some):
                flat, begin = np.concatenate([sets[k] for k in some]), np.concatenate([[0], np.cumsum(size[some])])
                node[some] = mix(np.add.reduceat(mix(flat ^ np.uint64(SEED)), begin[:-1]))
                full = registers(flat, begin)
                keys = np.zeros((len(some), BANDS), np.uint64)
                for r in range(ROWS):
                    keys = mix(keys * np.uint64(31) + full[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64))
                for k, row in enumerate(some):
                    sigs[row], bands[row] = full[k].tobytes(), keys[k].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(node.view(np.int64), mask=size == 0), pa.array(size),
                 pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                ["doc_id", "node", "n", "sig", "bands"])


def _set_task(batches):
    """Rows (text, grp) to (node, grp, shingles) of texts with words."""
    for batch in batches:
        for piece in slices(batch, "text"):
            sets = shingle_sets(*text_buffer(piece.column("text")))
            node = [int(mix(np.add.reduce(mix(x ^ np.uint64(SEED)), keepdims=True)).view(np.int64)[0]) for x in sets]
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), piece.column("grp"),
                                              pa.array([x.tobytes() for x in sets], pa.binary())],
                                             ["node", "grp", "shingles"])


def _edges(rows: DataFrame, exact: bool) -> DataFrame:
    """The edges found in the groups (grp, bi, bj) of members; each group is one block or two."""
    cols = ["grp", "bi", "bj", "own", "node", "label", "n", "sig"] + ["shingles"] * exact
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(*cols).repartition(partitions, "grp", "bi", "bj").sortWithinPartitions("grp", "bi", "bj")
    return dealt.mapInArrow(lambda it: _link_task(it, exact), "a long, b long")


def _with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels.withColumnRenamed("root", "label"), "node", "left").withColumn(
        "label", F.coalesce("label", "node"))


def _cross(rows: DataFrame) -> DataFrame:
    """Members as pairs of blocks, so that members of one group with different labels meet in one pair.

    A label with ``BLOCK`` members or more has blocks of its own, which don't meet one
    another; the other labels share blocks.
    """
    per_label = rows.groupBy("grp", "label").agg(F.count("*").alias("c"), F.sum("weight").alias("held"))
    per_label = per_label.withColumn("parts", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("held") / BLOCK_BYTES)))
    per_label = per_label.withColumn("pure", F.col("parts") > 1)
    mixed = per_label.filter(~F.col("pure")).groupBy("grp").agg(
        F.greatest(F.ceil(F.sum("c") / BLOCK), F.ceil(F.sum("held") / BLOCK_BYTES)).alias("shared"))
    per_label = per_label.join(mixed, "grp", "left").select("grp", "label", "pure", "parts", "shared")
    own = F.when(F.col("pure"), F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("parts")))).otherwise(
        F.pmod(F.xxhash64("label"), F.col("shared")))
    rows = cut_lineage(rows.drop("parts").join(per_label, ["grp", "label"]).withColumn("own", own).drop("parts", "shared"))
    blocks = rows.groupBy("grp", F.col("own").alias("other")).agg(
        F.first(F.when(F.col("pure"), F.col("label"))).alias("other_label"))
    met = rows.join(blocks, "grp").filter(~F.col("pure") | ~F.col("label").eqNullSafe(F.col("other_label")))
    return met.withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))


def connected(members: DataFrame, exact: bool, edges: DataFrame | None = None,
              labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All edges, and (node, root) of all nodes with edges, from members (grp, parts, node, n, sig[, shingles], weight).

    ``parts`` says into how many blocks the group is dealt. Edges that are known already come with their labels.
    """
    before, salt, now = None, 0, members
    while True:
        rows = _with_labels(now, labels) if edges is not None else now.withColumn("label", F.col("node"))
        own = F.pmod(F.xxhash64("node", F.lit(salt)), F.col("parts"))
        found = cut_lineage(_edges(rows.withColumn("own", own).withColumn("bi", own).withColumn("bj", own), exact))
        edges = found if edges is None else edges.unionByName(found)
        labels = cut_lineage(components(edges))
        if not salt:  # a group of one block is done
            now = cut_lineage(members.filter("parts > 1"))
        # groups whose members don't all have one label yet
        left = _with_labels(now.select("grp", "node"), labels).groupBy("grp", "label").agg(F.lit(1).alias("one"))
        left = cut_lineage(left.groupBy("grp").agg(F.count("*").alias("n_labels")).filter("n_labels > 1"))
        total = left.agg(F.sum("n_labels")).first()[0] or 0
        if not total:
            return edges, labels
        now = cut_lineage(now.join(left.select("grp"), "grp", "left_semi"))
        if before is not None and 2 * total > before:
            break
        before, salt = total, salt + 1
    edges = edges.unionByName(cut_lineage(_edges(_cross(_with_labels(now, labels)), exact)))
    return edges, cut_lineage(components(edges))


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = cut_lineage(base.mapInArrow(_sketch_task, "doc_id long, node long, n long, sig binary, bands array<long>"))
    classes = cut_lineage(rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig"), F.first("bands").alias("bands")))

    edges = near = None
    for first, last in zip(WAVES[:-1], WAVES[1:]):
        some = F.explode(F.slice("bands", first + 1, last - first)).alias("grp")
        bands = (_with_labels(classes, near) if near is not None else classes.withColumn("label", F.col("node"))).select(
            "node", "label", some)
        # buckets whose members aren't connected by the bands before
        shared = bands.groupBy("grp").agg(F.count("*").alias("m"), F.min("label").alias("a"), F.max("label").alias("b"))
        shared = cut_lineage(shared.filter("a <> b").select("grp", F.ceil(F.col("m") / BLOCK).alias("parts")))
        members = bands.select("node", "grp").join(shared, "grp").join(classes.select("node", "n", "sig"), "node")
        edges, near = connected(members.withColumn("weight", F.lit(0)), False, edges, near)

    inside = near.withColumnRenamed("root", "grp").join(classes.select("node", "rep", "n", "sig"), "node")
    narrow = inside.select(F.col("rep").alias("doc_id"), "grp")
    if near.count() <= SMALL:
        narrow = F.broadcast(narrow)
    # a row that repeats an id may bring another text: its node isn't one of these and falls out below
    sets = base.alias("t").join(narrow.alias("r"), F.col("t.doc_id").eqNullSafe(F.col("r.doc_id"))).select("text", "grp")
    sets = sets.mapInArrow(_set_task, "node long, grp long, shingles binary")
    inside = cut_lineage(inside.select("node", "grp", "n", "sig", (8 * F.col("n")).alias("weight"))
                         .join(sets, ["node", "grp"]))
    sizes = cut_lineage(inside.groupBy("grp").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("weight") / BLOCK_BYTES)).alias("parts")))
    _, links = connected(inside.join(sizes, "grp"), True)

    found = classes.select("node", "rep", "copies").join(links, "node", "left").filter("copies > 1 OR root IS NOT NULL")
    found = cut_lineage(found.withColumn("root", F.coalesce("root", "node")))
    least = found.groupBy("root").agg(F.min("rep").alias("component_id"))
    found = found.join(least, "root").select("node", "component_id", F.lit(True).alias("grouped"))
    out = rows.select("doc_id", "node", "n").join(found, "node", "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op13_setsketch(spark, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document, on 4-word shingles at 0.8."""
    return near_components(read(spark, sf_dir, "documents"))
