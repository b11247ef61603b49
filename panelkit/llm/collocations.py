"""Phrase collocation mining with Rabin-Karp fingerprints.

A text (A-Z lower-cased) falls at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into
words ``[^\\x20\\x09]+``. Everything is counted per lang.

1. **Fingerprints.** Words are hashed by prefix polynomials over bytes, n-grams by
   prefix polynomials over the word hashes: the fingerprint of the words i to i + n
   is a difference of two prefixes, taken back by i powers, all in numpy.
2. **Counting.** For n = 2, 3, 4 the tasks add up (fingerprint, count) and the
   shuffle sums them. An n-gram can only reach ``least`` if both its (n-1)-grams do,
   so from n = 3 on only those are sent whose two parts are in the map of frequent
   fingerprints. The map has ``2 ** BITS`` bits (16 MB) at any size; it can let too
   many through, never too few.
3. **Verification and materialising.** A last pass reads the texts again. Occurrences
   of frequent fingerprints are grouped by fingerprint, one occurrence of each as
   pointer; all are compared by text (their words' numbers in a dictionary of the
   slice), and groups that hold several texts are split. Only these phrases become strings, and
   the shuffle adds up counts by phrase, so a collision changes no result.
4. **Scores.** Each cut of a phrase meets the counts of its two parts in joins; sums
   and products are decimals of 38 digits.

Scale: all is aggregated by fingerprint or phrase with partial sums in the tasks,
so a frequent phrase is one row a task; nothing is kept by document. The ranks come
from a window that is limited before its shuffle.

Inputs: a null text is empty, a null lang is ``und``; repeated rows count each time;
a lang without candidates has no rows; an empty table gives an empty result; other
columns are ignored. Texts are handled whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import FOLD, LOWER, UPPER, _spans, mix, slices, span_hashes, text_buffer

LEAST, LONGEST, TOP, COVER, SCALE = 30, 4, 2000, 80, 2_000_000
#: log2 of the bits of a map of fingerprints; fingerprints held by a task before it adds them up.
BITS, HELD = 27, 500_000
#: Text bytes that a counting pass looks at together, and the last pass (there a phrase is one row a slice).
COUNT_SLICE, SLICE = 1 << 19, 1 << 20

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
STEP = 0x9FB21C651E98DF25
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** k and STEP ** -k modulo 2^64."""
    if n > len(_POWERS.get("up", ())):
        size = max(n, 1 << 18)
        for name, base in (("up", STEP), ("down", pow(STEP, -1, 1 << 64))):
            _POWERS[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]))
    return _POWERS["up"], _POWERS["down"]


class Slice:
    """The words of some texts, their pieces and the fingerprints of their n-grams."""

    def __init__(self, piece: pa.RecordBatch):
        raw, offsets = text_buffer(piece.column("text"))
        self.data = FOLD[raw]
        self.inside = ~GAP[raw]
        self.starts, self.ends = _spans(self.inside, offsets)
        self.hashes = self.word_hashes()
        row = np.searchsorted(offsets, self.starts, side="right") - 1
        breaks = np.searchsorted(np.flatnonzero(BREAK[raw]), self.starts)
        new = (np.diff(row, prepend=-1) != 0) | (np.diff(breaks, prepend=0) != 0)
        self.piece = np.cumsum(new)
        self.langs, code = np.unique(np.array(piece.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        self.lang = code[row]
        seeds, _ = _lang_seeds(self.langs.tolist())
        self.seed = seeds[self.lang]
        up, down = _powers(len(self.hashes))
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * up[:len(self.hashes)])])
        self.down = down

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of every n-gram inside a piece; the lang is part of the fingerprint."""
        i = np.arange(max(0, len(self.piece) - n + 1))
        i = i[self.piece[i] == self.piece[i + n - 1]]
        return i, mix((self.prefix[i + n] - self.prefix[i]) * self.down[i] + self.seed[i] + np.uint64(n))

    def frequent(self, n: int, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Of the n-grams at these words, those in a map of n-grams."""
        key = mix((self.prefix[at + n] - self.prefix[at]) * self.down[at] + self.seed[at] + np.uint64(n))
        return has(known, key)

    def word_codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the words by number: told apart by their text."""
        ends = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        text = pa.LargeStringArray.from_buffers(len(self.starts), pa.py_buffer(ends), pa.py_buffer(self.data[self.inside]))
        coded = text.dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary


def _lang_seeds(langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [x.encode() for x in langs]
    ends = np.cumsum([len(x) for x in raw])
    starts = ends - [len(x) for x in raw]
    data = np.frombuffer(b"".join(raw), np.uint8)
    return (span_hashes(data, starts, ends) if len(data) else np.zeros(len(raw), np.uint64)), starts


def has(known: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the bit of each fingerprint is set."""
    at = key >> np.uint64(64 - BITS)
    return (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _count_task(batches, n: int, known: np.ndarray | None):
    """(key, count) of the n-grams whose two shorter n-grams are known."""
    held: list[np.ndarray] = []

    def leave():
        key, count = np.unique(np.concatenate(held), return_counts=True)
        for lo in range(0, len(key), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[lo:lo + 200_000].view(np.int64)), pa.array(count[lo:lo + 200_000])],
                                             ["key", "count"])

    for batch in batches:
        for piece in slices(batch, "text", COUNT_SLICE):
            s = Slice(piece)
            i, key = s.grams(n)
            if known is not None:
                key = key[s.frequent(n - 1, i, known) & s.frequent(n - 1, i + 1, known)]
            held.append(key)
            if sum(map(len, held)) > HELD:
                yield from leave()
                held.clear()
    if held:
        yield from leave()


def _phrase_task(batches, maps: dict[int, np.ndarray]):
    """(lang, n, phrase, count) of all words and of the n-grams whose fingerprint is in a map."""
    for batch in batches:
        for piece in slices(batch, "text", SLICE):
            s = Slice(piece)
            if not len(s.hashes):
                continue
            code, word = s.word_codes()
            for n in [1, *sorted(maps)]:
                i, key = s.grams(n)
                if n > 1:
                    on = has(maps[n], key)
                    i, key = i[on], key[on]
                if not len(i):
                    continue
                pointer, count = _groups(key, [s.lang[i], *[code[i + k] for k in range(n)]])
                at = i[pointer]
                phrase = word.take(pa.array(code[at]))
                for k in range(1, n):
                    phrase = pc.binary_join_element_wise(phrase, word.take(pa.array(code[at + k])), pa.scalar(" ", pa.large_string()))
                lang = pa.array(s.langs.tolist(), pa.string()).take(pa.array(s.lang[at]))
                out = pa.record_batch([lang, pa.array(np.full(len(at), n, np.int32)), phrase.cast(pa.string()), pa.array(count)],
                                      ["lang", "n", "phrase", "count"])
                for lo in range(0, len(at), 50_000):
                    yield out.slice(lo, 50_000)


def _groups(key: np.ndarray, text: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(one occurrence, count) of each phrase. Occurrences are grouped by fingerprint; in a group each one is
    compared with the text of the one before it, and groups that hold several texts are grouped by text."""
    order = np.argsort(key)
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    if not all((new[1:] | (t[order][1:] == t[order][:-1])).all() for t in text):
        order = np.lexsort(text[::-1])
        new = np.zeros(len(key), bool)
        new[0] = True
        for t in text:
            new[1:] |= t[order][1:] != t[order][:-1]
    first = np.flatnonzero(new)
    return order[first], np.diff(first, append=len(key))


def _map_of(keys: DataFrame) -> np.ndarray:
    """The bit map of fingerprints, built in 256 parts of at most ``2 ** BITS / 256`` bits each."""
    part_bits = BITS - 8
    bits = keys.select(F.shiftrightunsigned("key", 64 - BITS).alias("bit")).distinct()

    def build(group: pa.Table) -> pa.Table:
        at = group.column("bit").to_numpy()
        part = np.zeros(1 << part_bits, np.uint8)
        part[at & ((1 << part_bits) - 1)] = 1
        return pa.table({"part": pa.array([int(at[0] >> part_bits)], pa.int64()),
                         "raw": pa.array([np.packbits(part, bitorder="little").tobytes()])})

    parts = bits.withColumn("part", F.shiftright("bit", part_bits)).groupBy("part").applyInArrow(build, "part long, raw binary")
    known = np.zeros((256, 1 << (part_bits - 3)), np.uint8)
    for r in parts.toArrow().to_pylist():
        known[r["part"]] = np.frombuffer(r["raw"], np.uint8)
    return known.reshape(-1)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, n, phrase, f): all words (n = 1), and the phrases of 2 to ``longest`` words with f >= ``least``."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce("text", F.lit("")).alias("text"))
    context = docs.sparkSession.sparkContext
    maps: dict = {}
    for n in range(2, longest + 1):
        shorter = maps.get(n - 1)
        counted = texts.mapInArrow(lambda it, n=n, m=shorter: _count_task(it, n, m and m.value), "key long, count long")
        keys = cut_lineage(counted.groupBy("key").agg(F.sum("count").alias("f")).filter(F.col("f") >= least).select("key"))
        maps[n] = context.broadcast(_map_of(keys))
    found = texts.mapInArrow(lambda it: _phrase_task(it, {n: m.value for n, m in maps.items()}),
                             "lang string, n int, phrase string, count long")
    found = found.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("f"))
    return cut_lineage(found.filter((F.col("n") == 1) | (F.col("f") >= least)))


def _exact(c):
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each lang."""
    found = phrases(docs, least, longest)
    totals = found.filter("n = 1").groupBy("lang").agg(F.sum("f").alias("n"))  # a row per lang
    words = F.split("phrase", " ")
    candidates = found.filter("n > 1").select("lang", "phrase", F.col("n").alias("size"), F.col("f").alias("a"),
                                              words.alias("words"))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("tail"))
    parts = found.select("lang", F.col("phrase").alias("part"), "f")
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr(f"cast(a as decimal(20,0)) * {SCALE}BD div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.select("lang", "phrase", "a", F.struct(score.cast("long").alias("score"), "k", "l", "r").alias("cut"))
    best = best.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))

    # the most frequent longer candidate around each shorter phrase
    inner = F.explode(F.expr("flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
                             "p -> array_join(slice(words, p, m), ' '))))"))
    around = candidates.filter("size > 2").select("lang", inner.alias("phrase"), F.col("a").alias("longer")).groupBy(
        "lang", "phrase").agg(F.max("longer").alias("longer"))
    stay = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * cover))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = stay.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                                              "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each lang."""
    return collocations(read(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) sizes WHERE len(w) >= m
), f AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING m = 1 OR count(*) >= {LEAST}
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang
), cand AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, a AS longer, array_to_string(w[p:p + s - 1], ' ') AS phrase FROM (
    SELECT *, unnest(range(1, m - s + 2)) AS p FROM (SELECT *, unnest(range(2, m)) AS s FROM cand WHERE m > 2))
), around AS (SELECT lang, phrase, max(longer) AS longer FROM inner_ GROUP BY ALL
), stay AS (
  SELECT b.* FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < {COVER}::HUGEINT * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stay
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}
"""
