"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text becomes a vector of four statistics: the log of the mean word length
and the square roots of the shares of symbols, duplicate lines and words in
repeated windows. Every share is smoothed towards a usual text, so a short text
isn't odd by chance. For every (lang, source) the minimum-covariance-determinant
estimate is found by concentration steps from three starts: take the mean and
covariance of a subset, keep the three quarters of the rows that lie nearest by
Mahalanobis distance, repeat; the start with the smallest determinant wins. A
text is rejected beyond ``CUTOFF`` (squared distance), or if a base rule fails.

A variance floor (``FLOOR``) stands for differences that are too small to
matter; without it a group whose texts never hold a symbol would reject the
first one that does. Rows of (lang, source) pairs with fewer than ``MIN_ROWS``
rows are pooled by language, and pooled over all if that is still too few. A
pool below ``LEAST`` rows gives no verdict, so its rows pass.

Scale: texts are read once; the concentration steps run on a narrow table with
one aggregate per step (partial sums by group and bin; a group's rows meet its
estimate in ``PARTS`` parts, so a hot group is no single task). The distance within which three quarters lie is read off a histogram of
log distances (``BINS`` per doubling), which is exact about its rows and takes
bounded memory: the subset holds every row of the bin that reaches the share.

Inputs: a null text is empty, has no words and fails a base rule; a null lang
or source is a value of its own; ties in distance fall in one bin; repeated
rows count as rows; an empty table gives an empty result; extra columns are
ignored. ``n_repeat_words`` compares windows by a 64-bit hash of their words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import words_column

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_ROWS, LEAST = 100, 20
KEEP = 0.75
STEPS = 4
BINS = 64
#: chi-squared with 4 degrees of freedom: the consistency factor of the best
#: three quarters, and a squared distance that one in 10^12 exceeds.
FACTOR, CUTOFF = 1.486, 60.0
FLOOR = (0.04, 0.06, 0.06, 0.06)
DIMS = len(FLOOR)
#: parts in which the rows of a group meet its estimate
PARTS = 64
#: a usual text, towards which short ones are smoothed: words, characters a word, lines
PRIOR_WORDS, PRIOR_CHARS, PRIOR_LINES = 50, 5.0, 10


def _covered(s: Column) -> Column:
    """Positions covered by windows whose key occurs twice or more, from the
    sorted array of (key, position). Every array that a lambda looks into is a
    variable of an enclosing lambda, so it is computed once per row."""
    same = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
                    | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)))
    at = F.sort_array(F.transform(same, lambda x: x["i"]))

    def length(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    return F.aggregate(F.array(at), F.lit(0), lambda _, p: length(p))


def repeat_words(rows: DataFrame) -> DataFrame:
    """Replace the words ``w`` by ``n_repeat_words``: words in 5-word windows that occur twice or more.

    The selects are apart on purpose: each array is used more than once, so
    the optimizer keeps them apart and computes each once per row.
    """
    rest = [c for c in rows.columns if c != "w"]
    n = F.size("h") - WINDOW
    keys = F.slice(F.transform("h", lambda x, i: F.xxhash64(x, *[F.get("h", i + k) for k in range(1, WINDOW)])),
                   F.lit(1), n + 1)
    rows = rows.select(*rest, F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    rows = rows.select(*rest, F.when(n >= 1, keys).alias("keys"))
    pairs = F.sort_array(F.transform("keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    count = F.aggregate(F.array(pairs), F.lit(0), lambda _, s: _covered(s))
    some = F.size(F.array_distinct("keys")) < F.size("keys")
    return rows.select(*rest, F.when(some, count).otherwise(0).cast("long").alias("n_repeat_words"))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The base statistics and the vector x1..x4 of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", *keep, words_column(text).alias("w"),
                       F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                       F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("l"))
    n, chars = F.size("w").cast("long"), F.length(F.array_join("w", "")).cast("long")
    base = base.select("doc_id", *keep, n.alias("n_words"), chars.alias("word_chars"), "n_symbols",
                       F.size("l").cast("long").alias("n_lines"),
                       (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"), "w")
    base = repeat_words(base)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    w = F.col("n_words") + PRIOR_WORDS
    return base.withColumns({
        "base_failed": failed,
        "x1": F.ln((F.col("word_chars") + PRIOR_WORDS * PRIOR_CHARS) / w),
        "x2": F.sqrt(F.col("n_symbols") / w),
        "x3": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + PRIOR_LINES)),
        "x4": F.sqrt(F.col("n_repeat_words") / w)})


def _group(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add ``grp``: the pair, its language's pool, or the pool of all."""
    def name(cols):
        return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})

    fine = rows.groupBy(*by).agg(F.count("*").alias("n"))
    level = by[:1]
    pools = fine.filter(F.col("n") < MIN_ROWS).groupBy(*level).agg(F.sum("n").alias("pool"))
    pools = pools.select(*[F.col(c).alias(f"_{c}") for c in level], "pool")
    fine = fine.join(pools, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in level]), "left")
    grp = F.when(F.col("n") >= MIN_ROWS, name(by)).when(F.col("pool") >= MIN_ROWS, name(level)).otherwise("all")
    fine = fine.select(*[F.col(c).alias(f"_{c}") for c in by], grp.alias("grp"))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    part = F.pmod(F.xxhash64("doc_id", *XS), F.lit(PARTS)).cast("int")
    return rows.join(fine, on).drop(*[f"_{c}" for c in by]).withColumn("part", part)


def _meet(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Join a table by ``grp`` to the rows, whose groups are split into ``PARTS`` parts.

    The part is a key of the join, so neither the join nor an aggregate after
    it puts a hot group into one task, however the join is planned.
    """
    parts = table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return rows.join(parts, ["grp", "part"], how).drop("part")


XS = [f"x{i + 1}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
SUMS = {"n": F.count, **{f"s{i}": F.sum for i in range(DIMS)}, **{f"p{i}{j}": F.sum for i, j in PAIRS}}


def _sums(rows: DataFrame, *by: str) -> DataFrame:
    """Count, sums and sums of products of the vectors; they add up over groups."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(XS)],
        *[F.sum(F.col(XS[i]) * F.col(XS[j])).alias(f"p{i}{j}") for i, j in PAIRS])


def _factor(m: DataFrame) -> DataFrame:
    """Means and the Cholesky factor of the floored covariance from sums, and its log determinant."""
    m = m.select("*", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(DIMS)])
    for i, j in PAIRS:
        rest = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.lit(0.0))
        c = F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
        c = c * FACTOR + (FLOOR[i] ** 2 if i == j else 0.0) - rest
        m = m.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-12))) if i == j else c / F.col(f"l{j}{j}"))
    logdet = reduce(lambda a, b: a + b, [F.ln(f"l{i}{i}") for i in range(DIMS)])
    return m.select("grp", "start", "n_rows", logdet.alias("logdet"), *[f"m{i}" for i in range(DIMS)],
                    *[f"l{i}{j}" for i, j in PAIRS])


def _distance(rows: DataFrame) -> DataFrame:
    """Add ``d2`` from the joined means and factors."""
    for i in range(DIMS):
        rest = reduce(lambda a, b: a + b, [F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)], F.lit(0.0))
        rows = rows.withColumn(f"z{i}", (F.col(f"x{i + 1}") - F.col(f"m{i}") - rest) / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(DIMS)]))


def _step(rows: DataFrame, est: DataFrame) -> DataFrame:
    """A concentration step: the estimate from the nearest ``KEEP`` of each (grp, start)'s rows.

    The sums are taken by bin of the log distance, so one pass over the rows
    gives both the distance that the share reaches and the sums within it.
    """
    bin_ = F.floor(F.log2(F.col("d2") + 1e-9) * BINS).cast("long")
    far = _distance(_meet(rows, est)).withColumn("bin", bin_)
    # at most some thousands of bins a group, whatever the rows
    one = F.struct("bin", *SUMS)
    bins = _sums(far, "grp", "start", "bin").groupBy("grp", "start").agg(
        F.sum("n").alias("n_rows"), F.sort_array(F.collect_list(one)).alias("bins"))
    first = F.struct(*[F.lit(0).cast("long" if c == "n" else "double").alias(c) for c in SUMS])
    total = F.aggregate("bins", first, lambda a, b: F.when(
        a["n"] < F.ceil(F.col("n_rows") * KEEP), F.struct(*[(a[c] + b[c]).alias(c) for c in SUMS])).otherwise(a))
    return _factor(bins.select("grp", "start", "n_rows", total.alias("t")).select("grp", "start", "n_rows", "t.*"))


def estimates(rows: DataFrame) -> DataFrame:
    """The MCD estimate of each ``grp``: (grp, n_rows, means, factors)."""
    odd = F.col("x2") + F.col("x3") + F.col("x4")
    mean = cut_lineage(rows.groupBy("grp").agg(F.avg(odd).alias("odd"), F.avg("x1").alias("mid"),
                                               F.stddev_pop("x1").alias("sd")))
    # starts: all rows; those with few oddities; of these, those of a usual word length
    low = odd <= F.col("odd")
    starts = F.when(low & (F.abs(F.col("x1") - F.col("mid")) <= F.col("sd")), F.array(*map(F.lit, (0, 1, 2)))).when(
        low, F.array(*map(F.lit, (0, 1)))).otherwise(F.array(F.lit(0)))
    subset = _meet(rows, mean).select("grp", F.explode(starts).alias("start"), *XS)
    est = cut_lineage(_factor(_sums(subset, "grp", "start").withColumn("n_rows", F.col("n"))))
    for _ in range(STEPS):
        est = cut_lineage(_step(rows, est))
    best = est.groupBy("grp").agg(F.min(F.struct("logdet", "start")).alias("b")).select(
        "grp", F.col("b.start").alias("start"))
    return est.join(best, ["grp", "start"]).drop("start", "logdet")


def judge(docs: DataFrame) -> DataFrame:
    """Statistics, ``base_failed``, ``distance`` (squared) and ``kept`` of every document."""
    rows = cut_lineage(statistics(docs, "lang", "source"))
    rows = cut_lineage(_group(rows, ["lang", "source"]))
    out = _distance(_meet(rows, estimates(rows), "left"))
    far = F.coalesce(F.col("d2") > CUTOFF, F.lit(False)) & (F.col("n_rows") >= LEAST)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~far).alias("kept"), F.col("d2").alias("distance"), "grp")


def op7_outliers(spark, sf_dir: str) -> DataFrame:
    """The verdict on every document."""
    return judge(read(spark, sf_dir, "documents"))
