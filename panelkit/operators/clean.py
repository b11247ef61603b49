"""Cleaning: row filters, column drops, text and type normalisation, outliers.

Row-wise operators are single ``filter`` / ``select`` nodes (stay in one
codegen stage, no shuffle). Column-dropping operators need statistics; each
gathers the statistics of all columns in one aggregate job.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import (CODE_STANDARDIZE_CANDIDATES, CONSTANT_THRESHOLD,
                                          DROP_PATTERNS, IQR_K, INVALID_TOKENS, KEEP_COLUMNS,
                                          MERGED_PREFIXES, NUMERIC_SHARE, PRIORITY_FEATURES,
                                          SPARSE_THRESHOLD, TOPIC_CANDIDATES, TOPIC_PATTERNS,
                                          YEAR_MAX, YEAR_MIN, ZSCORE_EPS, ZSCORE_THRESHOLD)
from panelkit.operators import stats as ST


def _q(c: str) -> str:
    return f"`{c}`"


# --- row filters -----------------------------------------------------------------

def where_in(df: DataFrame, col: str, values) -> DataFrame:
    return df.where(F.col(_q(col)).isin(list(values)))


def where_year(df: DataFrame, col: str = "year", lo: int = YEAR_MIN, hi: int = YEAR_MAX) -> DataFrame:
    """Inclusive year range after numeric coercion; NULL / unparsable drop."""
    return df.where(S.to_int(df, col).between(lo, hi))


def topic_predicate(col: str, patterns=tuple(TOPIC_PATTERNS)):
    """Case-insensitive 'contains any pattern'; NULL -> False."""
    uniq = []
    for p in patterns:
        if p.lower() not in [u.lower() for u in uniq]:
            uniq.append(p)
    rx = "(?i)" + "|".join(re.escape(p) for p in uniq)
    return F.coalesce(F.col(_q(col)).cast("string").rlike(rx), F.lit(False))


def where_topic(df: DataFrame, patterns=tuple(TOPIC_PATTERNS), candidates=tuple(TOPIC_CANDIDATES)) -> DataFrame:
    """Keep rows whose topic matches any pattern; without a topic column, all."""
    col = C.resolve(df.columns, candidates)
    if col is None:
        return df
    return df.where(topic_predicate(col, patterns))


def drop_invalid(df: DataFrame, tokens=tuple(INVALID_TOKENS), exempt_prefixes=tuple(MERGED_PREFIXES),
                 null_is_invalid: bool = True) -> DataFrame:
    """Drop rows holding an invalid token in a text column or +-inf in a
    numeric column; merged indicator columns are exempt; NaN / NULL numbers
    stay (imputed later). A NULL text counts as invalid by default."""
    conds = []
    for f in df.schema.fields:
        if C.has_prefix(f.name, exempt_prefixes):
            continue
        c = F.col(_q(f.name))
        if isinstance(f.dataType, T.StringType):
            bad = c.isin(list(tokens))
            conds.append((c.isNull() | bad) if null_is_invalid else F.coalesce(bad, F.lit(False)))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            conds.append(F.coalesce(S.is_inf(c), F.lit(False)))
    if not conds:
        return df
    return df.where(~reduce(or_, conds))


def standardize_codes(df: DataFrame, candidates=tuple(CODE_STANDARDIZE_CANDIDATES)) -> DataFrame:
    """Upper-case and strip the entity code; keep only 3-letter alphabetic codes
    (a NULL code is invalid)."""
    col = C.resolve_ci(df.columns, candidates)
    if col is None:
        return df
    code = F.upper(S.strip(F.col(_q(col)).cast("string")))
    return df.withColumn(col, code).where(S.is_alpha(F.col(_q(col)), 3))


# --- column drops ----------------------------------------------------------------

def drop_matching(df: DataFrame, patterns=tuple(DROP_PATTERNS), keep=tuple(KEEP_COLUMNS)) -> DataFrame:
    cols = C.matching_columns(df.columns, patterns, keep)
    return df.drop(*cols) if cols else df


def sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD,
                   priority=tuple(PRIORITY_FEATURES)) -> list:
    """Columns whose NULL share exceeds the threshold (priority ones kept)."""
    if not df.columns:
        return []
    r = df.agg(*[F.avg(S.present(df, c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    if r is None:
        return []
    r = r.asDict()
    return [c for c in df.columns if r[c] is not None and r[c] > threshold and c not in priority]


def drop_sparse(df: DataFrame, threshold: float = SPARSE_THRESHOLD, priority=tuple(PRIORITY_FEATURES)) -> DataFrame:
    cols = sparse_columns(df, threshold, priority)
    return df.drop(*cols) if cols else df


def constant_columns(df: DataFrame, threshold: float = CONSTANT_THRESHOLD) -> list:
    """Constant (<= 1 distinct present value) and near-constant columns.

    Near-constant: distinct / rows < 1 - threshold and the top value holds at
    least ``threshold`` (more than half) of the present values. NaN is missing.

    Pass 1 (one aggregate, no per-column row copies): count, min, max and the
    approximate median of the value hashes. A value that holds ``threshold`` of
    the rows also holds the middle of the hashes, far beyond the median's rank
    error, so it is the only value that can qualify. Pass 2 counts it exactly.
    Pass 3 counts the distinct values of the columns that qualify.
    """
    cols = [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType))]
    if not cols:
        return []
    aggs = [F.count(F.lit(1)).alias("_n")]
    # 52 bits: the approximate median works on doubles
    hashes = [F.when(S.present(df, c).isNotNull(), F.shiftrightunsigned(F.xxhash64(_q(c)), 12)) for c in cols]
    for i, (c, h) in enumerate(zip(cols, hashes)):
        x = S.present(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.percentile_approx(h, 0.5, 1000).alias(f"m{i}")]
    r = df.agg(*aggs).first().asDict()
    n = r["_n"]
    if not n:
        return []
    drop = {c for i, c in enumerate(cols) if r[f"n{i}"] == 0 or r[f"lo{i}"] == r[f"hi{i}"]}
    rest = [i for i, c in enumerate(cols) if c not in drop]
    if rest:
        top = df.agg(*[F.count(F.when(hashes[i] == r[f"m{i}"], 1)).alias(f"t{i}") for i in rest]).first().asDict()
        cand = [cols[i] for i in rest if top[f"t{i}"] >= threshold * r[f"n{i}"]]
        if cand:
            d = df.agg(*[F.count_distinct(S.present(df, c)).alias(c) for c in cand]).first().asDict()
            drop |= {c for c in cand if d[c] < (1 - threshold) * n}
    return [c for c in cols if c in drop]


def drop_constant(df: DataFrame, threshold: float = CONSTANT_THRESHOLD) -> DataFrame:
    cols = constant_columns(df, threshold)
    return df.drop(*cols) if cols else df


# --- duplicates -------------------------------------------------------------------

def remove_duplicates(df: DataFrame, subset=None, order_by=None) -> DataFrame:
    """Full-row duplicates: ``dropDuplicates`` (combined map-side). Subset
    duplicates: keep the first row per subset key in ``order_by`` order."""
    from panelkit.operators.impute import dedupe_first

    subset = [c for c in (subset or []) if c in df.columns]
    if not subset:
        return df.dropDuplicates()
    return dedupe_first(df, subset, order_by or [])


# --- text and types ---------------------------------------------------------------

def clean_text_columns(df: DataFrame, cols=None) -> DataFrame:
    """Strip, collapse white space and null-token every text column."""
    cols = list(cols or C.string_cols(df))
    if not cols:
        return df
    return df.withColumns({c: S.clean_text(F.col(_q(c))) for c in cols})


def day_first(df: DataFrame, cols, kind: str = "timestamp_ntz") -> dict:
    """{column: whether its numeric dates put the day first}: the order that reads more of the column's
    values, month first if both read as many. One aggregate for all columns."""
    cols = list(cols)
    if not cols:
        return {}

    def read(c, forms):
        return F.count(F.coalesce(*[S.read_date(F.col(_q(c)), i, kind) for i in forms]))

    r = df.agg(*[read(c, forms).alias(f"{name}{k}") for k, c in enumerate(cols)
                 for name, forms in (("m", S.MONTH_FIRST), ("d", S.DAY_FIRST))]).first()
    return {c: r[f"d{k}"] > r[f"m{k}"] for k, c in enumerate(cols)}


def convert_types(df: DataFrame, share: float = NUMERIC_SHARE) -> DataFrame:
    """Text columns where more than ``share`` of ALL rows parse as numbers
    become DOUBLE; text columns named like '*date*' (not exactly 'date')
    become timestamps (``scalars.DATE_FORMS``), each column in one order of month and day
    (``day_first``). One job for all columns' parse shares, one for the orders."""
    scols = C.string_cols(df)
    out = df
    if scols:
        r = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count(S.safe_double(F.col(_q(c)))).alias(c) for c in scols]).first().asDict()
        n = r["_n"]
        num = [c for c in scols if n and r[c] / n > share]
        if num:
            out = out.withColumns({c: S.safe_double(F.col(_q(c))) for c in num})
    dates = [c for c in C.string_cols(out) if "date" in c.lower() and c != "date"]
    if dates:
        order = day_first(out, dates)
        out = out.withColumns({c: S.parse_date(F.col(_q(c)), "timestamp_ntz", order[c]) for c in dates})
    return out


# --- outliers ---------------------------------------------------------------------

def outlier_bounds(df: DataFrame, cols, method: str = "iqr", threshold: float = ZSCORE_THRESHOLD,
                   exact_limit: int | None = None) -> dict:
    """{col: (lo, hi, usable_for_removal)} from one statistics job."""
    out = {}
    if method == "iqr":
        qs = ST.quantiles(df, cols, [0.25, 0.75], exact_limit)
        for c in cols:
            q1, q3 = qs[c]
            if q1 is None:
                out[c] = (None, None, False)
                continue
            iqr = q3 - q1
            out[c] = (q1 - IQR_K * iqr, q3 + IQR_K * iqr, iqr > 0)
    else:
        d = ST.describe_cols(df, cols)
        for c in cols:
            m, s, _ = d[c]
            out[c] = (m, s, m is not None and s is not None)
    return out


def remove_outliers(df: DataFrame, cols=None, method: str = "iqr", strictness: str = "moderate",
                    threshold: float = ZSCORE_THRESHOLD, exclude=(), exempt_prefixes=tuple(MERGED_PREFIXES),
                    exact_limit: int | None = None) -> DataFrame:
    """IQR or z-score outliers.

    strict: drop a row flagged in any column; moderate: flagged in more than
    half of the columns; lenient: clip to the bounds, drop nothing. Unknown
    strictness acts as strict.
    """
    cols = list(cols) if cols is not None else C.outlier_columns(df, exclude, exempt_prefixes)
    if not cols:
        return df
    b = outlier_bounds(df, cols, method, threshold, exact_limit)
    if strictness == "lenient":
        repl = {}
        for c in cols:
            x = F.col(_q(c))
            if method == "iqr":
                lo, hi, _ = b[c]
            else:
                m, s, ok = b[c]
                lo, hi = (m - threshold * s, m + threshold * s) if ok else (None, None)
            if lo is None or hi is None:
                continue
            repl[c] = S.clip(x, float(lo), float(hi))
        return df.withColumns(repl) if repl else df
    flags = []
    for c in cols:
        x = F.col(_q(c)).cast("double")
        if method == "iqr":
            lo, hi, ok = b[c]
            if not ok:
                continue
            f = (x < F.lit(lo)) | (x > F.lit(hi))
        else:
            m, s, ok = b[c]
            if not ok:
                continue
            f = F.abs((x - F.lit(m)) / F.lit(s + ZSCORE_EPS)) >= F.lit(threshold)
        flags.append(F.coalesce(f, F.lit(False)).cast("int"))
    if not flags:
        return df
    score = reduce(lambda a, b2: a + b2, flags)
    limit = len(cols) / 2 if strictness == "moderate" else 0
    return df.where(~(score > F.lit(limit)))


# --- pipeline ---------------------------------------------------------------------

def comprehensive_clean(df: DataFrame, remove_duplicates_: bool = True, remove_outliers_: bool = True,
                        remove_constants: bool = True, clean_invalid: bool = True,
                        standardize_countries: bool = True, remove_irrelevant: bool = True,
                        clean_text: bool = True, convert_types_: bool = True,
                        outlier_strictness: str = "moderate", cut: bool = True) -> DataFrame:
    """Fixed order: irrelevant columns -> text -> types -> invalid rows ->
    codes -> constant columns -> duplicates -> outliers. Falls back to the
    input if nothing is left.

    With ``cut`` the frame is checkpointed (reliable, shared folder) after the
    codes, so the passes of the constant columns and the duplicate removal don't
    parse every text and date again, and after the duplicate removal: the
    emptiness checks and the outlier statistics then read the checkpoint
    instead of re-running that shuffle each time."""
    from panelkit.session import cut_lineage

    if df.isEmpty():
        raise ValueError("comprehensive_clean: empty input")
    out = df
    if remove_irrelevant:
        out = drop_matching(out)
    if clean_text:
        out = clean_text_columns(out)
    if convert_types_:
        out = convert_types(out)
    if clean_invalid:
        out = drop_invalid(out)
    if standardize_countries:
        out = standardize_codes(out)
    if cut and remove_constants:
        out = cut_lineage(out)
    if remove_constants:
        out = drop_constant(out)
    if remove_duplicates_:
        out = remove_duplicates(out)
    if cut:
        out = cut_lineage(out)
    if remove_outliers_ and not out.isEmpty():
        out = remove_outliers(out, strictness=outlier_strictness)
    if out.isEmpty():
        return df
    return out
