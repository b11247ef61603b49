"""CSV discovery and loading (fact, indicator and spending tables).

Listing goes through the ``binaryFile`` source selecting only ``path`` and
``length`` (file contents are never read for it). A file's signature is
taken from its header alone; a row-count test reads at most ``min_rows + 1``
rows. Files are read with every column as text unless a schema is given:
type inference would cost a full extra pass over each file, and
``convert_types`` does the same job in one aggregate afterwards.
"""

from __future__ import annotations

import fnmatch
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_csv(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """(path, bytes) of the CSV files in a directory (or its whole tree)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
                 .option("recursiveFileLookup", str(recursive).lower())
                 .load(directory).select("path", F.col("length").alias("bytes")))


def _listing(spark, directory, recursive=False):
    """Driver-side file list: one row per file (metadata, not data); none where there is no such folder."""
    try:
        return [(r.path, r.bytes) for r in list_csv(spark, directory, recursive).collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def holds_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether some record of a CSV file goes over several lines: a line then has an odd number of quotes.

    One scan of the lines, which splits at any size and stops at the first such line."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).limit(1).isEmpty()


def read_csv(spark: SparkSession, path: str, schema=None, multi_line: bool | None = None) -> DataFrame:
    """A CSV file with a header; quoted records may hold line breaks.

    A file with such records can't be split and is one task; any other is read in splits.
    ``multi_line`` says which it is; by default one scan finds out (``holds_line_breaks``).
    """
    if multi_line is None:
        multi_line = holds_line_breaks(spark, path)
    r = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def _peek(spark: SparkSession, path: str) -> DataFrame:
    """For a look at the header and the first rows: right for every file, and nothing is scanned."""
    return read_csv(spark, path, multi_line=True)


def _has_rows(df: DataFrame, n: int) -> bool:
    return df.limit(n + 1).count() > n


def load_by_signature(spark: SparkSession, directory: str, any_cols=("vote", "votes"),
                      min_rows: int = 100, walk_min_rows: bool = False) -> DataFrame | None:
    """First CSV (flat listing) having one of ``any_cols`` or more than
    ``min_rows`` rows; with no flat CSV, walk the tree and take the first
    with one of ``any_cols`` (or, if ``walk_min_rows``, enough rows)."""
    flat = _listing(spark, directory)
    for path, _ in sorted(flat):
        df = _peek(spark, path)
        if set(any_cols) & set(df.columns) or _has_rows(df, min_rows):
            return read_csv(spark, path)
    if flat:
        return None
    for path, _ in sorted(_listing(spark, directory, recursive=True)):
        df = _peek(spark, path)
        if set(any_cols) & set(df.columns) or (walk_min_rows and _has_rows(df, min_rows)):
            return read_csv(spark, path)
    return None


def load_by_priority(spark: SparkSession, directory: str,
                     names=("WDIData.csv", "WDI_Data.csv", "data.csv", "indicators.csv"),
                     pattern: str = "WDI*Data*.csv", min_bytes: int = 50 * 1024 * 1024,
                     min_rows: int = 1000) -> DataFrame | None:
    """Preferred file names; else a ``pattern`` file over ``min_bytes`` with
    more than ``min_rows`` rows anywhere in the tree; else the largest flat
    file first with more than ``min_rows`` rows."""
    flat = _listing(spark, directory)
    by_name = {os.path.basename(p): p for p, _ in flat}
    for n in names:
        if n in by_name:
            return read_csv(spark, by_name[n])
    for path, size in sorted(_listing(spark, directory, recursive=True)):
        base = os.path.basename(path)
        if (base == "WDIData.csv" or fnmatch.fnmatch(base, pattern)) and size > min_bytes:
            if _has_rows(_peek(spark, path), min_rows):
                return read_csv(spark, path)
    for path, _ in sorted(flat, key=lambda x: -x[1]):
        if _has_rows(_peek(spark, path), min_rows):
            return read_csv(spark, path)
    return None


def load_spending(spark: SparkSession, directory: str) -> DataFrame | None:
    """The first readable flat CSV (one with a header); with no flat CSV, the first in the tree
    having a 'spending' / 'expenditure' column or more than 100 rows."""
    flat = _listing(spark, directory)
    for path, size in sorted(flat):
        if size and _peek(spark, path).columns:
            return read_csv(spark, path)
    if flat:
        return None
    return load_by_signature(spark, directory, ("spending", "expenditure"), 100, walk_min_rows=True)
