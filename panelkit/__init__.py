"""panelkit: entity-by-year panel data cleaning, exploration and binary
classification, written as lazy ``DataFrame -> DataFrame`` Spark functions.

Sub-packages
------------
``sources``    CSV discovery / loading and result sinks.
``functions``  column expressions (text, numbers, keys) and schema helpers.
``operators``  row and column operators: reshape, joins, cleaning, statistics,
               windows, splits, metrics, models, explanations.
``plans``      end-to-end compositions (harmonise, clean, train) and the
               query catalogue used by ``__spark_entry__``.
``streaming``  incremental forms of the row-wise operators.
"""

from panelkit.session import get_spark, checkpoint_dir, cut_lineage  # noqa: F401

__version__ = "0.1.0"
