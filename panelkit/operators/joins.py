"""Joins of the fact table with indicator panels, and the harmonise step.

Panels are keyed by (entity, year); their size is bounded by entities x
years, not by the fact table. ``join_panel`` measures the panel (written
once to the checkpoint folder, then counted) and broadcasts it only under a
byte limit; beyond it the planner's join stays, so a panel that turns out
large never overloads executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import (ENTITY_CODE_CANDIDATES, ENTITY_NAME_CANDIDATES,
                                          YEAR_MAX, YEAR_MIN)
from panelkit.operators import clean as CL
from panelkit.operators import reshape as R


MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def join_panel(fact: DataFrame, panel: DataFrame, keys=("country_code", "year"),
               broadcast: bool | None = None, suffix: str = "_panel",
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Left equi-join; overlapping non-key panel columns get ``suffix``.

    ``broadcast=None`` (default) checks the size: the panel is written once
    to the checkpoint folder, its rows are counted, and it is broadcast when
    rows x columns stays under ``max_broadcast_bytes``. So the fact table is
    never shuffled for a small panel (AQE alone would switch to a broadcast
    only after the fact side had been shuffled). A larger panel keeps the
    planner's join (sort-merge, with AQE skew splitting of hot fact keys).
    """
    keys = list(keys)
    clash = [c for c in panel.columns if c in fact.columns and c not in keys]
    if clash:
        panel = panel.withColumnsRenamed({c: c + suffix for c in clash})
    if broadcast is None:
        from panelkit.session import cut_lineage
        panel = cut_lineage(panel)
        est = panel.count() * (8 * len(panel.columns) + 32)
        broadcast = est <= max_broadcast_bytes
    if broadcast:
        panel = F.broadcast(panel)
    return fact.join(panel, keys, "left")


def derive_year(votes: DataFrame) -> DataFrame:
    """``year`` INT from year, else date (the column in one order of month and day), else session
    (1945 + session), else the first column named like '*year*'."""
    cols = votes.columns
    if "year" in cols:
        y = S.to_int(votes, "year")
    elif "date" in cols:
        text = votes.schema["date"].dataType.simpleString() == "string"
        y = S.year_from_date("date", CL.day_first(votes, ["date"], "date")["date"] if text else None)
    elif "session" in cols:
        y = S.year_from_session("session")
    else:
        yc = C.resolve_like(cols, ["year"])
        if yc is None:
            raise ValueError("derive_year: no year, date, session or *year* column")
        y = S.to_int(votes, yc)
    return votes.withColumn("year", y)


def harmonize(votes: DataFrame, indicators: DataFrame | None = None, spending: DataFrame | None = None,
              filter_issues: bool = True, lo: int = YEAR_MIN, hi: int = YEAR_MAX,
              indicator_order_by=None, spending_order_by=None, topic_patterns=None,
              indicator_mapping: dict | None = None) -> DataFrame:
    """Year derivation -> year range -> topic filter -> entity key ->
    indicator panel (left join on code, year) -> spending (left join on the
    normalised name, year; or on code when there is no name column)."""
    v = derive_year(votes).where(F.col("year").between(lo, hi))
    if filter_issues:
        v = CL.where_topic(v, topic_patterns) if topic_patterns else CL.where_topic(v)
    code = C.resolve(v.columns, ENTITY_CODE_CANDIDATES)
    v = v.withColumn("country_code", S.norm_key(F.col(f"`{code}`")) if code else F.lit("UNK"))
    out = v
    if indicators is not None:
        panel = R.extract_indicators(indicators, mapping=indicator_mapping, lo=lo, hi=hi,
                                     order_by=indicator_order_by)
        if panel is not None:
            out = join_panel(out, panel, ["country_code", "year"])
    if spending is not None:
        sp = R.extract_spending(spending, lo, hi, order_by=spending_order_by)
        if sp is not None:
            name = C.resolve(out.columns, ENTITY_NAME_CANDIDATES)
            if name:
                out = out.withColumn("_name_norm", S.norm_key(F.col(f"`{name}`")))
                sp = sp.withColumnRenamed("country_name", "_name_norm")
                out = join_panel(out, sp, ["_name_norm", "year"]).drop("_name_norm")
            else:
                sp = sp.withColumnRenamed("country_name", "country_code")
                out = join_panel(out, sp, ["country_code", "year"])
    return out
