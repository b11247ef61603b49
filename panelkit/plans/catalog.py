"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from panelkit.plans import model_queries as MQ
from panelkit.plans import more_queries as XQ
from panelkit.plans import queries as Q


def all_queries() -> dict:
    return {**Q.QUERIES, **MQ.QUERIES, **XQ.QUERIES}


def all_oracles() -> dict:
    return {**Q.ORACLE, **MQ.ORACLE, **XQ.ORACLE}
