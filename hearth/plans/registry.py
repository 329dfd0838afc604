"""Registered queries: one per operator, each with its DuckDB oracle statement.

Every query reads the base tables of ``sf_dir`` (through ``districts``) and
runs over all of their rows. Floating results that are aggregates are
rounded (6 decimals unless noted) on both sides, since two engines may
differ in the last bits of a sum.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.plans import sqltext as S
from hearth.plans.views import housing
from hearth.operators import relational as rel

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


# --- M0: districts -> features -> category aggregate -------------------------------


@register(
    "aggregate_by_income_category",
    S.on_housing(
        """SELECT income_category,
       ROUND(AVG(median_house_value), 6) AS avg_house_value,
       ROUND(AVG(rooms_per_household), 6) AS avg_rooms_per_household,
       ROUND(AVG(housing_median_age), 6) AS avg_age,
       COUNT(*) AS count_districts
FROM housing WHERE income_category IS NOT NULL
GROUP BY income_category ORDER BY avg_house_value DESC"""
    ),
)
def q_aggregate_by_income_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rel.aggregate_by_income_category(housing(spark, sf_dir))
    return out.select("income_category", r6("avg_house_value"), r6("avg_rooms_per_household"), r6("avg_age"), "count_districts")


def queries() -> dict[str, QueryFn]:
    # Importing the query modules fills the registry.
    from hearth.plans import catalog  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from hearth.plans import catalog  # noqa: F401

    return dict(ORACLE)
