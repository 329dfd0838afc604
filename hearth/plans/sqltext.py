"""SQL text shared by the oracle statements (DuckDB dialect, ANSI where possible).

Each oracle statement is self-contained: it starts from the base views
(orders, lineitem) through the same ``districts`` definition the Spark side
builds with the DataFrame API.
"""

from __future__ import annotations

from hearth import config
from hearth.sources.fixtures import DISTRICTS_SQL, RAW_AVERAGES_SQL

RAW = ", ".join(config.RAW_COLUMNS)


def bin_case(column: str, bins, default: str) -> str:
    parts = []
    for label, lo, hi in bins:
        cond = f"{column} >= {float(lo)!r}"
        if hi != float("inf"):
            cond += f" AND {column} < {float(hi)!r}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{default}' END"


def dbl(v: float) -> str:
    """A DOUBLE literal (a bare 0.25 is DECIMAL in DuckDB)."""
    return f"CAST({float(v)!r} AS DOUBLE)"


def sorted_list(col: str) -> str:
    return f"list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL))"


def _order_stats(xs: str, p: float):
    q = (p * 100.0) / 100.0  # pandas' round trip through percent
    pos = f"(CAST(len({xs}) - 1 AS DOUBLE) * {dbl(q)})"  # numpy's linear virtual index
    a = f"{xs}[CAST(floor({pos}) AS BIGINT) + 1]"
    b = f"{xs}[CAST(ceil({pos}) AS BIGINT) + 1]"
    t = f"({pos} - floor({pos}))"
    return a, b, t


def lerp(xs: str, p: float) -> str:
    """numpy's linear quantile of a sorted list (pandas ``Series.quantile``)."""
    a, b, t = _order_stats(xs, p)
    return f"(CASE WHEN {t} < 0.5 THEN {a} + ({b} - {a}) * {t} ELSE {b} - ({b} - {a}) * (CAST(1.0 AS DOUBLE) - {t}) END)"


def midpoint(xs: str) -> str:
    """pandas ``Series.median``: the middle value, or the mean of the two middle values."""
    a, b, _ = _order_stats(xs, 0.5)
    return f"(({a} + {b}) / CAST(2.0 AS DOUBLE))"


INCOME_CASE = bin_case("median_income", config.INCOME_BINS, config.INCOME_DEFAULT)
AGE_CASE = bin_case("housing_median_age", config.AGE_BINS, config.AGE_DEFAULT)

def features_ctes(source: str, out: str, p: str = "f") -> str:
    """CTEs deriving the feature table ``out`` from ``source``: ratios filled
    with their medians (bedrooms capped after), income and age categories."""
    return f"""{p}_ratios AS (SELECT *, total_rooms / NULLIF(households, 0) AS r_rph,
                  total_bedrooms / NULLIF(total_rooms, 0) AS r_bpr,
                  population / NULLIF(households, 0) AS r_pph FROM {source}),
{p}_lists AS (SELECT {sorted_list("r_rph")} AS l_rph, {sorted_list("r_bpr")} AS l_bpr,
                       {sorted_list("r_pph")} AS l_pph FROM {p}_ratios),
{p}_medians AS (SELECT {midpoint("l_rph")} AS m_rph, {midpoint("l_bpr")} AS m_bpr,
                         {midpoint("l_pph")} AS m_pph FROM {p}_lists),
{out} AS (SELECT district_id, {RAW},
       COALESCE(r_rph, m_rph) AS rooms_per_household,
       CASE WHEN COALESCE(r_bpr, m_bpr) > 1.0 THEN 1.0 ELSE COALESCE(r_bpr, m_bpr) END AS bedrooms_per_room,
       COALESCE(r_pph, m_pph) AS population_per_household,
       {INCOME_CASE} AS income_category,
       {AGE_CASE} AS age_category
FROM {p}_ratios, {p}_medians)"""


# districts -> ratios filled with their medians (bedrooms capped after) -> categories
HOUSING_CTES = f"districts AS ({DISTRICTS_SQL}),\n" + features_ctes("districts", "housing")

SUMMARY_CTE = """district_summary AS (SELECT income_category,
       AVG(median_house_value) AS avg_house_value,
       AVG(rooms_per_household) AS avg_rooms,
       AVG(housing_median_age) AS avg_age,
       COUNT(*) AS district_count
FROM housing WHERE income_category IS NOT NULL GROUP BY income_category)"""


def on_districts(body: str) -> str:
    return f"WITH districts AS ({DISTRICTS_SQL})\n{body}"


def on_raw_averages(body: str) -> str:
    return f"WITH districts AS ({DISTRICTS_SQL}),\nraw_averages AS ({RAW_AVERAGES_SQL})\n{body}"


def on_housing(body: str, extra_ctes: str = "") -> str:
    ctes = HOUSING_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


def r6(expr: str, alias: str, digits: int = 6) -> str:
    return f"ROUND({expr}, {digits}) AS {alias}"
