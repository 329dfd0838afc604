"""Table contracts that are enforced: audit, then publish.

A contract states which columns must not be NULL, which column sets identify a
row, and which types values must convert to. ``audit`` names the broken rules of
every row; ``publish`` writes the audited rows once and moves a table's location
only if no row breaks a rule, or after setting the breaking rows aside.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from hearth.config import SCALE, Scale
from hearth.operators.joins import sized_broadcast
from hearth.session import scratch_path
from hearth.sources.sinks import replace_table


@dataclass(frozen=True)
class Contract:
    """``unique`` holds column sets; ``types`` the type each value must convert to."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    types: Mapping[str, str] = field(default_factory=dict)


class ContractError(ValueError):
    """Rows break the contract; nothing was published."""


def row_rules(contract: Contract) -> list[Column]:
    """Per row rule the text of its violation, else NULL."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in contract.not_null]
    for c, kind in contract.types.items():
        rules.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(), F.lit(f"{c} is no {kind}")))
    return rules


def audit(df: DataFrame, contract: Contract, scale: Scale = SCALE) -> DataFrame:
    """``df`` with ``violations``: the broken rules of each row, in the contract's order (empty: none).

    Row rules are one projection. A repeated key is found by a count per key
    (combined map-side, so a key of any frequency is one row) and marked by a join
    with the repeated keys only, broadcast if their written size allows. Every row
    of a repeated key breaks the rule; NULL is not a key value and repeats nothing.
    """
    out = df.withColumn("violations", F.array_compact(F.array(*row_rules(contract), F.lit(None).cast("string"))))
    for columns in contract.unique:
        keys = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        side = sized_broadcast(keys.select(*columns, F.lit(True).alias("__repeated")), scale.broadcast_max_bytes)
        rule = F.when(F.col("__repeated"), F.array(F.lit(f"{', '.join(columns)} is not unique"))).otherwise(F.array().cast("array<string>"))
        out = out.join(side, list(columns), "left").withColumn("violations", F.concat("violations", rule)).drop("__repeated")
    return out.select(*df.columns, "violations")


def violating_rows(df: DataFrame, contract: Contract, scale: Scale = SCALE) -> DataFrame:
    return audit(df, contract, scale).where(F.size("violations") > 0)


def publish(spark: SparkSession, df: DataFrame, name: str, contract: Contract, on_violation: str = "refuse", path: str | None = None, scale: Scale = SCALE) -> dict:
    """Make ``df`` the table ``name`` if it keeps the contract.

    ``refuse`` raises ``ContractError`` when any row breaks a rule and leaves the
    table as it is; ``quarantine`` publishes the other rows and makes the breaking
    ones, with their violations, the table ``<name>_rejected``.
    """
    if on_violation not in ("refuse", "quarantine"):
        raise ValueError("on_violation is 'refuse' or 'quarantine'")
    staged = scratch_path(spark, "audited", name)
    marked = audit(df, contract, scale)
    marked.withColumn("__bad", F.size("violations") > 0).write.partitionBy("__bad").parquet(staged)  # the two kinds of rows lie apart
    rows = spark.read.schema(StructType([*marked.schema.fields, StructField("__bad", BooleanType())])).parquet(staged)
    good, rejected = rows.where("NOT __bad").drop("__bad", "violations"), rows.where("__bad").drop("__bad")
    bad = rejected.count()
    if bad and on_violation == "refuse":
        broken = rejected.select(F.explode("violations").alias("rule")).groupBy("rule").count().orderBy("rule").limit(20).collect()
        raise ContractError(f"{name} is not published: " + "; ".join(f"{r['rule']} in {r['count']} rows" for r in broken))
    done = replace_table(spark, good, name, path) | {"rejected": bad}
    if bad:
        replace_table(spark, rejected, f"{name}_rejected", f"{path}_rejected" if path else None)
    return done
