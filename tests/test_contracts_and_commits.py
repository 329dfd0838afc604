import math

import pytest
from pyspark.sql import functions as F

from hearth.operators import regression as R
from hearth.session import scratch_path
from hearth.sources import sinks
from hearth.sources.contracts import Contract, ContractError, audit, publish, violating_rows

CONTRACT = Contract(not_null=["v"], unique=[["k"], ["v", "w"]], types={"w": "int"})
ROWS = [(1, "a", "1"), (2, "a", "1"), (2, "b", "2"), (3, None, "3"), (None, "c", "x"), (None, "d", None), (4, "e", None), (5, "e", None)]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "k long, v string, w string")


def test_audit_names_every_broken_rule(spark):
    got = sorted(((r["k"], r["v"], r["w"]), r["violations"]) for r in audit(table(spark), CONTRACT).where("k is not null").collect())
    assert got == [
        ((1, "a", "1"), ["v, w is not unique"]), ((2, "a", "1"), ["k is not unique", "v, w is not unique"]), ((2, "b", "2"), ["k is not unique"]),
        ((3, None, "3"), ["v is null"]), ((4, "e", None), []), ((5, "e", None), []),
    ]
    assert sorted(r["v"] for r in violating_rows(table(spark), CONTRACT).where("k is null").collect()) == ["c"]


def test_publish_refuses_or_quarantines(spark):
    good = table(spark, [(9, "z", "9")])
    assert publish(spark, good, "kept_contract", CONTRACT)["rejected"] == 0
    with pytest.raises(ContractError, match="v is null in 1 rows"):
        publish(spark, table(spark), "kept_contract", CONTRACT)
    assert [r["k"] for r in spark.table("kept_contract").collect()] == [9]  # as it was
    done = publish(spark, table(spark), "kept_contract", CONTRACT, "quarantine")
    assert (done["rows_written"], done["rejected"]) == (3, 5)
    assert sorted(r["v"] for r in spark.table("kept_contract").collect()) == ["d", "e", "e"]
    rejected = spark.table("kept_contract_rejected")
    assert rejected.count() == 5 and rejected.where(F.size("violations") == 0).count() == 0
    assert spark.table("kept_contract").columns == ["k", "v", "w"]
    with pytest.raises(ValueError):
        publish(spark, good, "kept_contract", CONTRACT, "ignore")


def test_hot_repeated_key(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 7).otherwise(F.col("id")).alias("k"))
    assert violating_rows(df, Contract(unique=[["k"]])).count() == 15_000


def test_committed_changes(spark):
    sinks.replace_table(spark, spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v")), "committed")
    before = spark.table("committed").select(F.input_file_name()).distinct().collect()
    changes = spark.createDataFrame([(3, "new"), (3, "newer"), (500, "lost"), (None, "none")], "k long, new_value string")
    assert sinks.update_table(spark, "committed", changes, "v", "k")["matched"] == 1
    assert {(r["k"], r["v"]) for r in spark.table("committed").where("v != 'old'").collect()} == {(3, "newer")}
    assert spark.read.parquet(*[r[0] for r in before]).where("v = 'old'").count() == 100  # the old location is whole
    assert sinks.delete_from_table(spark, "committed", spark.range(90, 200).select(F.col("id").alias("k")), "k") == {
        "table": "committed", "location": spark.sql("DESCRIBE FORMATTED committed").where("col_name = 'Location'").first()["data_type"].removeprefix("file:"),
        "rows_written": 90, "delta": -10, "matched": 10,
    }
    assert sinks.update_table(spark, "committed", changes.where("k = 500"), "v", "k")["rows_written"] == 90
    sinks.delete_from_table(spark, "committed", spark.range(100).select(F.col("id").alias("k")), "k")
    assert spark.table("committed").count() == 0


def test_other_columns_never_without_data(spark):
    sinks.replace_table(spark, spark.range(5), "changing")
    sinks.replace_table(spark, spark.range(2).withColumn("more", F.lit(1)), "changing")
    assert spark.table("changing").columns == ["id", "more"] and spark.table("changing").count() == 2
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("changing_")]


def test_stage_pointer_moves_to_whole_snapshots(spark):
    root = scratch_path(spark, "t-pointer")
    with pytest.raises(FileNotFoundError):
        sinks.stage_path(spark, "raw", root)
    first = sinks.save_stage(spark, spark.range(3), "raw", root)
    assert sinks.stage_path(spark, "raw", root) == first
    second = sinks.save_stage(spark, spark.range(4), "raw", root)
    assert sinks.stage_path(spark, "raw", root) == second != first
    assert spark.read.parquet(first).count() == 3 and spark.read.parquet(second).count() == 4


@pytest.mark.parametrize("rows", [1, 2, 7, 5000])
def test_exact_split(spark, rows):
    df = spark.range(rows).withColumnRenamed("id", "district_id")
    train, test = R.exact_split(df)
    assert test.count() == math.ceil(rows * 0.2) and train.count() == rows - test.count()
    assert train.join(test, "district_id").count() == 0
    again = R.exact_split(df.repartition(7))[1]
    assert again.exceptAll(test).count() == 0


def test_exact_split_refines_buckets(spark):
    df = spark.range(3000).withColumnRenamed("id", "district_id")
    digest = R.split_digest()
    ordered = sorted(r[0] for r in df.select(digest).collect())
    for k in (1, 17, 1500, 3000):
        assert R.smallest_digests(df, digest, k, most=1) == ordered[k - 1]
    same = spark.createDataFrame([(None,)] * 10 + [(1,)], "district_id long")
    assert R.smallest_digests(same, digest, 4, most=2) in {r[0] for r in same.select(digest).collect()}
    train, test = R.exact_split(df.limit(0))
    assert train.count() == test.count() == 0
    with pytest.raises(ValueError):
        R.exact_split(df, test_size=1.0)
