from hearth.plans.workflow import run_all
from hearth.session import scratch_path


def test_run_all_writes_every_output(spark, small_dir):
    res = run_all(spark, small_dir, scratch_path(spark, "t-run"))
    processed = spark.read.parquet(res["processed"])
    raw = spark.read.parquet(res["raw"])
    assert 0 < processed.count() < raw.count() == 1473
    assert processed.filter("total_bedrooms IS NULL").count() == 0  # imputed before the outlier pass
    assert spark.table("housing").count() == processed.count()
    assert spark.table("district_summary").count() == 4
    for name, path in res["statistics"].items():
        assert spark.read.parquet(path).count() > 0, name
    assert res["metrics"]["n"] > 0 and 0 < res["metrics"]["r2"] < 1
