"""Compositions: the processed table and a training run (no new operators).

On a cluster, the processed table is written once to the shared folder and
read back, so the statistics jobs of later steps scan a materialised table
instead of recomputing the cleaning plan, and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth import config
from hearth.config import SCALE, Scale
from hearth.operators import features as FE
from hearth.operators import quality as Q
from hearth.operators import regression as R
from hearth.session import materialise
from hearth.sources.fixtures import districts


def processed(raw: DataFrame, method: str = config.OUTLIER_METHOD, threshold: float | None = None, scale: Scale = SCALE) -> DataFrame:
    """raw -> impute (median, only if anything is missing) -> outliers -> features."""
    rows, counts = Q.missing_counts(raw)
    missing = [c for c in raw.columns if counts[c] > 0]
    cleaned = Q.impute(raw, config.IMPUTE_STRATEGY, columns=missing, scale=scale, max_rows=rows) if missing else raw
    kept = Q.remove_outliers(cleaned, method, threshold, scale=scale)
    return FE.all_features(kept, scale=scale)


def processed_districts(spark: SparkSession, sf_dir: str, scale: Scale = SCALE) -> DataFrame:
    return processed(districts(spark, sf_dir), scale=scale)


def training_run(spark: SparkSession, table: DataFrame, model_path: str | None = None) -> dict:
    """prepare -> split -> fit -> evaluate -> (save); returns model, metrics, importance."""
    prepared, feats = R.prepare_features(table)
    prepared = materialise(spark, prepared, "prepared")
    train, test = R.train_test_split(prepared)
    model = R.fit_ols(train, feats)
    metrics = R.evaluate_metrics(R.predictions(model, test)).first().asDict()
    n_train = int(model.stages[-1].summary.numInstances)
    out = {
        "model": model,
        "features": feats,
        "metrics": metrics,
        "train_r2": float(model.stages[-1].summary.r2),
        "importance": R.feature_importance(model, feats, n_train),
    }
    if model_path:
        R.save_model(model, feats, {k: metrics[k] for k in ("rmse", "r2", "mae")}, model_path)
    return out


__all__ = ["F", "materialise", "processed", "processed_districts", "run_all", "training_run"]


def run_all(spark: SparkSession, sf_dir: str, out_root: str | None = None, scale: Scale = SCALE) -> dict:
    """The whole batch flow, every result written under ``out_root`` (default:
    a fresh folder in the shared folder):

    raw stage -> imputation (median, when anything is missing) -> sequential
    IQR outliers -> interim stage -> features -> processed stage -> tables
    ``housing`` and ``district_summary`` -> statistics tables -> split, fit,
    evaluate, save the model -> importance and residual diagnostics.

    Later steps read the written processed table (one scan each) instead of
    re-running the cleaning plan. Returns paths, counts and metrics.
    """
    from hearth.operators import eda
    from hearth.operators import relational as rel
    from hearth.session import scratch_path
    from hearth.sources import sinks

    root = (out_root or scratch_path(spark, "runs")).rstrip("/")
    out: dict = {"root": root}
    raw = districts(spark, sf_dir)
    out["raw"] = sinks.save_stage(spark, raw, "raw", root=f"{root}/data")
    raw = spark.read.parquet(out["raw"])
    rows, counts = Q.missing_counts(raw)
    missing = [c for c in raw.columns if counts[c] > 0]
    cleaned = Q.impute(raw, config.IMPUTE_STRATEGY, columns=missing, scale=scale, max_rows=rows) if missing else raw
    kept = Q.remove_outliers(cleaned, config.OUTLIER_METHOD, config.OUTLIER_THRESHOLD, scale=scale)
    out["interim"] = sinks.save_stage(spark, kept, "interim", root=f"{root}/data")
    interim = spark.read.parquet(out["interim"])
    out["processed"] = sinks.save_stage(spark, FE.all_features(interim, scale=scale), "processed", root=f"{root}/data")
    table = spark.read.parquet(out["processed"])

    out["housing"] = sinks.replace_table(spark, table, "housing", path=f"{root}/tables/housing")
    out["district_summary"] = sinks.replace_table(spark, rel.district_summary(table), "district_summary", path=f"{root}/tables/district_summary")

    stats = {
        "summary_statistics": lambda: eda.summary_statistics(table, scale=scale),
        "correlation_matrix": lambda: eda.correlation_matrix(table),
        "target_correlation": lambda: eda.target_correlation(table),
        "histogram": lambda: eda.histogram(table, config.TARGET, 50),
        "box_stats": lambda: eda.box_stats(table, "income_category", config.TARGET, scale=scale),
        "scatter_grid": lambda: eda.scatter_grid(table, "longitude", "latitude"),
        "pair_grid": lambda: eda.pair_grid(table),
        "grouped_mean": lambda: eda.grouped_aggregate(table, "income_category", config.TARGET, "mean", scale),
        "violin_data": lambda: eda.violin_data(table),
        "trend_by_age": lambda: eda.trend(table, "housing_median_age", config.TARGET, "mean", scale),
        "density": lambda: eda.density(table),
        "geo_grid": lambda: eda.geo_grid(table),
    }
    out["statistics"] = {}
    for name, make in stats.items():
        path = f"{root}/statistics/{name}"
        make().write.mode("overwrite").parquet(path)
        out["statistics"][name] = path

    run = training_run(spark, table, model_path=f"{root}/model")
    out["metrics"] = {k: run["metrics"][k] for k in ("rmse", "mae", "r2", "n")}
    out["train_r2"] = run["train_r2"]
    run["importance"].write.mode("overwrite").parquet(f"{root}/model_report/feature_importance")
    prepared, feats = R.prepare_features(table)
    _, test = R.train_test_split(prepared)
    pred = R.predictions(run["model"], test)
    R.residual_histogram(pred).write.mode("overwrite").parquet(f"{root}/model_report/residual_histogram")
    R.residual_grid(pred).write.mode("overwrite").parquet(f"{root}/model_report/residual_grid")
    out["model"] = f"{root}/model"
    return out


def main(argv: list[str] | None = None) -> None:
    import argparse
    import json

    from hearth.session import local_session

    ap = argparse.ArgumentParser(description="Run the whole batch flow on a folder of base tables.")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None, help="output root (default: a new folder under spark.checkpoint.dir)")
    ap.add_argument("--cpus", default="*")
    args = ap.parse_args(argv)
    spark = local_session(args.cpus)
    spark.sparkContext.setLogLevel("ERROR")
    res = run_all(spark, args.sf_dir, args.out)
    print(json.dumps({k: v for k, v in res.items() if k not in ("housing", "district_summary")} | {"tables": ["housing", "district_summary"]}, default=str))


if __name__ == "__main__":
    main()
