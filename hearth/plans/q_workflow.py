"""Registered queries: compositions of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth import config
from hearth.plans import sqltext as S
from hearth.plans.q_model import scored_sql, violation_sql
from hearth.plans.q_quality import DISTRICT_COLS, RAW8, iqr_chain
from hearth.plans.registry import register
from hearth.plans.workflow import processed_districts


def _processed_sql() -> str:
    fill = f"(SELECT {S.midpoint('xs')} FROM (SELECT {S.sorted_list('total_bedrooms')} AS xs FROM districts))"
    imp = ", ".join(c if c != "total_bedrooms" else f"COALESCE(total_bedrooms, {fill}) AS total_bedrooms" for c in DISTRICT_COLS)
    chain, last, _ = iqr_chain("imputed", RAW8, config.OUTLIER_THRESHOLD, prefix="p")
    return (
        f"WITH districts AS ({S.DISTRICTS_SQL}),\nimputed AS (SELECT {imp} FROM districts),\n{chain},\n"
        + S.features_ctes(last, "processed", "g")
        + "\nSELECT * FROM processed"
    )


@register("processed_districts", _processed_sql())
def q_processed_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """districts -> median imputation -> sequential IQR (8 columns) -> features."""
    return processed_districts(spark, sf_dir)


@register(
    "stream_classify",
    S.on_districts(
        f"SELECT *, {S.INCOME_CASE} AS income_category, {S.AGE_CASE} AS age_category, "
        f"{violation_sql()} AS violation FROM districts"
    ),
)
def q_stream_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts land as parquet files; a stream classifies them micro-batch by
    micro-batch (one file per trigger) into a file sink, which is read back."""
    from pyspark.sql import functions as F

    from hearth.session import scratch_path
    from hearth.sources.fixtures import districts
    from hearth.streaming import classify, district_stream, run_available

    landing = scratch_path(spark, "stream", "landing")
    districts(spark, sf_dir).repartition(4, F.col("district_id")).write.parquet(landing)
    sink, ckpt = scratch_path(spark, "stream", "sink"), scratch_path(spark, "stream", "checkpoint")
    run_available(classify(district_stream(spark, landing, max_files_per_trigger=1)), sink, ckpt)
    return spark.read.parquet(sink)


@register("stream_score", scored_sql())
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 11-feature pipeline fitted on the train districts scores the
    districts as they land (one file per micro-batch); ratio inputs use the
    medians fitted on the housing table; rows that break an input rule say so."""
    from pyspark.sql import functions as F

    from hearth.operators import regression as R
    from hearth.operators.features import RATIOS
    from hearth.operators.quantiles import medians
    from hearth.plans.views import housing
    from hearth.session import scratch_path
    from hearth.sources.fixtures import districts
    from hearth.streaming import district_stream, run_available, score_stream

    h = housing(spark, sf_dir)
    prepared, feats = R.prepare_features(h)
    train, _ = R.train_test_split(prepared)
    model = R.fit_ols(train, feats)
    d = districts(spark, sf_dir)
    ratios = d.select(*[(F.col(a) / F.nullif(F.col(b), F.lit(0.0))).alias(n) for n, (a, b, _) in RATIOS.items()])
    fitted = medians(ratios, list(RATIOS))
    landing = scratch_path(spark, "stream", "landing")
    d.repartition(4, F.col("district_id")).write.parquet(landing)
    sink, ckpt = scratch_path(spark, "stream", "sink"), scratch_path(spark, "stream", "checkpoint")
    run_available(score_stream(district_stream(spark, landing, max_files_per_trigger=1), model, fitted), sink, ckpt)
    return spark.read.parquet(sink).select("district_id", F.round("prediction", 1).alias("prediction"), "violation")
