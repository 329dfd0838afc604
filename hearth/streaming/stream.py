"""The stateless district operators on Structured Streaming.

Income/age categories, the location and income filters, and the scoring
input rules are row-wise, so they apply unchanged to ``readStream``; no
state, watermark or window is involved. The sink is a file sink with its
checkpoint in the shared folder (exactly-once across restarts and executor
loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearth import config
from hearth.config import SCALE, Scale
from hearth.operators import features as FE
from hearth.operators import relational as rel
from hearth.operators import scoring as SC
from hearth.session import materialise

DISTRICT_SCHEMA = T.StructType(
    [T.StructField(config.KEY, T.LongType())] + [T.StructField(c, T.DoubleType()) for c in config.RAW_COLUMNS]
)


def district_stream(spark: SparkSession, path: str, schema: T.StructType = DISTRICT_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving under ``path`` as a stream of district rows."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def classify(df: DataFrame) -> DataFrame:
    """Categories and the first violated input rule per row (works on streams and tables)."""
    return SC.input_violations(FE.age_category(FE.income_category(df)))


def score_stream(df: DataFrame, model, fitted_medians: dict) -> DataFrame:
    """Score a stream of district rows with a fitted pipeline.

    The rule of ``score_batch``: every row is scored, the broken input rule is only
    reported, and a row that lacks a model input has no prediction. Derived inputs
    use the *fitted* ratio medians. Stateless: every micro-batch is scored
    independently.
    """
    return SC.score_rows(model, df, fill=fitted_medians)


def score_micro_batches(df: DataFrame, model, sink_path: str, checkpoint_path: str, scale: Scale = SCALE) -> StreamingQuery:
    """Score everything available now, each micro-batch with its *own* ratio medians, as ``score_batch`` does a table.

    A batch is written to ``sink_path/batch=<id>``, replacing what an interrupted
    attempt at the same batch left there, so a restart neither loses nor repeats rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = materialise(batch.sparkSession, batch, "micro-batch")  # medians and scores read it again
        if kept.isEmpty():
            return
        SC.score_batch(model, kept, scale=scale).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")

    q = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def in_box(df: DataFrame, min_lat: float, max_lat: float, min_lon: float, max_lon: float) -> DataFrame:
    return rel.filter_by_location(df, min_lat, max_lat, min_lon, max_lon)


def in_income_range(df: DataFrame, lo: float, hi: float) -> DataFrame:
    return rel.filter_by_income(df, lo, hi)


def run_available(df: DataFrame, sink_path: str, checkpoint_path: str, fmt: str = "parquet") -> StreamingQuery:
    """Process everything available now (in as many micro-batches as the
    source allows), then stop; restartable from ``checkpoint_path``."""
    q = (
        df.writeStream.format(fmt)
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q
