"""Sinks and the catalog: stage files, replaced tables, contracts, counts.

All paths live under the shared folder (``spark.checkpoint.dir``) unless a
path is given; nothing is written to a machine-local folder on a cluster.
A table is never overwritten in place while it is read: replacement writes a
new location first.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth import config
from hearth.operators import relational
from hearth.session import path_exists, scratch_path, shared_dir

STAGES = ("raw", "interim", "processed")


def save_stage(spark: SparkSession, df: DataFrame, stage: str, root: str | None = None, fmt: str = "parquet") -> str:
    """Write ``df`` as a new timestamped snapshot of ``stage`` and make it the current one.

    ``fmt`` is ``parquet`` or ``csv`` (with a header). Snapshots are never
    overwritten; the stage's pointer moves to the new one in a single rename after
    it is complete, so readers of ``stage_path`` always find whole data. Returns
    the snapshot's path.
    """
    if stage not in STAGES:
        raise ValueError(f"Invalid stage: {stage}. Use one of {list(STAGES)}")
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"Unsupported format: {fmt}")
    root = (root or f"{shared_dir(spark)}/stages").rstrip("/")
    ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    snap = f"{root}/snapshots/{stage}/ts={ts}"
    if fmt == "csv":
        df.write.option("header", True).csv(snap)
    else:
        df.write.parquet(snap)
    _point(spark, f"{root}/{stage}.current", snap)
    return snap


def stage_path(spark: SparkSession, stage: str, root: str | None = None) -> str:
    """The current snapshot of ``stage``."""
    pointer = f"{(root or f'{shared_dir(spark)}/stages').rstrip('/')}/{stage}.current"
    if not path_exists(spark, pointer):
        raise FileNotFoundError(f"nothing was saved as stage {stage}")
    return spark.read.text(pointer, wholetext=True).first()[0]


def _point(spark: SparkSession, pointer: str, target: str) -> None:
    """Let the one-line file ``pointer`` name ``target``, replacing what it named by an atomic rename."""
    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(pointer)
    beside = jvm.org.apache.hadoop.fs.Path(f"{pointer}.{uuid.uuid4().hex[:8]}")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    files = final.getFileSystem(conf)
    out = files.create(beside)
    out.write(bytearray(target.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf).rename(beside, final, options)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_count(spark: SparkSession, name: str) -> int:
    """COUNT(*) of a table; 0 when it does not exist."""
    if not table_exists(spark, name):
        return 0
    return spark.table(name).count()


def create_if_absent(spark: SparkSession, name: str, schema: StructType | str) -> bool:
    """An empty table ``name`` with the given column types, unless it exists; True if it was made."""
    if table_exists(spark, name):
        return False
    empty = spark.createDataFrame([], schema)
    location = scratch_path(spark, "tables", name)
    empty.write.parquet(location)
    spark.catalog.createTable(name, path=location, source="parquet", schema=empty.schema)
    return True


def replace_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None, allow_empty: bool = False) -> dict:
    """Replace table ``name`` with ``df``; empty input is refused unless ``allow_empty``.

    The data goes to a location of its own (under ``path``, or the shared
    folder), is counted during the write by an Observation, and only then does
    the table's location move to it: an existing table is never without data,
    and a refused or failed write leaves it as it was. With other columns, the new
    table is complete under a name of its own before the names change. Returns
    rows_written and delta = rows after - rows before.
    """
    if df is None:
        raise ValueError("there is no table to write")
    before = table_count(spark, name)
    obs = Observation(f"write_{name}")
    location = "/".join([path.rstrip("/"), uuid.uuid4().hex[:12]]) if path else scratch_path(spark, "tables", name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(location)
    written = int(obs.get["rows"])
    if written == 0 and not allow_empty:
        raise ValueError(f"{name} is not replaced: the new table has no rows")
    if any(t.name == name and t.isTemporary for t in spark.catalog.listTables()):
        spark.catalog.dropTempView(name)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=location, source="parquet")
    elif spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        _change_columns(spark, name, location)
    return {"table": name, "location": location, "rows_written": written, "delta": written - before}


def _change_columns(spark: SparkSession, name: str, location: str) -> None:
    """Put a table of other columns in the place of ``name``: two renames, undone if the second fails."""
    tag = uuid.uuid4().hex[:8]
    new, old = f"{name}_new_{tag}", f"{name}_old_{tag}"
    spark.catalog.createTable(new, path=location, source="parquet")
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")


def update_table(spark: SparkSession, name: str, changes: DataFrame, column: str, key: str = config.KEY) -> dict:
    """Commit ``changes`` (key, new_value) to ``column`` of table ``name``: written to a new location, then moved there.

    Readers see the old rows until the location moves and all new ones after.
    ``matched`` counts the change keys that found a row; without any, nothing is written.
    """
    return _commit(spark, name, changes, key, lambda t: relational.update_rows(t, changes, column, key))


def delete_from_table(spark: SparkSession, name: str, keys: DataFrame, key: str = config.KEY) -> dict:
    """Commit the removal of the rows with these keys, as ``update_table`` does; a table may become empty."""
    return _commit(spark, name, keys, key, lambda t: relational.delete_rows(t, keys, key), empty=True)


def _commit(spark: SparkSession, name: str, keys: DataFrame, key: str, change, empty: bool = False) -> dict:
    table = spark.table(name)
    matched = relational.matched_keys(table, keys, key)
    if not matched:
        return {"table": name, "matched": 0, "rows_written": table_count(spark, name), "delta": 0}
    return replace_table(spark, change(table), name, allow_empty=empty) | {"matched": matched}


def fetch_all(spark: SparkSession, name: str) -> DataFrame:
    """SELECT * of a table or view."""
    return spark.table(name)


def table_statistics(spark: SparkSession, names: Sequence[str] | None = None) -> DataFrame:
    """(table, rows) for the given tables (default: all of the current database).

    Each count is its own small job; on Parquet it reads no column, only the files' footers.
    """
    names = list(names) if names is not None else sorted(t.name for t in spark.catalog.listTables())
    rows = [(n, table_count(spark, n)) for n in names]
    return spark.createDataFrame(rows, "table string, rows bigint")


def contract_violations(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """(constraint, column, violations) for NOT NULL and UNIQUE contracts.

    NOT NULL: rows with a NULL in the column (one aggregate for all columns).
    UNIQUE: number of key values held by more than one row (a distributed
    count per key, map-side combined).
    """
    spark = df.sparkSession
    parts = []
    if not_null:
        parts.append(
            df.agg(
                F.array(
                    *[
                        F.struct(F.lit("not_null").alias("constraint"), F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("violations"))
                        for c in not_null
                    ]
                ).alias("a")
            ).select(F.inline("a"))
        )
    for c in unique:
        dup = df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("violations"))
        parts.append(dup.select(F.lit("unique").alias("constraint"), F.lit(c).alias("column"), "violations"))
    if not parts:
        return spark.createDataFrame([], "constraint string, column string, violations bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
