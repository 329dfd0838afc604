"""Small helpers shared by the operators: Arrow text access and lineage cuts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.session import scratch_path

__all__ = ["append_columns", "likely_among", "materialise", "row_key", "text_bytes", "unit_hash"]

#: Most bits of a filter that is broadcast (16 MB).
FILTER_BITS = 1 << 27


def materialise(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of an Arrow string column without copying; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offs, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def append_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], list[pa.Array]], fields: list[T.StructField], drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns that ``fn`` computes per Arrow batch.

    An input column of the same name (in any case) is replaced; ``drop`` names
    input columns that ``fn`` reads but that are not passed on.
    """
    names = [f.name for f in fields]
    taken = {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in taken and c not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays(same + fn(batch), names=kept + names)

    return df.mapInArrow(run, schema)


def unit_hash(*cols: Column | str, seed: int = 0) -> Column:
    """A reproducible pseudo-random double in [0, 1) from the columns' values."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def row_key(id_col: str, text_col: str) -> Column:
    """A non-null key that is equal for rows with equal id and equal text only."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("\0null"))
    return F.concat_ws(
        ":", ident, F.hex(F.xxhash64(F.col(id_col), F.col(text_col))), F.hex(F.hash(F.lit(7), F.col(text_col))),
    )


def likely_among(df: DataFrame, wanted: DataFrame, key: str, most: int = FILTER_BITS) -> DataFrame:
    """Those rows of ``df`` whose ``key`` may be among the keys of ``wanted``, and all whose key is.

    A broadcast bitmap of the keys' hashes, 16 bits a key up to ``most``, keeps the others out of an
    exchange; beyond that it lets more of them pass, so a join on the key itself still has to follow.
    ``wanted`` is read twice.
    """
    bits = min(most, max(1 << 15, 1 << (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(key), F.lit(bits)) + F.lit(1)
    maps = wanted.select(place.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("__bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("__bits"))
    at = F.bitmap_bit_position("__place").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    met = df.withColumn("__place", place).join(F.broadcast(maps), F.bitmap_bucket_number("__place") == F.col("__bucket"))
    return met.where(F.getbit(byte, at % 8) == 1).select(*df.columns)
