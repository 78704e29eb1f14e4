"""Reading the driver's tables, joining on keys that may be null."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a bit map that one row brings to the driver.
_PART_BITS = 1 << 17


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which null keys are equal; the keys are those of ``left``."""
    renamed = right.select(*(F.col(c).alias(f"right_{c}") if c in keys else F.col(c) for c in right.columns))
    same = reduce(and_, (left[c].eqNullSafe(renamed[f"right_{c}"]) for c in keys))
    return left.join(renamed, same, how).drop(*(f"right_{c}" for c in keys))


def bit_map(values: DataFrame, column: str, bits: int) -> bytes:
    """Bit map of a bigint column modulo ``bits``, a power of two; no more than its size reaches the driver."""
    part = min(bits, _PART_BITS)
    marked = values.select(F.col(column).bitwiseAND(F.lit(bits - 1)).alias("bit")).distinct()

    def parts(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            places = batch.column("bit").to_numpy()
            for at in np.unique(places // part).tolist():
                here = places[places // part == at] % part
                np.bitwise_or.at(found.setdefault(at, np.zeros(part // 8, np.uint8)), here >> 3, (1 << (here & 7)).astype(np.uint8))
        columns = [pa.array(list(found), pa.int64()), pa.array([x.tobytes() for x in found.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["at", "value"])

    dealt = marked.repartition(F.floor(F.col("bit") / part))
    whole = np.zeros(bits // 8, np.uint8)
    for batch in dealt.mapInArrow(parts, "at bigint, value binary").toArrow().to_batches():
        for at, value in zip(batch.column("at").to_pylist(), batch.column("value"), strict=True):
            whole[at * part // 8 :][: part // 8] = np.frombuffer(value.as_buffer(), np.uint8)
    return whole.tobytes()


def in_bit_map(table: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Which of the unsigned 64-bit ``values`` have their bit set."""
    places = (values & np.uint64(bits - 1)).astype(np.int64)
    return (table[places >> 3] >> (places & 7).astype(np.uint8) & 1) > 0
