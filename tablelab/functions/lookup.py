"""Value-to-code joins that hold up against hot values and large dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelab.functions.columns import ref

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.001
SALTS = 64


def lookup_join(df: DataFrame, dictionary: DataFrame, column: str, *, size: int, total: int, octets: int = 0) -> DataFrame:
    """Add ``__code`` from ``dictionary(value, n, code)`` to every row of ``df``.

    A dictionary of at most ``BROADCAST_ROWS`` rows whose values take at most
    ``BROADCAST_BYTES`` bytes (``octets``) is broadcast. A larger one
    is joined by shuffle; values holding more than ``HOT_SHARE`` of the rows
    (so fewer than a thousand) are copied to every salt and their rows spread
    over the salts. NULL cells are spread too and get no code.
    """
    if size <= BROADCAST_ROWS and octets <= BROADCAST_BYTES:
        table = dictionary.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        return df.join(F.broadcast(table), ref(column) == F.col("__value"), "left").drop("__value")
    hot = [r["value"] for r in dictionary.where(F.col("n") > total * HOT_SHARE).select("value").collect()]
    spread = F.pmod(F.xxhash64(*[ref(c) for c in df.columns]), F.lit(SALTS)).cast("int")
    busy = ref(column).isNull() | ref(column).isin(hot) if hot else ref(column).isNull()
    salted = df.withColumn("__salt", F.when(busy, spread).otherwise(F.lit(0)))
    copies = F.when(F.col("value").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))) if hot else None
    copies = F.array(F.lit(0)) if copies is None else copies.otherwise(F.array(F.lit(0)))
    table = dictionary.select(F.col("value").alias("__value"), F.col("code").alias("__code"), F.explode(copies).alias("__dsalt"))
    match = (ref(column) == F.col("__value")) & (F.col("__salt") == F.col("__dsalt"))
    return salted.join(table, match, "left").drop("__value", "__salt", "__dsalt")
