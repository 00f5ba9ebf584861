"""Joining many rows to a table with one row per key.

Two sizes decide the plan, and neither is guessed:

* the lookup side is broadcast only after its bytes have been counted;
* past that limit both sides are shuffled on the key, and the keys that would
  overload one task are spread over many by a salt. The lookup row of such a
  key is repeated once per salt, every row still meets exactly its own partner.

Tables that are joined again and again can be stored by key and salt, in buckets
(``store_rows``, ``store_lookup``). Reading them joined then shuffles neither.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from tradeflow.workspace import new_folder

BROADCAST_BYTES = 64 * 1024 * 1024
# The part of the key column that is read to find keys worth salting.
SAMPLE_SHARE = 0.01


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is at most ``limit`` bytes, by counting it.

    False when a column's width cannot be bounded by counting.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    if any(isinstance(k, (ArrayType, MapType, StructType, VariantType)) for k in kinds.values()):
        return False
    # 8 bytes a field plus up to 16 for a wide decimal, and 16 a row of overhead.
    size = df.count() * (24 * len(kinds) + 16)
    texts = [n for n, k in kinds.items() if isinstance(k, (StringType, BinaryType))]
    if size > limit or not texts:
        return size <= limit
    lengths = [F.coalesce(F.sum(F.octet_length(n)), F.lit(0)) for n in texts]
    return size + df.agg(sum(lengths, F.lit(0)).alias("bytes")).first()["bytes"] <= limit


def frequent_keys(
    rows: DataFrame, key: str, partitions: int, share: float = SAMPLE_SHARE
) -> list[tuple[object, int]]:
    """Keys that hold more than an even partition's rows, and how often to split each.

    There are at most ``partitions`` of them. The sample only decides what gets
    salted: a wrong guess costs time, never a row.
    """
    sampled = rows.select(key).where(F.col(key).isNotNull()).sample(fraction=share, seed=11)
    total = sampled.count()
    most = sampled.groupBy(key).count().where(
        (F.col("count") > 1) & (F.col("count") * partitions >= total)
    )
    # Several salts per even share, so that chance does not pile them up.
    return [(r[key], math.ceil(8 * partitions * r["count"] / total)) for r in most.collect()]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    *,
    spread_by: str,
    limit: int = BROADCAST_BYTES,
    key_source: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which holds each ``key`` at most once.

    ``spread_by`` is a column that varies among rows of one key, so its hash is
    a salt that stays the same when a lost task is run again. ``key_source``
    may name a cheaper table with the same keys to look for frequent ones.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup join is left or inner, not {how}")
    if fits_broadcast(lookup, limit):
        return rows.join(F.broadcast(lookup), key, how)
    spark = rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = frequent_keys(key_source if key_source is not None else rows, key, partitions)
    hot = spark.createDataFrame(found, _salts_schema(rows, key))
    salted_rows = _salted_rows(rows, hot, key, spread_by, partitions)
    return salted_rows.join(_salted_lookup(lookup, hot, key), [key, "_salt"], how).drop("_salt")


def _salts_schema(rows: DataFrame, key: str) -> StructType:
    return StructType([StructField(key, rows.schema[key].dataType), StructField("_salts", IntegerType())])


def _salted_rows(rows: DataFrame, hot: DataFrame, key: str, spread_by: str, partitions: int) -> DataFrame:
    # Rows without a key have no partner wherever they are, but may be many.
    salts = F.when(F.col(key).isNull(), 8 * partitions).otherwise(F.coalesce("_salts", F.lit(1)))
    own_salt = F.pmod(F.xxhash64(spread_by), salts).cast("int")
    return rows.join(F.broadcast(hot), key, "left").withColumn("_salt", own_salt).drop("_salts")


def _salted_lookup(lookup: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    return lookup.join(F.broadcast(hot), key, "left").withColumn("_salt", every_salt).drop("_salts")


def _store(rows: DataFrame, key: str, table: str, buckets: int) -> None:
    spark = rows.sparkSession
    # Dealt by what the buckets are made of, each bucket is one file.
    dealt = rows.repartition(buckets, key, "_salt").sortWithinPartitions(key, "_salt")
    dealt.write.mode("overwrite").bucketBy(buckets, key, "_salt").sortBy(key, "_salt").option(
        "path", new_folder(spark, table)).saveAsTable(table)


def store_rows(rows: DataFrame, key: str, table: str, *, spread_by: str, buckets: int) -> None:
    """Store ``rows`` as a table in buckets by key; a frequent key is split over several.

    How often each is split is kept beside it, as the table ``<table>_salts``.
    """
    spark = rows.sparkSession
    hot = spark.createDataFrame(frequent_keys(rows, key, buckets), _salts_schema(rows, key))
    hot.write.mode("overwrite").option("path", new_folder(spark, f"{table}_salts")).saveAsTable(f"{table}_salts")
    _store(_salted_rows(rows, spark.table(f"{table}_salts"), key, spread_by, buckets), key, table, buckets)


def store_lookup(lookup: DataFrame, key: str, table: str, *, beside: str, buckets: int) -> None:
    """Store ``lookup``, which holds each key at most once, in the buckets of the table ``beside``."""
    _store(_salted_lookup(lookup, lookup.sparkSession.table(f"{beside}_salts"), key), key, table, buckets)


def stored_join(spark: SparkSession, rows: str, lookup: str, key: str, how: str = "left") -> DataFrame:
    """The stored ``rows``, each with its row of ``lookup``; nothing is shuffled."""
    return spark.table(rows).join(spark.table(lookup).hint("merge"), [key, "_salt"], how).drop("_salt")
