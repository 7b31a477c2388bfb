"""Jobs on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# A key is hot when it holds more than one in HOT_SHARE rows; so there are fewer than HOT_SHARE
# hot keys, whatever the size of the table.
HOT_SHARE = 1000


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join (inner or left_semi) of a table with hot keys with one that holds a key at most
    once.

    Rows of hot keys meet the fewer than HOT_SHARE matching rows of the right side by broadcast
    and are never shuffled by key; all others take a plain join. The left side is read several
    times, so it should be a stored table or a cheap projection of one.
    """
    total = left.agg(F.count("*")).scalar()
    hot = F.broadcast(
        left.groupBy(key).agg(F.count("*").alias("_n"))
        .filter(F.col(key).isNotNull() & (F.col("_n") * HOT_SHARE > total))
        .select(key))
    hot_right = F.broadcast(right.join(hot, key, "left_semi"))
    return (
        left.join(hot, key, "left_anti").join(right, key, how)
        .unionByName(left.join(hot_right, key, how))
    )


def exact_rank(df: DataFrame, keys: list[str], order: list[str], name: str,
               start: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """Add the place of each row within its key, from 1, exact for every row. ``order`` must tell the
    rows of a key apart. ``start`` (the keys, ``before``) holds places that came earlier.

    Rows are cut into ranges of the first order column that hold about as many rows each. The ranges
    of a key are counted (at most ``buckets`` numbers per key) and their counts added up; a row's
    place is its place within key and range, which is all that one task sees, and what came before.
    """
    value = F.col(order[0]).cast("double")
    steps = [n / buckets for n in range(1, buckets)]
    bounds = df.agg(F.percentile_approx(value, steps)).scalar()
    cut = df.withColumn("_bounds", F.coalesce(bounds, F.array().cast("array<double>"))).withColumn(
        "_bucket", F.size(F.filter("_bounds", lambda b: b < value))).drop("_bounds")
    counts = cut.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    if start is not None:
        earlier = start.select(*[F.col(k).alias(f"_start_{k}") for k in keys], F.col("before").alias("_start"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_start_{k}")) for k in keys])
        before = before.join(earlier, same, "left").select(
            *keys, "_bucket", (F.col("_before") + F.coalesce("_start", F.lit(0))).alias("_before"))
    named = before.withColumnsRenamed({k: f"_key_{k}" for k in keys} | {"_bucket": "_range"})
    meet = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys],
                  F.col("_bucket") == F.col("_range"))
    place = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return cut.join(named, meet).withColumn(name, (place + F.col("_before")).cast("bigint")).select(
        *df.columns, name)


def capped_rank(df: DataFrame, keys: list[str], order: list[str], limit: int,
                name: str, salts: int | None = None) -> DataFrame:
    """Add the place of each row within its key, exact up to ``limit`` and limit + 1 for all rows
    behind. ``order`` must tell the rows of a key apart. All rows are kept.

    A row that is behind ``limit`` others of its salt is so within its key too. So rows are first
    ranked per (key, salt), and only the leading rows of each salt, at most limit * salts per key,
    come together for the final rank; the others stay apart by salt.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    local = salted.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
    lead: Column = F.col("_local") <= limit
    spread = local.withColumn("_salt", F.when(lead, F.lit(-1)).otherwise(F.col("_salt")))
    place = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    return spread.withColumn("_within", place).withColumn(
        name, F.when(F.col("_salt") == -1, F.least("_within", F.lit(limit + 1)))
        .otherwise(F.lit(limit + 1)).cast("bigint")
    ).drop("_salt", "_local", "_within")
