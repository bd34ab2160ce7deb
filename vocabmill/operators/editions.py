"""Dated editions of versioned rows, and what differs between two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(versions: DataFrame, key: list[str], time: str, tie: list[str] = ()) -> DataFrame:
    """The last version of each key; ``tie`` columns settle equal times, so that the result is fixed."""
    last = Window.partitionBy(*key).orderBy(F.desc(time), *[F.desc(c) for c in tie])
    return versions.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")


def cut(versions: DataFrame, key: list[str], time: str, until: Column, tie: list[str] = ()) -> DataFrame:
    """The edition as of ``until``, which may differ by row (as by module): the last version not after it."""
    return latest(versions.where(F.col(time) <= until), key, time, tie)


def difference(old: DataFrame, new: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, change (added, removed, changed), before, after."""
    a, b = old.select(*key, F.col(value).alias("before"), F.lit(1).alias("_a")), new.select(*key, F.col(value).alias("after"), F.lit(1).alias("_b"))
    both = a.join(b, key, "full")
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    return both.withColumn("change", change).where("change is not null").select(*key, "change", "before", "after")


def first_route(routes: list[DataFrame], key: list[str], tie: list[str]) -> DataFrame:
    """Rows of the first route that answers a key; ``method`` columns are kept."""
    every = None
    for k, r in enumerate(routes):
        r = r.withColumn("_route", F.lit(k))
        every = r if every is None else every.unionByName(r)
    best = Window.partitionBy(*key).orderBy("_route", *tie)
    return every.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k", "_route")


def stratified(rows: DataFrame, strata: list[str], key: list[str], n: int, seed: str) -> DataFrame:
    """``n`` rows of each stratum, in the order of a seeded hash of the key (a sampling operator)."""
    order = Window.partitionBy(*strata).orderBy(F.md5(F.concat_ws("|", F.lit(seed), *key)), *key)
    return rows.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).drop("_k")
