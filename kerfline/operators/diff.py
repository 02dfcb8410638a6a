"""Comparing two exports of the same data: as bags and by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import quantize_as


def signature(df: DataFrame, columns: list[str], tolerance: float) -> list[Column]:
    """The columns, missing ones as null, with all numbers in them in multiples of the tolerance; integers stay exact."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    exact = lambda k: isinstance(k, T.IntegralType) or not isinstance(k, (T.NumericType, T.ArrayType, T.StructType, T.MapType))
    return [(F.lit(None) if c not in kinds else F.col(c) if exact(kinds[c]) else quantize_as(F.col(c), kinds[c], tolerance)).alias(c) for c in columns]


def bag_diff(left: DataFrame, right: DataFrame, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """One row: rows of either side, matched rows (sum of the lesser counts) and those of one side only."""
    sides = left.select(*signature(left, columns, tolerance), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*signature(right, columns, tolerance), F.lit(0).alias("l"), F.lit(1).alias("r")))
    # one aggregate over both sides: nulls meet, no join, and counts are combined before the shuffle
    bags = sides.groupBy(*columns).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return bags.agg(total(F.col("l")).alias("left_count"), total(F.col("r")).alias("right_count"), total(F.least("l", "r")).alias("matched"), total(F.greatest(F.col("l") - F.col("r"), F.lit(0))).alias("left_only"), total(F.greatest(F.col("r") - F.col("l"), F.lit(0))).alias("right_only"))


def bag_diff_by(left: DataFrame, right: DataFrame, group: str, columns: list[str], tolerance: float = 1e-6) -> DataFrame:
    """bag_diff for each value of a column, as rows of one table."""

    def side(df: DataFrame, l: int) -> DataFrame:
        return df.select(group, *signature(df, columns, tolerance), F.lit(l).alias("l"), F.lit(1 - l).alias("r"))

    bags = side(left, 1).unionByName(side(right, 0)).groupBy(group, *columns).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    more = lambda a, b: F.sum(F.greatest(F.col(a) - F.col(b), F.lit(0)))
    return bags.groupBy(group).agg(F.sum("l").alias("left_count"), F.sum("r").alias("right_count"), F.sum(F.least("l", "r")).alias("matched"), more("l", "r").alias("left_only"), more("r", "l").alias("right_only"))


def key_sets(left: DataFrame, key: str, right: DataFrame, of: str) -> DataFrame:
    """(side, n): how many different keys both sides have, or one of them; one aggregate over both."""
    rows = left.select(F.col(key).alias("k"), F.lit(1).alias("s")).union(right.select(F.col(of), F.lit(2)))
    sides = rows.groupBy("k").agg(F.bit_or("s").alias("s"))
    counts = sides.agg(*[F.count_if(F.col("s") == i).alias(name) for i, name in ((3, "both"), (1, "left"), (2, "right"))])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("side"), F.col(name).alias("n")) for name in ("both", "left", "right")])).alias("x")).select("x.*")


def key_text(key: Column) -> Column:
    """Keys are compared as texts; null is the text 'None'."""
    return F.coalesce(key.cast("string"), F.lit("None"))


def last_of(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key by the given columns; of a key that is null and one that reads 'None' there is one row."""
    place = F.row_number().over(Window.partitionBy("key_").orderBy(*[F.desc(c) for c in order]))
    rows = df.withColumn("key_", key_text(F.col(key))).withColumn("place_", place).where("place_ = 1")
    return rows.withColumn(key, F.col("key_")).drop("key_", "place_")


def _sides(left: DataFrame, right: DataFrame, key: str, columns: list[str], tolerance: float, order: list[str] | None) -> DataFrame:
    """(key, l, r, n_l, n_r): the last record of either side under each key, and how many there were.

    One aggregate over both sides: counts and last records are combined before the one shuffle.
    """

    def side(df: DataFrame, mine: str) -> DataFrame:
        by = F.struct(*(order or [c for c in columns if c in df.columns]))
        record = F.struct(*signature(df, columns, tolerance))
        return df.select(key_text(F.col(key)).alias("key"), F.lit(mine).alias("side"), by.alias("by"), record.alias("record"))

    rows = side(left, "l").unionByName(side(right, "r"))
    last = [F.max_by(F.when(F.col("side") == s, F.col("record")), F.when(F.col("side") == s, F.col("by"))).alias(s) for s in "lr"]
    return rows.groupBy("key").agg(*last, F.count_if(F.col("side") == "l").alias("n_l"), F.count_if(F.col("side") == "r").alias("n_r"))


def matched_keys(left: DataFrame, right: DataFrame, key: str, columns: list[str], tolerance: float = 1e-6, order: list[str] | None = None) -> DataFrame:
    """(key, side, fields, n_l, n_r): side is both, left or right, fields names what differs, n_l and n_r count the key's rows.

    Of several rows under one key the last by `order` (by the compared columns where none is given) stands for it.
    """
    joined = _sides(left, right, key, columns, tolerance, order)
    fields = F.concat_ws(",", *[F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in columns])
    side = F.when(F.col("n_l") == 0, "right").when(F.col("n_r") == 0, "left").otherwise("both")
    return joined.select("key", side.alias("side"), F.when(side == "both", fields).otherwise("").alias("fields"), "n_l", "n_r")


def keyed_diff(left: DataFrame, right: DataFrame, key: str, columns: list[str], tolerance: float = 1e-6, order: list[str] | None = None) -> DataFrame:
    """One row: rows of either side, keys of one side only, matched and mismatched keys, and whether all agree and no key occurs twice on a side."""
    rows = matched_keys(left, right, key, columns, tolerance, order)
    n = lambda c: F.count_if(c)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    both = F.col("side") == "both"
    counts = rows.agg(total("n_l").alias("left_count"), total("n_r").alias("right_count"), n(F.col("side") == "left").alias("left_only"), n(F.col("side") == "right").alias("right_only"), n(both).alias("common"), n(both & (F.col("fields") == "")).alias("matched"), n(both & (F.col("fields") != "")).alias("mismatched"), n((F.col("n_l") > 1) | (F.col("n_r") > 1)).alias("repeated_keys"))
    return counts.withColumn("consistent", F.expr("left_only + right_only + mismatched + repeated_keys = 0"))


def examples(left: DataFrame, right: DataFrame, key: str, columns: list[str], tolerance: float = 1e-6, limit: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first differing keys in text order, with the fields that differ."""
    rows = matched_keys(left, right, key, columns, tolerance, order)
    return rows.where((F.col("side") == "both") & (F.col("fields") != "")).select("key", "fields").orderBy("key").limit(limit)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def common_columns(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    """The union of both sides' columns without the key, in order."""
    return sorted((set(left.columns) | set(right.columns)) - {key})


def signature_counts(df: DataFrame, signature_: Column) -> DataFrame:
    """(signature, n); rows whose signature is null are left out."""
    return df.select(signature_.alias("signature")).where("signature IS NOT NULL").groupBy("signature").agg(F.count("*").alias("n"))
