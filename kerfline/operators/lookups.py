"""Lookups between records: dimensions with defaults, unique keys, identities, containment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rules import require_unique


def lookup(df: DataFrame, dimension: DataFrame, key: str, of: str, defaults: dict[str, object]) -> DataFrame:
    """df with columns of the dimension row whose `of` equals `key`; rows without one get the defaults.

    Whether the dimension is broadcast is left to Spark, which knows its size.
    """
    found = dimension.select(F.col(of).alias("key_"), *[F.col(c).alias(f"found_{c}") for c in defaults])
    joined = df.join(found, df[key] == found["key_"], "left")
    return joined.select(*[df[c] for c in df.columns], *[F.coalesce(F.col(f"found_{c}"), F.lit(v)).alias(c) for c, v in defaults.items()])


def unique_lookup(df: DataFrame, ledger: DataFrame, key: str, of: str, defaults: dict[str, object]) -> DataFrame:
    """As lookup, but a key that the ledger has twice is an error."""
    return lookup(df, require_unique(ledger, of), key, of, defaults)


def with_many(df: DataFrame, children: DataFrame, key: str, of: str, columns: list[str], order: str, name: str) -> DataFrame:
    """df with an array of its children's columns, in order; empty where there are none."""
    kind = ",".join(f"{c}:{children.schema[c].dataType.simpleString()}" for c in columns)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("order_"), F.struct(*columns).alias("row"))))
    lists = children.groupBy(F.col(of).alias("key_")).agg(F.transform(ordered, lambda x: x["row"]).alias("rows_"))
    joined = df.join(lists, df[key] == lists["key_"], "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce("rows_", F.array().cast(f"array<struct<{kind}>>")).alias(name))


def same_identity(left: DataFrame, right: DataFrame, keys: list[str], folded: list[str] = ()) -> Column:
    """The condition that two rows agree in all keys, trimmed texts, in those of `folded` without regard to case; null as an empty text."""

    def clean(df: DataFrame, c: str) -> Column:
        text = F.trim(F.coalesce(df[c].cast("string"), F.lit("")))
        return F.upper(text) if c in folded else text

    return reduce(lambda a, b: a & b, [clean(left, c) == clean(right, c) for c in keys])


def within(low: Column, high: Column, intervals: Column, tolerance: float = 1.0) -> Column:
    """Whether [low, high] lies in any of an array of two-element intervals, give or take the tolerance; ends in any order."""
    return F.exists(intervals, lambda i: (low >= F.array_min(i) - tolerance) & (high <= F.array_max(i) + tolerance))


def consumed(df: DataFrame, uses: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows that some use refers to."""
    return df.join(uses, reduce(lambda a, b: a & b, [df[a] == uses[b] for a, b in on]), "left_semi")


def unmatched(df: DataFrame, other: DataFrame, key: str, of: str) -> DataFrame:
    """Rows whose key the other side lacks."""
    return df.join(other, df[key] == other[of], "left_anti")


def in_windows(points: DataFrame, windows: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    """Points joined to the windows (name, min_x, max_x, min_y, max_y, ..) that hold them, borders included.

    Windows are dealt to the squares of a grid that they touch and points to the one they
    lie in, so that the join is on squares, and no pair is looked at that shares none. The
    cell should have about the size of a window.
    """
    steps = [F.sequence(F.floor(F.col(f"min_{a}") / cell), F.floor(F.col(f"max_{a}") / cell)) for a in "xy"]
    dealt = windows.withColumn("cell_x", F.explode(steps[0])).withColumn("cell_y", F.explode(steps[1]))
    placed = points.withColumn("cell_x", F.floor(F.col(x) / cell)).withColumn("cell_y", F.floor(F.col(y) / cell))
    return placed.join(dealt, ["cell_x", "cell_y"]).where(F.col(x).between(F.col("min_x"), F.col("max_x")) & F.col(y).between(F.col("min_y"), F.col("max_y"))).drop("cell_x", "cell_y")


def shown(points: DataFrame, windows: DataFrame, x: str, y: str, layer: str, cell: float) -> DataFrame:
    """Points in the windows that are on, but for layers that a window has frozen."""
    return in_windows(points, windows.where("on"), x, y, cell).where(~F.array_contains("frozen", F.col(layer)))
