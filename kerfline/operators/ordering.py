"""Order-sensitive operators: the latest of a family, neighbours, positions, caps, samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def latest(df: DataFrame, family: str, order: list[str]) -> DataFrame:
    """The last row of each family by the given columns."""
    place = F.row_number().over(Window.partitionBy(family).orderBy(*[F.desc(c) for c in order]))
    return df.withColumn("place_", place).where("place_ = 1").drop("place_")


def neighbours(df: DataFrame, axis: str, value: str, tie: str) -> DataFrame:
    """Each row with the value before and the gap to it on its axis; the first has nulls."""
    on = Window.partitionBy(axis).orderBy(value, tie)
    return df.withColumn("before", F.lag(value).over(on)).withColumn("gap", F.col(value) - F.col("before"))


def off_ratio(df: DataFrame, axis: str, value: str, tie: str, ratio: float = 0.25) -> DataFrame:
    """Rows whose gap differs from the gap before by more than `ratio` of that."""
    on = Window.partitionBy(axis).orderBy(value, tie)
    rows = neighbours(df, axis, value, tie).withColumn("gap_before", F.lag("gap").over(on))
    return rows.where(F.abs(F.col("gap") - F.col("gap_before")) > F.lit(ratio) * F.col("gap_before"))


def out_of_order(df: DataFrame, key: str, ordinal: str, name: str, declared: list[str]) -> DataFrame:
    """(key, attempts, out_of_order): attempts whose place in the declared order is before that of an earlier one; undeclared names count as last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in declared]), F.col(name)), F.lit(0)), F.lit(len(declared) + 1))
    highest = F.max("place_").over(Window.partitionBy(key).orderBy(ordinal).rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("place_", place).withColumn("highest_", highest)
    return rows.groupBy(key).agg(F.count("*").alias("attempts"), F.count_if(F.col("place_") < F.col("highest_")).alias("out_of_order"))


def positions(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, place): the different values of a group in order, without regard to case, counted from 1."""
    each = df.groupBy(group, F.lower(value).alias("folded")).agg(F.min(value).alias(value))
    return each.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy("folded"))).drop("folded")


def handle_order(handle: str = "handle") -> list[Column]:
    """What hexadecimal handles are ordered by as numbers, however long they are: how many digits, and then which."""
    digits = F.ltrim(F.col(handle), F.lit("0"))
    return [F.length(digits), F.upper(digits)]


def by_handle(df: DataFrame, handle: str = "handle", then: str | None = None) -> DataFrame:
    """Rows in the order of hexadecimal handles as numbers."""
    return df.orderBy(*handle_order(handle), *([then] if then else []))


def capped(df: DataFrame, order: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """The first rows up to a limit, and one row (kept, truncated) that says whether there are more; one row too many is looked for."""
    more = df.select(*order).limit(limit + 1).agg(F.least(F.count("*"), F.lit(limit)).alias("kept"), (F.count("*") > limit).alias("truncated"))
    return df.orderBy(*order).limit(limit), more


def stratified(df: DataFrame, stratum: str, key: str, each: Column) -> DataFrame:
    """So many rows of each stratum as the column `each` says, the same ones every time: those whose key hashes least."""
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(F.sha2(F.col(key).cast("string").cast("binary"), 256)))
    return df.withColumn("place_", place).where(F.col("place_") <= each).drop("place_")


def evidence_ids(ids: Column) -> Column:
    """Trimmed, not blank, each once, in order; null for a null list."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x != "")))


def ranked(df: DataFrame, order: list, name: str = "rank", within: list[str] = ()) -> DataFrame:
    """df with its rank from 1 in that order, in each group of `within` if there are any; ties get ranks in any order.

    Rows are dealt to ranges of the order and sorted there. A row's rank is its place in its
    range and the number of rows in earlier ranges, so no task sees all rows; of the ranges
    only their sizes meet, one row each. In groups, the rank of the group's first row is
    taken off.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*within, *order]
    placed = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    placed = cut(placed.withColumns({"range_": F.spark_partition_id(), "place_": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    sizes = placed.groupBy("range_").agg(F.count("*").alias("n_"))
    before = sizes.select("range_", F.coalesce(F.sum("n_").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before_"))
    out = placed.join(F.broadcast(before), "range_").withColumn(name, F.col("before_") + F.col("place_") + 1).drop("range_", "place_", "before_")
    if within:
        firsts = out.groupBy(*[F.col(c).alias(f"{c}_of") for c in within]).agg(F.min(name).alias("first_"))
        same = reduce(lambda a, b: a & b, [out[c].eqNullSafe(firsts[f"{c}_of"]) for c in within])
        out = out.join(firsts, same).withColumn(name, F.col(name) - F.col("first_") + 1).drop("first_", *[f"{c}_of" for c in within])
    return out.select(*df.columns, name)
