"""Scans over a total order that no task holds whole.

Rows are range-partitioned and sorted, so each task sees one slice of the order as a
stream of batches. What crosses from slice to slice is one row a slice; there are as many
slices as the session's shuffle partitions, however many rows there are, so only those few
numbers meet in one place and travel to all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import blocks


def slices(rows: DataFrame, *order: Column | str) -> DataFrame:
    """The rows dealt to slices of the order and sorted in them; rows equal in all of `order` share a slice."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)


def before(totals: DataFrame, *names: str) -> DataFrame:
    """(slice, names): the sums of all earlier slices, from one row a slice."""
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("slice", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in names])


def _with(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    for name, values in columns.items():
        batch = batch.append_column(name, values)
    return batch


def _schema(rows: DataFrame, more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + [more])


def running(rows: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """rows with new columns: for each name in sums the sum of that long column up to and with the row. Null counts as 0."""

    def add(batches):
        so_far = dict.fromkeys(sums, 0)
        for batch in batches:
            new = {}
            for name, of in sums.items():
                values = pc.fill_null(batch.column(batch.schema.get_field_index(of)), 0).to_numpy(zero_copy_only=False)
                new[name] = np.cumsum(values) + so_far[name]
                so_far[name] = int(new[name][-1]) if len(values) else so_far[name]
            yield _with(batch, **{k: pa.array(v, pa.int64()) for k, v in new.items()})

    local = slices(rows, *order).mapInArrow(add, _schema(rows, ", ".join(f"`{n}` long" for n in sums)))
    local = blocks.cut(local.withColumn("slice", F.spark_partition_id()))
    totals = local.groupBy("slice").agg(*[F.sum(of).alias(f"before_{n}") for n, of in sums.items()])
    placed = local.join(F.broadcast(before(totals, *[f"before_{n}" for n in sums])), "slice")
    return placed.select(*[F.col(c) for c in rows.columns], *[(F.col(n) + F.col(f"before_{n}")).alias(n) for n in sums])


def previous(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """rows with `earlier`: the long value of the row before it in the same group by `order`, null where there is none or it is null."""

    def add(batches):
        last_group = last_value = None
        for batch in batches:
            if not batch.num_rows:
                continue
            g, v = (batch.column(batch.schema.get_field_index(c)) for c in (group, value))
            above = pa.concat_arrays([pa.array([last_group], g.type), g.slice(0, len(g) - 1)])
            values = pa.concat_arrays([pa.array([last_value], v.type), v.slice(0, len(v) - 1)])
            last_group, last_value = g[-1].as_py(), v[-1].as_py()
            same = pc.fill_null(pc.equal(g, above), False)
            yield _with(batch, earlier=pc.if_else(same, values, pa.scalar(None, v.type)), opens=pc.invert(same))

    kind = rows.schema[value].dataType.simpleString()
    local = slices(rows, group, order).mapInArrow(add, _schema(rows, f"earlier {kind}, opens boolean"))
    local = blocks.cut(local.withColumn("slice", F.spark_partition_id()))
    ends = local.groupBy("slice").agg(F.max_by(F.struct(F.col(group).alias("g"), F.col(value).alias("v")), F.struct(group, order)).alias("end"))
    carried = ends.select("slice", F.lag("end").over(Window.orderBy("slice")).alias("end"))
    found = F.when(F.col("opens") & (F.col("end.g") == F.col(group)), F.col("end.v")).otherwise(F.col("earlier"))
    return local.join(F.broadcast(carried), "slice").select(*[F.col(c) for c in rows.columns], found.alias("earlier"))
