"""Line dedup by site-relative frequency, with DataFrame functions only.

A line is boilerplate on a host when more than `ratio` of the host's pages, and at least
min_pages of them, hold it; a host of fewer pages, but two at least, loses the lines that
all of them hold. Such lines are dropped from all pages of that host.

Defined cases: a null text stays null and counts as a page without lines; blank lines
are never boilerplate; null hosts form one host; a page counts a repeated line once, and
repeated rows count as pages of their own; a line held by just `ratio` of the pages stays;
a very long text is handled whole, row by row in the JVM; an empty table gives no rows;
other columns pass through unchanged, but that counts of the same names give way to those
that are asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

_OWN = "__line_dedup_"  # and as many _ behind it as tell its columns from those of the rows


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """(host, lines): for each host that has any, the xxhash64 values of its boilerplate lines.

    A host's list holds at most (its mean number of lines a page) / ratio values. Counts are
    combined before the shuffle, so that a host with a third of all pages sends each task's
    distinct lines once, and the key holds the line, so that its lines spread over tasks.
    """
    rows = docs.select(docs[host].alias("host"), docs[text].alias("text"))
    pages = rows.groupBy("host").agg(F.count("*").alias("pages"))
    lines = rows.select("host", F.explode(F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))).alias("line"))
    held = lines.groupBy("host", "line").agg(F.count("*").alias("held")).where(F.col("held") >= min(2, min_pages))
    enough = (F.col("held") > F.col("pages") * F.lit(ratio)) & (F.col("held") >= F.least(F.lit(min_pages), F.greatest(F.col("pages"), F.lit(2))))
    common = held.join(pages, held["host"].eqNullSafe(pages["host"])).where(enough)
    return common.groupBy(held["host"]).agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.05, min_pages: int = 5, counts: bool = False, broadcast_values: int = 1_000_000) -> DataFrame:
    """The rows with boilerplate lines dropped from text; counts adds n_lines and n_dropped.

    The boilerplate lists are broadcast only if they hold at most broadcast_values values.
    """
    own = _OWN + "_" * max(map(len, docs.columns))
    common = blocks.cut(boilerplate(docs, host, text, ratio, min_pages)).toDF(own + "host", own + "lines")
    size = common.agg(F.sum(F.size(own + "lines") + F.coalesce(F.octet_length(own + "host"), F.lit(0)))).first()[0] or 0
    if size <= broadcast_values:  # else the rows are shuffled by host, and Spark splits a hot one
        common = F.broadcast(common)
    joined = docs.join(common, docs[host].eqNullSafe(common[own + "host"]), "left")
    lines = F.split(docs[text], "\n")
    kept = F.when(common[own + "lines"].isNull(), docs[text]).otherwise(F.array_join(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(common[own + "lines"], F.xxhash64(x)), F.lit(False))), "\n"))
    columns = [kept.alias(c) if c == text else docs[c] for c in docs.columns if not (counts and c in ("n_lines", "n_dropped"))]
    if counts:
        n = F.when(docs[text].isNull(), 0).otherwise(F.size(lines))
        left = F.when(docs[text].isNull(), 0).otherwise(F.size(F.filter(lines, lambda x: ~F.coalesce(F.array_contains(common[own + "lines"], F.xxhash64(x)), F.lit(False)))))
        columns += [n.cast("long").alias("n_lines"), (n - left).cast("long").alias("n_dropped")]
    return joined.select(*columns)
