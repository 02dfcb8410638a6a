"""Rule checks, ordered decisions and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_rules(df: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """(key, rule) for each broken rule; a rule is broken where its condition is true. One scan for all rules."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules]), lambda x: x.isNotNull())
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def first_success(df: DataFrame, key: str, order: str, value: str, ok: Column) -> DataFrame:
    """The value of each key's first successful attempt in order; null if none succeeds."""
    return df.groupBy(key).agg(F.min_by(F.when(ok, F.col(value)), F.when(ok, F.col(order))).alias("selected"))


def duplicated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The rows, or an error when a key occurs twice."""
    found = duplicated(df, key).limit(1).collect()
    if found:
        raise ValueError(f"{key} {found[0][0]!r} occurs more than once")
    return df


def decide(*cases: tuple[Column, str], default: str) -> Column:
    """The first case that holds."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default)


def drawing_status(*counts: Column) -> Column:
    """'unresolved' where any of the counts (notifications, issues, unsupported types, uneven scales) is over zero."""
    some = None
    for c in counts:
        some = (c > 0) if some is None else some | (c > 0)
    return F.when(some, "unresolved").otherwise("complete")


def leaves(df: DataFrame, parents: DataFrame, parent: str, alike: str, area: str, least: int = 2, share: float = 0.05) -> DataFrame:
    """(parent, alike, leaves): groups of at least so many alike rows of one parent, of at most a share of parent_area each."""
    small = df.join(parents, parent).where(F.col(area) <= F.lit(share) * F.col("parent_area"))
    return small.groupBy(parent, alike).agg(F.count("*").alias("leaves")).where(F.col("leaves") >= least)
