"""Every query with SQL gives the same rows as DuckDB on the small tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.operators import summaries
from kerfline.plans import catalogue

DATA = "/root/testdata/sf0.001"


def norm(rows):
    fix = lambda v: round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    key = lambda r: tuple((v is None, str(v)) for v in r)
    return sorted((tuple("nan" if isinstance(v, float) and math.isnan(v) else fix(v) for v in r) for r in rows), key=key)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in catalogue.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = got.select(*[f"`{c}`" for c in columns]).collect()
    if name not in catalogue.SQL:
        assert rows
        return
    want = duck.sql(catalogue.SQL[name])
    assert sorted(want.columns) == columns
    assert norm(rows) == norm(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_texts_are_joined_once_a_definition(spark):
    plan = catalogue.QUERIES["dynamic_inserts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" in plan and plan.index("array_join") > plan.rindex("Join LeftOuter")


def test_inserts_are_shared_out_by_what_they_give(spark):
    """Short rows that become long ones are not brought together in one task, and equal texts lie together there."""
    rows = catalogue.QUERIES["dynamic_inserts"](spark, "/root/testdata/sf0.1").selectExpr("spark_partition_id() AS task", "monotonically_increasing_id() AS place", "md5(definition_texts) AS text").collect()
    tasks = {}
    for r in sorted(rows, key=lambda r: r.place):
        tasks.setdefault(r.task, []).append(r.text)
    assert len(rows) == 1000 and len(tasks) >= 4 and max(map(len, tasks.values())) < 600
    assert all(sum(a != b for a, b in zip(t, t[1:])) + 1 == len(set(t)) for t in tasks.values())


def test_a_hot_definition_is_dealt_and_none_is_lost(spark):
    inserts = spark.range(2000).selectExpr("id", "CASE WHEN id % 100 = 0 THEN NULL WHEN id % 50 = 1 THEN 7 WHEN id % 50 = 2 THEN 8 WHEN id % 50 = 3 THEN 9 ELSE 1 END AS base")
    texts = spark.createDataFrame([(1, "long" * 100), (7, "short"), (8, ""), (9, None), (10, "unused")], "owner int, text string")
    rows = summaries.with_texts(inserts, texts, "base", "owner", "text").selectExpr("id", "base", "text", "spark_partition_id() AS task").collect()
    known = {1: "long" * 100, 7: "short", 8: ""}
    assert sorted(r.id for r in rows) == list(range(2000)) and all(r.text == known.get(r.base) for r in rows)
    assert len({r.task for r in rows if r.base == 1}) >= 3 and len({r.task for r in rows if r.base == 7}) == 1


def test_hatches_are_dealt_to_all_tasks(spark):
    """One small file is one split, but not one task."""
    plan = catalogue.QUERIES["hatch_caps"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
