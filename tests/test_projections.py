"""Projections, texts and registries on rows made here."""

import math
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.functions import scalar
from kerfline.operators import projections, registry
from kerfline.sources import exports


def test_value_texts(spark):
    cases = {0.0: "0", 1.5: "1.5", -2.25: "-2.25", 1e15: "1E+15", 123456789012345.0: "123456789012345", 1e-4: "0.0001", 1e-5: "1E-05", 1.25e-7: "1.25E-07", 6.02e123: "6.02E+123", 1 / 3: "0.333333333333333", math.inf: "Infinity", -math.inf: "-Infinity", 100.0: "100"}
    rows = spark.createDataFrame([(v, t) for v, t in cases.items()] + [(math.nan, "NaN"), (None, "")], "v double, want string")
    got = rows.select(scalar.value_text(F.col("v"), rows.schema["v"].dataType).alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]
    flags = spark.createDataFrame([(True, 7), (False, None), (None, -3)], "b boolean, n int")
    assert [tuple(r) for r in flags.select(*[scalar.value_text(F.col(c), flags.schema[c].dataType) for c in flags.columns]).collect()] == [("True", "7"), ("False", ""), ("", "-3")]
    texts = spark.createDataFrame([('a"b\\c\r\n\td\x01',), (None,)], "t string")
    assert [r[0] for r in texts.select(scalar.json_text(F.col("t"))).collect()] == ['a\\"b\\\\c\\r\\n\\td\x01', ""]


def test_types(spark):
    rows = spark.createDataFrame([("LINE", "x", math.nan, [1.0]), ("CIRCLE", "y", 2.0, [3.0]), ("CIRCLE", "z", -math.inf, None)], "type string, text string, radius double, start array<double>")
    assert [tuple(r) for r in projections.by_type(rows, "type").collect()] == [("LINE", None, None, [1.0]), ("CIRCLE", None, 2.0, None), ("CIRCLE", None, None, None)]
    assert projections.by_type(rows.where("false"), "type").collect() == []
    for kind in ("SPLINE", None):
        with pytest.raises(Exception, match="no fields are known"):
            projections.by_type(rows.withColumn("type", F.lit(kind).cast("string")), "type").collect()


def test_hatches(spark):
    def hatch(*loops, most_loops=3, most_points=5):
        made = [{"is_polyline": p, "points": None if n is None else [{"role": f"vertex_{i}" if p else f"curve_{i // 2}_{'end' if i % 2 else 'start'}"} for i in range(n)]} for p, n in loops]
        rows = spark.createDataFrame([(made,)], "loops array<struct<is_polyline:boolean,points:array<struct<role:string>>>>")
        r = rows.select(projections.hatch_evidence(F.col("loops"), most_loops, most_points).alias("h")).first().h
        return [None if l.points is None else len(l.points) for l in r.loops], r.n_loops, r.n_points, r.truncated

    assert hatch() == ([], 0, 0, False)
    assert hatch((True, 5)) == ([5], 1, 5, False) and hatch((True, 6)) == ([5], 1, 5, True)
    assert hatch((True, 5), (True, 0)) == ([5], 2, 5, True) and hatch((True, 0), (False, 0), (True, None), (True, 1)) == ([0, 0, None], 4, 0, True)
    assert hatch((False, 6)) == ([5], 1, 5, False) and hatch((False, 8)) == ([5], 1, 5, True) and hatch((False, 6), (True, 1)) == ([5], 2, 5, True)


def test_what_to_explode(spark):
    rows = spark.createDataFrame([("1A", "block_reference"), ("1A", "line"), ("2B", "entity_bounds"), (None, "entity_unresolved")], "handle string, kind string")
    wanted = lambda pattern: [r[0] for r in rows.select(projections.to_explode(F.col("handle"), F.col("kind"), pattern)).collect()]
    assert wanted("^1") == [True, False, False, False] and wanted("A$|B$") == [True, False, True, False] and wanted(" ") == wanted(None) == [False] * 4


def test_drift(spark, tmp_path):
    for side, files in {"source": {"a": "1", "b": "2", "c": "3"}, "same": {"a": "1", "b": "2", "c": "3"}, "other": {"a": "1", "b": "x", "d": "4"}}.items():
        (tmp_path / side).mkdir()
        for name, text in files.items():
            (tmp_path / side / name).write_text(text)
    tree = lambda side: exports.snapshot(spark, str(tmp_path / side)).withColumn("path", F.substring_index("path", f"/{side}/", -1))
    drift = lambda side: tuple(registry.tree_drift(tree("source"), tree(side)).first())
    assert drift("same") == (registry.IN_SYNC, []) and drift("other") == (registry.DRIFTED, ["b", "c", "d"])


def test_floors(spark):
    rows = spark.createDataFrame([(1, 2, 4, True), (2, 4, 2, True), (3, 1, 2, False), (4, None, 2, True), (5, 3, 3, None)], "id int, low int, high int, sure boolean")
    got = registry.expand_floors(rows, "low", "high", F.col("sure")).orderBy("id", "floor").collect()
    assert [(r.id, r.floor, r.expanded) for r in got] == [(1, 2, True), (1, 3, True), (1, 4, True), (2, None, False), (3, None, False), (4, None, False), (5, None, False)]
