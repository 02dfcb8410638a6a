"""Documents of drawings made here: reading, comparing, validating, expanding."""

import json
import math
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.functions import geometry
from kerfline.operators import gates, hierarchy, ordering, reconcile, validators
from kerfline.sources import exports


def put(folder, kind, bom=False, **body):
    folder.mkdir(exist_ok=True)
    (folder / f"plan.{exports.SUFFIXES[kind]}.json").write_text(("﻿" if bom else "") + json.dumps({"drawing": "plan", **body}), encoding="utf-8")


def documents(folder, text="A", camera=10.0, number=5, twice=False, bom=False):
    item = {"entity_type": "DBText", "origin": "direct", "text": text, "x": 1.0, "y": 2.0, "z": 0.0, "layer": "0", "space": "Model", "handle": "1A", "block_path": ""}
    put(folder, "text", bom, records=[item, item, None])
    put(folder, "frame", line_segments=[{"space": "Model", "layer": "0", "handle": "2", "start_x": 0.0, "start_y": 0.0, "end_x": 1.0000000001, "end_y": 0.0}])
    one = {"instance_key": "5", "block_name": "B", "x": 1.0, "attributes": ["T=1"], "scale_x": 1.0}
    put(folder, "symbol", records=[one, one] if twice else [one])
    put(folder, "oriented_text", records=[{"record_key": "7", "text": "t", "x": 0.5}])
    put(folder, "primitive", records=[{"record_key": "9", "entity_type": "Line", "start_x": 0.0, "min_x": 0.0 if text == "A" else 1.0}])
    view = {"handle": "V1", "number": 1, "is_paper_viewport": True, "view_height": camera}
    put(folder, "visibility", records=[{"instance_key": "5", "is_dynamic": True, "own_layer_state": {"name": "0", "is_off": False}, "dynamic_properties": [{"name": "p", "value": "1"}]}], layers=[{"name": "0", "is_off": False}], layouts=[{"layout_handle": "L", "tab_order": 1}], viewports=[view, {**view, "handle": "V2", "number": number, "is_paper_viewport": False, "view_height": 4.0}, {**view, "handle": "V3", "number": 6, "is_paper_viewport": None, "view_height": 4.0}])
    return str(folder)


def compared(spark, left, right):
    rows = reconcile.compare(*exports.read_pair(spark, left, right, "plan")).cache()
    return {r.comparison: r for r in rows.collect()}, reconcile.status(rows).first()


def test_native_compare(spark, tmp_path):
    left = documents(tmp_path / "a", bom=True)
    got, status = compared(spark, left, documents(tmp_path / "b", camera=999.0, number=-1))
    assert (status.status, status.backend_equivalent, status.absence_proven) == (reconcile.CONSISTENT, False, False)
    assert (got["visibility_viewports"].matched, got["viewport_number_diagnostics"].mismatched, got["text_core"].matched, got["frame_lines"].matched) == (2, 1, 2, 1)
    assert len(got) == 11 and all(r.consistent for r in got.values() if not r.diagnostic)
    got, status = compared(spark, left, documents(tmp_path / "c", text="B", twice=True))
    assert status.status == reconcile.UNRESOLVED and (got["text_core"].left_only, got["text_core"].right_only, got["primitive_bounds"].mismatched) == (2, 2, 1)
    assert got["symbol_core"].matched == 1 and not got["symbol_core"].consistent and got["visibility_layers"].consistent


def test_documents_that_are_none(spark, tmp_path):
    (tmp_path / "x.json").write_text("[1, 2")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        exports.read_document(spark, str(tmp_path / "x.json"), exports.T.StructType.fromDDL("a int")).collect()


def test_portable_compare(spark):
    entity = "entity_type string, handle string, text string, block_name string, block_path string, position array<double>, rotation_radians double, scale array<double>, start array<double>, end array<double>, vertices array<struct<x:double,y:double>>, closed boolean, center array<double>, radius double"
    line = {"entity_type": "LINE", "handle": "d", "start": [3.0, 1.0, 0.0], "end": [0.0, 2.0, 0.0]}

    def portable(x):
        rows = [{"entity_type": "TEXT", "handle": "a", "text": "T", "position": [x, 2.0, 0.0]}, {"entity_type": "ATTDEF", "handle": "b", "text": "D", "position": [x, 3.0, 0.0]}, {"entity_type": "INSERT", "handle": "c", "block_name": "B", "block_path": "", "position": [1.0, 1.0, 0.0], "rotation_radians": 0.5, "scale": [1.0, 1.0, 1.0]}, line, {"entity_type": "ARC", "handle": "e"}, {"entity_type": "LWPOLYLINE", "handle": "f", "vertices": [], "closed": True}, {"entity_type": "LWPOLYLINE", "handle": "g", "vertices": [{"x": 0.0, "y": 0.0}, {"x": 5.0, "y": 1.0}]}, {"entity_type": "CIRCLE", "handle": "h", "center": [1.0, 1.0], "radius": 9.0}]
        return spark.read.schema(entity).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))

    text = spark.createDataFrame([("DBText", "A", "T", 1.0, 2.0, 0.0), ("DBText", "B", "D", 1.0, 3.0, 0.0)], "entity_type string, handle string, text string, x double, y double, z double")
    symbol = spark.createDataFrame([("C", "B", None, 1.0, 1.0, 0.0, 0.5, 1.0, 1.0, 1.0)], "instance_handle string, block_name string, parent_instance_key string, x double, y double, z double, local_rotation_radians double, scale_x double, scale_y double, scale_z double")
    primitive = spark.createDataFrame([("Line", "D", 0.0, 1.0, 3.0, 2.0, None, None, None, None), ("Polyline", "G", 0.0, 0.0, 5.0, 1.0, None, None, 2, False), ("Circle", "H", 0.0, 0.0, 2.0, 2.0, 1.0, 1.0, None, None), ("Line", "Z", float("nan"), 0.0, 0.0, 0.0, None, None, None, None)], "entity_type string, handle string, min_x double, min_y double, max_x double, max_y double, center_x double, center_y double, vertex_count int, closed boolean")
    got = {r.comparison: r for r in reconcile.compare_portable(portable(1.0), text, symbol, primitive).collect()}
    assert {k: r.matched for k, r in got.items()} == {"text:TEXT": 1, "text:TEXT_PLUS_ATTDEF": 2, "insert:identity_by_handle_and_name": 1, "insert:world_position": 1, "insert:root_local_transform_tuple": 1, "insert:local_transform_tuple": 1, "primitive:LINE": 1, "primitive:LWPOLYLINE": 1, "primitive:CIRCLE": 1, "primitive:ARC": None}
    assert (got["text:TEXT"].right_only, got["primitive:LINE"].right_count, got["primitive:ARC"].left_count, got["primitive:ARC"].status) == (1, 1, 1, reconcile.ARC_STATUS)
    got = {r.comparison: r for r in reconcile.compare_portable(portable(1.01), text, symbol, primitive).collect()}
    assert (got["text:TEXT"].matched, got["text:TEXT"].left_only, got["text:TEXT"].right_only, got["text:TEXT_PLUS_ATTDEF"].matched) == (0, 1, 2, 0)


def evidence(**changes):
    row = lambda key: {"entity_type": "LINE", "handle": "1", "instance_key": key, "root_space": "Model", "block_path": "", "layer": "0", "start": [0.0, 1.0], "vertices": []}
    records = changes.pop("records", [row("a"), row("b")])
    return {"document": "d", "metadata": {**validators.PORTABLE, "status": validators.STATUSES[0], "source_sha256": "A" * 64} | changes, "summary": {"evidence_record_count": len(records)}, "evidence_records": records}, row


def test_portable_rules(spark):
    meta = ",".join(f"{k}:{'boolean' if isinstance(v, bool) else 'string'}" for k, v in validators.PORTABLE.items())
    ddl = f"document string, metadata struct<{meta},status:string,source_sha256:string>, summary struct<evidence_record_count:bigint>, evidence_records array<struct<entity_type:string,handle:string,instance_key:string,root_space:string,block_path:string,layer:string,start:array<double>,vertices:array<struct<x:double>>>>"
    errors = lambda d: sorted(r.error for r in validators.portable_errors(spark.read.schema(ddl).option("allowNonNumericNumbers", True).json(spark.sparkContext.parallelize([json.dumps(d)]))).collect())
    good, row = evidence()
    assert errors(good) == []
    assert errors(evidence(absence_proven=True, formal_backend_equivalent=True)[0]) == ["metadata.absence_proven must be false", "metadata.formal_backend_equivalent must be false"]
    bad = {**good, "evidence_records": [row("a"), row("a"), {**row("c"), "layer": None, "start": [math.nan]}, {**row("e"), "vertices": [{"x": math.inf}]}]}
    assert errors(bad) == ["evidence_records[2].layer must be a text", "evidence_records[2].start is not finite", "evidence_records[3].vertices[] is not finite", "instance_key given more than once: a", "summary.evidence_record_count does not match the records"]


def test_route_rules(spark):
    first, second = list(validators.ROUTE)[:2]
    host = {"backend": "AutoCAD2014", "status": "success", "host_release": "2014", "host_api_version": "R19.1", "host_file_version": "19.1", "max_dwg_version": "AC1027"}
    good = {"document": "d", "schema_version": validators.ROUTE_VERSION, "status": validators.ROUTE[first], "selected_backend": first, "selected_output": "o", "source_dwg_version": "AC1032", "source_sha256_before": "A" * 64, "source_sha256_after": "A" * 64, "source_unchanged": True, "absence_proven": False, "route_order": list(validators.ROUTE), "attempts": [{"backend": first, "status": "success"}]}
    lost = [{"backend": first, "status": "failed"}, {"backend": second, "status": "failed"}]
    old = {**good, "status": validators.ROUTE["AutoCAD2014"], "selected_backend": "AutoCAD2014", "attempts": [*lost, host]}
    cases = [
        (good, []),
        ({**good, "route_order": list(validators.ROUTE)[::-1]}, ["route_order is not the declared one"]),
        ({**good, "attempts": lost}, ["no attempt of the chosen reader succeeded"]),
        ({**good, "attempts": [lost[1], *good["attempts"]]}, ["attempts do not follow the declared order", f"the first attempt is not one of {first}"]),
        (old, ["attempts[2]: AutoCAD2014 cannot succeed for the source's version"]),
        ({**old, "source_dwg_version": "AC1027"}, []),
        ({**old, "source_dwg_version": "AC1027", "attempts": [*lost, {**host, "host_api_version": "R24.2"}]}, ["attempts[2]: host_api_version does not match backend"]),
        ({**good, "status": validators.HASH_CHANGED, "selected_backend": None, "selected_output": None}, [f"{validators.HASH_CHANGED} requires a changed hash"]),
        ({**good, "source_sha256_after": "a" * 64, "attempts": []}, ["attempts must not be empty", "source_sha256_after must be an upper-case SHA-256", "source_unchanged does not match the two hashes"]),
    ]
    rows = [json.dumps({**c, "document": str(i)}) for i, (c, _) in enumerate(cases)]
    found = validators.route_errors(spark.read.schema(validators.ROUTE_SCHEMA).json(spark.sparkContext.parallelize(rows))).collect()
    assert {i: sorted(r.error for r in found if r.document == str(i)) for i in range(len(cases))} == {i: e for i, (_, e) in enumerate(cases)}


def test_settings_and_copies():
    base = {"schema_version": validators.CONFIG_VERSION, "enabled": True, "input_modes": ["image"], "use_for": [validators.USES[0]], "formal_confirmation_allowed": False, "provider": "p", "model": "m", "api_key_env": "KEY"}
    assert validators.assistant_route(base, {"KEY": "x"}) == ([], validators.ROUTES[1]) and validators.assistant_route(base, {}) == ([], validators.ROUTES[2])
    assert validators.assistant_route({**base, "enabled": False}, {"KEY": "x"})[1] == validators.ROUTES[2] and validators.assistant_route(base, {}, True)[1] == validators.ROUTES[0]
    assert len(validators.assistant_route({**base, "formal_confirmation_allowed": True, "input_modes": [], "use_for": ["x"], "schema_version": "2"}, {})[0]) == 4
    assert gates.copy_gate("a/b", "c", "A" * 64, "a" * 64) == [] and len(gates.copy_gate("A\\b", "a/B", "A" * 64, "B" * 64)) == 2 and gates.copy_gate("a", "b", "x", "x") == ["the expected hash is not a SHA-256"]


def test_transforms(spark):
    """Nested, uneven and repeated inserts: places in the world, worked out by complex numbers."""
    turn = math.radians
    insert = lambda parent, child, x, y, degrees, sx=1.0, sy=1.0, rows=1, columns=1: (parent, child, x, y, turn(degrees), sx, sy, rows, columns)
    inserts = spark.createDataFrame([insert("parent", "leaf", 200.0, 100.0, 30, 1.5, 1.5), insert("space", "parent", 1000.0, 2000.0, -15, 2.0, 2.0), insert("space", "leaf", 3000.0, 1000.0, 20, 2.0, 0.5), insert("space", "leaf", 5000.0, 2000.0, 10, rows=2, columns=3), insert("space", "leaf", 7000.0, 500.0, 90)], "parent string, child string, x double, y double, rotation double, sx double, sy double, n_rows int, n_columns int")
    edges = inserts.select("parent", "child", "n_rows", "n_columns", geometry.placement(*[F.col(c) for c in ("x", "y", "rotation", "sx", "sy")]).alias("m"))
    roots = spark.range(1).select(F.lit("space").alias("node"), geometry.identity().alias("m"))
    found = hierarchy.placed(edges, roots)
    entities = spark.createDataFrame([("leaf", "line end", 100.0, 0.0), ("leaf", "circle", 50.0, 100.0), ("leaf", "point", 25.0, 100.0), ("leaf", "text", 10.0, 140.0), ("parent", "line end", 300.0, 0.0)], "owner string, role string, x double, y double")
    got = {(r.role, "/".join(r.path[1:]), round(r.x, 5), round(r.y, 5)) for r in hierarchy.attribute_points(found, entities).collect()}
    place = lambda z, x, y, degrees, sx=1.0, sy=1.0: complex(x, y) + complex(z.real * sx, z.imag * sy) * complex(math.cos(turn(degrees)), math.sin(turn(degrees)))
    leaf = {"line end": 100 + 0j, "circle": 50 + 100j, "point": 25 + 100j, "text": 10 + 140j}
    want = {("line end", "parent", place(300 + 0j, 1000, 2000, -15, 2, 2))}
    for role, z in leaf.items():
        want |= {(role, "parent/leaf", place(place(z, 200, 100, 30, 1.5, 1.5), 1000, 2000, -15, 2, 2)), (role, "leaf", place(z, 3000, 1000, 20, 2, 0.5)), (role, "leaf", place(z, 5000, 2000, 10)), (role, "leaf", place(z, 7000, 500, 90))}
    assert got == {(r, p, round(z.real, 5), round(z.imag, 5)) for r, p, z in want}
    assert ("text", "leaf", 6860.0, 510.0) in got and ("line end", "parent/leaf", 1727.91189, 2167.30326) in got
    assert found.count() == 6 and hierarchy.repeated_inserts(edges).count() == 5 and hierarchy.repeated_inserts(edges, True).count() == 10


def test_cycles_and_depth(spark):
    m = geometry.identity()
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("a", "c")], "parent string, child string").withColumn("m", m)
    roots = spark.createDataFrame([("a",)], "node string").withColumn("m", m)
    paths = lambda df: sorted(("".join(r.path), r.issue) for r in df.collect())
    assert paths(hierarchy.placed(edges, roots)) == [("a", None), ("ab", None), ("aba", "cycle"), ("abc", None), ("ac", None)]
    assert paths(hierarchy.placed(edges, roots, emit_cycle=False)) == [("a", None), ("ab", None), ("abc", None), ("ac", None)]
    assert paths(hierarchy.placed(edges, roots, max_depth=1)) == [("a", None), ("ab", "depth"), ("ac", None)]


def test_orders(spark):
    rows = spark.createDataFrame([("ff",), ("100",), ("0A",), ("",)], "handle string")
    assert [r.handle for r in ordering.by_handle(rows).collect()] == ["", "0A", "ff", "100"]
    box = spark.range(1).select(geometry.measures(geometry.envelope(geometry.moved(geometry.corners(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(1.0)), geometry.matrix(0, -1, 1, 0, 5, 0)))).alias("b")).first().b
    assert (box.center_x, box.center_y, box.width, box.height) == (4.5, 1.0, 1.0, 2.0)
    gate = gates.completeness(spark.range(3), {"small": F.col("id") < 3, "even": F.col("id") % 2 == 0}).first()
    assert (gate.complete, gate.reasons) == (False, ["even"])
