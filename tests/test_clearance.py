"""The clearance report: direct beams, candidates, formal beams, missing evidence, safety stops, and its files."""

import copy
import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.functions import scalar
from kerfline.operators import clearance as c
from kerfline.sources import exports


def quantity(value, status=c.CONFIRMED, reason="measured", **more):
    return {"value_mm": None if value is None else str(value), "status": status, "reason": reason, "source_stage": "test", **more}


def device(name="D1", direct=True):
    link = lambda role, floor: {"support_floor": floor, "component_id": "A", "actual_insert_root": f"r-{role}", "orientation": "horizontal", "mapped_envelope": [100.0, 0.0, 900.0, 200.0], "mapping_status": c.CONFIRMED, "p5_beam_segment_id": f"S-{role}" if direct else None, "p5_physical_status": c.CONFIRMED if direct else c.CANDIDATE, "beam_reference_status": c.CONFIRMED if direct else c.LACKING, "dependency_ids": ["E2", " E1 ", "", "E2"]}
    return {
        "registry_device_id": name, "device_type": "panel", "building_id": "B1", "floor": "1F", "component_id": "A", "axis_position": "1/2", "orientation": "horizontal", "model": "M",
        "beam_references": {"lower_beam_id": "S-lower", "upper_beam_id": "S-upper", "status": c.CONFIRMED} if direct else {},
        "support_links": {"lower": link("lower", "1F"), "upper": link("upper", "2F")},
        "inputs": {"z_lower_level_mm": quantity(0), "z_upper_level_mm": quantity(4500), "lower_installation_surface_offset_mm": quantity(-100, reason="confirmed_lower_Beam_Top"), "upper_beam_top_offset_mm": quantity(-50), "upper_beam_height_mm": quantity(800, beam_number="KL1")},
        "clear_height_mm": 3650.0,
    }


def beam(role="lower", floor="1F", **changes):
    out = {"formal_beam_id": f"F-{role}", "identity": {"building_id": "B1", "support_floor": floor, "component_id": "A", "actual_insert_root": f"R-{role}", "orientation": "horizontal", "face_coordinates_mm": [200.5, -0.5]}, "consumer_supports": [{"registry_device_id": "D1", "support_role": role}], "target_along_intervals_mm": [[5000.0, 6000.0], [900.0, 100.0]]}
    out["identity"] |= changes.pop("identity", {})
    return out | changes


def frames(spark, devices, beams=()):
    read = lambda rows, ddl: spark.read.schema(ddl).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows] or ["{}"], 1)).limit(len(rows))
    return read(devices, c.DEVICES), read(beams, c.BEAMS)


def only(spark, *args):
    return c.report(*frames(spark, *args)).first()


def test_direct_beams(spark):
    rows = c.report(*frames(spark, [device()]), expected=1)
    r = rows.first()
    assert (r.lower_beam_top_elevation_mm, r.upper_beam_top_elevation_mm, r.beam_clearance_excluding_upturn_mm, r.baseline_delta_mm) == (-100, 4450, 3750, 100)
    assert (r.lower_drop_status, r.lower_drop_height_mm, r.lower_drop_reason, r.upper_drop_height_mm) == (c.DROP, 100, f"{c.LOWERED}100mm", 50)
    assert (r.overall_status, r.unresolved_reasons, r.lower_anchorage.conclusion, r.lower_anchorage.evidence_ids, r.upper_beam.beam_number, r.upper_beam.height_mm, r.device_model) == (c.CONFIRMED, [], c.ANCHORED, ["E1", "E2"], "KL1", 800, "M")
    s = c.statistics(rows).first()
    assert (s.output_device_count, s.unique_output_device_count, s.confirmed_clearance_count, s.baseline_clearance_mismatch_count, s.overall_status_counts) == (1, 1, 1, 1, {c.CONFIRMED: 1})


def test_candidates_are_not_promoted(spark):
    r = only(spark, [device(direct=False)])
    assert (r.clearance_status, r.lower_anchorage.status, r.lower_anchorage.reason, r.overall_status) == (c.CONFIRMED, c.CANDIDATE, c.UNPROVEN_SEGMENT, c.REVIEW)
    assert r.unresolved_reasons == [f"{v}:{c.CANDIDATE}" for v in c.ROLES.values()]
    d = device()
    d["support_links"]["lower"]["p5_beam_segment_id"] = "other"
    d["support_links"]["upper"]["mapping_status"] = None
    r = only(spark, [d])
    assert (r.lower_anchorage.status, r.upper_anchorage.status, r.upper_anchorage.reason, r.overall_status) == (c.CONFLICT, c.LACKING, c.NOT_MAPPED, c.CONFLICT)


FORMAL = [
    (beam(), c.INSIDE + c.STAYS_CANDIDATE),
    (beam(formal_beam_id="else"), c.NO_RECORD),
    (beam(identity={"component_id": "B"}), c.GEOMETRY_DIFFERS + c.OTHER_SUPPORT + c.NOT_JUDGED),
    (beam(identity={"face_coordinates_mm": [0.0]}), c.NO_FACES),
    (beam(identity={"face_coordinates_mm": [0.0, 198.0]}), c.GEOMETRY_DIFFERS + c.OUT_OF_FACES + c.NOT_JUDGED),
    (beam(consumer_supports=[]), c.NO_CONSUMER),
    (beam(target_along_intervals_mm=[[1.0]]), c.NO_INTERVALS),
    (beam(target_along_intervals_mm=[[102.0, 900.0]]), c.GEOMETRY_DIFFERS + c.OUT_OF_INTERVALS + c.NOT_JUDGED),
]


def test_formal_beams(spark):
    devices, ledger = [], []
    for i, (b, _) in enumerate(FORMAL):
        d, b = device(f"D{i}", direct=False), copy.deepcopy(b)
        d["formal_shared_beam_references"] = {"lower": {"status": c.CONFIRMED, "formal_beam_id": f"F{i}", "beam_number": "KL9", "width_mm": 400.0, "height_mm": 900.0}}
        b["formal_beam_id"] = b["formal_beam_id"].replace("F-lower", f"F{i}")
        for use in b["consumer_supports"]:
            use["registry_device_id"] = f"D{i}"
        devices.append(d)
        ledger.append(b)
    found = {r.registry_device_id: r for r in c.report(*frames(spark, devices, ledger)).collect()}
    for i, (_, reason) in enumerate(FORMAL):
        r = found[f"D{i}"]
        assert (r.lower_anchorage.status, r.lower_anchorage.reason, r.lower_anchorage.beam_id, r.lower_beam.beam_number, r.lower_beam.source) == (c.CANDIDATE, reason, f"F{i}", "KL9", c.CONTAINERS[0])


def test_missing_is_null_not_zero(spark):
    d = device()
    d["inputs"]["lower_installation_surface_offset_mm"]["reason"] = "installation_surface_only"
    r = only(spark, [d])
    assert (r.lower_beam_top_offset_mm, r.lower_beam_top_elevation_mm, r.beam_clearance_excluding_upturn_mm, r.baseline_delta_mm, r.lower_drop_height_mm) == (None,) * 5
    assert (r.clearance_status, r.lower_drop_status, r.unresolved_reasons, r.overall_status) == (c.LACKING, c.LACKING, [c.MISSING[0], c.MISSING[3]], c.REVIEW)


def test_safety_stops(spark):
    for devices, beams, expected in (([device(), device()], [], None), ([device(" ")], [], None), ([], [], None), ([device()], [], 114), ([device()], [beam(), beam()], None)):
        with pytest.raises(c.SafetyStop):
            c.report(*frames(spark, devices, beams), expected=expected)


def test_files(spark, tmp_path):
    d = device(direct=False)
    d["registry_device_id"] = 'D "2", x'
    rows = c.report(*frames(spark, [device(), d]))
    exports.write_csv(c.as_table(rows).coalesce(1), f"{tmp_path}/csv")
    raw = next(Path(f"{tmp_path}/csv").glob("*.csv")).read_bytes()
    assert raw.startswith("﻿设备ID,".encode()) and b"\r" not in raw and raw.count(b"\n") == 3
    back = {r["设备ID"]: r for r in exports.read_csv(spark, f"{tmp_path}/csv").collect()}
    assert len(c.CSV_COLUMNS) == 28 and back['D "2", x']["未决原因"] == "|".join(f"{v}:{c.CANDIDATE}" for v in c.ROLES.values()) and back["D1"]["梁间净空-未计上翻墩(mm)"] == "3750.0"
    table = exports.markdown_table(rows.select("registry_device_id", "overall_status").orderBy("registry_device_id"))
    assert table.splitlines()[0] == "| registry_device_id | overall_status |" and len(table.splitlines()) == 4
    with pytest.raises(ValueError):
        exports.markdown_table(rows, most=1)
    assert exports.canonical_hash({"b": 1, "a": "é"}) == exports.canonical_hash({"a": "é", "b": 1}) != exports.canonical_hash({"a": "e", "b": 1})


def test_general_text(spark):
    values = [0.0, 1.0, 100.0, 0.5, 123456.7, 999999.6, 1234567.0, 2.5e-5, 0.0001, 33.33333333, 1e20, 50.25]
    rows = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", T.DoubleType())]))
    assert [r.t for r in rows.select(scalar.general_text(F.col("v")).alias("t")).collect()] == [f"{v:g}" for v in values]
    assert copy.copy(exports.positive(" 12 ", 3)) == 12 and exports.positive("-1", 3) == exports.positive(None, 3) == 3
