"""Documents as files, joins by place, ranks and brackets on rows made here, against all pairs."""

import json
import math
import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.operators import ordering, spatial
from kerfline.sources import documents

BAD = {
    "array.json": "[\n  {\n  }\n]\n",
    "cut.json": '{\n  "drawing": "x",\n  "records": [\n    {"a": 1},\n    {"a": 2},\n',
    "empty.json": "",
    "open.json": '{\n  "records": [\n    {"a": 1}\n}\n',
    "other.json": '{\n  "records": [\n    17\n  ]\n}\n',
}


@pytest.mark.parametrize("name", BAD)
def test_files_that_are_no_documents(spark, tmp_path, name):
    (tmp_path / name).write_text(BAD[name])
    with pytest.raises(Exception, match="not one whole object"):
        documents.read_array(spark, str(tmp_path / name), "records", "a int").collect()
    with pytest.raises(Exception, match="not one whole object"):
        documents.read_header(spark, str(tmp_path / name), "drawing string").collect()


@pytest.mark.parametrize("body", ["[1, 2]", '[{"a": 1}, {"a": 2}]', '{"a": [1, 2', "", '"text"', '{"a": 1}]'])
def test_whole_documents(spark, tmp_path, body):
    (tmp_path / "x.json").write_text(body)
    with pytest.raises(Exception, match="(?i)one whole object|malformed|parse"):
        documents.read_whole(spark, str(tmp_path / "x.json"), "a int").collect()


def test_whole_document_with_mark(spark, tmp_path):
    (tmp_path / "x.json").write_text('\ufeff{"a": NaN,\n "b": [{"c": 1}, null]} \n', encoding="utf-8")
    row = documents.read_whole(spark, str(tmp_path / "x.json"), "a double, b array<struct<c:int>>").first()
    assert math.isnan(row.a) and row.b[0].c == 1 and row.b[1] is None


def test_write_and_scan(spark, tmp_path):
    """Header, four arrays, one of them empty, odd names and texts; split by bytes; written again; nothing there on error."""
    text = 'a "b"\\\n\t{é中}, ]'
    header = spark.createDataFrame([("plan 1 a é", 3, text, None), ("zwei", 0, "", 1.5)], "drawing string, n int, note string, scale double")
    many = [("zwei" if k % 3 else "plan 1 a é", k, f"r{k} {text}", float("inf") if k == 4 else k / 8) for k in random.Random(1).sample(range(500), 500)]
    records = spark.createDataFrame(many, "drawing string, k int, text string, x double").repartition(7)
    names = spark.createDataFrame([("zwei", "B", ["q", None]), ("zwei", "A", [])], "drawing string, name string, list array<string>")
    none = spark.createDataFrame([], "drawing string, name string")
    arrays = {"records": (records, ["k"]), "layers": (names, ["name"]), "layouts": (none, ["name"]), "viewports": (names, ["name"])}
    folder = str(tmp_path / "out")
    for _ in range(2):  # a second time over the first
        documents.write_documents(header, arrays, folder, "cad_visibility_export_v13")
    files = sorted(p.relative_to(folder) for p in Path(folder).rglob("*.json"))
    assert len(files) == 2 and not [p for p in Path(folder).iterdir() if p.name.startswith("_")]
    want = {r[0]: {"drawing": r[0], "n": r[1], "note": r[2], "scale": r[3], "records": [], "layers": [], "layouts": [], "viewports": []} for r in header.collect()}
    for d, k, t, x in sorted(many, key=lambda r: r[1]):
        want[d]["records"].append({"k": k, "text": t, "x": None if x == float("inf") else x})
    for d, n, items in sorted(names.collect()):
        want[d]["layers"].append({"name": n, "list": items})
        want[d]["viewports"].append({"name": n, "list": items})
    got = [json.loads((Path(folder) / f).read_text(encoding="utf-8")) for f in files]
    assert {g["drawing"]: g for g in got} == want and list(got[0]) == ["drawing", "n", "note", "scale", "records", "layers", "layouts", "viewports"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = documents.read_array(spark, folder, "records", "text string, k int")
        assert documents._lines(spark, folder).select("block").distinct().count() > 4
        rows = back.join(documents.read_header(spark, folder, "drawing string"), "file").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for d, doc in want.items():
        assert [(r.k, r.text) for r in sorted((r for r in rows if r.drawing == d), key=lambda r: r.ordinal)] == [(r["k"], r["text"]) for r in doc["records"]]
        assert sorted(r.ordinal for r in rows if r.drawing == d) == list(range(len(doc["records"])))
    assert documents.read_array(spark, folder, "layouts", "name string").count() == documents.read_array(spark, folder, "nothing", "name string").count() == 0
    assert documents.read_whole(spark, folder, "layers array<struct<name:string>>").count() == 2
    with pytest.raises(ValueError, match="tell the documents apart"):
        documents.write_documents(header.union(header), arrays, str(tmp_path / "no"), "s")
    with pytest.raises(ValueError, match="belong to no document"):
        documents.write_documents(header.where("n = 3"), arrays, str(tmp_path / "no"), "s")
    with pytest.raises(ValueError, match="name that a file can have"):
        documents.write_documents(header.selectExpr("'a/b' AS drawing").limit(1), {}, str(tmp_path / "no"), "s")
    assert not (tmp_path / "no").exists()


def test_unknown_layouts(spark):
    views = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "handle string, space_record_handle string")
    layouts = spark.createDataFrame([("a", "Layout1", "L1", 4)], "space_record_handle string, layout_name string, layout_handle string, tab_order int")
    got = documents.layouts_of(views, layouts).select("handle", "layout_name", "layout_handle", "layout_tab_order").collect()
    assert sorted(map(tuple, got)) == [("1", "Layout1", "L1", 4), ("2", "", "", -1), ("3", "", "", -1)]


def test_one_csv_file(spark, tmp_path):
    df = spark.createDataFrame([(k, f'say "{k}"', None if k % 2 else k / 4) for k in range(50)], "k int, text string, x double").repartition(5)
    documents.write_csv_file(df, str(tmp_path / "report.csv"), ["k"])
    raw = (tmp_path / "report.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfk,text,x\n") and raw.count(b"\n") == 51 and b"\r" not in raw
    assert raw.decode("utf-8-sig").splitlines()[1:4] == ['0,"say ""0""",0.0', '1,"say ""1""",', '2,"say ""2""",0.5']


def test_viewports(spark):
    """The paper's own viewport and those that are off show nothing; a turned one, a clipped one, sizes far apart."""
    columns = "handle string, is_paper_viewport boolean, on boolean, entity_visible boolean, layer_off boolean, paper_width double, paper_height double, view_center_x double, view_center_y double, view_target_x double, view_target_y double, view_height double, twist_angle double, view_direction_x double, view_direction_y double, view_direction_z double, frozen_layers array<string>, clip array<struct<x:double,y:double>>"
    base = ("V", False, True, True, False, 100.0, 50.0, 0.0, 0.0, 0.0, 0.0, 50.0, 0.0, 0.0, 0.0, 1.0, [], None)
    change = lambda name, **c: tuple(c.get(f.split()[0], name if f.startswith("handle") else v) for f, v in zip(columns.replace("array<struct<x:double,y:double>>", "a").split(", "), base))
    rng = random.Random(2)
    views = [change("paper", is_paper_viewport=True), change("off", on=False), change("hidden", entity_visible=False), change("layer", layer_off=True), change("side", view_direction_x=1.0), change("plain"), change("frozen", frozen_layers=["F"]), change("turned", twist_angle=0.7, view_center_x=5.0, view_target_x=-3.0), change("tiny", view_height=0.01, view_target_x=1.0), change("huge", view_height=1e6), change("clip", clip=[(-10.0, -10.0), (30.0, -5.0), (0.0, 20.0)])]
    points = [(k, rng.uniform(-60, 60), rng.uniform(-40, 40), rng.choice("FG")) for k in range(400)] + [(900, 50.0, 25.0, "G"), (901, 1.0, 0.0, "F"), (902, 50.1, 0.0, "G")]
    want = set()
    for k, x, y, layer in points:
        for v in views[5:]:
            v = dict(zip([f.split()[0] for f in columns.replace("array<struct<x:double,y:double>>", "a").split(", ")], v))
            dx, dy, t = x - v["view_target_x"], y - v["view_target_y"], v["twist_angle"]
            u, w = math.cos(t) * dx - math.sin(t) * dy - v["view_center_x"], math.sin(t) * dx + math.cos(t) * dy - v["view_center_y"]
            shown = abs(u) <= v["view_height"] + 1e-9 and abs(w) <= v["view_height"] / 2 + 1e-9 and layer not in v["frozen_layers"]
            if v["clip"]:
                edges = list(zip(v["clip"], v["clip"][1:] + v["clip"][:1]))
                shown = shown and sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges) % 2 == 1
            if shown:
                want.add((k, v["handle"]))
    shown = spatial.in_turned_windows(spark.createDataFrame(points, "k int, x double, y double, layer string"), spatial.windows_of_viewports(spark.createDataFrame(views, columns)), "x", "y", "layer")
    got = [(r.k, r.name) for r in shown.collect()]
    assert set(got) == want and len(got) == len(want) and {n for _, n in got} == {"plain", "frozen", "turned", "tiny", "huge", "clip"}
    once = {r.k: (r.windows, r.first_window) for r in spatial.seen_once(shown, "k").collect()}
    assert once == {k: (sum(a == k for a, _ in want), min(n for a, n in want if a == k)) for k, _ in want}


@pytest.mark.parametrize("tolerance", [0.0, 1.0])
def test_intervals(spark, tolerance):
    rng = random.Random(3)
    rows = [(k, rng.choice("ab"), v, v + rng.choice([0.0, 0.5, 30.0])) for k in range(200) for v in [rng.choice([rng.uniform(-500, 500), float(rng.randint(-8, 8))])]]
    intervals = [(k, rng.choice("ab"), a, a + rng.choice([0.0, 1.0, -1.0, 64.0, 900.0, 1e-12])) for k in range(80) for a in [rng.choice([rng.uniform(-500, 500), float(rng.randint(-8, 8))])]]
    want = sorted((i, j) for i, g, lo, hi in rows for j, h, a, b in intervals if g == h and lo >= min(a, b) - tolerance and hi <= max(a, b) + tolerance)
    found = spatial.in_intervals(spark.createDataFrame(rows, "i int, g string, lo double, hi double"), spark.createDataFrame(intervals, "j int, g string, a double, b double"), "lo", "hi", "a", "b", tolerance, ("g",))
    assert sorted((r.i, r.j) for r in found.collect()) == want and want
    assert not any(word in found._jdf.queryExecution().executedPlan().toString() for word in ("CartesianProduct",))


def test_axes(spark):
    axes = [("a", "1", 0.0), ("a", "2", 10.0), ("a", "3", 14.0), ("one", "x", 5.0)]
    points = [("a", 1, 0.0), ("a", 2, 2.5), ("a", 3, 14.5), ("a", 4, 15.5), ("a", 5, -2.0), ("a", 6, -3.0), ("a", 7, 10.0), ("one", 8, 6.0), ("none", 9, 1.0)]
    got = spatial.between_axes(spark.createDataFrame(points, "g string, k int, v double"), spark.createDataFrame(axes, "g string, name string, pos double"), "g", "k", "v", "name", "pos").collect()
    assert {r.k: (r.before, r.after, r.ratio, r.place) for r in got} == {1: ("1", "2", 0.0, "1-2"), 2: ("1", "2", 0.25, "1-2"), 3: ("3", None, 0.125, "3>OUT@0.1250"), 4: ("3", None, 0.375, None), 5: (None, "1", 0.2, "1<OUT@0.2000"), 6: (None, "1", 0.3, None), 7: ("2", "3", 0.0, "2-3"), 8: ("x", None, None, None), 9: (None, None, None, None)}


def test_coincident(spark):
    """A chain of neighbours is one group; copies are not paired; other names and values that are no numbers stay alone."""
    rows = [(k, "n", 0.9 * k, 5.0) for k in range(6)] + [(100 + k, "n", 50.0, 5.0) for k in range(2000)] + [(20, "other", 0.0, 5.0), (21, "n", 0.0, 6.5), (22, None, 1.0, 1.0), (23, None, 1.5, 1.0), (24, "n", None, 1.0), (25, "n", float("nan"), 1.0)]
    got = {r.k: (r.group_key, r.n) for r in spatial.coincident(spark.createDataFrame(rows, "k int, name string, x double, y double"), "k", ["name"], ["x", "y"], 1.0).collect()}
    assert {k: got[k] for k in range(6)} == {k: (0, 6) for k in range(6)} and {got[100 + k] for k in range(2000)} == {(100, 2000)}
    assert {k: v for k, v in got.items() if 20 <= k < 26} == {20: (20, 1), 21: (21, 1), 22: (22, 2), 23: (22, 2), 24: (24, 1), 25: (25, 1)} and len(got) == len(rows)


def test_ranks(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, "a", "b", "c"]), f"{rng.randrange(1 << 40):X}".zfill(rng.choice([1, 14]))) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, g string, handle string").withColumns({"n": ordering.handle_order()[0], "t": ordering.handle_order()[1]}).repartition(9)
    want = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: int(r[2], 16)), 1)}
    assert {r.k: r.rank for r in ordering.ranked(df, ["n", "t"]).collect()} == want
    inner = {}
    for g in {r[1] for r in rows}:
        inner |= {r[0]: i for i, r in enumerate(sorted((r for r in rows if r[1] == g), key=lambda r: int(r[2], 16)), 1)}
    assert {r.k: r.rank for r in ordering.ranked(df, ["n", "t"], within=["g"]).collect()} == inner
    assert ordering.ranked(df.limit(0), ["n"]).count() == 0


def test_interval_totals(spark):
    """As joined and counted: spans longer and shorter than intervals, turned ends, nulls, equal rows, negative spans; and no join of pairs."""
    rng = random.Random(3)
    spans = [(k % 5 and k - 200, lo, lo + rng.choice((-1.0, 0.0, 0.5, 2.0, 30.0))) for k in range(400) for lo in (float(rng.randint(0, 40)),)]
    spans += [(None, 5.0, 6.0), (7, None, 3.0), (8, 3.0, None), (None, 990.0, 991.0), (9, 0.0, 1000.0)]
    cuts = [(k, float(rng.randint(0, 40)), float(rng.randint(0, 40))) for k in range(120)] + [(500, 989.0, 992.0), (501, None, None), (502, 2000.0, 2001.0)]
    rows, intervals = spark.createDataFrame(spans, "v long, low double, high double"), spark.createDataFrame(cuts, "k long, a double, b double")
    want = set()
    for k, a, b in cuts:
        inside = [v for v, lo, hi in spans if None not in (a, b, lo, hi) and lo >= min(a, b) - 0.5 and hi <= max(a, b) + 0.5]
        if inside:
            want.add((k, len(inside), sum(v for v in inside if v is not None) if any(v is not None for v in inside) else None))
    got = spatial.interval_totals(rows, intervals, "low", "high", "a", "b", "v", 0.5)
    assert {tuple(r) for r in got.select("k", "n", "total").collect()} == want and len(want) > 60
    wide = spark.range(30000).selectExpr("id AS v", "CAST(id % 3000 AS DOUBLE) AS low", "id % 3000 + 0.5D AS high")
    n = spatial.interval_totals(wide, spark.range(30000).selectExpr("id AS k", "CAST(0 AS DOUBLE) AS a", "CAST(3000 + id % 7 AS DOUBLE) AS b"), "low", "high", "a", "b", "v").selectExpr("count(*)", "min(n)", "min(total)").first()
    assert tuple(n) == (30000, 30000, 30000 * 29999 // 2)


def test_pairs_of_one_kind_are_not_held(spark):
    """Windows are counted by name: repeated names and keys once, null names never; and pairs that are sure are not grouped by name."""
    points = [(k % 50 if k < 60 else k, k % 7) for k in range(100)]
    windows = [("a", 3), ("a", 3), ("a", 4), ("b", 3), ("c", 5), (None, 5)]
    rows = spatial.once(spark.createDataFrame(points, "k long, at long"), "k", "one_k").join(spatial.once(spark.createDataFrame(windows, "name string, at long"), "name", "one_w"), "at")
    got = {tuple(r) for r in spatial.seen_once(rows, "k", sure=F.col("one_k") & F.col("one_w")).collect()}
    assert got == {tuple(r) for r in spatial.seen_once(rows, "k").collect()}
    want = {}
    for k, at in points:
        for name, there in windows:
            if at == there:
                want.setdefault(k, set()).add(name)
    assert got == {(k, len(v - {None}), min(v - {None}, default=None)) for k, v in want.items()}
    pairs = spark.range(200).selectExpr("id AS k").crossJoin(spark.range(500).selectExpr("id AS name"))
    counted = spatial.seen_once(pairs, "k", sure=F.lit(True) & (F.col("k") >= 0))
    assert {r.windows for r in counted.collect()} == {500}


def test_files_are_scanned_once(spark, tmp_path, monkeypatch):
    """Header and arrays come from what was scanned, as from reads of their own."""
    for name in "ab":
        (tmp_path / f"{name}.json").write_text('{\n  "drawing": "%s",\n  "p": [\n    {"k": 1},\n    {"k": 2}\n  ],\n  "q": [\n    {"k": 7}\n  ]\n}\n' % name)
    path = f"{tmp_path}/*.json"
    told = lambda *scanned: [sorted(map(tuple, df.drop("file").collect())) for df in (documents.read_header(spark, path, "drawing string", *scanned), *[documents.read_array(spark, path, a, "k int", *scanned) for a in "pq"])]
    plain, scanned = told(), documents.scan(spark, path)
    monkeypatch.setattr(documents, "_lines", None)
    assert told(scanned) == plain == [[("a",), ("b",)], [(0, 1), (0, 1), (1, 2), (1, 2)], [(0, 7), (0, 7)]]
