"""Nested definitions put together from below, counted, and reached."""

import cmath
import itertools
import math
import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from kerfline.functions import geometry
from kerfline.operators import hierarchy, traversal

INSERT = "owner string, handle string, name string, target string, a double, b double, c double, d double, tx double, ty double"


def inserts(spark, rows):
    df = spark.createDataFrame([(o, h, h.upper(), t, *(m or (1.0, 0.0, 0.0, 1.0, 0.0, 0.0))) for o, h, t, m in rows], INSERT)
    return df.select("owner", "handle", "name", "target", geometry.matrix(*[F.col(c) for c in ("a", "b", "c", "d", "tx", "ty")]).alias("m"))


def nodes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def walked(rows, roots, external=()):
    """(space, path, node, issue) of every place, one path after the other."""
    out = []

    def go(space, path, node, stack):
        out.append((space, "/".join(path), node, None))
        for o, h, t, _ in rows:
            if o == node and t is not None and t not in external:
                if t in stack:
                    out.append((space, "/".join([*path, h]), None, "cycle"))
                else:
                    go(space, [*path, h], t, stack | {t})

    for r in roots:
        go(r, [], r, {r})
    return Counter(out)


def random_inserts(seed, cyclic):
    rng, names = random.Random(seed), "ABCDEFGH"
    rows = []
    for k in range(rng.randint(4, 14)):
        o, t = rng.choice("S" + names), rng.choice(names)
        if not cyclic and o != "S" and o >= t:
            o, t = min(o, t), max(o, t)
            if o == t:
                continue
        rows.append((o, f"h{k}", rng.choice([t, t, t, None]), None))
    return rows


@pytest.mark.parametrize("seed, cyclic", [(s, c) for s in range(2) for c in (False, True)])
def test_places_and_counts(spark, seed, cyclic):
    rows = random_inserts(seed, cyclic)
    table, roots, external = inserts(spark, rows), nodes(spark, "S", "Z"), nodes(spark, "D")
    got = traversal.placements(table, roots, external)
    want = walked(rows, ["S", "Z"], "D")
    assert Counter((r.space, r.path, r.node, r.issue) for r in got.collect()) == want
    counts = {r.node: r for r in traversal.occurrences(table, roots, external).collect()}
    times = Counter()
    for (_, path, node, _), n in want.items():
        if node:
            times[node] += n
            times["D"] += n * sum(o == node and t == "D" for o, _, t, _ in rows)
    assert {k: int(r.n) for k, r in counts.items() if r.n} == {k: v for k, v in times.items() if v}
    assert set(counts) == {"S", "Z", "D"} | {x for o, _, t, _ in rows if t for x in (o, t)}
    for k, r in counts.items():
        used = sum(t == k for _, _, t, _ in rows)
        assert (r.n_inserts, r.reachable, r.unused, r.is_external) == (used, times[k] > 0, used == 0 and k not in "SZ", k == "D")


def test_a_billion_places(spark):
    """Thirty layers, each used twice by the one above: counted, not listed."""
    rows = [(f"N{k}", f"{k}{side}", f"N{k + 1}", None) for k in range(30) for side in "ab"]
    got = {r.node: int(r.n) for r in traversal.occurrences(inserts(spark, rows), nodes(spark, "N0")).collect()}
    assert got == {f"N{k}": 2**k for k in range(31)}


def test_texts_and_primitives(spark):
    """An insert turned by a quarter and stretched holds one that is moved: all in the world, handles as keys."""
    rows = [("Model", "1A", "OUT", (0.0, -2.0, 2.0, 0.0, 10.0, 20.0)), ("OUT", "2B", "IN", (1.0, 0.0, 0.0, 1.0, 5.0, 0.0)), ("OUT", "2C", "FLAT", (0.0, 0.0, 0.0, 0.0, 1.0, 1.0))]
    places = traversal.placements(inserts(spark, rows), nodes(spark, "Model"))
    text = [("Model", "T1", "DBText", "direct", 1.0, 2.0, 0.5, "0", None), ("IN", "T2", "MText", "in", 1.0, 2.0, 0.0, "0", (1.0, 2.0, 4.0, 3.0)), ("IN", "T3", "MText", " \n", 1.0, 2.0, 0.0, "0", None), ("FLAT", "T4", "DBText", "flat", 3.0, 3.0, 1.0, "0", None)]
    texts = spark.createDataFrame(text, "owner string, handle string, entity_type string, text string, x double, y double, rotation double, layer string, bounds struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    got = {r.record_key: r for r in traversal.oriented_texts(places, texts).collect()}
    assert set(got) == {"direct/T1", "1A/2B/T2", "1A/2C/T4"}
    r = got["1A/2B/T2"]
    assert (r.x, r.y, r.origin, r.block_path, r.root_handle, r.space) == (6.0, 32.0, "block-definition", "1A/2B", "1A", "Model")
    assert (round(r.world_rotation, 9), round(r.axis_x, 9), r.axis_y, tuple(r.bounds)) == (1.570796327, 0.0, 1.0, (4.0, 32.0, 6.0, 38.0))
    assert (got["direct/T1"].local_rotation, round(got["direct/T1"].world_rotation, 9), got["direct/T1"].bounds_valid, got["direct/T1"].block_path) == (0.5, 0.5, False, "")
    assert (got["1A/2C/T4"].axis_x, got["1A/2C/T4"].axis_y, got["1A/2C/T4"].world_rotation) == (0.0, 0.0, 0.0)
    point = "struct<x:double,y:double>"
    entity = [("IN", "L", "Line", (0.0, 0.0), (1.0, 0.0), None, None, None, None, None, None, None), ("IN", "A", "Arc", None, None, (0.0, 0.0), 1.0, 0.0, 3.141592653589793, None, None, (-1.0, 0.0, 1.0, 1.0)), ("IN", "P", "Polyline", None, None, None, None, None, None, [(0.0, 0.0), (1.0, 1.0)], True, None), ("IN", "X", "Solid", None, None, None, None, None, None, None, None, None)]
    entities = spark.createDataFrame(entity, f"owner string, handle string, entity_type string, start {point}, end {point}, center {point}, radius double, start_angle double, end_angle double, vertices array<{point}>, closed boolean, bounds struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    got = {r.handle: r for r in traversal.primitives(places, entities).collect()}
    assert set(got) == {"L", "A", "P"}
    assert (tuple(got["L"].start), tuple(got["L"].end), got["L"].endpoints_valid, got["L"].curve_geometry_valid) == ((10.0, 30.0), (10.0, 32.0), True, False)
    arc = got["A"]
    assert (tuple(arc.start), tuple(arc.center), arc.radius, tuple(round(v, 9) for v in arc.mid), tuple(round(v, 9) for v in arc.end), tuple(arc.bounds)) == ((10.0, 32.0), (10.0, 30.0), 2.0, (8.0, 30.0), (10.0, 28.0), (8.0, 28.0, 10.0, 32.0))
    assert (got["P"].vertex_count, got["P"].closed, got["P"].start, got["L"].vertex_count, got["P"].record_key) == (2, True, None, 0, "1A/2B/P")


@pytest.mark.parametrize("growth", [0, 4])
def test_reachable_by_doubling(spark, growth):
    """A chain, a loop with a tail, a dense knot: whether links double or not, what a walk reaches; limits are of edges."""
    edges = [(i, i + 1) for i in range(37)] + [(37, 20), (5, 100)] + [(100 + i, 100 + j) for i, j in itertools.product(range(6), range(6))] + [(200, 201), (50, 0)]
    table, roots = spark.createDataFrame(edges, "parent long, child long"), spark.createDataFrame([(0,), (0,)], "node long")
    want, todo = {0}, [0]
    while todo:
        todo = [c for p, c in edges if p in todo and c not in want]
        want |= set(todo)
    assert sorted(r.node for r in hierarchy.reachable(table, roots, growth=growth).collect()) == sorted(want)
    chain, first = spark.createDataFrame([(i, i + 1) for i in range(21)], "parent long, child long"), spark.createDataFrame([(0,)], "node long")
    for limit in (0, 1, 5, 20):
        with pytest.raises(ValueError, match=f"max_rounds {limit}"):
            hierarchy.reachable(chain, first, limit, growth)
    assert [hierarchy.reachable(chain, first, n, growth).count() for n in (21, 22, 99)] == [22, 22, 22]


@pytest.mark.parametrize("seed", range(2))
def test_simple_paths(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(9), rng.randrange(9)) for _ in range(12)] + [(i, i + 1) for i in range(20, 33)] + [(0, 20)]
    table, roots = spark.createDataFrame(edges, "parent long, child long"), spark.createDataFrame([(0,), (3,)], "node long")
    rows = lambda df: Counter((r.node, tuple(r.path), r.depth, r.stopped) for r in df.collect())
    assert rows(hierarchy.simple_paths(table, roots)) == rows(hierarchy.expand(table, roots, max_depth=40))


def test_a_leaf_in_a_parent(spark):
    """A parent turned back by 15 degrees and doubled holds a leaf turned by 30 and stretched by 1.5; another leaf is stretched unevenly, one turned by 90."""
    turn = lambda degrees, sx, sy, x, y: (math.cos(math.radians(degrees)) * sx, -math.sin(math.radians(degrees)) * sy, math.sin(math.radians(degrees)) * sx, math.cos(math.radians(degrees)) * sy, float(x), float(y))
    rows = [("Model", "A1", "PARENT", turn(-15, 2, 2, 1000, 2000)), ("PARENT", "B2", "LEAF", turn(30, 1.5, 1.5, 200, 100)), ("Model", "C3", "LEAF", turn(20, 2, 0.5, 3000, 1000)), ("Model", "D4", "LEAF", turn(90, 1, 1, 7000, 500))]
    places = traversal.placements(inserts(spark, rows), nodes(spark, "Model"))
    at = {"A1/B2": lambda p: complex(1000, 2000) + 2 * cmath.exp(-1j * math.pi / 12) * (complex(200, 100) + 1.5 * cmath.exp(1j * math.pi / 6) * p), "C3": lambda p: complex(3000, 1000) + cmath.exp(1j * math.pi / 9) * complex(2 * p.real, 0.5 * p.imag), "D4": lambda p: complex(7000, 500) + 1j * p}
    texts = spark.createDataFrame([("LEAF", "T", "DBText", "LEAF_TEXT", 10.0, 140.0, 0.0, "0", None)], "owner string, handle string, entity_type string, text string, x double, y double, rotation double, layer string, bounds struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    got = {r.record_key: r for r in traversal.oriented_texts(places, texts).collect()}
    assert set(got) == {f"{k}/T" for k in at}
    for k, f in at.items():
        r = got[f"{k}/T"]
        assert abs(complex(r.x, r.y) - f(10 + 140j)) < 1e-6
        assert abs(r.world_rotation - cmath.phase(f(1 + 0j) - f(0j))) < 1e-9
    point = "struct<x:double,y:double>"
    box = (20.0, 70.0, 80.0, 130.0)
    leaf = [("LEAF", "L", "Line", (0.0, 0.0), (100.0, 0.0), None, None, None, None, None, None, (0.0, 0.0, 100.0, 0.0)), ("LEAF", "P", "Polyline", None, None, None, None, None, None, [(0.0, 20.0), (100.0, 20.0), (100.0, 60.0), (0.0, 60.0)], True, (0.0, 20.0, 100.0, 60.0)), ("LEAF", "C", "Circle", None, None, (50.0, 100.0), 20.0, None, None, None, None, (30.0, 80.0, 70.0, 120.0)), ("LEAF", "R", "Arc", None, None, (50.0, 100.0), 30.0, 0.0, math.pi / 2, None, None, box), ("PARENT", "M", "Line", (0.0, 0.0), (300.0, 0.0), None, None, None, None, None, None, None), ("LEAF", "D", "DBPoint", None, None, None, None, None, None, None, None, None)]
    entities = spark.createDataFrame(leaf, f"owner string, handle string, entity_type string, start {point}, end {point}, center {point}, radius double, start_angle double, end_angle double, vertices array<{point}>, closed boolean, bounds struct<min_x:double,min_y:double,max_x:double,max_y:double>")
    got = {r.record_key: r for r in traversal.primitives(places, entities).collect()}
    assert set(got) == {f"{k}/{e}" for k in at for e in "LPCR"} | {"A1/M"} and got["A1/M"].bounds_valid is False
    near = lambda p, z: abs(complex(p.x, p.y) - z) < 1e-6
    for k, f in at.items():
        line, arc, poly = got[f"{k}/L"], got[f"{k}/R"], got[f"{k}/P"]
        assert near(line.start, f(0j)) and near(line.end, f(100 + 0j))
        half = 30 * cmath.exp(1j * math.pi / 4)
        assert near(arc.center, f(50 + 100j)) and near(arc.start, f(80 + 100j)) and near(arc.mid, f(50 + 100j + half)) and near(arc.end, f(50 + 130j))
        assert abs(arc.radius - abs(f(80 + 100j) - f(50 + 100j))) < 1e-6
        corners = [f(complex(x, y)) for x in (box[0], box[2]) for y in (box[1], box[3])]
        want = (min(z.real for z in corners), min(z.imag for z in corners), max(z.real for z in corners), max(z.imag for z in corners))
        assert all(abs(a - b) < 1e-6 for a, b in zip(arc.bounds, want)) and (poly.vertex_count, poly.closed, poly.endpoints_valid) == (4, True, False)
    assert [round(got[f"{k}/R"].radius, 6) for k in at] == [90.0, 60.0, 30.0]


def test_hot_nodes_are_dealt(spark):
    """A node of many entities, one of many places and one of both are several parts, and every pair still meets once."""
    places = spark.createDataFrame([("a", "")] + [("b", f"p{k}") for k in range(95)] + [("c", f"q{k}") for k in range(25)] + [("d", "")] * 2, "node string, path string")
    entities = spark.createDataFrame([("a", f"x{k}") for k in range(90)] + [("b", "y")] * 2 + [("c", f"z{k}") for k in range(31)] + [("e", "w")], "owner string, handle string")
    got = traversal._dealt(places, entities, most=10)
    plain = places.join(entities, places["node"] == entities["owner"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.columns == plain.columns
    assert "part_e" in got._jdf.queryExecution().optimizedPlan().toString()


def test_places_meet_entities_in_one_shuffle(spark):
    """Neither side is brought together by node alone, as two spaces that hold all entities would be two tasks; corners are worked out without arrays."""
    shown, before = {}, {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    places = spark.createDataFrame([("S", "", "", (2.0, 0.0, 0.0, -1.0, 1.0, 1.0), "S", None)] * 2, "space string, path string, names string, m struct<a:double,b:double,c:double,d:double,tx:double,ty:double>, node string, issue string")
    box = "bounds struct<min_x:double,min_y:double,max_x:double,max_y:double>"
    texts = spark.createDataFrame([("S", "1", "DBText", "a", 1.0, 2.0, 0.5, (1.0, 2.0, 4.0, 3.0)), ("S", "2", "DBText", "b", 1.0, 2.0, 0.5, (1.0, None, 4.0, 3.0)), ("S", "3", "DBText", "c", 1.0, 2.0, 0.5, None), ("S", "4", "DBText", "\t \r\n", 1.0, 2.0, 0.5, None), ("S", "5", "DBText", None, 1.0, 2.0, 0.5, None), ("S", "6", "DBText", "\n\u00a0", 1.0, 2.0, 0.5, None)], f"owner string, handle string, entity_type string, text string, x double, y double, rotation double, {box}")
    point = "struct<x:double,y:double>"
    line = spark.createDataFrame([("S", "L", "Line", (0.0, 0.0), (1.0, 1.0), None, None, None, None, None, None, (0.0, 0.0, 1.0, 1.0))], f"owner string, handle string, entity_type string, start {point}, end {point}, center {point}, radius double, start_angle double, end_angle double, vertices array<{point}>, closed boolean, {box}")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for name, rows in (("texts", traversal.oriented_texts(places, texts)), ("line", traversal.primitives(places, line))):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            shown[name] = plan.count("Exchange hashpartitioning"), "lambda" in plan
            got = Counter((r.handle, r.bounds and tuple(r.bounds), r.bounds_valid) for r in rows.collect())
            assert got == ({("1", (3.0, -2.0, 9.0, -1.0), True): 2, ("2", None, False): 2, ("3", None, False): 2, ("6", None, False): 2} if name == "texts" else {("L", (1.0, 0.0, 3.0, 1.0), True): 2})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert shown == {"texts": (2, False), "line": (2, False)}
