"""Registered queries of nested definitions: what they hold in the world, and how often they are used.

Two spaces hold the nations; a nation's definition holds its customers as inserts of seven
shared definitions, these hold regions, and one region holds one of the seven again. One
of the seven is external, and every fiftieth customer's definition is missing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import traversal
from .registry import query, table

_TURN = ("[1.0, 0.0, 0.0, 1.0]", "[0.0, -1.0, 1.0, 0.0]", "[0.6, -0.8, 0.8, 0.6]", "[-1.0, 0.0, 0.0, 1.0]")
_WALK = f"""WITH RECURSIVE i0 AS (SELECT 'L' || (n_regionkey % 2) AS owner, 'n' || n_nationkey AS handle, n_name AS name, 'N' || n_nationkey AS target, n_nationkey AS key, n_nationkey * 100.0::DOUBLE AS tx, n_nationkey * 10.0::DOUBLE AS ty FROM nation
 UNION ALL SELECT 'N' || c_nationkey, 'c' || c_custkey, c_mktsegment, CASE WHEN c_custkey % 50 <> 0 THEN 'K' || (c_custkey % 7) END, c_custkey, c_acctbal::DOUBLE, (c_custkey % 1000)::DOUBLE FROM customer
 UNION ALL SELECT 'K' || k, 'k' || k || 'r' || r_regionkey, r_name, 'R' || r_regionkey, r_regionkey + k, k * 5.0::DOUBLE, r_regionkey * 7.0::DOUBLE FROM region, range(7) t(k) WHERE (r_regionkey + k) % 3 = 0
 UNION ALL SELECT 'R4', 'back', 'BACK', 'K2', 1, 3.0::DOUBLE, 4.0::DOUBLE),
inserts AS (SELECT *, (1 + key % 3) * t[1] AS a, (1 + key % 3) * t[2] AS b, (1 + key % 3) * t[3] AS c, (1 + key % 3) * t[4] AS d FROM (SELECT *, ([{", ".join(_TURN)}]::DOUBLE[][])[key % 4 + 1] AS t FROM i0)),
x AS (SELECT DISTINCT 'L' || (n_regionkey % 2) AS space, '' AS path, '' AS names, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, 1.0::DOUBLE AS d, 0.0::DOUBLE AS tx, 0.0::DOUBLE AS ty, 'L' || (n_regionkey % 2) AS node, ['L' || (n_regionkey % 2)] AS stack, false AS stopped FROM nation
 UNION ALL SELECT x.space, CASE WHEN x.path = '' THEN '' ELSE x.path || '/' END || i.handle, CASE WHEN x.names = '' THEN '' ELSE x.names || '/' END || i.name, x.a * i.a + x.b * i.c, x.a * i.b + x.b * i.d, x.c * i.a + x.d * i.c, x.c * i.b + x.d * i.d, x.a * i.tx + x.b * i.ty + x.tx, x.c * i.tx + x.d * i.ty + x.ty,
  i.target, list_append(x.stack, i.target), list_contains(x.stack, i.target) FROM x JOIN inserts i ON x.node = i.owner WHERE NOT x.stopped AND i.target IS NOT NULL AND i.target <> 'K5')"""
_THINGS = """, things AS (SELECT 'L' || (o_orderkey % 2) AS owner, 'o' || o_orderkey AS handle, o_orderkey AS key, o_orderpriority AS words, o_totalprice::DOUBLE AS x, o_custkey::DOUBLE AS y FROM orders
 UNION ALL SELECT 'N' || s_nationkey, 's' || s_suppkey, s_suppkey, s_name, s_acctbal::DOUBLE, s_suppkey::DOUBLE FROM supplier UNION ALL SELECT 'R' || n_regionkey, 'm' || n_nationkey, n_nationkey, n_name, n_nationkey * 3.0::DOUBLE, n_nationkey * 2.0::DOUBLE FROM nation),
placed AS (SELECT p.space, p.names AS block_path, p.a, p.b, p.c, p.d, p.tx, p.ty, t.key, t.words, t.x, t.y, t.handle, CASE WHEN p.path = '' THEN 'direct' ELSE p.path END || '/' || t.handle AS record_key, CASE WHEN p.path = '' THEN 'direct' ELSE 'block-definition' END AS origin, CASE WHEN p.path <> '' THEN string_split(p.path, '/')[1] END AS root_handle
 FROM x p JOIN things t ON p.node = t.owner WHERE NOT p.stopped)"""
_BOX = """CASE WHEN key % 5 <> 0 THEN round(least(a * x + b * y, a * (x + 9) + b * y, a * x + b * (y + 2), a * (x + 9) + b * (y + 2)) + tx, 6) END AS min_x, CASE WHEN key % 5 <> 0 THEN round(greatest(c * x + d * y, c * (x + 9) + d * y, c * x + d * (y + 2), c * (x + 9) + d * (y + 2)) + ty, 6) END AS max_y, key % 5 <> 0 AS bounds_valid"""


def _inserts(spark, sf_dir):
    nation, customer, region = (table(spark, sf_dir, t) for t in ("nation", "customer", "region"))
    rows = nation.selectExpr("concat('L', n_regionkey % 2) AS owner", "concat('n', n_nationkey) AS handle", "n_name AS name", "concat('N', n_nationkey) AS target", "n_nationkey AS key", "CAST(n_nationkey * 100 AS DOUBLE) AS tx", "CAST(n_nationkey * 10 AS DOUBLE) AS ty")
    rows = rows.union(customer.selectExpr("concat('N', c_nationkey)", "concat('c', c_custkey)", "c_mktsegment", "CASE WHEN c_custkey % 50 <> 0 THEN concat('K', c_custkey % 7) END", "c_custkey", "CAST(c_acctbal AS DOUBLE)", "CAST(c_custkey % 1000 AS DOUBLE)"))
    shared = region.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(6)))).where("(r_regionkey + k) % 3 = 0")
    rows = rows.union(shared.selectExpr("concat('K', k)", "concat('k', k, 'r', r_regionkey)", "r_name", "concat('R', r_regionkey)", "r_regionkey + k", "CAST(k * 5 AS DOUBLE)", "CAST(r_regionkey * 7 AS DOUBLE)"))
    rows = rows.union(region.where("r_regionkey = 4").selectExpr("'R4'", "'back'", "'BACK'", "'K2'", "1", "3.0D", "4.0D"))
    turns = F.array(*[F.array(*[F.lit(float(v)) for v in t.strip("[]").split(",")]) for t in _TURN])
    turn, scale = F.element_at(turns, (F.col("key") % 4 + 1).cast("int")), (1 + F.col("key") % 3).cast("double")
    return rows.select("owner", "handle", "name", "target", geometry.matrix(*[scale * turn[k] for k in range(4)], F.col("tx"), F.col("ty")).alias("m"))


def _spaces(spark, sf_dir):
    return table(spark, sf_dir, "nation").selectExpr("concat('L', n_regionkey % 2) AS node").distinct()


def _external(spark, sf_dir):
    return table(spark, sf_dir, "region").where("r_regionkey = 0").selectExpr("'K5' AS node")


def _things(spark, sf_dir):
    """Orders in the spaces, suppliers in their nations, nations in their regions, with a box of 9 by 2 but for every fifth."""
    rows = table(spark, sf_dir, "orders").selectExpr("concat('L', o_orderkey % 2) AS owner", "concat('o', o_orderkey) AS handle", "o_orderkey AS key", "o_orderpriority AS words", "CAST(o_totalprice AS DOUBLE) AS x", "CAST(o_custkey AS DOUBLE) AS y")
    rows = rows.union(table(spark, sf_dir, "supplier").selectExpr("concat('N', s_nationkey)", "concat('s', s_suppkey)", "s_suppkey", "s_name", "CAST(s_acctbal AS DOUBLE)", "CAST(s_suppkey AS DOUBLE)"))
    rows = rows.union(table(spark, sf_dir, "nation").selectExpr("concat('R', n_regionkey)", "concat('m', n_nationkey)", "n_nationkey", "n_name", "CAST(n_nationkey * 3 AS DOUBLE)", "CAST(n_nationkey * 2 AS DOUBLE)"))
    box = F.struct(F.col("x").alias("min_x"), F.col("y").alias("min_y"), (F.col("x") + 9).alias("max_x"), (F.col("y") + 2).alias("max_y"))
    return rows.withColumn("bounds", F.when(F.col("key") % 5 != 0, box))


def _places(spark, sf_dir):
    return traversal.placements(_inserts(spark, sf_dir), _spaces(spark, sf_dir), _external(spark, sf_dir))


@query(_WALK + " SELECT space, path, names, CASE WHEN NOT stopped THEN node END AS node, CASE WHEN stopped THEN 'cycle' END AS issue, round(a, 6) + 0.0 AS a, round(b, 6) + 0.0 AS b, round(tx, 6) + 0.0 AS tx, round(ty, 6) + 0.0 AS ty FROM x")
def placed_definitions(spark, sf_dir):
    """Where each definition's content stands, with its map; inserts of what is on its own path carry an issue."""
    rows = _places(spark, sf_dir)
    return rows.select("space", "path", "names", "node", "issue", *[(F.round(F.col("m")[k], 6) + F.lit(0.0)).alias(k) for k in ("a", "b", "tx", "ty")])


@query(_WALK + _THINGS + f""", t AS (SELECT *, (0.3::DOUBLE + 0.7::DOUBLE * (key % 9)) AS turn FROM placed WHERE key % 13 <> 0), v AS (SELECT *, a * cos(turn) + b * sin(turn) AS vx, c * cos(turn) + d * sin(turn) AS vy FROM t)
SELECT record_key, CASE WHEN key % 2 = 0 THEN 'DBText' ELSE 'MText' END AS entity_type, origin, words AS text, space, block_path, handle, round(a * x + b * y + tx, 6) AS x, round(c * x + d * y + ty, 6) AS y, round(turn, 6) AS local_rotation, round(atan2(vy, vx), 6) AS world_rotation, round(vx / sqrt(vx * vx + vy * vy), 6) AS axis_x, round(vy / sqrt(vx * vx + vy * vy), 6) AS axis_y, {_BOX} FROM v""")
def oriented_texts(spark, sf_dir):
    """Texts of all places with position, direction and bounds in the world; blank ones are left out."""
    texts = _things(spark, sf_dir).select("owner", "handle", F.when(F.col("key") % 2 == 0, "DBText").otherwise("MText").alias("entity_type"), F.when(F.col("key") % 13 == 0, " \t ").otherwise(F.col("words")).alias("text"), "x", "y", (0.3 + 0.7 * (F.col("key") % 9)).alias("rotation"), "bounds")
    rows = traversal.oriented_texts(_places(spark, sf_dir), texts)
    return rows.select("record_key", "entity_type", "origin", "text", "space", "block_path", "handle", *[F.round(c, 6).alias(c) for c in ("x", "y", "local_rotation", "world_rotation", "axis_x", "axis_y")], F.round("bounds.min_x", 6).alias("min_x"), F.round("bounds.max_y", 6).alias("max_y"), "bounds_valid")


@query(_WALK + _THINGS + f""", e AS (SELECT *, (['Arc', 'Circle', 'Hatch', 'Line', 'Polyline', 'Solid'])[key % 6 + 1] AS kind, 10 + key % 5 AS r, 0.2 AS a0, 1.7 + key % 3 AS a1 FROM placed),
g AS (SELECT *, kind = 'Arc' AS arc, kind = 'Line' AS line, x + r * cos(a0) AS sx, y + r * sin(a0) AS sy, x + r * cos(a0 + (a1 - a0) / 2) AS px, y + r * sin(a0 + (a1 - a0) / 2) AS py, x + r * cos(a1) AS ex, y + r * sin(a1) AS ey FROM e WHERE kind <> 'Solid')
SELECT record_key, kind AS entity_type, origin, root_handle, space, CASE WHEN arc THEN round(a * sx + b * sy + tx, 6) WHEN line THEN round(a * x + b * y + tx, 6) END AS start_x, CASE WHEN arc THEN round(c * ex + d * ey + ty, 6) WHEN line THEN round(c * (x + 4) + d * (y + 3) + ty, 6) END AS end_y,
CASE WHEN arc THEN round(a * px + b * py + tx, 6) END AS mid_x, CASE WHEN arc THEN round(c * px + d * py + ty, 6) END AS mid_y, CASE WHEN arc THEN round(a * x + b * y + tx, 6) END AS center_x, CASE WHEN arc THEN round(sqrt(pow(a * (sx - x) + b * (sy - y), 2) + pow(c * (sx - x) + d * (sy - y), 2)), 6) END AS radius,
arc OR line AS endpoints_valid, arc AS curve_geometry_valid, CASE WHEN kind = 'Polyline' THEN 3 ELSE 0 END::INT AS vertex_count, kind = 'Polyline' AND key % 4 = 0 AS closed, {_BOX} FROM g""")
def primitive_records(spark, sf_dir):
    """Arcs, circles, hatches, lines and polylines of all places; a class that is none of these is left out."""
    key, at = F.col("key"), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("Arc", "Circle", "Hatch", "Line", "Polyline", "Solid")]), (key % 6 + 1).cast("int"))
    here = at(F.col("x"), F.col("y"))
    entities = _things(spark, sf_dir).select("owner", "handle", kind.alias("entity_type"), here.alias("start"), at(F.col("x") + 4, F.col("y") + 3).alias("end"), here.alias("center"), (10 + key % 5).cast("double").alias("radius"), F.lit(0.2).alias("start_angle"), (1.7 + key % 3).alias("end_angle"), F.array(here, here, here).alias("vertices"), (key % 4 == 0).alias("closed"), "bounds")
    rows = traversal.primitives(_places(spark, sf_dir), entities)
    shown = {"start_x": "start.x", "end_y": "end.y", "mid_x": "mid.x", "mid_y": "mid.y", "center_x": "center.x", "radius": "radius", "min_x": "bounds.min_x", "max_y": "bounds.max_y"}
    return rows.select("record_key", "entity_type", "origin", "root_handle", "space", *[F.round(c, 6).alias(n) for n, c in shown.items()], "endpoints_valid", "curve_geometry_valid", "vertex_count", "closed", "bounds_valid")


@query(_WALK + """, d AS (SELECT owner AS node FROM inserts UNION SELECT target FROM inserts WHERE target IS NOT NULL UNION SELECT node FROM x UNION SELECT 'K5'),
n AS (SELECT node, count(*) AS n FROM x WHERE NOT stopped GROUP BY node UNION ALL SELECT 'K5', count(*) FROM x JOIN inserts i ON x.node = i.owner WHERE NOT x.stopped AND i.target = 'K5'),
u AS (SELECT target AS node, count(*) AS n_inserts FROM inserts WHERE target IS NOT NULL GROUP BY target)
SELECT d.node, coalesce(n.n, 0)::BIGINT AS n, coalesce(u.n_inserts, 0)::BIGINT AS n_inserts, coalesce(n.n, 0) > 0 AS reachable, u.n_inserts IS NULL AND d.node NOT LIKE 'L%' AS unused, d.node = 'K5' AS is_external FROM d LEFT JOIN n USING (node) LEFT JOIN u USING (node)""")
def definition_counts(spark, sf_dir):
    """How often each definition's content stands in the spaces, counted without listing paths; what is reachable, unused, external."""
    rows = traversal.occurrences(_inserts(spark, sf_dir), _spaces(spark, sf_dir), _external(spark, sf_dir))
    return rows.select("node", F.col("n").cast("bigint").alias("n"), F.col("n_inserts").cast("bigint").alias("n_inserts"), "reachable", "unused", "is_external")
