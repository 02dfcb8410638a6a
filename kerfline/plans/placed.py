"""Registered queries of joins by place and of order, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lineage, ordering, spatial
from ..sources import documents
from .registry import query, table

_INSIDE = "list_count(list_filter(range(3), lambda i: CASE WHEN i = 0 THEN (v0y > y) <> (v1y > y) AND x < (v1x - v0x) * (y - v0y) / (v1y - v0y) + v0x WHEN i = 1 THEN (v1y > y) <> (v2y > y) AND x < (v2x - v1x) * (y - v1y) / (v2y - v1y) + v1x ELSE (v2y > y) <> (v0y > y) AND x < (v0x - v2x) * (y - v2y) / (v0y - v2y) + v2x END)) % 2 = 1"


@query(f"""WITH v AS (SELECT s_suppkey, s_nationkey, s_suppkey % 11 = 1 AS paper, s_suppkey % 7 <> 0 AS is_on, s_suppkey % 13 = 0 AS off, 0.1 * (s_suppkey % 9) AS twist, s_acctbal AS tx, (s_nationkey * 40)::DOUBLE AS ty, pow(2, s_suppkey % 6) * 3 AS h, pow(2, s_suppkey % 6) * 3 * (1 + s_suppkey % 3) / 2 AS w FROM supplier),
w AS (SELECT *, tx - 2 * w AS v0x, ty - 2 * w AS v0y, tx + 2 * w AS v1x, ty - w AS v1y, tx AS v2x, ty + 2 * w AS v2y FROM v WHERE NOT paper AND is_on AND NOT off),
p AS (SELECT c_custkey, c_acctbal AS x, (c_custkey % 1000)::DOUBLE AS y, c_nationkey FROM customer),
m AS (SELECT * FROM p JOIN w ON c_nationkey <> s_nationkey AND abs(cos(twist) * (x - tx) - sin(twist) * (y - ty) - 1) <= w / 2 AND abs(sin(twist) * (x - tx) + cos(twist) * (y - ty)) <= h / 2 WHERE s_suppkey % 4 <> 0 OR {_INSIDE})
SELECT c_custkey, count(*) AS windows, min(s_suppkey) AS first_window FROM m GROUP BY c_custkey""")
def turned_viewports(spark, sf_dir):
    """Points that viewports show, which are turned, clipped, frozen for a layer or off, and differ in size; each point once."""
    key, size = F.col("s_suppkey"), F.pow(F.lit(2.0), F.col("s_suppkey") % 6) * 3
    x, y = F.col("s_acctbal"), (F.col("s_nationkey") * 40).cast("double")
    wide = size * (1 + key % 3) / 2
    corner = lambda dx, dy: F.struct((x + dx * wide).alias("x"), (y + dy * wide).alias("y"))
    clip = F.when(key % 4 == 0, F.array(corner(-2, -2), corner(2, -1), corner(0, 2)))
    zero, one = F.lit(0.0), F.lit(1.0)
    views = table(spark, sf_dir, "supplier").select(key.alias("handle"), (key % 11 == 1).alias("is_paper_viewport"), (key % 7 != 0).alias("on"), F.lit(True).alias("entity_visible"), (key % 13 == 0).alias("layer_off"), (1.0 + key % 3).alias("paper_width"), F.lit(2.0).alias("paper_height"), one.alias("view_center_x"), zero.alias("view_center_y"), x.alias("view_target_x"), y.alias("view_target_y"), size.alias("view_height"), (0.1 * (key % 9)).alias("twist_angle"), zero.alias("view_direction_x"), zero.alias("view_direction_y"), one.alias("view_direction_z"), F.array(F.col("s_nationkey").cast("string")).alias("frozen_layers"), clip.alias("clip"))
    points = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_acctbal AS x", "CAST(c_custkey % 1000 AS DOUBLE) AS y", "CAST(c_nationkey AS STRING) AS layer")
    windows = spatial.once(spatial.windows_of_viewports(views), "name", "one_window")
    shown = spatial.in_turned_windows(spatial.once(points, "c_custkey", "one_point"), windows, "x", "y", "layer")
    return spatial.seen_once(shown, "c_custkey", sure=F.col("one_window") & F.col("one_point"))


@query("""WITH i AS (SELECT p_partkey, p_retailprice * 20 + CASE WHEN p_partkey % 2 = 0 THEN p_size * pow(2, p_partkey % 5) / 8 ELSE 0 END AS a, p_retailprice * 20 + CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE p_size * pow(2, p_partkey % 5) / 8 END AS b FROM part),
w AS (SELECT p_partkey, least(a, b) - 1 AS lo, greatest(a, b) + 1 AS hi FROM i)
SELECT p_partkey, count(*) AS n, sum(l_orderkey)::BIGINT AS orders FROM lineitem JOIN w ON l_extendedprice >= lo AND l_extendedprice <= hi WHERE l_extendedprice + l_tax <= hi GROUP BY p_partkey""")
def intervals_as_rows(spark, sf_dir):
    """Line items whose span of price and tax lies in an interval that a part makes, give or take 1."""
    at, size = F.col("p_retailprice") * 20, F.col("p_size") * F.pow(F.lit(2.0), F.col("p_partkey") % 5) / 8
    even = F.col("p_partkey") % 2 == 0
    intervals = table(spark, sf_dir, "part").select("p_partkey", (at + F.when(even, size).otherwise(0)).alias("a"), (at + F.when(even, 0).otherwise(size)).alias("b"))
    spans = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("low"), (F.col("l_extendedprice") + F.col("l_tax")).alias("high"))
    return spatial.interval_totals(spans, intervals, "low", "high", "a", "b", "l_orderkey", 1.0).select("p_partkey", "n", F.col("total").alias("orders"))


@query("""WITH a AS (SELECT s_nationkey AS g, s_suppkey::VARCHAR AS name, s_acctbal AS pos FROM supplier WHERE s_suppkey % 3 <> 0),
o AS (SELECT *, coalesce(pos - lag(pos) OVER w, lead(pos) OVER w - pos) AS outer_gap FROM a WINDOW w AS (PARTITION BY g ORDER BY pos, name)),
u AS (SELECT g, pos, 0 AS kind, name AS tie, name, outer_gap, NULL AS k FROM o UNION ALL SELECT c_nationkey, c_acctbal, 1, c_custkey::VARCHAR, NULL, NULL, c_custkey FROM customer),
f AS (SELECT *, last_value(CASE WHEN kind = 0 THEN {'name': name, 'pos': pos, 'gap': outer_gap} END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
 first_value(CASE WHEN kind = 0 THEN {'name': name, 'pos': pos, 'gap': outer_gap} END IGNORE NULLS) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS a FROM u WINDOW w AS (PARTITION BY g ORDER BY pos, kind, tie)),
r AS (SELECT k, g, b.name AS before, a.name AS after, CASE WHEN b IS NOT NULL AND a IS NOT NULL THEN (pos - b.pos) / nullif(a.pos - b.pos, 0) WHEN b IS NOT NULL THEN (pos - b.pos) / CASE WHEN b.gap > 0 THEN b.gap END WHEN a IS NOT NULL THEN (a.pos - pos) / CASE WHEN a.gap > 0 THEN a.gap END END AS ratio FROM f WHERE kind = 1)
SELECT k AS c_custkey, g AS nation, before, after, round(ratio, 6) AS ratio, CASE WHEN before IS NOT NULL AND after IS NOT NULL THEN before || '-' || after WHEN ratio <= 0.25 AND before IS NOT NULL THEN before || '>OUT' WHEN ratio <= 0.25 AND after IS NOT NULL THEN after || '<OUT' END AS place FROM r""")
def axis_places(spark, sf_dir):
    """Between which two axes of its nation each customer lies, or how far outside of them."""
    axes = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").selectExpr("s_nationkey AS nation", "CAST(s_suppkey AS STRING) AS axis", "s_acctbal AS at")
    points = table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nation", "c_custkey", "c_acctbal")
    rows = spatial.between_axes(points, axes, "nation", "c_custkey", "c_acctbal", "axis", "at")
    return rows.select("c_custkey", "nation", "before", "after", F.round("ratio", 6).alias("ratio"), F.regexp_replace("place", "@.*$", "").alias("place"))


@query("""WITH RECURSIVE i AS (SELECT o_orderkey AS k, o_orderpriority AS name, (o_custkey % 40) + 0.004 * (o_orderkey % 3) AS x, (o_custkey % 60) + 0.004 * (o_orderkey % 2) AS y FROM orders),
d AS (SELECT name, x, y, min(k) AS node, count(*) AS n FROM i GROUP BY name, x, y), e AS (SELECT a.node AS p, b.node AS q FROM d a JOIN d b ON a.name = b.name AND abs(a.x - b.x) <= 0.005 AND abs(a.y - b.y) <= 0.005),
r AS (SELECT p, q FROM e UNION SELECT r.p, e.q FROM r JOIN e ON r.q = e.p), g AS (SELECT p AS node, min(q) AS group_key FROM r GROUP BY p),
s AS (SELECT group_key, sum(n)::BIGINT AS n FROM g JOIN d USING (node) GROUP BY group_key)
SELECT i.k AS o_orderkey, g.group_key, s.n FROM i JOIN d ON i.name = d.name AND i.x = d.x AND i.y = d.y JOIN g ON g.node = d.node JOIN s USING (group_key)""")
def coincident_instances(spark, sf_dir):
    """Instances of one name whose places agree within a tolerance, also by way of others."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("name"), (F.col("o_custkey") % 40 + 0.004 * (F.col("o_orderkey") % 3)).alias("x"), (F.col("o_custkey") % 60 + 0.004 * (F.col("o_orderkey") % 2)).alias("y"))
    return spatial.coincident(rows, "o_orderkey", ["name"], ["x", "y"], 0.005)


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY lower(o_orderpriority), o_orderkey, o_orderstatus) AS place, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS of_customer FROM orders""")
def handle_ranks(spark, sf_dir):
    """The place of each record by name without regard to case and by its hexadecimal handle, in all and in its owner."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.lower("o_orderpriority").alias("name"), F.lower(F.hex("o_orderkey")).alias("handle"))
    rows = rows.withColumns({"digits": ordering.handle_order("handle")[0], "text": ordering.handle_order("handle")[1]})
    every = ordering.ranked(rows, ["name", "digits", "text", "o_orderstatus"], "place")
    return ordering.ranked(every, ["digits", "text"], "of_customer", within=["o_custkey"]).select("o_orderkey", "place", "of_customer")


@query("""WITH v AS (SELECT s_suppkey, s_nationkey FROM supplier), l AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer)
SELECT 'records' AS list, n_name AS drawing, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS ordinal, c_custkey::VARCHAR AS key, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS amount FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'layers', n_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1, c_mktsegment, NULL FROM l JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'layouts', n_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1, 'L' || s_suppkey, s_suppkey % 5 FROM v JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 2 = 0
UNION ALL SELECT 'viewports', n_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1, CASE WHEN s_suppkey % 2 = 0 THEN 'L' || s_suppkey ELSE '' END, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey % 5 ELSE -1 END FROM v JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'header', n_name, n_nationkey, 'a "quoted" path' || chr(92) || n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) FROM nation""")
def document_round_trip(spark, sf_dir):
    """Documents of each nation with a header and four arrays, written to the shared folder and scanned again."""
    nation, customer, supplier = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    named = lambda df, of: df.join(nation.select(F.col("n_nationkey").alias(of), F.col("n_name").alias("drawing")), of)
    sizes = customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("record_count"))
    header = nation.join(sizes, "n_nationkey", "left").select(F.col("n_name").alias("drawing"), F.concat(F.lit('a "quoted" path\\'), "n_name").alias("path"), F.col("n_nationkey").alias("number"), F.coalesce("record_count", F.lit(0)).alias("record_count"))
    amount = F.when(F.col("c_custkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    layouts = supplier.where("s_suppkey % 2 = 0").selectExpr("s_nationkey", "s_suppkey", "concat('S', s_suppkey) AS space_record_handle", "concat('L', s_suppkey) AS layout_name", "hex(s_suppkey) AS layout_handle", "CAST(s_suppkey % 5 AS INT) AS tab_order")
    viewports = supplier.selectExpr("s_nationkey", "s_suppkey", "concat('S', s_suppkey) AS space_record_handle")
    arrays = {
        "records": (named(customer.select("c_nationkey", "c_custkey", amount.alias("amount")), "c_nationkey").drop("c_nationkey"), ["c_custkey"]),
        "layers": (named(customer.select("c_nationkey", F.col("c_mktsegment").alias("name")).distinct(), "c_nationkey").drop("c_nationkey"), ["name"]),
        "layouts": (named(layouts, "s_nationkey").drop("s_nationkey"), ["s_suppkey"]),
        "viewports": (named(documents.layouts_of(viewports, layouts), "s_nationkey").drop("s_nationkey"), ["s_suppkey"]),
    }
    folder = lineage.new_path(spark)
    documents.write_documents(header, arrays, folder, "cad_visibility_export_v13")
    path = f"{folder}/*.cad_visibility_export_v13.json"
    scanned = documents.scan(spark, path)
    heads = documents.read_header(spark, path, "drawing string, path string, number long, record_count long", scanned)
    out = heads.select(F.lit("header").alias("list"), "drawing", F.col("number").alias("ordinal"), F.col("path").alias("key"), F.col("record_count").cast("double").alias("amount"))
    fields = {"records": ("c_custkey string, amount double", "c_custkey", "amount"), "layers": ("name string", "name", "CAST(NULL AS DOUBLE)"), "layouts": ("layout_name string, tab_order int", "layout_name", "CAST(tab_order AS DOUBLE)"), "viewports": ("layout_name string, layout_tab_order int", "layout_name", "CAST(layout_tab_order AS DOUBLE)")}
    of_file = heads.select("file", "drawing")
    for name, (schema, key, value) in fields.items():
        rows = documents.read_array(spark, path, name, schema, scanned).join(of_file, "file")
        out = out.union(rows.selectExpr(f"'{name}' AS list", "drawing", "ordinal", f"{key} AS key", f"{value} AS amount"))
    return out
