"""The registered queries of comparisons and hierarchies, and the SQL that each is held against; those of records are in records.py and projected.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, scalar
from ..operators import diff, hierarchy, ordering, rules
from ..sources import exports
from . import compared, placed, projected, records, scanned, traversed  # noqa: F401  register their queries
from .registry import QUERIES, SQL, TABLES, query, table

def edited_lineitem(spark, sf_dir):
    """A second export: some keys gone, some prices off by a cent."""
    rows = table(spark, sf_dir, "lineitem").where("l_orderkey % 101 <> 0")
    return rows.withColumn("l_extendedprice", F.expr("l_extendedprice + CASE WHEN l_orderkey % 97 = 0 THEN 0.01 ELSE 0.0 END"))


def edited_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderkey % 101 <> 0")
    return rows.withColumn("o_totalprice", F.expr("o_totalprice + CASE WHEN o_orderkey % 97 = 0 THEN 0.01D ELSE 0D END"))


_BAG = """
WITH l AS (SELECT l_orderkey, l_linenumber, round_even(l_extendedprice / 0.001, 0) AS p, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT l_orderkey, l_linenumber, round_even((l_extendedprice + CASE WHEN l_orderkey % 97 = 0 THEN 0.01 ELSE 0 END) / 0.001, 0) AS p, count(*) AS n FROM lineitem WHERE l_orderkey % 101 <> 0 GROUP BY ALL),
b AS (SELECT coalesce(l.n, 0) AS l, coalesce(r.n, 0) AS r FROM l FULL JOIN r USING (l_orderkey, l_linenumber, p))
SELECT sum(l)::BIGINT AS left_count, sum(r)::BIGINT AS right_count, sum(least(l, r))::BIGINT AS matched, sum(greatest(l - r, 0))::BIGINT AS left_only, sum(greatest(r - l, 0))::BIGINT AS right_only FROM b"""


@query(_BAG)
def bag_diff_lineitem(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    return diff.bag_diff(table(spark, sf_dir, "lineitem"), edited_lineitem(spark, sf_dir), keys, 0.001)


_KEYED_ROWS = """
WITH l AS (SELECT o_orderkey AS key, o_orderstatus AS s, round_even(o_totalprice / 0.001, 0) AS p FROM orders),
r AS (SELECT o_orderkey AS key, o_orderstatus AS s, round_even((o_totalprice + CASE WHEN o_orderkey % 97 = 0 THEN 0.01 ELSE 0 END) / 0.001, 0) AS p FROM orders WHERE o_orderkey % 101 <> 0),
d AS (SELECT coalesce(l.key, r.key) AS key, l.key IS NULL AS ro, r.key IS NULL AS lo,
      concat_ws(',', CASE WHEN l.s IS DISTINCT FROM r.s THEN 'o_orderstatus' END, CASE WHEN l.p IS DISTINCT FROM r.p THEN 'o_totalprice' END) AS f FROM l FULL JOIN r ON l.key = r.key)"""


@query(_KEYED_ROWS + """
SELECT count_if(NOT ro)::BIGINT AS left_count, count_if(NOT lo)::BIGINT AS right_count, count_if(lo)::BIGINT AS left_only, count_if(ro)::BIGINT AS right_only, count_if(NOT lo AND NOT ro)::BIGINT AS common,
       count_if(NOT lo AND NOT ro AND f = '')::BIGINT AS matched, count_if(NOT lo AND NOT ro AND f <> '')::BIGINT AS mismatched, 0::BIGINT AS repeated_keys, count_if(lo OR ro OR f <> '') = 0 AS consistent FROM d""")
def keyed_diff_orders(spark, sf_dir):
    return diff.keyed_diff(table(spark, sf_dir, "orders"), edited_orders(spark, sf_dir), "o_orderkey", ["o_orderstatus", "o_totalprice"], 0.001)


@query(_KEYED_ROWS + " SELECT key::VARCHAR AS key, f AS fields FROM d WHERE NOT lo AND NOT ro AND f <> '' ORDER BY 1 LIMIT 5")
def keyed_diff_examples(spark, sf_dir):
    return diff.examples(table(spark, sf_dir, "orders"), edited_orders(spark, sf_dir), "o_orderkey", ["o_orderstatus", "o_totalprice"], 0.001)


@query("""
WITH rows_of AS (SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'None' ELSE l_orderkey::VARCHAR END AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, round_even(l_extendedprice / 0.001, 0) AS v FROM lineitem),
l AS (SELECT k, count(*) AS c, max({'n': n, 'p': p, 's': s, 'v': v}) AS r FROM rows_of GROUP BY k),
r AS (SELECT k, count(*) AS c, max({'n': n, 'p': p, 's': s, 'v': v}) AS r FROM rows_of WHERE n < 6 GROUP BY k)
SELECT sum(l.c)::BIGINT AS left_count, coalesce(sum(r.c), 0)::BIGINT AS right_count, count_if(r.k IS NULL)::BIGINT AS left_only, count_if(l.k IS NULL)::BIGINT AS right_only, count_if(l.k IS NOT NULL AND r.k IS NOT NULL)::BIGINT AS common,
       count_if(l.r.n = r.r.n AND l.r.v = r.r.v)::BIGINT AS matched, count_if(l.r.n <> r.r.n OR l.r.v <> r.r.v)::BIGINT AS mismatched, count_if(l.c > 1 OR r.c > 1)::BIGINT AS repeated_keys, false AS consistent
FROM l FULL JOIN r ON l.k = r.k""")
def keyed_diff_duplicates(spark, sf_dir):
    """Many rows a key and null keys: the last one stands for each, and the sides are not consistent."""
    rows = table(spark, sf_dir, "lineitem").withColumn("key", F.expr("CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END"))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return diff.keyed_diff(rows, rows.where("l_linenumber < 6"), "key", ["l_linenumber", "l_extendedprice"], 0.001, order)


@query("""SELECT k AS key, n AS l_linenumber, p AS l_partkey FROM (SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'None' ELSE l_orderkey::VARCHAR END AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem) x
QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, p DESC, s DESC) = 1""")
def last_records(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("key", F.expr("CASE WHEN l_orderkey % 50 <> 0 THEN l_orderkey END"))
    return diff.last_of(rows, "key", ["l_linenumber", "l_partkey", "l_suppkey"]).select("key", "l_linenumber", "l_partkey")


@query("WITH bag AS (" + _BAG + "), keyed AS (" + _KEYED_ROWS + """ SELECT count_if(lo)::BIGINT AS a, count_if(ro)::BIGINT AS b, count_if(NOT lo AND NOT ro AND f = '')::BIGINT AS c FROM d)
SELECT 'lineitem_bag' AS comparison, matched, left_only, right_only, CASE WHEN left_only + right_only = 0 THEN 'consistent' ELSE 'unresolved' END AS status, false AS absence_proven FROM bag
UNION ALL SELECT 'orders_keyed', c, a, b, CASE WHEN a + b = 0 AND c = (SELECT count(*) FROM orders) THEN 'consistent' ELSE 'unresolved' END, false FROM keyed
UNION ALL SELECT 'nation_bag', count(*), 0, 0, 'consistent', false FROM nation""")
def compare_summary(spark, sf_dir):
    bag = bag_diff_lineitem(spark, sf_dir).select(F.lit("lineitem_bag").alias("comparison"), "matched", "left_only", "right_only", F.lit(0).alias("mismatched"))
    keyed = keyed_diff_orders(spark, sf_dir).select(F.lit("orders_keyed").alias("comparison"), "matched", "left_only", "right_only", "mismatched")
    nation = table(spark, sf_dir, "nation")
    same = diff.bag_diff(nation, nation, nation.columns).select(F.lit("nation_bag").alias("comparison"), "matched", "left_only", "right_only", F.lit(0).alias("mismatched"))
    rows = diff.union_all([bag, keyed, same])
    return rows.selectExpr("comparison", "matched", "left_only", "right_only", "CASE WHEN left_only + right_only + mismatched = 0 THEN 'consistent' ELSE 'unresolved' END AS status", "false AS absence_proven")


def geography(spark, sf_dir):
    """Edges region -> nation -> customer -> order, with the child's own flags and layer."""
    nation, customer, orders = (table(spark, sf_dir, t) for t in ("nation", "customer", "orders"))
    a = nation.selectExpr("concat('R', n_regionkey) AS parent", "concat('N', n_nationkey) AS child", "n_nationkey % 7 <> 0 AS visible", "n_nationkey % 5 <> 0 AS plottable", "CASE WHEN n_nationkey % 3 = 0 THEN '0' ELSE n_name END AS layer")
    b = customer.selectExpr("concat('N', c_nationkey) AS parent", "concat('C', c_custkey) AS child", "c_acctbal >= 0 AS visible", "c_custkey % 4 <> 0 AS plottable", "CASE WHEN c_custkey % 2 = 0 THEN '0' WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS layer")
    c = orders.selectExpr("concat('C', o_custkey) AS parent", "concat('O', o_orderkey) AS child", "o_orderstatus <> 'P' AS visible", "true AS plottable", "CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE o_orderpriority END AS layer")
    return a.unionByName(b).unionByName(c)


_GEO = """
WITH RECURSIVE edges AS (SELECT 'R' || n_regionkey AS parent, 'N' || n_nationkey AS child, n_nationkey % 7 <> 0 AS visible, n_nationkey % 5 <> 0 AS plottable, CASE WHEN n_nationkey % 3 = 0 THEN '0' ELSE n_name END AS layer FROM nation
 UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey, c_acctbal >= 0, c_custkey % 4 <> 0, CASE WHEN c_custkey % 2 = 0 THEN '0' WHEN c_custkey % 11 <> 0 THEN c_mktsegment END FROM customer
 UNION ALL SELECT 'C' || o_custkey, 'O' || o_orderkey, o_orderstatus <> 'P', true, CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE o_orderpriority END FROM orders),
x AS (SELECT 'R' || r_regionkey AS node, 'R' || r_regionkey AS path, 0 AS depth, r_regionkey <> 1 AS visible, true AS plottable, r_regionkey <> 1 AS own, true AS above, r_name AS layer, r_name AS own_layer FROM region
 UNION ALL SELECT e.child, x.path || '/' || e.child, x.depth + 1, x.visible AND e.visible, x.plottable AND e.plottable, e.visible, x.visible, CASE WHEN e.layer = '0' AND x.layer IS NOT NULL THEN x.layer ELSE e.layer END, e.layer FROM x JOIN edges e ON x.node = e.parent)"""


def _expanded(spark, sf_dir, where: str = "true"):
    roots = table(spark, sf_dir, "region").where(where).selectExpr("concat('R', r_regionkey) AS node", "r_regionkey <> 1 AS visible", "true AS plottable", "r_regionkey <> 1 AS own", "true AS above", "r_name AS layer", "r_name AS own_layer")
    carry = {**hierarchy.inherited_flags("visible", "plottable"), "own": F.col("e.visible"), "above": F.col("p.visible"), "layer": hierarchy.inherited_layer(F.col("e.layer"), F.col("p.layer")), "own_layer": F.col("e.layer")}
    return hierarchy.expand(geography(spark, sf_dir), roots, carry).withColumn("path", F.array_join("path", "/"))


@query(_GEO + " SELECT path, depth FROM x")
def expand_geo_paths(spark, sf_dir):
    return _expanded(spark, sf_dir).select("path", "depth")


@query(_GEO + " SELECT path, layer AS effective_layer, own_layer = '0' AS inherits FROM x")
def inherit_layer_zero(spark, sf_dir):
    return _expanded(spark, sf_dir).selectExpr("path", "layer AS effective_layer", "own_layer = '0' AS inherits")


@query(_GEO + """ SELECT path, visible AS effective_visible, plottable AS effective_plottable,
CASE WHEN visible THEN 'visible' ELSE concat_ws(';', CASE WHEN NOT own THEN 'entity_hidden' END, CASE WHEN NOT above THEN 'parent_hidden' END) END AS reason FROM x""")
def inherit_visibility(spark, sf_dir):
    reason = scalar.reasons((~F.col("own"), "entity_hidden"), (~F.col("above"), "parent_hidden"), default="visible")
    return _expanded(spark, sf_dir).select("path", F.col("visible").alias("effective_visible"), F.col("plottable").alias("effective_plottable"), reason.alias("reason"))


@query(_GEO + " SELECT depth, count(*) AS occurrences, count(DISTINCT layer) AS layers FROM x WHERE path LIKE 'R2%' GROUP BY depth")
def fanout_expand(spark, sf_dir):
    """Only what one root holds: the filter is put before the expansion."""
    return _expanded(spark, sf_dir, "r_regionkey = 2").groupBy("depth").agg(F.count("*").alias("occurrences"), F.count_distinct("layer").alias("layers"))


@query(_GEO + """, cut AS (SELECT path, depth, CASE WHEN depth = 2 AND EXISTS (SELECT 1 FROM edges WHERE parent = x.node) THEN 'depth' END AS issue FROM x WHERE depth <= 2)
SELECT issue, count(*) AS n FROM cut GROUP BY issue""")
def expand_depth_issues(spark, sf_dir):
    """Occurrences that a limit of depth leaves unexpanded carry an issue."""
    roots = table(spark, sf_dir, "region").selectExpr("concat('R', r_regionkey) AS node")
    return hierarchy.expand(geography(spark, sf_dir), roots, max_depth=2, at_depth="issue").groupBy("issue").agg(F.count("*").alias("n"))


_ALL_PARTS = "WITH RECURSIVE edges AS (SELECT p_partkey AS parent, (p_partkey * 7) % (SELECT count(*) FROM part) AS child FROM part), "


def _part_links(spark, sf_dir):
    """Edges of the whole part table, modulo its size; as roots all parts of one brand; and the size."""
    part = table(spark, sf_dir, "part")
    size = part.count()
    return part.selectExpr("p_partkey AS parent", f"(p_partkey * 7) % {size} AS child"), part.where("p_brand = 'Brand#7'").selectExpr("p_partkey AS node"), size


@query(_ALL_PARTS + """x AS (SELECT p_partkey AS node, [p_partkey] AS path, false AS stopped FROM part WHERE p_brand = 'Brand#7'
 UNION ALL SELECT e.child, list_append(x.path, e.child), list_contains(x.path, e.child) FROM x JOIN edges e ON x.node = e.parent WHERE NOT x.stopped)
SELECT node, array_to_string(path, '/') AS path, stopped FROM x""")
def expand_instances_cycle(spark, sf_dir):
    edges, roots, _ = _part_links(spark, sf_dir)
    return hierarchy.simple_path_texts(edges, roots)


_REACH_PARTS = _ALL_PARTS + "x AS (SELECT p_partkey AS node FROM part WHERE p_brand = 'Brand#7' UNION SELECT e.child FROM x JOIN edges e ON x.node = e.parent)"


@query(_REACH_PARTS + " SELECT node FROM x")
def reachable_nodes(spark, sf_dir):
    edges, roots, size = _part_links(spark, sf_dir)
    return hierarchy.reachable(edges, roots, max_rounds=size + 1)


@query(_REACH_PARTS + " SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_partkey IN (SELECT node FROM x) GROUP BY l_partkey")
def reachable_content(spark, sf_dir):
    nodes = reachable_nodes(spark, sf_dir)
    return table(spark, sf_dir, "lineitem").join(nodes, F.col("l_partkey") == nodes["node"], "left_semi").groupBy("l_partkey").agg(F.count("*").alias("n"))


@query("""SELECT vec_id, i.rule FROM (SELECT vec_id, unnest([CASE WHEN len(embedding) <> 64 THEN 'length' END, CASE WHEN embedding[1] > 0.2 THEN 'first_large' END, CASE WHEN label = 3 THEN 'label_three' END]) AS rule FROM embeddings) i WHERE i.rule IS NOT NULL""")
def rule_violations(spark, sf_dir):
    return rules.run_rules(table(spark, sf_dir, "embeddings"), "vec_id", [("length", F.size("embedding") != 64), ("first_large", F.col("embedding")[0] > F.lit(0.2).cast("double")), ("label_three", F.col("label") == 3)])


@query("SELECT user_id, min_by(event_type, event_id) FILTER (WHERE value > 50) AS selected FROM events GROUP BY user_id")
def first_success(spark, sf_dir):
    return rules.first_success(table(spark, sf_dir, "events"), "user_id", "event_id", "event_type", F.col("value") > 50)


@query("SELECT CASE WHEN l_discount > 0.08 THEN 'conflict' WHEN l_tax > 0.06 THEN 'candidate' WHEN l_quantity > 40 THEN 'confirmed' ELSE 'insufficient' END AS status, count(*) AS n FROM lineitem GROUP BY 1")
def decision_list(spark, sf_dir):
    status = rules.decide((F.col("l_discount") > 0.08, "conflict"), (F.col("l_tax") > 0.06, "candidate"), (F.col("l_quantity") > 40, "confirmed"), default="insufficient")
    return table(spark, sf_dir, "lineitem").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


_M = "0.8660254037844387 * {x} - 0.5 * {y} + 100"
_N = "0.5 * {x} + 0.8660254037844387 * {y} + 200"


@query(f"""SELECT p_partkey, round(x, 6) AS x, round(y, 6) AS y, round(2 * x - y, 6) AS chained_x, round(x + 3 * y, 6) AS chained_y FROM
(SELECT p_partkey, {_M.format(x='p_size', y='p_retailprice')} AS x, {_N.format(x='p_size', y='p_retailprice')} AS y FROM part) p""")
def affine_points(spark, sf_dir):
    m, outer = geometry.matrix(0.8660254037844387, -0.5, 0.5, 0.8660254037844387, 100, 200), geometry.matrix(2, -1, 1, 3, 0, 0)
    at = F.col("p_size").cast("double"), F.col("p_retailprice")
    (x, y), (u, v) = geometry.point(m, *at), geometry.through([m, outer], *at)
    return table(spark, sf_dir, "part").select("p_partkey", *[F.round(c, 6).alias(n) for c, n in ((x, "x"), (y, "y"), (u, "chained_x"), (v, "chained_y"))])


@query("SELECT vec_id, round(atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE), 9) AS signed, round(CASE WHEN atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE) < 0 THEN atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE) + 2 * pi() ELSE atan2(embedding[2]::DOUBLE, embedding[1]::DOUBLE) END, 9) AS positive FROM embeddings")
def rotation_norm(spark, sf_dir):
    dx, dy = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    m = geometry.matrix(dx, -dy, dy, dx, 0, 0)  # turns by the angle of (dx, dy), and stretches
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(geometry.turned(m, F.lit(0.0)), 9).alias("signed"), F.round(geometry.turned(m, F.lit(0.0), True), 9).alias("positive"))


@query("SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha256")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query("SELECT c_custkey, c_nationkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY sha256(c_custkey::VARCHAR)) <= 1 + c_nationkey % 3")
def stratified_sample(spark, sf_dir):
    return ordering.stratified(table(spark, sf_dir, "customer"), "c_nationkey", "c_custkey", 1 + F.col("c_nationkey") % 3).select("c_custkey", "c_nationkey")


@query("""SELECT list_sort(list_distinct(list_concat(['r_regionkey', 'r_name'], ['n_nationkey', 'n_name', 'r_regionkey'])))[1] AS first_column, count(*) AS n, count(n_name) AS named FROM
(SELECT r_regionkey, r_name, NULL AS n_nationkey, NULL AS n_name FROM region UNION ALL SELECT n_regionkey, NULL, n_nationkey, n_name FROM nation) u""")
def schema_union(spark, sf_dir):
    """Rows of both sides under the union of their columns; what one lacks is null."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    columns = diff.common_columns(region, nation, "")
    rows = diff.union_all([region, nation]).select(*columns)
    return rows.agg(F.lit(columns[0]).alias("first_column"), F.count("*").alias("n"), F.count("n_name").alias("named"))


@query("SELECT CASE WHEN event_id % 11 = 0 THEN 'non_finite' ELSE round_even(value / 0.5, 0)::BIGINT::VARCHAR END AS signature, count(*) AS n FROM events WHERE event_id % 13 <> 0 GROUP BY 1")
def bag_diff_null_signatures(spark, sf_dir):
    value = F.when(F.col("event_id") % 22 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("value"))
    signature = F.when(F.col("event_id") % 13 != 0, scalar.quantize_text(value, 0.5))  # records without one are not counted
    return diff.signature_counts(table(spark, sf_dir, "events"), signature)


@query()
def file_snapshot(spark, sf_dir):
    return exports.snapshot(spark, f"{sf_dir}/region.parquet").select("sha256", "bytes", "version")
