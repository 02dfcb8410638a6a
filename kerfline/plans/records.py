"""Registered queries of records: projections, lookups, summaries, order and gates, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import geometry, scalar
from ..operators import clearance, diff, gates, lookups, ordering, reconcile, rules, summaries
from .registry import query, table


@query("SELECT event_type AS type, count(*) AS n FROM events GROUP BY event_type")
def type_histogram(spark, sf_dir):
    return summaries.type_histogram(table(spark, sf_dir, "events"), "event_type")


@query("SELECT lower(t) AS type, arg_min(t, event_id) AS spelling, count(*) AS n FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END AS t FROM events) e GROUP BY ALL")
def histogram_ci(spark, sf_dir):
    mixed = table(spark, sf_dir, "events").withColumn("t", F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type")))
    return summaries.histogram_ci(mixed, "t", "event_id")


@query("SELECT lang, source, text, count(*) AS n, min(doc_id) AS first_doc_id, arg_min(n_chars, doc_id) AS first_n_chars FROM documents GROUP BY lang, source, text")
def text_fingerprint(spark, sf_dir):
    return summaries.text_fingerprint(table(spark, sf_dir, "documents"), ["lang", "source", "text"], ["doc_id", "n_chars"], "doc_id")


@query("""SELECT lower(o_orderstatus) AS name, CASE WHEN o_custkey % 4 = 0 THEN lower(o_orderpriority) ELSE lower(o_orderstatus) END AS effective, (o_custkey % 3)::VARCHAR AS layer,
count(*) FILTER (o_totalprice > 100000) AS layout_count, count(*) FILTER (o_totalprice <= 100000) AS definition_count FROM orders GROUP BY ALL""")
def block_fingerprint(spark, sf_dir):
    effective = F.when(F.col("o_custkey") % 4 == 0, F.col("o_orderpriority")).otherwise(F.lit(" "))
    return summaries.block_fingerprint(table(spark, sf_dir, "orders"), F.col("o_orderstatus"), effective, (F.col("o_custkey") % 3).cast("string"), F.col("o_totalprice") > 100000)


@query("SELECT string_agg(DISTINCT p_brand, ';' ORDER BY p_brand) AS brands FROM part")
def sorted_distinct(spark, sf_dir):
    brands = table(spark, sf_dir, "part").withColumn("b", F.when(F.col("p_partkey") % 2 == 0, F.lower("p_brand")).otherwise(F.col("p_brand")))
    found = summaries.distinct_ci(brands, "b")
    return found.agg(F.array_join(F.array_sort(F.collect_list(F.initcap("value"))), ";").alias("brands"))


@query("""WITH sizes AS (SELECT l_suppkey, max(l_extendedprice) - min(l_extendedprice) AS w, max(l_quantity) - min(l_quantity) AS h FROM lineitem GROUP BY l_suppkey),
text AS (SELECT *, rtrim(rtrim(printf('%.4f', CASE WHEN w < 1e-9 THEN 0 ELSE round_even(w / pow(10, floor(log10(w)) - 3), 0) * pow(10, floor(log10(w)) - 3) END), '0'), '.') AS ws,
 rtrim(rtrim(printf('%.4f', CASE WHEN h < 1e-9 THEN 0 ELSE round_even(h / pow(10, floor(log10(h)) - 3), 0) * pow(10, floor(log10(h)) - 3) END), '0'), '.') AS hs FROM sizes),
kinds AS (SELECT l_suppkey, string_agg(f || '=' || n, ';' ORDER BY f) AS k FROM (SELECT l_suppkey, l_returnflag || l_linestatus AS f, count(*) AS n FROM lineitem GROUP BY ALL) c GROUP BY l_suppkey)
SELECT l_suppkey, k || ';w=' || ws || ';h=' || hs AS signature FROM kinds JOIN text USING (l_suppkey)""")
def geometry_signature(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("kind", F.concat("l_returnflag", "l_linestatus"))
    return summaries.geometry_signature(rows, "l_suppkey", "kind", F.col("l_extendedprice"), F.col("l_quantity"))


_MESSAGES = "CASE event_id % 4 WHEN 0 THEN 'Unlisted object with DXF name ' || event_type || ' has been found at ' || user_id WHEN 1 THEN 'Entity in SortEntitiesTable ' || user_id WHEN 2 THEN 'Entry not found ' || event_type ELSE event_type END"


@query(f"""WITH m AS (SELECT event_id, {_MESSAGES} AS t FROM events),
g AS (SELECT *, CASE WHEN t LIKE 'Unlisted object with DXF name %' THEN split_part(t, ' has been', 1) WHEN t LIKE 'Entity in SortEntitiesTable %' THEN 'Entity in SortEntitiesTable not found' WHEN t LIKE 'Entry not found %' THEN 'Dictionary entry not found' ELSE t END AS grp FROM m),
e AS (SELECT grp, t, count(*) AS c, min(event_id) AS first FROM g GROUP BY grp, t), p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY first) AS place FROM e)
SELECT grp AS "group", sum(c)::BIGINT AS n, string_agg(t, '|' ORDER BY place) FILTER (place <= 3) AS examples FROM p GROUP BY grp""")
def diagnostic_groups(spark, sf_dir):
    messages = table(spark, sf_dir, "events").withColumn("t", F.expr(_MESSAGES))
    return summaries.diagnostic_groups(messages, "t", "event_id").withColumn("examples", F.array_join("examples", "|"))


@query("SELECT l_partkey, min(l_extendedprice) AS min_x, min(l_quantity) AS min_y, max(l_extendedprice) AS max_x, max(l_quantity) AS max_y FROM lineitem GROUP BY l_partkey")
def envelopes(spark, sf_dir):
    return summaries.envelopes(table(spark, sf_dir, "lineitem"), "l_partkey", F.col("l_extendedprice"), F.col("l_quantity"))


@query("""SELECT string_agg(s || '=' || n, ';' ORDER BY s) AS counts, sum(n)::BIGINT AS n, max(m)::BIGINT AS mismatches, max(d)::BIGINT AS different FROM
(SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL) a, (SELECT count(*) FILTER (abs(o_totalprice - 100000) > 1) AS m, count(DISTINCT o_custkey) AS d FROM orders) b""")
def status_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    counts = summaries.status_map(orders, "o_orderstatus").select(F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";").alias("counts"))
    numbers = summaries.counters(orders, {"mismatches": F.abs(F.col("o_totalprice") - 100000) > 1})
    return counts.join(numbers).join(orders.agg(F.count_distinct("o_custkey").alias("different")))  # one row each


@query("SELECT p_partkey, p_type FROM part WHERE p_type ILIKE '%e%' AND p_partkey % 3 <> 0")
def proxy_filter(spark, sf_dir):
    """Rows whose type names a thing in any case, and whose text is not blank."""
    part = table(spark, sf_dir, "part").withColumn("t", F.when(F.col("p_partkey") % 3 == 0, F.lit(" \t　")).otherwise(F.col("p_name")))
    return part.where(scalar.names(F.col("p_type"), "E") & scalar.non_blank(F.col("t"))).select("p_partkey", "p_type")


@query("SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '7[13]?$') AND (c_custkey % 2 = 0 OR regexp_matches(c_mktsegment, '^b', 'i'))")
def regex_roots(spark, sf_dir):
    """Roots for an expansion: by own name or effective name, and by handle."""
    effective = F.when(F.col("c_custkey") % 2 == 0, F.lit("BASE")).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").where(scalar.selected(F.lit("x"), effective, F.col("c_name"), "^b", "7[13]?$")).select("c_custkey", "c_name")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE EXISTS (SELECT 1 FROM (VALUES (0.0, 3.0), (22.0, 20.0), (49.0, 60.0)) AS b(lo, hi) WHERE l_quantity - 0.5 >= least(lo, hi) - 1 AND l_quantity + 0.5 <= greatest(lo, hi) + 1)")
def interval_containment(spark, sf_dir):
    intervals = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in ((0.0, 3.0), (22.0, 20.0), (49.0, 60.0))])
    return table(spark, sf_dir, "lineitem").where(lookups.within(F.col("l_quantity") - 0.5, F.col("l_quantity") + 0.5, intervals)).select("l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def semi_consumers(spark, sf_dir):
    return lookups.consumed(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'"), [("o_orderkey", "l_orderkey")]).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%')")
def anti_keys(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND o_orderpriority LIKE '1%'")
    return lookups.unmatched(table(spark, sf_dir, "customer"), urgent, "c_custkey", "o_custkey").select("c_custkey")


@query("""SELECT a.l_orderkey, a.l_linenumber FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber AND a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE a.l_quantity > 45 AND b.l_orderkey % 7 <> 0""")
def identity_join(spark, sf_dir):
    a = table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    b = table(spark, sf_dir, "lineitem").where("l_orderkey % 7 <> 0").withColumn("l_returnflag", F.lower("l_returnflag"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    return a.join(b, lookups.same_identity(a, b, keys, ["l_returnflag"])).select(a["l_orderkey"], a["l_linenumber"])


@query("""SELECT w.name, count(*) AS n, count(DISTINCT c_custkey) AS different FROM customer JOIN (VALUES ('left', -500.0, 2500.0, 0, 12, 5), ('both', 2000.0, 7500.0, 4, 20, 9)) AS w(name, x0, x1, y0, y1, frozen)
ON c_acctbal BETWEEN x0 AND x1 AND c_nationkey BETWEEN y0 AND y1 AND c_nationkey <> frozen GROUP BY ALL""")
def viewport_visibility(spark, sf_dir):
    """Points that the windows which are on show, layers frozen in a window left out."""
    windows = spark.createDataFrame([("left", -500.0, 2500.0, 0.0, 12.0, ["5"], True), ("both", 2000.0, 7500.0, 4.0, 20.0, ["9"], True), ("off", 0.0, 9999.0, 0.0, 24.0, [], False)], "name string, min_x double, max_x double, min_y double, max_y double, frozen array<string>, on boolean")
    points = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_acctbal AS x", "CAST(c_nationkey AS DOUBLE) AS y", "CAST(c_nationkey AS STRING) AS layer")
    return lookups.shown(points, windows, "x", "y", "layer", 1000.0).groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("c_custkey").alias("different"))


@query("SELECT s_suppkey, n_name AS nation, coalesce(r_name, '') AS region, coalesce(r_regionkey, -1) AS tab_order FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey <> 2")
def dimension_lookups(spark, sf_dir):
    nation = lookups.lookup(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation").withColumn("nation", F.col("n_name")), "s_nationkey", "n_nationkey", {"nation": "", "n_regionkey": -1})
    region = table(spark, sf_dir, "region").where("r_regionkey <> 2").selectExpr("r_regionkey", "r_name AS region", "r_regionkey AS tab_order")
    return lookups.lookup(nation, region, "n_regionkey", "r_regionkey", {"region": "", "tab_order": -1}).select("s_suppkey", "nation", "region", "tab_order")


@query("SELECT n_nationkey, coalesce(string_agg(s_name, ';' ORDER BY s_suppkey), '') AS names FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_suppkey % 3 = 0 GROUP BY n_nationkey")
def attributes_of(spark, sf_dir):
    rows = lookups.with_many(table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0"), "n_nationkey", "s_nationkey", ["s_name"], "s_suppkey", "attributes")
    return rows.select("n_nationkey", F.array_join(F.transform("attributes", lambda a: a["s_name"]), ";").alias("names"))


@query("SELECT o_orderkey, coalesce(c_name, '') AS c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 4 <> 0")
def beam_style_lookup(spark, sf_dir):
    return lookups.unique_lookup(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 4 <> 0"), "o_custkey", "c_custkey", {"c_name": ""}).select("o_orderkey", "c_name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 AND n_nationkey <> 5 THEN n_name ELSE c_mktsegment END AS reference FROM customer JOIN nation ON c_nationkey = n_nationkey")
def source_precedence(spark, sf_dir):
    rows = lookups.lookup(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").where("n_nationkey <> 5"), "c_nationkey", "n_nationkey", {"n_name": None})
    third = F.col("c_custkey") % 3
    return rows.select("c_custkey", scalar.first_known((third == 0, F.col("c_name")), (third == 1, F.col("n_name")), (F.lit(True), F.col("c_mktsegment"))).alias("reference"))


@query("""SELECT conv_id, count(*) AS attempts, count(*) FILTER (p < before) AS out_of_order FROM (SELECT conv_id, p, max(p) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
FROM (SELECT conv_id, turn, CASE role WHEN 'system' THEN 1 WHEN 'user' THEN 2 ELSE 3 END AS p FROM conversations) a) b GROUP BY conv_id""")
def route_order_check(spark, sf_dir):
    return ordering.out_of_order(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", ["system", "user"])


_CODE = "CASE WHEN p_partkey % 17 = 0 THEN 'MC0.0' ELSE 'AC' || (1000 + p_size) END"


@query(f"""SELECT p_partkey, r.release, CASE WHEN p_partkey % 17 = 0 THEN 'dwg_version_unrecognized' WHEN 1000 + p_size <= r.most THEN 'dwg_version_supported' ELSE 'dwg_version_newer_than_host' END AS reason, p_partkey % 17 <> 0 AND 1000 + p_size <= r.most AS compatible
FROM part JOIN (VALUES (0, '2014', 1027), (1, '2018', 1032), (2, '2020', 1032), (3, '2023', 1032)) AS r(k, release, most) ON p_partkey % 5 = r.k""")
def version_gate(spark, sf_dir):
    """Hosts are known by their file version; a drawing may be as new as the host's newest."""
    versions = F.element_at(F.array(*[F.lit(v) for v in ("19.1.18.0", "R22.0", "23.1.47.0.0", "R24.2.1", "24.20")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    part = table(spark, sf_dir, "part").select("p_partkey", versions.alias("file_version"), F.expr(_CODE.replace("'AC' ||", "concat('AC',").replace("(1000 + p_size)", "1000 + p_size)")).alias("code"))
    return gates.version_verdict(gates.with_policy(part, "file_version"), "code").select("p_partkey", "release", "reason", "compatible")


@query("SELECT 'orders' AS name, count(*) AS n, count(DISTINCT o_orderkey) AS keys, true AS passes FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey), false FROM lineitem UNION ALL SELECT 'customer', count(*), count(DISTINCT c_custkey), true FROM customer")
def uniqueness_gate(spark, sf_dir):
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "customer": "c_custkey"}
    return diff.union_all([gates.key_gate(table(spark, sf_dir, t), k).withColumn("name", F.lit(t)) for t, k in keys.items()]).select("name", "n", "keys", "passes")


@query("SELECT o_custkey, arg_max(o_orderkey, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderkey FROM orders GROUP BY o_custkey")
def latest_in_family(spark, sf_dir):
    return ordering.latest(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""WITH a AS (SELECT p_brand, p_partkey, p_retailprice - lag(p_retailprice) OVER w AS gap FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey)),
b AS (SELECT *, lag(gap) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) AS g FROM (SELECT a.*, part.p_retailprice FROM a JOIN part USING (p_partkey)) x)
SELECT p_brand, p_partkey, round(gap, 6) AS gap FROM b WHERE abs(gap - g) > 0.25 * g""")
def axis_ratio(spark, sf_dir):
    return ordering.off_ratio(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", "p_partkey").select("p_brand", "p_partkey", F.round("gap", 6).alias("gap"))


@query("""WITH kinds AS (SELECT CASE WHEN p_size < 15 THEN 'TEXT' WHEN p_size < 30 THEN 'INSERT' ELSE 'LINE' END AS kind, p_brand, round_even(p_retailprice / 0.5, 0) AS v, count(*) AS l, count(*) FILTER (p_partkey % 9 <> 0) AS r FROM part GROUP BY ALL)
SELECT kind, sum(l)::BIGINT AS left_count, sum(r)::BIGINT AS right_count, sum(least(l, r))::BIGINT AS matched, sum(greatest(l - r, 0))::BIGINT AS left_only, 0::BIGINT AS right_only FROM kinds GROUP BY kind""")
def portable_style_compare(spark, sf_dir):
    """Each kind's bag of signatures against that of another reader, whose class names differ."""
    kind = F.when(F.col("p_size") < 15, "DBText").when(F.col("p_size") < 30, "BlockReference").otherwise("Line")
    left = table(spark, sf_dir, "part").withColumn("kind", scalar.type_name(kind))
    return diff.bag_diff_by(left, left.where("p_partkey % 9 <> 0"), "kind", ["p_brand", "p_retailprice"], 0.5)


@query("SELECT 'both' AS side, count(*) AS n FROM (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0 INTERSECT SELECT o_custkey FROM orders) a UNION ALL SELECT 'left', count(*) FROM (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0 EXCEPT SELECT o_custkey FROM orders) b UNION ALL SELECT 'right', count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0) c")
def key_set_ops(spark, sf_dir):
    return diff.key_sets(table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT 'intersect' AS op, count(*) AS n FROM (SELECT l_suppkey FROM lineitem INTERSECT ALL SELECT ps FROM (SELECT o_custkey % 100 AS ps FROM orders) o) a UNION ALL SELECT 'except', count(*) FROM (SELECT l_suppkey FROM lineitem EXCEPT ALL SELECT ps FROM (SELECT o_custkey % 100 AS ps FROM orders) o) b")
def bag_set_ops(spark, sf_dir):
    left, right = table(spark, sf_dir, "lineitem").select("l_suppkey"), table(spark, sf_dir, "orders").selectExpr("o_custkey % 100 AS l_suppkey")
    got = diff.bag_diff(left, right, ["l_suppkey"])
    return got.select(F.explode(F.array(F.struct(F.lit("intersect").alias("op"), F.col("matched").alias("n")), F.struct(F.lit("except").alias("op"), F.col("left_only").alias("n")))).alias("x")).select("x.*")


@query("SELECT c_name AS name, 'direct' AS origin FROM customer UNION ALL SELECT s_name, 'block-attribute' FROM supplier UNION ALL SELECT n_name, 'block-definition' FROM nation")
def union_of_kinds(spark, sf_dir):
    parts = {"direct": ("customer", "c_name"), "block-attribute": ("supplier", "s_name"), "block-definition": ("nation", "n_name")}
    return diff.union_all([table(spark, sf_dir, t).select(F.col(c).alias("name"), F.lit(origin).alias("origin")) for origin, (t, c) in parts.items()])


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ';' ORDER BY o_orderpriority) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS outside FROM orders GROUP BY o_custkey")
def array_subset(spark, sf_dir):
    uses = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("uses"))
    outside = F.array_sort(gates.outside(F.col("uses"), ["1-URGENT", "2-HIGH", "3-MEDIUM"]))
    return uses.select("o_custkey", F.when(F.size(outside) > 0, F.array_join(outside, ";")).alias("outside"))


@query("SELECT l_returnflag || l_linestatus AS flag, count(*) AS n, count(*) FILTER (l_discount = 0) AS plain, count(*) FILTER (l_tax = 0) AS untaxed, bool_and(l_quantity > 1) AS consistent FROM lineitem GROUP BY ALL")
def counters(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("flag", F.concat("l_returnflag", "l_linestatus"))
    return summaries.counters(rows, {"plain": F.col("l_discount") == 0, "untaxed": F.col("l_tax") == 0}, ["flag"]).join(summaries.all_hold(rows, F.col("l_quantity") > 1, ["flag"]), "flag")


@query("SELECT least(count(*), 20000) AS kept, count(*) > 20000 AS truncated, (SELECT sum(l_partkey)::BIGINT FROM (SELECT l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20000) a) AS keys FROM lineitem")
def capped_scan(spark, sf_dir):
    first, more = ordering.capped(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 20000)
    return more.join(first.agg(F.sum("l_partkey").alias("keys")))  # one row each


@query("SELECT p_type, min(p_brand) AS p_brand, row_number() OVER (PARTITION BY p_type ORDER BY lower(p_brand)) AS place FROM part GROUP BY p_type, lower(p_brand)")
def ordered_lists(spark, sf_dir):
    return ordering.positions(table(spark, sf_dir, "part"), "p_type", "p_brand")


@query("""SELECT p_partkey, round(p_size * cos(s), 6) AS start_x, round(p_size * sin(s), 6) AS start_y, round(p_size * cos(s + 1), 6) AS mid_x, round(p_size * sin(s + 1), 6) AS mid_y, p_size::DOUBLE AS radius, 2.0 * p_size AS width FROM (SELECT *, p_retailprice / 100 AS s FROM part) p""")
def arc_points(spark, sf_dir):
    r, s, zero = F.col("p_size").cast("double"), F.col("p_retailprice") / 100, F.lit(0.0)
    rows = table(spark, sf_dir, "part").select("p_partkey", geometry.arc(zero, zero, r, s, s + 2).alias("a"), geometry.measures(geometry.envelope(geometry.corners(-r, -r, r, r))).alias("m"))
    return rows.select("p_partkey", *[F.round(f"a.{c}", 6).alias(c) for c in ("start_x", "start_y", "mid_x", "mid_y", "radius")], F.col("m.width").alias("width"))


@query("SELECT CASE event_type WHEN 'click' THEN 'TEXT' WHEN 'view' THEN 'INSERT' ELSE upper(event_type) END AS kind, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY 1")
def type_normalise(spark, sf_dir):
    kind = scalar.type_name(F.col("event_type"), {"click": "TEXT", "view": "INSERT"})
    return table(spark, sf_dir, "events").where("event_type <> 'error'").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 THEN o_totalprice END AS value FROM orders WHERE o_orderkey % 10 <> 0")
def confirmed_values(spark, sf_dir):
    """Values whose status, white space aside, is confirmed and that are numbers; null records are left out."""
    status = F.when(F.col("o_orderstatus") == "F", F.lit(f" {scalar.CONFIRMED} ")).otherwise(F.col("o_orderstatus"))
    value = F.when(F.col("o_orderkey") % 3 == 0, F.lit("none")).otherwise(F.col("o_totalprice").cast("string"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.when(F.col("o_orderkey") % 10 != 0, F.struct(value.alias("value_mm"), status.alias("status")))).alias("q"))
    return rows.select("o_orderkey", F.explode(F.filter("q", lambda x: x.isNotNull())).alias("q")).select("o_orderkey", scalar.confirmed(F.col("q")).alias("value"))


@query("""SELECT p_partkey, c.role, round(0.6 * x - 0.8 * y + 10, 6) AS x, round(0.8 * x + 0.6 * y + 20, 6) AS y FROM part,
LATERAL (SELECT * FROM (VALUES ('lower_left', -p_size, 0.0), ('lower_right', p_size, 0.0), ('upper_right', p_size, p_retailprice), ('upper_left', -p_size, p_retailprice)) AS v(role, x, y)) c""")
def transformed_point_arrays(spark, sf_dir):
    size = F.col("p_size").cast("double")
    points = geometry.moved(geometry.corners(-size, F.lit(0.0), size, F.col("p_retailprice")), geometry.matrix(0.6, -0.8, 0.8, 0.6, 10, 20))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(points).alias("p")).select("p_partkey", "p.role", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query("SELECT l_suppkey, CASE WHEN bool_or(l_tax > 0.079) OR count(*) FILTER (l_discount < 0.001) > 40 THEN 'unresolved' ELSE 'complete' END AS status FROM lineitem GROUP BY l_suppkey")
def unresolved_status(spark, sf_dir):
    """A drawing is unresolved where anything is left to look at; repeated inserts alone do not count."""
    counts = summaries.counters(table(spark, sf_dir, "lineitem"), {"notifications": F.col("l_tax") > 0.079, "issues": F.col("l_discount") < 0.001, "repeated": F.col("l_quantity") > 10}, ["l_suppkey"])
    return counts.select("l_suppkey", rules.drawing_status(F.col("notifications"), F.greatest(F.col("issues") - 40, F.lit(0))).alias("status"))


@query("SELECT o_custkey AS parent, count(*) AS leaves FROM orders o JOIN (SELECT o_custkey AS k, sum(o_totalprice) AS area FROM orders GROUP BY ALL) p ON k = o_custkey WHERE o_totalprice <= 0.05 * area GROUP BY o_custkey, o_orderstatus HAVING count(*) >= 2")
def leaf_rule(spark, sf_dir):
    """Two or more alike leaves of one parent, each of at most a twentieth of its area."""
    orders = table(spark, sf_dir, "orders")
    parents = orders.groupBy(F.col("o_custkey").alias("parent")).agg(F.sum("o_totalprice").alias("parent_area"))
    return rules.leaves(orders.withColumnRenamed("o_custkey", "parent"), parents, "parent", "o_orderstatus", "o_totalprice").select("parent", "leaves")


@query("""SELECT c_custkey, abs(c_acctbal * (1 + 1e-13) - c_acctbal) <= 1e-12 * greatest(1, abs(c_acctbal)) AS near, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS finite, replace(replace(c_name || '/a|b', '/', '_'), '|', '_') AS safe,
CASE WHEN c_custkey % 5 = 0 THEN '' ELSE upper(to_hex(c_custkey)) END AS handle, sha256(c_name) AS digest, true AS is_digest, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS number, upper(c_mktsegment) AS segment FROM customer""")
def scalar_suite(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    digest = F.sha2(F.col("c_name").cast("binary"), 256)
    value = F.when(F.col("c_custkey") % 12 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 6 == 0, F.lit(float("-inf"))).otherwise(F.col("c_acctbal"))
    return c.select(
        "c_custkey",
        scalar.nearly_equal(F.col("c_acctbal") * (1 + 1e-13), F.col("c_acctbal")).alias("near"),
        scalar.finite(value).alias("finite"),
        scalar.safe_name(F.concat("c_name", F.lit("/a|b"))).alias("safe"),
        scalar.handle_text(F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey"))).alias("handle"),
        digest.alias("digest"),
        scalar.is_sha256(digest).alias("is_digest"),
        scalar.number(F.when(F.col("c_custkey") % 4 == 0, F.lit("x1")).otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"), F.lit(" ")))).alias("number"),
        F.upper(scalar.clean(F.concat(F.lit("  "), "c_mktsegment"))).alias("segment"),
    )


@query("""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'value is not finite' ELSE 'nested.b[] is not finite' END AS rule FROM events WHERE event_id % 9 = 0 UNION ALL SELECT event_id, 'nested.b is not finite' FROM events WHERE event_id % 14 = 0""")
def finite_check(spark, sf_dir):
    """Rules made from the schema: no number anywhere may be NaN or infinite."""
    bad = lambda n, v: F.when(F.col("event_id") % n == 0, F.lit(float(v))).otherwise(F.col("value"))
    rows = table(spark, sf_dir, "events").select("event_id", bad(9, "nan").alias("value"), F.struct(F.lit("x").alias("a"), F.array(F.lit(1.0), bad(14, "inf")).alias("b")).alias("nested"))
    return rules.run_rules(rows, "event_id", scalar.finite_rules(rows))


@query("""WITH d AS (SELECT p_partkey AS k, p_size AS s, CASE WHEN p_partkey % 5 <> 0 THEN -(p_size % 3) * 50.0 WHEN p_partkey % 10 = 0 THEN 30.0 END AS off FROM part),
t AS (SELECT *, CASE WHEN k % 11 <> 0 THEN off END AS lower_top, CASE WHEN k % 7 <> 0 THEN 4450.0 + s + (s % 5) * 25 END AS upper_top,
 CASE WHEN k % 4 = 0 THEN '资料不足' WHEN k % 9 = 0 THEN '冲突' WHEN k % 3 = 0 AND s % 2 = 0 THEN '已确认' ELSE '候选' END AS lower_status, CASE WHEN k % 6 <> 0 THEN '已确认' ELSE '候选' END AS upper_status FROM d),
c AS (SELECT *, upper_top - CASE WHEN k % 13 <> 0 THEN 800 END - lower_top AS clearance FROM t)
SELECT 'D' || k AS registry_device_id, lower_top::DOUBLE AS lower_top, upper_top::DOUBLE AS upper_top, clearance::DOUBLE AS clearance, (clearance - 3650)::DOUBLE AS delta, lower_status, upper_status,
 CASE WHEN off IS NULL THEN '资料不足' WHEN off < -1 THEN '有' WHEN off > 1 THEN '升板' ELSE '无' END AS lower_drop,
 CASE WHEN lower_status = '冲突' THEN '冲突' WHEN clearance IS NULL OR lower_status <> '已确认' OR upper_status <> '已确认' THEN '待人工核实' ELSE '已确认' END AS overall FROM c""")
def clearance_report(spark, sf_dir):
    """The device report over evidence derived from parts, with a ledger derived from suppliers."""
    k, s = F.col("p_partkey"), F.col("p_size")

    def quantity(value, known, reason="measured"):
        reason = reason if isinstance(reason, Column) else F.lit(reason)
        return F.struct(value.cast("string").alias("value_mm"), F.when(known, clearance.CONFIRMED).otherwise(clearance.LACKING).alias("status"), reason.alias("reason"))

    def link(segment, mapped, physical):
        sure = lambda c: F.when(c, clearance.CONFIRMED).otherwise(clearance.CANDIDATE)
        return F.struct(sure(mapped).alias("mapping_status"), segment.alias("p5_beam_segment_id"), sure(physical).alias("p5_physical_status"), F.lit(clearance.CONFIRMED).alias("beam_reference_status"))

    always, lower, upper = F.lit(True), F.concat(F.lit("B"), k), F.concat(F.lit("U"), k)
    inputs = {
        "z_lower_level_mm": quantity(F.lit(0), k % 11 != 0),
        "z_upper_level_mm": quantity(4500 + s, always),
        "lower_beam_top_offset_mm": quantity(-(s % 3) * 50, k % 5 != 0),
        "lower_installation_surface_offset_mm": quantity(F.lit(30), always, F.when(k % 10 == 0, "Beam_Top seen").otherwise("surface")),
        "upper_beam_top_offset_mm": quantity((s % 5) * 25 - 50, k % 7 != 0),
        "upper_beam_height_mm": quantity(F.lit(800), k % 13 != 0),
    }
    device = F.struct(
        F.concat(F.lit("D"), k).alias("registry_device_id"),
        F.struct(F.when(k % 9 == 0, "X").when(k % 3 == 0, lower).alias("lower_beam_id"), upper.alias("upper_beam_id")).alias("beam_references"),
        F.struct(link(lower, k % 4 != 0, s % 2 == 0).alias("lower"), link(upper, always, k % 6 != 0).alias("upper")).alias("support_links"),
        F.struct(*[v.alias(n) for n, v in inputs.items()]).alias("inputs"),
        F.lit(3650.0).alias("clear_height_mm"),
    )
    devices = table(spark, sf_dir, "part").select(F.from_json(F.to_json(device), clearance.DEVICES).alias("d")).select("d.*")
    beams = table(spark, sf_dir, "supplier").select(F.from_json(F.to_json(F.struct(F.concat(F.lit("F"), F.col("s_suppkey")).alias("formal_beam_id"))), clearance.BEAMS).alias("b")).select("b.*")
    rows = clearance.report(devices, beams)
    names = {"lower_beam_top_elevation_mm": "lower_top", "upper_beam_top_elevation_mm": "upper_top", "beam_clearance_excluding_upturn_mm": "clearance", "baseline_delta_mm": "delta", "lower_anchorage.status": "lower_status", "upper_anchorage.status": "upper_status", "lower_drop_status": "lower_drop", "overall_status": "overall"}
    return rows.select("registry_device_id", *[F.col(c).alias(n) for c, n in names.items()])


@query("""WITH t AS (SELECT count(*) AS l, count(*) FILTER (c_custkey % 7 <> 0) AS r, count(*) FILTER (c_custkey % 7 <> 0 AND c_custkey % 11 <> 0) AS m FROM customer),
s AS (SELECT count(*) AS l, count(*) FILTER (o_orderkey % 101 <> 0) AS r, count(*) FILTER (o_orderkey % 101 <> 0 AND o_orderkey % 13 <> 0) AS m FROM orders), n AS (SELECT count(*) AS l FROM nation)
SELECT 'text_core' AS comparison, l AS left_count, r AS right_count, m AS matched, l - m AS left_only, r - m AS right_only, 0 AS mismatched, l = m AND r = m AS consistent FROM t
UNION ALL SELECT 'symbol_core', l, r, m, l - r, 0, r - m, l = m FROM s UNION ALL SELECT 'visibility_layers', l, l, l, 0, 0, 0, true FROM n""")
def document_compare(spark, sf_dir):
    """Two readers' records of one drawing: texts as a bag, inserts and layers by key."""
    customer, orders, nation = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    text = customer.selectExpr("c_custkey AS ordinal", "'DBText' AS entity_type", "'direct' AS origin", "c_name AS text", "c_acctbal AS x", "c_mktsegment AS layer")
    symbol = orders.selectExpr("o_orderkey AS ordinal", "CAST(o_orderkey AS STRING) AS instance_key", "o_orderstatus AS block_name", "o_totalprice AS x", "array(o_orderpriority) AS attributes")
    layers = nation.selectExpr("n_nationkey AS ordinal", "n_name AS name", "n_regionkey = 1 AS is_off", "named_struct('r', n_regionkey / 3.0D) AS state")
    other = {
        "text": text.where("ordinal % 7 <> 0").withColumn("x", F.expr("x + IF(ordinal % 11 = 0, 0.01D, 1e-9D)")),
        "symbol": symbol.where("ordinal % 101 <> 0").withColumn("attributes", F.expr("IF(ordinal % 13 = 0, array('changed'), attributes)")),
        "layers": layers,
    }
    rows = reconcile.compare({"text": text, "symbol": symbol, "layers": layers}, other, 0.005)
    return rows.where("not diagnostic").drop("diagnostic")
