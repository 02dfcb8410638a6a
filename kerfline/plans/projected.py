"""Registered queries of projections and registries, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import projections, registry
from .registry import query, table


@query("""SELECT p_partkey, (['TEXT', 'MTEXT', 'CIRCLE', 'INSERT'])[p_partkey % 4 + 1] AS kind, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS text, CASE WHEN p_partkey % 4 = 1 THEN p_brand END AS plain_text,
CASE WHEN p_partkey % 4 < 2 AND p_partkey % 5 <> 0 THEN p_retailprice END AS height, CASE WHEN p_partkey % 4 = 2 THEN p_size::DOUBLE END AS radius, CASE WHEN p_partkey % 4 = 3 THEN p_type END AS block_name FROM part""")
def type_projection(spark, sf_dir):
    """Each type keeps its own fields; heights that are not finite are null."""
    kind = F.element_at(F.array(*[F.lit(k) for k in ("TEXT", "MTEXT", "CIRCLE", "INSERT")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    height = F.when(F.col("p_partkey") % 5 == 0, F.lit(float("inf"))).otherwise(F.col("p_retailprice"))
    rows = table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"), F.col("p_name").alias("text"), F.col("p_brand").alias("plain_text"), height.alias("height"), F.col("p_size").cast("double").alias("radius"), F.col("p_type").alias("block_name"))
    return projections.by_type(rows, "kind")


@query("""WITH k AS (SELECT *, CASE s_suppkey % 5 WHEN 0 THEN 'line' WHEN 1 THEN 'polyline' WHEN 2 THEN 'circle' WHEN 3 THEN 'entity_bounds' ELSE 'entity_unresolved' END AS kind FROM supplier),
p AS (SELECT s_suppkey, kind, unnest(CASE kind WHEN 'line' THEN [{'role': 'start', 'x': s_acctbal, 'y': 0.0}, {'role': 'end', 'x': s_acctbal + 10, 'y': 5.0}]
 WHEN 'polyline' THEN [{'role': 'vertex_0', 'x': s_acctbal, 'y': 0.0}, {'role': 'vertex_1', 'x': s_acctbal + 10, 'y': 5.0}, {'role': 'vertex_2', 'x': s_acctbal, 'y': 0.0}] WHEN 'circle' THEN [{'role': 'center', 'x': s_acctbal, 'y': 0.0}]
 WHEN 'entity_bounds' THEN [{'role': 'bounds_min', 'x': s_acctbal, 'y': 0.0}, {'role': 'bounds_max_x_min_y', 'x': s_acctbal + 10, 'y': 0.0}, {'role': 'bounds_max', 'x': s_acctbal + 10, 'y': 5.0}, {'role': 'bounds_min_x_max_y', 'x': s_acctbal, 'y': 5.0}]
 ELSE [{'role': NULL, 'x': NULL, 'y': NULL}] END) AS p FROM k)
SELECT s_suppkey, kind, CASE kind WHEN 'entity_bounds' THEN true ELSE false END AS closed, p.role AS role, p.x AS x, p.y::DOUBLE AS y FROM p""")
def kind_points(spark, sf_dir):
    """Points with roles by kind of entity; an entity without any is one row."""
    at = lambda x, y: F.struct(x.alias("x"), F.lit(y).alias("y"), F.lit(0.0).alias("z"))
    low, high = at(F.col("s_acctbal"), 0.0), at(F.col("s_acctbal") + 10, 5.0)
    cls = F.element_at(F.array(*[F.lit(k) for k in ("Line", "Polyline", "Circle", "Solid", "Solid")]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    bounds = F.when(F.col("s_suppkey") % 5 != 4, F.struct(low.alias("min"), high.alias("max")))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", cls.alias("class"), F.lit(False).alias("closed"), low.alias("start"), high.alias("end"), low.alias("center"), F.array(low, high, low).alias("vertices"), bounds.alias("bounds"))
    return projections.kind_record(rows).select("s_suppkey", "kind", "closed", F.explode_outer("points").alias("p")).select("s_suppkey", "kind", "closed", "p.role", "p.x", "p.y")


@query("""SELECT n_nationkey, unnest(list_filter(['text_position', CASE WHEN n_nationkey % 2 = 0 THEN 'XLine1Point' END, CASE WHEN n_nationkey % 3 = 0 THEN 'DimLinePoint' END, CASE WHEN n_nationkey % 5 = 0 THEN 'ArcPoint' END], lambda x: x IS NOT NULL)) AS role FROM nation""")
def dimension_roles(spark, sf_dir):
    """The points that a dimension has; others are left out."""
    here = F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(0.0).alias("z"))
    known = {"ArcPoint": 5, "DimLinePoint": 3, "XLine1Point": 2, "text_position": 1}
    rows = table(spark, sf_dir, "nation").select("n_nationkey", *[F.when(F.col("n_nationkey") % n == 0, here).alias(name) for name, n in known.items()])
    return rows.select("n_nationkey", F.explode(projections.dimension_points(rows)).alias("p")).select("n_nationkey", "p.role")


@query("""WITH h AS (SELECT p_partkey, p_size AS n, p_partkey % 7 AS m FROM part), k AS (SELECT *, least(n, 20, CASE WHEN m = 0 THEN 20 ELSE ceil(60 / m) END)::INT AS kept FROM h)
SELECT p_partkey, n::INT AS n_loops, kept AS kept_loops, least(kept * m, 60)::INT AS n_points, n > kept OR kept * m > 60 AS truncated FROM k""")
def hatch_caps(spark, sf_dir):
    """At most 20 loops and 60 points of a hatch are kept, as the caller asks, and the record says so."""
    vertex = F.transform(F.slice(F.sequence(F.lit(1), F.lit(7)), F.lit(1), (F.col("p_partkey") % 7).cast("int")), lambda i: F.struct(F.concat(F.lit("vertex_"), (i - 1).cast("string")).alias("role"), i.alias("x")))
    loops = F.transform(F.sequence(F.lit(1), F.col("p_size").cast("int")), lambda i: F.struct(F.lit(True).alias("is_polyline"), F.col("v").alias("points")))
    # few bytes make much work here, so that rows are dealt to all tasks and not left to the file's few splits
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    rows = part.withColumn("v", vertex).select("p_partkey", projections.hatch_evidence(loops, 20, 60).alias("h"))
    return rows.select("p_partkey", "h.n_loops", F.size("h.loops").alias("kept_loops"), "h.n_points", "h.truncated")


@query("""SELECT CASE l_linenumber % 3 WHEN 0 THEN 'line' WHEN 1 THEN 'closed-polyline' ELSE 'block-reference' END AS candidate, count(*) AS n, sum(l_partkey)::BIGINT AS keys FROM lineitem
WHERE l_linenumber % 3 = 0 OR l_quantity > 10 AND l_extendedprice > 5000 AND (l_linenumber % 3 = 2 OR l_returnflag = 'N') GROUP BY 1""")
def frame_candidates(spark, sf_dir):
    """Lines, closed polylines and inserts; those without an area are none."""
    cls = F.when(F.col("l_linenumber") % 3 == 0, "Line").when(F.col("l_linenumber") % 3 == 1, "Polyline").otherwise("BlockReference")
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", cls.alias("class"), (F.col("l_returnflag") == "N").alias("closed"), F.lit(10.0).alias("min_x"), F.lit(5000.0).alias("min_y"), F.col("l_quantity").cast("double").alias("max_x"), F.col("l_extendedprice").cast("double").alias("max_y"))
    return projections.frame_candidates(rows).groupBy("candidate").agg(F.count("*").alias("n"), F.sum("l_partkey").alias("keys"))


@query("SELECT o_orderkey FROM orders WHERE regexp_matches(printf('%X', o_orderkey), '^(1A|2)') AND o_orderstatus <> 'P'")
def explode_handles(spark, sf_dir):
    """Inserts and entities of unknown make-up whose handle is asked for."""
    kind = F.when(F.col("o_orderstatus") == "F", "block_reference").when(F.col("o_orderstatus") == "O", "entity_bounds").otherwise("line")
    return table(spark, sf_dir, "orders").where(projections.to_explode(scalar.handle_text(F.col("o_orderkey")), kind, "^(1A|2)")).select("o_orderkey")


@query("""SELECT o_orderkey, upper(printf('%.15g', o_totalprice)) AS plain, upper(printf('%.15g', o_totalprice * 1e11)) AS large, upper(printf('%.15g', o_orderkey / 1e8)) AS small, CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END AS flag,
CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey::VARCHAR ELSE '' END AS key, replace(replace(o_orderstatus || chr(9) || '"' || chr(92) || chr(10) || o_orderpriority, chr(92), chr(92) || chr(92)), '"', chr(92) || '"').replace(chr(9), chr(92) || 't').replace(chr(10), chr(92) || 'n') AS escaped FROM orders""")
def value_texts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    values = {"plain": F.col("o_totalprice").cast("double"), "large": F.col("o_totalprice") * 1e11, "small": F.col("o_orderkey") / 1e8, "flag": F.col("o_orderkey") % 2 == 0, "key": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))}
    rows = o.select("o_orderkey", F.concat("o_orderstatus", F.lit('\t"\\\n'), "o_orderpriority").alias("t"), *[v.alias(n) for n, v in values.items()])
    return rows.select("o_orderkey", *[scalar.value_text(F.col(n), rows.schema[n].dataType).alias(n) for n in values], scalar.json_text(F.col("t")).alias("escaped"))


@query("""SELECT 'all' AS devices, 'device_location_registry_unresolved' AS status, 'building is missing;grouped' AS reasons UNION ALL SELECT 'known', 'device_location_registry_complete', '' UNION ALL SELECT 'twice', 'device_location_registry_unresolved', 'c_custkey is repeated' UNION ALL SELECT 'none', 'device_location_registry_unresolved', 'no devices'""")
def registry_gate(spark, sf_dir):
    """A registry is complete only where nothing is blank, repeated or left ungrouped."""
    rows = table(spark, sf_dir, "customer").withColumn("building", F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")).otherwise(F.lit(" ")))
    known = rows.where("c_custkey % 50 <> 0")
    cases = {"all": rows, "known": known, "twice": known.unionByName(known), "none": rows.where("c_custkey < 0")}
    found = [registry.registry_status(df, "c_custkey", ["building"], {"grouped": F.col("c_custkey") % 50 != 0}).withColumn("devices", F.lit(name)) for name, df in cases.items()]
    return registry.diff.union_all(found).select("devices", "status", F.array_join("reasons", ";").alias("reasons"))


@query("""SELECT o_orderkey::VARCHAR AS key, concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN 'not recomputed' WHEN o_orderkey % 13 = 0 THEN 'o_totalprice' END, CASE WHEN o_orderkey % 17 = 0 THEN 'handle' END) AS fields,
CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 'evidence_trace_unresolved' ELSE 'evidence_trace_complete' END AS status FROM orders""")
def evidence_trace(spark, sf_dir):
    """Devices whose place comes out again and that name their evidence."""
    rows = table(spark, sf_dir, "orders").withColumn("handle", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")))
    again = rows.where("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 13 == 0, 1.0).otherwise(1e-7))
    return registry.evidence_trace(rows, again, "o_orderkey", ["o_custkey", "o_totalprice"], ["handle", "o_orderpriority"], 0.001)


@query("SELECT s_nationkey, s_name <> '' AS named, count(DISTINCT s_suppkey) AS devices FROM supplier GROUP BY ALL")
def device_templates(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").withColumn("named", F.col("s_name") != "")
    return registry.templates(rows, ["s_nationkey", "named"]).withColumnRenamed("n", "devices")


@query("""SELECT p_partkey, p_partkey % 3 = 0 AND p_size <= 25 AS expanded, unnest(CASE WHEN p_partkey % 3 = 0 AND p_size <= 25 THEN range(p_size, 26) ELSE [NULL] END)::BIGINT AS floor FROM part""")
def expand_floors(spark, sf_dir):
    """From a part's size up to 25, where there is evidence; ranges that are upside down stay as they are."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("low"), F.lit(25).cast("bigint").alias("high"))
    return registry.expand_floors(rows, "low", "high", F.col("p_partkey") % 3 == 0).select("p_partkey", "expanded", "floor")


@query("""WITH f(name, x0, x1, y0, y1) AS (VALUES ('left', -500.0, 2500.0, 0, 12), ('both', 2000.0, 7500.0, 4, 20)), i AS (SELECT * FROM customer JOIN f ON c_acctbal BETWEEN x0 AND x1 AND c_nationkey BETWEEN y0 AND y1)
SELECT name, count(*) AS n_texts, count(*) FILTER (contains(c_mktsegment, 'BUILD')) AS "BUILD", count(*) FILTER (contains(c_mktsegment, 'MA')) AS "MA" FROM i GROUP BY name
UNION ALL SELECT NULL, count(*), 0, 0 FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM i)""")
def frame_texts(spark, sf_dir):
    """Words by frame, and how many texts lie in none."""
    frames = spark.createDataFrame([("left", -500.0, 2500.0, 0.0, 12.0), ("both", 2000.0, 7500.0, 4.0, 20.0)], "name string, min_x double, max_x double, min_y double, max_y double")
    texts = table(spark, sf_dir, "customer").selectExpr("c_custkey", "CAST(c_acctbal AS DOUBLE) AS x", "CAST(c_nationkey AS DOUBLE) AS y", "c_mktsegment")
    return registry.frame_texts(texts, frames, "c_custkey", "x", "y", "c_mktsegment", ["BUILD", "MA"], 1000.0)
