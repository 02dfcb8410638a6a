"""Registered queries of two readers' documents, of formal geometry, of reasons, rules and trees, each with SQL of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import clearance, lineage, reconcile, registry, validators
from ..sources import exports
from .registry import query, table


def _bag(name: str, rows: str, kept: str, same: str, key: str = "") -> str:
    return f"SELECT '{name}' AS comparison, count(*) AS left_count, count(*) FILTER ({kept}) AS right_count, count(*) FILTER ({kept} AND {same}) AS matched, count(*) - count(*) FILTER ({kept} AND {same}) AS left_only, count(*) FILTER ({kept}) - count(*) FILTER ({kept} AND {same}) AS right_only, 0 AS mismatched, count(*) = count(*) FILTER ({kept} AND {same}) AS consistent FROM {rows}"


def _keyed(name: str, rows: str, kept: str, same: str) -> str:
    return f"SELECT '{name}' AS comparison, count(*) AS left_count, count(*) FILTER ({kept}) AS right_count, count(*) FILTER ({kept} AND {same}) AS matched, count(*) FILTER (NOT ({kept})) AS left_only, 0 AS right_only, count(*) FILTER ({kept} AND NOT ({same})) AS mismatched, count(*) = count(*) FILTER ({kept} AND {same}) AS consistent FROM {rows}"


_NINE = " UNION ALL ".join([
    _bag("text_core", "customer", "c_custkey % 7 <> 0", "c_custkey % 11 <> 0"), _bag("frame_lines", "lineitem", "l_orderkey % 17 <> 0", "l_orderkey % 19 <> 0"),
    _keyed("symbol_core", "orders", "o_orderkey % 101 <> 0", "o_orderkey % 13 <> 0"), _keyed("oriented_text_core", "part", "p_partkey % 5 <> 0", "p_partkey % 8 <> 0"),
    _keyed("primitive_core", "supplier", "s_suppkey % 6 <> 0", "true"), _keyed("visibility_instance_core", "events", "event_id % 23 <> 0", "event_id % 29 <> 0"),
    _keyed("visibility_layers", "nation", "true", "true"), _keyed("visibility_layouts", "region", "r_regionkey <> 2", "true"),
    _keyed("visibility_viewports", "(SELECT * FROM supplier WHERE s_suppkey % 4 <> 0)", "true", "s_suppkey % 7 <> 0"), _keyed("primitive_bounds", "supplier", "s_suppkey % 6 <> 0", "s_suppkey % 9 <> 0"),
    _keyed("viewport_number_diagnostics", "(SELECT * FROM supplier WHERE s_suppkey % 4 <> 0)", "true", "s_suppkey % 5 <> 0"),
])


@query(_NINE)
def compare_all_kinds(spark, sf_dir):
    """All nine comparisons of two readers and both diagnostics: bags of texts and lines, all others by key."""
    t = {n: table(spark, sf_dir, n) for n in ("customer", "lineitem", "orders", "part", "supplier", "events", "nation", "region")}
    left = {
        "text": t["customer"].selectExpr("c_custkey AS ordinal", "'DBText' AS entity_type", "'direct' AS origin", "c_name AS text", "c_acctbal AS x", "c_mktsegment AS layer"),
        "frame_lines": t["lineitem"].selectExpr("l_orderkey AS ordinal", "'Line' AS entity_type", "l_returnflag AS layer", "concat(hex(l_orderkey), '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS handle", "l_quantity AS start_x", "l_extendedprice AS start_y", "l_tax AS end_x", "l_discount AS end_y"),
        "symbol": t["orders"].selectExpr("o_orderkey AS ordinal", "CAST(o_orderkey AS STRING) AS instance_key", "o_orderstatus AS block_name", "o_totalprice AS x", "array(o_orderpriority) AS attributes"),
        "oriented_text": t["part"].selectExpr("p_partkey AS ordinal", "CAST(p_partkey AS STRING) AS record_key", "p_name AS text", "p_retailprice AS x", "p_size / 10.0D AS world_rotation_radians"),
        "primitive": t["supplier"].selectExpr("s_suppkey AS ordinal", "CAST(s_suppkey AS STRING) AS record_key", "'Line' AS entity_type", "s_acctbal AS start_x", "s_acctbal AS min_x"),
        "visibility": t["events"].selectExpr("event_id AS ordinal", "CAST(event_id AS STRING) AS instance_key", "event_type AS visibility_reason", "value > 50 AS entity_visible", "array(named_struct('name', 'v', 'value', value)) AS dynamic_properties"),
        "layers": t["nation"].selectExpr("n_nationkey AS ordinal", "n_name AS name", "n_regionkey = 1 AS is_off", "named_struct('r', n_regionkey / 3.0D) AS state"),
        "layouts": t["region"].selectExpr("r_regionkey AS ordinal", "r_name AS layout_handle", "r_regionkey AS tab_order"),
        "viewports": t["supplier"].selectExpr("s_suppkey AS ordinal", "hex(s_suppkey) AS handle", "CAST(s_suppkey AS INT) AS number", "s_suppkey % 4 = 0 AS is_paper_viewport", "s_acctbal AS view_height"),
    }
    edit = lambda kind, keep, column, new: left[kind].where(keep).withColumn(column, F.expr(new))
    right = {
        "text": edit("text", "ordinal % 7 <> 0", "x", "x + IF(ordinal % 11 = 0, 0.01D, 1e-9D)"),
        "frame_lines": edit("frame_lines", "ordinal % 17 <> 0", "end_x", "end_x + IF(ordinal % 19 = 0, 1.0D, 0.0D)"),
        "symbol": edit("symbol", "ordinal % 101 <> 0", "attributes", "IF(ordinal % 13 = 0, array('changed'), attributes)"),
        "oriented_text": edit("oriented_text", "ordinal % 5 <> 0", "world_rotation_radians", "world_rotation_radians + IF(ordinal % 8 = 0, 0.1D, 0.0D)"),
        "primitive": edit("primitive", "ordinal % 6 <> 0", "min_x", "min_x + IF(ordinal % 9 = 0, 1.0D, 0.0D)"),
        "visibility": edit("visibility", "ordinal % 23 <> 0", "dynamic_properties", "transform(dynamic_properties, p -> named_struct('name', p.name, 'value', p.value + IF(ordinal % 29 = 0, 1.0D, 0.0D)))"),
        "layers": left["layers"],
        "layouts": left["layouts"].where("ordinal <> 2"),
        "viewports": left["viewports"].withColumn("view_height", F.expr("view_height + IF(ordinal % 7 = 0, 1.0D, 0.0D)")).withColumn("number", F.expr("number + IF(ordinal % 5 = 0, 1, 0)")),
    }
    return reconcile.compare(left, right, 0.005).drop("diagnostic")


def _portable(name: str, rows: str, left: str, right: str, both: str) -> str:
    return f"SELECT '{name}' AS comparison, count(*) FILTER ({left}) AS left_count, count(*) FILTER ({right}) AS right_count, count(*) FILTER ({both}) AS matched, count(*) FILTER ({left}) - count(*) FILTER ({both}) AS left_only, count(*) FILTER ({right}) - count(*) FILTER ({both}) AS right_only, 'compared' AS status FROM {rows}"


_READERS = " UNION ALL ".join([
    _portable("text:TEXT", "customer", "c_custkey % 5 <> 0", "true", "c_custkey % 5 <> 0 AND c_custkey % 11 <> 0"), _portable("text:TEXT_PLUS_ATTDEF", "customer", "true", "true", "c_custkey % 11 <> 0"),
    _portable("text:MTEXT", "part", "true", "p_partkey % 3 <> 0", "p_partkey % 3 <> 0"), _portable("insert:identity_by_handle_and_name", "orders", "true", "o_orderkey % 13 <> 0", "o_orderkey % 13 <> 0"),
    _portable("insert:world_position", "orders", "true", "o_orderkey % 13 <> 0", "o_orderkey % 13 <> 0 AND o_orderkey % 7 <> 0"), _portable("insert:local_transform_tuple", "orders", "true", "o_orderkey % 13 <> 0", "o_orderkey % 13 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0"),
    _portable("insert:root_local_transform_tuple", "orders", "o_orderkey % 2 = 0", "o_orderkey % 2 = 0 AND o_orderkey % 13 <> 0", "o_orderkey % 2 = 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 9 <> 0"),
    _portable("primitive:LINE", "supplier", "true", "true", "s_suppkey % 6 <> 0"), _portable("primitive:LWPOLYLINE", "part", "true", "true", "p_partkey % 4 <> 0"), _portable("primitive:CIRCLE", "nation", "true", "true", "n_nationkey % 3 <> 0"),
]) + f" UNION ALL SELECT 'primitive:ARC', (SELECT count(*) FROM region), (SELECT count(*) FROM region WHERE r_regionkey > 0), NULL, NULL, NULL, '{reconcile.ARC_STATUS}'"


@query(_READERS)
def portable_compare(spark, sf_dir):
    """Records of a portable reader against native ones, by signatures of their own for each kind."""
    t = {n: table(spark, sf_dir, n) for n in ("customer", "part", "orders", "supplier", "nation", "region")}
    fields = {"entity_type": "string", "handle": "string", "text": "string", "block_name": "string", "block_path": "string", "position": "array<double>", "rotation_radians": "double", "scale": "array<double>", "start": "array<double>", "end": "array<double>", "vertices": "array<struct<x:double,y:double>>", "closed": "boolean", "center": "array<double>", "radius": "double"}
    entity = lambda df, **have: df.select(*[F.expr(have.get(n, "NULL")).cast(kind).alias(n) for n, kind in fields.items()])
    portable = [
        entity(t["customer"], entity_type="IF(c_custkey % 5 = 0, 'ATTDEF', 'TEXT')", handle="lower(hex(c_custkey))", text="c_name", position="array(c_acctbal, 1.0D, 0.0D)"),
        entity(t["part"], entity_type="'MTEXT'", handle="concat('A', hex(p_partkey))", text="p_name", position="array(p_retailprice, 2.0D, 0.0D)"),
        entity(t["orders"], entity_type="'INSERT'", handle="hex(o_orderkey)", block_name="o_orderstatus", block_path="IF(o_orderkey % 2 = 0, '', 'in')", position="array(o_totalprice, 3.0D, 0.0D)", rotation_radians="0.5D", scale="array(1.0D, 1.0D, 1.0D)"),
        entity(t["supplier"], entity_type="'LINE'", handle="hex(s_suppkey)", start="array(s_acctbal, 4.0D, 0.0D)", end="array(s_acctbal - 9, 5.0D, 0.0D)"),
        entity(t["part"], entity_type="'LWPOLYLINE'", handle="concat('B', hex(p_partkey))", vertices="array(named_struct('x', 1.0D, 'y', p_retailprice), named_struct('x', 0.0D, 'y', 0.0D), named_struct('x', 2.0D, 'y', 7.0D))", closed="p_partkey % 2 = 0"),
        entity(t["nation"], entity_type="'CIRCLE'", handle="hex(n_nationkey)", center="array(CAST(n_nationkey AS DOUBLE), 1.0D)", radius="2.0D"),
        entity(t["region"], entity_type="'ARC'", handle="hex(r_regionkey)"),
    ]
    text = t["customer"].selectExpr("'DBText' AS entity_type", "hex(c_custkey) AS handle", "c_name AS text", "c_acctbal + IF(c_custkey % 11 = 0, 1.0D, 0.0D) AS x", "1.0D AS y", "0.0D AS z")
    text = text.union(t["part"].where("p_partkey % 3 <> 0").selectExpr("'MText'", "concat('A', hex(p_partkey))", "p_name", "p_retailprice", "2.0D", "0.0D"))
    symbol = t["orders"].where("o_orderkey % 13 <> 0").selectExpr("hex(o_orderkey) AS instance_handle", "o_orderstatus AS block_name", "IF(o_orderkey % 2 = 0, NULL, 'p') AS parent_instance_key", "o_totalprice + IF(o_orderkey % 7 = 0, 1.0D, 0.0D) AS x", "3.0D AS y", "0.0D AS z", "0.5D + IF(o_orderkey % 9 = 0, 0.1D, 0.0D) AS local_rotation_radians", "1.0D AS scale_x", "1.0D AS scale_y", "1.0D AS scale_z")
    shape = {"entity_type": "string", "handle": "string", "min_x": "double", "min_y": "double", "max_x": "double", "max_y": "double", "center_x": "double", "center_y": "double", "vertex_count": "int", "closed": "boolean"}
    native = lambda df, **have: df.select(*[F.expr(have.get(n, "NULL")).cast(kind).alias(n) for n, kind in shape.items()])
    primitive = native(t["supplier"], entity_type="'Line'", handle="hex(s_suppkey)", min_x="s_acctbal - 9", min_y="4", max_x="s_acctbal", max_y="5 + IF(s_suppkey % 6 = 0, 1, 0)")
    primitive = primitive.union(native(t["part"], entity_type="'Polyline'", handle="concat('B', hex(p_partkey))", min_x="0", min_y="0", max_x="2", max_y="greatest(p_retailprice, 7)", vertex_count="3", closed="(p_partkey % 2 = 0) <> (p_partkey % 4 = 0)"))
    primitive = primitive.union(native(t["nation"], entity_type="'Circle'", handle="hex(n_nationkey)", center_x="n_nationkey + IF(n_nationkey % 3 = 0, 1, 0)", center_y="1")).union(native(t["region"].where("r_regionkey > 0"), entity_type="'Arc'", handle="hex(r_regionkey)"))
    rows = portable[0]
    for more in portable[1:]:
        rows = rows.union(more)
    return reconcile.compare_portable(rows, text, symbol, primitive)


_C = clearance
_differs = lambda reason: f"'{_C.GEOMETRY_DIFFERS}{reason}{_C.NOT_JUDGED}'"


@query(f"""SELECT 'D' || p_partkey AS registry_device_id, '{_C.CANDIDATE}' AS status, 'F' || p_partkey AS beam_id, CASE WHEN p_partkey % 8 = 0 THEN '{_C.NO_RECORD}' WHEN p_partkey % 13 = 0 THEN {_differs(_C.OTHER_SUPPORT)} WHEN p_partkey % 11 = 0 THEN '{_C.NO_FACES}'
WHEN p_partkey % 7 = 0 THEN {_differs(_C.OUT_OF_FACES)} WHEN p_partkey % 5 = 0 THEN '{_C.NO_CONSUMER}' WHEN p_partkey % 9 = 0 THEN '{_C.NO_INTERVALS}' WHEN p_partkey % 4 <> 0 THEN '{_C.INSIDE}{_C.STAYS_CANDIDATE}' ELSE {_differs(_C.OUT_OF_INTERVALS)} END AS reason,
'KL' || p_size AS beam_number, 300.0::DOUBLE AS width, (p_size * 10)::DOUBLE AS height, 'formal_shared_beam_references' AS source FROM part""")
def formal_beams(spark, sf_dir):
    """Devices whose lower support only the ledger of formal beams tells: their projection across and along it, and its size."""
    k = F.col("p_partkey")
    flat = k % 2 == 0
    null = lambda when, value: F.when(~when, value)
    numbers = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    link = F.struct(F.lit("1F").alias("support_floor"), F.lit("A").alias("component_id"), F.lit("root").alias("actual_insert_root"), F.when(flat, "horizontal").otherwise("vertical").alias("orientation"), null(k % 11 == 0, numbers(100, 0, 900, 200)).alias("mapped_envelope"), F.lit(_C.CONFIRMED).alias("mapping_status"))
    reference = F.struct(F.lit(_C.CONFIRMED).alias("status"), F.concat(F.lit("F"), k).alias("formal_beam_id"), F.concat(F.lit("KL"), F.col("p_size")).alias("beam_number"), F.lit(300.0).alias("width_mm"), (F.col("p_size") * 10).cast("double").alias("height_mm"))
    device = F.struct(F.concat(F.lit("D"), k).alias("registry_device_id"), F.concat(F.lit("B"), k % 3).alias("building_id"), F.struct(link.alias("lower")).alias("support_links"), F.struct(reference.alias("lower")).alias("formal_shared_beam_references"))
    faces = F.when(flat, F.when(k % 7 == 0, numbers(0, 198)).otherwise(numbers(200.5, -0.5))).otherwise(F.when(k % 7 == 0, numbers(102, 900)).otherwise(numbers(99.5, 900.5)))
    identity = F.struct(F.concat(F.lit("B"), k % 3).alias("building_id"), F.lit("1F").alias("support_floor"), F.when(k % 13 == 0, "B").otherwise("A").alias("component_id"), F.lit("ROOT").alias("actual_insert_root"), F.when(flat, "horizontal").otherwise("vertical").alias("orientation"), faces.alias("face_coordinates_mm"))
    uses = null(k % 5 == 0, F.array(F.struct(F.concat(F.lit("D"), k).alias("registry_device_id"), F.lit("lower").alias("support_role"))))
    intervals = F.when(k % 9 == 0, F.array()).otherwise(F.array(numbers(5000, 6000), F.when(k % 4 == 0, numbers(150, 880)).otherwise(numbers(900, 0))))
    beam = F.struct(F.concat(F.lit("F"), k).alias("formal_beam_id"), identity.alias("identity"), uses.alias("consumer_supports"), intervals.alias("target_along_intervals_mm"))
    part = table(spark, sf_dir, "part")
    devices = part.select(F.from_json(F.to_json(device), _C.DEVICES).alias("d")).select("d.*")
    beams = part.where("p_partkey % 8 <> 0").select(F.from_json(F.to_json(beam), _C.BEAMS).alias("b")).select("b.*")
    return _C.report(devices, beams).select("registry_device_id", "lower_anchorage.status", "lower_anchorage.beam_id", "lower_anchorage.reason", "lower_beam.beam_number", F.col("lower_beam.width_mm").alias("width"), F.col("lower_beam.height_mm").alias("height"), "lower_beam.source")


@query("""WITH v AS (SELECT c_custkey, n_nationkey % 4 <> 0 AS parent, c_acctbal >= 0 AS own, c_custkey % 5 = 0 AS inherits, CASE WHEN c_custkey % 5 = 0 THEN n_regionkey ELSE c_custkey % 6 END AS layer FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT reason, count(*) AS n FROM (SELECT coalesce(nullif(concat_ws(';', CASE WHEN NOT parent THEN 'hidden_parent' END, CASE WHEN NOT own THEN 'entity_visible_false' END, CASE WHEN layer = 5 THEN 'effective_layer_unreadable' END,
CASE WHEN layer IN (1, 2) THEN 'effective_layer_off' END, CASE WHEN layer = 2 THEN 'effective_layer_frozen' END, CASE WHEN layer = 3 THEN 'effective_layer_hidden' END, CASE WHEN inherits THEN 'layer0_inherits_parent_layer' END), ''), 'visible_in_database') AS reason FROM v) AS r GROUP BY reason""")
def visibility_reasons(spark, sf_dir):
    """All reasons why instances are hidden: by their parent, themselves, their layer's states, or a layer that cannot be read."""
    layers = table(spark, sf_dir, "region").selectExpr("r_regionkey AS layer", "named_struct('is_off', r_regionkey IN (1, 2), 'is_frozen', r_regionkey = 2, 'is_hidden', r_regionkey = 3) AS state")
    nation = table(spark, sf_dir, "nation").selectExpr("n_nationkey", "n_nationkey % 4 <> 0 AS parent", "n_regionkey")
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("inherits", F.col("c_custkey") % 5 == 0)
    rows = rows.withColumn("layer", F.when(F.col("inherits"), F.col("n_regionkey")).otherwise(F.col("c_custkey") % 6)).join(layers, "layer", "left")
    reason = scalar.visibility_reason(F.col("parent"), F.col("c_acctbal") >= 0, F.col("state"), F.col("inherits"))
    return rows.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT n_name AS document, 'summary.evidence_record_count does not match the records' AS error FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_name, 'metadata.absence_proven must be false' FROM nation WHERE n_nationkey % 4 = 0
UNION ALL SELECT n_name, 'evidence_records[' || (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) || '].layer must be a text' FROM customer JOIN nation ON c_nationkey = n_nationkey QUALIFY c_custkey % 10 = 0
UNION ALL SELECT n_name, 'instance_key given more than once: K' || c_custkey // 50 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, c_custkey // 50 HAVING count(*) > 1""")
def portable_rules(spark, sf_dir):
    """What is wrong with portable evidence: a document for each nation, its customers as records."""
    meta = dict(validators.PORTABLE)
    record = F.struct(F.col("c_custkey").alias("k"), F.lit("LINE").alias("entity_type"), F.hex("c_custkey").alias("handle"), F.concat(F.lit("K"), F.floor(F.col("c_custkey") / 50)).alias("instance_key"), F.lit("Model").alias("root_space"), F.lit("").alias("block_path"), F.when(F.col("c_custkey") % 10 != 0, "0").alias("layer"), F.array(F.col("c_acctbal")).alias("start"))
    lists = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_sort(F.collect_list(record)).alias("records"))
    rows = table(spark, sf_dir, "nation").join(lists, F.col("n_nationkey") == F.col("c_nationkey"))
    fields = [F.when(F.col("n_nationkey") % 4 == 0, not v).otherwise(v).alias(k) if k == "absence_proven" else F.lit(v).alias(k) for k, v in meta.items()]
    documents = rows.select(F.col("n_name").alias("document"), F.struct(*fields, F.lit(validators.STATUSES[0]).alias("status"), F.lit("A" * 64).alias("source_sha256")).alias("metadata"), F.struct((F.size("records") + F.when(F.col("n_nationkey") % 3 == 0, 1).otherwise(0)).cast("bigint").alias("evidence_record_count")).alias("summary"), F.transform("records", lambda r: r.dropFields("k")).alias("evidence_records"))
    return validators.portable_errors(documents)


_PATH = "replace(p_brand, '#', '') || '/' || p_size || '/' || p_partkey || '.txt'"


@query(f"""WITH l AS (SELECT {_PATH} AS path, p_name AS body, p_partkey AS k, p_brand AS b, p_size AS s FROM part WHERE NOT (p_brand LIKE '%2' AND p_size % 5 = 1) AND p_partkey % 31 <> 0 AND p_brand NOT LIKE '%7'), r AS (SELECT {_PATH} AS path, p_name || CASE WHEN p_partkey % 17 = 0 THEN '!' ELSE '' END AS body, p_brand AS b, p_size AS s FROM part WHERE NOT (p_brand LIKE '%3' AND p_size % 4 = 1)),
f AS (SELECT path, 'left' AS side, split_part(path, '/', 1) || '/' AS top, split_part(path, '/', 1) || '/' || split_part(path, '/', 2) || '/' AS sub FROM l WHERE path NOT IN (SELECT path FROM r) UNION ALL SELECT path, 'right', split_part(path, '/', 1) || '/', split_part(path, '/', 1) || '/' || split_part(path, '/', 2) || '/' FROM r WHERE path NOT IN (SELECT path FROM l)),
tops AS (SELECT 'left' AS side, split_part(path, '/', 1) || '/' AS d FROM l UNION SELECT 'right', split_part(path, '/', 1) || '/' FROM r UNION SELECT 'left', split_part(path, '/', 1) || '/' || split_part(path, '/', 2) || '/' FROM l UNION SELECT 'right', split_part(path, '/', 1) || '/' || split_part(path, '/', 2) || '/' FROM r)
SELECT DISTINCT CASE WHEN top NOT IN (SELECT d FROM tops WHERE side <> f.side) THEN top WHEN sub NOT IN (SELECT d FROM tops WHERE side <> f.side) THEN sub ELSE path END AS path, side, top IN (SELECT d FROM tops WHERE side <> f.side) AND sub IN (SELECT d FROM tops WHERE side <> f.side) AS is_file FROM f
UNION ALL SELECT path, 'both', true FROM l JOIN r USING (path) WHERE l.body <> r.body""")
def tree_branches(spark, sf_dir):
    """Two trees of files by brand and size: folders and files that one lacks, and files that differ."""
    part = table(spark, sf_dir, "part").withColumn("path", F.concat(F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("/"), F.col("p_size"), F.lit("/"), F.col("p_partkey"), F.lit(".txt")))
    sha = lambda body: F.upper(F.sha2(body.cast("binary"), 256)).alias("sha256")
    left = part.where("NOT (p_brand LIKE '%2' AND p_size % 5 = 1) AND p_partkey % 31 <> 0 AND p_brand NOT LIKE '%7'").select("path", sha(F.col("p_name")))
    right = part.where("NOT (p_brand LIKE '%3' AND p_size % 4 = 1)").select("path", sha(F.concat("p_name", F.when(F.col("p_partkey") % 17 == 0, "!").otherwise(""))))
    return registry.tree_differences(left, right)


@query("""SELECT n_name || '.dwg' AS name, 'drawing' AS role, upper(sha256(CASE WHEN n_nationkey % 3 = 0 THEN 'AC10' || (18 + n_nationkey % 15) WHEN n_nationkey % 3 = 1 THEN 'ac1032' ELSE 'X' END || ' of ' || n_name || chr(10))) AS sha256,
length(CASE WHEN n_nationkey % 3 = 0 THEN 'AC10' || (18 + n_nationkey % 15) WHEN n_nationkey % 3 = 1 THEN 'ac1032' ELSE 'X' END || ' of ' || n_name) + 1 AS bytes, CASE WHEN n_nationkey % 3 = 0 THEN 'AC10' || (18 + n_nationkey % 15) ELSE 'UNRECOGNIZED' END AS version FROM nation""")
def drawing_snapshots(spark, sf_dir):
    """Files written for each nation, with their role, hash, size and drawing version."""
    key = F.col("n_nationkey")
    head = F.when(key % 3 == 0, F.concat(F.lit("AC10"), (18 + key % 15).cast("string"))).when(key % 3 == 1, "ac1032").otherwise("X")
    folder = lineage.new_path(spark)
    table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.concat(head, F.lit(" of "), "n_name").alias("line")).repartition("name").write.partitionBy("name").text(folder)
    rows = exports.snapshot(spark, f"{folder}/name=*/*.txt", "drawing")
    return rows.select(F.concat(F.url_decode(F.regexp_extract("path", "name=([^/]*)/", 1)), F.lit(".dwg")).alias("name"), "role", "sha256", "bytes", "version")


_NAME = """CASE p_partkey % 6 WHEN 0 THEN '结构平面' WHEN 1 THEN '梁' WHEN 2 THEN '目录' WHEN 3 THEN 'Plan' WHEN 4 THEN '电气' ELSE '阻尼器' END"""
_FILE = f"CASE WHEN p_partkey % 12 = 3 THEN '' ELSE 'd' || p_partkey % 3 || '/' END || {_NAME} || '_' || p_size || p_brand || CASE WHEN p_partkey % 4 <> 0 THEN '-2024010' || (1 + p_partkey % 4 + p_partkey % 3) ELSE '' END || CASE WHEN p_partkey % 7 = 0 THEN '-' || p_partkey ELSE '' END || '.dwg'"


@query(f"""WITH f AS (SELECT DISTINCT {_FILE} AS path, upper(sha256(p_size::VARCHAR || p_brand)) AS sha256 FROM part),
n AS (SELECT *, regexp_replace(string_split(path, '/')[-1], '\\.dwg$', '') AS name FROM f), d AS (SELECT *, nullif(regexp_extract(name, '-(2024010[0-9])(-|$)', 1), '') AS file_date FROM n),
r AS (SELECT *, regexp_replace(lower(CASE WHEN file_date IS NOT NULL THEN replace(name, file_date, '') ELSE name END), '[ _.-]+', '', 'g') AS family, CASE WHEN contains(path, '电气') THEN 'excluded' WHEN contains(path, '目录') THEN 'reference' WHEN contains(path, '阻尼器') OR contains(path, '结构平面') THEN 'selected' WHEN contains(path, '梁') THEN 'supporting'
 WHEN NOT contains(path, '/') AND file_date IS NOT NULL THEN 'project_package_candidate' ELSE 'uncertain' END AS role FROM d),
t AS (SELECT *, CASE WHEN role IN ('reference', 'excluded') THEN role WHEN file_date < max(file_date) OVER (PARTITION BY family) THEN 'older_revision' WHEN path <> min(path) OVER (PARTITION BY family, sha256) THEN 'exact_duplicate' ELSE role END AS tier FROM r)
SELECT path, sha256, family, file_date, role, tier, list_position(['selected', 'project_package_candidate', 'supporting', 'uncertain', 'reference', 'older_revision', 'exact_duplicate', 'excluded'], tier)::BIGINT AS priority FROM t""")
def directory_tiers(spark, sf_dir):
    """Drawings of a folder by what their names say: role, family, date, older revisions and equal files."""
    k = F.col("p_partkey")
    name = F.element_at(F.array(*[F.lit(n) for n in ("结构平面", "梁", "目录", "Plan", "电气", "阻尼器")]), (k % 6 + 1).cast("int"))
    date = F.when(k % 4 != 0, F.concat(F.lit("-2024010"), 1 + k % 4 + k % 3)).otherwise("")
    path = F.concat(F.when(k % 12 == 3, "").otherwise(F.concat(F.lit("d"), k % 3, F.lit("/"))), name, F.lit("_"), "p_size", "p_brand", date, F.when(k % 7 == 0, F.concat(F.lit("-"), k)).otherwise(""), F.lit(".dwg"))
    files = table(spark, sf_dir, "part").select(path.alias("path"), F.upper(F.sha2(F.concat(F.col("p_size").cast("string"), "p_brand").cast("binary"), 256)).alias("sha256")).distinct()
    return registry.directory_tiers(files, "电气")
