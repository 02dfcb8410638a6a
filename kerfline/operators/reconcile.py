"""Comparing the documents of two readers of one drawing: the same kinds of documents, or two kinds of readers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from ..functions.scalar import quantize_text
from . import diff

# fixed values: what is compared of each kind of record, with what several kinds share first; frames list three columns that no document has, null on both sides
_PLACE = ["x", "y", "z"]
_PARENTS = ["instance_handle", "definition_handle", "parent_instance_key", "parent_instance_handle", "root_instance_handle"]
FIELDS = {
    "text": ["entity_type", "origin", "text", *_PLACE, "layer", "space", "handle", "block_path"],
    "frame_lines": ["entity_type", "origin", "space", "layer", "handle", "block_path", "start_x", "start_y", "end_x", "end_y"],
    "symbol": [*_PARENTS, "instance_path", "name_path", "block_name", "effective_name", "is_dynamic", "space", "layer", *_PLACE, "local_rotation_radians", "scale_x", "scale_y", "scale_z", "attributes", "definition_texts"],
    "oriented_text": ["entity_type", "origin", "text", *_PLACE, "local_rotation_radians", "world_rotation_radians", "world_axis_x", "world_axis_y", "layer", "space", "handle", "block_path"],
    "primitive": ["entity_type", "origin", "root_instance_handle", "block_path", "handle", "layer", "linetype", "color_index", "space", "endpoints_valid", "start_x", "start_y", "end_x", "end_y", "curve_geometry_valid", "curve_center_x", "curve_center_y", "curve_mid_x", "curve_mid_y", "curve_radius", "vertex_count", "closed"],
    "primitive_bounds": ["bounds_valid", "min_x", "min_y", "max_x", "max_y", "center_x", "center_y", "width", "height"],
    "visibility": [*_PARENTS, "name_path", "block_name", "effective_name", "is_dynamic", "space", "own_layer", "effective_layer", "inherits_layer_zero", "entity_visible", "parent_effective_visible", "effective_visible_database", "visibility_reason", "own_layer_state", "effective_layer_state", "dynamic_properties"],
}
# fixed values: comparisons, the records that they take, their key (none: as bags) and their columns (none: all that either side has)
COMPARISONS = (
    ("text_core", "text", None, "text"),
    ("frame_lines", "frame_lines", None, "frame_lines"),
    ("symbol_core", "symbol", "instance_key", "symbol"),
    ("oriented_text_core", "oriented_text", "record_key", "oriented_text"),
    ("primitive_core", "primitive", "record_key", "primitive"),
    ("visibility_instance_core", "visibility", "instance_key", "visibility"),
    ("visibility_layers", "layers", "name", None),
    ("visibility_layouts", "layouts", "layout_handle", None),
    ("visibility_viewports", "viewports", "handle", None),
)
CONSISTENT, UNRESOLVED = "native_core_fields_consistent", "native_core_field_comparison_unresolved"


def model_viewports(viewports: DataFrame) -> DataFrame:
    """Those that are not the paper's own."""
    flag = F.col("is_paper_viewport") if "is_paper_viewport" in viewports.columns else F.lit(None).cast("boolean")
    number = F.col("number") if "number" in viewports.columns else F.lit(None).cast("int")
    return viewports.where(~scalar.paper_viewport(flag, number.cast("string")))


def compare(left: dict[str, DataFrame], right: dict[str, DataFrame], tolerance: float = 1e-6) -> DataFrame:
    """(comparison, diagnostic, counts, consistent) for nine comparisons and two diagnostics.

    Both sides have the records by kind; a kind that a side lacks has no rows there. The
    records of a document carry the column ordinal, by which the last of a key is known.
    """
    sides = [{k: (model_viewports(df) if k == "viewports" else df) for k, df in side.items()} for side in (left, right)]
    rows = []

    def add(name: str, kind: str, key: str | None, fields: list[str] | None, diagnostic: bool) -> None:
        both = [s[kind] if kind in s else None for s in sides]
        some = next((b for b in both if b is not None), None)
        if some is None:
            return
        l, r = [b if b is not None else some.limit(0) for b in both]
        columns = fields or [c for c in diff.common_columns(l, r, key) if c not in ("ordinal", *(("number",) if kind == "viewports" else ()))]
        if key is None:
            got = diff.bag_diff(l, r, columns, tolerance).withColumn("mismatched", F.lit(0).cast("bigint")).withColumn("consistent", F.expr("left_only + right_only = 0"))
        else:
            got = diff.keyed_diff(l, r, key, columns, tolerance, ["ordinal"])
        rows.append(got.select(F.lit(name).alias("comparison"), F.lit(diagnostic).alias("diagnostic"), "left_count", "right_count", "matched", "left_only", "right_only", "mismatched", "consistent"))

    for name, kind, key, fields in COMPARISONS:
        add(name, kind, key, FIELDS.get(fields), False)
    add("primitive_bounds", "primitive", "record_key", FIELDS["primitive_bounds"], True)
    add("viewport_number_diagnostics", "viewports", "handle", ["number"], True)
    return diff.union_all(rows)


def status(compared: DataFrame) -> DataFrame:
    """One row (status, backend_equivalent, absence_proven): diagnostics do not count, and nothing is ever proven absent."""
    held = compared.where("not diagnostic").agg(F.coalesce(F.bool_and("consistent"), F.lit(True)).alias("c"))
    return held.select(F.when(F.col("c"), CONSISTENT).otherwise(UNRESOLVED).alias("status"), F.lit(False).alias("backend_equivalent"), F.lit(False).alias("absence_proven"))


# fixed values: class names in native documents and the types of portable records that they stand for
TEXT_CLASSES = {"DBText": "TEXT", "MText": "MTEXT", "AttributeReference": "ATTRIB"}
SHAPE_CLASSES = {"Line": "LINE", "Polyline": "LWPOLYLINE", "Circle": "CIRCLE"}
ARC_STATUS = "not_compared_bounds_need_independent_arc_extents_validation"


def _pick(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _point(df: DataFrame, array: str, names: list[str]) -> list[Column]:
    """Coordinates from an array where the record has one, else from single columns."""
    if array not in df.columns:
        return [_pick(df, n, "double") for n in names]
    return [F.when(F.col(array).isNotNull(), F.get(array, F.lit(i))).otherwise(_pick(df, n, "double")) for i, n in enumerate(names)]


def _signed(df: DataFrame, group: str, where: Column, texts: list[Column], numbers: list[Column], tolerance: float) -> DataFrame:
    nums = F.concat_ws(",", *[quantize_text(n, tolerance) for n in numbers]) if numbers else F.lit("")
    return df.where(where).select(F.lit(group).alias("comparison"), F.to_json(F.array(*[F.coalesce(t.cast("string"), F.lit("")) for t in texts])).alias("identity"), nums.alias("numbers"))


def _handle(df: DataFrame) -> Column:
    own = _pick(df, "handle", "string")
    return F.upper(F.coalesce(own, _pick(df, "instance_handle", "string"), F.lit("")))


def text_signatures(df: DataFrame, kind: Column, tolerance: float, combined: Column) -> list[DataFrame]:
    """Texts by type, handle and place; and all that a reader may take for one text type together."""
    texts, place = [_handle(df), _pick(df, "text", "string")], _point(df, "position", _PLACE)
    out = [_signed(df, f"text:{t}", kind == t, texts, place, tolerance) for t in ("TEXT", "MTEXT", "ATTRIB")]
    return [*out, _signed(df, "text:TEXT_PLUS_ATTDEF", combined, texts, place, tolerance)]


def insert_signatures(df: DataFrame, where: Column, root: Column, tolerance: float) -> list[DataFrame]:
    """Inserts by handle and name; with their place; and with rotation and scale, of roots and of all."""
    texts, place = [_handle(df), _pick(df, "block_name", "string")], _point(df, "position", _PLACE)
    rotation = F.coalesce(_pick(df, "rotation_radians", "double"), _pick(df, "local_rotation_radians", "double"))
    whole = [*place, rotation, *_point(df, "scale", ["scale_x", "scale_y", "scale_z"])]
    return [_signed(df, f"insert:{name}", w, texts, numbers, tolerance) for name, w, numbers in (("identity_by_handle_and_name", where, []), ("world_position", where, place), ("root_local_transform_tuple", where & root, whole), ("local_transform_tuple", where, whole))]


def shape_signatures(df: DataFrame, kind: Column, tolerance: float) -> list[DataFrame]:
    """Lines and polylines by their envelope, circles by their centre; those without finite bounds are left out."""
    stored = [scalar.finite(_pick(df, c, "double")) for c in ("min_x", "min_y", "max_x", "max_y")]
    has = lambda c: c in df.columns

    def bounds(own: list[Column] | None) -> list[Column]:
        if own is None:
            return stored
        return [F.when(_pick(df, "min_x", "double").isNotNull(), s).otherwise(scalar.finite(o)) for s, o in zip(stored, own)]

    ends = [F.least if i < 2 else F.greatest for i in range(4)]
    line = bounds([f(F.get("start", F.lit(i % 2)), F.get("end", F.lit(i % 2))) for i, f in enumerate(ends)] if has("start") and has("end") else None)
    corner = lambda k: F.transform("vertices", lambda v: v[k])
    poly = bounds([F.array_min(corner("x")), F.array_min(corner("y")), F.array_max(corner("x")), F.array_max(corner("y"))] if has("vertices") else None)
    count = F.coalesce(_pick(df, "vertex_count", "int"), F.size("vertices") if has("vertices") else F.lit(0))
    closed = F.coalesce(_pick(df, "closed", "boolean"), F.lit(False))
    known = lambda cols: reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    centre = _point(df, "center", ["center_x", "center_y"])
    return [
        _signed(df, "primitive:LINE", (kind == "LINE") & known(line), [_handle(df)], line, tolerance),
        _signed(df, "primitive:LWPOLYLINE", (kind == "LWPOLYLINE") & known(poly), [_handle(df), count, closed], poly, tolerance),
        _signed(df, "primitive:CIRCLE", kind == "CIRCLE", [_handle(df)], centre, tolerance),
    ]


def compare_portable(portable: DataFrame, text: DataFrame, symbol: DataFrame, primitive: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """(comparison, left_count, right_count, matched, left_only, right_only, status): the portable records, left, against native ones.

    All signatures of one side are rows of one table, so that one shuffle does for all comparisons.
    """
    entity, name = F.col("entity_type"), lambda classes: scalar.type_name(F.col("entity_type"), classes)
    rootless = lambda df, c: F.coalesce(_pick(df, c, "string"), F.lit("")) == ""
    left = text_signatures(portable, entity, tolerance, entity.isin("TEXT", "ATTDEF")) + insert_signatures(portable, entity == "INSERT", rootless(portable, "block_path"), tolerance) + shape_signatures(portable, entity, tolerance)
    right = text_signatures(text, name(TEXT_CLASSES), tolerance, entity == "DBText") + insert_signatures(symbol, F.lit(True), rootless(symbol, "parent_instance_key"), tolerance) + shape_signatures(primitive, name(SHAPE_CLASSES), tolerance)
    found = diff.bag_diff_by(diff.union_all(left), diff.union_all(right), "comparison", ["identity", "numbers"], 0).withColumn("status", F.lit("compared"))
    n = lambda df, kind: df.agg(F.count_if(F.col("entity_type") == kind).alias("n"))
    arcs = n(portable, "ARC").withColumnRenamed("n", "left_count").join(n(primitive, "Arc").withColumnRenamed("n", "right_count"))  # one row each
    none = F.lit(None).cast("bigint")
    return found.unionByName(arcs.select(F.lit("primitive:ARC").alias("comparison"), "left_count", "right_count", none.alias("matched"), none.alias("left_only"), none.alias("right_only"), F.lit(ARC_STATUS).alias("status")))
