"""Projections of entities: the fields of each type, points with roles, hatch loops, frame candidates, what to explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: what a record of each type has beside the fields that all have
TEXT = ["text", "position", "rotation_radians", "height"]
FIELDS = {
    "TEXT": TEXT,
    "ATTDEF": [*TEXT, "tag", "definition_template_not_placed_value"],
    "ATTRIB": [*TEXT, "tag"],
    "MTEXT": [*TEXT, "plain_text", "rectangle_width"],
    "INSERT": ["block_name", "block_handle", "position", "rotation_radians", "scale", "attribute_count", "is_multiple", "row_count", "column_count", "row_spacing", "column_spacing"],
    "LINE": ["start", "end"],
    "LWPOLYLINE": ["closed", "vertices"],
    "ARC": ["center", "radius", "start_angle_radians", "end_angle_radians"],
    "CIRCLE": ["center", "radius"],
    "POINT": ["position"],
}
# fixed values: the points that dimensions of one class or another have
DIMENSION_POINTS = ["XLine1Point", "XLine2Point", "DimLinePoint", "DefiningPoint", "LeaderEndPoint", "Center", "CenterPoint", "ChordPoint", "FarChordPoint", "XLine1Start", "XLine1End", "XLine2Start", "XLine2End", "ArcPoint"]


def by_type(df: DataFrame, kind: str, fields: dict[str, list[str]] = FIELDS) -> DataFrame:
    """df with each row's fields left as they are where its type has them, else null; numbers that are not finite become null too.

    Columns that no type lists stay. A type that is not listed is an error, and so is a null one.
    """
    listed = {f for names in fields.values() for f in names}
    known = F.coalesce(F.col(kind).isin(list(fields)), F.lit(False))
    checked = F.when(known, F.col(kind)).otherwise(F.raise_error(F.concat(F.lit("no fields are known for type "), F.coalesce(F.col(kind), F.lit("null")))).cast("string"))

    def value(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
        return F.when(F.col(kind).isin([k for k, names in fields.items() if f.name in names]), c).alias(f.name)

    return df.select(*[checked.alias(kind) if f.name == kind else value(f) if f.name in listed else F.col(f.name) for f in df.schema.fields])


def known_points(points: dict[str, Column]) -> Column:
    """An array of (role, x, y, z) of those points, structs with x, y and z, that are there."""
    every = F.array(*[F.when(p.isNotNull(), F.struct(F.lit(role).alias("role"), p["x"].alias("x"), p["y"].alias("y"), p["z"].alias("z"))) for role, p in points.items()])
    return F.filter(every, lambda p: p.isNotNull())


def dimension_points(df: DataFrame, text_position: str = "text_position") -> Column:
    """The text position of a dimension, then the points that it has, in their declared order; names that df lacks are left out."""
    return known_points({n: F.col(n) for n in [text_position, *DIMENSION_POINTS] if n in df.columns})


# fixed values: the roles of the corners of an entity's bounds, and which end of x and y each has
BOUNDS = [("bounds_min", "min", "min"), ("bounds_max_x_min_y", "max", "min"), ("bounds_max", "max", "max"), ("bounds_min_x_max_y", "min", "max")]


def kind_record(df: DataFrame) -> DataFrame:
    """df, which has class, closed, start, end, center (structs of x, y, z), vertices (an array of those) and bounds (min and max), with (kind, points).

    Lines have a start and an end, polylines their vertices, circles and arcs a centre; any
    other class has the corners of its bounds, a closed figure, or none where these are not known.
    """
    cls, box = F.col("class"), F.col("bounds")
    vertices = F.transform("vertices", lambda v, i: F.struct(F.concat(F.lit("vertex_"), i.cast("string")).alias("role"), v["x"].alias("x"), v["y"].alias("y"), v["z"].alias("z")))
    known = box["min"].isNotNull() & box["max"].isNotNull()
    corners = known_points({role: F.when(known, F.struct(box[x]["x"].alias("x"), box[y]["y"].alias("y"), box["min"]["z"].alias("z"))) for role, x, y in BOUNDS})
    kind = F.when(cls.isin("Line", "Polyline", "Circle", "Arc"), F.lower(cls)).when(known, "entity_bounds").otherwise("entity_unresolved")
    points = F.when(cls == "Line", known_points({"start": F.col("start"), "end": F.col("end")})).when(cls == "Polyline", vertices).when(cls.isin("Circle", "Arc"), known_points({"center": F.col("center")})).otherwise(corners)
    return df.withColumns({"kind": kind, "points": points, "closed": F.when(kind == "entity_bounds", True).otherwise(F.col("closed"))})


# fixed values: classes of texts and of inserts, and their kinds
TEXT_CLASSES, INSERT_CLASS = ("DBText", "MText", "AttributeReference", "AttributeDefinition"), "BlockReference"


def evidence_records(df: DataFrame, most_loops: int = 512, most_points: int = 20000) -> DataFrame:
    """df with (kind, points, closed, radius, start_angle, end_angle, text, x, y, z, measurement, hatch) of every kind of record.

    df has class and what its classes have of position, text, closed, start, end, center,
    radius, start_angle, end_angle, vertices, bounds, loops, text_position, measurement and
    the points of dimensions; a column that it lacks is null for all. A text and an insert
    have a position and no points, a dimension its text's position and the points that it
    has, a hatch its loops and the corners of its bounds; all others are as in kind_record().
    A field that a kind does not have is null.
    """
    point = "struct<x:double,y:double,z:double>"
    may = {"position": point, "text": "string", "closed": "boolean", "start": point, "end": point, "center": point, "radius": "double", "start_angle": "double", "end_angle": "double", "vertices": f"array<{point}>", "bounds": f"struct<min:{point},max:{point}>", "loops": "array<struct<is_polyline:boolean,points:array<struct<role:string,x:double,y:double>>>>", "text_position": point, "measurement": "double"}
    rows = kind_record(df.withColumns({k: F.lit(None).cast(t) for k, t in may.items() if k not in df.columns}))
    cls = F.col("class")
    text, insert, dimension, hatch = cls.isin(*TEXT_CLASSES), cls == INSERT_CLASS, F.coalesce(cls.endswith("Dimension"), F.lit(False)), cls == "Hatch"
    placed = text | insert
    none = F.filter("points", lambda p: F.lit(False))
    kind = F.when(text, "text").when(insert, "block_reference").when(dimension, "dimension").when(hatch, "hatch").otherwise(F.col("kind"))
    at = F.when(placed, F.col("position")).when(dimension, F.col("text_position"))
    return rows.withColumns({
        "kind": kind, "points": F.when(placed, none).when(dimension, dimension_points(rows)).otherwise(F.col("points")), "closed": F.when(placed | dimension, False).when(hatch, F.size("points") > 0).otherwise(F.coalesce("closed", F.lit(False))),
        "radius": F.when(cls.isin("Circle", "Arc"), F.col("radius")), "start_angle": F.when(cls == "Arc", F.col("start_angle")), "end_angle": F.when(cls == "Arc", F.col("end_angle")),
        "text": F.when(text | dimension, F.coalesce("text", F.lit(""))), "x": at["x"], "y": at["y"], "z": at["z"], "measurement": F.when(dimension, F.col("measurement")), "hatch": F.when(hatch & F.col("loops").isNotNull(), hatch_evidence(F.col("loops"), most_loops, most_points)),
    })


def hatch_evidence(loops: Column, most_loops: int = 512, most_points: int = 20000) -> Column:
    """(loops, n_loops, n_points, truncated) of an array of loops (is_polyline, points (role, ..)).

    At most so many loops are kept, and so many points in all of them, the first ones;
    n_loops counts all. truncated says that a loop, a vertex or a curve is missing; the end
    of a loop's last curve, where its start is kept and it alone is beyond the limit, is none.
    A loop without points, empty or null, counts as a loop.
    """
    n_of = lambda l: F.coalesce(F.size(l["points"]), F.lit(0))
    numbered = lambda first: F.transform(F.slice(loops, 1, first), lambda l, i: F.struct(i.alias("loop_index"), l["is_polyline"].alias("is_polyline"), l["points"].alias("points"), n_of(l).alias("n")))

    def one(l: Column, room: Column) -> Column:
        points, over = l["points"], l["n"] - room
        last, previous = F.try_element_at(points["role"], F.lit(-1)), F.try_element_at(points["role"], F.lit(-2))
        half_curve = ~l["is_polyline"] & (over == 1) & F.coalesce(previous == F.regexp_replace(last, "_end$", "_start"), F.lit(False)) & last.endswith("_end")
        return F.struct(l["loop_index"].alias("loop_index"), l["is_polyline"].alias("is_polyline"), F.slice(points, 1, F.greatest(room, F.lit(1))).alias("points"), ((over > 0) & ~half_curve).alias("cut"))

    # one fold carries the room that is left from loop to loop; a loop is kept where there is any
    def add(a: Column, l: Column) -> Column:
        room = a["room"]
        return F.struct((room - l["n"]).alias("room"), F.when(room > 0, F.concat(a["kept"], F.array(one(l, room)))).otherwise(a["kept"]).alias("kept"))

    def told(a: Column) -> Column:
        kept, n_loops = a["kept"], F.size(loops)
        n_points = F.aggregate(kept, F.lit(0), lambda n, l: n + n_of(l))
        return F.struct(kept.alias("loops"), n_loops.alias("n_loops"), n_points.alias("n_points"), ((n_loops > F.size(kept)) | F.exists(kept, lambda l: l["cut"])).alias("truncated"))

    none = F.transform(numbered(0), lambda l: one(l, F.lit(most_points)))
    return F.aggregate(numbered(most_loops), F.struct(F.lit(most_points).alias("room"), none.alias("kept")), add, told)


def frame_candidates(df: DataFrame) -> DataFrame:
    """What may be a drawing's frame: closed polylines and inserts whose bounds have a width and a height, and all lines.

    df has class, closed, min_x, min_y, max_x, max_y; the result has candidate too:
    'closed-polyline', 'block-reference' or 'line'.
    """
    area = (F.col("max_x") - F.col("min_x") > 0) & (F.col("max_y") - F.col("min_y") > 0)
    candidate = F.when(F.col("class") == "Line", "line").when(area & (F.col("class") == "Polyline") & F.col("closed"), "closed-polyline").when(area & (F.col("class") == "BlockReference"), "block-reference")
    return df.withColumn("candidate", candidate).where("candidate IS NOT NULL")


def to_explode(handle: Column, kind: Column, pattern: str | None) -> Column:
    """Whether an entity is one that the caller asks to take apart: its handle matches, and it is an insert or of unknown make-up."""
    if not (pattern or "").strip():
        return F.lit(False)
    return F.coalesce(handle.rlike(pattern) & kind.isin("block_reference", "entity_bounds", "entity_unresolved"), F.lit(False))
