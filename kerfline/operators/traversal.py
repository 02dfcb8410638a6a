"""What nested definitions hold, put together from below, and how often each is used.

Inserts are (owner, handle, name, target, m): in the definition `owner` stands an insert of
`target`, moved by the affine map m. Definitions are taken apart in layers: those that use
no other come first, then those that only use these, and so on; each is put together once,
from what the definitions in it were put together to, however often it is used. Only
definitions that lead to a cycle are walked from the roots, path by path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from . import hierarchy
from .lineage import cut

#: Rounds after which peeling gives up instead of looping: deeper nests than any drawing has.
MOST_LAYERS = 1000


def _layers(edges: DataFrame, nodes: DataFrame, most: int = MOST_LAYERS):
    """Yields (nodes of a layer, nodes left, edges left): first those without an edge to another, then those whose edges all lead to earlier ones; ends where only nodes that lead to a cycle are left."""
    for _ in range(most):
        owners = edges.select(F.col("owner").alias("node")).distinct()
        layer = cut(nodes.join(owners, "node", "left_anti"))
        if layer.limit(1).count() == 0:
            return
        nodes = cut(nodes.join(layer, "node", "left_anti"))
        edges = cut(edges.join(layer.withColumnRenamed("node", "target"), "target", "left_anti"))
        yield layer, nodes, edges
    raise ValueError(f"definitions are nested in more than {most} layers")


def _joined(*parts: Column) -> Column:
    """Texts that are not empty, with slashes between them."""
    return F.concat_ws("/", *[F.when(p != "", p) for p in parts])


# inside this module a map is six columns, as Spark's optimiser fails on structs that meet in these joins
_M = geometry.FIELDS


def _of(alias: str) -> dict[str, Column]:
    return {k: F.col(f"{alias}.{k}") for k in _M}


def _composed(outer: str, inner: str) -> list[Column]:
    both = geometry.compose(_of(outer), _of(inner))
    return [both[k].alias(k) for k in _M]


def _unmoved() -> list[Column]:
    return [F.lit(1.0 if k in "ad" else 0.0).alias(k) for k in _M]


def _under(inserts: DataFrame, flat: DataFrame) -> DataFrame:
    """Each insert with each part of its target: (owner and other columns of the insert, path, names, the map, node)."""
    i, f = inserts.alias("i"), flat.alias("f")
    kept = [F.col(f"i.{c}") for c in inserts.columns if c not in ("handle", "name", "target", *_M, "path", "names", "stack")]
    above = [F.col(f"i.{c}") if c in inserts.columns else F.lit("") for c in ("path", "names")]
    return i.join(f, F.col("i.target") == F.col("f.definition")).select(*kept, _joined(above[0], F.col("i.handle"), F.col("f.path")).alias("path"), _joined(above[1], F.col("i.name"), F.col("f.names")).alias("names"), *_composed("i", "f"), "f.node")


def placements(inserts: DataFrame, roots: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """(space, path, names, m, node, issue): every place where a definition's content stands under a root.

    roots has node; each is a space and its own first place, with an empty path. path has
    the handles of the inserts from the root on, names their names. An insert of a
    definition that is on its own path has issue 'cycle' and no content (node null). Inserts
    without a target, and of definitions in external (node), give none.
    """
    edges = inserts.where("target IS NOT NULL").select("owner", "handle", "name", "target", *[F.col("m")[k].alias(k) for k in _M])
    if external is not None:
        edges = edges.join(external.select(F.col("node").alias("target")).distinct(), "target", "left_anti").select("owner", "handle", "name", "target", *_M)
    edges = cut(edges)
    nodes = edges.select(F.col("owner").alias("node")).union(edges.select("target")).union(roots.select("node")).distinct()
    flat, left = None, nodes
    for layer, left, _ in _layers(edges.select("owner", "target").distinct(), nodes):
        own = layer.select(F.col("node").alias("definition"), F.lit("").alias("path"), F.lit("").alias("names"), *_unmoved(), "node")
        if flat is not None:
            used = edges.join(layer.withColumnRenamed("node", "owner"), "owner", "left_semi")
            own = own.union(_under(used, flat).select(F.col("owner").alias("definition"), "path", "names", *_M, "node"))
        flat = cut(own) if flat is None else flat.union(cut(own))
    out, plain = [], F.lit(None).cast("string").alias("issue")
    spaces = roots.select("node").distinct()
    if flat is not None:
        out.append(flat.join(spaces.withColumnRenamed("node", "definition"), "definition", "left_semi").select(F.col("definition").alias("space"), "path", "names", *_M, "node", plain))
    level = cut(spaces.join(left, "node", "left_semi").select(F.col("node").alias("space"), F.lit("").alias("path"), F.lit("").alias("names"), *_unmoved(), "node", F.array("node").alias("stack")))
    while level.limit(1).count():
        out.append(level.select("space", "path", "names", *_M, "node", plain))
        p, e = level.alias("p"), edges.alias("e")
        step = p.join(e, F.col("p.node") == F.col("e.owner")).select("p.space", "p.path", "p.names", *_composed("p", "e"), "e.handle", "e.name", "e.target", "p.stack")
        again = F.array_contains("stack", F.col("target"))
        if flat is not None:
            out.append(_under(step, flat).select("space", "path", "names", *_M, "node", plain))
        here = step.select("space", _joined(F.col("path"), F.col("handle")).alias("path"), _joined(F.col("names"), F.col("name")).alias("names"), *_M, F.col("target").alias("node"), "stack", again.alias("again"))
        out.append(here.where("again").select("space", "path", "names", *_M, F.lit(None).cast(here.schema["node"].dataType).alias("node"), F.lit("cycle").alias("issue")))
        level = cut(here.where("NOT again").join(left, "node", "left_semi").select("space", "path", "names", *_M, "node", F.concat("stack", F.array("node")).alias("stack")))
    return reduce(DataFrame.union, out).select("space", "path", "names", F.struct(*_M).alias("m"), "node", "issue")


def _dealt(places: DataFrame, entities: DataFrame, most: int = 50_000) -> DataFrame:
    """places joined to entities at node == owner; a node with more than `most` places or entities is dealt to several tasks.

    Its entities are dealt to so many parts, and each of its places goes to all of these, and
    the other way round, so that each pair still meets once.
    """
    n_places, n_entities = places.groupBy(F.col("node").alias("at_")).agg(F.count("*").alias("places_")), entities.groupBy(F.col("owner").alias("at_")).agg(F.count("*").alias("entities_"))
    of = lambda n: F.ceil(F.col(n) / most).cast("int")
    # a node in so many rows only: few enough to be sent to all tasks, so that no side is brought together by node alone
    hot = F.broadcast(cut(n_places.join(n_entities, "at_").select("at_", of("places_").alias("p_"), of("entities_").alias("e_")).where("p_ > 1 OR e_ > 1")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1))
    own = lambda df, n: F.when(F.col(n) > 1, F.pmod(F.xxhash64(*df.columns), F.col(n))).otherwise(0).cast("int")
    p = places.join(hot, F.col("node") == F.col("at_"), "left").withColumn("part_p", own(places, "p_")).withColumn("part_e", every("e_")).drop("at_", "p_", "e_")
    e = entities.join(hot, F.col("owner") == F.col("at_"), "left").withColumn("of_e", own(entities, "e_")).withColumn("of_p", every("p_")).drop("at_", "p_", "e_")
    return p.join(e, (F.col("node") == F.col("owner")) & (F.col("part_p") == F.col("of_p")) & (F.col("part_e") == F.col("of_e"))).drop("part_p", "part_e", "of_p", "of_e")


def placed_entities(places: DataFrame, entities: DataFrame) -> DataFrame:
    """The entities (owner, handle, ..) of each place, with record_key, origin, space, block_path, root_handle and its map m."""
    direct = F.col("path") == ""
    rows = _dealt(places.where("node IS NOT NULL"), entities)
    keyed = {"record_key": F.concat(F.when(direct, "direct").otherwise(F.col("path")), F.lit("/"), F.col("handle")), "origin": F.when(direct, "direct").otherwise("block-definition"), "root_handle": F.when(~direct, F.substring_index("path", "/", 1))}
    return rows.withColumns(keyed).withColumnRenamed("names", "block_path").drop("node", "owner", "path", "issue")


_BOX = ("min_x", "min_y", "max_x", "max_y")


def _boxed(entities: DataFrame) -> DataFrame:
    """The entities with null for bounds of which a side is not known."""
    return entities.withColumn("bounds", F.when(reduce(Column.__and__, [F.col("bounds")[k].isNotNull() for k in _BOX]), F.col("bounds")))


def _bounded(rows: DataFrame) -> DataFrame:
    """bounds as the box of its four corners under m, null where it is null.

    Corners are columns, so that each is worked out once, and no arrays, whose functions are
    not compiled.
    """
    m, box = F.col("m"), F.col("bounds")
    corners = [geometry.point(m, box[x], box[y]) for x in ("min_x", "max_x") for y in ("min_y", "max_y")]
    at = {axis: [f"{axis}{k}_" for k in range(4)] for axis in "xy"}
    rows = rows.withColumns({at[axis][k]: v for k, corner in enumerate(corners) for axis, v in zip("xy", corner)})
    sides = [(F.least if k.startswith("min") else F.greatest)(*at[k[-1]]).alias(k) for k in _BOX]
    return rows.withColumn("bounds", F.when(box.isNotNull(), F.struct(*sides))).drop(*at["x"], *at["y"])


def oriented_texts(places: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts in the world: position, own rotation, direction and rotation in the world, bounds.

    texts has owner, handle, entity_type, text, x, y, rotation, layer, and bounds (min_x,
    min_y, max_x, max_y). Blank texts are left out. A direction that the map shrinks to
    under 1e-12 stays as short as it is.
    """
    rows = _bounded(placed_entities(places, _boxed(texts.where(F.col("text").rlike("\\S")))))
    m, cos, sin = F.col("m"), F.cos("rotation"), F.sin("rotation")
    x, y = geometry.point(m, F.col("x"), F.col("y"))
    rows = rows.withColumns({"x": x, "y": y, "axis_x": m["a"] * cos + m["b"] * sin, "axis_y": m["c"] * cos + m["d"] * sin})
    length = F.sqrt(F.col("axis_x") * F.col("axis_x") + F.col("axis_y") * F.col("axis_y"))
    rows = rows.withColumn("length_", F.when(length > 1e-12, length).otherwise(1.0))
    rows = rows.withColumns({"axis_x": F.col("axis_x") / F.col("length_"), "axis_y": F.col("axis_y") / F.col("length_")}).withColumn("world_rotation", F.atan2("axis_y", "axis_x"))
    return rows.withColumnRenamed("rotation", "local_rotation").withColumn("bounds_valid", F.col("bounds").isNotNull()).drop("m", "length_")


# fixed values: the classes that are primitives
PRIMITIVES = ("Arc", "Circle", "Hatch", "Line", "Polyline")


def primitives(places: DataFrame, entities: DataFrame) -> DataFrame:
    """Arcs, circles, hatches, lines and polylines in the world.

    entities has owner, handle, entity_type, layer, start and end (x, y) of lines, center (x,
    y), radius, start_angle and end_angle of arcs, vertices (an array) and closed of
    polylines, and bounds. Arcs have start, mid, end, centre and the radius from the centre
    to the start as they lie in the world, lines their ends; others only bounds.
    """
    is_arc, is_line = F.col("entity_type") == "Arc", F.col("entity_type") == "Line"
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    arc = {k: F.when(is_arc, at(*v)) for k, v in geometry.on_arc(F.col("center.x"), F.col("center.y"), F.col("radius"), F.col("start_angle"), F.col("end_angle")).items()}
    # points of an arc in its definition are worked out before it is placed, once for all places
    own = entities.where(F.col("entity_type").isin(*PRIMITIVES)).withColumns({"start": arc["start"].when(is_line, F.col("start")), "mid": arc["mid"], "end": arc["end"].when(is_line, F.col("end"))})
    rows = _bounded(placed_entities(places, _boxed(own.drop("radius", "start_angle", "end_angle"))))
    placed = lambda k: at(*geometry.point(F.col("m"), F.col(f"{k}.x"), F.col(f"{k}.y")))
    rows = rows.withColumns({"start": F.when(is_arc | is_line, placed("start")), "mid": F.when(is_arc, placed("mid")), "end": F.when(is_arc | is_line, placed("end")), "center": F.when(is_arc, placed("center"))})
    dx, dy = F.col("start.x") - F.col("center.x"), F.col("start.y") - F.col("center.y")
    polyline = F.col("entity_type") == "Polyline"
    shown = {
        "radius": F.when(is_arc, F.sqrt(dx * dx + dy * dy)), "endpoints_valid": is_arc | is_line, "curve_geometry_valid": is_arc, "vertex_count": F.when(polyline, F.size("vertices")).otherwise(0),
        "closed": polyline & F.coalesce("closed", F.lit(False)), "bounds_valid": F.col("bounds").isNotNull(),
    }
    return rows.withColumns(shown).drop("m", "vertices")


_COUNT = "decimal(38,0)"


def occurrences(inserts: DataFrame, roots: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """(node, n, n_inserts, reachable, unused, is_external) of every definition, without listing a path.

    n counts the places where its content stands under the roots, as placements() would list
    them: each definition's count goes to what it uses, once all counts that it is made of
    are known. Only inside cycles paths are walked. n_inserts counts the inserts of it
    anywhere; unused are those that no insert uses and that are no roots. An external
    definition is counted and its own inserts are not followed. A count beyond 38 digits
    is an error.
    """
    pairs = inserts.where("target IS NOT NULL").groupBy("owner", "target").agg(F.count("*").cast(_COUNT).alias("k"))
    outside = inserts.select(F.col("target").alias("node")).limit(0) if external is None else external.select("node").distinct()
    pairs = cut(pairs)
    followed = pairs.join(outside.withColumnRenamed("node", "owner"), "owner", "left_anti")
    nodes = pairs.select(F.col("owner").alias("node")).union(pairs.select("target")).union(roots.select("node")).union(outside).distinct()
    seen = cut(hierarchy.reachable(followed.select(F.col("owner").alias("parent"), F.col("target").alias("child")), roots))
    edges = cut(followed.join(seen.withColumnRenamed("node", "owner"), "owner", "left_semi").select("owner", "target", "k"))
    told = cut(roots.select("node").distinct().withColumn("n", F.lit(1).cast(_COUNT)))  # what each node has been told so far
    counted = []

    def settle(layer: DataFrame) -> None:
        """Counts of a layer, and what they tell those that it uses."""
        nonlocal told
        known = cut(layer.join(told, "node").groupBy("node").agg(F.sum("n").cast(_COUNT).alias("n")))
        counted.append(known)
        down = edges.join(known.withColumnRenamed("node", "owner"), "owner").select(F.col("target").alias("node"), (F.col("n") * F.col("k")).cast(_COUNT).alias("n"))
        told = cut(told.join(layer, "node", "left_anti").union(down).groupBy("node").agg(F.sum("n").cast(_COUNT).alias("n")))

    # from above: a layer is used by none of what is left
    turned = lambda e: e.select(F.col("target").alias("owner"), F.col("owner").alias("target"))
    left, rest = seen, turned(edges)
    for layer, left, rest in _layers(rest, left):
        settle(layer)
    if left.limit(1).count():
        below = []  # what only hangs below the cycles, from the deepest on
        core, inner = left, turned(rest)
        for layer, core, inner in _layers(inner, core):
            below.append(layer)
        inside = inner.join(edges, ["owner", "target"]).select(F.col("owner").alias("parent"), F.col("target").alias("child"), "k")
        entered = core.join(told, "node").groupBy("node").agg(F.sum("n").cast(_COUNT).alias("n"))
        walked = hierarchy.expand(inside, entered, {"n": (F.col("p.n") * F.col("e.k")).cast(_COUNT)}, max_depth=MOST_LAYERS)
        known = cut(walked.where("NOT stopped").groupBy("node").agg(F.sum("n").cast(_COUNT).alias("n")))
        counted.append(known)
        outward = edges.join(core.withColumnRenamed("node", "target"), "target", "left_anti")
        down = outward.join(known.withColumnRenamed("node", "owner"), "owner").select(F.col("target").alias("node"), (F.col("n") * F.col("k")).cast(_COUNT).alias("n"))
        told = cut(told.join(core, "node", "left_anti").union(down).groupBy("node").agg(F.sum("n").cast(_COUNT).alias("n")))
        for layer in reversed(below):
            settle(layer)
    counts = reduce(DataFrame.union, counted)
    used = pairs.groupBy(F.col("target").alias("node")).agg(F.sum("k").cast(_COUNT).alias("n_inserts"))
    flags = outside.withColumn("is_external", F.lit(True))
    starts = roots.select("node").distinct().withColumn("root", F.lit(True))
    out = nodes.join(counts, "node", "left").join(used, "node", "left").join(flags, "node", "left").join(starts, "node", "left")
    zero = F.lit(0).cast(_COUNT)
    return out.select("node", F.coalesce("n", zero).alias("n"), F.coalesce("n_inserts", zero).alias("n_inserts"), F.col("n").isNotNull().alias("reachable"), (F.col("n_inserts").isNull() & F.col("root").isNull()).alias("unused"), F.coalesce("is_external", F.lit(False)).alias("is_external"))
