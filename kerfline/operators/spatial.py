"""Joins by place: points in windows, values in intervals, the nearest axes, instances that lie on one another."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut

#: Sizes under this are taken for this, so that points and lines have a level too.
_LEAST_SIZE = 2.0**-20


def _level(size: Column) -> Column:
    """The least whole n with 2**n at least the size."""
    return F.ceil(F.log2(F.greatest(size, F.lit(_LEAST_SIZE)))).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def _on_levels(rows: DataFrame, boxes: DataFrame) -> DataFrame:
    """rows once for each level that boxes have: there are no more levels than sizes differ by powers of two, at most two thousand."""
    levels = boxes.select("level_").distinct()
    return rows.join(F.broadcast(levels))


def windows_of_viewports(viewports: DataFrame) -> DataFrame:
    """Viewports that show the model, as turned windows (name, target_x, target_y, twist, min_u, max_u, min_v, max_v, clip, frozen).

    viewports has handle, is_paper_viewport, on, entity_visible, layer_off, paper_width,
    paper_height, view_center_x, view_center_y, view_target_x, view_target_y, view_height,
    twist_angle, view_direction_x, _y, _z, frozen_layers, and clip, an array of points (x, y)
    or null. The paper's own viewport, one that is off or on a layer that is, and one that
    does not look straight down show nothing. A window is as high as the view and as wide as
    the paper's sides make it; u and v are measured from the target, turned by the twist.
    """
    down = (F.col("view_direction_x") == 0) & (F.col("view_direction_y") == 0) & (F.col("view_direction_z") > 0)
    seen = viewports.where(~F.col("is_paper_viewport") & F.col("on") & F.col("entity_visible") & ~F.col("layer_off") & down & (F.col("paper_height") > 0) & (F.col("view_height") > 0))
    half_v = F.col("view_height") / 2
    half_u = half_v * F.col("paper_width") / F.col("paper_height")
    u, v = F.col("view_center_x"), F.col("view_center_y")
    return seen.select(F.col("handle").alias("name"), F.col("view_target_x").alias("target_x"), F.col("view_target_y").alias("target_y"), F.col("twist_angle").alias("twist"), (u - half_u).alias("min_u"), (u + half_u).alias("max_u"), (v - half_v).alias("min_v"), (v + half_v).alias("max_v"), "clip", F.col("frozen_layers").alias("frozen"))


def inside_polygon(clip: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside a polygon, an array of (x, y), by the even-odd rule."""

    def crosses(i: Column) -> Column:
        a, b = F.get(clip, i), F.get(clip, (i + 1) % F.size(clip))
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(F.sequence(F.lit(0), F.size(clip) - 1), crosses)) % 2 == 1


def in_turned_windows(points: DataFrame, windows: DataFrame, x: str, y: str, layer: str | None = None) -> DataFrame:
    """points joined to the windows that show them; windows as windows_of_viewports() has them.

    Each window has the level of its own size, and lies in at most four squares of that
    level; points lie in one square of each level that there is. So windows of very
    different sizes meet in one join on squares, and no size has to be guessed. Borders are
    inside. With a clip only what is inside that polygon of the model is shown, and layers
    that a window has frozen are not.
    """
    cos, sin = F.cos("twist"), F.sin("twist")
    corners = [(F.col(f"{a}_u"), F.col(f"{b}_v")) for a in ("min", "max") for b in ("min", "max")]
    xs, ys = [F.col("target_x") + cos * u + sin * v for u, v in corners], [F.col("target_y") - sin * u + cos * v for u, v in corners]
    boxed = windows.withColumns({"x0_": F.least(*xs), "x1_": F.greatest(*xs), "y0_": F.least(*ys), "y1_": F.greatest(*ys)})
    boxed = cut(boxed.withColumn("level_", _level(F.greatest(F.col("x1_") - F.col("x0_"), F.col("y1_") - F.col("y0_")))))
    # corners come out of a sum of products: a square more where one is all but reached
    near = 1e-9
    steps = {a: F.sequence(_cell(F.col(f"{a}0_") - near, F.col("level_")), _cell(F.col(f"{a}1_") + near, F.col("level_"))) for a in "xy"}
    dealt = boxed.withColumn("square_x", F.explode(steps["x"])).withColumn("square_y", F.explode(steps["y"])).drop("x0_", "x1_", "y0_", "y1_")
    placed = _on_levels(points, boxed).withColumns({"square_x": _cell(F.col(x), F.col("level_")), "square_y": _cell(F.col(y), F.col("level_"))})
    met = placed.join(dealt, ["level_", "square_x", "square_y"])
    dx, dy = F.col(x) - F.col("target_x"), F.col(y) - F.col("target_y")
    u, v = cos * dx - sin * dy, sin * dx + cos * dy
    shown = u.between(F.col("min_u") - near, F.col("max_u") + near) & v.between(F.col("min_v") - near, F.col("max_v") + near)
    shown = shown & (F.col("clip").isNull() | inside_polygon(F.col("clip"), F.col(x), F.col(y)))
    if layer is not None:
        shown = shown & ~F.array_contains("frozen", F.col(layer))
    return met.where(shown).drop("level_", "square_x", "square_y")


def once(rows: DataFrame, column: str, flag: str) -> DataFrame:
    """rows, dealt by the column, with the flag that its value is on no other row."""
    return rows.withColumn(flag, F.col(column).isNotNull() & (F.count("*").over(Window.partitionBy(column)) == 1))


def seen_once(shown: DataFrame, key: str, name: str = "name", sure: Column | None = None) -> DataFrame:
    """(key, windows, first_window): each point once, with the number of windows that show it.

    sure tells of rows whose (key, name) is on no other row; of these none is held, they are only counted.
    """
    sure = F.lit(False) if sure is None else sure
    windows = F.count_if(sure) + F.count_distinct(F.when(~sure, F.col(name)))
    return shown.groupBy(key).agg(windows.alias("windows"), F.min(name).alias("first_window"))


def in_intervals(rows: DataFrame, intervals: DataFrame, low: str, high: str, from_: str, to: str, tolerance: float = 0.0, on: tuple[str, ...] = ()) -> DataFrame:
    """rows joined to the intervals that hold all of [low, high], give or take the tolerance, and agree in the columns `on`.

    Each interval is covered by the dyadic ones of its own length, two at most; a row's low
    end lies in one dyadic interval of each length that there is. The join is on these, so
    only rows near an interval meet it. Ends of intervals may come in either order.
    """
    ends = F.least(from_, to) - tolerance, F.greatest(from_, to) + tolerance
    covered = cut(intervals.withColumns({"lo_": ends[0], "hi_": ends[1]}).withColumn("level_", _level(F.col("hi_") - F.col("lo_"))))
    dealt = covered.withColumn("dyad_", F.explode(F.sequence(_cell(F.col("lo_"), F.col("level_")), _cell(F.col("hi_"), F.col("level_")))))
    placed = _on_levels(rows, covered).withColumn("dyad_", _cell(F.col(low), F.col("level_")))
    met = placed.join(dealt, ["level_", "dyad_", *on])
    return met.where((F.col(low) >= F.col("lo_")) & (F.col(high) <= F.col("hi_"))).drop("level_", "dyad_", "lo_", "hi_")


def _running(rows: DataFrame, at: str, late: str, sums: list[str]) -> DataFrame:
    """rows with sums replaced by their totals over all rows up to and with themselves, in the order of (at, late).

    Rows are dealt to ranges of the order; past a range only its totals are carried, one row
    a range.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(n, at, late).sortWithinPartitions(at, late)
    placed = cut(placed.withColumns({"range_": F.spark_partition_id(), "place_": F.monotonically_increasing_id()}))
    before = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    carried = placed.groupBy("range_").agg(*[F.sum(c).alias(c) for c in sums]).select("range_", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums])
    here = Window.partitionBy("range_").orderBy("place_").rowsBetween(Window.unboundedPreceding, 0)
    told = placed.withColumns({c: F.sum(c).over(here) for c in sums}).join(F.broadcast(carried), "range_")
    return told.select(*[(F.col(c) + F.col(f"{c}_before")).alias(c) if c in sums else F.col(c) for c in rows.columns])


def interval_totals(rows: DataFrame, intervals: DataFrame, low: str, high: str, from_: str, to: str, value: str, tolerance: float = 0.0) -> DataFrame:
    """intervals with n and total, the number of rows that in_intervals() joins to each and the sum of their values (whole numbers), without joining them; those with none are left out.

    What lies in an interval are the rows that end by its end, without those that begin
    before it, but for those that do both, begin before it and end after it. The first two
    are running totals along one order of ends and intervals each. The third are only rows
    longer than the shortest interval, joined to the intervals inside of them; equal rows
    and equal intervals count as one in all of this.
    """
    ends = intervals.withColumns({"lo_": F.least(from_, to) - tolerance, "hi_": F.greatest(from_, to) + tolerance})
    known = rows.where(F.col(low).isNotNull() & F.col(high).isNotNull())
    v = F.col(value).cast("long")
    some = lambda df, *by: df.groupBy(*by).agg(F.count("*").alias("n"), F.count(value).alias("some"), F.coalesce(F.sum(v), F.lit(0)).alias("total"))
    sums = ["n", "some", "total"]
    spans = cut(some(known, F.col(low).alias("low_"), F.col(high).alias("high_")))
    asked = cut(ends.select("lo_", "hi_").where("lo_ IS NOT NULL AND hi_ IS NOT NULL").distinct().withColumn("asked_", F.monotonically_increasing_id()))

    def told(of: str, at: str, late: int, sign: int) -> DataFrame:
        """(asked_, sums) for each interval: the totals of spans whose `of` is before `at`, or also at it where `late` is 2."""
        none = [F.lit(0).cast("long").alias(c) for c in sums]
        alike = spans.groupBy(F.col(of).alias("at_")).agg(*[F.sum(c).alias(c) for c in sums])
        places = alike.select("at_", F.lit(1).alias("late_"), F.lit(None).cast("long").alias("asked_"), *sums)
        both = places.union(asked.select(at, F.lit(late), "asked_", *none))
        return _running(both, "at_", "late_", sums).where(F.col("late_") == late).select("asked_", *[(F.col(c) * sign).alias(c) for c in sums])

    least = asked.agg(F.min(F.col("hi_") - F.col("lo_")).alias("least_"))
    long_ = spans.join(F.broadcast(least), F.col("high_") - F.col("low_") >= F.col("least_")).drop("least_")
    around = in_intervals(asked.select("asked_", F.col("lo_").alias("l_"), F.col("hi_").alias("h_")), long_, "l_", "h_", "low_", "high_").where("low_ < l_ AND high_ > h_")
    parts = told("high_", "hi_", 2, 1).union(told("low_", "lo_", 0, -1)).union(around.select("asked_", *sums))
    found = parts.groupBy("asked_").agg(*[F.sum(c).alias(c) for c in sums]).where("n > 0").join(asked, "asked_").select("lo_", "hi_", "n", F.when(F.col("some") > 0, F.col("total")).alias("total"))
    return ends.join(found, ["lo_", "hi_"]).drop("lo_", "hi_")


def bracketed(rows: DataFrame, within: str, order: list[str], item: Column, before: str, after: str, inclusive: bool = False) -> DataFrame:
    """rows with the last item at or before and the first after them in the order of their group; item is null where a row has none.

    Rows are dealt to ranges of (group, order). Inside a range a window looks back and ahead;
    past its borders only the last and the first item of each range are carried, one row a
    range. Without `inclusive` a row's own item does not count as before it.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("item_", item).repartitionByRange(n, within, *order).sortWithinPartitions(within, *order)
    placed = cut(placed.withColumns({"range_": F.spark_partition_id(), "place_": F.monotonically_increasing_id()}))
    there = F.when(F.col("item_").isNotNull(), F.struct(F.col(within).alias("g"), F.col("item_").alias("i")))
    inner = Window.partitionBy("range_").orderBy("place_")
    back = inner.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    ahead = inner.rowsBetween(1, Window.unboundedFollowing)
    here = placed.withColumn("it_", there).withColumns({"b_": F.last("it_", True).over(back), "a_": F.first("it_", True).over(ahead)})
    ends = placed.withColumn("it_", there).where("it_ IS NOT NULL").groupBy("range_").agg(F.min_by("it_", "place_").alias("first_"), F.max_by("it_", "place_").alias("last_"))
    ranges = placed.select("range_").distinct().join(ends, "range_", "left")
    over = Window.orderBy("range_")
    carried = ranges.select("range_", F.last("last_", True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("from_before"), F.first("first_", True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("from_after"))
    joined = here.join(F.broadcast(carried), "range_", "left")
    own = lambda near, far: F.when(F.coalesce(F.col(near), F.col(far))["g"] == F.col(within), F.coalesce(F.col(near), F.col(far))["i"])
    return joined.select(*rows.columns, own("b_", "from_before").alias(before), own("a_", "from_after").alias(after))


def between_axes(points: DataFrame, axes: DataFrame, group: str, key: str, value: str, axis: str, at: str, most: float = 0.25) -> DataFrame:
    """(key, group, before, after, ratio, place): between which axes of its group each point lies.

    The ratio is how far the point is from the axis before, in spacings of the two. Outside
    of all axes, at most `most` of the spacing of the outermost two away, the place is
    '<axis>>OUT@<ratio>' after the last and '<axis><OUT@<ratio>' before the first one;
    farther off, or with fewer than two axes, it is null: no axis is made up.
    """
    pair = lambda a, b: F.concat(a, F.lit("-"), b)
    struct = F.struct(F.col(axis).alias("name"), F.col(at).alias("at"))
    spaced = bracketed(axes.select(group, axis, at), group, [at, axis], struct, "lower", "upper")
    item = F.struct(F.col(axis).alias("name"), F.col(at).alias("at"), F.coalesce(F.col(at) - F.col("lower.at"), F.col("upper.at") - F.col(at)).alias("outer"))
    both = spaced.select(group, F.col(at).alias("at_"), F.lit(0).alias("kind_"), F.col(axis).cast("string").alias("tie_"), item.alias("axis_"), F.lit(None).cast(points.schema[key].dataType).alias("key_"))
    both = both.union(points.select(group, F.col(value), F.lit(1), F.col(key).cast("string"), F.lit(None).cast(both.schema["axis_"].dataType), F.col(key)))
    found = bracketed(both, group, ["at_", "kind_", "tie_"], F.col("axis_"), "before", "after").where("kind_ = 1")
    b, a, p = F.col("before"), F.col("after"), F.col("at_")
    inner, above, below = b.isNotNull() & a.isNotNull(), a.isNull() & b.isNotNull(), b.isNull() & a.isNotNull()
    ratio = F.when(inner, (p - b["at"]) / F.when(a["at"] > b["at"], a["at"] - b["at"])).when(above, (p - b["at"]) / F.when(b["outer"] > 0, b["outer"])).when(below, (a["at"] - p) / F.when(a["outer"] > 0, a["outer"]))
    rows = found.select(F.col("key_").alias(key), group, b["name"].alias("before"), a["name"].alias("after"), ratio.alias("ratio"))
    text = F.format_string("%.4f", "ratio")
    near = F.col("ratio") <= most
    place = F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), pair(F.col("before"), F.col("after"))).when(near & F.col("before").isNotNull(), F.concat("before", F.lit(">OUT@"), text)).when(near & F.col("after").isNotNull(), F.concat("after", F.lit("<OUT@"), text))
    return rows.withColumn("place", place)


def coincident(rows: DataFrame, key: str, same: list[str], measures: list[str], tolerance: float) -> DataFrame:
    """(key, group_key, n): instances that agree in `same` and, within the tolerance, in each measure; group_key is the least key of the group.

    Rows are first put together by equal values, so copies never meet one another. What is
    left meets in squares of the first two measures, of twice the tolerance, laid twice in
    each direction with half a square between them, so that two values within the tolerance
    share a square of one laying or another. Groups are what such links join, link by link. A measure that is null or not
    finite links with nothing.
    """
    finite = reduce(lambda a, b: a & b, [F.col(m).isNotNull() & ~F.isnan(m) & (F.abs(m) != float("inf")) for m in measures])
    whole = rows.where(finite)
    kinds = cut(whole.groupBy(*same, *measures).agg(F.min(key).alias("node"), F.count("*").alias("n")))
    side = 2 * tolerance
    laid = lambda m: F.array(*[F.struct(F.lit(k), F.floor(F.col(m) / side + k / 2)) for k in (0, 1)])
    dealt = kinds.select(*same, *measures, "node", F.explode(laid(measures[0])).alias("square_0")).withColumn("square_1", F.explode(laid(measures[min(1, len(measures) - 1)])))
    a, b = dealt.alias("a"), dealt.alias("b")
    meet = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in same] + [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("square_0", "square_1")]
    close = [F.abs(F.col(f"a.{m}") - F.col(f"b.{m}")) <= tolerance for m in measures]
    links = a.join(b, reduce(lambda p, q: p & q, [*meet, F.col("a.node") < F.col("b.node"), *close])).select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).distinct()
    labels = connected(links)
    named = kinds.join(labels, "node", "left").withColumn("group_key", F.coalesce("label", "node"))
    sizes = named.groupBy("group_key").agg(F.sum("n").alias("n"))
    of_kind = named.select(*[F.col(c).alias(f"{c}_k") for c in [*same, *measures]], "group_key").join(sizes, "group_key")
    on = [whole[c].eqNullSafe(of_kind[f"{c}_k"]) for c in [*same, *measures]]
    grouped = whole.join(of_kind, reduce(lambda p, q: p & q, on)).select(key, "group_key", "n")
    return grouped.union(rows.where(~F.coalesce(finite, F.lit(False))).select(key, F.col(key), F.lit(1).cast("long")))


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (x, y): the least node that it is joined to.

    Each round gives a node the least label of its neighbours, and then that label's own
    label, so that rounds grow with the logarithm of the longest way.
    """
    both = cut(links.select(F.col("x").alias("node"), F.col("y").alias("to")).union(links.select("y", "x")).distinct())
    labels = cut(both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("to"), "label"), "to").groupBy("node").agg(F.min("label").alias("least"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = cut(step.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")))
        labels = step.select("node", "label")
        if step.where("old <> label").limit(1).count() == 0:
            return labels
