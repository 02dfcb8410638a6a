"""The device clearance and anchorage report: one row a device from its evidence and the ledger of beams.

Missing evidence gives null and a reason, never zero. Both tables are joined once for each
support role by the beam's id, which the ledger must have once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, scalar
from ..functions.scalar import CONFIRMED, clean, confirmed
from . import lookups, ordering

QUANTITY = "struct<value_mm:string,status:string,reason:string,source_stage:string,beam_number:string>"
REFERENCE = "struct<status:string,formal_beam_id:string,beam_number:string,width_mm:double,height_mm:double>"
LINK = "struct<support_floor:string,component_id:string,actual_insert_root:string,orientation:string,mapped_envelope:array<double>,mapping_status:string,p5_beam_segment_id:string,p5_physical_status:string,beam_reference_status:string,dependency_ids:array<string>>"
PAIR = "struct<lower:{0},upper:{0}>"
INPUTS = ("z_lower_level_mm", "z_upper_level_mm", "lower_beam_top_offset_mm", "lower_installation_surface_offset_mm", "upper_beam_top_offset_mm", "upper_beam_height_mm")
CONTAINERS = ("formal_shared_beam_references", "reviewed_beam_references", "evidence_augmented_beam_references")
TEXTS = ("registry_device_id", "device_type", "building_id", "floor", "component_id", "axis_position", "orientation")
#: What the two tables look like.
DEVICES = f"{', '.join(f'{t} string' for t in TEXTS)}, device_model string, model string, beam_references struct<lower_beam_id:string,upper_beam_id:string,status:string>, support_links {PAIR.format(LINK)}, inputs struct<{','.join(f'{i}:{QUANTITY}' for i in INPUTS)}>, {', '.join(f'{c} {PAIR.format(REFERENCE)}' for c in CONTAINERS)}, clear_height_mm double"
BEAMS = "formal_beam_id string, identity struct<building_id:string,support_floor:string,component_id:string,actual_insert_root:string,orientation:string,face_coordinates_mm:array<double>>, consumer_supports array<struct<registry_device_id:string,support_role:string>>, target_along_intervals_mm array<array<double>>"
TOLERANCE = 1.0

# fixed values: statuses, conclusions and reasons
CANDIDATE, LACKING, CONFLICT = "候选", "资料不足", "冲突"
REVIEW, ANCHORED = "待人工核实", "已生根"
DROP, RAISE, LEVEL = "有", "升板", "无"
LATER = "后续处理"
NO_OFFSET = "缺少已确认的梁顶/板面偏移"
LOWERED, RAISED, SAME_LEVEL = "梁顶相对楼层标高降低", "梁顶相对楼层标高升高", "梁顶与楼层标高一致"
NOT_MAPPED = "跨楼层设备投影尚未确认"
OTHER_SEGMENT = "设备梁引用与支承链梁段ID不一致"
BOUND = "设备投影已唯一绑定已确认物理梁段"
NO_RECORD = "存在正式梁文字引用，但共享梁台账缺少对应记录"
UNPROVEN_SEGMENT = "存在梁段候选，但物理梁或引用尚未确认"
NO_CHAIN = "未形成可回查的支承梁证据链"
OTHER_SUPPORT = "正式梁台账与支承楼层/分区/块实例/方向不一致"
NO_FACES = "缺少可复核的设备投影或双梁面坐标"
OUT_OF_FACES = "设备法向投影未落入正式梁双梁面范围"
NO_CONSUMER = "正式梁几何匹配但台账缺少该设备支承角色绑定"
NO_INTERVALS = "法向投影闭合，但缺少梁长度方向有效区间"
INSIDE = "设备投影完整落入正式梁双梁面及长度方向有效区间"
OUT_OF_INTERVALS = "设备长度方向投影未完整落入正式梁有效区间"
STAYS_CANDIDATE = "；但缺少已确认物理梁段，保持候选"
GEOMETRY_DIFFERS, NOT_JUDGED = "正式梁辅助几何与设备支承链不一致：", "；不据此判定未生根"
MISSING = ("下梁顶标高", "上梁顶标高", "上梁高度", "梁间净空")
ROLES = {"lower": "下梁生根", "upper": "上梁生根"}


class SafetyStop(ValueError):
    """The input can't be reported on."""


def check(devices: DataFrame, beams: DataFrame, expected: int | None = None) -> None:
    """Raises where there are no devices, ids are blank or repeated, or their number is not the expected one."""

    def counts(df: DataFrame, key: str):
        by = df.groupBy(clean(F.col(key)).alias("k")).agg(F.count("*").alias("c"))
        return by.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if((F.col("k") == "") | (F.col("c") > 1)).alias("bad")).first()

    d, b = counts(devices, "registry_device_id"), counts(beams, "formal_beam_id")
    if not d["n"] or d["bad"]:
        raise SafetyStop("device ids are missing or repeated")
    if expected is not None and d["n"] != expected:
        raise SafetyStop(f"{d['n']} devices, expected {expected}")
    if b["bad"]:
        raise SafetyStop("beam ids are missing or repeated")


def lower_offset(inputs: Column) -> Column:
    """(value, status, reason) of the lower beam's top: its own, or the surface's where the reason says that this is a beam top."""
    own, older = inputs["lower_beam_top_offset_mm"], inputs["lower_installation_surface_offset_mm"]
    reason = clean(older["reason"])
    none = F.lit(None).cast("double")
    either = lambda *texts: F.coalesce(*[F.when(t != "", t) for t in texts])
    struct = lambda v, s, r: F.struct(v.alias("value"), s.alias("status"), r.alias("reason"))
    return (
        F.when(confirmed(own).isNotNull(), struct(confirmed(own), F.lit(CONFIRMED), either(clean(own["reason"]), F.lit("direct_lower_beam_top_offset"))))
        .when(confirmed(older).isNotNull() & F.lower(reason).contains("beam_top"), struct(confirmed(older), F.lit(CONFIRMED), reason))
        .otherwise(struct(none, either(clean(F.coalesce(F.when(own["status"] != "", own["status"]), older["status"])), F.lit(LACKING)), either(reason, F.lit("missing_confirmed_lower_beam_top_offset"))))
    )


def drop(offset: Column, status: Column) -> Column:
    """(status, height, reason): whether the floor lies lower or higher at the support, to the tolerance."""
    size = F.abs(offset)
    struct = lambda s, h, r: F.struct(F.lit(s).alias("status"), h.alias("height"), r.alias("reason"))
    told = lambda text: F.concat(F.lit(text), scalar.general_text(size), F.lit("mm"))
    return (
        F.when((status != CONFIRMED) | offset.isNull(), struct(LACKING, F.lit(None).cast("double"), F.lit(NO_OFFSET)))
        .when(offset < -TOLERANCE, struct(DROP, size, told(LOWERED)))
        .when(offset > TOLERANCE, struct(RAISE, size, told(RAISED)))
        .otherwise(struct(LEVEL, F.lit(0.0), F.lit(SAME_LEVEL)))
    )


def formal_geometry(device: DataFrame, link: Column, beam: Column, role: str, sides: Column) -> Column:
    """(status, reason) of a device's projection, with its sides across and along the support, against the beam of the ledger."""
    identity = beam["identity"]
    same = clean(identity["building_id"]) == clean(device["building_id"])
    for key in ("support_floor", "component_id", "orientation"):
        same &= clean(identity[key]) == clean(link[key])
    same &= F.upper(clean(identity["actual_insert_root"])) == F.upper(clean(link["actual_insert_root"]))
    faces = F.coalesce(identity["face_coordinates_mm"], F.array().cast("array<double>"))
    uses = F.filter(F.coalesce(beam["consumer_supports"], F.array().cast("array<struct<registry_device_id:string,support_role:string>>")), lambda u: (clean(u["registry_device_id"]) == clean(device["registry_device_id"])) & (clean(u["support_role"]) == role))
    intervals = F.filter(F.coalesce(beam["target_along_intervals_mm"], F.array().cast("array<array<double>>")), lambda i: F.size(i) == 2)
    normal, along = sides["normal"], sides["along"]
    struct = lambda s, r: F.struct(F.lit(s).alias("status"), F.lit(r).alias("reason"))
    return (
        F.when(~same, struct(CONFLICT, OTHER_SUPPORT))
        .when(sides.isNull() | (F.size(faces) != 2), struct(LACKING, NO_FACES))
        .when((normal[0] < F.array_min(faces) - TOLERANCE) | (normal[1] > F.array_max(faces) + TOLERANCE), struct(CONFLICT, OUT_OF_FACES))
        .when(F.size(uses) == 0, struct(CANDIDATE, NO_CONSUMER))
        .when(F.size(intervals) == 0, struct(CANDIDATE, NO_INTERVALS))
        .when(lookups.within(along[0], along[1], intervals, TOLERANCE), struct(CONFIRMED, INSIDE))
        .otherwise(struct(CONFLICT, OUT_OF_INTERVALS))
    )


def anchorage(device: DataFrame, role: str, beam: Column, found: Column) -> Column:
    """(status, conclusion, reason, beam_id, evidence_ids): the first rule that holds; what formal geometry found never confirms alone."""
    link, formal = device["support_links"][role], device["formal_shared_beam_references"][role]
    direct, segment, formal_id = clean(device["beam_references"][f"{role}_beam_id"]), clean(link["p5_beam_segment_id"]), clean(formal["formal_beam_id"])
    either = F.when(direct != "", direct).otherwise(segment)
    told = F.when(found["status"] == CONFIRMED, F.concat(found["reason"], F.lit(STAYS_CANDIDATE))).when(found["status"] == CONFLICT, F.concat(F.lit(GEOMETRY_DIFFERS), found["reason"], F.lit(NOT_JUDGED))).otherwise(found["reason"])
    none = F.lit(None).cast("array<string>")

    def verdict(status: str, reason, beam_id: Column, evidence: Column = none) -> Column:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        return F.struct(F.lit(status).alias("status"), F.lit(ANCHORED if status == CONFIRMED else REVIEW).alias("conclusion"), reason.alias("reason"), beam_id.alias("beam_id"), evidence.alias("evidence_ids"))

    proven = (clean(link["p5_physical_status"]) == CONFIRMED) & (clean(link["beam_reference_status"]) == CONFIRMED)
    named = (clean(formal["status"]) == CONFIRMED) & (formal_id != "")
    return (
        F.when(clean(link["mapping_status"]) != CONFIRMED, verdict(LACKING, NOT_MAPPED, either))
        .when((direct != "") & (direct != segment), verdict(CONFLICT, OTHER_SEGMENT, direct))
        .when((direct != "") & proven, verdict(CONFIRMED, BOUND, direct, F.coalesce(ordering.evidence_ids(link["dependency_ids"]), F.array().cast("array<string>"))))
        .when(named & beam.isNull(), verdict(CANDIDATE, NO_RECORD, formal_id))
        .when(named, verdict(CANDIDATE, told, formal_id))
        .when((clean(link["p5_physical_status"]) == CANDIDATE) | (direct != "") | (segment != ""), verdict(CANDIDATE, UNPROVEN_SEGMENT, either))
        .otherwise(verdict(LACKING, NO_CHAIN, F.lit("")))
    )


def beam_reference(device: DataFrame, role: str) -> Column:
    """(beam_number, width_mm, height_mm, source) from the first source whose reference is confirmed."""
    struct = lambda n, w, h, s: F.struct(n.alias("beam_number"), w.alias("width_mm"), h.alias("height_mm"), s.alias("source"))
    none, height = F.lit(None).cast("double"), device["inputs"]["upper_beam_height_mm"]
    cases = [(clean(device[c][role]["status"]) == CONFIRMED, struct(clean(device[c][role]["beam_number"]), device[c][role]["width_mm"], device[c][role]["height_mm"], F.lit(c))) for c in CONTAINERS]
    last = struct(clean(height["beam_number"]), none, confirmed(height), clean(height["source_stage"])) if role == "upper" else struct(F.lit(""), none, none, F.lit(""))
    return scalar.first_known(*cases, (F.lit(True), last))


def report(devices: DataFrame, beams: DataFrame, expected: int | None = None) -> DataFrame:
    """One row for each device; raises SafetyStop where `check` does."""
    check(devices, beams, expected)
    joined = devices.alias("d")
    for role in ROLES:
        of = beams.select(clean(F.col("formal_beam_id")).alias(f"{role}_key"), F.struct(*beams.columns).alias(f"{role}_ledger"))
        joined = joined.join(of, clean(F.col(f"formal_shared_beam_references.{role}.formal_beam_id")) == F.col(f"{role}_key"), "left")
    # in steps, so that what later columns use often is worked out once
    joined = joined.withColumns({f"{role}_sides": geometry.normal_and_along(F.col(f"support_links.{role}.mapped_envelope"), clean(F.col(f"support_links.{role}.orientation"))) for role in ROLES})
    joined = joined.withColumns({f"{role}_geometry": formal_geometry(joined, F.col(f"support_links.{role}"), F.col(f"{role}_ledger"), role, F.col(f"{role}_sides")) for role in ROLES})
    inputs = joined["inputs"]
    rows = joined.select(
        *[clean(F.col(c)).alias(c) for c in TEXTS],
        clean(F.when(F.coalesce(F.col("device_model"), F.lit("")) != "", F.col("device_model")).otherwise(F.col("model"))).alias("device_model"),
        lower_offset(inputs).alias("lower_offset"),
        *[confirmed(inputs[c]).alias(c) for c in ("z_lower_level_mm", "z_upper_level_mm", "upper_beam_top_offset_mm", "upper_beam_height_mm")],
        *[clean(inputs[c]["status"]).alias(f"{c}_status") for c in ("upper_beam_top_offset_mm", "upper_beam_height_mm")],
        *[anchorage(joined, role, F.col(f"{role}_ledger"), F.col(f"{role}_geometry")).alias(f"{role}_anchorage") for role in ROLES],
        *[beam_reference(joined, role).alias(f"{role}_beam") for role in ROLES],
        F.col("clear_height_mm").alias("baseline_clear_height_mm"),
    )
    lower, upper = F.col("lower_offset"), F.col("upper_beam_top_offset_mm")
    rows = rows.withColumns({"lower_top": F.col("z_lower_level_mm") + lower["value"], "upper_top": F.col("z_upper_level_mm") + upper, "lower_drop": drop(lower["value"], lower["status"]), "upper_drop": drop(upper, F.col("upper_beam_top_offset_mm_status"))})
    rows = rows.withColumn("clearance", F.col("upper_top") - F.col("upper_beam_height_mm") - F.col("lower_top"))
    anchors = {role: F.col(f"{role}_anchorage.status") for role in ROLES}
    unknown = [F.when(F.col(c).isNull(), F.lit(name)) for name, c in zip(MISSING, ("lower_top", "upper_top", "upper_beam_height_mm", "clearance"))]
    unknown += [F.when(anchors[role] != CONFIRMED, F.concat(F.lit(f"{ROLES[role]}:"), anchors[role])) for role in ROLES]
    reasons = F.filter(F.array(*unknown), lambda x: x.isNotNull())
    or_lacking = lambda c: F.when(F.col(c) != "", F.col(c)).otherwise(LACKING)
    return rows.select(
        *TEXTS, "device_model", "lower_beam", F.col("lower_top").alias("lower_beam_top_elevation_mm"), lower["value"].alias("lower_beam_top_offset_mm"), lower["status"].alias("lower_beam_top_offset_status"), lower["reason"].alias("lower_beam_top_offset_reason"),
        *[F.col(f"{role}_drop.{c}").alias(f"{role}_drop_{n}") for role in ROLES for c, n in (("status", "status"), ("height", "height_mm"), ("reason", "reason"))],
        "lower_anchorage", "upper_beam", F.col("upper_top").alias("upper_beam_top_elevation_mm"), "upper_beam_top_offset_mm", or_lacking("upper_beam_top_offset_mm_status").alias("upper_beam_top_offset_status"), "upper_beam_height_mm", or_lacking("upper_beam_height_mm_status").alias("upper_beam_height_status"), "upper_anchorage",
        F.bround("clearance", 6).alias("beam_clearance_excluding_upturn_mm"), F.when(F.col("clearance").isNotNull(), CONFIRMED).otherwise(LACKING).alias("clearance_status"),
        "baseline_clear_height_mm", F.bround(F.col("clearance") - F.col("baseline_clear_height_mm"), 6).alias("baseline_delta_mm"), F.lit(False).alias("upturn_included"), F.lit(LATER).alias("upturn_review_status"),
        F.when((anchors["lower"] == CONFLICT) | (anchors["upper"] == CONFLICT), CONFLICT).when(F.size(reasons) > 0, REVIEW).otherwise(CONFIRMED).alias("overall_status"), reasons.alias("unresolved_reasons"),
    )


def statistics(rows: DataFrame) -> DataFrame:
    """One row: devices in all and different, confirmed clearances, baseline mismatches, and maps from each status to its number."""
    counts = rows.groupBy("overall_status", F.col("lower_anchorage.status").alias("lower_status"), F.col("upper_anchorage.status").alias("upper_status")).agg(F.count("*").alias("n"), F.count_if(F.col("clearance_status") == CONFIRMED).alias("confirmed"), F.count_if(F.abs("baseline_delta_mm") > TOLERANCE).alias("mismatches"))

    def by(column: str) -> Column:  # a few statuses
        pairs = F.collect_list(F.struct(F.col(column).alias("k"), F.col("n").alias("n")))
        return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["k"]))), lambda k: F.struct(k, F.aggregate(F.filter(pairs, lambda p: p["k"] == k), F.lit(0).cast("bigint"), lambda a, p: a + p["n"]))))

    total = counts.agg(F.sum("n").alias("output_device_count"), F.sum("confirmed").alias("confirmed_clearance_count"), F.sum("mismatches").alias("baseline_clearance_mismatch_count"), by("lower_status").alias("lower_anchorage_status_counts"), by("upper_status").alias("upper_anchorage_status_counts"), by("overall_status").alias("overall_status_counts"))
    return total.join(rows.agg(F.count_distinct("registry_device_id").alias("unique_output_device_count")))  # one row each


# fixed values: the columns of the report as a table, and what each is taken from
CSV_COLUMNS = (
    ("设备ID", "registry_device_id"), ("设备类型", "device_type"), ("楼栋", "building_id"), ("楼层", "floor"), ("分区", "component_id"), ("轴号", "axis_position"), ("方向", "orientation"), ("型号", "device_model"),
    ("下梁编号", "lower_beam.beam_number"), ("下梁顶标高(mm)", "lower_beam_top_elevation_mm"), ("下支承降板状态", "lower_drop_status"), ("下支承降板高度(mm)", "lower_drop_height_mm"), ("下梁生根结论", "lower_anchorage.conclusion"), ("下梁生根状态", "lower_anchorage.status"), ("下梁生根说明", "lower_anchorage.reason"),
    ("上梁编号", "upper_beam.beam_number"), ("上梁顶标高(mm)", "upper_beam_top_elevation_mm"), ("上梁高度(mm)", "upper_beam_height_mm"), ("上支承降板状态", "upper_drop_status"), ("上支承降板高度(mm)", "upper_drop_height_mm"), ("上梁生根结论", "upper_anchorage.conclusion"), ("上梁生根状态", "upper_anchorage.status"), ("上梁生根说明", "upper_anchorage.reason"),
    ("梁间净空-未计上翻墩(mm)", "beam_clearance_excluding_upturn_mm"), ("净空状态", "clearance_status"), ("上翻墩复核状态", "upturn_review_status"), ("总体状态", "overall_status"), ("未决原因", "unresolved_reasons"),
)


def as_table(rows: DataFrame) -> DataFrame:
    """The report's 28 columns as texts; reasons joined by |."""
    kinds = dict(rows.dtypes)
    return rows.select(*[(F.array_join(c, "|") if kinds.get(c, "").startswith("array") else F.col(c).cast("string")).alias(f"c{i}") for i, (_, c) in enumerate(CSV_COLUMNS)]).toDF(*[name for name, _ in CSV_COLUMNS])
