"""Registries of located devices: completeness, recomputed evidence, floors, texts by frame, drift between trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from . import diff, gates, lookups
from .lineage import cut

# fixed values: the states that reports carry
COMPLETE, INCOMPLETE = "device_location_registry_complete", "device_location_registry_unresolved"
TRACED, UNTRACED = "evidence_trace_complete", "evidence_trace_unresolved"
IN_SYNC, DRIFTED = "in_sync", "drifted"


def registry_status(devices: DataFrame, key: str, required: list[str], conditions: dict[str, Column]) -> DataFrame:
    """One row (status, reasons): complete where every device has a key of its own and no blank field, and the conditions hold for all.

    No devices at all are not a complete registry.
    """
    flags = {f"{c} is missing": scalar.clean(F.col(c).cast("string")) != "" for c in [key, *required]} | conditions
    counts = devices.groupBy(key).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    return gates.completeness(devices, flags).join(counts).select(  # one row each
        F.when(F.col("complete") & (F.col("most") == 1), COMPLETE).otherwise(INCOMPLETE).alias("status"),
        F.concat("reasons", F.when(F.col("most") > 1, F.array(F.lit(f"{key} is repeated"))).when(F.col("most") == 0, F.array(F.lit("no devices"))).otherwise(F.array().cast("array<string>"))).alias("reasons"),
    )


def evidence_trace(devices: DataFrame, recomputed: DataFrame, key: str, columns: list[str], evidence: list[str], tolerance: float = 1e-6) -> DataFrame:
    """(key, fields, status) of each device: traced where the recomputed columns agree and no field of evidence is blank; fields names what does not."""
    found = diff.matched_keys(devices, recomputed, key, columns, tolerance).where("side <> 'right'")
    blank = devices.groupBy(diff.key_text(F.col(key)).alias("key")).agg(F.concat_ws(",", *[F.max(F.when(scalar.clean(F.col(c).cast("string")) == "", c)) for c in evidence]).alias("blank"))
    fields = F.concat_ws(",", F.when(F.col("side") == "left", "not recomputed"), *[F.when(F.col(c) != "", F.col(c)) for c in ("fields", "blank")])
    return found.join(blank, "key").select("key", fields.alias("fields")).withColumn("status", F.when(F.col("fields") == "", TRACED).otherwise(UNTRACED))


def templates(devices: DataFrame, columns: list[str]) -> DataFrame:
    """Each template once, with the number of devices that share it: a picture is made for a template, not for a device."""
    return devices.groupBy(*columns).agg(F.count("*").alias("n"))


def expand_floors(df: DataFrame, low: str, high: str, evidence: Column) -> DataFrame:
    """One row for each floor from low to high, in `floor`, where evidence holds and the range is known and not upside down.

    Any other row stays one row without a floor; `expanded` tells them apart.
    """
    sure = F.coalesce(evidence & (F.col(low) <= F.col(high)), F.lit(False))
    floors = F.when(sure, F.sequence(F.col(low), F.col(high)))
    return df.withColumn("expanded", sure).withColumn("floor", F.explode_outer(floors))


def frame_texts(texts: DataFrame, frames: DataFrame, key: str, x: str, y: str, text: str, words: list[str], cell: float) -> DataFrame:
    """(name, n_texts, and a count for each word): the texts within each frame, by frame; those in no frame under a null name, their words not counted.

    texts has a key of its own for each row; frames has name, min_x, max_x, min_y, max_y. A
    text in several frames counts in each.
    """
    inside = lookups.in_windows(texts, frames, x, y, cell)
    held = inside.groupBy("name").agg(F.count("*").alias("n_texts"), *[F.count_if(F.col(text).contains(w)).alias(w) for w in words])
    rest = texts.join(inside.select(key), key, "left_anti").agg(F.lit(None).cast("string").alias("name"), F.count("*").alias("n_texts"), *[F.lit(0).cast("bigint").alias(w) for w in words])
    return held.unionByName(rest)


def tree_drift(source: DataFrame, installed: DataFrame) -> DataFrame:
    """One row (status, differences) for two tables of (path, sha256) with paths below their roots: what is on one side only or differs, in order.

    The differences are a list in one row: trees of a tool's files are meant, not of a corpus.
    """
    rows = diff.matched_keys(source, installed, "path", ["sha256"]).where("side <> 'both' OR fields <> ''")
    listed = rows.agg(F.array_sort(F.collect_list("key")).alias("differences"))
    return listed.select(F.when(F.size("differences") == 0, IN_SYNC).otherwise(DRIFTED).alias("status"), "differences")


def _rolled(files: DataFrame) -> DataFrame:
    """(node, parent, depth, hash, is_file) of all files (path, sha256) and folders: a folder's hash is that of the names and hashes in it, in any order."""
    node = files.select(F.col("path").alias("node"), F.col("sha256").alias("hash"), F.lit(True).alias("is_file")).withColumn("depth", F.size(F.split("node", "/")))
    folder = lambda c: F.when(F.instr(c, "/") > 0, F.regexp_replace(c, "/[^/]*$", "")).otherwise("")
    node = node.withColumn("parent", F.when(F.col("node") != "", folder(F.col("node"))))
    deepest = node.agg(F.max("depth")).first()[0] or 0
    level, out = node.where(F.col("depth") == deepest), []
    for depth in range(deepest, 0, -1):
        level = cut(level)
        out.append(level)
        of = F.xxhash64("node", "hash", "is_file")
        up = level.groupBy(F.col("parent").alias("node")).agg(F.sha2(F.concat_ws(",", F.bit_xor(of), F.sum(of % (1 << 31)), F.count("*")).cast("binary"), 256).alias("hash"))
        up = up.select("node", "hash", F.lit(False).alias("is_file"), F.lit(depth - 1).alias("depth"), F.when(F.col("node") != "", folder(F.col("node"))).alias("parent"))
        level = up.union(node.where(F.col("depth") == depth - 1).select(up.columns)) if depth > 1 else up
    return reduce(DataFrame.unionByName, [*out, cut(level)])


def tree_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(path, side, is_file) of two trees (path, sha256): what only one has, side 'left' or 'right', and files that differ, 'both'.

    Hashes are rolled up the folders, so that only inside of folders that differ anything is
    compared, from the roots down; a folder that one side lacks is one row, ending in a
    slash. A path that is a folder here and a file there is told for both sides. Trees must
    name a path once.
    """
    sides = [cut(_rolled(t)) for t in (left, right)]
    l, r = (t.select("node", "parent", "depth", F.struct("hash", "is_file").alias(name)) for t, name in zip(sides, "lr"))
    both = cut(l.withColumnRenamed("parent", "lp").join(r.withColumnRenamed("parent", "rp"), ["node", "depth"], "full_outer").select("node", "depth", F.coalesce("lp", "rp").alias("parent"), "l", "r"))
    differ = both.where(~F.col("l").eqNullSafe(F.col("r")))
    last = both.agg(F.max("depth")).first()[0] or 0
    opened, out = cut(differ.where("depth = 0 AND l IS NOT NULL AND r IS NOT NULL")), [differ.where("depth = 0 AND (l IS NULL OR r IS NULL)")]
    for depth in range(1, last + 1):
        if opened.limit(1).count() == 0:
            break
        here = cut(differ.where(F.col("depth") == depth).join(opened.select(F.col("node").alias("parent")), "parent", "left_semi"))
        folders = F.coalesce(~F.col("l.is_file") & ~F.col("r.is_file"), F.lit(False))
        out.append(here.where(~folders).select(*differ.columns))
        opened = here.where(folders)
    found = reduce(DataFrame.union, out)
    kind = F.when(F.col("l").isNull(), F.array(F.lit("right"))).when(F.col("r").isNull() , F.array(F.lit("left"))).when(F.col("l.is_file") != F.col("r.is_file"), F.array(F.lit("left"), F.lit("right"))).otherwise(F.array(F.lit("both")))
    rows = found.withColumn("side", F.explode(kind))
    is_file = F.when(F.col("side") == "right", F.col("r.is_file")).otherwise(F.col("l.is_file"))
    return rows.select(F.concat("node", F.when(is_file, "").otherwise("/")).alias("path"), "side", is_file.alias("is_file"))


# fixed values: what file names and folders say of a drawing's role, the first that holds, and the tiers with their priority
ROLES = (("目录|说明", "reference"), ("阻尼器|结构平面|结构整图", "selected"), ("梁|柱|墙|板|基础|节点", "supporting"))
TIERS = ("selected", "project_package_candidate", "supporting", "uncertain", "reference", "older_revision", "exact_duplicate", "excluded")


def directory_tiers(files: DataFrame, excluded: str | None = None, roles=ROLES) -> DataFrame:
    """(path, sha256, family, file_date, role, tier, priority) of a folder's drawings (path, sha256), by their names alone.

    A name's family is the name without folders, case, its end and a date of eight digits.
    Names that `excluded` matches are of another trade. A drawing at the top that is a name
    and a date is a package of the project. Of a family those with an earlier date than its
    latest are older revisions, and of equal files in a family only the first path is kept.
    None of this says which version is in force; files are told apart, and none is left out.
    """
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = files.select("path", "sha256", name.alias("name_")).withColumn("file_date", F.regexp_extract("name_", r"(?<!\d)(\d{8})(?!\d)", 1))
    bare = F.lower(F.regexp_replace(F.regexp_replace("name_", r"(?<!\d)\d{8}(?!\d)", ""), r"[\s_\-.]+", ""))
    rows = rows.withColumns({"file_date": F.when(F.col("file_date") != "", F.col("file_date")), "family": bare})
    role = None
    for pattern, tier in roles:
        role = F.when(F.col("path").rlike(pattern), tier) if role is None else role.when(F.col("path").rlike(pattern), tier)
    package = ~F.contains("path", F.lit("/")) & F.col("file_date").isNotNull() & (F.col("family") != "")
    other = F.col("path").rlike(excluded) if excluded else F.lit(False)
    rows = cut(rows.withColumn("role", F.when(other, "excluded").otherwise(F.coalesce(role, F.when(package, "project_package_candidate"), F.lit("uncertain")))))
    latest = rows.groupBy(F.col("family").alias("family_")).agg(F.max("file_date").alias("latest_"))
    first = rows.groupBy(F.col("family").alias("f_"), F.col("sha256").alias("s_")).agg(F.min("path").alias("first_"))
    joined = rows.join(latest, rows["family"] == F.col("family_")).join(first, (rows["family"] == F.col("f_")) & (rows["sha256"] == F.col("s_")), "left")
    kept = F.col("role").isin("reference", "excluded")
    tier = F.when(kept, F.col("role")).when(F.col("file_date") < F.col("latest_"), "older_revision").when(F.col("path") != F.col("first_"), "exact_duplicate").otherwise(F.col("role"))
    ranks = F.array(*[F.lit(t) for t in TIERS])
    return joined.withColumn("tier", tier).select("path", "sha256", "family", "file_date", "role", "tier", F.array_position(ranks, F.col("tier")).alias("priority"))
