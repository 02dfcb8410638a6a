"""Gates: versions, unique keys, hashes, allowed values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar

# fixed values: host release, its interface version, what its file version begins with, the newest drawing that it reads, and which is asked first
HOSTS = (
    ("2023", "R24.2", r"^R?24\.2(?:\.|$)", "AC1032", 400),
    ("2020", "R23.1", r"^R?23\.1(?:\.|$)", "AC1032", 300),
    ("2018", "R22.0", r"^R?22\.0(?:\.|$)", "AC1032", 200),
    ("2014", "R19.1", r"^R?19\.1(?:\.|$)", "AC1027", 100),
)


def with_policy(df: DataFrame, file_version: str, hosts=HOSTS) -> DataFrame:
    """The rows whose host is known by its file version, with (release, api_version, max_code, priority).

    The table is a constant, so it goes into the plan as an expression, not as a join.
    """
    found = None
    for release, api, pattern, code, priority in hosts:
        value = F.struct(F.lit(release).alias("release"), F.lit(api).alias("api_version"), F.lit(code).alias("max_code"), F.lit(priority).alias("priority"))
        known = F.col(file_version).rlike(pattern)
        found = F.when(known, value) if found is None else found.when(known, value)
    return df.withColumn("host_", found).where("host_ IS NOT NULL").select("*", "host_.*").drop("host_")


def version_verdict(df: DataFrame, code: str) -> DataFrame:
    """df, which has max_code, with (recognized, compatible, reason)."""
    own, most = scalar.version_number(F.col(code)), scalar.version_number(F.col("max_code"))
    recognized = own.isNotNull() & most.isNotNull()
    compatible = F.coalesce(own <= most, F.lit(False))
    reason = F.when(~recognized, "dwg_version_unrecognized").when(compatible, "dwg_version_supported").otherwise("dwg_version_newer_than_host")
    return df.withColumns({"recognized": recognized, "compatible": compatible, "reason": reason})


def key_gate(df: DataFrame, key: str) -> DataFrame:
    """One row (n, keys, passes): passes where there are rows and each has a key of its own that is not blank."""
    text = scalar.clean(F.col(key))
    counts = df.groupBy(text.alias("k")).agg(F.count("*").alias("c"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("k") != "").alias("keys"))
    return total.withColumn("passes", (F.col("n") > 0) & (F.col("n") == F.col("keys")))


def outside(values: Column, allowed: list[str]) -> Column:
    """Those of an array that are not allowed."""
    return F.array_except(values, F.array(*[F.lit(x) for x in allowed]))


def copy_gate(original: str, copy: str, expected_sha256: str, found_sha256: str) -> list[str]:
    """What is wrong with a working copy: none where it is another file and has the expected hash, in any case of letters."""
    hexadecimal = set("0123456789abcdefABCDEF")
    well_formed = len(expected_sha256) == 64 and set(expected_sha256) <= hexadecimal
    checks = ((original.replace("\\", "/").lower() == copy.replace("\\", "/").lower(), "the copy is the original"), (not well_formed, "the expected hash is not a SHA-256"), (well_formed and expected_sha256.lower() != found_sha256.lower(), "the copy has another hash"))
    return [message for wrong, message in checks if wrong]


def completeness(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row (complete, reasons): the names of the conditions that do not hold for all rows, in order."""
    held = df.agg(*[F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True)).alias(f"f{i}") for i, c in enumerate(flags.values())])
    reasons = F.filter(F.array(*chain(*[[F.when(~F.col(f"f{i}"), F.lit(name))] for i, name in enumerate(flags)])), lambda x: x.isNotNull())
    return held.select((F.size(reasons) == 0).alias("complete"), reasons.alias("reasons"))


# fixed values: the version of a whole side index, the spaces of rotations that are the world's, and the two states of the gate
INDEX_VERSION, WORLD = "D2L-sidedb-2.2", ("entity-world", "expanded-world")
GATE_PASSED, GATE_FAILED = "evidence_gate_passed", "evidence_gate_failed"


def index_gate(headers: DataFrame, records: DataFrame, key: str = "drawing") -> DataFrame:
    """(key, status, reasons): whether a side index may stand as evidence; reasons name what does not hold, in order.

    headers has key, schema_version, truncated and skipped_object_count; records has key,
    kind, effective_visible, effective_plottable and rotation_space. Each record must say
    whether it is shown and plotted, and each text must be turned in the world.
    """
    text = F.col("kind") == "text"
    by = records.groupBy(F.col(key).alias("key_")).agg(F.count("*").alias("n"), F.count_if(F.col("effective_visible").isNull() | F.col("effective_plottable").isNull()).alias("unsaid"), F.count_if(text & ~F.coalesce(F.col("rotation_space").isin(*WORLD), F.lit(False))).alias("unturned"))
    rows = headers.join(by, headers[key] == by["key_"], "left")
    checks = {
        "schema_version": ~F.col("schema_version").eqNullSafe(F.lit(INDEX_VERSION)), "truncated": ~F.col("truncated").eqNullSafe(F.lit(False)), "skipped_object_count": ~F.col("skipped_object_count").cast("long").eqNullSafe(F.lit(0).cast("long")),
        "no_records": F.col("n").isNull(), "visibility_fields": F.coalesce(F.col("unsaid") > 0, F.lit(False)), "rotation_space": F.coalesce(F.col("unturned") > 0, F.lit(False)),
    }
    reasons = F.concat_ws(";", *[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return rows.select(headers[key], F.when(reasons == "", GATE_PASSED).otherwise(GATE_FAILED).alias("status"), reasons.alias("reasons"))
