"""Rules for documents: portable evidence, route records, assistant settings. Each gives messages; none means valid."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar
from . import diff, gates, ordering, rules

# fixed values: what the metadata of portable evidence must say
PORTABLE = {
    "schema_version": "acadsharp-portable-evidence/0.1", "backend": "ACadSharp", "formal_backend_equivalent": False, "absence_proven": False, "original_dwg_opened_by_parser": False, "analysis_copy_only": True,
    "coordinate_evidence_status": "candidate_requires_field_comparison", "attribute_coordinate_status": "parser_value_not_backend_equivalent", "effective_layer_status": "not_implemented_unverified", "layout_viewport_visibility_status": "not_implemented_unverified",
}
STATUSES = ("portable_readonly_candidate_ready_for_comparison", "portable_readonly_candidate_unresolved")
TEXTS = ("entity_type", "handle", "instance_key", "root_space", "block_path", "layer")


def portable_errors(documents: DataFrame, statuses: tuple[str, ...] = STATUSES, expected: Mapping = PORTABLE) -> DataFrame:
    """(document, error) for documents (document, metadata, summary, evidence_records) of portable evidence."""
    m, size = F.col("metadata"), F.coalesce(F.size(F.when(F.col("evidence_records").isNotNull(), F.col("evidence_records"))), F.lit(0))
    checks = [(f"metadata.{k} must be {str(v).lower() if isinstance(v, bool) else v}", ~m[k].eqNullSafe(F.lit(v))) for k, v in expected.items()]
    checks += [
        ("metadata.status is not allowed", ~F.coalesce(m["status"].isin(*statuses), F.lit(False))),
        ("metadata.source_sha256 must be an upper-case SHA-256", ~F.coalesce(m["source_sha256"].rlike("^[0-9A-F]{64}$"), F.lit(False))),
        ("summary.evidence_record_count does not match the records", ~F.col("summary.evidence_record_count").eqNullSafe(size.cast("bigint"))),
    ]
    whole = rules.run_rules(documents, "document", checks).withColumnRenamed("rule", "error")
    rows = documents.select("document", F.posexplode("evidence_records").alias("place", "r")).select("document", "place", "r.*")
    broken = [(f"{c} must be a text", F.col(c).isNull()) for c in TEXTS] + scalar.finite_rules(rows, ("document", "place"))
    where = F.concat(F.lit("evidence_records["), F.col("place").cast("string"), F.lit("]."))
    each = rows.select("document", F.explode(F.filter(F.array(*[F.when(bad, F.concat(where, F.lit(name))) for name, bad in broken]), lambda x: x.isNotNull())).alias("error"))
    twice = rows.where("instance_key IS NOT NULL").groupBy("document", "instance_key").agg(F.count("*").alias("n")).where("n > 1")
    return diff.union_all([whole, each, twice.select("document", F.concat(F.lit("instance_key given more than once: "), "instance_key").alias("error"))])


# fixed values: the order in which readers are tried, and the status under which each is chosen
ROUTE = {
    "ACadSharp": "portable_candidate_selected",
    "ZWCAD": "zwcad_native_fallback_selected",
    "AutoCAD2023": "autocad_2023_native_fallback_selected",
    "AutoCAD2020": "autocad_2020_native_fallback_selected",
    "AutoCAD2018": "autocad_2018_native_fallback_selected",
    "AutoCAD2014": "autocad_2014_native_fallback_selected",
}
ROUTE_VERSION, HASH_CHANGED, MANUAL = "cad-backend-route/0.2", "source_hash_changed_safe_stop", "manual_review_required_no_backend"
ROUTE_SCHEMA = "document string, schema_version string, status string, selected_backend string, selected_output string, source_dwg_version string, source_sha256_before string, source_sha256_after string, source_unchanged boolean, absence_proven boolean, route_order array<string>, attempts array<struct<backend:string,status:string,host_release:string,host_api_version:string,host_file_version:string,max_dwg_version:string>>"


def route_errors(routes: DataFrame, hosts=gates.HOSTS, host_name: str = "AutoCAD") -> DataFrame:
    """(document, error) for route records; attempts are told by their place."""
    known, before, after = F.array(*[F.lit(x) for x in ROUTE]), F.col("source_sha256_before"), F.col("source_sha256_after")
    unchanged = F.coalesce(before == after, F.lit(False))
    wanted, status, attempts = None, F.col("status"), F.col("attempts")
    for backend, name in ROUTE.items():
        wanted = F.when(status == name, backend) if wanted is None else wanted.when(status == name, backend)
    sha = lambda c: ~F.coalesce(c.rlike("^[0-9A-F]{64}$"), F.lit(False))
    empty = F.coalesce(F.size(F.when(attempts.isNotNull(), attempts)), F.lit(0)) == 0
    checks = [
        (f"schema_version must be {ROUTE_VERSION}", ~F.col("schema_version").eqNullSafe(F.lit(ROUTE_VERSION))),
        ("route_order is not the declared one", ~F.col("route_order").eqNullSafe(known)),
        ("absence_proven must remain false", ~F.col("absence_proven").eqNullSafe(F.lit(False))),
        ("source_dwg_version must be an AC code or UNRECOGNIZED", ~F.coalesce(F.col("source_dwg_version").rlike("^(AC[0-9]{4}|UNRECOGNIZED)$"), F.lit(False))),
        ("source_sha256_before must be an upper-case SHA-256", sha(before)),
        ("source_sha256_after must be an upper-case SHA-256", sha(after)),
        ("source_unchanged does not match the two hashes", ~F.col("source_unchanged").eqNullSafe(unchanged)),
        ("status is not known", ~F.coalesce(status.isin(*ROUTE.values(), HASH_CHANGED, MANUAL), F.lit(False))),
        ("a stop cannot select a backend", wanted.isNull() & (F.col("selected_backend").isNotNull() | F.col("selected_output").isNotNull())),
        ("selected_backend does not match status", wanted.isNotNull() & ~F.col("selected_backend").eqNullSafe(wanted)),
        ("a selected backend must have a selected_output", wanted.isNotNull() & (F.coalesce(F.col("selected_output"), F.lit("")) == "")),
        ("attempts must not be empty", empty),
        (f"the first attempt is not one of {next(iter(ROUTE))}", ~empty & ~F.get(attempts, F.lit(0))["backend"].eqNullSafe(F.lit(next(iter(ROUTE))))),
        ("no attempt of the chosen reader succeeded", ~empty & wanted.isNotNull() & ~F.coalesce(F.exists(attempts, lambda a: (a["backend"] == wanted) & (a["status"] == "success")), F.lit(False))),
        (f"{HASH_CHANGED} requires a changed hash", ~empty & (status == HASH_CHANGED) & unchanged),
    ]
    whole = rules.run_rules(routes, "document", checks).withColumnRenamed("rule", "error")
    rows = routes.select("document", "source_dwg_version", F.posexplode("attempts").alias("place", "a")).select("document", "source_dwg_version", "place", "a.*")
    source = scalar.version_number(F.col("source_dwg_version"))
    is_host = F.array_contains(F.array(*[F.lit(f"{host_name}{h[0]}") for h in hosts]), F.col("backend"))
    plain = F.array_contains(known, F.col("backend")) & ~is_host
    won, broken = F.col("status") == "success", [("backend is not known", ~F.coalesce(F.array_contains(known, F.col("backend")), F.lit(False)))]
    for release, api, _, newest, _ in hosts:
        own = F.col("backend") == f"{host_name}{release}"
        broken += [(f"{c} does not match backend", own & ~F.col(c).eqNullSafe(F.lit(v))) for c, v in (("host_release", release), ("host_api_version", api), ("max_dwg_version", newest))]
        broken.append((f"{host_name}{release} cannot succeed for the source's version", own & won & ((F.col("source_dwg_version") == "UNRECOGNIZED") | (source > int(newest[2:])))))
    broken += [(f"{c} must be null", plain & F.col(c).isNotNull()) for c in ("host_release", "host_api_version", "host_file_version", "max_dwg_version")]
    where = F.concat(F.lit("attempts["), F.col("place").cast("string"), F.lit("]: "))
    each = rows.select("document", F.explode(F.filter(F.array(*[F.when(bad, F.concat(where, F.lit(name))) for name, bad in broken]), lambda x: x.isNotNull())).alias("error"))
    asked = rows.where(F.array_contains(known, F.col("backend")))
    disorder = ordering.out_of_order(asked, "document", "place", "backend", list(ROUTE)).where("out_of_order > 0")
    return diff.union_all([whole, each, disorder.select("document", F.lit("attempts do not follow the declared order").alias("error"))])


# fixed values of the assistant's settings
CONFIG_VERSION = "multimodal-assistant-1.0"
USES = ("beam_section_candidate_review", "high_risk_roi_review", "axis_location_review", "proxy_object_review")
ROUTES = ("base_model_multimodal", "configured_multimodal_assistant", "text_only_conservative")


def assistant_route(config: Mapping, environment: Mapping[str, str], base_sees_images: bool = False) -> tuple[list[str], str]:
    """(errors, route) of one settings file; whether a secret is there is looked at, the secret is not."""
    on, images = config.get("enabled") is True, "image" in (config.get("input_modes") or ())
    wrong = {
        "schema_version is not supported": config.get("schema_version") != CONFIG_VERSION,
        "an enabled assistant must take images": on and not images,
        "use_for has a value that is not supported": not set(config.get("use_for") or ()) <= set(USES),
        "formal_confirmation_allowed has to stay off": config.get("formal_confirmation_allowed") is not False,
    }
    errors = [message for message, bad in wrong.items() if bad]
    complete = all(config.get(k) for k in ("provider", "model", "api_key_env")) and bool(environment.get(config["api_key_env"]))
    return errors, ROUTES[0] if base_sees_images else ROUTES[1] if on and images and complete and not errors else ROUTES[2]
