"""Reading export documents and files; writing them back."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import documents


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents, one object a file, a byte-order mark allowed; anything else fails, a root array too."""
    return documents.read_whole(spark, path, schema)


# fixed values: what the names of a drawing's six documents end in
SUFFIXES = {"text": "cad_text_export_v5", "frame": "cad_frame_export_v5", "symbol": "cad_symbol_export_v6", "oriented_text": "cad_oriented_text_export_v7", "primitive": "cad_primitive_export_v10", "visibility": "cad_visibility_export_v13"}
#: The arrays that hold the records of each kind, by document.
ARRAYS = {"text": ("text", "records"), "frame_lines": ("frame", "line_segments"), "symbol": ("symbol", "records"), "oriented_text": ("oriented_text", "records"), "primitive": ("primitive", "records"), "visibility": ("visibility", "records"), "layers": ("visibility", "layers"), "layouts": ("visibility", "layouts"), "viewports": ("visibility", "viewports")}


def read_pair(spark: SparkSession, left: str, right: str, stem: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The records of both folders' documents of one drawing, by kind.

    Both sides of a document are read by one schema, inferred from the two files, so that
    a field which one lacks is null there. A kind that neither has is left out.
    """
    out: tuple[dict, dict] = {}, {}
    for kind, (document, field) in ARRAYS.items():
        paths = [f"{folder}/{stem}.{SUFFIXES[document]}.json" for folder in (left, right)]
        schema = spark.read.option("multiLine", True).option("allowNonNumericNumbers", True).json(paths).schema
        if field in schema.names and isinstance(schema[field].dataType, T.ArrayType) and isinstance(schema[field].dataType.elementType, T.StructType):
            for side, path in zip(out, paths):
                side[kind] = records(read_document(spark, path, schema), field)
    return out


def raw_counts(entity: DataFrame, attribute: DataFrame) -> DataFrame:
    """(type, n) over all definitions, reached or not; attributes count as a type of their own."""
    return entity.groupBy("type").agg(F.count("*").alias("n")).unionByName(attribute.agg(F.lit("ATTRIB").alias("type"), F.count("*").alias("n")))


def records(document: DataFrame, field: str = "records") -> DataFrame:
    """The rows of one array of a document; null entries are left out."""
    return document.select(F.posexplode(field).alias("ordinal", "r")).where("r IS NOT NULL").select("ordinal", "r.*")


def snapshot(spark: SparkSession, path: str, role: str = "") -> DataFrame:
    """(role, path, sha256, bytes, version) of files: upper-case hash, and the drawing version from the first 6 bytes."""
    files = spark.read.format("binaryFile").load(path)
    head = F.decode(F.substring("content", 1, 6), "ISO-8859-1")
    return files.select(F.lit(role).alias("role"), "path", F.upper(F.sha2("content", 256)).alias("sha256"), F.col("length").alias("bytes"), F.when(head.rlike("^AC[0-9]{4}$"), head).otherwise("UNRECOGNIZED").alias("version"))


def layout_entities(block_def: DataFrame, entity: DataFrame) -> DataFrame:
    """Entities of layout spaces, external references left out."""
    spaces = block_def.where("is_layout AND NOT is_xref").select("drawing", F.col("def_id").alias("owner_def"))
    return entity.join(spaces, ["drawing", "owner_def"], "left_semi")


def canonical_hash(report: dict) -> str:
    """Upper-case SHA-256 of the canonical JSON text: sorted keys, compact, a line feed at the end."""
    text = json.dumps(report, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n"
    return hashlib.sha256(text.encode()).hexdigest().upper()


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A report table; for summaries only, as its rows come to the driver: more than `most` of them are an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for a report table")
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows]) + "\n"


def write_csv(df: DataFrame, path: str) -> None:
    """Files with a header, line feeds and a byte-order mark each; null is empty."""
    names = df.columns
    # the mark is the first character of the first column's name, as each file begins with the header
    df.toDF("\ufeff" + names[0], *names[1:]).write.mode("overwrite").option("header", True).option("lineSep", "\n").option("escape", '"').option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Texts by the names of the header, a byte-order mark allowed."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def positive(value: str | None, fallback: int) -> int:
    """A positive whole number from a setting, else the fallback."""
    text = (value or "").strip()
    return int(text) if text.isdigit() and int(text) > 0 else fallback
