"""Export documents as tables: scans of their arrays by byte ranges, and writers that show nothing before all is written.

A document is one JSON object with scalar fields and arrays of records. As exports are laid
out, each field, each record and each bracket has a line of its own, so a scan reads lines:
a large file is split by bytes like any other text, and a record belongs to the array that
opened last before it. Documents of any other layout are read whole, one a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import cut
from ..operators.ordering import ranked

_OPTIONS = {"mode": "FAILFAST", "allowNonNumericNumbers": "true"}
_MARK = "\ufeff"


def _failed(path: Column, why: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{why}: "), path))


def read_whole(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One row a file, of the wanted fields: the root must be an object, a byte-order mark is allowed, anything else stops the read."""
    _none_empty(spark, path)
    files = spark.read.format("text").option("wholetext", True).load(path).select(F.regexp_replace("value", f"^{_MARK}", "").alias("body"), F.col("_metadata.file_path").alias("file"))
    whole = F.col("body").rlike(r"^\s*\{") & F.col("body").rlike(r"\}\s*$")
    checked = F.when(whole, F.col("body")).otherwise(_failed(F.col("file"), "malformed document, the root must be one whole object").cast("string"))
    return files.select(F.from_json(checked, schema, _OPTIONS).alias("d")).select("d.*")


def _none_empty(spark: SparkSession, path: str) -> None:
    """Stops the read if a file is empty, which scans would pass over; only names and lengths are looked at."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(root) or []:
        for file in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
            if not file.isDirectory() and not file.getPath().getName().startswith(("_", ".")) and file.getLen() == 0:
                raise ValueError(f"not one whole object: {file.getPath()} is empty")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, kind, name, body): the lines of all files; (block, at) is their order in a file."""
    rows = spark.read.text(path).select(F.trim(F.regexp_replace("value", f"^{_MARK}|\\s+$", "")).alias("t"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    body = F.regexp_replace("t", ",$", "")
    name = F.regexp_extract("t", r'^"((?:[^"\\]|\\.)*)"\s*:', 1)
    kind = F.when(body == "{", "open").when(body == "}", "close").when(body == "]", "end").when(body.rlike(r'^"(?:[^"\\]|\\.)*"\s*:\s*\[$'), "array")
    kind = kind.when(body.rlike(r"^\{.*\}$") | (body == "null"), "record").when(body.startswith('"') & (name != ""), "field").when(body == "", "blank")
    return rows.select("file", "block", "at", kind.otherwise("other").alias("kind"), name.alias("name"), body.alias("body")).where("kind <> 'blank'")


def _sections(spark: SparkSession, path: str, lines: DataFrame) -> DataFrame:
    """(file, sections): the arrays of each file, as (name, first, last) places. A file that is not one whole object in the layout of exports stops the read."""
    _none_empty(spark, path)
    place = F.struct("block", "at").alias("place")
    marks = lines.where("kind NOT IN ('record', 'field')").groupBy("file").agg(F.array_sort(F.collect_list(F.struct(place, "kind", "name"))).alias("marks"))
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file")).join(marks, "file", "left")
    kinds = F.array_join(F.transform("marks", lambda m: m["kind"]), " ")
    whole = F.coalesce(kinds.rlike("^open( array end)* close$"), F.lit(False))
    inner = F.filter(F.transform("marks", lambda m, i: F.struct(m["name"].alias("name"), m["kind"].alias("kind"), m["place"].alias("first"), F.try_element_at(F.col("marks"), i + 2)["place"].alias("last"))), lambda m: m["kind"] == "array")
    return files.select("file", F.when(whole, inner).otherwise(_failed(F.col("file"), "not one whole object with a line for each record").cast("array<struct<name:string,kind:string,first:struct<block:bigint,at:bigint>,last:struct<block:bigint,at:bigint>>>")).alias("sections"))


def scan(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The lines of all files and their sections, kept, for several reads of the same files."""
    lines = cut(_lines(spark, path))
    return lines, cut(_sections(spark, path, lines))


def read_array(spark: SparkSession, path: str, array: str, schema: T.StructType | str, scanned: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(file, ordinal, the wanted fields) of the records of one array, numbered from 0 in each file; null entries are left out.

    Large arrays are read by many tasks. A file that is cut short, has another root than an
    object or holds anything that is no line of an export stops the read. Who reads several
    arrays gives what scan() found, so that the files are scanned once.
    """
    lines, sections = scanned or scan(spark, path)
    rows = lines.where("kind = 'record'").join(sections, "file")
    at = F.struct("block", "at")
    inside = F.exists("sections", lambda s: (s["name"] == array) & (s["first"] < at) & (at < s["last"]))
    records = rows.where(inside & (F.col("body") != "null")).select("file", "block", "at", "body")
    numbered = ranked(records, ["block", "at"], "ordinal", within=["file"])
    return numbered.select("file", (F.col("ordinal") - 1).alias("ordinal"), F.from_json("body", schema, _OPTIONS).alias("r")).select("file", "ordinal", "r.*")


def read_header(spark: SparkSession, path: str, schema: T.StructType | str, scanned: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(file, the wanted fields) outside of the arrays; a field that a document lacks is null."""
    lines, sections = scanned or scan(spark, path)
    sections = sections.select("file")
    fields = lines.where("kind = 'field'").groupBy("file").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("body"), ","), F.lit("}")).alias("body"))
    found = sections.join(fields, "file", "left")
    return found.select("file", F.from_json(F.coalesce("body", F.lit("{}")), schema, _OPTIONS).alias("h")).select("file", "h.*")


def layouts_of(viewports: DataFrame, layouts: DataFrame) -> DataFrame:
    """Viewports with the name, handle and tab order of the layout that is on their space; an unknown one has empty texts and -1."""
    known = layouts.select(F.col("space_record_handle").alias("space_"), "layout_name", "layout_handle", F.col("tab_order").alias("layout_tab_order")).dropDuplicates(["space_"])
    joined = viewports.drop("layout_name", "layout_handle", "layout_tab_order").join(known, viewports["space_record_handle"] == known["space_"], "left").drop("space_")
    return joined.fillna("", ["layout_name", "layout_handle"]).fillna(-1, ["layout_tab_order"])


def _value(field: T.StructField) -> Column:
    """A column as JSON has it: numbers that are not finite are null."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    return c.alias(field.name)


def _json(columns: list[Column]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def document_lines(header: DataFrame, arrays: dict[str, tuple[DataFrame, list]], key: str = "drawing") -> DataFrame:
    """(key, section, place, line): the lines of each document, which stand in the order of section and place.

    header has a row for each document, whose columns are its fields; each array has its
    records, with the key, and the columns that they are ordered by, which are written too.
    """
    plain = [f for f in header.schema.fields]
    fields = F.array(*[F.concat(F.lit("  "), F.substring(_json([_value(f)]), 2, 1 << 30)) for f in plain])
    opening = F.concat(F.array(F.lit("{")), F.transform(fields, lambda t, i: F.concat(F.regexp_replace(t, r"\}$", ""), F.lit(",") if arrays else F.when(i < len(plain) - 1, ",").otherwise(""))))
    at = lambda section, lines: header.select(key, F.lit(section).alias("section"), F.posexplode(lines).alias("place", "line")).select(key, "section", F.col("place").cast("long").alias("place"), "line")
    out = at(0, opening)
    for k, (name, (records, order)) in enumerate(arrays.items()):
        out = out.union(at(3 * k + 1, F.array(F.lit(f'  "{name}": ['))))
        body = records.select(key, *order, _json([_value(f) for f in records.schema.fields if f.name != key]).alias("line"))
        numbered = ranked(body, order, "place", within=[key])
        most = numbered.groupBy(key).agg(F.max("place").alias("last"))
        out = out.union(numbered.join(most, key).select(key, F.lit(3 * k + 2).alias("section"), "place", F.concat(F.lit("    "), F.col("line"), F.when(F.col("place") < F.col("last"), ",").otherwise(""))))
        out = out.union(at(3 * k + 3, F.array(F.lit("  ]" + ("," if k < len(arrays) - 1 else "")))))
    return out.union(at(3 * len(arrays) + 1, F.array(F.lit("}"))))


def _renamed(spark: SparkSession, staging: str, name_of) -> None:
    """Moves the one file of each folder below staging to its own name, then drops staging; only names pass through the driver."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(staging)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    moves = []
    for folder in fs.listStatus(root):
        if folder.isDirectory():
            parts = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise ValueError(f"{len(parts)} files for one document in {folder.getPath()}")
            value = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.getPath().getName().split("=", 1)[1])
            moves.append((parts[0], jvm.org.apache.hadoop.fs.Path(name_of(value))))
    for source, target in moves:
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"{source} could not be moved to {target}")
    fs.delete(root, True)


def write_documents(header: DataFrame, arrays: dict[str, tuple[DataFrame, list]], folder: str, suffix: str, key: str = "drawing") -> None:
    """One document for each row of header, named `<key>.<suffix>.json`; see document_lines().

    The lines of a document are written by one task, as they stream out of its sort, to a
    hidden folder; only when all are written do they get their names. A document with that
    name is replaced. Keys that header has twice, or that are no file names, are an error,
    and records without a header are too.
    """
    spark = header.sparkSession
    names = header.groupBy(F.col(key).cast("string").alias("key")).count()
    if names.where("count > 1 OR key IS NULL").limit(1).count():
        raise ValueError(f"{key} must tell the documents apart")
    if names.where("key = '' OR key RLIKE '[/:]'").limit(1).count():
        raise ValueError(f"{key} must be a name that a file can have")
    for name, (records, _) in arrays.items():
        if records.join(header.select(key), key, "left_anti").limit(1).count():
            raise ValueError(f"records of {name} belong to no document")
    staging = f"{folder}/_being_written_{suffix}"
    lines = document_lines(header, arrays, key).repartition(key).sortWithinPartitions(key, "section", "place")
    lines.select(F.col(key).cast("string").alias("document"), "line").write.mode("overwrite").partitionBy("document").text(staging)
    _renamed(spark, staging, lambda value: f"{folder}/{value}.{suffix}.json")


def write_csv_file(df: DataFrame, path: str, order: list) -> None:
    """One CSV file with a byte-order mark, its rows in order; line feeds end lines, null is empty, and quotes are doubled."""
    first, *others = df.columns
    staging = f"{path}_being_written"
    text = df.toDF(_MARK + first, *others).withColumn("document", F.lit("report"))
    order = [F.col(_MARK + c if c == first else c) for c in order]
    text = text.coalesce(1).sortWithinPartitions("document", *order)
    text.write.mode("overwrite").partitionBy("document").option("header", True).option("lineSep", "\n").option("escape", '"').option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(staging)
    _renamed(df.sparkSession, staging, lambda _: path)
