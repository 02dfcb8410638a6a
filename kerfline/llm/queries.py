"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import blocks, decontam, gif, jaccard, langid, linededup, packing, quality, repeats, spandedup, toxicity, twofit, txlog, variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), 200, keep_text=False).drop("kept")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spandedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2(F.col("kept_text").cast("binary"), 256)).drop("kept_text")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), token_path())


def op5_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.digests(gif.store(_table(spark, sf_dir, "documents")))


def _held_out(scored: DataFrame, docs: DataFrame, parts: int, fold: int) -> DataFrame:
    return scored.withColumn("held_out", F.coalesce(blocks.bucket_of(F.col("doc_id"), parts) == fold, F.lit(False)))


def _labelled(spark: SparkSession, sf_dir: str, label: str, parts: int, fold: int) -> DataFrame:
    """Texts of the rows that may be learned from, with their label."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learn = labels.where(blocks.bucket_of(F.col("doc_id"), parts) != fold).select("doc_id", label)
    return docs.select("doc_id", "text").join(learn, "doc_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(_labelled(spark, sf_dir, "quality", 4, 2))
    return _held_out(quality.predict(docs, model), docs, 4, 2).select("doc_id", "held_out", "score", "predicted")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(blocks.bucket_of(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang"))
    return _held_out(langid.predict(docs, model), docs, 4, 2).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _labelled(spark, sf_dir, "toxic", 5, 0))
    return _held_out(toxicity.predict(docs, model), docs, 5, 0).select("doc_id", "held_out", "score", "predicted")


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), words=4, percent=85)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.drop_boilerplate(_table(spark, sf_dir, "documents"), counts=True)
    return found.select("doc_id", "source", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.count_words(_table(spark, sf_dir, "documents"), least=7, drop_every=31)
    return variants.group_variants(words.where("n >= 2"), ratio=10)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = twofit.pack(_table(spark, sf_dir, "documents"), token_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txlog.reassemble(txlog.records(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_decontamination, op3_span_dedup, op4_packing, op5_gif, op6_quality, op7_language, op8_toxicity, op9_jaccard, op10_line_dedup, op11_variants, op12_best_fit, op13_transactions)}

SQL = {
    "op10_line_dedup": """
WITH split AS (SELECT rowid_ AS r, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
               FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) AS d),
pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
held AS (SELECT source, line, count(DISTINCT r) AS held FROM split WHERE trim(line) <> '' GROUP BY source, line),
common AS (SELECT h.source, h.line FROM held h JOIN pages p ON h.source IS NOT DISTINCT FROM p.source WHERE h.held >= least(5, greatest(p.pages, 2)) AND h.held > p.pages * 0.05),
kept AS (SELECT s.r, count(*) AS n_lines, count(c.line) AS n_dropped,
                coalesce(string_agg(s.line, chr(10) ORDER BY s.place) FILTER (WHERE c.line IS NULL), '') AS text
         FROM split s LEFT JOIN common c ON s.source IS NOT DISTINCT FROM c.source AND s.line = c.line GROUP BY s.r)
SELECT d.doc_id, d.source, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN sha256(k.text) END AS kept_sha256
FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents) d LEFT JOIN kept k ON k.r = d.rowid_""",
}
