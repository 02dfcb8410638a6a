"""From raw documents to packed training sequences, one stage after the other.

Each stage reads what its predecessor kept and returns the columns of documents, but for
the last, which returns the packed pieces.

Defined cases, in all stages: null and empty texts go in the first stage, as nothing tells
their language, and a later stage given them keeps them (packing: as the closing id alone);
a very long text is read whole; rows that share an id are one document to near duplicates,
where that whose text sorts first stays, and rows of their own elsewhere; rows without an
id stay; a null source is a source; of documents alike that with the smallest id stays;
columns beside those of documents pass through but for packing; an empty table gives no
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerfline.llm import blocks, decontam, jaccard, langid, linededup, packing
from kerfline.llm.queries import token_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts whose language can't be told: no letters, or a score under 0.5."""
    model = langid.fit(docs.where(blocks.bucket_of(docs["doc_id"], 4) != 2).select("doc_id", "text", "lang"))
    return langid.keep_identified(docs, model)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines that more than a twentieth of a source's documents hold."""
    return linededup.drop_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by a Jaccard similarity of 0.8 or more over five-word shingles."""
    return jaccard.keep_first(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item with at most one edit in ten characters."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all tokens into sequences of at most 2048."""
    return packing.pack(docs, token_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can express neither the language model nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{blocks.shared_dir(spark)}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
