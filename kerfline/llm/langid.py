"""Language identification by multinomial naive Bayes over hashed character n-grams.

Defined cases: a null or letterless text is `und` with score 0; without any labelled
training row every text is `und`; equal likelihoods go to the language that sorts
first; other columns of the input are not looked at, and repeated rows are scored
alike. Null languages are not learned from. With more than 512 languages there are fewer
hash buckets, so that the table keeps its size. A very long text is scored whole, in steps
of bounded memory; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 16
#: Cells of the table of log-probabilities at most, and cells of it gathered at once.
TABLE_CELLS, CELLS = 1 << 25, 1 << 22
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def grams(column) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each order the hashed n-grams and the index of their text, and the letters in each text.

    Text is folded to lower case, and each run of other characters becomes one space.
    """
    texts = [t or "" for t in column.to_pylist()]
    codes = np.frombuffer((" ".join(texts) + " ").lower().encode("utf-32-le", "replace"), np.uint32)
    lengths = np.fromiter((len(t.lower()) for t in texts), np.int64, len(texts))
    doc = np.repeat(np.arange(len(texts)), lengths + 1)
    letter = _letter_table()[codes]
    keep = letter | np.concatenate(([True], letter[:-1]))
    keep |= np.concatenate(([True], doc[1:] != doc[:-1]))
    letters = np.bincount(doc[letter], minlength=len(texts))
    codes, doc = np.where(letter, codes, 32)[keep].astype(np.uint64), doc[keep]
    hashed, owner, h = [], [], np.zeros(len(codes), np.uint64)
    for k in range(max(ORDERS)):
        h = (h[: len(codes) - k] + codes[k:] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if k + 1 in ORDERS:
            same = doc[: len(codes) - k] == doc[k:]
            hashed.append((h[same] >> np.uint64(17)).astype(np.int64) % BUCKETS)
            owner.append(doc[: len(codes) - k][same])
    return hashed, owner, letters


@dataclass
class LanguageModel:
    """Log-probabilities of BUCKETS hashed n-grams by language; its size is fixed by BUCKETS and the labels."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray  # BUCKETS x languages, float32

    def score(self, column) -> tuple[list[str], np.ndarray]:
        hashed, owner, letters = grams(column)
        n, width = len(letters), len(self.languages)
        if not width:
            return ["und"] * n, np.zeros(n)
        total, count = np.zeros((n, width)), np.zeros(n)
        for h, doc in zip(hashed, owner):
            count += np.bincount(doc, minlength=n)
            for a in range(0, len(h), max(1, CELLS // width)):
                some, own = h[a : a + max(1, CELLS // width)] % len(self.table), doc[a : a + max(1, CELLS // width)]
                first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
                total[own[first]] += np.add.reduceat(self.table[some], first, axis=0, dtype=np.float64)
        best = np.argmax(total + self.prior, axis=1)
        # long texts count as SHARPNESS n-grams: else every score would round to 1
        logit = total * np.minimum(1, 200 / np.maximum(count, 1))[:, None] + self.prior
        logit -= logit.max(axis=1, keepdims=True)
        p = np.exp(logit)
        p = (p / p.sum(axis=1, keepdims=True))[np.arange(n), best]
        return [self.languages[b] if k else "und" for b, k in zip(best, letters)], np.where(letters > 0, p, 0.0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_rows: int = 20000, smoothing: float = 0.2) -> LanguageModel:
    """Learns from about max_rows labelled rows, chosen by a hash of the id (all of them if there are fewer)."""
    blocks.small_batches(docs)
    rows = docs.where(docs[lang].isNotNull())
    total = rows.count()
    if total > max_rows:
        rows = rows.where(F.pmod(F.xxhash64(docs[doc_id]), F.lit(1_000_000)) < int(1_000_000 * max_rows / total) + 1)
    languages = [r[0] for r in rows.select(lang).distinct().orderBy(lang).collect()]  # at most about max_rows
    if not languages:
        return LanguageModel([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    number, buckets = {x: i for i, x in enumerate(languages)}, BUCKETS
    while buckets * len(languages) > TABLE_CELLS:
        buckets //= 2

    def count(batches):
        seen = np.zeros((len(languages), buckets + 1), np.int64)
        for batch in blocks.sliced(batches, "text"):
            of = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            hashed, owner, _ = grams(batch.column(0))
            seen[:, buckets] += np.bincount(of, minlength=len(languages))
            for h, doc in zip(hashed, owner):
                seen += np.bincount(of[doc] * (buckets + 1) + h % buckets, minlength=seen.size).reshape(seen.shape)
        k, b = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(k * (buckets + 1) + b), pa.array(seen[k, b])], names=["cell", "n"])

    cells = rows.select(docs[text].alias("text"), docs[lang].alias("lang")).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = cells.toPandas()  # at most languages x (buckets + 1) rows, and so TABLE_CELLS and one a language
    seen = np.zeros((len(languages), buckets + 1))
    seen.ravel()[got["cell"].to_numpy()] = got["n"].to_numpy()
    docs_of, seen = seen[:, buckets], seen[:, :buckets] + smoothing
    table = np.log(seen / seen.sum(axis=1, keepdims=True)).T.astype(np.float32)
    return LanguageModel(languages, np.log(docs_of / docs_of.sum()), np.ascontiguousarray(table))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    blocks.small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            lang, score = shared.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose language is identified with at least min_score; `und` goes."""
    blocks.small_batches(docs)
    shared, schema = docs.sparkSession.sparkContext.broadcast(model), docs.schema

    def run(batches):
        for batch in blocks.sliced(batches, text):
            lang, score = shared.value.score(batch.column(batch.schema.get_field_index(text)))
            keep = (score >= min_score) & (np.array(lang, object) != "und")
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
