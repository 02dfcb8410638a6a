"""Toxicity by class-conditional Kneser-Ney bigram models.

Toxic and ordinary rows each give an interpolated Kneser-Ney model: bigrams back off
to the continuation counts of their own class, and these to continuation counts shared
by both: how many different words precede a word anywhere in the corpus, out of all
different pairs. Words and pairs are told apart by 64-bit hashes. A word that neither
class knows well gets the same probability from both, whatever its count, so that only
the counts of the words that a class knows are brought together. The log-likelihood ratio, normalised by
length over the whole text and over its most suspicious short window, is turned into a
probability by a logistic curve fitted on labelled rows that gave no counts.

Defined cases: a text without words (or null) gets the share of toxic rows among the
labelled; without labelled rows of both classes every score is that share (0.5 without
any). A very long text is read whole, in memory that grows with its own words; an empty
table gives no rows. Repeated rows and ties are scored alike; other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

#: Pairs that a task holds before it passes them on, and the parts they are dealt to, at least.
HELD, BUCKETS = 1 << 22, 1 << 10
#: What absolute discounting takes from each count of a class, at most the count itself: an
#: expression met in no more places than that is left to the shared counts.
PAIR_DISCOUNT, WORD_DISCOUNT = 2, 3
WINDOW = 6
_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'")] = True
_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Hash of every word, hash of the word before, and text; a text's first word follows 0, which is no word."""
    data, starts, _ = blocks.separated(column)
    data = _LOWER[data]
    s, e = blocks.runs(_WORD[data])
    word = np.maximum(blocks.range_hashes(blocks.prefix_sums(blocks.BYTE_VALUES[data]), s, e), np.uint64(1))
    doc = np.searchsorted(starts, s, side="right") - 1
    before = np.concatenate((np.zeros(1, np.uint64), word[:-1])) if len(word) else word
    before[np.concatenate(([True], doc[1:] != doc[:-1]))[: len(doc)]] = 0
    return word, before, doc, len(starts)


def _pair(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return blocks.mix64(blocks.mix64(before) + word)


def _place(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Where each x is in the sorted known; len(known) for those that are not."""
    at = np.searchsorted(known, x)
    at[at < len(known)] = np.where(known[at[at < len(known)]] == x[at < len(known)], at[at < len(known)], len(known))
    return at


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # sorted hashes of what the classes know; max_rows bounds these, not the corpus
    bigrams: np.ndarray
    ratio: tuple  # for each class the counts of bigrams, contexts and words, with one place more for the unknown
    weights: np.ndarray
    prior: float

    def features(self, column) -> tuple[np.ndarray, np.ndarray]:
        word, before, doc, n = words(column)
        count = np.bincount(doc, minlength=n)
        if not self.ratio or not len(word):
            return np.zeros((n, 4)), count
        cell, before, pair = _place(self.vocabulary, word), _place(self.vocabulary, before), _place(self.bigrams, _pair(before, word))
        logs, alone = [], []
        for pairs, context, taken, unigram in self.ratio:
            # a context that the class does not know, or not well, backs off altogether
            share = np.where(context > 0, taken / np.maximum(context, 1), 1)
            p = np.maximum(pairs[pair] - PAIR_DISCOUNT, 0) / np.maximum(context[before], 1) + share[before] * unigram[cell]
            logs.append(np.log(p))
            alone.append(np.log(unigram[cell]))
        llr = logs[0] - logs[1]
        words_only = alone[0] - alone[1]
        mean = np.bincount(doc, llr, n) / np.maximum(count, 1)
        # mean over each window of up to WINDOW words inside one text; the largest counts
        sums = np.concatenate(([0.0], np.cumsum(llr)))
        last = np.cumsum(count)[doc]
        upto = np.minimum(np.arange(len(llr)) + WINDOW, last)
        window = (sums[upto] - sums[:-1]) / WINDOW
        first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        top = np.zeros(n)
        top[doc[first]] = np.maximum.reduceat(window, first)
        single = np.zeros(n)
        single[doc[first]] = np.maximum.reduceat(words_only, first)
        return np.column_stack([mean, top, single, np.log1p(count) / 5]), count

    def score(self, column) -> np.ndarray:
        x, count = self.features(column)
        if not self.ratio:
            return np.full(len(count), self.prior)
        z = np.column_stack([np.ones(len(x)), x]) @ self.weights
        return np.where(count > 0, 1 / (1 + np.exp(-np.clip(z, -35, 35))), self.prior)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton steps."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _packed(keys: np.ndarray, *more: np.ndarray) -> bytes:
    """Rising 64-bit keys by their steps, and arrays beside them, each byte of a value apart."""
    parts = [np.diff(keys, prepend=np.uint64(0)), *more]
    return pa.compress(b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in parts), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, *kinds) -> list[np.ndarray]:
    sizes = [8, *[np.dtype(k).itemsize for k in kinds]]
    data, out, at = np.frombuffer(pa.decompress(raw, n * sum(sizes), codec="zstd", asbytes=True), np.uint8), [], 0
    for size, kind in zip(sizes, [np.uint64, *kinds]):
        out.append(np.ascontiguousarray(data[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return [np.cumsum(out[0], dtype=np.uint64), *out[1:]]


def _distinct(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray | None]:
    keys = np.concatenate([p[0] for p in parts])
    if parts[0][1] is None:
        return np.unique(keys), None
    keys, first = np.unique(keys, return_index=True)
    return keys, np.concatenate([p[1] for p in parts])[first]


def corpus_counts(docs: DataFrame, vocabulary: np.ndarray, text: str = "text", buckets: int | None = None) -> tuple[np.ndarray, int]:
    """Shared backoff: how many different words precede each word of the sorted vocabulary, over all texts, and how many different pairs there are of any words.

    A task passes on each pair once: two words of the vocabulary by their places, others
    by the 64-bit hash of the pair with the place of its second word. Equal pairs meet in
    one of the buckets and count once. What reaches the driver has the vocabulary's size.
    """
    size = len(vocabulary)
    if buckets is None:
        buckets = max(BUCKETS, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bc = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def passed(parts, kind):
        keys, ids = _distinct(parts)
        # both grow with the key, so that a bucket is a slice
        at = (keys // np.uint64(max(size, 1)) * np.uint64(buckets) // np.uint64(max(size, 1)) if kind == 0 else keys // np.uint64((1 << 64) // buckets + 1)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1)) if len(at) else np.zeros(1, np.int64)
        sides = list(zip(cuts[:-1], cuts[1:]))
        data = [_packed(keys[a:b]) if ids is None else _packed(keys[a:b], ids[a:b]) for a, b in sides]
        columns = [pa.array(at[cuts[:-1]].astype(np.int32)), pa.array(np.full(len(sides), kind, np.int32)), pa.array(np.diff(cuts).astype(np.int32)), pa.array(data, pa.binary())]
        whole = pa.RecordBatch.from_arrays(columns, names=["bucket", "kind", "n", "data"])
        for i in range(0, len(sides), 256):
            yield whole.slice(i, 256)

    def gather(batches):
        held, sizes = ([], []), [0, 0]
        for batch in blocks.sliced(batches, "text"):
            word, before, *_ = words(batch.column(0))
            if not len(word):
                continue
            w, b = _place(bc.value, word), _place(bc.value, before)
            both = (w < size) & (b < size)
            key, first = np.unique(_pair(before[~both], word[~both]), return_index=True)
            new = (np.unique(w[both].astype(np.uint64) * np.uint64(size) + b[both].astype(np.uint64)), None), (key, w[~both][first].astype(np.int32))
            for kind in (0, 1):
                held[kind].append(new[kind])
                sizes[kind] += len(new[kind][0])
                if sizes[kind] > HELD:
                    # given away where most are different, and else gathered on
                    held[kind][:] = [_distinct(held[kind])]
                    sizes[kind] = len(held[kind][0][0])
                    if sizes[kind] > HELD // 2:
                        yield from passed(held[kind], kind)
                        held[kind].clear()
                        sizes[kind] = 0
        for kind in (0, 1):
            if held[kind]:
                yield from passed(held[kind], kind)

    def merge(batches):
        met, now, parts, number = np.zeros(size + 1, np.int64), None, [], 0

        def done():
            if parts:
                keys, ids = _distinct(parts)
                met[:] += np.bincount((keys // np.uint64(size)).astype(np.int64) if ids is None else ids, minlength=size + 1)
                parts.clear()

        for batch in batches:
            for bucket, kind, n, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if (bucket, kind) != now:
                    done()
                    now, number = (bucket, kind), 0
                parts.append((*_unpacked(raw, n), None) if kind == 0 else tuple(_unpacked(raw, n, np.int32)))
                number += n
                if number > HELD:
                    parts[:] = [_distinct(parts)]
                    number = len(parts[0][0]) // 2  # the next time at the latest when as many again have come
        done()
        at = np.flatnonzero(met)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(met[at])], names=["place", "n"])
        blocks.release()

    dealt = docs.select(docs[text].alias("text")).mapInArrow(gather, "bucket int, kind int, n int, data binary").repartition("bucket", "kind").sortWithinPartitions("bucket", "kind")
    got = dealt.mapInArrow(merge, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size + 1, np.int64)
    out[got["place"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out[:size], int(out.sum())


def fit(docs: DataFrame, labelled: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", max_rows: int = 30000) -> ToxicityModel:
    """docs gives the shared counts; labelled has doc_id, text and label (0 or 1), of which about max_rows are used."""
    rows = labelled.where(labelled[label].isNotNull()).select(labelled[doc_id].alias("doc_id"), labelled[text].alias("text"), labelled[label].cast("long").alias("y"))
    total = rows.count()
    if total > max_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * max_rows / total) + 1)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)))  # part 0 only calibrates

    def count(batches):
        rows_of = np.zeros(2, np.int64)
        for batch in blocks.sliced(batches, "text"):
            word, before, doc, _ = words(batch.column(0))
            y = batch.column(1).to_numpy(zero_copy_only=False)
            rows_of += np.bincount(y, minlength=2)[:2]
            own = y[doc]
            _, first, which = np.unique(_pair(before, word), return_index=True, return_inverse=True)
            # both classes' counts in one number: toxic rows from bit 32 on
            met = np.bincount(which[own == 0], minlength=len(first)) + (np.bincount(which[own == 1], minlength=len(first)) << 32)
            yield pa.RecordBatch.from_arrays([pa.array(before[first].view(np.int64)), pa.array(word[first].view(np.int64)), pa.array(met)], names=["before", "word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([0]), pa.array([int(rows_of[0] + (rows_of[1] << 32))])], names=["before", "word", "n"])

    counted = blocks.cut(rows.where("part <> 0").select("text", "y").mapInArrow(count, "before long, word long, n long").groupBy("before", "word").agg(F.sum("n").alias("n")))
    classes = F.explode(F.expr("array(named_struct('k', 0, 'n', n & 4294967295L), named_struct('k', 1, 'n', shiftright(n, 32)))")).alias("of")
    counted = counted.select("before", "word", classes).select("of.k", "before", "word", "of.n").where("n > 0")
    pairs = counted.where("word <> 0")
    # the driver gets what absolute discounting leaves, and sums: pairs, contexts and words met often enough
    often = pairs.where(F.col("n") > PAIR_DISCOUNT).toPandas()
    contexts = pairs.groupBy("k", "before").agg(F.sum("n").alias("n"), F.sum(F.least("n", F.lit(PAIR_DISCOUNT))).alias("taken")).where("n > taken").toPandas()
    continued = pairs.groupBy("k", "word").agg(F.count("*").alias("n"))
    known = continued.where(F.col("n") > WORD_DISCOUNT).toPandas()
    mass = {r["k"]: (r["total"], r["taken"]) for r in continued.groupBy("k").agg(F.sum("n").alias("total"), F.sum(F.least("n", F.lit(WORD_DISCOUNT))).alias("taken")).collect()}
    rows_of = {r["k"]: r["n"] for r in counted.where("word = 0").collect()}
    n0, n1 = rows_of.get(0, 0), rows_of.get(1, 0)
    prior = float(n1 / (n0 + n1)) if n0 + n1 else 0.5
    if not n0 or not n1:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0, np.uint64), (), np.zeros(5), prior)

    def hashes(table, column: str) -> np.ndarray:
        return table[column].to_numpy(np.int64).view(np.uint64)

    vocabulary = np.unique(np.concatenate([hashes(often, "word"), hashes(often, "before"), hashes(contexts, "before"), hashes(known, "word")]))
    often_pairs = _pair(hashes(often, "before"), hashes(often, "word"))
    bigrams = np.unique(often_pairs)

    def dense(table, k: int, value: str, keys: np.ndarray, column: np.ndarray) -> np.ndarray:
        own = (table["k"] == k).to_numpy()
        out = np.zeros(len(keys) + 1)
        out[_place(keys, column[own])] = table[value].to_numpy()[own]
        return out

    met, total_pairs = corpus_counts(docs, vocabulary, text)
    # a word that the corpus lacks counts as half a pair; the last place is for words of which neither class knows anything: its value is in both classes' probability as a factor and falls out of the ratio
    shared = np.append(np.maximum(met, 0.5) / max(total_pairs, 1), 1.0)
    ratio = []
    for k in (1, 0):
        total, taken = mass.get(k, (1, 1))
        unigram = np.maximum(dense(known, k, "n", vocabulary, hashes(known, "word")) - WORD_DISCOUNT, 0) / total + taken / total * shared
        ratio.append((dense(often, k, "n", bigrams, often_pairs), dense(contexts, k, "n", vocabulary, hashes(contexts, "before")), dense(contexts, k, "taken", vocabulary, hashes(contexts, "before")), unigram))
    model = ToxicityModel(vocabulary, bigrams, tuple(ratio), np.zeros(5), prior)
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def featured(batches):
        for batch in blocks.sliced(batches, "text"):
            x, n = bc.value.features(batch.column(0))
            keep = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[keep, i]) for i in range(4)] + [pa.array(batch.column(1).to_numpy(zero_copy_only=False)[keep])], names=["a", "b", "c", "d", "y"])

    held = rows.where("part = 0").select("text", "y").mapInArrow(featured, "a double, b double, c double, d double, y long").toPandas()  # about max_rows / 3 rows of numbers
    if held["y"].nunique() == 2:
        model.weights = _logistic(held[["a", "b", "c", "d"]].to_numpy(), held["y"].to_numpy())
    else:
        model.weights = np.array([np.log(prior / (1 - prior)), 1.0, 1.0, 0.0, 0.0])
    return model


def predict(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in blocks.sliced(batches, "text"):
            score = shared.value.score(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
