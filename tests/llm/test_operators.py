"""Operators on small tables: nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerfline.llm import decontam, gif, jaccard, langid, linededup, packing, quality, repeats, spandedup, toxicity
from kerfline.llm.queries import token_path

SCHEMA = "doc_id long, text string, lang string, source string, score double"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    shared, long = words(rng, 80), words(rng, 6000)
    base = [words(rng, rng.randint(30, 120)) for _ in range(12)]
    out = [(i, t, "en", "a", 0.0) for i, t in enumerate(base)]
    near = base[0].split()
    near[7] = "changed"
    out += [(20, base[0], "en", "a", 0.0), (21, base[3] + " " + shared, "fr", "a", 0.0), (22, shared + " " + base[4], None, None, None), (23, " ".join(near), "en", "a", 0.0), (24, None, None, None, None), (25, "", "en", "b", 0.0), (26, long + long, "en", "b", 0.0), (2, base[2], "en", "a", 0.0), (27, "ha " * 400, "en", "b", 0.0), (28, "1 2 3", "en", "b", 0.0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("hot_bytes", [1 << 20, 100])
def test_repeats(docs, rows, nothing, hot_bytes):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = collections.Counter(t[i : i + 200] for _, t in texts for i in range(len(t) - 199))
    want = []
    for i, t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        kept = bytes(b for b, g in zip(t, gone) if not g)
        want.append((i, len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    got = repeats.remove_repeats(docs, 200, hot_bytes=hot_bytes).drop("kept").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert repeats.remove_repeats(nothing, 200).count() == 0


def test_jaccard(docs, rows, nothing):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(docs, 4, 85).collect()}
    sets = []
    for i, t, *_ in rows:
        w = (t or "").lower().split()
        sets.append((i, frozenset(tuple(w[k : k + 4]) for k in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])))
    least = {s: min(i for i, x in sets if x == s) for _, s in sets if s}
    changed = True
    while changed:
        changed = False
        for a in least:
            for b in least:
                if 100 * len(a & b) >= 85 * len(a | b) and least[b] < least[a]:
                    least[a], changed = least[b], True
    assert got == {(i, len(s)): least[s] if s else i for i, s in sets}
    assert jaccard.near_duplicates(nothing).count() == 0
    split = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.near_duplicates(docs, 4, 85, cell_tokens=100).collect()}
    assert split == got
    kept = [r.doc_id for r in jaccard.keep_first(docs).select("doc_id").collect()]
    assert len(kept) == len(set(kept)) and 20 not in kept and {0, 24, 25, 26} <= set(kept)


@pytest.mark.parametrize("cell_tokens", [300_000, 400])
def test_jaccard_chained_group(spark, cell_tokens):
    """Copies of one text with random edits: pairs on both sides of the limit, and chains."""
    rng = random.Random(9)
    base, made = words(rng, 100).split(), []
    for i in range(60):
        text = list(base)
        for at in rng.sample(range(100), rng.randint(0, 4)):
            text[at] = words(rng, 1)
        made.append((i, " ".join(text)))
    sets = [frozenset(tuple(t.split()[k : k + 4]) for k in range(97)) for _, t in made]
    least = list(range(60))
    for _ in range(60):
        for a in range(60):
            least[a] = min(least[b] for b in range(60) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    found = jaccard.near_duplicates(spark.createDataFrame(made, "doc_id long, text string"), cell_tokens=cell_tokens).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(enumerate(least))


def sentences(text):
    """Split anew: after . ! or ? before white space or the end, and at line ends."""
    return [x.strip(" \t\n\v\f\r") for x in re.split(r"(?<=[.!?])(?=[ \t\n\v\f\r])|\n", text or "") if x.strip(" \t\n\v\f\r")]


def spans_by_hand(texts, span, least):
    """The removed sentences of each (doc_id, text): {(doc_id, text): set of places}."""
    listed = {key: sentences(key[1]) for key in sorted(set(texts), key=lambda x: x[0])}
    first, gone = {}, {k: set() for k in listed}
    for key, parts in listed.items():
        for i in range(len(parts)):
            stop = next((j for j in range(i + span, len(parts) + 1) if sum(len(x.encode()) for x in parts[i:j]) >= least), len(parts) if i == 0 else None)
            if stop is not None and first.setdefault(tuple(parts[i:stop]), (key, i)) != (key, i):
                gone[key].update(range(i, stop))
    return gone


def test_spans(docs, rows, spark, nothing):
    made = [(1, "A one. B two. C three. D four."), (2, "X. A one.  B two.\nC three. Y."), (3, None), (3, ""), (2, "X. A one.  B two.\nC three. Y.")]
    got = spandedup.remove_repeats(spark.createDataFrame(made, "doc_id long, text string"), least_bytes=0).collect()
    want = {k: len(v) for k, v in spans_by_hand([(i, t or "") for i, t in made], 2, 0).items()}
    assert sorted((r.doc_id, r.n_sentences, r.n_removed, r.kept_text) for r in got) == [(1, 4, 0, made[0][1]), (2, 5, 3, "X. Y."), (2, 5, 3, "X. Y."), (3, 0, 0, ""), (3, 0, 0, "")] and want[2, made[1][1]] == 3
    assert spandedup.remove_repeats(nothing).count() == 0


def test_short_texts_and_passages(spark):
    """Copies of one or two sentences are cut whole, and so are two whole sentences among others."""
    made = [(1, "Only one sentence here."), (2, "Only one sentence here.  "), (3, "P one. Q two."), (4, "P one. Q two."), (5, "Own. P one. Q two. End."), (6, "P one."), (7, "Q two. P one."), (8, "!"), (9, "no stop"), (10, "no stop\n")]
    want = {1: 0, 2: 1, 3: 0, 4: 2, 5: 2, 6: 0, 7: 0, 8: 0, 9: 0, 10: 1}
    for rows in (made, made[::-1]):
        got = {r.doc_id: r for r in spandedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), least_bytes=0).collect()}
        assert {i: r.n_removed for i, r in got.items()} == want
        assert got[4].kept_text == got[2].kept_text == "" and got[5].kept_text == "Own. End."
    assert {k[0]: len(v) for k, v in spans_by_hand(made, 2, 0).items()} == want
    rng = random.Random(3)
    mixed = [(i, rng.choice([" ", "\n", "  "]).join(f"Sé{rng.randrange(9)}." for _ in range(rng.randrange(9)))) for i in range(80)]
    for span, least in ((1, 0), (2, 0), (3, 0), (2, 13), (2, 20), (1, 9)):
        removed = {(r.doc_id, t): r.n_removed for r, t in ((r, dict(mixed)[r.doc_id]) for r in spandedup.remove_repeats(spark.createDataFrame(mixed, "doc_id long, text string"), span, least).collect())}
        assert removed == {k: len(v) for k, v in spans_by_hand(mixed, span, least).items()}


def test_packing(docs, rows, nothing):
    got = packing.pack(docs, token_path(), group_rows=8).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert got[got.doc_id == 24][["length", "doc_tokens"]].values.tolist() == [[1, 1]]
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == (g["length"].cumsum() - g["length"]).tolist()
    assert got["length"].sum() == got.drop_duplicates(["doc_id", "doc_tokens"]).doc_tokens.sum() + got[(got.doc_id == 2)].doc_tokens.sum() / 2
    assert packing.pack(nothing, token_path()).count() == 0


def test_gif(docs, nothing, rows, spark):
    found = gif.digests(gif.store(docs)).collect()
    texts = sorted((i, (t or "").encode()) for i, t, *_ in rows)
    for r, (i, body) in zip(sorted(found, key=lambda r: (r.doc_id, r.n_bytes)), texts, strict=True):
        payload = body + b"\0" * (-len(body) % 64 if body else 64)
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_sha256 == hashlib.sha256(gif.encode(payload)).hexdigest() and sum(c.pixels for c in r.frames[0].colours) == 64 * min(1024, len(payload) // 64)
    assert len({r.feature for r in found}) > 10 and gif.digests(gif.store(nothing)).count() == 0
    # a GIF from elsewhere: red, then green at the left with a hole through which what the first left is seen
    codes = [gif.pack(np.array([4, *x, 5]), np.array([3] * 4)) for x in ((1, 1), (2, 0))]
    for disposal, second in ((1, {48: 1, 12: 1}), (2, {12: 1}), (3, {12: 1})):
        media = b"GIF89a" + bytes([2, 0, 1, 0, 0x81, 0, 0, 0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0, 255])
        for data, bits in ((codes[0], disposal << 2), (codes[1], 1 << 2 | 1)):
            media += b"\x21\xf9\x04" + bytes([bits, 5, 0, 0, 0]) + b"\x2c" + bytes([0, 0, 0, 0, 2, 0, 1, 0, 0]) + b"\x02" + bytes([len(data)]) + data + b"\0"
        got = gif.digests(spark.createDataFrame([(1, 0, media + b"\x3b"), (2, 0, None)], "doc_id long, n_bytes long, media binary")).collect()
        assert [(f.at_ms, f.disposal, {c.colour: c.pixels for c in f.colours}) for f in got[0].frames] == [(0, disposal, {48: 2}), (50, 1, second)] and got[0].payload_bytes == 4 and got[1].frames is None


def test_line_dedup(spark, nothing):
    made = [(i, f"menu\nown {i}\n\nmenu" if i != 3 else None, "h", i) for i in range(6)] + [(9, "menu\nx", None, 1), (10, "solo", "g", 2)]
    got = linededup.drop_boilerplate(spark.createDataFrame(made, "doc_id long, text string, source string, __host long"), ratio=0.5, min_pages=3, counts=True).collect()
    by = {r.doc_id: r for r in got}
    assert by[0].text == "own 0\n" and by[0].n_dropped == 2 and by[3].text is None and by[9].text == "menu\nx" and by[0]["__host"] == 0 and len(got) == 8
    wide = linededup.drop_boilerplate(spark.createDataFrame(made, "doc_id long, text string, source string, __host long"), ratio=0.5, min_pages=3, counts=True, broadcast_values=0)
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(map(tuple, got), key=str)
    assert linededup.drop_boilerplate(nothing).count() == 0


def test_language(docs, nothing, spark):
    model = langid.fit(docs)
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert got[24].lang_pred == got[28].lang_pred == "und" and got[24].score == 0 and got[0].lang_pred in ("en", "fr")
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(nothing)).collect()} == {"und"} and langid.predict(nothing, model).count() == 0
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and not {24, 25, 28} & {r.doc_id for r in kept.collect()}


def test_classifiers(spark, nothing):
    rng = random.Random(6)
    made = [(i, words(rng, 40) + (" nasty slur " if i % 3 == 0 else " ") + words(rng, 40) + ("\n%%% ### @@@" * 4 if i % 2 else ""), int(i % 3 == 0), int(i % 2 == 0)) for i in range(300)] + [(900, None, None, None), (901, "", None, None)]
    data = spark.createDataFrame(made, "doc_id long, text string, toxic int, quality int")
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        fit = (lambda d: toxicity.fit(d, d)) if module is toxicity else (lambda d: quality.fit(d))
        model = fit(data)
        got = {r.doc_id: r for r in module.predict(data, model).collect()}
        right = sum((got[i].score >= 0.5) == bool(t if label == "toxic" else q) for i, _, t, q in made[:300])
        assert right > 280 and 0 <= got[900].score == got[901].score <= 1
        none = fit(nothing.withColumn(label, F.lit(None).cast("int")))
        assert {r.score for r in module.predict(data, none).collect()} == {0.5}


def test_decontamination(docs, rows, spark, nothing):
    bench = spark.createDataFrame([(1, rows[5][1]), (2, None), (3, "tiny")], "item_id long, text string")
    assert {(r.doc_id, r.item_id, r.edits) for r in decontam.find_leaks(docs, bench).collect()} == {(5, 1, 0)}
    assert decontam.find_leaks(docs, bench, block_mb=0.0001).count() == 1 and decontam.drop_leaks(docs, bench, block_mb=0.0001).count() == docs.count() - 1
    small = bench.selectExpr("CAST(item_id AS INT) AS item_id", "text").unionByName(bench.selectExpr("CAST(NULL AS INT) AS item_id", "text"))
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, small).collect()} == {(5, 1), (5, None)}
    named = docs.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text").union(spark.createDataFrame([(None, rows[5][1])], "doc_id string, text string"))
    assert {r.doc_id for r in decontam.find_leaks(named, bench).collect()} == {"5", None}
    kept = decontam.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 1 and decontam.find_leaks(nothing, bench).count() == 0


def test_toxicity_counts_all_predecessors(spark):
    """A word behind 700 different words counts 700 times, pairs met again in other texts once."""
    made = [(i, f"p{i} common p{i} Common x{i % 7} rare") for i in range(700)] + [(-1, "rare"), (-2, None), (-3, "")]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    want = collections.defaultdict(set)
    for _, t in made:
        before = None
        for w in (t or "").lower().split():
            want[w].add(before)
            before = w
    hashed = {w: int(toxicity.words(pa.array([w]))[0][0]) for w in want}
    for asked in (["common", "rare", "p5", "x3"], sorted(want)):
        vocabulary = np.array(sorted([0] * (len(asked) > 4) + [hashed[w] for w in asked]), np.uint64)
        met, total = toxicity.corpus_counts(docs, vocabulary)
        assert {w: met[np.searchsorted(vocabulary, np.uint64(hashed[w]))] for w in asked} == {w: len(want[w]) for w in asked}
        assert total == sum(map(len, want.values()))
    assert len(want["common"]) == 700 and len(want["rare"]) == 8
    assert [x.tolist() for x in toxicity.corpus_counts(docs, vocabulary[:0])[:1]] == [[]]


CLASHES = ["__rows", "__place", "_", "__", "node", "token", "label", "n", "key", "seg", "copy", "at", "hash", "spans", "runs", "host", "line", "lines", "pages", "held", "n_lines", "n_dropped", "media", "frames", "__line_dedup_host", "y", "bucket", "salt", "item_id", "edits"]


def test_clashing_columns_and_ids(spark, rows):
    """Columns that are called as an operator's own pass through or are not looked at; ids may be null, strings or ints."""
    bench = spark.createDataFrame([(1, rows[5][1])], "item_id long, text string")
    for kind in ("int", "string"):
        base = spark.createDataFrame([(None if i in (3, 5) else i, t, l, s) for i, t, l, s, _ in rows], "doc_id long, text string, lang string, source string").withColumn("doc_id", F.col("doc_id").cast(kind))
        wide = base.select("*", *[F.lit(7).alias(c) for c in CLASHES])
        model = langid.fit(wide)
        made = {
            "repeats": lambda d: repeats.remove_repeats(d),
            "leaks": lambda d: decontam.find_leaks(d, bench),
            "clean": lambda d: decontam.drop_leaks(d, bench),
            "spans": lambda d: spandedup.remove_repeats(d),
            "gif": lambda d: gif.digests(gif.store(d)),
            "language": lambda d: langid.keep_identified(d, model),
            "near": lambda d: jaccard.near_duplicates(d),
            "first": lambda d: jaccard.keep_first(d),
            "lines": lambda d: linededup.drop_boilerplate(d, min_pages=2),
        }
        for name, run in made.items():
            if kind == "int" and name in ("near", "first", "language", "lines"):
                continue  # these take long, and look at ids in one way only
            got, plain = run(wide), run(base)
            if name in ("clean", "first", "lines", "language"):
                assert got.columns == wide.columns
            assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, plain.collect())), (kind, name)
        counted = linededup.drop_boilerplate(wide, min_pages=2, counts=True)
        assert len(set(counted.columns)) == len(counted.columns) and counted.where("n_lines = 7").count() < counted.count()
    assert linededup.drop_boilerplate(wide).count() == len(rows)


def test_many_languages(spark, monkeypatch):
    """More languages than the table has room for at full width."""
    monkeypatch.setattr(langid, "TABLE_CELLS", langid.BUCKETS * 8)
    made = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" * 3 for _ in range(9)), f"l{i % 60:02}") for i in range(240)]
    data = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = langid.fit(data)
    assert len(model.languages) == 60 and len(model.table) == langid.BUCKETS // 8 and langid.predict(data, model).count() == 240
