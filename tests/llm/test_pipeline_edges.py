"""Each stage of the pipeline on nulls, empty and long texts, repeated rows, clashing names and an empty table."""

import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    rng, path = random.Random(9), tmp_path_factory.mktemp("edges")
    prose = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(n))
    texts = {i: prose("abcdefg" if i % 2 else "mnopqrs", 40) for i in range(40)}
    texts[50], texts[51], texts[52] = None, "", "   \n"
    texts[53] = prose("abcdefg", 60_000)  # longer than a block
    texts[54] = texts[3]
    rows = [(i, t, "aa" if i % 2 else "bb", None if i % 5 == 0 else "site", len(t or ""), "x", 1.5) for i, t in texts.items()]
    rows += [rows[6], (None, texts[8] + " tail", "bb", "site", 9, "x", 1.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, bucket string, score double")
    spark.createDataFrame([(1, prose("tuvwxyz", 20)), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, str(path), texts


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, edges, name):
    docs, path, texts = edges
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, path)
    rows = got.collect()
    ids = sorted((r.doc_id for r in rows), key=lambda i: (i is None, i))
    every = sorted([*texts, 6, None], key=lambda i: (i is None, i))
    if name == "packing":
        assert set(ids) == set(every) and sum(r.start == 0 for r in rows) == len(every)
        assert {r.length for r in rows if r.doc_id in (50, 51, 52)} == {1}
    else:
        assert got.columns == docs.columns
        want = {"language_id": [i for i in every if i not in (50, 51, 52)], "near_duplicates": [i for i in dict.fromkeys(every) if i != 54]}.get(name, every)
        assert ids == want
        if name != "line_dedup":
            assert all(r.text == texts[r.doc_id] for r in rows if r.doc_id is not None)
    assert stage(spark, docs.limit(0), path).count() == 0
