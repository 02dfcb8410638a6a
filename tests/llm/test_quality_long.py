"""Texts of very many lines are scored as others are; models keep to their bounds; small hosts lose what all pages hold."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from kerfline.llm import gif, linededup, quality


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    return quality.QualityModel(rng.normal(0, 0.5, quality.FEATURES + 1), rng.normal(0, 1, (2, 2)), (0.1, 2.0, 0.3), 0.5)


def made(rng, n):
    return "\n".join(rng.choice(["", "home", "a b c", f"{rng.random()} Word! word word", "x" * rng.randint(0, 90), "é中 ok"]) for _ in range(n))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 57, 300])
def test_in_steps_as_at_once(model, n):
    rng = random.Random(n)
    text = made(rng, n)
    good, size, _ = model.lines(pa.array([text]))
    for at_once in (1, 2, 4, 50):
        x, sizes = (np.concatenate(p) for p in zip(*quality.long_features(text.encode(), at_once)))
        whole = quality.line_features(pa.array([text]))
        assert np.array_equal(sizes, whole[1]) and np.allclose(x, whole[0])
    assert np.allclose(quality.long_chain(whole[0] @ model.weights[:-1] + model.weights[-1], model.move), good)
    assert np.allclose(model.long_evidence(text.encode()), [v[0] for v in model.evidence(pa.array([text]))])


def test_a_text_of_half_a_million_lines(model):
    text = made(random.Random(0), 500_000)
    began = time.time()
    assert 0 <= model.score(pa.array([text]))[0] <= 1 and time.time() - began < 60


def test_predict_edges(spark, model):
    rows = [(1, None, "p"), (None, "", "p"), (2, "one\ntwo", "p"), (2, "one\ntwo", "p"), (3, "z\n" * 30_000, "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string")
    got = quality.predict(docs, model).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 2, 3] and all(0 <= r.score <= 1 for r in got)
    assert got[2].score == got[3].score and got[0].score == got[1].score
    assert quality.predict(docs.limit(0), model).count() == 0
    named = docs.selectExpr("concat('d', coalesce(doc_id, 0)) AS name", "text AS body")
    assert dict(quality.predict(named, model, text="body", doc_id="name").dtypes)["doc_id"] == "string"


def test_fit_stays_in_its_bounds(spark):
    rng = random.Random(3)
    rows = [(k, ("good words of prose, and more of them. " * 3 + "\n") * rng.randint(1, 6) if k % 2 else "x9$ q\n" * rng.randint(1, 40), k % 2) for k in range(400)] + [(1000, "y\n" * 100_000, 0), (1001, None, 1), (1002, "t", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    fitted = quality.fit(table, max_rows=150, max_lines=1500)
    scored = {r.doc_id: r.predicted for r in quality.predict(table.where("doc_id < 400").select("doc_id", "text"), fitted, 0.5).collect()}
    assert sum(scored[k] == k % 2 for k in range(400)) > 380
    assert quality.fit(table.limit(0)).prior == 0.5 and quality.fit(table.where("quality = 1")).prior == 1.0


def test_small_hosts(spark):
    menu = "menu of the host"
    rows = [(h, p, f"{menu}\nown {h} {p}" + ("\npart" if p == 0 else "")) for h, n in (("one", 1), ("two", 2), ("four", 4), ("ten", 10)) for p in range(n)]
    docs = spark.createDataFrame([(f"{h}{p}", h, t) for h, p, t in rows], "doc_id string, source string, text string")
    got = {r.doc_id: r.text for r in linededup.drop_boilerplate(docs).collect()}
    assert got["one0"] == f"{menu}\nown one 0\npart" and got["two1"] == "own two 1" and got["four0"] == "own four 0\npart" and got["ten3"] == "own ten 3"


def test_a_small_file_of_a_huge_picture():
    with pytest.raises(ValueError, match="65535 by 65535 is too large"):
        next(gif.decode(b"GIF89a" + b"\xff\xff\xff\xff" + b"\0" * 30))
