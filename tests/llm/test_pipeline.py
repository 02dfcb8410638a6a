"""The pipeline on a small table, held against a brute-force version of its stages."""

import random

import pytest

from kerfline.llm.queries import token_path

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def words(rng, n, letters):
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(12)) for _ in range(n)]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rng, path = random.Random(3), tmp_path_factory.mktemp("sf")
    body = {i: "\n".join(words(rng, 6, "abcdefg" if i % 2 else "mnopqrs")) for i in range(60)}
    body[60] = body[4][:-4] + " end"  # a near copy
    body[61] = body[7]  # an exact copy
    item = " ".join(words(rng, 2, "abcdefg"))
    body[62] = f"{body[62 % 5]}\n{item}\n" + "\n".join(words(rng, 8, "abcdefg"))  # a benchmark passage
    rows = [(i, f"home page menu\n{t}", "aa" if i % 2 else "bb", "site") for i, t in body.items()]
    rows += [(70, "12 34 !!", "aa", "site"), (71, None, "aa", "site"), (72, "", "bb", None)]
    documents = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), body


def shingles(text):
    w = text.split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_stages(spark, made):
    path, body = made
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == columns
    # documents without letters go, the shared line goes, later copies go, the benchmark passage goes
    sets, gone = {i: shingles(t) for i, t in body.items()}, {62}
    for a in body:
        gone |= {b for b in body if b > a and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {60, 61} <= gone
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_path())
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in body.items() if i not in gone}
    got = corpus_pipeline.run(spark, path).toPandas()
    assert got.groupby("doc_id")["length"].sum().to_dict() == want
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048


def test_nothing(spark, made, tmp_path):
    path, _ = made
    spark.read.parquet(f"{path}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
