import os

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as m  # noqa: E402
from basketlens.llm import minhash_dedup, registry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, row INT, digest INT"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")

ROWS = ([(1, "a b c d e f g", "en", "x", 13, 9, 0)] * 3 + [(None, None, None, None, None, 1, 0)] +
        [(None, "p q r s t u v w", "en", "y", 15, 2, 0)] * 2 + [(7, "", "en", None, 0, 3, 0), (8, "token=abcdefghijklmnop1", "en", "x", 23, 3, 0),
         (1, "another text wholly different from it", "en", "x", 37, 9, 0), (5, "A b C d e f g", "en", "z", 13, 9, 0)])


def test_every_number_has_its_query():
    names = registry.load()[0]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_stages_on_odd_rows(spark, tmp_path):
    docs, seen = spark.createDataFrame(ROWS, SCHEMA), {}
    for name, stage in m.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        if name != "pieces":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert len(seen["toxicity"]) == len(ROWS)
    texts = sorted(str(r["text"]) for r in seen["near_duplicates"])
    assert texts == sorted(["a b c d e f g", "None", "p q r s t u v w", "", "token=abcdefghijklmnop1", "another text wholly different from it"])
    assert {r["text"]: r["n_chars"] for r in seen["secrets"]}["[SECRET]"] == 8
    assert {str(r["text"]) for r in seen["source_mix"]} == {str(r["text"]) for r in seen["secrets"]}
    assert len(seen["pieces"]) == len(seen["source_mix"])


def test_stages_on_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in m.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_near_duplicates_leave_one_of_each_group(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    judged = minhash_dedup.near_duplicates(docs).toPandas()
    kept = {r["doc_id"] for r in m.drop_near_duplicates(spark, docs, FOLDER).collect()}
    assert kept == set(judged[judged.kept].doc_id)


def test_run(spark):
    found = m.run(spark, FOLDER)
    assert found.columns == ["doc_id", "n_tokens", "ids"] and found.count() > 100
