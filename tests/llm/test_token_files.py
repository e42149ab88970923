import random
import uuid
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from basketlens.llm import token_files as m  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "á b  ́c \x1c x\x85y　z  q", "<|endoftext|>hi <|startoftext|> don't I'LL ΣΑΣ", "x" * 3000 + " " + "é" * 500,
         "\tA\nB\rC\x0bD\x0cE 😀😀 a😀b", "Abc, DEF. é, è. Ünï, İx, ʼn, ǆ. it's, x,. ab... 5, a5. 中文, ﬁ. Å, <|ENDOFTEXT|>, <|endoftext|>."]


@pytest.fixture(scope="module")
def whole():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture
def written(spark, tmp_path):
    rows = [(10 * k, t, "clash") for k, t in enumerate(TEXTS)] + [(None, "no id", "x"), (20, "same id", "x")] + [(7, "again", "x")] * 3
    path = str(tmp_path / uuid.uuid4().hex)
    m.write_tokens(spark.createDataFrame(rows, "doc_id LONG, text STRING, part STRING").repartition(5), path, PATH, 2)
    return rows, path


def test_round_trip_in_order(spark, written, whole):
    rows, path = written
    got = sorted((r["start"], r["doc_id"], list(r["ids"])) for r in m.read_tokens(spark, path).collect() if r["doc_id"] is not None)
    first = next(r for r in m.read_tokens(spark, path).collect() if r["doc_id"] is None)
    assert first["start"] == 0 and list(first["ids"]) == whole("no id")
    place = first["n_tokens"]
    for start, _, ids in got:
        assert start == place
        place += len(ids)
    assert [i for _, i, _ in got] == sorted(i for i, *_ in rows if i is not None)
    assert sorted((i, ids) for _, i, ids in got) == sorted((i, whole(t)) for i, t, _ in rows if i is not None)


def test_selective_reads(spark, written):
    rows, path = written
    some = m.read_tokens(spark, path, first=20, last=30)
    assert sorted(r["doc_id"] for r in some.collect()) == [20, 20, 30]
    plan = some._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,20)" in plan.replace("isnotnull", "IsNotNull")
    index = m.read_index(spark, path)
    assert "ids:" not in index._jdf.queryExecution().executedPlan().toString() and index.count() == len(rows)
    everything = {(r["doc_id"], r["start"]) for r in m.read_tokens(spark, path).collect()}
    assert {(r["doc_id"], r["start"]) for r in some.collect()} <= everything


def test_file_format(written):
    import glob
    encodings = set()
    for file in glob.glob(f"{written[1]}/part-*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        for k in range(group.num_columns):
            column = group.column(k)
            encodings.add((column.path_in_schema.split(".")[0], "RLE_DICTIONARY" in column.encodings, "DELTA_BINARY_PACKED" in column.encodings))
            assert column.has_offset_index
    assert ("ids", True, False) in encodings and ("local_start", False, True) in encodings


def test_checksums_and_empty_table(spark, written, whole, tmp_path):
    got = m.read_tokens(spark, written[1]).mapInArrow(
        m._checksums, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT").where("doc_id = 60").first()
    assert got["ids_crc32"] == zlib.crc32(np.array(whole(TEXTS[6]), "<u4").tobytes())
    path = str(tmp_path / "none")
    m.write_tokens(spark.createDataFrame([], "doc_id LONG, text STRING"), path, PATH, 2)
    assert m.read_tokens(spark, path).count() == 0


def morse(n, swap):
    return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(n))


def test_chunks_are_told_apart_by_their_bytes(spark, tmp_path, whole):
    """Complementary Thue-Morse words, whose sums modulo 2**64 are equal: alone, in texts, and with marks."""
    texts = []
    for n in (1024, 2048, 4096):
        a, b = morse(n, 0), morse(n, 1)
        texts += [a, b, f"{b} some {a} words {b}, {a}. {b}", f"é{a} é{b}"]
    path = str(tmp_path / "morse")
    m.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING").repartition(1), path, PATH, 2)
    got = {r["doc_id"]: list(r["ids"]) for r in m.read_tokens(spark, path).collect()}
    assert got == {i: whole(t) for i, t in enumerate(texts)}


def test_letters_through_the_model(whole):
    chunks = m._Chunks(open(PATH, encoding="utf-8").read(), 2)
    letters = [chr(c) for c in chunks.letters]
    assert {"a", "Z", "é", "Ж", "ß", "Σ"} <= set(letters)
    draw = random.Random(1)
    words = ["".join(draw.choice(letters) for _ in range(draw.randrange(1, 12))) + draw.choice(["", ",", ".", "!", "1"])
             for _ in range(4000)] + ["ΑΣ", "ΣΑΣ.", "İİ", "ŉa", "ǆ,", "don't", "l'eau", "x's"]
    data = " ".join(words).encode()
    ids, bounds = chunks.encode(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert ids.tolist() == whole(" ".join(words)) and bounds.tolist() == [0, len(ids)]
