import random

import pytest
from pyspark.sql import functions as F

from storyflow.common import load
from storyflow.llm import tokens as T

from ..conftest import SF


@pytest.fixture(scope="module")
def enc(spark):
    return T.encoder(T.vocabulary_path(spark))


TEXTS = ["Hello, world's  end\n\n x", "片刻之后镜头向左摇。", "a" * 3000, " \t\n ", "é 👩‍🚀 \x00", "<|endoftext|>", "don't we'll I'M 12345 a,b", " x　y"]


def test_round_trip_and_public_vocabulary(enc):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(T.TOKENIZER_DIR + "/byte_bpe_50k.json")
    other.encode_special_tokens = True
    for t in TEXTS:
        ids = T.encode(t, enc)
        assert T.decode(ids, enc) == t.encode()
        assert ids == other.encode(t, add_special_tokens=False).ids
    assert T.encode(None, enc) == T.encode("", enc) == []
    half = T.encode("日", enc)
    assert b"".join(T.decode([i], enc) for i in half) == "日".encode()


def test_long_texts_split_safely(enc):
    random.seed(2)
    alphabet = ["a", "b ", " ", "  ", "\n", "中", "，", "é", "1", "'s", "n't", ". ", "👍", "x"]
    for _ in range(40):
        t = "".join(random.choice(alphabet) for _ in range(4000))
        parts = T.safe_parts(t, 50)
        assert "".join(parts) == t and len(parts) > 5
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)
    assert T.safe_parts("y" * 500, 50) == ["y" * 500]
    long = "some words and 中文字 here. " * 8000
    assert T.encode(long, enc) == enc.encode_ordinary(long)


def test_ids_of_a_table(spark, enc):
    docs = load(spark, SF, "documents")
    got = {r.doc_id: list(r.ids) for r in T.token_ids(docs.withColumn("ids", F.lit("clash")), T.vocabulary_path(spark)).collect()}
    assert got == {r.doc_id: (enc.encode_ordinary(r.text) if r.text else []) for r in docs.select("doc_id", "text").collect()}


def test_windows_best_fit():
    w = T.OpenWindows(10, 2)
    assert w.place(10, "full") == ["full"] and w.place(6, "a") is None and w.place(7, "b") is None
    assert w.place(3, "c") == ["b", "c"]  # the tighter window, which is full now
    assert w.place(3, "d") is None and w.place(8, "e") is None
    assert w.place(9, "f") == ["a", "d"]  # none fits and all are open: the fullest goes
    assert sorted(w.rest()) == [["e"], ["f"]] and w.rest() == []


def packed(spark, df, **k):
    return [tuple(r) for r in T.pack(df, T.vocabulary_path(spark), **k).collect()]


def test_packing(spark, enc):
    docs = load(spark, SF, "documents").select("doc_id", "text")
    sizes = {r.doc_id: len(enc.encode_ordinary(r.text)) for r in docs.collect() if r.text}
    for parts, capacity, k in ((1, 2048, 512), (7, 512, 4), (3, 64, 1)):
        rows = packed(spark, docs.repartition(parts, "doc_id"), capacity=capacity, open_windows=k, merge_fan=2)
        got, room = {}, {}
        for doc, piece, n, box in rows:
            got.setdefault(doc, []).append((piece, n))
            room[box] = room.get(box, 0) + n
        assert max(room.values()) <= capacity and {d: sum(n for _, n in p) for d, p in got.items()} == sizes
        for d, p in got.items():
            assert sorted(i for i, _ in p) == list(range(len(p))) and len(p) == -(-sizes[d] // capacity)
        if k == 512:
            assert len(room) <= -(-sum(sizes.values()) // capacity) + 1


def test_packing_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "same"), (3, "same"), (None, "same")], "doc_id long, text string").withColumn("open", F.lit("clash"))
    rows = packed(spark, df)
    assert sorted((r[0] or 0, r[1], r[2]) for r in rows) == [(0, 0, 1), (3, 0, 1), (3, 0, 1)] and len({r[3] for r in rows}) <= 2
    assert packed(spark, df.limit(0)) == []


def test_ids_of_any_type_and_many_levels(spark):
    rows = [(f"doc-{i}", "some words " * (i % 7 + 1)) for i in range(200)] + [(None, "one"), ("", "two")]
    df = spark.createDataFrame(rows, "name string, text string").repartition(16)
    got = T.pack(df, T.vocabulary_path(spark), capacity=16, open_windows=2, merge_fan=2, doc="name")
    assert dict(got.dtypes)["name"] == "string" and sorted({r.name or "-" for r in got.collect()}) == sorted({n or "-" for n, _ in rows})
