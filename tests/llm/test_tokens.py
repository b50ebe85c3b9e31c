import random

import pytest

from corpusloom.llm import bpe, packing

ODD = ["", " ", "  ", "a   b", "a \n b", "\n \n b", "x\x1c y", "x \x1c y\x1c  z", "a\x85 b \x85 c", "<|endoftext|> hi", " 'tis 's it's I'll", "a" * 3000, "\0 a\0", "a　 b", "ab    c\t d", "漢字かな 😀👍🏽 é", "12345 6.78e9", "퟿", "don't", "Áb"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary_path(), bpe.pattern())


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_same_ids_as_the_library(encoder, library):
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab  \n\té'1.漢\xa0") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    assert [encoder.encode(t) for t in texts] == library(texts)
    assert [encoder.count(t) for t in texts] == [len(x) for x in library(texts)]


def test_rank_queue():
    q, rng = bpe.RankQueue(50_000), random.Random(1)
    pushed = [(rng.randrange(50_000), i) for i in range(2_000)]
    for rank, i in pushed:
        q.push(rank, i)
    out = []
    while (least := q.pop()) is not None:
        out += [(least[0], i) for i in least[1]]
    assert out == sorted(pushed)


def test_encode_operator(spark, data, library):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "some text", "x"), (3, "some text", "x")], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(df).collect()}
    assert got == {1: [], 2: [], 3: library(["some text"])[0]}
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    rows = {r["doc_id"]: list(r["ids"]) for r in bpe.encode(docs).collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    assert [rows[i] for i, _ in texts] == library([t for _, t in texts])
    assert bpe.encode(df.limit(0)).count() == 0


def test_first_fit_decreasing_agrees_with_a_plain_scan():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(0, 40))]
        room, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
            if k == len(room):
                room.append(20)
            room[k] -= sizes[i]
            want[i] = k
        assert packing.first_fit_decreasing(sizes, 20) == want
    with pytest.raises(ValueError):
        packing.first_fit_decreasing([21], 20)


def test_pack(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, None, rng.randint(1, 2048), rng.randint(1, 2048), 5000])) for i in range(400)] + [(7, 9), (7, 9)]
    df = spark.createDataFrame(rows, "doc_id int, n_tokens bigint")
    got = packing.pack(df, group_size=100).collect()
    full, parts = {}, {}
    for r in got:
        assert 0 <= r["size"] <= 2048 and r["offset"] == 2048 * r["part"] and (r["container"] is None) == (r["size"] == 0)
        if r["size"]:
            full[r["container"]] = full.get(r["container"], 0) + r["size"]
        parts.setdefault(r["doc_id"], []).append(r["size"])
    assert max(full.values()) <= 2048
    total = sum(n or 0 for _, n in rows)
    assert sum(full.values()) == total and len(full) <= total / 2048 * 1.15 + 5
    assert all(sorted(v) == sorted([2048, 2048, 904]) for i, v in parts.items() if dict(rows)[i] == 5000)
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_doesnt_depend_on_how_rows_lie(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(1, 3000)) for i in range(300)] + [(None, 700)] * 150 + [(7, 9)] * 20
    runs = []
    for n in (1, 7):
        rng.shuffle(rows)
        got = packing.pack(spark.createDataFrame(rows, "doc_id int, n_tokens bigint").repartition(n), group_size=60).collect()
        runs.append(sorted((tuple(r) for r in got), key=repr))
    assert runs[0] == runs[1] and len({r[4] % 8 for r in runs[0] if r[0] is None}) > 4  # an id of many rows is dealt out
