import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import copies, neardup, queries


def brute(rows, width, threshold, least):
    sets = []
    for i, t in rows:
        w = [x.lower() for x in neardup.words_of(t)]
        if len(w) >= max(1, least):
            s = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
            if s:
                sets.append((i, s))
    out = set()
    for x, (a, s) in enumerate(sets):
        for b, r in sets[x + 1 :]:
            if a != b and len(s & r) >= threshold * len(s | r) - 1e-9:
                out.add((min(a, b), max(a, b)))
    return sorted(out)


def made(rng, n, size):
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(30)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randint(0, max(1, len(words) // 6))):
                k = rng.randrange(len(words))
                words[k : k + rng.randint(0, 2)] = [rng.choice(vocabulary) for _ in range(rng.randint(0, 2))]
            rows.append((i, " ".join(words) or "one"))
        else:
            rows.append((i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, size)))))
    return rows


@pytest.mark.parametrize("frequent", [False, True])
@pytest.mark.parametrize("width,threshold,size,least", [(5, 0.5, 120, 20), (1, 0.6, 12, 0), (2, 0.8, 60, 0), (1, 0.5, 30, 0)])
def test_pairs_agree_with_brute_force(spark, monkeypatch, width, threshold, size, least, frequent):
    if frequent:  # so that sequences are listed on a small collection too
        monkeypatch.setattr(neardup, "WORD_LEAST", 2)
        monkeypatch.setattr(neardup, "SEQUENCE_LEAST", 2)
        monkeypatch.setattr(neardup, "HOT", 5)  # and so that groups are passed on
        monkeypatch.setattr(neardup, "HELD", 400)
    rng = random.Random(width * 10 + size)
    rows = made(rng, 150, size)
    rows += [(500, None), (501, ""), (502, "12 34"), (3, rows[9][1]), (503, rows[4][1].upper()), (504, rows[4][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, full_text string, cls int").repartition(2)
    got = sorted((r[0], r[1]) for r in neardup.similar_pairs(df, width=width, threshold=threshold, min_words=least).collect())
    assert got == brute(rows, width, threshold, least)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id int, full_text string")
    assert neardup.similar_pairs(df).count() == 0
    assert neardup.components(neardup.similar_pairs(df)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(55)] + [(k, k + 1) for k in range(100, 130)]
    df = spark.createDataFrame(edges, "doc_a int, doc_b int")
    got = {r["id"]: r["group_id"] for r in neardup.components(df).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}


def test_links_count_copies_in_full(spark):
    rng = random.Random(5)
    fields, want = [], {}
    for _ in range(2):
        members = {(rng.randrange(60), rng.randrange(12)) for _ in range(70)}
        alike = {tuple(sorted(rng.sample(range(12), 2))) for _ in range(5)}
        for i, c in members:
            for j, d in members:
                if i != j and (c == d or (min(c, d), max(c, d)) in alike):
                    want.setdefault(i, set()).add(j)
        fields.append((spark.createDataFrame(sorted(members), "id int, cls long"), spark.createDataFrame(sorted(alike), "cls_a long, cls_b long")))
    got = {r["id"]: r["n_links"] for r in copies.links(*fields).collect()}
    assert {i: n for i, n in got.items() if n} == {i: len(x) for i, x in want.items()}


def test_groups_of_very_many_copies(spark, tmp_path):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(120)]
    text, near = " ".join(words), " ".join([*words[:-2], "other", "words"])
    spark.createDataFrame([(f"d{k:04}", text) for k in range(1001)] + [("e", near)], "doc_id string, full_text string").write.parquet(f"{tmp_path}/full_texts.parquet")
    spark.createDataFrame([("e", "Spiders of the north"), ("f", "Spiders of the north"), ("d0000", "Spiders of the north")], "doc_id string, title string").write.parquet(f"{tmp_path}/metadata.parquet")
    got = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in queries.p4_groups(spark, str(tmp_path)).collect()}
    assert len(got) == 1003 and {g for g, _ in got.values()} == {"d0000"}
    assert got["d0000"][1] == 1002 and got["e"][1] == 1002 and got["f"][1] == 2 and {got[f"d{k:04}"][1] for k in range(1, 1001)} == {1001}


def test_one_order_in_very_long_texts():
    """The level of a sequence doesn't depend on the text it stands in, however many rare words stand before it."""
    rng = random.Random(8)
    frequent = [neardup._Hashes().of([f"w{k}"])[0].item() for k in range(300)]
    stats = neardup.Statistics({h: 1000 + k for k, h in enumerate(frequent)}, 400_000, {})
    common = [rng.choice(frequent) for _ in range(3000)]
    texts = [[rng.getrandbits(63) for _ in range(rare)] + common for rare in (0, 500, 20_000)]
    levels = []
    for words in texts:
        w = np.array(words, np.uint64)
        text, seq, place = neardup.raw(w, np.array([len(w)]), 5)
        levels.append(dict(zip(seq.tolist(), stats.levels(w, seq, place, 5).tolist())))
    shared = set(levels[0]) & set(levels[1]) & set(levels[2])
    assert len(shared) > 2900 and all(levels[0][s] == levels[1][s] == levels[2][s] for s in shared)


def test_very_long_texts_agree_with_brute_force(spark):
    rng = random.Random(12)
    base = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{''.join(rng.choice('klmnop') for _ in range(rng.randint(1, 4)))}" for _ in range(20_000)]
    rows = [(0, " ".join(base))]
    for i, step in enumerate((13, 14, 15, 16, 30, 9, 200), 1):  # around the threshold
        words = list(base)
        for k in range(i, len(words), step):
            words[k] = "zz" + "".join(rng.choice("abcdefgh") for _ in range(6))
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id int, full_text string")
    got = sorted((r[0], r[1]) for r in neardup.similar_pairs(df, width=5, threshold=0.5).collect())
    assert got == brute(rows, 5, 0.5, 0) and 0 < len(got) < 28


@pytest.mark.parametrize("listed", [True, False])
def test_an_entry_in_very_many_records(spark, monkeypatch, listed):
    """One sequence in a whole collection of short records: of the frequent class it is indexed in pairs only; else its group is passed on to a join."""
    if not listed:
        monkeypatch.setattr(neardup, "SEQUENCE_LEAST", 1 << 40)
        monkeypatch.setattr(neardup, "HOT", 20)
        monkeypatch.setattr(neardup, "HELD", 5_000)
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(7))
    rows = [(i, " ".join([*(word() for _ in range(12)), "one line that all of them have", *(word() for _ in range(12))])) for i in range(10_000 if listed else 1_500)]
    rows += [(20_000, rows[5][1] + " end"), (20_001, rows[999][1] + " end")]
    df = spark.createDataFrame(rows, "doc_id int, full_text string").repartition(8)
    got = sorted((r[0], r[1]) for r in neardup.similar_pairs(df, width=5, threshold=0.5).collect())
    assert got == [(5, 20_000), (999, 20_001)]


def test_classes_at_the_limit_of_copies(spark):
    for n in (1000, 1001):
        members = spark.createDataFrame([(0, i, 1) for i in range(n)] + [(0, 5000, 2)], "field int, id int, cls bigint")
        alike = spark.createDataFrame([(0, 1, 2)], "field int, cls_a bigint, cls_b bigint")
        assert copies.expand(members, alike, most=None).count() == n * (n - 1) // 2 + n
        assert copies.expand(members, alike).count() == (n * (n - 1) // 2 + n if n == 1000 else n)
        rows = copies.membership(members).collect()
        assert len(rows) == n + 1 and {(r["cls"], r["representative"], r["n"]) for r in rows} == {(1, 0, n), (2, 5000, 1)}
        assert [tuple(r) for r in copies.representatives(members, alike).collect()] == [(0, 0, 5000, n, 1)]


def test_a_sequence_is_frequent_by_its_count_in_large_collections_too(spark):
    """Ten places a part of 36 million sequences: by a share it would be indexed singly, and its group grow with the collection."""
    phrase = np.arange(1, 6, dtype=np.uint64)

    def make(batches):
        for batch in batches:
            for k in batch.column("id").to_pylist():
                words = np.random.default_rng(k).integers(1 << 20, 1 << 63, (40, 90_000), np.uint64)
                words[:10, 500:505] = phrase
                yield pa.RecordBatch.from_arrays([pa.array([0] * 40, pa.int8()), pa.array([w.tobytes() for w in words], pa.binary())], names=["field", "words"])

    stats = neardup.statistics(spark.range(10, numPartitions=10).mapInArrow(make, "field tinyint, words binary"), [neardup.Field()])
    sequence = neardup.raw(phrase, np.array([5]), 5, neardup._salt(0))[1]
    assert stats.listed.tolist() == sequence.tolist()
    assert stats.levels(phrase, sequence, np.array([0]), 5)[0] >= neardup._LISTED


def test_no_more_sequences_are_listed_than_are_held(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SEQUENCE_LEAST", 2)
    monkeypatch.setattr(neardup, "MOST_LISTED", 50, raising=False)
    rows = [np.arange(k, k + 40, dtype=np.uint64).tobytes() for k in range(100) for _ in range(1 + k // 10)]
    df = spark.createDataFrame([(0, bytearray(w)) for w in rows], "field tinyint, words binary").repartition(1)
    assert 0 < len(neardup.statistics(df, [neardup.Field()]).listed) <= 50
