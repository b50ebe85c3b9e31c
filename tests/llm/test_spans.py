import random

from corpusloom.llm import copies, spans


def brute(docs, span):
    have = {}
    for i, t in docs:
        if t:
            for k in range(len(t) - span + 1):
                have.setdefault(t[k : k + span], set()).add(i)
    return sorted({(a, b) for s in have.values() for a in s for b in s if a < b})


def made(rng, n=60):
    pool = ["".join(rng.choice("abcdé 漢") for _ in range(rng.randint(20, 60))) for _ in range(12)]
    docs = [(i, "".join(rng.choice(pool) if rng.random() < 0.4 else "".join(rng.choice("abcdé 漢") for _ in range(15)) for _ in range(rng.randint(0, 6)))) for i in range(n)]
    return [*docs, (n, None), (n + 1, ""), (n + 2, docs[0][1]), (n + 3, docs[0][1]), (n + 4, "a" * 200), (n + 5, "b" + "a" * 90), (n + 6, "xy" * 70), (n + 7, "y" + "xy" * 30)]


def test_pairs_agree_with_brute_force(spark):
    for seed in range(3):
        docs = made(random.Random(seed))
        df = spark.createDataFrame([(*d, "extra") for d in docs], "doc_id bigint, text string, cls string")
        got = sorted((r["doc_a"], r["doc_b"]) for r in spans.shared_pairs(df, span=40, unit=16).collect())
        assert got == brute(docs, 40)


def test_hot_units_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spans, "HOT", 3)
    rng = random.Random(4)
    short, long = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (30, 45))
    fill = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 50)))
    docs = [(i, fill() + (short if i % 3 else long) + fill()) for i in range(60)] + [(60, "z" + short + "abcdefgha"), (61, "z" + short + "abcdefgha" + "b")]
    docs += made(rng, 20)[:0]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted((r["doc_a"], r["doc_b"]) for r in spans.shared_pairs(df, span=40, unit=16).collect())
    assert got == brute(docs, 40) and len(got) == 191


def test_share_agrees_with_brute_force(spark):
    docs = made(random.Random(9))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r["doc_id"]: r["shared_chars"] for r in spans.shared_share(df, span=40, unit=16).collect()}
    for i, t in docs:
        own = set()
        others = [x for j, x in docs if j != i and x]
        for k in range(len(t or "") - 39):
            if any(t[k : k + 40] in x for x in others):
                own.update(range(k, k + 40))
        assert got[i] == len(own), i


def test_repeated_lines(spark):
    line = "A line that is long enough to count for something here"
    df = spark.createDataFrame([(1, f"x\n{line}\n{line.upper()}"), (0, f"  {line}"), (2, None), (3, ""), (0, f"  {line}")], "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["line_no"], r["start"], r["keep"]) for r in spans.repeated_lines(df).collect())
    assert got == [(0, 0, 0, True), (1, 1, 2, False), (1, 2, 3 + len(line), False)]
    assert spans.repeated_lines(df.limit(0)).count() == 0 and spans.shared_pairs(df.limit(0)).count() == 0


def test_many_copies_are_given_by_membership(spark):
    members = spark.createDataFrame([(0, i, 1) for i in range(6)] + [(0, 10, 2), (0, 11, 2)], "field int, id int, cls bigint")
    alike = spark.createDataFrame([(1, 2)], "cls_a bigint, cls_b bigint")
    got = sorted((r[1], r[2]) for r in copies.expand(members, alike, most=5).collect())
    assert got == [(0, 1), (0, 2), (0, 3), (0, 4), (0, 5), (0, 10), (0, 11), (10, 11)]
    assert copies.expand(members, alike).count() == 15 + 1 + 12


def test_runs_of_lines_and_windows_find_every_span(spark):
    """Texts of short, long and empty lines that share stretches beginning anywhere."""
    for seed in range(3):
        rng = random.Random(seed)
        line = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 3, 9, 9, 14, 70])))
        pool = ["\n".join(line() for _ in range(8)) for _ in range(6)]
        docs = []
        for i in range(50):
            cut = rng.choice(pool)
            a = rng.randrange(len(cut))
            docs.append((i, line() + "\n" * rng.randint(0, 2) + cut[a : a + rng.randint(20, 90)] + rng.choice(["", "\n"]) + line()))
        df = spark.createDataFrame(docs, "doc_id bigint, text string")
        got = sorted((r["doc_a"], r["doc_b"]) for r in spans.shared_pairs(df, span=40, unit=16).collect())
        assert got == brute(docs, 40) and got
        assert any(len(spans.line_runs(spans._codes(t), 40, 16)[0]) for _, t in docs)


def test_a_span_in_very_many_texts_is_marked_without_pairs(spark):
    rng = random.Random(3)
    licence = "".join(rng.choice("abcdefgh ") for _ in range(250))
    rows = [(i, f"{i:06}" + "".join(rng.choice("abcdefgh ") for _ in range(20)) + licence + f"{i:06}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = spans.shared_share(df).groupBy("shared_chars").count().collect()
    assert sum(r["count"] for r in got) == 20_000 and all(250 <= r["shared_chars"] < 268 for r in got)  # a few characters on either side are alike by chance


def test_left_over(spark):
    line = "A line that is long enough to count for something here"
    rows = [(0, f"{line}\nx"), (1, f"x\n{line.upper()}\ny\n{line}"), (2, None), (3, ""), (4, line), (1, f"x\n{line.upper()}\ny\n{line}"), (5, "one")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, text string, v int")
    got = {r["doc_id"]: (r["n_removed"], r["removed_chars"], [tuple(p) for p in r["pieces"]]) for r in spans.left_over(df).collect()}
    assert got == {0: (0, 0, [(0, len(rows[0][1]), rows[0][1])]), 1: (2, 2 * len(line), [(0, 2, "x\n"), (3 + len(line), 5 + len(line), "y\n")]), 2: (0, 0, []), 3: (0, 0, []), 4: (1, len(line), []), 5: (0, 0, [(0, 3, "one")])}
    assert spans.left_over(df).count() == 7 and spans.left_over(df.limit(0)).count() == 0
