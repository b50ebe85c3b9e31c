from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.split import boundaries, split_oversized

TEXT = st.lists(st.sampled_from(["word ", "a", "Sentence ends. ", "Next! ", "\n\n", "\n", " ", "longerword" * 4, "é漢 ", "."]), max_size=120).map("".join)


def check(text, limit, overlap):
    got = boundaries(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for k, (a, b) in enumerate(got):
        assert b - a <= limit and (b > a or not text)
        if k:
            before = got[k - 1]
            assert a == before[1] - overlap and before[1] - before[0] >= overlap and b > before[1]
    return got


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(20, 80), st.integers(0, 15))
def test_pieces_cover_the_text(text, limit, overlap):
    check(text, limit, overlap)


def test_cuts_lie_at_the_strongest_ends_that_fit():
    text = "One two three. Four five six.\n\nSeven eight nine. Ten eleven twelve."
    assert [text[b - 1] for _, b in check(text, 45, 5)] == [".", "."]
    assert check(text, 45, 5)[0][1] == text.index("\n\n")
    words = "alpha beta gamma delta " * 20
    assert all(b == len(words) or words[b] == " " for _, b in check(words, 50, 6))
    assert check("x" * 100, 40, 10) == [(0, 30), (20, 60), (50, 90), (80, 100)]


def test_operator(spark):
    rows = [(1, "a b " * 500, 7), (2, None, 7), (3, "", 7), (4, "short", 7), (1, "a b " * 500, 7)]
    df = spark.createDataFrame(rows, "id int, text string, piece int")
    got = split_oversized(df).collect()
    assert sorted((r["id"], r["n_pieces"]) for r in got if r["piece_idx"] == 0) == [(1, 2), (1, 2), (3, 1), (4, 1)]
    for r in got:
        assert r["piece"] == dict((x[0], x[1]) for x in rows)[r["id"]][r["start"] : r["end"]]
    assert split_oversized(df.limit(0)).count() == 0
