import random

from pyspark.sql import functions as F

from corpusloom.functions import fuzzy, paths, text


def run(spark, kind, rows, *cols):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_nonws_and_letters(spark):
    rows = ["a b\x1c c\n", "", None, "Ёж 12 é", "   "]
    got = run(spark, "string", rows, text.nonws_len("x"), text.letter_count("x"), text.foreign_letter_count("x"))
    assert got == [(3, 3, 0), (0, 0, 0), (None, None, None), (5, 3, 3), (0, 0, 0)]


def python_garbled(t):
    body = [c for c in t if not c.isspace()]
    if not body:
        return False
    n = len(body)
    if sum(c.isalpha() and ord(c) > 127 for c in body) / n >= 0.15:
        return False
    if sum(c.isalpha() for c in body) / n < 0.4:
        return True
    inner = sum(t[i].isdigit() and t[i - 1].isalpha() and t[i + 1].isalpha() for i in range(1, len(t) - 1))
    return inner / n > 0.005


def test_garbled_agrees_with_a_plain_restatement(spark):
    rng = random.Random(5)
    rows = ["".join(rng.choice("aZ é1 я.\n9") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    rows += ["a1b2c", "1" * 60, "a" * 199 + "1", "a" * 99 + "1a" + "a" * 99, "H3yqaJIHCb pa6oTa " * 5, " "]
    assert [g[0] for g in run(spark, "string", rows, text.looks_garbled("x"))] == [python_garbled(r) for r in rows]
    assert [g[0] for g in run(spark, "string", [None, "", "a" * 49, "a" * 50], text.needs_ocr("x"))] == [True, True, True, False]


def test_parse_filename(spark):
    cases = {
        "Denis_J_1964a": ("Denis_J", "1964a", ""), "A__B_1955c_T_2012_U": ("A__B", "1955c", "T 2012 U"), "1980_x": ("", "1980", "x"), "_1980_x": ("", "1980", "x"),
        "A_1980__x_": ("A", "1980", "x"), "A_19800_x": ("A", "19800", "x"), "A_1980B_x": ("A", "1980B", "x"), "A_B_c_d_1": ("A", "B", "c d 1"), "Author": ("Author", "", ""), "": ("", "", ""),
    }
    got = run(spark, "string", list(cases), text.parse_filename("x"))
    assert [tuple(g[0]) for g in got] == list(cases.values())
    assert run(spark, "string", [None], text.parse_filename("x")) == [(None,)]


def test_slugs(spark):
    rows = ["Fig. 1. Spider", "***", " a  b ", "x" * 60, "a-_", None, ""]
    assert [g[0] for g in run(spark, "string", rows, text.make_slug("x"))] == ["Fig_1_Spider", "***", "a_b", "x" * 50, "a", None, ""]
    assert [g[0] for g in run(spark, "string", ["", None, "Tab 1"], text.slug_or("x", "table", F.lit(3)))] == ["table_3", "table_3", "Tab_1"]


def test_names(spark):
    assert run(spark, "string", ["A\tb, c d"], text.base_name("x", F.lit("1999a"), F.lit(None))) == [("Ab_c_d_1999a_",)]
    rng = random.Random(1)
    rows = ["".join(rng.choice("aéЖ漢😀") for _ in range(rng.randint(0, 30))) for _ in range(100)]
    got = [g[0] for g in run(spark, "string", rows, text.truncate_utf8("x", 20))]
    assert got == [r.encode()[:20].decode(errors="ignore") for r in rows]
    assert run(spark, "string", ["a" * 300, "b"], text.file_name("x")) == [("a" * 245 + ".pdf",), ("b.pdf",)]


def test_html(spark):
    html = '<a href="/a.pdf">x</a><a href="b">y</a><a href="/a.pdf">z</a><td>Author:</td> <td> <b>N. N.</b> </td>'
    got = run(spark, "string", [html, ""], text.hrefs("x"), text.labelled_cell("x", "Author"), text.url_join(F.lit("http://h/"), F.lit("/p")))
    assert got == [(["/a.pdf", "b"], "N. N.", "http://h/p"), ([], None, "http://h/p")]


def test_paths(spark):
    rows = ["r/S a/x_10.pdf", "x_02", "r/A_1964.pdf", "r/n.tar.gz", ".hidden"]
    got = run(spark, "string", rows, paths.species("x"), paths.stem("x"), paths.numeric_suffix("x").cast("int"))
    assert got == [("S a", "x_10", 10), ("", "x_02", 2), ("r", "A_1964", 1964), ("r", "n.tar", None), ("", ".hidden", None)]
    assert run(spark, "string", ["in/a/b", "other/c"], paths.reroot("x", "in", "out"), paths.windows("x")) == [("out/a/b", "in\\a\\b"), (None, "other\\c")]


def test_relative_paths_agree_with_the_standard_library(spark):
    import posixpath

    rng = random.Random(3)
    part = lambda: "/".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    pairs = [(part(), part()) for _ in range(200)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, t string, s string")
    got = [r[1] for r in df.select("i", paths.relative("t", "s")).orderBy("i").collect()]
    assert got == [posixpath.relpath(a, b) for a, b in pairs]


def plain_ratio(a, b):
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0

    def common(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            old = row
            row = [0]
            for j, e in enumerate(y):
                row.append(old[j] + 1 if c == e else max(old[j + 1], row[j]))
        return row[-1]

    def best(s, w):
        m = len(s)
        windows = {w[max(0, e - m) : e] for e in range(1, len(w) + m) if w[max(0, e - m) : e]}
        return max(200.0 * common(s, x) / (m + len(x)) for x in windows)

    return max(best(short, long), best(long, short)) if len(a) == len(b) else best(short, long)


def test_partial_ratio_agrees_with_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, n))) for n in (6, 14))
        want = plain_ratio(a, b)
        assert abs(fuzzy.partial_ratio(a, b) - want) < 1e-9, (a, b)
        assert abs(fuzzy.partial_ratio(a, b, 85) - (want if want >= 85 else 0)) < 1e-9, (a, b)
    assert fuzzy.partial_ratio(None, "a") is None and fuzzy.partial_ratio("bc", "abcd") == 100.0
