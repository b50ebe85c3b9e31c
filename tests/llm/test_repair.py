"""Restoring of garbled text, languages and scan noise, on sentences from the reference samples."""

import random
from collections import Counter

import pytest

from corpusloom.llm import language, mojibake, scan


@pytest.fixture(scope="module")
def refs(spark, data):
    rows = spark.read.parquet(f"{data}/lang_refs.parquet").collect()
    out = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["sample"])
    return out


@pytest.fixture(scope="module")
def refs_df(spark, data):
    return spark.read.parquet(f"{data}/lang_refs.parquet")


CHAINS = [("utf-8", "cp1252"), ("utf-8", "latin_1"), ("utf-8", "cp850"), ("utf-8", "mac_roman"), ("cp1252", "mac_roman"), ("cp1252", "cp850")]


def test_garbled_held_out_sentences_are_restored(spark, data, refs):
    full = spark.read.parquet(f"{data}/full_texts.parquet")
    restorer = mojibake.Restorer(*mojibake.train(full, [s for v in refs.values() for s in v[::2]], "full_text"))
    good = bad = clean = 0
    for lang, texts in refs.items():
        text = " ".join(texts[1::2])
        clean += bool(restorer.chains(mojibake.odd_words(text)))
        for written, read in CHAINS:
            try:
                garbled = text.encode(written).decode(read)
            except UnicodeError:
                continue
            if garbled == text:
                continue
            fixed = restorer.restore(garbled)[0]
            same = sum(a == b for a, b in zip(text.split(), fixed.split())) / len(text.split())
            good, bad = good + (same > 0.97), bad + (same <= 0.97)
    assert clean == 0 and good >= 10 and bad <= 0.15 * (good + bad)


def test_restore_operator(spark, refs, refs_df):
    text = " ".join(refs["fr"])
    rows = [(1, text), (2, text.encode().decode("latin_1")), (3, None), (4, ""), (5, "plain ascii"), (6, "lost � here"), (2, text.encode().decode("latin_1"))]
    rows += [(10 + k, " ".join(refs[lang])) for k, lang in enumerate(refs)]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id int, full_text string, garbled boolean")
    got = {r["doc_id"]: (r["garbled"], r["restored"]) for r in mojibake.restore(df, refs_df).collect()}
    assert got[2] == (True, text) and got[1] == (False, text) and got[3] == (False, None) and got[4] == (False, "") and got[6][0] is True
    assert not any(v[0] for k, v in got.items() if k >= 10)
    assert mojibake.restore(df.limit(0), refs_df).count() == 0


def test_held_out_sentences_get_their_language(refs):
    parser = language.Parser({k: v[::2] for k, v in refs.items()})
    texts, want = zip(*[(s, k) for k, v in refs.items() for s in v[1::2]])
    of, _, _, lang, _ = language.segment(parser, list(texts))
    best = {int(o): parser.langs[x] for o, x in zip(of, lang)}
    right = sum(best[i] == w for i, w in enumerate(want))
    assert right / len(want) >= 0.95


def test_phrases_agree_with_a_plain_parse():
    samples = {"x": ["abcab", "bca"], "y": ["ddab"]}
    parser = language.Parser(samples)
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcd e") for _ in range(rng.randint(1, 30))) for _ in range(100)]

    def plain(text, own):
        have = [f" {s} " for s in own]
        n, i = 0, 0
        while i < len(text):
            j = i + 1
            while j < len(text) and any(text[i : j + 1] in s for s in have):
                j += 1
            n, i = n + 1, j
        return n

    import numpy as np

    starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
    counts = parser.phrases(parser.codes("".join(texts)), starts, np.array([len(t) for t in texts]))
    assert counts[0].tolist() == [plain(t, samples["x"]) for t in texts] and counts[1].tolist() == [plain(t, samples["y"]) for t in texts]


def test_segments_operator(spark, refs, refs_df):
    mixed = " ".join(refs["en"][:4]) + "\n\n" + " ".join(refs["ru"][:3])
    df = spark.createDataFrame([(1, mixed, "x"), (2, None, "x"), (3, "", "x"), (4, "   ", "x"), (5, "12 34", "x")], "doc_id int, text string, language string")
    got = [(r["doc_id"], r["language"], mixed[r["start"] : r["end"]][:5], r["confidence"]) for r in language.segments(df, refs_df).collect() if r["doc_id"] == 1]
    assert [g[1] for g in got] == ["en", "ru"] and all(0.4 < g[3] <= 1 for g in got) and got[1][2] == refs["ru"][0][:5]
    whole = language.languages_of(df.drop("language"), refs_df).filter("doc_id = 1").first()
    assert whole["language"] == "en" and whole["languages"] == ["en", "ru"]
    assert language.segments(df.limit(0), refs_df).count() == 0


def test_labels(spark, refs_df):
    rows = ["en", " EN", "eng", "en-GB", "de_AT", "rus", "nl", "", None, "und", "\tRU\n"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, l string")
    got = [r[1] for r in df.select("i", language.named(df["l"], refs_df)).orderBy("i").collect()]
    assert got == ["en", "en", "en", "en", "de", "ru", None, None, None, None, "ru"]


def wrapped(words, width=60):
    lines, line = [], ""
    for w in words:
        if len(line) + len(w) > width:
            lines.append(line.rstrip())
            line = ""
        line += w + " "
    return [*lines, line.rstrip()]


def lexicon(refs):
    counts = {}
    for v in refs.values():
        for s in v:
            for w in scan._WORD.findall(s):
                counts[w] = counts.get(w, 0) + 50
    return scan.Lexicon(counts, sum(counts.values()), frozenset({"annalsofthewebsociety"}))


def test_noise_is_found_and_taken_out(refs):
    lex = lexicon(refs)
    page = wrapped(" ".join(refs["en"][:6]).split())
    broken = [x for x in page]
    broken[2], broken[3] = broken[2] + " speci-", "mens " + broken[3]
    text = "\n".join(["[Page 1]", "Annals of the Web Society", *broken, "- 12 -", "", "[Page 2]", "ANNALS OF THE WEB SOCIETY", *page, "- 13 -"])
    fixed, evidence = lex.repair(text)
    assert evidence == 5 and "Annals" not in fixed and "12 -" not in fixed and "specimens\n" in fixed
    assert lex.repair("\n".join(["[Page 1]", "Introduction", *page]))[1] == 0
    word = max((w for w in lex.counts if w.isascii() and w.islower() and "m" in w and len(w) > 6), key=len)
    assert lex.fix(word.replace("m", "rn", 1)) == (word, 1) and lex.fix(word) is None and lex.fix("Zqm66l3O") is None


def test_running_headers_and_page_numbers_of_one_document(refs):
    lex = lexicon(refs)
    lex.headings = frozenset({scan.line_key("Material and methods")})
    bodies = [wrapped(" ".join(refs["en"][5 * k : 5 * k + 5]).split()) for k in range(4)]

    def text(tops, ends=("", "", "", "")):
        return "\n\n".join("\n".join(x for x in (f"[Page {k + 1}]", tops[k], *bodies[k], ends[k]) if x) for k in range(4))

    assert lex.repair(text(["72   Goka E", "On the spiders   73", "74   Goka E", "On the spiders   75"]))[1] == 4
    assert lex.repair(text(["Shapué V L", "", "Sliapué V L", ""], ["31", "32", "33", "34"]))[1] == 6
    assert lex.repair(text(["Material and methods"] * 4))[1] == 0  # a heading printed again and again
    assert lex.repair(text(["12.5", "II", "4", "19"], ["IV", "7", "3.1", "II"]))[1] == 0  # columns of figures
    assert scan.line_key("p. 384") == "=p. #" and scan.line_key("xiv") == "=r" and scan.line_key("IV") is None
    doubled = "\n".join(["[Page 1]", *bodies[0], "[Page 2]", *bodies[0]])  # a passage printed twice is no header
    assert lex.repair(doubled)[1] == 0


def test_every_listed_confusion_is_looked_up():
    words = {"white": 500, "field": 900, "ficld": 1, "under": 500, "spine": 500, "hind": 500, "found": 900, "fauna": 400, "head": 500, "margin": 500, "spinneret": 500}
    lex = scan.Lexicon(words, 10_000, frozenset())
    read = {"whife": "white", "fielcl": "field", "ficld": "field", "urider": "under", "spirie": "spine", "bind": "hind", "fouud": "found", "fonnd": "found", "bead": "head", "margiri": "margin", "spirineret": "spinneret", "fauua": "fauna"}
    assert {t: lex.fix(t) and lex.fix(t)[0] for t in read} == read
    assert all(lex.fix(w) is None for w in ("white", "zebra", "Hind7", "found"))
    for a, b in scan.CONFUSIONS:
        word = f"zqzq{b}zqzq"
        assert scan.Lexicon({word: 500, f"zqzq{b}qzqz": 900}, 10_000, frozenset()).fix(f"zqzq{a}zqzq") == (word, 1)


def test_compounds_keep_their_hyphen(refs):
    lex = scan.Lexicon({"wing": 500, "shaped": 500, "yellow": 500, "brown": 500, "individuals": 500}, 10_000, frozenset())
    assert lex.join("wing", "-", "shaped") == ("wing-shaped", 0, 0) and lex.join("indivi", "\xad", "duals") == ("individuals", 1, 0)
    assert lex.decode("yellowbrown wing")[0] == "yellow brown wing" and lex.decode("indiv iduals")[0] == "individuals"


def test_broken_and_run_together_words_are_repaired():
    words = {"individuals": 500, "yellow": 900, "wing": 900, "of": 3000, "the": 5000, "in": 3000, "spider": 900, "seen": 700, "be": 900, "Por": 60}
    lex = scan.Lexicon(words, 40_000, frozenset())
    assert lex.repair("seen indiv iduals ofthe spider") == ("seen individuals of the spider", 0)
    assert lex.repair("seen in the yellow indi\nviduals of the spider") == ("seen in the yellow individuals\nof the spider", 1)
    assert lex.repair("the be wing in dividuals seen")[0] == "the be wing individuals seen"
    for text in ("seen in the\nwing of the spider", "Porthe of Zelotes", "[Page 1]\nindi", "a yellow wing"):
        assert lex.repair(text) == (text, 0)


def test_paragraphs():
    text = "[Page 1]\nHeading\nThe first line of a paragraph that is long enough to be full\nand goes on here, to the end.\n\nAnother one starts after a blank line and is as long as that\nother line."
    assert scan.paragraphs(text) == ["[Page 1]", "Heading", "The first line of a paragraph that is long enough to be full and goes on here, to the end.", "Another one starts after a blank line and is as long as that other line."]
    assert scan.paragraphs("") == [] and len(scan.paragraphs("word\n" * 20_000)) >= 1


def test_statistics_dont_depend_on_the_splits(spark):
    head, heading = "Annals of Spiders", "Material and Methods"
    body = "\n".join(f"a line of the text number {k} goes here" for k in range(6))
    texts = [f"[Page 1]\n{head if k % 5 == 0 else ''}\n{heading if k < 4 else 'An opening'}\n{body}\n{heading if k >= 4 else 'Some line'}\n{body}" for k in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "full_text string")
    one, many = (scan.statistics(df.repartition(n), "full_text")[0] for n in (1, 20))
    assert one == many and scan.line_key(head) in many[2] and scan.line_key(heading) in many[3] and scan.line_key(heading) not in many[2]


def test_scan_operator(spark, refs):
    page = "\n".join(wrapped(" ".join(refs["en"]).split()))
    noisy = "\n".join(f"[Page {k}]\n- {k} -\n" + "\n".join(wrapped(" ".join(refs["en"][5 * k : 5 * k + 5]).split())) + "\n" for k in range(1, 5))
    rows = [(1, noisy), (2, page), (3, None), (4, ""), (1, noisy), (5, "[Page 1]")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id int, full_text string, evidence int")
    got = {r["doc_id"]: (r["noisy"], r["evidence"], r["paragraphs"]) for r in scan.clean(df).collect()}
    assert got[1][0] and got[1][1] == 4 and not any("- 2 -" in p for p in got[1][2])
    assert got[2][:2] == (False, 0) and got[3] == (False, 0, None) and got[4] == (False, 0, []) and got[5] == (False, 0, ["[Page 1]"])
    assert scan.clean(df.limit(0)).count() == 0


def test_text_garbled_again_and_again_is_restored(spark, data, refs):
    full = spark.read.parquet(f"{data}/full_texts.parquet")
    counts, margin = mojibake.train(full, [s for v in refs.values() for s in v], "full_text")
    assert margin >= mojibake.MARGIN
    text = garbled = " ".join(refs["fr"])
    for _ in range(3):
        garbled = garbled.encode().decode("latin_1")
    assert mojibake.Restorer(counts, margin).restore(garbled)[0] == text


def test_every_chain_that_makes_a_word_is_credited():
    found = mojibake.candidates("Ã©tÃ©")
    assert {"utf-8>cp1252", "utf-8>latin_1", "utf-8>cp1254"} <= set(found["été"])


def test_labelled_rows_are_bounded_by_their_texts(spark):
    df = spark.createDataFrame([("a", f"some text number {k}") for k in range(400)] + [("b", "short"), (None, "none"), ("c", None), ("c", "")], "lang string, sample string")
    got = mojibake.bounded_samples(df, "lang", "sample", 2000)
    assert got == mojibake.bounded_samples(df.repartition(7), "lang", "sample", 2000)
    assert 500 < sum(len(t) for k, t in got if k == "a") < 4000 and {k for k, _ in got} == {None, "a", "b"}


def test_repair_is_trained_on_all_labelled_rows(spark, monkeypatch):
    """However little text is taken elsewhere, no labelled row is left out of the characters, counts and margin of the repair."""
    monkeypatch.setattr(mojibake.bounded_samples, "__defaults__", (50,))
    texts = [f"größe {'äöü'[k % 3]}{chr(0x250 + k)} número {k}" for k in range(80)]
    refs = spark.createDataFrame([(t,) for t in [*texts, texts[0], None, ""]], "sample string").repartition(5)
    asked = []
    real = mojibake.Shared
    monkeypatch.setattr(mojibake, "Shared", lambda spark, value: asked.append(value) or real(spark, value))
    df = spark.createDataFrame([(1, "abc")], "doc_id int, full_text string")
    assert [r["garbled"] for r in mojibake.restore(df, refs, "full_text", "sample").collect()] == [False]
    counts, margin = asked[-1]
    assert counts == dict(mojibake.trigrams(Counter(w for t in [*texts, texts[0]] for w in mojibake.odd_words(t)))) and margin >= mojibake.MARGIN


def test_unequal_samples_still_give_the_right_language(refs):
    parser = language.Parser({k: v[::2] if k != "fr" else v[::2][:6] for k, v in refs.items()})
    texts, want = zip(*[(s, k) for k, v in refs.items() for s in v[1::2]])
    of, _, _, lang, _ = language.segment(parser, list(texts))
    best = {int(o): parser.langs[x] for o, x in zip(of, lang)}
    assert sum(best[i] == w for i, w in enumerate(want)) / len(want) >= 0.93


def spoilt(text, rng):
    """(text with scan noise, places misread, words broken): headers, page numbers, confusions and hyphens put into a clean text."""
    read = {}
    for a, b in scan.CONFUSIONS:
        read.setdefault(b, []).append(a)
    out, misread, broken, page = [], 0, 0, 100
    for line in text.split("\n"):
        words = line.split(" ")
        for k, w in enumerate(words):
            if len(w) > 5 and w.isalpha() and w.islower() and rng.random() < 0.03:
                at = [(i, p) for i in range(len(w)) for p in read if w.startswith(p, i)]
                if at:
                    i, p = rng.choice(at)
                    words[k] = w[:i] + rng.choice(read[p]) + w[i + len(p) :]
                    misread += 1
        line = " ".join(words)
        if out and out[-1][:1] not in "[" and words[0].isalpha() and words[0].islower() and len(words[0]) > 6 and words[0] in text and rng.random() < 0.1:
            cut = rng.randint(3, len(words[0]) - 3)
            out[-1] += f" {words[0][:cut]}-"
            line = " ".join([words[0][cut:], *words[1:]])
            broken += 1
        if line[:6] == "[Page ":
            page += 1
            out += [line, f"- {page} -"]
        else:
            out.append(line)
    return "\n".join(out), misread, broken


def test_noise_put_into_clean_texts_is_taken_out(spark, data):
    full = spark.read.parquet(f"{data.rsplit('/', 1)[0]}/sf0.01/full_texts.parquet").select("full_text")
    known, _ = scan.statistics(full, "full_text")
    lex = scan.Lexicon(*known)
    rng = random.Random(7)
    clean = [t for (t,) in full.collect() if t and t.isprintable() is False and lex.repair(t)[1] == 0 and len(t) > 800][:200]
    places = right = damage = words = 0
    for text in clean:
        noisy, misread, broken = spoilt(text, rng)
        want = [w for x in scan.paragraphs(text) for w in x.split()]
        fixed, evidence = lex.repair(noisy)
        got = [w for x in scan.paragraphs(fixed) for w in x.split()]
        bad = sum((_bag(want) - _bag(got)).values())
        before = sum((_bag(want) - _bag([w for w in noisy.split()])).values())
        places, right, words = places + before, right + max(0, before - bad), words + len(want)
        damage += sum((_bag(want) - _bag([w for x in scan.paragraphs(lex.repair(text)[0]) for w in x.split()])).values())
        if misread + broken >= 8:
            assert evidence >= scan.LEAST_EVIDENCE
    print(f"words spoilt {places}, restored {right / places:.4f}, clean words damaged {damage / words:.6f}, words right after repair {1 - (places - right) / words:.5f}")
    assert right / places > 0.9 and damage <= 1e-4 * words


def _bag(words):
    from collections import Counter

    return Counter(words)
