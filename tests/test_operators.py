import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.fuzzy import partial_ratio
from corpusloom.operators import catalog, chunks, duplicates, export, items, pages

from .conftest import values

INV = "hash string, path string, ord int"
CH = "doc_id string, chunk_idx int, text string, page_numbers array<int>, figures array<struct<caption:string,picture_ref:string,image_file:string>>, tables array<struct<caption:string,csv_file:string>>"
SIDE = "doc_id string, meta_path string, caption string, page_number int, picture_ref string"


def test_keepers(spark):
    cases = [(["T_2", "T", "U"], "T"), (["T_10", "T_2"], "T_2"), (["T_3", "U_03"], "T_3"), (["A_1964", "A_1964_x"], "A_1964_x"), (["S"], "S")]
    rows = [(f"h{i}", f"r/{p}.pdf", i * 10 + k) for i, (ps, _) in enumerate(cases) for k, p in enumerate(ps)]
    got = {r["hash"]: r["keeper"] for r in duplicates.sizes(spark.createDataFrame(rows, INV)).collect()}
    assert got == {f"h{i}": f"r/{k}.pdf" for i, (_, k) in enumerate(cases)}


def test_plan(spark):
    inv = spark.createDataFrame([("h", "in/A/x_2.pdf", 0), ("h", "in/B/x.pdf", 1), ("h", "in/B/x.pdf", 2), ("u", "in/A/u.pdf", 3), (None, "in/A/bad.pdf", 4), ("v", "else/v.pdf", 5)], INV)
    files = spark.createDataFrame([("in/A/u.pdf",), ("in/A/bad.pdf",)], "path string")
    plan = duplicates.plan(inv, files, "in", "out")
    assert values(plan, "action", "src", "dest", "target") == sorted([
        ("copy", "else/v.pdf", None, None), ("copy", "in/A/u.pdf", "out/A/u.pdf", None), ("copy_keeper", "in/B/x.pdf", "out/B/x.pdf", None),
        ("copy_unlisted", "in/A/bad.pdf", "out/A/bad.pdf", None), ("link", "in/A/x_2.pdf", "out/A/x_2.pdf", "../B/x.pdf")], key=repr)
    command = plan.filter("action = 'link'").first()["command"]
    assert command == 'Push-Location "A"; New-Item -ItemType HardLink -Path "x_2.pdf" -Target "..\\B\\x.pdf" -Force; Pop-Location'
    assert tuple(duplicates.plan_summary(plan).first()) == (3, 1, 2, 1, 1)
    assert tuple(duplicates.summary(inv).first()) == (6, 3, 2, 4)
    empty = spark.createDataFrame([], INV)
    assert tuple(duplicates.summary(empty).first()) == (0, 0, 0, 0) and duplicates.plan(empty, files.limit(0), "", "o").count() == 0


def test_pages(spark):
    text = "[Page 1]\nfirst\npage\n\n[Page 2 — OCR]\n\n\n[Page 3 — OCR failed: no [file]]\n\n[Page 3 — OCR failed: x]"
    docs = spark.createDataFrame([("d", text), ("n", None), ("e", ""), ("m", "no marker")], "doc string, t string")
    assert values(pages.split_marked(docs, "doc", "t")) == [("d", 1, "", "first\npage"), ("d", 2, "OCR", "\n\n[Page 3 — OCR failed: no [file]]"), ("d", 3, "OCR failed", "")]
    rows = [("d", 2, "b" * 60, None, None), ("d", 1, "short", "read", None), ("d", 3, None, None, "boom"), ("c", 1, "c" * 60, "x", None)]
    parts = pages.with_parts(spark.createDataFrame(rows, "doc string, page_no int, raw_text string, ocr_text string, ocr_error string"))
    got = {r["doc"]: r for r in pages.roll_up(parts, "doc").collect()}
    assert got["d"]["full_text"] == "[Page 1 — OCR]\nread\n\n[Page 2]\n" + "b" * 60 + "\n\n[Page 3 — OCR failed: boom]"
    assert (got["d"]["ocr_used"], got["c"]["ocr_used"], got["d"]["page_count"]) == (True, False, 3)
    log = pages.extraction_log(pages.roll_up(parts, "doc").withColumnRenamed("doc", "doc_path"), errors=spark.createDataFrame([("s/bad.pdf", "broken")], "doc_path string, error string"))
    assert ("s/bad.pdf", "s", None, None, None, None, "broken") in values(log)


def test_garbled_share(spark):
    rows = [("a", 1, "1" * 60), ("a", 2, "a" * 60), ("a", 3, "x"), ("b", 1, None), ("c", 1, "1" * 60), ("c", 2, "a" * 60), ("c", 3, "a" * 60)]
    df = spark.createDataFrame(rows, "doc string, page_no int, raw_text string")
    got = {r["doc"]: (r["page_count"], r["text_pages"], r["garbled_pages"], r["force_ocr"]) for r in pages.garbled_share(df, "doc").collect()}
    assert got == {"a": (3, 2, 1, True), "b": (1, 0, 0, False), "c": (3, 3, 1, True)}


def test_images(spark):
    cols = "doc_path string, page_no int, seq int, xref int, width int, height int, rect_w double, rect_h double, page_w double, page_h double, page_nws int"
    rows = [("d", 1, 1, 7, 49, 200, None, None, 100.0, 100.0, 0), ("d", 1, 2, 7, 50, 50, None, None, 100.0, 100.0, 0), ("d", 1, 3, 8, 50, 50, 85.0, 85.0, 100.0, 100.0, 300), ("d", 1, 4, 9, 50, 50, 85.0, 85.0, 100.0, 100.0, 301), ("d", 2, 1, 8, 60, 60, None, None, 1.0, 1.0, 999)]
    assert values(pages.kept_images(spark.createDataFrame(rows, cols)), "page_no", "seq", "image_idx", "image_file") == [(1, 3, 1, "page1_img1.png"), (2, 1, 1, "page2_img1.png")]


def sequential(docs, captions, sidecars, threshold):
    """The same steps one after another over Python lists, and what each of them did."""
    out, did = {}, {}
    for doc, chs in docs.items():
        n = [0, 0, 0, 0]
        state = [[i, txt, pg, [dict(zip(("caption", "ref", "img"), f)) for f in figs]] for i, txt, pg, figs in chs]
        side = sorted((s for s in sidecars if s[0] == doc), key=lambda s: s[1])
        for _, txt, _, figs in state:
            held = {f["ref"] for f in figs}
            for c, ref in captions.get(doc, []):
                if txt and partial_ratio(c, txt) >= threshold and ref not in held:
                    held.add(ref)
                    figs.append({"caption": c, "ref": ref, "img": None})
                    n[0] += 1
        image = {s[4]: "images/" + s[1].split("/")[-1].replace("_meta.json", ".png") for s in side if s[4]}
        for x in state:
            seen, kept = set(), []
            for f in x[3]:
                n[1] += not f["img"] and f["ref"] in image
                f["img"] = f["img"] or image.get(f["ref"])
                if f["ref"] not in seen:
                    seen.add(f["ref"])
                    kept.append(f)
            x[3] = kept
        seen = set()
        before = sum(len(x[3]) for x in state)
        for x in state:
            x[3] = [f for f in x[3] if f["ref"] == "" or not (f["ref"] in seen or seen.add(f["ref"]))]
        n[2] = before - sum(len(x[3]) for x in state)
        held = {f["ref"] for x in state for f in x[3]}
        for _, path, cap, page, ref in side:
            if cap.strip() == "" and ref and ref not in held:
                first = next((x for x in state if page in x[2]), None)
                if first:
                    held.add(ref)
                    n[3] += 1
                    first[3].append({"caption": "", "ref": ref, "img": "images/" + path.split("/")[-1].replace("_meta.json", ".png")})
        for x in state:
            out[doc, x[0]] = [(f["caption"], f["ref"], f["img"]) for f in x[3]]
        did[doc] = tuple(n)
    return out, did


@pytest.mark.parametrize("threshold", [85, 100])
def test_postprocess_agrees_with_the_sequential_fold(spark, threshold):
    rng = random.Random(11)
    docs, captions, side = {}, {}, []
    names = [f"Figure {k}. A spider of the {k}th kind" for k in range(5)]
    for d in range(12):
        doc = f"d{d}"
        caps = {rng.choice(names): f"#{rng.randint(0, 5)}" for _ in range(3)}
        captions[doc] = list(caps.items())
        spoilt = [c[:k] + "%" * rng.randint(1, 4) + c[k + 3 :] for c in caps for k in (5, 20)]  # around the threshold
        docs[doc] = [(i, " ".join(rng.choice([*caps, *spoilt, "word"]) for _ in range(3)), sorted(rng.sample(range(5), 2)), [(None, rng.choice(["", "#0", "#1", "#2"]), rng.choice([None, "", "y.png"])) for _ in range(rng.randint(0, 3))]) for i in range(4)]
        side += [(doc, f"images/f{k}_meta.json", rng.choice(["", " ", "c"]), rng.choice([0, 1, 2, 7]), f"#{rng.randint(0, 9)}") for k in range(6)]
    rows = [(doc, i, txt, pg, figs, []) for doc, chs in docs.items() for i, txt, pg, figs in chs]
    caps = [(doc, c, ref, k) for doc, cs in captions.items() for k, (c, ref) in enumerate(cs)]
    done = chunks.postprocess(spark.createDataFrame(rows, CH), spark.createDataFrame(caps, "doc_id string, caption string, picture_ref string, pos int"), spark.createDataFrame(side, SIDE), threshold)
    got = {(r["doc_id"], r["chunk_idx"]): [(f["caption"], f["picture_ref"], f["image_file"] or None) for f in r["figures"]] for r in done["chunks"].collect()}
    want, did = sequential(docs, captions, side, threshold)
    assert got == {k: [(c, a, b or None) for c, a, b in v] for k, v in want.items()}
    stats = {r["doc_id"]: (r["fuzzy_injected"], r["image_files_resolved"], r["cross_chunk_removed"], r["fallback_injected"]) for r in done["stats"].collect()}
    assert stats == did and any(x[0] for x in did.values())
    again = chunks.dedup_across(done["chunks"])
    assert values(again, "doc_id", "chunk_idx", "figures") == values(done["chunks"], "doc_id", "chunk_idx", "figures")


def test_chunks_with_nulls(spark):
    df = spark.createDataFrame([("d", 0, None, None, None, None), ("d", 1, "", [1], [("", "", None), ("", "", None), ("c", None, None)], [("a", ""), ("b", None)])], CH)
    got = {r["chunk_idx"]: (len(r["figures"]), len(r["tables"])) for r in chunks.dedup_in_chunk(df).collect()}
    assert got == {0: (0, 0), 1: (1, 1)}
    assert chunks.postprocess(df.limit(0), spark.createDataFrame([], "doc_id string, caption string, picture_ref string, pos int"), spark.createDataFrame([], SIDE))["chunks"].count() == 0


def test_fuzzy_threshold_is_inclusive(spark):
    df = spark.createDataFrame([("d", 0, "xx abcdefghijklmnopqrst yy", [], [], [])], CH)
    caps = spark.createDataFrame([("d", "abcdefghijklmnopq###", "#1", 0), ("d", "zzzzzzzzzz", "#2", 1)], "doc_id string, caption string, picture_ref string, pos int")
    assert values(chunks.fuzzy_links(df, caps, 85), "picture_ref", "score") == [("#1", 85.0)]


def test_items(spark):
    rows = [("d", 1, "TableItem", "t1", "", None, "Tab", [2, None, 1]), ("d", 2, "TableItem", "t2", "", None, "Tab", None), ("d", 3, "TableItem", "t3", "", None, "", []), ("d", 4, "PictureItem", "p1", "", None, "Cap", [3]), ("d", 5, "PictureItem", "p2", "", None, "Cap", [4]), ("d", 6, "TextItem", "x", "Caption", "Cap", None, [4])]
    df = spark.createDataFrame(rows, "doc_id string, item_ord int, item_type string, self_ref string, label string, text string, caption string, page_nos array<int>")
    files = items.table_files(df)
    assert values(files, "self_ref", "slug", "page_number") == [("t1", "Tab", 1), ("t2", "Tab", None), ("t3", "table_3", None)]
    assert values(items.written(files), "slug", "writers", "self_ref") == [("Tab", 2, "t2"), ("table_3", 1, "t3")]
    assert values(items.captions(df)) == [("d", "Cap", "p2", 4)]
    placed = spark.createDataFrame([("d", 0, "t", ["h"], k) for k in (1, 2, 4, 6)], "doc_id string, chunk_idx int, chunk_text string, headings array<string>, item_ord int")
    made = items.build_chunks(placed, df).first()
    assert [f["picture_ref"] for f in made["figures"]] == ["p1", "p2"] and [x["csv_file"] for x in made["tables"]] == ["tables/Tab.csv", "tables/Tab.csv"] and made["page_numbers"] == [1, 2, 3, 4]


def test_catalog(spark):
    refs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("a", 4)], "base string, ord int")
    assert values(catalog.number_names(refs, ["ord"]), "ord", "unique_base") == [(1, "a"), (2, "a_1"), (3, "b"), (4, "a_2")]
    errors = spark.createDataFrame([("B", 1), ("A", 2), ("B", 3)], "species string, ord int")
    assert catalog.failed_folders(errors).first()["folders"] == "B, A" and catalog.failed_folders(errors.limit(0)).first()["folders"] == ""
    pages_ = spark.createDataFrame([("u", '<a href="/o.pdf"></a><table><td>PDF</td> <td><a href="http://h/x.pdf">1</a><a class="k" href="/y?a=1">2</a></td></table>'), ("v", "<td>PDF</td><td>none</td>"), ("w", None)], "url string, html string")
    assert values(catalog.links(pages_)) == [("u", 1, "http://h/x.pdf"), ("u", 2, "/y?a=1")]
    assert values(catalog.to_fetch(spark.createDataFrame([("p",), ("q",)], "path string"), spark.createDataFrame([("p",)], "path string"))) == [("q",)]
    assert catalog.folder(F.lit("A b")) is not None


def test_fuzzy_links_look_for_every_heading(spark, data):
    from corpusloom.plans import registry

    got = set(values(registry.QUERIES["caption_fuzzy_link"](spark, data), "doc_id", "chunk_idx", "caption"))
    rows = registry._chunks(spark, data).collect()
    want, odd = set(), 0
    for x in rows:
        for h in x["headings"] or []:
            at = (len(h or "") + 1) // 2 - 1
            for y in rows:
                held = {f["picture_ref"] for f in y["figures"] or []}
                if h and len(h) >= 7 and y["doc_id"] == x["doc_id"] and h in (y["text"] or "") and not any("#/pictures/" in (r or "") for r in held):
                    want.add((y["doc_id"], y["chunk_idx"], h[:at] + "#" + h[at + 1 :]))
                    odd += x["chunk_idx"] % 2
    assert odd and want <= got


def cell(name, value):
    return f"<tr><td>{name}</td><td>{value}</td></tr>"


def test_crawl(spark):
    long = "é" * 200
    page = lambda title, links: "<table>" + cell("Author", "A B") + cell("Year", "1999") + cell("Title", title) + cell("PDF", "".join(f'<a href="{x}">p</a>' for x in links)) + "</table>"
    blocks = [["/r/1", "r/2", "/r/1"], ["r/3"], []]
    html = "".join(f'<div class="species-title"><em>{s}</em></div>' for s in ("Aa bb", "Cc dd", "Ee")) + '<div class="tax-ref"></div>' * 9 + "".join('<div class="x tax-ref">' + "".join(f'<strong><a href="{x}">r</a></strong>' for x in b) + "</div>" for b in blocks)
    genus = spark.createDataFrame([(html, 1)], "html string, url int")
    pages_ = spark.createDataFrame([("h/r/1", page(long, ["http://o/1.pdf", "http://o/2.pdf"])), ("h/r/2", page("T, t", ["x"]))], "url string, html string")
    first = "A_B_1999_" + long
    cut = first.encode()[:245].decode(errors="ignore")
    present = spark.createDataFrame([("out/Aa_bb/A_B_1999_T_t.pdf",)], "path string")
    files, summary = catalog.crawl(genus, pages_, present, "h/", "out/")
    assert values(files, "species", "pdf_url", "copy_no", "path", "there") == sorted([("Aa_bb", "http://o/1.pdf", 0, f"out/Aa_bb/{cut}.pdf", False), ("Aa_bb", "http://o/2.pdf", 1, f"out/Aa_bb/{cut}_1.pdf", False), ("Aa_bb", "x", 0, "out/Aa_bb/A_B_1999_T_t.pdf", True)], key=repr)
    assert tuple(summary.first()) == (3, 3, 3, 1, "Cc_dd")
    only = catalog.crawl(genus, pages_, present, "h/", "out", spark.createDataFrame([("Ee",)], "species string"))
    assert only[0].count() == 0 and tuple(only[1].first()) == (1, 3, 0, 0, "")
    assert catalog.crawl(genus.limit(0), pages_, present, "h", "o")[1].first()["files"] == 0


def test_report_has_a_row_a_path(spark):
    inv = spark.createDataFrame([("h", f"p{k}", k) for k in range(3)] + [("u", "q", 9), (None, "r", 10)], INV)
    assert values(duplicates.report(inv), "hash", "n", "first_ord", "path") == [("h", 3, 0, "p0"), ("h", 3, 0, "p1"), ("h", 3, 0, "p2")]


ITEMS = "doc_id string, item_ord int, item_type string, self_ref string, label string, text string, caption string, page_nos array<int>"


def test_exports_and_a_whole_run(spark):
    rows = [("d", 1, "TableItem", "t1", "", None, "Tab", [2]), ("d", 2, "TableItem", "t2", "", None, "Tab", None), ("d", 3, "TableItem", "t3", "", None, None, [1]), ("d", 4, "PictureItem", "p1", "", None, "A drawing of the palp", [3]), ("d", 5, "PictureItem", "p2", "", None, "", [1]), ("d", 6, "PictureItem", "p3", "", None, None, [9]), ("d", 7, "TextItem", "x", "Caption", "A drawing of the palp", None, [4]), ("e", 1, "TextItem", "y", "", "t", None, None)]
    made = spark.createDataFrame(rows, ITEMS)
    data = spark.createDataFrame([("d", "t1", ["a", 'b"c'], [["1,2", None], ["x\ny", "z"]], None), ("d", "t2", ["a"], [], None), ("d", "t3", None, None, "torn")], "doc_id string, self_ref string, header array<string>, cells array<array<string>>, error string")
    pics = spark.createDataFrame([("d", "p1", bytearray(b"one"), None), ("d", "p2", None, None), ("d", "p3", None, "bad stream")], "doc_id string, self_ref string, content binary, error string")
    where = spark.createDataFrame([("d", "in/S a/x.pdf"), ("e", "in/T/y.pdf")], "doc_id string, path string")
    placed = spark.createDataFrame([("d", 0, "see A drawing of the palm here", [], 1), ("d", 0, "see A drawing of the palm here", [], 4), ("d", 1, "more", ["H"], 7), ("d", 1, "more", ["H"], 3), ("e", 0, "t", [], 1)], "doc_id string, chunk_idx int, chunk_text string, headings array<string>, item_ord int")
    run = export.process(made, placed, data, pics, spark.createDataFrame([("d", 3), ("e", 1)], "doc_id string, page_count int"), where)
    assert values(run["tables"], "self_ref", "csv_file", "ok") == [("t1", "tables/Tab.csv", True), ("t2", "tables/Tab.csv", True), ("t3", "tables/table_3.csv", False)]
    assert run["tables"].filter("self_ref = 't1'").first()["csv"] == 'a,"b""c"\n"1,2",\n"x\ny",z\n'
    assert run["tables"].filter("self_ref = 't1'").first()["meta"] == '{"caption":"Tab","page_number":2,"rows":2,"cols":2,"source_file":"x.pdf","species":"S a"}'
    assert export.on_disk(run["tables"], "csv_file").first()["self_ref"] == "t2"
    got = {r["doc_id"]: r.asDict() for r in run["summary"].collect()}
    assert got["d"] == {"doc_id": "d", "page_count": 3, "tables_total": 3, "tables_ok": 2, "tables_fail": 1, "pictures_total": 3, "pictures_ok": 2, "pictures_fail": 1, "chunks": 2, "with_figures": 2, "with_tables": 2, "fuzzy_injected": 0, "image_files_resolved": 2, "cross_chunk_removed": 1, "fallback_injected": 1}
    assert got["e"]["chunks"] == 1 and got["e"]["tables_total"] == 0
    empty = export.process(made.limit(0), placed.limit(0), data.limit(0), pics.limit(0), spark.createDataFrame([], "doc_id string, page_count int"), where.limit(0))
    assert empty["summary"].count() == 0 and empty["chunks"].count() == 0


def test_columns_with_names_of_their_own(spark):
    """Extra columns named like working columns don't get in the way."""
    df = spark.createDataFrame([("d", 0, "a text with the caption in it", [1], [], [], "x", 1)], CH + ", score string, pos int")
    caps = spark.createDataFrame([("d", "the caption", "#1", 0, "y")], "doc_id string, caption string, picture_ref string, pos int, text string")
    done = chunks.postprocess(df, caps.drop("text"), spark.createDataFrame([], SIDE))["chunks"].first()
    assert done["score"] == "x" and [f["picture_ref"] for f in done["figures"]] == ["#1"]
