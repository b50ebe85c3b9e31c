import json
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import chunks, duplicates, export, extraction
from corpusloom.sources import files, hooks, sinks, staging
from corpusloom.streaming import incremental

from .conftest import values


def test_scan_hash_and_inventory(spark, tmp_path):
    for name, body in {"S a/x.pdf": b"one", "T/x_2.pdf": b"one", "T/y.pdf": b"two", "T/z.txt": b"no"}.items():
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(body)
    found = files.scan_files(spark, str(tmp_path / "in"))
    assert values(found, "species", "stem") == [("S a", "x"), ("T", "x_2"), ("T", "y")]
    hashed = files.hash_files(found).withColumn("ord", F.monotonically_increasing_id())
    assert duplicates.report(hashed).count() == 2
    sinks.write_inventory(hashed, str(tmp_path / "inv"))
    assert files.read_inventory(spark, str(tmp_path / "inv")).count() == 3


def test_sidecars_with_a_broken_one(spark, tmp_path):
    (tmp_path / "a_meta.json").write_text(json.dumps({"caption": "é", "page_number": None, "picture_ref": "#1", "source_file": "s", "species": "x"}))
    (tmp_path / "b_meta.json").write_text("{broken")
    got = values(files.read_sidecars(spark, str(tmp_path)), "bad", "caption", "page_number")
    assert got == [(False, "é", None), (True, None, None)]


def test_paths_with_blanks_and_letters_of_any_script(spark, tmp_path):
    names = ["Паук_Fig é 1_meta.json", "a+b 50%_meta.json", "x%20y_meta.json"]
    for k, name in enumerate(names):
        (tmp_path / name).write_text(json.dumps({"caption": "c", "page_number": 1, "picture_ref": f"#{k}", "source_file": "s", "species": "x"}))
    (tmp_path / "p a.html").write_text("<html></html>")
    read = files.read_sidecars(spark, str(tmp_path)).withColumn("doc_id", F.lit("d"))
    assert values(chunks.image_files(read), "picture_ref", "found") == [(f"#{k}", "images/" + n.replace("_meta.json", ".png")) for k, n in enumerate(names)]
    assert files.read_html(spark, str(tmp_path)).first()["url"].endswith("/p a.html")


def test_missing_and_empty_roots(spark, tmp_path):
    assert files.read_sidecars(spark, str(tmp_path / "none")).columns == ["meta_path", "bad", "caption", "page_number", "picture_ref", "source_file", "species"]
    assert files.read_sidecars(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.scan_files(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert files.scan_files(spark, str(tmp_path / "empty")).count() == 0
    for name in ("a-b", "a"):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "x.pdf").write_bytes(b"1")
    assert [r["species"] for r in files.in_order(files.scan_files(spark, str(tmp_path / "in"))).collect()] == ["a", "a-b"]


def test_inventory_of_several_files_keeps_its_order(spark, tmp_path):
    size = 400
    for k, rows in enumerate((3, size, 5)):  # splits are read in the order of their size
        (tmp_path / f"part-{k}.csv").write_text("hash,path\n" + "".join(f"h,p{k}_{i:04}\n" for i in range(rows)))
    got = [r["path"] for r in files.read_inventory(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == [f"p{k}_{i:04}" for k, rows in enumerate((3, size, 5)) for i in range(rows)]
    assert duplicates.sizes(files.read_inventory(spark, str(tmp_path))).first()["n"] == size + 8


def test_sinks(spark, tmp_path):
    log = spark.createDataFrame([("s/a.pdf", "s", 3, 10, 0, True, ""), ("s/b.pdf", "s", None, None, None, None, "broken, really")], files.LOG)
    sinks.write_log(log, str(tmp_path / "log"))
    text = "".join(p.read_text() for p in (tmp_path / "log").glob("*.csv"))
    assert 's/b.pdf,s,,,,,"broken, really"' in text
    assert files.read_log(spark, str(tmp_path / "log")).count() == 2
    inv = spark.createDataFrame([("h", "A/x.pdf", 0), ("h", "A/x_1.pdf", 1)], "hash string, path string, ord int")
    sinks.write_link_script(duplicates.plan(inv, inv.select("path"), "", "out"), str(tmp_path / "script"))
    lines = [line for p in sorted((tmp_path / "script").glob("part*")) for line in p.read_text().splitlines()]
    assert lines[0].startswith("#") and len(lines) == 2
    chunk = spark.createDataFrame([("d", 1, "t", [], [], "f", "s", [1], [], [("c", "")])], "doc_id string, chunk_idx int, text string, headings array<string>, item_types array<string>, source_file string, species string, page_numbers array<int>, figures array<struct<caption:string,picture_ref:string,image_file:string>>, tables array<struct<caption:string,csv_file:string>>")
    sinks.write_chunks(chunk, str(tmp_path / "chunks"))
    sinks.write_metadata(log, str(tmp_path / "meta"))
    sinks.write_texts(spark.createDataFrame([("S a", "in/S a/p.pdf", "t\n\nu"), ("S a", "in/S a/q.pdf", None)], "species string, doc_path string, full_text string"), str(tmp_path / "texts"))
    written = list((tmp_path / "texts").rglob("part*.txt"))
    assert [p.read_text() for p in written] == ["t\n\nu\n"] and written[0].parent.name == "document=p"
    body = "".join(p.read_text() for p in (tmp_path / "chunks").glob("part*"))
    assert json.loads(body)[0]["tables"] == [{"caption": "c", "csv_file": ""}]


def test_hooks_isolate_failures(spark):
    df = spark.createDataFrame([("a", bytearray(b"2")), ("b", bytearray(b"x"))], "path string, content binary")

    def read(path, content):
        return [{"page_no": k, "raw_text": "t"} for k in range(int(content))]

    got = values(hooks.extract(df, hooks.PAGES, read), "doc_path", "page_no", "error")
    assert [g[:2] for g in got] == [("a", 0), ("a", 1), ("b", None)] and "invalid literal" in got[2][2]
    assert values(hooks.extract(df, hooks.PAGES, hooks.unavailable("PDF reader")), "error") == [("no PDF reader is configured",)] * 2
    pages = df.withColumn("need", F.col("path") == "a")
    assert values(hooks.ocr(pages, "content", "need", lambda b: "read"), "path", "ocr_text", "ocr_error") == [("a", "read", None), ("b", None, None)]
    assert values(hooks.ocr(pages, "content", "need"), "path", "ocr_error") == [("a", "no reader is configured"), ("b", None)]


def test_stream_of_new_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id bigint, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    docs = incremental.new_documents(spark, str(tmp_path / "in"), "doc_id bigint, text string")
    incremental.append_to(docs, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(4, "b"), (5, "c")], "doc_id bigint, text string").write.mode("append").parquet(str(tmp_path / "in"))
    incremental.append_to(incremental.new_documents(spark, str(tmp_path / "in"), "doc_id bigint, text string"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_staged_tables_read_back(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert values(staging.stage(df, "test")) == [(1, None), (2, "x")]


def test_staged_tables_are_deleted(spark):
    kept, gone = (staging.stage(spark.range(3).toDF("id"), "test") for _ in range(2))
    staging.discard(gone, spark.range(1))
    assert kept.count() == 3 and not files.exists(spark, gone._staged_at)
    assert files.exists(spark, kept._staged_at)


def test_written_files(spark, tmp_path):
    df = spark.createDataFrame([("a/Паук 1.txt", "é"), ("b.txt", ""), (None, "x"), ("c.txt", None)], "path string, content string")
    assert values(sinks.write_files(df, f"file://{tmp_path}")) == [("a/Паук 1.txt", 2), ("b.txt", 0)]
    assert (tmp_path / "a" / "Паук 1.txt").read_text() == "é" and sorted(p.name for p in tmp_path.iterdir()) == ["a", "b.txt"]


def test_pixels():
    grey, n = hooks.to_rgb(bytes([0, 255]), 2, 1, None)
    assert (list(grey), n) == ([255, 0], 1)
    assert hooks.to_rgb(bytes([7, 9]), 2, 1, "gray") == (bytes([7, 7, 7, 9, 9, 9]), 3)
    assert hooks.to_rgb(bytes([1, 2, 3, 99]), 1, 1, "rgb", alpha=True) == (bytes([1, 2, 3]), 3)
    assert hooks.to_rgb(bytes([0, 255, 0, 0]), 1, 1, "cmyk") == (bytes([255, 0, 255]), 3)
    assert hooks.to_rgb(bytes([0]), 1, 1, "separation") == (bytes([255] * 3), 3)
    file = hooks.png(bytes(range(12)), 2, 2, 3)
    assert file[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", file[16:24]) == (2, 2)
    body = zlib.decompress(file[file.index(b"IDAT") + 4 : -16])
    assert body == bytes([0, 0, 1, 2, 3, 4, 5, 0, 6, 7, 8, 9, 10, 11])


def test_extraction_of_files(spark, tmp_path):
    def page_reader(path, content):
        if content == b"bad":
            raise ValueError("not a PDF")
        long = "A page with text enough to stand as it is, without any reading of its picture. " * 5
        return [{"page_no": 1, "raw_text": long, "page_w": 100.0, "page_h": 100.0}, {"page_no": 2, "raw_text": "", "page_w": 100.0, "page_h": 100.0, "page_image": b"img"}, {"page_no": 3, "raw_text": " ", "page_w": 1.0, "page_h": 1.0, "page_image": b"torn"}]

    def image_reader(path, content):
        if content == b"bad":
            raise ValueError("no images")
        size = {"width": 60, "height": 60, "rect_w": 10.0, "rect_h": 10.0, "content": b"png"}
        return [{"page_no": 1, "seq": 1, "xref": 5, **size}, {"page_no": 1, "seq": 2, "xref": 5, **size}, {"page_no": 1, "seq": 3, "xref": 6, **size | {"rect_w": 99.0, "rect_h": 99.0}}, {"page_no": 2, "seq": 1, "xref": 6, **size | {"rect_w": 99.0, "rect_h": 99.0}}]

    def ocr(image):
        if image == b"torn":
            raise ValueError("no ink")
        return "read"

    df = spark.createDataFrame([("in/S a/Author_1999_Title.pdf", bytearray(b"good")), ("in/T/y.pdf", bytearray(b"bad"))], "path string, content binary")
    done = extraction.extract(df, page_reader, image_reader, ocr)
    text = done.documents.first()["full_text"]
    assert text.startswith("[Page 1]\nA page") and text.endswith("\n\n[Page 2 — OCR]\nread\n\n[Page 3 — OCR failed: no ink]")
    assert values(done.log) == sorted([("in/S a/Author_1999_Title.pdf", "S a", 3, len(text), 2, True, ""), ("in/T/y.pdf", "T", None, None, None, None, "not a PDF")], key=repr)
    assert values(done.images, "page_no", "image_file") == [(1, "page1_img1.png"), (2, "page2_img1.png")]
    meta = done.metadata.first()
    assert (meta["author"], meta["year"], meta["title"], meta["image_count"]) == ("Author", "1999", "Title", 2)
    assert sinks.write_images(done.images, f"file://{tmp_path}").count() == 2
    assert (tmp_path / "S a" / "Author_1999_Title" / "images" / "page1_img1.png").read_bytes() == b"png"
    none = extraction.extract(df.limit(0), page_reader, image_reader, ocr)
    assert none.log.count() == 0 and none.images.count() == 0
    assert values(extraction.extract(df, hooks.unavailable("PDF reader")).log, "error") == [("no PDF reader is configured",)] * 2


def test_a_run_is_written(spark, tmp_path):
    items = spark.createDataFrame([("d", 1, "TableItem", "t", "", None, "Tab", [1]), ("d", 2, "PictureItem", "p", "", None, "Паук é", [1])], "doc_id string, item_ord int, item_type string, self_ref string, label string, text string, caption string, page_nos array<int>")
    placed = spark.createDataFrame([("d", 0, "t", [], 1), ("d", 0, "t", [], 2)], "doc_id string, chunk_idx int, chunk_text string, headings array<string>, item_ord int")
    data = spark.createDataFrame([("d", "t", ["a"], [["1"]], None)], "doc_id string, self_ref string, header array<string>, cells array<array<string>>, error string")
    pics = spark.createDataFrame([("d", "p", bytearray(b"png"), None)], "doc_id string, self_ref string, content binary, error string")
    run = export.process(items, placed, data, pics, spark.createDataFrame([("d", 1)], "doc_id string, page_count int"), spark.createDataFrame([("d", "in/S/x.pdf")], "doc_id string, path string"))
    sinks.write_run(run, str(tmp_path))
    assert (tmp_path / "d/tables/Tab.csv").read_text() == "a\n1\n" and (tmp_path / "d/images/Паук_é.png").read_bytes() == b"png"
    assert json.loads((tmp_path / "d/images/Паук_é_meta.json").read_text())["picture_ref"] == "p"
    raw, done = ("".join(p.read_text() for p in (tmp_path / k).glob("part*")) for k in ("raw_chunks", "chunks"))
    assert "image_file" not in raw and json.loads(done)[0]["figures"] == [{"caption": "Паук é", "picture_ref": "p", "image_file": "images/Паук_é.png"}]
    sinks.write_documents(items, str(tmp_path / "documents"))
    body = json.loads("".join(p.read_text() for p in (tmp_path / "documents").glob("part*")))
    assert [x["self_ref"] for x in body["items"]] == ["t", "p"]
