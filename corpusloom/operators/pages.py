"""From pages to documents: quality gate, markers, roll-up, images, extraction log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import paths, text

# Sizes in pixels and shares of the page.
LEAST_SIDE, SCAN_SHARE, SCAN_TEXT = 50, 0.85, 300

_MARKER = r"(?m)^\[Page (\p{Nd}+)( — OCR(?: failed: [^\]\n]*)?)?\]$"


def split_marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, page_no, label, raw_text): a document's text taken apart at its page markers again.

    Null texts and texts without a marker give no page; a page without text has an empty one.
    """
    t = F.concat(F.lit("\n\n"), F.col(text_col))
    marks = F.regexp_extract_all(t, F.lit(_MARKER), F.lit(0))
    bodies = F.slice(F.split(t, _MARKER), 2, 1_000_000_000)
    # A marker opens a page after a blank line; the blank line belongs to neither page.
    pages = F.arrays_zip(marks.alias("mark"), bodies.alias("body"))
    p = docs.filter(F.col(text_col).isNotNull()).select(id_col, F.explode(pages).alias("p"))
    return p.select(
        id_col, F.regexp_extract("p.mark", _MARKER, 1).cast("int").alias("page_no"),
        F.regexp_replace(F.regexp_replace(F.regexp_extract("p.mark", _MARKER, 2), r"\A — ", ""), r": .*", "").alias("label"),
        F.regexp_replace(F.regexp_replace("p.body", r"\A\n", ""), r"\n+\z", "").alias("raw_text"))


def gate(pages: DataFrame, raw: str = "raw_text") -> DataFrame:
    """Adds nws, garbled and ocr: whether a page's native text has to be read again."""
    return pages.withColumns({"nws": F.coalesce(text.nonws_len(raw), F.lit(0)), "garbled": text.looks_garbled(raw), "ocr": text.needs_ocr(raw)})


def garbled_share(pages: DataFrame, doc: str, raw: str = "raw_text") -> DataFrame:
    """(doc, page_count, text_pages, garbled_pages, ratio, force_ocr): of the pages that bear text, how many are garbled."""
    bears = text.nonws_len(raw) >= text.OCR_LEAST_CHARS
    ratio = F.coalesce(F.col("garbled_pages") / F.nullif(F.col("text_pages"), F.lit(0)), F.lit(0.0))
    counted = pages.groupBy(doc).agg(F.count("*").alias("page_count"), F.count_if(bears).alias("text_pages"), F.count_if(bears & text.looks_garbled(raw)).alias("garbled_pages"))
    return counted.withColumn("ratio", ratio).withColumn("force_ocr", F.col("ratio") > text.FORCE_OCR_SHARE)


def with_parts(pages: DataFrame, raw: str = "raw_text", ocr_text: str = "ocr_text", ocr_error: str = "ocr_error") -> DataFrame:
    """Adds part (the page under its marker), part_nws (marker included) and ocr_done."""
    ocr = text.needs_ocr(raw)
    part = text.page_part("page_no", raw, ocr, ocr_text, ocr_error)
    return pages.withColumn("part", part).withColumn("part_nws", text.nonws_len("part")).withColumn("ocr_done", ocr & F.col(ocr_error).isNull())


def roll_up(parts: DataFrame, doc: str) -> DataFrame:
    """(doc, page_count, full_text, text_length, ocr_used): pages in order, joined by a blank line. A document's pages meet in one row."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page_no", "part"))), lambda x: x["part"])
    return parts.groupBy(doc).agg(F.count("*").alias("page_count"), F.array_join(ordered, "\n\n").alias("full_text"), F.bool_or("ocr_done").alias("ocr_used")).withColumn("text_length", F.length("full_text"))


def first_on_page(images: DataFrame) -> DataFrame:
    """The first placement of every image (xref) of a page, before any test of its size."""
    by = W.partitionBy("doc_path", "page_no", "xref").orderBy("seq")
    return images.withColumn("__n", F.row_number().over(by)).filter("__n = 1").drop("__n")


def large_enough(width: str = "width", height: str = "height") -> Column:
    return (F.col(width) >= LEAST_SIDE) & (F.col(height) >= LEAST_SIDE)


def page_scan(page_nws: str = "page_nws") -> Column:
    """A picture of the whole page behind its text. Without a known place it is none."""
    return F.coalesce((F.col("rect_w") >= SCAN_SHARE * F.col("page_w")) & (F.col("rect_h") >= SCAN_SHARE * F.col("page_h")) & (F.col(page_nws) > SCAN_TEXT), F.lit(False))


def kept_images(images: DataFrame) -> DataFrame:
    """Images that are written out, with image_idx (counting kept ones) and image_file."""
    kept = first_on_page(images).filter(large_enough()).filter(~page_scan())
    by = W.partitionBy("doc_path", "page_no").orderBy("seq")
    return kept.withColumn("image_idx", F.row_number().over(by)).withColumn("image_file", F.format_string("page%d_img%d.png", "page_no", "image_idx"))


def extraction_log(docs: DataFrame, images: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """(file_path, species, page_count, text_length, image_count, ocr_used, error): one row per document; a failed one has an error and nulls."""
    rows = docs.select(F.col("doc_path").alias("file_path"), paths.species("doc_path").alias("species"), F.col("page_count").cast("int").alias("page_count"), F.col("text_length").cast("int").alias("text_length"), "ocr_used")
    if images is not None:
        counts = images.groupBy(F.col("doc_path").alias("file_path")).agg(F.count("*").cast("int").alias("image_count"))
        rows = rows.join(counts, "file_path", "left").withColumn("image_count", F.coalesce("image_count", F.lit(0)))
    else:
        rows = rows.withColumn("image_count", F.lit(0))
    order = ["file_path", "species", "page_count", "text_length", "image_count", "ocr_used", "error"]
    rows = rows.withColumn("error", F.lit("")).select(order)
    if errors is not None:
        bad = errors.select(F.col("doc_path").alias("file_path"), paths.species("doc_path").alias("species"), "error")
        rows = rows.unionByName(bad, allowMissingColumns=True)
    return rows


def metadata(docs: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """The ten fields of a document's metadata; the time of extraction is now, without a zone."""
    log = extraction_log(docs, images)
    named = text.parse_filename(paths.stem("file_path"))
    return log.select(
        F.col("file_path").alias("original_pdf_path"), "species", named["author"].alias("author"), named["year"].alias("year"), named["title"].alias("title"),
        "page_count", F.col("text_length").alias("text_length_chars"), "image_count", "ocr_used", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("extraction_datetime"))
