"""Files to documents in one pass over each file: pages, OCR, images, log and metadata.

The readers are hooks (`sources.hooks`). A file its page reader fails on gives one log row with the error and nulls; a failed OCR
leaves its marker in the text; an unreadable image is passed over. No file ends the run, and empty input gives empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators import pages as page_ops
from corpusloom.sources import hooks
from corpusloom.sources.staging import stage


@dataclass(frozen=True)
class Extracted:
    """documents (doc_path, page_count, full_text, ocr_used, text_length), images (kept ones, with image_file and content), log, metadata."""

    documents: DataFrame
    images: DataFrame
    log: DataFrame
    metadata: DataFrame


def extract(files: DataFrame, page_reader: hooks.Extractor, image_reader: hooks.Extractor | None = None, ocr_reader: hooks.Reader | None = None) -> Extracted:
    """`files` (path, content). The page reader yields page_no, raw_text, page_w, page_h and, for OCR, page_image (a raster of RENDER_DPI);
    the image reader yields the fields of hooks.IMAGES. Contents go to Python once for each reader and through no shuffle."""
    read = stage(hooks.extract(files, hooks.PAGES, page_reader), "pages-read")
    failed = read.filter("error IS NOT NULL").select("doc_path", "error")
    good = read.filter("error IS NULL AND page_no IS NOT NULL").drop("error")
    gated = page_ops.gate(good)
    parts = stage(page_ops.with_parts(hooks.ocr(gated, "page_image", "ocr", ocr_reader)).drop("page_image"), "pages-parts")
    documents = page_ops.roll_up(parts, "doc_path")
    images = None
    if image_reader is not None:
        found = hooks.extract(files, hooks.IMAGES, image_reader).filter("error IS NULL AND page_no IS NOT NULL").drop("error")
        sized = parts.select("doc_path", "page_no", "page_w", "page_h", F.col("part_nws").alias("page_nws"))
        images = stage(page_ops.kept_images(found.join(sized, ["doc_path", "page_no"])), "pages-images")
    log = page_ops.extraction_log(documents, images, failed)
    kept = images if images is not None else hooks.none_of(files, hooks.IMAGES)
    return Extracted(documents, kept, log, page_ops.metadata(documents, images))
