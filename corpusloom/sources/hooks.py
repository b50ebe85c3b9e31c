"""Places for external extractors. A hook is a function from bytes to rows; the engine isolates its failures.

No extractor is bundled: the defaults answer with an error row, which the log keeps like any other failure.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGES = "doc_path STRING, page_no INT, raw_text STRING, page_w DOUBLE, page_h DOUBLE, page_image BINARY, error STRING"
IMAGES = "doc_path STRING, page_no INT, seq INT, xref INT, width INT, height INT, rect_w DOUBLE, rect_h DOUBLE, content BINARY, error STRING"
ITEMS = "doc_id STRING, item_ord INT, item_type STRING, self_ref STRING, label STRING, text STRING, caption STRING, page_nos ARRAY<INT>, error STRING"

#: Resolution at which a page reader renders pages for OCR, and the languages of the OCR.
RENDER_DPI = 200
OCR_LANGUAGES = ("eng", "rus")

Extractor = Callable[[str, bytes], Iterable[dict[str, Any]]]
Reader = Callable[[bytes], str]


def unavailable(what: str) -> Extractor:
    def fail(path: str, content: bytes) -> Iterable[dict[str, Any]]:
        raise RuntimeError(f"no {what} is configured")

    return fail


def extract(files: DataFrame, schema: str, extractor: Extractor) -> DataFrame:
    """Rows of `extractor` for each (path, content); a file it fails on gives one row with its path and the error."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    found = [dict.fromkeys(names) | {names[0]: path} | r for r in extractor(path, content)]
                except Exception as e:  # one bad file must not end the run
                    found = [dict.fromkeys(names) | {names[0]: path, "error": str(e) or type(e).__name__}]
                rows += found
            yield pd.DataFrame(rows, columns=names).astype(object).where(lambda x: x.notna(), None)

    return files.select("path", "content").mapInPandas(run, schema)


def ocr(pages: DataFrame, image: str, needed: str, reader: Reader | None = None) -> DataFrame:
    """Adds ocr_text and ocr_error. Pages that need none reach the reader as null and are passed over."""

    @F.pandas_udf("struct<ocr_text:string,ocr_error:string>")
    def read(images: pd.Series) -> pd.DataFrame:
        out = []
        for content in images:
            if content is None:
                out.append((None, None))
                continue
            try:
                if reader is None:
                    raise RuntimeError("no reader is configured")
                out.append((reader(bytes(content)), None))
            except Exception as e:
                out.append((None, str(e) or type(e).__name__))
        return pd.DataFrame(out, columns=["ocr_text", "ocr_error"])

    done = pages.withColumn("__o", read.asNondeterministic()(F.when(F.col(needed), F.col(image))))
    return done.withColumn("ocr_text", F.col("__o.ocr_text")).withColumn("ocr_error", F.col("__o.ocr_error")).drop("__o")


def none_of(files: DataFrame, schema: str) -> DataFrame:
    """An empty table of a hook's schema, without the error."""
    return files.sparkSession.createDataFrame([], schema).drop("error")


def to_rgb(samples: bytes, width: int, height: int, colorspace: str | None, alpha: bool = False) -> tuple[bytes, int]:
    """(samples, channels) fit to be saved: a mask (no colour space) as grey values with ink dark, anything else as RGB without alpha.

    colorspace: null, 'gray', 'rgb', 'cmyk' or 'separation' (one channel of ink, 0 for none).
    """
    x = np.frombuffer(samples, np.uint8).reshape(height, width, -1)
    if colorspace is None:
        return (255 - x[:, :, :1]).tobytes(), 1
    if alpha:
        x = x[:, :, :-1]
    if colorspace == "separation":
        x = 255 - x[:, :, :1]
    elif colorspace == "cmyk":
        ink = x.astype(np.uint16)
        x = ((255 - ink[:, :, :3]) * (255 - ink[:, :, 3:4]) // 255).astype(np.uint8)
    return np.repeat(x, 3, axis=2).tobytes() if x.shape[2] == 1 else x[:, :, :3].tobytes(), 3


def png(samples: bytes, width: int, height: int, channels: int) -> bytes:
    """A PNG file of grey (1) or RGB (3) samples."""

    def block(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    rows = np.frombuffer(samples, np.uint8).reshape(height, width * channels)
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rows], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", width, height, 8, 0 if channels == 1 else 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + block(b"IHDR", head) + block(b"IDAT", zlib.compress(lines)) + block(b"IEND", b"")
