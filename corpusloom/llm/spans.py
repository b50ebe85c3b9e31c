"""Spans of at least a given length that stand, character by character, in more than one record.

Units are digested, the digests are grouped globally, and of each digest the earliest occurrence is kept. `repeated_lines` ranks
whole lines so, and `left_over` takes all but the earliest out, with the offsets of what stays.

For spans exactly as stored, the units are runs of whole lines: from each line's start as many lines as make `unit` characters. A span
that holds such a run with the line breaks at its ends is found by it. What lines can't show, spans that begin and end within
lines too long for that, is left to units picked by content: of every run of `span - unit + 1` neighbouring windows of `unit` characters the one with the
least hash. Whether a span holds a run of lines depends on the span alone, so two records that share one agree on how it is found.
Records that meet are compared along the diagonal on which they meet, character by character. A unit that stands in very many texts
(a boilerplate line) is first replaced by the windows of `span` characters around it, known by 128 bits, so that
texts meet only if they share one of those; `shared_share` marks them without pairing anything, so its work grows with the occurrences.

Defined results: null, empty and short texts have no span; copies of one text (by a digest of 128 bits) are compared once and
meet over their whole length; a span repeated inside one record alone doesn't count; columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.sources.staging import discard, stage

from .copies import expand

SPAN, UNIT = 240, 120
#: A unit in more texts than this is looked at together with its surroundings before any two texts are paired.
HOT = 64

_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, m, np.uint64)])) for m in (_MULT, _INVERSE))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _sums(codes: np.ndarray, salt: int = 1) -> np.ndarray:
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(salt)) * _powers.get(len(codes) + 1)[0][: len(codes)], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every stretch of code points [start, end)."""
    return _mix((sums[ends] - sums[starts]) * _powers.get(len(sums))[1][starts])


def window_hashes(codes: np.ndarray, unit: int, salt: int = 1) -> np.ndarray:
    """A 64-bit hash of every window of `unit` code points."""
    sums, n = _sums(codes, salt), len(codes)
    return _mix((sums[unit:] - sums[: n - unit + 1]) * _powers.get(n + 1)[1][: n - unit + 1])


def line_runs(codes: np.ndarray, span: int, unit: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of runs of whole lines within a text, each begun by a line that isn't empty and as long as makes `unit` characters, if a span can hold it."""
    breaks = np.flatnonzero(codes == 10)
    starts, ends = breaks[:-1] + 1, breaks[1:]  # lines with a break on either side
    if not len(starts):
        return starts, ends
    last = np.searchsorted(ends, starts + unit)
    good = (last < len(ends)) & (ends > starts)
    starts, ends = starts[good], ends[last[good]]
    good = ends - starts + 2 <= span
    return starts[good], ends[good]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Distinct positions of the (rightmost) minimum of every run of `width` values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[: n - width + 1], head[width - 1 : n])
    # The minima of neighbouring runs change rarely: one position is looked up for each stretch of one value.
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.concatenate([change[1:], [len(least)]]) - 1
    where = []
    for a, b in zip(change.tolist(), ends.tolist()):
        hit = np.flatnonzero(values[a : b + width] == least[a])
        where.append(a + hit)
    return np.unique(np.concatenate(where))


def units(text: str, span: int = SPAN, unit: int = UNIT) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the units of a text: its runs of lines, and windows picked where a span may hold none of them.

    Of a run of equal units that overlap the first, the last and one in every `span - unit` places stay.
    """
    n = len(text)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    sums = _sums(codes)
    picked, at = [], []
    first, last = line_runs(codes, span, unit)
    open_ = [(0, n - span + 1)]  # starts of spans that hold no run of lines
    if len(first):
        picked.append(_mix(stretch_hashes(sums, first, last) + _MULT))
        at.append(first)
        step = np.zeros(n - span + 3, np.int64)
        np.add.at(step, np.minimum(np.maximum(last + 1 - span, 0), n - span + 1), 1)
        np.add.at(step, np.minimum(first, n - span + 1), -1)
        free = np.concatenate([[False], np.cumsum(step[: n - span + 1]) == 0, [False]])
        edges = np.flatnonzero(free[1:] != free[:-1]).tolist()
        open_ = list(zip(edges[::2], edges[1::2]))
    for a, b in open_:
        starts = np.arange(a, b + span - unit)
        hashes = stretch_hashes(sums, starts, starts + unit)
        where = sliding_argmin(hashes, span - unit + 1)
        picked.append(hashes[where])
        at.append(a + where)
    picked, at = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((picked, np.uint64), (at, np.int64)))
    if len(np.unique(picked)) < len(picked):
        order = np.lexsort((at, picked))
        h, p = picked[order], at[order]
        close = np.concatenate([[False], (h[1:] == h[:-1]) & (p[1:] - p[:-1] <= unit)])
        start = p[np.maximum.accumulate(np.where(close, 0, np.arange(len(p))))]
        step = (p - start) // (span - unit)
        last = np.concatenate([~close[1:], [True]])
        keep = ~close | last | np.concatenate([[True], step[1:] != step[:-1]])
        picked, at = h[keep], p[keep]
    return picked.view(np.int64), at


def common_runs(a: np.ndarray, b: np.ndarray, shift: int, span: int) -> list[tuple[int, int, int]]:
    """Maximal runs (start in a, start in b, length) of at least `span` equal code points with start_a - start_b = shift."""
    lo, hi = max(0, shift), min(len(a), len(b) + shift)
    if hi - lo < span:
        return []
    same = np.concatenate([[False], a[lo:hi] == b[lo - shift : hi - shift], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    return [(lo + s, lo + s - shift, e - s) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()) if e - s >= span]


def classes(df: DataFrame, id_col: str, text_col: str, span: int = SPAN) -> DataFrame:
    """(id, cls, size) of the texts long enough; copies have one class. The class is a 128-bit digest of the text."""
    return df.filter(F.length(text_col) >= span).select(df[id_col].alias("id"), F.unhex(F.md5(text_col)).alias("cls"), F.length(text_col).alias("size"))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def span_meetings(df: DataFrame, text_col: str = "text", span: int = SPAN, unit: int = UNIT) -> tuple[DataFrame, DataFrame]:
    """(matches, windows) of different texts.

    matches (cls_a, cls_b, start_a, start_b, length): maximal shared spans on every diagonal on which two texts share a unit that
    few texts have. windows (g, h, cls, pos): the windows of `span` characters that at least two texts have, around the
    other units. Shuffled are digests (two numbers a unit), then only the texts that meet another.
    """
    # h64: the first half of the class, for the units; where texts of two classes share it, they are compared as well.
    texts = df.filter(F.length(text_col) >= span).select(F.xxhash64(text_col).alias("h64"), F.unhex(F.md5(text_col)).alias("cls"), df[text_col].alias("text"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out_h, out_p, out_c = [], [], []
            for c, cls, text in zip(batch.column("h64").to_pylist(), batch.column("cls").to_pylist(), batch.column("text").to_pylist()):
                if cls not in seen:
                    seen.add(cls)
                    h, p = units(text, span, unit)
                    out_h.append(h)
                    out_p.append(p.astype(np.int32))
                    out_c.append(np.full(len(h), c, np.int64))
            if out_h:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (out_h, out_c, out_p)], names=["u", "h64", "pos"])

    picked = stage(texts.select("h64", "cls", "text").mapInArrow(pick, "u bigint, h64 bigint, pos int"), "span-picked")
    # A digest is of use if two different texts hold it. Partial aggregates and a join keep a hot digest spread.
    shared = picked.groupBy("u").agg(F.min("h64").alias("lo"), F.max("h64").alias("hi")).filter("lo < hi").select("u")
    meeting = stage(picked.join(shared, "u").distinct(), "span-units")
    discard(picked)
    many = meeting.groupBy("u").agg(F.countDistinct("h64").alias("n")).filter(F.col("n") > HOT).select("u")
    doubled = texts.groupBy("h64").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("h64")
    # Aggregating by the class keeps one text of each, however many copies there are.
    wanted = stage(meeting.select("h64").unionByName(doubled).distinct(), "span-wanted")  # of known size, so texts needn't be shuffled to it if it is small
    held = stage(texts.join(wanted, "h64", "left_semi").groupBy("h64", "cls").agg(F.first("text").alias("text")), "span-texts")
    discard(wanted)
    around = meeting.join(many, "u").groupBy("h64").agg(F.collect_set("pos").alias("at"))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cls, at, text in zip(*(batch.column(c).to_pylist() for c in ("cls", "at", "text"))):
                codes = _codes(text)
                starts = np.unique((np.asarray(at, np.int64)[:, None] - np.arange(span - unit + 1)).ravel())
                starts = starts[(starts >= 0) & (starts <= len(codes) - span)]
                g, h = (stretch_hashes(_sums(codes, salt), starts, starts + span).view(np.int64) for salt in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(h), pa.array([cls] * len(starts), pa.binary()), pa.array(starts.astype(np.int32))], names=["g", "h", "cls", "pos"])

    windows = stage(around.join(held, "h64").select("cls", "at", "text").mapInArrow(widen, "g bigint, h bigint, cls binary, pos int"), "span-windows")
    spanning = windows.groupBy("g", "h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("g", "h")
    windows = windows.join(spanning, ["g", "h"])
    few = meeting.join(many, "u", "left_anti")
    left, right = (few.select("u", F.col("h64").alias(f"h_{x}"), F.col("pos").alias(f"pos_{x}")) for x in "ab")
    diagonals = left.join(right, "u").filter("h_a < h_b").groupBy("h_a", "h_b").agg(F.collect_set(F.col("pos_a") - F.col("pos_b")).alias("shifts"))
    diagonals = diagonals.unionByName(doubled.select(F.col("h64").alias("h_a"), F.col("h64").alias("h_b"), F.lit(None).cast("array<int>").alias("shifts")))
    one = lambda x: held.select(F.col("h64").alias(f"h_{x}"), F.col("cls").alias(f"cls_{x}"), F.col("text").alias(f"text_{x}"))
    pairs = diagonals.join(one("a"), "h_a").join(one("b"), "h_b").filter("h_a < h_b OR cls_a < cls_b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for ca, cb, shifts, ta, tb in zip(rows["cls_a"], rows["cls_b"], rows["shifts"], rows["text_a"], rows["text_b"]):
                if shifts is None:
                    (ha, pa_), (hb, pb) = units(ta, span, unit), units(tb, span, unit)
                    i, j = np.nonzero(ha[:, None] == hb[None, :])
                    shifts = np.unique(pa_[i] - pb[j])
                a, b = _codes(ta), _codes(tb)
                for shift in shifts:
                    out += [(ca, cb, *run) for run in common_runs(a, b, int(shift), span)]
            yield pd.DataFrame(out, columns=["cls_a", "cls_b", "start_a", "start_b", "length"])

    matches = pairs.select("cls_a", "cls_b", "shifts", "text_a", "text_b").mapInPandas(compare, "cls_a binary, cls_b binary, start_a int, start_b int, length int")
    return matches, windows


def shared_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, unit: int = UNIT, **how) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: records with a span in common, copies included; `how`: as for copies.expand."""
    matches, windows = span_meetings(df, text_col, span, unit)
    windows = windows.select("g", "h", "cls").distinct()
    met = windows.withColumnRenamed("cls", "cls_a").join(windows.withColumnRenamed("cls", "cls_b"), ["g", "h"]).filter("cls_a < cls_b").select("cls_a", "cls_b")
    alike = matches.select(F.least("cls_a", "cls_b").alias("cls_a"), F.greatest("cls_a", "cls_b").alias("cls_b")).unionByName(met).distinct()
    return expand(classes(df, id_col, text_col, span).withColumn("field", F.lit(0)), alike, **how).select("doc_a", "doc_b")


def shared_share(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, unit: int = UNIT) -> DataFrame:
    """(id_col, n_chars, spans array<struct<start,end>>, shared_chars, share): what of each record stands elsewhere too.

    One row per row of `df`; the spans of a record are merged where they touch. A null or empty text has share 0. No texts are
    paired over a unit that many have.
    """
    m, windows = span_meetings(df, text_col, span, unit)
    m = stage(m, "span-matches")
    both = m.select(F.col("cls_a").alias("cls"), F.col("start_a").alias("s"), "length").unionByName(m.select(F.col("cls_b").alias("cls"), F.col("start_b").alias("s"), "length"))
    both = both.unionByName(windows.select("cls", F.col("pos").alias("s"), F.lit(span).alias("length")))
    many = classes(df, id_col, text_col, span).groupBy("cls").agg(F.min("size").alias("length"), F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi")
    spans = both.unionByName(many.select("cls", F.lit(0).alias("s"), "length")).select("cls", "s", (F.col("s") + F.col("length")).alias("e")).groupBy("cls", "s").agg(F.max("e").alias("e"))
    order = W.partitionBy("cls").orderBy("s")
    merged = (
        spans.withColumn("before", F.max("e").over(order.rowsBetween(W.unboundedPreceding, -1)))
        .withColumn("run", F.sum(F.when(F.col("before") >= F.col("s"), 0).otherwise(1)).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("cls", "run").agg(F.min("s").alias("start"), F.max("e").alias("end"))
        .groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("shared_chars"))
    )
    n = F.coalesce(F.length(text_col), F.lit(0))
    rows = df.select(df[id_col].alias(id_col), n.alias("n_chars"), F.when(F.length(text_col) >= span, F.unhex(F.md5(text_col))).alias("cls"))
    shared = F.coalesce("shared_chars", F.lit(0)).cast("bigint")
    return rows.join(merged, "cls", "left").select(
        id_col, "n_chars", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        shared.alias("shared_chars"), F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0)).alias("share"))


def _ranked_lines(df: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(id, v, line_no, start, size, digest, keep) of the lines of each record's texts; v: the text's digest."""
    lines = df.filter(df[text_col].isNotNull()).select(df[id_col].alias("id"), F.md5(df[text_col]).alias("v"), F.posexplode(F.split(df[text_col], "\n", -1)).alias("line_no", "line"))
    norm = F.lower(F.regexp_replace(F.trim("line"), "[ \\t]+", " "))
    # From here on only numbers and digests are shuffled; repeated rows fall together before a record's lines do.
    lines = lines.select("id", "v", "line_no", F.length("line").alias("size"), F.when(F.length("line") >= least, F.md5(norm)).alias("digest")).dropDuplicates(["id", "v", "line_no"])
    at = W.partitionBy("id", "v").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    lines = lines.withColumn("start", F.coalesce(F.sum(F.col("size") + 1).over(at), F.lit(0)).cast("int")).filter("digest IS NOT NULL")
    # The earliest of a digest is an aggregate with partial sums, so a digest that holds a third of all lines stays spread.
    own = F.struct("id", "v", "line_no")
    first = lines.groupBy("digest").agg(F.min(own).alias("f"))
    return lines.join(first, "digest").select("id", "v", "line_no", "start", "size", "digest", (own == F.col("f")).alias("keep"))


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 40) -> DataFrame:
    """(id_col, line_no, start, size, digest, keep): lines of at least `least` characters; all but the earliest of a digest have keep = false.

    A line is normalised for its digest (lower case, white space to one space); start and size are of the line as
    stored. Earliest is by id, then line number. Empty and null texts have no lines; repeated rows count once.
    """
    return _ranked_lines(df, id_col, text_col, least).drop("v").withColumnRenamed("id", id_col)


def left_over(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 40) -> DataFrame:
    """(id_col, n_removed, removed_chars, pieces array<struct<start,end,piece>>): each row's text without the lines that an earlier record or line has, with the offsets in the text as stored.

    A piece is a stretch between removed lines; the line break behind a removed line goes with it. A text whose lines all stay is
    one piece; null and empty texts have none. One row per row of `df`.
    """
    gone = _ranked_lines(df, id_col, text_col, least).filter("NOT keep").groupBy("id", "v").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("cuts"))
    rows = df.select(df[id_col].alias("id"), df[text_col].alias("t"), F.md5(df[text_col]).alias("v"))
    rows = rows.join(gone, ["id", "v"], "left").withColumn("cuts", F.coalesce("cuts", F.array().cast("array<struct<start:int,size:int>>")))
    n = F.length("t")
    first = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: F.least(c["start"] + c["size"] + 1, n)))
    last = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(n))
    cut = F.filter(F.zip_with(first, last, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda x: x["start"] < x["end"])
    pieces = F.transform(cut, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.substring(F.col("t"), x["start"] + 1, x["end"] - x["start"]).alias("piece")))
    removed = F.aggregate("cuts", F.lit(0), lambda acc, c: acc + c["size"])
    return rows.select(F.col("id").alias(id_col), F.size("cuts").alias("n_removed"), removed.alias("removed_chars"), F.when(n > 0, pieces).otherwise(F.array().cast("array<struct<start:int,end:int,piece:string>>")).alias("pieces"))
