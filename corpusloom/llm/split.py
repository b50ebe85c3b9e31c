"""Splitting oversized texts at natural boundaries by agglomerative merging.

Defined results: a null text gives no piece; an empty text gives one empty piece; a text within the limit gives
itself; a text without white space is cut at the limit. Repeated rows are split each for itself. A column named as
an output column is replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1200, 120

_ATOM = re.compile(r"\s*\S+")
_STOP = re.compile(r"[.!?…][)\]\"'»”’]*\Z")
_OPENER = re.compile(r"[\"'«“„(\[¿¡]*[^\W_]")
HARD, WORD, LINE, SENTENCE, PARAGRAPH = range(5)


def _atoms(text: str, most: int) -> tuple[list[int], list[int]]:
    """Ends of the atomic segments, and the strength of the boundary behind each."""
    ends: list[int] = []
    strengths: list[int] = []
    start, before = 0, ""
    for m in _ATOM.finditer(text):
        piece = m.group()
        word = piece.lstrip()
        if ends:
            gap = piece[: len(piece) - len(word)]
            breaks = gap.count("\n")
            first = _OPENER.match(word)
            stop = _STOP.search(before) is not None and (first is None or not first.group()[-1].islower())
            strengths[-1] = PARAGRAPH if breaks > 1 else SENTENCE if stop else LINE if breaks else WORD
        for cut in range(start + most, m.end(), most):
            ends.append(cut)
            strengths.append(HARD)
        start = m.end()
        ends.append(start)
        strengths.append(HARD)
        before = word[-6:]
    if start < len(text):  # white space at the end stays with the last word as far as it fits
        at = ends[-2] if len(ends) > 1 else 0
        if ends and len(text) - at <= most:
            ends[-1] = len(text)
        else:
            for cut in [*range(start + most, len(text), most), len(text)]:
                ends.append(cut)
                strengths.append(HARD)
    return ends, strengths


def boundaries(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of each piece; start lies `overlap` characters before the end of the piece before.

    Starts from words; the pair of neighbours over the weakest boundary (then the smallest) is merged first, while
    the merged segment and its overlap fit the limit.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and less than limit")
    if len(text) <= limit:
        return [(0, len(text))]
    most = limit - overlap
    ends, strengths = _atoms(text, most)
    n = len(ends)
    starts = [0, *ends[:-1]]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    # The first piece must be long enough to lend the second its overlap.
    while ends[0] < overlap and after[0] < n:
        j = after[0]
        ends[0], after[0], strengths[0], alive[j] = ends[j], after[j], strengths[j], False
        if after[0] < n:
            before[after[0]] = 0
    heap = []
    i = 0
    while after[i] < n:
        heap.append((strengths[i], ends[after[i]] - starts[i], i, after[i]))
        i = after[i]
    heapq.heapify(heap)
    while heap:
        _, size, i, j = heapq.heappop(heap)
        if not (alive[i] and after[i] == j and ends[j] - starts[i] == size):
            continue
        if size > (limit if starts[i] == 0 else most):
            continue  # sizes only grow: this pair never fits
        ends[i], strengths[i], after[i], alive[j] = ends[j], strengths[j], after[j], False
        if after[i] < n:
            before[after[i]] = i
            heapq.heappush(heap, (strengths[i], ends[after[i]] - starts[i], i, after[i]))
        if before[i] >= 0:
            h = before[i]
            heapq.heappush(heap, (strengths[h], ends[i] - starts[h], h, i))
    out, i = [], 0
    while i < n:
        out.append((max(0, starts[i] - overlap) if i else 0, ends[i]))
        i = after[i]
    return out


_PIECES = "array<struct<piece_idx:int,start:int,end:int,piece:string>>"


def split_oversized(df: DataFrame, text_col: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row per piece: all columns of `df` and piece_idx, start, end (code points), piece, n_pieces.

    Only texts over the limit leave the JVM; nothing is shuffled.
    """

    @F.pandas_udf(_PIECES)
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([
                None if t is None else [
                    {"piece_idx": k, "start": a, "end": b, "piece": t[a:b]} for k, (a, b) in enumerate(boundaries(t, limit, overlap))
                ]
                for t in batch
            ], dtype=object)

    text = df[text_col]
    size = F.length(text)
    whole = F.when(text.isNotNull(), F.array(F.struct(
        F.lit(0).alias("piece_idx"), F.lit(0).alias("start"), size.alias("end"), text.alias("piece"))))
    made = ("piece_idx", "start", "end", "piece", "n_pieces")
    kept = [df[c] for c in df.columns if c not in made]
    pieces = df.select(*kept, F.coalesce(cut.asNondeterministic()(F.when(size > limit, text)), whole).alias("__pieces"))
    return (
        pieces.withColumn("n_pieces", F.size("__pieces"))
        .withColumn("__p", F.explode("__pieces"))
        .select(*(c for c in df.columns if c not in made), "__p.*", "n_pieces")
    )
