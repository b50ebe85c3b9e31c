"""Best alignment of a short string inside a longer one, 0 to 100."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def _common(masks: dict[str, int], size: int, text: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the pattern whose masks are given."""
    full = (1 << size) - 1
    state = full
    for c in text:
        hit = state & masks.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


class _Counts:
    """How often each character stands before each place of a text; counted as it is first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.known: dict[str, np.ndarray] = {}

    def of(self, c: str) -> np.ndarray:
        found = self.known.get(c)
        if found is None:
            found = np.zeros(len(self.codes) + 1, np.int32)
            np.cumsum(self.codes == ord(c), out=found[1:])
            self.known[c] = found
        return found


def _slide(short: str, long: _Counts, cutoff: float) -> float:
    """Windows of the pattern's size, and shorter ones at either end, in the order of what their letters alone allow."""
    m, n = len(short), len(long.text)
    masks: dict[str, int] = {}
    for i, c in enumerate(short):
        masks[c] = masks.get(c, 0) | 1 << i
    # Windows end at 1 .. n + m - 1: shorter than the pattern, whole ones, shorter again.
    shared = np.zeros(n + m - 1, np.int32)
    for c, mask in masks.items():
        seen, most = long.of(c), mask.bit_count()
        if seen[n]:
            shared[: m - 1] += np.minimum(seen[1:m], most)
            shared[m - 1 : n] += np.minimum(seen[m:] - seen[: n - m + 1], most)
            shared[n:] += np.minimum(seen[n] - seen[n - m + 1 : n], most)
    size = np.minimum(np.minimum(np.arange(1, n + m), m), np.arange(n + m - 1, 0, -1))
    bound = 200.0 * shared / (m + size)
    least = max(cutoff, 1e-9)
    order = np.flatnonzero(bound >= least)
    best = 0.0
    for i in order[np.argsort(-bound[order], kind="stable")].tolist():
        if bound[i] <= best:
            break
        a = max(i + 1 - m, 0)
        b = min(i + 1, n)
        best = max(best, 200.0 * _common(masks, m, long.text[a:b]) / (m + b - a))
    return float(best)


def partial_ratio(a: str | None, b: str | None, cutoff: float = 0.0, counts: _Counts | None = None) -> float | None:
    """100 * 2 * common / (lengths) of the best window; 0 below the cutoff. Two empty strings are alike, one is not. counts: those of b, if it is compared often."""
    if a is None or b is None:
        return None
    if not a or not b:
        return 100.0 if a == b else 0.0
    if (a if len(a) <= len(b) else b) in (b if len(a) <= len(b) else a):
        return 100.0
    if cutoff >= 100:
        return 0.0
    best = 0.0
    if len(a) <= len(b):
        best = _slide(a, counts or _Counts(b), cutoff)
    if len(b) <= len(a):
        best = max(best, _slide(b, _Counts(a), cutoff))
    return best if best >= cutoff else 0.0


def partial_ratios_udf(cutoff: float = 0.0):
    """(text, array of strings) to an array of scores; a null string has none."""

    @F.pandas_udf("array<double>")
    def scores(texts: pd.Series, captions: pd.Series) -> pd.Series:
        out = []
        for x, cs in zip(texts, captions):
            counts = _Counts(x) if x and cs is not None else None
            out.append(None if cs is None else [partial_ratio(c, x, cutoff, counts) for c in cs])
        return pd.Series(out)

    return scores
