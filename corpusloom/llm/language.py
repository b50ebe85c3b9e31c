"""Language of texts and of their stretches by cross-parsing against labelled samples.

For each language a suffix automaton of its samples is laid out as a table. A sentence is parsed greedily into the longest
phrases that stand somewhere in the samples. A phrase of one language weighs the logarithm of the size of its samples (more text gives longer
phrases), as in the entropy that cross-parsing estimates; the language that needs the fewest phrases so weighed wins. Over a text
the sentences' phrase counts are joined by dynamic programming with a price for each change of language, which
settles short and name-ridden sentences by their neighbours. Quotations and long parentheses are skipped. Batches of sentences are parsed side by
side, one character of each at a time, in all languages at once.

Defined results: null, empty and blank texts have no segment; texts without letters of any sample have confidence 0;
ties go to the language first in the order of its code; a garbled text is restored before it is parsed, and
offsets then refer to the restored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import mojibake

#: Price of a change of language between neighbouring sentences, in phrases.
SWITCH = 4.0
LEAST_RUN = 120
#: Longer sentences are parsed in parts of this many characters.
PART = 400
#: A run counts if its best language needs at most 1 - LEAST_CONFIDENCE of the phrases of the next. Of labelled sentences held out, put together
#: to runs of LEAST_RUN characters, a twentieth has less; runs of names and figures alone have less as well.
LEAST_CONFIDENCE = 0.38
_BATCH_CHARS = 2_000_000

_SENTENCE = re.compile(r"(?<=[.!?…])[\"»”’)\]]*\s+(?=[\"«“„(\[¿¡]*[^\W\d_a-zà-öø-ÿа-яё])|\s*\n\s*\n\s*|\n?\[[^\]\n]{1,60}\]\n")
# Abbreviations of collectors, figures and ranks; a single letter is an initial.
_SHORT = re.compile(r"(?:^|[\s(\[])(?:leg|det|coll|cf|vgl|ver|voir|fig|figs|abb|taf|pl|см|рис|sp|spp|nov|ca|no|nr|pp|(?-i:[A-ZÀ-ÞА-ЯЁ]))\.$", re.IGNORECASE)
_QUOTE = re.compile(r"\([^()]{20,300}\)|«[^«»]{8,300}»|“[^“”]{8,300}”|„[^„“”]{8,300}[“”]|(?<!\w)\"[^\"]{8,300}\"(?!\w)")


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    to: list[dict[int, int]] = [{}]
    link, size = [-1], [0]
    last = 0
    for c in text:
        cur = len(to)
        to.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in to[p]:
            to[p][c] = cur
            p = link[p]
        if p >= 0:
            q = to[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                twin = len(to)
                to.append(dict(to[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and to[p].get(c) == q:
                    to[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return to


class Parser:
    """All languages' automata in one table: entry = 2 * next state + (1 if a phrase ends before this character)."""

    SPACE, SKIP, OTHER = 0, 1, 2

    def __init__(self, samples: dict[str, list[str]]) -> None:
        self.langs = sorted(samples)
        letters = sorted({c for texts in samples.values() for t in texts for c in t.lower() if not c.isspace() and not c.isdigit()})
        self.width = len(letters) + 4
        self.classes = np.full(65536, self.OTHER, np.uint8 if self.width < 256 else np.uint16)
        for k, c in enumerate(letters):
            if ord(c) < 65536:
                self.classes[ord(c)] = k + 4
        for i in range(65536):
            c = chr(i)
            if c.isspace():
                self.classes[i] = self.SPACE
            elif c.isdigit():
                self.classes[i] = 3
            elif (low := c.lower()) != c and len(low) == 1 and ord(low) < 65536:
                self.classes[i] = self.classes[ord(low)]
        self.letter = np.zeros(self.width, bool)
        self.letter[4:] = [c.isalpha() for c in letters]
        tables, starts, base = [], [], 0
        for lang in self.langs:
            codes: list[int] = []
            for t in samples[lang]:
                codes += [*self.codes(f" {t} ").tolist(), -1]  # -1 keeps phrases within a sample
            to = suffix_automaton(codes)
            n = len(to)
            root = np.full(self.width, base * 2 + 1, np.int32)  # an unknown character is a phrase of its own
            for c, s in to[0].items():
                if c >= 0:
                    root[c] = (base + s) * 2 + 1
            table = np.tile(root, (n, 1))
            for s, out in enumerate(to):
                for c, s2 in out.items():
                    if c >= 0:
                        table[s, c] = (base + s2) * 2 + (s == 0)
            table[:, self.SKIP] = base * 2
            tables.append(table)
            starts.append(base)
            base += n
        self.table = np.concatenate(tables).ravel()
        sizes = np.log2([max(2, sum(map(len, samples[lang]))) for lang in self.langs] or [2])
        self.weights = sizes / sizes.mean()
        self.starts = np.array(starts, np.int32)

    def codes(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.classes[np.minimum(points, 65535)]

    def phrases(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(languages, stretches): phrases of each stretch in each language."""
        order = np.argsort(-sizes, kind="stable")
        begin, size = starts[order], sizes[order]
        m, width = len(order), self.width
        counts = np.zeros((len(self.langs), m), np.int32)
        state = np.repeat(self.starts[:, None], m, axis=1)
        longest = int(size[0]) if m else 0
        live = np.searchsorted(-size, -np.arange(longest), side="left")  # how many are longer than j
        for j in range(longest):
            k = live[j]
            entry = self.table.take(state[:, :k] * width + codes[begin[:k] + j])
            counts[:, :k] += entry & 1
            state[:, :k] = entry >> 1
        out = np.empty_like(counts)
        out[:, order] = counts
        return out


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences; blank lines and page markers end one too, and long ones are cut."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        if text[m.start() - 1 : m.start()] == "." and _SHORT.search(text[max(0, m.start() - 6) : m.start()]):
            continue
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    if any(b - a > PART for a, b in out):
        out = [part for a, b in out for part in _parts(text, a, b)]
    return out


def _parts(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """A long sentence in parts of at most PART characters, cut at a blank if there is one in the second half of a part."""
    out = []
    while b - a > PART:
        cut = text.rfind(" ", a + PART // 2, a + PART)
        cut = a + PART if cut < 0 else cut
        out.append((a, cut))
        a = cut
    return [*out, (a, b)]


def _decode(costs: np.ndarray, first: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """The cheapest language of each sentence, over texts of sizes[t] sentences from first[t]; costs: (sentences, languages)."""
    order = np.argsort(-sizes, kind="stable")
    begin, size = first[order], sizes[order]
    n = costs.shape[1]
    back = np.zeros(costs.shape, np.int8)
    longest = int(size[0]) if len(size) else 0
    live = np.searchsorted(-size, -np.arange(longest), side="left")
    total = costs[begin].copy() if longest else costs[:0]
    own = np.arange(n, dtype=np.int8)
    for j in range(1, longest):
        k = live[j]
        prev = total[:k]
        best = prev.argmin(axis=1)
        least = prev[np.arange(k), best][:, None] + switch
        stay = prev <= least
        back[begin[:k] + j] = np.where(stay, own, best[:, None])
        total[:k] = np.where(stay, prev, least) + costs[begin[:k] + j]
    out = np.zeros(len(costs), np.int8)
    now = total.argmin(axis=1) if longest else np.zeros(0, int)
    for j in range(longest - 1, -1, -1):
        k = live[j]
        out[begin[:k] + j] = now[:k]
        if j:
            now[:k] = back[begin[:k] + j, now[:k]]
    return out


def segment(parser: Parser, texts: list[str], switch: float = SWITCH) -> list[np.ndarray]:
    """For runs of one language in the texts: text number, start, end, language number, confidence * 1e6 (one array each)."""
    bounds = [sentences(t) for t in texts]
    sizes = np.array([len(b) for b in bounds], np.int64)
    if not sizes.sum():
        return [np.zeros(0, np.int64)] * 5
    codes = parser.codes("".join(texts))
    offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for t, text in enumerate(texts):
        for m in _QUOTE.finditer(text):
            codes[offset[t] + m.start() : offset[t] + m.end()] = parser.SKIP
    spans = np.array([ab for b in bounds for ab in b], np.int64).reshape(-1, 2)
    of = np.repeat(np.arange(len(texts)), sizes)
    start = spans[:, 0] + offset[of]
    costs = parser.phrases(codes, start, spans[:, 1] - spans[:, 0]).T * parser.weights
    lang = _decode(costs, np.concatenate([[0], np.cumsum(sizes)[:-1]])[sizes > 0], sizes[sizes > 0], switch)
    edge = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (lang[1:] != lang[:-1])]))
    sums = np.add.reduceat(costs, edge, axis=0)
    own = sums[np.arange(len(edge)), lang[edge]]
    rest = sums.copy()
    rest[np.arange(len(edge)), lang[edge]] = np.inf
    second = rest.min(axis=1)
    confidence = np.clip(1 - own / np.maximum(second, 1e-9), 0, 1)
    last = np.concatenate([edge[1:], [len(of)]]) - 1
    return [of[edge], spans[edge, 0], spans[last, 1], lang[edge].astype(np.int64), np.round(confidence * 1e6).astype(np.int64)]


_parsers: dict[str, Parser] = {}


def segments(df: DataFrame, refs: DataFrame, text_col: str = "text", repair: mojibake.Shared | None = None, alphabet: frozenset[str] | None = None, most_samples: int = mojibake.MOST_SAMPLES) -> DataFrame:
    """Other columns of `df` and start, end, language, confidence: one row per stretch of one language. No shuffle.

    refs: (lang, sample), of which about `most_samples` characters a language are taken; the automata made of them are
    as large, which bounds what is broadcast.
    """
    samples: dict[str, list[str]] = {}
    for lang, text in mojibake.bounded_samples(refs, "lang", "sample", most_samples):
        if lang:
            samples.setdefault(lang, []).append(text)
    shared = mojibake.Shared(df.sparkSession, samples)
    clean = mojibake.clean_pattern(alphabet) if alphabet else None
    made = ("start", "end", "language", "confidence")
    kept = [c for c in df.columns if c not in made and c != text_col]
    fields = [df.schema[c] for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.id not in _parsers:
            _parsers.clear()
            _parsers[shared.id] = Parser(shared.value)
        parser = _parsers[shared.id]
        restorer = mojibake.restorer_of(repair) if repair else None

        def ready(text: str | None) -> str:
            if restorer and text and clean and not clean.fullmatch(text) and restorer.chains(mojibake.odd_words(text)):
                return restorer.restore(text)[0]
            return text or ""

        for batch in batches:
            texts = list(map(ready, batch.column("__text").to_pylist()))
            a = 0
            while a < len(texts):
                b, size = a, 0
                while b < len(texts) and (b == a or size + len(texts[b]) <= _BATCH_CHARS):
                    size += len(texts[b])
                    b += 1
                of, start, end, lang, sure = segment(parser, texts[a:b])
                if len(of):
                    rows = batch.select(kept).take(pa.array(of + a))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array([parser.langs[x] for x in lang], pa.string()), pa.array(sure / 1e6)],
                        names=[*kept, *made])
                a = b

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "start int, end int, language string, confidence double"])
    return df.select(*kept, df[text_col].alias("__text")).mapInArrow(run, schema)


def languages_of(df: DataFrame, refs: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """One row per row with a text: language with the most characters, its confidence there, and all stretches."""
    keys = [c for c in df.columns if c != text_col]
    found = segments(df.withColumn("__row", F.monotonically_increasing_id()), refs, text_col, **how)
    per = found.groupBy("__row", *keys, "language").agg(F.sum(F.col("end") - F.col("start")).alias("size"), F.max("confidence").alias("confidence"))
    return per.groupBy("__row", *keys).agg(
        F.max_by("language", F.struct("size", "confidence", "language")).alias("language"), F.max_by("confidence", F.struct("size", "confidence", "language")).alias("confidence"),
        F.sort_array(F.collect_set("language")).alias("languages")).drop("__row")


def named(label, refs: DataFrame):
    """The language a label names: its `lang` or `code3` without case, outer blanks and what follows - or _; else null."""
    core = F.regexp_replace(F.lower(F.regexp_replace(label, r"^\s+|\s+$", "")), "[-_].*$", "")
    codes = {k: r["lang"] for r in refs.select("lang", "code3").distinct().collect() for k in (r["lang"], r["code3"]) if k}
    pairs = [F.lit(x) for k, v in sorted(codes.items()) for x in (k, v)]
    return F.try_element_at(F.create_map(*pairs), core) if pairs else F.lit(None).cast("string")
