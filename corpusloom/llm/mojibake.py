"""Text decoded with the wrong character encoding: found and restored with a character n-gram model.

A smoothed trigram model is trained on the words of clean records (all of whose characters belong to the alphabets of
the labelled samples or to plain typography). Every word with a character beyond ASCII is scored as it stands and
under every chain "encode with A, decode with B"; the likeliest is accepted if it beats the word as it stands by a
margin, which is validated on labelled samples held out: no clean sample word may reach it. Weak evidence adds up over the
different words of a record that one chain explains. Chains may nest, for text that was garbled twice.

Defined results: null and empty texts are not garbled; a replacement character (U+FFFD) marks a record as garbled
beyond repair at that place, and stays; ASCII is never changed; repeated rows are judged each for itself.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Encodings text was written in, and encodings it is read in by mistake.
WRITTEN = ("utf-8", "cp1252", "mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic")
READ = ("cp1252", "latin_1", "cp1251", "cp850", "cp437", "mac_roman", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic", "cp1250", "cp1254")
# Letters of the six languages and typography that clean text may hold beside the samples.
TYPOGRAPHY = "«»“”„’‘‚…—–‐♂♀°×ºª¿¡§±²³µ½¼·•†€№¬\xad\xa0"
LETTERS = "àâäæçèéêëîïôöœùûüÿñáíóúãõßńśżźćłøåý"

#: A clean word keeps to one script.
_MIXED = re.compile("[a-zà-ÿ][а-яё]|[а-яё][a-zà-ÿ]", re.IGNORECASE)
MARGIN = 10.0


def odd_words(text: str) -> list[str]:
    return [w for w in text.replace("\n", " ").split(" ") if not w.isascii()]


def clean_alphabet(samples: Iterable[str]) -> frozenset[str]:
    own = {c for s in samples for c in s}
    return frozenset(own | {f(c) for c in own | set(LETTERS) if c.isalpha() for f in (str.lower, str.upper)} | set(TYPOGRAPHY) | {chr(i) for i in range(128)})


def clean_pattern(alphabet: frozenset[str]) -> re.Pattern:
    """Matches texts of these characters alone, in a fraction of the time a set takes."""
    return re.compile("[" + re.escape("".join(sorted(c for c in alphabet if len(c) == 1))) + "]*")


#: Labelled text that is taken for training, in characters of each label; of more, a sample by hash.
MOST_SAMPLES = 2_000_000


def bounded_samples(df: DataFrame, label_col: str | None, text_col: str, most: int = MOST_SAMPLES) -> list[tuple[str | None, str]]:
    """(label, text) of labelled rows, about `most` characters of each label at most; the rows taken depend on their texts alone."""
    label = F.lit(None).cast("string") if label_col is None else df[label_col]
    rows = df.select(label.alias("label"), df[text_col].alias("text")).filter(F.length("text") > 0)
    sizes = rows.groupBy("label").agg(F.sum(F.length("text")).alias("n")).collect()
    keep = F.lit(True)
    for r in sizes:
        if r["n"] > most:
            keep = F.when(F.col("label").eqNullSafe(F.lit(r["label"])), F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < int(1_000_000 * most / r["n"])).otherwise(keep)
    found = rows.filter(keep) if any(r["n"] > most for r in sizes) else rows
    return sorted(((r["label"], r["text"]) for r in found.collect()), key=lambda x: (x[0] or "", x[1]))


class Model:
    """Trigrams over words, interpolated with bigrams, single characters and a uniform floor."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.three = counts
        self.two: dict[str, int] = defaultdict(int)
        self.pair: dict[str, int] = defaultdict(int)
        self.one: dict[str, int] = defaultdict(int)
        self.left: dict[str, int] = defaultdict(int)
        self.total = 0
        for g, n in counts.items():
            self.two[g[:2]] += n
            self.pair[g[1:]] += n
            self.left[g[1]] += n
            self.one[g[2]] += n
            self.total += n
        self.known: dict[str, float] = {}

    def _log(self, g: str) -> float:
        p = (self.one.get(g[2], 0) + 0.01) / (self.total + 1000)
        p = (self.pair.get(g[1:], 0) + 2 * p) / (self.left.get(g[1], 0) + 2)
        p = (self.three.get(g, 0) + 2 * p) / (self.two.get(g[:2], 0) + 2)
        self.known[g] = p = math.log(p)
        return p

    def score(self, word: str, floor: float = -math.inf) -> float:
        """The word's log likelihood; once it is below the floor, any number below it."""
        w, known, total = f"\0\0{word}\0", self.known, 0.0
        for i in range(len(word) + 1):
            g = w[i : i + 3]
            total += known[g] if g in known else self._log(g)
            if total < floor:
                return total
        return total


def trigrams(words: dict[str, int]) -> Counter[str]:
    out: Counter[str] = Counter()
    for word, n in words.items():
        w = f"\0\0{word}\0"
        for i in range(len(word) + 1):
            out[w[i : i + 3]] += n
    return out


def _table(name: str) -> dict[str, int]:
    """Character to byte; bytes without a character stand for themselves, as readers do."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    return out


_READERS: dict[str, dict[str, int]] = {}


def candidates(word: str) -> dict[str, list[str]]:
    """Every word another reading makes of this one, with all chains that do so."""
    if not _READERS:
        _READERS.update({r: _table(r) for r in READ})
    read_as: dict[bytes, list[str]] = {}
    for read, table in _READERS.items():
        try:
            read_as.setdefault(bytes([table[c] for c in word]), []).append(read)
        except KeyError:
            continue
    found: dict[str, list[str]] = {}
    mixed = _MIXED.search(word)
    for data, readers in read_as.items():
        for written in WRITTEN:
            try:
                fixed = data.decode(written)
            except UnicodeDecodeError:
                continue
            if fixed != word:
                found.setdefault(fixed, []).extend(f"{written}>{read}" for read in readers)
    return found if mixed else {fixed: chains for fixed, chains in found.items() if not _MIXED.search(fixed)}


class Restorer:
    def __init__(self, counts: dict[str, int], margin: float) -> None:
        self.model, self.margin = Model(counts), margin
        self.known: dict[str, tuple[tuple[float, tuple[str, ...], str], ...]] = {}

    def options(self, word: str) -> tuple[tuple[float, tuple[str, ...], str], ...]:
        """(gain, chains, restored), best first, of everything that makes a word likelier."""
        found = self.known.get(word)
        if found is None:
            own = self.model.score(word)
            found = ()
            if own < -2.0 * (len(word) + 1) and self._odd(word):
                found = tuple(sorted(
                    ((gain, tuple(sorted(chains)), fixed) for fixed, chains in candidates(word).items() if (gain := self.model.score(fixed, own + 0.5) - own) > 0.5), key=lambda x: (-x[0], x[1])))
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = found
        return found

    def _odd(self, word: str) -> bool:
        """Any character that is unlikely where it stands; a word without one can't gain the margin."""
        w = f"\0\0{word}\0"
        known, model = self.model.known, self.model
        return any((known[g] if g in known else model._log(g)) < -5.5 for i in range(len(word) + 1) for g in (w[i : i + 3],))

    def chains(self, words: list[str]) -> dict[str, float]:
        """Chains that explain a record's different words beyond the margin; a word counts for every chain that makes it likelier."""
        sums: dict[str, float] = defaultdict(float)
        for word in set(words):
            for gain, chains, _ in self.options(word):
                for chain in chains:
                    sums[chain] += gain
        return {c: g for c, g in sums.items() if g >= self.margin}

    def restore(self, text: str) -> tuple[str, list[str], int]:
        """(text, chains used, words changed). Repeated, for text garbled several times, until nothing changes; every change makes a word likelier, so that ends."""
        used: Counter[str] = Counter()
        while True:
            words = odd_words(text)
            chains = self.chains(words)
            changes = {}
            for word in set(words):
                options = [(gain, max((chains[c], c) for c in own if c in chains), fixed) for gain, own, fixed in self.options(word) if any(c in chains for c in own)]
                if options and options[0][0] > 1.0:
                    _, (_, chain), changes[word] = max(options)
                    used[chain] += 1
            if not changes:
                return text, sorted(used), sum(used.values())
            text = "\n".join(" ".join(changes.get(w, w) for w in line.split(" ")) for line in text.split("\n"))


def validated_margin(counts: dict[str, int], samples: list[str], least: float = MARGIN) -> float:
    """Above every gain of a clean sample word under a model that wasn't trained on its sample: either half is held out in turn."""
    gains = [0.0]
    for k in range(2):
        own = Counter(counts)
        own.update(trigrams(Counter(w for s in samples[k::2] for w in odd_words(s))))
        restorer = Restorer(own, least)
        gains += [o[0] for s in samples[1 - k :: 2] for w in odd_words(s) for o in restorer.options(w)[:1]]
    return max(least, 1.25 * max(gains))


def count_clean(text: str | None, clean: re.Pattern, words: Counter[str]) -> None:
    """Adds the words beyond ASCII of a clean text."""
    if text and not text.isascii() and clean.fullmatch(text):
        words.update(odd_words(text))


def clean_trigrams(words: Counter[str]) -> Counter[str]:
    return trigrams({w: n for w, n in words.items() if not _MIXED.search(w)})


def train(texts: DataFrame, samples: list[str], text_col: str) -> tuple[dict[str, int], float]:
    """(trigram counts of all clean records, margin)."""
    return trained(corpus_trigrams(texts, samples, text_col), samples)


def train_on_all(texts: DataFrame, text_col: str, samples: DataFrame, sample_col: str) -> tuple[dict[str, int], float]:
    """`train` on a table of labelled texts of any size, all of which count."""
    characters, halves = labelled_trigrams(samples, sample_col)
    counts = corpus_trigrams(texts, [characters], text_col)
    margin = margin_of_all(samples, sample_col, counts, halves)
    return dict(Counter(counts) + Counter(halves[0]) + Counter(halves[1])), margin


def corpus_trigrams(texts: DataFrame, samples: list[str], text_col: str) -> dict[str, int]:
    """Trigram counts of all clean records. Words are counted where they lie; only trigrams are shuffled."""
    clean = clean_pattern(clean_alphabet(samples))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                count_clean(text, clean, words)
        grams = clean_trigrams(words)
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], names=["g", "n"])

    # Clean words are of the alphabet, so the number of different trigrams is bounded by it, whatever the size of the corpus.
    rows = texts.select(text_col).mapInArrow(count, "g string, n bigint").groupBy("g").agg(F.sum("n").alias("n")).collect()
    return {r["g"]: r["n"] for r in rows}


def trained(counts: dict[str, int], samples: list[str]) -> tuple[dict[str, int], float]:
    """(trigram counts with those of the samples, margin) of the trigram counts of all clean records."""
    counts = dict(counts)
    margin = validated_margin(counts, samples)
    for g, n in trigrams(Counter(w for s in samples for w in odd_words(s))).items():
        counts[g] = counts.get(g, 0) + n
    return counts, margin


def _half(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) & 1


def labelled_trigrams(samples: DataFrame, sample_col: str) -> tuple[str, list[dict[str, int]]]:
    """(characters, trigram counts of either half) of all labelled texts, however many; a text's half follows from its hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters: set[str] = set()
        halves: list[Counter[str]] = [Counter(), Counter()]
        for batch in batches:
            for text in filter(None, batch.column(0).to_pylist()):
                characters.update(text)
                halves[_half(text)].update(trigrams(Counter(odd_words(text))))
        rows = [(k, g, n) for k, grams in enumerate(halves) for g, n in grams.items()] + [(2, c, 1) for c in characters]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int8(), pa.string(), pa.int64()))], names=["half", "g", "n"])

    # As in train: bounded by the characters there are.
    rows = samples.select(sample_col).mapInArrow(count, "half tinyint, g string, n bigint").groupBy("half", "g").agg(F.sum("n").alias("n")).collect()
    return "".join(sorted(r["g"] for r in rows if r["half"] == 2)), [{r["g"]: r["n"] for r in rows if r["half"] == k} for k in range(2)]


def margin_of_all(samples: DataFrame, sample_col: str, counts: dict[str, int], halves: list[dict[str, int]], least: float = MARGIN) -> float:
    """`validated_margin` over all labelled texts where they lie: each is judged by the model of the half it isn't in."""
    shared = Shared(samples.sparkSession, [dict(Counter(counts) + Counter(half)) for half in halves])

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorers = [Restorer(own, least) for own in shared.value]
        most = 0.0
        for batch in batches:
            for text in filter(None, batch.column(0).to_pylist()):
                most = max([most, *(o[0] for w in odd_words(text) for o in restorers[1 - _half(text)].options(w)[:1])])
        yield pa.RecordBatch.from_arrays([pa.array([most])], names=["gain"])

    most = samples.select(sample_col).mapInArrow(gains, "gain double").agg(F.max("gain")).first()[0]
    return max(least, 1.25 * (most or 0.0))


_restorers: dict[str, Restorer] = {}


def restorer_of(shared) -> Restorer:
    """The worker's restorer for a broadcast (counts, margin)."""
    if shared.id not in _restorers:
        _restorers.clear()
        _restorers[shared.id] = Restorer(*shared.value)
    return _restorers[shared.id]


class Shared:
    """A broadcast with a name of its own, so a worker builds its model once."""

    def __init__(self, spark, value) -> None:
        self.broadcast = spark.sparkContext.broadcast(value)
        self.id = uuid.uuid4().hex

    @property
    def value(self):
        return self.broadcast.value


def restore(df: DataFrame, samples: DataFrame, text_col: str = "full_text", sample_col: str = "sample", keep_text: bool = True) -> DataFrame:
    """All columns of `df` and garbled (boolean), chains (array<string>), words_changed (int) and, if wanted, restored (string)."""
    shared = Shared(df.sparkSession, train_on_all(df, text_col, samples, sample_col))

    kind = "struct<garbled:boolean,chains:array<string>,words_changed:int,restored:string>"

    @F.pandas_udf(kind)
    def judge(texts: pd.Series) -> pd.DataFrame:
        r = restorer_of(shared)
        out = []
        for text in texts:
            if text is None or text.isascii():
                out.append((False, [], 0, text if keep_text else None))
                continue
            fixed, chains, n = r.restore(text) if r.chains(odd_words(text)) else (text, [], 0)
            out.append((n > 0 or "�" in text, chains, n, fixed if keep_text else None))
        return pd.DataFrame(out, columns=["garbled", "chains", "words_changed", "restored"])

    made = ["garbled", "chains", "words_changed", *["restored"] * keep_text]
    kept = [c for c in df.columns if c not in made]
    judged = df.select(*kept, judge.asNondeterministic()(df[text_col]).alias("__j"))
    return judged.select(*kept, *(F.col(f"__j.{c}").alias(c) for c in made))
