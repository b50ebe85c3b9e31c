"""Near-duplicate records: an exact set-similarity join over prefixes of rare tokens and combinations of frequent ones.

A record is the set of its token sequences (`width` words; 1 for titles). All sets are read in one global order, made of
integers alone: sequences with a rare word, then the others by the sum of their words' frequency classes, then those that are
frequent themselves by their count. With threshold t a set of n misses at most n - ceil(2 t / (1 + t) n) of its members in a
partner of its size or larger, and n - ceil(t n) in any partner. Its indexing and its probing prefix hold `depth` members
more than that, so the smaller set's indexing prefix and the larger one's probing prefix share that many. A member of the rare
class is indexed by itself; of the frequent class only pairs (k = 2) are, made within buckets, for which the prefix is extended by one member a
bucket: shared members r of the rare and f of the frequent class in b buckets give r + max(0, f - b) shared entries at
least. The number of buckets follows the size of the set (`level`), so pairs grow in proportion to it; a set also probes
in the levels its smaller partners may have. Two sets are candidates if they share `depth` entries; candidates are verified over
their whole sets. The order decides only how much work there is: every statistic may be rough, the result stays exact, and nothing is capped.

The index is shuffled once, by entry. A group of more than HOT rows isn't paired where it lies but in a join of its own, which
is split over tasks, so no task holds an unbounded group. A sequence that stands SEQUENCE_LEAST times is of the frequent class,
however large the collection, so a single entry's group doesn't grow with it; only where more than MOST_LISTED sequences
stand so often, those that do twice as often are, and so on.

Defined results: null texts, texts below `min_words` and texts without words give no pair; identical texts (by a digest of 128 bits) are one
class, compared once and expanded at the end; a record with several rows counts with each of them, and never meets itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.staging import discard, stage

from .copies import expand

WORDS = regex.compile(r"\p{L}{3,}")
#: A word is frequent if it makes up this share of all words (so at most 2**17 are) and stands so often.
WORD_SHARE, WORD_LEAST = 2.0**-17, 200
#: A sequence is frequent if it stands so often; that is doubled until so many sequences are at most.
SEQUENCE_LEAST, MOST_LISTED = 64, 1 << 21
#: Rows of one entry that are paired where they lie, and rows a task holds before it looks for larger groups to pass on.
HOT, HELD = 4096, 8_000_000
#: Words that are worked on at once.
BATCH = 300_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = np.uint64((1 << 22) - 1)
_LISTED = 1 << 15  # the level from which members are of the frequent class


@dataclass(frozen=True)
class Field:
    """What makes two texts of a field alike."""

    width: int = 5
    threshold: float = 0.8
    min_words: int = 0


def words_of(text: str | None) -> list[str]:
    """The words as they stand; their case is dropped where they are hashed."""
    return WORDS.findall(text) if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _salt(k: int) -> np.uint64:
    return np.uint64((k * 0x9E3779B97F4A7C15 + 1) % (1 << 64))


class _Hashes(dict):
    """Word to the hash of its lower case; a new word is added as it is looked up."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.lower().encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# -- sets ---------------------------------------------------------------------------------------------------------------


def raw(words: np.ndarray, sizes: np.ndarray, width: int, salt: np.uint64 = np.uint64(0)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, sequence, place) of every sequence of texts of `sizes` words each, laid end to end."""
    n = len(words) - width + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = words[:n].copy()
    for j in range(1, width):
        total = total * _STEP + words[j : j + n]
    text = np.repeat(np.arange(len(sizes)), sizes)[:n]
    place = np.flatnonzero(np.arange(n) + width <= np.cumsum(sizes)[text])
    return text[place], _mix(total[place] + salt), place


def depth(n):
    """How many index entries two partners share at least, of sets of n."""
    return 1 + n // 24


def level(n):
    """Which number of buckets, 2**level, a set of n pairs its frequent members in: one for 8 to 16 members."""
    return np.maximum(np.floor(np.log2(np.maximum(n, 1) / 8 + 1e-12)), 0).astype(np.int64)


def _least(n, share: float):
    return np.ceil(share * n - 1e-9).astype(np.int64)


def tiny(threshold: float) -> int:
    """Sets up to this size may share too few members for pairs; their prefix is indexed by single members of either class."""
    sizes = np.arange(1, 4096)
    short = depth(sizes) + (1 << level(sizes)) > _least(sizes, 2 * threshold / (1 + threshold))
    return int(sizes[short].max(initial=0))


class Statistics:
    """What is known of all texts: frequency classes of words by hash slot, and the frequent sequences with their counts."""

    def __init__(self, words: dict[int, int], total: int, listed: dict[int, int] | tuple[np.ndarray, np.ndarray]) -> None:
        # Two words may share a slot: that makes a rare one pass for frequent, in every set alike, so the order stays one.
        self.words = np.zeros(int(_SLOTS) + 1, np.int16)
        for h, n in words.items():
            at = h & int(_SLOTS)
            self.words[at] = max(self.words[at], 1 + round(64 * math.log2(n / total / WORD_SHARE)))
        h, n = (np.array([*listed], np.uint64), np.array([*listed.values()], np.int64)) if isinstance(listed, dict) else listed
        order = np.argsort(h)
        self.listed, self.classes = h[order], np.minimum(np.log2(n[order]) * 512, _LISTED - 1).astype(np.int16)
        self.slots = max(_SLOTS, np.uint64((1 << (len(h).bit_length() + 3)) - 1))
        self.maybe = np.zeros(int(self.slots) + 1, bool)
        self.maybe[self.listed & self.slots] = True

    def levels(self, words: np.ndarray, sequences: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """The place of each sequence's class in the global order: 0 with a rare word, up to _LISTED by its words, from there by its count."""
        score = self.words[words & _SLOTS]
        sums = np.concatenate([[0], np.cumsum(score, dtype=np.int64)])
        rare = np.concatenate([[0], np.cumsum(score == 0, dtype=np.int64)])
        out = np.where(rare[place + width] > rare[place], 0, np.minimum(sums[place + width] - sums[place], _LISTED - 1))
        seen = np.flatnonzero(self.maybe[sequences & self.slots])
        if len(seen) and len(self.listed):
            at = np.minimum(np.searchsorted(self.listed, sequences[seen]), len(self.listed) - 1)
            hit = self.listed[at] == sequences[seen]
            out[seen[hit]] = _LISTED + self.classes[at[hit]].astype(np.int64)
        return out


def ordered(text: np.ndarray, sequences: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, sequence, level) of each text's distinct sequences, in the order of the texts and in each in the global order."""
    key = levels.astype(np.uint64) << np.uint64(48) | sequences >> np.uint64(16)
    order = np.argsort(key)
    order = order[np.argsort(text[order].astype(np.uint16) if len(text) and text[-1] < 65536 else text[order], kind="stable")]
    t, s, k = text[order], sequences[order], key[order]
    same = (t[1:] == t[:-1]) & (k[1:] == k[:-1])
    if np.any(same & (s[1:] != s[:-1])):  # two sequences with one key: equal ones may not stand side by side
        order = np.lexsort((sequences, key, text))
        t, s = text[order], sequences[order]
        same = (t[1:] == t[:-1]) & (s[1:] == s[:-1])
    keep = np.concatenate([np.ones(min(1, len(t)), bool), ~same])
    return t[keep], s[keep], levels[order][keep]


def entries(text: np.ndarray, member: np.ndarray, levels: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, text, size) of the sets of `ordered`: size is that of the set for entries of its indexing prefix, its negative beyond."""
    if not len(text):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = np.bincount(text)
    place = np.arange(len(text)) - (np.cumsum(n) - n)[text]
    frequent = levels >= _LISTED
    rare = np.bincount(text, weights=~frequent).astype(np.int64)
    short, long = (n - _least(n, share) + depth(n) for share in (2 * threshold / (1 + threshold), threshold))
    small = tiny(threshold)
    is_tiny, by_tiny = n <= small, n <= small / threshold
    single = np.flatnonzero((place < long[text]) & (~frequent | by_tiny[text]))
    indexing = (place[single] < short[text[single]]) & (~frequent[single] | is_tiny[text[single]])
    out = [member[single]]
    whose = [text[single]]
    size = [np.where(indexing, n[whose[0]], -n[whose[0]])]
    own, low = level(n), level(np.maximum(_least(n, threshold), 1))
    for back in range(int((own - low).max()) + 1):
        # back 0: the set's own level; above: levels of smaller partners, only probed.
        at = np.maximum(own - back, 0)
        takes_part = (own - back >= low) & ~is_tiny & (long > rare)
        limit = long + (1 << at)
        some = np.flatnonzero(takes_part[text] & frequent & (place < limit[text]))
        if not len(some):
            continue
        t = text[some]
        early = (place[some] < (short + (1 << at))[t]) & (short > rare)[t] & (back == 0)
        bucket = _mix(member[some]) & ((1 << at) - 1).astype(np.uint64)[t]
        group = (t.astype(np.uint64) << np.uint64(32)) | bucket
        by = np.argsort(group, kind="stable")
        group, keys, early, t = group[by], member[some][by], early[by], t[by]
        i, k = np.arange(len(group)), 1
        while True:
            i = i[i + k < len(group)]
            i = i[group[i] == group[i + k]]
            if not len(i):
                break
            out.append(_mix(_mix(keys[i] * _STEP + keys[i + k]) + (at[t[i]].astype(np.uint64) + np.uint64(1)) * _STEP))
            whose.append(t[i])
            size.append(np.where(early[i] & early[i + k], n[t[i]], -n[t[i]]))
            k += 1
    return np.concatenate(out), np.concatenate(whose), np.concatenate(size)


# -- pairs --------------------------------------------------------------------------------------------------------------


def meet(sig: np.ndarray, cls: np.ndarray, size: np.ndarray, least: np.ndarray | float) -> tuple[np.ndarray, ...]:
    """(a, b, n, hits), a < b: how many entries two sets share of which the smaller has `n` members and the entry in its indexing prefix."""
    found: list[tuple[np.ndarray, ...]] = []
    i, k = np.arange(len(sig)), 1
    while True:
        i = i[i + k < len(sig)]
        i = i[sig[i] == sig[i + k]]
        if not len(i):
            break
        j = i + k
        k += 1
        na, nb = np.abs(size[i]), np.abs(size[j])
        good = (cls[i] != cls[j]) & (np.minimum(na, nb) >= least * np.maximum(na, nb) - 1e-9) & (((size[i] > 0) & (na <= nb)) | ((size[j] > 0) & (nb <= na)))
        p, q = cls[i[good]], cls[j[good]]
        found.append((np.minimum(p, q), np.maximum(p, q), np.minimum(na, nb)[good], np.ones(len(p), np.int64)))
        if sum(len(x[0]) for x in found) > 4_000_000:
            found = [_summed(found)]
    return _summed(found)


def _summed(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    a, b, n, hits = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in found)]) for k in range(4))
    if not len(a):
        return a, b, n, hits
    order = np.lexsort((b, a))
    a, b, n, hits = a[order], b[order], n[order], hits[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[first], b[first], np.minimum.reduceat(n, first), np.add.reduceat(hits, first)


def _packed(column: pa.Array) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, their words, number of words of each) of a column of packed hashes, in parts of about BATCH words."""
    values = column.to_pylist()
    sizes = np.array([len(x) // 8 for x in values], np.int64)
    part = np.cumsum(sizes) // BATCH
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(values)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield slice(a, b), np.frombuffer(b"".join(values[a:b]), np.uint64), sizes[a:b]


def tokens(texts: DataFrame, fields: list[Field]) -> DataFrame:
    """Of rows (field, cls, text): (field, h, cls, words), the hashed words of each class that counts; h: its first 64 bits, with the field in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = _Hashes(), set()
        for batch in batches:
            rows: list[tuple[int, int, bytes, bytes]] = []
            for field, cls, text in zip(batch.column("field").to_pylist(), batch.column("cls").to_pylist(), batch.column("text").to_pylist()):
                if cls in seen:
                    continue
                seen.add(cls)
                words = words_of(text)
                if len(words) >= max(fields[field].width, fields[field].min_words, 1):
                    rows.append((field, int.from_bytes(cls[-8:], "little", signed=True) ^ field, cls, hashes.of(words).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int8(), pa.int64(), pa.binary(), pa.binary()))], names=["field", "h", "cls", "words"])

    return texts.select("field", "cls", "text").mapInArrow(run, "field tinyint, h bigint, cls binary, words binary")


def seen_twice(n, parts):
    """Of n places dealt to so many parts, how many lie in a part that has another of them."""
    return n * -np.expm1(-n / parts)


def statistics(tokens: DataFrame, fields: list[Field]) -> Statistics:
    """Counts over all texts. A part leaves out what it met once; `seen_twice` says what is left of a sequence's count then, of words as frequent as is asked for nearly all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {k: [] for k in range(len(fields))}
        size = 0

        def out() -> pa.RecordBatch:
            nonlocal size
            rows: list[tuple[np.ndarray, np.ndarray, int, int]] = []
            for field, parts in held.items():
                if not parts:
                    continue
                for kind in (1, 3):
                    if kind == 3 or fields[field].width > 1:
                        values = np.concatenate([p[kind // 2] for p in parts])
                        value, n = np.unique(values, return_counts=True)
                        rows.append((value[n > 1], n[n > 1], kind, field))
                        rows.append((np.zeros(1, np.uint64), np.array([len(values)]), kind - 1, field))
                rows.append((np.zeros(1, np.uint64), np.ones(1, np.int64), 4, field))
                parts.clear()
            size = 0
            keys, n = (np.concatenate([np.zeros(0, t), *(r[k] for r in rows)]) for k, t in enumerate((np.uint64, np.int64)))
            kind, field = (np.repeat(np.array([r[k] for r in rows], np.int8), [len(r[0]) for r in rows]) for k in (2, 3))
            return pa.RecordBatch.from_arrays([pa.array(field), pa.array(kind), pa.array(keys.view(np.int64)), pa.array(n)], names=["field", "kind", "h", "n"])

        for batch in batches:
            which = batch.column("field").to_numpy()
            for field in np.unique(which).tolist():
                for _, words, sizes in _packed(batch.column("words").filter(pa.array(which == field))):
                    held[field].append((words if fields[field].width > 1 else words[:0], raw(words, sizes, fields[field].width, _salt(field))[1]))
                    size += len(words)
            if size > 4_000_000:
                yield out()
        yield out()

    counted = tokens.select("field", "words").mapInArrow(count, "field tinyint, kind tinyint, h bigint, n bigint").groupBy("field", "kind", "h").agg(F.sum("n").alias("n"))
    counted = stage(counted.filter(F.col("n") >= F.when(F.col("kind") == 1, WORD_LEAST).when(F.col("kind") == 3, min(4, SEQUENCE_LEAST)).otherwise(0)), "dup-counts")
    totals = {(r["field"], r["kind"]): r["n"] for r in counted.filter("kind IN (0, 2, 4)").collect()}
    # By their share at most 2**17 words a field come back.
    often = F.lit(False)
    for (field, kind), n in totals.items():
        if kind == 0:
            often = often | ((F.col("field") == field) & (F.col("n") >= n * WORD_SHARE))
    words: dict[int, int] = {}
    for r in counted.filter("kind = 1").filter(often).toArrow().to_pylist():
        x = r["h"] % (1 << 64)
        words[x] = words.get(x, 0) + r["n"]
    total = max(1, sum(c for (_, k), c in totals.items() if k == 0))
    least = SEQUENCE_LEAST
    while True:
        often = F.lit(False)
        for (field, kind), parts in totals.items():
            if kind == 4:
                often = often | ((F.col("field") == field) & (F.col("n") >= float(seen_twice(least, parts))))
        sequences = counted.filter("kind = 3").filter(often)
        if sequences.count() <= MOST_LISTED:
            break
        least *= 2
    top = sequences.select("h", "n").toArrow()
    discard(counted)
    listed = (top.column("h").to_numpy().view(np.uint64), top.column("n").to_numpy())
    return Statistics({x: c for x, c in words.items() if c >= total * WORD_SHARE}, total, listed)


def similar_classes(held: DataFrame, fields: list[Field]) -> DataFrame:
    """Of staged `tokens`: (field, cls_a, cls_b, common, union) of the classes that are alike, cls_a < cls_b."""
    known = held.sparkSession.sparkContext.broadcast(statistics(held, fields))  # bounded by the shares

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = known.value
        for batch in batches:
            which = batch.column("field").to_numpy()
            for field in np.unique(which).tolist():
                rows = batch.filter(pa.array(which == field))
                h = rows.column("h").to_numpy()
                for at, words, sizes in _packed(rows.column("words")):
                    text, sequences, place = raw(words, sizes, fields[field].width, _salt(field))
                    sig, text, size = entries(*ordered(text, sequences, stats.levels(words, sequences, place, fields[field].width)), fields[field].threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(h[at][text]), pa.array(size.astype(np.int32))], names=["sig", "h", "size"])

    least = min(f.threshold for f in fields)

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        rows, seen_hot = 0, np.zeros(0, np.int64)

        def batch(hot: bool, *columns: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), hot)), *(pa.array(c.astype(np.int64)) for c in columns)], names=["hot", "a", "b", "n", "hits"])

        def grouped() -> tuple[np.ndarray, ...]:
            sig, cls, size = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in range(3))
            order = np.argsort(sig)
            s = sig[order]
            same = s[1:] == s[:-1]
            order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(s) else order
            order = order[np.lexsort((size[order], cls[order], sig[order]))]
            sig, cls, size = sig[order], cls[order], size[order]
            once = np.concatenate([np.ones(min(1, len(sig)), bool), (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1]) | (size[1:] != size[:-1])])
            return sig[once], cls[once], size[once]

        def large(sig: np.ndarray) -> np.ndarray:
            start = np.flatnonzero(np.concatenate([np.ones(min(1, len(sig)), bool), sig[1:] != sig[:-1]]))
            n = np.diff(np.append(start, len(sig)))
            return np.repeat(n > HOT, n)

        for b in batches:
            sig, cls, size = (b.column(c).to_numpy() for c in ("sig", "h", "size"))
            if len(seen_hot):
                at = np.isin(sig, seen_hot)
                if at.any():
                    yield batch(True, sig[at], cls[at], size[at], np.zeros(int(at.sum()), np.int64))
                    sig, cls, size = sig[~at], cls[~at], size[~at]
            parts.append((sig, cls, size))
            rows += len(sig)
            if rows > HELD:
                whole = tuple(np.concatenate([p[k] for p in parts]) for k in range(3))
                value, n = np.unique(whole[0], return_counts=True)
                seen_hot = np.union1d(seen_hot, value[n > HOT])
                at = np.isin(whole[0], seen_hot)
                yield batch(True, *(x[at] for x in whole), np.zeros(int(at.sum()), np.int64))
                parts = [tuple(x[~at] for x in whole)]
                rows = -int((~at).sum())  # looks again when as many have come as stay
        sig, cls, size = grouped()
        at = large(sig)
        yield batch(True, sig[at], cls[at], size[at], np.zeros(int(at.sum()), np.int64))
        yield batch(False, *meet(sig[~at], cls[~at], size[~at].astype(np.int64), least))

    indexed = held.select("field", "h", "words").mapInArrow(index, "sig bigint, h bigint, size int")
    met = stage(indexed.repartition("sig").mapInArrow(paired, "hot boolean, a bigint, b bigint, n bigint, hits bigint"), "dup-met")
    # Groups too large for one task: a join, whose skewed partitions are split.
    hot = met.filter("hot").select(F.col("a").alias("sig"), F.col("b").alias("h"), F.col("n").alias("size")).distinct()
    left = hot.filter("size > 0").select("sig", F.col("h").alias("h_a"), F.col("size").alias("n_a"))
    right = hot.select("sig", F.col("h").alias("h_b"), F.abs("size").alias("n_b"), (F.col("size") > 0).alias("i_b"))
    far = left.join(right, "sig").filter((F.col("h_a") != F.col("h_b")) & (F.col("n_a") >= least * F.col("n_b") - 1e-9) & ((F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (~F.col("i_b") | (F.col("h_a") < F.col("h_b")))))
    far = far.select(F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b"), F.col("n_a").alias("n"), F.lit(1).cast("bigint").alias("hits"))
    candidates = met.filter("NOT hot").select("a", "b", "n", "hits").unionByName(far).groupBy("a", "b").agg(F.sum("hits").alias("hits"), F.min("n").alias("n"))
    # Classes that share 64 bits are looked at too.
    doubled = held.groupBy("h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select(F.col("h").alias("a"), F.col("h").alias("b"))
    candidates = stage(candidates.filter(F.col("hits") >= depth_column("n")).select("a", "b").unionByName(doubled), "dup-candidates")
    discard(met)
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("h")).distinct()
    texts = stage(held.join(wanted, "h", "left_semi").groupBy("h", "cls").agg(F.first("field").alias("field"), F.first("words").alias("words")), "dup-texts")
    both = candidates.join(texts.select(F.col("h").alias("a"), F.col("cls").alias("cls_a"), "field", F.col("words").alias("words_a")), "a").join(
        texts.select(F.col("h").alias("b"), F.col("cls").alias("cls_b"), F.col("field").alias("field_b"), F.col("words").alias("words_b")), "b").filter((F.col("a") != F.col("b")) | (F.col("cls_a") < F.col("cls_b"))).filter("field = field_b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[tuple[int, bytes], np.ndarray] = {}
            out = []
            which = batch.column("field").to_pylist()
            for side in "ab":
                for f, c, words in zip(which, batch.column(f"cls_{side}").to_pylist(), batch.column(f"words_{side}").to_pylist()):
                    if (f, c) not in sets:
                        w = np.frombuffer(words, np.uint64)
                        sets[f, c] = np.unique(raw(w, np.array([len(w)]), fields[f].width)[1])
            for f, ca, cb in zip(which, batch.column("cls_a").to_pylist(), batch.column("cls_b").to_pylist()):
                a, b = sets[f, ca], sets[f, cb]
                common = len(np.intersect1d(a, b, assume_unique=True))
                union = len(a) + len(b) - common
                if common >= fields[f].threshold * union - 1e-9:
                    out.append((f, min(ca, cb), max(ca, cb), common, union))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int8(), pa.binary(), pa.binary(), pa.int32(), pa.int32()))], names=["field", "cls_a", "cls_b", "common", "union"])

    return both.select("field", "cls_a", "cls_b", "words_a", "words_b").mapInArrow(verify, "field tinyint, cls_a binary, cls_b binary, common int, union int")


def depth_column(n: str):
    return 1 + F.floor(F.col(n) / 24)


def class_members(parts: list[tuple[DataFrame, str, str, Field]]) -> tuple[DataFrame, DataFrame]:
    """Of fields, each (table, id column, text column, Field): members (field, id, cls) and staged `tokens`.

    A class is one text of one field that counts, its members are the records that have it.
    """
    rows = None
    for k, (df, id_col, text_col, _) in enumerate(parts):
        cls = F.concat(F.unhex(F.lit(f"{k:02x}")), F.unhex(F.md5(df[text_col])))
        one = df.filter(df[text_col].isNotNull()).select(F.lit(k).cast("tinyint").alias("field"), df[id_col].alias("id"), cls.alias("cls"), df[text_col].alias("text"))
        rows = one if rows is None else rows.unionByName(one)
    held = stage(tokens(rows, [p[3] for p in parts]), "dup-tokens")
    return rows.select("field", "id", "cls").distinct().join(held.select("cls").distinct(), "cls", "left_semi"), held


def similar_members(parts: list[tuple[DataFrame, str, str, Field]]) -> tuple[DataFrame, DataFrame]:
    """`class_members` and pairs of classes alike (field, cls_a, cls_b), for `copies`. Fields share every stage."""
    members, held = class_members(parts)
    return members, similar_classes(held, [p[3] for p in parts])


def similar_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "full_text", width: int = 5, threshold: float = 0.8, min_words: int = 0, **how) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: records of which at least `threshold` of the distinct sequences of `width` words in either stand in both."""
    return expand(*similar_members([(df, id_col, text_col, Field(width, threshold, min_words))]), **how).select("doc_a", "doc_b")


def components(edges: DataFrame, a: str = "doc_a", b: str = "doc_b") -> DataFrame:
    """(id, group_id, n_links) of every record in an edge: group_id is the least id of its connected component.

    Each round a record takes the least label of its neighbours and then the label's own label, so chains halve; only a
    count of changed labels reaches the driver.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = stage(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("g"), F.count("*").alias("n_links"))
    labels = stage(labels.withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), F.col("g").alias("h")), "b").groupBy("a").agg(F.min("h").alias("h"))
        step = labels.join(near, labels["id"] == near["a"]).select("id", F.least("g", "h").alias("g"), "n_links", F.col("g").alias("was"))
        jump = labels.select(F.col("id").alias("g"), F.col("g").alias("h"))
        step = stage(step.join(jump, "g").select("id", F.least("g", "h").alias("g"), "n_links", "was"), "labels")
        discard(labels)
        if step.filter("g <> was").isEmpty():
            return step.select("id", F.col("g").alias("group_id"), "n_links")
        labels = step.drop("was")
