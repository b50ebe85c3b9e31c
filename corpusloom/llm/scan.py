"""Noise in text from scanned pages: found and repaired into continuous paragraphs.

1. Corpus statistics: how often each word stands, and how often each short line stands at the edge of a page. A short line
   that stands (nearly) always at an edge, several times over, is a running header, and so is a line of a number (by its
   shape); headings stand anywhere. In a document, a short line at the edges of several pages that is no heading of the corpus is a
   running header, and numbers at the edges that grow as the pages do are page numbers. Pages are peeled from either end.
2. Running headers and page numbers are taken out, so that a word or sentence broken by a page runs on.
3. A decoder reads doubtful stretches (words broken at a line's end, words that look like a misread of a far more frequent
   one, neighbouring unknown fragments) as a character stream without lines: a path through a trie of the corpus's
   words may pass over hyphens and blanks (merges), start a word without a blank (splits) and read one group of
   characters for another (confusions), three such operations a word at most; unknown words have a price by length. The cheapest path is the text as printed.
4. Paragraph boundaries are chosen by dynamic programming over the lines.

Defined results: null texts stay null and empty ones empty, neither is noisy; page markers stay; names, numbers, codes in brackets and
headings are no candidates, since no frequent word lies within a misreading of them; repeated rows are repaired each for itself.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.staging import discard, stage

from . import mojibake

#: A record is noisy if its evidence comes to this many places.
LEAST_EVIDENCE = 3
#: Words kept of the corpus: so often at least, and this share of all words, so a million at most (natural text has about a tenth of that).
WORD_LEAST, WORD_SHARE = 8, 1e-6
#: When a line is a header of the corpus: share of its places at an edge; places; share of all lines that may be one, so 2**17 at
#: most. Rarer running headers are found in their own document, where they stand on several pages.
EDGE_SHARE, EDGE_LEAST, LINE_SHARE = 0.97, 3, 2.0**-17

# Groups of characters that a reader of scanned pages takes for each other (read, printed).
CONFUSIONS = (
    ("0", "o"), ("0", "O"), ("1", "l"), ("1", "i"), ("1", "I"), ("5", "s"), ("5", "S"), ("6", "b"), ("9", "g"), ("8", "B"), ("@", "a"), ("|", "l"), ("|", "i"), ("|", "t"),
    ("4", "A"), ("3", "e"), ("rn", "m"), ("m", "rn"), ("li", "h"), ("h", "li"), ("ii", "u"), ("u", "ii"), ("cl", "d"), ("d", "cl"), ("c", "e"), ("e", "c"),
    ("t", "f"), ("f", "t"), ("vv", "w"), ("w", "vv"), ("l", "i"), ("i", "l"), ("I", "l"), ("l", "I"), ("l", "t"), ("in", "m"), ("nn", "m"), ("ri", "n"), ("b", "h"), ("h", "b"), ("n", "u"), ("u", "n"), ("ti", "n"), ("n", "ri"), ("a", "o"), ("o", "a"),
    ("0", "о"), ("0", "О"), ("6", "б"), ("3", "з"), ("3", "З"), ("4", "ч"), ("n", "и"), ("n", "п"), ("H", "н"), ("m", "т"), ("b", "ь"), ("u", "и"), ("p", "р"), ("c", "с"), ("a", "а"), ("e", "е"), ("o", "о"), ("x", "х"), ("y", "у"),
    ("B", "в"), ("T", "т"), ("K", "к"), ("M", "м"), ("r", "г"), ("g", "д"), ("ш", "щ"), ("щ", "ш"), ("н", "и"), ("и", "н"), ("п", "н"), ("ь", "ы"), ("с", "е"), ("е", "с"), ("ц", "и"), ("@", "а"), ("|", "і"), ("ii", "п"), ("и", "п"),
)
# What an operation of the decoder costs, in nats.
PRICES = {"split": 7.0, "confusion": 4.0, "hyphen": 1.0, "merge": 6.0}
BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _read, _printed in CONFUSIONS:
    BY_FIRST.setdefault(_read[0], []).append((_read, _printed))


_PIECES = re.compile(r"(\[?[\w@|]+\]?)")
_SPACE = re.compile(r"\s")
_LETTER = re.compile(r"[^\W\d_]")
_WORD = re.compile(r"[^\W\d_]{2,}")
_MARKER = re.compile(r"^\[[^\]\n]{1,80}\]$")
_HYPHEN = re.compile(r"[-\xad‐¬]\n(\s*\[[^\]\n]{1,80}\]\n)?([\w@|]*[^\W\d_][\w@|]*)")
_LEFT = re.compile(r"[^\W\d_][\w@|]*\Z")
_PAGE_NUMBER = re.compile(r"^\s*[-–—]\s*\d{1,4}\s*[-–—]\s*$")
_BESIDE = re.compile(r"^\s*(?:\d{1,4}\s{2,}(\S.*)|(\S.*?)\s{2,}\d{1,4})\s*$")
_HEADS = re.compile(r"^[^\W\d_a-zа-яà-öø-ÿ]{2,}(?:\s+[^\W\d_a-zа-яà-öø-ÿ]\.?){1,4}$")
_DIGITS = re.compile(r"\d+")
_SHORT_LINE = re.compile(r"^(?!.*[^\W\d_]{3})(?=.*\d)\S.{0,11}$|^[ivxlc]{1,8}$")
_ROMAN = re.compile(r"^[ivxlc]+$")


def line_key(line: str) -> str | None:
    """What all printings of a header have in common, or the shape of a line of a number; null for lines that can't be either."""
    line = line.strip()
    n = len(line)
    if n > 60:
        return None
    if n <= 12 and _SHORT_LINE.match(line):
        return "=" + ("r" if _ROMAN.match(line) else _DIGITS.sub("#", line))
    if n < 3 or line[-1] in ".,;:" or not (line[0].isupper() or line[0].isdigit()):
        return None
    key = _DIGITS.sub("#", line).replace(" ", "").strip("#,").lower()
    return key if len(key) >= 3 and not key.replace("#", "").replace(".", "").replace(",", "") == "" else None


# What stands for each other in a header read twice.
_ALIKE = (("0", "o"), ("1", "l"), ("|", "l"), ("i", "l"), ("5", "s"), ("@", "a"), ("rn", "m"), ("nn", "m"), ("vv", "w"), ("ll", "h"), ("cl", "d"), ("c", "e"), ("t", "f"))


def likeness(key: str) -> str:
    """One form of all readings of a header within the common confusions."""
    for a, b in _ALIKE:
        key = key.replace(a, b)
    return key


def page_numbers(pages: list[list[str]]) -> set[tuple[int, int]]:
    """(page, line) of the numbers alone at an edge that grow as the pages do, on two pages at least."""
    found: dict[int, list[tuple[int, int]]] = {}
    for p, lines in enumerate(pages):
        for k in sorted({0, 1, len(lines) - 2, len(lines) - 1} & set(range(len(lines)))):
            text = lines[k].strip()
            if _SHORT_LINE.match(text) and len(numbers := _DIGITS.findall(text)) == 1 and len(numbers[0]) < 5:
                found.setdefault(int(numbers[0]) - p, []).append((p, k))
    best = max(found.values(), key=lambda x: len({p for p, _ in x}), default=[])
    return set(best) if len({p for p, _ in best}) > 1 else set()


def edges(lines: list[str]) -> list[bool]:
    """Which lines are the first or last two of their page."""
    out = [False] * len(lines)
    page: list[int] = []
    for i in [*range(len(lines)), len(lines)]:
        if i == len(lines) or lines[i][:1] == "[" and _MARKER.match(lines[i]):
            for k in (*page[:2], *page[-2:]):
                out[k] = True
            page = []
        elif lines[i].strip():
            page.append(i)
    return out


class Lexicon:
    """The corpus's words with their counts and a trie of them: the prefixes, each with the count of the most frequent word under it."""

    def __init__(self, counts: dict[str, int], total: int, headers: frozenset[str], headings: frozenset[str] = frozenset()) -> None:
        self.counts, self.total, self.headers, self.headings = counts, max(total, 1), headers, headings
        self.log_total = math.log(self.total)
        self.prefixes: dict[str, int] = {}
        for word, n in sorted(counts.items(), key=lambda x: (x[1], x[0])):
            for k in range(1, len(word) + 1):
                self.prefixes[word[:k]] = n
        self.most = max(counts.values(), default=0)
        self.often = max(40, 2e-5 * self.total)  # how often a word stands that tokens are put together or parted for
        self.known: dict[str, tuple[str, int] | None] = {}
        self.judged: dict[str, str | None] = {}
        self.breaks: dict[str, tuple[str, int]] = {}
        self.stretches: dict[str, tuple[str, int]] = {}
        self.walks: dict[str, tuple[bool, list[tuple[str, int]]]] = {}

    def decode(self, stream: str) -> tuple[str, Counter[str], float]:
        """(text, operations used, cost) of the cheapest reading of a stream."""
        parts, cost = self.path(stream)
        return "".join(out for _, _, out, _ in parts), Counter(op for *_, ops in parts for op in ops), cost

    def path(self, stream: str) -> tuple[list[tuple[int, int, str, tuple[str, ...]]], float]:
        """The cheapest reading of a stream in its parts, (from, to, text, operations used), and its cost."""
        n, counts, prefixes = len(stream), self.counts, self.prefixes
        best: list[tuple[float, int, str, tuple[str, ...]] | None] = [None] * (n + 1)
        best[0] = (0.0, -1, "", ())

        def reach(j: int, cost: float, i: int, out: str, ops: tuple[str, ...]) -> None:
            if best[j] is None or cost < best[j][0]:
                best[j] = (cost, i, out, ops)

        for i in range(n):
            if best[i] is None:
                continue
            base, c = best[i][0], stream[i]
            if c.isspace():
                reach(i + 1, base, i, c, ())
                continue
            if not (c.isalnum() or c in "@|"):
                reach(i + 1, base + 2.0, i, c, ())
            if i and not stream[i - 1].isspace() and (stream[i - 1].isalnum()):
                base += PRICES["split"]  # a word that begins without a blank
                start: tuple[str, ...] = ("split",)
            else:
                start = ()
            todo: list[tuple[int, str, float, tuple[str, ...], bool]] = [(i, "", 0.0, start, False)]
            while todo:
                j, prefix, cost, ops, whole = todo.pop()
                if whole and (m := counts.get(prefix)) is not None:
                    word = " " + prefix if "split" in ops else prefix
                    reach(j, base + cost + self.log_total - math.log(m), i, word, ops)
                if j == n:
                    continue
                d = stream[j]
                if prefix + d in prefixes:
                    todo.append((j + 1, prefix + d, cost, ops, True))
                if len(ops) < 3:
                    for read, printed in BY_FIRST.get(d, ()):
                        if stream.startswith(read, j) and prefix + printed in prefixes:
                            todo.append((j + len(read), prefix + printed, cost + PRICES["confusion"], (*ops, "confusion"), True))
                    if whole:
                        if d in "-\xad‐¬" and stream[j + 1 : j + 2] == "\n":
                            todo.append((j + 2, prefix, cost + PRICES["hyphen"], (*ops, "hyphen"), False))
                        elif d in " \n" and "merge" not in ops:
                            todo.append((j + 1, prefix, cost + PRICES["merge"], (*ops, "merge"), False))
            # An unknown word, whole or broken at a line's end.
            j, out, cost, ops = i, "", 12.0, start
            while j < n:
                if stream[j].isalnum() or stream[j] in "@|":
                    out, cost, j = out + stream[j], cost + 2.2, j + 1
                elif out and stream[j] in "-\xad‐¬" and stream[j + 1 : j + 2] == "\n":
                    reach(j, base + cost, i, out, ops)
                    cost, ops, j = cost + 1.0, (*ops, "hyphen"), j + 2
                else:
                    break
            if out:
                reach(j, base + cost, i, out, ops)
        parts, i = [], n
        while i > 0:
            _, before, out, ops = best[i]  # every position before the end of a run of characters is reached
            parts.append((before, i, out, ops))
            i = before
        return parts[::-1], best[n][0]

    def reading(self, token: str, least: float = 1) -> tuple[str, int, float] | None:
        """(word, confusions, cost) of the cheapest word that stands `least` times and may be misread as the token, else null."""
        n, counts, prefixes, best = len(token), self.counts, self.prefixes, None
        if least > self.most:
            return None
        todo = [(0, "", 0)]
        while todo:
            j, prefix, used = todo.pop()
            if j == n:
                m = counts.get(prefix, 0)
                if used and m >= least and prefix != token:
                    found = (PRICES["confusion"] * used + self.log_total - math.log(m), prefix, used)
                    best = found if best is None else min(best, found)
                continue
            if prefixes.get(prefix + token[j], 0) >= least:
                todo.append((j + 1, prefix + token[j], used))
            if used < 3:
                for read, printed in BY_FIRST.get(token[j], ()):
                    if token.startswith(read, j) and prefixes.get(prefix + printed, 0) >= least:
                        todo.append((j + len(read), prefix + printed, used + 1))
        return best and (best[1], best[2], best[0])

    def fix(self, token: str) -> tuple[str, int] | None:
        """(word as printed, confusions) of a misread token, else null."""
        if token in self.known:
            return self.known[token]
        found = None
        if len(token) > 2:
            n = self.counts.get(token, 0)
            read = self.reading(token, max(40 * max(1, n), 2e-5 * self.total))
            # Where another reading is cheaper (an unknown word, words run together, a rarer word), the token stays.
            if read is not None and read[2] <= (self.decode(token) if not n else self._without(token))[2] + 1e-9:
                found = read[:2]
        if len(self.known) > 400_000:
            self.known.clear()
        self.known[token] = found
        return found

    def _without(self, token: str) -> tuple[str, Counter[str], float]:
        """The reading of a token as if it weren't a word itself."""
        n = self.counts.pop(token)
        try:
            return self.decode(token)
        finally:
            self.counts[token] = n

    def join(self, left: str, hyphen: str, right: str) -> tuple[str, int, int]:
        """(text, broken words, confusions) of a word broken over lines."""
        key = f"{left}{hyphen}\n{right}"
        found = self.breaks.get(key)
        if found is None:
            if left[0].isupper() and left.isalpha() and right.isalpha() and left + right not in self.counts and self.counts.get(left, 0) < 50 and self.counts.get(right, 0) < 50 and self.reading(left + right) is None:
                found = (left + right, 1, 0)  # a name: no reading of it is in the trie
            else:
                text, used, _ = self.decode(key)
                found = (text, int(used["hyphen"] > 0), used["confusion"]) if used["hyphen"] else (f"{left}-{right}", 0, 0)
            if len(self.breaks) > 200_000:
                self.breaks.clear()
            self.breaks[key] = found
        return found

    def price(self, token: str) -> float:
        """What a token costs as it stands."""
        n = self.counts.get(token)
        return 12.0 + 2.2 * len(token) if n is None else self.log_total - math.log(n)

    def doubtful(self, token: str) -> bool:
        return token not in self.counts and sum(map(str.isalpha, token)) > 1

    def walk(self, token: str, begun: list[tuple[str, int]]) -> tuple[bool, list[tuple[str, int]]]:
        """(whether a frequent word ends within the token, beginnings of frequent words alive at its end), read on from `begun` (beginning, operations)."""
        counts, prefixes, often, n = self.counts, self.prefixes, self.often, len(token)
        todo, alive, parted = [(0, prefix, used) for prefix, used in begun], [], False
        restarted: set[int] = set()
        while todo:
            j, prefix, used = todo.pop()
            if j and prefix and counts.get(prefix, 0) >= often and j < n and token[j].isalnum():
                parted = True
                if j not in restarted:
                    restarted.add(j)
                    todo.append((j, "", 0))
            if j == n:
                alive.append((prefix, used))
                continue
            d = token[j]
            if prefixes.get(prefix + d, 0) >= often:
                todo.append((j + 1, prefix + d, used))
            if used < 3:
                for read, printed in BY_FIRST.get(d, ()):
                    if prefixes.get(prefix + printed, 0) >= often and token.startswith(read, j):
                        todo.append((j + len(read), prefix + printed, used + 1))
        return parted, alive

    def alone(self, token: str) -> tuple[bool, list[tuple[str, int]]]:
        """The walk of a token from its beginning, and from behind any sign in it."""
        found = self.walks.get(token)
        if found is None:
            if len(self.walks) > 200_000:
                self.walks.clear()
            parted, alive = self.walk(token, [("", 0)])
            for k, c in enumerate(token[:-1]):
                if not c.isalnum():
                    more = self.walk(token[k + 1 :], [("", 0)])
                    parted, alive = parted or more[0], alive + more[1]
            found = self.walks[token] = parted, alive
        return found

    def maybe_respaceable(self, tokens: list[str]) -> bool:
        """False only if respaceable is: no odd token can be begun, or go on from the one before, as a frequent word."""
        for k, token in enumerate(tokens):
            if self.doubtful(token):
                if any(self.alone(token)):
                    return True
                if k and (begun := [(prefix, used + 1) for prefix, used in self.alone(tokens[k - 1])[1] if prefix]) and any(self.walk(token, begun)):
                    return True
        return False

    def respaceable(self, stream: str) -> bool:
        """Whether words that stand often, misread or not, cover tokens of the stream with a blank left out or put in: nothing else can change it."""
        counts, prefixes, often, n = self.counts, self.prefixes, self.often, len(stream)
        tried: set[int] = set()
        starts, before, at = [], None, 0
        tokens = _SPACE.split(stream)
        if not self.maybe_respaceable(tokens):
            return False
        for token in tokens:
            if self.doubtful(token):  # some token of what changes is doubtful; at most two tokens are put together
                starts += [at, *(at + k + 1 for k, c in enumerate(token[:-1]) if not c.isalnum())]
                if before is not None:
                    starts += [before[0], *(before[0] + k + 1 for k, c in enumerate(before[1][:-1]) if not c.isalnum())]
            before = (at, token)
            at += len(token) + 1
        while starts:
            begin = starts.pop()
            if begin in tried:
                continue
            tried.add(begin)
            todo = [(begin, "", 0, False)]
            inside = begin > 0 and stream[begin - 1].isalnum()  # a word begun without a blank
            while todo:
                j, prefix, used, merged = todo.pop()
                if prefix and counts.get(prefix, 0) >= often:
                    if j == n or not stream[j].isalnum():
                        if merged or inside:
                            return True
                    else:
                        starts.append(j)
                if j == n:
                    continue
                d = stream[j]
                if prefixes.get(prefix + d, 0) >= often:
                    todo.append((j + 1, prefix + d, used, merged))
                if used < 3:
                    for read, printed in BY_FIRST.get(d, ()):
                        if prefixes.get(prefix + printed, 0) >= often and stream.startswith(read, j):
                            todo.append((j + len(read), prefix + printed, used + 1, merged))
                    if prefix and d in " \n" and not merged:
                        todo.append((j + 1, prefix, used + 1, True))
        return False

    def stretch(self, stream: str) -> tuple[str, int]:
        """(text, evidence) of tokens beside each other: words with a blank or line end in them are put together, words run together parted.

        As in fix(), only words that stand often are read so, and only with a gain of `mojibake.MARGIN` over the tokens as they stand; a
        part without a doubtful token stays. A blank too many or too few may be a slip of the keyboard and is no evidence; a word
        broken by a line's end is, and so are confusions.
        """
        found = self.stretches.get(stream)
        if found is None:
            least, out, evidence = self.often, [], 0
            groups: list[list[tuple[int, int, str, tuple[str, ...]]]] = []
            for part in self.path(stream)[0] if self.respaceable(stream) else ():
                if groups and "split" in part[3]:
                    groups[-1].append(part)
                else:
                    groups.append([part])
            for group in groups:
                read = stream[group[0][0] : group[-1][1]]
                used = [op for part in group for op in part[3]]
                words = [part[2].strip() for part in group]
                gain = sum(map(self.price, read.split())) - sum(map(self.price, words)) - sum(PRICES[op] for op in used)
                if ("merge" in used or "split" in used) and gain >= mojibake.MARGIN and all(self.counts.get(w, 0) >= least for w in words) and any(map(self.doubtful, read.split())):
                    # Line ends are kept, so that the lines stay what they are.
                    out.append(" ".join(words) + "\n" * ("\n" in read))
                    evidence += ("\n" in read) + used.count("confusion")
                else:
                    out.append(read)
            found = (re.sub(r"\n\s", "\n", "".join(out)), evidence) if groups else (stream, 0)
            if len(self.stretches) > 200_000:
                self.stretches.clear()
            self.stretches[stream] = found
        return found

    def candidate(self, token: str) -> bool:
        """Whether a token may be scan noise: it has a letter and is no code in brackets."""
        return token[0] != "[" and token[-1] != "]" and _LETTER.search(token) is not None

    def judge(self, token: str) -> str | None:
        """The word a token was misread from, '' for a doubtful token, null for any other."""
        word = None
        if self.candidate(token):
            fixed = self.fix(token)
            word = fixed[0] if fixed is not None else "" if self.doubtful(token) else None
        if len(self.judged) > 400_000:
            self.judged.clear()
        self.judged[token] = word
        return word

    def respace(self, pieces: list[str], odd: set[str]) -> tuple[str, int]:
        """(text with blanks put right, evidence): every run of odd tokens with the token before and behind it is decoded. pieces: what stands between tokens, and tokens, in turn."""
        runs: list[list[int]] = []  # (first, last) token of stretches; those that touch are one
        last = len(pieces) // 2 - 1
        for i in [i for i, token in enumerate(pieces[1::2]) if token in odd]:
            first = i - 1 if i and pieces[2 * i] in (" ", "\n") and self.candidate(pieces[2 * i - 1]) else i
            until = i + 1 if i < last and pieces[2 * i + 2] in (" ", "\n") and self.candidate(pieces[2 * i + 3]) else i
            if runs and first <= runs[-1][1]:
                runs[-1][1] = until
            else:
                runs.append([first, until])
        out, at, evidence = [], 0, 0
        for first, until in runs:
            text, found = self.stretch("".join(pieces[2 * first + 1 : 2 * until + 2]))
            out += pieces[at : 2 * first + 1]
            out.append(text)
            at, evidence = 2 * until + 2, evidence + found
        return "".join(out + pieces[at:]), evidence

    def strip(self, lines: list[str]) -> tuple[list[str], int]:
        """(lines without running headers and page numbers, how many those were)."""
        where: list[list[int]] = [[]]  # the lines of each page
        for i, line in enumerate(lines):
            if line[:1] == "[" and _MARKER.match(line):
                where.append([])
            elif line.strip():
                where[-1].append(i)
        where = [x for x in where if x]
        pages = [[lines[i] for i in x] for x in where]
        numbers = page_numbers(pages)

        def bare(line: str) -> str:
            beside = _BESIDE.match(line)
            return (beside.group(1) or beside.group(2)).strip() if beside else line.strip()

        # Lines that stand at the edges of several pages of this text and nowhere within one; a passage printed twice goes on alike, a header doesn't.
        own: dict[str, set[str]] = {}
        for p, page in enumerate(pages):
            for k in sorted({0, 1, len(page) - 2, len(page) - 1} & set(range(len(page)))):
                if len(page[k]) <= 70 and (key := line_key(bare(page[k]))) is not None and key[0] != "=":
                    own.setdefault(likeness(key), set()).add(page[2 if k < 2 else -3] if len(page) > 2 else str(p))
        own = {key: goes_on for key, goes_on in own.items() if len(goes_on) > 1}
        inside = {line_key(bare(line)) for page in pages for line in page[2:-2] if len(line) <= 70} if own else set()

        sizes = sorted(len(x) for page in pages for x in page) or [0]
        width = sizes[int(0.8 * (len(sizes) - 1))]  # a full line may stand at an edge as often as its work was stored

        def goes(p: int, k: int) -> bool:
            line = pages[p][k]
            text = bare(line)
            key = line_key(text)
            if (p, k) in numbers or _PAGE_NUMBER.match(line) or _BESIDE.match(line) or key is not None and key in self.headers and (len(text) <= 0.85 * width or text.upper() == text):
                return True
            return key is not None and key[0] != "=" and (likeness(key) in own and key not in inside and key not in self.headings or _HEADS.match(text) is not None and len(text) > 3)

        gone: set[int] = set()
        for p, page in enumerate(pages):
            for order in (range(len(page)), range(len(page) - 1, -1, -1)):
                for k in order:
                    if len(page[k]) > 70 or where[p][k] in gone or not goes(p, k):
                        break
                    gone.add(where[p][k])
        return [line for i, line in enumerate(lines) if i not in gone], len(gone)

    def repair(self, text: str) -> tuple[str, int]:
        """(text without scan noise, still in its lines; evidence found)."""
        lines, evidence = self.strip(text.split("\n"))
        body = "\n".join(lines)
        broken = misread = 0
        parts, at = [], 0
        for m in _HYPHEN.finditer(body):
            left = _LEFT.search(body, max(at, m.start() - 60), m.start())
            if left is None:
                continue
            marker, right = m.groups()
            word, hyphens, confusions = self.join(left.group(), m.group()[0], right)
            broken += hyphens + confusions
            parts += [body[at : left.start()], word, "\n" + marker.strip("\n") if marker else "", "\n"]
            at = m.end()
        if parts:
            body = "".join([*parts, body[at:]])
        judged, fixes, odd = self.judged, {}, set()
        pieces = _PIECES.split(body)
        for token in set(pieces[1::2]):
            word = judged[token] if token in judged else self.judge(token)
            if word is not None:
                if word:
                    fixes[token] = word
                else:
                    odd.add(token)
        if fixes:
            misread = sum(token in fixes for token in pieces[1::2])
            pieces[1::2] = [fixes.get(token, token) for token in pieces[1::2]]
        if odd:
            body, respaced = self.respace(pieces, odd)
        else:
            body, respaced = "".join(pieces), 0
        return body, evidence + broken + misread + respaced


def paragraphs(text: str) -> list[str]:
    """Lines put together into paragraphs: the cheapest choice of breaks between lines.

    A break is cheap after a blank line, a short line or the end of a sentence and dear within a sentence; a heading is
    a paragraph of one line. Page markers stand by themselves.
    """
    lines = [x for x in text.split("\n")]
    full = sorted(len(x) for x in lines if x.strip()) or [0]
    width = max(20, full[int(0.8 * (len(full) - 1))])
    items: list[tuple[str, bool]] = []  # (line, a blank line before it)
    blank = False
    for x in lines:
        if x.strip():
            items.append((x.strip(), blank))
            blank = False
        else:
            blank = True
    n = len(items)
    # best[j]: the cheapest paragraphs of the first j lines; run: the same with the last one still open, begun at `since`.
    best, back = [0.0] * (n + 1), [0] * (n + 1)
    run, since = 0.0, 0
    for j in range(1, n + 1):
        together = run + _together(items[j - 2][0], *items[j - 1], width) if j > 1 else math.inf
        if together < best[j - 1]:
            run = together
        else:
            run, since = best[j - 1], j - 1
        best[j], back[j] = run + 1.0, since
    cuts, j = [], n
    while j:
        cuts.append((back[j], j))
        j = back[j]
    return [" ".join(x for x, _ in items[a:b]) for a, b in reversed(cuts)]


def _together(a: str, b: str, gap: bool, width: int) -> float:
    """The price of line b running on from line a within a paragraph."""
    if _MARKER.match(a) or _MARKER.match(b):
        return math.inf
    ends, low, short = a[-1] in ".!?:…»”\"", b[0].islower(), len(a) < 0.75 * width
    price = (3.0 if gap else 0.0) + (1.5 if ends else -1.0) * short + (-2.0 if low else 0.2) + (0.5 if ends and not low else 0.0)
    return price + (3.0 if len(a) < 45 and not ends and not low and len(a) < 0.6 * width else 0.0)  # a heading doesn't run into text


def statistics(texts: DataFrame, text_col: str, clean: re.Pattern | None = None) -> tuple[tuple[dict[str, int], int, frozenset[str], frozenset[str]], dict[str, int]]:
    """((word counts, number of words, header lines, lines that stand within pages too), trigram counts of texts that are `clean`) of all texts, in one pass.

    Every word and line is summed over all tasks before any is left out; by the shares a bounded number comes back.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        inside: Counter[str] = Counter()
        edge: Counter[str] = Counter()
        odd: Counter[str] = Counter()
        total = keyed = 0

        def out(last: bool) -> pa.RecordBatch:
            nonlocal total
            real: Counter[str] = Counter()
            for token, n in words.items():
                for word in (token,) if token.isalpha() and len(token) > 1 else _WORD.findall(token):
                    real[word] += n
            total += sum(real.values())
            lines = list(inside.keys() | edge.keys())
            grams = mojibake.clean_trigrams(odd)
            key = [*real, *grams, *lines, *[""] * last]
            n = [*real.values(), *grams.values(), *(inside[k] for k in lines), *[total] * last]
            e = [*[0] * (len(real) + len(grams)), *(edge[k] for k in lines), *[keyed] * last]
            kind = [*["w"] * len(real), *["g"] * len(grams), *["l"] * len(lines), *["t"] * last]
            for c in (words, inside, edge, odd):
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(key, pa.string()), pa.array(n, pa.int64()), pa.array(e, pa.int64())], names=["kind", "key", "n", "e"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                if clean:
                    mojibake.count_clean(text, clean, odd)
                words.update(text.split())  # no word runs over a blank
                lines = text.split("\n")
                for line, e in zip(lines, edges(lines)):
                    beside = _BESIDE.match(line) if e else None
                    if (key := line_key((beside.group(1) or beside.group(2)) if beside else line)) is not None:
                        (edge if e else inside)[key] += 1
                        keyed += 1
                if len(words) + len(inside) + len(edge) > 1_000_000:
                    yield out(False)
        yield out(True)

    counted = texts.select(text_col).mapInArrow(count, "kind string, key string, n bigint, e bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    counted = stage(counted.filter(F.col("kind").isin("t", "g") | (F.col("n") + F.col("e") >= EDGE_LEAST)), "scan-counts")
    whole = counted.filter("kind = 't'").agg(F.sum("n").alias("n"), F.sum("e").alias("e")).first()
    total, least_line = whole["n"] or 0, max(EDGE_LEAST, (whole["e"] or 0) * LINE_SHARE)
    words = counted.filter((F.col("kind") == "w") & (F.col("n") >= max(WORD_LEAST, total * WORD_SHARE))).select("key", "n").toArrow()
    lines = counted.filter((F.col("kind") == "l") & (F.col("n") + F.col("e") >= least_line)).select("key", (F.col("e") >= EDGE_SHARE * (F.col("n") + F.col("e"))).alias("edge")).toArrow().to_pylist()
    grams = counted.filter("kind = 'g'").select("key", "n").toArrow().to_pydict() if clean else {"key": [], "n": []}
    discard(counted)
    heads, inner = (frozenset(r["key"] for r in lines if r["edge"] == edge) for edge in (True, False))
    return (dict(zip(words.column("key").to_pylist(), words.column("n").to_pylist())), total, heads, inner), dict(zip(grams["key"], grams["n"]))


_lexicons: dict[str, Lexicon] = {}


def _lexicon(shared: mojibake.Shared) -> Lexicon:
    if shared.id not in _lexicons:
        _lexicons.clear()
        _lexicons[shared.id] = Lexicon(*shared.value)
    return _lexicons[shared.id]


def clean(df: DataFrame, text_col: str = "full_text", samples: list[str] | None = None, with_text: bool = True, only_noisy: bool = False) -> DataFrame:
    """All columns of `df` and evidence (int: places with scan noise), noisy (boolean), paragraphs (array<string>, if wanted).

    With `samples` of clean text, garbled texts are restored before they are judged. only_noisy: records without noise have null for paragraphs.
    """
    clean_text = mojibake.clean_pattern(mojibake.clean_alphabet(samples)) if samples else None
    known, grams = statistics(df, text_col, clean_text)
    shared = mojibake.Shared(df.sparkSession, known)
    repair = mojibake.Shared(df.sparkSession, mojibake.trained(grams, samples)) if samples else None

    @F.pandas_udf("struct<evidence:int,paragraphs:array<string>>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        lexicon, restorer = _lexicon(shared), mojibake.restorer_of(repair) if repair else None
        out = []
        for text in texts:
            if not text:
                out.append((0, None if text is None else []))
                continue
            if restorer and not clean_text.fullmatch(text) and restorer.chains(mojibake.odd_words(text)):
                text = restorer.restore(text)[0]
            fixed, evidence = lexicon.repair(text)
            noisy = evidence >= LEAST_EVIDENCE
            out.append((evidence, paragraphs(fixed if noisy else text) if with_text and (noisy or not only_noisy) else None))
        return pd.DataFrame(out, columns=["evidence", "paragraphs"])

    made = ["evidence", "noisy", *["paragraphs"] * with_text]
    kept = [c for c in df.columns if c not in made]
    judged = df.select(*kept, judge.asNondeterministic()(df[text_col]).alias("__j")).select(*kept, F.col("__j.evidence").alias("evidence"), F.col("__j.paragraphs").alias("paragraphs"))
    judged = judged.withColumn("noisy", F.coalesce(F.col("evidence") >= LEAST_EVIDENCE, F.lit(False)))
    return judged.select(*kept, *made)
