"""Keywords in lines: a multi-pattern automaton for exact hits, and a weighted ratio of edits for loose ones.

Both run over Arrow batches: a catalog of any number of keywords is one pass over a line, and a plan holds one node for
it. Catalogs travel with the tasks in parts of at most ``PART_BYTES``; each part is a pass of its own, and the best of
the parts' finds is the find.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Least lengths of lines and keywords, shared anchors and likeness of a loose match; letters of an anchor.
LEAST_LINE, LEAST_KEYWORD, LEAST_ANCHORS, LEAST_LIKENESS, ANCHOR_LETTERS = 12, 8, 2, 82.0, 4

#: Fixed values of the weighted ratio: what token and partial comparisons count, and from which lengths on.
TOKENS, PARTIAL, FAR_PARTIAL, PARTIAL_FROM, FAR_FROM = 0.95, 0.9, 0.6, 1.5, 8.0

#: Bytes of keywords that one task holds as an automaton.
PART_BYTES = 32 << 20

#: Numbers that a comparison of many pairs holds at once.
CELLS = 4 << 20

Payload = tuple[str, str, str]


def _edge(text: str, at: int) -> bool:
    """Whether no letter, digit or underscore (of ASCII) stands at a place."""
    return not 0 <= at < len(text) or not (text[at].isascii() and (text[at].isalnum() or text[at] == "_"))


class Automaton:
    """Finds keywords as whole words; it is built where it is first used, so only the keywords travel."""

    def __init__(self, keywords: Sequence[str]):
        self.keywords, self.built = list(keywords), None

    def longest(self, line: str, overlapping: bool = True) -> tuple[int, int] | None:
        """(start, end) of the longest keyword in a line, the first on a tie. Without ``overlapping`` only hits count that are
        left when the line is read from its start and the longest keyword at each place is taken and skipped."""
        if self.built is None:
            import ahocorasick

            self.built = ahocorasick.Automaton()
            for k in self.keywords:
                if k:
                    self.built.add_word(k, len(k))
            self.built.make_automaton()
        if not len(self.built):
            return None
        hits = [(end + 1 - n, end + 1) for end, n in self.built.iter(line) if _edge(line, end + 1) and _edge(line, end - n)]
        if not overlapping:
            taken, free = [], 0
            for start, end in sorted(hits, key=lambda h: (h[0], -h[1])):
                if start >= free:
                    taken.append((start, end))
                    free = end
            hits = taken
        return min(hits, key=lambda h: (h[0] - h[1], h[0]), default=None)


def parts_of(keywords: Sequence[str], most: int = PART_BYTES) -> list[list[str]]:
    """Keywords in runs of at most so many bytes."""
    out: list[list[str]] = [[]]
    size = 0
    for k in keywords:
        n = len(k.encode())
        if out[-1] and size + n > most:
            out.append([])
            size = 0
        out[-1].append(k)
        size += n
    return out


def longest_keyword(line: Column, keywords: Sequence[str], overlapping: bool = True, part_bytes: int = PART_BYTES) -> Column:
    """The longest of the keywords that stand in a line as whole words, the first on a tie; NULL if none does, or for a NULL
    line. A hit inside or across another counts, unless ``overlapping`` is off (and then within each part of the catalog)."""

    def finder(part: list[str]) -> Callable[[pd.Series], pd.DataFrame]:
        automaton = Automaton(part)

        def find(lines: pd.Series) -> pd.DataFrame:
            found = [automaton.longest(t, overlapping) if t else None for t in lines]
            return pd.DataFrame({"n": [h and h[1] - h[0] for h in found], "early": [h and -h[0] for h in found], "word": [h and t[h[0] : h[1]] for h, t in zip(found, lines, strict=True)]}, dtype=object)

        return find

    hits = [F.pandas_udf(finder(p), "n int, early int, word string")(line) for p in parts_of(keywords, part_bytes)]
    best = hits[0] if len(hits) == 1 else F.array_max(F.array(*(F.when(h["word"].isNotNull(), h) for h in hits)))
    return best["word"]


def _codes(texts: Sequence[str], width: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, np.int32)
    for i, t in enumerate(texts):
        out[i, : len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _masks(needles: np.ndarray, hays: np.ndarray) -> np.ndarray:
    """For each place of a hay, the set of places of the needle with the same character, as bits."""
    out = np.zeros(hays.shape, np.uint64)
    for i in range(needles.shape[1]):
        out |= (needles[:, i : i + 1] == hays).astype(np.uint64) << np.uint64(i)
    return out


def _step(state: np.ndarray, mask: np.ndarray) -> np.ndarray:
    met = state & mask
    return (state + met) | (state - met)


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, with a bit for each character of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for c in b:
        met = state & places.get(c, 0)
        state = (state + met | state - met) & full
    return len(a) - state.bit_count()


def _chunks(pairs: list[tuple[str, str]]) -> list[list[int]]:
    """Places of pairs, by lengths, in runs whose padded matrices stay within CELLS."""
    out, cells = [[]], 0
    for i in sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1]))):
        n = len(pairs[i][1]) + 2 * len(pairs[i][0])
        if out[-1] and (len(pairs[out[-1][0]][0]) != len(pairs[i][0]) or cells + n > CELLS):
            out.append([])
            cells = 0
        out[-1].append(i)
        cells += n
    return out


def ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """200 times the common subsequence over both lengths, for each pair; 100 for two empty texts."""
    out = np.full(len(pairs), 100.0)
    todo = [(min(p, key=len), max(p, key=len)) if len(p[0]) != len(p[1]) else p for p in pairs]
    for group in _chunks(todo) if pairs else []:
        n = len(todo[group[0]][0])
        if n > 64:
            common = np.array([common_length(*todo[i]) for i in group])
        else:
            hays = _codes([todo[i][1] for i in group], max(len(todo[i][1]) for i in group), -2)
            masks = _masks(_codes([todo[i][0] for i in group], n, -1), hays)
            state = np.full(len(group), np.uint64(2**64 - 1))
            for h in range(hays.shape[1]):
                state = _step(state, masks[:, h])
            common = n - np.bitwise_count(state & np.uint64((1 << n) - 1)).astype(np.int64)
        total = np.array([n + len(todo[i][1]) for i in group])
        out[group] = np.where(total > 0, 200.0 * common / np.maximum(total, 1), 100.0)
    return out


def partial_ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """The best ratio of the shorter text with any run of the longer that is as long, or is cut off by its ends; 0 where one
    is empty. Of two texts of one length either may be the one that is cut."""
    todo, owner = [], []
    for i, (a, b) in enumerate(pairs):
        for p in [(a, b), (b, a)] if len(a) == len(b) else [(min(a, b, key=len), max(a, b, key=len))]:
            todo.append(p)
            owner.append(i)
    best = np.zeros(len(todo))
    for group in _chunks(todo) if todo else []:
        n = len(todo[group[0]][0])
        if not n:
            best[group] = [0.0 if todo[i][1] else 100.0 for i in group]
            continue
        if n > 64:
            for i in group:
                a, b = todo[i]
                best[i] = max(200.0 * common_length(a, r) / (n + len(r)) for r in {b[max(0, s) : s + n] for s in range(1 - n, len(b))})
            continue
        width = max(len(todo[i][1]) for i in group)
        needles, hays = _codes([todo[i][0] for i in group], n, -1), _codes([todo[i][1] for i in group], width, -2)
        masks = np.pad(_masks(needles, hays), ((0, 0), (n - 1, n - 1)))
        # a run begins at each place from n - 1 before the text to its last character
        runs = width + n - 1
        state = np.full((len(group), runs), np.uint64(2**64 - 1))
        for s in range(n):
            state = _step(state, masks[:, s : s + runs])
        common = n - np.bitwise_count(state & np.uint64((1 << n) - 1)).astype(np.int64)
        last, ends = np.arange(runs), np.array([len(todo[i][1]) for i in group])[:, None]
        inside = np.maximum(np.minimum(ends - 1, last) - np.maximum(0, last - n + 1) + 1, 0)
        best[group] = (200.0 * common / (n + inside)).max(axis=1)
    out = np.zeros(len(pairs))
    np.maximum.at(out, owner, best)
    return out


def weighted_ratios(pairs: list[tuple[str, str]]) -> np.ndarray:
    """The weighted ratio, 0 to 100, of each pair of texts: the greatest of the plain ratio and

    - if the longer text is less than PARTIAL_FROM times as long: TOKENS times the ratio of the sorted words, or of the words
      apart from the common ones with these in front;
    - else, with PARTIAL (beyond FAR_FROM times: FAR_PARTIAL) as a factor: the best ratio with a run of the longer text, and
      TOKENS times the same of the sorted words, which is 100 as soon as one word is common.
    """
    words = [(a.split(), b.split()) for a, b in pairs]
    out = np.zeros(len(pairs))
    real = [i for i, (a, b) in enumerate(pairs) if a and b]
    whole: list[tuple[int, float, tuple[str, str], tuple[int, int] | None]] = [(i, 1.0, pairs[i], None) for i in real]
    partial: list[tuple[int, float, tuple[str, str]]] = []
    for i in real:
        (a, b), (x, y) = pairs[i], words[i]
        sizes = max(len(a), len(b)) / min(len(a), len(b))
        one, two = set(x), set(y)
        common, only_one, only_two = " ".join(sorted(one & two)), " ".join(sorted(one - two)), " ".join(sorted(two - one))
        ordered = " ".join(sorted(x)), " ".join(sorted(y))
        if sizes < PARTIAL_FROM:
            whole.append((i, TOKENS, ordered, None))
            if one and two:
                if common and not (only_one and only_two):
                    out[i] = max(out[i], 100.0 * TOKENS)
                else:
                    n, gap = len(common), bool(common)
                    whole.append((i, TOKENS, (only_one, only_two), (n + gap + len(only_one), n + gap + len(only_two))))
                    for rest in (only_one, only_two) if common else ():
                        out[i] = max(out[i], TOKENS * 200.0 * n / (2 * n + 1 + len(rest)))
        else:
            scale = PARTIAL if sizes <= FAR_FROM else FAR_PARTIAL
            partial.append((i, scale, (a, b)))
            if common:
                out[i] = max(out[i], 100.0 * TOKENS * scale)
            else:
                partial.append((i, TOKENS * scale, ordered))
                if len(one) < len(x) or len(two) < len(y):
                    partial.append((i, TOKENS * scale, (only_one, only_two)))
    for (i, scale, (a, b), sizes), r in zip(whole, ratios([w[2] for w in whole]), strict=True):
        if sizes:  # the common words in front of both: as many edits, in longer texts
            edits = (len(a) + len(b)) * (1 - r / 100.0)
            r = 100.0 * (1 - edits / sum(sizes)) if sum(sizes) else 100.0
        out[i] = max(out[i], scale * r)
    for (i, scale, _), r in zip(partial, partial_ratios([p[2] for p in partial]), strict=True):
        out[i] = max(out[i], scale * r)
    return out


class Loose:
    """Finds the keyword most like a line, among those of metrics that share enough anchors with it.

    A metric's anchors are the words of at least ANCHOR_LETTERS letters of all its keywords; a line must have
    LEAST_ANCHORS of them, or all if they are fewer.
    """

    def __init__(self, index: Mapping[str, Payload]):
        self.keywords: list[list[str]] = []
        self.needed: list[int] = []
        self.of: dict[str, list[int]] = {}
        place: dict[str, int] = {}
        anchors: list[set[str]] = []
        for k, (metric, *_) in index.items():
            m = place.setdefault(metric, len(place))
            if m == len(anchors):
                anchors.append(set())
                self.keywords.append([])
            anchors[m].update(w for w in k.split() if len(w) >= ANCHOR_LETTERS)
            if len(k) >= LEAST_KEYWORD:
                self.keywords[m].append(k)
        for m, words in enumerate(anchors):
            self.needed.append(min(LEAST_ANCHORS, len(words)))
            for w in words:
                self.of.setdefault(w, []).append(m)
        self.free = [m for m, n in enumerate(self.needed) if not n]

    def candidates(self, line: str) -> list[str]:
        """Keywords to compare with a line, in the catalog's order of metrics."""
        if len(line) < LEAST_LINE:
            return []
        met: dict[int, int] = dict.fromkeys(self.free, 0)
        for w in set(line.split()):
            for m in self.of.get(w, ()):
                met[m] = met.get(m, 0) + 1
        return [k for m in sorted(m for m, n in met.items() if n >= self.needed[m]) for k in self.keywords[m]]

    def best(self, lines: Sequence[str | None]) -> list[tuple[str, float] | None]:
        """(keyword, likeness) of each line: the first with the greatest likeness over LEAST_LIKENESS."""
        out: list[tuple[str, float] | None] = [None] * len(lines)
        pairs, owner, cells = [], [], 0

        def settle() -> None:
            for (line, k), i, s in zip(pairs, owner, weighted_ratios(pairs), strict=True):
                if s > max(LEAST_LIKENESS, out[i][1] if out[i] else 0.0):
                    out[i] = (k, float(s))

        for i, line in enumerate(lines):
            for k in self.candidates(line) if line else ():
                pairs.append((line, k))
                owner.append(i)
                cells += len(line)
            if cells > CELLS:
                settle()
                pairs, owner, cells = [], [], 0
        settle()
        return out


def loose_keyword(line: Column, index: Mapping[str, Payload]) -> Column:
    """struct<word, likeness> of the keyword most like a line; NULL if none is like it by more than LEAST_LIKENESS of 100."""
    loose = Loose(index)

    def find(lines: pd.Series) -> pd.DataFrame:
        found = loose.best(list(lines))
        return pd.DataFrame({"word": [f and f[0] for f in found], "likeness": [f and round(f[1], 4) for f in found]}, dtype=object)

    hit = F.pandas_udf(find, "word string, likeness double")(line)
    return F.when(hit["word"].isNotNull(), hit)


def named_keyword(exact: Column, rest: Column, index: Mapping[str, Payload], loose: bool = True) -> Column:
    """struct<word, likeness, metric_id, label, unit>: the longest keyword in ``exact``, else the one most like ``rest``, with
    what the catalog has for it; all NULL if there is none."""
    automaton, near = Automaton(list(index)), Loose(index)
    table = dict(index)

    def find(lines: pd.Series, others: pd.Series) -> pd.DataFrame:
        hits = [automaton.longest(t) if t else None for t in lines]
        words = [h and t[h[0] : h[1]] for h, t in zip(hits, lines, strict=True)]
        like = near.best([None if w else t for w, t in zip(words, others, strict=True)]) if loose else [None] * len(words)
        chosen = [w or (f and f[0]) for w, f in zip(words, like, strict=True)]
        of = [table[w] if w else (None, None, None) for w in chosen]
        return pd.DataFrame({"word": chosen, "likeness": [f and round(f[1], 4) for f in like], "metric_id": [x[0] for x in of], "label": [x[1] for x in of], "unit": [x[2] for x in of]}, dtype=object)

    return F.pandas_udf(find, "word string, likeness double, metric_id string, label string, unit string")(exact, rest)
