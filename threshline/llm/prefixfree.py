"""Repeated byte strings by prefix-free parsing (operator 6).

Texts are cut into phrases at triggers: strings of ``TRIGGER`` bytes whose rolling hash is
divisible by ``DIVISOR``. A phrase reaches from one trigger's start to the next one's end, so
neighbours overlap by a trigger, and no phrase's suffix longer than a trigger is a prefix
of another such suffix: the parsing is prefix-free. The distinct phrases, sorted, are the
dictionary; the sequence of their ranks is the parse. The suffix array of the dictionary
orders the phrases' suffixes, the suffix array of the parse orders what follows a phrase, and
both together are the order of the texts: first by the rest of the phrase that a place
lies in, then by the parse after it. Neighbours in that order that share the window's
bytes are repeats; how many they share also comes from dictionary and parse alone. Texts
that repeat much share phrases, so the dictionary and its sorting stay small.

The corpus is parsed in shares: places whose windows can be equal come to one task (see
``repeats``), in groups of bounded size, and each task combines the orders of its share.
The order of all shares among each other isn't made, as equal windows never need it.

Defined results: null text is empty; texts shorter than the window lose nothing; repeated
rows are repeats of one another; null ids are results like others; what is left need not
be valid UTF-8; an empty table gives an empty table; only doc_id and text are read, so
other columns, whatever their names, don't matter. Very long texts are read whole, their
windows in chunks of fixed size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from threshline.llm.repeats import Bytes, Finder, doubled, rolling

#: Bytes of a window, and of the strings whose hash can be its anchor.
WINDOW, GRAM = 400, 64
#: Bytes of a trigger; one place in ``DIVISOR`` is one.
TRIGGER, DIVISOR = 8, 32
#: Bytes of the texts that a task parses at once.
PARSE_BYTES = 2_000_000
#: Neighbours whose bytes are compared at once.
CHUNK = 4096


class Smallest:
    """The smallest value of any range of an array, by ranges of powers of two."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        step = 1
        while 2 * step <= len(x):
            self.rows.append(np.minimum(self.rows[-1][:-step], self.rows[-1][step:]))
            step *= 2

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of x[first] to x[last], at least one value each."""
        size = last - first + 1
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[first[at]], row[last[at] - (1 << int(k)) + 1])
        return out


class Parse:
    """Dictionary and parse of several texts.

    ``cut``: where each phrase starts in ``text`` (all texts, each closed by a zero; bytes
    count from 1); ``entry`` and ``number``: its place in the dictionary as it was found, and
    sorted; ``length``: its length without the closing zero; ``gain``: the bytes that it adds
    to what is before it.
    """

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) + 1 for t in texts])
        self.offset = np.cumsum(sizes) - sizes
        joined = b"\0".join(texts) + b"\0"
        raw = np.frombuffer(joined, np.uint8)
        closing = self.offset + sizes - 1
        self.text = raw.astype(np.int16) + 1
        self.text[closing] = 0
        width = TRIGGER
        trigger = np.zeros(len(raw), bool)
        if len(raw) >= width:
            trigger[: len(raw) - width + 1] = rolling(Bytes().codes(joined), width) % np.uint64(DIVISOR) == 0
        for back in range(width):  # no trigger reaches over a text's end
            trigger[np.maximum(closing - back, 0)] = False
        trigger[self.offset] = True
        self.cut = np.flatnonzero(trigger)
        owner = np.searchsorted(self.offset, self.cut, side="right") - 1
        self.last = np.append(owner[1:] != owner[:-1], True)  # phrases that a text ends with
        following = np.append(self.cut[1:], len(raw))
        self.end = np.where(self.last, following, following + width)
        known: dict[bytes | tuple[bytes], int] = {}
        first: list[int] = []
        self.entry = np.empty(len(self.cut), np.int64)
        for i, (a, b, tail) in enumerate(zip(self.cut.tolist(), self.end.tolist(), self.last.tolist(), strict=True)):
            phrase = joined[a:b]
            k = known.setdefault((phrase,) if tail else phrase, len(first))
            if k == len(first):
                first.append(i)
            self.entry[i] = k
        self.length = self.end - self.cut - self.last
        self.gain = self.length - np.where(self.last, 0, width)
        self.first = np.array(first)
        self._sort()

    def _sort(self) -> None:
        """Ranks of the dictionary's phrases, and the suffix array of the dictionary:
        ``kind`` is the rank of the phrase's rest at each place of ``symbols``."""
        at, sizes = self.cut[self.first], (self.end - self.cut)[self.first]
        self.begin = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(self.begin - at, sizes)
        symbols = self.text[place].astype(np.int64) + 1  # 0: after the phrase's end
        end = np.repeat(self.begin + sizes, sizes)
        packed, here = np.zeros(len(symbols), np.int64), np.arange(len(symbols))
        for j in range(7):
            packed = packed * 258 + np.where(here + j < end, symbols[np.minimum(here + j, len(symbols) - 1)], 0)
        rank = np.unique(packed, return_inverse=True)[1]
        self.levels = doubled(rank, 7, end, int(sizes.max()))
        self.kind = self.levels[-1][1]
        self.sorted = np.argsort(self.kind[self.begin])  # phrases differ, so their ranks do
        rank = np.empty(len(self.sorted), np.int64)
        rank[self.sorted] = np.arange(len(rank))
        self.number = rank[self.entry]

    def neighbours(self) -> np.ndarray:
        """Bytes that each phrase of the sorted dictionary shares with the one before."""
        start, size = self.cut[self.first][self.sorted], self.length[self.first][self.sorted]
        out = np.zeros(len(start), np.int64)
        for i in range(1, len(start), CHUNK):
            a, b = start[i - 1 : i - 1 + CHUNK], start[i : i + CHUNK]
            a = a[: len(b)]
            most = np.minimum(size[i - 1 : i - 1 + len(b)], size[i : i + len(b)])
            j = np.arange(int(most.max()) if len(most) else 0)
            last = len(self.text) - 1
            same = (self.text[np.minimum(a[:, None] + j, last)] == self.text[np.minimum(b[:, None] + j, last)]) & (j < most[:, None])
            out[i : i + len(b)] = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1)) if same.shape[1] else 0
        return out

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """(rank of each place of the parse among its suffixes, bytes that the suffix of
        each rank adds to what it has in common with the one before). The parse has an
        end mark of its own after each text, which no other place equals."""
        self.place = np.arange(len(self.cut)) + np.concatenate([[0], np.cumsum(self.last[:-1])])
        n_texts = int(self.last.sum())
        parse = np.empty(len(self.cut) + n_texts, np.int64)
        is_phrase = np.zeros(len(parse), bool)
        is_phrase[self.place] = True
        parse[self.place] = self.number + n_texts
        parse[~is_phrase] = np.arange(n_texts)
        gain = np.zeros(len(parse) + 1, np.int64)
        gain[self.place] = self.gain
        upto = np.concatenate([[0], np.cumsum(gain)])
        dense = np.unique(parse, return_inverse=True)[1]
        levels = doubled(dense, 1, len(parse), len(parse))
        rank = levels[-1][1]
        sa = np.argsort(rank)
        a, b = sa[:-1], sa[1:]
        x, y = a, b
        for depth, level in reversed(levels):
            same = level[x] == level[y]
            x, y = np.where(same, x + depth, x), np.where(same, y + depth, y)
        shared = upto[x] - upto[a]
        # the first phrases that differ share bytes, too; their first trigger is counted already
        p, q = parse[x] - n_texts, parse[y] - n_texts
        both = (p >= 0) & (q >= 0)
        within = Smallest(self.neighbours())
        low, high = np.minimum(p[both], q[both]), np.maximum(p[both], q[both])
        shared[both] += np.maximum(0, within(low + 1, high) - TRIGGER)
        return rank, np.concatenate([[0], shared])


class CorpusOrder:
    """For each text of whole groups the starts whose window also starts elsewhere."""

    def __init__(self, window: int):
        self.window = window

    def __call__(self, contents: list[bytes], starts: list[int]) -> list[np.ndarray]:
        parse = Parse(contents)
        rank, shared = parse.order()
        counts = np.array(starts)
        places = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts - parse.offset, counts)
        phrase = np.searchsorted(parse.cut, places, side="right") - 1
        inside = places - parse.cut[phrase]
        spot = parse.begin[parse.entry[phrase]] + inside  # in the dictionary
        kind = parse.kind[spot]
        after = rank[parse.place[phrase] + 1]
        order = np.argsort(kind * len(rank) + after, kind="stable")
        a, b = order[:-1], order[1:]
        rest = parse.length[phrase] - inside
        same = kind[a] == kind[b]
        reach = np.zeros(len(a), bool)
        closed = rest >= self.window
        reach[same] = closed[a[same]]
        # the rest of the phrase is equal: what follows is the parse's matter
        open_ = np.flatnonzero(same & ~reach)
        more = Smallest(shared)(after[a[open_]] + 1, after[b[open_]]) if len(open_) else np.zeros(0, np.int64)
        reach[open_] = rest[a[open_]] + more >= self.window
        # the rests differ, but both hold a window
        apart = np.flatnonzero(~same & closed[a] & closed[b])
        reach[apart] = self._equal(parse, spot[a[apart]], spot[b[apart]])
        again = np.zeros(len(places), bool)
        again[a[reach]] = True
        again[b[reach]] = True
        return np.split(again, np.cumsum(counts)[:-1])

    def _equal(self, parse: Parse, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the dictionary's strings of the window's length at a and b are equal."""
        fits = [x for x in parse.levels if x[0] <= self.window]
        if not fits:  # windows of a few bytes
            j = np.arange(self.window)
            at = parse.cut[parse.first]
            text = lambda p: parse.text[(p + (at - parse.begin)[np.searchsorted(parse.begin, p, side="right") - 1])[:, None] + j]
            return (text(a) == text(b)).all(axis=1)
        depth, rank = fits[-1]
        out = np.ones(len(a), bool)
        for step in [*range(0, self.window - depth, depth), self.window - depth]:
            out &= rank[a + step] == rank[b + step]
        return out


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_units, n_removed, spans, kept) per row: every byte covered by a
    ``window``-byte string that also starts elsewhere is removed."""
    return Finder(Bytes, window, gram, CorpusOrder(window), PARSE_BYTES).remove(docs, doc_id, text)
