"""Repeated passages of words by prefix-partitioned suffix trees (operator 4).

Suffixes are dealt out to groups by a string of variable length that their own content
chooses (see ``repeats``): at first the eight words of the anchor, and where a group is
too large for memory a longer string, lengthened, counted and dealt again until the group
fits. All suffixes of a group that start equally come together, so its suffix tree is a
whole part of the corpus's tree, down to the window's depth and as far as its texts go.

A group's tree is held as its sorted suffixes and the lengths of neighbours' common
prefixes, which are its leaves and inner nodes: a run of neighbours that share d words at
least is the node of that depth, and its strings are the maximal repeats. The topmost
nodes of the window's depth or more spell the repeats, and all leaves below them are the
starts to report.

Words are matched by 64-bit hashes. Defined results: null and blank texts have no
words; texts shorter than the window lose nothing; repeated rows are repeats of one
another; null ids are results like others; an empty table gives an empty table; only
doc_id and text are read, so other columns, whatever their names, don't matter. Very
long texts are read whole, their windows in chunks of fixed size.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from threshline.llm.repeats import Finder, Words, common, doubled

#: Words of a window, and of the strings whose hash can be its anchor.
WINDOW, GRAM = 35, 8
#: Words of the trees that a task builds at once.
SUBTREE_WORDS = 400_000


class SuffixTree:
    """The suffix tree of several texts' word codes; ``leaves`` are its sorted suffixes,
    ``shared[i]`` the words that leaf i shares with the leaf before it."""

    def __init__(self, texts: list[np.ndarray]):
        # Every text ends in a mark of its own, so that no string passes its end.
        sizes = np.array([len(t) + 1 for t in texts])
        self.offset = np.cumsum(sizes) - sizes
        marks = self.offset + sizes - 1
        codes = np.zeros(int(sizes.sum()), np.uint64)
        is_word = np.ones(len(codes), bool)
        is_word[marks] = False
        codes[is_word] = np.concatenate(texts)
        words, first = np.unique(codes[is_word], return_inverse=True)
        rank = np.empty(len(codes), np.int64)
        rank[is_word], rank[marks] = first, len(words) + np.arange(len(marks))
        levels = doubled(rank, 1, len(rank), int(sizes.max()))
        self.leaves = np.argsort(levels[-1][1])  # all suffixes differ
        self.shared = np.concatenate([[0], common(levels, self.leaves[:-1], self.leaves[1:])])

    def nodes(self, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The topmost inner nodes of ``depth`` or more: (first leaf, last leaf, words)."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (self.shared >= depth).astype(np.int8), [0]])))
        first, last = edge[::2] - 1, edge[1::2] - 1  # a run's first leaf shares with the next
        words = np.minimum.reduceat(np.append(self.shared, 0), np.stack([first + 1, last + 1], 1).ravel())[::2] if len(first) else first
        return first, last, words

    def below(self, depth: int) -> np.ndarray:
        """True at the places whose leaf is below an inner node of ``depth`` or more."""
        first, last, _ = self.nodes(depth)
        change = np.zeros(len(self.leaves) + 1, np.int64)
        np.add.at(change, first, 1)
        np.add.at(change, last + 1, -1)
        out = np.zeros(len(self.leaves), bool)
        out[self.leaves] = np.cumsum(change[:-1]) > 0
        return out


class DeepLeaves:
    """For each text of whole groups the starts below a node of the window's depth."""

    def __init__(self, window: int):
        self.window = window

    def __call__(self, contents: list[bytes], starts: list[int]) -> list[np.ndarray]:
        kind = Words()
        tree = SuffixTree([kind.codes(kind.unpack(c)) for c in contents])
        deep = tree.below(self.window)
        return [deep[o : o + s] for o, s in zip(tree.offset.tolist(), starts, strict=True)]


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_units, n_removed, spans, kept) per row: every word covered by a
    ``window``-word sequence that also starts elsewhere is removed."""
    return Finder(Words, window, gram, DeepLeaves(window), SUBTREE_WORDS).remove(docs, doc_id, text)
