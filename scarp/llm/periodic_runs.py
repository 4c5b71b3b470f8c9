"""Periodic runs of words: maximal repetitions found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are equal), at least ``max(min_words, 2q)``
words long, that no neighbouring word extends. For every document all of them are found:

* the suffix automaton of the words is built; its suffix links form a tree in which the path from prefix i to the root
  holds every string that ends at word i, each node a class of strings with the same ends;
* the prefixes are then taken in order. Accessing prefix i in a link-cut tree makes its root path one preferred path; the
  path is recoloured with i, so a preferred path always holds the strings whose last occurrence ends at one and the
  same word. What the access cuts up on its way are the path's former segments. A segment that ended at word e and
  reaches down to strings of L words says: the L words up to i last ended at e, no longer string did. If the distance
  i - e is at most L the two occurrences touch, which is a square, and the words ``i - L - (i - e) + 1 .. i`` have the
  period i - e; they cannot be extended to the left, and i - e is their smallest period, since a smaller one would be a
  later occurrence;
* the stretch is a run as soon as the next word differs from the one a period before it. Every run shows up like this at
  its last word, so each is met exactly once.

Only words that can lie in a run enter the automaton. A run of at least ``min_words`` words is covered by groups of
``min_words // 2`` consecutive words that occur twice in the document: within the first and within the last period if
the period is that long, anywhere otherwise. So the words are cut at those that no repeated group covers (found by
sorting group hashes; equal groups always have equal hashes, a collision only lets more words in), and a run lies in one
piece with its whole neighbourhood.

Each document is one unit of work of O(n log n) steps, in the task that scans it: no shuffle, so neither hot sources nor
groups of copies matter, and a lost executor repeats its splits only.

Defined results: null and empty texts have no words and no runs; words are maximal strings of characters other than
space and U+0009 to U+000D, compared byte by byte; rows with a null or repeated id are rows of their own; other columns
are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, map_texts

MIN_WORDS = 12
# odd multipliers that mix the hashes of the words of a group
_MIX = 0x9E3779B97F4A7C15


def suffix_automaton(words: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and length of the longest string of every state, and the state of every prefix."""
    link, length, move = [-1], [0], [{}]
    prefix, last = [], 0
    for word in words:
        state = len(link)
        link.append(0)
        length.append(length[last] + 1)
        move.append({})
        p = last
        while p >= 0 and word not in move[p]:
            move[p][word] = state
            p = link[p]
        if p >= 0:
            q = move[p][word]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                move.append(move[q].copy())
                while p >= 0 and move[p].get(word) == q:
                    move[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        prefix.append(state)
        last = state
    return link, length, prefix


class LastEnds:
    """Link-cut tree over suffix links; a preferred path holds the strings whose last occurrence ends at one word.

    Preferred paths are splay trees ordered by depth, joined by their topmost pointers; the word is kept at the root of
    each splay tree (-1: the strings of the path have not occurred yet).
    """

    def __init__(self, link: Sequence[int]):
        n = len(link)
        self.up = list(link)
        self.left = [-1] * n
        self.right = [-1] * n
        self.end = [-1] * n

    def _splay(self, x: int) -> None:
        up, left, right, end = self.up, self.left, self.right, self.end
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g >= 0 and (left[g] == p or right[g] == p)
            turns = (p, x) if inner and (left[g] == p) == (left[p] == x) else (x, x) if inner else (x,)
            for y in turns:                                  # rotate y above its parent
                a = up[y]
                b = up[a]
                if b >= 0 and left[b] == a:
                    left[b] = y
                elif b >= 0 and right[b] == a:
                    right[b] = y
                else:
                    end[y] = end[a]                          # y becomes the root of the splay tree
                if left[a] == y:
                    c = left[a] = right[y]
                    right[y] = a
                else:
                    c = right[a] = left[y]
                    left[y] = a
                if c >= 0:
                    up[c] = a
                up[a] = y
                up[y] = b

    def access(self, node: int, end: int) -> Iterator[tuple[int, int]]:
        """Recolour the path from ``node`` to the root with ``end``; yields (deepest node, former end) of its segments."""
        x, below = node, -1
        while x >= 0:
            self._splay(x)
            was, cut = self.end[x], self.right[x]
            if was >= 0:
                yield x, was
            if cut >= 0:
                self.end[cut] = was                          # what lay deeper keeps its colour
            self.right[x] = below
            below, x = x, self.up[x]
        self.end[below] = end


def runs_of(words: Sequence[int], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a sequence, by start, then period."""
    n = len(words)
    link, length, prefix = suffix_automaton(words)
    tree, out = LastEnds(link), []
    for i, state in enumerate(prefix):
        for node, was in tree.access(state, i):
            reach, period = length[node], i - was
            if period <= reach and reach + period >= min_words and (i + 1 == n or words[i + 1] != words[i + 1 - period]):
                out.append((i - reach - period + 1, reach + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeated_pieces(codes: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """``[start, end)`` of the maximal stretches covered by groups of ``min_words // 2`` words that occur twice."""
    size = max(1, min_words // 2)
    n = len(codes) - size + 1
    if len(codes) < min_words or n < 2:
        return []
    groups, mix = np.zeros(n, np.uint64), 1
    for k in range(size):
        mix = mix * _MIX & 0xFFFFFFFFFFFFFFFF
        groups += codes[k:k + n] * np.uint64(mix)
    order = np.argsort(groups, kind="stable")
    ranked = groups[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return []
    steps = np.zeros(len(codes) + 1, np.int64)
    first = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    np.add.at(steps, first, 1)
    np.add.at(steps, first + size, -1)
    inside = np.concatenate([[False], np.cumsum(steps[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= min_words]


def document_runs(words: list[bytes], min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Runs of a document's words, by start, then period."""
    if len(words) < min_words:
        return []
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = []
    for a, b in repeated_pieces(codes, min_words):
        number: dict[bytes, int] = {}
        piece = [number.setdefault(w, len(number)) for w in words[a:b]]
        out += [(a + start, length, period) for start, length, period in runs_of(piece, min_words)]
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when every run keeps its first period only, joined by one space.

    A word goes if any run contains it after that run's first period.
    """
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(steps[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` holds ``start`` (number of the first word), ``length`` and ``period`` by start, then period; ``collapsed``
    is the text with every run cut to its first period.
    """
    def make() -> Callable[[list[str]], Iterable[pa.Array]]:
        def work(texts: list[str]) -> Iterable[pa.Array]:
            counts, found, left = [], [], []
            for text in texts:
                words = text.encode().split()                # bytes split at space and 09-0D only
                runs = document_runs(words, min_words)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                left.append(collapsed(words, runs).decode())
            return pa.array(counts, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(left, pa.string())
        return work

    schema = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return map_texts(id_text(docs, id_col, text_col), make, schema)
