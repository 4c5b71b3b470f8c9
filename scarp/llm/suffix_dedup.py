"""Exact removal of repeated passages: every byte covered by a ``LENGTH``-byte string that starts anywhere else too.

The suffixes of a corpus are sorted to depth ``LENGTH`` by deep-shallow sorting. Sorting all of them is not needed: a
``LENGTH``-byte window picks one anchor, the position of the smallest hash among its ``GRAM``-byte grams, by content
alone, so equal windows pick the same gram at the same distance. Neighbouring windows share an anchor and form a run.

1. Anchors are computed once; only runs whose gram recurs in the corpus can hold a repeated window.
2. Whole runs (``text[lo : lo + n + LENGTH - 1]``) that recur are repeated altogether.
3. Of other runs, and of one run for every class of step 2, pieces of ``PIECE`` neighbouring windows (aligned to the
   anchor) go on when the bytes that all their windows share recur. Whole pieces are then judged like whole runs.
4. The windows of the other pieces, and of one piece per class, are judged one by one.

At each step the strings of a task are suffixes of its texts, sorted by deep-shallow sorting: multikey quicksort on eight
bytes at a time to a shallow depth (all groups of a round together in numpy), then a blind trie for every group that still
shares its prefix. Neighbours with a common prefix of their whole length are one class, and a class leaves the task as one
128-bit digest; the digests are summed over the corpus. A passage in a third of all texts thus costs one row per task, and
no group of equal strings is ever gathered. Texts are shuffled once, to meet their runs.

Defined results: null text has no bytes; each row is a document of its own, so two equal rows repeat each other; ids may
be null; other columns are ignored; texts of any length are handled in pieces of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, scratch_table, text_groups

LENGTH = 200
GRAM = 48
PIECE = 16            # windows in a piece of a run
LONG = 4_000_000      # windows handled at once
SHALLOW = 24          # bytes sorted by quicksort, in words of eight
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)


# -- anchors -----------------------------------------------------------------------------------------------------------
def gram_hashes(buf: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram``-byte run of a buffer (differences of a running polynomial sum, modulo 2^64)."""
    inverse = U(pow(int(_BASE), -1, 1 << 64))
    power = np.cumprod(np.r_[U(1), np.full(len(buf) - 1, _BASE)]) if len(buf) else np.zeros(0, U)
    total = np.r_[U(0), np.cumsum((buf.astype(U) + U(1)) * power)]
    n = len(buf) - gram + 1
    back = np.cumprod(np.r_[U(1), np.full(max(0, n - 1), inverse)])
    x = (total[gram:] - total[:n]) * back
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def runs_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows that share an anchor: text number, first window, windows, anchor minus first window, gram hash."""
    none = (np.zeros(0, np.int64),) * 5
    parts = [(k, s, t[s:s + LONG + length - 1]) for k, t in enumerate(texts) for s in range(0, max(0, len(t) - length + 1), LONG)]
    found, held, size = [none], [], 0
    for part in parts:
        held.append(part)
        size += len(part[2])
        if size >= LONG:
            found.append(_runs(held, length, gram))
            held, size = [], 0
    if held:
        found.append(_runs(held, length, gram))
    return tuple(np.concatenate(c) for c in zip(*found))


def _runs(parts: list[tuple[int, int, bytes]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of pieces of texts (text number, begin, bytes) that lie in one buffer of less than 2^24 bytes."""
    size = np.array([len(p) for *_, p in parts], np.int64)
    begin = np.cumsum(size) - size
    h = gram_hashes(np.frombuffer(b"".join(p for *_, p in parts), np.uint8), gram)
    low = U((1 << 24) - 1)
    place = np.arange(len(h), dtype=U)
    # ties go to the left
    best = sliding_min((h & ~low) | (place & low), length - gram + 1)
    windows = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begin, size)])
    owner = np.repeat(np.arange(len(parts)), size - length + 1)
    ahead = ((best[windows] - windows.astype(U)) & low).astype(np.int64)
    anchor = windows + ahead
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])])
    count = np.diff(np.r_[first, len(windows)])
    part = owner[first]
    lo = windows[first] - begin[part] + np.array([s for _, s, _ in parts])[part]
    return np.array([k for k, *_ in parts])[part], lo, count, anchor[first] - windows[first], h[anchor[first]].view(np.int64)


# -- deep-shallow sorting ----------------------------------------------------------------------------------------------
def deep_shallow(buf: bytes, starts: np.ndarray, lengths: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings ``buf[start : start + length]`` and the common prefix of each with the one before.

    Common prefixes are exact from ``shallow`` on; shorter ones are given as 0.
    """
    n = len(starts)
    data = np.frombuffer(buf + bytes(8), np.uint8)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for depth in range(0, shallow, 8):
        order, group = _quicksort_word(data, starts, lengths, order, group, depth)
    prefix = np.zeros(n, np.int64)
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if n else np.zeros(1, np.int64)
    for a in np.flatnonzero(np.diff(edges) > 1):
        lo, hi = int(edges[a]), int(edges[a + 1])
        members = order[lo:hi]
        strings = [buf[s:s + m] for s, m in zip(starts[members].tolist(), lengths[members].tolist())]
        sequence, common = blind_trie(strings)
        order[lo:hi] = members[sequence]
        prefix[lo:hi] = common
    return order, prefix


def _quicksort_word(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray, group: np.ndarray,
                    depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Ternary partitions on the eight bytes at ``depth``, all groups at once, until each group agrees on them.

    ``group`` holds for every place of the order the place at which its group begins.
    """
    todo = np.flatnonzero(np.bincount(group, minlength=len(group))[group] > 1)
    if not len(todo):
        return order, group
    who = order[todo]
    rest = np.clip(lengths[who] - depth, 0, 8)
    at = np.minimum(starts[who] + depth, len(data) - 8)
    word = np.lib.stride_tricks.sliding_window_view(data, 8)[at].copy().view(">u8")[:, 0].astype(U)
    word &= np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], U)[rest]
    live, begin = np.arange(len(todo)), group[todo]
    final = begin.copy()
    while len(live):
        # a group is split below, at and above its middle member; the end of a string comes before any byte
        first = np.flatnonzero(np.r_[True, begin[1:] != begin[:-1]])
        count = np.diff(np.r_[first, len(live)])
        pivot = np.repeat(live[first + count // 2], count)
        w, pw, r, pr = word[live], word[pivot], rest[live], rest[pivot]
        side = np.where(w != pw, np.where(w > pw, 1, -1), np.sign(r - pr))
        below = np.repeat(np.add.reduceat((side < 0).astype(np.int64), first), count)
        equal = np.repeat(np.add.reduceat((side == 0).astype(np.int64), first), count)
        begin = begin + np.where(side < 0, 0, np.where(side == 0, below, below + equal))
        final[live] = begin
        size = np.where(side < 0, below, np.repeat(count, count) - below - equal)
        go = (side != 0) & (size > 1)
        live, begin = live[go], begin[go]
        perm = np.argsort(begin, kind="stable")
        live, begin = live[perm], begin[perm]
    rank = np.argsort(final, kind="stable")
    order, group = order.copy(), group.copy()
    order[todo], group[todo] = who[rank], final[rank]
    return order, group


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Sorted order of strings and common prefixes, by a trie that stores branching bytes and depths only.

    A string goes down blindly to some leaf, is compared with that one leaf, and branches off at the depth found.
    """
    number = [int.from_bytes(s, "big") for s in strings]
    sizes = [len(s) for s in strings]
    root: list = [-1, {}, [0]]  # depth, children by byte (-1: the string ends), members; leaves have depth -1
    for k in range(1, len(strings)):
        s, node = strings[k], root
        while node[0] >= 0:
            children = node[1]
            node = children.get(s[node[0]] if node[0] < sizes[k] else -1) or next(iter(children.values()))
        other = node[2][0]
        short = min(sizes[k], sizes[other])
        x = (number[k] >> 8 * (sizes[k] - short)) ^ (number[other] >> 8 * (sizes[other] - short))
        common = short - (x.bit_length() + 7) // 8
        if common == sizes[k] == sizes[other]:
            node[2].append(k)
            continue
        node = root
        while 0 <= node[0] < common:
            child = node[1].get(s[node[0]] if node[0] < sizes[k] else -1)
            if child is None:
                break
            node = child
        if node[0] == common:
            node[1][s[common] if common < sizes[k] else -1] = [-1, {}, [k]]
        else:
            old = [node[0], node[1], node[2]]
            t = strings[other]
            node[0], node[2] = common, []
            node[1] = {t[common] if common < sizes[other] else -1: old, s[common] if common < sizes[k] else -1: [-1, {}, [k]]}
    order: list[int] = []
    prefix: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, before = stack.pop()
        if node[0] < 0:
            order.extend(node[2])
            prefix.extend([before] + [sizes[node[2][0]]] * (len(node[2]) - 1))
            continue
        keys = sorted(node[1])
        for k in reversed(keys):
            stack.append((node[1][k], before if k == keys[0] else node[0]))
    return order, prefix


def digests(buf: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """128-bit digest of every string as two integers, computed once per class of equal strings."""
    import xxhash

    order, prefix = deep_shallow(buf, starts, lengths)
    same = np.r_[False, (prefix[1:] == lengths[order][1:]) & (prefix[1:] == lengths[order][:-1])] if len(order) else np.zeros(0, bool)
    heads = order[~same]
    one = b"".join(xxhash.xxh3_128_digest(buf[s:s + n]) for s, n in zip(starts[heads].tolist(), lengths[heads].tolist()))
    out = np.zeros((len(starts), 2), np.int64)
    out[order] = np.frombuffer(one, np.int64).reshape(-1, 2)[np.cumsum(~same) - 1]
    return out


# -- steps -------------------------------------------------------------------------------------------------------------
def whole_runs(lo: np.ndarray, n: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, ...]:
    """Source row, first window, windows, anchor distance, begin and length of the string that decides: the whole run."""
    return np.arange(len(lo)), lo, n, ahead, lo, n + LENGTH - 1


def pieces_of(lo: np.ndarray, n: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs cut into pieces by the distance to the anchor; the string is what all windows of a piece share."""
    last = (ahead - n + 1) // PIECE
    count = ahead // PIECE - last + 1
    source = np.repeat(np.arange(len(lo)), count)
    number = ahead[source] // PIECE - (np.arange(len(source)) - np.repeat(np.cumsum(count) - count, count))
    anchor = (lo + ahead)[source]
    first = np.maximum(lo[source], anchor - number * PIECE - PIECE + 1)
    end = np.minimum((lo + n)[source], anchor - number * PIECE + 1)
    return source, first, end - first, anchor - first, anchor - number * PIECE, np.full(len(source), LENGTH - PIECE + 1)


def single_windows(lo: np.ndarray, n: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, ...]:
    source = np.repeat(np.arange(len(lo)), n)
    first = lo[source] + np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
    return source, first, np.ones(len(source), np.int64), (lo + ahead)[source] - first, first, np.full(len(source), LENGTH)


def key_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, text``; rows with the same id and text share a key (and are told apart by their number)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("doc_id", "text", F.lit(1)).alias("key"), F.xxhash64("text", "doc_id").alias("key2"), "text")


KEY = ["key", "key2"]


def anchor_runs(rows: DataFrame) -> DataFrame:
    """``key, key2, lo, n, ahead, gram`` of every run in the corpus."""
    names = [*KEY, "lo", "n", "ahead", "gram"]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_groups(batch, chars=1_000_000):
                keys = [batch.column(c).slice(at, len(texts)).to_numpy() for c in KEY]
                who, *columns = runs_of([t.encode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*(k[who] for k in keys), *columns], types)], names=names)

    return rows.select(*KEY, "text").mapInArrow(run, "key long, key2 long, lo int, n short, ahead short, gram long")


def digested(texts: DataFrame, runs: DataFrame, cut: Callable, one_row: bool = False) -> DataFrame:
    """The strings of one step with their digests: ``key, key2, lo, n, ahead, d1, d2`` for every text that has runs.

    ``one_row``: rows that share a key (equal rows, whose runs have all been found in step 2) are taken once.
    """
    grouped = runs.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "n", "ahead")).alias("runs"))  # bounded by one text
    names = [*KEY, "lo", "n", "ahead", "d1", "d2"]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, group in text_groups(batch, chars=1_000_000):
                raw = [t.encode("utf-8", "replace") for t in group]
                begin = np.cumsum([0, *map(len, raw)])[:-1]
                column = batch.column("runs").slice(at, len(group))
                flat = column.flatten()
                owner = np.repeat(np.arange(len(group)), np.diff(column.offsets.to_numpy()))
                lo, n, ahead = (flat.field(k).to_numpy().astype(np.int64) for k in range(3))
                source, first, count, dist, start, length = cut(lo, n, ahead)
                text = owner[source]
                d = digests(b"".join(raw), start + begin[text], length)
                keys = [batch.column(c).slice(at, len(group)).to_numpy()[text] for c in KEY]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*keys, first, count, dist, d[:, 0], d[:, 1]], types)], names=names)

    joined = texts.dropDuplicates(KEY) if one_row else texts
    joined = joined.join(grouped, KEY).select(*KEY, "text", "runs")
    return joined.mapInArrow(run, "key long, key2 long, lo int, n short, ahead short, d1 long, d2 long")


def recurring(strings: DataFrame, name: str) -> DataFrame:
    """Digests that occur more than once in the corpus, and the run that stands for each (``r``)."""
    each = strings.groupBy("d1", "d2").agg(F.count("*").alias("times"), F.min(F.struct(*KEY, "lo", "n", "ahead")).alias("r"))
    return scratch_table(each.where("times > 1").select("d1", "d2", "r"), name)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts that hold candidates (``key, key2, text``), and ``key, key2, lo, n``: runs of repeated windows."""
    rows = key_columns(docs, id_col, text_col)
    anchors = scratch_table(anchor_runs(rows), "anchors")
    grams = scratch_table(anchors.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1").select("gram"), "grams")
    runs = scratch_table(anchors.join(grams, "gram").select(*KEY, "lo", "n", "ahead"), "runs")
    discard(anchors)
    texts = scratch_table(rows.select(*KEY, "text").join(runs.select(*KEY).distinct(), KEY, "left_semi"), "texts")
    found, rest = settled(scratch_table(digested(texts, runs, whole_runs), "whole"))
    pieces = scratch_table(digested(texts, rest, pieces_of, one_row=True), "pieces")
    likely = pieces.join(recurring(pieces, "pieces-twice").select("d1", "d2"), ["d1", "d2"])
    more, rest = settled(scratch_table(digested(texts, likely, whole_runs, one_row=True), "whole-pieces"))
    discard(pieces)
    windows = scratch_table(digested(texts, rest, single_windows, one_row=True), "windows")
    last = windows.join(recurring(windows, "windows-twice").select("d1", "d2"), ["d1", "d2"]).select(*KEY, "lo", "n")
    return texts, found.unionByName(more).unionByName(last).distinct()


def settled(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs whose whole strings recur, and the runs that are still open.

    A window of an open run can equal one inside a recurring run, so one run of each recurring class stays open too.
    """
    twice = recurring(strings, "twice")
    found = strings.join(twice.select("d1", "d2"), ["d1", "d2"]).select(*KEY, "lo", "n")
    rest = strings.join(twice.select("d1", "d2"), ["d1", "d2"], "left_anti").select(*KEY, "lo", "n", "ahead")
    return found, rest.unionByName(twice.select("r.*"))


def merged(lo: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the windows of the runs."""
    out: list[tuple[int, int]] = []
    for k in np.argsort(lo, kind="stable"):
        a, b = int(lo[k]), int(lo[k] + n[k] + LENGTH - 1)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut_texts(texts: DataFrame, found: DataFrame, columns: str, make: Callable[[bytes, list[tuple[int, int]]], tuple]) -> DataFrame:
    """One row per key that has repeats: ``make(bytes, spans)`` beside the key."""
    grouped = found.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "n")).alias("runs"))
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, group in text_groups(batch):
                rows = []
                for text, runs in zip(group, batch.column("runs").slice(at, len(group))):
                    lo, n = (runs.values.field(k).to_numpy() for k in range(2))
                    rows.append(make(text.encode("utf-8", "replace"), merged(lo.astype(np.int64), n.astype(np.int64))))
                keys = [batch.column(c).slice(at, len(group)) for c in KEY]
                yield pa.RecordBatch.from_arrays(keys + [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=KEY + names)

    return texts.dropDuplicates(KEY).join(grouped, KEY).select(*KEY, "text", "runs").mapInArrow(run, f"key long, key2 long, {columns}")


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    done, out = 0, []
    for a, b in spans:
        out.append(raw[done:a])
        done = b
    return b"".join(out) + raw[done:]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, kept``: the bytes that are left."""
    texts, found = repeated_spans(docs, id_col, text_col)
    cut = scratch_table(cut_texts(texts, found, "kept binary", lambda raw, spans: (without(raw, spans),)), "kept")
    rows = key_columns(docs, id_col, text_col)
    return rows.join(cut, KEY, "left").select("doc_id", F.coalesce("kept", F.col("text").cast("binary")).alias("kept"))


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    texts, found = repeated_spans(docs, id_col, text_col)

    def make(raw: bytes, spans: list[tuple[int, int]]) -> tuple:
        return sum(b - a for a, b in spans), len(spans), hashlib.sha256(without(raw, spans)).hexdigest()

    cut = scratch_table(cut_texts(texts, found, "n_removed long, n_spans long, kept string", make), "cut")
    base = key_columns(docs, id_col, text_col).select(
        "doc_id", *KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("whole"))

    def or_zero(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("long")).alias(name)

    return base.join(cut, KEY, "left").select("doc_id", "n_bytes", or_zero("n_removed"), or_zero("n_spans"),
                                              F.coalesce("kept", "whole").alias("kept_sha256"))
