"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

The vocabulary file is a parameter (a ``tokenizers`` JSON of the byte-level BPE kind). The driver reads it once; the
tables made from it have the size of the vocabulary, whatever the corpus, and travel with the task closure.

Texts are cut into units at single spaces, and units into words by the public GPT-2 pattern. The distinct words of the
new units of a group of texts are encoded together: their symbols lie in one flat array, each round looks up the rank of every neighbouring pair by binary search
over the sorted pair keys, and merges the lowest-ranked pair of every word at all its places. Words that have nothing
left to merge retire, so a round costs what is still open. A per-task table keeps the ids of units
already seen.

Defined results: null text is the empty text (no tokens, the digests of nothing); repeated rows and null ids give one
row each; texts of any length are encoded whole, unit list by unit list, so memory is bounded by one group of units.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text, map_texts

# fixed value: the public GPT-2 word pattern
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# a word never reaches over a single space between two other characters, so a text can be cut there
UNIT_BREAK = re.compile(r"(?<=\S) (?=\S)")
LONG_WORD = 300        # bytes; longer words would need too many rounds and are merged with a heap
CACHE_UNITS = 600_000  # the table of seen units is emptied beyond this size
CHUNK_UNITS = 300_000  # units encoded at once
PIECE_CHARS = 1_000_000  # longer texts are cut into units piece by piece


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others
    for the code points from 256 on, in byte order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in own}
    rest = [b for b in range(256) if b not in set(own)]
    table.update({chr(256 + k): b for k, b in enumerate(rest)})
    return table


def read_vocabulary(path: str) -> dict:
    """Tables of a byte-level BPE file: sorted pair keys with rank and product, byte ids, token bytes, added tokens."""
    with open(path, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    model, alphabet = spec["model"], byte_alphabet()
    pre = spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer"):
        raise ValueError("a byte-level BPE vocabulary without a normalizer is needed")
    if pre.get("add_prefix_space"):
        raise ValueError("vocabularies that add a leading space are not supported")
    vocab = model["vocab"]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([*vocab.values(), *added.values()]) + 1
    token_bytes = [b""] * size
    for token, i in vocab.items():
        token_bytes[i] = bytes(alphabet[c] for c in token)
    for token, i in added.items():
        token_bytes[i] = token.encode()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    keys = left * size + right
    order = np.argsort(keys, kind="stable")
    return {
        "digest": hashlib.sha256(raw).hexdigest(), "size": size, "keys": keys[order], "ranks": order.astype(np.int64), "made": made[order],
        "byte_ids": np.array([vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])], np.int64),
        "token_bytes": token_bytes, "added": added,
    }


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs numbered ``at`` of a flat array, one after the other, and their lengths."""
    counts = counts[at]
    ends = np.cumsum(counts)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - ends + counts, counts)
    return flat[where], counts


_LOADED: dict[str, Bpe] = {}


def loaded(tables: dict) -> Bpe:
    """The encoder of this worker process: its table of units serves one task after the other."""
    if tables["digest"] not in _LOADED:
        _LOADED[tables["digest"]] = Bpe(tables)
    return _LOADED[tables["digest"]]


class Bpe:
    """Encoder and decoder over the tables of :func:`read_vocabulary`."""

    def __init__(self, tables: dict) -> None:
        self.t = tables
        self.words = regex.compile(WORD_PATTERN)
        added = sorted(tables["added"], key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    # -- units ---------------------------------------------------------------------------------------------------
    def unit_lists(self, text: str) -> Iterator[list[str]]:
        """The units of a text in lists of bounded length; an added token is a unit of its own."""
        at = 0
        for m in (self.added.finditer(text) if self.added else ()):
            yield from self._plain(text, at, m.start())
            yield [m.group()]
            at = m.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, start: int, end: int) -> Iterator[list[str]]:
        while start < end:
            cut = UNIT_BREAK.search(text, start + PIECE_CHARS, end) if end - start > PIECE_CHARS else None
            stop = cut.start() if cut else end
            first, *rest = UNIT_BREAK.split(text[start:stop])
            yield [first, *[" " + u for u in rest]]
            start = stop

    # -- merging -------------------------------------------------------------------------------------------------
    def merge_rounds(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one flat array, and their number per word."""
        keys, ranks, made, size = (self.t[k] for k in ("keys", "ranks", "made", "size"))
        none = np.int64(len(keys))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.t["byte_ids"][np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)

        def look_up(i: np.ndarray) -> np.ndarray:
            """Place in ``keys`` of the pairs that begin at ``i``; ``none`` where there is no such merge."""
            pair = sym[i] * size + sym[i + 1]
            at = np.searchsorted(keys, pair)
            at[at == len(keys)] = 0
            return np.where((keys[at] == pair) & (word[i] == word[i + 1]), at, none)

        ranks = np.append(ranks, none)
        pairs = np.full(len(sym), none)
        if len(keys) and len(sym) > 1:
            pairs[:-1] = look_up(np.arange(len(sym) - 1))
        done_sym, done_word = [], []
        while len(sym):
            rank = ranks[pairs]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(sym)]))
            stay = best < none
            done_sym.append(sym[~stay])
            done_word.append(word[~stay])
            hit = np.flatnonzero(stay & (rank == best))
            if len(hit):
                # places that overlap (a a a) merge every second one, from the left
                run = np.flatnonzero(np.r_[True, np.diff(hit) > 1])
                place = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
                hit = hit[place % 2 == 0]
                sym[hit] = made[pairs[hit]]
                stay[hit + 1] = False
                merged = np.cumsum(stay)[hit] - 1
            sym, word, pairs = sym[stay], word[stay], pairs[stay]
            if len(hit):
                # only the pairs on both sides of a merged symbol are new
                pairs[-1] = none
                pairs[merged] = none
                right, left = merged[merged < len(sym) - 1], merged[merged > 0] - 1
                pairs[right] = look_up(right)
                pairs[left] = look_up(left)
        if not done_sym:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        ids, owner = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(owner, minlength=len(words))

    def merge_long(self, word: bytes) -> list[int]:
        """One very long word: a linked list and a heap of (rank, place)."""
        keys, ranks, made, size = (self.t[k] for k in ("keys", "ranks", "made", "size"))
        sym = self.t["byte_ids"][np.frombuffer(word, np.uint8)].tolist()
        nxt = [*range(1, len(sym)), -1]
        prev = [*range(-1, len(sym) - 1)]
        table = self._pairs()
        heap = [(table[p][0], k, p) for k, p in enumerate(zip(sym, sym[1:])) if p in table]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            j = nxt[k]
            if sym[k] != pair[0] or j < 0 or sym[j] != pair[1]:
                continue
            sym[k], sym[j] = table[pair][1], -1
            nxt[k] = nxt[j]
            if nxt[k] >= 0:
                prev[nxt[k]] = k
            for a, b in ((prev[k], k), (k, nxt[k])):
                if a >= 0 and b >= 0 and (sym[a], sym[b]) in table:
                    p = (sym[a], sym[b])
                    heapq.heappush(heap, (table[p][0], a, p))
        return [s for s in sym if s >= 0]

    def _pairs(self) -> dict[tuple[int, int], tuple[int, int]]:
        if not hasattr(self, "_pair_table"):
            t = self.t
            self._pair_table = {(int(k) // t["size"], int(k) % t["size"]): (int(r), int(m))
                                for k, r, m in zip(t["keys"], t["ranks"], t["made"])}
        return self._pair_table

    def _learn(self, units: list[str]) -> None:
        """Add units to the table: their distinct words are merged together."""
        added = self.t["added"]
        lists = [[u] if u in added else self.words.findall(u) for u in units]
        number = {w: k for k, w in enumerate(dict.fromkeys(w for words in lists for w in words))}
        raw = [w.encode() for w in number]
        long = {k: [added[w]] if w in added else self.merge_long(raw[k])
                for w, k in number.items() if w in added or len(raw[k]) > LONG_WORD}
        for k in long:
            raw[k] = b""
        flat, counts = self.merge_rounds(raw)
        starts = np.cumsum(counts) - counts
        for k, ids in long.items():
            starts[k], counts[k] = len(flat), len(ids)
            flat = np.concatenate([flat, np.array(ids, np.uint32)])
        per_unit = np.array([len(words) for words in lists], np.int64)
        at = np.array([number[w] for words in lists for w in words], np.int64)
        flat, of_words = gather(flat, starts, counts, at)
        ends = np.r_[0, np.cumsum(of_words)][np.cumsum(per_unit)]
        counts = np.diff(np.r_[0, ends])
        self.index.update(zip(units, range(len(self.starts), len(self.starts) + len(units))))
        self.starts = np.concatenate([self.starts, len(self.flat) + ends - counts])
        self.counts = np.concatenate([self.counts, counts])
        self.flat = np.concatenate([self.flat, flat])

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a list of units in a flat array, and their number per unit."""
        if len(self.index) > CACHE_UNITS:
            self._reset()
        new = [u for u in dict.fromkeys(units) if u not in self.index]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))
        return gather(self.flat, self.starts, self.counts, at)

    def encode(self, text: str) -> list[int]:
        return [i for units in self.unit_lists(text) for i in self.encode_units(units)[0].tolist()]

    # -- decoding ------------------------------------------------------------------------------------------------
    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.t["token_bytes"].__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _pieces(bpe: Bpe, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, ids) pieces in order; the units of many texts are encoded together."""
    held: list[tuple[int, list[str]]] = []
    size = 0

    def flush() -> Iterator[tuple[int, np.ndarray]]:
        ids, counts = bpe.encode_units([u for _, units in held for u in units])
        ends = np.r_[0, np.cumsum(counts)]
        at = 0
        for k, units in held:
            yield k, ids[ends[at]:ends[at + len(units)]]
            at += len(units)

    for k, text in enumerate(texts):
        for units in bpe.unit_lists(text):
            held.append((k, units))
            size += len(units)
            if size >= CHUNK_UNITS:
                yield from flush()
                held, size = [], 0
    if held:
        yield from flush()


def encode_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text: ``doc_id, ids array<int>, decoded string``."""
    tables = read_vocabulary(tokenizer_path)

    def make():
        bpe = loaded(tables)

        def work(texts: list[str]):
            ids: list[list[int]] = [[] for _ in texts]
            for k, piece in _pieces(bpe, texts):
                ids[k].extend(piece.tolist())
            yield pa.array(ids, pa.list_(pa.int32()))
            yield pa.array([bpe.decode(x) for x in ids], pa.string())
        return work

    return map_texts(id_text(docs, id_col, text_col), make, "ids array<int>, decoded string")


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again; per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The digests are those of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8. They
    are fed piece by piece, so neither ids nor decoded text of a long document are ever held whole.
    """
    tables = read_vocabulary(tokenizer_path)

    def make():
        bpe = loaded(tables)

        def work(texts: list[str]):
            n = [0] * len(texts)
            of_ids = [hashlib.sha256() for _ in texts]
            of_text = [hashlib.sha256() for _ in texts]
            readers: dict[int, codecs.IncrementalDecoder] = {}
            for k, ids in _pieces(bpe, texts):
                n[k] += len(ids)
                of_ids[k].update(ids.astype("<u4").tobytes())
                if k not in readers:
                    _finish(readers, of_text)
                    readers = {k: codecs.getincrementaldecoder("utf-8")("replace")}
                of_text[k].update(readers[k].decode(bpe.decode_bytes(ids.tolist())).encode())
            _finish(readers, of_text)
            yield pa.array(n, pa.int64())
            yield pa.array([h.hexdigest() for h in of_ids], pa.string())
            yield pa.array([h.hexdigest() for h in of_text], pa.string())
        return work

    return map_texts(id_text(docs, id_col, text_col), make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _finish(readers: dict, digests: list) -> None:
    """Feed what incomplete byte sequences at the end of a text decode to."""
    for k, reader in readers.items():
        digests[k].update(reader.decode(b"", True).encode())
