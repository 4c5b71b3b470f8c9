"""Periodic runs against a plain search, odd texts, and the query with its planted repeats."""

import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from scarp.llm import periodic_runs as pr
from scarp.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, shortest):
    """All maximal repetitions by comparing the sequence with itself at every distance."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            piece = words[i:i + length]
            if j > i and length >= max(shortest, 2 * q) and not any(
                    all(piece[k] == piece[k + g] for k in range(length - g)) for g in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(2, 14))
def test_runs_of_small_alphabets(words, shortest):
    want = plain_runs(words, shortest)
    assert pr.runs_of(words, shortest) == want
    assert pr.document_runs([b"w%d" % w for w in words], shortest) == want


def test_runs_in_longer_sequences():
    rnd = random.Random(5)
    for _ in range(40):
        words = [rnd.randrange(30) for _ in range(300)]
        for _ in range(3):
            at, period, times = rnd.randrange(300), rnd.randrange(1, 20), rnd.randrange(2, 6)
            words[at:at] = words[at:at + period] * times
        assert pr.document_runs([b"%d" % w for w in words]) == plain_runs(words, 12)


def damaged(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    words = WORD.findall(text or "")
    words = words if doc_id is None else damaged(doc_id, words)
    runs = plain_runs(words, 12)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_query_equals_the_plain_version(spark, tmpdir_local):
    rnd = random.Random(7)
    vocabulary = ["a", "b", "Ä", "word", " ", "x y", "\x1c", "\x85", "end."]
    texts = [None, "", " ", "\t\n \x0b\x0c\r", "one", "a " * 500, "a b c\x1cd " * 30]
    for n in (5, 11, 12, 13, 40, 120, 300):
        for _ in range(12):
            texts.append(rnd.choice([" ", "\n", "  \t"]).join(rnd.choice(vocabulary) if rnd.random() < 0.5 else str(rnd.randrange(1000)) for _ in range(n)))
    rows = [(k, t) for k, t in enumerate(texts * 3)] + [(None, "a " * 20), (None, None), (3, "same id")]
    spark.createDataFrame([(*r, "a", 1, 2) for r in rows], "doc_id long, text string, runs string, h int, w int").write.parquet(f"{tmpdir_local}/documents.parquet")
    got = queries.op11_periodic_runs(spark, tmpdir_local).collect()
    have = sorted((r.doc_id is not None, r.doc_id or 0, (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)) for r in got)
    want = sorted((i is not None, i or 0, expected(i, t)) for i, t in rows)
    assert repr(have) == repr(want)


def test_empty_table_and_long_text(spark, tmpdir_local):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmpdir_local}/documents.parquet")
    assert queries.op11_periodic_runs(spark, tmpdir_local).count() == 0
    words = [str(k) for k in range(50_000)]
    long = spark.createDataFrame([(1, " ".join(words + words))], "doc_id long, text string")
    r = pr.find_runs(long).first()
    assert [tuple(x) for x in r.runs] == [(0, 100_000, 50_000)] and r.collapsed == " ".join(words) and r.n_words == 100_000
