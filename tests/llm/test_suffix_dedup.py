import hashlib
import random
from collections import Counter

import numpy as np

from scarp.llm import suffix_dedup as sd


def brute(rows):
    seen = Counter()
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        seen.update(raw[k:k + 200] for k in range(len(raw) - 199))
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - 199):
            if seen[raw[k:k + 200]] > 1:
                gone[k:k + 200] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def invented(seed=1, n=40):
    rng = random.Random(seed)

    def text(k):
        return " ".join(rng.choice(["ärger", "b", "cat", "dog ", "é", "ff\n", "12"]) + str(rng.randrange(900)) for _ in range(k))
    shared = [text(rng.choice([20, 40, 60, 300])) for _ in range(6)] + ["-" * 230, "ab" * 150, text(30)[:199], text(40)[:201]]
    rows = []
    for k in range(n):
        parts = [text(rng.randrange(0, 80)) for _ in range(3)]
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            cut = rng.randrange(len(s)) if rng.random() < 0.5 else 0
            parts.insert(rng.randrange(4), s[cut:])
        rows.append((k, "".join(parts)))
    return rows + [(900, "x" * 400), (901, None), (902, ""), (903, rows[3][1]), (3, rows[3][1]), (3, rows[3][1]), (None, rows[5][1])]


def test_deep_shallow_sorts_and_gives_common_prefixes():
    rng = random.Random(0)
    for _ in range(60):
        buf = bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 400))) + b"abcdefgh" * rng.randint(0, 20)
        n = rng.randint(1, 80)
        starts = np.array([rng.randrange(len(buf)) for _ in range(n)])
        lengths = np.array([rng.randint(0, len(buf) - s) for s in starts])
        order, prefix = sd.deep_shallow(buf, starts, lengths)
        strings = [buf[s:s + m] for s, m in zip(starts, lengths)]
        got = [strings[k] for k in order]
        assert got == sorted(strings)
        for a, b, p in zip(got, got[1:], prefix[1:]):
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert p == common or (p == 0 and common < sd.SHALLOW) or (len(a) < sd.SHALLOW and p == common)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(4)
    shared = bytes(rng.choice(b"ab") for _ in range(500))
    texts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 300))) + shared + b"zz" * k for k in range(5)] + [b"-" * 700, b"x"]
    who, lo, n, ahead, gram = sd.runs_of(texts)
    place = {}
    for t, a, c, d, g in zip(who, lo, n, ahead, gram):
        for k in range(c):
            window = texts[t][a + k:a + k + 200]
            assert len(window) == 200
            assert place.setdefault(window, (d - k, g)) == (d - k, g)
    assert n.sum() == sum(max(0, len(t) - 199) for t in texts)


def test_against_all_windows(spark):
    rows = invented()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_spans int").repartition(3)
    got = sorted((tuple(r) for r in sd.removal_digests(df).collect()), key=str)
    want = brute(rows)
    assert got == want and sum(w[2] > 0 for w in want) > 10
    kept = {hashlib.sha256(bytes(r.kept)).hexdigest() for r in sd.remove_repeats(df).collect()}
    assert kept == {w[4] for w in want}


def test_long_texts_in_pieces_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(sd, "LONG", 100)
    rng = random.Random(8)
    a = "".join(rng.choice("abc") for _ in range(3000))
    rows = [(1, a), (2, "zz" + a[500:1900] + "yy"), (3, "q")]
    texts = [t.encode() for _, t in rows]
    who, lo, n, ahead, gram = sd.runs_of(texts)
    assert n.max() <= 100 and n.sum() == sum(max(0, len(t) - 199) for t in texts)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sd.removal_digests(df.limit(0)).count() == 0
