import random
import re

import numpy as np

from scarp.llm import near_dup as nd

U0 = np.zeros(1, np.uint64)


def brute(rows):
    """Component and set size by comparing all pairs."""
    sets = {}
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        ws = [w for w in re.split("[\x20\x09-\x0d]+", low) if w]
        sets[i] = ({tuple(ws)} if ws else set()) if len(ws) < 5 else {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                lo, hi = sorted((root(a), root(b)))
                label[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in ids}


def invented(seed=2, n=30):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    rows = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 8, 20, 60, 200]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            if rng.random() < 0.3:
                own = own[:-1]
            rows.append((len(rows), rng.choice([" ", "\n", "  \t"]).join(own)))
    return rows + [(1000 + k, t) for k, t in enumerate(["", None, " \n ", "one", "ONE", "é É", "É é", "a b c d", "A b  c d"])]


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_groups(df).collect()}


def test_against_all_pairs(spark):
    rows = invented()
    df = spark.createDataFrame([(i, t, i % 2 == 0) for i, t in rows], "doc_id long, text string, kept boolean")
    want = brute(rows)
    assert len({c for _, c in want.values()}) < len(want) - 8
    assert result(df) == want
    assert {r.doc_id for r in nd.keep_one(df).collect()} == {i for i, (_, c) in want.items() if i == c}
    assert nd.keep_one(df).columns == df.columns


def test_members_unlike_the_hub_are_compared_in_later_rounds(spark, monkeypatch):
    monkeypatch.setattr(nd, "band_keys", lambda sig: np.zeros(1, np.uint64))  # all texts share one bucket
    rows = invented(seed=4, n=8)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_texts_that_share_a_passage_are_searched_by_rare_shingles(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 2)
    monkeypatch.setattr(nd, "band_keys", lambda sig: np.zeros(1, np.uint64))  # all texts share one bucket
    rng = random.Random(11)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(30):
        own = [f"o{k}x{j}" for j in range(rng.choice([4, 12, 60]))]
        rows += [(len(rows), " ".join(passage + own)), (len(rows) + 1, " ".join(passage + own + [f"e{j}" for j in range(rng.randint(0, 14))]))]
    rows += [(500, "lonely words that no other text here has"), (501, "p0 p1")]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def family(n, places=8, seed=0):
    """Texts of one bucket whose links are few: a common text with three of some places changed to one of three words."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        own = [f"b{j}" for j in range(40)]
        for at in rng.sample(range(2, 40, 36 // places), 3):
            own[at] = f"x{rng.randrange(3)}"
        rows.append((k, " ".join(own)))
    return rows


def test_no_link_is_lost_between_texts_that_are_no_hubs(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 2)
    monkeypatch.setattr(nd, "band_keys", lambda sig: np.zeros(1, np.uint64))  # all texts share one bucket
    rows = family(300)
    want = brute(rows)
    assert 20 < len({c for _, c in want.values()}) < 270
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_texts_just_below_the_threshold_are_seldom_paired(spark, monkeypatch):
    monkeypatch.setattr(nd, "SMALL", 2)
    monkeypatch.setattr(nd, "band_keys", lambda sig: np.zeros(1, np.uint64))  # all texts share one bucket
    made, search = [], nd.rare_pairs

    def counted(several, threshold):
        pairs = search(several, threshold)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(nd, "rare_pairs", counted)
    rng = random.Random(5)
    rows = []
    for k in range(70):                                      # near copies of one text, some too far from it
        own = [f"b{j}" for j in range(400)]
        for at in rng.sample(range(400), rng.choice([4, 6, 8]) if k < 45 else 14):
            own[at] = rng.choice([f"x{k}", "y", "z"])
        rows.append((k, " ".join(own)))
    want = brute(rows)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert 5 < len({c for _, c in want.values()}) < 60
    assert len(made) == 1 and made[0] < 70


def test_small_buckets_and_rare_stars_share_a_pass(spark, monkeypatch):
    keys, write, written = nd.band_keys, nd.scratch_table, []
    monkeypatch.setattr(nd, "band_keys", lambda sig: np.r_[U0, keys(sig)[:12]])  # one bucket of all, besides small ones
    monkeypatch.setattr(nd, "scratch_table", lambda df, name: written.append(name) or write(df, name))
    rows = family(120)
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    assert "members" in written and "rare" in written
    # stars of the first bands, of all bands, of rare shingles with the small buckets, pairs of rare shingles
    assert written.count("confirmed") <= 4
    assert written.count("sets") <= 3 and len(written) <= 48


def test_passes_read_shared_buckets_and_texts_that_meet(spark, monkeypatch):
    sets, stars, write, rows_read, placed_rows, batches = nd._sets_of, nd.star_pass, nd.scratch_table, [], [], set()

    def counted_sets(docs, wanted, *rest):
        rows_read.append((docs.count(), wanted.count()))
        return sets(docs, wanted, *rest)

    monkeypatch.setattr(nd, "_sets_of", counted_sets)
    monkeypatch.setattr(nd, "star_pass", lambda placed, *rest: placed_rows.append(placed.count()) or stars(placed, *rest))
    monkeypatch.setattr(nd, "scratch_table", lambda df, name: batches.add(int(spark.conf.get(nd.BATCH_ROWS))) or write(df, name))
    before = spark.conf.get(nd.BATCH_ROWS)
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(9000)}" for _ in range(30))) for k in range(200)]
    rows += [(500 + k, rows[k % 5][1] + f" e{k}") for k in range(10)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    # texts that meet no other are not dealt out for their sets, nor are their bands in a pass
    assert rows_read and all(n <= 2 * wanted + 5 for n, wanted in rows_read)
    assert placed_rows[0] <= 15 * nd.BINS // nd.ROWS
    assert max(batches) <= 1000 and spark.conf.get(nd.BATCH_ROWS) == before


def test_bitmap_of_wanted_ids_loses_none(spark):
    ids = [k * k * k - 70_000 for k in range(3000)]
    docs = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    wanted = docs.where("doc_id % 7 = 0").select("doc_id")
    count = wanted.count()
    found = {r.doc_id for r in nd.may_be_among(docs, wanted, count).collect()}
    assert {i for i in ids if i % 7 == 0} <= found and len(found) < 3000 * 0.35
    assert nd.may_be_among(docs, wanted.limit(0), 0).count() == 0


def test_parities_never_exceed_the_symmetric_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        s, t = (np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in "st")
        a, b = nd.parities([s, t])
        differ = sum(bin((int(x) ^ int(y)) & (2 ** 64 - 1)).count("1") for x, y in zip(a, b))
        assert differ <= len(np.setxor1d(s, t))


def test_repeated_null_and_no_rows(spark):
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (3, None), (4, "q r s"), (4, "q r t"),
                                (5, "q r s"), (5, "q r t")], "doc_id long, text string")
    assert result(df) == {1: (4, 1), 2: (4, 1), 3: (0, 3), 4: (1, 4), 5: (1, 4)}
    assert sorted(str(r.doc_id) for r in nd.keep_one(df).collect()) == ["1", "1", "3", "4", "4", "None"]
    assert result(df.limit(0)) == {}


def test_densified_bins_of_small_sets_agree_like_jaccard():
    rng = np.random.default_rng(0)
    same = []
    for _ in range(200):
        s = rng.integers(0, 1 << 62, 4).astype(np.uint64)
        same.append((nd.signature(np.sort(s)) == nd.signature(np.sort(s[:3]))).mean())
    assert 0.65 < np.mean(same) < 0.85


def test_very_long_text():
    text = " ".join(f"w{k % 7919}" for k in range(300_000))
    a, b = (nd.shingle_set(t, nd.WordHashes()) for t in (text, text + " end"))
    assert len(a) == 7919 and len(b) == 7920
    assert (nd.band_keys(nd.signature(a)) == nd.band_keys(nd.signature(b))).any()
