import random
import re

from scarp.llm import decontaminate as dc


def cut(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items):
    """Best containment of every pair, by comparing sets."""
    best = {}
    for d, text in docs:
        for i, item in items:
            ws = cut(item)
            if not ws or d is None or i is None:
                continue
            n = min(5, len(ws))
            own, there = cut(text), {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)}
            both = len(there & {tuple(own[k:k + n]) for k in range(len(own) - n + 1)})
            if both >= 0.75 * len(there):
                best[d, i] = max(best.get((d, i), (0,)), (both / len(there), both, len(there)))
    return best


def result(docs, items):
    return {(r.doc_id, r.item_id): (r.containment, r.n_shared, r.n_item) for r in dc.contained_items(docs, items).collect()}


def test_against_comparing_all_pairs(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 8, 15, 40, 120])))) for k in range(40)]
    docs = []
    for k in range(120):
        ws = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 30, 400, 4000]))]
        for _ in range(rng.randint(0, 2)):
            part = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 1 + len(part) // 12)):
                part[rng.randrange(len(part))] = rng.choice(vocab)
            at = rng.randint(0, len(ws))
            ws[at:at] = part if rng.random() < 0.6 else [w.upper() + "," for w in part]
        docs.append((k, " ".join(ws)))
    docs += [(3, "other text of a repeated id"), (None, items[5][1]), (500, None), (501, "")]
    items += [(None, "w1 w2 w3 w4 w5"), (77, None), (78, ""), (5, "w1 w2 w3 w4 w5 w6"), (5, items[5][1])]
    want = brute(docs, items)
    assert 20 < len(want) and any(v[0] < 1 for v in want.values())
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, sketch string")
    assert result(d, b) == want
    left = dc.without_leaks(d, b)
    assert left.columns == d.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in docs if (i not in {x for x, _ in want}))


def test_sketches_always_reach_the_threshold(spark):
    items = spark.createDataFrame([(n, " ".join(f"w{n}x{k}" for k in range(n + 4))) for n in range(1, 70)], "item_id long, text string")
    for r in dc.items_of(items, 0.75, "item_id", "text").collect():
        missing = int(r.n_item * 0.25)
        assert len(r.sketch) >= min(r.n_item, missing + 1) and r.sketch == sorted(r.shingles)[:len(r.sketch)]


def test_no_rows_on_either_side(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert result(d.limit(0), b) == {} and result(d, b.limit(0)) == {}
