import hashlib
import random
import re

from scarp.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_spans(text):
    """The base findings straight from their definition."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 14 <= len(d) <= 19:
            total = sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d)))
            if total % 10 == 0:
                out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out)


def test_base_spans_against_definition():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "b.", "@", "@x.y", "%", "-", "+1", "7", "42", "4111 1111 1111 1111", ".", " ", "(", "é",
                                   "192.168.", "+49 30 1234567", "\n"]) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_stay_linear():
    assert pii.base_spans("a" * 300_000 + " @ " + "1" * 300_000 + "." * 10 + "9" * 5000) == []


def rows_with_disclosing_name():
    filler = ["the", "report", "was", "sent", "on", "monday", "by", "our", "team", "in", "spring"]
    rng = random.Random(4)
    rows = []
    for k in range(60):
        words = [rng.choice(filler) for _ in range(30)]
        if k % 10 == 0:
            words[10:10] = [f"q{k}", "Zebulon", "jo@corp.example", f"r{k}"]
        rows.append((k, " ".join(words)))
    return rows


def by_hand(rows):
    """Flagged (entity, term) pairs from plain dictionaries."""
    import math
    joint, n_c, n_t = {}, {}, {}
    for i, text in rows:
        for t in set(pii.TERM.findall(text.lower())):
            n_t[t] = n_t.get(t, 0) + 1
        for e, c, terms in pii.contexts(text):
            n_c.setdefault(e, set()).add(i)
            for t in terms:
                joint.setdefault((e, t), set()).add(c)
    out = set()
    for (e, t), cs in joint.items():
        if len(cs) >= pii.SUPPORT:
            nc, nt = max(len(n_c[e]), len(cs)), max(n_t.get(t, 0), len(cs))
            n = max(len(rows), nc, nt)
            if n > nc and math.log2(n * len(cs) / (nc * nt)) * pii.ALPHA >= math.log2(n / nc):
                out.add((e, t))
    return out


def test_disclosing_terms_are_marked_and_generalised(spark):
    rows = rows_with_disclosing_name()
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, terms string, n_chars int")
    flagged = pii.disclosing_terms(df.select("doc_id", "text"), pii.occurrences(df.select("doc_id", "text")))
    want = by_hand(rows)
    assert {(r.entity, r.term) for r in flagged.collect()} == want and {t for _, t in want} == {"zebulon"}
    got = {r.doc_id: r for r in pii.find(df).collect()}
    for i, text in rows:
        base = plain_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert got[i].n_email == len(base)
        assert ("term:" in got[i].spans) == (i % 10 == 0)
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    for r in clean.collect():
        assert "Zebulon" not in r.text and "@" not in r.text and r.n_chars == len(r.text) and r.terms == "x"
        assert r.doc_id % 10 or "[TERM] [EMAIL]" in r.text


def test_copies_of_one_context_are_no_evidence(spark):
    rows = [(k, "call Zebulon at jo@corp.example today") for k in range(20)] + [(99, "nothing here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.spans.count(":") == 2 * bool(r.spans) for r in pii.find(df).collect())


def test_copies_of_a_context_do_not_hide_a_disclosing_term(spark):
    rows = [(k, "the report was sent on monday") for k in range(2000)]
    rows += [(3000 + k, f"{w} Zebulon jo@corp.example {w}") for k, w in enumerate(["red", "green"] + ["blue"] * 100)]
    for ids in (lambda i: i, lambda i: None, lambda i: i // 50):
        df = spark.createDataFrame([(ids(i), t) for i, t in rows], "doc_id long, text string")
        flagged = pii.disclosing_terms(df, pii.occurrences(df)).collect()
        assert [r.term for r in flagged] == ["zebulon"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(("term:" in r.spans) == (r.doc_id >= 3000) for r in pii.find(df).collect())


def test_disclosing_terms_are_marked_in_every_document(spark):
    rows = rows_with_disclosing_name()
    far = "jo@corp.example wrote about the spring report of the team and also of ZEBULON"
    rows += [(100, far), (None, "a note by Zebulon"), (None, "the report"), (7, "Zebulon again")]
    rows += [(200 + k, f"{w} İpek ann@corp.example {w}") for k, w in enumerate(["red", "green", "blue"])] + [(210, "with İpek")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.spans.count("term:")) for r in pii.find(df).collect())
    assert found == sorted((str(i), t.lower().count("zebulon") + t.count("İpek")) for i, t in rows)
    assert not any("zebulon" in r.text.lower() or "İpek" in r.text for r in pii.sanitise(df).collect())


def test_nulls_repeats_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a@b.co"), (1, None), (1, "10.0.0.1"), (1, "10.0.0.1"), (2, "")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.spans) for r in pii.find(df).collect())
    assert got == [("1", 0, 0, ""), ("1", 0, 1, "ip:0:8"), ("1", 0, 1, "ip:0:8"), ("2", 0, 0, ""), ("None", 1, 0, "email:0:6")]
    assert sorted("-" if r.text is None else r.text for r in pii.sanitise(df).collect()) == ["", "-", "[EMAIL]", "[IP]", "[IP]"]
    assert pii.find(df.limit(0)).count() == 0


def test_the_corpus_size_does_not_loosen_the_rule(spark):
    """A term with nine tenths of its documents elsewhere is never flagged, one that stands beside the entity always is."""
    found = {}
    for n in (500, 20_000):
        rows = [(k, f"word{k % 97} the plain line {k % 13}") for k in range(n)]
        rows += [(n + k, f"w{k} Common Zebulon jo@corp.example v{k}") for k in range(20)]
        rows += [(n + 100 + k, f"Common again in line {k}") for k in range(180)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found[n] = {r.term for r in pii.disclosing_terms(df, pii.occurrences(df)).collect()}
    assert found == {500: {"zebulon"}, 20_000: {"zebulon"}}
