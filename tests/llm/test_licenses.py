import random
import textwrap

import pytest

from scarp.llm import licenses as lic


def corpus(n=120, seed=2):
    rng = random.Random(seed)
    words = [a + b for a in ("an", "the", "or", "in", "re", "st") for b in ("tion", "ing", "er", "ly", "of", "with")]

    def line(k):
        return " ".join(rng.choice(words) for _ in range(k)).capitalize() + "."
    rows, want = [], {}
    notices = [("MIT", "Released under the MIT License."), ("GPL", "This work is licensed under the GNU General Public License, version 3."),
               ("CC", "Licensed under CC BY-NC 4.0."), ("Apache", "Licensed under the Apache License, Version 2.0."),
               ("proprietary", "All rights reserved."), ("", "")]
    for k in range(n):
        family, notice = rng.choice(notices)
        lines = [line(rng.randint(3, 60)) for _ in range(rng.randint(1, 5))]
        if notice:
            place = rng.randrange(len(lines) + 1)
            if rng.random() < 0.3 and place < len(lines):
                lines[place] += " " + notice
            else:
                lines.insert(place, notice)
        rows.append((k, "\n".join(lines)))
        want[k] = (family, len(lines))
    return rows, want


@pytest.fixture(scope="module")
def scanner(spark):
    return lic.train(spark.createDataFrame(corpus(seed=5)[0], "doc_id long, text string"))


def test_families_of_other_texts(spark, scanner):
    rows, want = corpus(seed=9)
    df = spark.createDataFrame([(i, t, "q") for i, t in rows], "doc_id long, text string, families string")
    got = {r.doc_id: r for r in lic.scan(df, scanner).collect()}
    assert {i: r.n_paragraphs for i, r in got.items()} == {i: n for i, (_, n) in want.items()}
    wrong = [i for i, r in got.items() if r.families != want[i][0]]
    assert len(wrong) <= 2 and all(0 <= r.confidence <= 1 for r in got.values())


def test_other_licences_are_unknown_and_unconfirmed_families_too(spark, scanner):
    rows = [(1, "Distributed under the Boost Software License, Version 1.0."), (2, "Distributed under the zlib license."),
            (3, "MIT MIT MIT."), (4, "Released under the MIT License.\nAll rights reserved.")]
    got = {r.doc_id: r for r in lic.scan(spark.createDataFrame(rows, "doc_id long, text string"), scanner).collect()}
    assert got[1].families == got[2].families == "" and got[1].n_unknown == got[2].n_unknown == 1
    assert got[3].families == "" and got[4].families == "MIT,proprietary" and got[4].n_licensed == 2


def test_wrapped_notices(spark, scanner):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:")
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
           "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    rows, want = [], {}
    for family, notice in (("BSD", bsd), ("GPL", gpl)):
        for width in (30, 50, 70, 80):
            for head, end in (("", "\n"), (" * ", "\n"), ("# ", "\r\n")):
                lines = [head + x for x in textwrap.wrap(notice, width)]
                rows.append((len(rows), end.join(["A tool for the team.", "", *lines, "", "The code starts here."])))
                want[len(want)] = (family, len(lines) + 2)
    half = textwrap.wrap(bsd, 70)
    rows.append((len(rows), half[0] + "\n\n" + half[1]))  # two paragraphs
    want[len(want)] = ("", 2)
    got = {r.doc_id: r for r in lic.scan(spark.createDataFrame(rows, "doc_id long, text string"), scanner).collect()}
    assert {i: (r.families, r.n_paragraphs) for i, r in got.items()} == want
    assert all((r.n_licensed > 0) == bool(r.families) and r.n_licensed + r.n_unknown <= r.n_paragraphs for r in got.values())


def test_no_template_without_a_key_word(spark):
    sets = [s for c in lic.templates(spark).values() for s in c]
    keys = set(lic.key_words(sets))
    assert all(sum(not set(q.split()) & keys for q in s) < lic.CONFIRM * len(s) for s in sets)
    assert max(len(s) for s in sets) + 2 <= lic.WINDOW // 2


def test_nulls_repeats_long_text_and_no_rows(spark, scanner):
    long = "word " * 200_000 + "\nAll rights reserved."
    rows = [(None, "All rights reserved."), (1, None), (1, ""), (2, "All rights reserved."), (2, "All rights reserved."), (3, long), (4, " \n\r\n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.families, r.n_paragraphs) for r in lic.scan(df, scanner).collect())
    assert got == [("1", "", 0), ("1", "", 0), ("2", "proprietary", 1), ("2", "proprietary", 1), ("3", "proprietary", 2), ("4", "", 0),
                   ("None", "proprietary", 1)]
    assert lic.scan(df.limit(0), scanner).count() == 0
    out = lic.scan(df, scanner)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_sample_is_bounded_and_clean(spark, monkeypatch):
    monkeypatch.setattr(lic, "PARAGRAPHS", 7)
    rows = lic.sample_of(spark.createDataFrame(corpus()[0], "doc_id long, text string")).collect()
    assert sorted(r.at for r in rows) == list(range(7)) and not any("License" in r.paragraph for r in rows)
