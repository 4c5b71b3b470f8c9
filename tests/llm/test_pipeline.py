import hashlib
import random

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from scarp.llm import pii, toxicity
from test_decontaminate import brute as leaks
from test_near_dup import brute as groups
from test_toxicity import invented


def test_run_against_a_plain_version(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    rows = [(k, t, "en", f"s{k % 3}", len(t)) for k, t, _ in invented(150)]
    labels = [(k, 1, x) for k, _, x in invented(150)]
    clean = [r[1] for r in rows if r[0] % 3 and r[0] < 150]
    item = " ".join(rng.choice(rng.choice(clean).split()) for _ in range(20))
    for k in range(200, 240):
        text = rng.choice(clean)
        text = {0: text, 1: text + " more", 2: item + " " + text, 3: text + " mail a.b@corp.example"}[k % 4]
        rows.append((k, text, None, None, len(text)))
    rows += [(300, None, None, None, None), (301, "", "en", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    seen = []

    def watched(stage):
        def call(s, docs, d):
            out = stage(s, docs, d)
            seen.append(out.columns == docs.columns)
            return out
        return call
    stages = corpus_pipeline.STAGES
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, watched(f)) for n, f in stages[:-1]] + stages[-1:])
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    left = [(i, t) for i, t, *_ in rows if i in kept]
    assert 40 < len(left) < len(rows) - 20
    label = groups(left)
    left = [(i, t) for i, t in left if label[i][1] == i]
    bad = {d for d, _ in leaks(left, [(1, item)])}
    left = [(i, t) for i, t in left if i not in bad]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t in left:
        text = pii.sanitised(t or "", set())
        want[i] = (len(library.encode(text, add_special_tokens=False).ids), hashlib.sha256(text.encode()).hexdigest())
    assert bad and got == want and seen == [True] * 4
