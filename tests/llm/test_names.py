"""Extra columns, whatever their names, pass through the stages of the pipeline and never stand in for their own."""

import pytest
from pyspark.sql import functions as F

from scarp.llm import decontaminate, near_dup, pii, toxicity
from scarp.llm.common import fresh

# every name the stages use inside, and those of earlier versions
NAMES = ["kept_id", "leak_id", "text_scored", "score_of_text", "term_key", "text_marks", "text_missing", "text_sanitised", "TERM_KEY_",
         "__kept", "__leak", "__score", "__text", "__key", "__terms", "__new", "__null", "hub", "label", "bucket", "n", "kept", "score", "term",
         "entity", "document", "item_id", "shingles"]


def frame(spark):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, "write to x.y@example.org now"), (4, "one two three four five six")]
    return spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in NAMES])


STAGES = {"near_dup": lambda spark, d: near_dup.keep_one(d),
          "toxicity": lambda spark, d: toxicity.keep_clean(d, toxicity.train(d, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")), 2.0),
          "leaks": lambda spark, d: decontaminate.without_leaks(d, spark.createDataFrame([(7, "one two three four five six")], "item_id long, text string")),
          "pii": lambda spark, d: pii.sanitise(d)}
LEFT = {"near_dup": {1, 3, 4}, "toxicity": {1, 2, 3, 4}, "leaks": {1, 2, 3}, "pii": {1, 2, 3, 4}}


@pytest.mark.parametrize("stage", STAGES)
def test_clashing_columns_pass_through(spark, stage):
    docs = frame(spark)
    out = STAGES[stage](spark, docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == LEFT[stage]
    for r in rows:
        assert all(r[c] == f"{c}{r.doc_id}" for c in NAMES)
    texts = {r.doc_id: r.text for r in rows}
    assert texts[3] == ("write to [EMAIL] now" if stage == "pii" else "write to x.y@example.org now")


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, A_ int")
    assert fresh(df, "A") == "A__" and fresh(df, "b") == "b"
