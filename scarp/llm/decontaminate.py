"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Texts are lower-cased and cut into words at everything but letters and digits; a set holds the 64-bit hashes of its
distinct five-word shingles. Benchmark items are partitioned by set size in powers of two. The sketch of an item is its
bottom-k MinHash: the k smallest hashes, where k follows from the upper size ``u`` of its partition,
``k = floor((1 - t) * u) + 1``. An item of which at least the share ``t`` lies in a document misses at most
``floor((1 - t) * n)`` of its shingles there, so one of any k is found: the search loses nothing, however long the
document is. Candidates are documents that hold a sketch value; they are verified by exact shingle containment.

Only sketches (a share ``1 - t`` of the benchmark) meet the shingles of the corpus. Spark decides by size whether they
are broadcast. Candidate pairs are written, and only documents with candidates are cut into shingles again.

Defined results: items with fewer than five words are one shingle of all their words, searched at that width; items
without words and null ids match nothing; a repeated document id is judged by its best row, a repeated item id by its
best text; null and empty texts hold nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, id_text, scratch_table

WIDTH = 5
CONTAINMENT = 0.75


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(ws: Column, width: int) -> Column:
    """Hashes of the runs of ``width`` words of an array of word hashes (none when there are fewer words)."""
    runs = F.transform(F.sequence(F.lit(0), F.size(ws) - width),
                       lambda i: F.xxhash64(F.lit(width), *[ws[i + k] for k in range(width)]))
    return F.when(F.size(ws) >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def word_hashes(df: DataFrame) -> DataFrame:
    """Replace ``text`` by ``wh``, the hashes of its words."""
    return df.withColumn("wh", F.transform(words(F.col("text")), lambda w: F.xxhash64(w))).drop("text")


def items_of(benchmark: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """``item_id, item, width, n_item, shingles, sketch``: one row per distinct item text."""
    raw = (benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
           .where(F.col("item_id").isNotNull()).dropDuplicates())
    hashed = word_hashes(raw).withColumn("width", F.least(F.size("wh"), F.lit(WIDTH))).where("width > 0")
    sets = F.lit(None).cast("array<bigint>")
    for width in range(1, WIDTH + 1):
        sets = F.when(F.col("width") == width, shingle_hashes(F.col("wh"), width)).otherwise(sets)
    sized = hashed.withColumn("shingles", F.array_sort(sets)).withColumn("n_item", F.size("shingles").cast("long"))
    # sizes from 2^c to 2^(c+1) - 1 form partition c
    upper = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n_item").cast("double"))) + 1) - 1
    k = (F.floor(F.lit(1 - threshold) * upper + F.lit(1e-9)) + 1).cast("int")
    return (sized.withColumn("sketch", F.slice("shingles", F.lit(1), k))
            .withColumn("item", F.xxhash64("item_id", "shingles"))
            .select("item_id", "item", "width", "n_item", "shingles", "sketch").dropDuplicates(["item"]))


def document_shingles(docs: DataFrame, widths: list[int]) -> DataFrame:
    """``doc_id, sh``: the hashes of a document's shingles of all widths asked for."""
    hashed = word_hashes(docs)
    parts = [shingle_hashes(F.col("wh"), w) for w in widths]
    return hashed.select("doc_id", (parts[0] if len(parts) == 1 else F.concat(*parts)).alias("sh"))


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT, id_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of every pair at or above the threshold."""
    docs = id_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    items = scratch_table(items_of(benchmark, threshold, item_col, item_text_col), "items")
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [WIDTH]  # five values at most
    sketches = items.select("item", F.explode("sketch").alias("h"))
    # explode_outer: for the inner form Spark would put a filter on the array size below the projection of the word
    # hashes, which cuts a text into words once per shingle
    found = (document_shingles(docs, widths).select("doc_id", F.explode_outer("sh").alias("h"))
             .join(sketches, "h").select("doc_id", "item").distinct())
    candidates = scratch_table(found, "candidates")
    suspects = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi")
    pairs = (document_shingles(suspects, widths).join(candidates, "doc_id")
             .join(items.select("item", "item_id", "n_item", "shingles"), "item")
             .select("doc_id", "item_id", "n_item",
                     F.size(F.array_intersect("shingles", "sh")).cast("long").alias("n_shared")))
    sure = (pairs.withColumn("containment", F.col("n_shared") / F.col("n_item"))
            .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item")))
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("b")
    return (sure.groupBy("doc_id", "item_id").agg(best)
            .select("doc_id", "item_id", "b.n_item", "b.n_shared", "b.containment"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINMENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark item, with their columns (rows with a null id stay)."""
    leaks = contained_items(docs, benchmark, threshold, id_col, text_col)
    name = fresh(docs, "leak_id")
    ids = leaks.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(ids, docs[id_col].cast("long") == F.col(name), "left_anti")
