"""Known damage planted into the given tables, so that queries over them have something to find and to repair.

Both are pure functions of a row's own columns (its crc32), the same on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One document in ten repeats itself; of twenty conversation rows five are damaged.
REPEATING = 10
KINDS = 20
DROPPED, EMPTIED, UNSTOPPED, DOUBLED, REROLED = 0, 1, 2, 3, 4


def periodic_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text``: in one document of ten the words from some word on repeat a few of themselves.

    With h the crc32 of the decimal id and g = h div 10: if h is divisible by 10, each of the n words from a = g mod n on
    becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Documents without id or words stay.
    """
    crc = F.crc32(F.col(id_col).cast("string"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                    crc.alias("h"), F.floor(crc / REPEATING).cast("long").alias("g"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    d = d.withColumn("w", F.when(F.col("h") % REPEATING == 0, words))
    n = F.size("w")
    d = d.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    step = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return d.select("doc_id", F.when(n > 0, F.array_join(step, " ")).otherwise(F.col("text")).alias("text"))


def damaged_rows(rows: DataFrame) -> DataFrame:
    """Rows of conversations (``conv_id, turn, role, text`` without null roles and texts), some damaged.

    By the crc32 of ``conv_id:turn`` (null: one space) modulo 20: 0 drops the row, 1 empties its text, 2 removes its
    ``.``, ``!`` and ``?``, 3 repeats it, 4 sets its role to user.
    """
    space = F.lit(" ")
    kind = F.crc32(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])) % KINDS
    text = F.when(F.col("kind") == EMPTIED, F.lit("")).when(F.col("kind") == UNSTOPPED, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == REROLED, F.lit("user")).otherwise(F.col("role"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == DOUBLED, F.lit(2)).otherwise(F.lit(1))))
    return (rows.withColumn("kind", kind).where(F.col("kind") != DROPPED)
            .select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time"))
