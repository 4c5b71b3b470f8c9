"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns (assignments, access keys, hexadecimal runs) and a wider one for opaque tokens give candidates with their
places. Over the whole corpus every candidate value, known by its SHA-256, is counted by distinct owners and distinct
repositories: a value that several owners hold is a widely copied example, one that stays with one owner and looks
random is a live-looking credential. Opaque tokens are reported (kind ``live``) only when they are live-looking, outside
of base findings; base findings always stay, and are counted as live or copied in two further columns.

The texts are read once; what follows works on candidates alone. A widely copied value costs one row per owner and
repository and task: the counts are combined before the shuffle, and the join back is split by Spark where it is skewed.

Places are counted in code points: the pieces between the matches and the matches themselves, added up from the left.

Defined results: null text is empty; every row gives one row, repeated and null ids too; a null owner or repository is
one of its own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch_table

KINDS = ("assign", "access", "hex")
# fixed values: the base patterns (shortest lengths inside, where whole runs are matched anyway)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
MIN_ASSIGNED = 6
# a live-looking value: no owner but one, in this many repositories at most, with this many different characters
LIVE_OWNERS = 1
LIVE_REPOS = 3
LIVE_CHARS = 10
COPIED_OWNERS = 3  # from here on a value is a copied example


def located(text: Column, pattern: str, kind: int, group: int = 0) -> Column:
    """``array<struct<start, kind, end, value>>`` of all matches from the left; ``value`` is one group of each."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
                         F.transform(whole, F.length).alias("len"), value.alias("val"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        end = start + x["len"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["val"].alias("value"))
        return F.struct(F.coalesce(end, start).alias("pos"),
                        F.when(x["len"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    zipped = parts.cast("array<struct<gap:bigint,len:bigint,val:string>>")
    run = F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("pos"), empty.alias("out")), add, lambda a: a["out"])
    return F.when(F.size(whole) == 0, empty).otherwise(run)


def joined(spans: Column, names: tuple[str, ...]) -> Column:
    """``kind:start:end``, comma-joined, by start and then kind."""
    kinds = F.array(*[F.lit(n) for n in names])
    rows = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(rows, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def candidates(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column) -> DataFrame:
    """One row per document: ``row, doc_id, repo, owner, base, opaque`` (spans with their values)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(repo.cast("string"), F.lit("")).alias("repo"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"))
    t = F.col("text")
    assign = F.filter(located(t, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= MIN_ASSIGNED)
    base = F.concat(assign, located(t, ACCESS, 1), located(t, HEX, 2))
    opaque = F.filter(located(t, OPAQUE, 3), lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"))
    found = read.select("doc_id", "repo", "owner", base.alias("base"), opaque.alias("opaque"))
    hidden = lambda spans: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"),
        F.size(F.array_distinct(F.split(s["value"], ""))).alias("chars")))
    apart = F.filter("opaque", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "repo", "owner",
                        hidden(F.col("base")).alias("base"), hidden(apart).alias("opaque"))


def ownership(found: DataFrame) -> DataFrame:
    """``hash, n_owners, n_repos`` of every candidate value in the corpus."""
    values = found.select("repo", "owner", F.explode(F.concat("base", "opaque")).alias("s"))
    return (values.groupBy(F.col("s.hash").alias("hash"))
            .agg(F.count_distinct("owner").alias("n_owners"), F.count_distinct("owner", "repo").alias("n_repos")))


def scan(docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied``."""
    # written once: the row numbers stay, and the texts are not read again
    found = scratch_table(candidates(docs, id_col, text_col, repo, owner), "candidates")
    owners = scratch_table(ownership(found), "owners")
    each = (found.select("row", F.explode(F.concat("base", "opaque")).alias("s")).select("row", "s.*").join(owners, "hash"))
    live = (F.col("n_owners") <= LIVE_OWNERS) & (F.col("n_repos") <= LIVE_REPOS) & (F.col("chars") >= LIVE_CHARS)
    judged = each.select("row", "start", "kind", "end", live.alias("live"), (F.col("n_owners") >= COPIED_OWNERS).alias("copied"))
    per_row = judged.groupBy("row").agg(  # bounded by one text
        F.collect_list(F.when((F.col("kind") == 3) & F.col("live"), F.struct("start", "kind", "end"))).alias("added"),
        F.sum((F.col("live") & (F.col("kind") < 3)).cast("long")).alias("n_live"),
        F.sum((F.col("copied") & (F.col("kind") < 3)).cast("long")).alias("n_copied"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = (found.select("row", "doc_id", plain.alias("base")).join(per_row, "row", "left")
           .withColumn("added", F.coalesce("added", none)))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, F.lit(k)))).cast("long").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
                      joined(F.concat("base", "added"), (*KINDS, "live")).alias("spans"),
                      F.coalesce("n_live", F.lit(0).cast("long")).alias("n_live"),
                      F.coalesce("n_copied", F.lit(0).cast("long")).alias("n_copied"))
