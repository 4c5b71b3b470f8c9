"""Near-duplicate groups by one-permutation MinHash.

A document's set holds its distinct five-word shingles as 64-bit hashes. One hash value serves as the permutation: it
sorts every shingle into one of ``BINS`` bins, and each bin keeps its smallest value. Empty bins are filled by optimal
densification: bin ``j`` probes other bins in a pseudo-random order that depends on ``j`` alone, until it meets a filled
one. Bands of ``ROWS`` bins are hashed to buckets.

Documents with equal sets are first gathered into one class, so copies cost one row each. Pairs are confirmed on the full
sets, and what they link counts as one component from then on. Stars come first: inside a bucket every member meets a few
hubs only, which keeps the pairs linear in the bucket.

* one hub in every bucket of the first ``FIRST`` bands, the most central member (it meets the most documents over all its
  buckets): copies of one text resemble the text more than each other, and a group has the same hub in all its buckets;
* a few hubs in the buckets of all bands that still hold several components, a component counting as one member of it. It
  is stood for by another of its documents in every bucket. Of more than ``SMALL`` components the ``HUBS`` largest are hubs.

Stars alone would lose links between texts that are no hub in any bucket they share. What they leave apart is therefore
searched completely:

* a bucket of no more than ``SMALL`` documents is compared member by member;
* the documents of larger ones that still hold several components are joined by a prefix filter, which is exact: each
  document stands in the buckets of its rarest shingles, where two linked texts always meet (``rare_members``), stars
  first, then every pair of different components (``rare_pairs``). Texts that share a widespread passage and little else
  do not meet there. Upper bounds of the intersection, from the place of the first shared shingle in both, from the
  shingles that one text has alone and from a bitmap of parities of the others, keep out pairs that cannot be linked
  before their sets are read.

The pairs of small buckets are confirmed together with the stars of rare shingles, on sets read for both at once.

So every two texts that agree in a band are compared, or proven unlinked, or linked through others already. Texts just
below the threshold of each other, which no bound tells apart, remain pairs; they are spread over tasks and spill.

Components come from minimum labels passed along the confirmed links with pointer jumping, in Spark tables only.

Defined results: null and empty texts have no shingle and link with nothing; rows with a null id are left out; a
repeated id is one document, whose text is the one with the smallest set digest; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, fresh, id_text, map_texts, scratch_table

WIDTH = 5
BINS = 160
ROWS = 4
THRESHOLD = 75  # per cent of intersection over union
SMALL = 8       # a bucket of so many documents is compared completely
FIRST = 8       # bands of the first pass
HUBS = 2        # stars of a larger one; what they leave apart is joined by rare shingles
MARKS = 8       # 64-bit words of parities that bound an intersection
PART_BITS = 1 << 15  # of a row of the bitmap of wanted ids, as bitmap_construct_agg makes them
MOST_BITS = 1 << 26  # of the whole bitmap
BATCH = 1000    # rows of an Arrow batch: texts and sets are long
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
U = np.uint64
_GOLD = U(0x9E3779B97F4A7C15)
_ODD = U(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes:
    """64-bit hashes of the words of a text, all at once over its bytes: no table of words is kept."""

    def __init__(self):
        self.of_byte = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
        self.power = np.ones(1, np.uint64)

    def __call__(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        length = ends - starts
        while len(self.power) < length.max():
            step = self.power[-1:] * _ODD
            self.power = np.concatenate([self.power, self.power * step])
        inside = np.flatnonzero(~space)
        place = np.arange(len(inside)) - np.repeat(np.cumsum(length) - length, length)
        summand = self.of_byte[raw[inside]] * self.power[place]
        total = np.add.reduceat(summand, np.cumsum(length) - length)
        return mix(total + length.astype(np.uint64) * _GOLD)


def shingle_set(text: str, table: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    h = table(text.encode("utf-8", "replace").lower())
    if not len(h):
        return h
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = (out * _GOLD) ^ mix(h[k:len(h) - n + 1 + k] + U(k + 1))
        out = (out << U(7)) | (out >> U(57))
    out = np.sort(mix(out))
    return out[np.r_[True, out[1:] != out[:-1]]]


def probes(bins: int = BINS) -> np.ndarray:
    """For every bin the order in which it looks at the bins: its own first, then hashed ones, at last all in a row."""
    j = np.arange(bins, dtype=np.uint64)[:, None]
    tries = np.arange(4 * bins, dtype=np.uint64)[None, :]
    order = (mix((j + U(1)) * _GOLD + mix(tries + U(1))) % U(bins)).astype(np.int64)
    return np.column_stack([j.astype(np.int64), order, (j.astype(np.int64) + np.arange(bins)[None, :]) % bins])


PROBES = probes()


def signature(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Densified one-permutation MinHash of a non-empty set."""
    value = mix(shingles ^ U(0x5851F42D4C957F2D))
    at = ((value >> U(32)) * U(bins) >> U(32)).astype(np.int64)
    low = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(low, at, value)
    filled = np.zeros(bins, bool)
    filled[at] = True
    order = PROBES if bins == BINS else probes(bins)
    open_ = np.flatnonzero(~filled)
    source = np.arange(bins)
    k = 1
    while len(open_):
        source[open_] = order[open_, k]
        open_ = open_[~filled[source[open_]]]
        k += 1
    return low[source]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    out = np.arange(len(sig) // rows, dtype=np.uint64) + U(1)
    for k in range(rows):
        out = mix(out * _GOLD ^ sig[k:len(sig) // rows * rows:rows])
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, n_shingles, hi, lo, bands``: set size, 128-bit digest of the set, band keys."""
    def make():
        import xxhash

        table = WordHashes()

        def work(texts: list[str]):
            sizes, hi, lo, bands = [], [], [], []
            for text in texts:
                s = shingle_set(text, table)
                sizes.append(len(s))
                digest = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                hi.append(digest[0])
                lo.append(digest[1])
                bands.append(band_keys(signature(s)).view(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.array(sizes, pa.int64())
            yield pa.array(hi, pa.int64())
            yield pa.array(lo, pa.int64())
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands)))
        return work

    return map_texts(docs, make, "n_shingles long, hi long, lo long, bands array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id, shingles``: the sorted set as little-endian 64-bit integers."""
    def make():
        table = WordHashes()

        def work(texts: list[str]):
            yield pa.array([shingle_set(t, table).tobytes() for t in texts], pa.binary())
        return work

    return map_texts(docs, make, "shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The pairs ``a, b`` whose full sets have ``100 * intersection >= threshold * union``."""
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(t, s)
                at[at == len(t)] = 0
                both = int((t[at] == s).sum()) if len(t) else 0
                keep.append(100 * both >= threshold * (len(s) + len(t) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every linked id: the smallest id it is linked with, directly or through others.

    Each step takes the smallest label among the neighbours and then the label of that label. Every step writes its
    table and removes the one before; the driver learns one number a step.
    """
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    both = scratch_table(links.where("a <> b").select(ways.alias("way")).select("way.*").distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("label"))
    labels = scratch_table(labels, "labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("low")))
        step = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "low").alias("next"))
        step = scratch_table(step, "labels")
        discard(labels)
        if step.where("label <> next").limit(1).count() == 0:
            discard(both)
            return step.select("id", "label")
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("jumped"))
        labels = scratch_table(step.join(jump, "next").select("id", F.col("jumped").alias("label")), "labels")
        discard(step)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is written inside hands Python no more than ``BATCH`` rows at once, which bounds a task's memory outside the heap."""
    before = int(spark.conf.get(BATCH_ROWS))
    spark.conf.set(BATCH_ROWS, str(BATCH if before <= 0 else min(before, BATCH)))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, str(before))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per distinct id ``doc_id, n_shingles, component_id, kept``."""
    docs = id_text(docs, id_col, text_col).where(F.col("doc_id").isNotNull())
    # a repeated id: the row with the smallest set digest stands for it
    one = (sketches(docs).groupBy("doc_id").agg(F.min(F.struct("hi", "lo", "n_shingles", "bands")).alias("s"), F.count("*").alias("copies"))
           .select("doc_id", "s.*", "copies"))
    with small_batches(docs.sparkSession):
        return _grouped(docs, scratch_table(one, "ids"), threshold)


def _grouped(docs: DataFrame, one: DataFrame, threshold: int) -> DataFrame:
    """``near_groups`` of the documents sketched in ``one``."""
    reps = (one.where("n_shingles > 0").groupBy("hi", "lo")
            .agg(F.min(F.struct("doc_id", F.col("n_shingles").alias("n"), "bands")).alias("s")).select("s.*", "hi", "lo"))
    reps = scratch_table(reps, "reps")
    classes = reps.select("hi", "lo", F.col("doc_id").alias("rep"))
    label_of_class = _labels_of(docs, reps, one.where("copies > 1").select("doc_id"), threshold)
    out = (one.join(classes, ["hi", "lo"], "left")
           .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"))
           .join(label_of_class.select(F.col("id").alias("rep"), "label"), "rep", "left")
           .select("doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id")))
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _labels_of(docs: DataFrame, reps: DataFrame, repeated: DataFrame, threshold: int) -> DataFrame:
    """Labels of the class representatives ``reps`` that are linked with another one; ``repeated``: ids of several rows."""
    if repeated.limit(1).count() == 0:
        repeated = None
    held: list[DataFrame] = []                               # sets read so far, a table per pass that needed new ones

    def sets_of(wanted: DataFrame) -> DataFrame:
        have = None
        for table in held:
            have = table if have is None else have.unionByName(table)
        new = scratch_table(wanted if have is None else wanted.join(have.select("doc_id"), "doc_id", "left_anti"), "wanted")
        count = new.count()
        if have is None or count:
            held.append(_sets_of(may_be_among(docs, new, count), new, reps, repeated))
            have = held[-1] if have is None else have.unionByName(held[-1])
        discard(new)
        return have

    def link(pairs: DataFrame, labels: DataFrame | None, sets: DataFrame | None = None) -> DataFrame:
        """Labels after the pairs; ``sets``: those of all their documents, where they have been read."""
        found = scratch_table(_distinct_pairs(pairs, threshold), "pairs")
        if sets is None:
            sets = sets_of(found.select(F.col("a").alias("doc_id")).union(found.select("b")).distinct())
        after = _linked(found, labels, sets, threshold)
        discard(found)
        return after

    # a group meets in its first bands already; in the others a component counts as one
    shared = shared_buckets(reps)
    sized = shared.where("early").select("bucket", "doc_id", "n", "size")
    # the document in the middle of a group meets the others in more, and larger, buckets than they meet each other
    central = sized.groupBy("doc_id").agg(F.sum("size").alias("central"))
    members = scratch_table(sized.drop("size").join(central, "doc_id"), "members")
    hubs = members.groupBy("bucket").agg(F.max(F.struct("central", "doc_id", "n")).alias("h")).select("bucket", "h.*")
    labels = link(members.join(hubs.select("bucket", F.col("doc_id").alias("hub"), F.col("n").alias("hub_n")), "bucket").where("doc_id <> hub"), None)
    discard(members)

    placed = shared.select("bucket", "doc_id", "n")
    labels, stands = star_pass(labelled(placed, labels), labels, link)
    parted = parted_buckets(stands, labels)
    discard(stands)
    # small ones: every pair of documents (where a component is one document, its star has met the others already)
    small = parted.where((F.col("documents") <= SMALL) & (F.col("components") < F.col("documents"))).select("bucket").distinct()
    members = scratch_table(labelled(placed.join(small, "bucket"), labels), "members")
    discard(shared)
    # large ones: all documents of the components that met there
    apart = parted.where(F.col("documents") > SMALL).select(F.col("doc_id")).distinct()
    apart = labelled(apart, labels).select("label").distinct()
    crowd = scratch_table(labelled(reps.select("doc_id"), labels).join(apart, "label", "left_semi").select("doc_id"), "crowd")
    discard(parted)
    if crowd.limit(1).count():
        sets = sets_of(crowd.union(members.select("doc_id")).distinct())
        rare = rare_members(crowd.join(sets, "doc_id"), threshold)
        # the pairs of small buckets are confirmed with the stars
        labels, stands = star_pass(labelled(rare, labels), labels,
                                   lambda pairs, known: link(pairs.unionByName(cross_pairs(members)), known, sets))
        discard(stands)
        several = several_components(labelled(rare, labels))
        labels = link(rare_pairs(several, threshold), labels, sets)
        for table in (several, rare):
            discard(table)
    elif members.limit(1).count():
        labels = link(cross_pairs(members), labels)
    discard(members)
    for table in (crowd, *held):
        discard(table)
    return labels


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` with the ``label`` of their component (their own id while they are linked with nothing)."""
    of = labels.select(F.col("id").alias("doc_id"), F.col("label").alias("known"))
    return documents.join(of, "doc_id", "left").withColumn("label", F.coalesce("known", "doc_id")).drop("known")


def _sets_of(docs: DataFrame, wanted: DataFrame, reps: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """``doc_id, shingles`` of the representatives wanted, each the set of its class."""
    if repeated is None:
        return scratch_table(full_sets(docs.join(wanted, "doc_id")), "sets")
    single = full_sets(docs.join(wanted.join(repeated, "doc_id", "left_anti"), "doc_id"))
    several = sketched_sets(docs.join(repeated.join(wanted, "doc_id"), "doc_id")).join(reps.select("doc_id", "hi", "lo"), ["doc_id", "hi", "lo"])
    return scratch_table(single.unionByName(several.dropDuplicates(["doc_id"]).select("doc_id", "shingles")), "sets")


def _distinct_pairs(pairs: DataFrame, threshold: int) -> DataFrame:
    """``a, b`` of the pairs ``doc_id, hub`` whose set sizes allow a link."""
    near = F.lit(100) * F.least("n", "hub_n") >= F.lit(threshold) * F.greatest("n", "hub_n")
    return pairs.where(near).select(F.least("hub", "doc_id").alias("a"), F.greatest("hub", "doc_id").alias("b")).distinct()


def _linked(pairs: DataFrame, labels: DataFrame | None, sets: DataFrame, threshold: int) -> DataFrame:
    """``id, label`` of all linked documents after the confirmed pairs have joined theirs."""
    found = scratch_table(confirm(pairs, sets, threshold), "confirmed")
    if labels is None:
        after = components(found)
        discard(found)
        return after
    if found.limit(1).count() == 0:
        return labels
    of = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    to = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    moved = components(found.join(of, "a", "left").join(to, "b", "left")
                       .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    # documents that had no label yet are links' ends themselves
    new = moved.join(labels.select("id"), "id", "left_anti")
    old = labels.join(moved.select(F.col("id").alias("label"), F.col("label").alias("now")), "label", "left").select("id", F.coalesce("now", "label").alias("label"))
    after = scratch_table(old.unionByName(new), "components")
    for table in (found, moved, labels):
        discard(table)
    return after


def star_pass(placed: DataFrame, labels: DataFrame, link) -> tuple[DataFrame, DataFrame]:
    """Stars in the buckets ``bucket, doc_id, n, label`` that hold several components.

    New labels, and the documents that stood for the components of these buckets, with the numbers of components and
    documents the bucket held before.
    """
    # one document stands for a component in a bucket, another one in every bucket
    chosen = F.min(F.struct(F.xxhash64("bucket", "doc_id").alias("h"), "doc_id", "n")).alias("d")
    each = placed.groupBy("bucket", "label").agg(chosen, F.count("*").alias("held")).select("bucket", "label", "d.doc_id", "d.n", "held")
    several = each.groupBy("bucket").agg(F.count("*").alias("components"), F.sum("held").alias("documents")).where("components > 1")
    stands = scratch_table(each.join(several, "bucket"), "stands")
    # the largest components first; equal ones in the same order everywhere, so the same pairs come from many buckets
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("held"), F.xxhash64("label"), "label"))
    hubs = stands.withColumn("rank", rank).where(F.col("rank") <= SMALL)
    hubs = scratch_table(hubs.where(F.col("rank") <= F.when(F.col("components") > SMALL, HUBS).otherwise(SMALL))
                         .select("bucket", F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"), F.col("label").alias("hub_label")), "hubs")
    labels = link(stands.join(hubs, "bucket").where("label <> hub_label").select("doc_id", "n", "hub", "hub_n"), labels)
    discard(hubs)
    return labels, stands


def parted_buckets(stands: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows ``bucket, doc_id, components, documents`` of ``stands`` whose bucket still holds several components."""
    met = labelled(stands.select("bucket", "doc_id", "components", "documents"), labels)
    several = met.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("bucket")
    return scratch_table(met.drop("label").join(several, "bucket"), "parted")


def cross_pairs(members: DataFrame) -> DataFrame:
    """Every pair ``doc_id, n, hub, hub_n`` of documents of different components in the buckets ``bucket, doc_id, n, label``."""
    other = members.select("bucket", F.col("doc_id").alias("hub"), F.col("n").alias("hub_n"), F.col("label").alias("hub_label"))
    return members.join(other, "bucket").where("label <> hub_label AND doc_id < hub").select("doc_id", "n", "hub", "hub_n")


def several_components(placed: DataFrame) -> DataFrame:
    """The rows of the buckets that hold several components, with ``minor``: not of the component with the most rows there."""
    each = placed.groupBy("bucket", "label").agg(F.count("*").alias("held_rows"))
    of = (each.groupBy("bucket").agg(F.max(F.struct("held_rows", "label")).alias("main"), F.count("*").alias("components"))
          .where("components > 1").select("bucket", F.col("main.label").alias("main")))
    return scratch_table(placed.join(of, "bucket").withColumn("minor", F.col("label") != F.col("main")).drop("main"), "several")


def rare_pairs(several: DataFrame, threshold: int) -> DataFrame:
    """Every pair ``doc_id, n, hub, hub_n`` of different components in the buckets of ``rare_members`` that may be linked.

    The members of a bucket's main component do not meet each other. A linked pair meets in the bucket of the first
    shingle in the common order that both texts have (it stands in the prefix of either), so a bucket gives the pairs
    whose first it may be: their intersection is at most that shingle and those after its place in both. Their symmetric
    difference is at least the shingles that one text has alone and the parities of the others that differ. A pair is
    left out only where one of the two rules a link out.
    """
    other = several.select("bucket", *[F.col(c).alias(f"hub_{c}") for c in several.columns if c not in ("bucket", "doc_id")],
                           F.col("doc_id").alias("hub"))
    both = F.least(F.col("held") - F.col("place"), F.col("hub_held") - F.col("hub_place")) + 1
    sizes = F.col("n") + F.col("hub_n")
    apart = sum((F.bit_count(F.col(f"m{k}").bitwiseXOR(F.col(f"hub_m{k}"))) for k in range(MARKS)),
                sizes - F.col("held") - F.col("hub_held"))
    may = ((F.lit(100) * both >= F.lit(threshold) * (sizes - both))
           & (F.lit(100 - threshold) * sizes >= F.lit(100 + threshold) * apart))
    once = ~F.col("hub_minor") | (F.col("doc_id") < F.col("hub"))
    # two texts of one size class meet in that class, not in the one above again
    own = ~(F.col("lower") & F.col("hub_lower"))
    return (several.where("minor").join(other, "bucket").where((F.col("label") != F.col("hub_label")) & once & own & may)
            .select("doc_id", "n", "hub", "hub_n"))


def shared_buckets(reps: DataFrame) -> DataFrame:
    """Buckets ``bucket, doc_id, n, early, size`` in which a band of several documents agrees; ``early``: a first band.

    Most bands are those of one document only. All passes read this table, so the bands are dealt out by bucket once.
    """
    placed = reps.select(F.posexplode("bands").alias("band", "bucket"), "doc_id", "n").withColumn("early", F.col("band") < FIRST).drop("band")
    several = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return scratch_table(placed.join(several, "bucket"), "shared")


def may_be_among(docs: DataFrame, wanted: DataFrame, count: int) -> DataFrame:
    """The rows of ``docs`` whose id may be one of the ``count`` ids of ``wanted``: all of these, and few others.

    A bitmap of hashed ids, of bounded size, tells most of the others, so a join by id does not deal out their texts.
    """
    bits = min(MOST_BITS, max(PART_BITS, 1 << (16 * count).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    part, bit = F.floor(at / PART_BITS).alias("part"), (at % PART_BITS).alias("bit")
    bitmap = wanted.select(part, bit).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    bitmap = scratch_table(bitmap, "bitmap")                 # a small table, whose size Spark knows when it plans the join
    byte = F.expr("cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
    found = docs.select("*", part, bit).join(bitmap, "part").withColumn("byte", byte)
    return found.where(F.expr("(shiftright(byte, cast(bit % 8 as int)) & 1) = 1")).select(*docs.columns)


def parities(shingles: list[np.ndarray]) -> np.ndarray:
    """Per set ``MARKS`` words of bits: whether an odd number of its shingles falls on the bit.

    A bit that differs between two sets takes a shingle that only one of them has.
    """
    bits = 64 * MARKS
    who = np.repeat(np.arange(len(shingles)), np.array([len(s) for s in shingles], np.int64))
    at = (mix(np.concatenate([*shingles, np.zeros(0, np.uint64)]) ^ U(0x2545F4914F6CDD1D)) >> U(40)).astype(np.int64) % bits
    odd = np.bincount(who * bits + at, minlength=len(shingles) * bits) & 1
    return np.packbits(odd.astype(bool).reshape(len(shingles), bits), axis=1).view(np.int64)


def rare_members(crowd: DataFrame, threshold: int) -> DataFrame:
    """Buckets of rare shingles: ``bucket, doc_id, n, place, held, lower, m0...`` of ``doc_id, shingles``.

    With a common order of all shingles, two sets that reach the threshold share one among the first
    ``n - ceil(t n) + 1`` of either. Rare shingles come first, so texts that only share a widespread passage fall
    apart. A bucket is a shingle and a range of set sizes: sizes of linked sets differ by the factor ``t`` at most, so
    ranges of that width, each joined by the one above (``lower`` there), keep every link. ``held`` counts the shingles
    that other texts have too, ``place`` tells where the bucket's one stands among them, ``m0...`` are their parities.
    """
    def unpack(batches):
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
            sizes = np.array([len(p) for p in parts], np.int64)
            who = np.repeat(np.arange(len(parts)), sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(who)), pa.array(sizes[who]),
                 pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))], names=["doc_id", "n", "shingle"])

    each = scratch_table(crowd.select("doc_id", "shingles").mapInArrow(unpack, "doc_id long, n long, shingle long"), "shingles")
    often = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "shingle").groupBy("doc_id", "n").agg(F.collect_list(F.struct("df", "shingle")).alias("shared"))

    def prefix(batches):
        for batch in batches:
            lists = batch.column("shared")
            ends, df, shingle = lists.offsets.to_numpy(), *(lists.values.field(c).to_numpy() for c in ("df", "shingle"))
            sizes = batch.column("n").to_numpy()
            held, chosen = np.diff(ends), []
            # shingles of one text alone come first
            keep = np.maximum(sizes - np.ceil(sizes * threshold / 100.0 - 1e-9).astype(np.int64) + 1 - (sizes - held), 0)
            for lo, hi, k in zip(ends, ends[1:], keep):
                chosen.append(shingle[lo:hi][np.lexsort((shingle[lo:hi], df[lo:hi]))[:k]])
            words = parities([shingle[lo:hi].view(U) for lo, hi in zip(ends, ends[1:])])
            count = np.array([len(c) for c in chosen], np.int64)
            who = np.repeat(np.arange(len(chosen)), count)
            place = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + 1
            columns = [batch.column("doc_id").to_numpy()[who], sizes[who], np.concatenate([*chosen, np.zeros(0, np.int64)]), place,
                       held[who].astype(np.int64), *(words[who, m] for m in range(MARKS))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    names = ["doc_id", "n", "shingle", "place", "held", *(f"m{k}" for k in range(MARKS))]
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(threshold / 100.0))))
    keyed = (shared.mapInArrow(prefix, ", ".join(f"{c} long" for c in names))
             .select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("lower"))
             .withColumn("bucket", F.xxhash64("shingle", size_class + F.col("lower").cast("int"))))
    out = scratch_table(keyed.select("bucket", "doc_id", "n", "place", "held", "lower", *[f"m{k}" for k in range(MARKS)]), "rare")
    discard(each)
    return out


def sketched_sets(docs: DataFrame) -> DataFrame:
    """Set and digest of a row together (for ids that come with several texts)."""
    def make():
        import xxhash

        table = WordHashes()

        def work(texts: list[str]):
            sets = [shingle_set(t, table).tobytes() for t in texts]
            digests = [np.frombuffer(xxhash.xxh3_128_digest(s), np.int64) for s in sets]
            yield pa.array(sets, pa.binary())
            yield pa.array([d[0] for d in digests], pa.int64())
            yield pa.array([d[1] for d in digests], pa.int64())
        return work

    return map_texts(docs, make, "shingles binary, hi long, lo long")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The documents left when one of each group stays (the one with the smallest id), with their columns.

    Rows with a null id belong to no group and stay, as do all rows of a repeated id that is kept.
    """
    groups = near_groups(docs, id_col, text_col, threshold)
    name = fresh(docs, "kept_id")
    kept = groups.where("kept").select(F.col("doc_id").alias(name))
    grouped = docs.join(kept, docs[id_col].cast("long") == F.col(name), "left_semi")
    return grouped.unionByName(docs.where(F.col(id_col).isNull()))
