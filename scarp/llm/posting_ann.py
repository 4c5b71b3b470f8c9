"""Approximate nearest neighbours by inner product: balanced posting lists behind an in-memory centroid graph.

Vectors are scaled by the largest norm and given one more component that fills them up to length 1, so that the largest
inner product is the smallest distance; queries have 0 there. Then

* **lists**: a balanced tree of halvings (2-means, cut at the median) over a bounded sample gives centroids of equally
  filled cells, one for about ``LIST_ROWS`` rows and at most ``MAX_LISTS``;
* **graph**: the centroids form a graph of near, mutually diverse neighbours (and a ring, so that it is connected). It
  travels to the tasks (at most ``MAX_LISTS`` vectors, a few MB). A search descends until the nearest centroids it
  has met (``BEAM``) are expanded and then widens to every centroid within a given ratio of the nearest one's distance;
* **replication**: a vector goes to the list of its nearest centroid, and, if it lies near a boundary, to those whose
  distance is within ``1 + REPLICATE`` of it as well, ``COPIES`` lists at most;
* **search**: a query reads the lists whose centroids lie within ``1 + PROBE`` of its nearest one; there is no limit on
  their number, so hard data get more lists, not fewer results. Lists that hold fewer than k rows are widened to the
  next nearest. In the lists all inner products are computed.

Neighbouring lists are packed into blocks of about ``BLOCK`` rows; a larger list is dealt over several blocks, and the
queries of a block over tasks of about ``ASKED``. A query goes to a block once, whatever it probes there, and k + 1
rows come back.

Copies of one vector stand as one entry that carries its k + 1 smallest ids: the other copies tie with those and can never
be among the k best. Queries with equal vectors are searched once. So a vector held by a third of all rows is one entry.

The sample bounds the fitting of the centroids only (``SAMPLE`` rows a list, by a hash of the id); every row is indexed.

Defined results: rows without id, and vectors that are null, empty, all zero or hold null or non-finite components take
no part; shorter vectors count as padded with zeros; rows repeated with id and vector count once; rows of one id with
different vectors are rows of their own, but a query's own id is never its result; ties go to the smaller id; with k
candidates or fewer all are returned; other columns are ignored; without vectors the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table

LIST_ROWS = 256        # entries for each list wanted
MAX_LISTS = 4096
SAMPLE = 32            # sampled rows a list; the sample holds about MAX_LISTS * SAMPLE rows at most
COPIES = 4
REPLICATE = 0.1
PROBE = 0.22
BLOCK = 16384
ASKED = 16384
ENTRIES = 8            # entry points of a graph search
BEAM = 16              # nearest centroids that a search has expanded before it ends
BATCH = 256            # vectors that search the graph together
PAIRS = 1 << 16        # distances computed at once
SALTS = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Index:
    """Unit centroids (rows), neighbours in the graph (padded with -1), scale of the vectors, their dimension."""
    centroids: np.ndarray
    graph: np.ndarray
    scale: float
    norm: float
    dim: int

    def unit(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """Vectors on the unit sphere with one more component; queries point there without it."""
        x = vectors / self.scale
        if queries:
            return np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x))])
        x = x / self.norm
        return np.column_stack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))])


# ------------------------------------------------------------ centroids and graph

def halve(m: np.ndarray, rows: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Two equal halves of ``rows``: 2-means along the line of the two means, cut at the median."""
    x = m[rows]
    a = x[np.argmax(((x - x.mean(axis=0)) ** 2).sum(axis=1))]
    b = x[np.argmax(((x - a) ** 2).sum(axis=1))]
    middle = len(rows) // 2
    order = np.arange(len(rows))
    for _ in range(rounds):
        order = np.argsort(x @ (a - b), kind="stable")
        a, b = x[order[middle:]].mean(axis=0), x[order[:middle]].mean(axis=0)
    return rows[order[:middle]], rows[order[middle:]]


def balanced_centroids(m: np.ndarray, lists: int) -> np.ndarray:
    """Unit means of ``lists`` equally filled cells, neighbouring cells next to each other."""
    cells = [np.arange(len(m))]
    while len(cells) < lists:
        largest = max(map(len, cells))
        if largest < 2:
            break
        grown = []
        for k, cell in enumerate(cells):
            if len(cell) == largest and len(grown) + len(cells) - k < lists:
                grown += halve(m, cell)
            else:
                grown.append(cell)
        cells = grown
    means = np.array([m[cell].mean(axis=0) for cell in cells])
    size = np.linalg.norm(means, axis=1, keepdims=True)
    return means / np.where(size > 0, size, 1.0)


def centroid_graph(c: np.ndarray, near: int = 24, degree: int = 12) -> np.ndarray:
    """Neighbours of every centroid: of its nearest ones those not nearer to one already taken, both ways, and a ring."""
    n = len(c)
    linked: list[set[int]] = [{(k - 1) % n, (k + 1) % n} - {k} for k in range(n)]
    for start in range(0, n, 1024):
        dots = c[start:start + 1024] @ c.T
        for k in range(len(dots)):
            i = start + k
            order = np.argsort(-dots[k], kind="stable")[:near + 1]
            order = order[order != i][:near]
            among, taken = c[order] @ c[order].T, []
            for j, dot in enumerate(dots[k][order]):
                if len(taken) < degree and not (among[j, taken] > dot).any():
                    taken.append(j)
            for j in order[taken].tolist():
                linked[i].add(j)
                linked[j].add(i)
    out = np.full((n, max(1, max(map(len, linked)))), -1, np.int32)
    for i, links in enumerate(linked):
        out[i, :len(links)] = sorted(links)
    return out


def search_graph(index: Index, x: np.ndarray, ratio: float) -> np.ndarray:
    """Distances of unit vectors to the centroids met, infinite for those beyond ``1 + ratio`` of the nearest one."""
    c, graph = index.centroids, index.graph
    rows = np.arange(len(x))
    far = np.full((len(x), len(c)), np.inf)
    expanded = np.zeros(far.shape, bool)

    def measure(r: np.ndarray, n: np.ndarray) -> None:
        new = np.isinf(far[r, n])
        r, n = r[new], n[new]
        for at in range(0, len(r), PAIRS):
            s = slice(at, at + PAIRS)
            dot = np.einsum("ij,ij->i", x[r[s]], c[n[s]])
            far[r[s], n[s]] = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dot))

    def expand(r: np.ndarray, n: np.ndarray) -> None:
        expanded[r, n] = True
        reached = graph[n]
        r2 = np.repeat(r, reached.shape[1])
        n2 = reached.ravel()
        measure(r2[n2 >= 0], n2[n2 >= 0])

    starts = np.unique(np.linspace(0, len(c) - 1, ENTRIES).astype(np.int64))
    measure(np.repeat(rows, len(starts)), np.tile(starts, len(rows)))
    beam = min(BEAM, len(c))
    active = rows
    while len(active):                                       # descend until the nearest ones known are all expanded
        closest = np.argpartition(far[active], beam - 1, axis=1)[:, :beam]
        open_ = ~expanded[active[:, None], closest] & np.isfinite(far[active[:, None], closest])
        at, place = np.nonzero(open_)
        expand(active[at], closest[at, place])
        active = active[open_.any(axis=1)]
    while True:                                              # everything within the ratio
        bound = (1.0 + ratio) * far.min(axis=1, keepdims=True) + 1e-12
        r, n = np.nonzero((far <= bound) & ~expanded)
        if not len(r):
            return np.where(far <= bound, far, np.inf)
        expand(r, n)


# ------------------------------------------------------------ vectors in Arrow batches

def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a float64 matrix, short vectors padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    m = np.zeros((len(sizes), dim))
    m[np.arange(dim) < sizes[:, None]] = flat
    return m


def _batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the rows that take part; the component type (float or double) stays."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    # adding 0 turns -0.0 into 0.0, so that equal vectors compare as equal
    kind = "float" if "array<float>" in vectors.schema[vector_col].dataType.simpleString() else "double"
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: (x + F.lit(0.0)).cast(kind)).alias("v"))


def entries_of(rows: DataFrame, ids: int) -> DataFrame:
    """One entry per different vector: ``first`` (smallest id), ``ids`` (its smallest ``ids`` ids), ``v``."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.dropDuplicates(["id", "v"]).withColumn("r", rank).where(F.col("r") <= ids)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("first"), "ids", "v")


def fit(entries: DataFrame, count: int, list_rows: int = LIST_ROWS, max_lists: int = MAX_LISTS, sample: int = SAMPLE) -> Index | None:
    """Centroids and graph from a hash sample of the entries, fitted in one task; nothing is fitted without entries."""
    top = F.transform("v", lambda x: F.abs(x).cast("double"))
    scale, dim = entries.agg(F.max(F.array_max(top)), F.max(F.size("v"))).first()
    if scale is None:
        return None
    norm = entries.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.lit(scale)) * (x / F.lit(scale)))))).first()[0]
    lists = max(1, min(max_lists, -(-count // list_rows)))
    index = Index(np.zeros((1, dim + 1)), np.zeros((1, 1), np.int32), float(scale), float(norm), int(dim))
    share = min(1.0, sample * lists / count)
    few = entries.where(F.pmod(F.xxhash64("first"), F.lit(1 << 30)) < F.lit(int(math.ceil(share * (1 << 30)))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("first").to_numpy(), _matrix(b.column("v"), dim)) for b in batches]
        if not held:
            return
        first, m = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        c = balanced_centroids(index.unit(m[np.argsort(first, kind="stable")], False), lists)
        g = centroid_graph(c)
        yield pa.RecordBatch.from_pydict({"n": [len(c)], "centroids": [c.astype("<f8").tobytes()], "graph": [g.astype("<i4").tobytes()]},
                                         schema=pa.schema([("n", pa.int64()), ("centroids", pa.binary()), ("graph", pa.binary())]))

    few = few if count > sample * lists else entries
    built = few.select("first", "v").repartition(1).mapInArrow(build, "n long, centroids binary, graph binary").first()
    if built is None:                                        # the hash chose none of very few rows
        built = entries.select("first", "v").limit(lists * sample).repartition(1).mapInArrow(
            build, "n long, centroids binary, graph binary").first()
    index.centroids = np.frombuffer(built["centroids"], "<f8").reshape(built["n"], dim + 1)
    index.graph = np.frombuffer(built["graph"], "<i4").reshape(built["n"], -1)
    return index


def postings_of(entries: DataFrame, index: Index, copies: int = COPIES, replicate: float = REPLICATE) -> DataFrame:
    """``list, own, first, ids, v``: every entry in the list of its nearest centroid (``own``), boundary entries in more."""
    kind = entries.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, BATCH):
            far = search_graph(index, index.unit(_matrix(batch.column("v"), index.dim), False), replicate)
            order = np.argsort(far, axis=1, kind="stable")[:, :copies]
            row, rank = np.nonzero(np.isfinite(np.take_along_axis(far, order, axis=1)))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(order[row, rank].astype(np.int32)), pa.array(rank == 0)] + [batch.column(c).take(at) for c in ("first", "ids", "v")],
                names=["list", "own", "first", "ids", "v"])

    return entries.mapInArrow(run, f"list int, own boolean, first long, ids array<long>, v {kind}")


@dataclass
class Directory:
    """For every list the ids it holds as the nearest and its group; for every group its blocks and shares of queries."""
    own: np.ndarray
    group: np.ndarray
    blocks: np.ndarray
    shares: np.ndarray


def directory_of(sizes: np.ndarray, own: np.ndarray, block: int = BLOCK) -> Directory:
    """Pack neighbouring lists into groups of at most ``block`` rows; larger lists are groups of several blocks."""
    group = np.zeros(len(sizes), np.int32)
    at = filled = 0
    for k, size in enumerate(sizes.tolist()):
        if filled and filled + size > block:
            at, filled = at + 1, 0
        group[k] = at
        filled += size
    held = np.bincount(group, sizes, at + 1).astype(np.int64)
    return Directory(own, group, np.maximum(1, -(-held // block)).astype(np.int32), np.ones(at + 1, np.int32))


def probes(index: Index, x: np.ndarray, own: np.ndarray | None, wanted: int, ratio: float) -> list[np.ndarray]:
    """The lists that each query reads; widened to the next nearest where they hold too few rows of their own."""
    far, out = search_graph(index, x, ratio), []
    for k in range(len(x)):
        lists = np.flatnonzero(np.isfinite(far[k]))
        if own is not None and own[lists].sum() < wanted:
            order = np.argsort(-(index.centroids @ x[k]), kind="stable")
            enough = int(np.searchsorted(np.cumsum(own[order]), wanted)) + 1
            lists = np.union1d(lists, order[:enough])
        out.append(lists)
    return out


# ------------------------------------------------------------ search

def best_of(q: np.ndarray, probed: np.ndarray, m: np.ndarray, member: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, entry, score)`` of the k best entries of the probed lists; entries by id, ties to the smaller one."""
    out_q, out_e, out_s = [], [], []
    for at in range(0, len(q), 128):
        part = q[at:at + 128]
        score = np.where(probed[at:at + 128].astype(np.float32) @ member.T.astype(np.float32) > 0, part @ m.T, -np.inf)
        if score.shape[1] > k:
            floor = np.partition(score, -k, axis=1)[:, -k]
            floor = np.where(np.isfinite(floor), floor - 1e-9 * np.maximum(1.0, np.abs(floor)), floor)
            score = np.where(score >= floor[:, None], score, -np.inf)
        r, e = np.nonzero(score > -np.inf)
        exact = np.add.accumulate(part[r] * m[e], axis=1)[:, -1] if len(r) else np.zeros(0)
        order = np.lexsort((first[e], -exact, r))
        r, e, exact = r[order], e[order], exact[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r, "left")
        keep = rank < k
        out_q.append(r[keep] + at)
        out_e.append(e[keep])
        out_s.append(exact[keep])
    return np.concatenate(out_q), np.concatenate(out_e), np.concatenate(out_s)


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            probe: float = PROBE, list_rows: int = LIST_ROWS, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest rows found for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_col, vector_col)
    kind = rows.schema["v"].dataType.simpleString()
    entries = scratch_table(entries_of(rows, k + 1), "ann-entries")
    index = fit(entries, entries.count(), list_rows)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    digest = F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256)
    queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"]).select("id", "v", digest.alias("digest"))
    asked = scratch_table(queries.groupBy("digest").agg(F.min("id").alias("q"), F.first("v").alias("v")), "ann-queries")

    # the directory: a few numbers per list, MAX_LISTS rows at most
    postings = scratch_table(postings_of(entries, index), "ann-postings")
    sizes, own = (np.zeros(len(index.centroids), np.int64) for _ in range(2))
    for r in postings.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("own"), F.size("ids"))).alias("own")).collect():
        sizes[r["list"]], own[r["list"]] = r["n"], r["own"] or 0
    book = directory_of(sizes, own, block)

    def count_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(book.blocks), np.int64)
        for batch in _batches(batches, BATCH):
            for lists in probes(index, index.unit(_matrix(batch.column("v"), index.dim), True), own, k + 1, probe):
                total[np.unique(book.group[lists])] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["g", "n"])

    for r in asked.mapInArrow(count_groups, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        book.shares[r["g"]] = max(1, -(-r["n"] // ASKED))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, BATCH):
            at, group, lists, blocks, shares = [], [], [], [], []
            for n, probed in enumerate(probes(index, index.unit(_matrix(batch.column("v"), index.dim), True), own, k + 1, probe)):
                for g in np.unique(book.group[probed]).tolist():
                    here = probed[book.group[probed] == g]
                    at.append(n)
                    group.append(g)
                    lists.append(here.astype(np.int32))
                    blocks.append(book.blocks[g])
                    shares.append(book.shares[g])
            yield pa.RecordBatch.from_arrays(
                [pa.array(group, pa.int32()), pa.array(lists, pa.list_(pa.int32())), pa.array(blocks, pa.int32()), pa.array(shares, pa.int32()),
                 batch.column("q").take(pa.array(at, pa.int64())), batch.column("v").take(pa.array(at, pa.int64()))],
                names=["g", "lists", "blocks", "shares", "q", "v"])

    wanted = asked.mapInArrow(ask, f"g int, lists array<int>, blocks int, shares int, q long, v {kind}")
    wanted = wanted.select("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
                           F.pmod(F.xxhash64("q"), F.col("shares")).cast("int").alias("s"), "q", "lists", "v")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = book.group[batch.column("list").to_numpy()]
            mixed = batch.column("first").to_numpy().view(np.uint64) * _MIX
            b = ((mixed >> np.uint64(33)) % book.blocks[g].astype(np.uint64)).astype(np.int32)
            rows = np.repeat(np.arange(len(g)), book.shares[g])          # once for every share of the block's queries
            s = np.arange(len(rows)) - np.repeat(np.cumsum(book.shares[g]) - book.shares[g], book.shares[g])
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[rows]), pa.array(b[rows]), pa.array(s.astype(np.int32))] + [batch.column(c).take(at) for c in ("list", "first", "ids", "v")],
                names=["g", "b", "s", "list", "first", "ids", "v"])

    held = postings.mapInArrow(deal, f"g int, b int, s int, list int, first long, ids array<long>, v {kind}")

    dim = index.dim

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["q", "first", "score", "ids"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.int64()))], names=names)
        left, right = left.combine_chunks(), right.combine_chunks()
        first, where, number = np.unique(left["first"].to_numpy(), return_index=True, return_inverse=True)
        known, local = np.unique(left["list"].to_numpy(), return_inverse=True)
        member = np.zeros((len(first), len(known)), bool)
        member[number, local] = True
        m = _matrix(left["v"].chunk(0), dim)[where]
        asked_lists = right["lists"].chunk(0)
        who = np.repeat(np.arange(right.num_rows), np.diff(asked_lists.offsets.to_numpy()))
        flat = asked_lists.flatten().to_numpy()
        place = np.minimum(np.searchsorted(known, flat), len(known) - 1)
        probed = np.zeros((right.num_rows, len(known)), bool)
        hit = known[place] == flat
        probed[who[hit], place[hit]] = True
        r, e, score = best_of(_matrix(right["v"].chunk(0), dim), probed, m, member, first, k + 1)
        return pa.table([right["q"].take(pa.array(r)), pa.array(first[e]), pa.array(score), left["ids"].take(pa.array(where[e]))], names=names)

    keys = ["g", "b", "s"]
    found = held.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(match, "q long, first long, score double, ids array<long>")
    # an entry may come from several lists; its copies share score and first id, so they share one dense rank
    best = found.withColumn("r", F.dense_rank().over(Window.partitionBy("q").orderBy(F.desc("score"), "first"))).where(F.col("r") <= k + 1)
    best = best.dropDuplicates(["q", "first"]).select("q", "score", F.explode("ids").alias("vec_id"))
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    answer = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("answer"))

    # equal queries share one answer, which is dealt to as many places as their rows are
    salted = queries.select(F.col("id").alias("query_id"), "digest", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    places = salted.select("digest", "salt").distinct()
    dealt = answer.join(asked.select("q", "digest"), "q").join(places, "digest").select("digest", "salt", "answer")
    others = F.filter("answer", lambda a: a["vec_id"] != F.col("query_id"))
    own_rows = salted.join(dealt, ["digest", "salt"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
    return own_rows.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
