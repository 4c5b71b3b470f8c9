"""Exact top-k inner-product search with a vector-approximation file.

Vectors are scaled and floored to integers. Two files are written: the exact vectors, one row each, and the approximation,
in blocks of up to ``BLOCK`` rows: per vector and dimension the number of one of ``CELLS`` cells, one byte, and the
block's cell edges, quantiles of its own values, so that every vector lies inside its cells whatever the data.

The search scans the approximations alone. For a block of queries and a block of rows the cells give an upper and a lower
bound of every score; a row is passed on if its upper bound reaches the k-th best lower bound of its block, and stays if
it reaches the k-th best lower bound over all blocks. Exact vectors are then read in the order of the upper bounds: first
the k best of each query, and, as their k-th exact score is now known, only those others whose upper bound reaches it. What
shares a bound is read too, so ties are settled by the smaller id, and no row that could be in the result is left out.

Copies of one vector are one entry that carries its k + 1 smallest ids (the others tie with them and are never among the
k best), and queries with equal vectors are searched once, so a vector that a third of all rows hold is one entry.

The query set is a stated one (ids divisible by ``every``) and meets every block of approximations: row blocks and query
blocks are dealt to groups of about ``TILE`` bytes (row blocks to ``SPREAD`` groups at least), and every pair of groups is a
tile that one task scans. Both sides are shuffled to the tiles, whatever their size: the copies that meet every group are
many times the stored file by which Spark would choose a broadcast, and would pass through the driver. The joins that follow
are merge joins for the same reason: their files and shuffles are many times smaller than the rows.

Defined results: rows whose vector or id is null, or whose vector is empty or holds null or non-finite components, take no
part; shorter vectors count as padded with zeros; rows repeated with id and vector count once, rows of one id with different
vectors are rows of their own, but the query's own id is never its candidate; scores beyond the long range are cut to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_table
from .posting_ann import entries_of

CELLS = 256
BLOCK = 4096     # rows in a block of approximations
QUERIES = 512    # queries in a block
TILE = 16 << 20  # bytes of row blocks, and of query blocks, that meet in one task
SPREAD = 64      # groups of row blocks at least, for parallel work
SALTS = 64
EXACT = 2.0 ** 53          # whole numbers below are exact doubles
EXACT_SINGLE = 2.0 ** 24   # and below this exact singles


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(keys, vectors)`` of at most ``size`` rows, vectors padded with zeros."""
    keys: list[int] = []
    held: list[np.ndarray] = []

    def flush() -> tuple[np.ndarray, np.ndarray]:
        m = np.zeros((len(held), max(map(len, held))))
        for k, v in enumerate(held):
            m[k, :len(v)] = v
        out = np.array(keys, "<i8"), m
        keys.clear()
        held.clear()
        return out

    for batch in batches:
        column = batch.column("v")
        flat = column.flatten().to_numpy(zero_copy_only=False)
        ends = column.offsets.to_numpy() - column.offsets[0].as_py()
        for k, key in enumerate(batch.column("first").to_pylist()):
            keys.append(key)
            held.append(flat[ends[k]:ends[k + 1]])
            if len(held) == size:
                yield flush()
    if held:
        yield flush()


def approximations(entries: DataFrame, size: int, cells: int = CELLS) -> DataFrame:
    """The approximation file: ``n, dim, keys, codes, edges, top`` (largest absolute value) of blocks of entries."""
    names = ["n", "dim", "keys", "codes", "edges", "top"]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, m in _blocks(batches, size):
            codes, edges = cells_of(m, cells)
            row = [len(keys), m.shape[1], keys.tobytes(), codes.tobytes(), edges.astype("<f8").tobytes(), float(np.abs(m).max())]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)

    out = entries.select("first", "v").mapInArrow(run, "n long, dim long, keys binary, codes binary, edges binary, top double")
    return scratch_table(out.withColumn("b", F.monotonically_increasing_id()), "topk-codes")


def query_blocks(asked: DataFrame, size: int) -> DataFrame:
    """``q_n, q_dim, q_keys, q_vectors`` of blocks of queries (``q`` is the key of a query vector)."""
    names = ["q_n", "q_dim", "q_keys", "q_vectors"]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, m in _blocks(batches, size):
            row = [len(keys), m.shape[1], keys.tobytes(), m.astype("<f8").tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)

    out = asked.select(F.col("q").alias("first"), "v").mapInArrow(run, "q_n long, q_dim long, q_keys binary, q_vectors binary")
    return scratch_table(out.withColumn("b", F.monotonically_increasing_id()), "topk-queries")


def cells_of(m: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cell numbers (bytes) of a matrix, and the edges per dimension (cell c reaches from edge c to edge c + 1)."""
    edges = np.quantile(m, np.linspace(0, 1, cells + 1), axis=0, method="lower")
    edges[-1] = m.max(axis=0)
    code = np.empty(m.shape, np.uint8)
    for d in range(m.shape[1]):
        code[:, d] = np.clip(np.searchsorted(edges[:, d], m[:, d], "right") - 1, 0, cells - 1)
    return code, edges


def bounds(q: np.ndarray, code: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of all queries with all rows, from cell numbers alone."""
    return both_bounds(q, code, edges)[0]


def both_bounds(q: np.ndarray, code: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower bounds of the scores of all queries with all rows, from cell numbers alone."""
    twice, width = cell_sums(code, edges)
    middle, half = q @ twice.T, np.abs(q) @ width.T
    return (middle + half) / 2, (middle - half) / 2


def cell_sums(code: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and difference of the two edges of every cell (twice its middle, and its width)."""
    dims = np.arange(code.shape[1])
    low, high = edges[code, dims], edges[code.astype(np.int64) + 1, dims]
    return low + high, high - low


def scan_block(q: np.ndarray, code: np.ndarray, edges: np.ndarray, top: float, k: int) -> tuple[np.ndarray, ...]:
    """``(query, row, upper, lower)`` of the rows of a block that can be among the k best of a query."""
    return scan_cells(q, *cell_sums(code, edges), top, k, np.full(len(q), -np.inf))


def scan_cells(q: np.ndarray, twice: np.ndarray, width: np.ndarray, top: float, k: int, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """:func:`scan_block` on the sums of :func:`cell_sums`, for queries that have k rows of the lower bound ``reach``."""
    d = twice.shape[1]
    size = 4.0 * float(np.abs(q).max()) * top * d            # no sum below is larger
    kind = np.float32 if size < EXACT_SINGLE else np.float64
    x = q.astype(kind)
    middle, half = x @ twice.T.astype(kind), np.abs(x) @ width.T.astype(kind)
    if size >= EXACT:                                        # sums of doubles are rounded here
        half += size * (d + 4) * 2.0 ** -52
    upper, lower = middle + half, middle - half              # twice the bounds
    if size >= EXACT:                                        # scores beyond the long range tie
        upper, lower = (np.clip(np.where(np.isfinite(m), m, far), -2.0 ** 64, 2.0 ** 64) for m, far in ((upper, 2.0 ** 64), (lower, -2.0 ** 64)))
    if len(twice) > k and not np.isfinite(reach).all():
        reach = np.maximum(reach, np.partition(lower, -k, axis=1)[:, -k].astype(np.float64) / 2)
    limit = (2.0 * reach).astype(kind)
    limit = np.where(limit > 2.0 * reach, np.nextafter(limit, kind(-np.inf)), limit)
    n, r = np.divmod(np.flatnonzero(upper >= limit[:, None]), len(twice))
    return n, r, upper[n, r].astype(np.float64) / 2, lower[n, r].astype(np.float64) / 2


def raised(best: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """The k best lower bounds of every query (a row of ``best``, in falling order) with those of further rows."""
    k = best.shape[1]
    who, value = np.concatenate([np.repeat(np.arange(len(best)), k), n]), np.concatenate([best.ravel(), lower])
    order = np.lexsort((-value, who))
    who, value = who[order], value[order]
    return value[np.arange(len(who)) - np.searchsorted(who, who, "left") < k].reshape(len(best), k)


def scan_tile(blocks: list[dict], asked: list[dict], k: int, queries: int) -> tuple[np.ndarray, ...]:
    """``(query key, row key, upper, lower)`` of the rows of a tile that can be among the k best of a query."""
    q = np.zeros((sum(r["q_n"] for r in asked), max((r["q_dim"] for r in asked), default=0)))
    at = 0
    for r in asked:
        q[at:at + r["q_n"], :r["q_dim"]] = np.frombuffer(r["q_vectors"], "<f8").reshape(r["q_n"], r["q_dim"])
        at += r["q_n"]
    best = np.full((len(q), k), -np.inf)
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
    for r in blocks:
        keys, d = np.frombuffer(r["keys"], "<i8"), min(r["dim"], q.shape[1])     # what one side lacks counts as zeros
        code, edges = np.frombuffer(r["codes"], np.uint8).reshape(r["n"], r["dim"]), np.frombuffer(r["edges"], "<f8").reshape(-1, r["dim"])
        twice, width = cell_sums(code[:, :d], edges[:, :d])
        for at in range(0, len(q), queries):
            n, row, upper, lower = scan_cells(q[at:at + queries, :d], twice, width, r["top"], k, best[at:at + queries, -1])
            n = n + at
            new = lower > best[n, -1]
            if new.any():
                who, place = np.unique(n[new], return_inverse=True)
                best[who] = raised(best[who], place, lower[new])
            held.append((n, keys[row], upper, lower))
    n, keys, upper, lower = (np.concatenate(x) for x in zip(*held))
    stays = upper >= best[n, -1]
    asked_keys = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(r["q_keys"], "<i8") for r in asked)])
    return asked_keys[n[stays]], keys[stays], upper[stays], lower[stays]


def passed_on(store: DataFrame, asked: DataFrame, k: int, queries: int) -> DataFrame:
    """``q, first, upper, lower``: the rows of ``store`` that can be among the k best of a query block, by tiles."""
    part, place = F.shiftright("b", 33), F.col("b").bitwiseAND(F.lit((1 << 33) - 1))         # as the ids are made

    def sizes(blocks: DataFrame, columns: list[str], least: int) -> tuple[int, int]:
        """Into how many groups blocks are dealt, and how many tasks have made them."""
        held = F.sum(sum((F.octet_length(c) for c in columns), F.lit(0)).cast("long"))
        n, held, last = blocks.agg(F.count(F.lit(1)), held, F.max(part)).first()
        return max(1, min(n, max(least, -(-(held or 0) // TILE)))), (last or 0) + 1

    row_groups, row_tasks = sizes(store, ["keys", "codes", "edges"], SPREAD)
    query_groups, query_tasks = sizes(asked, ["q_keys", "q_vectors"], 1)

    def dealt(blocks: DataFrame, tasks: int, to: str, groups: int, meets: str, others: int) -> DataFrame:
        """Blocks in turn to the groups ``to``, each copied to every group ``meets``."""
        turn = F.pmod(place * F.lit(tasks) + part, F.lit(groups)).cast("int")
        return blocks.withColumn(to, turn).drop("b").withColumn(meets, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        found = scan_tile(left.to_pylist(), right.to_pylist(), k, queries)
        return pa.table([pa.array(x) for x in found], names=["q", "first", "upper", "lower"])

    rows = dealt(store, row_tasks, "g", row_groups, "h", query_groups)
    wanted = dealt(asked, query_tasks, "h", query_groups, "g", row_groups)
    return rows.groupBy("g", "h").cogroup(wanted.groupBy("g", "h")).applyInArrow(scan, "q long, first long, upper double, lower double")


def exact_scores(pairs: DataFrame, entries: DataFrame, asked: DataFrame) -> DataFrame:
    """``pairs`` (``q, first, ...``) with ``ids`` and ``score``: reads the exact vectors of these pairs only."""
    keep = pairs.columns
    read = pairs.join(entries.select("first", "ids", "v").hint("merge"), "first").join(asked.select("q", F.col("v").alias("qv")).hint("merge"), "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for v, qv in zip(batch.column("v"), batch.column("qv")):
                a, b = v.values.to_numpy(), qv.values.to_numpy()
                n = min(len(a), len(b))
                if np.abs(a).max() * np.abs(b).max() * n >= EXACT:   # beyond exact doubles: whole numbers of any size
                    score = sum(int(x) * int(y) for x, y in zip(a[:n].tolist(), b[:n].tolist()))
                    scores.append(min(max(score, -2 ** 63), 2 ** 63 - 1))
                else:
                    scores.append(int(a[:n] @ b[:n]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [batch.column("ids"), pa.array(scores, pa.int64())], names=[*keep, "ids", "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    return read.select(*keep, "ids", "v", "qv").mapInArrow(run, f"{kinds}, ids array<long>, score long")


def top_k(vectors: DataFrame, k: int = 5, scale: int = 256, every: int = 50, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows of every query."""
    v = F.col(vector_col).cast("array<double>")
    good = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(good).where(F.size(v) > 0).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda x: F.floor(x * scale).cast("double") + F.lit(0.0)).alias("v"))
    # one entry has room for the query's own id beside k others
    entries = scratch_table(entries_of(rows, k + 1), "topk-exact")
    digest = F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256)
    own = rows.where(F.col("id") % every == 0).dropDuplicates(["id", "v"]).select("id", "v", digest.alias("digest"))
    asked = scratch_table(own.groupBy("digest").agg(F.min("id").alias("q_id"), F.first("v").alias("v"))
                          .withColumn("q", F.monotonically_increasing_id()), "topk-asked")
    # an id may come with several vectors: entries go by a key of their own
    entries = scratch_table(entries.withColumn("first", F.monotonically_increasing_id()), "topk-keyed")
    # an entry of the query's own vector holds its own id: one more than k may be needed
    wanted = k + 1
    passed = scratch_table(passed_on(approximations(entries, block), query_blocks(asked, queries), wanted, queries), "topk-passed")
    by_lower = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("lower")))
    reach = passed.withColumn("r", by_lower).where(F.col("r") == wanted).select("q", F.col("lower").alias("reach"))
    left = passed.join(reach.hint("merge"), "q", "left").where(F.col("reach").isNull() | (F.col("upper") >= F.col("reach")))
    by_upper = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("upper"), "first"))
    left = scratch_table(left.withColumn("r", by_upper).select("q", "first", "upper", "r"), "topk-left")
    nearest = scratch_table(exact_scores(left.where(F.col("r") <= wanted).select("q", "first"), entries, asked), "topk-first")
    kth = nearest.groupBy("q").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    # a rounded double may lie a little below the exact whole number it stands for
    rest = (left.where(F.col("r") > wanted).join(kth.hint("merge"), "q")
            .where((F.col("n") < wanted) | (F.col("upper") + F.abs("upper") * F.lit(1e-9) >= F.col("kth"))).select("q", "first"))
    found = nearest.unionByName(exact_scores(rest, entries, asked))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    best = found.select("q", "score", F.explode("ids").alias("vec_id")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    answer = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "vec_id", "score"))).alias("answer"))

    # equal queries share one answer, which is dealt to as many places as their rows are
    salted = own.select(F.col("id").alias("query_id"), "digest", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    places = salted.select("digest", "salt").distinct()
    dealt = answer.join(asked.select("q", "digest").hint("merge"), "q").join(places.hint("merge"), "digest").select("digest", "salt", "answer")
    others = F.filter("answer", lambda a: a["vec_id"] != F.col("query_id"))
    out = salted.join(dealt.hint("merge"), ["digest", "salt"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
