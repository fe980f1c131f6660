"""Approximate nearest neighbours by multiprobe p-stable hashing."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innsight.llm.common import materialise, uniform

#: Bound of the sample that the index is fitted on (expected rows), and of the queries among them that measure recall.
SAMPLE_ROWS, SAMPLE_QUERIES = 4_096, 200
#: Hash tables, width of a cell in standard deviations of a projection, and the recall to reach on the sample.
TABLES, CELL_WIDTH, TARGET_RECALL = 3, 2.5, 0.94
#: Most cells probed in a table; if they do not reach the target, every row is compared in blocks instead.
MOST_PROBES = 4_096
#: Rows and queries that are compared with each other at a time.
BLOCK_ROWS, BLOCK_QUERIES = 256, 1_024

FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                      T.StructField("score", T.DoubleType())])
_FOUND_ARROW = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


@dataclass
class Index:
    """Projections (tables, dimension, functions), offsets, cell width, probes a table, and the sample."""

    a: np.ndarray
    b: np.ndarray
    width: float
    probes: int
    ids: np.ndarray
    sample: np.ndarray
    recall: float

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each function, and the place within it."""
        p = (x @ self.a[t] + self.b[t]) / self.width
        whole = np.floor(p)
        return whole.astype(np.int64), p - whole

    def key(self, cells: np.ndarray) -> np.ndarray:
        """One number for the cells of a table; chance meetings only add candidates."""
        h = np.zeros(cells.shape[:-1], np.uint64)
        for j in range(cells.shape[-1]):
            h = (h ^ cells[..., j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return h.view(np.int64)


def probe_cells(cells: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """The cell of a point and its neighbours by +-1, in order of estimated success, ``most`` at most.

    A change of function i costs the squared distance to that side of the
    cell; sets of changes come out of a heap by their summed cost.
    """
    k = len(cells)
    out = [cells]
    if not k or most <= 1:
        return np.array(out).reshape(len(out), k)
    cost = np.concatenate([place ** 2, (1 - place) ** 2])
    order = np.argsort(cost, kind="stable")
    cost = cost[order].tolist()
    which, step = (order % k).tolist(), np.where(order < k, -1, 1).tolist()
    heap = [(cost[0], (0,))]
    while heap and len(out) < most:
        c, chosen = heapq.heappop(heap)
        if len({which[i] for i in chosen}) == len(chosen):
            cell = cells.copy()
            for i in chosen:
                cell[which[i]] += step[i]
            out.append(cell)
        m = chosen[-1]
        if m + 1 < 2 * k:
            heapq.heappush(heap, (c - cost[m] + cost[m + 1], (*chosen[:-1], m + 1)))
            heapq.heappush(heap, (c + cost[m + 1], (*chosen, m + 1)))
    return np.array(out)


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance in double precision, always summed the same way."""
    return np.sqrt(((q - x) ** 2).sum(-1))


def nearest(q: np.ndarray, q_ids: np.ndarray, bound: np.ndarray, x: np.ndarray, ids: np.ndarray, top: int) -> list[tuple]:
    """(query, row, distance) of each query's nearest ids within its bound, ties to the smaller id; of several rows with one id the nearest counts."""
    alone = len(np.unique(ids)) == len(ids)
    rough = (q ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None] - 2 * (q @ x.T)
    slack = 1e-9 * ((q ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None])
    near = (rough <= (bound ** 2)[:, None] + slack) & (q_ids[:, None] != ids[None])
    out = []
    for i in np.flatnonzero(near.any(1)):
        at = np.flatnonzero(near[i])
        if alone and len(at) > 4 * top:
            r = rough[i, at]
            cut = np.partition(r, top - 1)[top - 1] + 2 * slack[i, at].max()
            at = at[r <= cut]
        d = distances(q[i][None], x[at])
        best = np.lexsort((ids[at], d))
        if not alone:  # the first of each id, in order
            best = best[np.sort(np.unique(ids[at][best], return_index=True)[1])]
        best = best[:top]
        out += [(int(q_ids[i]), int(ids[at][j]), float(d[j])) for j in best if d[j] <= bound[i]]
    return out


def reach(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """A distance that each query's ``top``-th nearest id does not exceed; infinite if there are fewer ids."""
    out = np.full(len(q), np.inf)
    order = np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    for i in range(len(q)):
        other = ids != q_ids[i]
        d, own = distances(q[i][None], x[other]), ids[other]
        if len(d):  # one distance an id, its least
            d = np.minimum.reduceat(d, np.flatnonzero(np.append(True, own[1:] != own[:-1])))
        if len(d) >= top:
            out[i] = np.partition(d, top - 1)[top - 1]
    return out


def _valid(df: DataFrame, key: Column, vector: Column) -> DataFrame:
    """Rows that take part, as (vec_id, v array<double>)."""
    t = df.select(key.cast("long").alias("vec_id"), vector.cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    t = t.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    size = t.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "n").limit(1).collect()
    return t.where(F.size("v") == (size[0]["n"] if size else 0))


def fit(rows: DataFrame, n: int, seed: int = 11, tables: int = TABLES, target: float = TARGET_RECALL) -> Index | None:
    """Draw projections and choose the number of probes by the recall on a bounded sample of ``rows`` (vec_id, v)."""
    share = min(1.0, SAMPLE_ROWS / max(n, 1))
    got = rows.where(uniform(F.xxhash64(F.lit(seed), "vec_id", "v"), 1 << 24) < math.ceil(share * (1 << 24))).toArrow()
    if not got.num_rows:
        return None
    ids = got.column("vec_id").to_numpy()
    x = np.array(got.column("v").combine_chunks().flatten()).reshape(len(ids), -1)
    order = np.lexsort((ids,))
    ids, x = ids[order], x[order]
    k = max(1, round(math.log2(max(n, 2)) / 2))
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(tables, x.shape[1], k))
    width = CELL_WIDTH * float(np.sqrt(((x - x.mean(0)) ** 2).sum(1).mean())) or 1.0
    index = Index(a, rng.uniform(0, width, (tables, k)), width, 1, ids, x, 1.0)

    picked = rng.choice(len(x), min(SAMPLE_QUERIES, len(x)), replace=False)
    truths = [np.searchsorted(ids, [r[1] for r in nearest(x[i][None], ids[i:i + 1], np.array([np.inf]), x, ids, 10)]) for i in picked]
    keys = [index.key(index.cells(x, t)[0]) for t in range(tables)]
    need, first = 1, []
    for most in sorted({min(m, MOST_PROBES) for m in (64, 256, 1024, MOST_PROBES)}):
        first = []  # for each true neighbour: the least number of probes that finds it in any table
        for i, at in zip(picked, truths, strict=True):
            best = np.full(len(at), most + 1)
            for t in range(tables):
                cell, place = index.cells(x[i][None], t)
                rank: dict[int, int] = {}
                for r, key in enumerate(index.key(probe_cells(cell[0], place[0], most)).tolist()):
                    rank.setdefault(key, r + 1)
                best = np.minimum(best, [rank.get(key, most + 1) for key in keys[t][at].tolist()])
            first += best.tolist()
        need = int(np.quantile(first, target, method="higher")) if first else 1
        if need <= most:  # else more probes are tried
            break
    if need > MOST_PROBES:  # one cell for all rows: blocks of every row
        return Index(np.zeros((1, x.shape[1], 0)), np.zeros((1, 0)), 1.0, 1, ids, x, 1.0)
    index.probes, index.recall = need, float(np.mean(np.array(first) <= need)) if first else 1.0
    return index


def search(embeddings: DataFrame, key: Column, vector: Column, query: Column, top: int = 10, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows found for each query row, nearest first.

    Queries are the rows of ``embeddings`` where ``query`` (over the columns
    vec_id and v) holds; candidates are all rows but those with the query's own
    id. Ties go to the smaller id. Rows without id, and vectors null, zero,
    with null or non-finite components or not of the most frequent length,
    take no part. Repeated rows count once; rows with one id and different vectors count with the nearer one.
    Other columns are not read. An empty table gives no row.

    Every row is hashed into each table; queries probe cells in order of
    estimated success, as many as reach the target recall on a bounded sample.
    Rows of a cell meet its queries in blocks of bounded size, which return
    only what is within the query's distance to its ``top``-th neighbour in
    the sample; the sample's neighbours count as found, so no query has fewer than ``top`` if the table has them.
    """
    spark = embeddings.sparkSession
    valid = _valid(embeddings, key, vector)
    # of equal vectors, only the smallest ids can be among the nearest: the query's own and ``top`` more
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    rows = valid.distinct().withColumn("r", rank).where(F.col("r") <= top + 1).drop("r")
    rows = materialise(rows, "vectors")
    index = fit(rows, rows.count(), seed)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)
    queries = materialise(valid.where(query).distinct().withColumn("q", F.monotonically_increasing_id()), "queries")

    def arrays(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return b.column("vec_id").to_numpy(), np.array(b.column("v").flatten()).reshape(b.num_rows, -1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = arrays(b)
            keys = np.stack([ix.key(ix.cells(x, t)[0]) for t in range(len(ix.a))], 1)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * len(ix.a)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), flat], names=["vec_id", "v", "keys"])

    def sampled(x: np.ndarray, ids: np.ndarray) -> Iterator[list[tuple]]:
        ix = shared.value
        for lo in range(0, len(ids), 256):
            yield nearest(x[lo:lo + 256], ids[lo:lo + 256], np.full(len(ids[lo:lo + 256]), np.inf), ix.sample, ix.ids, top)

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids, x = arrays(b)
                for part in sampled(x, ids):
                    cols = zip(*part, strict=True) if part else ([], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            ids, x = arrays(b)
            bound = reach(x, ids, ix.sample, ix.ids, top)
            for i in range(len(ids)):
                keys, tabs = [], []
                for t in range(len(ix.a)):
                    cell, place = ix.cells(x[i][None], t)
                    own = np.unique(ix.key(probe_cells(cell[0], place[0], ix.probes)))
                    keys.append(own)
                    tabs.append(np.full(len(own), t))
                keys, tabs = np.concatenate(keys), np.concatenate(tabs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tabs.astype(np.int32)), pa.array(keys), pa.array(np.full(len(keys), b.column("q")[i].as_py(), np.int64)),
                     pa.array(np.full(len(keys), bound[i]))], names=["tab", "key", "q", "bound"])

    stored = materialise(rows.mapInArrow(hashed, "vec_id long, v array<double>, keys array<long>"), "hashed-vectors")
    cells = stored.select("vec_id", "v", F.posexplode("keys").alias("tab", "key"))
    # a probe is a number and a cell; the query's vector goes only to cells that hold rows
    probes = materialise(queries.mapInArrow(probed, "tab int, key long, q long, bound double"), "probes")
    blocks = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    in_cell = stored.select(F.posexplode("keys").alias("tab", "key")).groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n"))
    asked = probes.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("m"))
    # written: a join with it shuffles both sides for itself, and a cell with many rows can be split
    sizes = materialise(in_cell.join(asked, ["tab", "key"]).select(
        "tab", "key", blocks("n", BLOCK_ROWS).alias("nb"), blocks("m", BLOCK_QUERIES).alias("mb")), "cell-sizes")
    spread = lambda c: F.pmod(F.xxhash64("vec_id", "v"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = (cells.join(sizes, ["tab", "key"]).withColumn("x", spread("nb")).withColumn("y", every("mb"))
            .select("tab", "key", "x", "y", "vec_id", "v"))
    right = (probes.join(sizes, ["tab", "key"]).withColumn("y", F.pmod(F.xxhash64("q"), F.col("mb")).cast("int")).withColumn("x", every("nb"))
             .select("tab", "key", "x", "y", "q", "bound").join(queries, "q").drop("q"))

    def compare(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _FOUND_ARROW.empty_table()
        vectors = lambda t: np.array(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1)
        found = nearest(vectors(asked), asked.column("vec_id").to_numpy(), asked.column("bound").to_numpy(),
                        vectors(rows), rows.column("vec_id").to_numpy(), top)
        cols = list(zip(*found, strict=True)) if found else [[], [], []]
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

    by = ["tab", "key", "x", "y"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(compare, FOUND)
    found = met.unionByName(queries.drop("q").mapInArrow(started, FOUND)).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
