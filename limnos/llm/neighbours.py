"""Nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more component that makes all lengths 1, so the largest
inner product with a query is the least distance from it. Each table cuts K Gaussian projections into cells; a
query visits its own bucket of every table and then perturbed ones, in the order of the estimated chance that
a neighbour lies there. Candidates are reranked by their exact inner product, bucket by bucket, in double
precision, and the tables' best are merged.

How many projections and probes are needed depends on the data. A bounded sample of queries is compared with
all vectors, and the finest hashing that reaches the asked recall on it within MOST_PROBES is taken; without
any, a table has one bucket and the search is exhaustive.

Equal vectors are one class in all of this, so a vector that a third of the rows share is hashed, probed and
compared once. A bucket with more than BUCKET classes or VISITS queries is dealt out over several tasks, its classes
and its queries alike. Vectors travel as bytes of the column's own precision and are compared in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from limnos.llm.text import keys64, mix64
from limnos.plans.staging import bounded_join, stage

NEAREST = 20
TABLES = 6
WIDTH = 1.6
MOST_PROBES = 24
MOST_PROJECTIONS = 20
#: Classes that a bucket should hold; classes and queries beyond which it is dealt out. Each share of classes gives
#: every query its own nearest, so classes are dealt out only where a task would hold too many; shares of queries add none.
FILL = 2048
BUCKET = 8192
VISITS = 1024
#: Sample queries for the choice of parameters, and the recall asked of them.
SAMPLE = 128
RECALL = 0.95
SEED = 3


def perturbations(k: int, most: int) -> list[tuple[int, ...]]:
    """Sets of places among a query's 2k distances to cell edges (nearest first), by expected sum of squares.

    A set never moves one projection both ways: the j-th nearest edge and the j-th farthest are of one cell.
    """
    if not k:
        return [()]
    j = np.arange(1, 2 * k + 1)
    near = j * (j + 1) / (4 * (k + 1) * (k + 2))
    m = 2 * k + 1 - j
    expected = np.where(j <= k, near, 1 - m / (k + 1) + m * (m + 1) / (4 * (k + 1) * (k + 2)))
    out: list[tuple[int, ...]] = [()]
    heap = [(float(expected[0]), (0,))]
    while heap and len(out) < most:
        cost, places = heapq.heappop(heap)
        if not {2 * k - 1 - p for p in places} & set(places):
            out.append(places)
        last = places[-1]
        if last + 1 < 2 * k:
            step = float(expected[last + 1])
            heapq.heappush(heap, (cost - float(expected[last]) + step, (*places[:-1], last + 1)))
            heapq.heappush(heap, (cost + step, (*places, last + 1)))
    return out


@dataclass
class Hashes:
    """TABLES tables of k projections, for vectors of one dimension and a largest norm."""

    dim: int
    norm: float
    k: int
    probes: int
    tables: int = TABLES

    def __post_init__(self) -> None:
        r = np.random.default_rng(SEED)
        self.planes = r.standard_normal((MOST_PROJECTIONS * self.tables, self.dim + 1)).reshape(self.tables, MOST_PROJECTIONS, -1)[:, : self.k].reshape(self.tables * self.k, self.dim + 1).T
        self.shift = r.uniform(0, 1, (self.tables, MOST_PROJECTIONS))[:, : self.k].reshape(-1)
        self.sets = perturbations(self.k, self.probes)

    def _places(self, x: np.ndarray, query: bool) -> np.ndarray:
        """rows x tables x k places on the projections, in cells."""
        if query:
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            y = unit @ self.planes[:-1]
        else:
            unit = x / self.norm
            rest = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
            y = unit @ self.planes[:-1] + rest[:, None] * self.planes[-1]
        return (y / WIDTH + self.shift).reshape(len(x), self.tables, self.k)

    def _keys(self, cells: np.ndarray) -> np.ndarray:
        """... x k cells -> a 64-bit key of each row's bucket, without its table."""
        with np.errstate(over="ignore"):
            return (mix64(cells.astype(np.int64).view(np.uint64) + np.uint64(1 << 32)) * keys64(MOST_PROJECTIONS, 7)[: self.k]).sum(axis=-1, dtype=np.uint64)

    def _table_keys(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(keys + keys64(self.tables, 17)[None, :, *[None] * (keys.ndim - 2)]).view(np.int64)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """rows x tables bucket keys of vectors."""
        return self._table_keys(self._keys(np.floor(self._places(x, query=False))))

    def visited(self, x: np.ndarray) -> np.ndarray:
        """rows x tables x probes bucket keys of queries, in the order of their visit."""
        p = self._places(x, query=True)
        cell = np.floor(p)
        part = p - cell
        edge = np.argsort(np.concatenate([part, 1 - part], axis=2), axis=2, kind="stable")  # e < k: down; else up
        out = np.empty((*p.shape[:2], len(self.sets)), np.uint64)
        for n, places in enumerate(self.sets):
            moved = cell.copy()
            for place in places:
                e = edge[:, :, place : place + 1]
                which = e % self.k
                step = np.where(e < self.k, -1.0, 1.0)
                np.put_along_axis(moved, which, np.take_along_axis(moved, which, axis=2) + step, axis=2)
            out[:, :, n] = self._keys(moved)
        return self._table_keys(out)


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    """rows x dim of a column of packed vectors, in double precision."""
    if not len(column):
        return np.zeros((0, 1))
    column = column.cast(pa.large_binary())
    _, where, data = column.buffers()
    ends = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].copy().view(kind).reshape(len(column), -1).astype(np.float64)


def _packed(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(id, dim, vec) of the rows that take part, vec packed, and the numbers' kind."""
    small = vectors.schema[vec_col].dataType == ArrayType(FloatType(), vectors.schema[vec_col].dataType.containsNull)
    kind = "<f4" if small else "<f8"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").cast("array<float>" if small else "array<double>").alias("vec")).filter("id IS NOT NULL AND vec IS NOT NULL")

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                vecs = part.column(1)
                x = vecs.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.array(0, kind)  # nulls are nan; -0 is 0
                ends = np.append(0, np.cumsum(pc.list_value_length(vecs).to_numpy(zero_copy_only=False)))
                bad, some = (np.append(0, np.cumsum(m)) for m in (~np.isfinite(x), x != 0))
                ok = np.flatnonzero((bad[ends[1:]] == bad[ends[:-1]]) & (some[ends[1:]] > some[ends[:-1]]))
                size = x.dtype.itemsize
                packed = pa.Array.from_buffers(pa.binary(), len(vecs), [None, pa.py_buffer((ends * size).astype(np.int32)), pa.py_buffer(x.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(ok)), pa.array(np.diff(ends)[ok].astype(np.int32)), packed.take(pa.array(ok))], names=["id", "dim", "vec"])

    return rows.mapInArrow(run, "id long, dim int, vec binary"), kind


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of one vector with rows, each summed alike wherever its row stands."""
    return (x * q).sum(axis=1)


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of q: ids and exact products of its n best rows of x, ties to the smaller id."""
    products = q @ x.T
    some = min(len(x), n + 12)
    rough = np.argpartition(-products, some - 1, axis=1)[:, :some]
    for i in range(len(q)):
        # rounding in blocked products may reorder near ties: all within it of the last are compared exactly
        row = products[i]
        floor = np.sort(row[rough[i]])[::-1][min(n, some) - 1] - 1e-9 * (1 + abs(row[rough[i]]).max())
        rows = rough[i] if some == len(x) or row[rough[i]].min() < floor else np.flatnonzero(row >= floor)
        scores = exact(q[i], x[rows])
        order = np.lexsort((ids[rows], -scores))[:n]
        yield ids[rows][order], scores[order]


def _scan(batches, n: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, salt, kind: the classes of a bucket (kind 0), then the queries that visit it (kind 1)."""
    key, x, ids = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        col = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
        keys, salts, kinds, cids = (col(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "kind", "cid"))
        vectors = _matrix(col("vec"), kind)
        edge = np.flatnonzero((keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(keys)], strict=True):
            if (keys[a], salts[a]) != key:
                key, x, ids = (keys[a], salts[a]), [], []
            if kinds[a] == 0:
                x.append(vectors[a:b])
                ids.append(cids[a:b])
            elif x:
                x, ids = [np.concatenate(x)], [np.concatenate(ids)]
                for at in range(a, b, 256):
                    to = min(b, at + 256)
                    got = list(best(vectors[at:to], x[0], ids[0], n))
                    sizes = np.cumsum([0, *[len(g[0]) for g in got]]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cids[at:to]), pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([g[0] for g in got]))), pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([g[1] for g in got])))], names=["qid", "cids", "scores"]
                    )


def brute(vectors: DataFrame, queries: DataFrame, kind: str, n: int = NEAREST) -> DataFrame:
    """(qid, cid, score) of the n best of vectors (cid, vec) for each of a few queries (qid, vec): all products."""
    rows = queries.toArrow()
    qid, q = rows.column("qid").to_numpy(), _matrix(rows.column("vec").combine_chunks(), kind)
    given = vectors.sparkSession.sparkContext.broadcast((qid, q))

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids, q = given.value
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ids]
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                if len(ids):
                    for h, got in zip(held, best(q, _matrix(part.column(1), kind), part.column(0).to_numpy(zero_copy_only=False), n + 1), strict=True):
                        h.append(got)
                        if len(h) > 8:
                            h[:] = [tuple(np.concatenate(z) for z in zip(*h, strict=True))]
                            order = np.lexsort((h[0][0], -h[0][1]))[: n + 1]
                            h[0] = (h[0][0][order], h[0][1][order])
        for i, h in zip(ids, held, strict=True):
            if h:
                c, s = (np.concatenate(z) for z in zip(*h, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), i)), pa.array(c), pa.array(s)], names=["qid", "cid", "score"])

    out = vectors.select("cid", "vec").mapInArrow(run, "qid long, cid long, score double").filter("qid <> cid")
    return out.withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))).filter(F.col("n") <= n).drop("n")


def choose(classes: DataFrame, queries: DataFrame, kind: str, count: int, dim: int, norm: float, nearest: int = NEAREST, recall: float = RECALL) -> tuple[Hashes, float]:
    """The finest hashing that reaches the recall on a sample of queries, and its recall there."""
    exhaustive = Hashes(dim, norm, 0, 1, 1)
    k = max(1, min(MOST_PROJECTIONS, math.ceil(math.log(max(1.0, count / FILL), 3))))
    sample = queries.orderBy(F.xxhash64("qid"), "qid").limit(SAMPLE)
    true = stage(brute(classes, sample, kind, nearest), "sample")
    pairs = true.join(F.broadcast(sample.withColumnRenamed("vec", "q")), "qid").join(classes.select("cid", "vec"), "cid").select("q", "vec").toArrow()
    if not pairs.num_rows:
        return exhaustive, 1.0
    q, x = (_matrix(pairs.column(c).combine_chunks(), kind) for c in ("q", "vec"))
    for k_now in range(k, 0, -1):
        h = Hashes(dim, norm, k_now, MOST_PROBES)
        met = (h.visited(q) == h.buckets(x)[:, :, None]).any(axis=1)  # pairs x probes
        found = np.maximum.accumulate(met, axis=1).mean(axis=0)
        enough = np.flatnonzero(found >= recall)
        if len(enough):
            return Hashes(dim, norm, k_now, int(enough[0]) + 1), float(found[enough[0]])
    return exhaustive, 1.0


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", n: int = NEAREST, recall: float = RECALL) -> DataFrame:
    """The n nearest found rows of every row where is_query (over the id) holds: query_id, rank, vec_id, score.

    Ids are integers. Rows whose id or vector is null, whose vector is zero or holds null or non-finite
    components, or has another length than most, take no part; repeated rows count once. Ties go to the smaller
    id; a query that has fewer candidates gets them all; no rows give no rows; other columns may have any name.
    """
    spark = vectors.sparkSession
    packed, kind = _packed(vectors, id_col, vec_col)
    packed = stage(packed.dropDuplicates(["id", "vec"]), "vectors")
    common = packed.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if not common:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = packed.filter(F.col("dim") == common["dim"]).select("id", "vec")
    # classes of equal vectors: of their ids only the first n + 1 can be among anyone's n nearest
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).filter(F.col("r") <= n + 1)
    classes = stage(first.groupBy("vec").agg(F.min("id").alias("cid"), F.sort_array(F.collect_list("id")).alias("ids")), "classes")
    least = rows.filter(is_query(F.col("id"))).select("vec").distinct()
    queries = stage(least.join(classes.select("vec", "cid"), "vec").select(F.col("cid").alias("qid"), "vec"), "queries")

    def products(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array((x * x).sum(axis=1))], names=["cid", "score"])

    squares = "cid long, score double"
    total = classes.select("cid", "vec").mapInArrow(products, squares).agg(F.count("*").alias("n"), F.sqrt(F.max("score")).alias("norm")).first()
    hashes, _ = choose(classes, queries, kind, total["n"], common["dim"], total["norm"], n, recall)
    given = spark.sparkContext.broadcast(hashes)

    def spread(probe: bool, whole: bool):
        def run(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                    x = _matrix(part.column(1), kind)
                    keys = given.value.visited(x) if probe else given.value.buckets(x)
                    keys = keys.reshape(len(x), -1)
                    if not whole:
                        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel())], names=["key"])
                        continue
                    at = np.repeat(np.arange(len(x)), keys.shape[1])
                    order = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), part.column(0).take(order), part.column(1).take(order)], names=["key", "cid", "vec"])

        return run

    pointed = "key long, cid long, vec binary"
    sides = classes.select("cid", "vec"), queries.select("qid", "vec")
    keys = [side.mapInArrow(spread(i == 1, False), "key long").groupBy("key").agg(F.count("*").alias(name)) for i, (side, name) in enumerate(zip(sides, ("held", "asked"), strict=True))]
    full = keys[0].join(keys[1], "key").filter((F.col("held") > BUCKET) | (F.col("asked") > VISITS))
    full = stage(full.select("key", F.ceil(F.col("held") / BUCKET).cast("int").alias("shares"), F.ceil(F.col("asked") / VISITS).cast("int").alias("turns")), "full")
    shares, turns = (F.coalesce(c, F.lit(1)) for c in ("shares", "turns"))
    every = lambda upto: F.explode(F.sequence(F.lit(0), upto - 1))
    own = lambda upto: F.pmod(F.xxhash64("cid"), upto).cast("int")
    index, probes = (bounded_join(side.mapInArrow(spread(i == 1, True), pointed), full, ["key"], "left") for i, side in enumerate(sides))
    index = index.select("key", own(shares).alias("share"), every(turns).alias("turn"), F.lit(0).alias("kind"), "cid", "vec")
    probes = probes.select("key", every(shares).alias("share"), own(turns).alias("turn"), F.lit(1).alias("kind"), "cid", "vec")
    both = index.unionByName(probes).withColumn("salt", F.xxhash64("share", "turn")).drop("share", "turn")
    both = both.repartition("key", "salt").sortWithinPartitions("key", "salt", "kind", "cid")
    found = both.mapInArrow(lambda x: _scan(x, n + 1, kind), "qid long, cids array<long>, scores array<double>")
    found = found.select("qid", F.inline(F.arrays_zip(F.col("cids").alias("cid"), F.col("scores").alias("score"))))
    selves = queries.select("qid", "vec").mapInArrow(products, squares).select(F.col("cid").alias("qid"), "cid", "score")
    found = found.unionByName(selves).groupBy("qid", "cid").agg(F.max("score").alias("score"))
    top = lambda by: Window.partitionBy("qid").orderBy(F.desc("score"), by)
    found = found.withColumn("r", F.row_number().over(top("cid"))).filter(F.col("r") <= n + 1)
    ids = found.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("id"))
    ids = ids.withColumn("r", F.row_number().over(top("id"))).filter(F.col("r") <= n + 1)
    lists = ids.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("near"))
    asking = rows.filter(is_query(F.col("id"))).join(classes.select("vec", F.col("cid").alias("qid")), "vec").select("id", "qid").distinct()
    out = asking.join(lists, "qid").select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, n)).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def op5(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0)
