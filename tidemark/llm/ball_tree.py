"""Exact top-k inner products by branch and bound over ball trees, one tree a shard.

Rows are dealt to shards of some thousand vectors; each shard becomes one row that holds its vectors in the
order of a ball tree (centre and radius of every node). Queries travel in blocks. A block visits a shard's
nodes in order of their upper bound, the largest ``q . centre + |q| radius`` among the queries that still
need the node, and skips a node for every query whose k-th score is out of reach. The first shard gives
every query a k-th score, which all other shards then start from.

Components are scaled and rounded down to integers, and scores are exact integers; beyond 64 bits they
stop at the largest or smallest long.

Rows with a null id, a null vector, or components that are null or not finite after scaling take no part.
Equal rows count once; rows that carry the query's id are its own and no candidates. Rows that give one id
several vectors are several candidates, and as queries share one list. Vectors of another dimension are no
candidates. Ties go to the smaller id. A query without candidates returns no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import repeats
from tidemark.llm.shared import stash, table

K = 10
SCALE = 1024
SHARD_ROWS = 8192
BLOCK_QUERIES = 256
LEAF = 128
PACKED = "part long, dim int, n int, ids binary, vectors binary, kth binary, centres binary, radii binary, nodes binary"
FOUND = "query_id long, vec_id long, score long"
LONG = (1 << 63) - 1


def build(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the vectors, and of every node its centre, radius and (start, end, left, right)."""
    order, centres, radii, nodes = np.arange(len(vectors)), [], [], []

    def node(start: int, end: int) -> int:
        own = vectors[order[start:end]]
        centre = own.mean(axis=0)
        apart = np.sqrt(((own - centre) ** 2).sum(axis=1))
        number = len(nodes)
        nodes.append([start, end, -1, -1])
        centres.append(centre)
        radii.append(apart.max())
        if end - start > LEAF:
            # split at the median between the point far from the centre and the point far from that
            far = own[apart.argmax()]
            other = own[((own - far) ** 2).sum(axis=1).argmax()]
            along = own @ (other - far)
            middle = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(along, middle)]
            nodes[number][2:] = node(start, start + middle), node(start + middle, end)
        return number

    node(0, len(vectors))
    return order, np.array(centres).reshape(len(nodes), -1), np.array(radii), np.array(nodes, np.int64)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products as longs: by doubles where those are exact, else by integers of any size."""
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(queries.shape[1], 1)
    if most < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    left = [[int(x) for x in row] for row in queries]
    right = [[int(x) for x in row] for row in vectors]
    sums = [[max(min(sum(map(mul, a, b)), LONG), -LONG - 1) for b in right] for a in left]
    return np.array(sums, np.int64)


def search(queries: np.ndarray, own: np.ndarray, kth: np.ndarray, ids: np.ndarray, vectors: np.ndarray, tree: tuple, k: int) -> list:
    """For every query its k best (score, id) of a shard, of those whose score reaches kth; tree as build returns it."""
    centres, radii, nodes = tree
    norms = np.sqrt((queries**2).sum(axis=1))
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    kth = kth.copy()

    def bounds(number: int, rows: np.ndarray) -> np.ndarray:
        upper = queries[rows] @ centres[number] + norms[rows] * radii[number]
        # room for the rounding of centres, radii and sums
        return upper + 1 + 1e-9 * norms[rows] * (radii[number] + np.abs(centres[number]).sum())

    def visit(number: int, rows: np.ndarray) -> None:
        upper = bounds(number, rows)
        if (upper >= kth[rows]).any():
            heapq.heappush(heap, (-upper.max(), number, rows, upper))

    heap: list[tuple] = []
    visit(0, np.arange(len(queries)))
    while heap:
        _, number, rows, upper = heapq.heappop(heap)
        rows = rows[upper >= kth[rows]]
        start, end, left, right = nodes[number]
        if left >= 0:
            for child in (left, right) if len(rows) else ():
                visit(int(child), rows)
            continue
        scores = _products(queries[rows], vectors[start:end])
        able = (scores >= kth[rows][:, None]) & (ids[start:end] != own[rows][:, None])
        for i in np.flatnonzero(able.any(axis=1)):
            at, query = np.flatnonzero(able[i]), rows[i]
            merged = best[query] + list(zip(scores[i, at].tolist(), ids[start + at].tolist(), strict=True))
            best[query] = sorted(merged, key=lambda x: (-x[0], x[1]))[:k]
            if len(best[query]) == k:
                kth[query] = max(kth[query], _below(best[query][-1][0]))
    return best


def _below(score: int) -> float:
    """A double no larger than the score, and equal to it where doubles hold all integers."""
    return float(score) if abs(score) < 1 << 53 else float(np.nextafter(float(score), -np.inf))


def _packed(with_tree: bool) -> Callable:
    """applyInArrow function: the rows of a part as one row of arrays, with a tree or with k-th scores."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().to_batches()[0]
        get = lambda name: rows.column(rows.schema.get_field_index(name))
        dim, ids = get("dim")[0].as_py(), get("vec_id").to_numpy(zero_copy_only=False)
        vectors = np.floor(repeats.lists(get("v"))[0].astype(np.float64)).reshape(len(ids), dim)
        order, empty = np.lexsort((ids,)), np.zeros(0)
        kth = empty if with_tree else get("kth").to_numpy(zero_copy_only=False)[order]
        tree = build(vectors) if with_tree else (order, empty, empty, empty)
        raw = [ids[tree[0]], vectors[tree[0]], kth, *tree[1:]]
        return pa.table(
            [pa.array([get("part")[0].as_py()], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32())]
            + [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in raw],
            [c.split()[0] for c in PACKED.split(", ")],
        )

    return run


def _visits(k: int) -> Callable:
    """mapInArrow function: (query block, shard) rows to the best candidates of every query in that shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(j)[i] for j, c in enumerate(batch.schema.names)}
                dim, n, q_n = row["dim"].as_py(), row["n"].as_py(), row["q_n"].as_py()

                def array(name: str, kind: type, *shape: int, row: dict = row) -> np.ndarray:
                    return np.frombuffer(row[name].as_buffer(), kind).reshape(*shape)

                own, nodes = array("q_ids", np.int64, q_n), array("nodes", np.int64, -1, 4)
                tree = array("centres", np.float64, len(nodes), dim), array("radii", np.float64, -1), nodes
                best = search(
                    array("q_vectors", np.float64, q_n, dim),
                    own,
                    array("q_kth", np.float64, q_n),
                    array("ids", np.int64, n),
                    array("vectors", np.float64, n, dim),
                    tree,
                    k,
                )
                flat = [(q, v, s) for q, found in zip(own.tolist(), best, strict=True) for s, v in found]
                columns = zip(*flat, strict=True) if flat else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return run


def _parts(rows: DataFrame, size: int) -> DataFrame:
    """rows dealt into parts of about so many."""
    count = max(1, -(-rows.count() // size))
    return rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)))


def top_k(rows: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best partners of every row of (vec_id, embedding) that is_query selects."""
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    valid = (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"), is_query.alias("asks"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite)
        .withColumn("dim", F.size("v"))
        .dropDuplicates(["vec_id", "v"])
    )
    valid = stash(valid)
    shards = stash(_parts(valid, SHARD_ROWS).groupBy("part", "dim").applyInArrow(_packed(True), PACKED))
    asked = stash(_parts(valid.where("asks"), BLOCK_QUERIES))
    names = ["n", "ids", "vectors", "kth"]

    def visited(queries: DataFrame, these: DataFrame) -> DataFrame:
        blocks = queries.groupBy("part", "dim").applyInArrow(_packed(False), PACKED)
        blocks = blocks.select(F.col("dim").alias("q_dim"), *(F.col(c).alias(f"q_{c}") for c in names))
        # a stated set of queries against all rows, block by block
        met = blocks.crossJoin(these.drop("kth", "part")).where("q_dim = dim")
        return met.mapInArrow(_visits(k), FOUND)

    start = asked.withColumn("kth", F.lit(float("-inf")))
    found = stash(visited(start, shards.where("part = 0")))
    kth = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("reached"))
    reached = F.col("reached").cast("double")
    lower = F.when(F.abs(reached) < float(1 << 53), reached)
    later = asked.join(kth, F.col("vec_id") == F.col("query_id"), "left").withColumn("kth", F.coalesce(lower, F.lit(float("-inf"))))
    found = found.unionAll(visited(later.drop("query_id", "reached"), shards.where("part != 0")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP5_SQL = """
WITH v AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
"""
