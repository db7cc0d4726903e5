"""Approximate nearest neighbours: a small-world graph for each shard, results merged.

Distinct vectors are dealt to shards of about ``SHARD_ROWS`` by hash; each shard's graph (see
``graph``) is one row of flat arrays. Every block of queries meets every shard: each task reads some
shards and some blocks, so no block is copied for each shard and none goes through the driver. What
a shard finds is scored again in double precision on the vectors as given, and the best over all
shards remain.

Equal vectors are one node with the smallest ids that have it, as many as a query can need, so large
groups of copies neither crowd a graph nor break ties. Vectors that are null, empty, zero or hold a
null or a number that isn't finite take no part. Vectors of different lengths don't meet. A row
repeated with the same id and vector counts once; the same id with another vector is a candidate for
other ids, and a query of its own, of which the best scores remain. Null ids are candidates for nobody.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window

from smeltery.llm.graph import Graph
from smeltery.session import stage

SHARD_ROWS = 8192
BLOCK = 512      # queries searched side by side
PARTS = 64       # of all blocks at most, so that tasks grow with the shards alone
MORE = 16        # nodes a shard scores exactly beyond those asked for
# Writers look at sizes only every hundred rows, and readers take a row group at once; a row here is a whole graph.
SMALL_GROUPS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(4 << 20)}


def sound(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def vectors(df: DataFrame) -> DataFrame:
    v = F.col("embedding").cast("array<double>")
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & sound(F.col("v")))
    # Adding zero makes one number of both zeros.
    return rows.select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v")).distinct()


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """``v`` and the ``k + 1`` smallest ids that have it; each map task sends no more for a vector."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    return rows.select("*", rank.alias("rank")).filter(F.col("rank") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def scaled(x: np.ndarray) -> np.ndarray:
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines in double precision of each query with its own rows of ``x``.

    Both are first divided by a power of two near their largest component: this rounds nothing, and squares
    of very large or small components stay finite and above zero.
    """
    q, x = scaled(q), scaled(x)
    return np.einsum("qd,qkd->qk", q, x) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=2))


def shard_rows(nodes: DataFrame, n_shards: int) -> DataFrame:
    """One row for each shard: ``dim``, ``shard`` and its graph, vectors and ids as flat arrays."""
    at = nodes.select("v", "ids", F.size("v").alias("dim"), F.xxhash64("v").alias("mark"))
    at = at.select("*", F.pmod("mark", F.lit(n_shards)).alias("shard"))

    def run(key, table):
        dim, shard = key[0].as_py(), key[1].as_py()
        table = table.sort_by([("mark", "ascending")]).combine_chunks()
        x = np.asarray(table["v"].combine_chunks().flatten()).reshape(-1, dim)
        marks = np.asarray(table["mark"].combine_chunks()).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        marks ^= marks >> np.uint64(29)
        ids = table["ids"].combine_chunks()
        graph = Graph.build(unit(x), marks)
        pack = lambda a: a.tobytes()
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()),
            "x": pa.array([pack(x.astype("<f8"))], pa.binary()),
            "ids": pa.array([pack(np.asarray(ids.flatten()).astype("<i8"))], pa.binary()),
            "ends": pa.array([pack(np.cumsum(np.asarray(ids.value_lengths()), dtype="<i8"))], pa.binary()),
            "nodes": pa.array([[pack(n) for n in graph.nodes]], pa.list_(pa.binary())),
            "links": pa.array([[pack(n) for n in graph.links]], pa.list_(pa.binary()))})

    return at.groupBy("dim", "shard").applyInArrow(
        run, "dim int, shard bigint, x binary, ids binary, ends binary, nodes array<binary>, links array<binary>")


class Shard:
    def __init__(self, dim: int, x: bytes, ids: bytes, ends: bytes, nodes: list[bytes], links: list[bytes]):
        self.x = np.frombuffer(x, "<f8").reshape(-1, dim)
        self.ids, self.ends = np.frombuffer(ids, "<i8"), np.frombuffer(ends, "<i8")
        on = [np.frombuffer(n, np.int32) for n in nodes]
        self.graph = Graph(unit(self.x), on, [np.frombuffer(a, np.int32).reshape(len(n), -1) for n, a in zip(on, links)])

    def best(self, own: np.ndarray, q: np.ndarray, k: int):
        """Of each query the ``k`` best ids other than its own: query place, id, score."""
        found, _ = self.graph.search(unit(q), min(k + MORE, 64))
        scores = exact(q, self.x[np.maximum(found, 0)])
        query, place = np.nonzero(found >= 0)
        node, score = found[query, place], scores[query, place]
        size = self.ends[node] - np.where(node > 0, self.ends[node - 1], 0)
        query, score = np.repeat(query, size), np.repeat(score, size)
        inner = np.arange(len(query)) - np.repeat(np.cumsum(size) - size, size)
        ids = self.ids[np.repeat(self.ends[node] - size, size) + inner]
        other = ids != own[query]
        query, score, ids = query[other], score[other], ids[other]
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return query[rank < k], ids[rank < k], score[rank < k]


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: of each query the ``k`` nearest found, ties to smaller ids."""
    nodes = stage(distinct_vectors(vectors(candidates), k), "nodes")
    n = nodes.count()
    n_shards = max(1, -(-n // SHARD_ROWS))
    index = stage(shard_rows(nodes, n_shards), "graphs", **SMALL_GROUPS)
    asked = stage(vectors(queries), "queries")
    n_blocks = max(1, -(-asked.count() // BLOCK))
    blocks = (asked.select("vec_id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).alias("block"))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("q")))
    blocks = blocks.select("dim", F.col("q.vec_id").alias("own"), F.flatten("q.v").alias("qs")).repartition(min(n_blocks, PARTS))
    # Each task joins a partition of either side. Left to the sizes of the files, the driver would broadcast all blocks once they compress well.
    met = index.join(blocks.hint("shuffle_replicate_nl"), "dim")

    def run(batches):
        shard, name = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                at = {c: batch.column(i)[row] for i, c in enumerate(batch.schema.names)}
                dim = at["dim"].as_py()
                if name != (dim, at["shard"].as_py()):
                    name = (dim, at["shard"].as_py())
                    shard = Shard(dim, *[at[c].as_py() for c in ("x", "ids", "ends", "nodes", "links")])
                own = np.asarray(at["own"].values)
                query, ids, score = shard.best(own, np.asarray(at["qs"].values).reshape(-1, dim), k)
                yield pa.RecordBatch.from_arrays([pa.array(own[query]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def neighbours_of_sample(embeddings: DataFrame, step: int = 50, k: int = 5) -> DataFrame:
    """The nearest rows of those whose id ``step`` divides, among all rows."""
    return nearest(embeddings, embeddings.filter(F.col("vec_id") % step == 0), k)
