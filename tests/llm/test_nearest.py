from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from smeltery.llm import nearest as q
from smeltery.session import collected


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, query_ids, k):
    good = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for i in query_ids:
        if i in good:
            a = good[i]
            s = [(-float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))), j) for j, b in good.items() if j != i and len(b) == len(a)]
            out[i] = [j for _, j in sorted((round(x, 12), j) for x, j in s)[:k]]
    return out


def test_recall_and_bad_vectors(spark, docs_of):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(600)]
    rows[50] = (50, None, 0)
    rows[51] = (51, [0.0] * 16, 0)
    rows[52] = (52, [float("nan")] + [1.0] * 15, 0)
    rows[100] = (100, [None] + [1.0] * 15, 0)
    rows += [(700 + i, [1.0, 2.0, 3.0], 0) for i in range(3)]                    # another length
    rows += [(1000 + i, rows[150][1], 0) for i in range(300)] + [rows[0], (None, rows[1][1], 0)]  # copies, a repeated row
    got = {}
    for r in q.neighbours_of_sample(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(rows, {i for i, *_ in rows if i is not None and i % 50 == 0}, 5)
    assert set(got) == set(want) and 50 not in got and 100 not in got
    assert got[150] == [1000, 1001, 1002, 1003, 1004] and got[700] == [701, 702]
    hits = sum(len(set(got[i]) & set(v)) for i, v in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9


def test_several_shards(spark, docs_of, monkeypatch):
    monkeypatch.setattr(q, "SHARD_ROWS", 100)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0) for i in range(500)]
    got = {}
    for r in q.neighbours_of_sample(frame(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(rows, range(0, 500, 50), 5)


def test_empty(spark, docs_of):
    assert q.neighbours_of_sample(frame(spark, [])).count() == 0
    assert q.neighbours_of_sample(frame(spark, [(0, [1.0], 0)])).count() == 0


def test_cosines_of_extreme_components():
    small, large = np.array([[1e-200, 0.0]]), np.array([[1e200, 0.0]])
    for a in (small, large, np.array([[1.0, 0.0]])):
        for b in (small, large):
            assert q.exact(a, b[None]).tolist() == [[1.0]]
    x = np.random.default_rng(3).normal(size=(50, 16))
    plain = np.einsum("qd,qkd->qk", x, x[None].repeat(50, 0)) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(x, axis=1)[None])
    assert (q.exact(x, x[None].repeat(50, 0)) == plain).all()


def test_blocks_are_neither_broadcast_nor_copied_for_each_shard(spark, docs_of, monkeypatch):
    monkeypatch.setattr(q, "SHARD_ROWS", 100)
    monkeypatch.setattr(q, "BLOCK", 4)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8 if i % 7 else 3).astype(np.float32).tolist(), 0) for i in range(700)]
    found = q.neighbours_of_sample(frame(spark, rows), step=10)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(rows, range(0, 700, 10), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan


def test_a_few_graphs_make_a_row_group(spark, docs_of, monkeypatch):
    monkeypatch.setattr(q, "SHARD_ROWS", 1000)
    v = F.transform(F.sequence(F.lit(1), F.lit(256)), lambda x: F.hash("vec_id", x) / 7)
    rows = spark.range(5500).select(F.col("id").alias("vec_id"), v.alias("embedding"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with collected() as paths:
            q.neighbours_of_sample(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = [f for p in paths if "/graphs-" in p for f in Path(p.removeprefix("file:")).glob("*.parquet")]
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 6 and max(g.total_byte_size for g in groups) < 8 << 20
