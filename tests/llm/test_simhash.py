import random
import re

import numpy as np
import xxhash

from conftest_text import prose
from smeltery.llm import simhash as q


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = np.array([brute_print(r[1]) for r in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    label = np.arange(len(rows))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(rows))])
        if (new == label).all():
            break
        label = new
    least = {}
    for r, c in zip(rows, label):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return fps, [least.get(c) for c in label], sorted(v for v in least.values())


def check(docs_of, rows):
    fps, roots, _ = brute_components(rows)
    want = sorted(((r[0] is None, r[0]), f"{f:016x}", str(c)) for r, f, c in zip(rows, fps.tolist(), roots))
    got = sorted(((r.doc_id is None, r.doc_id), r.fingerprint, str(r.component_id)) for r in q.near_duplicates(docs_of(rows)).collect())
    assert [x[1:] for x in got] == [x[1:] for x in want] and [x[0] for x in got] == [x[0] for x in want]


def test_corpus(docs_of, corpus):
    check(docs_of, corpus)


def test_near_copies(docs_of):
    rng = random.Random(4)
    base = [prose(rng, 400, [f"w{k}" for k in range(300)]) for _ in range(6)]
    rows = []
    for i in range(120):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 9)}"
        rows.append((1000 - i, " ".join(w)))
    check(docs_of, rows)
    assert len(set(brute_components(rows)[1])) < 60


def test_chunks_of_a_tile_meet_each_other_once(spark, monkeypatch):
    # Small chunks: every tile has several, and each pair of chunks in reach is one row.
    monkeypatch.setattr(q, "CHUNK", 4)
    test_tiles_lose_no_pair(spark)
    frame = spark.createDataFrame([(x,) for x in range(64)], "fp bigint")
    placed = q.placed_in_tiles(frame)
    parts = q.chunks_of(placed)
    packed = q.tiles(placed, parts)
    sizes = [(r.tile, r.chunk) for r in packed.collect()]
    assert len(sizes) > 7
    got = [(r.tile, r.chunk, r.to, r.part) for r in q.towards(packed, parts, q.steps()).collect()]
    chunks = {r.tile: r.parts for r in parts.collect()}
    want = [(t, c, t + m, p) for t, c in sizes for m in q.steps() for p in range(chunks.get(t + m, 0))]
    assert sorted(got) == sorted(want)


def test_tiles_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 30).astype(np.uint64)
    fps = set()
    for s in seeds:
        for _ in range(12):
            x = s
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= np.uint64(1) << np.uint64(b)
            fps.add(int(x.view(np.int64)))
    frame = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    from smeltery.llm.components import components

    got = {r.node: r.root for r in components(q.links(frame)).collect()}
    a = np.array(sorted(fps), np.int64)
    near = np.bitwise_count(a.view(np.uint64)[:, None] ^ a.view(np.uint64)[None, :]) <= 3
    label = np.arange(len(a))
    for _ in range(40):
        label = np.array([label[near[i]].min() for i in range(len(a))])
    assert [got.get(int(x), int(x)) for x in a] == [int(a[k]) for k in label]


def test_dense_pairs_stay_connected():
    a = np.arange(64, dtype=np.uint64)
    x, y = q.near_pairs(a, a, 3)
    parent = {int(v): int(v) for v in a}
    for u, v in zip(x.tolist(), y.tolist()):
        u, v = (next_root(parent, k) for k in (u, v))
        parent[u] = v
    assert len({next_root(parent, int(v)) for v in a}) == 1 and len(x) <= 4 * len(a)


def next_root(parent, k):
    while parent[k] != k:
        k = parent[k]
    return k


def test_one_stays(docs_of, corpus):
    docs = docs_of(corpus)
    kept = q.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == brute_components(corpus)[2]
    assert q.near_duplicates(docs_of([])).count() == 0 and q.one_of_each(docs_of([])).count() == 0
