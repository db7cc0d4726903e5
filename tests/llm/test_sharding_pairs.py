from collections import Counter, defaultdict

from smeltery.llm import sharding


def placed(docs_of, rows):
    """Bytes by shard, and how many texts lie on one shard and on several."""
    load, where = Counter(), defaultdict(set)
    text = {r[0]: r[1] for r in rows}
    for r in sharding.shards(docs_of(rows)).collect():
        load[r.shard] += r["size"]
        where[text[r.doc_id]].add(r.shard)
    mean = sum(load.values()) / sharding.SHARDS
    assert len(load) == sharding.SHARDS and max(load.values()) < 1.03 * mean and min(load.values()) > 0.97 * mean
    return Counter(len(s) == 1 for s in where.values())


def test_pairs_alone(docs_of):
    rows = [(i, f"pair {i // 2:05} " * 5) for i in range(12_000)]
    assert placed(docs_of, rows) == {True: 6_000}


def test_groups_alone(docs_of):
    # 480 groups of 25: a group is a twentieth of a share.
    rows = [(i, f"group {i % 480:05} " * 5) for i in range(12_000)]
    assert placed(docs_of, rows) == {True: 480}
