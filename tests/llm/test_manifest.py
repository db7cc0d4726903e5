"""The manifest against a tree built by hand, for several fans, ties, nulls and languages of every size."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from smeltery.llm import manifest as q

FIELDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("pos", T.StringType()), T.StructField("steps", T.StringType()), T.StructField("hash", T.StringType())])


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(i, text, lang, source, n):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def climb(nodes, fan):
    """Root, and of each node the siblings left and right at every level."""
    steps, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // fan * fan
            steps[k].append(("".join(level[run:i]), "".join(level[i + 1:run + fan])))
        level = [h(*level[i:i + fan]) for i in range(0, len(level), fan)]
        at = [i // fan for i in at]
    return level[0], steps


def brute(rows, fan):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    by, tops = {}, []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        leaves = [leaf_of(*r) for r in own]
        top, steps = climb(leaves, fan)
        by[lang] = own, leaves, steps
        tops.append(top)
    root, above = climb(tops, fan)
    out = []
    for lang, top, more in zip(langs, tops, above):
        for r, leaf, steps in zip(*by[lang]):
            path, node = steps + more, leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                node = leaf_of(*r[:4], r[4] + 1)
            for a, b in path:
                node = h(a, node, b)
            out.append((str(r[0]), leaf, top, root, h(*[a + b for a, b in path]), node, node == root))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], FIELDS)


def sample(rng, sizes):
    rows = []
    for lang, n in sizes.items():
        for _ in range(n):
            i = rng.choice([None, *range(8)]) if rng.random() < 0.1 else rng.randrange(10**6)
            rows.append((i, rng.choice([None, "", "é 😀", "x" * 3000, str(rng.random())]), lang, rng.choice([None, "", "s"]), rng.choice([None, 0, 5])))
        rows += rows[-3:] if n > 40 else []   # repeated rows
    return rows


SIZES = {None: 1, "": 2, "de": 3, "en": 300, "fr": 17, "é": 33, "zz": 1}


@pytest.mark.parametrize("fan, levels, sizes", [(2, 10, SIZES), (2, 2, SIZES), (3, 2, SIZES), (5, 1, SIZES), (2, 3, {"en": 8}), (2, 3, {"en": 1}), (3, 2, {None: 82})])
def test_equals_a_tree_by_hand(spark, fan, levels, sizes):
    rows = sample(random.Random(fan * 10 + levels), sizes)
    made = q.manifest(table(spark, rows), fan, levels)
    got = made.select("doc_id", "leaf", "subroot", "root", "bent", "steps").collect()
    want = brute(rows, fan)
    have = []
    for r in got:
        node = r.bent or r.leaf
        for s in r.steps:
            node = h(s.left, node, s.right)
        have.append((str(r.doc_id), r.leaf, r.subroot, r.root, h(*[s.left + s.right for s in r.steps]), node, node == r.root))
    assert sorted(have) == want


def test_proofs_and_empty_table(spark):
    rows = sample(random.Random(1), SIZES)
    assert sorted((str(r[0]), *r[1:]) for r in q.proofs(table(spark, rows)).collect()) == brute(rows, q.FAN)
    assert any(not r.verified for r in q.proofs(table(spark, rows)).collect())
    assert q.proofs(table(spark, [])).count() == 0
