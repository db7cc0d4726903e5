"""The classifier: features and counts by hand, the machine's optimum, held-out accuracy, odd tables."""

import random
import zlib

import numpy as np
import pytest

from conftest_text import prose
from smeltery.llm import classifier as q
from smeltery.llm import grams

LABELS = "doc_id long, quality int, toxic int, text string"


def features(text):
    return next(iter(grams.Indicators().of([text])))


def noisy(rng, text):
    kind = rng.randrange(4)
    words = text.split()
    return [" ".join(w + rng.choice(["###", "&&&", "$$$"]) for w in words), " ".join(w.upper() + "!!" for w in words),
            " | ".join(words), " ".join([words[0]] * len(words))][kind]


def made(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = prose(rng, rng.randint(8, 120))
        docs.append((i, text if good else noisy(rng, text)))
        if i % 3:
            labels.append((i, int(good), 0, "x"))
    return docs, labels


def part(i):
    return zlib.crc32(str(i).encode()) % 5


def test_features_do_not_depend_on_neighbours():
    rng = random.Random(2)
    texts = ["", " ", "a", "a a a a a a", "é 日本\n\n", prose(rng, 5), prose(rng, 80_000), "x" * 600_000] + [prose(rng, rng.randint(0, 50)) for _ in range(300)]
    alone = [features(t).tolist() for t in texts]
    assert [f.tolist() for f in grams.Indicators().of(texts)] == alone
    assert all(f == sorted(set(f)) and f for f in alone)
    assert alone[3] != alone[2] and set(features("b b b b b")) & set(features("c c c c c"))


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(1)
    rows = [(int(rng.random() < 0.5), np.sort(rng.choice(40, 12, replace=False)).astype(np.uint32)) for _ in range(200)]
    ratio = rng.normal(size=40)
    weight, bias, dual = q.descend(rows, ratio, 0.5, 400, 1e-6)
    x = np.zeros((200, 41))
    for k, (_, f) in enumerate(rows):
        x[k, f] = ratio[f] / np.linalg.norm(ratio[f])
    x[:, 40] = 1
    y = np.array([2 * r[0] - 1 for r in rows])
    w = np.append(weight, bias)
    assert np.allclose(w, (dual * y) @ x) and dual.min() >= 0 and dual.max() <= 0.5
    primal = 0.5 * w @ w + 0.5 * np.maximum(0, 1 - y * (x @ w)).sum()
    assert abs(primal - (dual.sum() - 0.5 * w @ w)) < 1e-4 * primal


def test_counts_and_held_out_rows(spark, docs_of):
    docs, labels = made(400, 5)
    rows = q.labelled(docs_of(docs), spark.createDataFrame(labels, LABELS))
    n = q.counts(rows.where("part > 1"))
    want = np.zeros_like(n)
    text = dict(docs)
    for i, y, *_ in labels:
        if part(i) > 1:
            want[y, features(text[i])] += 1
            want[y, -1] += 1
    assert (n == want).all()
    # Labels of held-out documents change nothing.
    other = [(i, y if part(i) else 1 - y, t, s) for i, y, t, s in labels]
    a, b = (q.fitted(docs_of(docs), spark.createDataFrame(x, LABELS)) for x in (labels, other))
    assert (a.scaled == b.scaled).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


def test_held_out_accuracy(spark, docs_of):
    docs, labels = made(3000, 7)
    marks = spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in q.quality_scores(docs_of(docs), marks).collect()}
    again = {r.doc_id: r for r in q.quality_scores(docs_of(docs).repartition(5), marks.repartition(3)).collect()}
    assert got == again and len(got) == 3000
    held = [(y, got[i]) for i, y, *_ in labels if part(i) == 0]
    assert all(r.held_out for _, r in held) and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([r.predicted == y for y, r in held]) > 0.97
    good, bad = ([r.score for y, r in held if y == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99


def test_many_labels_give_the_same_model(spark, docs_of, monkeypatch):
    docs, labels = made(300, 5)
    models = []
    for bound in (10**6, 10):
        monkeypatch.setattr(q, "BROADCAST_ROWS", bound)
        models.append(q.fitted(docs_of(docs), spark.createDataFrame(labels, LABELS)))
    assert (models[0].scaled == models[1].scaled).all() and models[0].slope == models[1].slope


def test_odd_tables(spark, docs_of, corpus):
    docs, labels = made(300, 9)
    odd = docs + [(i and i + 10_000, t) for i, t, *_ in corpus if i is None or i >= 100] + [(5000, "z " * 400_000), (5000, "")]
    marks = labels + [(None, 1, 0, "x"), (1, None, 0, "x"), (2, 7, 0, "x"), (4, 0, 0, "x"), (4, 1, 0, "x"), (10**6, 1, 0, "x"), (5, labels[0][1], 0, "x")]
    got = q.quality_scores(docs_of(odd), spark.createDataFrame(marks, LABELS)).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    by_text = {}
    for i, t in odd:
        by_text.setdefault(t or "", set())
    ids = {i: t or "" for i, t in odd if i is not None and i != 5000}
    for r in got:
        if r.doc_id in ids:
            by_text[ids[r.doc_id]].add(r.score)
    assert all(len(s) <= 1 for s in by_text.values())   # the score sees the text alone
    for some in ([], [(i, 1, 0, "x") for i in range(50)]):
        r = q.quality_scores(docs_of(docs[:20]), spark.createDataFrame(some, LABELS)).collect()
        assert len({x.score for x in r}) == 1
    assert q.quality_scores(docs_of([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_calibration():
    rng = np.random.default_rng(0)
    m = rng.normal(size=20_000)
    y = (rng.random(20_000) < q.sigmoid(2 * m - 0.5)).astype(int)
    slope, shift = q.calibrated(m, y)
    assert slope == pytest.approx(2, abs=0.15) and shift == pytest.approx(-0.5, abs=0.1)
