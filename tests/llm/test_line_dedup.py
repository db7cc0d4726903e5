import hashlib
import random
import re

from conftest_text import prose
from smeltery.llm import line_dedup as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def brute(rows):
    """Lines left of each (doc_id, text); ids in order, null last."""
    from pyspark.sql import SparkSession, functions as F

    spark = SparkSession.getActiveSession()
    texts = sorted({t for _, t in rows if t is not None})
    mark = {}
    if texts:
        frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t"), F.xxhash64(F.lit(7), "t"))
        mark = {t: (a, b) for t, a, b in frame.collect()}
    seen, out = [], {}
    for i, t in sorted({(i, t) for i, t in rows}, key=lambda r: (r[0] is None, r[0] or 0, mark.get(r[1], (0, 0)))):
        if t is None:
            out[i, t] = ""
            continue
        left = []
        for line in t.split("\n"):
            w = WORD.findall(line)
            if not w:
                left.append(line)
                continue
            if line in {s for s, _ in seen}:
                continue
            near = len(w) >= q.MIN_WORDS and any(len(v) >= q.MIN_WORDS and abs(len(v) - len(w)) <= 1 and edit(v, w) <= 1 for _, v in seen)
            seen.append((line, w))
            if not near:
                left.append(line)
        out[i, t] = "\n".join(left)
    return out


def check(docs_of, rows):
    want = sorted(hashlib.sha256(brute([(r[0], r[1]) for r in rows])[r[0], r[1]].encode()).hexdigest() for r in rows)
    got = sorted(r.text_sha256 for r in q.line_counts(docs_of(rows)).collect())
    assert got == want


def test_corpus(docs_of, corpus):
    check(docs_of, corpus)


def test_random_edits(docs_of):
    rng = random.Random(2)
    base = [prose(rng, rng.randint(7, 14)).split() for _ in range(12)]
    rows = []
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            k, kind = rng.randrange(len(w)), rng.randrange(3)
            w[k:k + (kind != 0)] = [] if kind == 1 else ["new" + str(rng.randint(0, 3))]
        rows.append((rng.randint(0, 90), "  ".join(w) + rng.choice(["", "\n\n" + " ".join(rng.choice(base))])))
    check(docs_of, rows)


def test_chain_of_edits(docs_of):
    # Each line is one edit from the last; all but the first go, as each has an earlier line beside it.
    w = "one two three four five six seven eight nine".split()
    rows = [(0, " ".join(w))]
    for i in range(5):
        w[i] += "x"
        rows.append((i + 1, " ".join(w)))
    got = {r.doc_id: r.n_kept for r in q.line_counts(docs_of(rows)).collect()}
    assert got == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0}


def test_stage(docs_of, corpus):
    docs = docs_of(corpus)
    made = q.without_repeated_lines(docs)
    assert made.columns == docs.columns and made.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in made.collect() if r.text is not None)
    assert q.without_repeated_lines(docs_of([])).count() == 0
