"""The pipeline on a small table against its stages by brute force."""

import hashlib
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")
import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from test_line_dedup import brute  # noqa: E402
from test_quality import counts  # noqa: E402
from test_simhash import brute_components  # noqa: E402


def rows_of(frame):
    return [(r.doc_id, r.text, r.source) for r in frame.collect()]


def test_stages(spark, docs_of, corpus, tmp_path):
    docs_of(corpus).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = dict(corpus_pipeline.STAGES)
    good = rows_of(steps["quality_rules"](spark, docs, str(tmp_path)))
    assert {r[0] for r in good} <= {i for i, t, *_ in corpus if counts(t)[0] >= 20}
    one = docs_of(good)
    lines = rows_of(steps["line_dedup"](spark, one, ""))
    left = brute([(i, t) for i, t, _ in good])
    assert Counter((i, t) for i, t, _ in lines) == Counter((i, left[i, t]) for i, t, _ in good)
    kept = rows_of(steps["simhash"](spark, docs_of(lines), ""))
    assert sorted(i for i, *_ in kept if i is not None) == brute_components(lines)[2]
    mixed = rows_of(steps["mixing"](spark, docs_of(kept), ""))
    assert max(Counter(mixed).values()) <= 3 and set(mixed) <= set(kept)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((i, hashlib.sha256(np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()) for i, t, _ in mixed)
    assert Counter((r.doc_id, r.ids_sha256) for r in steps["bpe"](spark, docs_of(mixed), "").collect()) == want
    assert Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == want
