import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_text import prose  # noqa: E402

FIELDS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.IntegerType()),
    # Names that the operators use inside.
    T.StructField("fp", T.StringType()), T.StructField("_doc", T.IntegerType()), T.StructField("size", T.StringType()),
    T.StructField("pos", T.LongType()), T.StructField("kept", T.StringType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    from smeltery.llm.common import reach_package

    reach_package(spark)

    def make(rows):
        """``rows``: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, None, 2, "k") for r in rows]
        return spark.createDataFrame(full, FIELDS)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, blanks, ties, copies, near copies, equal ids and a long text."""
    rng = random.Random(5)
    rows = [(i, "\n".join(prose(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 4))), f"s{i % 3}") for i in range(40)]
    rows += [(100, None, "s0"), (101, "", "s1"), (102, " \t\n ", None), (None, "alone without id " * 9, None), (103, "é ß 日本 " * 30, "s2")]
    rows += [(200 + i, rows[3][1], "s0") for i in range(25)]                     # copies
    rows += [(300 + i, rows[4][1].replace("the", f"the{i}", 1), "s1") for i in range(5)]
    rows += [(7, rows[9][1], "s1"), (8, rows[8][1], "s2"), (8, rows[8][1], "s2")]  # equal ids
    rows += [(400, prose(rng, 9000), "s2"), (401, "# $ % & | < > * " * 40, "s0"), (402, "SHOUT OUT LOUD NOW " * 20, "s0")]
    return rows
