"""The text queries that SQL can express, beside their twins on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import compare, duck  # noqa: E402
from smeltery.llm.queries import ORACLE, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, name):
    got, want, _ = compare(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE[name])
    assert got == want


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
