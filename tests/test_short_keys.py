"""The upsert's rows go through shuffles with the bytes of their hash, and the batch is staged without it."""

from smeltery.operators.merge import upsert
from smeltery.plans import standin

SF = "/root/testdata/sf0.001"


def test_rows_to_be_merged_carry_no_hexadecimal_hash(spark, monkeypatch):
    real, staged = standin.stage, {}
    monkeypatch.setattr(standin, "stage", lambda df, label: staged.setdefault(label, df.columns) and real(df, label))
    batch = standin.staged_batch(spark, SF)
    assert "record_hash" not in staged["batch"] and "record_hash" in batch.columns
    stored, incoming = standin.first_silver(batch, "first", (1, 2)), standin.first_silver(batch, "second")
    merged = upsert(stored, incoming, standin.BYTE_KEY, keep=("id",))
    plan = merged._jdf.queryExecution().executedPlan().toString().split("\n")
    exchanges = [x for x in plan if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and all("_key" in x and "record_hash" not in x for x in exchanges)
    plain = standin.silver_of(standin.first_rows(batch), "second")
    assert sorted(map(str, incoming.drop("_key").collect())) == sorted(map(str, plain.collect()))
