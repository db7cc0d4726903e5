"""Jobs over small files: contract, replay, row numbers, silver, gold, flags and the ledger."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from smeltery.operators.keys import IngestionError
from smeltery.operators import ledger
from smeltery.plans import jobs
from smeltery.sinks import tables

HEADER = "source_id,event_time,value,category"
# Fixed value: the row whose content hash is a known vector.
KNOWN_ROW = "a1,2026-01-05T06:00:00Z,10,alpha"


def sample_lines():
    """The known row and nine meter readings."""
    meters = [f"meter-{k},2026-01-{5 + k % 2:02d}T{8 + k:02d}:15:00+01:00,{k * k}.5,{'indoor' if k < 7 else 'Outdoor'}" for k in range(1, 10)]
    return [HEADER, KNOWN_ROW, *meters]


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture
def sample(tmp_path):
    return write(tmp_path / "sample.csv", sample_lines())


def test_sample_ingest_replay_and_gold(spark, lake, sample, tmp_path):
    first = jobs.ingest(spark, lake, "samples", [sample])
    assert (first.total_records, first.inserted_records, first.deduped_records) == (10, 10, 0)
    assert list(first.per_file.values()) == [10]
    again = jobs.ingest(spark, lake, "samples", [sample])
    assert (again.total_records, again.inserted_records, again.deduped_records) == (10, 0, 10)
    raw = lake.read(spark, "raw_records")
    assert raw.count() == 10
    assert {r.run_id for r in raw.collect()} == {first.run_id}
    assert sorted(r.row_num for r in raw.collect()) == list(range(1, 11))
    a1 = raw.where("source_id = 'a1'").first()
    assert a1.record_hash == "62f903ed73fc101e055aa9a03835071a9797359756314e5a757d837983969b07"
    assert a1.payload["value"] == "10"
    assert lake.read(spark, "ingest_runs").where("status = 'success'").count() == 2

    assert jobs.refresh_clean(spark, lake) == 10
    ids = {r.record_hash: r.id for r in lake.read(spark, "clean_records").collect()}
    assert jobs.refresh_clean(spark, lake) == 10
    assert ids == {r.record_hash: r.id for r in lake.read(spark, "clean_records").collect()}

    monthly = [tuple(r) for r in jobs.refresh_metrics(spark, lake).collect()]
    assert monthly == [(date(2026, 1, 1), 10, 10, 10, 1, 3)]
    daily = sorted(tuple(r) for r in lake.read(spark, "daily_metrics").collect())
    assert daily == [(date(2026, 1, 5), 5, 5, 5, 1, 3), (date(2026, 1, 6), 5, 5, 5, 1, 2)]
    checks = lake.read(spark, "data_quality_checks").collect()
    assert [(c.status, c.expected, c.observed) for c in checks] == [("pass", 10, 10)] * 2
    jobs.refresh_metrics(spark, lake, start=date(2026, 2, 1))
    assert sorted(tuple(r) for r in lake.read(spark, "daily_metrics").collect()) == daily

    now = datetime(2026, 3, 1, tzinfo=timezone.utc)
    done = jobs.flag_report(spark, lake, str(tmp_path / "out" / "report"), now=now)
    assert (done.scanned, done.flagged) == (10, 10)
    text = spark.read.csv(done.path, header=True)
    assert text.columns[-3:] == ["severity", "flag_codes", "flag_messages"]
    assert {r.flag_codes for r in text.collect()} == {"STALE_EVENT_TIME"}
    assert text.first().event_time.endswith("+00:00")

    runs = ledger.current(lake.read(spark, "pipeline_runs")).orderBy("started_at").collect()
    assert [r.pipeline for r in runs] == [
        "ingest", "ingest", "clean", "clean", "metrics", "metrics", "flags"]
    assert all(r.status == "succeeded" and r.steps and r.error_summary is None for r in runs)
    assert (runs[0].records_in, runs[0].records_out) == (10, 10)
    assert (runs[1].records_in, runs[1].records_out) == (10, 0)


def test_chain_sums_its_stages(spark, lake, sample, tmp_path):
    done = jobs.run_all(spark, lake, "samples", [sample], str(tmp_path / "r"))
    assert (done["records_in"], done["records_out"]) == (20, 20)
    assert done["status"] == "succeeded"


def test_chain_failure_is_recorded(spark, lake, tmp_path):
    bad = write(tmp_path / "bad.csv", ["source_id,event_time,value", "a,2026-01-01,1"])
    with pytest.raises(IngestionError):
        jobs.run_all(spark, lake, "samples", [bad], str(tmp_path / "r"))
    runs = {r.pipeline: r for r in ledger.current(lake.read(spark, "pipeline_runs")).collect()}
    assert runs["demo"].status == runs["ingest"].status == "failed"
    assert "Missing required columns" in runs["demo"].error_summary
    assert runs["demo"].finished_at is not None
    assert (runs["demo"].records_in, runs["demo"].records_out) == (0, 0)


@pytest.mark.parametrize(
    "name, lines, message",
    [
        ("m.csv", ["source_id,event_time,value", "a,2026-01-01,1"],
         r"Missing required columns: \['category'\]"),
        ("e.csv", [], r"Missing required columns"),
        ("x.txt", [HEADER], "Unsupported file type"),
        ("X.TXT", [HEADER], "Unsupported file type: .*X.TXT"),
        ("t.csv", [HEADER, "a,,1,c"], "event_time is required"),
        ("u.csv", [HEADER, "a,yesterday,1,c"], "Invalid event_time format: .yesterday."),
        ("l.csv", [HEADER, f"{'a' * 101},2026-01-01,1,c"], "source_id exceeds 100"),
    ],
)
def test_contract_breaks_write_nothing(spark, lake, sample, tmp_path, name, lines, message):
    path = tmp_path / name
    path.write_text("\n".join(lines), encoding="utf-8")
    with pytest.raises(IngestionError, match=message):
        jobs.ingest(spark, lake, "samples", [sample, str(path)])
    assert lake.read(spark, "raw_records").count() == 0
    assert lake.read(spark, "ingest_runs").where("status = 'failed'").count() == 1


def test_header_only_file_is_an_empty_success(spark, lake, tmp_path):
    done = jobs.ingest(spark, lake, "s", [write(tmp_path / "h.csv", [HEADER])])
    assert (done.total_records, done.inserted_records) == (0, 0)
    assert list(done.per_file.values()) == [0]
    assert lake.read(spark, "raw_records").count() == 0
    assert jobs.refresh_clean(spark, lake) == 0


def test_first_file_wins_and_sources_stay_apart(spark, lake, tmp_path):
    one = write(tmp_path / "b one.csv", [HEADER + ",note", "a,2026-01-05T08:00:00+02:00, 10 ,Alpha,x"])
    two = write(tmp_path / "a.csv", [
        "category,value,event_time,source_id", " ALPHA ,10,2026-01-05T06:00:00Z,a",
        '"be,ta","line\nbreak",2026-01-06,"say ""hi"""'])
    done = jobs.ingest(spark, lake, "s1", [one, two])
    assert (done.total_records, done.inserted_records) == (3, 2)
    rows = {r.source_id: r for r in lake.read(spark, "raw_records").collect()}
    assert rows["a"].payload["note"] == "x" and rows["a"].payload["value"] == " 10 "
    assert rows['say "hi"'].value == "line\nbreak" and rows['say "hi"'].category == "be,ta"
    assert rows['say "hi"'].row_num == 2
    other = jobs.ingest(spark, lake, "s2", [one])
    assert other.inserted_records == 1
    assert lake.read(spark, "raw_records").where("source_id = 'a'").count() == 2


def test_row_numbers_over_many_splits(spark, lake, tmp_path):
    rows = [f"id{i},2026-01-{1 + i % 28:02d}T00:00:00Z,{i},c" for i in range(5000)]
    path = write(tmp_path / "big.csv", [HEADER] + rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        jobs.ingest(spark, lake, "s", [path], multi_line=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    raw = lake.read(spark, "raw_records")
    assert raw.count() == 5000
    assert raw.where(F.col("row_num") != F.col("value").cast("int") + 1).count() == 0


def test_upsert_touches_only_its_months(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", [HEADER, "a,2026-01-01,1,N/A"])])
    jobs.refresh_clean(spark, lake)
    before = lake.read(spark, "clean_records").first()
    assert before.category == "n/a" and before.value_text == "1"
    jobs.ingest(spark, lake, "s", [write(tmp_path / "2.csv", [HEADER, "b,2026-02-01,$2.5,X"])])
    jobs.refresh_clean(spark, lake, limit=1)
    rows = {r.source_id: r for r in lake.read(spark, "clean_records").collect()}
    assert rows["a"].id == before.id and rows["a"].cleaned_at == before.cleaned_at
    assert rows["b"].category == "X" and str(rows["b"].value_decimal) == "2.5000"


def test_lookup_reads_only_the_batch_months(spark, lake, tmp_path):
    lines = [HEADER] + [f"a,2026-{m:02d}-03,1,c" for m in range(1, 7)]
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", lines)])
    some = lake.read_months(spark, "raw_records", [date(2026, 2, 1), date(2026, 9, 1)])
    assert len(some.inputFiles()) == 1 and some.first().event_month == date(2026, 2, 1)
    assert lake.read_months(spark, "raw_records", [date(2030, 1, 1)]).isEmpty()


def test_stream_sees_each_file_once(spark, lake, tmp_path):
    from smeltery.streaming.discovery import ingest_stream

    folder = tmp_path / "drop"
    folder.mkdir()
    write(folder / "1.csv", sample_lines())
    checkpoint = str(tmp_path / "ck")
    ingest_stream(spark, lake, "s", str(folder), checkpoint).awaitTermination()
    assert lake.read(spark, "raw_records").count() == 10
    write(folder / "2.csv", ["value,note,category,source_id,event_time", "1,x,c,z,2026-01-09", "10,y,alpha,a1,2026-01-05T06:00:00Z"])
    ingest_stream(spark, lake, "s", str(folder), checkpoint).awaitTermination()
    assert lake.read(spark, "raw_records").count() == 11
    runs = ledger.current(lake.read(spark, "pipeline_runs")).orderBy("started_at").collect()
    assert [(r.records_in, r.records_out) for r in runs] == [(10, 10), (2, 1)]


def test_short_rows_break_the_contract(spark, lake, tmp_path):
    path = write(tmp_path / "s.csv", ["source_id,category,value,event_time", "a,c,1"])
    with pytest.raises(IngestionError, match="event_time is required"):
        jobs.ingest(spark, lake, "s", [path])


def test_command_line(spark, lake, sample, tmp_path, capsys):
    from smeltery.__main__ import main

    main(["--lake", lake.root, "ingest", "--source", "cli", sample])
    main(["--lake", lake.root, "clean"])
    main(["--lake", lake.root, "runs"])
    shown = capsys.readouterr().out
    assert "inserted_records=10" in shown and "Silver rows: 10" in shown
    assert "ingest" in shown and "succeeded" in shown


def test_headers_by_position(spark, lake, tmp_path):
    from smeltery.sources.batch import read_batch

    trailing = write(tmp_path / "trailing.csv", [HEADER + ",", "a,2026-01-01,1,c,x"])
    repeated = write(tmp_path / "glob[1].csv", [HEADER + ",note,note", "b,2026-01-02,2,c,first,last"])
    twins = write(tmp_path / "twins.csv", ["value,Value,source_id,event_time,category", "3,no,d,2026-01-03,c"])
    done = jobs.ingest(spark, lake, "s", [trailing, repeated, twins])
    assert done.inserted_records == 3
    rows = {r.source_id: r for r in lake.read(spark, "raw_records").collect()}
    assert rows["a"].payload[""] == "x" and rows["b"].payload["note"] == "last"
    assert (rows["d"].value, rows["d"].payload["Value"]) == ("3", "no")
    folder = tmp_path / "v1.2"
    folder.mkdir()
    write(folder / "in.csv", [HEADER, "e,2026-01-04,4,c"])
    assert read_batch(spark, [str(folder)])[0].count() == 1
    write(folder / "notes.txt", ["x"])
    with pytest.raises(IngestionError, match="Unsupported file type: .*notes.txt"):
        read_batch(spark, [str(folder)])


def test_broken_bytes_and_extra_cells_are_refused(spark, lake, tmp_path):
    latin = tmp_path / "latin.csv"
    latin.write_bytes(f"{HEADER}\na,2026-01-01,1,café\n".encode("latin-1"))
    with pytest.raises(IngestionError, match="latin.csv is not UTF-8"):
        jobs.ingest(spark, lake, "s", [str(latin)])
    wide = write(tmp_path / "wide.csv", [HEADER, "a,2026-01-01,1,c", "b,2026-01-01,1,c,more"])
    with pytest.raises(IngestionError, match="more cells than the header: more"):
        jobs.ingest(spark, lake, "s", [wide])
    assert lake.read(spark, "raw_records").count() == 0


def test_silver_takes_every_row(spark, lake, tmp_path):
    rows = [f"id{i},2026-01-{1 + i % 28:02d}T00:00:00Z,{i},c" for i in range(12000)]
    jobs.ingest(spark, lake, "s", [write(tmp_path / "big.csv", [HEADER] + rows)])
    assert jobs.refresh_clean(spark, lake) == 12000
    monthly = jobs.refresh_metrics(spark, lake).collect()
    assert [r.total_records for r in monthly] == [12000]


def test_keys_stored_twice_are_found(spark, lake, tmp_path):
    path = write(tmp_path / "1.csv", [HEADER] + [f"k{i},2026-01-01,{i},c" for i in range(20)])
    jobs.ingest(spark, lake, "s", [path])
    tables.append(lake, "raw_records", lake.read(spark, "raw_records"))   # past the job that looks keys up
    assert lake.read(spark, "raw_records").count() == 40
    assert jobs.refresh_clean(spark, lake) == 20
    assert jobs.refresh_clean(spark, lake) == 20
    more = write(tmp_path / "2.csv", [HEADER, "new,2026-01-02,1,c"])
    with pytest.raises(jobs.DuplicateKeyError, match="stored more than once: s/"):
        jobs.ingest(spark, lake, "s", [more])
    assert lake.read(spark, "raw_records").count() == 40 and lake.batches(spark) == [1, 2]
    jobs.refresh_metrics(spark, lake)
    daily = lake.read(spark, "daily_metrics").first()
    assert (daily.total_records, daily.distinct_records) == (40, 20)
    assert jobs.repair(spark, lake) == 20
    assert lake.read(spark, "raw_records").count() == 20 and jobs.unproven(spark, lake) == []
    assert jobs.repair(spark, lake) == 0
    assert jobs.ingest(spark, lake, "s", [more]).inserted_records == 1
    assert lake.read(spark, "raw_records").count() == 21


def test_lost_silver_rows_fail_the_checks(spark, lake, tmp_path):
    jobs.ingest(spark, lake, "s", [write(tmp_path / "1.csv", [HEADER] + [f"k{i},2026-01-01,{i},c" for i in range(9)])])
    jobs.refresh_clean(spark, lake, limit=5)
    jobs.refresh_metrics(spark, lake)
    checks = {c.check_scope: c for c in lake.read(spark, "data_quality_checks").collect()}
    assert checks["monthly_metrics"].status == "pass"
    assert (checks["clean_records"].status, checks["clean_records"].expected, checks["clean_records"].observed) == ("fail", 9, 5)


def test_ledger_keeps_starts_and_files(spark, lake, sample):
    jobs.ingest(spark, lake, "s", [sample])
    rows = lake.read(spark, "pipeline_runs")
    assert sorted(r.status for r in rows.collect()) == ["running", "succeeded"]
    end = ledger.current(rows).first()
    assert end.meta["source"] == "s" and any(s.step == "file" and s.meta["row_count"] == "10" for s in end.steps)
    assert sorted(r.status for r in lake.read(spark, "ingest_runs").collect()) == ["started", "success"]
