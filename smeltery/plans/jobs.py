"""The jobs: ingest, silver refresh, metrics refresh, flag report, and the chain of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery import schemas
from smeltery.operators import dedupe, flags, keys, ledger, quality, rollup
from smeltery.operators import states as merging
from smeltery.operators.clean import losses, to_silver
from smeltery.plans.runlog import recorded
from smeltery.session import ensure_utc, scratch, stage
from smeltery.sinks import states, tables
from smeltery.sinks.report import write_report
from smeltery.sources.batch import read_batch, with_row_numbers
from smeltery.sources.tables import Lake, latest_n

PLACE = ("file_ord", "block_start", "seq")


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class IngestResult:
    run_id: str
    total_records: int
    inserted_records: int
    deduped_records: int
    per_file: dict[str, int]
    rejected_records: int = 0


@dataclass(frozen=True)
class FlagResult:
    run_id: str
    scanned: int
    flagged: int
    path: str
    top: DataFrame


def check_batch(staged: DataFrame) -> dict:
    """Every contract rule in one pass over the staged batch; raises before anything is written.

    A batch that breaks one with a text of its own is read once more for the smallest such text.
    """
    found = keys.contract_summary(staged).first().asDict()
    if found["header_errors"]:
        raise keys.IngestionError(staged.agg(F.min("header_error")).first()[0])
    if found["missing_event_time"]:
        raise keys.IngestionError(
            f"event_time is required ({found['missing_event_time']} rows have none)"
        )
    if found["invalid_event_time"]:
        example = staged.where("unread <> ''").agg(F.min("unread")).first()[0]
        raise keys.IngestionError(
            f"Invalid event_time format: {example!r} "
            f"({found['invalid_event_time']} rows in all)"
        )
    for name, limit in schemas.MAX_LENGTHS.items():
        if found[f"long_{name}"]:
            raise keys.IngestionError(
                f"{name} exceeds {limit} characters in {found[f'long_{name}']} rows"
            )
    return found


def insert_batch(
    spark: SparkSession, lake: Lake, staged: DataFrame, run_id: str, now: datetime
) -> tuple[int, int]:
    """Insert-if-absent of a checked batch; the first row of a key in arrival order wins.

    The new rows are written where readers don't see them and published by one rename to the number after
    the last batch that was looked up. If another batch took it, only that one is looked up as well, so no
    key is stored twice, whoever else writes. Returns the rows inserted and the batch's number.
    """
    months = tables.touched_months(staged)
    last = max(lake.batches(spark), default=0)
    # Equal keys share an event month, so only those months of the table can hold them.
    stored = lake.read_months(spark, "raw_records", months)
    if unproven(spark, lake):
        check_unique(stored)
    # They share their source as well: an ingest brings rows of one, which the scan can tell by file statistics.
    sources = [r[0] for r in staged.select("source").distinct().limit(100).collect()]
    own = stored.where(F.col("source").isin(*sources)) if 0 < len(sources) < 100 else stored
    fresh = dedupe.first_new(staged, own, PLACE)
    batch = tables.PendingBatch.write(
        spark, lake,
        with_row_numbers(fresh, staged).withColumns(
            {
                "id": F.sha2(F.concat_ws("|", "source", "record_hash"), 256),
                "run_id": F.lit(run_id),
                "ingested_at": F.lit(now),
            }
        ),
    )
    try:
        while not batch.publish(last):
            before, last = last, max(lake.batches(spark))
            late = lake.read_months(spark, "raw_records", months, after=before)
            rest = tables.PendingBatch.write(spark, lake, dedupe.new_only(batch.read(), late))
            batch.drop()
            batch = rest
    except Exception:
        batch.drop()
        raise
    return batch.rows, batch.number


def unproven(spark: SparkSession, lake: Lake) -> list[int]:
    """Batches whose keys no run of these jobs has looked up: neither published by an ingest run that
    succeeded, nor covered by a repair."""
    runs = lake.read(spark, "pipeline_runs").where("status = 'succeeded'")
    noted = runs.select(F.col("meta")["batch"].cast("int").alias("n"), F.col("meta")["proven_upto"].cast("int").alias("upto"))
    proven = noted.agg(F.collect_set("n"), F.max("upto")).first()   # a number for each batch
    return [n for n in lake.batches(spark) if n > (proven[1] or 0) and n not in set(proven[0])]


def check_unique(rows: DataFrame) -> None:
    """Fails when a key is stored twice, as when files were copied in; names some of the keys."""
    twice = dedupe.duplicate_keys(rows).orderBy(*dedupe.KEY).limit(5).collect()
    if twice:
        named = ", ".join(f"{r['source']}/{r['record_hash']}" for r in twice)
        raise DuplicateKeyError(f"Keys stored more than once: {named}")


class DuplicateKeyError(RuntimeError):
    """Bronze holds a key twice."""


def repair(spark: SparkSession, lake: Lake) -> int:
    """Deletes all but the first stored row of each key; returns how many rows went.

    Only batches that lose a row are written anew, one after the other. Each key keeps its row throughout,
    so a run that dies is simply repeated. At the end all batches seen are known to hold unique keys.
    """
    ensure_utc(spark)
    with recorded(spark, lake, "repair", "raw_records") as run, scratch(spark):
        numbers = lake.batches(spark)
        rows = lake.read_batches(spark, numbers, with_batch=True)
        place = F.struct("ingested_at", "batch", "row_num", "id")
        copies = rows.groupBy(*dedupe.KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*dedupe.KEY)
        # All columns of the copies alone, the first of equal rows too: each has a number of its own.
        of_copies = stage(rows.join(copies, list(dedupe.KEY), "left_semi").withColumn("_at", F.monotonically_increasing_id()), "copies")
        kept = of_copies.groupBy(*dedupe.KEY).agg(F.min_by("_at", F.struct(place, "_at")).alias("_at")).select("_at")
        losers = of_copies.join(kept, "_at", "left_anti")
        gone = 0
        for row in losers.groupBy("batch").count().orderBy("batch").collect():
            batch = row["batch"]
            own = rows.where(F.col("batch") == batch)
            winners = of_copies.join(kept, "_at", "left_semi").where(F.col("batch") == batch)
            tables.replace_batch(spark, lake, batch, own.join(copies, list(dedupe.KEY), "left_anti").unionByName(winners.drop("_at")))
            run.note("batch", batch=batch, row_count=row["count"])
            gone += row["count"]
        run.meta["proven_upto"] = str(max(numbers, default=0))
        run.counts = gone, 0
    return gone


def ingest_frame(
    spark: SparkSession, lake: Lake, source: str, batch: DataFrame, input_ref: str,
    names: Sequence[str] = (), set_aside: bool = False,
) -> IngestResult:
    """Ingest rows shaped like :func:`smeltery.sources.batch.read_batch`; all or nothing."""
    with recorded(spark, lake, "ingest", input_ref, source=source, files=len(names)) as run:
        with scratch(spark):
            return _ingest(spark, lake, run, source, batch, names, set_aside)


def _ingest(spark, lake, run, source, batch, names, set_aside) -> IngestResult:
    now = utc_now()
    _ingest_run(spark, lake, run, source, names, "started", None, now)
    try:
        with run.timed("parse", files=len(names)):
            keyed = keys.with_event_month(keys.extract_keys(batch.withColumn("source", F.lit(source))))
            # Hashes are as long as all the rest of a row; where one is asked for, it is made again of the keys.
            parsed = keys.with_unread(keys.with_reasons(keyed) if set_aside else keyed).drop("record_hash")
            staged = every = keys.with_hash(stage(parsed, "ingest"))
            rejected = 0
            if set_aside:
                rejected = reject(lake, staged, run.id, now)
                staged = staged.where("size(reasons) = 0").drop("reasons")
            found = check_batch(staged)
            staged = staged.drop("unread")
        total = found["total_records"]
        with run.timed("upsert", row_count=total, rejected=rejected):
            inserted, batch = insert_batch(spark, lake, staged, run.id, now)
            run.meta["batch"] = str(batch)
        per_file = dict.fromkeys(names, 0)
        for row in every.groupBy("file_path").count().collect():
            per_file[row["file_path"]] = row["count"]
        for name, rows in per_file.items():
            run.note("file", file=name, row_count=rows)
    except Exception as error:
        _ingest_run(spark, lake, run, source, names, "failed", str(error), now)
        raise
    _ingest_run(spark, lake, run, source, names, "success", None, now)
    run.counts = total + rejected, inserted
    return IngestResult(run.id, total + rejected, inserted, total - inserted, per_file, rejected)


def reject(lake: Lake, staged: DataFrame, run_id: str, now: datetime) -> int:
    """Sets rows with reasons aside. A file without the required columns still fails the batch, as none of its
    rows can be read."""
    bad = staged.where("size(reasons) > 0")
    headers = bad.agg(F.min(F.when(F.col("header_error").startswith("Missing required columns"), F.col("header_error")))).first()[0]
    if headers:
        raise keys.IngestionError(headers)
    numbered = with_row_numbers(bad, staged)
    return tables.append(lake, "rejected_rows", numbered.withColumns({"run_id": F.lit(run_id), "rejected_at": F.lit(now)}))


def _ingest_run(spark, lake, run, source, names, status, error, now) -> None:
    row = (run.id, now, source, status, "\n".join(names), error)
    tables.append(lake, "ingest_runs", spark.createDataFrame([row], schemas.INGEST_RUNS))


def ingest(
    spark: SparkSession, lake: Lake, source: str, paths: Sequence[str], multi_line: bool | None = None,
    set_aside: bool = False,
) -> IngestResult:
    """Files to bronze. Headers are checked per file before a row is read.

    A row that breaks the contract fails the batch; with ``set_aside`` such rows go to the table
    ``rejected_rows`` with their reasons, and the others are ingested.
    """
    ensure_utc(spark)
    with recorded(spark, lake, "ingest", ",".join(paths), source=source) as run:
        try:
            with run.timed("open", paths=len(paths)):
                batch, files = read_batch(spark, paths, multi_line)
        except Exception as error:
            _ingest_run(spark, lake, run, source, paths, "failed", str(error), utc_now())
            raise
        with scratch(spark):
            return _ingest(spark, lake, run, source, batch, files, set_aside)


def cleaned_upto(spark: SparkSession, lake: Lake) -> tuple[int, int | None, int | None]:
    """The last batch that silver holds, and the version and rows silver had after that, from the ledger."""
    runs = ledger.current(lake.read(spark, "pipeline_runs")).where("pipeline = 'clean' AND status = 'succeeded'")
    marks = runs.select(F.col("meta")["batches_upto"].cast("int").alias("upto"), F.col("meta")["version"].cast("int").alias("version"), "records_out")
    found = marks.agg(F.max("upto"), F.max_by(F.struct("version", "records_out"), "version")).first()
    last = found[1]
    return found[0] or 0, last and last["version"], last and last["records_out"]


def refresh_clean(
    spark: SparkSession, lake: Lake, limit: int | None = None, everything: bool = False
) -> int:
    """Bronze rows cleaned and upserted into silver; returns the silver row count.

    By default the batches published since the last refresh: their numbers are given in order, so the ledger
    keeps the highest one as a mark, and neither other batches nor untouched parts of silver are read. A run
    that dies before its mark is written is repeated whole; the upsert then changes nothing. ``limit`` takes
    that many of the newest bronze rows instead and sets no mark, ``everything`` takes all rows, as after a
    change of the cleaning rules.
    """
    ensure_utc(spark)
    name = "clean", "raw_records"
    with recorded(spark, lake, *name, limit=limit, everything=everything) as run, scratch(spark):
        numbers = lake.batches(spark)
        mark, version, rows = cleaned_upto(spark, lake)
        with run.timed("fetch_raw_records", limit=limit):
            if limit is not None:
                bronze = latest_n(lake.read(spark, "raw_records"), limit)
            else:
                bronze = lake.read_batches(spark, [n for n in numbers if everything or n > mark])
            found = bronze.agg(F.count(F.lit(1)).alias("scanned"), *losses(bronze)).first().asDict()
            scanned = found.pop("scanned")
            # Batches never change, so rows are cleaned as they are written, not staged before.
            cleaned = to_silver(bronze, F.col("run_id"), F.lit(utc_now()))
            run.note("losses", **found)
            if found["amounts_lost"]:
                tables.append(lake, "data_quality_checks", quality.count_check(
                    spark, "amounts_lost", "clean_records", found["amounts_lost"], utc_now()))
        with run.timed("upsert_clean_records", record_count=scanned):
            before = max(lake.versions(spark, "clean_records"), default=0)
            now, added = tables.upsert_by_part(
                spark, lake, "clean_records", cleaned, dedupe.KEY, keep=("id",), unique=not unproven(spark, lake)
            )
            # The count after the last run still holds if no other version came in between.
            known = before == 0 or rows is not None and version == before
            known = known and now <= before + 1
            total = (rows if before else 0) + added if known else lake.read(spark, "clean_records").count()
        run.meta["version"] = str(now)
        if limit is None:
            run.meta["batches_upto"] = str(max(numbers, default=mark))
        run.counts = scanned, total
    return total


def refresh_metrics(
    spark: SparkSession, lake: Lake, start: date | None = None, check: bool = True, recount: bool = False
) -> DataFrame:
    """Gold: monthly metrics of silver, daily and monthly metrics of bronze, the checks.

    Only bronze batches and silver parts that are new since the last refresh are read; for the others their
    stored states stand. ``recount`` counts all rows instead, as does bronze by itself while some batch isn't
    known to hold unique keys. The tables are upserted by date, so with ``start`` only the days and months from
    there on are computed. Returns the stored monthly table.
    """
    ensure_utc(spark)
    month = start and start.replace(day=1)
    with recorded(spark, lake, "metrics", "clean_records,raw_records", start=start, recount=recount) as run, scratch(spark):
        with run.timed("monthly_metrics"):
            if recount:
                monthly = rollup.monthly_metrics(lake.read(spark, "clean_records"), month, two_scans=True)
            else:
                monthly = merging.metrics(_states(spark, lake, run, "clean_records", month), "month_start", "hashes")
            tables.upsert_small(spark, lake, "monthly_metrics", monthly, ("month_start",))
        with run.timed("gold_tables"):
            # Batches of the ingest job hold unique keys, which need no recount.
            unique = not unproven(spark, lake)
            if recount or not unique:
                bronze = lake.read(spark, "raw_records")
                daily = rollup.daily_metrics(bronze, start, unique_keys=unique)
                by_month = rollup.monthly_metrics_raw(bronze, month, unique_keys=unique)
            else:
                held = _states(spark, lake, run, "raw_records", month)
                daily = merging.metrics(held if start is None else held.where(F.col("day") >= F.lit(start)), "day_date", "records")
                by_month = merging.metrics(held, "month_start", "records")
            tables.upsert_small(spark, lake, "daily_metrics", daily, ("day_date",))
            tables.upsert_small(spark, lake, "monthly_metrics_raw", by_month, ("month_start",))
        if check:
            with run.timed("control_totals"):
                check_totals(spark, lake, month)
    return lake.read(spark, "monthly_metrics")


def _states(spark, lake, run, table, month) -> DataFrame:
    held, read = states.refresh(spark, lake, table)
    run.note("states", table=table, parts_read=read)
    return held if month is None else held.where(F.col("event_month") >= F.lit(month))


def check_totals(spark: SparkSession, lake: Lake, month: date | None = None) -> None:
    """Logs per month: stored gold of silver against silver, silver's gold against bronze."""
    stored = rollup.monthly_slice(lake.read(spark, "monthly_metrics"), month)
    now = utc_now()
    for scope, name in (("monthly_metrics", "clean_records"), ("clean_records", "raw_records")):
        rows = rollup.within(lake.read(spark, name), month, None, "month")
        totals = quality.control_totals(stored, rows)
        tables.append(lake, "data_quality_checks", quality.quality_checks(totals, now, scope))


def flag_report(
    spark: SparkSession, lake: Lake, out: str, limit: int | None = None,
    now: datetime | None = None, single_file: bool = False,
) -> FlagResult:
    """Bronze rows (the newest ``limit``, if one is named) through the rules into a sorted CSV report."""
    ensure_utc(spark)
    with recorded(spark, lake, "flags", "raw_records", limit=limit) as run:
        with run.timed("fetch_raw_records", limit=limit):
            records = latest_n(flags.of_report(lake.read(spark, "raw_records")), limit)
            if limit is not None:
                records = stage(records, "latest")
            scanned = records.count()
        # Where bronze keys are known to be unique, no fingerprint can repeat in these rows.
        with run.timed("flag_records", record_count=scanned):
            unique = not unproven(spark, lake)
            found = flags.flag(records, now or utc_now(), unique_keys=unique)
            # Digests are most of a row: those that follow from other columns are made again of the sorted ranges.
            small = stage(tables._packed(found), "flagged")
            flagged = tables._unpacked(small, found)
            count = small.count()
        with run.timed("write_flag_report_csv", flagged_count=count, output_path=out):
            parts = flags.report_parts(small, tables.packed_id(found), lambda rows: tables._unpacked(rows, found))
            write_report(flags.report(flagged) if single_file else parts, out, single_file)
        run.counts = scanned, count
    return FlagResult(run.id, scanned, count, out, flags.top(flagged))


def refresh(spark: SparkSession, lake: Lake, limit: int | None = None) -> DataFrame:
    """Silver, then gold."""
    refresh_clean(spark, lake, limit)
    return refresh_metrics(spark, lake)


def run_all(
    spark: SparkSession, lake: Lake, source: str, paths: Sequence[str], out: str,
    limit: int | None = None, now: datetime | None = None,
) -> dict:
    """Ingest and flags in one application, summed up from the ledger."""
    ensure_utc(spark)
    with recorded(spark, lake, "demo", ",".join(paths), source=source) as run:
        try:
            with run.timed("ingest_samples"):
                ingest(spark, lake, source, paths)
            with run.timed("flags"):
                flag_report(spark, lake, out, limit, now)
        finally:
            runs = ledger.current(lake.read(spark, "pipeline_runs"))
            done = ledger.run_rollup(runs, run.opened).first().asDict()
            run.counts = done["records_in"], done["records_out"]
    return {"run_id": run.id, "status": "succeeded", **done}
