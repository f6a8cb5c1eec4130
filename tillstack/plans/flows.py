"""Daily run, backfill and recovery flows (FLW1-3).

Plain functions in the reference's order.  Each step's output is written to
the shared folder and read back, so later steps start from storage (lineage
is cut at every table, and a lost executor costs at most the current step).
Cleaning a backfill is one Spark job over all its files: every file-order
rule is scoped by ``source_file``, so this equals running day by day.

Every run has an id, and lake zones, archive and audit results are folders of
that run: nothing that an earlier run wrote is replaced, and a run without new
files writes nothing.  Each flow can be repeated after a stop at any step.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tillstack import schemas as S
from tillstack.functions.dates import report_date
from tillstack.operators import checks as C
from tillstack.operators import upsert as U
from tillstack.operators.audit import unmapped_rows
from tillstack.operators.clean import COPIES, clean_report
from tillstack.operators.dims import Dims
from tillstack.operators.fact import LINE, build_fact, fact_increment, high_water_mark
from tillstack.operators.quarantine import bad_mask, good_rows, quarantine_reason
from tillstack.functions.dates import local_today
from tillstack import fixed_values as FV
from tillstack.sources import reports as RP
from tillstack.sources import sinks as K
from tillstack.sources.seeds import Vocabulary, bounded_broadcast, local_table

LEDGER = StructType([StructField("source_file", StringType()), StructField("run_date", DateType()),
                     StructField("rows", LongType()), StructField("archived_to", StringType())])
GOOD, BAD = "good", "quarantine"
LATE_FLAG, LATE_STRICT = "flag", "strict"
#: Up to so many order ids are named in the filter on the fact's history.
FEW_ORDERS = 500
#: A day of so many rows, or fewer, is written by one task.
PART_ROWS = 100_000
#: A task that sorts or merges lines has about so many, whatever the size of the batch.
TASK_ROWS = 100_000
#: A batch of so many days a task, or more, is placed by day before it is parsed.
DAYS_A_TASK = 4


def new_run(label: str) -> str:
    return f"{label}-{uuid.uuid4().hex[:12]}"


@dataclass(frozen=True)
class Paths:
    """Folder layout under one base path on shared storage."""

    base: str
    incoming_dir: str | None = None  # delivered reports, if kept elsewhere

    @property
    def incoming(self) -> str:
        return self.incoming_dir or f"{self.base}/incoming"

    def zone(self, name: str, run: str) -> str:
        return f"{self.base}/lake/{name}/run={run}"

    def archive(self, name: str, run: str) -> str:
        return f"{self.base}/archive/{name}/run={run}"

    def audit(self, name: str, run: str) -> str:
        return f"{self.base}/audit/{name}/run={run}"

    def table(self, name: str, schema, partition_by=(), bloom=()) -> K.Table:
        return K.Table(f"{self.base}/tables/{name}", schema, tuple(partition_by), tuple(bloom))

    @property
    def staging(self) -> K.Table:
        return self.table("staging_fact_sales", S.STAGING_FLAGGED, ["sale_date"], ["order_id"])

    @property
    def quarantine(self) -> K.Table:
        return self.table("fact_sales_quarantine", S.QUARANTINE, ["sale_date"])

    @property
    def fact(self) -> K.Table:
        return self.table("fact_sales", S.FACT_LINES, ["sale_date"], ["order_id"])

    @property
    def dims(self) -> dict[str, K.Table]:
        return {name: self.table(f"dim_{name}", schema) for name, schema in S.DIMENSIONS.items()}

    @property
    def unmapped(self) -> K.Table:
        return self.table("unmapped_rows", S.UNMAPPED)

    @property
    def ledger(self) -> K.Table:
        return self.table("processed_files", LEDGER)


def unprocessed(spark: SparkSession, paths: Paths, files: list[str]) -> list[str]:
    """SNK7 ledger: the files that no run has finished; the others are not read again."""
    if not files or not paths.ledger.exists(spark):
        return files
    asked = spark.createDataFrame([(f,) for f in files], "source_file string")
    left = asked.join(paths.ledger.read(spark).select("source_file"), "source_file", "left_anti")
    return sorted(r.source_file for r in left.collect())  # names of the list itself


def day_spans(df: DataFrame, col: str = "payment_time") -> list:
    """What times the rows have, a row a day: the day partition, the first and last
    value, how many are null, and the number of rows."""
    return df.groupBy(K.day_of(col).alias("d")).agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
                                                    F.count_if(F.col(col).isNull()).alias("nulls"), F.count(F.lit(1)).alias("n")).collect()


def _in_spans(per: list, col: str = "payment_time"):
    """Which rows can have one of these times: a condition on the day partitions (a
    value a day; times that do not parse, and null ones, are all in the null
    partition) and one on the value itself, in its own order, that is pushed into
    the scan."""
    known = [r for r in per if r.lo is not None]
    values = F.col(col).between(F.lit(min(r.lo for r in known)), F.lit(max(r.hi for r in known))) if known else F.lit(False)
    return K.in_days([r.d for r in per]) & (values | F.col(col).isNull() if any(r.nulls for r in per) else values)


def touched_days(df: DataFrame) -> list:
    """The day partitions of some rows: a value a day."""
    return [r.d for r in df.select(K.day_of().alias("d")).distinct().collect()]


def merge_candidates(target: DataFrame, batch: DataFrame, col: str = "payment_time") -> DataFrame:
    """The target rows a batch can collide with: merge keys include
    ``payment_time``, so only rows of the batch's day partitions can match."""
    return target.filter(_in_spans(day_spans(batch, col), col))


def tasks_of(spark: SparkSession, rows: dict) -> int:
    """How many tasks share the lines of ``rows``, lines a day: the session's number, or
    as many as a large batch needs for its tasks to sort their lines in memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(rows.values()) // TASK_ROWS))


def day_cuts(spark: SparkSession, rows: dict) -> list:
    """The days of ``rows``, lines a day, that have far more than others, with the
    number of tasks that share each."""
    most = max(PART_ROWS, -(-sum(rows.values()) // tasks_of(spark, rows)))
    return [(d, -(-r // most)) for d, r in rows.items() if r > most]


def with_part(spark: SparkSession, df: DataFrame, cut: list, day: str, keys) -> DataFrame:
    """``df`` with ``_part``: which of its day's tasks a row goes to, by a hash of ``keys``."""
    parts = bounded_broadcast(local_table(spark, cut, "_cut_day date, _parts int"), len(cut))
    part = F.coalesce(F.pmod(F.xxhash64(*keys), F.col("_parts")), F.lit(0))
    return df.join(parts, F.col(day).eqNullSafe(F.col("_cut_day")), "left").withColumn("_part", part).drop("_cut_day", "_parts")


def report_placing(spark: SparkSession, rows: dict):
    """How a backfill puts report rows before they are parsed, ``rows`` lines a day: by
    their day, as its merges will need their lines, a large day by a hash of order and
    time in several tasks.  Copies of a line, in whatever file, have one place.  None if
    there are too few days to keep the tasks busy: the merges place the lines then."""
    n, cut = tasks_of(spark, rows), day_cuts(spark, rows)
    if len(rows) + sum(p - 1 for _, p in cut) < DAYS_A_TASK * int(spark.conf.get("spark.sql.shuffle.partitions")):
        return None

    def place(df: DataFrame) -> tuple[DataFrame, list]:
        df = df.withColumn("_day", K.day_of())
        if not cut:
            return df.repartition(n, "_day"), ["_day"]
        return with_part(spark, df, cut, "_day", ["order_id", "payment_time"]).repartition(n, "_day", "_part"), ["_day", "_part"]

    return place


def day_placing(spark: SparkSession, rows: dict):
    """How a merge puts rows where they are written, ``rows`` a day: a day's rows in one
    task, those of a day with far more than others in several, by a hash of the merge
    keys.  The merge's aggregate needs no other shuffle then, as rows of a key have one
    place, and neither does the write."""
    n, cut = tasks_of(spark, rows), day_cuts(spark, rows)

    def place(df: DataFrame) -> tuple[DataFrame, list]:
        df = df.withColumn("sale_date", K.day_of())
        if not cut:
            return df.repartition(n, "sale_date"), ["sale_date"]
        return with_part(spark, df, cut, "sale_date", FV.MERGE_KEYS).repartition(n, "sale_date", "_part"), ["sale_date", "_part"]

    return place


def line_placing(spark: SparkSession, rows: dict):
    """``day_placing`` for rows that have their day and are told apart by their line
    (``mark_rows``)."""
    n, cut = tasks_of(spark, rows), day_cuts(spark, rows)

    def place(df: DataFrame) -> tuple[DataFrame, list]:
        if not cut:
            return df.repartition(n, "sale_date"), ["sale_date"]
        return with_part(spark, df, cut, "sale_date", LINE).repartition(n, "sale_date", "_part"), ["sale_date", "_part"]

    return place


def rows_a_day(df: DataFrame) -> dict:
    """The number of a table's rows a day partition; the files' ends alone are read."""
    return {r.sale_date: r.n for r in df.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n")).collect()}


def merge(spark: SparkSession, table: K.Table, batch: DataFrame, reprocessed: bool | Column | None = False, spans: list | None = None, by=()) -> int:
    """UPS1/UPS2 on a day-partitioned table: append what is not there; again, nothing.
    The table is read only if it holds days of the batch.  ``spans``: the batch's ``day_spans``.
    ``by``: columns by which the batch lies in tasks already (``report_placing``); if the
    table holds none of its days, no row is shuffled."""
    spans = day_spans(batch) if spans is None else spans
    rows, candidates = {r.d: r.n for r in spans}, table.nothing(spark)
    if table.days(spark) & set(rows):
        candidates = table.read(spark).filter(_in_spans(spans))
        for r in candidates.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n")).collect():  # a row a day
            rows[r.sale_date] = rows.get(r.sale_date, 0) + r.n
    elif by:
        return table.append(spark, U.merge_insert(candidates, batch, reprocessed=reprocessed, place=lambda df: (df, list(by))), placed=True)
    batch = batch.drop(*by)
    return table.append(spark, U.merge_insert(candidates, batch, reprocessed=reprocessed, place=day_placing(spark, rows)), placed=True)


def late_flag(spark: SparkSession, paths: Paths, late: str) -> bool | Column:
    """Whether a new staging line comes too late for the increment: it has no time, or
    one that is not after the fact's mark.  A time that does not parse is no such line."""
    if late not in (LATE_FLAG, LATE_STRICT):
        raise ValueError(f"late is {LATE_FLAG!r} or {LATE_STRICT!r}")
    at = high_water_mark(paths.fact.read(spark)) if late == LATE_FLAG and paths.fact.exists(spark) else None
    if at is None:
        return False
    time = F.col("payment_time").try_cast("timestamp_ntz")
    return F.coalesce(time <= F.lit(at[0]).cast("timestamp_ntz"), F.col("payment_time").isNull())


def gate(spark: SparkSession, paths: Paths, run: str, stage: str, tables: list, enforce: bool) -> DataFrame:
    """CHK10/CHK8: evaluate the suites once, keep their results, stop on an error."""
    path = paths.audit(f"results/{stage}", run)
    run_checks = C.run_grain_checks if stage == "staging" else C.run_checks  # a merge leaves a row for each key
    reduce(DataFrame.unionByName, [run_checks(df, name, checks) for name, df, checks in tables]).write.mode("overwrite").parquet(path)
    results = spark.read.parquet(path)
    if enforce:
        C.enforce(results)
    return results


def ingest(spark: SparkSession, paths: Paths, files: list[str], run: str, vocab: Vocabulary | None = None,
           now_utc: _dt.datetime | None = None, enforce: bool = True, fmt: str = "csv", multiline: bool = False,
           drop_last_row: bool = True, keep_unparsed: bool = False, late: str = LATE_FLAG) -> dict:
    """Clean → land → load → merge ×2 → staging/quarantine checks → archive +
    ledger, for the files that are not in the ledger.  Returns the step counts
    (AGG2/SNK14) and the names of unreadable files, which stay out of the ledger.

    ``late``: what happens to new lines whose time is not after the fact's mark, which
    the incremental load would pass over.  ``LATE_FLAG`` flags them for it as recovered
    lines are; ``LATE_STRICT`` leaves them in staging alone, as the rule reads (Q7)."""
    files = unprocessed(spark, paths, files)
    counts = {"files": 0, "unreadable": [], "bad_records": {}, "loaded": 0, "exploded": 0, "duplicates": 0, "good": 0, "quarantined": 0,
              "staged": 0, "quarantine_added": 0, "archived": 0}
    if not files:
        return counts
    # SNK7: the delivery is read once, into the archive; all that follows comes from there
    landed = paths.archive("raw", run)
    scan = RP.land_files(spark, files, landed, fmt, multiline)
    counts |= {"files": len(scan.rows), "unreadable": scan.unreadable, "loaded": sum(scan.rows.values())}
    if not scan.rows:
        return counts
    raw = RP.landed_report(spark, landed, scan)
    place, tasks, counts["bad_records"] = survey(spark, raw)
    tables = []  # clustered zones, dropped when the run has read them
    try:
        return _ingest_landed(spark, paths, run, raw, place, tasks, scan, counts, tables, vocab, now_utc, enforce, drop_last_row, keep_unparsed, late)
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def survey(spark: SparkSession, raw: DataFrame) -> tuple:
    """One pass over the report rows, which gives a row for a file and day: how to place them by
    day (``report_placing``) in how many tasks, and how many records do not fit their header, a file."""
    keyed = {"order_id", "payment_time", "products"} <= set(raw.columns)
    day = K.day_of() if keyed else F.lit(None).cast("date")
    items = F.coalesce(F.length("products") - F.length(F.replace("products", F.lit(","), F.lit(""))), F.lit(0)) + 1 if keyed else F.lit(1)
    found = raw.groupBy("source_file", day.alias("d")).agg(F.count_if(F.col(RP.CORRUPT).isNotNull()).alias("misfits"), F.sum(items).alias("n")).collect()
    rows, misfits = {}, {}
    for r in found:
        rows[r.d] = rows.get(r.d, 0) + r.n
        if r.misfits:
            misfits[r.source_file] = misfits.get(r.source_file, 0) + r.misfits
    return report_placing(spark, rows) if keyed else None, tasks_of(spark, rows), misfits


def _ingest_landed(spark: SparkSession, paths: Paths, run: str, raw: DataFrame, place, tasks: int, scan: RP.Scan, counts: dict, tables: list,
                   vocab: Vocabulary | None, now_utc: _dt.datetime | None, enforce: bool, drop_last_row: bool, keep_unparsed: bool, late: str) -> dict:
    """``ingest`` after the landing; ``place``, ``tasks``: see ``survey``."""
    by: list = []

    def placed(df: DataFrame) -> tuple[DataFrame, list]:
        df, names = place(df)
        by.extend(names)
        return df, names

    def hold(first: DataFrame) -> DataFrame:  # lines are parsed once
        zone = paths.zone("parsed", run)
        metrics = {"lines": F.count(F.lit(1)), "exploded": F.sum(COPIES)}
        if by:
            held, name, seen = K.write_clustered(first, zone, by, metrics, tasks)
            tables.append(name)
        else:
            seen = K.write_observed(first, zone, "overwrite", (), metrics)
            held = spark.read.schema(first.schema).parquet(zone)
        counts.update(exploded=seen["exploded"], duplicates=seen["exploded"] - seen["lines"])
        return held

    lines = clean_report(raw, spark, vocab, drop_last_row, keep_unparsed=keep_unparsed, hold=hold, place=placed if place else None, tasks=tasks)
    bad = bad_mask(lines)
    placing = [lines.schema[c] for c in by]
    schema = StructType([*S.QUARANTINE.fields, *placing, StructField("half", StringType())])
    halves = S.conform(lines.withColumns({
        "quarantine_reason": F.when(bad, quarantine_reason()),
        "quarantine_timestamp": F.when(bad, local_today(FV.QUARANTINE_TIMEZONE, now_utc)),
        "half": F.when(bad, BAD).otherwise(GOOD)}), schema)
    # SNK1-3: both halves in one write, in folders of this run
    zone = paths.zone("lines", run)
    metrics = {"good": F.count_if(F.col("half") == GOOD), "quarantined": F.count_if(F.col("half") == BAD)}
    # SNK4/SNK5: fixed-schema loads read back from the lake zone
    if by:
        load, name, seen = K.write_clustered(halves, zone, by, metrics, tasks, ("half",), folders=2)
        tables.append(name)
    else:
        seen = K.write_observed(halves, zone, "overwrite", ("half",), metrics, folders=2)
        load = spark.read.schema(schema).parquet(zone)
    counts.update(seen)
    good, quarantined = (load.filter(F.col("half") == h) for h in (GOOD, BAD))
    temp_good, temp_bad = (S.conform(df, StructType([*s.fields, *placing])) for df, s in ((good, S.STAGING), (quarantined, S.QUARANTINE)))
    good_days, bad_days = day_spans(temp_good), day_spans(temp_bad)
    counts["staged"] = merge(spark, paths.staging, temp_good, late_flag(spark, paths, late), good_days, by)
    counts["quarantine_added"] = merge(spark, paths.quarantine, temp_bad, None, bad_days, by)
    # the checks' keys hold a day, so the batch's days are all that a batch can have broken
    gate(spark, paths, run, "staging", [
        ("staging_fact_sales", paths.staging.read(spark).filter(_in_spans(good_days)), C.STAGING_CHECKS),
        ("fact_sales_quarantine", paths.quarantine.read(spark).filter(_in_spans(bad_days)), C.QUARANTINE_CHECKS),
    ], enforce)
    counts["archived"] = archive(spark, paths, run, paths.archive("raw", run), load.drop(*by), scan, counts)
    return counts


def archive(spark: SparkSession, paths: Paths, run: str, landed: str, halves: DataFrame, scan: RP.Scan, counts: dict) -> int:
    """SNK7: both halves into the run's archive, beside the delivered rows, then the
    ledger: the files count as processed."""
    if K.write_parquet(halves, paths.archive("lines", run), "overwrite", ("half",), folders=2) != counts["good"] + counts["quarantined"]:
        raise RuntimeError("archive of the cleaned lines is incomplete")
    rows = [(f, _day_of(f), n, landed) for f, n in sorted(scan.rows.items())]
    paths.ledger.append(spark, spark.createDataFrame(rows, LEDGER))
    return sum(scan.rows.values())


def _day_of(file: str) -> _dt.date | None:
    at = file.rfind(RP.REPORT_FILE_PREFIX)
    text = file[at + len(RP.REPORT_FILE_PREFIX):][:10]
    try:
        return _dt.date.fromisoformat(text) if at >= 0 else None
    except ValueError:
        return None


def archived_rows(spark: SparkSession, paths: Paths) -> DataFrame:
    """The archived delivered rows of every file in the ledger, each from the run that finished it."""
    runs = [r.archived_to for r in paths.ledger.read(spark).select("archived_to").distinct().collect()]
    parts = [RP.landed_report(spark, to, RP.landed_scan(spark, to)).withColumn("archived_to", F.lit(to)) for to in sorted(runs)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.join(paths.ledger.read(spark).select("source_file", "archived_to"), ["source_file", "archived_to"], "left_semi")


def history(existing: DataFrame, new: DataFrame, rows: int) -> DataFrame:
    """The fact's rows of the ``rows`` new rows' orders, whatever their day.

    Few order ids go into the scan's filter, where the files' Bloom filters skip row
    groups; a known small number is broadcast, more are joined by their size."""
    ids = new.select("order_id").distinct()
    if rows <= FEW_ORDERS:
        return existing.filter(F.col("order_id").isin([r.order_id for r in ids.collect()]))
    return existing.join(bounded_broadcast(ids, rows), "order_id", "left_semi")


def build_models(spark: SparkSession, paths: Paths, vocab: Vocabulary | None = None, enforce: bool = True,
                 run: str | None = None) -> dict:
    """Incremental fact + unmapped audit.  The new fact rows wait in a lake zone until
    their checks have passed (CHK8), the grain among the rows that the fact already
    holds of their orders, and become a batch of the table then; failing rows are stored
    (CHK7) before a failed check stops the run.  Then the flags of lines that have
    reached the fact are cleared."""
    run = run or new_run("models")
    dims = Dims.stored(spark, paths.dims, vocab)
    staging = paths.staging.read(spark)
    existing = paths.fact.read(spark) if paths.fact.exists(spark) else None
    new = (build_fact(staging, dims) if existing is None
           else fact_increment(staging, dims, existing, paths.fact.days(spark), lambda rows: line_placing(spark, rows)))
    # written once, as the table will hold it: the rows come from staging's day files or are placed, a day's in few tasks
    zone = paths.zone("fact", run)
    K.remove(spark, zone)  # of a stopped run of this name
    counts = {"fact_appended": paths.fact.write_aside(spark, S.conform(new, S.FACT_LINES), zone, placed=True)}
    new = spark.read.schema(S.FACT_LINES).parquet(zone).select(*S.FACT_LINES.names)
    C.store_failures(new.select(*S.FACT.names), "fact_sales", C.FACT_CHECKS, paths.audit("failures", run))
    tables = [("fact_sales", new, C.FACT_CHECKS)]
    if existing is not None:
        grain = [c for c in C.FACT_CHECKS if c.kind == "unique_combination"]
        lines = new.unionByName(S.conform(history(existing, new, counts["fact_appended"]), S.FACT_LINES))
        tables = [("fact_sales", lines, grain), ("fact_sales", new, [c for c in C.FACT_CHECKS if c not in grain])]
    results = gate(spark, paths, run, "fact", tables, enforce)
    counts["failed_checks"] = results.filter(~F.col("passed")).count()
    if counts["fact_appended"]:
        paths.fact.publish(spark, zone)
    audited = paths.unmapped.read(spark) if paths.unmapped.exists(spark) else None
    counts["unmapped_appended"] = paths.unmapped.append(spark, unmapped_rows(staging, dims, audited))
    reset(spark, paths)
    return counts


def run_day(spark: SparkSession, paths: Paths, ds, vocab: Vocabulary | None = None,
            now_utc: _dt.datetime | None = None, enforce: bool = True, fmt: str = "csv", run: str | None = None, **options) -> dict:
    """FLW1: the report for ``ds − 1`` through every step; no file ⇒ no-op."""
    day = report_date(ds)
    files = RP.day_files(spark, paths.incoming, day, day)
    if not files:
        return {"report_date": day.isoformat(), "skipped": True}
    run = run or new_run(day.isoformat())
    counts = ingest(spark, paths, files, run, vocab, now_utc, enforce, fmt, **options)
    counts.update(build_models(spark, paths, vocab, enforce, run))
    counts["report_date"] = day.isoformat()
    return counts


def run_range(spark: SparkSession, paths: Paths, first_ds, last_ds, vocab: Vocabulary | None = None,
              now_utc: _dt.datetime | None = None, enforce: bool = True, fmt: str = "csv", run: str | None = None,
              **options) -> dict:
    """FLW2: backfill every report from ``first_ds − 1`` to ``last_ds − 1``
    in one job over the files of those day folders."""
    first, last = report_date(first_ds), report_date(last_ds)
    run = run or new_run(f"{first.isoformat()}_{last.isoformat()}")
    counts = ingest(spark, paths, RP.day_files(spark, paths.incoming, first, last), run, vocab, now_utc, enforce, fmt, **options)
    counts.update(build_models(spark, paths, vocab, enforce, run))
    return counts


def reset(spark: SparkSession, paths: Paths) -> int:
    """REC3 on the tables: only the days that hold flagged lines are written again."""
    staging = paths.staging.read(spark)
    found = staging.groupBy("sale_date").agg(F.count_if(F.col("is_reprocessed")).alias("flagged"), F.count(F.lit(1)).alias("n"))
    rows = {r.sale_date: r.n for r in found.filter(F.col("flagged") > 0).collect()}
    if not rows:
        return 0
    here = K.in_days(rows)
    cleared = U.reset_flag(staging.filter(here), paths.fact.read(spark).filter(here), line_placing(spark, rows))
    return paths.staging.replace_days(spark, cleared, rows, placed=True)


def recover_quarantine(spark: SparkSession, paths: Paths, edited: DataFrame, vocab: Vocabulary | None = None,
                       enforce: bool = False) -> dict:
    """FLW3: edited quarantine rows → staging (flagged) → quarantine without
    them → fact picks them up → flags reset.  What leaves quarantine is decided by
    what staging holds, and the fact skips lines that it has, so the flow can be
    run again after a stop at any step.  Only the edited rows' days are rewritten."""
    run = new_run("recovery")
    passing = S.conform(good_rows(edited), S.STAGING)
    zone = paths.zone("reprocessed", run)
    K.write_parquet(passing, zone)
    passing = spark.read.schema(S.STAGING).parquet(zone)
    spans = day_spans(passing)
    counts = {"loaded": merge(spark, paths.staging, passing, True, spans)}
    days = [r.d for r in spans]
    staged, held = (t.read(spark).filter(K.in_days(days)) for t in (paths.staging, paths.quarantine))
    rows = rows_a_day(staged.select("sale_date").unionAll(held.select("sale_date")))
    left = U.delete_fixed(held, staged.filter(_in_spans(spans)), fixed=passing, place=day_placing(spark, rows))
    paths.quarantine.replace_days(spark, left, days, placed=True)
    counts.update(build_models(spark, paths, vocab, enforce, run))
    return counts


def recover_failed(spark: SparkSession, paths: Paths, check: C.Check, column: str, value, vocab: Vocabulary | None = None,
                   enforce: bool = False) -> dict:
    """REC4/REC5 as a flow: repair and flag the staging lines that fail ``check``, take
    the failing fact lines out, re-feed, reset.  Only their days are rewritten.
    Repeatable: staging is repaired before the fact forgets which lines failed."""
    run = new_run("repair")
    zone = paths.zone("failing", run)
    counts = {"failing": K.write_parquet(C.failing_rows(paths.fact.read(spark), check).select(*S.FACT_LINES.names), zone)}
    if counts["failing"]:
        failures = spark.read.schema(S.FACT_LINES).parquet(zone).withColumn("sale_date", K.day_of())
        days = touched_days(failures)
        staging, fact = (t.read(spark).filter(K.in_days(days)) for t in (paths.staging, paths.fact))
        place = line_placing(spark, rows_a_day(staging))  # the fact has no more lines
        paths.staging.replace_days(spark, U.recover(staging, failures, column, value, place), days, placed=True)
        paths.fact.replace_days(spark, U.remove_failed(fact, failures, place), days, placed=True)
    counts.update(build_models(spark, paths, vocab, enforce, run))
    return counts
