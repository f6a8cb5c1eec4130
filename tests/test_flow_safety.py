"""Nothing is lost or doubled when files are damaged, runs are repeated or stopped."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from tillstack import schemas as S
from tillstack.operators import checks as C
from tillstack.operators import upsert as U
from tillstack.operators.dims import Dims
from tillstack.operators.fact import build_fact, fact_increment
from tillstack.plans import flows as P
from tillstack.session import run_dir
from tillstack.sources import reports as RP
from tillstack.sources import sinks as K
from tillstack.sources.fixture import daily_report

HEADER = "Order ID,Products,Product Amount,Received Amount,Payment Time,Cash,GCash,Type/Channel"
NOW = dt.datetime(2026, 4, 1)


def _row(order, day, item="Mocha (Hot) x2", kind="Dine-in"):
    return f'{order},"{item}","1,250.00","1,300.00",{day} 09:15:00,100.00,-,{kind}'


def _deliver(paths, day, lines, header=HEADER, name="report.csv", zipped=None):
    folder = f"{paths.incoming}/report_date={day}".removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    body = "\n".join([header, *lines, "," * header.count(",")]) + "\n"
    if zipped:
        with open(f"{folder}/{name}.gz", "wb") as f:
            f.write(gzip.compress(body.encode())[:zipped])
    else:
        with open(f"{folder}/{name}", "w") as f:
            f.write(body)


@pytest.fixture()
def paths(spark):
    return P.Paths(run_dir(spark, "safety"))


def _next(day):
    return dt.date.fromisoformat(day) + dt.timedelta(days=1)


def test_clean_day_passes_the_gate_and_repeats(spark, paths):
    day = "2026-03-21"
    _deliver(paths, day, [_row(1, day), _row(2, day, "Americano (Cold) x1", "Takeaway"), _row(3, day, "Espresso Shot")])
    out = P.run_day(spark, paths, _next(day), now_utc=NOW)
    # the footer line is an item-less row: the last item line goes, as the rule says
    n = paths.fact.read(spark).count()
    assert out["fact_appended"] == n > 0 and out["archived"] == 4 and out["failed_checks"] == 0
    again = P.run_day(spark, paths, _next(day), now_utc=NOW)
    assert again["files"] == 0 and again["fact_appended"] == 0
    assert paths.fact.read(spark).count() == n and P.archived_rows(spark, paths).count() == 4


def test_damaged_file_is_named_and_left_out_whole(spark, paths):
    day = "2026-03-21"
    lines = [_row(i, day) for i in range(1, 3000)]
    _deliver(paths, day, lines, name="bad.csv", zipped=2000)
    _deliver(paths, day, [_row(9001, day), _row(9002, day)], name="good.csv")
    out = P.run_day(spark, paths, _next(day), now_utc=NOW, enforce=False)
    assert out["files"] == 1 and [os.path.basename(f) for f in out["unreadable"]] == ["bad.csv.gz"]
    assert paths.ledger.read(spark).count() == 1
    assert {r.order_id for r in paths.staging.read(spark).collect()} <= {"9001", "9002"}


def test_columns_go_by_name_in_each_file(spark, paths):
    names = HEADER.split(",")
    _deliver(paths, "2026-03-21", [_row(1, "2026-03-21")])
    values = dict(zip(names, ["2", "Espresso Shot", "10", "10", "2026-03-22 10:00:00", "10", "-", "Dine-in"]))
    turned = [n for n in names[::-1] if n != "GCash"]
    _deliver(paths, "2026-03-22", [",".join(values[n] for n in turned)], header=",".join(turned))
    rows = {r.order_id: r for r in RP.read_report(spark, paths.incoming).filter("order_id IS NOT NULL").collect()}
    assert rows["2"].products == "Espresso Shot" and rows["2"].gcash is None and rows["1"].gcash == "-"


def test_backfill_opens_only_its_days(spark, paths):
    for day in ("2026-03-20", "2026-03-21", "2026-03-22"):
        _deliver(paths, day, [_row(1, day)])
    files = RP.day_files(spark, paths.incoming, dt.date(2026, 3, 21), dt.date(2026, 3, 22))
    assert [f.split("report_date=")[1][:10] for f in files] == ["2026-03-21", "2026-03-22"]


def _ledger_row(spark, name):
    return spark.createDataFrame([(name, dt.date(2026, 3, 21), 1, "a")], P.LEDGER)


def test_a_stopped_write_shows_nothing(spark, paths, monkeypatch):
    paths.ledger.append(spark, _ledger_row(spark, "f"))
    whole = K._write_counted

    def stops(*args):
        whole(*args)
        raise RuntimeError("stopped after the files were written, before they were published")

    monkeypatch.setattr(K, "_write_counted", stops)
    for write in (paths.ledger.append, paths.ledger.replace):
        with pytest.raises(RuntimeError):
            write(spark, _ledger_row(spark, "g"))
        assert [r.source_file for r in paths.ledger.read(spark).collect()] == ["f"]
    monkeypatch.undo()
    paths.ledger.replace(spark, paths.ledger.read(spark).union(_ledger_row(spark, "h")))
    assert sorted(r.source_file for r in paths.ledger.read(spark).collect()) == ["f", "h"]


def test_day_repairs_leave_other_days_files(spark, paths, run):
    table = paths.staging
    table.append(spark, U.with_flag(run.staging.filter("payment_time < '1996'")))
    table.append(spark, U.with_flag(run.staging.filter("payment_time BETWEEN '1996' AND '1996-03'")))
    all_days = sorted(P.touched_days(table.read(spark)))
    fixed, emptied = all_days[3], all_days[7]
    here = K.in_days([fixed, emptied])
    before = {r.f: r.n for r in table.read(spark).filter(~here).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    rows = table.read(spark).count()
    gone = table.read(spark).filter(F.col("sale_date") == F.lit(emptied)).count()
    table.replace_days(spark, table.read(spark).filter(F.col("sale_date") == F.lit(fixed)).withColumn("quantity", F.lit(99.0)), [fixed, emptied])
    now = table.read(spark)
    after = {r.f: r.n for r in now.filter(~here).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}
    assert before == after and now.count() == rows - gone > 0 < gone
    assert {r.quantity for r in now.filter(F.col("sale_date") == F.lit(fixed)).collect()} == {99.0}
    plan = now._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "batch" in scan.split("PartitionFilters: [")[1].split("]")[0]  # superseded files are not read


def test_null_days_can_be_repaired(spark, paths, run):
    rows = U.with_flag(run.staging.limit(5)).withColumn("payment_time", F.when(F.col("order_id") > "", F.lit(None).cast("string")))
    paths.staging.append(spark, rows)
    paths.staging.append(spark, U.with_flag(run.staging.filter("payment_time < '1995-02'")))
    known = paths.staging.read(spark).filter("sale_date IS NOT NULL").count()
    paths.staging.replace_days(spark, paths.staging.read(spark).filter("sale_date IS NULL").limit(2), [None])
    assert paths.staging.read(spark).filter("sale_date IS NULL").count() == 2
    assert paths.staging.read(spark).filter("sale_date IS NOT NULL").count() == known


def test_order_ids_carry_bloom_filters(spark, paths, run):
    one = U.with_flag(run.staging.limit(1))
    many = one.crossJoin(spark.range(200000).withColumn("n", F.sha2(F.col("id").cast("string"), 256))).withColumn("order_id", F.col("n"))
    paths.staging.append(spark, many)  # few different values stay in a dictionary, which serves as well
    jvm = spark.sparkContext._jvm
    file = paths.staging.read(spark).inputFiles()[0]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    filters = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks()[0].getColumns()}
    reader.close()
    assert filters["order_id"] > 0 > filters["items"]


def test_a_late_day_reaches_the_fact_once(spark, paths):
    for day, orders in (("2026-03-21", (1, 2, 3)), ("2026-03-22", (4, 5, 6))):
        _deliver(paths, day, [_row(i, day) for i in orders])
    P.run_day(spark, paths, _next("2026-03-22"), now_utc=NOW)
    out = P.run_day(spark, paths, _next("2026-03-21"), now_utc=NOW)
    assert out["staged"] == out["fact_appended"] == 2  # the file's last line goes, as the rule says
    assert sorted(r.order_id for r in paths.fact.read(spark).collect()) == ["1", "2", "4", "5"]
    assert paths.staging.read(spark).filter("is_reprocessed").count() == 0
    assert P.build_models(spark, paths)["fact_appended"] == 0


def test_the_strict_rule_keeps_late_lines_out(spark, paths):
    for day in ("2026-03-21", "2026-03-22"):
        _deliver(paths, day, [_row(day[-1] + str(i), day) for i in range(3)])
    P.run_day(spark, paths, _next("2026-03-22"), now_utc=NOW)
    out = P.run_day(spark, paths, _next("2026-03-21"), now_utc=NOW, late=P.LATE_STRICT)
    assert out["staged"] == 2 and out["fact_appended"] == 0
    with pytest.raises(ValueError):
        P.late_flag(spark, paths, "perhaps")


def test_an_order_on_two_days_stops_the_run(spark, paths, monkeypatch):
    _deliver(paths, "2026-03-21", [_row(i, "2026-03-21") for i in (1, 2, 3)])
    _deliver(paths, "2026-03-22", [_row(i, "2026-03-22") for i in (1, 7, 8)])
    P.run_day(spark, paths, _next("2026-03-21"), now_utc=NOW)
    monkeypatch.setattr(P, "FEW_ORDERS", 0)  # by a join, not by named ids
    for few in (0, 500):
        monkeypatch.setattr(P, "FEW_ORDERS", few)
        with pytest.raises(C.CheckFailed, match="unique_combination"):
            P.run_day(spark, paths, _next("2026-03-22"), now_utc=NOW)
        assert sorted(r.order_id for r in paths.fact.read(spark).collect()) == ["1", "2"]


def test_recovery_tells_two_unknown_items_of_an_order_apart(spark, paths):
    day = "2026-03-21"
    _deliver(paths, day, [_row(1, day, "Scented Candle x1, Scented Candle (Hot) x0"), _row(2, day, "Mocha (Hot) x0, Scented Candle x0"), _row(9, day)])
    P.run_day(spark, paths, _next(day), now_utc=NOW, enforce=False)
    edited = paths.quarantine.read(spark).withColumn("quantity", F.lit(1.0))
    n = edited.count()
    out = P.recover_quarantine(spark, paths, edited)
    assert out["loaded"] == out["fact_appended"] == n >= 2
    assert paths.fact.read(spark).count() == paths.staging.read(spark).count()
    assert P.recover_quarantine(spark, paths, edited)["fact_appended"] == 0 and paths.quarantine.read(spark).count() == 0


def test_failed_lines_are_repaired_where_they_are(spark, paths):
    for day in ("2026-03-20", "2026-03-21"):
        _deliver(paths, day, [_row(day[-2:] + "1", day, kind="Delivery" if day.endswith("21") else "Dine-in"), _row(day[-2:] + "2", day), _row(9, day)])
    P.run_range(spark, paths, _next("2026-03-20"), _next("2026-03-21"), now_utc=NOW, enforce=False)
    check = C.Check("expression", ("order_type_key",), expression="!= 0")
    calm = {r.f for r in paths.fact.read(spark).filter("sale_date = '2026-03-20'").select(F.col("_metadata.file_path").alias("f")).collect()}
    out = P.recover_failed(spark, paths, check, "order_type", "Dine-in")
    assert out["failing"] == out["fact_appended"] == 1
    fact = paths.fact.read(spark)
    assert fact.count() == 4 and C.failing_rows(fact, check).count() == 0
    assert calm == {r.f for r in fact.filter("sale_date = '2026-03-20'").select(F.col("_metadata.file_path").alias("f")).collect()}
    assert P.recover_failed(spark, paths, check, "order_type", "Dine-in")["failing"] == 0


def test_multiline_report_and_misfit_records(spark, paths):
    day = "2026-03-21"
    lines = [_row(1, day, "Mocha (Hot) x2,\n Espresso Shot"), _row(2, day), "3,short record", _row(4, day) + ",one cell more", _row(5, day)]
    _deliver(paths, day, lines)
    out = P.run_day(spark, paths, _next(day), now_utc=NOW, multiline=True, enforce=False)
    assert out["loaded"] == out["archived"] == 6 and list(out["bad_records"].values()) == [2]
    staged = sorted((r.order_id, r["items"]) for r in paths.staging.read(spark).collect())
    assert staged == [("1", "Espresso Shot"), ("1", "Mocha"), ("2", "Mocha"), ("4", "Mocha")]
    assert P.archived_rows(spark, paths).filter(F.col(RP.CORRUPT).isNotNull()).count() == 2


def test_step_counts_of_a_day(spark, paths):
    day = "2026-03-21"
    _deliver(paths, day, [_row(1, day, "Mocha (Hot) x2, Mocha (Hot) x2, Mystery Box"), _row(2, day, "Espresso Shot x0"), _row(3, day)])
    out = P.run_day(spark, paths, _next(day), now_utc=NOW, enforce=False)
    assert {k: out[k] for k in ("files", "loaded", "exploded", "duplicates", "good", "quarantined", "bad_records")} == {
        "files": 1, "loaded": 4, "exploded": 5, "duplicates": 1, "good": 1, "quarantined": 2, "bad_records": {}}


def test_grown_catalog_shifts_no_key(spark, paths):
    from tillstack.sources.seeds import Vocabulary
    first = Vocabulary()
    a = {(r["items"], r.variation, r["size"]): r.product_key for r in Dims.stored(spark, paths.dims, first).product.df.collect()}
    grown = Vocabulary(catalog=[("Aaa", "Wake-Up", "Food", None, None), *first.catalog[1:]])
    b = {(r["items"], r.variation, r["size"]): r.product_key for r in Dims.stored(spark, paths.dims, grown).product.df.collect()}
    assert all(b[k] == a[k] for k in a) and b[("Aaa", None, None)] == max(a.values()) + 1 and len(set(b.values())) == len(b)
    batches = {n: t.batches(spark) for n, t in paths.dims.items()}
    Dims.stored(spark, paths.dims, grown)
    assert batches == {n: t.batches(spark) for n, t in paths.dims.items()}  # nothing new, nothing written


def test_increment_prunes_both_scans(spark, paths, run):
    paths.staging.append(spark, U.with_flag(run.staging))
    dims = Dims.build(spark)
    old = paths.staging.read(spark).filter("sale_date < '2001-01-01'")
    paths.fact.append(spark, build_fact(old, dims))
    new = fact_increment(paths.staging.read(spark), dims, paths.fact.read(spark))
    assert new.count() == run.staging.filter("payment_time >= '2001-01-01'").count()
    plan = new._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert any("sale_date" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_recovery_touches_the_failing_line_only(spark):
    staging = spark.createDataFrame(
        [("1", "Mocha", "s", "c", None, "Hot", None, q, None, None, 10.0, 10.0, "2026-03-21 09:00:00", "Cash", "Dine-in", "f") if i else
         ("1", "Espresso Shot", "s", "c", None, None, None, q, None, None, 10.0, 10.0, "2026-03-21 09:00:00", "Cash", "Dine-in", "f")
         for i, q in enumerate((0.0, 3.0))],
        "order_id string, items string, sub_category string, category string, flavor string, variation string, size string, quantity double, "
        "spice_level string, sugar_level string, total_order_amount double, received_amount double, payment_time string, "
        "payment_type string, order_type string, source_file string")
    dims = Dims.build(spark)
    failing = C.failing_rows(build_fact(staging, dims), C.Check("expression", ("quantity",), expression="> 0"))
    fixed = {r.items: (r.quantity, r.is_reprocessed) for r in U.recover_int(staging, failing, "quantity", 1).collect()}
    assert fixed == {"Espresso Shot": (1.0, True), "Mocha": (3.0, False)}
    assert U.remove_failed(build_fact(staging, dims), failing).count() == 1


def test_bad_day_stops_before_the_fact(spark, paths):
    day = "2026-03-21"
    _deliver(paths, day, [_row(1, day, kind="Delivery"), _row(2, day), _row(3, day)])
    with pytest.raises(C.CheckFailed):
        P.run_day(spark, paths, _next(day), now_utc=NOW, run="bad")
    assert not paths.fact.exists(spark)
    stored = spark.read.parquet(paths.audit("failures", "bad"))
    assert [r.order_id for r in stored.filter(F.col("check_name").contains("order_type_key")).collect()] == ["1"]


def test_days_are_landed_by_many_tasks(spark, tiny_dir):
    """A day's cost is that of its file: a small delivery is not written by one task."""
    import glob
    import re
    to = run_dir(spark, "landed")
    K.land_reports(daily_report(spark, tiny_dir), to)
    files = glob.glob(f"{to.removeprefix('file://')}/report_date=*/part-*.csv")
    assert len(files) == len(K.list_dirs(spark, to)) > 10  # one a day
    assert len({re.search(r"part-(\d+)", f)[1] for f in files}) > 1


def test_many_days_are_one_expression(spark):
    import datetime as dt
    import time
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=2 * k) for k in range(3000)]
    t = time.time()
    cond = K.in_days([*days, None])
    assert time.time() - t < 1  # literals made one by one took seconds
    df = spark.createDataFrame([(days[0],), (days[-1],), (days[0] + dt.timedelta(days=1),), (None,)], "sale_date date")
    assert df.filter(cond).count() == 3 and df.filter(K.in_days(days)).count() == 2
    assert df.filter(~K.in_days(days)).count() == 2 and df.filter(K.in_days([])).count() == 0
    times = spark.createDataFrame([("2000-01-01 10:00:00",), ("unknown",), (None,), ("2000-01-02 10:00:00",)], "payment_time string")
    assert times.filter(K.in_days(days, K.DAY_SQL)).count() == 1
    assert times.filter(K.in_days([days[0], None], K.DAY_SQL)).count() == 3
    assert times.filter(~K.day_of().eqNullSafe(F.expr(K.DAY_SQL))).isEmpty()


def test_an_empty_table_takes_no_join(spark):
    table = P.Paths(run_dir(spark, "none")).staging
    assert table.read(spark).schema.names == [*S.STAGING_FLAGGED.names, "sale_date"]
    plan = table.read(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("LocalRelation <empty>")
