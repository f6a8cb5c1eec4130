"""The flows' steps move and read no more than they need."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tillstack import fixed_values as FV
from tillstack import schemas as S
from tillstack.operators import checks as C
from tillstack.operators import upsert as U
from tillstack.operators.clean import clean_report, keep_first_drop_last
from tillstack.operators.dims import Dims
from tillstack.operators.fact import build_fact, fact_increment
from tillstack.plans import flows as P
from tillstack.session import configure, run_dir
from tillstack.sources import sinks as K
from tillstack.sources.fixture import daily_report

HEADER = "Order ID,Products,Product Amount,Received Amount,Payment Time,Cash,GCash,Type/Channel"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return len(re.findall(r"\bExchange (?!SinglePartition)", _plan(df)))


def _staged(spark, rows):
    """Staging rows of (order, item, time, quantity)."""
    df = spark.createDataFrame(rows, "order_id string, items string, payment_time string, quantity double")
    return S.conform(df, S.STAGING)


BATCH = [("1", "Mocha", "2026-03-21 09:00:00", 2.0), ("1", "Mocha", "2026-03-21 09:00:00", 1.0), (None, "Mocha", None, 1.0),
         (None, "Mocha", None, 4.0), ("2", "Mocha", "unknown", 1.0), ("3", "Espresso Shot", "2026-03-22 09:00:00", 1.0)]


def _rows(df):
    return sorted((tuple(r) for r in df.select("order_id", "items", "payment_time", "quantity").collect()), key=repr)


def test_a_merge_shuffles_its_batch_once(spark):
    configure(spark)
    target, batch = _staged(spark, [BATCH[0], ("9", "Mocha", "x", 1.0)]), _staged(spark, BATCH)
    new = U.merge_insert(target, batch)
    assert _rows(new) == sorted([(None, "Mocha", None, 1.0), BATCH[4], BATCH[5]], key=repr)
    assert _exchanges(new) == 1 and "Join" not in _plan(new)
    place = P.day_placing(spark, {dt.date(2026, 3, 21): 2, dt.date(2026, 3, 22): 1, None: 3})
    placed = U.merge_insert(target, batch, place=place)
    assert _rows(placed) == _rows(new) and _exchanges(placed) == 1 and "hashpartitioning(sale_date" in _plan(placed)


def test_a_large_day_is_cut_across_tasks(spark, monkeypatch):
    configure(spark)
    monkeypatch.setattr(P, "PART_ROWS", 100)
    hot = spark.range(3000).select(F.lit("1").alias("order_id"), F.concat(F.lit("item "), F.col("id") % 1500).alias("items"),
                                   F.lit("2026-03-21 09:00:00").alias("payment_time"), F.lit(1.0).alias("quantity"))
    rows = S.conform(hot.unionByName(_staged(spark, BATCH).select(*hot.columns)), S.STAGING)
    sizes = {r.d: r.n for r in P.day_spans(rows)}
    new = U.merge_insert(P.Paths(run_dir(spark, "none")).staging.nothing(spark), rows, place=P.day_placing(spark, sizes))
    got = new.withColumn("task", F.spark_partition_id())
    hot_rows = got.filter("items LIKE 'item %'")
    assert hot_rows.count() == 1500 and hot_rows.select("task").distinct().count() > 2
    assert got.groupBy(*FV.MERGE_KEYS).count().filter("count > 1").isEmpty() and got.count() == 1504


def test_a_merge_again_on_its_days_adds_nothing(spark):
    configure(spark)
    table = P.Paths(run_dir(spark, "again")).staging
    assert P.merge(spark, table, _staged(spark, BATCH)) == 4
    assert P.merge(spark, table, _staged(spark, BATCH + [("7", "Mocha", "2026-03-21 10:00:00", 1.0)])) == 1
    assert P.merge(spark, table, _staged(spark, BATCH)) == 0 and table.read(spark).count() == 5
    assert table.days(spark) == {None, dt.date(2026, 3, 21), dt.date(2026, 3, 22)}


def test_lines_are_shuffled_as_report_rows(spark):
    configure(spark)
    names = "order_id string, products string, product_amount string, received_amount string, payment_time string, " \
            "cash string, gcash string, `type/channel` string, source_file string, row_idx long, row_part long"
    raw = spark.createDataFrame([("1", "Mocha x2, Mocha x2", "1", "1", "t", "-", "-", "Dine-in", "f", 0, 0),
                                 ("1", "Mocha x3", "1", "1", "t", "-", "-", "Dine-in", "f", 1, 0),
                                 ("2", "Mocha", "1", "1", "t", "-", "-", "Dine-in", "f", 2, 0)], names)
    lines = clean_report(raw, spark, drop_last_row=False)
    plan = _plan(lines)
    assert _exchanges(lines) == 1 and plan.index("Generate") < plan.index(" Exchange ")  # the plan is printed from its end
    assert sorted((r.order_id, r.quantity) for r in lines.collect()) == [("1", 2.0), ("2", 1.0)]


def test_held_lines_are_not_shuffled_for_the_files_last_ones(spark):
    configure(spark)
    df = spark.range(300).select(F.concat(F.lit("f"), F.col("id") % 3).alias("source_file"), F.col("id").alias("row_idx"), F.lit(0).alias("row_part"),
                                 F.lit(0).alias("pos"), F.col("id").cast("string").alias("order_id"), F.lit("Mocha").alias("items"), F.lit("t").alias("payment_time"))

    def hold(first):
        path = run_dir(spark, "held")
        K.write_parquet(first, path)
        return spark.read.schema(first.schema).parquet(path)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for lines that are many by their size
    try:
        out = keep_first_drop_last(df, hold=hold)
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        assert sorted(int(r.order_id) for r in out.collect()) == list(range(297))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_footers_read_no_lines(spark, tiny_dir):
    configure(spark)
    report = daily_report(spark, tiny_dir)
    assert _plan(report).count("l_partkey") > 0 and len(re.findall(r"FileScan parquet \[l_orderkey", _plan(report))) == 1
    days = report.groupBy("report_date").agg(F.count_if(F.col("Order ID").isNull() & F.col("Payment Time").isNull()).alias("n")).collect()
    assert len(days) > 10 and {r.n for r in days} == {1}


def test_row_rules_go_along_with_the_grain(spark):
    df = spark.createDataFrame([("1", 1, 0.0), ("1", 1, None), (None, 2, 3.0), (None, 2, -1.0), ("2", 1, 2.0)], "k string, g int, v double")
    checks = [C.Check("unique_combination", ("k", "g")), C.Check("not_null", ("k",)), C.Check("not_null", ("v",)),
              C.Check("expression", ("v",), expression="> 0")]
    for rows in (df, df.limit(0)):
        got = C.run_checks(rows, "t", checks)
        apart = {c.name("t"): C.failing_rows(rows, c).count() for c in checks}
        assert {r.check_name: r.failures for r in got.collect()} == apart and "Union" not in _plan(got)
        assert [r.passed for r in got.collect()] == [n == 0 for n in (r.failures for r in got.collect())]


def test_checked_fact_rows_become_the_batch(spark):
    """Fact rows are written once: the zone in which they waited becomes the table's batch."""
    import os
    paths, day = P.Paths(run_dir(spark, "once")), "2026-03-21"
    folder = f"{paths.incoming}/report_date={day}".removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/report.csv", "w") as f:
        f.write("\n".join([HEADER, *(f'{i},"Mocha (Hot) x2","1,250.00","1,300.00",{day} 09:15:00,100.00,-,Dine-in' for i in (1, 2, 3)), "," * 7]) + "\n")
    out = P.run_day(spark, paths, dt.date(2026, 3, 22), now_utc=dt.datetime(2026, 4, 1), run="r")
    assert out["fact_appended"] == paths.fact.read(spark).count() == 2
    assert not K.path_exists(spark, paths.zone("fact", "r"))


def _day_report(spark, folder, days):
    """A report file a day: two orders, a copy of the first, and the blank last row."""
    import os
    for day in days:
        at = f"{folder}/report_date={day.isoformat()}".removeprefix("file:")
        os.makedirs(at)
        rows = [f'{i},"Mocha (Hot) x2, Mystery Box","1,250.00","1,300.00",{day} 09:15:0{i},100.00,-,Dine-in' for i in (1, 2, 1)]
        with open(f"{at}/report.csv", "w") as f:
            f.write("\n".join([HEADER, *rows, "," * 7]) + "\n")


def test_a_backfills_lines_are_shuffled_before_they_are_parsed_only(spark, monkeypatch):
    """The clustered zones' rows are merged where they lie; the rows are those of a merge that places them."""
    configure(spark)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)]
    plain, held = P.U.merge_insert, {}
    plans = []
    monkeypatch.setattr(P.U, "merge_insert", lambda *a, **k: plans.append(_exchanges(out := plain(*a, **k))) or out)
    for days_a_task, part_rows in ((4, 100_000), (4, 3), (10_000, 100_000)):
        monkeypatch.setattr(P, "DAYS_A_TASK", days_a_task)
        monkeypatch.setattr(P, "PART_ROWS", part_rows)
        paths = P.Paths(run_dir(spark, "placed"))
        _day_report(spark, paths.incoming, days)
        plans.clear()
        out = P.ingest(spark, paths, [f for d in days for f in P.RP.day_files(spark, paths.incoming, d, d)], "r", now_utc=dt.datetime(2026, 4, 1))
        rows = sorted(map(repr, (r[:15] for t in (paths.staging, paths.quarantine) for r in t.read(spark).collect())))
        held[days_a_task, part_rows] = rows, out
        assert plans == ([0, 0] if days_a_task == 4 else [1, 1])
        assert out["good"] == out["staged"] > 0 and out["quarantined"] == out["quarantine_added"] > 0 and out["duplicates"] > 0
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tillstack_zone_")]
        again = P.merge(spark, paths.staging, S.conform(spark.read.parquet(paths.zone("lines", "r")).filter("half = 'good'"), S.STAGING))
        assert again == 0
    first, *others = held.values()
    assert all(o == first for o in others)


def test_a_large_batch_has_more_tasks(spark, monkeypatch):
    """A task's lines, which it sorts, do not grow with the batch; the rows are the same."""
    configure(spark)
    assert P.tasks_of(spark, {None: 1}) == 8 and P.tasks_of(spark, dict.fromkeys(range(2400), 90_000)) == 2160
    days, held, files = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(40)], [], []
    for task_rows, n in ((P.TASK_ROWS, 8), (10, 40)):
        monkeypatch.setattr(P, "TASK_ROWS", task_rows)
        paths = P.Paths(run_dir(spark, "tasks"))
        _day_report(spark, paths.incoming, days)
        P.ingest(spark, paths, [f for d in days for f in P.RP.day_files(spark, paths.incoming, d, d)], "r", now_utc=dt.datetime(2026, 4, 1))
        held.append(sorted(map(repr, (r[:15] for t in (paths.staging, paths.quarantine) for r in t.read(spark).collect()))))
        files.append(len(spark.read.parquet(paths.zone("parsed", "r")).inputFiles()))
    assert held[0] == held[1] and held[0] and files[0] <= 8 < files[1]


def test_grain_checks_count_what_the_plain_ones_do(spark, monkeypatch):
    keys = "order_id string, items string, flavor string, size string, variation string, payment_time string"
    apart = [("1", "a", None, None, None, "t"), ("1", None, "a", None, None, "t"), (None, "a", "x", None, None, None), ("2", "a", None, None, None, "t")]
    for rows in (apart, apart + apart[:1], apart + apart * 2, []):
        df = spark.createDataFrame(rows, keys)
        want = sorted(tuple(r) for r in C.run_checks(df, "t", C.STAGING_CHECKS).collect())
        for limit in (200_000, 0):
            monkeypatch.setattr(C, "BROADCAST_ROW_LIMIT", limit)
            got = C.run_grain_checks(df, "t", C.STAGING_CHECKS)
            assert sorted(tuple(r) for r in got.collect()) == want
    collide = spark.createDataFrame(apart, keys)
    monkeypatch.setattr(C.F, "xxhash64", lambda *cols: F.lit(7))  # all rows of one hash, no duplicates
    monkeypatch.setattr(C, "BROADCAST_ROW_LIMIT", 200_000)
    assert {r.failures for r in C.run_grain_checks(collide, "t", C.STAGING_CHECKS[:1]).collect()} == {0}


def _repairable(spark, name, days):
    """Tables after a backfill of ``days``; each has lines of four orders that no known order type has."""
    import os
    paths = P.Paths(run_dir(spark, name))
    for day in days:
        at = f"{paths.incoming}/report_date={day.isoformat()}".removeprefix("file:")
        os.makedirs(at)
        rows = [f'{day.day}{i},"Mocha (Hot) x2, Espresso Shot, Mystery Box","1,250.00","1,300.00",{day} 09:15:0{i},100.00,-,{"Delivery" if i < 4 else "Dine-in"}'
                for i in range(6)]
        with open(f"{at}/report.csv", "w") as f:
            f.write("\n".join([HEADER, *rows, "," * 7]) + "\n")
    P.run_range(spark, paths, days[0] + dt.timedelta(days=1), days[-1] + dt.timedelta(days=1), now_utc=dt.datetime(2026, 4, 1), enforce=False)
    return paths


def test_recovered_lines_have_a_file_a_day(spark):
    """However many tasks match the lines: each once wrote files of all days."""
    configure(spark)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(4)]
    paths = _repairable(spark, "repair", days)
    before = _rows(paths.staging.read(spark))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # as for many lines
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        check = C.Check("expression", ("order_type_key",), expression="!= 0")
        out = P.recover_failed(spark, paths, check, "order_type", "Dine-in")
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert out["failing"] == out["fact_appended"] == 8 * len(days)
    staging, fact = paths.staging.read(spark), paths.fact.read(spark)
    assert C.failing_rows(fact, check).count() == 0 and fact.count() == staging.count() == len(before)
    assert _rows(staging) == before and staging.filter("is_reprocessed OR order_type <> 'Dine-in'").count() == 0
    for table in (paths.staging, paths.fact):
        for batch in table.batches(spark)[1:]:
            assert len(spark.read.parquet(table._dir(batch)).inputFiles()) == len(days)


def test_repairs_shuffle_the_rows_once(spark, monkeypatch):
    """Rows marked where they will be written are those of the plain operators, nulls and copies too."""
    configure(spark)
    rows = S.conform(_staged(spark, [*BATCH, BATCH[0], BATCH[3]]), S.STAGING_FLAGGED).filter("payment_time IS NULL OR payment_time <> 'unknown'")
    rows = rows.withColumns({"sale_date": K.day_of(), "is_reprocessed": F.lit(True)})
    fact = build_fact(rows.filter("quantity > 1"), Dims.build(spark)).withColumn("sale_date", K.day_of())
    whole = build_fact(rows, Dims.build(spark)).withColumn("sale_date", K.day_of())
    counts = P.rows_a_day(rows)
    assert counts == {dt.date(2026, 3, 21): 3, dt.date(2026, 3, 22): 1, None: 3}
    keyed, fixed, staged = rows.drop("is_reprocessed"), rows.filter("quantity > 1"), rows.filter("order_id IS NULL OR order_id = '3'")
    for part_rows in (100_000, 1):
        monkeypatch.setattr(P, "PART_ROWS", part_rows)
        monkeypatch.setattr(P, "TASK_ROWS", part_rows)
        line, day = P.line_placing(spark, counts), P.day_placing(spark, counts)
        for plain, placed in (
                (U.reset_flag(rows, fact), U.reset_flag(rows, fact, line)),
                (U.recover(rows, fact, "quantity", 9), U.recover(rows, fact, "quantity", 9, line)),
                (U.remove_failed(whole, fact), U.remove_failed(whole, fact, line)),
                (U.delete_fixed(keyed, fixed), U.delete_fixed(keyed, fixed, place=day)),
                (U.delete_fixed(keyed, staged, fixed=fixed), U.delete_fixed(keyed, staged, fixed=fixed, place=day))):
            want = sorted(map(repr, plain.collect()))
            assert sorted(map(repr, placed.select(*plain.columns).collect())) == want and want
            assert _exchanges(placed) == 1 and "hashpartitioning(sale_date" in _plan(placed)


def test_late_lines_of_days_that_the_fact_lacks_are_not_shuffled(spark):
    configure(spark)
    paths, dims = P.Paths(run_dir(spark, "late")), Dims.build(spark)
    rows = U.with_flag(_staged(spark, [r for r in BATCH if r[2] != "unknown"]))
    paths.staging.append(spark, rows.withColumn("is_reprocessed", F.expr("payment_time IS NULL OR payment_time < '2026-03-22'")))
    paths.fact.append(spark, build_fact(rows.filter("payment_time >= '2026-03-22'"), dims))
    staging, fact = paths.staging.read(spark), paths.fact.read(spark)
    plain = fact_increment(staging, dims, fact)
    new = fact_increment(staging, dims, fact, paths.fact.days(spark), lambda rows: P.line_placing(spark, rows))
    assert _exchanges(new) == 0
    assert sorted(map(repr, new.collect())) == sorted(map(repr, plain.collect())) and new.count() == 4
    paths.fact.append(spark, plain.filter("order_id = '1'"))  # a run that stopped
    fact = paths.fact.read(spark)
    plain = fact_increment(staging, dims, fact)
    new = fact_increment(staging, dims, fact, paths.fact.days(spark), lambda rows: P.line_placing(spark, rows))
    assert _exchanges(new) == 1
    assert sorted(map(repr, new.collect())) == sorted(map(repr, plain.collect())) and new.count() == 2


def test_redelivered_orders_alone_are_put_together(spark, tiny_dir):
    configure(spark)
    mine = F.col("Order ID").cast("long") % 7 == 0
    some = daily_report(spark, tiny_dir, lambda key: F.col(key) % 7 == 0).filter(mine)
    want = sorted(map(repr, daily_report(spark, tiny_dir).filter(mine).collect()))
    assert sorted(map(repr, some.collect())) == want and want
    assert re.search(r"DataFilters: \[[^]]*l_orderkey#\d+L? % 7", _plan(some)) or re.search(r"Filter \([^\n]*l_orderkey#\d+L? % 7", _plan(some))
