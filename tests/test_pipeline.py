"""Pipeline invariants and plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from tillstack.operators import upsert as U
from tillstack.operators.quarantine import quarantine_rows, split_good_bad
from tillstack.schemas import STAGING, conform


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_split_is_a_partition(run):
    good, bad = split_good_bad(run.lines, dt.datetime(2026, 3, 23))
    n, g, b = run.lines.count(), good.count(), bad.count()
    assert n == g + b and g > 0 and b > 0
    keys = ["source_file", "row_idx", "row_part", "pos"]
    assert good.select(*keys).intersect(bad.select(*keys)).count() == 0


def test_quarantine_reason_priority(spark):
    rows = [
        ("1", "X", "Uncategorized", "Uncategorized", 0.0, 10.0),
        (None, "Latte", "Long Talk", "Beverages", 0.0, 10.0),
        (None, "Latte", "Long Talk", "Beverages", 1.0, None),
        ("2", "Latte", "Long Talk", "Beverages", 1.0, None),
    ]
    df = spark.createDataFrame(rows, "order_id string, items string, sub_category string, category string, "
                                     "quantity double, total_order_amount double")
    got = [r.quarantine_reason for r in quarantine_rows(df, dt.datetime(2026, 3, 23)).collect()]
    assert got == ["Uncategorized category", "Invalid quantity", "Null order ID", "Null order amount"]


def test_merge_is_idempotent(run):
    target = run.staging.filter(F.col("payment_time") < "1999-01-01")
    batch = run.staging.filter(F.col("payment_time") >= "1998-07-01")
    first = U.merge_insert(target, batch)
    t1 = U.with_flag(target).unionByName(first)
    assert U.merge_insert(t1, batch).count() == 0
    assert t1.count() == run.staging.count()


def test_fact_rows_equal_staging_rows(run):
    assert run.fact.count() == run.staging.count()


def test_recovery_cycle(run):
    assert run.loaded.count() > 0
    left = U.delete_fixed(run.quarantine, run.loaded).count()
    assert left == run.quarantine.count() - run.loaded.count()
    reset = U.reset_flag(run.staging2, run.fact.unionByName(run.fact_reprocessed))
    assert reset.filter("is_reprocessed").count() == 0


def test_plans_have_no_cartesian_or_python(run):
    for df in (run.lines, run.fact, run.fact_reprocessed):
        df.write.format("noop").mode("overwrite").save()
        p = _plan(df)
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in p, bad


def test_fact_joins_are_broadcast(run):
    p = run.fact._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join LeftOuter") >= 6
    phys = _plan(run.fact)
    assert "SortMergeJoin" not in phys.split("InMemoryTableScan")[0]


def test_conform_fills_missing_columns(spark):
    df = spark.createDataFrame([("1", "x")], "order_id string, extra string")
    out = conform(df, STAGING)
    assert out.columns == STAGING.names and out.first().items is None


def test_keep_unparsed_sends_pastry_without_flavor_to_quarantine(spark):
    from tillstack.operators.clean import clean_report
    raw = spark.createDataFrame(
        [("1", "Croissant x2, Latte x1, Filler", "100", "100", "2026-03-22 09:00:00", "-", "-", "Dine-in", "f", 0, 0)],
        "order_id string, products string, product_amount string, received_amount string, payment_time string, "
        "cash string, gcash string, `type/channel` string, source_file string, row_idx long, row_part long")
    dropped = clean_report(raw, spark, drop_last_row=False)
    kept = clean_report(raw, spark, drop_last_row=False, keep_unparsed=True)
    assert dropped.count() == 2 and kept.count() == 3
    q = quarantine_rows(kept, dt.datetime(2026, 3, 23), with_all_reasons=True)
    row = q.filter("items IS NULL").first()
    assert row.quarantine_reason == "Uncategorized category"
    assert set(row.quarantine_reasons) == {"Null item name", "Uncategorized sub_category", "Uncategorized category"}


def test_hash_product_key_is_stable(spark):
    from tillstack.operators.dims import dim_product
    from tillstack.sources import seeds
    v = seeds.Vocabulary()
    a = {r.items + str(r.variation) + str(r.size): r.product_key
         for r in dim_product(seeds.products_seed(spark, v), key="hash").df.collect()}
    grown = seeds.Vocabulary(catalog=[("Aaa First", "Wake-Up", "Beverages", None, None)] + list(v.catalog))
    b = {r.items + str(r.variation) + str(r.size): r.product_key
         for r in dim_product(seeds.products_seed(spark, grown), key="hash").df.collect()}
    assert all(b[k] == a[k] for k in a) and len(set(a.values())) == len(a)


def test_merge_reads_only_the_batch_window(spark, run):
    from tillstack.plans import flows as P
    from tillstack.session import run_dir
    paths = P.Paths(run_dir(spark, "prune"))
    paths.staging.append(spark, U.with_flag(run.staging))
    batch = run.staging.filter(F.col("payment_time").startswith("2001-07"))
    hits = P.merge_candidates(paths.staging.read(spark), batch)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "PartitionFilters: [" in scan and "sale_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "payment_time" in scan.split("PushedFilters: [")[1].split("]")[0]
    expected = run.staging.filter(F.col("payment_time").between(
        batch.agg(F.min("payment_time")).first()[0], batch.agg(F.max("payment_time")).first()[0])).count()
    assert hits.count() == expected


def test_file_order_steps_use_no_window(run):
    from tillstack.operators.clean import keep_first_drop_last
    df = keep_first_drop_last(run.finished)
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "Window" not in plan.split("InMemoryTableScan")[0]
    assert "SortAggregate" in plan or "HashAggregate" in plan


def test_hot_file_dedup_matches_window_semantics(spark):
    """One file holding most rows, many copies of one key: the aggregate +
    semi-join form keeps exactly the first line of each key and drops the
    file's last line, as the row-order rule says."""
    from pyspark.sql import Window
    from tillstack.operators.clean import keep_first_drop_last
    rows = [("hot", i // 3, 0, i % 3, "o1" if i % 5 else "o2", "Latte", "t") for i in range(3000)]
    rows += [("cold", i, 0, 0, f"c{i}", "Tea", "t") for i in range(10)]
    df = spark.createDataFrame(rows, "source_file string, row_idx long, row_part long, pos int, "
                                     "order_id string, items string, payment_time string")
    got = {tuple(r) for r in keep_first_drop_last(df).collect()}
    last = Window.partitionBy("source_file").orderBy(F.desc("row_idx"), F.desc("row_part"), F.desc("pos"))
    first = Window.partitionBy("source_file", "order_id", "items", "payment_time").orderBy("row_idx", "row_part", "pos")
    ref = (df.withColumn("l", F.row_number().over(last)).filter("l > 1").drop("l")
           .withColumn("f", F.row_number().over(first)).filter("f = 1").drop("f"))
    assert got == {tuple(r) for r in ref.collect()}


def test_typed_seed_csvs_and_calendar(spark):
    import csv
    import os

    from tillstack import catalog as CAT
    from tillstack.operators.dims import dim_date, dim_product
    from tillstack.session import run_dir
    from tillstack.sources import seeds
    base = run_dir(spark, "seeds").replace("file:", "")
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/products.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["items", "sub_category", "category", "variation", "size"])
        w.writerows([[("" if v is None else v) for v in row] for row in CAT.CATALOG])
    with open(f"{base}/holidays.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["holiday_date", "holiday_name", "holiday_type"])
        w.writerows([[d.isoformat(), n, t] for d, n, t in CAT.holiday_rows(2026, 2027)])
    prod = seeds.read_products_seed(spark, f"{base}/products.csv")
    assert sorted(map(tuple, prod.collect()), key=repr) == sorted(CAT.CATALOG, key=repr)
    keys = dim_product(seeds.Sized(prod, len(CAT.CATALOG))).df
    assert keys.select("product_key").distinct().count() == len(CAT.CATALOG)
    hol = seeds.read_holidays_seed(spark, f"{base}/holidays.csv")
    cal = dim_date(spark, "2026-01-01", "2027-12-31", holidays=hol)
    assert cal.count() == 730
    assert cal.filter("is_holiday").count() == 12
    d = cal.filter("date_key = 20261225").first()
    assert (d.day_of_week, d.month_name, d.is_weekend, d.holiday_type) == ("Friday", "December", False, "Regular")
    assert cal.filter("is_weekend").count() == 208
