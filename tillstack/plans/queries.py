"""Registered queries: one per operator row or tight group of SURVEY §2.

Every query starts from the report derived from the test tables at
``sf_dir`` (so its work grows with them) and runs over all of it.  Each
Spark callable has a DuckDB twin in ``SQL`` built from ``plans.oracle``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillstack import fixed_values as FV
from tillstack.functions import numeric as N
from tillstack.functions import text as T
from tillstack.operators import checks as C
from tillstack.operators import clean as CL
from tillstack.operators import reports as R
from tillstack.operators import upsert as U
from tillstack.operators.audit import unmapped_rows
from tillstack.operators.dims import Dims, dim_date_for
from tillstack.operators.fact import build_fact
from tillstack.operators.quarantine import bad_mask, good_rows, quarantine_rows
from tillstack.plans import oracle as O
from tillstack.plans import flows as P
from tillstack.schemas import FACT, HOLIDAYS_SEED, PRODUCTS_SEED, QUARANTINE, RAW_REPORT_COLUMNS, STAGING, STAGING_FLAGGED, conform
from tillstack.session import configure, run_dir
from tillstack.sources import reports as RP
from tillstack.sources import sinks as K
from tillstack.sources.fixture import daily_report, normalized_report, raw_report
from tillstack.sources.seeds import Vocabulary, local_table

RUN_NOW = _dt.datetime.fromisoformat(O.RUN_DATE + " 00:00:00")
KEYS = ["source_file", "row_idx", "row_part", "pos"]
RKEYS = ["source_file", "row_idx", "row_part"]


class Run:
    """The pipeline stages over one test-data folder, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str, vocab: Vocabulary | None = None):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.vocab = vocab or Vocabulary()

    def _held(self, df: DataFrame, label: str) -> DataFrame:
        path = run_dir(self.spark, label)
        K.write_parquet(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def report(self) -> DataFrame:
        return normalized_report(self.spark, self.sf_dir)

    @cached_property
    def exploded(self) -> DataFrame:
        return CL.explode_items(self.report)

    @cached_property
    def nonblank(self) -> DataFrame:
        return CL.drop_blank_items(self.exploded)

    @cached_property
    def parsed(self) -> DataFrame:
        return CL.parse_lines(self.report, self.spark, self.vocab)

    @cached_property
    def kept(self) -> DataFrame:
        return CL.drop_missing_items(CL.keep_columns(self.parsed))

    @cached_property
    def finished(self) -> DataFrame:
        return self._held(CL.finished_lines(self.report, self.spark, self.vocab), "finished")

    @cached_property
    def nofoot(self) -> DataFrame:
        return CL.drop_footer(self.finished)

    @cached_property
    def lines(self) -> DataFrame:
        # parsed once, into the shared folder, like the zones a daily run writes
        hold = lambda first: self._held(first, "lines")
        if "finished" in self.__dict__:  # written already
            return CL.keep_first_drop_last(self.finished, hold=hold)
        return CL.clean_report(self.report, self.spark, self.vocab, hold=hold)

    @cached_property
    def staging(self) -> DataFrame:
        return conform(good_rows(self.lines), STAGING)

    @cached_property
    def quarantine(self) -> DataFrame:
        return conform(quarantine_rows(self.lines, RUN_NOW), QUARANTINE)

    @cached_property
    def dims(self) -> Dims:
        return Dims.build(self.spark, self.vocab)

    @cached_property
    def fact(self) -> DataFrame:
        return build_fact(self.staging, self.dims)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dim_date_for(self.staging)

    # recovery inputs -------------------------------------------------------
    @cached_property
    def edited_quarantine(self) -> DataFrame:
        return _edit(self.quarantine)

    @cached_property
    def loaded(self) -> DataFrame:
        # read by several branches (staging2, the quarantine delete, counts)
        return self._held(U.load_fixed(self.staging, self.edited_quarantine), "loaded")

    @cached_property
    def staging2(self) -> DataFrame:
        return U.with_flag(self.staging).unionByName(self.loaded)

    @cached_property
    def fact_reprocessed(self) -> DataFrame:
        return build_fact(self.staging2, self.dims, existing=self.fact)


def _with_lines(run: Run, df: DataFrame, cols) -> DataFrame:
    return df.select(*KEYS, *cols)


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def q_normalize_headers(r: Run):
    return r.report


def q_explode_items(r: Run):
    return r.exploded.select(*KEYS, "product_text")


def q_drop_blank_items(r: Run):
    return r.nonblank.select(*KEYS, "product_list")


def _extract(name: str, fn):
    def q(r: Run):
        return r.nonblank.select(*KEYS, "product_list", fn("product_list").alias(name))
    return q


def q_composite_item(r: Run):
    p = F.col("product_list")
    return r.nonblank.filter(T.is_pastry(p)).select(
        *KEYS, "product_list", T.pastry_group(p).alias("pastry_group"),
        T.pastry_flavor(p).alias("pastry_flavor"), T.composite_item(p).alias("clean_item"))


def q_plain_item(r: Run):
    p = F.col("product_list")
    return r.nonblank.filter(~T.is_pastry(p)).select(*KEYS, "product_list", T.plain_item(p).alias("clean_item"))


def q_corrections(r: Run):
    before = CL.derive_item(r.nonblank).withColumn("clean_before", F.col("clean_item"))
    after = CL.apply_corrections(before, r.spark, r.vocab)
    return after.select(*KEYS, "clean_before", "clean_item")


def q_title_case(r: Run):
    return r.kept.select(*KEYS, "clean_item", T.title_case("clean_item").alias("items"))


def q_parse_amount(r: Run):
    return r.report.select(
        *RKEYS, "product_amount", "received_amount",
        N.amount("product_amount").alias("total_order_amount"),
        N.amount("received_amount").alias("received_value"))


def q_payment_type(r: Run):
    return r.report.select(*RKEYS, "cash", "gcash", N.payment_type(F.col("cash"), F.col("gcash")).alias("payment_type"))


def q_categorize(r: Run):
    return r.parsed.select(*KEYS, "clean_item", "sub_category", "category")


def q_clean_lines(r: Run):
    return r.lines


def q_drop_footer(r: Run):
    return r.finished.join(r.nofoot, KEYS, "left_anti").select(*KEYS, "items")


def q_dedup_first(r: Run):
    return r.nofoot.join(r.lines, KEYS, "left_anti").select(*KEYS, "order_id", "items", "payment_time")


def q_good_rows(r: Run):
    return r.staging


def q_quarantine_rows(r: Run):
    return r.quarantine


def q_ingest_counts(r: Run):
    rep = r.report.groupBy("source_file").agg(F.count(F.lit(1)).alias("report_rows"))
    items = r.nonblank.groupBy("source_file").agg(F.count(F.lit(1)).alias("item_lines"))
    ls = r.lines.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("clean_lines"),
        F.count_if(~bad_mask(r.lines)).alias("good_rows"),
        F.count_if(bad_mask(r.lines)).alias("quarantine_rows"))
    out = rep.join(items, "source_file", "left").join(ls, "source_file", "left")
    return out.fillna(0, ["item_lines", "clean_lines", "good_rows", "quarantine_rows"])


def _dim_usage(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_lines"))
    return dim.join(used, key, "left").fillna(0, ["fact_lines"])


def q_dim_product(r: Run):
    return _dim_usage(r.dims.product.df, r.fact, "product_key")


def q_dim_flavor(r: Run):
    return _dim_usage(r.dims.flavor.df, r.fact, "flavor_key")


def q_dim_sugar(r: Run):
    return _dim_usage(r.dims.sugar.df, r.fact, "sugar_key")


def q_dim_spice(r: Run):
    return _dim_usage(r.dims.spice.df, r.fact, "spice_key")


def q_dim_payment(r: Run):
    return _dim_usage(r.dims.payment.df, r.fact, "payment_type_key")


def q_dim_order(r: Run):
    return _dim_usage(r.dims.order.df, r.fact, "order_type_key")


def q_dim_date(r: Run):
    return r.dim_date


def _seed_file(r: Run, rows, schema) -> str:
    """A seed as a CSV file with a header."""
    path = run_dir(r.spark, "seed")
    local_table(r.spark, rows, schema).coalesce(1).write.option("header", True).csv(path)
    return path


def q_dim_date_holidays(r: Run):
    """SRC4: the calendar with the holidays of a file."""
    path = _seed_file(r, O.HOLIDAYS, HOLIDAYS_SEED)
    return dim_date_for(r.staging, vocab=Vocabulary(holidays_path=path))


def q_dim_product_file(r: Run):
    """SRC5: products from a catalog file, with their use in the fact."""
    vocab = Vocabulary(catalog_path=_seed_file(r, O.SMALL_CATALOG, PRODUCTS_SEED))
    dims = Dims.build(r.spark, vocab)
    return _dim_usage(dims.product.df, build_fact(r.staging, dims), "product_key")


def q_dim_registry(r: Run):
    """SNK8/Q11: products of a small catalog, and then of the whole one, as tables:
    the first keep their keys."""
    tables = P.Paths(run_dir(r.spark, "registry")).dims
    Dims.stored(r.spark, tables, Vocabulary(catalog=O.SMALL_CATALOG))
    dims = Dims.stored(r.spark, tables, r.vocab)
    return _dim_usage(dims.product.df, build_fact(r.staging, dims), "product_key")


def q_fact_full(r: Run):
    return build_fact(r.staging, r.dims, dim_date=r.dim_date).select(*FACT.names)


def q_fact_incremental(r: Run):
    old = r.staging.filter(F.col("payment_time") < O.CUTOFF)
    existing = build_fact(old, r.dims)
    return build_fact(r.staging, r.dims, existing=existing).select(*FACT.names)


def q_fact_reprocessed(r: Run):
    return r.fact_reprocessed.select(*FACT.names)


def q_unmapped_rows(r: Run):
    return unmapped_rows(r.staging, r.dims)


def _merge_split(df: DataFrame):
    return df.filter(F.col("payment_time") < O.CUTOFF), df.filter(F.col("payment_time") >= O.OVERLAP)


def q_merge_insert(r: Run):
    target, batch = _merge_split(r.staging)
    return U.merge_insert(target, batch)


def q_merge_rerun(r: Run):
    target, batch = _merge_split(r.staging)
    t1 = U.with_flag(target).unionByName(U.merge_insert(target, batch))
    return t1.unionByName(U.merge_insert(t1, batch))


def q_merge_quarantine(r: Run):
    target, batch = _merge_split(r.quarantine)
    return U.merge_insert(target, batch, reprocessed=None)


def q_load_fixed(r: Run):
    return r.loaded


def q_delete_fixed(r: Run):
    return U.delete_fixed(r.quarantine, r.loaded)


def q_reset_flag(r: Run):
    fact2 = r.fact.unionByName(r.fact_reprocessed)
    return U.reset_flag(r.staging2, fact2)


def _fact_failures(r: Run, check: C.Check) -> DataFrame:
    return C.failing_rows(r.fact, check)


NOT_NULL_RECEIVED = C.Check("not_null", ("received_amount",))
ORDER_TYPE_KNOWN = C.Check("expression", ("order_type_key",), expression="!= 0", store_failures=True)


def q_recover_int(r: Run):
    return U.recover_int(r.staging, _fact_failures(r, NOT_NULL_RECEIVED), "received_amount", 0)


def q_recover_str(r: Run):
    return U.recover_str(r.staging, _fact_failures(r, ORDER_TYPE_KNOWN), "order_type", "Dine-in")


def _edit(quarantine: DataFrame) -> DataFrame:
    """Our stand-in for the hand edit: bad quantities set to 1, missing order
    amounts taken from the received amount; keys untouched."""
    return quarantine.withColumns({
        "quantity": F.when(F.col("quantity") <= 0, F.lit(1.0)).otherwise(F.col("quantity")),
        "total_order_amount": F.coalesce("total_order_amount", "received_amount")})


def q_recover_quarantine(r: Run):
    """FLW3 as it runs on tables, twice over: all of staging, quarantine and fact after it."""
    paths = _backfilled(r)
    edited = _edit(paths.quarantine.read(r.spark).drop("sale_date"))
    P.recover_quarantine(r.spark, paths, edited, r.vocab)
    P.recover_quarantine(r.spark, paths, edited, r.vocab)
    line = ["order_id", "items", "payment_time", "quantity", "is_reprocessed"]
    st, qu, fa = (t.read(r.spark) for t in (paths.staging, paths.quarantine, paths.fact))
    none = F.lit(None)
    return (st.select(F.lit("staging").alias("table_name"), *line)
            .unionByName(qu.withColumn("is_reprocessed", none.cast("boolean")).select(F.lit("quarantine").alias("table_name"), *line))
            .unionByName(fa.select(F.lit("fact").alias("table_name"), "order_id", none.cast("string").alias("items"),
                                   F.date_format("payment_time", "yyyy-MM-dd HH:mm:ss").alias("payment_time"), "quantity",
                                   none.cast("boolean").alias("is_reprocessed"))))


def _dim_tables(r: Run) -> dict:
    return {
        "dim_product": (r.dims.product.df, C.DIM_CHECKS["dim_product"]),
        "dim_date": (r.dim_date, C.DIM_CHECKS["dim_date"]),
        "dim_flavor": (r.dims.flavor.df, C.DIM_CHECKS["dim_flavor"]),
        "dim_spice_level": (r.dims.spice.df, C.DIM_CHECKS["dim_spice_level"]),
        "dim_sugar_levels": (r.dims.sugar.df, C.DIM_CHECKS["dim_sugar_levels"]),
        "dim_payment_type": (r.dims.payment.df, C.DIM_CHECKS["dim_payment_type"]),
        "dim_order_type": (r.dims.order.df, C.DIM_CHECKS["dim_order_type"]),
    }


def _all_tables(r: Run) -> dict:
    t = {"fact_sales": (r.fact, C.FACT_CHECKS),
         "staging_fact_sales": (r.staging, C.STAGING_CHECKS),
         "fact_sales_quarantine": (r.quarantine, C.QUARANTINE_CHECKS)}
    t.update(_dim_tables(r))
    return t


def _kind_suite(r: Run, kind: str) -> DataFrame:
    tables = {}
    for name, (df, checks) in _all_tables(r).items():
        sel = [c for c in checks if c.kind == kind]
        if sel:
            tables[name] = (df, sel)
    return C.check_suite(tables)


def q_chk_not_null(r: Run):
    return _kind_suite(r, "not_null")


def q_chk_unique(r: Run):
    return _kind_suite(r, "unique")


def q_chk_accepted(r: Run):
    return _kind_suite(r, "accepted_values")


def q_chk_unique_combo(r: Run):
    return _kind_suite(r, "unique_combination")


def q_chk_expression(r: Run):
    return _kind_suite(r, "expression")


def q_chk_summary(r: Run):
    return C.check_suite(_all_tables(r))


def q_chk_failures(r: Run):
    return C.failing_rows(r.fact.select(*FACT.names), ORDER_TYPE_KNOWN)


def q_rpt_daily(r: Run):
    return R.daily_sales(r.fact, r.dim_date)


def q_rpt_monthly(r: Run):
    return R.monthly_sales(r.fact)


def q_rpt_category(r: Run):
    return R.category_revenue(r.fact)


def q_rpt_category_totals(r: Run):
    return R.category_totals(r.fact)


def q_rpt_payment(r: Run):
    return R.payment_distribution(r.fact, r.dims)


def q_rpt_order_type(r: Run):
    return R.order_type_distribution(r.fact, r.dims)


def q_rpt_product(r: Run):
    return R.product_performance(r.fact, r.dims)


# --- sinks and flows (write to a fresh folder in the shared directory) -----

def _split_staging(r: Run):
    return r.staging.filter(F.col("payment_time") < O.CUTOFF), r.staging.filter(F.col("payment_time") >= O.CUTOFF)


def q_sink_roundtrip(r: Run):
    path = run_dir(r.spark, "sink") + "/staging"
    K.write_parquet(r.staging, path)
    return r.spark.read.schema(STAGING).parquet(path)


def q_append_merge_schema(r: Run):
    path = run_dir(r.spark, "append") + "/staging"
    old, new = _split_staging(r)
    K.write_parquet(old, path, "overwrite")
    K.write_parquet(U.with_flag(new), path, "append")
    return r.spark.read.option("mergeSchema", "true").parquet(path).select(*STAGING_FLAGGED.names)


def _fact_rows(r: Run, paths: P.Paths) -> DataFrame:
    return paths.fact.read(r.spark).select(*FACT.names, "sale_date")


def q_partitioned_fact(r: Run):
    paths = P.Paths(run_dir(r.spark, "fact"))
    paths.fact.replace(r.spark, r.fact)
    return _fact_rows(r, paths)


_LANDED: dict = {}


def _landed(r: Run) -> P.Paths:
    """Fresh tables for this query over the daily report files, which are
    written once per session and data folder (they never change)."""
    key = (r.spark.sparkContext.applicationId, r.sf_dir)
    incoming = _LANDED.get(key)
    if incoming is None or not K.path_exists(r.spark, incoming):
        incoming = run_dir(r.spark, "incoming")
        K.land_reports(daily_report(r.spark, r.sf_dir), incoming)
        _LANDED[key] = incoming
    return P.Paths(run_dir(r.spark, "flow"), incoming)


def _day_of(col: str = "source_file"):
    return F.regexp_extract(F.col(col), r"report_date=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)


def _report_days(paths: P.Paths, spark) -> list:
    days = [d.split("=", 1)[1] for d in K.list_dirs(spark, paths.incoming) if d.startswith("report_date=")]
    return sorted(_dt.date.fromisoformat(d) for d in days)


def _backfilled(r: Run, first: int = 0, last: int = -1, paths: P.Paths | None = None, enforce: bool = False, **options) -> P.Paths:
    """``run_range`` over the delivered days number ``first`` to ``last``."""
    paths = paths or _landed(r)
    days = _report_days(paths, r.spark)
    one = _dt.timedelta(days=1)
    P.run_range(r.spark, paths, days[first] + one, days[last] + one, r.vocab, RUN_NOW, enforce=enforce, **options)
    return paths


def _again(r: Run, paths: P.Paths) -> None:
    """The last day, and then everything, once more."""
    P.run_day(r.spark, paths, _report_days(paths, r.spark)[-1] + _dt.timedelta(days=1), r.vocab, RUN_NOW, enforce=False)
    _backfilled(r, paths=paths)


def q_run_range(r: Run):
    return _fact_rows(r, _backfilled(r))


def _halves(r: Run, late: str) -> P.Paths:
    """The days from the middle one on, and then the ones before it."""
    paths = _landed(r)
    middle = len(_report_days(paths, r.spark)) // 2
    _backfilled(r, middle, -1, paths)
    return _backfilled(r, 0, middle - 1, paths, late=late)


def q_late_days(r: Run):
    """The fact after half of all days came late."""
    return _fact_rows(r, _halves(r, P.LATE_FLAG))


def q_late_strict(r: Run):
    """The same by the strict rule: late lines stay in staging alone."""
    return _fact_rows(r, _halves(r, P.LATE_STRICT))


AGAIN = 7  # every seventh order number comes again


def q_gate_history(r: Run):
    """The fact checks' results of a day that holds orders of other days again; the
    run has stopped and the fact has none of its rows."""
    paths = _backfilled(r)
    again = _report_days(paths, r.spark)[-1] + _dt.timedelta(days=1)
    rows = daily_report(r.spark, r.sf_dir, lambda key: F.col(key) % AGAIN == 0).filter(F.col("Order ID").cast("long") % AGAIN == 0)
    moved = rows.withColumns({"Payment Time": F.concat(F.lit(again.isoformat()), F.substring("Payment Time", 11, 9)),
                              "report_date": F.lit(again)})
    late = P.Paths(paths.base, run_dir(r.spark, "again"))
    K.land_reports(moved, late.incoming)
    before, run = paths.fact.read(r.spark).count(), P.new_run("again")
    try:
        P.run_day(r.spark, late, again + _dt.timedelta(days=1), r.vocab, RUN_NOW, run=run)
        raise AssertionError("the run was not stopped")
    except C.CheckFailed:
        assert paths.fact.read(r.spark).count() == before
    return r.spark.read.parquet(paths.audit("results/fact", run))


def q_recover_failed(r: Run):
    """REC4/REC5 on tables: order types that the check does not know become Dine-in,
    and missing received amounts 0; the fact, staging and their flags after it."""
    paths = _backfilled(r)
    P.recover_failed(r.spark, paths, ORDER_TYPE_KNOWN, "order_type", "Dine-in", r.vocab)
    P.recover_failed(r.spark, paths, NOT_NULL_RECEIVED, "received_amount", 0, r.vocab)
    fact = paths.fact.read(r.spark).select(F.lit("fact").alias("table_name"), "order_id", F.col("order_type_key").cast("string").alias("order_type"),
                                           "quantity", "received_amount", F.lit(False).alias("is_reprocessed"))
    return fact.unionByName(paths.staging.read(r.spark).select(
        F.lit("staging").alias("table_name"), "order_id", "order_type", "quantity", "received_amount", "is_reprocessed"))


def q_archive_ledger(r: Run):
    return _backfilled(r).ledger.read(r.spark).select(_day_of().alias("source_file"), "run_date", "rows")


def q_archive_rows(r: Run):
    """The archive's content after days were run again."""
    paths = _backfilled(r)
    _again(r, paths)
    return P.archived_rows(r.spark, paths).withColumn("source_file", _day_of()).select(*RAW_REPORT_COLUMNS, "source_file")


def q_rerun_day(r: Run):
    """How many rows each table, zone and archive holds after days were run again."""
    paths = _backfilled(r)
    _again(r, paths)
    held = {name: t.read(r.spark) for name, t in (("staging", paths.staging), ("quarantine", paths.quarantine), ("fact", paths.fact),
                                                 ("unmapped", paths.unmapped), ("ledger", paths.ledger))}
    held["archive"] = P.archived_rows(r.spark, paths)
    held["zone"] = r.spark.read.parquet(f"{paths.base}/lake/lines")
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
                                          for name, df in held.items()])


def q_run_day(r: Run):
    paths = _backfilled(r, last=-2)
    P.run_day(r.spark, paths, _report_days(paths, r.spark)[-1] + _dt.timedelta(days=1), r.vocab, RUN_NOW, enforce=False)
    return paths.staging.read(r.spark).withColumn("source_file", _day_of()).select(*STAGING_FLAGGED.names)


def q_flow_quarantine(r: Run):
    return _backfilled(r).quarantine.read(r.spark).withColumn("source_file", _day_of()).select(*QUARANTINE.names)


def q_unmapped_incremental(r: Run):
    """The audit table after a run up to the middle day and one over the rest."""
    paths = _landed(r)
    middle = len(_report_days(paths, r.spark)) // 2
    _backfilled(r, 0, middle - 1, paths)
    _backfilled(r, middle, -1, paths)
    return paths.unmapped.read(r.spark)


def q_flow_merge(r: Run):
    """The flow's own merge, twice, with times that do not parse and null ones."""
    table = P.Paths(run_dir(r.spark, "merge")).staging
    order = F.col("order_id").cast("long")
    time = F.when(order % 17 == 0, F.lit("unknown")).when(order % 19 == 0, F.lit(None)).otherwise(F.col("payment_time"))
    rows = r.staging.withColumn("payment_time", time)
    P.merge(r.spark, table, rows.filter(order % 2 == 0))
    P.merge(r.spark, table, rows)
    P.merge(r.spark, table, rows)
    return table.read(r.spark)


def q_mixed_headers(r: Run):
    """Reports whose columns differ from file to file, read by name."""
    path = run_dir(r.spark, "mixed")
    raw = raw_report(r.spark, r.sf_dir)
    names = raw.columns[:8]
    part = F.pmod("row_idx", F.lit(3))
    for k, header in enumerate((names, names[::-1], [c for c in names if c != "GCash"])):
        (raw.filter(part == k).select(*[F.col(f"`{c}`").alias(f" {c} " if k == 1 else c) for c in header])
         .write.option("header", True).csv(f"{path}/part={k}"))
    return RP.read_report(r.spark, path).select(*RAW_REPORT_COLUMNS)


def q_gate_failures(r: Run):
    """The stored failing rows of a run that the fact checks stopped."""
    paths, run = _landed(r), P.new_run("gate")
    days = _report_days(paths, r.spark)
    P.ingest(r.spark, paths, RP.day_files(r.spark, paths.incoming, days[0], days[-1]), run, r.vocab, RUN_NOW, enforce=False)
    try:
        P.build_models(r.spark, paths, r.vocab, enforce=True, run=run)
    except C.CheckFailed:
        assert not paths.fact.exists(r.spark)
    schema = StructType([StructField("check_name", StringType()), *FACT.fields])  # a run without failures stores no file
    return r.spark.read.schema(schema).parquet(paths.audit("failures", run)).select(*schema.names)


def q_stream_incoming(r: Run):
    """The delivered daily files through the incoming-folder stream
    (availableNow): every file once, each micro-batch through the daily steps."""
    from tillstack.streaming.incoming import stream_incoming
    paths = _landed(r)
    stream_incoming(r.spark, paths, run_dir(r.spark, "stream-ck"), r.vocab, RUN_NOW,
                    enforce=False).awaitTermination()
    return paths.staging.read(r.spark).withColumn("source_file", _day_of()).select(*STAGING_FLAGGED.names)


SPARK: dict[str, Callable[[Run], DataFrame]] = {
    "normalize_headers": q_normalize_headers,
    "explode_items": q_explode_items,
    "drop_blank_items": q_drop_blank_items,
    "drop_footer": q_drop_footer,
    "extract_size": _extract("size", T.extract_size),
    "extract_variation": _extract("variation", T.extract_variation),
    "extract_flavor": _extract("flavor", T.extract_flavor),
    "extract_sugar": _extract("sugar_level", T.extract_sugar),
    "extract_spice": _extract("spice_level", T.extract_spice),
    "extract_quantity": _extract("quantity", T.extract_quantity),
    "composite_item": q_composite_item,
    "plain_item": q_plain_item,
    "title_case": q_title_case,
    "corrections": q_corrections,
    "parse_amount": q_parse_amount,
    "payment_type": q_payment_type,
    "categorize": q_categorize,
    "clean_lines": q_clean_lines,
    "dedup_first": q_dedup_first,
    "good_rows": q_good_rows,
    "quarantine_rows": q_quarantine_rows,
    "ingest_counts": q_ingest_counts,
    "dim_product": q_dim_product,
    "dim_date": q_dim_date,
    "dim_flavor": q_dim_flavor,
    "dim_sugar": q_dim_sugar,
    "dim_spice": q_dim_spice,
    "dim_payment": q_dim_payment,
    "dim_order": q_dim_order,
    "dim_date_holidays": q_dim_date_holidays,
    "dim_product_file": q_dim_product_file,
    "dim_registry": q_dim_registry,
    "fact_full": q_fact_full,
    "fact_incremental": q_fact_incremental,
    "fact_reprocessed": q_fact_reprocessed,
    "unmapped_rows": q_unmapped_rows,
    "merge_insert": q_merge_insert,
    "merge_rerun": q_merge_rerun,
    "merge_quarantine": q_merge_quarantine,
    "load_fixed": q_load_fixed,
    "delete_fixed": q_delete_fixed,
    "reset_flag": q_reset_flag,
    "recover_int": q_recover_int,
    "recover_str": q_recover_str,
    "recover_quarantine": q_recover_quarantine,
    "recover_failed": q_recover_failed,
    "chk_not_null": q_chk_not_null,
    "chk_unique": q_chk_unique,
    "chk_accepted": q_chk_accepted,
    "chk_unique_combo": q_chk_unique_combo,
    "chk_expression": q_chk_expression,
    "chk_summary": q_chk_summary,
    "chk_failures": q_chk_failures,
    "rpt_daily": q_rpt_daily,
    "rpt_monthly": q_rpt_monthly,
    "rpt_category": q_rpt_category,
    "rpt_category_totals": q_rpt_category_totals,
    "rpt_payment": q_rpt_payment,
    "rpt_order_type": q_rpt_order_type,
    "rpt_product": q_rpt_product,
    "sink_roundtrip": q_sink_roundtrip,
    "append_merge_schema": q_append_merge_schema,
    "partitioned_fact": q_partitioned_fact,
    "archive_ledger": q_archive_ledger,
    "archive_rows": q_archive_rows,
    "rerun_day": q_rerun_day,
    "flow_quarantine": q_flow_quarantine,
    "unmapped_incremental": q_unmapped_incremental,
    "flow_merge": q_flow_merge,
    "mixed_headers": q_mixed_headers,
    "gate_failures": q_gate_failures,
    "late_days": q_late_days,
    "late_strict": q_late_strict,
    "gate_history": q_gate_history,
    "run_day": q_run_day,
    "run_range": q_run_range,
    "stream_incoming": q_stream_incoming,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, sf_dir: fn(Run(spark, sf_dir))
    return {name: bind(fn) for name, fn in SPARK.items()}
