"""Sinks and table storage (SNK1-14, SRC6-7).

Tables live as Parquet under a base folder on shared storage.  A table is a
sequence of batches, folders ``batch=<number>-<kind>``:

- ``add``: rows that are appended;
- ``days``: the whole new content of some day partitions.  A day that such a batch
  holds is no longer read from the batches before it; the files of all other days
  stay as they are and where they are;
- ``all``: the whole new content of the table.

A write goes to a folder that readers pass over and is published by renaming that
folder, once, after it has ended.  So a stop at any moment shows all of a batch or
nothing of it, and a path that is being read never changes.  (One writer at a time;
an object store needs a committer whose rename is atomic.)  Every write reads its
result back from storage, which also cuts the lineage for later steps.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tillstack.schemas import conform

BATCH = "batch"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # how Spark names the folder of null


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def _any(spark: SparkSession, glob: str) -> bool:
    fs, p = _fs(spark, glob)
    return len(fs.globStatus(p) or []) > 0


def day_of(col: str = "payment_time"):
    """The day partition of a delivered text time; what does not parse has none."""
    return F.to_date(F.col(col).cast("string").try_cast("timestamp_ntz"))


#: ``day_of`` of the payment time, in SQL.
DAY_SQL = "to_date(try_cast(CAST(payment_time AS STRING) AS TIMESTAMP_NTZ))"


def in_days(days, day: str = "sale_date"):
    """Whether ``day`` (a column or SQL expression) is one of ``days``; None is the null
    partition.  One expression: thousands of literals made one by one take seconds."""
    days = list(days)
    known = ", ".join(f"DATE'{d.isoformat()}'" for d in days if d is not None)
    hit = f"coalesce({day} IN ({known}), false)" if known else "false"
    return F.expr(f"{hit} OR {day} IS NULL" if None in days else hit)


@dataclass(frozen=True)
class Table:
    """A Parquet table at ``path`` with a fixed schema; see the module's notes.
    ``bloom``: columns whose files carry Bloom filters (SNK11)."""

    path: str
    schema: StructType
    partition_by: tuple = ()
    bloom: tuple = ()

    def batches(self, spark: SparkSession) -> list[str]:
        """The published batches that still count, oldest first."""
        names = [d.split("=", 1)[1] for d in list_dirs(spark, self.path) if d.startswith(f"{BATCH}=")]
        whole = [i for i, n in enumerate(names) if n.endswith("-all")]
        return names[whole[-1]:] if whole else names

    def _dir(self, name: str) -> str:
        return f"{self.path}/{BATCH}={name}"

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.batches(spark))

    def _days(self, spark: SparkSession, name: str) -> list:
        """The days of a batch: its folders' names, no file is opened."""
        found = [d.split("=", 1)[1] for d in list_dirs(spark, self._dir(name)) if "=" in d]
        return [None if d == NO_DAY else _dt.date.fromisoformat(d) for d in found]

    def days(self, spark: SparkSession) -> set:
        """The days that have a folder in some batch that counts."""
        return {d for n in self.batches(spark) for d in self._days(spark, n)}

    def nothing(self, spark: SparkSession) -> DataFrame:
        """The table without rows, by a plan that the planner takes out of joins and unions."""
        schema = StructType([*self.schema.fields, *(StructField(c, DateType()) for c in self.partition_by)])
        return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def read(self, spark: SparkSession) -> DataFrame:
        """SRC6: the current content (empty with the schema if there is none yet);
        the partition column (``sale_date``) comes last."""
        names = self.batches(spark)
        schema = StructType([*self.schema.fields, *(StructField(c, DateType()) for c in self.partition_by)])
        filled = [n for n in names if not self.partition_by or _any(spark, f"{self._dir(n)}/*=*")]
        if not filled:
            return self.nothing(spark)
        out = (spark.read.schema(StructType([*schema.fields, StructField(BATCH, StringType())])).option("basePath", self.path)
               .parquet(*[self._dir(n) for n in filled]))
        for name in names:
            if name.endswith("-days"):  # partition values only: superseded files are pruned, not read
                out = out.filter(~((F.col(BATCH) < name) & in_days(self._days(spark, name))))
        return out.select(*schema.names)

    def append(self, spark: SparkSession, df: DataFrame, placed: bool = False) -> int:
        """SNK6/SNK9/SNK12: append rows; returns their number (SNK14, measured on
        the write itself).  Without rows nothing is published.  ``placed``: the rows
        of a day partition are in one task already, or in a few of its own."""
        return self._publish(spark, df, "add", placed=placed)

    def replace(self, spark: SparkSession, df: DataFrame) -> int:
        """SNK8: ``df`` is the table's content from now on."""
        return self._publish(spark, df, "all")

    def replace_days(self, spark: SparkSession, df: DataFrame, days, placed: bool = False) -> int:
        """SNK10: the rows of ``df`` in the day partitions ``days`` are these days'
        content from now on (a day without rows becomes empty); the files of other
        days stay untouched.  ``placed``: see ``append``."""
        days = list(days)
        return self._publish(spark, df.filter(in_days(days, DAY_SQL)), "days", days, placed) if days else 0

    def _publish(self, spark: SparkSession, df: DataFrame, kind: str, days=(), placed: bool = False) -> int:
        work = f"{self.path}/_writing-{uuid.uuid4().hex[:12]}"
        rows = self.write_aside(spark, df, work, placed)
        there = set(list_dirs(spark, work)) if days else ()
        fs, _ = _fs(spark, work)
        for name in (f"sale_date={NO_DAY if d is None else d.isoformat()}" for d in days):
            if name not in there:
                fs.mkdirs(_fs(spark, f"{work}/{name}")[1])
        if kind != "add" or rows:
            self.publish(spark, work, kind)
        else:
            fs.delete(_fs(spark, work)[1], True)
        return rows

    def write_aside(self, spark: SparkSession, df: DataFrame, work: str, placed: bool = False) -> int:
        """Write rows to a folder as the table holds them, for ``publish``."""
        return _write_counted(self._prepare(df, placed), work, "errorifexists", self.partition_by, self.bloom)

    def publish(self, spark: SparkSession, work: str, kind: str = "add") -> None:
        """Make the rows of ``write_aside`` a batch of the table, by one rename."""
        fs, at = _fs(spark, work)
        fs.mkdirs(_fs(spark, self.path)[1])
        taken = [int(d.split("=", 1)[1].split("-")[0]) for d in list_dirs(spark, self.path) if d.startswith(f"{BATCH}=")]
        if not fs.rename(at, _fs(spark, self._dir(f"{max(taken, default=0) + 1:08d}-{kind}"))[1]):
            raise RuntimeError(f"the batch at {work} could not be published")

    def _prepare(self, df: DataFrame, placed: bool = False) -> DataFrame:
        out = conform(df, self.schema)
        if self.partition_by:
            # SNK10/SNK11: range-partition on (day, category, sub-category,
            # order) with an explicit partition count: quiet days are packed
            # into one task, a hot day is cut across several by the secondary
            # keys (sampled boundaries), AQE does not collapse the writers,
            # and files come out clustered by category so Parquet min/max
            # statistics skip row groups.
            # staging keeps the delivered text time; a value that does not
            # parse lands in the null partition instead of failing the load
            out = out.withColumn("sale_date", day_of())
            if not placed:
                n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
                out = out.repartitionByRange(n, "sale_date", "category", "sub_category", "order_id")
            out = out.sortWithinPartitions("sale_date", "category", "sub_category")
        return out


def _write_counted(df: DataFrame, path: str, mode: str, partition_by=(), bloom=()) -> int:
    """Write and report the row count from an observed metric of the write
    itself (no second pass over the data)."""
    return write_observed(df, path, mode, partition_by, {"rows": F.count(F.lit(1))}, bloom)["rows"]


def write_clustered(df: DataFrame, path: str, by, metrics: dict, tasks: int, partition_by=(), folders: int = 1) -> tuple[DataFrame, str, dict]:
    """Write a zone whose rows lie in ``tasks`` tasks by a hash of the columns ``by``, and read it
    back so that Spark knows it: an aggregate whose keys hold ``by`` needs no shuffle
    then.  Buckets, which only tables have: returns the rows, the name of an external
    table, which the caller drops (its files stay), and the observed metrics."""
    spark, name = df.sparkSession, f"tillstack_zone_{uuid.uuid4().hex}"
    df = df.select(*[F.col(f"`{c}`") for c in [*[c for c in df.columns if c not in partition_by], *partition_by]])
    remove(spark, path)  # of a stopped run of this name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    parts = f"PARTITIONED BY ({', '.join(partition_by)}) " if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {parts}CLUSTERED BY ({', '.join(by)}) INTO {tasks} BUCKETS LOCATION '{path}'")
    seen = write_observed(df, name, "append", (), metrics, folders=folders, table=True)
    return spark.table(name), name, seen


def write_observed(df: DataFrame, path: str, mode: str, partition_by, metrics: dict, bloom=(), folders: int = 0, table: bool = False) -> dict:
    """Write ``df`` and return named metrics (AGG2) that were observed on the rows
    as they were written.  ``folders``: how many partition folders there are, if a task
    can keep a file open in each of them, so that the rows need no sort.  ``table``:
    ``path`` is the name of a table with the columns of ``df``."""
    seen = Observation("written")
    w = df.observe(seen, *[m.cast("bigint").alias(name) for name, m in metrics.items()]).write.mode(mode)
    # tasks move their own files: a folder counts as a whole when it is published or its flow goes on
    w = w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    for c in bloom:  # sized by the values that a row group has, not by the largest size
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FILES)
    conf.set(OPEN_FILES, str(folders))
    try:
        if table:
            w.insertInto(path)
        else:
            w.parquet(path)
    finally:
        conf.set(OPEN_FILES, before)
    return {name: int(seen.get.get(name) or 0) for name in metrics}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(), folders: int = 0) -> int:
    """SNK1/SNK2/SNK3/SNK7: write a zone or archive path; returns rows."""
    return write_observed(df, path, mode, partition_by, {"rows": F.count(F.lit(1))}, folders=folders)["rows"]


def land_reports(report: DataFrame, incoming: str, date_col: str = "report_date") -> None:
    """Write reports as daily CSV files ``incoming/report_date=YYYY-MM-DD/``
    (one file per day, rows in file order) — the delivered form the daily
    run reads with ``read_day``."""
    # a number of its own: by their size the rows would be joined into few tasks, while a
    # day's cost is that of its file
    n = int(report.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (report.repartition(n, date_col).sortWithinPartitions(date_col, "row_idx", "row_part")
     .drop("row_idx", "row_part", "source_file")
     .write.mode("overwrite").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .partitionBy(date_col).csv(incoming))
