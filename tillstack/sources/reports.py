"""Report sources (SRC1-3, SRC6-7, PRJ3).

A delivered report is read all-string, headers are normalised, and every
row carries its lineage: ``source_file``, ``report_date`` and the file-order
columns ``row_idx`` / ``row_part`` that the footer drop and keep-first dedup use.

The files of a run are listed first, by day folder, so a run opens only its own
days.  A flow reads them once, into a columnar landing zone (``land_files``): the
lines of a CSV report as they are, with their place in the file.  Each file's header
and number of rows, the report rows and the archive come from there.  Files that
cannot be read to their end are left out whole and named; records that do not fit
their header are kept as far as they go, with their text in ``corrupt_record``.
Files are parsed by their own header: column names decide, not positions.
"""

from __future__ import annotations

import csv
import datetime as _dt
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from tillstack.functions.dates import report_date
from tillstack.schemas import RAW_REPORT_COLUMNS
from tillstack.sources.seeds import bounded_broadcast
from tillstack.sources.sinks import list_dirs, write_parquet

ORDER_COLS = ["row_idx", "row_part"]
REPORT_FILE_PREFIX = "report_date="
_DAY = r"report_date=([0-9]{4}-[0-9]{2}-[0-9]{2})"


def normalize_header(name: str) -> str:
    """SRC3: strip, spaces and hyphens to underscores, lower-case."""
    return name.strip().replace(" ", "_").replace("-", "_").lower()


def normalize_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_header(c) for c in df.columns])


def raw_schema() -> StructType:
    """Schema of a normalised report with lineage columns."""
    return StructType(
        [StructField(c, StringType(), True) for c in RAW_REPORT_COLUMNS]
        + [StructField("source_file", StringType(), True), StructField("report_date", DateType(), True),
           StructField("row_idx", LongType(), True), StructField("row_part", LongType(), True)]
    )


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], raw_schema())


# --- listing ---------------------------------------------------------------------

def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """All data files under folders, files or a glob, without opening any (many
    folders are listed by a job)."""
    if isinstance(path, str):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not (p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []):
            return []
        path = [path]
    found = spark.read.option("recursiveFileLookup", "true").text(path).inputFiles() if path else []
    return sorted({file_key(unquote(f)) for f in found})


def file_key(path: str) -> str:
    """One spelling of a file's name: ``file:/x`` and ``file:///x`` are the same."""
    return re.sub("^file:/+", "file:///", path)


def _file_name():
    """The current file's name as ``file_key`` spells it (Spark's own is URL-encoded)."""
    path = F.col("_metadata.file_path")
    plain = F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.regexp_replace(plain, "^file:/+", "file:///")


def day_path(incoming: str, day: _dt.date) -> str:
    return f"{incoming.rstrip('/')}/{REPORT_FILE_PREFIX}{day.isoformat()}"


def day_files(spark: SparkSession, incoming: str, first: _dt.date, last: _dt.date) -> list[str]:
    """SRC1 / FLW2: the files in the day folders from ``first`` to ``last``; other
    folders are not listed further, their files never opened."""
    if first == last:
        return list_files(spark, day_path(incoming, first))
    days = [d.removeprefix(REPORT_FILE_PREFIX) for d in list_dirs(spark, incoming) if d.startswith(REPORT_FILE_PREFIX)]
    return list_files(spark, [f"{incoming.rstrip('/')}/{REPORT_FILE_PREFIX}{d}" for d in days if first.isoformat() <= d <= last.isoformat()])


# --- scanning --------------------------------------------------------------------

@dataclass
class Scan:
    """What one pass over delivered files found: each file's header (CSV) and
    number of rows, and the files that cannot be read."""

    rows: dict[str, int] = field(default_factory=dict)
    headers: dict[str, tuple] = field(default_factory=dict)
    heads: dict[str, tuple] = field(default_factory=dict)  # where a text file's header is
    unreadable: list[str] = field(default_factory=list)


def _failed_file(error: Exception, files: list[str]) -> str | None:
    """The file that a failed read names."""
    text = str(error)
    named = [f for f in files if re.sub("^file:/+", "/", f) in text]
    return max(named, key=len, default=None)  # a longer name may begin with a shorter one


def _without_unreadable(files: list[str], unreadable: list[str], read: Callable[[list[str]], object]):
    """``read`` the files that can be read; one that fails is named and the others
    are read again.  An error that names no file is raised."""
    left = list(files)
    while left:
        try:
            return read(left)
        except (PySparkException, Py4JJavaError) as e:
            bad = _failed_file(e, left)
            if bad is None:
                raise
            unreadable.append(bad)
            left.remove(bad)
    return None


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """The lines of text files with their file and place: the split's start, and the
    id that Spark gives in read order (splits of one file are read in offset order)."""
    return spark.read.text(files).select(_file_name().alias("source_file"), F.col("_metadata.file_block_start").alias("row_idx"),
                                         F.monotonically_increasing_id().alias("row_part"), "value")


def _filled(lines: DataFrame) -> DataFrame:
    """Lines with a sign beyond blanks and controls: the others are no records."""
    return lines.filter(F.col("value").rlike(r"[^\x00-\x20]"))


def _count_lines(lines: DataFrame, found: Scan) -> None:
    got = _filled(lines).groupBy("source_file").agg(F.min(F.struct("row_idx", "row_part", "value")).alias("first"),
                                                    F.count(F.lit(1)).alias("n")).collect()  # a row a file
    found.rows = {r.source_file: r.n - 1 for r in got}
    found.headers = {r.source_file: tuple(next(csv.reader([r.first.value.removeprefix("\ufeff")]))) for r in got}
    found.heads = {r.source_file: (r.first.row_idx, r.first.row_part) for r in got}


def _count_rows(rows: DataFrame, found: Scan, name) -> None:
    found.rows = {r.f: r.n for r in rows.groupBy(name.alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()}


def scan_files(spark: SparkSession, files: list[str], fmt: str = "csv") -> Scan:
    """One pass over ``files``: their headers and numbers of rows."""
    found = Scan()

    def read(left: list[str]) -> None:
        if fmt == "csv":
            _count_lines(_lines(spark, left), found)
        else:
            _count_rows(spark.read.option("mergeSchema", "true").format(fmt).load(left), found, _file_name())

    _without_unreadable(files, found.unreadable, read)
    return found


# --- reading ---------------------------------------------------------------------

def _lineage(df: DataFrame, row_idx, row_part) -> DataFrame:
    data = [c for c in df.columns if normalize_header(c) not in ("source_file", "report_date", *ORDER_COLS)]
    path = _file_name()
    out = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in data], path.alias("source_file"),
                    F.regexp_extract(path, _DAY, 1).try_cast("date").alias("report_date"),
                    row_idx.alias("row_idx"), row_part.alias("row_part"))
    return normalize_headers(out)


def read_files(spark: SparkSession, files: list[str], scan: Scan, fmt: str = "csv", multiline: bool = False) -> DataFrame:
    """SRC2/SRC7: the rows of scanned files with lineage.

    CSV files are read by their own header, all files of one header together;
    a column that a file lacks is null there.  File order comes from
    ``_metadata.row_index`` for Parquet; CSV has none, so it is the split start
    plus the id Spark assigns in read order (splits of one file are read in
    offset order).  Single-line CSV is split by byte range, so a very large file
    is read by many tasks; ``multiline`` (quoted newlines) makes files unsplittable.
    """
    files = [f for f in files if scan.rows.get(f) is not None]
    if not files:
        return empty_report(spark)
    if fmt == "parquet":
        df = spark.read.option("mergeSchema", "true").parquet(*files)
        return _lineage(df, F.col("_metadata.row_index"), F.lit(0).cast("long"))
    if fmt != "csv":
        raise ValueError(f"unsupported report format: {fmt}")
    parts = []
    for header in sorted({scan.headers[f] for f in files}):
        schema = StructType([StructField(name, StringType()) for name in (*header, CORRUPT)])
        df = (spark.read.schema(schema).option("header", True).option("multiLine", multiline).option("columnNameOfCorruptRecord", CORRUPT)
              .csv([f for f in files if scan.headers[f] == header]))
        parts.append(_lineage(df, F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_report(spark: SparkSession, path: str, fmt: str = "csv", multiline: bool = False) -> DataFrame:
    """The report file(s) under ``path``; a file that cannot be read is an error."""
    files = list_files(spark, path)
    scan = scan_files(spark, files, fmt)
    if scan.unreadable:
        raise OSError(f"unreadable report files: {', '.join(scan.unreadable)}")
    return read_files(spark, files, scan, fmt, multiline)


def read_day(spark: SparkSession, incoming: str, ds, fmt: str = "csv", multiline: bool = False) -> DataFrame:
    """SRC1: the report for ``ds − 1 day``; no file ⇒ an empty report."""
    day = report_date(ds)
    files = day_files(spark, incoming, day, day)
    scan = scan_files(spark, files, fmt)
    if scan.unreadable:
        raise OSError(f"unreadable report files: {', '.join(scan.unreadable)}")
    return read_files(spark, files, scan, fmt, multiline)


# --- landing ---------------------------------------------------------------------

CORRUPT = "corrupt_record"


def land_files(spark: SparkSession, files: list[str], path: str, fmt: str = "csv", multiline: bool = False) -> Scan:
    """SRC2/SNK7: read the files once and write them to ``path`` as Parquet.

    Single-line CSV lands as its lines, untouched; ``multiline`` CSV (quoted line ends)
    and Parquet land as records under their own column names, all text, with
    ``corrupt_record``.  What is counted afterwards comes from the landing zone."""
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported report format: {fmt}")
    found = Scan()
    heads = Scan()
    if fmt == "csv" and multiline:  # a record's columns must be known before it can be told from the next
        heads = scan_files(spark, files, fmt)
        found.unreadable += heads.unreadable
        files = [f for f in files if f in heads.rows]
        heads.rows = {f: 0 for f in files}

    def read(left: list[str]) -> int:
        if fmt == "csv" and not multiline:
            rows = _lines(spark, left)
        else:
            rows = read_files(spark, left, heads if multiline else Scan({f: 0 for f in left}), fmt, multiline)
        return write_parquet(rows, path)

    written = _without_unreadable(files, found.unreadable, read)
    if written is None:
        return found
    landed = spark.read.parquet(path)
    found.rows, found.headers, found.heads = (x := landed_scan(spark, path)).rows, x.headers, x.heads
    for f in files:  # readable files without a row
        if f not in found.unreadable:
            found.rows.setdefault(f, 0)
    if landed.count() != written:
        raise RuntimeError(f"the landing zone {path} does not hold the {written} lines that were read")
    return found


def landed_scan(spark: SparkSession, path: str) -> Scan:
    """What a landing zone holds of each file."""
    landed, found = spark.read.parquet(path), Scan()
    if "value" in landed.columns:
        _count_lines(landed, found)
    else:
        _count_rows(landed, found, F.col("source_file"))
    return found


def landed_report(spark: SparkSession, path: str, scan: Scan) -> DataFrame:
    """The report rows of a landing zone, with lineage and ``corrupt_record``."""
    landed = spark.read.parquet(path)
    if "value" not in landed.columns:
        return landed if CORRUPT in landed.columns else landed.withColumn(CORRUPT, F.lit(None).cast("string"))
    if not scan.heads:
        return empty_report(spark).withColumn(CORRUPT, F.lit(None).cast("string"))
    names = sorted(set(scan.headers.values()))
    heads = spark.createDataFrame([(f, *scan.heads[f], names.index(scan.headers[f])) for f in scan.heads],
                                  "source_file string, h_idx long, h_part long, header int")
    lines = (_filled(landed).join(bounded_broadcast(heads, len(scan.heads)), "source_file")
             .filter((F.col("row_idx") != F.col("h_idx")) | (F.col("row_part") != F.col("h_part"))))
    parts = []
    for number, header in enumerate(names):
        cells = lines.filter(F.col("header") == number).select(
            "source_file", "row_idx", "row_part",
            F.from_csv("value", ", ".join(f"`{c}` string" for c in (*header, CORRUPT)), {"columnNameOfCorruptRecord": CORRUPT}).alias("r"))
        data = [c for c in header if normalize_header(c) not in ("source_file", "report_date", *ORDER_COLS)]
        parts.append(normalize_headers(cells.select(
            *[F.col(f"r.`{c}`").alias(c) for c in data], "source_file",
            F.regexp_extract("source_file", _DAY, 1).try_cast("date").alias("report_date"), "row_idx", "row_part",
            F.col(f"r.{CORRUPT}").alias(CORRUPT))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

