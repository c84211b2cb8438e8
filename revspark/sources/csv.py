"""CSV ingestion with declared schemas (SRC-01, -02, -03, -05, -07).

Files are read as text with the header row, missing-value tokens become NULL,
DATE columns are parsed leniently (unparseable -> NULL) and the other columns
are cast to their declared types. A missing file is reported, not fatal.

Nothing is lost in silence. A record with fewer fields than its header is loaded, its
missing fields NULL; one with more fields, or with a quote that is never closed, is
set aside with its text. ``ingest`` counts all three, and per column the values that
were there but could not be converted, while it writes the table.
"""

from __future__ import annotations

import csv
import os
from functools import reduce
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revspark.sources.schemas import TABLES, TableSpec

# The strings pandas' CSV reader treats as missing by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Date layouts accepted for DATE columns, tried in order.
DATE_FORMATS = ["yyyy-MM-dd", "yyyy/MM/dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd", "M-d-yyyy",
                "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d-MMM-yyyy",
                "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-M-d", "yyyy/M/d",
              "yyyy.M.d", "d.M.yyyy", "d/M/yyyy", "d-M-yyyy", "d-MMM-yy", "yyyyMMdd HHmmss"]

# Columns beside a table's own while its file is read (no header can hold a line break).
RECORD, REASON, LOST = "record\n", "reason\n", "lost\n"
SHORT, LONG, BROKEN = "short", "long", "broken"

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("n", T.LongType()),
])

AUDIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("status", T.StringType()),
])


def normalize_nulls(c: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """A missing-value token, exactly as listed, becomes NULL; other blanks are text."""
    return F.when(c.isin(*list(tokens)), F.lit(None).cast("string")).otherwise(c)


def coerce_date(c: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Parse with the first layout that fits, or as an ISO timestamp (with ``T``, fraction
    or zone); NULL when none does (errors='coerce')."""
    text = F.trim(c)
    return F.coalesce(*[F.try_to_date(text, f) for f in formats],
                      text.try_cast("timestamp_ntz").cast("date"))


def _typed(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return coerce_date(c)
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.LongType):
        # integers may be written as 12 or 12.0
        return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    return c.try_cast(dtype)


def headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Each distinct header line of the files under ``path`` and the files that begin with it.

    One job for any number of files: of the rows that start at a file's first byte block the
    first one is kept per file, combined before the shuffle.
    """
    lines = (spark.read.text(path)
             .select("value", "_metadata.file_path", "_metadata.file_block_start")
             .where((F.col("file_block_start") == 0) & (F.trim("value") != ""))
             .withColumn("place", F.monotonically_increasing_id()))
    first = lines.groupBy("file_path").agg(F.min_by("value", "place").alias("header"))
    grouped = first.groupBy("header").agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    # Spark tells a file's path percent-encoded
    return {r.header.lstrip("\ufeff").rstrip("\r"): [unquote(f) for f in r.files] for r in grouped.collect()}


def scan(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Every record of one table's CSV: its typed columns, RECORD and REASON (the text and what
    is wrong with it, where its number of fields is not its header's) and LOST (a flag for each
    converted column: a value was there and is NULL now)."""
    reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
              .option("multiLine", spec.multi_line).option("emptyValue", "").option("mode", "PERMISSIVE")
              .option("columnPruning", False).option("columnNameOfCorruptRecord", RECORD))
    found = headers(spark, path)
    parts = []
    for header, files in found.items():
        names = next(csv.reader([header]))
        fields = [T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]
        text = reader.schema(T.StructType([*fields, T.StructField(RECORD, T.StringType())]))
        parts.append(_declared(text.csv(path if len(found) == 1 else files), names, spec))
    return reduce(DataFrame.union, parts) if parts else _declared(
        spark.createDataFrame([], f"`{RECORD}` string"), [], spec)


def _declared(text: DataFrame, names: list[str], spec: TableSpec) -> DataFrame:
    """The declared columns of files with one header."""
    place = {n: f"c{i}" for i, n in reversed(list(enumerate(names)))}
    given = {f.name: normalize_nulls(F.col(place[f.name])) if f.name in place else F.lit(None).cast("string")
             for f in spec.schema.fields}
    record = F.col(f"`{RECORD}`")
    # a record of another width: unclosed quote, or one field more than separators outside quotes
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    bare = F.regexp_replace(record, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    reason = F.when(record.isNull(), None).when(quotes % 2 == 1, BROKEN).when(
        fields > len(names), LONG).when(fields < len(names), SHORT)
    told = text.select(*[given[f.name].alias(f"t{i}") for i, f in enumerate(spec.schema.fields)],
                       reason.alias(REASON), F.rtrim(record, F.lit("\r\n")).alias(RECORD))
    typed = told.select("*", *[_typed(F.col(f"t{i}"), f.dataType).alias(f.name)
                               for i, f in enumerate(spec.schema.fields)])
    lost = [(F.col(f"t{i}").isNotNull() & F.col(f.name).isNull()).alias(f.name)
            for i, f in enumerate(spec.schema.fields) if f.name in _converted(spec)]
    return typed.select(*spec.schema.names, F.when(F.col(f"`{REASON}`").isNotNull(), F.col(f"`{RECORD}`")).alias(RECORD),
                        f"`{REASON}`", (F.struct(*lost) if lost else F.lit(None)).alias(LOST))


def _converted(spec: TableSpec) -> list[str]:
    return [f.name for f in spec.schema.fields if not isinstance(f.dataType, T.StringType)]


def _accepted() -> Column:
    reason = F.col(f"`{REASON}`")
    return reason.isNull() | (reason == SHORT)


def read_raw(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """SRC-01: read one table's CSV with its declared schema.

    Quoted fields may hold commas, doubled quotes, backslashes and (in a multi-line table)
    line breaks. Columns are matched by header name, in each file of a folder by its own
    header; declared columns absent from a file are NULL, extra columns are ignored.
    Records with too many fields or an unclosed quote are left out (``rejected`` has them).
    """
    return scan(spark, path, spec).where(_accepted()).select(*spec.schema.names)


def rejected(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """(first column, reason, record): what could be read of the first column and the text of every
    record whose number of fields is not its header's; the short ones are loaded all the same."""
    return scan(spark, path, spec).where(F.col(f"`{REASON}`").isNotNull()).select(
        spec.schema.names[0], F.col(f"`{REASON}`").alias("reason"), F.col(f"`{RECORD}`").alias("record"))


def _or_missing(build):
    try:
        df = build()
        df.schema  # noqa: B018  resolve now so a missing path surfaces here
        return df
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" in str(ex) or "Path does not exist" in str(ex):
            return None
        raise


def read_or_none(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame | None:
    """One table's CSV, or None when its file is missing."""
    return _or_missing(lambda: read_raw(spark, os.path.join(root, spec.file), spec))


def load_all(spark: SparkSession, root: str,
             tables: dict[str, TableSpec] = TABLES) -> dict[str, DataFrame | None]:
    """SRC-05: every registered table, or None when its file is missing."""
    return {name: read_or_none(spark, root, spec) for name, spec in tables.items()}


def ingest(spark: SparkSession, landing_root: str, warehouse_root: str,
           tables: dict[str, TableSpec] = TABLES, threads: int | None = None) -> DataFrame:
    """Load every CSV into a full-refresh Parquet table and audit it (SRC-06, SRC-07).

    All counts come from an ``Observation`` on the write itself, so the data is scanned
    once; independent tables load concurrently. Returns (table_name, source_system, rows,
    status) plus a TOTAL row; a missing file has status 'missing' and NULL rows. Beside the
    tables, ``_load_report`` holds (table_name, kind, column_name, n): records loaded, short,
    long and broken, and per column the values lost; ``_rejects/<table>`` holds the text of
    records of another width, where there are any.
    """
    from revspark.sources.sinks import DEFAULT_THREADS, publish, run_concurrently

    def load(name: str) -> tuple[tuple, list[tuple]]:
        spec = tables[name]
        path = os.path.join(landing_root, spec.file)
        df = _or_missing(lambda: scan(spark, path, spec))
        if df is None:
            return (name, spec.source_system, None, "missing"), []
        obs = Observation(f"load_{name}")
        reason, lost = F.col(f"`{REASON}`"), _converted(spec)
        observed = df.observe(
            obs, F.count_if(_accepted()).alias("rows"),
            *[F.count_if(reason == k).alias(k) for k in (SHORT, LONG, BROKEN)],
            *[F.count_if(_accepted() & F.col(f"`{LOST}`.`{c}`")).alias(f"lost {c}") for c in lost])
        publish(observed.where(_accepted()).select(*spec.schema.names), os.path.join(warehouse_root, name))
        n = obs.get
        if n[SHORT] or n[LONG] or n[BROKEN]:
            publish(rejected(spark, path, spec), os.path.join(warehouse_root, "_rejects", name))
        facts = [(name, "loaded", None, int(n["rows"]))]
        facts += [(name, k, None, int(n[k])) for k in (SHORT, LONG, BROKEN)]
        facts += [(name, "lost", c, int(n[f"lost {c}"])) for c in lost]
        return (name, spec.source_system, int(n["rows"]), "loaded"), facts

    done = run_concurrently([lambda n=n: load(n) for n in tables], threads or DEFAULT_THREADS)
    # load metadata, a few rows for each table, not data
    publish(spark.createDataFrame([f for _, facts in done for f in facts], REPORT_SCHEMA).coalesce(1),
            os.path.join(warehouse_root, "_load_report"))
    audit = [row for row, _ in done]
    audit.append(("TOTAL", None, sum(r[2] or 0 for r in audit), "loaded"))
    return spark.createDataFrame(audit, AUDIT_SCHEMA)


def load_report(spark: SparkSession, warehouse_root: str) -> DataFrame:
    """What the last ``ingest`` into this warehouse counted."""
    from revspark.sources.sinks import current
    return spark.read.schema(REPORT_SCHEMA).parquet(current(spark, os.path.join(warehouse_root, "_load_report")))
