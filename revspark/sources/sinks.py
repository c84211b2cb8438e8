"""Sinks: full-refresh tables, views and CSV exports (SRC-06, SNK-01..03).

A refreshed table is a folder of versions. A refresh writes a new version beside the
others and counts only once Spark has committed it (its success marker is there); readers
take the newest committed version. A refresh that fails half way changes nothing, and a
reader that is still at work keeps the version it has: the one before the newest is
removed by the refresh after.
"""

from __future__ import annotations

import hashlib
import os
import re
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from revspark.session import scratch_path

# Independent tables are written by this many concurrent Spark jobs (the
# modelled project runs four models at a time).
DEFAULT_THREADS = 4

_VERSION = re.compile(r"v\d{8}-[0-9a-f]{8}")


def run_concurrently(tasks: Iterable[Callable[[], object]], threads: int = DEFAULT_THREADS) -> list:
    """Run independent Spark actions from a small thread pool; results in order.

    Each task submits its own job(s); the scheduler interleaves their tasks
    on the executors, so many small tables do not wait on one another.
    """
    tasks = list(tasks)
    if threads <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full-refresh Parquet table (WRITE_TRUNCATE semantics)."""
    if partition_by:
        # rows of a directory meet first (AQE splits a hot one), so that tasks do not
        # each write a file to every directory
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


KEPT_VERSIONS = 2


def _versions(spark: SparkSession, path: str) -> tuple[object, list[tuple[str, bool]]]:
    """The file system of ``path`` and its version folders in order, with whether each is committed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return fs, []
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    return fs, [(n, fs.exists(hadoop.Path(f"{path}/{n}/_SUCCESS"))) for n in names if _VERSION.fullmatch(n)]


def current(spark: SparkSession, path: str) -> str:
    """The folder to read of a published table: its newest committed version."""
    _, found = _versions(spark, path.rstrip("/"))
    done = [n for n, committed in found if committed]
    if found and not done:
        raise FileNotFoundError(f"no refresh of {path} has been committed yet")
    return f"{path.rstrip('/')}/{done[-1]}" if done else path


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """SRC-06 / SNK-02: refresh the table at ``path`` as a whole, or not at all.

    Returns the folder of the new version. Of the versions before it the newest committed
    one stays for readers at work; older ones and failed attempts are removed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    fs, found = _versions(spark, path)
    last = int(found[-1][0][1:9]) if found else 0
    name = f"v{last + 1:08d}-{uuid.uuid4().hex[:8]}"
    write_table(df, f"{path}/{name}", partition_by)
    kept = [n for n, committed in found if committed][-(KEPT_VERSIONS - 1):]
    for old, _ in found:
        if old not in kept:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}"), True)
    return f"{path}/{name}"


def publish_table(df: DataFrame, table: str, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """``publish``, and the catalog's ``table`` moved to the new version once it is there."""
    spark = df.sparkSession
    folder = publish(df, path, partition_by)
    same = spark.catalog.tableExists(table) and set(spark.table(table).schema.simpleString()[7:-1].split(",")) == set(
        df.schema.simpleString()[7:-1].split(","))
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")      # the table is external: its files stay
        spark.catalog.createTable(table, path=folder, source="parquet", schema=None if partition_by else df.schema)
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def register_views(models: dict[str, DataFrame]) -> None:
    """SNK-01: lazy models become temp views, recomputed on each use."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def write_marts(spark: SparkSession, models: dict[str, DataFrame], root: str,
                threads: int = DEFAULT_THREADS,
                partitions: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """SNK-02: materialise each model as a table and return readers of the written data.

    ``partitions`` names partition columns per model (directory partitioning,
    so filters on them prune files); readers keep the model's column order.
    """
    partitions = partitions or {}
    paths = {name: os.path.join(root, name) for name in models}
    folders = run_concurrently([lambda n=n, df=df: publish(df, paths[n], partitions.get(n))
                                for n, df in models.items()], threads)
    return {name: spark.read.schema(df.schema).parquet(folder).select(*df.columns)
            for (name, df), folder in zip(models.items(), folders)}


def export_csv(df: DataFrame, path: str) -> None:
    """SNK-03: CSV with a header row, no index column."""
    (df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
       .option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(path))


# (application, namespace, table) -> (folder of the written table, its schema)
_LANDED: dict[tuple[str, str, str], tuple[str, object]] = {}
_LOCKS: defaultdict[tuple[str, str, str], threading.Lock] = defaultdict(threading.Lock)
_REGISTRY_LOCK = threading.Lock()
_RUN = uuid.uuid4().hex[:12]


def land_once(spark: SparkSession, namespace: str, name: str, build: Callable[[], DataFrame],
              partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``build()`` once per application under the shared checkpoint folder
    and return a reader of the written table.

    Concurrent callers of the same table wait for one writer; different tables
    are written concurrently. The written files, not the lineage, are what
    later queries read (and what a lost executor recomputes from).
    """
    key = (spark.sparkContext.applicationId, namespace, "/".join([name, *partition_by]))
    with _REGISTRY_LOCK:
        lock = _LOCKS[key]
    with lock:
        if key not in _LANDED:
            df = build()
            folder = hashlib.sha256("\0".join(key).encode()).hexdigest()[:24]
            path = scratch_path(spark, f"tables-{_RUN}/{folder}/{name}")
            write_table(df, path, list(partition_by))
            _LANDED[key] = (path, df.schema)
    path, schema = _LANDED[key]
    return spark.read.schema(schema).parquet(path).select(*schema.names)
