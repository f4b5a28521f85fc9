"""Stored tables: typed scans, overwrites, and layouts that keep key lookups local."""

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.operators.ratings import upsert_ratings
from merchlens.session import read_stored  # noqa: F401  (callers take it from here)

# Folders of the ratings table, and of the table a stream appends small files to.
USER_BUCKETS = 256
STREAM_BUCKETS = 16


def read_table(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame:
    """Scan a parquet table; ``columns`` is a DDL list that prunes and casts."""
    df = spark.read.parquet(path)
    if columns is None:
        return df
    fields = spark.createDataFrame([], columns).schema.fields
    return df.select(*[F.col(f.name).cast(f.dataType) for f in fields])


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def overwrite(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace a table; with partition columns, few and even files per folder.

    The rebalance gathers each folder's rows and splits a folder that is far too big.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    even = df.hint("rebalance", *partition_by)
    even.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None):
    """Table bucketed and sorted on its lookup key: joins on the key need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


#: Keys that a lookup states as a filter of the scan; more are joined only.
LOOKUP_KEYS = 10_000


def save_sorted(df: DataFrame, path: str, key: str, files: int = 64, block_bytes: int = 8 << 20) -> None:
    """Replace a table by files of key ranges, sorted, with small row groups and a bloom
    filter of the key in each, so a lookup of a few keys reads a few row groups."""
    rows = df.repartitionByRange(files, key).sortWithinPartitions(key)
    writer = rows.write.mode("overwrite").option("parquet.block.size", block_bytes)
    writer.option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path)


def lookup(table: DataFrame, requests: DataFrame, key: str, most: int = LOOKUP_KEYS) -> DataFrame:
    """Rows of a stored table whose key some request has.

    Up to ``most`` distinct keys also become a filter of the scan, which passes over the row
    groups that cannot hold any of them.
    """
    wanted = requests.select(key).where(F.col(key).isNotNull()).distinct()
    some = [r[0] for r in wanted.limit(most + 1).collect()]
    rows = table.where(F.col(key).isin(some)) if len(some) <= most else table
    return rows.join(wanted, key, "left_semi")


def user_bucket(buckets: int = USER_BUCKETS):
    return F.pmod(F.hash(F.col("user_id").cast("int")), F.lit(buckets)).alias("user_bucket")


def with_user_bucket(df: DataFrame, buckets: int = USER_BUCKETS) -> DataFrame:
    return df.select("*", user_bucket(buckets))


def ratings_of(stored: DataFrame, users: DataFrame, buckets: int = USER_BUCKETS) -> DataFrame:
    """Stored ratings of the given users only.

    The users' bucket numbers (never more than ``buckets`` of them) become a plain
    partition filter, so a small batch reads a few folders of the table.
    """
    touched = [r[0] for r in users.select(user_bucket(buckets)).distinct().collect()]
    keys = users.select("user_id").distinct()
    return stored.where(F.col("user_bucket").isin(touched)).join(keys, "user_id", "left_semi")


class CachedTable:
    """A table kept on the executors by key and read again when it is too old.

    For joins of many small batches with one large table.
    """

    def __init__(self, load: Callable[[], DataFrame], key: str, max_age_seconds: float = 3600):
        self._load, self._key, self._max_age = load, key, max_age_seconds
        self._table, self._loaded_at = None, 0.0

    def __call__(self) -> DataFrame:
        if self._table is None or time.monotonic() - self._loaded_at > self._max_age:
            old = self._table
            fresh = self._load().repartition(self._key)
            self._table = fresh.persist(StorageLevel.MEMORY_AND_DISK)
            self._loaded_at = time.monotonic()
            if old is not None:
                old.unpersist()
        return self._table


def write_version(spark: SparkSession, root: str, **named: DataFrame) -> str:
    """Write tables that belong together under a new folder, then make it the current one.

    Readers find a whole version or the one before; a run that fails leaves no trace that
    they see. The pointer is one small row, appended last.
    """
    now = time.time()
    version = f"v{now:.6f}".replace(".", "_")
    for name, df in named.items():
        df.write.parquet(f"{root}/{version}/{name}")
    pointer = spark.createDataFrame([(version, now)], "version STRING, at DOUBLE").coalesce(1)
    pointer.write.mode("append").parquet(f"{root}/versions")
    return version


def current_version(spark: SparkSession, root: str) -> str:
    pointers = spark.read.schema("version STRING, at DOUBLE").parquet(f"{root}/versions")
    return pointers.agg(F.max_by("version", "at")).first()[0]


class CachedVersion:
    """Tables of one version, kept on the executors by key and always of the same version.

    ``fresh`` looks for a newer version once in ``max_age_seconds``; ``table`` does not,
    so all tables taken after one ``fresh`` belong together.
    """

    def __init__(self, spark, root: str, key: str, max_age_seconds: float = 3600, **columns: str):
        self._spark, self._root, self._key, self._columns = spark, root, key, columns
        self._max_age, self._looked_at = max_age_seconds, None
        self.version, self._tables = None, {}

    def fresh(self) -> None:
        now = time.monotonic()
        if self._looked_at is not None and now - self._looked_at <= self._max_age:
            return
        version = current_version(self._spark, self._root)
        self._looked_at = now
        if version == self.version:
            return
        old, self._tables, self.version = self._tables, {}, version
        for name, columns in self._columns.items():
            df = read_table(self._spark, f"{self._root}/{version}/{name}", columns or None)
            self._tables[name] = df.repartition(self._key).persist(StorageLevel.MEMORY_AND_DISK)
        for df in old.values():
            df.unpersist()

    def table(self, name: str) -> DataFrame:
        if self.version is None:
            self.fresh()
        return self._tables[name]


def drop_partitions_up_to(spark: SparkSession, path: str, column: str, last: int) -> list[int]:
    """Delete the folders ``column=n`` of a table with ``n`` up to ``last``."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for status in system.listStatus(root):
        name, _, value = status.getPath().getName().partition("=")
        if name == column and value.isdigit() and int(value) <= last:
            system.delete(status.getPath(), True)
            gone.append(int(value))
    return sorted(gone)


def merge_ratings(
    spark: SparkSession, path: str, updates: DataFrame, buckets: int = USER_BUCKETS, **options
) -> None:
    """Upsert a batch into a ratings table partitioned by ``user_bucket``.

    Only the partitions of the batch's users are read and replaced. Ratings that the
    batch does not touch stay as they are, repeated ones too.
    """
    touched = [r[0] for r in updates.select(user_bucket(buckets)).distinct().collect()]
    stored = spark.read.parquet(path).where(F.col("user_bucket").isin(touched))
    base, new = schemas.as_ratings(stored), schemas.as_ratings(updates)
    keys = new.select("user_id", "product_id").distinct()
    touched_rows = base.join(keys, ["user_id", "product_id"], "left_semi")
    rest = base.join(keys, ["user_id", "product_id"], "left_anti")
    merged = upsert_ratings(touched_rows, new, **options).unionByName(rest)
    (
        with_user_bucket(merged, buckets)
        .hint("rebalance", "user_bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("user_bucket")
        .parquet(path)
    )
