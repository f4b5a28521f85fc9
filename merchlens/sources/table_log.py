"""Tables whose folders are listed in a log, so that readers see one state and only that.

A commit names, for some keys, the folder that holds their rows from now on (or that there
are none), and what it was made from. The state of a table is the newest folder of every
key. Old folders stay until ``drop_retired``, so a reader that has begun is not disturbed,
and a source that was taken once is not taken again. One writer at a time.
"""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens import schemas
from merchlens.operators.ratings import upsert_ratings
from merchlens.session import read_stored
from merchlens.sources.tables import USER_BUCKETS, user_bucket, with_user_bucket

LOG = "seq BIGINT, key STRING, folder STRING, source STRING"


def _hadoop(spark: SparkSession, path: str):
    """A path of the table's store and the file system it is in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


class TableLog:
    """A logged table below ``root``; its data folders are ``data/v=<commit>/…``."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def commits(self) -> DataFrame:
        """All rows of the log; none before the first commit."""
        where, system = _hadoop(self.spark, f"{self.root}/log")
        if not system.exists(where):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log")

    def last(self) -> int:
        """Number of the last commit, 0 before the first."""
        return self.commits().agg(F.max("seq")).first()[0] or 0

    def state(self) -> DataFrame:
        """``key, folder``: the newest folder of every key that has rows."""
        newest = self.commits().groupBy("key").agg(F.max_by("folder", "seq").alias("folder"))
        return newest.where("folder IS NOT NULL")

    def has(self, source: str) -> bool:
        """Whether a commit was made from the source."""
        return bool(self.commits().where(F.col("source") == source).limit(1).count())

    def commit(self, seq: int, folders: dict[str, str | None], source: str = "") -> None:
        """Make folders the state of their keys, all at once: one file appears."""
        rows = [(seq, key, folder, source) for key, folder in folders.items()] or [(seq, "", None, source)]
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def read(self, keys: Iterable[str] | None = None) -> DataFrame:
        """The table's rows, or those of some keys; folder names below a commit are columns."""
        state = self.state()
        if keys is not None:
            state = state.where(F.col("key").isin(list(keys)))
        version = F.regexp_extract("folder", r"^data/v=\d+", 0).alias("version")
        live = state.groupBy(version).agg(F.collect_set("folder").alias("folders"))
        made = self.commits().where("folder IS NOT NULL").groupBy(version).agg(
            F.count_distinct("folder").alias("made")
        )
        # Of a commit that is still wholly in use one folder is listed instead of all.
        paths = [
            path
            for r in live.join(made, "version").collect()
            for path in ([r["version"]] if len(r["folders"]) == r["made"] else r["folders"])
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(f"{self.schema}, v INT").option("basePath", f"{self.root}/data")
        return reader.parquet(*[f"{self.root}/{path}" for path in sorted(paths)]).drop("v")

    def drop_retired(self, keep: int = 1) -> list[str]:
        """Delete the folders that neither the state nor that of ``keep`` commits ago has."""
        last = self.last()
        rows = self.commits().where("folder IS NOT NULL")
        newest = self.commits().where(F.col("seq") <= last - keep).groupBy("key").agg(F.max_by("folder", "seq").alias("folder"))
        recent = rows.where(F.col("seq") > last - keep).select("folder")
        used = self.state().select("folder").union(newest.select("folder")).union(recent).distinct()
        gone = sorted(r["folder"] for r in rows.select("folder").distinct().join(used, "folder", "left_anti").collect())
        dropped = []
        for folder in gone:
            where, system = _hadoop(self.spark, f"{self.root}/{folder}")
            if system.exists(where):
                system.delete(where, True)
                dropped.append(folder)
        return dropped


class RatingsLog(TableLog):
    """Ratings by ``user_bucket``; a merge writes the touched buckets anew beside the old."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = USER_BUCKETS):
        super().__init__(spark, root, f"{schemas.RATING}, user_bucket INT")
        self.buckets = buckets

    def _replace(self, rows: DataFrame, touched: list[int], source: str) -> None:
        seq = self.last() + 1
        folder = f"data/v={seq}"
        even = with_user_bucket(rows, self.buckets).hint("rebalance", "user_bucket")
        even.write.mode("overwrite").partitionBy("user_bucket").parquet(f"{self.root}/{folder}")
        where, system = _hadoop(self.spark, f"{self.root}/{folder}")
        names = [status.getPath().getName() for status in system.listStatus(where)]
        full = {int(name.partition("=")[2]) for name in names if name.startswith("user_bucket=")}
        keys = set(touched) | full
        self.commit(seq, {str(b): f"{folder}/user_bucket={b}" if b in full else None for b in sorted(keys)}, source)

    def overwrite(self, rows: DataFrame, source: str = "load") -> None:
        """Replace the whole table."""
        self._replace(rows.select(*_columns()), list(range(self.buckets)), source)

    def of_buckets(self, touched: list[int]) -> DataFrame:
        return self.read([str(b) for b in touched])

    def merge(self, updates: DataFrame, source: str, **options) -> tuple[DataFrame, DataFrame] | None:
        """Upsert updates; nothing is done, and None returned, if the source was merged before.

        Returns the rows of the updated pairs of user and product before and after. Only
        the buckets of the updates' users are read and written; rows of other pairs stay
        as they are, repeated ones too.
        """
        if self.has(source):
            return None
        new = read_stored(schemas.as_ratings(updates), "updates")
        touched = [r[0] for r in new.select(user_bucket(self.buckets)).distinct().collect()]
        base = schemas.as_ratings(self.of_buckets(touched))
        keys = new.select("user_id", "product_id").distinct()
        before = read_stored(base.join(keys, ["user_id", "product_id"], "left_semi"), "before")
        rest = base.join(keys, ["user_id", "product_id"], "left_anti")
        after = read_stored(upsert_ratings(before, new, **options), "after")
        self._replace(after.unionByName(rest), touched, source)
        return before, after


def _columns() -> list[str]:
    return [field.split()[0] for field in schemas.RATING.split(", ")]


class TotalsLog(TableLog):
    """Monthly totals as a base and the changes of every merge."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(
            spark, root, "product_id INT, yearmonth INT, count BIGINT, n_scores BIGINT, sum_score DOUBLE"
        )

    def add(self, totals: DataFrame, source: str) -> bool:
        """Add totals, or changes of them, unless the source was added before."""
        if self.has(source):
            return False
        seq = self.last() + 1
        totals.select(*_names(self.schema)).write.mode("overwrite").parquet(f"{self.root}/data/v={seq}")
        self.commit(seq, {source: f"data/v={seq}"}, source)
        return True

    def fold(self) -> None:
        """Replace base and changes by one base."""
        keys = [r["key"] for r in self.state().collect()]
        seq = self.last() + 1
        # As many tasks as the shuffle has: few would each hold much of the table.
        folded = self.totals()
        folded.write.mode("overwrite").parquet(f"{self.root}/data/v={seq}")
        self.commit(seq, {**{k: None for k in keys}, f"base-{seq}": f"data/v={seq}"}, f"base-{seq}")

    def totals(self) -> DataFrame:
        """Totals per product and month; months without a rating left drop out."""
        names = ("count", "n_scores", "sum_score")
        rows = self.read().groupBy("product_id", "yearmonth").agg(*[F.sum(c).alias(c) for c in names])
        return rows.where("`count` <> 0 OR n_scores <> 0")


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]
