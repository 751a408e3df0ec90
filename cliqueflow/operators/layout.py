"""A large table stored once in a join-ready, skew-safe layout for iterative joins.

Iterative graph jobs join the same big table (edges) to a changing small-ish
table (vertex labels, ranks) every round. Storing the big side bucketed on
the join key removes its shuffle from every round: only the other side is
shuffled into the buckets. A key holding a large share of the rows would
make one bucket (and one task) huge, so keys with more than ``threshold``
rows are salted: their rows are spread over ``salts`` sub-keys by a hash of
another column, and the other side replicates that key's row once per salt.
The hot-key list has at most ``rows / threshold`` entries, which bounds what
is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialize, scratch_path

#: Rows of one bucket (some tens of MB of two ids and a number); what joins it is hashed a bucket at a time.
BUCKET_ROWS = 1_000_000


def bucket_count(spark, rows: int) -> int:
    """Buckets for a table of ``rows`` rows: one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str, path: str) -> None:
    """Add ``df`` to the table ``name``, bucketed on ``key`` (made at ``path`` if it does not exist)."""
    df.repartition(buckets, key).write.mode("append").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def bucketed_name(spark, tag: str) -> tuple[str, str]:
    """A fresh table name and its scratch location."""
    path = scratch_path(spark, tag)
    return f"cliqueflow_{tag.replace('-', '_')}_" + path.rsplit("-", 1)[-1], path


def bucketed_copy(df: DataFrame, key: str, buckets: int, tag: str = "bucketed") -> tuple[DataFrame, str, str]:
    """Store ``df`` bucketed on a unique ``key``; returns (table, table name, path).

    Joins on ``key`` against it shuffle only the other side. For keys that may
    repeat heavily use ``SaltedLayout``.
    """
    spark = df.sparkSession
    name, path = bucketed_name(spark, tag)
    write_bucketed(df, key, buckets, name, path)
    return spark.table(name), name, path


def drop_bucketed(spark, name: str, path: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    drop_path(spark, path)


class Salts:
    """The hot keys of ``big`` by ``key``, whose rows are spread over salts (0 for all others) by a hash of ``spread_by``.

    Without ``buckets`` their number follows the rows of ``big``. The salts hold
    for any table whose keys have no more rows than they have in ``big``.
    """

    def __init__(
        self,
        big: DataFrame,
        key: str,
        spread_by: str,
        buckets: int | None = None,
        threshold: int | None = None,
        tag: str = "layout",
    ):
        spark = big.sparkSession
        if buckets is None or threshold is None:
            rows = big.count()
            buckets = buckets or bucket_count(spark, rows)
            threshold = threshold or max(1000, -(-rows // (buckets * 4)))
        self.spark, self.key, self.spread_by, self.buckets, self.threshold, self.tag = spark, key, spread_by, buckets, threshold, tag
        self.hot, self.hot_path = materialize(
            big.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > threshold)
            .select(key, F.ceil(F.col("n") / F.lit(threshold)).cast("int").alias("salts")),
            f"{tag}-hot",
        )

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their ``salt``, dealt to the buckets."""
        salt = F.coalesce(F.pmod(F.xxhash64(self.spread_by), F.col("salts")).cast("int"), F.lit(0))
        salted = rows.join(F.broadcast(self.hot), self.key, "left").select(*rows.columns, salt.alias("salt"))
        return salted.repartition(self.buckets, self.key, "salt")

    def keyed(self, small: DataFrame, small_key: str) -> DataFrame:
        """``small`` by ``key`` and ``salt``; rows of hot keys are repeated once per salt."""
        salts = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
        named = small.withColumnRenamed(small_key, self.key)
        return named.join(F.broadcast(self.hot), self.key, "left").select(*named.columns, salts)

    def meet(self, rows: DataFrame, small: DataFrame, small_key: str, also: tuple[str, ...] = (), how: str = "inner") -> DataFrame:
        """``rows`` of ``dealt`` joined with ``small`` on ``key == small_key`` and the columns ``also``: hashed a bucket at a time."""
        side = self.keyed(small, small_key).repartition(self.buckets, self.key, "salt")
        return rows.join(side.hint("shuffle_hash"), [self.key, "salt", *also], how)

    def drop(self) -> None:
        drop_path(self.spark, self.hot_path)


class SaltedLayout:
    """Rows bucketed on ``key`` and their salt: those of ``big``, or ``rows`` dealt by ``salts`` of another table."""

    def __init__(
        self,
        big: DataFrame,
        key: str,
        spread_by: str,
        buckets: int | None = None,
        threshold: int | None = None,
        tag: str = "layout",
    ):
        salts = Salts(big, key, spread_by, buckets, threshold, tag)
        self._store(salts.dealt(big), salts)

    @classmethod
    def of(cls, rows: DataFrame, salts: Salts) -> SaltedLayout:
        """A layout of ``rows`` that ``salts`` has dealt: they stay in their partitions."""
        layout = cls.__new__(cls)
        layout._store(rows, salts)
        return layout

    def _store(self, rows: DataFrame, salts: Salts) -> None:
        self.spark, self.salts = salts.spark, salts
        self.key, self.buckets, self.threshold, self.hot = salts.key, salts.buckets, salts.threshold, salts.hot
        self.table, self.path = bucketed_name(self.spark, f"{salts.tag}-bucketed")
        (
            rows.repartition(self.buckets, self.key, "salt")
            .write.bucketBy(self.buckets, self.key, "salt")
            .sortBy(self.key, "salt")
            .option("path", self.path)
            .saveAsTable(self.table)
        )
        self.table_df = self.spark.table(self.table)

    def join(self, small: DataFrame, small_key: str) -> DataFrame:
        """Inner join of the stored table with ``small`` on ``key == small_key`` (no shuffle or sort of the big side).

        Each task hashes its bucket's share of ``small``, which never passes the driver.
        """
        side = self.salts.keyed(small, small_key).hint("shuffle_hash")
        return self.table_df.join(side, [self.key, "salt"]).drop("salt")

    def drop(self) -> None:
        drop_bucketed(self.spark, self.table, self.path)
        self.salts.drop()
