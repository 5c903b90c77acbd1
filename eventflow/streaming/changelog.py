"""Retract streams (SNK2): a log of changes with insert, update-before, update-after and delete rows.

``ChangeLog`` keeps a table under a folder as the changes that made it. Every micro-batch writes one folder
``log/_batch=<id>``: rows of the table with ``_op`` ``+I``, ``-U``, ``+U`` or ``-D``, as one null-safe full join of
what the batch brings with what stood before finds them. ``upsert`` takes rows that are new or changed; ``replace``
takes the whole contents of the groups that a batch touches, so rows that a group lost are deleted (a ranking that
an item fell out of, a window that shrank). ``current`` replays: the last change of a key decides. ``compact``
writes the table as a snapshot; a replay then starts there, and ``forget`` deletes the changes before it.

A batch reads the snapshot and the changes after it of the partitions it touches (``part``: days of a window end,
say), so its work follows the batch and the changes since the last snapshot, not the age of the stream. A batch
that is run again reads what stood before it and overwrites what it wrote. Null keys are keys; a key comes once in
a batch; rows that did not change leave no row; an empty batch leaves an empty folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.operators.ranking import top_n

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"


def by_day(ms_col: str, days: int = 1) -> Column:
    """Partitions by the day (or spans of ``days``) of a time in epoch milliseconds."""
    return F.floor(F.col(ms_col) / F.lit(86_400_000 * days))


@dataclass
class ChangeLog:
    """The table ``schema`` (DDL) with the key ``keys`` under ``path``, in partitions by the whole number ``part``,
    which must be a function of the group columns that ``replace`` is used with."""

    path: str
    schema: str
    keys: Sequence[str]
    part: Column = field(default_factory=lambda: F.lit(0))

    def changes(self, spark: SparkSession) -> DataFrame:
        """All changes that are kept: the table's columns, _op, _part, _batch."""
        full = f"{self.schema}, _op string, _part long, _batch long"
        if not self._folders(spark, "log"):
            return spark.createDataFrame([], full)
        return spark.read.schema(full).parquet(f"{self.path}/log")

    def current(self, spark: SparkSession, upto: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """The table after the batch ``upto`` (all there are); with ``parts``, these partitions of it."""
        log = self.changes(spark).where(F.col("_op") != BEFORE)
        if upto is not None:
            log = log.where(F.col("_batch") <= upto)
        shot = max((k for k in self._folders(spark, "snapshots", whole=True) if upto is None or k <= upto), default=None)
        if shot is not None:
            start = spark.read.schema(f"{self.schema}, _part long").parquet(f"{self.path}/snapshots/_batch={shot}")
            start = start.withColumns({"_op": F.lit(INSERT), "_batch": F.lit(shot).cast("long")})
            log = start.unionByName(log.where(F.col("_batch") > shot))
        if parts is not None:
            log = log.where(F.col("_part").isin(list(parts)))
        row = F.struct(*[c for c in self._columns(spark) if c not in self.keys], "_op")
        last = log.groupBy("_part", *self.keys).agg(F.max_by(row, "_batch").alias("_row"))
        return last.where(F.col("_row._op") != DELETE).select("_part", *self.keys, "_row.*").select(*self._columns(spark), "_part")

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Rows that the batch brings or changes; other keys stay."""
        self._write(rows, rows.select(*self.keys), list(self.keys), batch_id)

    def replace(self, rows: DataFrame, touched: DataFrame, batch_id: int) -> None:
        """``rows`` are all that the groups in ``touched`` (its columns name the group) hold from now on."""
        self._write(rows, touched.distinct(), touched.columns, batch_id)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """A snapshot of the table after the batch ``batch_id``, if there is none. Take it of batches that will not
        run again."""
        if batch_id in self._folders(spark, "snapshots", whole=True):
            return
        whole = self.current(spark, batch_id)
        whole.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/snapshots/_batch={batch_id}")

    def forget(self, spark: SparkSession) -> None:
        """Delete the changes, and the older snapshots, that the last snapshot makes needless."""
        shots = self._folders(spark, "snapshots", whole=True)
        gone = [("snapshots", k) for k in shots[:-1]] + [("log", k) for k in self._folders(spark, "log") if shots and k <= shots[-1]]
        for kind, k in gone:
            fs, at = self._at(spark, f"{kind}/_batch={k}")
            fs.delete(at, True)

    def _write(self, rows: DataFrame, touched: DataFrame, group: list[str], batch_id: int) -> None:
        spark, columns = rows.sparkSession, self._columns(rows.sparkSession)
        rest = [c for c in columns if c not in self.keys]
        rows = rows.select(*columns, self.part.cast("long").alias("_part"))
        # The partitions a batch touches: days, say; few, and only their numbers come to the driver.
        touched = touched.withColumn("_part", self.part.cast("long"))
        parts = [r["_part"] for r in touched.select("_part").distinct().collect()]
        old = self.current(spark, batch_id - 1, parts)
        known = touched.select(F.col("_part").alias("_tp"), *[F.col(c).alias(f"_t_{c}") for c in group]).distinct()
        same = F.col("_part") == F.col("_tp")
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
        old = old.join(known, same, "left_semi")
        side = lambda d, n: d.select(F.struct(*self.keys, "_part").alias(f"{n}_key"), F.struct(*rest).alias(n))
        d = side(old, "old").join(side(rows, "new"), F.col("old_key").eqNullSafe(F.col("new_key")), "full")
        change = lambda op, n: F.struct(F.lit(op).alias("_op"), F.col(f"{n}_key").alias("k"), F.col(n).alias("v"))
        ops = (F.when(F.col("old_key").isNull(), F.array(change(INSERT, "new")))
               .when(F.col("new_key").isNull(), F.array(change(DELETE, "old")))
               .when(~F.col("old").eqNullSafe(F.col("new")), F.array(change(BEFORE, "old"), change(AFTER, "new"))))
        d = d.select(F.explode(ops).alias("c")).select("c.k.*", "c.v.*", "c._op").select(*columns, "_op", "_part")
        d.write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/log/_batch={batch_id}")

    def _columns(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def _at(self, spark: SparkSession, name: str):
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return at.getFileSystem(spark._jsc.hadoopConfiguration()), at

    def _folders(self, spark: SparkSession, kind: str, whole: bool = False) -> list[int]:
        """Ids of the batches that have a folder of this kind (``whole``: one that was written to its end)."""
        fs, at = self._at(spark, kind)
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        ids = sorted(int(n.split("=")[1]) for n in names if n.startswith("_batch="))
        return [k for k in ids if not whole or fs.exists(self._at(spark, f"{kind}/_batch={k}/_SUCCESS")[1])]


def ranking_changes_writer(counts: ChangeLog, ranks: ChangeLog, n: int, group_col: str, count_col: str, tiebreak: Sequence[str],
                           rank_col: str = "rank", compact_every: int = 50) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` for update-mode counts: ``ranks`` becomes the retract stream of the top ``n`` of every group
    (``ranks`` keeps all its changes, ``counts`` those since its last snapshot).

    Changed counts go to ``counts``; only the groups of the batch are ranked again, from their counts after it."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % compact_every == 0:  # the batch before is done; this one may run again
            for log in (counts, ranks):
                log.compact(spark, batch_id - 1)
            counts.forget(spark)
        batch = batch.persist()
        try:
            counts.upsert(batch, batch_id)
            touched = batch.select(group_col).distinct()
            parts = [r["_part"] for r in touched.select(counts.part.cast("long").alias("_part")).distinct().collect()]
            whole = counts.current(spark, batch_id, parts).join(touched, group_col, "left_semi")
            ranks.replace(top_n(whole, group_col, count_col, n, tiebreak, rank_col), touched, batch_id)
        finally:
            batch.unpersist()
    return run


def rising_ranking_writer(ranks: ChangeLog, n: int, group_col: str, count_col: str, tiebreak: Sequence[str],
                          rank_col: str = "rank", compact_every: int = 50) -> Callable[[DataFrame, int], None]:
    """As ``ranking_changes_writer``, for counts that only rise, as those of a windowed count in update mode do (late
    corrections within the lateness, ST3 with TK2): no counts are logged or read again.

    What a batch leaves unchanged and was not in the top ``n`` cannot enter it, so a group's new ranking is that of its
    old ``n`` rows and the ``n`` best rows of the batch: these are all the state there is, beside the counts
    in Spark's own state store, which lets go of a window once the lateness has passed. A batch reads the rankings
    of the groups' partitions and writes the rows that changed; a group whose ranking stays writes none."""
    columns = [group_col, *tiebreak, count_col]

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id and batch_id % compact_every == 0:  # the batch before is done; this one may run again
            ranks.compact(spark, batch_id - 1)
        best = top_n(batch.select(*columns), group_col, count_col, n, tiebreak, rank_col).select(*columns).persist()
        try:
            touched = best.select(group_col).distinct()
            parts = [r["_part"] for r in touched.select(ranks.part.cast("long").alias("_part")).distinct().collect()]
            before = ranks.current(spark, batch_id - 1, parts).join(touched, group_col, "left_semi").select(*columns)
            # An item of both is the one of the larger count. One that rose, but not into the batch's best, is behind
            # those n rows with its old count too.
            both = before.unionByName(best).groupBy(group_col, *tiebreak).agg(F.max(count_col).alias(count_col))
            ranks.replace(top_n(both, group_col, count_col, n, tiebreak, rank_col), touched, batch_id)
        finally:
            best.unpersist()
    return run
