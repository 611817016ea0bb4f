"""KPIs of changing orders by retraction: a trigger's cost follows its own rows.

The state is the newest version of every key, stored in ``buckets`` folders by a
hash of the key: a compacted base and a log of the changes since; the first epoch's
versions are a base. A trigger reads only the buckets of its own keys, and moves
only state rows whose key's bit is set by its own keys (all of its own, few others):
they meet in one exchange, which also deals them to their buckets. Each change it logs holds the
version it replaces, and what a change does to a measure is a signed delta of the
measure's parts: the old version counts -1, the new one +1. The KPI table is the
last epoch's parts plus these deltas; it has a row for each group.

Sums and counts can be taken back. A minimum or maximum can't, so a group that
loses a version is computed anew for such measures, from the state.

Every epoch has folders of its own, written once: a replay does nothing or the
same again, and reads only epochs before its own. The base is written anew once
the log holds as many rows as the base, so all compaction together writes no
more than a few times what the triggers wrote.

``stats`` holds each trigger's rows and the state rows it read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.metrics import Measure
from ..session import path_exists
from .upsert import latest_versions, newness

# Versions of a task that seeks the newest of each key, and the most such tasks
# (more than 200 partitions are sorted as they are written).
PART_ROWS, MOST_PARTS = 500_000, 200
# Bits for each of a trigger's rows to pick state rows by, and the most (broadcast: 32 MB);
# those of one bitmap_construct_agg, and of a key's hash those that choose no bit.
KEY_BITS, MOST_BITS, BITMAP, SPARE = 16, 1 << 28, 32_768, 20


@dataclass
class Refresh:
    """What is refreshed, and where it is kept."""

    spark: SparkSession
    folder: str
    schema: object                              # of the versions
    keys: tuple
    version: str
    measures: list[Measure]
    by: tuple
    enrich: Callable[[DataFrame], DataFrame]    # joins the columns of ``by``
    buckets: int = 32
    stats: list[dict] = field(default_factory=list)

    # ---- the stored state ---------------------------------------------------
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _epochs(self, kind: str) -> list[int]:
        """Finished epochs of a table, from the names of its folders."""
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        p = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{kind}/epoch=*/_SUCCESS")
        found = p.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(p) or []
        return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)

    def _read(self, kind: str, epochs: list[int], at: list[int] | None = None) -> DataFrame:
        """Epochs of the base or the log, one scan of the folders of buckets ``at`` (all)."""
        row = StructType([f for f in self.schema.fields])
        kept = [StructField("epoch", IntegerType()), StructField("bucket", IntegerType())]
        own = row.fields if kind == "base" else [StructField("new", row), StructField("old", row)]
        rows = (self.spark.read.schema(StructType([*own, *kept])).option("basePath", f"{self.folder}/{kind}")
                .parquet(*[f"{self.folder}/{kind}/epoch={e}" for e in epochs]))
        return rows if at is None else rows.where(F.col("bucket").isin(at))

    def state(self, epoch: int | None = None, at: list[int] | None = None) -> DataFrame | None:
        """The newest versions before ``epoch`` (all), in buckets ``at`` (all)."""
        rows, base, since = self._versions(epoch, at), *self._stored(epoch)
        # a base alone, or one epoch's log, holds a key once
        alone = rows is None or len(since) + (base >= 0) == 1
        return rows if alone else latest_versions(rows, self.keys, self.version)

    def _stored(self, epoch: int | None) -> tuple[int, list[int]]:
        """The base before ``epoch`` (all; -1: none), and the epochs of the log since."""
        before = [e for e in self._epochs("log") if epoch is None or e < epoch]
        base = max((e for e in self._epochs("base") if epoch is None or e < epoch), default=-1)
        return base, [e for e in before if e > base]

    def _versions(self, epoch: int | None, at: list[int] | None) -> DataFrame | None:
        base, since = self._stored(epoch)
        names = [f.name for f in self.schema.fields]
        parts = [self._read("base", [base], at).select(*names)] if base >= 0 else []
        if since:
            parts.append(self._read("log", since, at).select(*[F.col("new")[c].alias(c) for c in names]))
        return reduce(DataFrame.unionByName, parts) if parts else None

    # ---- a trigger ------------------------------------------------------------
    def apply(self, batch: DataFrame, epoch: int) -> None:
        if path_exists(self.spark, f"{self.folder}/parts/epoch={epoch}/_SUCCESS"):
            return
        seen = {"epoch": epoch, "state_rows": 0}
        if not any(path_exists(self.spark, f"{self.folder}/{k}/epoch={epoch}/_SUCCESS") for k in ("log", "base")):
            self._log(batch, epoch, seen)
        log = self._logged(epoch)
        seen["changed"] = log.count()
        self._parts(log, epoch)
        self._compact(epoch)
        self.stats.append(seen)

    def _log(self, batch: DataFrame, epoch: int, seen: dict) -> None:
        """The versions that are newer than the state's, each with the one it replaces."""
        names = [f.name for f in self.schema.fields]
        if self._stored(epoch) == (-1, []):
            return self._first(batch.select(*names), epoch)
        batch = batch.select(*names)
        n = batch.count()
        at = [r.bucket for r in batch.select(self.bucket().alias("bucket")).distinct().collect()]      # ``buckets`` at most
        old = self._versions(epoch, at)
        seen["state_rows"] = old.count()           # from the files' footers
        # before the newest is sought, what isn't asked for goes; a key with a null equals none
        old = self._sieved(old.dropna(subset=list(self.keys)), batch, n)
        both = batch.withColumn("__came", F.lit(True)).unionByName(old.withColumn("__came", F.lit(False)))
        age = newness(both.select(*names), self.version)
        newest = [c for side, when in (("new", F.col("__came")), ("old", ~F.col("__came"))) for c in (
            F.max_by(F.struct(*names), F.when(when, age)).alias(side), F.max(F.when(when, age)).alias(f"__{side}"))]
        rows = self._dealt(both, 2 * n, newest).where(
            F.col("__new").isNotNull() & (F.col("__old").isNull() | (F.col("__new") > F.col("__old"))))
        self._write(rows.select("new", "old", "bucket"), "log", epoch)

    def _first(self, batch: DataFrame, epoch: int) -> None:
        """The newest versions where no state is: they are the base."""
        age = newness(batch, self.version)
        new = self._dealt(batch, batch.count(), [F.max_by(F.struct(*batch.columns), age).alias("new")])
        self._write(new.select("new.*", "bucket"), "base", epoch)

    def _dealt(self, rows: DataFrame, n: int, found: list[Column]) -> DataFrame:
        """``found`` of every key of about ``n`` rows: one exchange serves the keys and the folders alike."""
        parts = max(self.buckets, min(-(-n // PART_ROWS), MOST_PARTS))
        part = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets * -(-parts // self.buckets)))
        rows = rows.withColumns({"bucket": self.bucket(), "__part": part}).repartition(parts, "bucket", "__part")
        return rows.groupBy("bucket", "__part", *self.keys).agg(*found)

    def _sieved(self, rows: DataFrame, batch: DataFrame, n: int) -> DataFrame:
        """The rows with a key whose bit a key of ``batch`` sets: those of its keys, and few others."""
        bits = min(max(1, -(-n * KEY_BITS // BITMAP)) * BITMAP, MOST_BITS)
        at = F.shiftrightunsigned(F.xxhash64(*self.keys), SPARE) % bits
        place = {"__slot": F.expr(f"__at div {BITMAP}"), "__bit": (F.col("__at") % BITMAP).cast("int")}
        held = (batch.select(at.alias("__at")).withColumns(place).groupBy("__slot")
                .agg(F.bitmap_construct_agg("__bit").alias("__bits")))
        byte = F.conv(F.hex(F.substring("__bits", (F.col("__bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return (rows.withColumn("__at", at).withColumns(place).join(F.broadcast(held), "__slot")
                .where(F.getbit(byte, F.col("__bit") % 8) == 1).select(*rows.columns))

    def _write(self, rows: DataFrame, kind: str, epoch: int) -> None:
        (rows.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket")
         .parquet(f"{self.folder}/{kind}/epoch={epoch}"))

    def _logged(self, epoch: int) -> DataFrame:
        """The changes of an epoch; the first one's are its base."""
        if path_exists(self.spark, f"{self.folder}/log/epoch={epoch}/_SUCCESS"):
            return self._read("log", [epoch])
        row = F.struct(*[f.name for f in self.schema.fields])
        return self._read("base", [epoch]).select(row.alias("new"), F.lit(None).cast(self.schema).alias("old"))

    def _changes(self, log: DataFrame) -> DataFrame:
        """Versions with ``sign`` +1 for what came and -1 for what went, and the columns of ``by``."""
        names = [f.name for f in self.schema.fields]
        sides = log.select(F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")),
                                             F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))).alias("c"))
        rows = sides.where("c.row is not null").select("c.sign", *[F.col("c.row")[c].alias(c) for c in names])
        return self.enrich(rows)

    def _signed(self) -> list[Column]:
        """Deltas of every part: of what is summed, and of how many rows a sum is of."""
        out = [F.sum("sign").alias("__n")]
        sign = F.col("sign").cast("decimal(1,0)")
        for m in self.measures:
            for name, p in m.parts:
                e = p.expr if m.where is None else F.when(m.where, p.expr)
                there = F.sum(F.when(e.isNotNull(), F.col("sign")).otherwise(0))
                if p.fn == "count":
                    out.append(there.alias(m.col(name)))
                elif p.fn == "sum":
                    out += [F.sum(e * sign).alias(m.col(name)), there.alias(m.col(name) + "__k")]
        return out

    def _extremes(self, rows: DataFrame, having: Column | None = None) -> list[Column]:
        agg = {"min": F.min, "max": F.max}
        out = []
        for m in self.measures:
            for name, p in m.parts:
                if p.fn in agg:
                    e = p.expr if m.where is None else F.when(m.where, p.expr)
                    out.append(agg[p.fn](e if having is None else F.when(having, e)).alias(m.col(name)))
        return out

    def _parts(self, log: DataFrame, epoch: int) -> None:
        changes, by = self._changes(log), list(self.by)
        extremes = self._extremes(changes, F.col("sign") > 0)
        delta = changes.groupBy(*by).agg(*self._signed(), *extremes,
                                         F.max(F.col("sign") < 0).alias("__lost"))
        last = max((e for e in self._epochs("parts") if e < epoch), default=None)
        if last is not None:
            delta = delta.unionByName(self.spark.read.parquet(f"{self.folder}/parts/epoch={last}")
                                      .withColumn("__lost", F.lit(False)))
        merge = [F.sum("__n").alias("__n"), F.max("__lost").alias("__lost")]
        for m in self.measures:
            for name, p in m.parts:
                c = m.col(name)
                merge.append({"min": F.min, "max": F.max}.get(p.fn, F.sum)(c).alias(c))
                if p.fn == "sum":
                    merge.append(F.sum(c + "__k").alias(c + "__k"))
        merged = delta.groupBy(*by).agg(*merge).where("__n > 0")
        if extremes:
            merged = self._again(merged, epoch, by)
        # a row for each group
        merged.drop("__lost").write.mode("overwrite").parquet(f"{self.folder}/parts/epoch={epoch}")

    def _again(self, merged: DataFrame, epoch: int, by: list[str]) -> DataFrame:
        """Minima and maxima of the groups that lost a version, from the whole state."""
        rows = self.enrich(self.state(epoch + 1))
        lost = merged.where("__lost").select(*[F.col(c).alias(f"__{c}") for c in by])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by])
        again = rows.join(lost, same, "left_semi").groupBy(*by).agg(*self._extremes(rows))
        names = [c for c in again.columns if c not in by]
        again = again.select(*[F.col(c).alias(f"__{c}") for c in again.columns])
        out = merged.join(again, same, "left")
        return out.withColumns({c: F.when(F.col("__lost"), F.col(f"__{c}")).otherwise(F.col(c)) for c in names}).drop(
            *again.columns)

    def _compact(self, epoch: int) -> None:
        base, since = self._stored(epoch + 1)
        if since and self._read("log", since).count() >= max(self._read("base", [base]).count() if base >= 0 else 0, 1):
            state = self.state(epoch + 1).withColumn("bucket", self.bucket())
            if base >= 0 or len(since) > 1:       # one epoch's log lies by bucket already
                state = state.repartition("bucket")
            self._write(state, "base", epoch)

    # ---- what is read -----------------------------------------------------------
    def kpis(self) -> DataFrame:
        """The measures of every group after the last finished epoch."""
        rows = self.spark.read.parquet(f"{self.folder}/parts/epoch={max(self._epochs('parts'))}")
        for m in self.measures:          # a sum of no rows is null
            rows = rows.withColumns({m.col(n): F.when(F.col(m.col(n) + "__k") > 0, F.col(m.col(n)))
                                     for n, p in m.parts if p.fn == "sum"})
        return rows.select(*self.by, *[m.final(lambda p, m=m: F.col(m.col(p))).alias(m.name) for m in self.measures])

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Apply every micro-batch of the stream that is there."""
        return (stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
