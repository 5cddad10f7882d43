"""The live view: a keyed table fed by micro-batches.

Layout below the root of one row type:

    deltas/batch_id=<n>/   rows changed by micro-batch n
    base/upto=<n>/         all rows after micro-batch n, written by ``compact``: bucketed by
                           key and sorted inside a bucket; the file ``_buckets-<b>``, written
                           last, tells their number

A micro-batch only writes the rows it changed, from the executors, into a folder of
its own; replaying it after a failure replaces that folder.  Readers take the newest
complete base and the deltas after it and resolve each cell to its newest non-null
value.  Nothing that a reader may be using is ever overwritten.

Bounds of a read (a key, a prefix, a time) hold for whole keys, so they are applied to base
and deltas before these are merged and reach both scans.  The base meets the deltas
by its buckets: it is never moved, and a single key reads a single bucket of it.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from oddsline.config import KEY_SEPARATOR, REVERSE_TIME_BASE

_DONE = "_SUCCESS"
_BUCKETS = "_buckets-"


class LiveView:
    """``buckets`` is the number that the next base is written with; a read follows the stored one."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "rowkey",
                 buckets: int = 16):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.buckets = buckets

    @classmethod
    def open(cls, spark: SparkSession, root: str, key: str = "rowkey") -> LiveView:
        """A view that micro-batches have been written to, with the columns that they have."""
        newest = cls(spark, root, T.StructType(), key)
        stored = newest._versions("deltas", "batch_id"), newest._versions("base", "upto")
        if not any(stored):
            raise ValueError(f"{root} holds no live view")
        folder = newest._delta(stored[0][-1]) if stored[0] else newest._base(stored[1][-1])
        return cls(spark, root, spark.read.parquet(folder).schema, key)

    # --- folders -------------------------------------------------------------

    def _matches(self, pattern: str) -> list:
        """Paths that fit a pattern, by one listing of names (no data)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [status.getPath() for status in found or []]

    def _versions(self, kind: str, label: str) -> list[int]:
        """Numbers of the complete folders of a kind."""
        if kind == "base":
            return sorted(self._bases())
        names = [path.getParent().getName() for path in self._matches(f"{kind}/{label}=*/{_DONE}")]
        return sorted(int(m.group(1)) for m in (re.fullmatch(rf"{label}=(\d+)", n) for n in names) if m)

    def _bases(self) -> dict[int, int]:
        """Versions of the complete bases with their number of buckets."""
        out = {}
        for path in self._matches(f"base/upto=*/{_BUCKETS}*"):
            version = re.fullmatch(r"upto=(\d+)", path.getParent().getName())
            number = path.getName()[len(_BUCKETS):]
            if version and number.isdigit():
                out[int(version.group(1))] = int(number)
        return out

    def last_version(self) -> int:
        """The newest micro-batch in the view, -1 for none."""
        return max([-1, *self._versions("base", "upto"), *self._versions("deltas", "batch_id")])

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _delta(self, batch_id: int) -> str:
        return f"{self.root}/deltas/batch_id={batch_id}"

    def _base(self, upto: int) -> str:
        return f"{self.root}/base/upto={upto}"

    def _base_name(self, upto: int) -> str:
        """The catalog's name of a base: only tables can be bucketed."""
        return f"live_base_{hashlib.md5(self._base(upto).encode()).hexdigest()[:20]}"

    # --- write ---------------------------------------------------------------

    def upsert(self, rows: DataFrame, batch_id: int, order: str | None = None) -> None:
        """``foreachBatch`` target; writing the same batch again changes nothing.

        ``order`` (a BIGINT column) is given where a batch can hold a key twice: the row
        with the largest order stays, of equal ones that with the largest row hash.  The
        few changed rows are packed into few files.
        """
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        changed = rows.select(*columns)
        if order is not None:
            newest = Window.partitionBy(self.key).orderBy(F.desc(order), F.desc(F.xxhash64(*self.schema.names)))
            changed = (changed.withColumn("_rank", F.row_number().over(newest))
                       .filter("_rank = 1").drop("_rank"))
        changed.hint("rebalance").write.mode("overwrite").parquet(self._delta(batch_id))

    # --- read ----------------------------------------------------------------

    def _stored(self, upto: int, buckets: int) -> DataFrame:
        name = self._base_name(upto)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                       f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS "
                       f"LOCATION '{self._base(upto)}'")
        return self.spark.table(name)

    def _bounds(self, key: str | None, prefix: str | None, newer_than: int | None) -> list[Column]:
        """Conditions on stored columns that hold for all versions of a key or for none."""
        column, out = F.col(self.key), []
        if key is not None:
            out.append(column == key)
        if prefix is not None:
            out.append(column.startswith(prefix))
            if newer_than is not None and prefix.count(KEY_SEPARATOR) == 2 and prefix.endswith(KEY_SEPARATOR):
                # The rest of these keys is the reverse time: newer keys are smaller.
                out.append(column < f"{prefix}{REVERSE_TIME_BASE - newer_than}")
        if newer_than is not None:
            out.append(F.col("window_end") > newer_than)
        return out

    def _parts(self, upto: int | None, bounds: list[Column]) -> tuple[DataFrame | None, DataFrame | None, int]:
        """The newest base, the deltas after it with their version (None where missing), and the base's buckets."""
        bases = {v: n for v, n in self._bases().items() if upto is None or v <= upto}
        base = max(bases, default=-1)
        deltas = [v for v in self._versions("deltas", "batch_id")
                  if v > base and (upto is None or v <= upto)]
        stored = changed = None
        if base >= 0:
            stored = self._stored(base, bases[base])
        if deltas:
            full = T.StructType(list(self.schema.fields) + [T.StructField("batch_id", T.LongType())])
            changed = (self.spark.read.schema(full).option("basePath", f"{self.root}/deltas")
                       .parquet(*[self._delta(v) for v in deltas]).withColumnRenamed("batch_id", "_version"))
        for bound in bounds:
            stored = None if stored is None else stored.filter(bound)
            changed = None if changed is None else changed.filter(bound)
        return stored, changed, bases.get(base, self.buckets)

    def read(self, upto: int | None = None, newer_than: int | None = None, key: str | None = None,
             prefix: str | None = None) -> DataFrame:
        """Current rows; per cell the newest non-null value counts.

        ``key`` and ``prefix`` name rows, ``newer_than`` (epoch ms) leaves out windows that
        ended by then; the time of a key never changes.  Only the deltas are aggregated,
        into the buckets of the base, which has every key once and stays where it is.
        """
        stored, changed, buckets = self._parts(upto, self._bounds(key, prefix, newer_than))
        if changed is None:
            return self.spark.createDataFrame([], self.schema) if stored is None else stored.select(*self.schema.names)
        cells = [f.name for f in self.schema if f.name != self.key]
        dealt = changed if stored is None else changed.repartition(buckets, self.key)
        newest = dealt.groupBy(self.key).agg(*[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_version"))).alias(c) for c in cells])
        if stored is None:
            return newest.select(*self.schema.names)
        renamed = newest.withColumnsRenamed({c: f"_new_{c}" for c in cells})
        return stored.join(renamed, self.key, "full").select(*[
            F.col(c) if c == self.key else F.coalesce(f"_new_{c}", c).alias(c) for c in self.schema.names])

    # --- maintenance ---------------------------------------------------------

    def compact(self, min_window_end: int | None = None, settled: bool = False) -> int | None:
        """Write a new base from everything complete so far; returns its version.

        Expired rows (``min_window_end``, epoch ms) are left behind.  Beside a running
        stream pass ``settled``: its newest micro-batch, which a restart would write again,
        is left to the next time.
        """
        versions = self._versions("deltas", "batch_id")
        if settled:
            versions = versions[:-1]
        if not versions:
            return None
        upto = versions[-1]
        if upto <= max(self._bases(), default=-1):
            return max(self._bases())
        folder = self._base(upto)
        rows = self.read(upto, min_window_end).repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        (rows.write.mode("overwrite").option("path", folder).bucketBy(self.buckets, self.key)
         .sortBy(self.key).saveAsTable(self._base_name(upto)))
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{_BUCKETS}{self.buckets}")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker, True).close()
        return upto

    def vacuum(self, keep: int = 2) -> None:
        """Remove bases older than the newest ``keep`` and the deltas they all contain."""
        bases = self._versions("base", "upto")
        if len(bases) < keep:
            return
        oldest_kept = bases[-keep]
        for upto in bases[:-keep]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._base_name(upto)}")
            self._remove(self._base(upto))
        for batch_id in self._versions("deltas", "batch_id"):
            if batch_id <= oldest_kept:
                self._remove(self._delta(batch_id))
