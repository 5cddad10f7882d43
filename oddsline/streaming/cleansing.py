"""Raw files taken up as they arrive: cleansed once each, and only touched days judged again.

Layout below a root:

    klines/batch_id=n/date=D/, events/batch_id=n/date=D/   rows that micro-batch n cleansed
    judged/n<n>_<m>                                        micro-batches that verdicts include

A file stream remembers in its checkpoint which files it has read. A micro-batch that
is run again after a failure holds the same files and replaces its own folder, so every raw
row is stored exactly once. The folders in it name the dates it touched, old days included;
its ``_SUCCESS`` tells that it is complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from oddsline import schemas
from oddsline.config import Settings
from oddsline.operators import views
from oddsline.plans import batch
from oddsline.sinks import tables as sinks
from oddsline.sinks.folders import Folders

KINDS = ("klines", "events")
_STORED = {"klines": schemas.CLEANSED_KLINES, "events": schemas.CLEANSED_EVENTS}
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of rows without a date
_SORT = {"klines": ("symbol",), "events": ("market",)}


class CleansedTables:
    def __init__(self, spark: SparkSession, root: str, unit: str = "ms"):
        self.spark, self.root, self.unit = spark, root.rstrip("/"), unit
        self._cleanse: dict[str, Callable[[DataFrame], DataFrame]] = {
            "klines": lambda raw: sinks.cleanse_klines(raw, unit), "events": sinks.cleanse_market_events}

    def append(self, kind: str, raw: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` target; running a micro-batch again replaces what it stored."""
        sinks.write_partitioned(self._cleanse[kind](raw), f"{self.root}/{kind}/batch_id={batch_id}", ("date",),
                                sort=_SORT[kind], whole=True)

    def start(self, kind: str, raw: DataFrame, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
        """Cleanse a stream of raw files; ``trigger=None`` takes all that there are and stops."""
        writer = (raw.writeStream.foreachBatch(lambda rows, number: self.append(kind, rows, number))
                  .option("checkpointLocation", checkpoint).queryName(f"cleanse-{kind}"))
        if trigger is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=trigger).start()

    def read(self, kind: str) -> DataFrame:
        """All cleansed rows; filters on ``date`` prune folders."""
        path = f"{self.root}/{kind}"
        Folders(self.spark, path).make()
        schema = T.StructType([*_STORED[kind].fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(path).drop("batch_id")

    # --- judging --------------------------------------------------------------

    def _taken(self) -> list[int]:
        """The newest complete micro-batch of each kind, -1 for none."""
        out = []
        for kind in KINDS:
            listed = Folders(self.spark, f"{self.root}/{kind}")
            numbers = [int(n.split("=")[1]) for n in listed.names("", "batch_id=*") if listed.exists(f"{n}/_SUCCESS")]
            out.append(max(numbers, default=-1))
        return out

    def _judged(self) -> list[int]:
        done = [list(map(int, n[1:].split("_"))) for n in Folders(self.spark, f"{self.root}/judged").names("", "n*_*")
                if not n.endswith(".part")]
        return max(done, default=[-1, -1])

    def touched(self, after: list[int], upto: list[int]) -> list[str]:
        """Dates that micro-batches after some and up to others have added rows to."""
        found: set[str] = set()
        for kind, first, last in zip(KINDS, after, upto):
            listed = Folders(self.spark, f"{self.root}/{kind}")
            for number in range(first + 1, last + 1):
                found |= {name.removeprefix("date=") for name in listed.names(f"batch_id={number}", "date=*")}
        return sorted(found - {_NO_DATE})

    def judge(self, out: str, settings: Settings = Settings(), tokens: DataFrame | None = None) -> list[str]:
        """Judge the dates again that were touched since the last time; returns them.

        Of both tables only these dates are read, and ``<out>/analysis`` and ``<out>/view``
        are replaced for them alone. What was judged is noted last: after a failure
        the same dates are judged once more, with the same result.
        """
        taken, before = self._taken(), self._judged()
        days = self.touched(before, taken)
        if days:
            dates = [F.lit(day).cast("date") for day in days]
            klines, events = (self.read(kind).filter(F.col("date").isin(*dates)) for kind in KINDS)
            judged = sinks.dated_result(batch.verdicts(klines, events, settings=settings, tokens=tokens))
            sinks.replace_days(judged, f"{out}/analysis", days)
            analysis = sinks.read_dated(self.spark, f"{out}/analysis", judged.schema)
            view = sinks.dated_view(views.batch_view(analysis.filter(F.col("date").isin(*dates))))
            sinks.replace_days(view, f"{out}/view", days, sort=("rowkey",))
        if taken != before:
            Folders(self.spark, f"{self.root}/judged").write("n" + "_".join(map(str, taken)), "")
        return days
