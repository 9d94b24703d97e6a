"""Bounded memory of handled events, with late ones on record instead of dropped.

A transport delivers an event once or more. Two deliveries are the same event if all their columns
agree, the time of the event included. Each distinct event of a micro-batch has one fate:

- ``fresh``: not met before; the pass handles it,
- ``redelivered``: an earlier run had it,
- ``late``: older than the watermark allows. Whether it was handled can't be told any more, so it
  goes to quarantine, and the next catch-up finds its request in the listing,
- ``untracked``: without an id or a time; handled, as the guards of the state make repeats harmless.

The watermark is ``keep_hours`` before the latest time of the fresh events of earlier runs, a time
after the clock counting as the clock, and never goes back. After an outage nothing is late that comes in
the first run, as Structured Streaming has it. Since a repeat carries the time of its event,
it is either late or its hour is still on record: no event within the watermark is handled twice.

What was handled is laid out by hour of the event, then run. A run reads the hours that its own
events name and removes those that the watermark has left, so neither the memory nor the work of a run
grows with the history. Copies collapse before a shuffle, whatever their number. A run that is
repeated ignores its earlier attempt: it finds the watermark and the events that the run
before left.

Counts are kept per run and in all. ``received`` is observed on the rows as they come in, the
others are sums over what became of them; ``lost`` is the difference, and zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantline import schemas
from grantline.plans import intake
from grantline.settings import Settings
from grantline.state.store import StateStore
from grantline.state.tiers import Carried, Files

FRESH, REDELIVERED, LATE, UNTRACKED = "fresh", "redelivered", "late", "untracked"
LATE_EVENT = "late_event"
COUNTS = ("received", FRESH, REDELIVERED, LATE, UNTRACKED, "lost")
_HOUR_MS = 3_600_000
_EVENT = schemas.CHANGE_EVENTS.names
_TOTALS = T.StructType(
    [T.StructField(name, T.LongType()) for name in COUNTS]
    + [T.StructField("latest_ms", T.LongType())]
)
_SEEN = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("event_us", T.LongType()),
        T.StructField("content", T.LongType()),
        T.StructField("hour", T.LongType()),
        T.StructField("run_id", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Memory:
    """How long events are remembered, in hours of event time."""

    keep_hours: int = 48

    def __post_init__(self) -> None:
        if self.keep_hours < 0:
            raise ValueError("keep_hours is negative")


def _content() -> Column:
    return F.xxhash64("event_type", "entity_type", "aspect_name", "entity_urn")


def _hour(us: Column) -> Column:
    return F.floor(us / (1000 * _HOUR_MS)).cast("long")


def distinct_events(batch: DataFrame) -> DataFrame:
    """One row per event with ``copies``, ``event_us``, ``content`` and ``hour``."""
    us = F.unix_micros("event_ts")
    return (
        batch.groupBy(*_EVENT)
        .agg(F.count("*").alias("copies"))
        .withColumn("event_us", us)
        .withColumn("content", _content())
        .withColumn("hour", _hour(us))
    )


def fates(found: DataFrame, seen: DataFrame, oldest_ms: int | None) -> DataFrame:
    """Distinct events with their ``fate``, given what is on record and the watermark, if any."""
    keys = ["hour", "event_id", "event_us", "content"]
    known = seen.select(*keys).distinct().withColumn("known", F.lit(True))
    late = F.lit(False) if oldest_ms is None else F.col("event_us") < oldest_ms * 1000
    return (
        found.join(known, keys, "left")
        .withColumn(
            "fate",
            F.when(F.col("event_id").isNull() | F.col("event_us").isNull(), UNTRACKED)
            .when(late, LATE)
            .when(F.col("known"), REDELIVERED)
            .otherwise(FRESH),
        )
        .drop("known")
    )


def counted(judged: DataFrame) -> DataFrame:
    """One row: what became of the deliveries, and the latest time of a fresh event.

    Of the copies of a fresh event within a batch, one is fresh and the others are redelivered.
    """
    fate, copies = F.col("fate"), F.col("copies")
    again = F.when(fate == FRESH, copies - 1).when(fate == REDELIVERED, copies)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(fate == name, copies)), F.lit(0)).alias(name)

    return judged.agg(
        F.count_if(fate == FRESH).alias(FRESH),
        F.coalesce(F.sum(again), F.lit(0)).alias(REDELIVERED),
        total(LATE),
        total(UNTRACKED),
        F.floor(F.max(F.when(fate == FRESH, F.col("event_us"))) / 1000).cast("long").alias("latest_ms"),
    )


class Deliveries:
    """The memory of one stream, under the root of a store."""

    def __init__(self, store: StateStore, memory: Memory):
        self.store, self.memory = store, memory
        self.folder = store.path("seen_events")
        self.files = Files(store.spark, self.folder)
        self.totals = Carried(store.spark, store.path("delivery_totals"), _TOTALS)

    def oldest_ms(self, run_id: str | None) -> int | None:
        """Time before which an event is late; none before there was a fresh event."""
        row = self.totals.read(run_id).first()
        if row is None or row["latest_ms"] is None:
            return None
        return row["latest_ms"] - self.memory.keep_hours * _HOUR_MS

    def hours(self) -> list[int]:
        """Hours on record."""
        names = (n for n in self.files.names(self.folder) if n.startswith("hour="))
        return sorted(int(n.removeprefix("hour=")) for n in names)

    def seen(self, hours: list[int], run_id: str) -> DataFrame:
        """Events of these hours that other runs handled; other folders are not listed."""
        spark = self.store.spark
        wanted = [f"{self.folder}/hour={h}" for h in sorted(set(hours) & set(self.hours()))]
        if not wanted:
            return spark.createDataFrame([], _SEEN)
        rows = spark.read.schema(_SEEN).option("basePath", self.folder).parquet(*wanted)
        return rows.where(F.col("run_id") != run_id)

    def receive(self, batch: DataFrame, run_id: str, settings: Settings) -> DataFrame:
        """Judge the events of a run; gives those to handle, one row each.

        Late ones are quarantined. In a dry run nothing is put on record.
        """
        store = self.store
        came = Observation(f"received-{run_id}")
        observed = batch.select(*_EVENT).observe(came, F.count(F.lit(1)).alias("received"))
        found = store.write("arrivals", distinct_events(observed), run_id, "live")
        oldest = self.oldest_ms(run_id)
        within = F.lit(True) if oldest is None else F.col("hour") >= oldest // _HOUR_MS
        # At most the hours of the memory, and those that events before the first mark name.
        named = found.where(F.col("hour").isNotNull() & within).select("hour").distinct()
        on_record = named.join(F.broadcast(self._on_record()), "hour", "left_semi")
        hours = [r["hour"] for r in on_record.collect()]
        judged = store.write(
            "deliveries", fates(found, self.seen(hours, run_id), oldest), run_id, "live"
        )
        late = judged.where(F.col("fate") == LATE).select(
            F.col("entity_urn").alias("urn"),
            F.lit(LATE_EVENT).alias("reason"),
            F.concat_ws(" ", "event_id", F.col("event_us").cast("string")).alias("detail"),
        )
        intake.quarantine_rejected(store, late, run_id, "late", settings.dry_run)
        self._count(judged, came.get["received"], run_id, settings)
        if not settings.dry_run:
            self._remember(judged, run_id, self.oldest_ms(None))
            self._forget(oldest)
        return judged.where(F.col("fate").isin(FRESH, UNTRACKED)).select(*_EVENT)

    def _on_record(self) -> DataFrame:
        rows = [(h,) for h in self.hours()]
        return self.store.spark.createDataFrame(rows, "hour long")

    def _count(self, judged: DataFrame, received: int, run_id: str, settings: Settings) -> None:
        row = counted(judged).first().asDict()
        row["received"] = received
        row["lost"] = received - sum(row[n] for n in (FRESH, REDELIVERED, LATE, UNTRACKED))
        if row["latest_ms"] is not None:
            row["latest_ms"] = min(row["latest_ms"], settings.as_of_ms)
        spark = self.store.spark
        this_run = spark.createDataFrame([tuple(row[n] for n in _TOTALS.names)], _TOTALS)
        self.store.write("delivery_counts", this_run.drop("latest_ms"), run_id, "live")
        if not settings.dry_run:
            before = self.totals.read(run_id)
            summed = before.unionByName(this_run).agg(
                *[F.sum(n).alias(n) for n in COUNTS], F.max("latest_ms").alias("latest_ms")
            )
            self.totals.write(summed, run_id)

    def _remember(self, judged: DataFrame, run_id: str, next_oldest: int | None) -> None:
        """Put the fresh events on record that are not late from now on anyway."""
        if next_oldest is None:
            return
        asked_again = (F.col("fate") == FRESH) & (F.col("event_us") >= next_oldest * 1000)
        (
            judged.where(asked_again)
            .select("event_id", "event_us", "content", "hour", F.lit(run_id).alias("run_id"))
            # A file or a few for an hour; large hours are split.
            .hint("rebalance", "hour")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("hour", "run_id")
            .parquet(self.folder)
        )

    def _forget(self, oldest: int | None) -> None:
        """Remove the hours that were late as a whole when this run began."""
        for hour in self.hours() if oldest is not None else ():
            if (hour + 1) * _HOUR_MS <= oldest:
                self.files.remove(f"{self.folder}/hour={hour}")
