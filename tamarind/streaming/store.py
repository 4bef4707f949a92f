"""Sources, sinks and the idempotent event store.

Each micro-batch writes its own small aggregates into folders named by the batch id. A
manifest then takes the batch in: one small file that names the batches and the fold that
make up the store, switched by a pointer (``sources.versions``). Readers see the folders of
the newest manifest and no others, so a batch counts when its manifest is there, once, and
a replayed one changes nothing: exactly-once totals on top of at-least-once delivery, with
no row ever reaching the driver. Folded batches leave the manifest; their folders go with
the fold after that, so the number of folders is bounded however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamarind.functions.temporal import wall_clock
from tamarind.operators.dedupe import latest_per_key
from tamarind.sources.tables import empty_like
from tamarind.sources.versions import Files, Pointer
from tamarind.streaming.events import flatten, flatten_all, parse
from tamarind.streaming.measures import (
    add_day_counts,
    add_metrics,
    day_counts,
    dimension_counts,
    late_events,
    latest_events,
    metric_sums,
    recent_events,
    unexpired,
)


def kafka_source(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Topic messages. Starts at the latest offset and tolerates lost data, unless
    told otherwise; after that the checkpoint decides."""
    settings = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**settings)
        .load()
    )


def file_source(spark: SparkSession, folder: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files arriving in a folder."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(folder)


def archive(
    flat: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object], grain: str = "yyyy-MM-dd"
) -> StreamingQuery:
    """Flat events as parquet, one folder per event day, or per coarser ``grain``."""
    dated = flat.withColumn("event_date", F.date_format(wall_clock("event_timestamp"), grain))
    return (
        dated.writeStream.format("parquet")
        .partitionBy("event_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


@dataclass(frozen=True)
class EventStore:
    """Counters, sums, newest and recent events, day windows and rejects below one folder."""

    spark: SparkSession
    root: str
    keep_recent: int = 200
    # after so many batches the older ones are folded; 0 leaves folding to the caller
    fold_every: int = 360
    # folds drop the newest event of orders that have been silent for so long
    expire_hours: int | None = None
    # an event that is older than the newest one of earlier batches by more is late
    late_hours: int = 24
    # which tables to keep; all of them unless named
    tables: tuple[str, ...] | None = None

    # table -> how one batch, or the union of several, is folded
    @property
    def _folds(self):
        folds = {
            "counters": (
                dimension_counts,
                lambda d: d.groupBy("dim", "label").agg(F.sum("event_count").alias("event_count")),
            ),
            "metrics": (metric_sums, add_metrics),
            "latest": (latest_events, self._latest),
            "recent": (
                lambda d: recent_events(d, self.keep_recent),
                lambda d: recent_events(d, self.keep_recent),
            ),
            "days": (day_counts, add_day_counts),
            "late": (late_events, lambda d: d),
        }
        return {t: f for t, f in folds.items() if self.tables is None or t in self.tables}

    def _latest(self, parts: DataFrame) -> DataFrame:
        # what has expired goes before the rows meet: an order's newest event goes last
        alive = parts if self.expire_hours is None else unexpired(parts, self.expire_hours)
        return latest_per_key(alive, ["order_id"], "event_time")

    @property
    def _pointer(self) -> Pointer:
        return Pointer(self.spark, f"{self.root}/_manifest")

    def _manifest(self) -> tuple[int, dict[str, Any]]:
        seen, state = self._pointer.current()
        return seen, {"batches": [], "upto": -1, "newest": None, "leaving": [], "left": [], **state}

    @staticmethod
    def _before(state: dict[str, Any], hours: int) -> Column:
        """So many hours before the newest event of the batches in the manifest."""
        return F.lit(state["newest"]).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Sink of ``foreachBatch`` over messages from :func:`flatten_all`.

        Several tables: the parsed messages are written first and read back for each
        aggregate, so that they are parsed once, and a lost executor does not send the
        batch to the source again. One table: its aggregate is written from the messages
        themselves, and only invalid ones are stored. Whether an event is late or has
        expired is decided against the manifest before the batch, hence in the same way
        when the batch is tried again.
        """
        seen, state = self._manifest()
        if batch_id <= state["upto"] or batch_id in state["batches"] or batch.isEmpty():
            return
        observed = Observation(f"newest_{batch_id}")
        time = F.when(F.col("is_valid"), wall_clock("event_timestamp"))
        timed = batch.withColumn("event_time", time)
        late = F.coalesce(F.col("event_time") < self._before(state, self.late_hours), F.lit(False))
        timed = timed.withColumn("is_late", late).observe(
            observed, F.max("event_time").cast("string").alias("t"), F.count_if(~F.col("is_valid")).alias("invalid")
        )
        events = f"{self.root}/events/batch_id={batch_id}"
        alone = len(self._folds) == 1
        if not alone:
            timed.write.mode("overwrite").parquet(events)
            timed = self.spark.read.parquet(events)
        flat = timed.where("is_valid").drop("is_valid", "value")
        for table, (fold, _) in self._folds.items():
            given = flat
            if table == "latest" and self.expire_hours is not None and state["newest"]:
                given = given.where(F.col("event_time") > self._before(state, self.expire_hours))
            given = given if table in ("days", "late") else given.drop("event_time", "is_late")
            fold(given).write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")
        if alone:
            broken = batch.select("is_valid", "value")
            broken = broken.where("NOT is_valid") if observed.get.get("invalid") else empty_like(broken)
            broken.write.mode("overwrite").parquet(events)
        state["batches"] = [*state["batches"], batch_id]
        state["newest"] = max(filter(None, (state["newest"], observed.get.get("t"))), default=None)
        self._pointer.switch(seen, state)
        if self.fold_every and batch_id and batch_id % self.fold_every == 0:
            # the stream has committed all batches before this one
            self.fold(batch_id - 1)

    def start(self, raw: DataFrame, checkpoint: str, trigger: Mapping[str, object] | None = None) -> StreamingQuery:
        """Run over a stream of messages; by default a micro-batch every 10 seconds."""
        return (
            flatten_all(parse(raw))
            .writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )

    def _parts(self, table: str, state: dict[str, Any], upto: int | None = None) -> DataFrame:
        """The fold and the batches after it, optionally only up to a batch."""
        batches = [b for b in state["batches"] if upto is None or b <= upto]
        parts = []
        if state["upto"] >= 0:
            parts.append(self.spark.read.parquet(f"{self.root}/{table}_folded/upto={state['upto']}"))
        if batches:
            parts.append(self.spark.read.parquet(*[f"{self.root}/{table}/batch_id={b}" for b in batches]))
        if not parts:
            raise ValueError(f"{self.root} holds no batch yet")
        return reduce(DataFrame.unionByName, parts)

    def read(self, table: str) -> DataFrame:
        """Total over all batches of one table, e.g. ``counters`` or ``latest``."""
        return self._folds[table][1](self._parts(table, self._manifest()[1]))

    def fold(self, upto: int) -> None:
        """Fold the batches up to ``upto`` into one, so that reads stay short however
        long the stream runs. Give a batch that can no longer be replayed: one that
        is older than the stream's last. Folding again changes nothing.

        The folded folders leave the manifest now and the disk with the next fold: a
        reader that has just looked can finish. Invalid messages are folded like a table.
        """
        seen, state = self._manifest()
        folded = [b for b in state["batches"] if b <= upto]
        if not folded:
            return
        for table, (_, add) in self._folds.items():
            add(self._parts(table, state, upto)).write.mode("overwrite").parquet(f"{self.root}/{table}_folded/upto={upto}")
        self._rejects(state, upto).write.mode("overwrite").parquet(f"{self.root}/rejects_folded/upto={upto}")
        gone = [f"{t}/batch_id={b}" for t in (*self._folds, "events") for b in folded]
        if state["upto"] >= 0:
            gone += [f"{t}_folded/upto={state['upto']}" for t in (*self._folds, "rejects")]
        removed = [*state["leaving"], *state["left"]]
        changed = {
            "batches": [b for b in state["batches"] if b > upto],
            "upto": upto,
            "leaving": gone,
            "left": state["leaving"],
        }
        self._pointer.switch(seen, {**state, **changed})
        Files(self.spark).remove(f"{self.root}/{folder}" for folder in removed)

    def live(self, hours: int = 24) -> DataFrame:
        """Newest event per order that has not expired."""
        return self._latest(unexpired(self._parts("latest", self._manifest()[1]), hours))

    def _rejects(self, state: dict[str, Any], upto: int | None = None) -> DataFrame:
        events = [f"{self.root}/events/batch_id={b}" for b in state["batches"] if upto is None or b <= upto]
        parts = [self.spark.read.parquet(*events).where("NOT is_valid").select("value")] if events else []
        if state["upto"] >= 0:
            parts.append(self.spark.read.parquet(f"{self.root}/rejects_folded/upto={state['upto']}"))
        return reduce(DataFrame.unionByName, parts)

    def rejects(self) -> DataFrame:
        return self._rejects(self._manifest()[1])


def running_latest(parsed: DataFrame, hours: int = 24) -> DataFrame:
    """The newest event of each order as a stateful stream whose state has a time limit
    (T10), for sinks that take updates.

    State is kept per order and window of ``hours``; the watermark drops windows that lie
    ``hours`` behind the newest event, and with them late events, which would have expired
    anyway. :func:`live_orders` picks from what the sink holds.
    """
    flat = flatten(parsed)
    fields = [c for c in flat.columns if c != "order_id"]
    timed = flat.withColumn("event_time", wall_clock("event_timestamp").cast("timestamp"))
    span = f"{hours} hours"
    # the greatest time, and among equal ones the least fields, as in a batch
    age = -F.unix_micros("event_time")
    newest = F.min(F.struct(age.alias("age"), *fields)).alias("e")
    timed = timed.where("event_time IS NOT NULL").withWatermark("event_time", span)
    return timed.groupBy(F.window("event_time", span).alias("span"), "order_id").agg(newest).select(
        "order_id",
        *[f"e.{c}" for c in fields],
        F.timestamp_micros(-F.col("e.age")).alias("event_time"),
        F.col("span.start").alias("window_start"),
    )


def live_orders(updates: DataFrame, hours: int = 24) -> DataFrame:
    """The newest event per order within ``hours`` of the newest of all, from the updates
    of :func:`running_latest`."""
    return latest_per_key(unexpired(updates.drop("window_start"), hours), ["order_id"], "event_time")


def running_counts(parsed: DataFrame) -> DataFrame:
    """The counters as a stateful streaming aggregate, for sinks that take updates."""
    return dimension_counts(flatten(parsed))
