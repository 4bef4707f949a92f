"""Event-stream and dashboard queries (T*, V*). The stream is the whole lineitem
table, one nested JSON message per row, in several parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarind.catalog.base import cols, query
from tamarind.catalog.oracle import rnd, sql
from tamarind.functions import fixed
from tamarind.operators.joins import with_parent
from tamarind.plans import serving
from tamarind.session import scratch_path, stored
from tamarind.sources.versions import Files
from tamarind.streaming import measures
from tamarind.streaming.events import FLAT_FIELDS, flatten, flatten_all, parse
from tamarind.streaming.store import EventStore, archive, file_source, live_orders, running_counts, running_latest


def _message() -> Column:
    """A flat event as the nested JSON that the topic carries."""
    parts = [F.struct(*fields).alias(part) for part, fields in FLAT_FIELDS.items()]
    return F.to_json(F.struct("event_timestamp", *parts)).alias("value")


def _messages(flat: DataFrame) -> DataFrame:
    return flat.select(_message())


def _flat(r) -> DataFrame:
    return flatten(parse(_messages(r.role("flat_events"))))


# The messages arrive in so many parts by order, and an empty one in between.
_PARTS, _EMPTY_AT = 5, 2
# Topics keep their messages compressed.
_PACKED = {"compression": "gzip"}


def _topic(r) -> list[list[str]]:
    """The whole table's messages as files: those of each part, in order of arrival, each a
    micro-batch. Every task of the scan writes its own rows of a part, so no message is
    moved or sorted, and a micro-batch is read by as many tasks. The times of the files
    are set, because a file stream goes by them; empty files make all parts equally many.
    """
    folder = scratch_path(r.spark, "topic")
    part = F.coalesce(F.pmod(F.col("order_id").cast("bigint"), F.lit(_PARTS)), F.lit(_PARTS - 1))
    for n in range(_PARTS):
        r.role("flat_events").where(part == n).select(_message()).write.options(**_PACKED).text(f"{folder}/part={n}")
    files = Files(r.spark)
    parts = [
        [f"{folder}/part={n}/{name}" for name in sorted(files.names(f"{folder}/part={n}")) if not name.startswith(("_", "."))]
        for n in range(_PARTS)
    ]
    parts.insert(_EMPTY_AT, [])
    most = max(map(len, parts))
    for minute, places in enumerate(parts):
        places += [f"{folder}/nothing-{minute}-{k}.txt" for k in range(most - len(places))]
        for place in places:
            files.touch(place, 1_700_000_000 + 60 * minute)
    return parts


def _stream(r, parts: list[list[str]]) -> DataFrame:
    """The messages as a stream, one part at a time."""
    folder = parts[_EMPTY_AT][0].rpartition("/")[0]
    at_once = str(len(parts[0]))
    return file_source(r.spark, folder, "value string", "text", maxFilesPerTrigger=at_once, recursiveFileLookup="true")


def _played(r, *tables: str, **settings) -> EventStore:
    """The stream run to its end into a new event store that folds as it runs; then the
    second batch, long folded, and the last one are delivered once more."""
    parts = _topic(r)
    root = scratch_path(r.spark, "events")
    store = EventStore(r.spark, f"{root}/store", fold_every=2, tables=tables, **settings)
    store.start(_stream(r, parts), f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
    for batch in (1, len(parts) - 1):
        store.apply(flatten_all(parse(r.spark.read.text(parts[batch]))), batch)
    return store


_TYPES = {"delivery_days": "i", "product_photos_qty": "i", "product_weight_g": "i", "product_description_length": "i",
          "price": "d", "freight_value": "d", "payment_value": "d", "payment_installments": "i", "review_score": "i"}
_FLAT = ["event_timestamp", *[f for fields in FLAT_FIELDS.values() for f in fields]]
_SELECT = cols(", ".join(f"{c}:{_TYPES.get(c, '')}" for c in _FLAT))
_ORDER = "CAST(event_timestamp AS TIMESTAMP) DESC NULLS LAST, " + ", ".join(f"{c} NULLS FIRST" for c in _FLAT[1:])


@query("event_flatten", "T01 T02 T03 F26 F27", sql(f"SELECT {_SELECT} FROM flat_events"))
def _(r):
    return _flat(r)


_DIMS = {
    "status": "order_status", "payment": "payment_type", "category": "product_category_name_english",
    "state": "customer_state", "seller_state": "seller_state", "installments": "payment_installments",
    "photos": "product_photos_qty", "review_score": "review_score",
    "review_has_comment": "CASE WHEN review_has_comment THEN 'yes' ELSE 'no' END",
    "price_bucket": """CASE WHEN price < 50 THEN 'Under R$50' WHEN price < 100 THEN 'R$50-100' WHEN price < 200
        THEN 'R$100-200' WHEN price < 400 THEN 'R$200-400' ELSE 'Above R$400' END""",
    "freight_bucket": """CASE WHEN freight_value < 15 THEN 'Under R$15' WHEN freight_value < 30 THEN 'R$15-30'
        WHEN freight_value < 50 THEN 'R$30-50' ELSE 'Above R$50' END""",
    "customer_city": "customer_city", "seller_city": "seller_city",
}
_COUNTS = " UNION ALL ".join(
    f"""SELECT '{d}' AS dim, coalesce(CAST({c} AS VARCHAR), 'None') AS label, count(*) AS event_count
    FROM flat_events GROUP BY 2""" for d, c in _DIMS.items())


@query("dim_counters", "T07 T12 V02", sql(_COUNTS))
def _(r):
    return measures.dimension_counts(_flat(r))


@query("stream_counters", "T04 T05 T06 T07 T13 S15 S16", sql(_COUNTS))
def _(r):
    return _played(r, "counters").read("counters")


@query("stream_running_counts", "T07 S15", sql(_COUNTS))
def _(r):
    root = scratch_path(r.spark, "running")

    def upsert(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    running_counts(parse(_stream(r, _topic(r)))).writeStream.outputMode("complete").foreachBatch(upsert).option(
        "checkpointLocation", f"{root}-checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    batches = r.spark.read.parquet(root)
    return batches.where(F.col("batch_id") == batches.agg(F.max("batch_id")).scalar()).drop("batch_id")


_KPI = f"""
    SELECT count(*) AS total_orders, {rnd('sum(CAST(payment_value AS DECIMAL(18,2)))')} AS total_revenue,
           {rnd('sum(CAST(freight_value AS DECIMAL(18,2)))')} AS total_freight, {rnd('avg(review_score)')} AS avg_score,
           {rnd('CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) / count(*)')} AS avg_order_value,
           {rnd('avg(delivery_days)', 1)} AS avg_delivery_days, {rnd('avg(product_weight_g)', 0)} AS avg_weight_g,
           {rnd('avg(CASE WHEN payment_value > 0 THEN freight_value / payment_value END) * 100', 1)} AS avg_freight_pct
    FROM flat_events"""


@query("kpi_row", "V01 T08 T09", sql(_KPI))
def _(r):
    return serving.kpi_row(measures.metric_sums(_flat(r)))


@query("stream_kpi_row", "V01 T08 T09 T13", sql(_KPI))
def _(r):
    return serving.kpi_row(_played(r, "metrics").read("metrics"))


@query("recent_events", "T11", sql(f"SELECT {_SELECT} FROM flat_events ORDER BY {_ORDER} LIMIT 200"))
def _(r):
    return measures.recent_events(_flat(r))


_LATEST = f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {_ORDER.replace(
    'order_id NULLS FIRST, ', '')}) AS rn FROM flat_events) WHERE rn = 1)"""


@query("stream_latest", "T10", sql(f"""
    SELECT {_SELECT} FROM {_LATEST} WHERE CAST(event_timestamp AS TIMESTAMP) >
        (SELECT max(CAST(event_timestamp AS TIMESTAMP)) - INTERVAL '24' HOUR FROM flat_events)"""))
def _(r):
    return _played(r, "latest", expire_hours=24).live().drop("event_time")


@query("stream_latest_state", "T10 T14", sql(f"""
    SELECT {_SELECT} FROM {_LATEST} WHERE CAST(event_timestamp AS TIMESTAMP) >
        (SELECT max(CAST(event_timestamp AS TIMESTAMP)) - INTERVAL '24' HOUR FROM flat_events)"""))
def _(r):
    root = scratch_path(r.spark, "newest")

    def keep(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    running_latest(parse(_stream(r, _topic(r)))).writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", f"{root}-checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    return live_orders(r.spark.read.parquet(root).drop("batch_id")).drop("event_time")


_LATE_HOURS = 3 * 365 * 24


@query("stream_day_windows", "T13 T14", sql(f"""
    SELECT CAST(CAST(t AS DATE) AS VARCHAR) AS day, count(*) FILTER (NOT late) AS events, count(*) FILTER (late) AS late_events
    FROM (SELECT t, coalesce(t < top - INTERVAL '{_LATE_HOURS}' HOUR, false) AS late FROM (
        SELECT CAST(event_timestamp AS TIMESTAMP) AS t, CAST(order_id AS BIGINT) % {_PARTS} AS part FROM flat_events) e
        LEFT JOIN (SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
            FROM (SELECT CAST(order_id AS BIGINT) % {_PARTS} AS part, max(CAST(event_timestamp AS TIMESTAMP)) AS newest
                  FROM flat_events GROUP BY 1)) p ON e.part = p.part) GROUP BY 1"""))
def _(r):
    # tumbling days; an event more than three years older than the newest of earlier files is late
    return _played(r, "days", late_hours=_LATE_HOURS).read("days")


@query("stream_archive", "S17", sql("""
    SELECT substr(event_timestamp, 1, 7) AS event_month, count(*) AS events, count(DISTINCT order_id) AS orders
    FROM flat_events GROUP BY 1"""))
def _(r):
    # archived by month here: the table spans seven years, and a folder per day is
    # meant for a stream that arrives day by day
    root = scratch_path(r.spark, "archive")
    flat = flatten(parse(_stream(r, _topic(r))))
    archive(flat, f"{root}/events", f"{root}/checkpoint", {"availableNow": True}, grain="yyyy-MM").awaitTermination()
    stored = r.spark.read.parquet(f"{root}/events")
    return stored.groupBy(F.col("event_date").cast("string").alias("event_month")).agg(
        F.count("*").alias("events"), F.count_distinct("order_id").alias("orders")
    )


_LAST = f"""(SELECT order_id, event_timestamp AS seen_at FROM flat_events ORDER BY {_ORDER} LIMIT 200)"""


@query("live_feed", "V03 V09 F29 F30 F31", sql(f"""
    SELECT concat(substr(l.order_id, 1, 8), '...') AS "Order Id", order_status AS "Order Status",
           customer_state AS "Customer State", customer_city AS "Customer City",
           product_category_name_english AS "Product Category", payment_type AS "Payment Type",
           CAST(payment_installments AS DOUBLE) AS "Payment Installments", payment_value AS "Payment Value",
           price AS "Price", freight_value AS "Freight Value", CAST(review_score AS DOUBLE) AS "Review Score",
           CAST(delivery_days AS DOUBLE) AS "Delivery Days", substr(event_timestamp, 12, 8) AS "Event Timestamp"
    FROM (SELECT * FROM {_LAST} ORDER BY seen_at DESC, order_id LIMIT 15) s JOIN {_LATEST} l ON s.order_id = l.order_id"""))
def _(r):
    # each message is parsed once: the newest events per order are those of the orders shown
    flat = stored(_flat(r), "events")
    recent = stored(measures.recent_events(flat), "recent")
    latest = measures.latest_events(with_parent(flat, recent, "order_id"))
    details = serving.recent_details(recent, latest)
    return serving.live_feed(details)


@query("top_places", "V04 O03", sql(" UNION ALL ".join(f"""
    SELECT * FROM (SELECT '{d}' AS dim, coalesce(CAST({_DIMS[d]} AS VARCHAR), 'None') AS label, count(*) AS event_count
        FROM flat_events GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT {k})"""
    for d, k in (("category", 10), ("customer_city", 10), ("seller_city", 10), ("state", 15)))))
def _(r):
    sizes = {"category": 10, "customer_city": 10, "seller_city": 10, "state": 15}
    return serving.top_labels_of(measures.dimension_counts(r.role("flat_events"), list(sizes)), sizes)


@query("state_compare", "V05 J07", sql("""
    SELECT coalesce(a.s, b.s) AS label, coalesce(a.n, 0) AS customer_orders, coalesce(b.n, 0) AS seller_orders
    FROM (SELECT customer_state AS s, count(*) AS n FROM flat_events GROUP BY 1) a
    FULL JOIN (SELECT seller_state AS s, count(*) AS n FROM flat_events GROUP BY 1) b ON a.s = b.s
    ORDER BY 2 DESC, 1 LIMIT 10"""))
def _(r):
    return serving.state_comparison(measures.dimension_counts(r.role("flat_events"), ["state", "seller_state"]))


@query("bucket_distribution", "V06 O06", sql(f"""
    SELECT label, event_count, CAST(list_position({list(serving.FREIGHT_LABELS)}, label) - 1 AS BIGINT) AS sort_order
    FROM (SELECT {_DIMS['freight_bucket']} AS label, count(*) AS event_count FROM flat_events GROUP BY 1)"""))
def _(r):
    counts = measures.dimension_counts(r.role("flat_events"), ["freight_bucket"])
    return serving.bucket_distribution(counts, "freight_bucket", serving.FREIGHT_LABELS)


@query("numeric_distribution", "V07 O07", sql("""
    SELECT concat(CAST(payment_installments AS VARCHAR), 'x') AS label, count(*) AS event_count FROM flat_events GROUP BY 1"""))
def _(r):
    counts = measures.dimension_counts(r.role("flat_events"), ["installments"])
    return serving.numeric_distribution(counts, "installments", "x")


@query("state_map", "V08 F06", sql(f"""
    SELECT customer_state AS label, count(*) AS event_count, CASE customer_state
        {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in fixed.STATE_NAME.items())} ELSE customer_state END AS state_name
    FROM flat_events GROUP BY 1"""))
def _(r):
    return serving.state_map(measures.dimension_counts(r.role("flat_events"), ["state"]))
