"""Event schema, parsing and flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The nested event as published on the topic. All times are text.
EVENT_PARTS = {
    "order": """order_id STRING, customer_id STRING, order_status STRING, order_purchase_timestamp STRING,
        order_approved_at STRING, order_delivered_carrier_date STRING, order_delivered_customer_date STRING,
        order_estimated_delivery_date STRING, delivery_days INT""",
    "customer": """customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
        customer_city STRING, customer_state STRING""",
    "seller": "seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING, seller_state STRING",
    "product": """product_id STRING, product_category_name STRING, product_category_name_english STRING,
        product_name_length INT, product_description_length INT, product_photos_qty INT, product_weight_g INT,
        product_length_cm INT, product_height_cm INT, product_width_cm INT""",
    "order_item": """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date STRING, price DOUBLE, freight_value DOUBLE""",
    "payment": """order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT,
        payment_value DOUBLE""",
    "review": """review_id STRING, order_id STRING, review_score INT, review_comment_title STRING,
        review_comment_message STRING, review_has_comment BOOLEAN, review_creation_date STRING,
        review_answer_timestamp STRING""",
}
_CORRUPT = "_corrupt"
EVENT_SCHEMA = ", ".join(
    ["event_timestamp STRING", *[f"`{part}` STRUCT<{fields}>" for part, fields in EVENT_PARTS.items()], f"{_CORRUPT} STRING"]
)

# The fields that the counters and the dashboard use, per part.
FLAT_FIELDS = {
    "order": ("order_id", "order_status", "order_purchase_timestamp", "delivery_days"),
    "customer": ("customer_state", "customer_city"),
    "seller": ("seller_state", "seller_city"),
    "product": (
        "product_category_name", "product_category_name_english", "product_photos_qty", "product_weight_g",
        "product_description_length",
    ),
    "order_item": ("price", "freight_value"),
    "payment": ("payment_type", "payment_value", "payment_installments"),
    "review": ("review_score", "review_has_comment"),
}


def parse(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages with their parsed event in ``data`` and a verdict in ``is_valid``.

    A message is valid when it is well-formed JSON that names its order. The parsed
    struct is passed through a one-element ``explode``: as a projection it would be
    copied into every filter on the verdict, and each message parsed several times.
    """
    event = F.from_json(F.col(value).cast("string"), EVENT_SCHEMA, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = raw.select("*", F.explode(F.array(event)).alias("data"))
    valid = F.col(f"data.{_CORRUPT}").isNull() & F.col("data.order.order_id").isNotNull()
    return parsed.withColumn("is_valid", F.coalesce(valid, F.lit(False)))


def _fields() -> list[Column]:
    return [F.col(f"data.{part}.{field}") for part, fields in FLAT_FIELDS.items() for field in fields]


def flatten(parsed: DataFrame) -> DataFrame:
    """Valid events as 21 flat columns."""
    return parsed.where("is_valid").select(F.col("data.event_timestamp"), *_fields())


def flatten_all(parsed: DataFrame, value: str = "value") -> DataFrame:
    """All messages, flat, with the verdict; only invalid ones keep their text."""
    text = F.when(~F.col("is_valid"), F.col(value).cast("string"))
    return parsed.select("is_valid", text.alias(value), F.col("data.event_timestamp"), *_fields())
