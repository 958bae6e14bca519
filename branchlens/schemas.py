"""Fixed schemas of the landed entities and of the raw (reference-format) files."""

from __future__ import annotations

from pyspark.sql import types as T

from branchlens.fixed_values import RAW_COLUMN_NAMES, SHEET_COLUMN_NAMES  # noqa: F401  (re-exported)

MONEY = T.DecimalType(18, 2)

SALE = T.StructType([
    T.StructField("sale_id", T.StringType()), T.StructField("total", MONEY),
    T.StructField("people", T.IntegerType()), T.StructField("sale_type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("closed_at", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()), T.StructField("branch", T.StringType()),
])

# As landed, with the length of the stay taken from the instants before zones are dropped.
LANDED_SALE = T.StructType([*SALE.fields, T.StructField("stay_seconds", T.LongType())])

LINE = T.StructType([
    T.StructField("sale_id", T.StringType()), T.StructField("product_id", T.StringType()),
    T.StructField("price", MONEY), T.StructField("quantity", MONEY),
    T.StructField("canceled", T.BooleanType()), T.StructField("branch", T.StringType()),
])

PAYMENT = T.StructType([
    T.StructField("payment_id", T.StringType()), T.StructField("amount", MONEY),
    T.StructField("created_at", T.TimestampNTZType()), T.StructField("method", T.StringType()),
    T.StructField("canceled", T.BooleanType()), T.StructField("branch", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("product_category", T.StringType()), T.StructField("branch", T.StringType()),
])

BOOKING_RAW = T.StructType([T.StructField(c, T.StringType()) for c in (
    "event_date", "client", "branch", "menu", "guests", "slot", "price_per_guest", "total", "status")])

KNOWN_PAIR = T.StructType([T.StructField("product", T.StringType()), T.StructField("category", T.StringType())])

ENTITIES = {"sales": SALE, "lines": LINE, "payments": PAYMENT, "products": PRODUCT}

# Where a record was in the landing: the order that decides which delivery is the last.
LANDED_AT = T.StructType([T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
                          T.StructField("line", T.LongType()), T.StructField("pos", T.IntegerType())])


def raw_table(entity: T.StructType, partition: str) -> T.StructType:
    """Schema of a raw table: the entity, where and when it was ingested, and the partition
    column last (as text: folder names must not turn a branch ``01`` into a number)."""
    fields = [f for f in entity.fields if f.name != partition]
    return T.StructType([*fields, T.StructField("landed_at", LANDED_AT), T.StructField("ingest_seq", T.LongType()),
                         T.StructField(partition, T.StringType())])


RAW_TABLES = {"sales": raw_table(LANDED_SALE, "month"), "lines": raw_table(LINE, "month"),
              "payments": raw_table(PAYMENT, "month"), "products": raw_table(PRODUCT, "branch")}
