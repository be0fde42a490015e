"""Declared schemas of the logical tables.

Timestamps are UTC wall clock (``TIMESTAMP_NTZ``).  Readers of text formats
(CSV, JSON) read temporal fields as strings and parse them leniently, so a
malformed value becomes NULL instead of failing the job (FN1).
"""

from __future__ import annotations

from pyspark.sql import types as T

LABEL = T.StructType([T.StructField("name", T.StringType()),
                      T.StructField("slug", T.StringType())])
LABELS = T.ArrayType(LABEL)

MEMBERSHIPS = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("identity", T.LongType()),
    T.StructField("payment_status", T.StringType()),
    T.StructField("signup_date", T.TimestampNTZType()),
    T.StructField("payment_date", T.TimestampNTZType()),
    T.StructField("churn_date", T.TimestampNTZType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("refund", T.DoubleType()),
])

# The CSV form (SRC1): dates as text, parsed leniently after the read.
MEMBERSHIPS_CSV = T.StructType([
    T.StructField(f.name, T.StringType() if f.name.endswith("_date") else f.dataType)
    for f in MEMBERSHIPS.fields
])

# Texts that a membership CSV uses for no value.
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
            "NULL", "NaN", "None", "n/a", "nan", "null")

APP_EVENTS = T.StructType([
    T.StructField("event_time_utc", T.TimestampNTZType()),
    T.StructField("email", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_name", T.StringType()),
])

GA_EVENTS = T.StructType([
    T.StructField("event_time_utc", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("page_path", T.StringType()),
    T.StructField("engagement_time_sec", T.DoubleType()),
])

MEMBERS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("email", T.StringType(), False),
    T.StructField("labels", LABELS),
    T.StructField("note", T.StringType()),
    T.StructField("subscribed", T.BooleanType()),
    T.StructField("email_suppression", T.StructType([T.StructField("suppressed", T.BooleanType())])),
    T.StructField("email_count", T.LongType()),
    T.StructField("email_open_rate", T.DoubleType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("last_seen_at", T.TimestampNTZType()),
])


def as_text_timestamps(schema: T.StructType) -> T.StructType:
    """``schema`` with every (nested top-level) timestamp field read as text."""
    return T.StructType([
        T.StructField(f.name, T.StringType(), f.nullable)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f
        for f in schema.fields
    ])


# One landed page of the member dump (SRC2): {"page": n, "members": [...]}; last page empty.
MEMBER_PAGE = T.StructType([T.StructField("members", T.ArrayType(as_text_timestamps(MEMBERS)))])

NEWSLETTERS = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("email_segment", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StructType([T.StructField("slug", T.StringType())]))),
    T.StructField("email", T.StructType([
        T.StructField("email_count", T.LongType()),
        T.StructField("opened_count", T.LongType()),
        T.StructField("delivered_count", T.LongType()),
    ])),
    T.StructField("count", T.StructType([T.StructField("clicks", T.LongType())])),
])

# One landed newsletter dump document (SRC3): {"posts": [...]}.
POST_PAGE = T.StructType([T.StructField("posts", T.ArrayType(as_text_timestamps(NEWSLETTERS)))])

REGISTRY = T.StructType([
    T.StructField("email", T.StringType(), False),
    T.StructField("label", T.StringType()),
    T.StructField("note", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
])

# SRC8: the element type of the JSON array handed to the registry upsert.
UPSERT_RECORD = "array<struct<email:string,label:string,note:string>>"
