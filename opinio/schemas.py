"""Table schemas and a loader for warehouse-style JSON schema files.

A JSON schema file is a list of ``{"name", "type", "mode"}`` objects; the
loader maps it to a ``StructType`` so every read and write uses an
explicit schema (no inference).
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

# Warehouse type names -> Spark types.
_TYPE_MAP = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "BYTES": T.BinaryType(),
}

RAW_COLUMNS = [
    "review_id", "reviewer_id", "restaurant_id", "timestamp", "rating",
    "review_content", "friend_count", "review_count", "useful_count",
    "cool_count", "funny_count", "restaurant_rating",
]
FEATURE_COLUMNS = ["review_length", "rating_deviation", "maximum_review_per_user", "cos_sim"]
FINAL_COLUMNS = RAW_COLUMNS + FEATURE_COLUMNS
LABELED_COLUMNS = FINAL_COLUMNS + ["flagged"]
ERROR_COLUMNS = ["timestamp", "review_id", "review_snippet", "error_message"]

RAW = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("rating", T.LongType()),
    T.StructField("review_content", T.StringType()),
    T.StructField("friend_count", T.LongType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("useful_count", T.LongType()),
    T.StructField("cool_count", T.LongType()),
    T.StructField("funny_count", T.LongType()),
    T.StructField("restaurant_rating", T.DoubleType()),
])

FINAL = T.StructType(RAW.fields + [
    T.StructField("review_length", T.LongType()),
    T.StructField("rating_deviation", T.DoubleType()),
    T.StructField("maximum_review_per_user", T.DoubleType()),
    T.StructField("cos_sim", T.DoubleType()),
])

LABELED = T.StructType(FINAL.fields + [T.StructField("flagged", T.BooleanType())])

ERROR = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("review_snippet", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

# Stream message: the 12 raw keys, timestamp as epoch seconds, plus the
# optional keys the router looks at.
MESSAGE = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("reviewer_id", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("rating", T.LongType()),
    T.StructField("review_content", T.StringType()),
    T.StructField("friend_count", T.LongType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("useful_count", T.LongType()),
    T.StructField("cool_count", T.LongType()),
    T.StructField("funny_count", T.LongType()),
    T.StructField("restaurant_rating", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("payload", T.StringType()),
])

# Raw CSV (source file names before the rename to the table layout).
RAW_CSV = T.StructType([
    T.StructField("reviewID", T.StringType()),
    T.StructField("reviewerID", T.StringType()),
    T.StructField("restaurantID", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("reviewContent", T.StringType()),
    T.StructField("friendCount", T.LongType()),
    T.StructField("reviewCount", T.LongType()),
    T.StructField("usefulCount", T.LongType()),
    T.StructField("coolCount", T.LongType()),
    T.StructField("funnyCount", T.LongType()),
    T.StructField("restaurantRating", T.DoubleType()),
    T.StructField("reviewUsefulCount", T.LongType()),
])

SCHEMAS = {"raw": RAW, "final": FINAL, "labeled": LABELED, "error": ERROR}


def struct_from_json_schema(spec) -> T.StructType:
    """Build a ``StructType`` from a JSON schema file path, JSON text or list."""
    if isinstance(spec, str) and spec.lstrip().startswith("["):
        spec = json.loads(spec)
    elif isinstance(spec, (str, Path)):
        spec = json.loads(Path(spec).read_text())
    fields = []
    for f in spec:
        typ = f["type"].upper()
        if typ not in _TYPE_MAP:
            raise ValueError(f"unsupported column type {typ!r} for {f['name']!r}")
        nullable = f.get("mode", "NULLABLE").upper() != "REQUIRED"
        fields.append(T.StructField(f["name"], _TYPE_MAP[typ], nullable))
    return T.StructType(fields)


def struct_to_json_schema(schema: T.StructType) -> list[dict]:
    """Inverse of :func:`struct_from_json_schema` for the supported types."""
    back = {}
    for name, typ in _TYPE_MAP.items():
        back.setdefault(typ.simpleString(), name)
    return [
        {"name": f.name, "type": back[f.dataType.simpleString()],
         "mode": "NULLABLE" if f.nullable else "REQUIRED"}
        for f in schema.fields
    ]
