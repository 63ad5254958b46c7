"""Explicit schemas and column roles for the vehicle-listing table.

One ``StructType`` per dataset state, applied on read, so CSV and Parquet
inputs arrive with the same types whatever wrote them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column roles named by the modelling jobs.
NUMERIC_FEATURES = ["year", "mileage", "engine_hp", "vehicle_age", "mileage_per_year", "brand_popularity"]
GBT_CATEGORICALS = ["make", "model", "transmission"]
MLP_CATEGORICALS = ["make", "model", "transmission", "fuel_type", "drivetrain", "body_type",
                    "exterior_color", "interior_color", "accident_history", "seller_type",
                    "condition", "trim"]
TARGET = "price"
KEY = "listing_id"

LISTINGS = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("slot", T.LongType()),
     T.StructField(TARGET, T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC_FEATURES]
    + [T.StructField(c, T.StringType()) for c in MLP_CATEGORICALS]
)

# Raw listings: the target is text (may be null, blank or junk), two more
# columns carry planted nulls.
LISTINGS_RAW = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("slot", T.LongType()),
    T.StructField(TARGET, T.StringType()),
    T.StructField("mileage", T.DoubleType()),
    T.StructField("seller_type", T.StringType()),
    T.StructField("make", T.StringType()),
    T.StructField("transmission", T.StringType()),
])

