"""Declared schemas of transactions, stream events and logs."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed column names of the card data set.
COMPONENTS = [f"V{i}" for i in range(1, 29)]
FEATURES = [*COMPONENTS, "Amount"]
TARGET = "Class"

# Labelled table: offset in seconds, components, amount, label.
LABELLED = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
    + [T.StructField(TARGET, T.IntegerType())]
)

# Stream event as decoded from JSON; fields not named here are dropped.
EVENT = T.StructType(
    [T.StructField(c, T.FloatType()) for c in FEATURES]
    + [T.StructField("transaction_id", T.StringType()), T.StructField("timestamp", T.StringType())]
)

# Inference log: a scored row, the id and time of its batch, and the strict 0.5 flag.
INFERENCE_LOG = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in [*FEATURES, "prediction"]]
    + [T.StructField("prediction_id", T.StringType()), T.StructField("timestamp", T.StringType()),
       T.StructField("fraud_detected", T.BooleanType())]
)
