"""Declared schemas. Scans never infer one."""

from pyspark.sql import types as T

# One point-of-sale event, as it arrives on the topic and in the raw lake zone.
POS_EVENT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("branch_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# The staging table the stream appends to.
POS_STAGED = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("branch_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("event_ts", T.TimestampType()),
    ]
)

# Fields of the JSON arrays that master data is loaded from.
BRANCH_JSON = {"name": "string", "traffic_weight": "int"}
PRODUCT_JSON = {
    "name": "string",
    "category": "string",
    "base_price": "decimal(10,2)",
    "popularity_weight": "int",
}

# Domains that the source database enforces with CHECK constraints.
LEDGER_TYPES = ["import", "sale", "adjustment"]
LOG_REASONS = ["RESTOCK", "CONSUMPTION", "ADJUSTMENT"]
EMPLOYEE_ROLES = ["STAFF", "MANAGER"]
