"""Two order rows to start an empty table with."""

from __future__ import annotations

from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.operators.keyed import insert_if_absent
from sparkdesk.operators.orders import append_orders

# Fixed values; the last one is the age in minutes.
_ROWS = [
    ("PO-DEMO-0001", "Alice Chen", "GOLD", "R2DBC-BOOK", 2, Decimal("129.00"), Decimal("18.00"), "LOW", "CREATED",
     "seed data for list api", 15),
    ("PO-DEMO-0002", "Bob Li", "SILVER", "WEBFLUX-COURSE", 1, Decimal("299.00"), Decimal("26.00"), "MEDIUM",
     "PENDING_REVIEW", "seed data for topology demo", 8),
]
_SCHEMA = (
    "order_no string, customer_name string, customer_tier string, sku_code string, quantity int, "
    "unit_price decimal(12,2), shipping_fee decimal(12,2), risk_level string, status string, remark string, age int"
)


def load_seeds(spark: SparkSession, path: str, now: Column | None = None) -> None:
    """Adds the seed rows whose number the order table at ``path`` does not hold, so a second load adds nothing.

    The numbers reach the scan's filter. Columns of the table that seeds do not have are null.
    """
    seeds = seed_orders(spark, now)
    try:
        table = spark.read.parquet(path).drop("order_day")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        table = seeds.where("false").withColumn("request_id", F.lit(None).cast("string"))
    seeds = seeds.select(*[F.col(f.name) if f.name in seeds.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])
    present = table.where(F.col("order_no").isin([r[0] for r in _ROWS]))
    append_orders(insert_if_absent(seeds, present, ["order_no"], [F.col("created_at")]), path)


def seed_orders(spark: SparkSession, now: Column | None = None) -> DataFrame:
    """The seed rows with times relative to ``now``; load them with ``insert_if_absent``."""
    moment = F.current_timestamp() if now is None else now
    created = moment - F.make_interval(mins=F.col("age"))
    rows = spark.createDataFrame(_ROWS, _SCHEMA)
    return rows.withColumn("created_at", created).withColumn("updated_at", created).drop("age")
