"""Order intake: validation, normalising, pricing, risk, and the reads on the order table.

All rules are expressions on one row. A request frame has ``request_id,
customer_name, customer_tier, sku_code, quantity, unit_price, remark, requested_at``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.cells import instant_text
from sparkdesk.functions.strings import trim_ctl

# Fixed values.
MONEY = "decimal(12,2)"
AMOUNT = "decimal(24,2)"
RISK_BOUNDS = {"HIGH": 1000, "MEDIUM": 300}
FEE_BOUND, FEE_ABOVE, FEE_BELOW = 500, Decimal("12.00"), Decimal("24.00")
MIN_PRICE = Decimal("0.01")
BLANK_MESSAGES = {
    "customer_name": "customerName: customerName must not be blank",
    "customer_tier": "customerTier: customerTier must not be blank",
    "sku_code": "skuCode: skuCode must not be blank",
}
QUANTITY_MESSAGE = "quantity: quantity must be greater than 0"
PRICE_NULL_MESSAGE = "unitPrice: unitPrice must not be null"
PRICE_MIN_MESSAGE = "unitPrice: unitPrice must be greater than 0"
TABLE_LENGTH_MESSAGE = "{}: the order table takes at most {} characters"
TABLE_PRICE_MESSAGE = "unitPrice: the order table takes at most 10 digits before the point"
TABLE_NUMBER_MESSAGE = "requestedAt: an order number needs a time and a request id"
FIELD_NAMES = {"customer_name": "customerName", "customer_tier": "customerTier", "sku_code": "skuCode", "remark": "remark"}
LENGTH_LIMITS = {"order_no": 32, "customer_name": 64, "customer_tier": 32, "sku_code": 64, "remark": 255}
MIN_LIMIT, MAX_LIMIT, DEFAULT_LIMIT = 1, 100, 10

ORDER_COLUMNS = (
    "order_no", "customer_name", "customer_tier", "sku_code", "quantity", "unit_price", "shipping_fee",
    "risk_level", "status", "remark", "created_at", "updated_at",
)


def violations(df: DataFrame) -> Column:
    """Messages of one request, in the order of its fields; an empty array for a good one."""
    blank = [
        F.when(F.coalesce(trim_ctl(F.col(name)), F.lit("")) == "", text) for name, text in BLANK_MESSAGES.items()
    ]
    checks = F.array(
        *blank,
        F.when(F.coalesce(F.col("quantity"), F.lit(0)) < 1, QUANTITY_MESSAGE),
        F.when(F.col("unit_price").isNull(), PRICE_NULL_MESSAGE),
        F.when(F.col("unit_price") < F.lit(MIN_PRICE), PRICE_MIN_MESSAGE),
    )
    return F.array_compact(checks)


def validate(requests: DataFrame) -> DataFrame:
    """Requests with ``violations`` and their text, joined by '; '."""
    told = requests.withColumn("violations", violations(requests))
    return told.withColumn("message", F.array_join("violations", "; "))


def table_violations(columns: Sequence[str], numbered: bool = False, number: Column | None = None) -> Column:
    """Messages on what the order table itself refuses of a normalised row, one for each of its columns that does not fit.

    With ``numbered``, a row that gets no order number is refused, too; ``number`` is that number where it is made already.
    """
    checks = [
        F.when(F.length(name) > LENGTH_LIMITS[name], TABLE_LENGTH_MESSAGE.format(field, LENGTH_LIMITS[name]))
        for name, field in FIELD_NAMES.items()
        if name in columns
    ]
    checks.append(F.when(F.col("unit_price").isNull() | (F.col("unit_price") <= 0), TABLE_PRICE_MESSAGE))
    if numbered:
        number = order_number(F.col("requested_at"), F.col("request_id")) if number is None else number
        checks.append(F.when(~F.coalesce(F.length(number) <= LENGTH_LIMITS["order_no"], F.lit(False)), TABLE_NUMBER_MESSAGE))
    return F.array_compact(F.array(*checks))


def checked(requests: DataFrame, numbered: bool = False, number: Column | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """Normalised requests, ``asked``, the struct of what they were but for the columns ``beside``, and ``violations``: those of the
    request rules or, where a request keeps these, of the order table."""
    asked = F.struct(*[c for c in requests.columns if c not in beside])
    stored = normalise(requests.select("*", violations(requests).alias("violations"), asked.alias("asked")))
    refused = F.when(F.size("violations") == 0, table_violations(stored.columns, numbered, number)).otherwise(F.col("violations"))
    return stored.withColumn("violations", refused)


def classify(requests: DataFrame, numbered: bool = False) -> DataFrame:
    """Requests as they are with ``violations``, as ``checked`` finds them, and ``message``, their text."""
    return checked(requests, numbered).select("asked.*", "violations", F.array_join("violations", "; ").alias("message"))


def split_valid(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected requests; together they are all of them.

    A request is rejected for the request rules or, when it keeps these, for those of the order table.
    """
    told = classify(requests)
    bad = F.size("violations") > 0
    return told.where(~bad).drop("violations", "message"), told.where(bad)


def normalise(requests: DataFrame) -> DataFrame:
    return requests.withColumns(
        {
            "customer_name": trim_ctl(F.col("customer_name")),
            "customer_tier": F.upper(trim_ctl(F.col("customer_tier"))),
            "sku_code": F.upper(trim_ctl(F.col("sku_code"))),
            "unit_price": F.round("unit_price", 2).try_cast(MONEY),
        }
    )


def goods_amount(unit_price: Column, quantity: Column) -> Column:
    return F.round(unit_price * quantity, 2).cast(AMOUNT)


def risk_level(amount: Column) -> Column:
    return (
        F.when(amount >= RISK_BOUNDS["HIGH"], "HIGH").when(amount >= RISK_BOUNDS["MEDIUM"], "MEDIUM").otherwise("LOW")
    )


def shipping_fee(tier: Column, amount: Column) -> Column:
    base = F.when(amount >= FEE_BOUND, F.lit(FEE_ABOVE)).otherwise(F.lit(FEE_BELOW))
    half = F.when(amount >= FEE_BOUND, F.lit(FEE_ABOVE / 2)).otherwise(F.lit(FEE_BELOW / 2))
    fee = F.when(tier == "PLATINUM", F.lit(Decimal("0.00"))).when(tier == "GOLD", half).otherwise(base)
    return fee.cast(MONEY)


def order_status(risk: Column) -> Column:
    return F.when(risk == "HIGH", "PENDING_REVIEW").otherwise("CREATED")


def order_number(created_at: Column, key: Column) -> Column:
    """PO-<UTC time>-<14 hex digits>, 32 characters; the digits are a digest of the key, so a retry gives the same number."""
    moment = F.translate(F.substring(instant_text(created_at), 1, 19), "-T:", "")
    tail = F.upper(F.substring(F.md5(key.cast("string").cast("binary")), 1, 14))
    return F.concat(F.lit("PO-"), moment, F.lit("-"), tail)


def price(requests: DataFrame) -> DataFrame:
    """Order rows of accepted requests; ``request_id`` stays as the key of the request."""
    return price_normalised(normalise(requests))


def price_normalised(requests: DataFrame, *carried: str, number: Column | None = None) -> DataFrame:
    """As ``price``, of requests that are normalised; ``carried`` columns stay, too. ``number`` is the order number where it is made already."""
    number = order_number(F.col("requested_at"), F.col("request_id")) if number is None else number
    amount = goods_amount(F.col("unit_price"), F.col("quantity"))
    priced = requests.withColumn("_amount", amount)
    return priced.select(
        "request_id",
        number.alias("order_no"),
        "customer_name",
        "customer_tier",
        "sku_code",
        "quantity",
        "unit_price",
        shipping_fee(F.col("customer_tier"), F.col("_amount")).alias("shipping_fee"),
        risk_level(F.col("_amount")).alias("risk_level"),
        order_status(risk_level(F.col("_amount"))).alias("status"),
        "remark",
        F.col("requested_at").alias("created_at"),
        F.col("requested_at").alias("updated_at"),
        *carried,
    )


def table_checks(columns: Sequence[str] = tuple(LENGTH_LIMITS)) -> Column:
    """True for a row that the order table's own constraints allow, as far as its columns are there."""
    ok = (F.col("quantity") > 0) & (F.col("unit_price") > 0)
    for name, limit in LENGTH_LIMITS.items():
        if name not in columns:
            continue
        fits = F.length(name) <= limit
        ok = ok & (F.coalesce(fits, F.lit(True)) if name == "remark" else fits)
    return F.coalesce(ok, F.lit(False))


def responses(orders: DataFrame) -> DataFrame:
    """The 13 columns a caller sees; the amount includes shipping."""
    amount = F.round(F.col("unit_price") * F.col("quantity") + F.col("shipping_fee"), 2).cast(AMOUNT)
    head = ORDER_COLUMNS[:7]
    return orders.select(*head, amount.alias("order_amount"), *ORDER_COLUMNS[7:])


def risk_rules(spark: SparkSession) -> DataFrame:
    """The decision table: one row per tier and amount band, twelve in all."""
    bounds = [None, RISK_BOUNDS["MEDIUM"], FEE_BOUND, RISK_BOUNDS["HIGH"], None]
    rows = []
    for tier, share in (("PLATINUM", Decimal(0)), ("GOLD", Decimal("0.5")), ("OTHER", Decimal(1))):
        for lo, hi in zip(bounds, bounds[1:]):
            level = next((name for name, bound in RISK_BOUNDS.items() if lo is not None and lo >= bound), "LOW")
            fee = (FEE_ABOVE if lo is not None and lo >= FEE_BOUND else FEE_BELOW) * share
            low = Decimal(lo) if lo is not None else Decimal(-(10**20))
            high = Decimal(hi) if hi is not None else Decimal(10**20)
            rows.append((tier, low, high, level, fee.quantize(Decimal("0.01")), level == "HIGH"))
    return spark.createDataFrame(
        rows, f"tier string, lo {AMOUNT}, hi {AMOUNT}, risk_level string, shipping_fee {MONEY}, review_required boolean"
    )


def decide(orders: DataFrame, rules: DataFrame, tier: str = "customer_tier", amount: str = "amount") -> DataFrame:
    """Orders with the decision row of their tier and amount.

    The rules are a dozen rows by construction, hence the broadcast.
    """
    known = F.when(F.col(tier).isin("PLATINUM", "GOLD"), F.col(tier)).otherwise("OTHER")
    table = F.broadcast(rules.withColumnRenamed("tier", "_tier"))
    fits = (known == F.col("_tier")) & (F.col(amount) >= F.col("lo")) & (F.col(amount) < F.col("hi"))
    return orders.join(table, fits, "left").drop("_tier", "lo", "hi")


def find_order(orders: DataFrame, order_no: str) -> DataFrame:
    """The order of that number. Of the stored table only the day is read that a number made by ``order_number`` carries."""
    found = orders.where(F.col("order_no") == order_no)
    if "order_day" in orders.columns and (made := re.fullmatch(r"PO-([0-9]{8})[0-9]{6}-[0-9A-F]{14}", order_no)):
        found = found.where(F.col("order_day") == F.lit(datetime.strptime(made[1], "%Y%m%d").date()))
    return responses(found)


def check_limit(limit: int | None = None) -> int:
    chosen = DEFAULT_LIMIT if limit is None else limit
    if chosen < MIN_LIMIT:
        raise ValueError(f"limit: limit must be at least {MIN_LIMIT}")
    if chosen > MAX_LIMIT:
        raise ValueError(f"limit: limit must be at most {MAX_LIMIT}")
    return chosen


def latest_orders(orders: DataFrame, limit: int | None = None) -> DataFrame:
    """The newest orders first; equal times by order number."""
    newest = orders.orderBy(F.desc("created_at"), "order_no").limit(check_limit(limit))
    return responses(newest)


def limit_message(limit: Column) -> Column:
    """What ``check_limit`` says to a limit, null for one that it takes; a null limit is the default one."""
    low = F.when(limit < MIN_LIMIT, f"limit: limit must be at least {MIN_LIMIT}")
    return low.when(limit > MAX_LIMIT, f"limit: limit must be at most {MAX_LIMIT}")


def stored_orders(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty where nothing was stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_orders(orders: DataFrame, path: str) -> None:
    """Add order rows to the table, in one folder per UTC day of creation.

    The rows are rebalanced by day: few files per day, and several tasks for a large one. What is added to each day is noted
    beside the table before the rows are, so the notes never say too little.
    """
    by_day = orders.withColumn("order_day", F.to_date("created_at"))
    by_day.groupBy("order_day").agg(F.count("*").alias("n")).coalesce(1).write.mode("append").parquet(day_counts_path(path))
    by_day.hint("rebalance", F.col("order_day")).write.mode("append").partitionBy("order_day").parquet(path)


def day_counts_path(path: str) -> str:
    return f"{path.rstrip('/')}-days"


def newest_days(spark: SparkSession, path: str, rows: int) -> list[tuple[date, int]]:
    """The newest days of the stored table with their noted rows, newest first: ``rows`` days at most."""
    noted = stored_orders(spark, day_counts_path(path), T.StructType([T.StructField("order_day", T.DateType()), T.StructField("n", T.LongType())]))
    days = noted.where("order_day is not null").groupBy("order_day").agg(F.sum("n").alias("n"))
    return [(r["order_day"], r["n"]) for r in days.orderBy(F.desc("order_day")).limit(rows).collect()]


def latest_stored(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``latest_orders`` of the stored table, reading from the newest day backwards.

    The notes say after how many days enough rows are there; these folders alone are read. A note of an append that broke off may
    count rows that never came: then more days are taken, and all of them in the end.
    """
    wanted = check_limit(limit)
    orders = spark.read.parquet(path)
    days, taken = newest_days(spark, path, wanted), 0
    while taken < len(days):
        noted = 0
        while taken < len(days) and noted < wanted:
            noted, taken = noted + days[taken][1], taken + 1
        newest = orders.where(F.col("order_day") >= F.lit(days[taken - 1][0]))
        if newest.limit(wanted).count() == wanted:
            return latest_orders(newest, limit)
    return latest_orders(orders, limit)


def violation_summary(requests: DataFrame) -> DataFrame:
    """Rejected requests per message, of the request rules and of the order table."""
    messages = classify(requests).select(F.explode("violations").alias("message"))
    return messages.groupBy("message").agg(F.count("*").alias("rejected"))
