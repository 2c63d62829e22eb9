"""Order intake and reads: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions.cells import instant_text
from sparkdesk.operators import orders as O
from sparkdesk.operators.keyed import first_per_key, insert_if_absent
from sparkdesk.plans.inputs import requests, table, utc
from sparkdesk.plans.sqltext import iso_instant
from sparkdesk.session import scratch_path


def priced(spark: SparkSession, d: str) -> DataFrame:
    accepted, _ = O.split_valid(requests(spark, d))
    return O.price(accepted).where(O.table_checks())


_STORED: dict[tuple[str, str], str] = {}


def stored(spark: SparkSession, d: str) -> str:
    """The path of all orders as the order table, one folder per day; written once in a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORED:
        path = scratch_path(spark, "orders")
        O.append_orders(priced(spark, d), path)
        _STORED[key] = path
    return _STORED[key]


def _shown(df: DataFrame) -> DataFrame:
    times = {name: instant_text(F.col(name)) for name in ("created_at", "updated_at") if name in df.columns}
    return df.withColumns(times)


def order_normalise(spark: SparkSession, d: str) -> DataFrame:
    return O.normalise(requests(spark, d)).select("request_id", "customer_name", "customer_tier", "sku_code", "unit_price")


def _amounts(spark: SparkSession, d: str) -> DataFrame:
    """Line items as goods: price and whole quantity, and a tier by supplier."""
    tiers = F.element_at(F.array(F.lit("PLATINUM"), F.lit("GOLD"), F.lit("SILVER")), (F.col("l_suppkey") % 3 + 1).cast("int"))
    unit = F.round(F.col("l_extendedprice").cast("decimal(12,2)") / 100, 2).cast(O.MONEY)
    items = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", tiers.alias("customer_tier"), unit.alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    return items.withColumn("amount", O.goods_amount(F.col("unit_price"), F.col("quantity")))


def order_amount_goods(spark: SparkSession, d: str) -> DataFrame:
    return _amounts(spark, d)


def order_risk(spark: SparkSession, d: str) -> DataFrame:
    return _amounts(spark, d).select("l_orderkey", "l_linenumber", "amount", O.risk_level(F.col("amount")).alias("risk"))


def order_shipping(spark: SparkSession, d: str) -> DataFrame:
    fee = O.shipping_fee(F.col("customer_tier"), F.col("amount")).alias("fee")
    return _amounts(spark, d).select("l_orderkey", "l_linenumber", "customer_tier", "amount", fee)


def order_status(spark: SparkSession, d: str) -> DataFrame:
    status = O.order_status(O.risk_level(F.col("amount"))).alias("status")
    return _amounts(spark, d).groupBy(status).agg(F.count("*").alias("items"))


def order_number(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return events.select("event_id", O.order_number(utc(F.col("ts")), F.col("event_id")).alias("order_no"))


def order_response(spark: SparkSession, d: str) -> DataFrame:
    return _shown(O.responses(priced(spark, d)))


def order_violations(spark: SparkSession, d: str) -> DataFrame:
    return O.validate(requests(spark, d)).select("request_id", F.size("violations").alias("n"), "message")


def order_valid(spark: SparkSession, d: str) -> DataFrame:
    accepted, rejected = O.split_valid(requests(spark, d))
    kept = O.price(accepted).where(O.table_checks()).select("request_id", F.lit("accepted").alias("outcome"))
    return kept.unionByName(rejected.select("request_id", F.lit("rejected").alias("outcome")))


def order_by_key(spark: SparkSession, d: str) -> DataFrame:
    """The order of the smallest accepted request by its number, read from the stored table; a second number has no match."""
    orders = spark.read.parquet(stored(spark, d))
    wanted = orders.agg(F.min_by("order_no", "request_id")).first()[0]
    return _shown(O.find_order(orders, wanted).unionByName(O.find_order(orders, "PO-20240101000000-00000000000000")))


def limit_bounds(spark: SparkSession, d: str) -> DataFrame:
    return _shown(O.latest_stored(spark, stored(spark, d), 100))


def limit_checks(spark: SparkSession, d: str) -> DataFrame:
    """Each event as a request for the latest orders, with the limit that holds or what is said to it."""
    asked = F.get_json_object("props", "$.k").cast("int") * 2 - 50
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, asked).alias("asked"))
    message = O.limit_message(F.col("asked"))
    chosen = F.when(message.isNull(), F.coalesce("asked", F.lit(O.DEFAULT_LIMIT)))
    return rows.select("event_id", "asked", chosen.alias("chosen"), message.alias("message"))


def latest_orders(spark: SparkSession, d: str) -> DataFrame:
    return _shown(O.latest_stored(spark, stored(spark, d)))


def order_decision(spark: SparkSession, d: str) -> DataFrame:
    decided = O.decide(_amounts(spark, d), O.risk_rules(spark))
    return decided.select("l_orderkey", "l_linenumber", "amount", "risk_level", "shipping_fee", "review_required")


_ITEM_KEYS = ["l_orderkey", "l_linenumber"]


def _items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(*_ITEM_KEYS, "l_partkey", "l_suppkey", "l_extendedprice")


def _item_order() -> list:
    return [F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")]


def first_of_key(spark: SparkSession, d: str) -> DataFrame:
    return first_per_key(_items(spark, d), _ITEM_KEYS, _item_order())


def insert_absent(spark: SparkSession, d: str) -> DataFrame:
    """Line items whose key no line item of an even part has."""
    items = _items(spark, d)
    return insert_if_absent(items, items.where("l_partkey % 2 = 0"), _ITEM_KEYS, _item_order())


def order_append(spark: SparkSession, d: str) -> DataFrame:
    """Two appends, read back: large orders first, then the rest."""
    path = scratch_path(spark, "orders")
    orders = priced(spark, d)
    O.append_orders(orders.where("risk_level = 'HIGH'"), path)
    O.append_orders(orders.where("risk_level <> 'HIGH'"), path)
    stored = spark.read.parquet(path)
    return _shown(stored.select(*O.ORDER_COLUMNS, F.col("order_day").cast("string").alias("order_day")))


def violation_summary(spark: SparkSession, d: str) -> DataFrame:
    return O.violation_summary(requests(spark, d))


QUERIES = {
    "order_normalise": order_normalise,
    "order_amount_goods": order_amount_goods,
    "order_risk": order_risk,
    "order_shipping": order_shipping,
    "order_status": order_status,
    "order_number": order_number,
    "order_response": order_response,
    "order_violations": order_violations,
    "order_valid": order_valid,
    "order_by_key": order_by_key,
    "limit_bounds": limit_bounds,
    "limit_checks": limit_checks,
    "latest_orders": latest_orders,
    "order_decision": order_decision,
    "first_per_key": first_of_key,
    "insert_if_absent": insert_absent,
    "order_append": order_append,
    "violation_summary": violation_summary,
}


_TRIM = "trim({}, ' ' || chr(9) || chr(10))"
_NUMBER = "'PO-' || strftime({ts}, '%Y%m%d%H%M%S') || '-' || upper(substr(md5({key}::varchar), 1, 14))"

REQUESTS_SQL = f"""
    requests as (
        select event_id as request_id,
               case when user_id % 50 = 7 then ' ' || chr(9) || ' ' when event_id % 103 = 11 then repeat(c_name, 4) else ' ' || c_name || chr(10) end as customer_name,
               case c_mktsegment when 'MACHINERY' then ' platinum' when 'FURNITURE' then 'Gold' || chr(9) else 'silver' end
                   as customer_tier,
               lower(p_brand || '-' || p_partkey) as sku_code,
               (props->>'$.k')::int as quantity,
               case when event_id % 89 = 3 then 0 when event_id % 101 = 9 then 99999999999 when event_id % 97 <> 5 then value::decimal(12,2) * 1.005::decimal(4,3) end
                   ::decimal(16,5) as unit_price,
               ts as requested_at
        from events left join customer on c_custkey = user_id
             left join part on p_partkey = event_id % (select count(*) from part)),
    asked as (
        select *, [x for x in [
            case when coalesce({_TRIM.format('customer_name')}, '') = '' then 'customerName: customerName must not be blank' end,
            case when coalesce({_TRIM.format('customer_tier')}, '') = '' then 'customerTier: customerTier must not be blank' end,
            case when coalesce({_TRIM.format('sku_code')}, '') = '' then 'skuCode: skuCode must not be blank' end,
            case when quantity < 1 then 'quantity: quantity must be greater than 0' end,
            case when unit_price is null then 'unitPrice: unitPrice must not be null' end,
            case when unit_price < 0.01 then 'unitPrice: unitPrice must be greater than 0' end]
            if x is not null] as broken
        from requests),
    checked as (
        select * exclude (broken), case when len(broken) > 0 then broken else [x for x in [
            case when length({_TRIM.format('customer_name')}) > 64 then 'customerName: the order table takes at most 64 characters' end,
            case when unit_price >= 10000000000 then 'unitPrice: the order table takes at most 10 digits before the point' end]
            if x is not null] end as violations
        from asked),
    normal as (
        select request_id, {_TRIM.format('customer_name')} as customer_name, upper({_TRIM.format('customer_tier')}) as customer_tier,
               upper(sku_code) as sku_code, quantity, try_cast(round(unit_price, 2) as decimal(12,2)) as unit_price, requested_at
        from requests),
    amounts as (
        select *, (unit_price * quantity)::decimal(24,2) as amount
        from normal where request_id in (select request_id from checked where len(violations) = 0)),
    priced as (
        select request_id, {_NUMBER.format(ts='requested_at', key='request_id')} as order_no, customer_name, customer_tier,
               sku_code, quantity, unit_price,
               (case customer_tier when 'PLATINUM' then 0 when 'GOLD' then case when amount >= 500 then 6 else 12 end
                else case when amount >= 500 then 12 else 24 end end)::decimal(12,2) as shipping_fee,
               case when amount >= 1000 then 'HIGH' when amount >= 300 then 'MEDIUM' else 'LOW' end as risk_level,
               case when amount >= 1000 then 'PENDING_REVIEW' else 'CREATED' end as status,
               null::varchar as remark, requested_at as created_at, requested_at as updated_at
        from amounts)"""

_AMOUNTS = """
    items as (
        select l_orderkey, l_linenumber, ['PLATINUM', 'GOLD', 'SILVER'][l_suppkey % 3 + 1] as customer_tier,
               ((l_extendedprice::decimal(12,2) * 100)::bigint // 100 + case when (l_extendedprice::decimal(12,2) * 100)::bigint % 100 >= 50
                then 1 else 0 end)::decimal(14,0) / 100 as u,
               l_quantity::int as quantity
        from lineitem),
    amounts as (
        select l_orderkey, l_linenumber, customer_tier, u::decimal(12,2) as unit_price, quantity,
               (u::decimal(12,2) * quantity)::decimal(24,2) as amount
        from items)"""
_RISK = "case when amount >= 1000 then 'HIGH' when amount >= 300 then 'MEDIUM' else 'LOW' end"
_FEE = """(case customer_tier when 'PLATINUM' then 0 when 'GOLD' then case when amount >= 500 then 6 else 12 end
           else case when amount >= 500 then 12 else 24 end end)::decimal(12,2)"""

_RESPONSE = f"""
    select order_no, customer_name, customer_tier, sku_code, quantity, unit_price, shipping_fee,
           (unit_price * quantity + shipping_fee)::decimal(24,2) as order_amount, risk_level, status, remark,
           {iso_instant('created_at')} as created_at, {iso_instant('updated_at')} as updated_at
    from priced"""

ORACLE = {
    "order_normalise": f"""
        with {REQUESTS_SQL}
        select request_id, customer_name, customer_tier, sku_code, unit_price from normal""",
    "order_amount_goods": f"with {_AMOUNTS} select * from amounts",
    "order_risk": f"with {_AMOUNTS} select l_orderkey, l_linenumber, amount, {_RISK} as risk from amounts",
    "order_shipping": f"with {_AMOUNTS} select l_orderkey, l_linenumber, customer_tier, amount, {_FEE} as fee from amounts",
    "order_status": f"""
        with {_AMOUNTS}
        select case when amount >= 1000 then 'PENDING_REVIEW' else 'CREATED' end as status, count(*) as items
        from amounts group by 1""",
    "order_number": f"select event_id, {_NUMBER.format(ts='ts', key='event_id')} as order_no from events",
    "order_response": f"with {REQUESTS_SQL} {_RESPONSE}",
    "order_violations": f"""
        with {REQUESTS_SQL}
        select request_id, len(broken)::int as n, array_to_string(broken, '; ') as message from asked""",
    "order_valid": f"""
        with {REQUESTS_SQL}
        select request_id, case when len(violations) = 0 then 'accepted' else 'rejected' end as outcome from checked""",
    "order_by_key": f"with {REQUESTS_SQL} {_RESPONSE} where order_no = (select arg_min(order_no, request_id) from priced)",
    "limit_bounds": f"""
        with {REQUESTS_SQL}, top as (select * from priced order by created_at desc, order_no limit 100)
        {_RESPONSE.replace('from priced', 'from top')}""",
    "limit_checks": """
        with asked as (select event_id, case when event_id % 7 <> 0 then (props->>'$.k')::int * 2 - 50 end as asked from events)
        select *, case when asked is null then 10 when asked between 1 and 100 then asked end as chosen,
               case when asked < 1 then 'limit: limit must be at least 1' when asked > 100 then 'limit: limit must be at most 100' end as message
        from asked""",
    "latest_orders": f"""
        with {REQUESTS_SQL}, top as (select * from priced order by created_at desc, order_no limit 10)
        {_RESPONSE.replace('from priced', 'from top')}""",
    "order_decision": f"""
        with {_AMOUNTS}
        select l_orderkey, l_linenumber, amount, {_RISK} as risk_level, {_FEE} as shipping_fee,
               amount >= 1000 as review_required
        from amounts""",
    "first_per_key": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) = 1""",
    "insert_if_absent": """
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice from lineitem l
        where not exists (select 1 from lineitem e where e.l_partkey % 2 = 0
                          and e.l_orderkey = l.l_orderkey and e.l_linenumber = l.l_linenumber)
        qualify row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_extendedprice) = 1""",
    "order_append": f"""
        with {REQUESTS_SQL}
        select * exclude (request_id, created_at, updated_at), {iso_instant('created_at')} as created_at,
               {iso_instant('updated_at')} as updated_at, created_at::date::varchar as order_day
        from priced""",
    "violation_summary": f"""
        with {REQUESTS_SQL}
        select message, count(*) as rejected from (select unnest(violations) as message from checked) group by 1""",
}
