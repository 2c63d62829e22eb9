"""Orders, jobs and tokens: literal cases, and streams against their batch form."""

import base64
import datetime as dt
import hashlib
import hmac
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import jobs as J
from sparkdesk.operators import keyed as K
from sparkdesk.operators import orders as O
from sparkdesk.operators import tokens as T
from sparkdesk.sources.seeds import seed_orders
from sparkdesk.streaming.jobs import current_records, stream_job_fold
from sparkdesk.streaming.orders import add_orders, outcomes

REQUEST = (
    "request_id string, customer_name string, customer_tier string, sku_code string, quantity int, "
    "unit_price decimal(14,4), remark string, requested_at timestamp"
)
AT = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)


def request(spark, *rows):
    return spark.createDataFrame([(*r[:4], r[4], r[5] and Decimal(r[5]), None, AT) for r in rows], REQUEST)


def test_normalise_and_number(spark):
    df = request(spark, ("k", " Cathy\t", " gold", "pg-ha-case ", 3, "199"), ("l", "n", "x", "s", 1, "0.015"))
    rows = O.price(df).orderBy("request_id").collect()
    assert (rows[0]["customer_name"], rows[0]["customer_tier"], rows[0]["sku_code"]) == ("Cathy", "GOLD", "PG-HA-CASE")
    assert rows[0]["order_no"] == "PO-20240506070809-" + hashlib.md5(b"k").hexdigest()[:14].upper()
    assert (rows[0]["shipping_fee"], rows[0]["risk_level"], rows[0]["status"]) == (Decimal("6.00"), "MEDIUM", "CREATED")
    assert rows[1]["unit_price"] == Decimal("0.02")


def test_response_amount(spark):
    df = O.price(request(spark, ("k", "Cathy", "gold", "pg-ha-case", 3, "199"))).withColumn("shipping_fee", F.lit(Decimal("12.00")))
    assert O.responses(df).first()["order_amount"] == Decimal("609.00")
    assert len(O.responses(df).columns) == 13


@pytest.mark.parametrize("tier", ["PLATINUM", "GOLD", "SILVER"])
def test_rules_and_table_agree(spark, tier):
    amounts = [Decimal(x) for x in ("0.01", "299.99", "300", "499.99", "500", "999.99", "1000", "99999999999.99")]
    df = spark.createDataFrame([(tier, a) for a in amounts], "customer_tier string, amount decimal(24,2)")
    ruled = df.select("amount", O.risk_level(F.col("amount")).alias("r"), O.shipping_fee(F.col("customer_tier"), F.col("amount")).alias("f"))
    decided = O.decide(df, O.risk_rules(spark)).select("amount", "risk_level", "shipping_fee")
    got = sorted(map(tuple, ruled.collect()))
    assert got == sorted(map(tuple, decided.collect()))
    base = {"PLATINUM": (0, 0), "GOLD": (12, 6), "SILVER": (24, 12)}[tier]
    assert [(r, f) for _, r, f in got] == [
        ("LOW", base[0]), ("LOW", base[0]), ("MEDIUM", base[0]), ("MEDIUM", base[0]), ("MEDIUM", base[1]), ("MEDIUM", base[1]),
        ("HIGH", base[1]), ("HIGH", base[1]),
    ]


def test_violations(spark):
    df = request(
        spark, ("a", "n", "t", "s", 1, "0.01"), ("b", " ", None, "s", 0, "0.005"), ("c", "n", "t", "\t", None, None),
    )
    got = {r["request_id"]: r["message"] for r in O.validate(df).collect()}
    assert got == {
        "a": "",
        "b": "customerName: customerName must not be blank; customerTier: customerTier must not be blank; "
        "quantity: quantity must be greater than 0; unitPrice: unitPrice must be greater than 0",
        "c": "skuCode: skuCode must not be blank; quantity: quantity must be greater than 0; unitPrice: unitPrice must not be null",
    }
    accepted, rejected = O.split_valid(df)
    assert [r["request_id"] for r in accepted.collect()] == ["a"] and rejected.count() == 2
    assert {tuple(r) for r in O.violation_summary(df).collect()} >= {("quantity: quantity must be greater than 0", 2)}


def test_table_checks(spark):
    df = O.price(request(spark, ("a", "n" * 65, "t", "s", 1, "1"), ("b", "n", "t", "s", 1, "1"), ("c", "n", "t", "s" * 65, 1, "1"),
                         ("d", "n", "t", "s", 1, "9999999999.994"), ("e", "n", "t", "s", 1, "9999999999.999")))
    assert sorted(r["request_id"] for r in df.where(O.table_checks()).collect()) == ["b", "d"]


@pytest.mark.parametrize("limit, ok", [(None, 10), (1, 1), (100, 100), (0, None), (101, None)])
def test_limit(limit, ok):
    if ok:
        assert O.check_limit(limit) == ok
    else:
        with pytest.raises(ValueError):
            O.check_limit(limit)


def test_latest_uses_top_n(spark):
    df = O.price(request(spark, ("a", "n", "t", "s", 1, "1")))
    assert "TakeOrderedAndProject" in O.latest_orders(df)._jdf.queryExecution().executedPlan().toString()


def test_seed_rows_load_once(spark):
    now = F.lit("2024-01-01 00:15:00").cast("timestamp")
    seeds = seed_orders(spark, now)
    rows = {r["order_no"]: r for r in seeds.collect()}
    assert rows["PO-DEMO-0001"]["created_at"] == dt.datetime(2024, 1, 1, 0, 0)
    assert rows["PO-DEMO-0002"]["created_at"] == dt.datetime(2024, 1, 1, 0, 7)
    assert K.insert_if_absent(seeds, seeds, ["order_no"], [F.col("created_at")]).count() == 0


def test_adding_orders_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "orders")
    df = request(spark, ("a", "n", "t", "s", 1, "1"), ("a", "n", "t", "s", 1, "1"), ("b", "", "t", "s", 1, "1"), ("c", "n", "t", "s", 2, "3"))
    add_orders(df, path)
    add_orders(df, path)
    stored = spark.read.parquet(path)
    assert sorted(r["request_id"] for r in stored.collect()) == ["a", "c"]
    add_orders(df.where("request_id = 'b'"), path)
    assert spark.read.parquet(path).count() == 2


LOG = (
    "submission_id string, seq int, ts timestamp, kind string, job_name string, queue string, application_id string, "
    "launcher_state string, yarn_state string, final_status string, tracking_url string, last_error string"
)


def change(key, seq, kind, **values):
    fields = ["job_name", "queue", "application_id", "launcher_state", "yarn_state", "final_status", "tracking_url", "last_error"]
    return (key, seq, AT + dt.timedelta(seconds=seq), kind, *[values.get(f) for f in fields])


CHANGES = [
    change("a", 1, "insert", job_name="j", queue="q"),
    change("a", 2, "launcher_state", launcher_state="LAUNCHING"),
    change("a", 3, "application_id", application_id="application_1_1"),
    change("a", 4, "last_error", last_error="x"),
    change("a", 5, "last_error", last_error=None),
    change("a", 6, "yarn_status", yarn_state="RUNNING", final_status="UNDEFINED", tracking_url="u"),
    change("b", 1, "launcher_state", launcher_state="EARLY"),
    change("b", 2, "insert", job_name="k", queue="q"),
    change("c", 1, "last_error", last_error="no insert"),
    change("d", 1, "insert", job_name="old", queue="q"),
    change("d", 2, "application_id", application_id="application_1_2"),
    change("d", 3, "insert", job_name="new", queue="r"),
    change("d", 4, "last_error", last_error="late"),
]


def by_hand(changes):
    """The store as a dictionary, one change after another."""
    store = {}
    for key, seq, ts, kind, job, queue, app, launcher, yarn, final, url, error in sorted(changes, key=lambda c: c[1]):
        if kind == "insert":
            store[key] = [job, queue, None, "SUBMITTED", "APP_ID_PENDING", None, None, None, ts, ts]
        elif key in store:
            record = store[key]
            record[9] = ts
            if kind == "application_id":
                record[2] = app
            elif kind == "launcher_state":
                record[3] = launcher
            elif kind == "yarn_status":
                record[4:7] = yarn, final, url
            else:
                record[7] = error
    return {k: tuple(v) for k, v in store.items()}


def test_fold(spark):
    df = spark.createDataFrame(CHANGES, LOG)
    got = {r[0]: tuple(r)[1:] for r in J.fold(df.orderBy(F.rand(1)), F.col("seq")).collect()}
    assert got == by_hand(CHANGES)


def test_stream_fold_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(CHANGES, LOG)
    for part in df.randomSplit([1.0, 1.0, 1.0], 3):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    stream_job_fold(stream, F.struct("ts", "seq"), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = {r[0]: tuple(r)[1:] for r in current_records(spark, str(tmp_path / "out")).collect()}
    assert got == by_hand(CHANGES)


def test_job_status(spark):
    records = J.fold(spark.createDataFrame(CHANGES, LOG), F.col("seq")).withColumn(
        "application_id", F.when(F.col("submission_id") == "b", " ").otherwise(F.col("application_id"))
    )
    reports = spark.createDataFrame(
        [("application_1_1", "FINISHED", "SUCCEEDED", None, AT)],
        "application_id string, yarn_state string, final_status string, tracking_url string, reported_at timestamp",
    )
    got = {r["submission_id"]: r for r in J.job_status(records, reports, "http://r").collect()}
    assert (got["a"]["yarn_state"], got["a"]["final_status"], got["a"]["tracking_url"]) == ("FINISHED", "SUCCEEDED", None)
    assert got["a"]["router_tracking_url"] == "http://r/cluster/app/application_1_1"
    assert (got["b"]["yarn_state"], got["b"]["router_tracking_url"]) == ("APP_ID_PENDING", None)


def b64(data):
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def token(key, claims, alg="HS256", name=None):
    digest = {"HS256": hashlib.sha256, "HS384": hashlib.sha384, "HS512": hashlib.sha512}[alg]
    body = f"{b64(json.dumps({'alg': name or alg}).encode())}.{b64(json.dumps(claims).encode())}"
    return f"{body}.{b64(hmac.new(key, body.encode(), digest).digest())}"


@pytest.mark.parametrize("alg, size", [("HS256", 32), ("HS256", 47), ("HS384", 48), ("HS512", 64), ("HS512", 128)])
def test_tokens(spark, alg, size):
    key = bytes((7 * i) % 256 for i in range(size))
    now = 1_700_000_000
    user = json.dumps({"id": "1", "username": "ü", "roles": ["r"], "permissions": [], "expiry": now * 1000, "more": 1})
    good = token(key, {"userInfo": user, "exp": now + 1}, alg)
    changed = good.split(".")
    changed[1] = b64(json.dumps({"userInfo": user, "exp": now + 999}).encode())
    cases = {
        good: "ok",
        token(key, {"userInfo": user}, alg): "ok",
        token(key, {"userInfo": user, "exp": now - 1}, alg): "expired",
        token(key, {"userInfo": user, "nbf": now + 5}, alg): "not_yet_valid",
        token(key[::-1], {"userInfo": user}, alg): "bad_signature",
        ".".join(changed): "bad_signature",
        token(key, {"userInfo": user}, alg, "none"): "wrong_algorithm",
        good.rsplit(".", 1)[0] + ".": "bad_signature",
        good.rsplit(".", 1)[0] + ".*": "bad_signature",
        "a.b": "malformed",
        "*.*.*": "malformed",
        "": "malformed",
    }
    df = spark.createDataFrame([(t,) for t in cases] + [(None,)], "t string")
    rows = T.verify(df, "t", key, F.timestamp_seconds(F.lit(now))).collect()
    assert {r["t"]: r["token_status"] for r in rows} == {**cases, None: "malformed"}
    first = next(r for r in rows if r["t"] == good)["user"]
    assert (first["id"], first["username"], first["roles"], first["permissions"]) == ("1", "ü", ["r"], [])
    assert first["expiry"] == dt.datetime(2023, 11, 14, 22, 13, 20)
    assert all(r["user"] is None for r in rows if r["token_status"] != "ok")


def test_short_key():
    with pytest.raises(ValueError):
        T.algorithm_for(bytes(31))


def test_effective_expiry(spark):
    created = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for expiry, want in [("2024-01-01 01:00:00", 2), ("2024-01-01 03:00:00", 3), (None, 2)]:
        got = spark.range(1).select(T.effective_expiry(F.lit(expiry).cast("timestamp"), created)).first()[0]
        assert got == dt.datetime(2024, 1, 1, want)


def test_no_request_vanishes(spark):
    from datetime import datetime

    at = datetime(2024, 1, 2)
    rows = [("a", "Ann", "9.99"), ("b", "n" * 70, "9.99"), ("c", "Cy", "99999999999.00"), ("d", " ", "1.00")]
    df = spark.createDataFrame([(i, n, "gold", "s-1", 2, Decimal(p), None, at) for i, n, p in rows],
        "request_id string, customer_name string, customer_tier string, sku_code string, quantity int, unit_price decimal(16,5), remark string, requested_at timestamp")
    accepted, rejected = O.split_valid(df)
    assert [r.request_id for r in accepted.collect()] == ["a"] and accepted.columns == df.columns
    found = {r.request_id: (r.customer_name, r.message) for r in rejected.collect()}
    assert found.keys() == {"b", "c", "d"}
    assert found["b"] == ("n" * 70, "customerName: the order table takes at most 64 characters")
    assert found["c"][1] == O.TABLE_PRICE_MESSAGE and "customerName" in found["d"][1]
    counted = {r.message: r.rejected for r in O.violation_summary(df).collect()}
    assert counted == {found[i][1]: 1 for i in "bcd"}


def test_seed_rows_are_appended(spark, tmp_path):
    from sparkdesk.sources.seeds import seed_orders

    path = str(tmp_path / "orders")
    seeds = seed_orders(spark)
    O.append_orders(seeds, path)
    back = spark.read.parquet(path)
    assert back.count() == seeds.count() and back.where("order_day != to_date(created_at)").isEmpty()


def test_find_order_reads_one_day(spark, tmp_path):
    path = str(tmp_path / "orders")
    O.append_orders(O.price(request(spark, ("a", "n", "t", "s", 1, "1"), ("b", "n", "t", "s", 1, "1"))), path)
    stored = spark.read.parquet(path)
    wanted = stored.where("request_id = 'a'").first()["order_no"]
    found = O.find_order(stored, wanted)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "order_day" in plan.split("PartitionFilters: ")[1].split("PushedFilters: ")[0]
    assert "EqualTo(order_no" in plan.split("PushedFilters: ")[1]
    assert [r["order_no"] for r in found.collect()] == [wanted]
    assert O.find_order(stored, "PO-DEMO-0001").isEmpty()


def test_stream_keeps_what_it_does_not_store(spark, tmp_path):
    from datetime import datetime

    from sparkdesk.streaming.orders import stream_orders

    at, schema = datetime(2024, 1, 2), "request_id string, customer_name string, customer_tier string, sku_code string, quantity int, unit_price decimal(16,5), remark string, requested_at timestamp"
    batches = [[("a", "Ann", at), ("b", " ", at), ("c", "Cy", None), ("a", "Ann", at)], [("a", "Ann", at), ("d", "Di", at), ("e", "n" * 70, at)]]
    landed, path = str(tmp_path / "landed"), str(tmp_path / "orders")
    frames = [spark.createDataFrame([(i, n, "gold", "s-1", 2, Decimal("9.99"), None, t) for i, n, t in rows], schema) for rows in batches]
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        stream_orders(stream, path, str(tmp_path / "ckpt")).awaitTermination()

    def found():
        told = outcomes(spark, f"{path}-aside").collect()
        assert {r.request.request_id for r in told if r.outcome == "stored"} == {r.request_id for r in spark.read.parquet(path).collect()}
        return sorted((r.outcome, r.request.request_id) for r in told), {r.request.request_id: r.message for r in told if r.outcome == "rejected"}

    want = [("conflict", "a"), ("conflict", "a"), *[("rejected", i) for i in "bce"], ("stored", "a"), ("stored", "d")]
    rows, messages = found()
    assert rows == want and spark.read.parquet(path).count() == 2
    assert "customerName" in messages["b"] and messages["c"] == O.TABLE_NUMBER_MESSAGE and "64" in messages["e"]
    # A batch that is run again after its orders were stored changes nothing.
    for k, frame in enumerate(frames):
        add_orders(frame, path, f"{path}-aside", k)
    assert found()[0] == want and spark.read.parquet(path).count() == 2


def test_batch_that_broke_off_before_its_orders(spark, tmp_path, monkeypatch):
    """Decided, then lost before the append: the rerun stores what was decided."""
    from sparkdesk.streaming import orders as S

    path, df = str(tmp_path / "orders"), request(spark, ("a", "n", "t", "s", 1, "1"), ("b", "n", "t", "s", 1, "1"), ("c", "", "t", "s", 1, "1"))
    with monkeypatch.context() as m:
        m.setattr(S, "append_orders", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            add_orders(df, path, f"{path}-aside", 0)
    assert O.stored_orders(spark, path, df.schema).isEmpty()
    add_orders(df, path, f"{path}-aside", 0)
    add_orders(df, path, f"{path}-aside", 1)
    assert sorted(r.request_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert sorted((r.outcome, r.request.request_id) for r in outcomes(spark, f"{path}-aside").collect()) == [
        ("conflict", "a"), ("conflict", "b"), ("rejected", "c"), ("rejected", "c"), ("stored", "a"), ("stored", "b"),
    ]


def test_batch_of_one_file_is_dealt_out(spark, tmp_path):
    """A batch that comes in one task is classified in several, by key; requests without a key do not meet, and no key meets twice."""
    from datetime import datetime

    from sparkdesk.streaming import orders as S

    schema = "request_id string, customer_name string, customer_tier string, sku_code string, quantity int, unit_price decimal(16,5), remark string, requested_at timestamp"
    at, price = datetime(2024, 1, 2), Decimal("9.99")
    good = [(f"r{i % 150}", "Ann", "gold", "s-1", 2, price, None, at) for i in range(300)]
    bad = [(None if i % 2 else f"r{i}", "Ann", "gold", f"s-{i}", 2, price, None, at if i % 2 else None) for i in range(100)]
    frame = spark.createDataFrame([*good, *bad], schema).coalesce(1)
    marked = S.classified(frame).withColumn("task", F.spark_partition_id())
    frames = {"keyed": "message is null", "unkeyed": "message is not null"}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = {name: marked.where(rule).agg(F.count_distinct("task")).first()[0] for name, rule in frames.items()}
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks["keyed"] > 1 and tasks["unkeyed"] > 1
    # The requests move once, before anything of them is classified.
    assert plan.count("Exchange") == 1 and plan.index("Window") < plan.index("array_join") < plan.index("Exchange")
    path = str(tmp_path / "orders")
    for k in (0, 1):
        add_orders(frame, path, f"{path}-aside", k)
    told = {(r.batch_id, r.outcome): r["count"] for r in outcomes(spark, f"{path}-aside").groupBy("batch_id", "outcome").count().collect()}
    assert told == {(0, "stored"): 150, (0, "conflict"): 150, (0, "rejected"): 100, (1, "conflict"): 300, (1, "rejected"): 100}
    assert spark.read.parquet(path).count() == 150
    assert all(r.request.asDict().keys() == set(frame.columns) for r in outcomes(spark, f"{path}-aside").take(3))


def test_latest_reads_the_newest_days(spark, tmp_path):
    path = str(tmp_path / "orders")
    rows = spark.range(300).select(
        F.col("id").alias("request_id"), *[F.lit("x").alias(c) for c in ("customer_name", "customer_tier", "sku_code", "remark")],
        F.lit(1).alias("quantity"), F.lit(Decimal("1.00")).alias("unit_price"),
        # Seven orders a day, many of one time.
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 7) * 86_400 + F.col("id") % 2).alias("requested_at"),
    )
    orders = O.price(rows)
    O.append_orders(orders.where("request_id % 3 = 0"), path)
    O.append_orders(orders.where("request_id % 3 <> 0"), path)
    for limit in (1, 6, 13, 100):
        found = O.latest_stored(spark, path, limit)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in O.latest_orders(orders, limit).collect()]
        filters = found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
        assert "order_day" in filters and ">=" in filters
    days = {f.split("order_day=")[1][:10] for f in O.latest_stored(spark, path, 13).inputFiles()}
    assert days  # the reader lists all; the filter above leaves two of them to read
    # A note on rows that never came only makes the search go on.
    spark.sql("select date'2030-01-01' as order_day, 1000L as n").write.mode("append").parquet(O.day_counts_path(path))
    assert [tuple(r) for r in O.latest_stored(spark, path, 13).collect()] == [tuple(r) for r in O.latest_orders(orders, 13).collect()]
    assert O.latest_stored(spark, path, 100).count() == 100


def test_seeds_loaded_twice(spark, tmp_path):
    from sparkdesk.sources.seeds import load_seeds

    for path, first in ((str(tmp_path / "new"), 0), (str(tmp_path / "old"), 1)):
        if first:
            O.append_orders(O.price(request(spark, ("a", "n", "t", "s", 1, "1"))), path)
        load_seeds(spark, path)
        load_seeds(spark, path)
        assert spark.read.parquet(path).count() == 2 + first


@pytest.mark.parametrize("limit", [None, -1, 0, 1, 100, 101])
def test_limit_messages(spark, limit):
    said = spark.range(1).select(O.limit_message(F.lit(limit).cast("int"))).first()[0]
    if said is None:
        O.check_limit(limit)
    else:
        with pytest.raises(ValueError, match=said):
            O.check_limit(limit)
