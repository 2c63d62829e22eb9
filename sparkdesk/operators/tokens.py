"""Signed tokens in a column: signature, expiry and claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.jsons import json_parse

# Algorithm -> digest bits, block bytes, least key bytes.
ALGORITHMS = {"HS256": (256, 64, 32), "HS384": (384, 128, 48), "HS512": (512, 128, 64)}
USER_SCHEMA = "id string, username string, roles array<string>, permissions array<string>, expiry string"
DEFAULT_LIFE = "interval 2 hours"


def algorithm_for(key: bytes) -> str:
    """The strongest algorithm that the key is long enough for."""
    fitting = [name for name, (_, _, least) in ALGORITHMS.items() if len(key) >= least]
    if not fitting:
        raise ValueError("the key must have 32 bytes or more")
    return fitting[-1]


def _digest(c: Column, bits: int) -> Column:
    return F.unhex(F.sha2(c, bits))


def hmac(message: Column, key: bytes, algorithm: str) -> Column:
    """HMAC of a text column as bytes, from Spark's own SHA-2 and two key pads."""
    bits, block, _ = ALGORITHMS[algorithm]
    if len(key) > block:
        raise ValueError(f"the key must not exceed {block} bytes")
    padded = key.ljust(block, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in padded)) for pad in (0x36, 0x5C))
    return _digest(F.concat(outer, _digest(F.concat(inner, message.cast("binary")), bits)), bits)


def base64url(c: Column) -> Column:
    return F.rtrim(F.translate(F.base64(c), "+/\r\n", "-_"), F.lit("="))


def from_base64url(c: Column) -> Column:
    """Bytes, or null for a text that is not Base64."""
    text = F.translate(c, "-_", "+/")
    padded = F.concat(text, F.repeat(F.lit("="), F.pmod(-F.length(text), F.lit(4))))
    return F.try_to_binary(padded, F.lit("base64"))


def user_expiry(c: Column) -> Column:
    """A claim's time: epoch milliseconds or ISO text."""
    millis = F.timestamp_millis(F.when(c.rlike("^-?[0-9]+$"), c).try_cast("bigint"))
    return F.coalesce(millis, F.when(~c.rlike("^-?[0-9]+$"), c.try_cast("timestamp")))


def verify(df: DataFrame, token: str, key: bytes, now: Column | None = None, algorithm: str | None = None) -> DataFrame:
    """Rows with ``token_status`` and ``user``, the claims of a token that passed.

    Status is ``ok``, ``malformed``, ``wrong_algorithm``, ``bad_signature``, ``expired`` or ``not_yet_valid``. The key
    becomes part of the plan as its two pads, so treat plans and event logs as secret.
    """
    chosen = algorithm or algorithm_for(key)
    moment = F.current_timestamp() if now is None else now
    parts = F.split(F.col(token), r"\.")
    opened = df.withColumn("_p", F.when(F.size(parts) == 3, parts))
    head, body, sign = (F.try_element_at(F.col("_p"), F.lit(i)) for i in (1, 2, 3))
    header = from_base64url(head).cast("string")
    opened = opened.withColumn("_body", from_base64url(body).cast("string"))
    payload = F.col("_body")
    until = F.get_json_object(payload, "$.exp").try_cast("bigint")
    since = F.get_json_object(payload, "$.nbf").try_cast("bigint")
    signed = hmac(F.concat(head, F.lit("."), body), key, chosen).eqNullSafe(from_base64url(sign))
    stamp = F.unix_micros(moment)
    status = (
        F.when(F.col("_p").isNull() | F.get_json_object(header, "$.alg").isNull() | payload.isNull(), "malformed")
        .when(F.get_json_object(header, "$.alg") != chosen, "wrong_algorithm")
        .when(~signed, "bad_signature")
        .when(stamp > until * 1_000_000, "expired")
        .when(stamp < since * 1_000_000, "not_yet_valid")
        .otherwise("ok")
    )
    claims = json_parse(F.get_json_object(payload, "$.userInfo"), USER_SCHEMA)
    checked = opened.withColumn("token_status", status)
    user = F.when(
        (F.col("token_status") == "ok") & F.col("_u").isNotNull(),
        F.struct(
            *[F.col(f"_u.{f}").alias(f) for f in ("id", "username", "roles", "permissions")],
            user_expiry(F.col("_u.expiry")).alias("expiry"),
        ),
    )
    return checked.withColumn("_u", claims).withColumn("user", user).drop("_p", "_body", "_u")


def effective_expiry(expiry: Column, created: Column) -> Column:
    """The later of a token's own expiry and two hours after its entry; the latter where it has none."""
    return F.greatest(expiry, created + F.expr(DEFAULT_LIFE))
