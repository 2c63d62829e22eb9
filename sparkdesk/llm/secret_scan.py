"""Secret scans with a ledger of content-addressed blobs.

Every version of every document is a blob named by its SHA-256. The ledger, a Parquet folder, says
which rules in which version have read which blob and what they matched; only pairs that
it lacks are scanned. Findings are joined back to all documents that hold the blob.
Column functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.llm.common import digest, free, text_of
from sparkdesk.session import materialise, scratch_path


@dataclass(frozen=True)
class Rule:
    """``value`` is the group whose length must reach ``least``; ``hint`` a string without which nothing matches."""

    kind: str
    version: int
    pattern: str
    value: int = 0
    least: int = 1
    hint: str = ""
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The runs of letters and digits are maximal, so their least length may stand in the pattern itself. For
#: ``assign`` it may not: a match that is too short still uses up its text.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", hint="AKIA", base=True),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{16,}", base=True),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?", hint="PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint="eyJ"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hint="xox"),
)

MATCH = "array<struct<rule:string,nth:int,gap:int,len:int,value:int>>"
LEDGER = f"blob binary, rules array<string>, matches {MATCH}"


def matches(text: Column, rule: Rule) -> Column:
    """All matches in order: the characters between the last match and this one, and this one's length.

    Splitting at a pattern gives the gaps and extracting it the matches; both find the same ones.
    """
    pattern = F.lit(rule.pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, pattern, F.lit(rule.value)).alias("v"),
        F.split(text, rule.pattern, -1).alias("g"),
    )
    shaped = F.transform(
        found,
        lambda z, i: F.struct(
            F.lit(rule.name).alias("rule"), i.alias("nth"), F.length(z["g"]).alias("gap"),
            F.length(z["m"]).alias("len"), F.length(z["v"]).alias("value"),
        ),
    )
    there = text.rlike(rule.pattern)
    if rule.hint:
        there = F.contains(text, F.lit(rule.hint)) & there
    return F.when(there, F.filter(shaped, lambda z: z["len"].isNotNull())).otherwise(F.array().cast(MATCH))


def scan(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Brings the ledger at ``ledger`` up to date with the texts of ``versions``, and returns it.

    A blob's rules that the ledger already has in this version are not run again.
    A run that breaks off may leave some of its files: their pairs are known to the next run, which scans the others. Runs that
    append at once may record a pair twice; ``spans`` takes it once.
    """
    spark = versions.sparkSession
    blobs = versions.select(text_of().alias("_text")).groupBy(digest(F.col("_text")).alias("blob"), "_text").agg(
        F.lit(1).alias("_one")
    ).drop("_one")
    known = _read(spark, ledger)
    if known is None:
        blobs = blobs.withColumn("_seen", F.array().cast("array<string>"))
    else:
        seen = known.select("blob", F.explode("rules").alias("r")).groupBy("blob").agg(F.collect_set("r").alias("_seen"))
        blobs = blobs.join(seen, "blob", "left").withColumn("_seen", F.coalesce("_seen", F.array().cast("array<string>")))
    names = F.array(*[F.lit(r.name) for r in rules])
    todo = blobs.withColumn("rules", F.array_except(names, F.col("_seen"))).where(F.size("rules") > 0)
    found = [
        F.when(F.array_contains("rules", r.name), matches(F.col("_text"), r)).otherwise(F.array().cast(MATCH)) for r in rules
    ]
    todo.select("blob", "rules", F.concat(*found).alias("matches")).write.mode("append").parquet(ledger)
    return _read(spark, ledger)


def _read(spark, ledger: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(ledger)


def spans(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, kind, ord, start, end`` of every match that is long enough; code points, end exclusive.

    A pair of blob and rule that the ledger holds several times counts once.
    """
    order = W.partitionBy("blob", "rule").orderBy("nth")
    rows = ledger.where(F.size("matches") > 0).select("blob", F.inline("matches"))
    rows = rows.withColumn("again", F.coalesce(F.lag("nth").over(order) == F.col("nth"), F.lit(False)))
    width = F.when(F.col("again"), F.lit(0)).otherwise(F.col("gap") + F.col("len"))
    rows = rows.withColumn("end", F.sum(width).over(order)).withColumn("start", F.col("end") - F.col("len")).where("not again")
    known = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)])
    least = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.least)])
    rows = rows.where(known[F.col("rule")].isNotNull() & (F.col("value") >= least[F.col("rule")]))
    return rows.select("blob", F.split_part("rule", F.lit("@"), F.lit(1)).alias("kind"), known[F.col("rule")].alias("ord"), "start", "end")


def secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans``, one row per row of ``docs``: the spans as ``(start, ord, kind, end)`` by start, then rule.

    A null text is empty and has no span. Equal texts share one scan, whatever their number; repeated
    rows each get their row. Columns beside doc_id and text are not read. Without a
    ledger path a new one is begun in the shared folder.
    """
    done = scan(docs, ledger or scratch_path(docs.sparkSession, "ledger"), rules)
    found = spans(done, rules).groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", "ord", "kind", "end"))).alias("spans"))
    found = materialise(found, "findings")
    blobs = docs.select("doc_id", digest(text_of()).alias("blob"))
    none = F.array().cast(found.schema["spans"].dataType)
    return blobs.join(found, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with the characters of every span in ``text`` replaced by the mask; other rows and columns as they are.

    Spans that overlap or touch become one. A null text stays null and an empty one empty. Rows that repeat an id or a text are each masked by their
    own text, rows without an id too. Other columns may have any names. No rows give no rows.
    """
    blob, hit, places = free(docs, "_blob", "_found", "_cuts")
    done = scan(docs, ledger or scratch_path(docs.sparkSession, "ledger"), rules)
    by_start = W.partitionBy("blob").orderBy("start", "end")
    rows = spans(done, rules).withColumn("_upto", F.max("end").over(by_start.rowsBetween(W.unboundedPreceding, -1)))
    new = (F.col("_upto").isNull() | (F.col("start") > F.col("_upto"))).cast("int")
    rows = rows.withColumn("_island", F.sum(new).over(by_start.rowsBetween(W.unboundedPreceding, W.currentRow)))
    islands = rows.groupBy("blob", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    before = F.coalesce(F.lag("end").over(W.partitionBy("blob").orderBy("_island")), F.lit(0))
    islands = islands.withColumn("after", before)
    cuts = islands.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "end", "after"))).alias(places))
    cuts = materialise(cuts.withColumnRenamed("blob", hit), "cuts")
    text, cut = F.col("text"), F.col(places)
    gone = lambda c: F.concat(text.substr((c["after"] + 1).cast("int"), (c["start"] - c["after"]).cast("int")), F.lit(mask))
    tail = text.substr((F.element_at(cut, -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(cut.isNull(), text).otherwise(F.concat(F.array_join(F.transform(cut, gone), ""), tail))
    joined = docs.withColumn(blob, digest(text_of())).join(cuts, F.col(blob) == F.col(hit), "left")
    return joined.withColumn("text", clean).drop(blob, hit, places)
