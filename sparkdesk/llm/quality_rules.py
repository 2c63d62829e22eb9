"""Quality rules: a table of thresholds compiled into one projection, Column functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import WORD, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it was on are as with by this be at from or an "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als "
    "le la les de du des et un une en que qui est pour dans par sur au "
    "el los las del y se por con su una es no al lo"
).split()
STOP_WORDS += [w.capitalize() for w in STOP_WORDS]


@dataclass(frozen=True)
class Bound:
    """A document fails when ``value`` of its measures is below ``least`` or above ``most``, given at least ``words`` words."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None
    words: int = 0


#: One row per rule; the values are SQL over the measures.
BOUNDS = (
    Bound("word_length", "word_chars / n_words", 1.5, 20.0, 1),
    Bound("symbol_ratio", "n_symbols / word_chars", None, 0.08, 1),
    Bound("symbol_lines", "n_symbol_lines / n_lines", None, 0.5, 20),
    Bound("upper_ratio", "n_upper / word_chars", None, 0.5, 20),
    Bound("dup_lines", "n_dup_lines / n_lines", None, 0.5, 1),
    Bound("stop_words", "n_stop_words / n_words", 0.002, None, 200),
)


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts that the bounds use; each text is split once."""
    text = F.col("_text")
    split = docs.select("doc_id", text_of().alias("_text")).select(
        "doc_id", "_text", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda s: s.rlike(WORD)).alias("_lines"),
    )
    words, lines = F.col("_words"), F.col("_lines")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    split = split.withColumn("_hashes", F.when(F.size(words) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    hashes = F.col("_hashes")
    windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
    split = split.withColumn("_keys", F.when(F.size(hashes) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    count = lambda c: c.cast("bigint")
    return split.withColumn("_starts", _repeated(F.col("_keys"))).select(
        "doc_id",
        count(F.size(words)).alias("n_words"),
        count(F.length(F.array_join(words, ""))).alias("word_chars"),
        count(_count(text, SYMBOLS)).alias("n_symbols"),
        count(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        count(_covered(F.col("_starts"))).alias("n_repeat_words"),
        count(F.size(lines)).alias("n_lines"),
        count(F.size(F.filter(lines, lambda s: F.length(s) < 4 * _count(s, "|#*$%&<>!")))).alias("n_symbol_lines"),
        count(F.length(F.regexp_replace(text, r"\P{Lu}+", ""))).alias("n_upper"),
        count(F.size(F.filter(words, lambda w: w.isin(STOP_WORDS)))).alias("n_stop_words"),
    )


def _count(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _repeated(keys: Column) -> Column:
    """Sorted places of the keys that occur twice or more, 0-based."""
    placed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    twin = lambda p: F.filter(
        p, lambda x, j: F.coalesce(F.get(p, j - 1)["k"] == x["k"], F.lit(False)) | F.coalesce(F.get(p, j + 1)["k"] == x["k"], F.lit(False))
    )
    # An array of one binds the sorted places, which would else be sorted anew for each of them.
    found = F.get(F.transform(F.array(placed), lambda p: F.sort_array(F.transform(twin(p), lambda x: x["i"]))), F.lit(0))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), found).otherwise(F.array().cast("array<int>"))


def _covered(starts: Column) -> Column:
    """Words that lie in a window which begins at one of the places."""
    step = lambda a, s: F.struct((a["n"] + F.least(s - a["last"], F.lit(WINDOW))).alias("n"), s.alias("last"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.when(F.size(starts) == 0, F.lit(0)).otherwise(F.aggregate(starts, zero, step, lambda a: a["n"]))


def verdict(bounds: tuple[Bound, ...] = BOUNDS) -> Column:
    """The names of the bounds that a row of measures breaks; a ratio of nothing breaks none."""
    broken = []
    for b in bounds:
        value, wrong = F.expr(f"try_divide({b.value.replace(' / ', ', ')})"), F.lit(False)
        if b.least is not None:
            wrong = wrong | (value < b.least)
        if b.most is not None:
            wrong = wrong | (value > b.most)
        broken.append(F.when((F.col("n_words") >= b.words) & F.coalesce(wrong, F.lit(False)), F.lit(b.name)))
    return F.array_compact(F.array(*broken))


def quality(docs: DataFrame, bounds: tuple[Bound, ...] = BOUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the measures, ``base_failed``, ``failed`` (broken bounds) and ``kept``.

    A null text is empty: no words, so it fails the base. Repeated rows each get their row; columns
    beside doc_id and text are not read. Nothing is shuffled.
    """
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    out = measures(docs).withColumn("base_failed", failed).withColumn("failed", verdict(bounds))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
