"""JSON documents as one row per node, to any depth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.cells import column
from sparkdesk.functions.jsons import is_container, json_depth, nodes_from
from sparkdesk.session import materialise

#: Levels that one projection opens.
STEP = 8


def json_nodes(df: DataFrame, keys: Sequence[str], doc: str, depth: int | None = None, step: int = STEP) -> DataFrame:
    """``n, path, key, kind, value`` beside the keys, one row per node; ``n`` counts a document's nodes in order from 0.

    The deepest document, or ``depth``, says how many levels there are. Up to ``step`` levels are one projection without a shuffle or a written
    table. Deeper ones are opened ``step`` levels at a time: what a round leaves closed is written and opened by the next. The keys tell
    the documents apart.
    """
    names = [column(k) for k in keys]
    levels = df.agg(F.max(json_depth(column(doc)))).first()[0] or 1
    levels = levels if depth is None else min(depth, levels)
    rows = df.select(*names, F.lit("$").alias("path"), F.array().cast("array<int>").alias("_place"), column(doc).alias("value"))
    found, shown = None, [*names, "_place", "_e.path", "_e.key", "_e.kind", "_e.value"]
    for base in range(0, levels, step):
        here = min(step, levels - base)
        opened = rows.select(*names, "_place", F.posexplode(nodes_from(F.col("value"), F.col("path"), here)).alias("_i", "_e"))
        if levels <= step:
            return opened.select(*names, F.col("_i").alias("n"), "_e.path", "_e.key", "_e.kind", "_e.value")
        opened = materialise(opened.withColumn("_place", F.concat("_place", F.array("_i"))), "json-levels")
        found = opened.select(*shown) if found is None else found.unionByName(opened.select(*shown))
        rows = opened.where((F.col("_e.level") == here) & is_container(F.col("_e.kind"))).select(*names, "_e.path", "_place", "_e.value")
    # A parent's place is the beginning of its children's, so it sorts before them.
    order = W.partitionBy(*names).orderBy("_place")
    return found.select(*names, (F.row_number().over(order) - 1).alias("n"), "path", "key", "kind", "value")
