"""New Parquet files to CSV as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sparkdesk.functions.cells import render
from sparkdesk.operators.export import CSV_OPTIONS, write_csv


def stream_export(table: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The text of every cell as CSV files with a header. The sink's own log makes each row appear once.

    The CSV sink would leave out empty rows of a one-column table. Such a table is written batch by batch as ``write_csv`` does it, in
    one folder per batch, which a repeated batch replaces.
    """
    if len(table.columns) == 1:
        writer = table.writeStream.foreachBatch(lambda batch, number: write_csv(batch, f"{path}/batch={number}", mode="overwrite"))
    else:
        writer = render(table).writeStream.format("csv").options(header="true", **CSV_OPTIONS).option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
