"""Streams of keyed records or of lines.

A source is any Structured Streaming format.  File formats and message queues
bundled with Spark map their own columns here; for another connector give the
option that sets its start position and the expressions of key, value and seq.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.schemas import STREAM_RECORD

FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")

# Option names of the bundled sources.
START_OPTION = {"kafka": "startingOffsets"}
LIMIT_OPTION = {"kafka": "maxOffsetsPerTrigger", **{f: "maxFilesPerTrigger" for f in FILE_FORMATS}}
RECORD_COLUMNS = {"kafka": {"key": "CAST(key AS STRING)", "value": "value", "seq": "offset"}}


def read_stream(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    start: str = "latest",
    limit: int | None = None,
    schema: T.StructType | None = None,
    start_option: str | None = None,
    limit_option: str | None = None,
    **options: str,
) -> DataFrame:
    """The stream as its source gives it.

    ``start`` counts only while the query has no checkpoint: ``latest`` takes
    new records, ``earliest`` all of them.  Files have no latest position.
    ``limit`` bounds what one micro-batch takes in.
    """
    if start not in ("latest", "earliest"):
        raise ValueError(f"start={start!r}: use 'latest' or 'earliest'")
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in FILE_FORMATS:
        if start != "earliest":
            raise ValueError(f"{fmt}: a file source starts at 'earliest'")
        if fmt != "text":
            reader = reader.schema(schema or STREAM_RECORD)
    else:
        start_option = start_option or START_OPTION.get(fmt)
        if not start_option:
            raise ValueError(f"{fmt}: name the option that sets its start position")
        reader = reader.option(start_option, start)
    if limit is not None:
        limit_option = limit_option or LIMIT_OPTION.get(fmt)
        if not limit_option:
            raise ValueError(f"{fmt}: name the option that limits a micro-batch")
        reader = reader.option(limit_option, limit)
    return reader.load(path) if path else reader.load()


def as_records(stream: DataFrame, fmt: str, columns: dict[str, str] | None = None) -> DataFrame:
    """Source columns as ``key STRING, value BINARY, seq BIGINT``.

    ``columns`` gives an SQL expression for each; without ``seq`` it is 0, and
    writes to one key within a batch are then ordered by their own columns.
    """
    known = columns or RECORD_COLUMNS.get(fmt) or {c: c for c in stream.columns}
    return stream.select(
        F.expr(known["key"]).cast("string").alias("key"),
        F.expr(known["value"]).cast("binary").alias("value"),
        F.expr(known.get("seq", "0")).cast("long").alias("seq"),
    )


def as_lines(stream: DataFrame) -> DataFrame:
    """A text source's lines, which are framed already."""
    return stream.select(F.lit(0).cast("long").alias("seq"), F.col("value").alias("line"))
