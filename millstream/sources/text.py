"""Text and CSV files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import load_or_empty, load_or_none


def read_text(
    spark: SparkSession,
    path: str | list[str],
    *,
    skip_header_lines: int = 0,
    strip_trailing_newlines: bool = True,
    line_separator: str | None = None,
    validate: bool = True,
) -> DataFrame:
    """One row ``value`` per line; ``path`` may hold globs. Lines end with a line feed,
    which a carriage return may precede, or with ``line_separator``.

    Compressed files are recognised by their extension. Without
    ``strip_trailing_newlines`` each value keeps its line end; a file whose last
    line has none gets one.
    """
    ending = line_separator or "\n"
    reader = spark.read.option("lineSep", ending)
    lines = load_or_none(lambda: reader.text(path), validate)
    if lines is None:
        return spark.createDataFrame([], "value string")
    if skip_header_lines:
        lines = _skip_headers(lines, skip_header_lines)
    if not strip_trailing_newlines:
        return lines.select(F.concat("value", F.lit(ending)).alias("value"))
    if line_separator is None:
        bare = F.expr("left(value, length(value) - 1)")
        lines = lines.select(
            F.when(F.endswith("value", F.lit("\r")), bare).otherwise(F.col("value")).alias("value"))
    return lines


def _skip_headers(lines: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` lines of every file.

    A file's lines reach a task in file order, and its header lies in the block
    that starts at byte 0, so counting within that block is enough. Lines are looked at in
    runs of one block, never one by one.
    """

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, 0
        for batch in batches:
            files = batch.column("file")
            keep = np.ones(len(files), bool)
            runs, start = pc.run_end_encode(files), 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if name != current:
                    current, seen = name, 0
                if name:
                    keep[start:min(end, start + max(n - seen, 0))] = False
                seen, start = seen + end - start, end
            yield batch.select(["value"]).filter(pa.array(keep))

    # the name of the file for lines of its first block, nothing for all others
    name = F.when(F.col("_metadata.file_block_start") == 0, F.col("_metadata.file_path"))
    return lines.select("value", F.coalesce(name, F.lit("")).alias("file")).mapInArrow(
        drop, "value string")


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    *,
    header: bool = True,
    separator: str = ",",
    date_format: str | None = None,
    on_error: str = "raise",
    validate: bool = True,
) -> DataFrame:
    """Delimited files with named, typed columns; each file's header is skipped.

    ``on_error="drop"`` leaves out rows that do not fit the schema.
    """
    if on_error not in ("raise", "drop"):
        raise ValueError("on_error must be 'raise' or 'drop'")
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", separator)
        .option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "FAILFAST" if on_error == "raise" else "DROPMALFORMED")
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return load_or_empty(spark, lambda: reader.csv(path), validate, schema)
