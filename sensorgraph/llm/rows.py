"""Row identity for operators that shuffle verdicts instead of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID, TEXT, HASH = "__llm_id", "__llm_text", "__llm_hash"


#: Rows of an Arrow batch that holds texts. Spark's usual 10,000 would be hundreds of megabytes of long documents.
TEXT_ROWS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch to what suits texts; it is read when the plan runs, so it stays so."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS_PER_BATCH:
        spark.conf.set(name, str(TEXT_ROWS_PER_BATCH))


def keyed(df: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    """Id, text (null becomes empty) and a hash of the text, under names no caller uses, and further columns.

    Rows that agree in id and text share their verdict, so a repeated row needs no number of its own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).cast("long").alias(ID),
        text.alias(TEXT),
        F.xxhash64(text).alias(HASH),
        *[c.alias(n) for n, c in more.items()],
    )


def attach(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, matched by row key (null ids match each other)."""
    right = right.withColumnsRenamed({ID: f"{ID}_r", HASH: f"{HASH}_r"})
    same = F.col(ID).eqNullSafe(F.col(f"{ID}_r")) & (F.col(HASH) == F.col(f"{HASH}_r"))
    return left.join(right, same, how).drop(f"{ID}_r", f"{HASH}_r")


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fixed_lists(column: pa.Array, width: int) -> np.ndarray:
    """A list column whose lists all have ``width`` numbers, as a table."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def arrow_rows(schema: pa.Schema, columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    """``n`` rows of exactly ``schema``, which all batches of a task must share; columns that are not given are null."""
    return pa.record_batch([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
