"""CSV files read with a channel for bad records: what does not parse is told apart, not turned into NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorgraph.functions.parsing import to_number, to_ts
from sensorgraph.operators.reshape import require_columns
from sensorgraph.operators.storage import stored

#: The line that has more or fewer fields than the header, and the list of what is wrong with a row.
BAD_LINE, REJECTS = "__bad_line", "rejects"


def parsed(column: str, kind: T.DataType, formats: Sequence[str] = ()) -> Column:
    """Text as a value of the type, NULL if it does not parse; whole numbers must be whole."""
    if isinstance(kind, T.StringType):
        return F.col(column)
    if isinstance(kind, T.DoubleType | T.FloatType):
        return to_number(column).cast(kind)
    if isinstance(kind, T.TimestampNTZType):
        return to_ts(column, formats)
    text = F.trim(column)
    if isinstance(kind, T.IntegralType):
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast(kind))
    return text.try_cast(kind)


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType | str, required: Sequence[str] = (), formats: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: each row of the file is in exactly one of them.

    ``good`` has the schema's columns, picked by header name. ``rejected`` has them as text, and ``rejects``, a list of
    (column, text, reason): a value that does not parse, a missing value of a ``required`` column, or a line with more or
    fewer fields than the header (column NULL, the line as text). Empty fields are NULL. ``formats`` are date patterns that
    times may have beside ISO text. The file is read and parsed once; both tables come from what that pass has written.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    require_columns(names := spark.read.option("header", True).csv(path), schema.fieldNames())
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*names.columns, BAD_LINE)])
    # Without all columns parsed, the reader does not see how many fields a line has.
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "columnPruning": "false"}
    raw = spark.read.option("header", True).options(**settings).schema(text).csv(path)
    values = {f.name: parsed(f.name, f.dataType, formats) for f in schema}
    faults = [F.when(F.col(BAD_LINE).isNotNull(), _fault(None, F.col(BAD_LINE), "wrong number of fields"))]
    whole = F.col(BAD_LINE).isNull()
    for field in schema:
        given = F.col(field.name)
        broken = whole & given.isNotNull() & values[field.name].isNull()
        faults.append(F.when(broken, _fault(field.name, given, f"not a {field.dataType.simpleString()}")))
        if field.name in required:
            faults.append(F.when(whole & given.isNull(), _fault(field.name, given, "missing")))
    rejects = F.filter(F.array(*faults), lambda x: x.isNotNull()).alias(REJECTS)
    both = raw.select(*[F.struct(values[c].alias("value"), F.col(c).alias("text")).alias(c) for c in values], rejects)
    both = stored(both, "checked-csv")
    good = both.where(F.size(REJECTS) == 0).select(*[F.col(f"`{c}`.value").alias(c) for c in values])
    bad = both.where(F.size(REJECTS) > 0).select(*[F.col(f"`{c}`.text").alias(c) for c in values], REJECTS)
    return good, bad


def _fault(column: str | None, text: Column, reason: str) -> Column:
    return F.struct(F.lit(column).cast("string").alias("column"), text.alias("text"), F.lit(reason).alias("reason"))
