"""CSV drops into a typed table, with bad lines set aside instead of failing the load.

Semantics of the source's load (positional CSV, fields optionally enclosed in
double quotes, continue on error): a line is loaded when it has exactly the
table's number of fields, every field is empty or converts to the column
type, and the NOT NULL columns are present. Anything else - a header line,
short or long lines, non-numeric values, a missing key - is skipped.

Spark's CSV reader runs in PERMISSIVE mode with every column read as text
plus ``_corrupt_record`` (set for a wrong field count). Validation is an
explicit expression over *all* columns, so Spark's CSV column pruning cannot
change which lines count as bad: ``count()`` and a full ``select`` agree.
Lines are split across tasks like any CSV (no header, no multi-line values),
so a drop of any size loads in parallel.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockledger import schemas
from stockledger.functions.scalar import all_of
from stockledger.sources.storage import VersionedTable

CORRUPT = "_corrupt_record"


def converted(value: Column, kind: T.DataType) -> Column:
    """Text as ``kind``, NULL if it is none. Whole-number columns take any number,
    rounded half away from zero, as a load into NUMBER(38,0) does."""
    if isinstance(kind, (T.LongType, T.IntegerType)):
        # whole numbers, as nearly all fields are, need no decimals; only the plain cast would pass over a DEL character
        whole = F.when(~value.contains("\x7f"), value.try_cast(kind))
        return F.coalesce(whole, value.try_cast("decimal(38,6)").try_cast("decimal(38,0)").try_cast(kind))
    return value.try_cast(kind)


@dataclass
class CsvLoad:
    good: DataFrame
    rejected: DataFrame


def read_csv_drop(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.INVENTORY,
    not_null: tuple[str, ...] = schemas.INVENTORY_NOT_NULL,
    delimiter: str = ",",
) -> CsvLoad:
    """Read a positional CSV drop; returns typed good rows and the rejected raw rows."""
    text_schema = T.StructType(
        [T.StructField(f.name, T.StringType(), True) for f in schema.fields]
        + [T.StructField(CORRUPT, T.StringType(), True)]
    )
    raw = (
        spark.read.schema(text_schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("header", "false")
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )

    def field(name: str):
        return F.nullif(F.trim(F.col(name)), F.lit(""))

    def loaded(f: T.StructField) -> Column:
        # casts to numbers pass over blanks themselves and give NULL for an empty field
        return converted(F.col(f.name) if isinstance(f.dataType, (T.LongType, T.IntegerType)) else field(f.name), f.dataType)

    checks = [F.col(CORRUPT).isNull()]
    for f in schema.fields:
        converts = loaded(f).isNotNull()
        checks.append(converts if f.name in not_null else converts | field(f.name).isNull())
    ok = all_of(checks)
    marked = raw.withColumn("_ok", F.coalesce(ok, F.lit(False)))
    good = marked.where(F.col("_ok")).select(
        *[loaded(f).alias(f.name) for f in schema.fields]
    )
    rejected = marked.where(~F.col("_ok")).drop("_ok")
    return CsvLoad(good, rejected)


def full_refresh(
    spark: SparkSession,
    path: str,
    target: VersionedTable,
    schema: T.StructType = schemas.INVENTORY,
    not_null: tuple[str, ...] = schemas.INVENTORY_NOT_NULL,
    rejects: VersionedTable | None = None,
) -> int:
    """``TRUNCATE`` + load as one atomic switch: the new version holds exactly the
    drop's good rows. The source truncates first, so a failed load leaves an
    empty table; here a failed load leaves the previous version current."""
    load = read_csv_drop(spark, path, schema, not_null)
    if rejects is not None:
        rejects.write(load.rejected)
    return target.write(load.good)
