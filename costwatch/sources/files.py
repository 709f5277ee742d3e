"""File sources and sinks: CSV, Parquet and JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from costwatch import settings
from costwatch.functions.measures import no_nan
from costwatch.operators import quality

FREIGHT_TYPE = "decimal(24,6)"
CORRUPT = "_corrupt_record"
# Quoting by RFC 4180; blanks at the ends of a value belong to it.
CSV_WRITE = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _read(
    spark: SparkSession, path: str, fmt: str, columns: list[str], what: str, multi_line: bool
) -> DataFrame:
    """Columns by name; CSV values stay strings, further columns pass through.

    With `multi_line` a quoted value may hold line breaks, and a file is read by one task.
    Without it large files are split, but such a value is cut.
    """
    if fmt == "csv":
        df = spark.read.csv(
            path, header=True, escape='"', inferSchema=False, multiLine=multi_line
        )
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    quality.require_columns(df, columns, what)
    return df


def _number(name: str) -> Column:
    return no_nan(F.col(name).try_cast("double"))


def _date(name: str, formats: Sequence[str] = ()) -> Column:
    """ISO dates, else the first of `formats` that fits."""
    known = [F.try_to_date(F.col(name).cast("string"), f) for f in formats]
    return F.coalesce(F.col(name).try_cast("date"), *known)


def read_shipments(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    check: bool = True,
    multi_line: bool = False,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    """Shipments; numbers and dates that cannot be read become null.

    `check` scans the file once more and raises `ValueError` on bad rows. CSV files are split
    over tasks; set `multi_line` for files with line breaks inside quotes.
    """
    df = _read(spark, path, fmt, settings.SHIPMENT_COLUMNS, "shipments", multi_line).withColumns(
        {
            "quantity_tonnes": _number("quantity_tonnes"),
            "distance_km": _number("distance_km"),
            "freight_cost_inr": F.col("freight_cost_inr").try_cast(FREIGHT_TYPE),
            "shipment_date": _date("shipment_date", date_formats),
        }
    )
    if check:
        quality.enforce(quality.shipment_checks(df))
    return df


def read_notes(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    check: bool = True,
    multi_line: bool = True,
    date_formats: Sequence[str] = (),
) -> DataFrame:
    df = _read(spark, path, fmt, settings.NOTE_COLUMNS, "notes", multi_line)
    df = df.withColumn("date", _date("date", date_formats))
    if check:
        quality.enforce(quality.note_checks(df))
    return df


def read_labeled(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True
) -> DataFrame:
    df = _read(spark, path, fmt, settings.LABELED_COLUMNS, "labelled cases", multi_line)
    return df.withColumns(
        {"week_of": _date("week_of"), "expected_valid": F.col("expected_valid").try_cast("boolean")}
    )


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Result table ordered by route and week over all files; replaces the target."""
    ordered = (
        df.select(*settings.RESULT_COLUMNS)
        .repartitionByRange("route", "week_of")
        .sortWithinPartitions("route", "week_of")
    )
    if fmt == "csv":
        ordered.write.csv(path, mode="overwrite", **CSV_WRITE)
    elif fmt == "parquet":
        ordered.write.parquet(path, mode="overwrite")
    else:
        raise ValueError(f"unknown format {fmt!r}")


def read_results(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True
) -> DataFrame:
    """Result table read back; `week_of` becomes a date (null if it cannot be read)."""
    df = _read(spark, path, fmt, settings.RESULT_COLUMNS, "results", multi_line)
    return df.withColumns(
        {
            "week_of": _date("week_of"),
            "cost_per_tonne_km": _number("cost_per_tonne_km"),
            "matched_note_id": F.coalesce("matched_note_id", F.lit("")),
        }
    )


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.json(path, mode="overwrite", ignoreNullFields=False)


def read_json_report(
    spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False
) -> DataFrame:
    """Report rows; an absent file gives no rows, records that cannot be read raise `ValueError`.

    One record per line, or with `multi_line` one indented record (or list of them) per file.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    try:
        read = spark.read.json(
            path, schema=wide, mode="PERMISSIVE", multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    bad = read.agg(F.count(F.lit(1)), F.count(CORRUPT), F.count(schema.names[0])).first()[1]
    if bad:
        hint = "" if multi_line else "; an indented report needs multi_line=True"
        raise ValueError(f"{bad} records of {path} cannot be read{hint}")
    return read.drop(CORRUPT)
