"""CSV, Parquet and text scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import quoted
from millrace.operators.ranking import ROWS_PER_TASK, fit_range_cuts, number_rows
from millrace.workspace import FittedTable, freeze

CORRUPT = "_corrupt_record"
#: Columns of a dictionary of file names.
NAME, NUMBER = "__name", "__number"


def file_lineage(pattern: str, group: int = 1) -> Column:
    """Part of the source file's path matched by ``pattern`` ('' if none).

    Needs the hidden ``_metadata`` column, so select it directly on a file scan.
    """
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def source_names(df: DataFrame, pattern: str, group: int = 1) -> DataFrame:
    """What ``file_lineage`` gives for the files behind ``df``, from their paths alone."""
    paths = df.sparkSession.createDataFrame([(f,) for f in df.inputFiles()], "path string")
    return paths.select(F.regexp_extract("path", pattern, group).alias("name"))


def fit_names(names: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> FittedTable:
    """Number the distinct values of the one column of ``names`` in their order.

    Rows can then carry a number in place of a text: it is smaller to shuffle, and the least
    of many is kept in a hash table, where texts would be sorted."""
    found = names.toDF(NAME).filter(F.col(NAME).isNotNull()).groupBy(NAME).agg(F.count(F.lit(1)).alias("n"))
    found = freeze(found, "names")
    cuts = fit_range_cuts(found.table, [], [NAME], rows_per_task=rows_per_task) if found.rows > rows_per_task else None
    return freeze(number_rows(found.table, [], [NAME], NUMBER, cuts), "name-numbers", found)


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    schema: T.StructType | str | None = None,
    sampling_ratio: float = 1.0,
    mode: str = "DROPMALFORMED",
    trim_values: bool = False,
    lineage_pattern: str | None = None,
    lineage_column: str = "source_file",
    **options: str,
) -> DataFrame:
    """Read headed CSV files; names are stripped of surrounding blanks.

    Without ``schema`` the types are inferred by one extra pass over a
    ``sampling_ratio`` of the rows; with it, columns are assigned by position and
    no extra pass is made.  ``trim_values`` drops blanks around values, without
    which ``" 4"`` infers as double and ``" x"`` differs from ``"x"``.

    Under ``DROPMALFORMED`` a row is dropped if any of its values does not fit, whatever columns
    are selected or counted afterwards (see ``whole_rows``).  Quoted line breaks need
    ``multiLine="true"``, for which Spark reads every file in one task.
    """
    reader = spark.read.option("header", True).option("mode", mode).options(**options)
    if trim_values:
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    columns = [quoted(name).alias(name.strip()) for name in df.columns]
    if lineage_pattern is not None:
        columns.append(file_lineage(lineage_pattern).alias(lineage_column))
    own = df.columns
    return whole_rows(df.select("*", "_metadata") if lineage_pattern is not None else df, own).select(columns)


def whole_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows, but every column is read with each of them.

    The CSV reader looks only at the columns that a query needs, so a row with a bad value
    in another one would pass as good, and a count would look at none.  A filter that
    needs all columns, and that every row passes, makes the reader judge whole rows.
    """
    return df.filter(F.pmod(F.xxhash64(*map(quoted, columns)), F.lit(1)) == 0)


def quarantine_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    lineage_pattern: str | None = None,
    lineage_column: str = "source_file",
    **options: str,
) -> DataFrame:
    """Read with a fixed schema and keep what does not fit.

    Adds ``_corrupt_record``: NULL on good rows, the raw line on rows that have a
    value outside its column's type or a wrong number of values.  Rows are judged as a whole,
    whatever columns are selected afterwards.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    df = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(wide).csv(
        paths if isinstance(paths, str) else list(paths)
    )
    if lineage_pattern is None:
        return whole_rows(df, wide.names)
    lineage = file_lineage(lineage_pattern).alias(lineage_column)
    return whole_rows(df.select("*", "_metadata"), wide.names).select(*map(quoted, wide.names), lineage)


def scan_parquet(
    spark: SparkSession, path: str, base_path: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """Parquet scan.  With ``base_path``, a part of a partitioned data set keeps its
    partition columns; with ``schema``, one without any rows can be read, too."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)


def scan_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Text lines in column ``value``; lines equal to ``header`` are skipped."""
    lines = spark.read.text(path)
    return lines if header is None else lines.filter(F.col("value") != header)
