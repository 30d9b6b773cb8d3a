"""Reading landing files: CSV with a declared schema, loose JSON, directory lists."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from tidemark.functions.expr import c

FILE, REASON, EXTRA = "_source_file", "_reject_reason", "_beyond_schema"


class Loaded(NamedTuple):
    """Typed rows, and the rows that could not be read with the reason; all of them side by side, if one reading gives both."""

    rows: DataFrame
    rejects: DataFrame
    both: DataFrame | None = None


def as_struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def text_schema(schema: StructType) -> StructType:
    """All fields as text, and what the line holds beyond them."""
    return StructType([StructField(name, StringType()) for name in [*schema.names, EXTRA]])


def csv_options(glob: str | None = None, header: bool = True) -> dict[str, str]:
    options = {
        "header": str(header).lower(),
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "enforceSchema": "true",
    }
    if glob:
        options["pathGlobFilter"] = glob
    return options


def _typed(f: StructField) -> Column:
    text = F.col(f.name)
    if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
        return text.try_cast(f.dataType)
    if isinstance(f.dataType, DateType):
        # only full ISO dates; a bare cast would also take '2024'
        return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))
    return text.try_cast(f.dataType) if not isinstance(f.dataType, StringType) else text


def apply_schema(raw: DataFrame, schema: StructType, null_values=(), required=()) -> Loaded:
    """Cast text columns; a row is rejected if a value does not fit or a required one is missing, or if there are too many.

    Short rows keep their leading values.  Works on batch and streaming frames.
    """
    if null_values:
        raw = raw.withColumns(
            {f.name: F.when(~F.trim(F.col(f.name)).isin(*null_values), F.col(f.name)) for f in schema.fields}
        )
    bad = [
        F.when(F.col(f.name).isNotNull() & _typed(f).isNull(), F.lit(f"bad {f.name}")) for f in schema.fields
    ] + [F.when(F.col(x).isNull(), F.lit(f"missing {x}")) for x in required]
    if EXTRA in raw.columns:
        bad.insert(0, F.when(F.col(EXTRA).isNotNull(), F.lit("too many fields")))
    checked = raw.withColumn(REASON, F.coalesce(*bad))
    extra = [x for x in raw.columns if x not in {EXTRA, *schema.names}]
    good = checked.where(F.col(REASON).isNull())
    rows = good.select(*[_typed(f).alias(f.name) for f in schema.fields], *extra)
    return Loaded(rows, checked.where(F.col(REASON).isNotNull()))


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of a file through its own file system; no more than a buffer is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return (lines.readLine() or "").removeprefix("\ufeff")
    finally:
        lines.close()


def first_lines(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """First line of every file, a few files at a time."""
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda path: _first_line(spark, path), paths))


def file_catalogue(spark: SparkSession, path: str, *like: str, header: bool = True) -> DataFrame:
    """path, relative_path, last_modified, size and header (the first line) of the files that ``list_files`` finds.

    The listing is Spark's own; of each file only the first bytes are read, by the driver, which lists the files anyhow.
    """
    files = list_files(spark, path, *like)
    if not header:
        return files
    paths = [r.path for r in files.select("path").collect()]
    table = spark.createDataFrame(list(zip(paths, first_lines(spark, paths), strict=True)), "path string, header string")
    return files.join(table, "path")


def header_names(line: str) -> tuple[str, ...]:
    """Lower-case names of a header line; quotes as in the data."""
    return tuple(x.strip().lower() for x in next(csv.reader([line], skipinitialspace=True), []))


def _by_header(spark: SparkSession, path: str, glob: str | None, names: list[str]) -> DataFrame:
    """Text values under the wanted names, each file read by its own first line.

    Files with one header are one scan, which names its columns itself, so no data is read to find names, nothing is
    joined, and only wanted columns are parsed.
    """
    listed = spark.read.format("binaryFile").options(**({"pathGlobFilter": glob} if glob else {})).load(path).select("path")
    paths = [r.path for r in listed.collect()]
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(paths, first_lines(spark, paths), strict=True):
        groups.setdefault(header_names(line), []).append(file)

    def scan(titles: tuple[str, ...], files: list[str]) -> DataFrame:
        cells = [f"c{i}" for i in range(len(titles))]
        text = StructType([StructField(x, StringType()) for x in [*cells, EXTRA]])
        rows = spark.read.options(**csv_options()).schema(text).csv(files)
        own = [F.col(cells[titles.index(n.lower())]) if n.lower() in titles else F.lit(None).cast("string") for n in names]
        return rows.select(*(x.alias(n) for x, n in zip(own, names, strict=True)), EXTRA, F.col("_metadata.file_path").alias(FILE))

    if not groups:
        return spark.createDataFrame([], text_schema(StructType([StructField(n, StringType()) for n in names])).add(FILE, "string"))
    return reduce(DataFrame.union, (scan(titles, files) for titles, files in groups.items()))


def load_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    glob: str | None = None,
    null_values=(),
    by_name: bool = False,
    required=(),
) -> Loaded:
    """CSV files with header, optional quotes, trimmed, as typed rows plus rejects.

    By position the declared names are used.  ``by_name`` matches header names regardless of case
    and order, for every file by its own header.  Values beyond the schema or header reject the line.
    """
    wanted = as_struct(schema)
    reader = spark.read.options(**csv_options(glob))
    if by_name:
        raw = _by_header(spark, path, glob, wanted.names)
    else:
        raw = reader.schema(text_schema(wanted)).csv(path)
        raw = raw.select("*", F.col("_metadata.file_path").alias(FILE))
    return apply_schema(raw, wanted, null_values, required)


def clean(df: DataFrame, *, blank_to_null=(), default_now=(), now: Column | None = None) -> DataFrame:
    """Load-time projection: blank text to null, missing load times to now."""
    stamp = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    return df.withColumns(
        {x: F.nullif(F.trim(F.col(x)), F.lit("")) for x in blank_to_null}
        | {x: F.coalesce(F.col(x).try_cast("timestamp_ntz"), stamp) for x in default_now}
    )


def parse_loose_json(col) -> Column:
    """JSON written with single quotes as a variant; null when it still does not parse."""
    return F.try_parse_json(F.replace(c(col), F.lit("'"), F.lit('"')))


def list_files(spark: SparkSession, path: str, *like: str) -> DataFrame:
    """Path, time and size of the files below a folder whose path relative to it matches all patterns.

    Only the file listing is read: the content column is pruned.  Files without content aren't listed.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("path"),
            F.ltrim(F.substring("path", len(root) + 1, 1 << 20), F.lit("/")).alias("relative_path"),
            F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
            F.col("length").alias("size"),
        )
    )
    return reduce(lambda df, pattern: df.where(F.col("relative_path").like(pattern)), like, found)
