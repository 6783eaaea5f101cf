"""Reading raw tables with stated schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.sources import pieces

# Fixed value: the field separator of the raw dialogue files.
SEPARATOR = " +++$+++ "


@dataclass(frozen=True)
class TableSpec:
    """Where a table lies and how to read it.

    ``format`` is ``delimited`` (text split by ``SEPARATOR``), ``csv``, ``json`` (one object
    per line), ``json_array`` (one array per file) or ``parquet``. Without a format, the file
    extension decides. ``columns`` keeps some columns only, so the scan reads no others.
    """

    path: str
    schema: T.StructType
    format: str | None = None
    columns: tuple[str, ...] = ()
    options: Mapping[str, str] = field(default_factory=dict)


# Reader options by format.
READER_OPTIONS: dict[str, dict[str, str]] = {
    "delimited": {"sep": SEPARATOR, "encoding": "ISO-8859-1", "quote": "", "header": "false"},
    "csv": {"header": "true", "multiLine": "true", "escape": '"', "encoding": "UTF-8"},
    "json": {},
    "json_array": {"multiLine": "true"},
    "parquet": {},
}
EXTENSIONS = {
    ".txt": "delimited", ".csv": "csv", ".jsonl": "json", ".json": "json_array", ".parquet": "parquet",
}


def format_of(spec: TableSpec) -> str:
    if spec.format is not None:
        if spec.format not in READER_OPTIONS:
            raise ValueError(f"unknown format {spec.format!r}")
        return spec.format
    for extension, kind in EXTENSIONS.items():
        if spec.path.rstrip("/").endswith(extension):
            return kind
    raise ValueError(f"no reader for {spec.path!r}")


def _split_csv(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Quoted CSV with a header line, cut at record ends; see ``pieces``."""
    found = pieces.records(spark, spec.path, pieces.CSV).where("record > 0 AND text NOT IN ('', '\\r')")
    options = {k: v for k, v in READER_OPTIONS["csv"].items() if k == "escape"}
    line = F.regexp_replace("text", "\r$", "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema)
    return found.select(F.from_csv(line, ddl, options).alias("_r")).select("_r.*")


def _split_json_array(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """An array of objects, cut at their ends; what is not an object is left out."""
    found = pieces.records(spark, spec.path, pieces.JSON_ARRAY)
    return (
        found.where(F.instr("text", "{") > 0)
        .select(F.from_json(F.concat(F.expr("substring(text, instr(text, '{'))"), F.lit("}")), spec.schema).alias("_r"))
        .select("_r.*")
    )


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """A table with its stated schema. Large CSV and JSON array files are read by many tasks, unless reader
    options are given, which Spark's own reader then takes."""
    kind = format_of(spec)
    split = {"csv": _split_csv, "json_array": _split_json_array}.get(kind)
    if split is not None and not spec.options:
        df = split(spark, spec)
        return df.select(*spec.columns) if spec.columns else df
    source = {"delimited": "csv", "json_array": "json"}.get(kind, kind)
    reader = spark.read.schema(spec.schema).options(**READER_OPTIONS[kind]).options(**spec.options)
    df = reader.format(source).load(spec.path)
    return df.select(*spec.columns) if spec.columns else df


def scan(
    spark: SparkSession, path: str, schema: T.StructType | str, spread_by: str | None = None
) -> DataFrame:
    """A Parquet table.

    With ``spread_by``, a table of fewer splits than cores is dealt out by that column, for
    work that costs far more than the rows' transport. Tables of many files stay as they are.
    """
    df = spark.read.schema(schema).parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by is not None and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, spread_by)
    return df


def read_tables(
    spark: SparkSession, specs: Mapping[str, TableSpec], required: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Named tables; a required name that is missing raises."""
    missing = [name for name in required if name not in specs]
    if missing:
        raise ValueError(f"tables missing: {', '.join(missing)}")
    return {name: read_table(spark, spec) for name, spec in specs.items()}


def split_delimited(
    df: DataFrame, column: str, names: Sequence[str], separator: str = SEPARATOR
) -> DataFrame:
    """Split one text column into named ones; the last keeps any further separators.

    Missing and empty fields become null.
    """
    pieces = F.split(F.col(column), rf"\Q{separator}\E", len(names))
    return df.select(
        *[F.nullif(F.get(pieces, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def json_array_to_lines(spark: SparkSession, path: str, schema: T.StructType, out: str) -> None:
    """Rewrite an array file as JSON Lines."""
    spec = TableSpec(path, schema, "json_array")
    read_table(spark, spec).write.mode("overwrite").option("ignoreNullFields", "false").json(out)
