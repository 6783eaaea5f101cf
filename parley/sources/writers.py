"""Writing tables, manifests and metrics."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, which CSV can hold."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[
            F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name)
            if isinstance(f.dataType, nested)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def write_table(
    df: DataFrame,
    path: str,
    fmt: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write as ``csv``, ``json`` (one object per line, nulls kept) or ``parquet``."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"no writer for {fmt!r}")
    options = {
        "csv": {"header": "true", "escape": '"', "quoteAll": "true"},
        "json": {"ignoreNullFields": "false"},
        "parquet": {},
    }[fmt]
    writer = (_flat(df) if fmt == "csv" else df).write.mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)


def write_records(records: DataFrame, path: str) -> None:
    """The combined record set, laid out so that reading one split skips the others."""
    write_table(records, path, "parquet", ["split", "type"])


def write_json_array(df: DataFrame, path: str) -> None:
    """One array of objects per file, nulls kept; a task's rows are a file."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

    def bracket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = "["
        for batch in batches:
            if batch.num_rows:
                marks = pa.array([mark] + [","] * (batch.num_rows - 1))
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0), "")], ["value"])
                mark = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if mark == "," else "[]"])], ["value"])

    rows.mapInArrow(bracket, "value string").write.mode("overwrite").text(path)


def _cell(field: T.StructField) -> Column:
    """A value as text that any engine can state: fractions in whole millionths, lists joined, null as a mark."""
    column, kind = F.col(field.name), field.dataType

    def plain(value: Column, of: T.DataType) -> Column:
        if isinstance(of, (T.DoubleType, T.FloatType)):
            return F.round(value.cast("double") * 1e6).cast("long").cast("string")
        return value.cast("string")

    if isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(column, lambda x: plain(x, kind.elementType)), ",")
    else:
        text = plain(column, kind)
    return F.coalesce(text, F.lit("-"))


def content_number(df: DataFrame) -> Column:
    """A number of 60 bits for each row, from the md5 of its cells."""
    whole = F.concat_ws("|", *[_cell(f) for f in df.schema])
    return F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("decimal(38,0)")


def _measures(df: DataFrame) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(content_number(df)), F.lit(0)).cast("decimal(38,0)").alias("content_hash"),
    ]


def manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count, column names and an order-free content hash of each table."""
    rows = [
        df.agg(*_measures(df)).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(", ".join(df.columns)).alias("column_names"),
            "content_hash",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def write_with_manifest(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet", rules: Mapping[str, Column] | None = None
) -> DataFrame:
    """Write every table below ``folder`` and return its ``manifest``, measured on the rows as they are written.

    No table is read twice. ``rules`` are conditions whose rows are counted as well, one column each; a rule
    must make sense for every table.
    """
    rules = dict(rules or {})
    rows = []
    for name, df in tables.items():
        seen = Observation(name)
        flags = [F.count_if(c).alias(rule) for rule, c in rules.items()]
        write_table(df.observe(seen, *_measures(df), *flags), f"{folder}/{name}", fmt)
        got = seen.get
        rows.append((name, got["n_rows"], ", ".join(df.columns), got["content_hash"], *[got[r] for r in rules]))
    spark = next(iter(tables.values())).sparkSession
    schema = "table_name string, n_rows long, column_names string, content_hash decimal(38,0)"
    return spark.createDataFrame(rows, ", ".join([schema, *[f"`{r}` long" for r in rules]]))


def metrics_rows(values: DataFrame, run_id: str) -> DataFrame:
    """One wide row of metrics to ``(run_id, metric, value)`` rows."""
    return values.unpivot([], values.columns, "metric", "value").select(
        F.lit(run_id).alias("run_id"), "metric", "value"
    )


def log_metrics(metrics: DataFrame, path: str) -> None:
    write_table(metrics, path, "parquet", mode="append")
