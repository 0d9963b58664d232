"""Writers: parquet by year, CSV (plain or gzip), validated publishing, run records and reports."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files that one year of a partitioned table is written to at most.
YEAR_FILES = 16

RUNS = "run_id long, started_at timestamp, stage string, years_spec string, lane_split boolean, typed_output boolean, persist_duckdb boolean, n_rows long, config_json string"


def write_parquet(df: DataFrame, path: str, by_year: bool = False, max_rows_per_file: int = 0, mode: str = "overwrite") -> None:
    """A parquet table; with ``by_year`` one folder per year, each written by up to ``YEAR_FILES`` tasks, so that a large year is
    no single task."""
    if by_year:
        df = df.repartition("year", F.pmod(F.xxhash64(*[c for c in df.columns if c != "year"][:2]), F.lit(YEAR_FILES)))
    writer = df.write.mode(mode).option("compression", "snappy").option("maxRecordsPerFile", max_rows_per_file)
    (writer.partitionBy("year") if by_year else writer).parquet(path)


def write_csv(df: DataFrame, path: str, gzip: bool = False, single: bool = False, mode: str = "overwrite") -> None:
    """A CSV table with a header; ``single`` gathers it into one file and is meant for small reports."""
    out = df.coalesce(1) if single else df
    out.write.mode(mode).option("header", True).option("compression", "gzip" if gzip else "none").option("escape", '"').csv(path)


def publish(df: DataFrame, path: str, validate: Callable[[DataFrame], None], by_year: bool = False) -> None:
    """Write next to the target, validate what was written, and only then put it in place; a failed check publishes nothing."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging"
    write_parquet(df, staging, by_year)
    validate(spark.read.parquet(staging))
    jvm = spark.sparkContext._jvm
    target, temp = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staging)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.before")
    fs.delete(aside, True)
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(temp, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"could not move {staging} to {path}")
    fs.delete(aside, True)


def record_run(spark: SparkSession, path: str, stage: str, config: object, years_spec: str = "", n_rows: int | None = None) -> int:
    """Append one run to the run table; the id is the time in nanoseconds, the configuration JSON with sorted keys."""
    import datetime

    values = asdict(config) if is_dataclass(config) else dict(config)
    run = time.time_ns()
    flags = [bool(values.get(k)) for k in ("lane_split", "typed_output", "persist_duckdb")]
    row = (run, datetime.datetime.now(), stage, years_spec, *flags, n_rows, json.dumps(values, sort_keys=True, default=str))
    spark.createDataFrame([row], RUNS).write.mode("append").parquet(path)
    return run


def write_report(path: str, text: str) -> None:
    """A small text report (Markdown, JSON or HTML) on the driver."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def write_workbook(path: str, frames: dict[str, DataFrame], max_rows: int = 100_000) -> None:
    """Small tables as sheets of a workbook; needs openpyxl, which is optional."""
    try:
        from openpyxl import Workbook
    except ImportError as e:
        raise RuntimeError("workbooks need openpyxl; write CSV instead") from e
    book = Workbook()
    book.remove(book.active)
    for name, df in frames.items():
        rows = df.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"{name} is too large for a sheet")
        sheet = book.create_sheet(name[:31])
        sheet.append(df.columns)
        for r in rows:
            sheet.append(list(r))
        sheet.freeze_panes = "A2"
    book.save(path)


def data_package(name: str, frames: dict[str, DataFrame]) -> str:
    """A JSON description of tables and their columns."""
    resources = [{"name": n, "schema": {"fields": [{"name": c, "type": t} for c, t in df.dtypes]}} for n, df in frames.items()]
    return json.dumps({"name": name, "resources": resources}, indent=1)
