"""Differences between two copies of the same data, cell by cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.runtime import pick

#: Fields that are compared as trimmed text; all others are compared as numbers where they read as one.
TEXT_FIELDS = ("INSTNM", "OPEID")


def comparable(field: Column, value: Column, text_fields: tuple[str, ...] = TEXT_FIELDS) -> Column:
    """A key that is equal for equal values: null for an empty value, the number for numbers, else the trimmed text."""
    t = T.null_if_token(value)
    number = T.read_number(t)
    # Adding 0.0 makes one zero of both.
    return F.when(field.isin(*text_fields) | number.isNull(), F.concat(F.lit("t:"), t)).otherwise(F.concat(F.lit("n:"), (number + 0.0).cast("string")))


def signed_cells(df: DataFrame, value: str, sign: int, text_fields: tuple[str, ...] = TEXT_FIELDS) -> DataFrame:
    """Key-field-value rows of one copy: +1 for the baseline, -1 for the current one."""
    field = T.varname(F.col("field"))
    return pick(df, "relative_path", "UNITID", "year", "field", value).select(
        T.path_key(F.col("relative_path")).alias("relative_path"), "UNITID", "year", field.alias("field"),
        comparable(field, F.col(value), text_fields).alias("value"), F.lit(sign).alias("sign"),
    )


def differences(baseline: DataFrame, current: DataFrame, text_fields: tuple[str, ...] = TEXT_FIELDS) -> DataFrame:
    """(relative_path, UNITID, year, field, kind) of records missing on a side and of fields whose values differ.

    Both sides become signed key-field-value rows; equal rows are counted per side before the shuffle, so a record that
    is repeated any number of times is one row per task afterwards. A cell differs if the sets of its values that are not
    empty differ. Null keys form records like any other value; a record that occurs only in rows with empty values is
    present. Repeated rows change nothing. With one empty side every record of the other is missing there.
    """
    key = ["relative_path", "UNITID", "year"]
    cells = (
        signed_cells(baseline, "baseline", 1, text_fields)
        .unionByName(signed_cells(current, "current", -1, text_fields))
        .groupBy(*key, "field", "value")
        .agg(F.count_if(F.col("sign") > 0).alias("b"), F.count_if(F.col("sign") < 0).alias("c"))
    )
    odd = F.when(F.col("value").isNotNull() & ((F.col("b") > 0) != (F.col("c") > 0)), F.col("field"))
    records = cells.groupBy(*key).agg(F.sum("b").alias("b"), F.sum("c").alias("c"), F.collect_set(odd).alias("fields"))
    found = F.when(F.col("c") == 0, F.array(F.struct(F.lit("").alias("field"), F.lit("missing_in_current").alias("kind")))).when(
        F.col("b") == 0, F.array(F.struct(F.lit("").alias("field"), F.lit("missing_in_baseline").alias("kind")))
    ).otherwise(F.transform("fields", lambda f: F.struct(f.alias("field"), F.lit("value_differs").alias("kind"))))
    return records.select(*key, F.explode(found).alias("d")).select(*key, "d.field", "d.kind")


def summary(found: DataFrame) -> DataFrame:
    """Counts per path, kind and field."""
    return found.groupBy("relative_path", "kind", "field").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("UNITID").alias("n_units"))
