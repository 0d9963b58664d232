"""The variable dictionary: normalisation, lookups, backfill, surrogates, ambiguity and audits."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import text as T
from panelloom.operators.longform import GateError
from panelloom.operators.structure import one_row
from panelloom.runtime import BROADCAST_ROWS, bounded

LAKE_KEY = ["year", "source_file", "varnumber", "varname"]


def normalised(lake: DataFrame) -> DataFrame:
    """Normalised keys, one row per (year, source_file, varnumber, varname): the least of the other columns, nulls last."""
    rows = lake.withColumns(
        {"varname": T.varname(F.col("varname")), "varnumber": F.coalesce(T.varnumber(F.col("varnumber")), F.lit("")), "source_file": T.source_file(F.col("source_file"))}
    )
    rest = [c for c in lake.columns if c not in LAKE_KEY]
    order = [x for c in rest for x in (F.col(c).isNull().alias(f"_n_{c}"), F.col(c))]
    kept = rows.groupBy(*LAKE_KEY).agg(F.min(F.struct(*order)).alias("m"))
    return kept.select(*[F.col(c) if c in LAKE_KEY else F.col(f"m.{c}").alias(c) for c in lake.columns])


def describe(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows with the first description found under (table, number), (table, name), number alone, then name alone.

    ``texts``: (ordinal, table_key, varnumber, varname, description). The earliest by ordinal wins per key; blank
    descriptions and blank keys never match.
    """
    good = texts.where(T.strip(F.col("description")) != "")

    def book(*key: str) -> DataFrame:
        kept = good.where(" and ".join(f"coalesce({k}, '') <> ''" for k in key if k != "table_key"))
        return kept.groupBy(*key).agg(F.min_by("description", "ordinal").alias("_d" + "_".join(key)))

    keys = [("table_key", "varnumber"), ("table_key", "varname"), ("varnumber",), ("varname",)]
    out = rows
    for key in keys:
        out = out.join(bounded(book(*key)), list(key), "left")
    names = ["_d" + "_".join(k) for k in keys]
    return out.withColumn("described", F.coalesce(*names, F.lit(""))).drop(*names)


def match_tables(tables: DataFrame, lake: DataFrame) -> DataFrame:
    """Dictionary rows whose source_file or access table matches a table of the same year, each once.

    The OR is a union of two equi-joins, so neither becomes a nested loop.
    """
    t = tables.select("year", F.upper(T.strip(F.col("source_file"))).alias("want_source"), F.upper(T.strip(F.col("access_table_name"))).alias("want_table"))
    d = lake.select("year", F.upper(F.col("source_file")).alias("s"), F.upper(F.col("access_table_name")).alias("a"), "varname", "varnumber")
    by_source = t.join(d, (t.year == d.year) & (t.want_source == d.s) & (t.want_source != "")).select(t.year, "want_source", "want_table", "varname", "varnumber")
    by_table = t.join(d, (t.year == d.year) & (t.want_table == d.a) & (t.want_table != "")).select(t.year, "want_source", "want_table", "varname", "varnumber")
    return by_source.unionByName(by_table).distinct()


def nearest_donors(lake: DataFrame, years: list[int]) -> DataFrame:
    """(source_file, year, donor_year) for years in which a source has no rows: the nearest year that has, earlier on ties.

    Per source and year the nearest year on either side is found by running maxima and minima over the union of both, so
    years and donors are never paired.
    """
    have = lake.where("source_file <> '' and not startswith(coalesce(metadata_source, ''), 'synthetic_')").select("source_file", F.col("year").cast("int").alias("year")).distinct()
    wanted = have.select("source_file").distinct().select("source_file", F.explode(F.lit(list(years)).cast("array<int>")).alias("year"))
    rows = wanted.join(have.withColumn("_have", F.lit(True)), ["source_file", "year"], "full_outer")
    w = Window.partitionBy("source_file").orderBy("year")
    own = F.when(F.col("_have"), F.col("year"))
    near = rows.withColumns({"_lo": F.max(own).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_hi": F.min(own).over(w.rowsBetween(0, Window.unboundedFollowing))})
    low = F.col("_lo").isNotNull() & (F.col("_hi").isNull() | (F.col("year") - F.col("_lo") <= F.col("_hi") - F.col("year")))
    return near.where("_have is null").select("source_file", "year", F.when(low, F.col("_lo")).otherwise(F.col("_hi")).alias("donor_year"))


def backfill(lake: DataFrame, donors: DataFrame, label: str = "year_backfill") -> DataFrame:
    """Dictionary rows of the donor years under the years they stand in for."""
    d = donors.select(F.col("source_file").alias("_s"), F.col("year").alias("_y"), "donor_year")
    rows = lake.join(bounded(d), (F.col("source_file") == F.col("_s")) & (F.col("year") == F.col("donor_year")))
    return rows.withColumns({"year": F.col("_y"), "metadata_source": F.lit(label)}).select(*lake.columns)


def surrogate_starts(lake: DataFrame) -> DataFrame:
    """Imputation flags without a row of their own: (year, source_file, imputationvar, anchor, start).

    The start number follows from the CRC-32 of the key: just behind the anchor variable, or in a range of its own.
    """
    d = lake.select("year", "source_file", "varname", "varnumber", F.upper(T.strip(F.col("imputationvar"))).alias("imputationvar"))
    flags = d.where("coalesce(imputationvar, '') <> ''").groupBy("year", "source_file", "imputationvar").agg(F.min_by("varnumber", F.struct("varnumber", "varname")).alias("anchor"))
    known = d.select("year", "source_file", F.col("varname").alias("imputationvar")).distinct()
    crc = F.crc32(F.concat_ws("|", F.col("year").cast("string"), "source_file", "imputationvar").cast("binary"))
    digits = F.col("anchor").rlike("^[0-9]+$") & (F.col("anchor") != "00000000")
    start = F.when(digits, F.col("anchor").try_cast("bigint") + 1 + crc % 11).otherwise(F.lit(85_000_000) + crc % 10_000_000)
    return flags.join(known, ["year", "source_file", "imputationvar"], "left_anti").withColumn("start", start)


def surrogate_rows(spark: SparkSession, starts: DataFrame, used: DataFrame) -> DataFrame:
    """(year, source_file, imputationvar, varnumber): the next free number from each start, in order of the keys.

    Probing is sequential, so it runs on the driver; dictionaries beyond the broadcast bound are refused.
    """
    rows = starts.orderBy("year", "source_file", "imputationvar").limit(BROADCAST_ROWS + 1).collect()
    taken = {r[0] for r in used.select("varnumber").distinct().limit(BROADCAST_ROWS + 1).collect()}
    if max(len(rows), len(taken)) > BROADCAST_ROWS:
        raise GateError("the dictionary is too large for surrogate numbers")
    out = []
    for r in rows:
        n = r["start"]
        while f"{n:08d}" in taken:
            n += 1
        taken.add(f"{n:08d}")
        out.append((r["year"], r["source_file"], r["imputationvar"], f"{n:08d}"))
    return spark.createDataFrame(out, "year int, source_file string, imputationvar string, varnumber string")


def surrogate_start(year: int, source: str, name: str, anchor: str) -> int:
    """The start number of one key, for tests of the column expression."""
    crc = zlib.crc32(f"{year}|{source}|{name}".encode())
    return int(anchor) + 1 + crc % 11 if anchor.isdigit() and anchor != "00000000" else 85_000_000 + crc % 10_000_000


def unit_rows(lake: DataFrame) -> DataFrame:
    """(year, varname, varnumber, source_file, academic_year_label): the key's own entry for years that lack it."""
    years = lake.select("year").where("year is not null").distinct()
    have = lake.where("source_file = 'KEYS' and varname = 'UNITID'").select("year").distinct()
    return years.join(have, "year", "left_anti").select(
        "year", F.lit("UNITID").alias("varname"), F.lit("00000001").alias("varnumber"), F.lit("KEYS").alias("source_file"), L.academic_label(F.col("year")).alias("academic_year_label")
    )


def ambiguities(lake: DataFrame) -> DataFrame:
    """(year, source_file, access_table_name, varname) with more than one candidate, and the candidates in order."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("varnumber", "metadata_source", "metadata_table_name")]
    return lake.groupBy("year", "source_file", F.upper(T.strip(F.col("access_table_name"))).alias("access_table_name"), "varname").agg(
        F.count_distinct(F.concat_ws("|", *parts)).alias("n_candidates"), F.array_join(F.array_sort(F.collect_set(F.concat_ws("|", *parts))), ";").alias("candidates")
    ).where("n_candidates > 1")


def clean_overrides(overrides: DataFrame) -> DataFrame:
    """Overrides with normalised keys; empty selections and keys are ''."""
    keep = lambda c: F.coalesce(T.null_if_token(F.col(c).cast("string")), F.lit(""))
    return overrides.select(
        "override_id", keep("year").alias("o_year"), T.source_file(keep("source_file")).alias("o_source"), F.upper(keep("access_table_name")).alias("o_table"),
        T.varname(F.col("varname")).alias("o_varname"), F.coalesce(T.varnumber(F.col("selected_varnumber")), F.lit("")).alias("o_varnumber"),
        keep("selected_metadata_source").alias("o_metadata"), keep("selected_metadata_table_name").alias("o_metadata_table"),
    )


def match_overrides(ambiguous: DataFrame, overrides: DataFrame) -> DataFrame:
    """Ambiguous keys with the overrides that match them; an empty part of an override matches anything.

    The variable name is always given, so it is an equi-join with the wildcards as a residual condition.
    """
    o = bounded(clean_overrides(overrides))
    year = F.col("o_year").try_cast("double").try_cast("int")
    wild = ((F.col("o_year") == "") | (year == F.col("year"))) & F.col("o_source").isin("", F.col("source_file")) & F.col("o_table").isin("", F.col("access_table_name"))
    return ambiguous.join(o, (F.col("varname") == F.col("o_varname")) & wild).select("year", "source_file", "access_table_name", "varname", "override_id", "o_varnumber", "o_metadata", "o_metadata_table")


def settle(lake: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per ambiguous key: how many overrides match, how many candidates they leave, and whether the key is settled.

    A key is settled by exactly one override that leaves exactly one candidate.
    """
    keys = ["year", "source_file", "access_table_name", "varname"]
    many = ambiguities(lake)
    hits = match_overrides(many, overrides)
    cand = lake.select("year", "source_file", F.upper(T.strip(F.col("access_table_name"))).alias("access_table_name"), "varname", "varnumber", *[F.coalesce(c, F.lit("")).alias(c) for c in ("metadata_source", "metadata_table_name")]).distinct()
    fits = F.col("o_varnumber").isin("", F.col("varnumber")) & F.col("o_metadata").isin("", F.col("metadata_source")) & F.col("o_metadata_table").isin("", F.col("metadata_table_name"))
    left = hits.join(cand, keys).groupBy(*keys).agg(F.count_distinct("override_id").alias("n_overrides"), F.count_if(fits).alias("n_selected"))
    return many.select(*keys, "n_candidates").join(left, keys, "left").fillna(0, ["n_overrides", "n_selected"]).withColumn("settled", (F.col("n_overrides") == 1) & (F.col("n_selected") == 1))


def ambiguity_gate(lake: DataFrame, overrides: DataFrame) -> DataFrame:
    """Ambiguous keys that no override settles; GateError if there are any."""
    open_ = settle(lake, overrides).where("not settled")
    if rows := open_.orderBy("year", "source_file", "access_table_name", "varname").limit(10).collect():
        raise GateError(f"ambiguous without an override: {[tuple(r)[:4] for r in rows]}")
    return open_


def best_text(c: Column) -> Column:
    """An aggregate: the longest text that isn't null-like, the first in order among equals; null if there is none."""
    t = T.strip(c)
    good = F.when(~F.lower(t).isin("", *T.TEXT_NULL_TOKENS), F.struct(-F.length(t), t.alias("t")))
    return F.min(good)["t"]


def summaries(lake: DataFrame) -> DataFrame:
    """One row per variable: its best texts, and its primary source (most rows, first in order among equals)."""
    texts = lake.groupBy("varname").agg(best_text(F.col("varTitle")).alias("title"), best_text(F.col("longDescription")).alias("description"), F.count(F.lit(1)).alias("n_rows"))
    counts = lake.where("source_file <> ''").groupBy("varname", "source_file").agg(F.count(F.lit(1)).alias("n"))
    primary = counts.groupBy("varname").agg(F.min(F.struct(-F.col("n"), F.col("source_file"))).alias("p"), F.count(F.lit(1)).alias("source_count"))
    return texts.join(primary.select("varname", F.col("p.source_file").alias("primary_source"), "source_count"), "varname", "left")


def best_modes(lake: DataFrame, column: str) -> DataFrame:
    """(varname, mode): the most frequent text of a column per variable, the first in order among equals."""
    counts = lake.select("varname", T.null_if_token(F.col(column), ("", *T.TEXT_NULL_TOKENS)).alias("v")).where("v is not null").groupBy("varname", "v").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("varname").agg(F.min(F.struct(-F.col("n"), F.col("v"))).alias("b")).select("varname", F.col("b.v").alias("mode"))


def panel_dictionary(columns: DataFrame, lake: DataFrame) -> DataFrame:
    """Panel columns with what the dictionary knows of them; unknown ones keep empty texts."""
    return columns.join(summaries(lake), "varname", "left").fillna("", ["title", "description", "primary_source"])


def audit_duplicates(lake: DataFrame) -> DataFrame:
    """Keys with several rows."""
    return lake.groupBy(*LAKE_KEY).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def audit_sources(lake: DataFrame) -> DataFrame:
    """(year, varnumber, varname) that several sources carry."""
    return _several(lake.where("varnumber <> ''"), ["year", "varnumber", "varname"], "source_file")


def audit_collisions(lake: DataFrame) -> DataFrame:
    """(year, source_file, varnumber) that several names carry."""
    return _several(lake.where("varnumber <> ''"), ["year", "source_file", "varnumber"], "varname")


def _several(rows: DataFrame, key: list[str], column: str) -> DataFrame:
    found = rows.groupBy(*key).agg(F.array_sort(F.collect_set(column)).alias("v"))
    return found.where("size(v) > 1").select(*key, F.size("v").alias("n_values"), F.array_join("v", "|").alias("found"))


def audit_descriptions(lake: DataFrame) -> DataFrame:
    """Rows and missing descriptions per year and source."""
    blank = F.coalesce(T.strip(F.col("longDescription")), F.lit("")) == ""
    return lake.groupBy("year", "source_file").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_missing"), F.round(F.count_if(blank) / F.count(F.lit(1)), 9).alias("missing_rate"))


def audit_years(lake: DataFrame) -> DataFrame:
    """Per source: its years in order, its category and rows."""
    years = F.array_join(F.array_sort(F.collect_set("year")).cast("array<string>"), ",")
    return lake.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"), years.alias("years")).withColumn("category", L.source_category(F.col("source_file")))


def audit_categories(lake: DataFrame) -> DataFrame:
    """Rows and sources per category."""
    return lake.withColumn("category", L.source_category(F.col("source_file"))).groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source_file").alias("n_sources"))


def audit_summary(lake: DataFrame) -> DataFrame:
    """The audit in one row."""
    blank = F.coalesce(T.strip(F.col("longDescription")), F.lit("")) == ""
    base = lake.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("year").alias("n_years"), F.count_distinct("source_file").alias("n_sources"), F.count_distinct("varname").alias("n_variables"),
        F.count_if(F.col("varnumber") == "").alias("n_without_number"), F.count_if(blank).alias("n_without_description"), F.count_if(F.coalesce("imputationvar", F.lit("")) != "").alias("n_with_imputation"),
    )
    parts = [("n_duplicate_keys", audit_duplicates(lake)), ("n_source_conflicts", audit_sources(lake)), ("n_collisions", audit_collisions(lake)), ("n_ambiguous", ambiguities(lake))]
    return one_row([base, *[rows.agg(F.count(F.lit(1)).alias(name)) for name, rows in parts]])
