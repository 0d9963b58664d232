"""References to records that do not exist.

State of the operator (three keyed tables, see :class:`State`):

* the parent index: (source_file, varnumber, year, n), n the number of live parent records;
* the reference counts: (table_name, source_file, varnumber, year, n), n the number of references to a key;
* the pending keys: those of the counts that find no parent, and whether the parent never was, is gone or comes later.

New references, arriving parents and deletions are signed deltas. An arriving parent takes a key out, a deletion puts it
back. Only keys touched by a delta are looked at again. Deltas commute: a deletion that comes before its arrival leaves a
negative count, which the arrival cancels; only positive counts are live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.runtime import bounded, materialise, pick

PARENT_KEY = ["source_file", "varnumber", "year"]
KEY = ["table_name", *PARENT_KEY]
#: The table whose references may leave source or year open.
OPEN_TABLE = "dictionary_ambiguity_overrides"
RAW = ["raw_source", "raw_number", "raw_year"]


def parent_delta(dictionary: DataFrame, sign: int = 1) -> DataFrame:
    """Signed parent keys of dictionary rows that have a varnumber; keys are normalised, repeats are counted."""
    return (
        pick(dictionary, "source_file", "varnumber", "year")
        .select(T.source_file(F.col("source_file")).alias("source_file"), T.varnumber(F.col("varnumber")).alias("varnumber"), F.col("year").cast("int").alias("year"))
        .where("varnumber is not null and year is not null")
        .groupBy(*PARENT_KEY)
        .agg((F.count(F.lit(1)) * sign).alias("n"))
    )


def apply_parents(index: DataFrame, delta: DataFrame) -> DataFrame:
    """The parent index after arrivals (+) and deletions (-); keys that cancel are dropped, negative ones wait for their arrival."""
    return index.unionByName(delta).groupBy(*PARENT_KEY).agg(F.sum("n").alias("n")).where("n <> 0")


def years_by_key(index: DataFrame) -> DataFrame:
    """(source_file, varnumber) -> its live years in order."""
    return index.where("n > 0").groupBy("source_file", "varnumber").agg(F.array_sort(F.collect_set("year")).alias("years"))


def years_anywhere(index: DataFrame) -> DataFrame:
    """varnumber -> its live years in any source, for references that leave the source open."""
    return index.where("n > 0").groupBy("varnumber").agg(F.array_sort(F.collect_set("year")).alias("any_years"))


def orphan_kind(year: Column, years: Column) -> Column:
    """``late`` if all live years come later, ``deleted`` if all are earlier, else ``missing``."""
    some = F.coalesce(F.size(years), F.lit(0)) > 0
    known = some & (F.coalesce(year, F.lit(0)) != 0)
    return F.when(known & (F.array_min(years) > year), F.lit("late")).when(known & (F.array_max(years) < year), F.lit("deleted")).otherwise(F.lit("missing"))


def panel_references(panel: DataFrame, *others: str) -> DataFrame:
    """References of panel rows that have a varnumber: (table_name, record_id, source_file, varnumber, year) and ``others``."""
    return pick(panel, "row_id", "source_file", "varnumber", "year", *others).select(
        F.lit("panel_long").alias("table_name"), F.col("row_id").alias("record_id"), T.source_file(F.col("source_file")).alias("source_file"),
        T.varnumber(F.col("varnumber")).alias("varnumber"), F.coalesce(F.col("year").cast("int"), F.lit(0)).alias("year"), *others,
    ).where("varnumber is not null")


def override_references(overrides: DataFrame) -> DataFrame:
    """References of overrides that select a varnumber; an empty or unreadable year is 0, an empty source ''."""
    year = T.null_if_token(F.col("year").cast("string")).try_cast("double").try_cast("int")
    return pick(overrides, "override_id", "source_file", "selected_varnumber", "year").select(
        F.lit(OPEN_TABLE).alias("table_name"), F.col("override_id").alias("record_id"),
        F.when(T.is_empty(F.col("source_file")), F.lit("")).otherwise(T.source_file(F.col("source_file"))).alias("source_file"),
        T.varnumber(F.col("selected_varnumber")).alias("varnumber"), F.coalesce(year, F.lit(0)).alias("year"),
    ).where("varnumber is not null")


def lookup(keys: DataFrame, index: DataFrame) -> DataFrame:
    """``keys`` (with table_name, source_file, varnumber, year) that have no live parent, with their ``kind``.

    In references of ``OPEN_TABLE`` an empty source matches any source and year 0 any year; in others they match nothing. The index is joined by broadcast when it is proven small; beyond
    that the join is shuffled.
    """
    found = keys.join(bounded(years_by_key(index)), ["source_file", "varnumber"], "left").join(bounded(years_anywhere(index)), "varnumber", "left")
    wild = F.col("table_name") == OPEN_TABLE
    found = found.withColumn("years", F.when(wild & (F.col("source_file") == ""), F.col("any_years")).otherwise(F.col("years")))
    met = F.coalesce(F.array_contains("years", F.col("year")), F.lit(False)) | (wild & (F.col("year") == 0) & F.col("years").isNotNull())
    return found.where(~met).withColumn("kind", orphan_kind(F.col("year"), F.col("years"))).select(*keys.columns, "kind")


@dataclass(frozen=True)
class State:
    """Live parents, live references per key, and the keys whose references wait for a parent."""

    index: DataFrame
    counts: DataFrame
    pending: DataFrame


def start(spark: SparkSession) -> State:
    """The state before any parent or reference."""
    empty = lambda schema: spark.createDataFrame([], schema)
    key = "table_name string, source_file string, varnumber string, year int, n long"
    return State(empty("source_file string, varnumber string, year int, n long"), empty(key), empty(key + ", kind string"))


def advance(state: State, references: DataFrame, parents: DataFrame) -> State:
    """The state after signed reference counts and signed parent changes.

    New references probe the index. A parent that arrives resolves what waits for it and one that goes reopens its
    references; either may also change the kind of what stays open, so all keys of its varnumber are looked at again. Keys
    that nothing touches keep their entry as it is.
    """
    index = apply_parents(state.index, parents)
    counts = state.counts.unionByName(references).groupBy(*KEY).agg(F.sum("n").alias("n")).where("n <> 0")
    live = counts.where("n > 0")
    moved = parents.select("varnumber").distinct()
    fresh = references.select(*KEY).distinct()
    quiet = state.pending.join(moved, "varnumber", "left_anti").join(fresh, KEY, "left_anti")
    touched = live.join(moved, "varnumber", "left_semi").unionByName(live.join(moved, "varnumber", "left_anti").join(fresh, KEY, "left_semi"))
    return State(index, counts, quiet.unionByName(lookup(touched, index).select(*state.pending.columns)))


def persist(state: State) -> State:
    """The state written to the shared folder, as between two batches."""
    return State(materialise(state.index, "parents"), materialise(state.counts, "references"), materialise(state.pending, "pending"))


def reference_counts(references: DataFrame, sign: int = 1) -> DataFrame:
    """References as signed counts per key, combined before the shuffle."""
    return references.groupBy(*KEY).agg((F.count(F.lit(1)) * sign).alias("n"))


def panel_spellings(panel: DataFrame) -> DataFrame:
    """The references of panel rows by raw spelling: (raw_source, raw_number, raw_year, the normalised key, n).

    Rows are counted as they are spelt, map-side, so that keys are normalised once per spelling and not once per row.
    """
    raw = ["source_file", "varnumber", "year"]
    counted = pick(panel, *raw).where("varnumber is not null").groupBy(*raw).agg(F.count(F.lit(1)).alias("n"))
    kept = counted.select("*", F.lit(0).cast("bigint").alias("row_id"), *[F.col(c).alias(r) for c, r in zip(raw, RAW)])
    return panel_references(kept, *RAW, "n").select("table_name", *PARENT_KEY, *RAW, "n")


def panel_reference_counts(panel: DataFrame, sign: int = 1) -> DataFrame:
    """Like :func:`reference_counts` of :func:`panel_references`, by way of the spellings."""
    return panel_spellings(panel).groupBy(*KEY).agg((F.sum("n") * sign).alias("n"))


def snapshot(pending: DataFrame) -> DataFrame:
    """Open references per table and period."""
    return pending.groupBy("table_name", "year").agg(F.sum("n").cast("bigint").alias("n_references"), F.count(F.lit(1)).alias("n_keys"))


def waiting_rows(panel: DataFrame, spellings: DataFrame, pending: DataFrame) -> DataFrame:
    """(table_name, year, record_id, kind) of the panel rows whose key is pending.

    Pending keys become the spellings that stand for them, and rows are joined by spelling, null-safe: by broadcast when
    these are proven few, else shuffled with a hot key's rows split by AQE, as each spelling has one entry.
    """
    open_ = spellings.join(pending.select(*KEY, "kind"), KEY).select("table_name", F.col("year").alias("at"), "kind", *RAW)
    rows = pick(panel, "row_id", "source_file", "varnumber", "year").where("varnumber is not null")
    same = (F.col("varnumber") == F.col(RAW[1])) & F.col("source_file").eqNullSafe(F.col(RAW[0])) & F.col("year").eqNullSafe(F.col(RAW[2]))
    return rows.join(bounded(open_), same).select("table_name", F.col("at").alias("year"), F.col("row_id").alias("record_id"), "kind")


def orphans(panel: DataFrame, dictionary: DataFrame, overrides: DataFrame) -> DataFrame:
    """(table_name, year, record_id, kind) of every reference that finds nothing.

    Two steps of the keyed state: all references come first and wait, then the dictionary arrives and resolves those it
    meets; the records of the keys that stay pending come out. Null and null-like varnumbers are no reference. A repeated row
    is reported under its own id. Without a dictionary every reference is ``missing``.
    """
    spellings = materialise(panel_spellings(panel), "spellings")
    wild = materialise(override_references(overrides), "overrides")
    counts = materialise(spellings.groupBy(*KEY).agg(F.sum("n").alias("n")).unionByName(reference_counts(wild)), "references")
    parents = materialise(parent_delta(dictionary), "parents")
    none = start(panel.sparkSession)
    waiting_all = State(none.index, counts, materialise(advance(none, counts, none.index).pending, "waiting"))
    pending = materialise(advance(waiting_all, none.counts, parents).pending, "pending")
    waiting = wild.join(pending.select(*KEY, "kind"), KEY).select("table_name", "year", "record_id", "kind")
    return waiting_rows(panel, spellings, pending).unionByName(waiting)
