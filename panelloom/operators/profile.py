"""Variable profiles, related variables and search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import rules
from panelloom.functions import text as T
from panelloom.operators.dictionary import best_modes, summaries
from panelloom.runtime import materialise

# Words too common to relate variables by, what shared properties are worth, the least score of a related
# variable and how many are kept of each.
COMMON_WORDS = (
    "THE", "AND", "FOR", "WITH", "FROM", "THAT", "THIS", "WITHIN", "RATE", "TOTAL", "NUMBER", "STUDENT", "STUDENTS", "VARIABLE", "IPEDS", "DATA", "INSTITUTION",
    "INSTITUTIONS",
)
ALIKE = {"component": 20, "family": 35, "variable_form": 8, "primary_source": 6, "root": 18, "word": 3}
RELATED_FROM, RELATED_KEPT = 28, 6
# Search scores, from the name itself down to its description.
SCORES = {"name": 140, "name_start": 115, "in_name": 92, "in_title": 74, "in_form": 68, "source": 64, "in_family": 62, "in_component": 58, "in_description": 34}


def variable_profile(staged: DataFrame, lake: DataFrame) -> DataFrame:
    """One row per variable: coverage, completeness, form and texts.

    ``staged`` rows are counted per variable and year; the fill percentage is over all unit-years of the panel.
    """
    window = staged.agg(F.count_distinct("year").alias("years"), F.count_distinct("year", "UNITID").alias("unit_years")).first()
    cells = staged.where("value_norm is not null").groupBy("varname").agg(
        F.count_distinct("year").alias("n_years"), F.min("year").alias("year_min"), F.max("year").alias("year_max"), F.count_distinct("year", "UNITID").alias("filled"),
        F.count(T.read_plain_double(F.col("value_norm"))).alias("n_numeric"), F.count(F.lit(1)).alias("n_values"),
    )
    rows = cells.join(summaries(lake), "varname", "left").join(best_modes(lake, "DataType").withColumnRenamed("mode", "_declared"), "varname", "left")
    percent = F.round(F.col("filled") * 100 / F.lit(window.unit_years), 4)
    kind = F.when(F.col("n_numeric") == F.col("n_values"), "numeric").otherwise("string")
    texts = F.concat_ws(" ", "varname", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    # Step by step, so that the long rules aren't copied into each other.
    rows = materialise(rows.withColumn("_texts", texts), "profile").withColumn("component", rules.component(F.coalesce("primary_source", F.lit("")), F.col("_texts")))
    rows = rows.withColumn("family", rules.family(F.col("component"), F.col("_texts")))
    return rows.select(
        "varname", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("description", F.lit("")).alias("description"), F.coalesce("primary_source", F.lit("")).alias("primary_source"),
        F.coalesce("source_count", F.lit(0)).cast("bigint").alias("source_count"), "year_min", "year_max", "n_years", percent.alias("completeness"), L.completeness(percent).alias("completeness_bucket"),
        L.coverage(F.col("n_years"), F.lit(window.years)).alias("coverage_bucket"), kind.alias("panel_type"), L.variable_form(F.col("varname"), F.col("title"), kind, F.col("_declared")).alias("variable_form"),
        "component", "family",
    )


def related(profile: DataFrame) -> DataFrame:
    """(varname, other, score, rank): the most alike variables of each, by component, family, form, source, name roots and words.

    Pairs come from shared keys (a family, a component with a form, a root, a word), never from all pairs; a pair without a
    shared key can't reach the least score. Variables are metadata: their number doesn't grow with the rows.
    """
    tokens = F.regexp_extract_all(F.upper(F.concat_ws(" ", "varname", "title", "description", "family")), F.lit("([A-Z0-9]+)"), 1)
    words = F.array_distinct(F.filter(tokens, lambda w: (F.length(w) > 2) & ~w.isin(*COMMON_WORDS)))
    name = F.upper("varname")
    roots = F.array_distinct(F.filter(F.array(name, F.regexp_replace(name, "[0-9]+$", ""), F.regexp_extract(name, "^([A-Z]+)", 1)), lambda r: F.length(r) > 2))
    v = profile.select("varname", "component", "family", "primary_source", "variable_form", words.alias("words"), roots.alias("roots"))
    tagged = lambda tag, c: F.transform(c, lambda x: F.concat(F.lit(tag), x))
    v = materialise(v, "related")
    both = F.array(F.concat(F.lit("f:"), "family"), F.concat(F.lit("c:"), "component", F.lit("|"), "variable_form"))
    keys = v.select("varname", F.explode(F.concat(both, tagged("r:", F.col("roots")), tagged("w:", F.col("words")))).alias("key"))
    pairs = keys.alias("a").join(keys.alias("b"), F.col("a.key") == F.col("b.key")).where("a.varname <> b.varname").select(F.col("a.varname").alias("x"), F.col("b.varname").alias("y")).distinct()
    a, b = v.alias("a"), v.alias("b")
    found = pairs.join(a, F.col("x") == F.col("a.varname")).join(b, F.col("y") == F.col("b.varname"))
    same = lambda c: (F.col(f"a.{c}") == F.col(f"b.{c}")).cast("int") * ALIKE[c]
    score = (
        same("component") + same("family") + same("variable_form") + F.when(F.col("a.primary_source") != "", same("primary_source")).otherwise(0)
        + F.arrays_overlap("a.roots", "b.roots").cast("int") * ALIKE["root"] + F.size(F.array_intersect("a.words", "b.words")) * ALIKE["word"]
    )
    top = Window.partitionBy("varname").orderBy(F.desc("score"), "other")
    scored = found.select(F.col("x").alias("varname"), F.col("y").alias("other"), score.alias("score")).where(F.col("score") >= RELATED_FROM)
    return scored.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= RELATED_KEPT)


def search(profile: DataFrame, query: str, **filters: str) -> DataFrame:
    """Variables that match a query, best first; ``filters`` are column = value. An empty query gives all in order of name."""
    q = query.strip().lower()
    rows = profile
    for column, wanted in filters.items():
        rows = rows.where(F.col(column) == wanted)
    low = lambda c: F.lower(F.coalesce(F.col(c), F.lit("")))
    name = low("varname")
    tests = {
        "name": name == q, "name_start": name.startswith(q), "in_name": name.contains(q), "in_title": low("title").contains(q), "in_form": low("variable_form").contains(q),
        "source": low("primary_source") == q, "in_family": low("family").contains(q), "in_component": low("component").contains(q), "in_description": low("description").contains(q),
    }
    score = F.coalesce(*[F.when(tests[k], n) for k, n in SCORES.items()], F.lit(0))
    rows = rows.withColumn("score", score if q else F.lit(0))
    return (rows.where("score > 0") if q else rows).orderBy(F.desc("score"), "varname")


def schema_digest(df: DataFrame, name: str, n_rows: int) -> str:
    """SHA-256 over a table's name, rows and columns with their types, in order."""
    import hashlib

    h = hashlib.sha256(f"{name}{n_rows}".encode())
    for c, t in df.dtypes:
        h.update(f"{c}{t}".encode())
    return h.hexdigest()


def column_stats(df: DataFrame, key: str = "year") -> DataFrame:
    """(column, non_null) of every column and the range of the key, from one pass."""
    one = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)], F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("non_null")) for i, c in enumerate(df.columns)]))
    return one.select(cells.alias("c"), "n", "lo", "hi").select("c.*", F.col("n").alias("n_rows"), F.col("lo").alias("key_min"), F.col("hi").alias("key_max"))
