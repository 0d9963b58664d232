"""Queries of the panel operators and the SQL they are checked against.

All run over whole tables. The long panel and the dictionary are read as they are; the wide panel of the structure and
cleaning queries is the release copy put into one row per unit and year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions import labels as L
from panelloom.functions import rules
from panelloom.functions import sql as S
from panelloom.functions import text as T
from panelloom.operators import clean, compare, dictionary, eav, gates, longform, monitor, profile, structure, wide
from panelloom.plans.catalog import Catalog
from panelloom.plans.data_queries import table
from panelloom.plans.options import WideOptions
from panelloom.plans.pipeline import build
from panelloom.runtime import materialise

DIM_SOURCES, DIM_PREFIXES = ("LIBR",), ("FIN_",)
FIELDS = ["INSTNM", "CONTROL", "SECTOR", "ICLEVEL", "OPEID", "PRCH_F", "FINVAL"]
LINEAGE = {"INSTNM": "HD", "CONTROL": "HD", "SECTOR": "HD", "ICLEVEL": "HD|F_F", "OPEID": "HD", "PRCH_F": "FLAGS", "FINVAL": "F_FA"}

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _double(x: str) -> str:
    return f"(CASE WHEN NOT regexp_matches({x}, '[dDfF]$|_') THEN try_cast({x} AS DOUBLE) END)"


def _ids(x: str) -> str:
    return S.null_if_token(x, structure.ID_NULLS)


# --- staging, lanes and conflicts

_STAGE = f"""stage AS (SELECT UNITID, year, {S.varname("varname")} AS varname, {S.strip("value")} AS value, {S.null_if_token("value")} AS value_norm,
 coalesce(upper({S.strip("source_file")}), '') AS source_file, coalesce({S.strip("varnumber")}, '') AS varnumber FROM panel_long
 WHERE UNITID IS NOT NULL AND year IS NOT NULL AND {S.varname("varname")} <> '')"""
_DIM = "(source_file IN ('LIBR') OR starts_with(source_file, 'FIN_'))"
_BASE = f"""WITH {_STAGE},
 base AS (SELECT UNITID, year, varname, min(value) AS value, value_norm, source_file, varnumber FROM stage WHERE NOT {_DIM} GROUP BY UNITID, year, varname, value_norm, source_file, varnumber),
 keys AS (SELECT UNITID, year, varnumber, source_file, count(DISTINCT value_norm) AS distinct_values FROM base WHERE value_norm IS NOT NULL
          GROUP BY ALL HAVING min(value_norm) <> max(value_norm)),
 kept AS (SELECT base.* FROM base ANTI JOIN keys USING (UNITID, year, varnumber, source_file))"""
_LAKE = f"""lake AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY year, source_file, varnumber, varname ORDER BY "varTitle" NULLS LAST,
  "longDescription" NULLS LAST, "DataType" NULLS LAST, format NULLS LAST, "Fieldwidth" NULLS LAST, imputationvar NULLS LAST, source_file_label NULLS LAST,
  access_table_name NULLS LAST, metadata_table_name NULLS LAST, academic_year_label NULLS LAST, release_type NULLS LAST, metadata_source NULLS LAST) AS rn
 FROM (SELECT * REPLACE ({S.varname("varname")} AS varname, coalesce({S.varnumber("varnumber")}, '') AS varnumber, {S.source_file("source_file")} AS source_file) FROM dictionary_lake)) WHERE rn = 1)"""
_IND = """names AS (SELECT DISTINCT varname, regexp_extract(varname, '^(.*?)([0-9]+)$', 1) AS base, regexp_extract(varname, '^(.*?)([0-9]+)$', 2) AS suffix FROM lake
   WHERE (lower(trim("DataType")) = 'disc' OR lower(trim(format)) = 'disc')),
 ind AS (SELECT * FROM names WHERE base <> '' AND base IN (SELECT base FROM names GROUP BY base HAVING count(*) > 1)),
 ranked AS (SELECT kept.*, base, suffix, row_number() OVER (PARTITION BY UNITID, year, base, suffix ORDER BY source_file, varnumber, value_norm, value, varname) AS rn
   FROM kept JOIN ind USING (varname) WHERE value_norm IS NOT NULL),
 active AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1 AND CASE WHEN """ + _double("value_norm") + " IS NOT NULL THEN " + _double("value_norm") + """ <> 0
   WHEN lower(value_norm) IN ('n', 'no', 'f', 'false') THEN false ELSE true END),
 choice AS (SELECT UNITID, year, base, count(DISTINCT suffix) AS n_active, min(suffix) AS chosen_suffix FROM active GROUP BY UNITID, year, base)"""  # fmt: skip
_DISC = f"{_BASE}, {_LAKE}, {_IND}"
_FINAL = f"""{_BASE}, final AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY year, UNITID, varname
   ORDER BY source_file, varnumber, coalesce(value_norm, ''), coalesce(value, '')) AS rn FROM kept) WHERE rn = 1)"""


def staged(spark, d) -> DataFrame:
    return wide.stage(table(spark, d, "panel_long"))


def base_rows(spark, d) -> DataFrame:
    return wide.base_rows(wide.lanes(staged(spark, d), DIM_SOURCES, DIM_PREFIXES)[0])


def kept_rows(spark, d) -> DataFrame:
    base = base_rows(spark, d)
    return wide.without_conflicts(base, wide.conflict_keys(base))


def final_rows(spark, d) -> DataFrame:
    return wide.final_rows(kept_rows(spark, d))


def lake(spark, d) -> DataFrame:
    return dictionary.normalised(table(spark, d, "dictionary_lake"))


@query(f"WITH {_STAGE} SELECT * FROM stage")
def stage_projection(spark, d):
    return staged(spark, d)


@query(f"WITH {_STAGE} SELECT DISTINCT * FROM stage WHERE NOT {_DIM}")
def lane_scalar(spark, d):
    return wide.lanes(staged(spark, d), DIM_SOURCES, DIM_PREFIXES)[0]


@query(f"WITH {_STAGE} SELECT DISTINCT * FROM stage WHERE {_DIM}")
def lane_dimension(spark, d):
    return wide.lanes(staged(spark, d), DIM_SOURCES, DIM_PREFIXES)[1]


@query(f"{_BASE} SELECT * FROM base")
def base_dedupe(spark, d):
    return base_rows(spark, d)


@query(f"{_BASE} SELECT * FROM keys")
def scalar_conflict_keys(spark, d):
    return wide.conflict_keys(base_rows(spark, d))


@query(f"{_BASE} SELECT base.*, distinct_values FROM base JOIN keys USING (UNITID, year, varnumber, source_file)")
def scalar_conflict_detail(spark, d):
    base = base_rows(spark, d)
    return wide.conflict_rows(base, wide.conflict_keys(base))


@query(f"{_BASE} SELECT * FROM kept")
def scalar_conflict_removed(spark, d):
    return kept_rows(spark, d)


@query(f"WITH {_STAGE} SELECT DISTINCT year, UNITID FROM stage")
def spine(spark, d):
    return wide.spine(staged(spark, d))


@query(f"WITH {_STAGE} SELECT varname, source_file, varnumber, count(*) AS n_rows, count(value_norm) AS n_non_empty FROM stage GROUP BY ALL")
def source_lineage_counts(spark, d):
    return wide.discover(staged(spark, d))


@query(f"WITH {_STAGE} SELECT varname, count(*) AS n_rows, count(value_norm) AS n_non_empty FROM stage GROUP BY ALL")
def variable_discovery(spark, d):
    return wide.variable_counts(wide.discover(staged(spark, d)))


@query(f"WITH {_STAGE} SELECT varname, count(*) AS n_rows, count(value_norm) AS n_non_empty FROM stage WHERE NOT {_DIM} AND varname NOT IN ('UNITNAME', 'TOWN') GROUP BY ALL")
def scalar_discovery(spark, d):
    rows = wide.stage(table(spark, d, "panel_long"), exclude=("UNITNAME", "TOWN"))
    return wide.variable_counts(wide.discover(rows.where(~wide.in_dimension(F.col("source_file"), DIM_SOURCES, DIM_PREFIXES))))


# --- indicator collapse, duplicates, pivot and reports


@query(f"{_DISC} SELECT * FROM ind")
def indicator_groups(spark, d):
    return wide.indicator_map(lake(spark, d))


# Orders as one-hot indicators: one variable per priority, on or off by status.
_ORD = """WITH kept AS (SELECT UNITID, year, varname, min(value) AS value, value AS value_norm, source_file, varnumber FROM (SELECT o_custkey AS "UNITID", CAST(year(o_orderdate) AS INTEGER) AS year, 'PRIO' || o_orderpriority[1] AS varname,
  CASE o_orderstatus WHEN 'F' THEN 'no' WHEN 'O' THEN '1' ELSE 'yes' END AS value, CASE WHEN o_orderkey % 3 = 0 THEN 'IC' ELSE 'ORD' END AS source_file, '' AS varnumber FROM orders) GROUP BY ALL),
 ind AS (SELECT varname, 'PRIO' AS base, varname[5:] AS suffix FROM (SELECT DISTINCT varname FROM kept)),""" + _IND[_IND.index(" ranked AS"):]  # fmt: skip


def order_indicators(spark, d) -> tuple[DataFrame, DataFrame]:
    status = F.when(F.col("o_orderstatus") == "F", "no").when(F.col("o_orderstatus") == "O", "1").otherwise("yes")
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("UNITID"), F.year("o_orderdate").alias("year"), F.concat(F.lit("PRIO"), F.substring("o_orderpriority", 1, 1)).alias("varname"), status.alias("value"), status.alias("value_norm"),
        F.when(F.col("o_orderkey") % 3 == 0, "IC").otherwise("ORD").alias("source_file"), F.lit("").alias("varnumber"),
    )
    base, suffix = L.split_indicator(F.col("varname"))
    return wide.base_rows(rows), rows.select("varname").distinct().select("varname", base.alias("base"), suffix.alias("suffix"))


@query(f"{_ORD} SELECT * FROM active")
def indicator_active(spark, d):
    return wide.active_indicators(*order_indicators(spark, d))


@query(f"{_ORD} SELECT * FROM choice")
def indicator_choice(spark, d):
    return wide.indicator_choice(indicator_active(spark, d))


@query(f"""{_ORD} SELECT UNITID, year, varname, value, value_norm, source_file, varnumber, 0 AS origin FROM kept ANTI JOIN ind USING (varname) UNION ALL
 SELECT UNITID, year, CASE WHEN base IN (SELECT varname FROM kept) THEN base || '_CAT' ELSE base END AS varname, chosen_suffix, chosen_suffix, '', '', 1 FROM choice WHERE n_active = 1""")
def indicator_collapse(spark, d):
    rows, groups = order_indicators(spark, d)
    return wide.collapse(rows, groups, wide.indicator_choice(wide.active_indicators(rows, groups)))


_EXPECTED = S.listed("|".join(p) for p in L.EXPECTED_CONFLICTS)


@query(f"""{_ORD} SELECT year, source_file, base, count(*) AS row_count, count(DISTINCT UNITID) AS unit_years, min(n_active) AS min_n_active, max(n_active) AS max_n_active,
 count(DISTINCT suffix) AS distinct_suffixes, CASE WHEN source_file || '|' || base IN {_EXPECTED} THEN 'expected' WHEN count(*) >= 25 THEN 'high' ELSE 'low' END AS signal_level
 FROM active JOIN choice USING (UNITID, year, base) WHERE n_active > 1 GROUP BY year, source_file, base""")
def indicator_conflict_summary(spark, d):
    active = indicator_active(spark, d)
    return wide.indicator_conflicts(active, wide.indicator_choice(active))


@query(f"{_BASE} SELECT year, UNITID, varname, count(*) AS dup_rows FROM kept GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark, d):
    return wide.duplicate_groups(kept_rows(spark, d))


@query(f"{_BASE} SELECT kept.* FROM kept SEMI JOIN (SELECT year, UNITID, varname FROM kept GROUP BY ALL HAVING count(*) > 1) USING (year, UNITID, varname)")
def duplicate_rows(spark, d):
    rows = kept_rows(spark, d)
    return rows.join(wide.duplicate_groups(rows), ["year", "UNITID", "varname"], "left_semi").select(*wide.STAGE)


@query(f"{_FINAL} SELECT * FROM final")
def final_dedupe(spark, d):
    return final_rows(spark, d)


_NUMVARS = f"""numeric_vars AS (SELECT varname FROM (SELECT {S.varname("varname")} AS varname, unnest([lower(trim(coalesce("DataType", ''))), lower(trim(coalesce(format, '')))]) AS k FROM dictionary_lake)
 WHERE varname <> '' GROUP BY varname HAVING bool_or(k IN {S.listed(T.NUMERIC_MARKERS)}) AND NOT bool_or(k IN {S.listed(wide.STRING_FORMATS)}))"""


_CELL = f"CASE WHEN varname IN (SELECT varname FROM numeric_vars) THEN {_double('value_norm')} END AS num, CASE WHEN varname NOT IN (SELECT varname FROM numeric_vars) THEN value_norm END AS text"


def all_targets(spark, d, final: DataFrame) -> tuple[list[str], set[str]]:
    """All variables of the final rows, and the numeric ones: metadata."""
    names = wide.order_targets([r.varname for r in final.where("value_norm is not null").select("varname").distinct().collect()])
    return names, {r.varname for r in wide.numeric_variables(table(spark, d, "dictionary_lake")).collect()}


def pivot_all(spark, d) -> DataFrame:
    final = materialise(final_rows(spark, d), "final")
    return wide.pivot_blocks(final, wide.spine(staged(spark, d)), *all_targets(spark, d, final))


def melted(panel: DataFrame) -> DataFrame:
    """(year, UNITID, varname, num, text): the cells of a wide panel that hold something."""
    return eav.melted(panel).select("year", "UNITID", "varname", "num", "text")


@query(f"SELECT * FROM ({_FINAL}, {_NUMVARS} SELECT year, UNITID, varname, {_CELL} FROM final) WHERE num IS NOT NULL OR text IS NOT NULL")
def pivot_typed(spark, d):
    return melted(pivot_all(spark, d))


@query(f"""{_DISC}, {_NUMVARS},
 made AS (SELECT UNITID, year, CASE WHEN base IN (SELECT varname FROM kept) THEN base || '_CAT' ELSE base END AS varname, chosen_suffix AS value, chosen_suffix AS value_norm, '' AS source_file, '' AS varnumber, 1 AS origin FROM choice WHERE n_active = 1),
 together AS (SELECT UNITID, year, varname, value, value_norm, source_file, varnumber, 0 AS origin FROM kept ANTI JOIN ind USING (varname) UNION ALL SELECT * FROM made),
 fin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY year, UNITID, varname ORDER BY origin, source_file, varnumber, coalesce(value_norm, ''), coalesce(value, '')) AS rn FROM together) WHERE rn = 1),
 cells AS (SELECT year, UNITID, varname, {_CELL} FROM fin) SELECT * FROM cells WHERE num IS NOT NULL OR text IS NOT NULL""")
def build_wide(spark, d):
    """The whole build over the whole panel, its wide result melted back."""
    o = WideOptions(dim_sources=DIM_SOURCES, dim_prefixes=DIM_PREFIXES, scalar_conflict_gate=False)
    return melted(build(table(spark, d, "panel_long"), lake(spark, d), o).wide)


@query(f"WITH {_NUMVARS} SELECT * FROM numeric_vars")
def numeric_targets(spark, d):
    return wide.numeric_variables(table(spark, d, "dictionary_lake"))


@query(f"""{_FINAL}, {_NUMVARS}, g AS (SELECT year, numeric_vars.varname FROM (SELECT DISTINCT year FROM final), numeric_vars),
 c AS (SELECT year, varname, count(value_norm) AS n, count({_double("value_norm")}) AS p FROM final GROUP BY ALL)
 SELECT year, varname AS "column", coalesce(n, 0) AS non_empty_tokens, coalesce(p, 0) AS parsed_numeric_tokens, coalesce(n, 0) - coalesce(p, 0) AS failed_parse_tokens FROM g LEFT JOIN c USING (year, varname)""")
def cast_report(spark, d):
    return wide.cast_report(materialise(final_rows(spark, d), "final"), wide.numeric_variables(table(spark, d, "dictionary_lake")))


@query(f"""{_FINAL} SELECT year, n_rows, coalesce(n_vars, 0) AS n_vars, coalesce(ne, 0) AS non_empty_values, CAST(coalesce(dup, 0) AS BIGINT) AS dup_rows, round(coalesce(ne, 0) / (n_rows * (SELECT count(DISTINCT varname) FROM final WHERE value_norm IS NOT NULL)), 9) AS fill_rate
 FROM (SELECT year, count(*) AS n_rows FROM (SELECT DISTINCT year, UNITID FROM stage) GROUP BY year)
 LEFT JOIN (SELECT year, count(DISTINCT varname) AS n_vars, count(value_norm) AS ne FROM final GROUP BY year) USING (year)
 LEFT JOIN (SELECT year, sum(n) AS dup FROM (SELECT year, count(*) AS n FROM kept GROUP BY year, UNITID, varname HAVING count(*) > 1) GROUP BY year) USING (year)""")
def year_qc_summary(spark, d):
    kept = materialise(kept_rows(spark, d), "kept")
    final = materialise(wide.final_rows(kept), "final")
    return wide.year_summary(final, wide.spine(staged(spark, d)), len(all_targets(spark, d, final)[0]), wide.duplicate_groups(kept))


@query(f"""{_FINAL}, {_NUMVARS}, cells AS (SELECT varname, value_norm, {_CELL} FROM final)
 SELECT varname AS "column", count(num) + count(text) AS non_null FROM cells GROUP BY varname HAVING count(value_norm) > 0""")
def null_scan(spark, d):
    return wide.empty_columns(pivot_all(spark, d))


@query(f"""{_DISC}, f AS (SELECT varname, source_file, varnumber, count(*) AS a, count(value_norm) AS b FROM stage GROUP BY ALL)
 SELECT coalesce(base, varname) AS output_column, max(CASE WHEN base IS NULL THEN 'direct_scalar' ELSE 'disc_collapsed' END) AS lineage_kind,
 array_to_string(list_sort(list(DISTINCT varname)), '|') AS source_varnames, coalesce(array_to_string(list_sort(list(DISTINCT source_file) FILTER (source_file <> '')), '|'), '') AS source_files,
 count(DISTINCT source_file) FILTER (source_file <> '') AS source_file_count, coalesce(array_to_string(list_sort(list(DISTINCT varnumber) FILTER (varnumber <> '')), '|'), '') AS source_varnumbers,
 CAST(sum(a) AS BIGINT) AS source_rows, CAST(sum(b) AS BIGINT) AS source_non_empty_rows,
 CASE WHEN count(DISTINCT source_file) FILTER (source_file <> '') = 1 THEN max(source_file) ELSE '' END AS primary_source_file, count(DISTINCT source_file) FILTER (source_file <> '') > 1 AS lineage_ambiguous
 FROM f LEFT JOIN ind USING (varname) GROUP BY coalesce(base, varname)""")
def column_lineage(spark, d):
    return wide.column_lineage(wide.discover(staged(spark, d)), wide.indicator_map(lake(spark, d)))


@query(f"""{_DISC}, a AS (SELECT varname, count(*) AS r, count(value_norm) AS n FROM stage GROUP BY varname), b AS (SELECT varname, count(*) AS r, count(value_norm) AS n FROM (SELECT DISTINCT * FROM stage WHERE NOT {_DIM}) GROUP BY varname)
 SELECT varname, a.r AS stage_rows, a.n AS stage_non_empty_rows, coalesce(b.r, 0) AS scalar_rows, coalesce(b.n, 0) AS scalar_non_empty_rows, coalesce(base, '') AS disc_group_base,
 coalesce(suffix, '') AS disc_group_suffix, varname IN ('TOWN') AS excluded_by_user, coalesce(b.r, 0) > 0 AND coalesce(b.n, 0) = 0 AS dropped_as_globally_empty,
 regexp_matches(varname, '^(PRG|OPENYR)($|[_0-9])') AS anti_garbage_hit,
 coalesce(b.n, 0) > 0 AND varname NOT IN ('TOWN') AND NOT regexp_matches(varname, '^(PRG|OPENYR)($|[_0-9])') AND base IS NULL AS final_in_all_targets
 FROM a LEFT JOIN b USING (varname) LEFT JOIN ind USING (varname)""")
def target_lineage(spark, d):
    rows = staged(spark, d)
    return wide.target_lineage(rows, wide.lanes(rows, DIM_SOURCES, DIM_PREFIXES)[0], wide.indicator_map(lake(spark, d)), ("TOWN",), ("PRG", "OPENYR"))


# --- long form


@query("""SELECT o_custkey AS "UNITID", o_orderkey AS "_rowid", u.varname, u.value, CASE u.varname WHEN 'O_TOTALPRICE' THEN o_orderstatus END AS imputation_value
 FROM orders, unnest([{'varname': 'O_ORDERPRIORITY', 'value': o_orderpriority}, {'varname': 'O_TOTALPRICE', 'value': CAST(o_orderstatus AS VARCHAR) || '!'}]) AS t(u)""")
def melt(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("UNITID"), F.col("o_orderkey").alias("_rowid"), "o_orderpriority", F.concat("o_orderstatus", F.lit("!")).alias("o_totalprice"), "o_orderstatus")
    return longform.melt(rows, ["UNITID", "_rowid"], ["o_orderpriority", "o_totalprice"], {"o_totalprice": "o_orderstatus"})


@query(f"""WITH {_LAKE}, k AS (SELECT year, source_file, varname, varnumber, max("varTitle") AS title FROM lake GROUP BY ALL)
 SELECT p.row_id, p.year, {S.source_file("p.source_file")} AS source_file, {S.varname("p.varname")} AS varname, coalesce({S.varnumber("p.varnumber")}, '') AS varnumber, k.title
 FROM panel_long p LEFT JOIN k ON k.year = p.year AND k.source_file = {S.source_file("p.source_file")} AND k.varname = {S.varname("p.varname")} AND k.varnumber = coalesce({S.varnumber("p.varnumber")}, '')""")
def dictionary_join(spark, d):
    rows = longform.source_key(table(spark, d, "panel_long")).select("row_id", "year", "source_file", "varname", "varnumber")
    key = ["year", "source_file", "varname", "varnumber"]
    side = lake(spark, d).groupBy(*key).agg(F.max("varTitle").alias("title"))
    return longform.join_dictionary(rows, side, key, ["title"]).select("row_id", *key, "title")


_REST = ["varTitle", "longDescription", "DataType", "format", "Fieldwidth", "imputationvar"]


@query(f"""SELECT * EXCLUDE (rn) FROM (SELECT {', '.join(f'"{c}"' for c in longform.PANEL_COLUMNS)}, row_number() OVER (PARTITION BY UNITID, year, varnumber, source_file ORDER BY access_table_name NULLS LAST, varname NULLS LAST,
 value NULLS LAST, imputation_value NULLS LAST, {', '.join(f'"{c}" NULLS LAST' for c in _REST)}) AS rn FROM panel_long) WHERE rn = 1""")
def long_dedupe(spark, d):
    return longform.dedupe(table(spark, d, "panel_long").select(*longform.PANEL_COLUMNS))


@query("""SELECT unnest(['year', 'UNITID', 'varnumber', 'source_file']) AS key, unnest([count(*) FILTER (year IS NULL), count(*) FILTER (UNITID IS NULL),
 count(*) FILTER (coalesce(trim(varnumber, ' '), '') = ''), count(*) FILTER (coalesce(trim(source_file, ' '), '') = '')]) AS n_missing FROM panel_long""")
def key_null_counts(spark, d):
    return longform.key_nulls(table(spark, d, "panel_long"))


@query("""SELECT year, access_table_name, count(*) AS n_rows, count(*) FILTER (UNITID IS NULL) AS n_missing FROM panel_long GROUP BY ALL""")
def missing_unit_counts(spark, d):
    return longform.missing_units(table(spark, d, "panel_long"))


_TEXTS = ["varTitle", "longDescription", "DataType", "format", "Fieldwidth", "imputationvar", "imputation_value"]


@query(f"""SELECT row_id, {', '.join(f'"{c}"' for c in longform.PANEL_COLUMNS)} FROM panel_long WHERE NOT ({' AND '.join(f"""coalesce(trim("{c}", ' '), '') = ''""" for c in _TEXTS)})""")
def blank_row_filter(spark, d):
    rows = table(spark, d, "panel_long").select("row_id", *longform.PANEL_COLUMNS)
    return longform.nonblank(rows, _TEXTS)


@query(f"""WITH {_LAKE}, t AS (SELECT year, {S.source_file("source_file")} AS s, upper({S.strip("access_table_name")}) AS a, count(*) AS n FROM panel_long GROUP BY ALL),
 c AS (SELECT t.*, (SELECT count(*) FROM lake WHERE lake.year = t.year AND lake.source_file = t.s) AS bs, (SELECT count(*) FROM lake WHERE lake.year = t.year AND upper(trim(lake.access_table_name)) = t.a) AS ba FROM t)
 SELECT year, s AS source_file, a AS access_table_name, n AS n_rows, CASE WHEN n = 0 THEN 'source_table_has_zero_rows' WHEN bs > 0 AND ba > 0 THEN 'dictionary_rows_found_no_column_overlap'
  WHEN ba > 0 THEN 'dictionary_rows_found_for_access_table_but_source_selection_failed' WHEN bs > 0 THEN 'dictionary_rows_found_for_source_file_but_access_table_missing'
  ELSE 'missing_dictionary_rows_for_source_file' END AS reason FROM c""")
def exclusion_reasons(spark, d):
    t = table(spark, d, "panel_long").groupBy("year", T.source_file(F.col("source_file")).alias("source_file"), F.upper(T.strip(F.col("access_table_name"))).alias("access_table_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    k = lake(spark, d)
    by_source = k.groupBy("year", "source_file").agg(F.count(F.lit(1)).alias("bs"))
    by_table = k.groupBy("year", F.upper(F.trim("access_table_name")).alias("access_table_name")).agg(F.count(F.lit(1)).alias("ba"))
    rows = t.join(by_source, ["year", "source_file"], "left").join(by_table, ["year", "access_table_name"], "left").fillna(0, ["bs", "ba"])
    reason = longform.exclusion_reason(F.col("n_rows"), F.least("bs", "ba"), F.col("ba"), F.col("bs"))
    return rows.select("year", "source_file", "access_table_name", "n_rows", reason.alias("reason"))


@query("SELECT row_id, year, UNITID, source_file FROM panel_long")
def stitch_union(spark, d):
    panel = table(spark, d, "panel_long").select("row_id", "year", "UNITID", "source_file")
    return longform.stitch([panel.where("year <= 2015"), panel.where("year > 2015")])


# --- dictionary


@query(f"WITH {_LAKE} SELECT * FROM lake")
def dictionary_lake_normalised(spark, d):
    return lake(spark, d)


@query(f"""WITH {_LAKE}, t AS (SELECT row_number() OVER (ORDER BY year, source_file, varnumber, varname) AS o, lower(trim(regexp_replace(upper(trim(access_table_name)), '[^A-Z0-9]+', '_', 'g'), '_')) AS tk, varnumber, varname, "longDescription" AS x FROM lake),
 g AS (SELECT * FROM t WHERE trim(x) <> ''),
 r AS (SELECT year, source_file, varnumber, varname, lower(trim(regexp_replace(upper(trim(access_table_name)), '[^A-Z0-9]+', '_', 'g'), '_')) AS tk FROM lake)
 SELECT year, source_file, varnumber, varname, coalesce((SELECT arg_min(x, o) FROM g WHERE g.tk = r.tk AND g.varnumber = r.varnumber AND g.varnumber <> ''), (SELECT arg_min(x, o) FROM g WHERE g.tk = r.tk AND g.varname = r.varname AND g.varname <> ''),
  (SELECT arg_min(x, o) FROM g WHERE g.varnumber = r.varnumber AND g.varnumber <> ''), (SELECT arg_min(x, o) FROM g WHERE g.varname = r.varname AND g.varname <> ''), '') AS described FROM r""")
def description_cascade(spark, d):
    k = lake(spark, d).withColumn("table_key", T.text_key(F.col("access_table_name")))
    texts = k.withColumn("ordinal", F.struct("year", "source_file", "varnumber", "varname")).select("ordinal", "table_key", "varnumber", "varname", F.col("longDescription").alias("description"))
    return dictionary.describe(k.select("year", "source_file", "varnumber", "varname", "table_key"), texts).select("year", "source_file", "varnumber", "varname", "described")


@query(f"""WITH {_LAKE}, t AS (SELECT DISTINCT year, upper({S.strip("source_file")}) AS s, upper({S.strip("access_table_name")}) AS a FROM panel_long)
 SELECT DISTINCT t.year, s AS want_source, a AS want_table, varname, varnumber FROM t JOIN lake ON lake.year = t.year AND ((upper(lake.source_file) = s AND s <> '') OR (upper(lake.access_table_name) = a AND a <> ''))""")
def disjunctive_match(spark, d):
    t = table(spark, d, "panel_long").select("year", F.upper(T.strip(F.col("source_file"))).alias("source_file"), F.upper(T.strip(F.col("access_table_name"))).alias("access_table_name")).distinct()
    return dictionary.match_tables(t, lake(spark, d))


@query(f"""WITH {_LAKE}, h AS (SELECT DISTINCT source_file, year FROM lake WHERE source_file <> ''), y AS (SELECT unnest(range(2008, 2027)) AS year),
 w AS (SELECT s.source_file, y.year FROM (SELECT DISTINCT source_file FROM h) s, y ANTI JOIN h USING (source_file, year))
 SELECT w.source_file, CAST(w.year AS INTEGER) AS year, arg_min(h.year, abs(h.year - w.year) * 10000 + h.year) AS donor_year FROM w JOIN h ON h.source_file = w.source_file GROUP BY ALL""".replace("FROM (SELECT DISTINCT source_file FROM h) s, y ANTI JOIN h USING (source_file, year)", "FROM (SELECT DISTINCT source_file FROM h) s CROSS JOIN y WHERE NOT EXISTS (FROM h WHERE h.source_file = s.source_file AND h.year = y.year)"))
def nearest_year_donor(spark, d):
    return dictionary.nearest_donors(lake(spark, d), list(range(2008, 2027)))


@query(f"""WITH {_LAKE}, f AS (SELECT year, source_file, upper(trim(imputationvar)) AS imputationvar, min(varnumber) AS anchor FROM lake WHERE coalesce(trim(imputationvar), '') <> '' GROUP BY ALL)
 SELECT f.* FROM f ANTI JOIN (SELECT year, source_file, varname AS imputationvar FROM lake) USING (year, source_file, imputationvar)""")
def imputation_flags_without_row(spark, d):
    return dictionary.surrogate_starts(lake(spark, d)).drop("start")


@query()
def imputation_surrogates(spark, d):
    k = lake(spark, d)
    return dictionary.surrogate_rows(spark, dictionary.surrogate_starts(k), k)


@query(f"""WITH {_LAKE} SELECT year, 'UNITID' AS varname, '00000001' AS varnumber, 'KEYS' AS source_file, year || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') AS academic_year_label FROM (SELECT DISTINCT year FROM lake)""")
def unit_metadata_rows(spark, d):
    return dictionary.unit_rows(lake(spark, d))


_AMB = f"""WITH {_LAKE}, c AS (SELECT DISTINCT year, source_file, upper({S.strip("access_table_name")}) AS access_table_name, varname, varnumber, coalesce(metadata_source, '') AS ms, coalesce(metadata_table_name, '') AS mt FROM lake),
 amb AS (SELECT year, source_file, access_table_name, varname, count(*) AS n_candidates, array_to_string(list_sort(list(varnumber || '|' || ms || '|' || mt)), ';') AS candidates FROM c GROUP BY ALL HAVING count(*) > 1),
 o AS (SELECT override_id, coalesce({S.null_if_token("year")}, '') AS oy, {S.source_file(S.null_if_token("source_file"))} AS os, upper(coalesce({S.null_if_token("access_table_name")}, '')) AS oa, {S.varname("varname")} AS ov,
  coalesce({S.varnumber("selected_varnumber")}, '') AS o_varnumber, coalesce({S.null_if_token("selected_metadata_source")}, '') AS o_metadata, coalesce({S.null_if_token("selected_metadata_table_name")}, '') AS o_metadata_table FROM dictionary_ambiguity_overrides),
 m AS (SELECT amb.year, source_file, access_table_name, varname, override_id, o_varnumber, o_metadata, o_metadata_table FROM amb JOIN o ON ov = varname AND (oy = '' OR try_cast(oy AS INTEGER) = amb.year) AND os IN ('', source_file) AND oa IN ('', access_table_name))"""


@query(f"{_AMB} SELECT * FROM amb")
def ambiguity_report(spark, d):
    return dictionary.ambiguities(lake(spark, d))


@query(f"{_AMB} SELECT * FROM m")
def override_match(spark, d):
    return dictionary.match_overrides(dictionary.ambiguities(lake(spark, d)), table(spark, d, "dictionary_ambiguity_overrides"))


@query(f"""{_AMB}, l AS (SELECT year, source_file, access_table_name, varname, count(DISTINCT override_id) AS n_overrides, count(*) FILTER (o_varnumber IN ('', c.varnumber) AND o_metadata IN ('', ms) AND o_metadata_table IN ('', mt)) AS n_selected
  FROM m JOIN c USING (year, source_file, access_table_name, varname) GROUP BY ALL)
 SELECT year, source_file, access_table_name, varname, n_candidates, coalesce(n_overrides, 0) AS n_overrides, coalesce(n_selected, 0) AS n_selected, coalesce(n_overrides = 1 AND n_selected = 1, false) AS settled FROM amb LEFT JOIN l USING (year, source_file, access_table_name, varname)""")
def ambiguity_settled(spark, d):
    return dictionary.settle(lake(spark, d), table(spark, d, "dictionary_ambiguity_overrides"))


_BEST = "list({x} ORDER BY -length({x}), {x}) FILTER (lower({x}) NOT IN ('', 'nan', 'none', '<na>', 'nat'))[1]"


def _best(x: str) -> str:
    return _BEST.format(x=f"trim({x})")


@query(f"""WITH {_LAKE}, t AS (SELECT varname, {_best('"varTitle"')} AS title, {_best('"longDescription"')} AS description, count(*) AS n_rows FROM lake GROUP BY varname),
 s AS (SELECT varname, source_file, count(*) AS n FROM lake WHERE source_file <> '' GROUP BY ALL)
 SELECT t.*, list(source_file ORDER BY -n, source_file)[1] AS primary_source, count(source_file) AS source_count FROM t LEFT JOIN s USING (varname) GROUP BY ALL""")
def dictionary_summaries(spark, d):
    return dictionary.summaries(lake(spark, d))


@query(f"""WITH {_LAKE}, c AS (SELECT varname, trim("DataType") AS v, count(*) AS n FROM lake WHERE lower(trim("DataType")) NOT IN ('', 'nan', 'none', '<na>', 'nat') GROUP BY ALL)
 SELECT varname, list(v ORDER BY -n, v)[1] AS mode FROM c GROUP BY varname""")
def best_modes(spark, d):
    return dictionary.best_modes(lake(spark, d), "DataType")


_RAW = f"WITH raw AS (SELECT * REPLACE ({S.varname('varname')} AS varname, coalesce({S.varnumber('varnumber')}, '') AS varnumber, {S.source_file('source_file')} AS source_file) FROM dictionary_lake)"


def raw_lake(spark, d) -> DataFrame:
    return longform.source_key(table(spark, d, "dictionary_lake"))


@query(f"{_RAW} SELECT year, source_file, varnumber, varname, count(*) AS n_rows FROM raw GROUP BY ALL HAVING count(*) > 1")
def dictionary_duplicates(spark, d):
    return dictionary.audit_duplicates(raw_lake(spark, d))


@query(f"{_RAW} SELECT year, varnumber, varname, count(DISTINCT source_file) AS n_values, array_to_string(list_sort(list(DISTINCT source_file)), '|') AS found FROM raw WHERE varnumber <> '' GROUP BY year, varnumber, varname HAVING count(DISTINCT source_file) > 1")
def dictionary_source_conflicts(spark, d):
    return dictionary.audit_sources(raw_lake(spark, d))


@query(f"{_RAW} SELECT year, source_file, varnumber, count(DISTINCT varname) AS n_values, array_to_string(list_sort(list(DISTINCT varname)), '|') AS found FROM raw WHERE varnumber <> '' GROUP BY year, source_file, varnumber HAVING count(DISTINCT varname) > 1")
def dictionary_collisions(spark, d):
    return dictionary.audit_collisions(raw_lake(spark, d))


@query(f"""{_RAW} SELECT year, source_file, count(*) AS n_rows, count(*) FILTER (coalesce(trim("longDescription"), '') = '') AS n_missing, round(count(*) FILTER (coalesce(trim("longDescription"), '') = '') / count(*), 9) AS missing_rate FROM raw GROUP BY year, source_file""")
def dictionary_missing_descriptions(spark, d):
    return dictionary.audit_descriptions(raw_lake(spark, d))


_CATEGORY = f"""CASE WHEN source_file = '' THEN 'needs_review' WHEN source_file IN {S.listed(L.CANONICAL_SOURCES)} THEN 'canonical' WHEN source_file IN {S.listed(L.AUXILIARY_SOURCES)} THEN 'auxiliary_expected'
 WHEN source_file IN {S.listed(L.DERIVED_SOURCES)} OR starts_with(source_file, 'CUSTOM') THEN 'derived_or_custom' ELSE 'needs_review' END"""


@query(f"{_RAW} SELECT source_file, count(*) AS n_rows, array_to_string(list_sort(list(DISTINCT year)), ',') AS years, {_CATEGORY} AS category FROM raw GROUP BY source_file")
def dictionary_years(spark, d):
    return dictionary.audit_years(raw_lake(spark, d))


@query(f"{_RAW} SELECT {_CATEGORY} AS category, count(*) AS n_rows, count(DISTINCT source_file) AS n_sources FROM raw GROUP BY ALL")
def dictionary_categories(spark, d):
    return dictionary.audit_categories(raw_lake(spark, d))


@query(f"""{_RAW} SELECT count(*) AS n_rows, count(DISTINCT year) AS n_years, count(DISTINCT source_file) AS n_sources, count(DISTINCT varname) AS n_variables, count(*) FILTER (varnumber = '') AS n_without_number,
 count(*) FILTER (coalesce(trim("longDescription"), '') = '') AS n_without_description, count(*) FILTER (coalesce(imputationvar, '') <> '') AS n_with_imputation,
 (SELECT count(*) FROM (SELECT 1 FROM raw GROUP BY year, source_file, varnumber, varname HAVING count(*) > 1)) AS n_duplicate_keys,
 (SELECT count(*) FROM (SELECT 1 FROM raw WHERE varnumber <> '' GROUP BY year, varnumber, varname HAVING count(DISTINCT source_file) > 1)) AS n_source_conflicts,
 (SELECT count(*) FROM (SELECT 1 FROM raw WHERE varnumber <> '' GROUP BY year, source_file, varnumber HAVING count(DISTINCT varname) > 1)) AS n_collisions,
 (SELECT count(*) FROM (SELECT 1 FROM raw GROUP BY year, source_file, upper(trim(access_table_name)), varname HAVING count(DISTINCT varnumber || '|' || coalesce(metadata_source, '') || '|' || coalesce(metadata_table_name, '')) > 1)) AS n_ambiguous FROM raw""")
def dictionary_audit(spark, d):
    return dictionary.audit_summary(raw_lake(spark, d))


# --- names, labels and numbers


@query(f"""SELECT DISTINCT source_file AS raw, {S.source_file("source_file")} AS canonical, {S.token("source_file")} AS token, lower({S.token("source_file")}) AS text_key, varnumber AS raw_number, {S.varnumber("varnumber")} AS varnumber FROM panel_long""")
def normalisers(spark, d):
    c, n = F.col("source_file"), F.col("varnumber")
    return table(spark, d, "panel_long").select(c.alias("raw"), T.source_file(c).alias("canonical"), T.token(c).alias("token"), T.text_key(c).alias("text_key"), n.alias("raw_number"), T.varnumber(n).alias("varnumber")).distinct()


@query(f"""SELECT DISTINCT source_file_label AS raw, trim(regexp_replace(regexp_replace(regexp_replace(coalesce('File documentation for ' || source_file_label || ' ' || academic_year_label, ''), '(?i)\\bfile documentation for (the )?\\b', '', 'g'), '\\b20[0-9]{{2}}\\s*[-/]\\s*[0-9]{{2}}\\b', '', 'g'), '\\s+', ' ', 'g'), ' ,') AS label,
 academic_year_label, CAST(regexp_extract(academic_year_label, '^\\s*([0-9]{{4}})\\s*[-/]\\s*[0-9]{{2,4}}\\s*$', 1) AS INTEGER) AS start_year, year || '-' || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') AS from_year FROM dictionary_lake""")
def source_labels(spark, d):
    text = F.concat(F.lit("File documentation for "), "source_file_label", F.lit(" "), "academic_year_label")
    return table(spark, d, "dictionary_lake").select(
        F.col("source_file_label").alias("raw"), L.clean_label(text).alias("label"), "academic_year_label", L.academic_start(F.col("academic_year_label")).alias("start_year"), L.academic_label(F.col("year")).alias("from_year")
    ).distinct()


@query(f"SELECT row_id, {S.read_number('value')} AS number, {_double(S.null_if_token('value'))} AS plain, {S.declared_numeric('\"DataType\"')} AS declared FROM panel_long")
def read_numbers(spark, d):
    v = F.col("value")
    return table(spark, d, "panel_long").select("row_id", T.read_number(v).alias("number"), T.read_plain_double(T.null_if_token(v)).alias("plain"), T.declared_numeric(F.col("DataType")).alias("declared"))


@query(f"""SELECT DISTINCT {S.varname("varname")} AS varname, regexp_extract({S.varname("varname")}, '^(.*?)([0-9]+)$', 1) AS base, regexp_extract({S.varname("varname")}, '^(.*?)([0-9]+)$', 2) AS suffix,
 regexp_matches({S.varname("varname")}, '^(PRG|COMP)($|[_0-9])') AS blocked FROM panel_long""")
def indicator_names(spark, d):
    rows = table(spark, d, "panel_long").select(T.varname(F.col("varname")).alias("varname")).distinct()
    base, suffix = L.split_indicator(F.col("varname"))
    return rows.select("varname", base.alias("base"), suffix.alias("suffix"), L.identifier_like(F.col("varname"), ("PRG", "COMP")).alias("blocked"))


_TEXT = """lower(concat_ws(' ', coalesce("varTitle", ''), coalesce("longDescription", '')))"""


@query(f"""SELECT DISTINCT varname, "varTitle", concat_ws('|', CASE WHEN regexp_matches({_TEXT}, 'depreciation|interest|maintenance') THEN 'accounting_standard_sensitive' END,
 CASE WHEN regexp_matches({_TEXT}, 'asset|liabilit') THEN 'balance_sheet_parent_child_sensitive' END) AS flags FROM dictionary_lake""")
def comparability_flags(spark, d):
    return table(spark, d, "dictionary_lake").select("varname", "varTitle", L.comparability(F.col("varTitle"), F.col("longDescription")).alias("flags")).distinct()


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k') IN ('1', 'true', 'yes', 'y') AS flag FROM events""")
def json_extract(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", k.alias("k"), L.boolish(k).alias("flag"))


# --- the release copy as a wide panel


def release_panel(spark, d, name: str = "release_baseline", value: str = "baseline", path: str | None = None) -> DataFrame:
    rows = table(spark, d, name)
    if path:
        rows = rows.where(T.path_key(F.col("relative_path")).contains(path))
    cells = rows.select("UNITID", "year", T.varname(F.col("field")).alias("field"), T.null_if_token(F.col(value)).alias("v"))
    return cells.groupBy("UNITID", "year").pivot("field", FIELDS).agg(F.max("v"))


def _panel(name: str = "panel", source: str = "release_baseline", value: str = "baseline") -> str:
    cells = ", ".join(f"max(v) FILTER (field = '{f}') AS \"{f}\"" for f in FIELDS)
    return f"""{name} AS (SELECT UNITID, year, {cells} FROM (SELECT UNITID, year, {S.varname("field")} AS field, {S.null_if_token(f'"{value}"')} AS v FROM {source}) GROUP BY UNITID, year)"""


_CODE = "CAST(trunc(" + _double("PRCH_F") + ") AS INTEGER)"
_CHILD = f"coalesce({_CODE} IN (2, 3, 4, 5), false)"
_CLEAN = f"""WITH {_panel()}, clean AS (SELECT UNITID, year, INSTNM, CONTROL, SECTOR, CASE WHEN NOT {_CHILD} THEN ICLEVEL END AS ICLEVEL, OPEID, PRCH_F, CASE WHEN NOT {_CHILD} THEN FINVAL END AS FINVAL FROM panel)"""


def targets() -> dict[str, list[str]]:
    return clean.flag_targets(["PRCH_F"], LINEAGE)


@query(f"{_CLEAN} SELECT * FROM clean")
def conditional_nulling(spark, d):
    return clean.blank_children(release_panel(spark, d), targets())


@query(f"""{_CLEAN}, b AS (SELECT year, CASE WHEN PRCH_F IS NULL THEN 'missing' WHEN {_CODE} IN (2, 3, 4, 5) THEN 'child_apply' WHEN {_CODE} = 6 THEN 'review_only' ELSE 'other' END AS bucket FROM panel)
 SELECT y.year, 'PRCH_F' AS flag, k.bucket, count(b.bucket) AS n_rows FROM (SELECT DISTINCT year FROM panel) y CROSS JOIN (SELECT unnest(['child_apply', 'review_only', 'other', 'missing']) AS bucket) k
 LEFT JOIN b ON b.year = y.year AND b.bucket = k.bucket GROUP BY ALL""")
def flag_code_grid(spark, d):
    return clean.code_counts(release_panel(spark, d), ["PRCH_F"])


@query(f"{_CLEAN} SELECT 'PRCH_F' AS flag, {_CODE} AS code, count(*) AS n_rows, count(ICLEVEL) + count(FINVAL) AS target_nonnull FROM panel WHERE {_CODE} IS NOT NULL GROUP BY ALL")
def flag_code_stats(spark, d):
    return clean.code_stats(release_panel(spark, d), "PRCH_F", targets()["PRCH_F"])


@query(f"""{_CLEAN}, r AS (SELECT count(*) FILTER ({_CHILD}) AS a, count(*) FILTER ({_CODE} = 6) AS b, coalesce(sum((ICLEVEL IS NOT NULL)::INT + (FINVAL IS NOT NULL)::INT) FILTER ({_CHILD}), 0) AS c FROM panel),
 s AS (SELECT count(*) FILTER ({_CHILD}) AS a, coalesce(sum((ICLEVEL IS NOT NULL)::INT + (FINVAL IS NOT NULL)::INT) FILTER ({_CHILD}), 0) AS c FROM clean)
 SELECT 'PRCH_F' AS flag, CAST(2 AS BIGINT) AS target_columns, r.a AS child_rows_raw, s.a AS child_rows_clean, r.b AS review_rows_raw, CAST(r.c AS BIGINT) AS raw_target_nonnull, CAST(s.c AS BIGINT) AS clean_target_nonnull,
 CASE WHEN r.a > 0 AND s.c > 0 THEN 'suspicious' WHEN r.a > 0 THEN 'cleaned' WHEN r.b > 0 THEN 'review_only' ELSE 'cleaned' END AS status FROM r, s""")
def flag_coverage(spark, d):
    raw = release_panel(spark, d)
    return clean.flag_coverage(raw, clean.blank_children(raw, targets()), targets())


@query(f"WITH {_panel()} SELECT year, UNITID, OPEID, FINVAL FROM panel WHERE year BETWEEN 2012 AND 2016")
def custom_extract(spark, d):
    return clean.custom_extract(release_panel(spark, d), clean.parse_columns("opeid, FinVal # money\nUNITID, OPEID"), (2012, 2016))


# --- structure of the panel

_UNITS = f"""WITH {_panel()}, w AS (SELECT min(year) AS s, max(year) AS e FROM panel),
 n AS (SELECT UNITID, INSTNM AS v, count(*) AS n FROM panel WHERE INSTNM IS NOT NULL GROUP BY ALL), nm AS (SELECT UNITID, list(v ORDER BY -n, v)[1] AS nm FROM n GROUP BY UNITID),
 u AS (SELECT UNITID, list_sort(list(DISTINCT year)) AS years, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS k, count(DISTINCT OPEID) AS opeid_count, max(OPEID) AS id FROM panel GROUP BY UNITID),
 pat AS (SELECT UNITID, array_to_string(years, '|') AS years_present_list, first_year, last_year, CAST(k AS INTEGER) AS observed_years, CAST(last_year - first_year + 1 - k AS INTEGER) AS missing_internal_years,
  first_year > s AS entered_after_start, last_year < e AS exited_before_end, k < last_year - first_year + 1 AS intermittent_gap, last_year < e OR k < last_year - first_year + 1 AS possible_selection_risk,
  CASE WHEN k < last_year - first_year + 1 THEN 'intermittent_gap' WHEN first_year > s AND last_year < e THEN 'entered_and_exited' WHEN first_year > s THEN 'entered_after_start' WHEN last_year < e THEN 'exited_before_end' ELSE 'always_present' END AS pattern,
  opeid_count, CASE WHEN opeid_count = 1 THEN id ELSE '' END AS stable_opeid, opeid_count > 1 AS possible_identifier_linkage_case, coalesce(nm, '') AS instnm_example FROM u CROSS JOIN w LEFT JOIN nm USING (UNITID))"""


@query(f"{_UNITS} SELECT * FROM pat")
def presence_patterns(spark, d):
    return structure.unit_patterns(release_panel(spark, d))


@query(f"""{_UNITS} SELECT * FROM (SELECT 'year_start' AS metric, CAST(min(year) AS BIGINT) AS value FROM panel UNION ALL SELECT 'year_end', max(year) FROM panel UNION ALL SELECT 'years_total', count(DISTINCT year) FROM panel
 UNION ALL SELECT 'institution_year_rows', count(*) FROM panel UNION ALL SELECT 'distinct_unitids', count(DISTINCT UNITID) FROM panel
 UNION ALL SELECT 'always_present_unitids', count(*) FROM pat WHERE pattern = 'always_present' UNION ALL SELECT 'entered_after_start_unitids', count(*) FROM pat WHERE entered_after_start
 UNION ALL SELECT 'exited_before_end_unitids', count(*) FROM pat WHERE exited_before_end UNION ALL SELECT 'entered_and_exited_unitids', count(*) FROM pat WHERE pattern = 'entered_and_exited'
 UNION ALL SELECT 'intermittent_gap_unitids', count(*) FROM pat WHERE intermittent_gap UNION ALL SELECT 'possible_selection_risk_unitids', count(*) FROM pat WHERE possible_selection_risk
 UNION ALL SELECT 'possible_identifier_linkage_cases', count(*) FROM pat WHERE possible_identifier_linkage_case)""")
def structure_summary(spark, d):
    panel = release_panel(spark, d)
    return structure.structure_summary(panel, structure.unit_patterns(panel))


@query(f"""{_UNITS}, y AS (SELECT p.year, count(*) AS unitids_present, count(*) FILTER (first_year = p.year) AS entrants, count(*) FILTER (last_year = p.year) AS lst, count(*) FILTER (intermittent_gap) AS intermittent_unitids_present, count(q.UNITID) AS ret
  FROM panel p JOIN pat USING (UNITID) LEFT JOIN panel q ON q.UNITID = p.UNITID AND q.year = p.year + 1 GROUP BY p.year)
 SELECT year, unitids_present, entrants, CASE WHEN year = e THEN 0 ELSE lst END AS exits_after_year, intermittent_unitids_present, CASE WHEN year <> e THEN ret END AS retained_to_next_year, CASE WHEN year <> e THEN round(ret / unitids_present, 9) END AS retention_rate FROM y, w""")
def entry_exit_gap(spark, d):
    panel = release_panel(spark, d)
    return structure.entry_exit(panel, structure.unit_patterns(panel))


@query(f"{_UNITS} SELECT pattern, count(*) AS institution_count FROM pat GROUP BY pattern")
def pattern_counts(spark, d):
    return structure.pattern_counts(structure.unit_patterns(release_panel(spark, d)))


@query(f"""WITH {_panel()}, r AS (SELECT year, UNITID, coalesce(OPEID, '') AS i FROM panel), g AS (SELECT year, i, count(DISTINCT UNITID) AS n FROM r WHERE i <> '' GROUP BY ALL)
 SELECT year, count(DISTINCT UNITID) AS distinct_unitids, count(*) FILTER (i = '') AS rows_missing_opeid, coalesce(any_value(di), 0) AS distinct_opeid, coalesce(any_value(sh), 0) AS shared_opeid_groups, CAST(coalesce(any_value(us), 0) AS BIGINT) AS unitids_in_shared_opeids,
  CAST(NULL AS BIGINT) AS unitids_with_multiple_opeid, CAST(NULL AS BIGINT) AS opeids_with_multiple_unitids
  FROM r LEFT JOIN (SELECT year, count(*) AS di, count(*) FILTER (n > 1) AS sh, sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS us FROM g GROUP BY year) USING (year) GROUP BY year
 UNION ALL SELECT NULL, count(DISTINCT UNITID), count(*) FILTER (i = ''), count(DISTINCT i) FILTER (i <> ''), NULL, NULL, (SELECT count(*) FROM (SELECT 1 FROM r WHERE i <> '' GROUP BY UNITID HAVING count(DISTINCT i) > 1)),
  (SELECT count(*) FROM (SELECT 1 FROM r WHERE i <> '' GROUP BY i HAVING count(DISTINCT UNITID) > 1)) FROM r""")
def identifier_linkage(spark, d):
    return structure.linkage(release_panel(spark, d))


_CLASSES = "c AS (" + " UNION ALL ".join(f"SELECT UNITID, year, '{v}' AS variable, trim({v}) AS value FROM panel WHERE trim({v}) <> ''" for v in ("CONTROL", "SECTOR", "ICLEVEL")) + ")"


@query(f"WITH {_panel()}, {_CLASSES} SELECT variable, year, value, count(DISTINCT UNITID) AS institution_count FROM c GROUP BY ALL")
def classification_frequency(spark, d):
    return structure.class_frequency(release_panel(spark, d))


@query(f"""WITH {_panel()}, {_CLASSES}, u AS (SELECT variable, UNITID, min(value) <> max(value) AS ch FROM c GROUP BY ALL)
 SELECT variable, count(*) AS units_observed, count(*) FILTER (ch) AS units_changed, round(count(*) FILTER (ch) / count(*), 9) AS change_rate FROM u GROUP BY variable""")
def classification_stability(spark, d):
    return structure.class_stability(release_panel(spark, d))


@query(f"""WITH {_panel()}, o AS (SELECT UNITID, list_sort(list(DISTINCT year)) AS ys, min(year) AS a, max(year) AS b, count(DISTINCT year) AS k, coalesce(array_to_string(list_sort(list(DISTINCT OPEID) FILTER (OPEID IS NOT NULL)), '|'), '') AS opeid_values,
  count(DISTINCT OPEID) AS opeid_count, array_to_string(list_sort(list(DISTINCT PRCH_F) FILTER (PRCH_F NOT IN ('0', '1'))), '|') AS f FROM panel GROUP BY UNITID),
 q AS (SELECT UNITID, a AS first_year, b AS last_year, CAST(k AS INTEGER) AS years_observed_count, array_to_string(ys, '|') AS years_observed, b - a + 1 > k AS has_internal_gap, opeid_values, opeid_count, CASE WHEN f <> '' THEN 'PRCH_F:' || f ELSE '' END AS prch_review_values FROM o),
 r AS (SELECT *, concat_ws('|', CASE WHEN opeid_count > 1 THEN 'multi_opeid' END, CASE WHEN prch_review_values <> '' THEN 'parent_child_flag_observed' END, CASE WHEN has_internal_gap THEN 'internal_year_gap' END, CASE WHEN years_observed_count = 1 THEN 'single_year_observation' END) AS join_risk_flags FROM q)
 SELECT *, CASE WHEN join_risk_flags <> '' THEN 'review' ELSE 'standard' END AS join_risk_level FROM r""")
def continuity_crosswalk(spark, d):
    return structure.continuity(release_panel(spark, d), ["PRCH_F"])


@query(f"""WITH {_panel()} SELECT year, 'panel_rows' AS metric, '' AS "column", CAST(count(*) AS DOUBLE) AS actual FROM panel GROUP BY year UNION ALL SELECT year, 'distinct_unitid', '', count(DISTINCT UNITID) FROM panel GROUP BY year
 UNION ALL SELECT year, 'nonnull_count', 'CONTROL', count(CONTROL) FROM panel GROUP BY year UNION ALL SELECT year, 'sum', 'CONTROL', sum({_double("CONTROL")}) FROM panel GROUP BY year UNION ALL SELECT year, 'mean', 'CONTROL', avg({_double("CONTROL")}) FROM panel GROUP BY year""")
def benchmark_metrics(spark, d):
    return structure.benchmark_metrics(release_panel(spark, d), ["CONTROL"])


@query(f"""WITH {_panel()} SELECT year, 'distinct_unitid' AS metric, '' AS "column", 'b' || year AS benchmark_id, CAST(2 * count(DISTINCT UNITID) AS DOUBLE) AS expected_value, 0.0 AS tolerance_abs, CASE WHEN year % 2 = 0 THEN 0.5 ELSE 0.1 END AS tolerance_rel,
 CAST(count(DISTINCT UNITID) AS DOUBLE) AS actual, CASE WHEN year % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM panel GROUP BY year""")
def benchmark_reconciliation(spark, d):
    metrics = structure.benchmark_metrics(release_panel(spark, d), ["CONTROL"])
    wanted = metrics.where("metric = 'distinct_unitid'").select(
        F.concat(F.lit("b"), F.col("year").cast("string")).alias("benchmark_id"), F.col("year").cast("string").alias("year"), "metric", "column", (F.col("actual") * 2).cast("string").alias("expected_value"),
        F.lit("").alias("tolerance_abs"), F.when(F.col("year") % 2 == 0, "0.5").otherwise("0.1").alias("tolerance_rel"),
    )
    return structure.reconcile(metrics, wanted)


# --- comparisons and gates

_BOTH = f"WITH {_panel('a')}, {_panel('b', 'release_current', 'current')}"


@query(f"""{_BOTH}, l AS (SELECT year, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY year), r AS (SELECT year, count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY year)
 SELECT coalesce(l.year, r.year) AS year, coalesce(l.n, 0) AS only_left, coalesce(r.n, 0) AS only_right FROM l FULL JOIN r ON l.year = r.year""")
def multiset_difference(spark, d):
    return compare.multiset_report(release_panel(spark, d), release_panel(spark, d, "release_current", "current"), "year")


_KEYED = ["SECTOR", "OPEID"]
_DIG = ", ".join(f"coalesce(array_to_string(list_sort(list(DISTINCT {c}) FILTER ({c} <> '')), '|'), '') AS {c}" for c in _KEYED)


@query(f"""{_BOTH}, x AS (SELECT UNITID, {_DIG} FROM a GROUP BY UNITID), y AS (SELECT UNITID, {_DIG} FROM b GROUP BY UNITID)
 SELECT UNITID, 'removed' AS change, '' AS "column", '' AS old, '' AS new FROM x ANTI JOIN y USING (UNITID) UNION ALL SELECT UNITID, 'added', '', '', '' FROM y ANTI JOIN x USING (UNITID)
 UNION ALL SELECT UNITID, 'changed', 'SECTOR', x.SECTOR, y.SECTOR FROM x JOIN y USING (UNITID) WHERE x.SECTOR <> y.SECTOR UNION ALL SELECT UNITID, 'changed', 'OPEID', x.OPEID, y.OPEID FROM x JOIN y USING (UNITID) WHERE x.OPEID <> y.OPEID""")
def keyed_changes(spark, d):
    return compare.keyed_changes(release_panel(spark, d), release_panel(spark, d, "release_current", "current"), ["UNITID"], _KEYED)


@query(f"WITH {_LAKE} SELECT year, source_file, array_to_string(list_sort(list(DISTINCT varname)), '|') AS varname, array_to_string(list_sort(list(DISTINCT varnumber)), '|') AS varnumber FROM lake GROUP BY ALL")
def mapping_digest(spark, d):
    return compare.digest(lake(spark, d), ["year", "source_file"], ["varname", "varnumber"])


@query(f"""{_BOTH}, i AS (SELECT CASE WHEN a.UNITID IS NULL THEN 'row_added' WHEN b.UNITID IS NULL THEN 'row_removed' ELSE 'value_changed' END AS category, CAST(coalesce(a.year, b.year) AS VARCHAR) AS artifact
   FROM a FULL JOIN b ON a.UNITID = b.UNITID AND a.year = b.year WHERE a.FINVAL IS DISTINCT FROM b.FINVAL OR a.UNITID IS NULL OR b.UNITID IS NULL)
 SELECT category, CASE WHEN category = 'value_changed' AND artifact = '2016' OR category = 'row_removed' THEN 'pass' ELSE 'fail' END AS severity, count(*) AS n_issues FROM i GROUP BY ALL""")
def release_issues(spark, d):
    a = release_panel(spark, d).select("UNITID", "year", F.col("FINVAL").alias("x"), F.lit(1).alias("_a"))
    b = release_panel(spark, d, "release_current", "current").select("UNITID", "year", F.col("FINVAL").alias("y"), F.lit(1).alias("_b"))
    both = a.join(b, ["UNITID", "year"], "full_outer").where("_a is null or _b is null or not (x <=> y)")
    category = F.when(F.col("_a").isNull(), "row_added").when(F.col("_b").isNull(), "row_removed").otherwise("value_changed")
    issues = both.select(category.alias("category"), F.col("year").cast("string").alias("artifact"), F.col("UNITID").cast("string").alias("detail"), F.lit("fail").alias("severity"))
    waivers = spark.createDataFrame([("value_changed", "2016", ""), ("row_removed", "", "")], "category string, artifact string, detail string")
    return compare.issue_summary(compare.apply_waivers(issues, waivers))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS artifact_id, concat_ws(',', CASE WHEN o_orderkey % 7 = 0 THEN 'missing_file' END, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 THEN 'size_mismatch' END) AS failure_reasons,
 o_orderkey % 7 <> 0 AND o_orderkey % 5 <> 0 AS passed FROM orders""")
def manifest_verification(spark, d):
    key = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(key.cast("string").alias("artifact_id"), F.lit("true").alias("present"), F.lit("10").alias("size_bytes"), F.sha2(key.cast("string"), 256).alias("sha256"), F.lit("").alias("rows"), F.lit("3").alias("columns"), key)
    actual = rows.where(key % 7 != 0).withColumn("size_bytes", F.when(key % 5 == 0, "11").otherwise("10"))
    return compare.verify_manifest(rows.drop("o_orderkey"), actual.drop("o_orderkey"))


@query(f"""WITH {_panel()} SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS n_beyond_first FROM (SELECT UNITID, year, count(*) AS n FROM (SELECT UNITID, year FROM panel_long) GROUP BY UNITID, year)""")
def duplicate_key_count(spark, d):
    return gates.duplicate_keys(table(spark, d, "panel_long"), ["UNITID", "year"])


@query()
def acceptance_audit(spark, d):
    raw = release_panel(spark, d)
    cleaned = clean.blank_children(raw, targets())
    base = base_rows(spark, d)
    years = list(range(2010, 2024))  # those the panel is delivered for
    counters = {"no_scalar_conflicts": wide.conflict_keys(base), "no_duplicate_cells": wide.duplicate_groups(base), "units_known": longform.missing_units(table(spark, d, "panel_long")).where("n_missing > 0")}
    checks = gates.acceptance(table(spark, d, "panel_long"), raw, cleaned, years, counters)
    return spark.createDataFrame([(c.name, c.status, c.detail) for c in checks], "name string, status string, detail string")


# --- profile and search


@query(f"""WITH {_STAGE}, {_LAKE}, w AS (SELECT count(DISTINCT year) AS wn, count(DISTINCT (year, UNITID)) AS uy FROM stage),
 t AS (SELECT varname, {_best('"varTitle"')} AS title, {_best('"longDescription"')} AS description FROM lake GROUP BY varname), s AS (SELECT varname, source_file, count(*) AS n FROM lake WHERE source_file <> '' GROUP BY ALL),
 p AS (SELECT varname, list(source_file ORDER BY -n, source_file)[1] AS primary_source, count(*) AS source_count FROM s GROUP BY varname),
 c AS (SELECT varname, count(DISTINCT year) AS n_years, min(year) AS year_min, max(year) AS year_max, count(DISTINCT (year, UNITID)) AS filled, count({_double("value_norm")}) AS nn, count(*) AS nv FROM stage WHERE value_norm IS NOT NULL GROUP BY varname),
 dc AS (SELECT varname, trim("DataType") AS v, count(*) AS n FROM lake WHERE lower(trim("DataType")) NOT IN ('', 'nan', 'none', '<na>', 'nat') GROUP BY ALL),
 dm AS (SELECT varname, list(v ORDER BY -n, v)[1] AS declared FROM dc GROUP BY varname),
 r AS (SELECT *, round(filled * 100 / uy, 4) AS completeness FROM c CROSS JOIN w)
 SELECT varname, coalesce(title, '') AS title, coalesce(description, '') AS description, coalesce(primary_source, '') AS primary_source, coalesce(source_count, 0) AS source_count, year_min, year_max, n_years, completeness,
  CASE WHEN completeness >= 95 THEN 'full' WHEN completeness >= 75 THEN 'strong' WHEN completeness >= 40 THEN 'partial' ELSE 'sparse' END AS completeness_bucket,
  CASE WHEN n_years >= wn THEN 'full-window' WHEN n_years >= greatest(3, round_even(wn * 0.75, 0)) THEN 'broad' WHEN n_years >= greatest(2, round_even(wn * 0.4, 0)) THEN 'partial' ELSE 'limited' END AS coverage_bucket,
  CASE WHEN nn = nv THEN 'numeric' ELSE 'string' END AS panel_type,
  CASE WHEN varname IN ('UNITID', 'OPEID', 'OPEID6', 'PEO1OPEID', 'DFRCGID', 'DFRCUSCG') OR varname LIKE '%URL' OR contains(w2, ' IDENTIFIER') THEN 'identifier'
   WHEN regexp_matches(w2, ' WEBSITE| WEB ADDRESS| ADDRESS| CITY| ZIP| URL| PHONE') THEN 'text'
   WHEN regexp_matches(w2, ' FLAG| STATUS| INDICATOR') OR varname LIKE '%FLG' OR starts_with(varname, 'PRCH_') THEN 'flag'
   WHEN regexp_matches(w2, 'PERCENT| RATE| RATIO| SHARE') OR ends_with(varname, '_P') OR varname LIKE '%PCT' OR varname LIKE 'PCT%' THEN 'rate'
   WHEN starts_with(upper(trim(coalesce(title, ''))), 'NUMBER OF') OR regexp_matches(w2, ' NUMBER OF | HEADCOUNT| ENROLLMENT') OR (contains(w2, ' STUDENT') AND regexp_matches(w2, ' RECEIVING| RECIPIENT'))
     OR ends_with(varname, '_N') OR regexp_matches(varname, '(AID|GRNT|LOAN|ENR|RET|ADM).*N$') OR (ends_with(varname, 'N') AND regexp_matches(varname, 'AID|GRNT|LOAN|ENR|RET|ADM')) THEN 'count'
   WHEN regexp_matches(w2, ' AMOUNT| TUITION| FEE| COST| PRICE| EXPENSE| EXPENDITURE| REVENUE| ASSET| LIABILITY| SALARY| ENDOWMENT| NET PRICE') THEN 'amount'
   WHEN (nn <> nv OR upper(coalesce(declared, '')) IN ('A', 'DISC')) THEN CASE WHEN regexp_matches(w2, ' NAME| TITLE| DESCRIPTION') THEN 'text' ELSE 'category' END ELSE 'measure' END AS variable_form,
  component, family
 FROM (SELECT *, varname || ' ' || upper(trim(coalesce(title, ''))) AS w2, {rules.family_sql('component', 'w3')} AS family FROM (SELECT *, {rules.component_sql("coalesce(primary_source, '')", 'w3')} AS component FROM (SELECT *, upper(concat_ws(' ', varname, coalesce(title, ''), coalesce(description, ''))) AS w3 FROM r LEFT JOIN t USING (varname) LEFT JOIN p USING (varname) LEFT JOIN dm USING (varname))))""")
def variable_profile(spark, d):
    return profile.variable_profile(staged(spark, d), lake(spark, d))


@query(ORACLES["variable_profile"].replace("WITH ", "WITH prof AS (WITH ", 1) + """),
 v AS (SELECT *, list_distinct(list_filter(regexp_extract_all(upper(concat_ws(' ', varname, title, description, family)), '[A-Z0-9]+'), lambda w: length(w) >= 3 AND w NOT IN ('THE', 'AND', 'FOR', 'WITH', 'FROM', 'THAT', 'THIS',
   'WITHIN', 'RATE', 'TOTAL', 'NUMBER', 'STUDENT', 'STUDENTS', 'VARIABLE', 'IPEDS', 'DATA', 'INSTITUTION', 'INSTITUTIONS'))) AS ws,
   list_filter([upper(varname), regexp_replace(upper(varname), '[0-9]+$', ''), regexp_extract(upper(varname), '^[A-Z]+')], lambda r: length(r) >= 3) AS rs FROM prof),
 z AS (SELECT a.varname, b.varname AS other, CAST(20 * CAST(a.component = b.component AS INT) + 35 * CAST(a.family = b.family AS INT) + 8 * CAST(a.variable_form = b.variable_form AS INT)
   + 6 * CAST(a.primary_source <> '' AND a.primary_source = b.primary_source AS INT) + 18 * CAST(list_has_any(a.rs, b.rs) AS INT) + 3 * len(list_intersect(a.ws, b.ws)) AS INTEGER) AS score FROM v a JOIN v b ON a.varname <> b.varname)
 SELECT *, CAST(row_number() OVER (PARTITION BY varname ORDER BY score DESC, other) AS INTEGER) AS rank FROM z WHERE score >= 28 QUALIFY rank <= 6""")
def related_variables(spark, d):
    return profile.related(variable_profile(spark, d))


@query(ORACLES["variable_profile"].replace("WITH ", "WITH prof AS (WITH ", 1) + """) SELECT *, CAST(CASE WHEN lower(varname) = 'staff' THEN 140 WHEN starts_with(lower(varname), 'staff') THEN 115 WHEN contains(lower(varname), 'staff') THEN 92
 WHEN contains(lower(title), 'staff') THEN 74 WHEN contains(variable_form, 'staff') THEN 68 WHEN lower(primary_source) = 'staff' THEN 64 WHEN contains(lower(family), 'staff') THEN 62
 WHEN contains(lower(component), 'staff') THEN 58 WHEN contains(lower(description), 'staff') THEN 34 ELSE 0 END AS INTEGER) AS score FROM prof WHERE score > 0 AND panel_type = 'string'""")
def variable_search(spark, d):
    return profile.search(variable_profile(spark, d), "Staff", panel_type="string")


@query("SELECT * FROM (" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count("{c}") AS non_null, count(*) AS n_rows, min(year) AS key_min, max(year) AS key_max FROM panel_long""" for c in ["row_id", *longform.PANEL_COLUMNS, "loaded_at"]) + ")")
def column_stats(spark, d):
    return profile.column_stats(table(spark, d, "panel_long").select("row_id", *longform.PANEL_COLUMNS, "loaded_at"))


_WORDS = "upper(concat_ws(' ', varname, coalesce(title, ''), coalesce(description, '')))"


@query(f"""WITH {_LAKE}, t AS (SELECT varname, {_best('"varTitle"')} AS title, {_best('"longDescription"')} AS description FROM lake GROUP BY varname), s AS (SELECT varname, source_file, count(*) AS n FROM lake WHERE source_file <> '' GROUP BY ALL),
 p AS (SELECT varname, list(source_file ORDER BY -n, source_file)[1] AS src FROM s GROUP BY varname), g AS (SELECT varname, {rules.component_sql("coalesce(src, '')", _WORDS)} AS component, {_WORDS} AS w FROM t LEFT JOIN p USING (varname))
 SELECT varname, component, {rules.family_sql("component", "w")} AS family FROM g""")
def variable_components(spark, d):
    v = dictionary.summaries(lake(spark, d))
    words = F.concat_ws(" ", "varname", F.coalesce("title", F.lit("")), F.coalesce("description", F.lit("")))
    v = v.select("varname", words.alias("w"), rules.component(F.col("primary_source"), words).alias("component"))
    return v.select("varname", "component", rules.family(F.col("component"), F.col("w")).alias("family"))


@query(f"""{_UNITS}, {_LAKE} SELECT 'long_panel' AS section, unnest(['rows', 'units', 'years', 'variables', 'sources']) AS metric, unnest([count(*), count(DISTINCT UNITID), count(DISTINCT year), count(DISTINCT varname), count(DISTINCT source_file)]) AS value FROM panel_long
 UNION ALL SELECT s, unnest(['rows', 'units', 'years', 'columns']), unnest([count(*), count(DISTINCT UNITID), count(DISTINCT year), 9]) FROM panel CROSS JOIN (SELECT unnest(['wide_panel', 'clean_panel']) AS s) GROUP BY s
 UNION ALL SELECT 'dictionary', unnest(['rows', 'variables', 'sources']), unnest([count(*), count(DISTINCT varname), count(DISTINCT source_file)]) FROM lake
 UNION ALL SELECT 'structure', unnest(['units', 'always_present', 'selection_risk', 'several_identifiers']), unnest([count(*), count(*) FILTER (pattern = 'always_present'), count(*) FILTER (possible_selection_risk), count(*) FILTER (possible_identifier_linkage_case)]) FROM pat""")
def release_metrics(spark, d):
    raw = release_panel(spark, d)
    return monitor.release_metrics(table(spark, d, "panel_long"), raw, clean.blank_children(raw, targets()), lake(spark, d), structure.unit_patterns(raw))


@query()
def parity_summary(spark, d):
    checks = monitor.parity(release_panel(spark, d), release_panel(spark, d, "release_current", "current"), ["UNITID", "year"])
    return spark.createDataFrame([(c.name, c.status, c.detail) for c in checks], "name string, status string, detail string")


@query()
def variable_payload(spark, d):
    return monitor.payload(variable_profile(spark, d))


# --- saved queries


def catalog(spark, d) -> Catalog:
    base = base_rows(spark, d)
    conflicts = wide.conflict_rows(base, wide.conflict_keys(base)).select("UNITID", "year", "varnumber", "source_file", "varname", "value", "value_norm", "distinct_values")
    return Catalog(spark, {
        "panel_clean": clean.blank_children(release_panel(spark, d), targets()), "dictionary_lake": table(spark, d, "dictionary_lake"), "scalar_conflicts": conflicts,
        "cast_report": table(spark, d, "cast_report").select("year", "column", "non_empty_tokens", "parsed_numeric_tokens", "failed_parse_tokens"),
    })


@query(f"{_CLEAN} SELECT year, count(*) AS unitid_year_rows, count(DISTINCT UNITID) AS distinct_unitids FROM clean GROUP BY year")
def saved_clean_panel_rows_by_year(spark, d):
    return catalog(spark, d).run("clean_panel_rows_by_year")


@query("""SELECT year, source_file, count(*) AS variable_rows, count(*) FILTER (trim("longDescription") <> '') AS with_long_description FROM dictionary_lake GROUP BY year, source_file""")
def saved_dictionary_source_coverage(spark, d):
    return catalog(spark, d).run("dictionary_source_coverage")


@query(f"""{_BASE} SELECT year, count(*) AS conflict_rows, count(DISTINCT UNITID) AS affected_unitids, count(DISTINCT source_file || '|' || varnumber) AS affected_source_var_pairs FROM base JOIN keys USING (UNITID, year, varnumber, source_file) GROUP BY year""")
def saved_scalar_conflict_summary(spark, d):
    return catalog(spark, d).run("scalar_conflict_summary")


@query("""SELECT year, "column", non_empty_tokens, parsed_numeric_tokens, failed_parse_tokens FROM cast_report WHERE failed_parse_tokens > 0
 ORDER BY failed_parse_tokens DESC, year, "column" NULLS FIRST, non_empty_tokens NULLS FIRST, parsed_numeric_tokens NULLS FIRST LIMIT 100""")
def saved_cast_failure_summary(spark, d):
    return catalog(spark, d).run("cast_failure_summary")


@query("SELECT CAST(NULL AS INTEGER) AS year, '' AS academic_year_label, '' AS release_type, '' AS release_date_text, '' AS download_status WHERE false")
def saved_release_inventory(spark, d):
    return catalog(spark, d).run("release_inventory")


@query("SELECT CAST(NULL AS TIMESTAMP) AS started_at, '' AS years_spec, true AS lane_split, true AS typed_output, true AS persist_duckdb, '' AS memory_limit, '' AS buckets WHERE false")
def saved_recent_build_runs(spark, d):
    return catalog(spark, d).run("recent_build_runs")

