"""Queries of the general data-processing operators (p1, p2, p4, p5, p6) and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions import sql as S
from panelloom.functions import text as T
from panelloom.operators import copies, drifting, eav, orphans, quality_profile
from panelloom.runtime import materialise, scratch
from panelloom.sources.versions import Versions


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- p1: attribute-value rows into wide tables


def p1_found(spark, d):
    return eav.unparsed_cells(eav.wide_table(table(spark, d, "panel_long")))


def p1_wide(spark, d):
    return eav.wide_table(table(spark, d, "panel_long"))


def p1_long(spark, d):
    """The wide table melted back."""
    return eav.melted(p1_wide(spark, d))


_P1 = f"""
WITH r AS (SELECT UNITID, year, {S.varname("varname")} AS varname, {S.null_if_token("value")} AS value, {S.read_number("value")} AS num,
                  {S.declared_numeric('"DataType"')} AS is_num, loaded_at, row_id FROM panel_long),
     t AS (SELECT varname, year, count(*) FILTER (is_num) AS a, count(*) FILTER (NOT is_num) AS b FROM r GROUP BY ALL),
     kind AS (SELECT varname, bool_or(a > b) AS has_num, bool_and(a > b) AS all_num FROM t GROUP BY varname)
"""
P1_FOUND = _P1 + """
SELECT UNITID, year, varname FROM r JOIN t USING (varname, year) WHERE UNITID IS NOT NULL AND a > b
GROUP BY UNITID, year, varname HAVING count(value) > 0 AND count(num) = 0"""
_P1_LONG = """, cells AS (
 SELECT UNITID, year, varname, list(num ORDER BY loaded_at DESC, row_id DESC) FILTER (num IS NOT NULL)[1] AS num, CAST(NULL AS VARCHAR) AS text FROM r JOIN kind USING (varname)
  WHERE has_num AND UNITID IS NOT NULL AND varname <> '' GROUP BY UNITID, year, varname
 UNION ALL SELECT UNITID, year, varname || CASE WHEN any_value(has_num) THEN '_TEXT' ELSE '' END, NULL,
   list(value ORDER BY loaded_at DESC, row_id DESC) FILTER (value IS NOT NULL AND (NOT has_num OR num IS NULL))[1] FROM r JOIN kind USING (varname)
  WHERE NOT all_num AND UNITID IS NOT NULL AND varname <> '' GROUP BY UNITID, year, varname)
"""
P1_LONG = _P1 + _P1_LONG + "SELECT * FROM cells WHERE num IS NOT NULL OR text IS NOT NULL"

# --- p2: differences between two copies


def p2_found(spark, d):
    return copies.differences(table(spark, d, "release_baseline"), table(spark, d, "release_current"))


def p2_summary(spark, d):
    return copies.summary(p2_found(spark, d))


def _p2_side(name: str, value: str) -> str:
    field, t = S.varname("field"), S.null_if_token(f'"{value}"')
    num = S.read_number(t)
    return f"""SELECT {S.path_key("relative_path")} AS relative_path, UNITID, year, {field} AS field,
    CASE WHEN {field} IN ('INSTNM', 'OPEID') OR {num} IS NULL THEN 't:' || {t} ELSE 'n:' || CAST({num} + 0.0 AS VARCHAR) END AS v FROM {name}"""


_P2 = f"""
WITH b AS ({_p2_side("release_baseline", "baseline")}), c AS ({_p2_side("release_current", "current")}),
 kb AS (SELECT DISTINCT relative_path, UNITID, year FROM b), kc AS (SELECT DISTINCT relative_path, UNITID, year FROM c),
 vb AS (SELECT DISTINCT * FROM b WHERE v IS NOT NULL), vc AS (SELECT DISTINCT * FROM c WHERE v IS NOT NULL),
 odd AS ((SELECT * FROM vb EXCEPT SELECT * FROM vc) UNION (SELECT * FROM vc EXCEPT SELECT * FROM vb)),
 found AS (
  SELECT *, '' AS field, 'missing_in_current' AS kind FROM (SELECT * FROM kb EXCEPT SELECT * FROM kc)
  UNION ALL SELECT *, '', 'missing_in_baseline' FROM (SELECT * FROM kc EXCEPT SELECT * FROM kb)
  UNION ALL SELECT DISTINCT relative_path, UNITID, year, field, 'value_differs' FROM odd
   WHERE (relative_path, UNITID, year) IN (SELECT * FROM kb) AND (relative_path, UNITID, year) IN (SELECT * FROM kc))
"""
P2_FOUND = _P2 + "SELECT relative_path, UNITID, year, field, kind FROM found"
P2_SUMMARY = _P2 + "SELECT relative_path, kind, field, count(*) AS n_rows, count(DISTINCT UNITID) AS n_units FROM found GROUP BY ALL"


# --- p4: column-level data quality profile

P4_COLUMNS = ["year", "column", "non_empty_tokens", "parsed_numeric_tokens", "failed_parse_tokens"]


def p4_found(spark, d):
    return quality_profile.report_issues(table(spark, d, "cast_report"))


COUNTS = "load string, column string, value string, n long"


def _p4_store(spark, *deltas: DataFrame) -> DataFrame:
    """The persistent counts after some signed deltas, one version each."""
    store = Versions(spark, scratch(spark, "value-counts"), COUNTS)
    for delta in deltas:
        counts = store.advance(lambda c: quality_profile.apply_delta(c, delta))  # noqa: B023
    return counts


def _p4_counts(spark, d):
    """Counts after two deltas per load: the rows of even and of odd report ids, as if they had come one after the other."""
    report = table(spark, d, "cast_report")
    even = quality_profile.value_counts(report.where("report_id % 2 = 0"), F.col("run_id"), P4_COLUMNS)
    odd = quality_profile.value_counts(report.where("report_id % 2 <> 0"), F.col("run_id"), P4_COLUMNS)
    return _p4_store(spark, even, odd)


def p4_profile(spark, d):
    return quality_profile.metrics(_p4_counts(spark, d), {"column": quality_profile.COLUMN_NAME_RE})


def p4_drift(spark, d):
    return quality_profile.drift(_p4_counts(spark, d))


def p4_loads(spark, d):
    """The profile after all loads, a correction (old counts out, new ones in) and the withdrawal of every third load."""
    report = table(spark, d, "cast_report")
    wrong = report.where("report_id % 5 = 0")
    right = wrong.withColumns({"failed_parse_tokens": F.col("failed_parse_tokens") + 1, "column": F.upper("column")})
    gone = report.where("report_id % 5 <> 0").unionByName(right).where("run_id % 3 = 0")
    of = lambda rows, sign=1: quality_profile.value_counts(rows, F.col("run_id"), P4_COLUMNS, sign)
    correction = of(wrong, -1).unionByName(of(right))
    return quality_profile.metrics(_p4_store(spark, of(report), correction, of(gone, -1)), {"column": quality_profile.COLUMN_NAME_RE})


P4_FOUND = """
WITH r AS (SELECT report_id, run_id, year, "column" AS col, non_empty_tokens AS n, parsed_numeric_tokens AS ok, failed_parse_tokens AS bad,
   n IS NULL OR ok IS NULL OR bad IS NULL AS missing FROM cast_report),
 f AS (SELECT *, coalesce(NOT missing AND (least(n, ok, bad) < 0 OR ok + bad <> n), false) AS wrong FROM r),
 s AS (SELECT * FROM f WHERE NOT missing AND NOT wrong AND col IS NOT NULL),
 e AS (SELECT DISTINCT run_id, col, year, n, ok, bad, CASE WHEN n > 0 THEN bad / n END AS share FROM s),
 k AS (SELECT DISTINCT run_id, col, year FROM e),
 m AS (SELECT k.run_id, k.col, k.year, median(e.n) AS mn, median(e.share) AS ms FROM k JOIN e ON e.run_id = k.run_id AND e.col = k.col AND e.year <> k.year GROUP BY ALL),
 j AS (SELECT report_id, n, CASE WHEN n > 0 THEN bad / n END AS share, mn, ms FROM s JOIN m USING (run_id, col, year))
SELECT report_id, 'count_missing' AS issue FROM f WHERE missing
UNION ALL SELECT report_id, 'counts_disagree' FROM f WHERE wrong
UNION ALL SELECT report_id, 'bad_column_name' FROM f WHERE col IS NULL OR NOT regexp_full_match(col, '[A-Z][A-Z0-9_]*')
UNION ALL SELECT report_id, 'volume_shift' FROM j WHERE n < mn / 2 OR n > mn * 2
UNION ALL SELECT report_id, 'failure_shift' FROM j WHERE round(share - ms, 9) >= 0.10"""
_P4_LONG = "WITH l AS (" + " UNION ALL ".join(f"""SELECT CAST(run_id AS VARCHAR) AS load, '{c}' AS "column", CAST("{c}" AS VARCHAR) AS value FROM cast_report""" for c in P4_COLUMNS) + """),
 c AS (SELECT load, "column", value, count(*) AS n FROM l GROUP BY ALL)"""  # fmt: skip
_P4_METRICS = f"""
SELECT load, "column", CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS n_null,
 round(coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n), 9) AS null_share,
 CAST(coalesce(sum(n) FILTER (value IS NOT NULL AND {S.null_if_token("value")} IS NULL), 0) AS BIGINT) AS n_empty, count(value) AS n_distinct,
 CAST(coalesce(sum(n) FILTER ("column" = 'column' AND NOT regexp_matches(value, '{quality_profile.COLUMN_NAME_RE}')), 0) AS BIGINT) AS n_violations,
 min(value) AS min_text, max(value) AS max_text, min(try_cast(value AS DOUBLE)) AS min_number, max(try_cast(value AS DOUBLE)) AS max_number,
 CASE WHEN count(value) > 0 THEN round(log2(sum(n) FILTER (value IS NOT NULL)) - sum(n * log2(n)) FILTER (value IS NOT NULL) / sum(n) FILTER (value IS NOT NULL), 9) + 0.0 END AS entropy
FROM c GROUP BY load, "column\""""
P4_PROFILE = _P4_LONG + _P4_METRICS
P4_LOADS = """WITH cast_report AS (SELECT report_id, run_id, year, CASE WHEN report_id % 5 = 0 THEN upper("column") ELSE "column" END AS "column", non_empty_tokens, parsed_numeric_tokens,
  CASE WHEN report_id % 5 = 0 THEN failed_parse_tokens + 1 ELSE failed_parse_tokens END AS failed_parse_tokens FROM main.cast_report WHERE run_id % 3 <> 0 OR run_id IS NULL),
""" + P4_PROFILE.removeprefix("WITH ")
P4_DRIFT = _P4_LONG + """,
 t AS (SELECT load, "column" AS col, sum(n) AS s, lag(load) OVER w AS earlier FROM c GROUP BY load, "column" WINDOW w AS (PARTITION BY "column" ORDER BY CAST(load AS BIGINT))),
 p AS (SELECT t.load AS tt, col, value, n / s AS d FROM t JOIN c ON c.load = t.load AND c."column" = col WHERE earlier IS NOT NULL
       UNION ALL SELECT t.load, t.col, value, -n / u.s FROM t JOIN t u ON u.load = t.earlier AND u.col = t.col JOIN c ON c.load = t.earlier AND c."column" = t.col),
 g AS (SELECT tt, col, value, sum(d) AS d FROM p GROUP BY ALL)
SELECT tt AS load, col AS "column", round(sum(abs(d)) / 2, 9) AS distance FROM g GROUP BY tt, col"""


# --- p5: references to records that do not exist


def p5_found(spark, d):
    return orphans.orphans(table(spark, d, "panel_long"), table(spark, d, "dictionary_lake"), table(spark, d, "dictionary_ambiguity_overrides"))


def p5_periods(spark, d):
    return p5_found(spark, d).groupBy("table_name", "year", "kind").agg(F.count(F.lit(1)).alias("n_references"))


def p5_state(spark, d):
    """Open references after five steps: the dictionary of years up to 2016, all references, the rest of the dictionary, the
    deletion of the years up to 2012, which reopens what they met, and their return. The keyed state ends where a single look
    at everything ends; the snapshot of the fourth step is p5_reopened."""
    state = _p5_deleted(spark, d)
    back = orphans.advance(state, orphans.start(spark).counts, orphans.parent_delta(table(spark, d, "dictionary_lake").where("year <= 2012")))
    return orphans.snapshot(back.pending)


def p5_reopened(spark, d):
    """Open references while the dictionary of the years up to 2012 is deleted."""
    return orphans.snapshot(_p5_deleted(spark, d).pending)


def _p5_deleted(spark, d) -> orphans.State:
    lake = table(spark, d, "dictionary_lake")
    none = orphans.start(spark)
    state = orphans.advance(none, none.counts, orphans.parent_delta(lake.where("year <= 2016")))
    wild = orphans.reference_counts(orphans.override_references(table(spark, d, "dictionary_ambiguity_overrides")))
    references = materialise(orphans.panel_reference_counts(table(spark, d, "panel_long")).unionByName(wild), "references")
    state = orphans.persist(orphans.advance(state, references, none.index))
    state = orphans.persist(orphans.advance(state, none.counts, orphans.parent_delta(lake.where("year > 2016"))))
    return orphans.persist(orphans.advance(state, none.counts, orphans.parent_delta(lake.where("year <= 2012"), -1)))


_P5 = f"""
WITH d AS (SELECT DISTINCT year, {S.source_file("source_file")} AS sf, {S.varnumber("varnumber")} AS vn FROM dictionary_lake WHERE {S.varnumber("varnumber")} IS NOT NULL),
 ds AS (SELECT sf, vn, list(year) AS years, min(year) AS lo, max(year) AS hi FROM d GROUP BY sf, vn),
 da AS (SELECT vn, list(year) AS years, min(year) AS lo, max(year) AS hi FROM d GROUP BY vn),
 p AS (SELECT 'panel_long' AS table_name, row_id AS record_id, coalesce(year, 0) AS year, {S.source_file("source_file")} AS sf, {S.varnumber("varnumber")} AS vn FROM panel_long),
 o AS (SELECT 'dictionary_ambiguity_overrides' AS table_name, override_id AS record_id, coalesce(CAST(try_cast({S.null_if_token("year")} AS DOUBLE) AS INTEGER), 0) AS year,
       CASE WHEN {S.null_if_token("source_file")} IS NULL THEN '' ELSE {S.source_file("source_file")} END AS sf, {S.varnumber("selected_varnumber")} AS vn FROM dictionary_ambiguity_overrides),
 j AS (SELECT p.*, years, lo, hi FROM p LEFT JOIN ds USING (sf, vn) WHERE vn IS NOT NULL AND NOT coalesce(list_contains(years, year), false)
       UNION ALL SELECT o.*, CASE WHEN sf = '' THEN da.years ELSE ds.years END AS ys, CASE WHEN sf = '' THEN da.lo ELSE ds.lo END, CASE WHEN sf = '' THEN da.hi ELSE ds.hi END
       FROM o LEFT JOIN ds USING (sf, vn) LEFT JOIN da USING (vn) WHERE vn IS NOT NULL AND NOT coalesce(list_contains(ys, year), false) AND NOT (year = 0 AND ys IS NOT NULL)),
 found AS (SELECT table_name, year, record_id, CASE WHEN year <> 0 AND lo > year THEN 'late' WHEN year <> 0 AND hi < year THEN 'deleted' ELSE 'missing' END AS kind FROM j)
"""
P5_FOUND = _P5 + "SELECT * FROM found"
P5_PERIODS = _P5 + "SELECT table_name, year, kind, count(*) AS n_references FROM found GROUP BY ALL"
P5_STATE = _P5 + "SELECT table_name, year, count(*) AS n_references, count(DISTINCT sf || '|' || vn) AS n_keys FROM j GROUP BY table_name, year"
P5_REOPENED = P5_STATE.replace('FROM dictionary_lake WHERE', 'FROM dictionary_lake WHERE year > 2012 AND')


# --- p6: schemas that drift between files


def p6_found(spark, d):
    return drifting.changes(drifting.file_schemas(table(spark, d, "panel_long"), table(spark, d, "dictionary_lake")))


def p6_schemas(spark, d):
    return drifting.file_schemas(table(spark, d, "panel_long"), table(spark, d, "dictionary_lake"))


def p6_consistent(spark, d):
    return drifting.consistent(table(spark, d, "panel_long"), table(spark, d, "dictionary_lake"))


_P6 = f"""
WITH d AS (SELECT DISTINCT year, {S.source_file("source_file")} AS sf, {S.varnumber("varnumber")} AS vn FROM dictionary_lake),
 p AS (SELECT {S.source_file("source_file")} AS sf, year, {S.varname("varname")} AS v, {S.varnumber("varnumber")} AS vn, {S.declared_numeric('"DataType"')} AS is_num FROM panel_long),
 r AS (SELECT p.* FROM p SEMI JOIN d USING (sf, year, vn) WHERE v <> ''),
 ty AS (SELECT sf, year, v, CASE WHEN count(is_num) > 0 THEN count(*) FILTER (is_num) > count(*) FILTER (NOT is_num) END AS num FROM r GROUP BY ALL),
 f AS (SELECT DISTINCT sf, year, v, vn, num FROM r JOIN ty USING (sf, year, v)),
 y AS (SELECT sf, year, lag(year) OVER (PARTITION BY sf ORDER BY year) AS prev FROM (SELECT DISTINCT sf, year FROM f)),
 l AS (SELECT f.*, prev FROM f JOIN y USING (sf, year) WHERE prev IS NOT NULL),
 e AS (SELECT f.sf, y.year AS tt, f.v, f.vn, f.num FROM f JOIN y ON y.sf = f.sf AND y.prev = f.year)
"""
P6_FOUND = _P6 + """
SELECT sf AS source_file, year, 'renamed' AS change, v AS varname FROM l WHERE EXISTS (FROM e WHERE e.sf = l.sf AND e.tt = l.year AND e.vn = l.vn)
   AND NOT EXISTS (FROM e WHERE e.sf = l.sf AND e.tt = l.year AND e.vn = l.vn AND e.v = l.v)
UNION SELECT sf, year, 'renumbered', v FROM l WHERE EXISTS (FROM e WHERE e.sf = l.sf AND e.tt = l.year AND e.v = l.v)
   AND NOT EXISTS (FROM e WHERE e.sf = l.sf AND e.tt = l.year AND e.vn = l.vn AND e.v = l.v)
UNION SELECT sf, year, 'added', v FROM l WHERE NOT EXISTS (FROM e WHERE e.sf = l.sf AND e.tt = l.year AND (e.vn = l.vn OR e.v = l.v))
UNION SELECT sf, tt, 'removed', v FROM e WHERE NOT EXISTS (FROM l WHERE e.sf = l.sf AND e.tt = l.year AND (e.vn = l.vn OR e.v = l.v))
UNION SELECT l.sf, l.year, 'type_changed', l.v FROM l JOIN e ON e.sf = l.sf AND e.tt = l.year AND e.v = l.v WHERE l.num <> e.num"""
P6_SCHEMAS = _P6 + "SELECT sf AS source_file, year, v AS varname, vn AS varnumber, num AS is_numeric FROM f"
P6_CONSISTENT = _P6.replace("WITH d AS", "WITH RECURSIVE d AS", 1) + f""",
 nm AS (SELECT DISTINCT sf, year, v, num FROM f), nxt AS (SELECT sf, year, lead(year) OVER (PARTITION BY sf ORDER BY year) AS later FROM (SELECT DISTINCT sf, year FROM f)),
 kept AS (SELECT nm.sf, nm.year, nm.v, later, nm.v AS v2 FROM nm JOIN nxt USING (sf, year) JOIN nm o ON o.sf = nm.sf AND o.year = later AND o.v = nm.v),
 came AS (SELECT a.sf, a.year, a.v, later, b.v AS v2, count(DISTINCT a.vn) AS shared FROM f a JOIN nxt USING (sf, year) JOIN f b ON b.sf = a.sf AND b.year = later AND b.vn = a.vn
   WHERE NOT EXISTS (FROM kept k WHERE k.sf = a.sf AND k.year = a.year AND k.v IN (a.v, b.v)) GROUP BY ALL),
 step AS (SELECT * FROM kept UNION ALL SELECT sf, year, v, later, arg_max(v2, shared) FROM came GROUP BY sf, year, v, later),
 walk AS (SELECT sf, year, v, year AS here, v AS name FROM nm UNION ALL SELECT w.sf, w.year, w.v, s.later, s.v2 FROM walk w JOIN step s ON s.sf = w.sf AND s.year = w.here AND s.v = w.name),
 final AS (SELECT sf, year, v, arg_max(name, here) AS field FROM walk GROUP BY sf, year, v),
 kind AS (SELECT sf, field, coalesce(list(num ORDER BY year DESC, v DESC)[1], false) AS num FROM final JOIN nm USING (sf, year, v) GROUP BY sf, field),
 rows AS (SELECT row_id, UNITID, year, {S.source_file("source_file")} AS sf, {S.varname("varname")} AS v, {S.null_if_token("value")} AS value FROM panel_long)
SELECT row_id, UNITID, r.year, r.sf AS source_file, coalesce(f.field, r.v) AS field, coalesce(k.num, false) AS field_numeric, CASE WHEN k.num THEN {S.read_number("value")} END AS number,
 CASE WHEN number IS NULL THEN value END AS text, f.field IS NOT NULL AS resolved FROM rows r LEFT JOIN final f ON f.sf = r.sf AND f.year = r.year AND f.v = r.v LEFT JOIN kind k ON k.sf = f.sf AND k.field = f.field"""

QUERIES = {
    "p1_found": p1_found, "p1_wide": p1_wide, "p1_long": p1_long, "p2_found": p2_found, "p2_summary": p2_summary,
    "p4_found": p4_found, "p4_profile": p4_profile, "p4_loads": p4_loads, "p4_drift": p4_drift, "p5_found": p5_found, "p5_periods": p5_periods, "p5_state": p5_state, "p5_reopened": p5_reopened,
    "p6_found": p6_found, "p6_schemas": p6_schemas, "p6_consistent": p6_consistent,
}
ORACLES = {
    "p1_found": P1_FOUND, "p1_long": P1_LONG, "p2_found": P2_FOUND, "p2_summary": P2_SUMMARY, "p4_found": P4_FOUND, "p4_profile": P4_PROFILE, "p4_loads": P4_LOADS,
    "p4_drift": P4_DRIFT, "p5_found": P5_FOUND, "p5_periods": P5_PERIODS, "p5_state": P5_STATE, "p5_reopened": P5_REOPENED, "p6_found": P6_FOUND, "p6_schemas": P6_SCHEMAS, "p6_consistent": P6_CONSISTENT,
}
