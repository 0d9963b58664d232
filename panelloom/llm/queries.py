"""Queries of the llm operators and the SQL they are checked against."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelloom.functions import sql as S
from panelloom.llm import abuse, leakage, mixing, survivors
from panelloom.plans.data_queries import table


def p3_found(spark, d):
    return survivors.choices(table(spark, d, "panel_long"))


def p3_survivors(spark, d):
    return survivors.survivors(table(spark, d, "panel_long"))


def p3_precedence(spark, d):
    return survivors.value_precedence(survivors.keyed(table(spark, d, "panel_long")))


def p7_leaks(spark, d):
    return leakage.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p7_found(spark, d):
    return p7_leaks(spark, d).where("kind = 'stretch'").select("doc_id", "item_id")


def p7_items(spark, d):
    """Every item with the number of documents that contain it and of those that paraphrase it."""
    found = p7_leaks(spark, d).groupBy("item_id").agg(F.count_if(F.col("kind") == "stretch").alias("n_docs"), F.count_if(F.col("kind") == "paraphrase").alias("n_paraphrased"))
    return table(spark, d, "eval_items").select("item_id", "task", "split").join(found, "item_id", "left").fillna(0, ["n_docs", "n_paraphrased"])


def p8_mix(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p8_shares(spark, d):
    return mixing.shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_scores(spark, d):
    return abuse.scores(table(spark, d, "documents"), table(spark, d, "doc_labels"))


def p9_found(spark, d):
    return p9_scores(spark, d).where("offensive").select("doc_id")


def p9_rates(spark, d):
    return abuse.rates(p9_scores(spark, d))


_P3 = f"""
WITH r AS (SELECT row_id, UNITID, year, {S.varnumber("varnumber")} AS vn, {S.source_file("source_file")} AS sf, loaded_at,
   {S.null_if_token("value")} AS value, {S.null_if_token('"varTitle"')} AS t, {S.null_if_token('"longDescription"')} AS l, {S.null_if_token("imputation_value")} AS i FROM panel_long),
 k AS (SELECT * FROM r WHERE UNITID IS NOT NULL AND vn IS NOT NULL),
 g AS (SELECT UNITID, year, vn, sf, min(row_id) AS group_row_id, count(*) AS n_rows,
   arg_max(row_id, loaded_at) FILTER (value IS NOT NULL) AS a, arg_max(row_id, loaded_at) FILTER (t IS NOT NULL) AS b,
   arg_max(row_id, loaded_at) FILTER (l IS NOT NULL) AS c, arg_max(row_id, loaded_at) FILTER (i IS NOT NULL) AS d FROM k GROUP BY UNITID, year, vn, sf)
"""
P3_FOUND = _P3 + """, m AS (SELECT * FROM g WHERE n_rows > 1)
SELECT group_row_id, 'value' AS field, a AS row_id FROM m WHERE a IS NOT NULL UNION ALL SELECT group_row_id, 'varTitle', b FROM m WHERE b IS NOT NULL
UNION ALL SELECT group_row_id, 'longDescription', c FROM m WHERE c IS NOT NULL UNION ALL SELECT group_row_id, 'imputation_value', d FROM m WHERE d IS NOT NULL"""
P3_SURVIVORS = _P3 + """
SELECT group_row_id, g.UNITID, g.year, g.vn AS varnumber, g.sf AS source_file, n_rows, v.value, t.t AS "varTitle", l.l AS "longDescription", i.i AS imputation_value
FROM g LEFT JOIN r v ON v.row_id = a LEFT JOIN r t ON t.row_id = b LEFT JOIN r l ON l.row_id = c LEFT JOIN r i ON i.row_id = d"""

QUERIES = {
    "p3_found": p3_found, "p3_survivors": p3_survivors, "p3_precedence": p3_precedence, "p7_found": p7_found, "p7_leaks": p7_leaks, "p7_items": p7_items,
    "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates,
}
ORACLES = {"p3_found": P3_FOUND, "p3_survivors": P3_SURVIVORS}
