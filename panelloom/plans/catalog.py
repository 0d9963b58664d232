"""Saved SQL over stable views, with typed empty views for what a build did not write."""

from __future__ import annotations

import json
import re
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The stable views and their columns.
VIEWS = {
    "panel_long": "year int, UNITID long, varname string, varnumber string, value string, varTitle string, longDescription string, DataType string, format string, Fieldwidth string, imputationvar string, imputation_value string, source_file string, access_table_name string",
    "panel_wide": "year int, UNITID long",
    "panel_clean": "year int, UNITID long",
    "dictionary_lake": "year int, varnumber string, varname string, varTitle string, longDescription string, DataType string, format string, Fieldwidth string, imputationvar string, source_file string, source_file_label string, access_table_name string, metadata_table_name string, academic_year_label string, release_type string, metadata_source string",
    "dictionary_codes": "year int, varnumber string, varname string, codevalue string, valuelabel string, source_file string",
    "release_inventory": "year int, academic_year_label string, release_type string, release_date_text string, download_status string",
    "build_runs": "run_id long, started_at timestamp, stage string, years_spec string, lane_split boolean, typed_output boolean, persist_duckdb boolean, n_rows long, config_json string",
    "scalar_conflicts": "UNITID long, year int, varnumber string, source_file string, varname string, value string, value_norm string, distinct_values long",
    "cast_report": "year int, column string, non_empty_tokens long, parsed_numeric_tokens long, failed_parse_tokens long",
    "wide_year_summary": "year int, n_rows long, n_vars long, non_empty_values long, fill_rate double, dup_rows long",
    "target_lineage": "varname string, stage_rows long, stage_non_empty_rows long, scalar_rows long, scalar_non_empty_rows long",
}

# The shipped queries with the settings they read; ``json_extract_string`` is registered as a SQL function.
SAVED = {
    "recent_build_runs": """SELECT started_at, years_spec, lane_split, typed_output, persist_duckdb,
        json_extract_string(config_json, '$.duckdb_memory_limit') AS memory_limit, json_extract_string(config_json, '$.scalar_conflict_buckets') AS buckets
        FROM inspect.build_runs ORDER BY started_at DESC NULLS LAST LIMIT 20""",
    "clean_panel_rows_by_year": "SELECT year, count(*) AS unitid_year_rows, count(DISTINCT UNITID) AS distinct_unitids FROM inspect.panel_clean GROUP BY year ORDER BY year NULLS LAST",
    "dictionary_source_coverage": """SELECT year, source_file, count(*) AS variable_rows, count(*) FILTER (WHERE trim(longDescription) <> '') AS with_long_description
        FROM inspect.dictionary_lake GROUP BY year, source_file ORDER BY year NULLS LAST, source_file NULLS LAST""",
    "scalar_conflict_summary": """SELECT year, count(*) AS conflict_rows, count(DISTINCT UNITID) AS affected_unitids,
        count(DISTINCT coalesce(source_file, '') || '|' || coalesce(varnumber, '')) AS affected_source_var_pairs
        FROM inspect.scalar_conflicts GROUP BY year ORDER BY year NULLS LAST""",
    "cast_failure_summary": """SELECT year, column, non_empty_tokens, parsed_numeric_tokens, failed_parse_tokens FROM inspect.cast_report
        WHERE failed_parse_tokens > 0 ORDER BY failed_parse_tokens DESC, year, column, non_empty_tokens, parsed_numeric_tokens LIMIT 100""",
    "release_inventory": "SELECT year, academic_year_label, release_type, release_date_text, download_status FROM inspect.release_inventory ORDER BY year NULLS LAST",
}


class Catalog:
    """The ``inspect`` views of a session. Tables that are not given are empty but typed, so every saved query runs."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame] | None = None) -> None:
        unknown = set(tables or {}) - set(VIEWS)
        if unknown:
            raise KeyError(f"no such views: {sorted(unknown)}")
        self.spark = spark
        self.tables = dict(tables or {})
        spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION json_extract_string(j STRING, p STRING) RETURNS STRING RETURN get_json_object(j, p)")
        for name, schema in VIEWS.items():
            df = self.tables.get(name)
            (df if df is not None else spark.createDataFrame([], schema)).createOrReplaceTempView(f"inspect_{name}")

    def text(self, query: str) -> str:
        """SQL of a saved query by name or path, or the text itself; trailing semicolons go, views get their session names."""
        if query in SAVED:
            sql = SAVED[query]
        elif query.endswith(".sql") and Path(query).exists():
            sql = Path(query).read_text(encoding="utf-8")
        else:
            sql = query
        sql = sql.strip().rstrip(";").strip()
        # Views are named outside of quoted literals only; what stands between quotes stays as it is.
        parts = sql.split("'")
        parts[::2] = [re.sub(rf"\binspect\.({'|'.join(VIEWS)})\b", r"inspect_\1", p) for p in parts[::2]]
        return "'".join(parts)

    def run(self, query: str) -> DataFrame:
        return self.spark.sql(self.text(query))

    def export(self, query: str, out: str, kind: str = "csv", preview: int = 20) -> dict:
        """Run a query, write its result and return a manifest with the SQL's hash, its rows and a preview."""
        import hashlib

        from panelloom.sources.writers import write_csv, write_parquet

        began, df = time.time(), self.run(query).cache()
        try:
            n = df.count()
            write_csv(df, out) if kind == "csv" else write_parquet(df, out)
            rows = [r.asDict() for r in df.limit(preview).collect()]
        finally:
            df.unpersist()
        sql = self.text(query)
        return {"query": query, "sha256": hashlib.sha256(sql.encode()).hexdigest(), "rows": n, "columns": df.columns, "path": out, "seconds": round(time.time() - began, 3), "preview": json.loads(json.dumps(rows, default=str))}

    def explain(self, query: str) -> str:
        """The formatted physical plan of a query."""
        return self.run(query)._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
