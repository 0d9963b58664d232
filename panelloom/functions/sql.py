"""The normalisers of :mod:`panelloom.functions.text` as DuckDB SQL expressions, for the SQL checks of the queries."""

from __future__ import annotations

from panelloom.functions import text as T


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def listed(items) -> str:
    return "(" + ", ".join(quoted(i) for i in items) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {quoted(T.SPACES)})"


def null_if_token(x: str, tokens=T.VALUE_NULL_TOKENS) -> str:
    return f"(CASE WHEN lower({strip(x)}) NOT IN {listed(tokens)} THEN {strip(x)} END)"


def varname(x: str) -> str:
    return f"coalesce(upper({strip(x)}), '')"


def varnumber(x: str) -> str:
    t = f"regexp_replace({x}, {quoted('[' + T.SPACES + ']+')}, '', 'g')"
    padded = f"CASE WHEN regexp_full_match({t}, '[0-9]{{1,7}}') THEN lpad({t}, 8, '0') ELSE {t} END"
    return f"(CASE WHEN lower({t}) NOT IN {listed(T.VARNUMBER_NULL_TOKENS)} THEN {padded} END)"


def token(x: str) -> str:
    return f"trim(regexp_replace(upper({strip(f'coalesce({x}, {quoted(str())})')}), '[^A-Z0-9]+', '_', 'g'), '_')"


def stem(x: str) -> str:
    last = f"regexp_extract({x}, '([^/]*)/*$', 1)"
    return f"regexp_replace({last}, '([^.])\\.[^.]+$', '\\1')"


def source_file(x: str) -> str:
    norm = token(stem(f"coalesce({x}, '')"))
    bare = f"trim(regexp_replace(regexp_replace({norm}, '[0-9]+', '', 'g'), '_+', '_', 'g'), '_')"
    aliases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in T.SOURCE_ALIASES.items())
    return (
        f"(CASE WHEN contains({norm}, 'GR200') THEN 'GR200' WHEN {bare} = '' THEN {norm} "
        f"ELSE CASE replace({bare}, '_', '') {aliases} ELSE {bare} END END)"
    )


def read_number(x: str) -> str:
    t = strip(x)
    body = f"try_cast(replace(regexp_extract({t}, {quoted(T._MANTISSA)}), ',', '') AS DOUBLE)"
    signed = f"CASE WHEN regexp_matches({t}, {quoted(T.NEGATIVE_RE)}) THEN -{body} ELSE {body} END"
    return f"(CASE WHEN regexp_matches({t}, {quoted(T.NUMBER_RE)}) AND isfinite({body}) THEN {signed} END)"


def declared_numeric(x: str) -> str:
    t = f"lower({strip(x)})"
    return f"(CASE WHEN {t} NOT IN {listed(T.VALUE_NULL_TOKENS)} THEN {t} IN {listed(T.NUMERIC_MARKERS)} END)"


def path_key(x: str) -> str:
    t = f"regexp_replace(replace({strip(f'coalesce({x}, {quoted(str())})')}, '\\', '/'), '/+', '/', 'g')"
    return f"regexp_replace({t}, '^(?:\\./)+', '')"
