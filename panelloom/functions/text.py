"""Column functions that normalise keys, tokens and numbers; all run inside the JVM.

Each one takes and returns a ``Column``; nulls give the stated result and nothing raises on odd input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three sets of null-like tokens.
VALUE_NULL_TOKENS = ("", ".", "nan", "none", "<na>", "na", "nat")
VARNUMBER_NULL_TOKENS = ("", "nan", "none", "<na>", "na", "nat")
TEXT_NULL_TOKENS = ("nan", "none", "<na>", "nat")

# The markers of a numeric declared type.
NUMERIC_MARKERS = ("cont", "continuous", "numeric", "number", "num", "int", "integer", "float", "double", "decimal")

# Short source names and the names they stand for.
SOURCE_ALIASES = {
    "HD": "HD", "IC": "IC", "ICAY": "IC_AY", "ICPY": "IC_PY", "ICCAMPUSES": "IC_CAMPUSES", "ICPCCAMPUSES": "IC_PCCAMPUSES",
    "ADM": "ADM", "AL": "AL", "CA": "C_A", "CB": "C_B", "CC": "C_C", "CDEP": "CDEP", "COST": "COST", "EAP": "EAP", "EFA": "EFA",
    "EFADIST": "EFA_DIST", "EFB": "EFB", "EFC": "EFC", "EFCP": "EFCP", "EFFY": "EFFY", "EFFYDIST": "EFFY_DIST", "EFIA": "EFIA",
    "EFIB": "EFIB", "EFIC": "EFIC", "EFID": "EFID", "FF": "F_F", "FFA": "F_FA", "FFAF": "F_FA_F", "FFAG": "F_FA_G", "GR": "GR",
    "GRPELLSSL": "GR_PELL_SSL", "OM": "OM", "SALA": "SAL_A", "SALALT": "SAL_A_LT", "SALB": "SAL_B", "SALFACULTY": "SAL_FACULTY",
    "SALIS": "SAL_IS", "SABD": "S_ABD", "SCN": "S_CN", "SF": "S_F", "SG": "S_G", "SIS": "S_IS", "SNH": "S_NH", "SOC": "S_OC",
    "SSIS": "S_SIS", "SFA": "SFA", "SFAV": "SFAV", "DRVADM": "DRVADM", "DRVAL": "DRVAL", "DRVC": "DRVC", "DRVEF": "DRVEF",
    "DRVEF12": "DRVEF12", "DRVF": "DRVF", "DRVGR": "DRVGR", "DRVHR": "DRVHR", "DRVIC": "DRVIC", "DRVOM": "DRVOM",
}

#: What counts as white space at the ends of a text.
SPACES = "\u0020\u0009\u000a\u000d\u000c\u000b\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ_"

_MANTISSA = r"(?:(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
#: One finite number in digits with at most one sign or pair of parentheses, a currency mark and a per-cent sign.
NUMBER_RE = (
    rf"^(?:[+-]?(?:\$|USD )?{_MANTISSA}%?|(?:\$|USD )[+-]{_MANTISSA}%?"
    rf"|(?:\$|USD )?{_MANTISSA}(?:-%?|%-)|\((?:\$|USD )?{_MANTISSA}%?\)%?)$"
)
#: A negative reading of a text that matches NUMBER_RE.
NEGATIVE_RE = r"^(?:\$|USD )?[-(]|-%?$"


def strip(c: Column) -> Column:
    """``c`` without white space of any kind at its ends; null stays null."""
    return F.btrim(c, F.lit(SPACES))


def null_if_token(c: Column, tokens: tuple[str, ...] = VALUE_NULL_TOKENS) -> Column:
    """The stripped text, or null if it is one of ``tokens`` in any case."""
    t = strip(c)
    return F.when((F.octet_length(t) > max(map(len, tokens))) | ~F.lower(t).isin(*tokens), t)


def is_empty(c: Column) -> Column:
    """True for null and for null-like tokens."""
    return null_if_token(c).isNull()


def varname(c: Column) -> Column:
    """Trimmed, upper case; null gives an empty string."""
    return F.coalesce(F.upper(strip(c)), F.lit(""))


def varnumber(c: Column) -> Column:
    """All white space removed, digits padded to 8 and never cut; null-like tokens give null."""
    t = F.regexp_replace(c, rf"[{SPACES}]+", "")
    padded = F.when(t.rlike("^[0-9]{1,7}$"), F.lpad(t, 8, "0")).otherwise(t)
    return F.when(~F.lower(t).isin(*VARNUMBER_NULL_TOKENS), padded)


def token(c: Column) -> Column:
    """Upper case, runs of other characters than letters and digits squeezed to one ``_``, none at the ends; null gives ''."""
    t = F.upper(strip(F.coalesce(c, F.lit(""))))
    return F.btrim(F.regexp_replace(t, "[^A-Z0-9]+", "_"), F.lit("_"))


def text_key(c: Column) -> Column:
    """Like :func:`token`, in lower case."""
    return F.lower(token(c))


def stem(c: Column) -> Column:
    """The last part of a path without its last extension."""
    last = F.regexp_extract(c, r"([^/]*)/*$", 1)
    return F.regexp_replace(last, r"(?<=[^.])\.[^.]+$", "")


def source_file(c: Column) -> Column:
    """The canonical name of a source table: extension and digits dropped, alias resolved; null and blank give ''.

    Names that are already plain upper-case letters and single underscores, and no alias, skip the regular expressions.
    """
    aliases = F.create_map(*[F.lit(x) for kv in SOURCE_ALIASES.items() for x in kv])

    def named(norm: Column) -> Column:
        bare = F.btrim(F.regexp_replace(F.regexp_replace(norm, "[0-9]+", ""), "_+", "_"), F.lit("_"))
        return F.when(norm.contains("GR200"), F.lit("GR200")).otherwise(
            _let(bare, lambda b: F.when(b == "", norm).otherwise(F.coalesce(F.try_element_at(aliases, F.translate(b, "_", "")), b)))
        )

    plain = (F.translate(c, _LETTERS, "") == "") & ~c.contains("__") & ~c.startswith("_") & ~c.endswith("_") & (c != "")
    return F.when(plain & ~F.translate(c, "_", "").isin(*SOURCE_ALIASES), c).otherwise(_let(token(stem(F.coalesce(c, F.lit("")))), named))


def _let(c: Column, f) -> Column:
    """``f(c)`` with ``c`` worked out once, however often ``f`` uses it, and outside of the generated code of the common path:
    a method that grows too large is never compiled by the JVM."""
    return F.transform(F.array(c), f)[0]


def reads_as_number(c: Column) -> Column:
    """Whether a text is one finite number, as NUMBER_RE has it; null gives false."""
    return F.coalesce(read_number(c).isNotNull(), F.lit(False))


def read_number(c: Column) -> Column:
    """The number that a text reads as, or null. A trailing ``%`` is read over: ``5%`` is 5."""
    t = strip(c)
    body = F.translate(F.regexp_extract(t, _MANTISSA, 0), ",", "").try_cast("double")
    signed = F.when(t.rlike(NEGATIVE_RE), -body).otherwise(body)
    fine = F.when(t.rlike(NUMBER_RE), signed)
    return F.when(F.abs(fine) < F.lit(float("inf")), fine)


def declared_numeric(c: Column) -> Column:
    """True for a numeric marker, false for another DataType, null for a blank one."""
    t = F.lower(strip(c))
    return F.when(~t.isin(*VALUE_NULL_TOKENS), t.isin(*NUMERIC_MARKERS))


def path_key(c: Column) -> Column:
    """Trimmed, forward slashes, none doubled, no leading ``./``; null gives ''."""
    t = F.regexp_replace(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"\\", "/"), "/+", "/")
    return F.regexp_replace(t, r"^(?:\./)+", "")


def source_key(c: Column) -> Column:
    """A document source: lower case, outer blanks dropped, ``-`` as ``_``; null stays null."""
    return F.translate(F.lower(strip(c)), "-", "_")


def recency(loaded_at: Column, row_id: Column) -> Column:
    """One fixed-width number that sorts as (loaded_at, row_id), so that ``max_by`` stays a hash aggregate.

    Null where loaded_at is null. Row ids must lie in the BIGINT range.
    """
    micros = F.unix_micros(loaded_at.cast("timestamp")).cast("decimal(18,0)")
    return (micros * F.lit("1" + "0" * 19).cast("decimal(20,0)") + row_id.cast("decimal(19,0)")).cast("decimal(38,0)")


def read_plain_double(c: Column) -> Column:
    """``try_cast`` to a double without the engine's extras: no type suffixes, no digit separators; null on failure."""
    return F.when(~c.rlike("[dDfF]$|_"), c.try_cast("double"))
