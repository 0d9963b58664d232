"""Ordered word rules that sort variables into components and families, as tables and as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelloom.functions.labels import first_match, has_any

# Components by source name (exact names, then prefixes), in order.
COMPONENT_SOURCES = [
    ("Admissions", ("ADM", "AL", "DRVADM"), ()),
    ("Student Financial Aid", ("SFA", "SFA_P", "SFAV"), ("F_FA",)),
    ("Enrollment / Student Profile", ("DRVEF", "EAP"), ("EF",)),
    ("Completions", ("CDEP", "DRVC", "CSTEM", "CUSTOMCG", "CUSTOMCGIDS"), ("C_",)),
    ("Graduation / Outcomes", ("DRVGR",), ("GR",)),
    ("Finance", ("DFR",), ("F_",)),
    ("Staff / Human Resources", ("DRVHR",), ("S_",)),
]
# Components by words in name and texts, in order.
COMPONENT_WORDS = [
    ("Student Financial Aid", ("PELL", "SCHOLARSHIP", "NET PRICE", "GRANT", "LOAN", "AID")),
    ("Costs / Price", ("TUITION", "ROOM", "BOARD", "PRICE", "COST OF ATTENDANCE", "APPLICATION FEE", "REQUIRED FEES", "RMBRD", "CHARGE")),
    ("Admissions", ("APPLICATION", "APPLICANT", "ADMISSION", "ADMIT", "ACCEPTANCE", "OPEN ADMISSIONS", "SELECTIVITY", "ACT", "SAT", "YIELD")),
    ("Graduation / Outcomes", ("GRADUATION RATE", "TRANSFER-OUT", "TRANSFER OUT", "OUTCOME", "COHORT DEFAULT", "RETENTION RATE")),
    ("Completions", ("COMPLETION", "AWARD", "DEGREE", "CERTIFICATE", "MAJOR", "FIELD OF STUDY", "PROGRAM OF STUDY")),
    ("Enrollment / Student Profile", ("ENROLLMENT", "HEADCOUNT", "FTE", "FULL-TIME", "PART-TIME", "RETENTION", "FIRST-TIME", "FIRST TIME", "RACE", "ETHNICITY", "RESIDENT", "FOREIGN")),
    ("Finance", ("REVENUE", "EXPENSE", "EXPENDITURE", "ASSET", "LIABILITY", "DEBT", "ENDOWMENT", "INSTRUCTION", "STUDENT SERVICES", "ACADEMIC SUPPORT", "AUXILIARY")),
    ("Staff / Human Resources", ("FACULTY", "STAFF", "EMPLOYEE", "SALARY", "PAYROLL", "TENURE")),
]
DIRECTORY_SOURCES = ("IC", "IC_AY", "IC_PY", "HD", "FLAGS", "KEYS", "ICMISSION")
# Families of a component by words, in order; the last entry of each has no words and takes the rest.
FAMILIES = {
    "Institution / Directory": [
        ("Location and geography", ("STATE", "COUNTY", "REGION", "FIPS", "CBSA", "LATITUDE", "LONGITUDE", "DISTRICT", "LOCALE")),
        ("System affiliation", ("SYSTEM", "BRANCH", "PARENT", "SYSTEM NAME")),
        ("Mission and institutional flags", ("HBCU", "TRIBAL", "LAND GRANT", "MEDICAL", "HOSPITAL", "POSTSECONDARY")),
        ("Control and offerings", ("CONTROL", "SECTOR", "LEVEL", "OFFER", "DEGREE", "OPEN ADMISSIONS")), ("Institution identity", ()),
    ],
    "Admissions": [
        ("Test scores", ("ACT", "SAT", "TEST")), ("Applications and admits", ("APPLICATION", "APPLICANT", "ADMIT", "ACCEPT", "ENROLLED")),
        ("Access and selectivity", ("OPEN ADMISSIONS", "SELECTIVITY", "YIELD", "ADMISSION RATE")), ("Other admissions", ()),
    ],
    "Costs / Price": [
        ("Room and board", ("ROOM", "BOARD", "RMBRD")), ("Application and ancillary fees", ("APPLICATION FEE", "APPLFEE")), ("Tuition and fees", ("TUITION", "FEE", "REQUIRED FEES")),
        ("Cost of attendance", ("PRICE", "COST OF ATTENDANCE", "TOTAL COST", "CHARGE")), ("Other price variables", ()),
    ],
    "Student Financial Aid": [
        ("Net price and aid composition", ("NET PRICE",)), ("Aid recipients and take-up", ("RECIPIENT", "NUMBER OF STUDENTS", "ANY AID", "RECEIVING")),
        ("Pell and federal grants", ("PELL", "FEDERAL GRANT")), ("Institutional grants", ("INSTITUTIONAL GRANT",)), ("Loans", ("LOAN",)), ("Grant aid and packaging", ()),
    ],
    "Enrollment / Student Profile": [
        ("Headcount and attendance", ("ENROLLMENT", "HEADCOUNT", "FTE", "FULL-TIME", "PART-TIME", "FIRST-TIME", "TRANSFER")),
        ("Student composition", ("RACE", "ETHNICITY", "WHITE", "BLACK", "HISPANIC", "ASIAN", "NONRESIDENT", "FOREIGN", "RESIDENT")),
        ("Retention and persistence", ("RETENTION", "PERSISTENCE")), ("Other enrollment profile", ()),
    ],
    "Completions": [("Fields of study", ("FIELD OF STUDY", "CIP", "STEM", "MAJOR")), ("Awards and completions", ())],
    "Graduation / Outcomes": [("Transfer and cohort outcomes", ("TRANSFER", "OUTCOME", "RETENTION")), ("Graduation rates", ())],
    "Finance": [
        ("Revenue", ("REVENUE",)), ("Expenditures and functional spending", ("EXPENSE", "EXPENDITURE", "INSTRUCTION", "ACADEMIC SUPPORT", "STUDENT SERVICES", "AUXILIARY")),
        ("Assets, liabilities, and debt", ("ASSET", "LIABILITY", "DEBT")), ("Endowment and investments", ("ENDOWMENT",)), ("Other finance", ()),
    ],
    "Staff / Human Resources": [("Salaries and payroll", ("SALARY", "PAYROLL", "WAGE")), ("Faculty profile", ("FACULTY",)), ("Staff counts and composition", ())],
    "Panel-only / custom": [("Panel-only / custom", ())],
}


def component(source: Column, text: Column) -> Column:
    """The component of a variable: by its source, else by words in its upper-case texts, else by what remains."""
    s, t = F.upper(F.coalesce(source, F.lit(""))), F.upper(F.coalesce(text, F.lit("")))

    def of_source(names: tuple[str, ...], prefixes: tuple[str, ...]) -> Column:
        test = s.isin(*names)
        for p in prefixes:
            test = test | s.startswith(p)
        return test

    rules = [(label, of_source(names, prefixes)) for label, names, prefixes in COMPONENT_SOURCES]
    rules += [(label, has_any(t, words)) for label, words in COMPONENT_WORDS]
    rules += [("Institution / Directory", s.isin(*DIRECTORY_SOURCES)), ("Costs / Price", s == "DRVIC"), ("Panel-only / custom", s == "")]
    return first_match(rules, "Custom / Derived / Other")


def family(group: Column, text: Column) -> Column:
    """The family of a variable within its component."""
    t = F.upper(F.coalesce(text, F.lit("")))
    rules = [(label, (group == g) & (has_any(t, words) if words else F.lit(True))) for g, entries in FAMILIES.items() for label, words in entries]
    return first_match(rules, "Custom / derived")


def _sql_any(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")" if words else "true"


def component_sql(s: str, t: str) -> str:
    """:func:`component` as SQL over upper-case expressions."""
    parts = [f"WHEN {s} IN ({', '.join(repr(n) for n in names)}){''.join(f' OR starts_with({s}, {p!r})' for p in prefixes)} THEN '{label}'" for label, names, prefixes in COMPONENT_SOURCES]
    parts += [f"WHEN {_sql_any(t, words)} THEN '{label}'" for label, words in COMPONENT_WORDS]
    parts += [f"WHEN {s} IN ({', '.join(repr(n) for n in DIRECTORY_SOURCES)}) THEN 'Institution / Directory'", f"WHEN {s} = 'DRVIC' THEN 'Costs / Price'", f"WHEN {s} = '' THEN 'Panel-only / custom'"]
    return "CASE " + " ".join(parts) + " ELSE 'Custom / Derived / Other' END"


def family_sql(g: str, t: str) -> str:
    """:func:`family` as SQL."""
    parts = [f"WHEN {g} = '{group}' AND {_sql_any(t, words)} THEN '{label}'" for group, entries in FAMILIES.items() for label, words in entries]
    return "CASE " + " ".join(parts) + " ELSE 'Custom / derived' END"
