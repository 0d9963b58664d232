"""Attribute-value rows to one wide, typed row per entity and year.

Rows are reduced to one typed cell per (entity, year, attribute) before any wide shuffle and written as narrow typed tables,
partitioned by attribute block. The blocks' tables, which hold only keys that have a cell, are outer-joined to the spine of
all keys; all sides share one hash partitioning of the key. Nodes of a bounded number of blocks are built apart and joined
level by level.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.runtime import bounded, materialise, pick

#: Attributes in one narrow table; a block's unparsed cells are kept as bits of one BIGINT.
BLOCK = 48
#: The wide schema is planned on the driver; more attributes than this are refused rather than collected.
MAX_ATTRIBUTES = 20_000
#: Tables that one node of the join tree combines; wider trees get another level.
FAN = 8
#: What the text column of an attribute of both kinds is called.
TEXT_SUFFIX = "_TEXT"


def declared_types(panel: DataFrame) -> DataFrame:
    """(varname, year, is_numeric): the majority of the declared types of all rows; blank ones don't count, ties are text."""
    numeric = T.declared_numeric(F.col("DataType"))
    return (
        panel.select(T.varname(F.col("varname")).alias("varname"), "year", numeric.alias("num"))
        .groupBy("varname", "year")
        .agg(F.count_if(F.col("num")).alias("n_num"), F.count_if(~F.col("num")).alias("n_text"))
        .select("varname", "year", (F.col("n_num") > F.col("n_text")).alias("is_numeric"), "n_num", "n_text")
    )


def plan_attributes(types: DataFrame, block: int = BLOCK) -> list[tuple[str, bool, bool, int, int]]:
    """(varname, numeric, mixed, block, bit) for every column: an attribute that is numeric in all years is a numeric column,
    one that is in none a text column; one that is in some is ``mixed`` and has both.

    The names become the columns of the result, so their number is bounded by what a table can hold.
    """
    kinds = (
        types.where("varname <> ''").groupBy("varname").agg(F.bool_or("is_numeric").alias("some"), F.bool_and("is_numeric").alias("every")).orderBy("varname").limit(MAX_ATTRIBUTES + 1).collect()
    )
    if len(kinds) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes: these rows are no table")
    out, nxt = [], 0
    for numeric in (True, False):
        names = [(r.varname, r.some and not r.every) for r in kinds if (r.some if numeric else not r.every)]
        for i, (v, mixed) in enumerate(names):
            out.append((v, numeric, mixed, nxt + i // block, i % block))
        nxt += -(-len(names) // block)
    return out


def narrow_tables(panel: DataFrame, types: DataFrame, plan: list[tuple[str, bool, bool, int, int]]) -> DataFrame:
    """One typed cell per (UNITID, year, column), written to the shared folder partitioned by block.

    A numeric cell holds the number of the latest row whose value reads as one, a text cell the latest value that is not
    empty, beside a numeric column the latest that is no number (latest: by loaded_at, then row_id). ``unparsed`` marks cells
    of attributes declared numeric in that year with values of which none reads as a number. Repeats of a cell are combined
    before the shuffle.
    """
    spark = panel.sparkSession
    names = spark.createDataFrame(plan, "varname string, numeric boolean, mixed boolean, block int, bit int")
    rows = panel.where(F.col("UNITID").isNotNull() & F.col("year").isNotNull()).select(
        F.col("UNITID").cast("bigint").alias("UNITID"),
        F.col("year").cast("int").alias("year"),
        T.varname(F.col("varname")).alias("varname"),
        T.null_if_token(F.col("value")).alias("value"),
        T.recency(F.col("loaded_at"), F.col("row_id")).alias("at"),
    )
    known = names.join(types.select("varname", "year", "is_numeric"), "varname")
    # A row without a load time is older than any other.
    at = F.coalesce(F.col("at"), F.lit(-1).cast("decimal(38,0)"))

    def cells(numeric: bool) -> DataFrame:
        part = rows.join(bounded(known.where("numeric" if numeric else "not numeric")), ["varname", "year"])
        value = F.col("value") if numeric else F.when(~F.col("mixed") | T.read_number(F.col("value")).isNull(), F.col("value"))
        part = part.select("UNITID", "year", "block", "bit", "is_numeric", value.alias("value"), at.alias("at"))
        if not numeric:
            grouped = part.groupBy("UNITID", "year", "block", "bit").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.col("at"))).alias("text"))
            return grouped.select("UNITID", "year", "bit", F.lit(None).cast("double").alias("num"), "text", F.lit(False).alias("unparsed"), "block")
        num = T.read_number(F.col("value"))
        grouped = part.withColumn("num", num).groupBy("UNITID", "year", "block", "bit", "is_numeric").agg(
            F.max_by("num", F.when(F.col("num").isNotNull(), F.col("at"))).alias("num"), F.count("value").alias("n_value"), F.count("num").alias("n_number")
        )
        unparsed = F.col("is_numeric") & (F.col("n_value") > 0) & (F.col("n_number") == 0)
        return grouped.select("UNITID", "year", "bit", "num", F.lit(None).cast("string").alias("text"), unparsed.alias("unparsed"), "block")

    return materialise(cells(True).unionByName(cells(False)), "narrow", ["block"])


def _block_table(cells: DataFrame, block: int, members: list[tuple[str, bool, bool, int, int]]) -> DataFrame:
    """The narrow tables of one block beside each other: one grouped pass over the keys that have a cell in it."""
    slots: list[Column] = []
    for i, (_, numeric, _, _, bit) in enumerate(members):
        value = F.col("num" if numeric else "text")
        slots.append(F.max(F.when(F.col("bit") == bit, value)).alias(f"c{block}_{i}"))
    mask = F.bit_or(F.when(F.col("unparsed"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).otherwise(F.lit(0).cast("bigint")))
    return cells.where(F.col("block") == block).groupBy("UNITID", "year").agg(*slots, mask.alias(f"u{block}"))


def _outer_join(spine: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """All tables outer-joined to the spine; every side is hash-partitioned and sorted by the key, and the joined rows stay so."""
    return reduce(lambda a, t: a.join(t.hint("merge"), ["UNITID", "year"], "left"), tables, spine)


def wide_table(panel: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per (UNITID, year), one typed column per varname, and ``unparsed``: the varnames whose cell failed.

    ``panel`` needs UNITID, year, varname, value, DataType, loaded_at and row_id; other columns are ignored. Rows without
    UNITID or year or with a blank varname are left out (they still count for the declared type). Attributes that differ
    only in case or outer blanks are one. An empty panel gives UNITID, year and unparsed, with no row. Column names are
    the varnames as normalised; a varname that would clash with a key column gets underscores appended.

    Attributes that are numeric in some years only have a second column, with the suffix ``_TEXT``, for their values that are
    no numbers: every value that is not empty is in the table, but for repeats of a cell and for what ``unparsed`` lists.

    The join tree: the tables of a block hold only keys with a cell in it and are outer-joined to the spine of all keys, up to
    ``FAN`` at a time. A tree of more tables has its nodes written and joined level by level, so that no stage holds more than
    ``FAN`` sorted sides. The spine keeps the hash partitioning of the key, so no join of a node shuffles again; pairwise full
    outer joins would, as they lose it.
    """
    panel = pick(panel, "UNITID", "year", "varname", "value", "DataType", "loaded_at", "row_id")
    types = materialise(declared_types(panel), "types")
    plan = plan_attributes(types, block)
    cells = narrow_tables(panel, types, plan)
    spine = cells.select("UNITID", "year").distinct()
    blocks: dict[int, list] = {}
    for row in plan:
        blocks.setdefault(row[3], []).append(row)
    tables = [_block_table(cells, b, m) for b, m in blocks.items()]
    if not tables:
        return spine.withColumn("unparsed", F.array().cast("array<string>"))
    while len(tables) > FAN:
        nodes = [tables[i : i + FAN] for i in range(0, len(tables), FAN)]
        tables = [materialise(_outer_join(spine, n), "node") for n in nodes]
    wide = _outer_join(spine, tables)
    taken, columns = {"unitid", "year", "unparsed"}, []
    for b, members in blocks.items():
        for i, (name, numeric, mixed, *_) in enumerate(members):
            alias = name + TEXT_SUFFIX if mixed and not numeric else name
            while alias.lower() in taken:
                alias += "_"
            taken.add(alias.lower())
            columns.append(F.col(f"c{b}_{i}").alias(alias))
    failed = [_named_bits(f"u{b}", [m[0] for m in members]) for b, members in blocks.items() if members[0][1]]
    return wide.select("UNITID", "year", *columns, (F.concat(*failed) if failed else F.array().cast("array<string>")).alias("unparsed"))


def _named_bits(mask: str, names: list[str]) -> Column:
    """The names whose bit is set in a BIGINT column."""
    bits = F.coalesce(F.col(mask), F.lit(0).cast("bigint"))
    return F.filter(F.lit(names), lambda x, i: F.getbit(bits, i) == 1)


def melted(wide: DataFrame) -> DataFrame:
    """(UNITID, year, varname, num, text): the cells of a wide table that hold something, back in rows."""
    names = [c for c in wide.columns if c not in ("UNITID", "year", "unparsed")]
    number = {c for c, t in wide.dtypes if t == "double"}
    cell = lambda c: F.struct(F.lit(c).alias("varname"), F.col(f"`{c}`" if c in number else "_n").alias("num"), F.col(f"`{c}`" if c not in number else "_t").alias("text"))
    rows = wide.select("*", F.lit(None).cast("double").alias("_n"), F.lit(None).cast("string").alias("_t"))
    return rows.select("UNITID", "year", F.explode(F.array(*[cell(c) for c in names])).alias("c")).select("UNITID", "year", "c.*").where("num is not null or text is not null")


def unparsed_cells(wide: DataFrame) -> DataFrame:
    """(UNITID, year, varname) of the cells whose values are declared numeric and don't read as a number."""
    return wide.select("UNITID", "year", F.explode("unparsed").alias("varname"))
