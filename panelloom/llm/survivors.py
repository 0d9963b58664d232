"""One surviving record per group of repeats, put together field by field from the most current values.

Every field of a group has a partial order of currency over its rows. Load times are its first evidence: dated rows form a
chain, whose last member has no successor. Where no row of a field is dated, the evidence is learned: transitions between
successive values of dated groups give a precedence per attribute, which is closed transitively over the values in question;
values on a cycle don't precede each other. The row of a topologically latest value survives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions import text as T
from panelloom.operators.ranking import running_totals
from panelloom.runtime import bounded, materialise, pick

FIELDS = ("value", "varTitle", "longDescription", "imputation_value")
KEY = ["UNITID", "year", "varnumber", "source_file"]
_SHIFT = "1" + "0" * 19


def keyed(panel: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Rows that belong to a group, with normalised keys and null for empty field values.

    Rows without UNITID or varnumber are in no group. A null year or a blank source is a key like any other.
    """
    rows = pick(panel, "row_id", "UNITID", "year", "varnumber", "source_file", "loaded_at", *fields).select(
        "row_id", F.col("UNITID").cast("bigint").alias("UNITID"), F.col("year").cast("int").alias("year"),
        T.varnumber(F.col("varnumber")).alias("varnumber"), T.source_file(F.col("source_file")).alias("source_file"),
        *[T.null_if_token(F.col(f)).alias(f) for f in fields], T.recency(F.col("loaded_at"), F.col("row_id")).alias("_at"), "loaded_at",
    )
    return rows.where("UNITID is not null and varnumber is not null")


def _row_of(at: Column) -> Column:
    """The row id that a recency number ends in."""
    return (at % F.lit(_SHIFT).cast("decimal(20,0)")).cast("bigint")


def dated_choices(rows: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per group: its smallest row id, its size, and per field the id of the latest dated row that has it.

    Only fixed-width maxima are kept, so repeats are combined by hash before the shuffle, however large a group is.
    Equal load times go to the larger row id.
    """
    picks = [F.max(F.when(F.col(f).isNotNull(), F.col("_at"))).alias(f"_at_{f}") for f in fields]
    seen = [F.count(f).alias(f"_n_{f}") for f in fields]
    return rows.groupBy(*KEY).agg(F.min("row_id").alias("group_row_id"), F.count(F.lit(1)).alias("n_rows"), *picks, *seen)


def value_precedence(rows: DataFrame, fields: tuple[str, ...] = FIELDS, wanted: DataFrame | None = None) -> DataFrame:
    """(varnumber, field, old, new, support): learned from dated groups, kept in the direction seen more often.

    A group's distinct values of a field, ordered by when each was first loaded, give one transition per neighbouring
    pair: linear in the values of a group. They are placed by distributed ranks, so a hot group is no single task. ``wanted``
    restricts it to some (varnumber, field). Groups with a single value are dropped before the values are ordered.
    """
    long = rows.where("loaded_at is not null").select(
        *KEY, "loaded_at", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in fields])).alias("f")
    )
    long = long.select(*KEY, "loaded_at", "f.field", "f.v").where("v is not null")
    if wanted is not None:
        long = long.join(bounded(wanted), ["varnumber", "field"], "left_semi")
    same = [*KEY, "field"]
    values = long.groupBy(*same, "v").agg(F.min("loaded_at").alias("first_seen"))
    several = values.groupBy(*[F.col(c).alias(f"_{c}") for c in same]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    alike = lambda prefix: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in same])
    ranked = running_totals(values.join(several, alike("_"), "left_semi"), same, ["first_seen", "v"]).select(*same, "v", "position")
    later = ranked.select(*[F.col(c).alias(f"_{c}") for c in same], F.col("v").alias("new"), (F.col("position") - 1).alias("_position"))
    steps = ranked.join(later, alike("_") & (F.col("position") == F.col("_position")))
    low, high = F.least("v", "new"), F.greatest("v", "new")
    pairs = steps.groupBy("varnumber", "field", low.alias("a"), high.alias("b")).agg(
        F.sum(F.when(F.col("v") < F.col("new"), 1).otherwise(-1)).alias("net"), F.count(F.lit(1)).alias("support")
    )
    up = F.col("net") > 0
    return pairs.where("net <> 0").select(
        "varnumber", "field", F.when(up, F.col("a")).otherwise(F.col("b")).alias("old"), F.when(up, F.col("b")).otherwise(F.col("a")).alias("new"), "support"
    )


EDGE = ["varnumber", "field", "old", "new"]


def closed(values: DataFrame, precedence: DataFrame) -> DataFrame:
    """(varnumber, field, old, new): all pairs of ``values`` of which the second is reached from the first by learned steps.

    ``values``: distinct (varnumber, field, v). The search starts from these values only, takes one step of all of them at a
    time and ends when a step finds nothing new, so cycles end it too. Pairs that reach each other are left out: a cycle
    says nothing about which is later.
    """
    edges = precedence.select("varnumber", "field", F.col("old").alias("new"), F.col("new").alias("_to"))
    start = values.select("varnumber", "field", F.col("v").alias("old"), F.col("v").alias("new"))
    reached, front = None, start
    while True:
        step = front.join(edges, ["varnumber", "field", "new"])
        found = step.select("varnumber", "field", "old", F.col("_to").alias("new")).where("old <> new").distinct()
        front = materialise(found if reached is None else found.join(reached, EDGE, "left_anti"), "front")
        if front.isEmpty():
            break
        reached = front if reached is None else materialise(reached.unionByName(front), "reached")
    if reached is None:
        return front
    known = reached.join(values.withColumnRenamed("v", "new"), ["varnumber", "field", "new"], "left_semi").select(*EDGE)
    back = known.select("varnumber", "field", F.col("new").alias("old"), F.col("old").alias("new"))
    return known.join(back, EDGE, "left_anti")


def reasoned_choices(candidates: DataFrame, precedence: DataFrame) -> DataFrame:
    """(group_row_id, field, row_id) for groups whose candidates have no date.

    ``candidates``: (group_row_id, field, varnumber, v, row_id). The closed order between a group's values is its partial
    order; a value with no successor in the group is topologically latest. Among several, more predecessors win, then the
    balance of directly learned support, then the larger row id. Edges are looked up from the closed order, so the values of a
    group are never paired with each other.
    """
    one = materialise(candidates.groupBy("group_row_id", "field", "varnumber", "v").agg(F.max("row_id").alias("row_id")), "undated")
    values = one.select("varnumber", "field", "v").distinct()
    order = closed(values, precedence).withColumn("ordered", F.lit(1))
    direct = precedence.select(*EDGE, "support")
    known = order.join(direct, EDGE, "full_outer").fillna(0, ["ordered", "support"])
    mine = one.select("group_row_id", "field", "varnumber", F.col("v").alias("old"))
    theirs = one.select("group_row_id", "field", F.col("v").alias("new"))
    edges = mine.join(known, ["varnumber", "field", "old"]).join(theirs, ["group_row_id", "field", "new"], "left_semi")
    ends = edges.select("group_row_id", "field", F.col("old").alias("v"), F.col("ordered").alias("o"), F.lit(0).alias("i"), (-F.col("support")).alias("s")).unionByName(
        edges.select("group_row_id", "field", F.col("new").alias("v"), F.lit(0).alias("o"), F.col("ordered").alias("i"), F.col("support").alias("s"))
    )
    degree = ends.groupBy("group_row_id", "field", "v").agg(F.sum("o").alias("o"), F.sum("i").alias("i"), F.sum("s").alias("s"))
    ranked = one.join(degree, ["group_row_id", "field", "v"], "left").fillna(0, ["o", "i", "s"])
    best = F.max(F.struct((F.col("o") == 0).alias("sink"), "i", "s", "row_id")).alias("best")
    return ranked.groupBy("group_row_id", "field").agg(best).select("group_row_id", "field", F.col("best.row_id").alias("row_id"))


def _undated(groups: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(group, field) with a dated row and its recency, and those of which no row is dated."""
    slots = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_at_{f}").alias("at"), F.col(f"_n_{f}").alias("n")) for f in fields])
    each = groups.select(*KEY, "group_row_id", F.explode(slots).alias("s")).select(*KEY, "group_row_id", "s.*").where("n > 0")
    return each.where("at is not null"), each.where("at is null").select(*KEY, "group_row_id", "field")


def _reasoned(rows: DataFrame, undated: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The choices of fields without a dated row. Only attributes that have such a field are learned about and looked up."""
    undated = materialise(undated, "open").select(*[F.col(c).alias(f"_{c}") for c in (*KEY, "field")], "group_row_id")
    wanted = undated.select(F.col("_varnumber").alias("varnumber"), F.col("_field").alias("field")).distinct()
    values = rows.select(*KEY, "row_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in fields])).alias("f"))
    values = values.select(*KEY, "row_id", "f.*").where("v is not null").join(bounded(wanted), ["varnumber", "field"], "left_semi")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*KEY, "field")])
    candidates = values.join(undated, same).select("group_row_id", "field", "varnumber", "v", "row_id")
    return reasoned_choices(candidates, materialise(value_precedence(rows, fields, wanted), "precedence"))


def choices(panel: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(group_row_id, field, row_id) for every group of two or more rows and every field that some row of it has.

    Null and null-like values never survive while another row has one. An empty panel gives no row. The last of a field's
    dated rows survives; a field without any dated row is settled by the learned order.
    """
    rows = keyed(panel, fields)
    groups = materialise(dated_choices(rows, fields).where("n_rows > 1"), "groups")
    dated, undated = _undated(groups, fields)
    return dated.select("group_row_id", "field", _row_of(F.col("at")).alias("row_id")).unionByName(_reasoned(rows, undated, fields))


def survivors(panel: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One record per group, single rows included: its key, group_row_id, n_rows and the surviving value of each field.

    One aggregate carries the value with its recency; only fields without a dated row are fetched by row.
    """
    rows = keyed(panel, fields)
    held = lambda f: F.max_by(f, F.when(F.col(f).isNotNull(), F.coalesce("_at", F.lit(-1).cast("decimal(38,0)")))).alias(f)
    picks = [F.max(F.when(F.col(f).isNotNull(), F.col("_at"))).alias(f"_at_{f}") for f in fields]
    groups = rows.groupBy(*KEY).agg(F.min("row_id").alias("group_row_id"), F.count(F.lit(1)).alias("n_rows"), *[held(f) for f in fields], *picks, *[F.count(f).alias(f"_n_{f}") for f in fields])
    groups = materialise(groups, "survivors")
    chosen = _reasoned(rows, _undated(groups.where("n_rows > 1"), fields)[1], fields)
    fetched = rows.select("row_id", *fields).join(chosen, "row_id").groupBy("group_row_id").agg(*[F.max(F.when(F.col("field") == f, F.col(f))).alias(f"_r_{f}") for f in fields])
    joined = groups.join(fetched, "group_row_id", "left")
    return joined.select("group_row_id", *KEY, "n_rows", *[F.coalesce(f"_r_{f}", f).alias(f) for f in fields])
