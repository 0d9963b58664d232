"""Schemas that drift between files: minimum-cost edit scripts between schema trees, and the projections they compile to.

A delivered file is a tree with two branches: its names with the numbers below each, and its numbers with the names below
each. Names and numbers are keys, so one that stands on both sides stays itself; what else becomes what is decided by cost.
Every reported change is an operation of the script, and the scripts chain the names of a source through its files.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from panelloom.functions import text as T
from panelloom.operators.orphans import PARENT_KEY, parent_delta
from panelloom.runtime import bounded, materialise, pick

# Costs of the edit operations. A renamed or renumbered field is cheaper than a delete and an add.
ADD = DELETE = 1.0
RELABEL = 0.6
RETYPE = 0.3
MOVE = 0.9


@dataclass
class Node:
    """A schema node: a label, an optional number that stays when the label changes, a type, and children.

    The children of a ``keyed`` node are known by their label: one found on both sides is matched with itself.
    """

    label: str
    ident: str = ""
    kind: str = ""
    children: list[Node] = field(default_factory=list)
    keyed: bool = False

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children)


def schema_tree(kind: DataType, label: str = "", ident: str = "") -> Node:
    """The tree of a Spark schema; arrays and maps are nodes with their element below. A field's ``id`` in its metadata is its number."""
    if isinstance(kind, StructType):
        return Node(label, ident, "struct", [schema_tree(f.dataType, f.name, str((f.metadata or {}).get("id", ""))) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return Node(label, ident, "array", [schema_tree(kind.elementType, "element")])
    if isinstance(kind, MapType):
        return Node(label, ident, "map", [schema_tree(kind.keyType, "key"), schema_tree(kind.valueType, "value")])
    return Node(label, ident, kind.simpleString())


def assignment(cost: list[list[float]]) -> list[int]:
    """The column for each row that makes the sum least (shortest augmenting paths; needs rows <= columns)."""
    n, m, inf = len(cost), len(cost[0]) if cost else 0, float("inf")
    u, v, match = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, back, done = [inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while match[j0]:
            done[j0], step, j1 = True, inf, 0
            for j in range(1, m + 1):
                if not done[j]:
                    now = cost[match[j0] - 1][j - 1] - u[match[j0]] - v[j]
                    if now < least[j]:
                        least[j], back[j] = now, j0
                    if least[j] < step:
                        step, j1 = least[j], j
            for j in range(m + 1):
                if done[j]:
                    u[match[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            j0 = j1
        while j0:
            match[j0] = match[back[j0]]
            j0 = back[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def _own_cost(a: Node, b: Node) -> float:
    """Of turning one node into another; nodes that share neither label nor number, or whose shapes differ, don't match."""
    shared = a.label == b.label or (a.ident != "" and a.ident == b.ident)
    shaped = bool(a.children) == bool(b.children)
    if a.keyed and b.keyed and not {c.label for c in a.children} & {c.label for c in b.children}:
        return float("inf")
    if not shaped or (not shared and not a.children):
        return float("inf")
    return RELABEL * (a.label != b.label) + RELABEL * (a.ident != b.ident) + RETYPE * (a.kind != b.kind)


def _match(a: Node, b: Node) -> tuple[float, list[tuple[Node | None, Node | None]]]:
    """Least cost of turning the children of ``a`` into those of ``b``, and the pairs that do it, at every depth."""
    if a.keyed and b.keyed:
        return _match_keyed(a, b)
    same = {(c.label, c.ident): c for c in b.children if not c.children}
    pairs: list[tuple[Node | None, Node | None]] = []
    left, used = [], set()
    for c in a.children:  # nodes alike in label and number match at the least possible cost
        twin = None if c.children else same.get((c.label, c.ident))
        if twin is not None and id(twin) not in used:
            used.add(id(twin))
            pairs.append((c, twin))
        else:
            left.append(c)
    right = [c for c in b.children if id(c) not in used]
    total = sum(_own_cost(x, y) for x, y in pairs)
    if not left or not right:
        pairs += [(c, None) for c in left] + [(None, c) for c in right]
        return total + DELETE * sum(c.size() for c in left) + ADD * sum(c.size() for c in right), pairs
    big = 1e9
    below: dict[tuple[int, int], tuple[float, list]] = {}
    table = []
    for i, x in enumerate(left):
        row = []
        for j, y in enumerate(right):
            own = _own_cost(x, y)
            if own != float("inf") and x.children:
                below[i, j] = _match(x, y)
                own += below[i, j][0]
            row.append(min(own, big))
        row += [DELETE * x.size() if k == i else big for k in range(len(left))]
        table.append(row)
    for k in range(len(right)):
        table.append([ADD * right[k].size() if j == k else big for j in range(len(right))] + [0.0] * len(left))
    chosen = assignment(table)
    met = set()
    for i, x in enumerate(left):
        j = chosen[i]
        if j < len(right) and table[i][j] < min(big, DELETE * x.size() + ADD * right[j].size()):
            met.add(j)
            pairs.append((x, right[j]))
            pairs += below.get((i, j), (0, []))[1]
            total += table[i][j]
        else:
            pairs.append((x, None))
            total += DELETE * x.size()
    for j, y in enumerate(right):
        if j not in met:
            pairs.append((None, y))
            total += ADD * y.size()
    return total, pairs


def _match_keyed(a: Node, b: Node) -> tuple[float, list[tuple[Node | None, Node | None]]]:
    """The same where labels are keys: shared ones match, the rest by least cost.

    Of the rest, leaves may become each other, as they share their parent; inner nodes only if they share a child. Nodes
    that can't reach each other by shared children are settled apart, so the tables stay small.
    """
    theirs = {c.label: c for c in b.children}
    mine = {c.label for c in a.children}
    pairs: list[tuple[Node | None, Node | None]] = []
    total = 0.0
    for x in a.children:
        if (y := theirs.get(x.label)) is not None:
            cost, below = _match(x, y)
            total += cost + RETYPE * (x.kind != y.kind)
            pairs += [(x, y), *below]
    left = [c for c in a.children if c.label not in theirs]
    right = [c for c in b.children if c.label not in mine]
    if not any(c.children for c in (*left, *right)):
        both = min(len(left), len(right))
        pairs += list(zip(left[:both], right[:both])) + [(c, None) for c in left[both:]] + [(None, c) for c in right[both:]]
        return total + RELABEL * both + DELETE * (len(left) - both) + ADD * (len(right) - both), pairs
    for some_left, some_right in _components(left, right):
        rest_a, rest_b = Node("", children=some_left), Node("", children=some_right)
        cost, more = _match(rest_a, rest_b)
        total += cost
        pairs += more
    return total, pairs


def _components(left: list[Node], right: list[Node]) -> list[tuple[list[Node], list[Node]]]:
    """Groups of nodes linked by shared child labels."""
    root: dict[tuple, tuple] = {}

    def find(x: tuple) -> tuple:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for side, nodes in enumerate((left, right)):
        for k, node in enumerate(nodes):
            for c in node.children:
                root[find((side, k))] = find(("child", c.label))
            find((side, k))
    out: dict[tuple, tuple[list, list]] = {}
    for side, nodes in enumerate((left, right)):
        for k, node in enumerate(nodes):
            out.setdefault(find((side, k)), ([], []))[side].append(node)
    return list(out.values())


def edit_script(a: Node, b: Node) -> list[tuple[str, Node | None, Node | None]]:
    """Operations that turn tree ``a`` into ``b``: add, delete, rename, renumber, retype, and move for a node that is
    deleted under one parent and added, alike, under another."""
    _, pairs = _match(a, b)
    gone = [x for x, y in pairs if y is None and x is not None]
    come = [y for x, y in pairs if x is None and y is not None]
    ops: list[tuple[str, Node | None, Node | None]] = []
    for x in [] if a.keyed else list(gone):
        twin = next((y for y in come if (x.ident and x.ident == y.ident) or (x.label == y.label and x.kind == y.kind)), None)
        if twin is not None and MOVE < DELETE * x.size() + ADD * twin.size():
            ops.append(("move", x, twin))
            gone.remove(x)
            come.remove(twin)
    ops += [("delete", x, None) for x in gone] + [("add", None, y) for y in come]
    for x, y in pairs:
        if x is None or y is None:
            continue
        if x.label != y.label:
            ops.append(("rename", x, y))
        if x.ident != y.ident:
            ops.append(("renumber", x, y))
        if x.kind != y.kind:
            ops.append(("retype", x, y))
    return ops


def file_schemas(panel: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(source_file, year, varname, varnumber, is_numeric): the fields of each file, from the panel rows that resolve.

    Rows are counted by their raw spellings first, map-side, so that keys are normalised once per spelling and not once per
    row; the result has one row per field of a file, whatever the number of rows.
    Files are metadata: the size of the result follows the number of files and fields.
    """
    raw = ["source_file", "varnumber", "year", "varname", "DataType"]
    spellings = pick(panel, *raw).groupBy(*raw).agg(F.count(F.lit(1)).alias("n"))
    numeric = T.declared_numeric(F.col("DataType"))
    rows = spellings.select(
        T.source_file(F.col("source_file")).alias("source_file"), T.varnumber(F.col("varnumber")).alias("varnumber"), F.col("year").cast("int").alias("year"),
        T.varname(F.col("varname")).alias("varname"), F.when(numeric, F.col("n")).otherwise(0).alias("num"), F.when(~numeric, F.col("n")).otherwise(0).alias("txt"),
    )
    index = bounded(parent_delta(dictionary).select(*PARENT_KEY))
    fields = (
        rows.where("varname <> ''").groupBy("source_file", "year", "varname", "varnumber")
        .agg(F.sum("num").alias("n_num"), F.sum("txt").alias("n_text")).join(index, PARENT_KEY)
    )
    of_name = Window.partitionBy("source_file", "year", "varname")
    n, m = F.sum("n_num").over(of_name), F.sum("n_text").over(of_name)
    return fields.select("source_file", "year", "varname", "varnumber", F.when(n + m > 0, n > m).alias("is_numeric"))


def _tree(rows: pd.DataFrame, label: str) -> Node:
    """The tree of a file: names with their numbers and types, and numbers with their names."""
    kinds = {True: "numeric", False: "text"}
    names: dict[str, Node] = {}
    numbers: dict[str, Node] = {}
    for v, n, k in sorted(zip(rows.varname, rows.varnumber, rows.is_numeric), key=lambda x: (x[0], x[1])):
        names.setdefault(v, Node(v, "", kinds.get(k, ""), keyed=True)).children.append(Node(n))
        numbers.setdefault(n, Node(n, keyed=True)).children.append(Node(v))
    return Node(label, "", "file", [Node("names", children=list(names.values()), keyed=True), Node("numbers", children=list(numbers.values()), keyed=True)], keyed=True)


def classify(a: Node, b: Node) -> list[tuple[str, str]]:
    """(change, varname) of the operations of the edit script from file ``a`` to file ``b``.

    A name put below a number that stays: renamed. A number put below a name that stays: renumbered. A name and a number
    below it that both come (as new nodes or under a new label): added; that both go: removed. A name with another type:
    type_changed.
    """
    up_a, up_b = _parents(a), _parents(b)
    come: dict[str, dict[str, Node]] = {"names": {}, "numbers": {}}
    gone: dict[str, dict[str, Node]] = {"names": {}, "numbers": {}}
    leaves, out = [], set()
    for op, x, y in edit_script(a, b):
        above = up_b[id(y)] if y is not None else up_a[id(x)]
        if above.label in come and above.kind == "" and (id(above) in (id(a.children[0]), id(a.children[1]), id(b.children[0]), id(b.children[1]))):
            if op in ("add", "rename"):
                come[above.label][y.label] = y
            if op in ("delete", "rename"):
                gone[above.label][x.label] = x
            if op == "retype" and above.label == "names" and x.label == y.label and x.kind and y.kind:
                out.add(("type_changed", y.label))
        elif op in ("add", "rename"):
            leaves.append((up_b[id(above)].label, above.label, y.label))
    for branch, key, leaf in leaves:
        if branch == "numbers" and key not in come["numbers"]:
            out.add(("renamed", leaf))
        if branch == "names" and key not in come["names"]:
            out.add(("renumbered", key))
    for change, moved in (("added", come), ("removed", gone)):
        out |= {(change, v) for v, node in moved["names"].items() if any(n.label in moved["numbers"] for n in node.children)}
    return sorted(out)


def _parents(tree: Node) -> dict[int, Node]:
    out = {}
    for c in tree.children:
        out[id(c)] = tree
        out |= _parents(c)
    return out


def changes(schemas: DataFrame) -> DataFrame:
    """(source_file, year, change, varname): each file against the next earlier one of its source.

    Every pair of neighbouring files is one group, so the pairs are compared in parallel; a group holds two schemas.
    The first file of a source has no change. Without files the result is empty.
    """
    schemas = materialise(schemas, "schemas")
    files = schemas.select("source_file", "year").distinct()
    follow = files.withColumn("later", F.lead("year").over(Window.partitionBy("source_file").orderBy("year")))
    older = schemas.join(follow.where("later is not null"), ["source_file", "year"]).select("source_file", F.col("later").alias("at"), F.lit(0).alias("side"), "varname", "varnumber", "is_numeric")
    newer = schemas.select("source_file", F.col("year").alias("at"), F.lit(1).alias("side"), "varname", "varnumber", "is_numeric")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        source, year = key
        if not (rows.side == 0).any():
            found = []
        else:
            found = classify(_tree(rows[rows.side == 0], source), _tree(rows[rows.side == 1], source))
        return pd.DataFrame([(source, year, c, v) for c, v in found], columns=["source_file", "year", "change", "varname"], dtype=object)

    return older.unionByName(newer).groupBy("source_file", "at").applyInPandas(compare, "source_file string, year int, change string, varname string")


def projections(schemas: DataFrame) -> DataFrame:
    """(source_file, year, varname, field, field_numeric): what each file's column is called in the one table.

    The scripts between neighbouring files chain the names of a source; a chain bears its newest name, and a field has the
    type that the newest file with it declares (of several names, the last in order). Grouped by source: a group holds the
    schemas of one source, not its rows.
    """

    def chain(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        (source,) = key
        ids: dict[tuple[int, str], int] = {}
        newest: dict[int, str] = {}
        kinds: dict[tuple[int, str], str] = {}
        before, at, n = None, 0, 0
        for year in sorted(rows.year.unique()):
            now = _tree(rows[rows.year == year], source)
            carried = {}
            if before is not None:
                for x, y in _match(before.children[0], now.children[0])[1]:
                    if x is not None and y is not None and x.keyed:
                        carried[y.label] = ids[at, x.label]
            for c in now.children[0].children:
                if c.label not in carried:
                    carried[c.label], n = n, n + 1
                ids[year, c.label] = carried[c.label]
                newest[carried[c.label]] = c.label
                kinds[year, c.label] = c.kind
            before, at = now, year
        field = {k: newest[i] for k, i in ids.items()}
        last = {field[k]: kinds[k] for k in sorted(ids)}
        out = [(source, y, v, f, last[f] == "numeric") for (y, v), f in field.items()]
        return pd.DataFrame(out, columns=["source_file", "year", "varname", "field", "field_numeric"], dtype=object)

    return schemas.groupBy("source_file").applyInPandas(chain, "source_file string, year int, varname string, field string, field_numeric boolean")


def consistent(panel: DataFrame, dictionary: DataFrame) -> DataFrame:
    """All files in one table: every row of the panel, under the field and type that its file's projection gives.

    ``number`` holds the value of numeric fields, ``text`` that of others and what does not read as a number. Rows whose name
    is no field of their file (nothing of it resolves) keep their own name as text and are marked not ``resolved``: no row is
    lost.
    """
    plan = bounded(materialise(projections(file_schemas(panel, dictionary)), "projections"))
    value = T.null_if_token(F.col("value"))
    rows = pick(panel, "row_id", "UNITID", "year", "source_file", "varname", "value").select(
        "row_id", "UNITID", F.col("year").cast("int").alias("year"), T.source_file(F.col("source_file")).alias("source_file"),
        T.varname(F.col("varname")).alias("varname"), value.alias("value"),
    )
    number = F.when(F.col("field_numeric"), T.read_number(F.col("value")))
    return rows.join(plan, ["source_file", "year", "varname"], "left").select(
        "row_id", "UNITID", "year", "source_file", F.coalesce("field", "varname").alias("field"), F.coalesce("field_numeric", F.lit(False)).alias("field_numeric"),
        number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"), F.col("field").isNotNull().alias("resolved"),
    )


def unify(frames: list[DataFrame]) -> tuple[DataFrame, list[tuple[int, str, str]]]:
    """Tables of drifting schemas, oldest first, as one table, and (position, operation, field path) of each change.

    The scripts between neighbouring schemas chain fields, at any depth of structs, and compile to one projection per table:
    a field bears its newest name and type, one that a table lacks is null, and values that don't fit the newest type are
    null by ``try_cast``. Fields that were removed stay, behind the newest ones. Arrays and maps are cast as a whole.
    """
    trees = [schema_tree(f.schema) for f in frames]
    ids: list[dict[tuple[str, ...], int]] = []
    report: list[tuple[int, str, str]] = []
    last: dict[int, tuple[tuple[str, ...], DataType]] = {}
    n = 0
    for k, (frame, tree) in enumerate(zip(frames, trees)):
        own = _paths(tree)
        carried: dict[tuple[str, ...], int] = {}
        if k:
            was = {id(x): p for p, x in _paths(trees[k - 1]).items()}
            now = {id(x): p for p, x in own.items()}
            script = edit_script(trees[k - 1], tree)
            report += [(k, op, ".".join(now[id(y)] if id(y) in now else was.get(id(x), ()))) for op, x, y in script if id(y) in now or id(x) in was]
            pairs = _match(trees[k - 1], tree)[1] + [(x, y) for op, x, y in script if op == "move"]
            carried = {now[id(y)]: ids[k - 1][was[id(x)]] for x, y in pairs if id(x) in was and id(y) in now}
        mine = {}
        for p in own:
            if p not in carried:
                carried[p], n = n, n + 1
            mine[p] = carried[p]
            last[mine[p]] = (p, _type_at(frame.schema, p))
        ids.append(mine)
    # Newest fields first; an id is placed under the id of its parent in the newest schema that has it.
    where = {i: p for i, (p, _) in last.items()}
    order = sorted(last, key=lambda i: (next(-k for k in range(len(ids) - 1, -1, -1) if i in ids[k].values()), [*ids[-1]].index(where[i]) if where[i] in ids[-1] else i))

    def column(frame: int, i: int, taken: tuple[str, ...]):
        at = next((p for p, j in ids[frame].items() if j == i), None)
        kind = last[i][1]
        if isinstance(kind, StructType):
            below = [j for j in order if where[j][:-1] == where[i]]
            return F.struct(*[column(frame, j, ()) for j in below]).alias(where[i][-1])
        got = F.col(".".join(f"`{x}`" for x in at)) if at else F.lit(None)
        same = at is not None and _type_at(frames[frame].schema, at) == kind
        return (got if same else got.cast(kind) if isinstance(kind, (ArrayType, MapType)) else got.try_cast(kind)).alias(where[i][-1])

    top, names = [], set()
    for i in order:
        if len(where[i]) == 1 and where[i][0].lower() not in names:
            names.add(where[i][0].lower())
            top.append(i)
    return reduce(DataFrame.unionAll, [f.select(*[column(k, i, ()) for i in top]) for k, f in enumerate(frames)]), report


def _paths(tree: Node, at: tuple[str, ...] = ()) -> dict[tuple[str, ...], Node]:
    """The nodes below a struct by their path; elements of arrays and maps are part of their field."""
    out = {}
    for c in tree.children:
        out[(*at, c.label)] = c
        if c.kind == "struct":
            out |= _paths(c, (*at, c.label))
    return out


def _type_at(kind: DataType, path: tuple[str, ...]) -> DataType:
    for p in path:
        kind = kind[p].dataType
    return kind
