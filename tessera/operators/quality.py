"""Distributed data-quality validators (table constraints re-aimed as checks).

Each validator returns the violating rows plus a ``rule`` column; nothing is
collected. SQL constraint semantics are kept:

* CHECK passes when the predicate is TRUE or NULL;
* NOT NULL fails only on NULL;
* UNIQUE ignores rows with a NULL key part (NULLs are distinct); with an
  arrival column, the first row of a key is accepted and later ones rejected;
* FOREIGN KEY passes on a NULL reference;
* a view's check option needs the predicate to be TRUE.

Uniqueness and reference checks are grouped aggregates and equi joins, so a
hot key costs one aggregate row, never a per-key sort in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

RULE = "rule"


def check(df: DataFrame, rule: str, predicate: Column) -> DataFrame:
    """CHECK (predicate): rows where it is FALSE (NULL passes)."""
    return df.where(~F.coalesce(predicate, F.lit(True))).withColumn(RULE, F.lit(rule))


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NOT NULL on each column: one output row per (row, NULL column)."""
    parts = [df.where(F.col(c).isNull()).withColumn(RULE, F.lit(f"not_null:{c}")) for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _non_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def unique(df: DataFrame, cols: Sequence[str], arrival: str | None = None,
           rule: str | None = None) -> DataFrame:
    """UNIQUE (cols): rows that collide on a fully non-NULL key.

    Without ``arrival`` every row of a duplicated key is reported. With it,
    the earliest arrival per key is accepted and the later rows are reported
    (as a sequence of single-row INSERTs would behave).
    """
    cols = list(cols)
    rule = rule or f"unique:{','.join(cols)}"
    keyed = _non_null_keys(df, cols)
    renamed = [f"__u{i}" for i in range(len(cols))]
    stats = keyed.groupBy(*[F.col(c).alias(r) for c, r in zip(cols, renamed)]).agg(
        F.count(F.lit(1)).alias("__n"),
        *([F.min(arrival).alias("__first")] if arrival else []))
    dups = stats.where(F.col("__n") > 1)
    cond = [F.col(c) == F.col(r) for c, r in zip(cols, renamed)]
    out = keyed.join(dups, cond, "inner")
    if arrival:
        out = out.where(F.col(arrival) > F.col("__first"))
    return out.drop(*renamed, "__n", "__first").withColumn(RULE, F.lit(rule))


def primary_key(df: DataFrame, cols: Sequence[str], arrival: str | None = None) -> DataFrame:
    """PRIMARY KEY = NOT NULL on every part + UNIQUE."""
    return not_null(df, cols).unionByName(unique(df, cols, arrival, rule=f"primary_key:{','.join(cols)}"))


def unique_where(df: DataFrame, cols: Sequence[str], predicate: Column, arrival: str | None = None
                 ) -> DataFrame:
    """Conditional UNIQUE (a partial unique index): only rows matching ``predicate``."""
    return unique(df.where(F.coalesce(predicate, F.lit(False))), cols, arrival,
                  rule=f"unique_where:{','.join(cols)}")


def foreign_key(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """FOREIGN KEY (fk) REFERENCES parent (pk): non-NULL references without a parent."""
    fk, pk = list(fk), list(pk)
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(pk)]).distinct()
    cond = [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(fk)]
    return (_non_null_keys(child, fk).join(keys, cond, "left_anti")
            .withColumn(RULE, F.lit(f"foreign_key:{','.join(fk)}")))


def in_domain(df: DataFrame, col: str, allowed: Sequence) -> DataFrame:
    """CHECK (col IN (...))."""
    return check(df, f"domain:{col}", F.col(col).isin(*allowed))


def matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """CHECK (col ~ pattern)."""
    return check(df, f"pattern:{col}", F.col(col).rlike(pattern))


def delete_restrict(requested: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str]]
                    ) -> DataFrame:
    """ON DELETE RESTRICT: label each requested parent ``deleted`` or ``refused``.

    A parent with at least one child row in any restricting table is refused.
    """
    refs = None
    for name, (child, fk) in children.items():
        k = child.select(F.col(fk).alias("__ref")).where(F.col("__ref").isNotNull())
        refs = k if refs is None else refs.unionByName(k)
    referenced = refs.distinct().withColumn("__has_child", F.lit(True))
    j = requested.join(referenced, F.col(key) == F.col("__ref"), "left")
    return j.withColumn("decision", F.when(F.col("__has_child"), "refused").otherwise("deleted")) \
        .drop("__ref", "__has_child")


def delete_cascade(parent: DataFrame, key: str, doomed: Column,
                   children: Mapping[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """ON DELETE CASCADE: remove matching parents and every child pointing at them.

    Returns the surviving version of the parent (under ``"parent"``) and of
    each child (under its name).
    """
    gone = parent.where(F.coalesce(doomed, F.lit(False))).select(F.col(key).alias("__gone"))
    out = {"parent": parent.where(~F.coalesce(doomed, F.lit(False)))}
    for name, (child, fk) in children.items():
        out[name] = child.join(gone, F.col(fk) == F.col("__gone"), "left_anti")
    return out


@dataclass(frozen=True)
class Reference:
    """``child.column`` points at the key of ``parent``; a delete of the parent cascades or is refused."""

    child: str
    column: str
    parent: str
    restrict: bool = False


def delete_graph(tables: Mapping[str, tuple[DataFrame, str]], references: Sequence[Reference], root: str,
                 requested: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """DELETE of the ``requested`` keys of ``root`` through a graph of foreign keys, each request for itself.

    ``tables``: name -> (rows, key column). A request dooms its row and all that
    hangs on it by cascading references, over any number of tables and
    levels (also of a table on itself); a RESTRICT reference to any doomed
    row refuses the request as a whole. Returns ``decisions`` (request,
    decision) and the surviving rows of every table: a row goes if some request
    that isn't refused dooms it.

    A fixpoint over (table, key, request): each round joins the keys found last
    with the tables that point at them and keeps what is new, written once; it
    ends with the depth of the data, not of the schema. Requests for keys that
    don't exist are dropped; NULL references point at nothing.
    """
    key = lambda c: F.col(c).cast("string")
    rows, root_key = tables[root]
    asked = requested.toDF("__want").distinct()
    front = rows.join(asked, F.col(root_key) == F.col("__want")).select(F.lit(root).alias("of"), key(root_key).alias("id"), key(root_key).alias("request"))
    front = doomed = materialize(front.distinct(), "doomed")
    while front.head(1):
        found = None
        for ref in references:
            if not ref.restrict:
                child, child_key = tables[ref.child]
                step = (child.select(key(child_key).alias("__id"), key(ref.column).alias("__to"))
                        .join(front.where(F.col("of") == ref.parent), F.col("__to") == F.col("id"))
                        .select(F.lit(ref.child).alias("of"), F.col("__id").alias("id"), "request"))
                found = step if found is None else found.unionByName(step)
        if found is None:
            break
        names = ["of", "id", "request"]
        known = doomed.select(*[F.col(c).alias(f"__{c}") for c in names])
        front = materialize(found.distinct().join(known, [F.col(c) == F.col(f"__{c}") for c in names], "left_anti"), "doomed")
        doomed = doomed.unionByName(front)
    refused = doomed.where(F.lit(False)).select("request")
    for ref in references:
        if ref.restrict:
            held = tables[ref.child][0].select(key(ref.column).alias("__to")).where(F.col("__to").isNotNull()).distinct()
            refused = refused.unionByName(doomed.where(F.col("of") == ref.parent).join(held, F.col("id") == F.col("__to"), "left_semi").select("request"))
    refused = materialize(refused.distinct().withColumnRenamed("request", "__refused"), "refused")
    decisions = (doomed.where(F.col("of") == root).select("request").distinct()
                 .join(refused, F.col("request") == F.col("__refused"), "left")
                 .select("request", F.when(F.col("__refused").isNotNull(), "refused").otherwise("deleted").alias("decision")))
    gone = doomed.join(refused, F.col("request") == F.col("__refused"), "left_anti").select("of", F.col("id").alias("__gone")).distinct()
    left = {name: frame.join(gone.where(F.col("of") == name).drop("of"), key(column) == F.col("__gone"), "left_anti")
            for name, (frame, column) in tables.items()}
    return decisions, left


def view_check(rows: DataFrame, predicate: Column) -> DataFrame:
    """WITH CHECK OPTION: rows written through a view must satisfy its predicate (TRUE)."""
    return rows.where(~F.coalesce(predicate, F.lit(False))).withColumn(RULE, F.lit("view_check"))


def enforce(df: DataFrame, checks: Mapping[str, Column], unique_keys: Sequence[Sequence[str]] = (),
            references: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = ()) -> DataFrame:
    """Split a batch into accepted / rejected rows with every failed rule named.

    ``checks`` are row predicates (NULL passes). ``unique_keys`` are column
    lists whose fully non-NULL values may occur once; ``references`` are
    (columns, parent, parent columns). Every flag is found on the row itself:
    a key's count comes by one join with the repeated keys, a reference's
    match by one join with the distinct parent keys; a row with a NULL key
    part never meets another row's reasons.
    """
    reasons = [F.when(~F.coalesce(pred, F.lit(True)), F.lit(name)) for name, pred in checks.items()]
    out, flags = df, []
    for n, (fk, parent, pk) in enumerate(references):
        keys = parent.select(*[F.col(p).alias(f"__p{n}_{i}") for i, p in enumerate(pk)]).distinct()
        keys = keys.withColumn(f"__ref{n}", F.lit(True))
        out = out.join(keys, [F.col(c) == F.col(f"__p{n}_{i}") for i, c in enumerate(fk)], "left")
        given = F.lit(True)
        for c in fk:
            given = given & F.col(c).isNotNull()
        reasons.append(F.when(given & F.col(f"__ref{n}").isNull(), F.lit(f"foreign_key:{','.join(fk)}")))
        flags += [f"__ref{n}", *[f"__p{n}_{i}" for i in range(len(pk))]]
    for n, cols in enumerate(unique_keys):
        repeated = (_non_null_keys(df, cols).groupBy(*[F.col(c).alias(f"__u{n}_{i}") for i, c in enumerate(cols)])
                    .agg(F.count(F.lit(1)).alias(f"__n{n}")).where(F.col(f"__n{n}") > 1))
        out = out.join(repeated, [F.col(c) == F.col(f"__u{n}_{i}") for i, c in enumerate(cols)], "left")
        reasons.append(F.when(F.col(f"__n{n}").isNotNull(), F.lit(f"unique:{','.join(cols)}")))
        flags += [f"__n{n}", *[f"__u{n}_{i}" for i in range(len(cols))]]
    return (out.withColumn("reasons", F.concat_ws(",", *reasons))
            .withColumn("accepted", F.col("reasons") == "").drop(*flags)
            .select(*df.columns, "accepted", "reasons"))


def enforce_in_order(df: DataFrame, arrival: str, checks: Mapping[str, Column], unique_keys: Sequence[Sequence[str]] = (),
                     references: Sequence[tuple[Sequence[str], DataFrame, Sequence[str]]] = ()) -> DataFrame:
    """``enforce`` as if the rows were inserted one by one in order of ``arrival`` (unique): the first valid row keeps its key.

    Checks and references come first: a row that they reject occupies no unique
    key. Of the others a row is accepted unless an accepted one before it holds
    one of its keys, and then names these keys as its reasons. With several
    unique keys a rejected row frees its other keys, so it goes in rounds:
    rows that are the first open one of all their keys are accepted, open rows
    that meet an accepted key are rejected. The earliest open row is always
    accepted; a single unique key takes one round.
    """
    judged = enforce(df, checks, (), references)
    if not unique_keys:
        return judged
    judged = materialize(judged, "enforce_judged")
    accepted, refused = [], []
    open_ = judged.where("accepted").select(*df.columns)
    while True:
        own, is_first = open_, F.lit(True)
        for n, cols in enumerate(unique_keys):
            own = _with_key(own, cols, _key_holders(open_, cols, arrival), f"__first{n}")
            is_first = is_first & F.coalesce(F.col(f"__first{n}") == F.col(arrival), F.lit(True))
        own = materialize(own.withColumn("__ok", is_first), "enforce_firsts")
        accepted.append(own.where("__ok").select(*df.columns))
        rest, blocked = own.where("NOT __ok"), F.lit(False)
        for n in range(len(unique_keys)):  # whether the first holder of the key is accepted
            held = accepted[-1].select(F.col(arrival).alias(f"__held{n}"))
            rest = rest.join(held, F.col(f"__first{n}") == F.col(f"__held{n}"), "left")
            blocked = blocked | F.col(f"__held{n}").isNotNull()
        rest = rest.withColumn("__blocked", blocked)
        if len(unique_keys) > 1:
            rest = materialize(rest.select(*df.columns, "__blocked"), "enforce_rest")
        refused.append(rest.where("__blocked").select(*df.columns))
        open_ = rest.where("NOT __blocked").select(*df.columns)
        if len(unique_keys) == 1 or not open_.head(1):
            break
    taken, lost = reduce(DataFrame.unionByName, accepted), reduce(DataFrame.unionByName, refused)
    reasons = []
    for n, cols in enumerate(unique_keys):
        lost = _with_key(lost, cols, _key_holders(taken, cols, arrival), f"__held{n}")
        reasons.append(F.when(F.col(f"__held{n}") < F.col(arrival), F.lit(f"unique:{','.join(cols)}")))
    return (judged.where(~F.col("accepted")).unionByName(taken.select("*", F.lit(True).alias("accepted"), F.lit("").alias("reasons")))
            .unionByName(lost.select(*df.columns, F.lit(False).alias("accepted"), F.concat_ws(",", *reasons).alias("reasons"))))


def _key_holders(df: DataFrame, cols: Sequence[str], arrival: str) -> DataFrame:
    """First arrival of every fully given key, the key's columns as __u0, __u1, ..."""
    return (_non_null_keys(df, cols).groupBy(*[F.col(c).alias(f"__u{i}") for i, c in enumerate(cols)])
            .agg(F.min(arrival).alias("__low")))


def _with_key(df: DataFrame, cols: Sequence[str], holders: DataFrame, out: str) -> DataFrame:
    names = [f"__u{i}" for i in range(len(cols))]
    return df.join(holders, [F.col(c) == F.col(n) for c, n in zip(cols, names)], "left").drop(*names).withColumnRenamed("__low", out)
