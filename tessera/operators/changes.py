"""Table changes as copy-on-write transforms.

Plain Parquet tables have no UPDATE or DELETE, so every change is a pure
function ``DataFrame -> Change(snapshot, returning)``: ``snapshot`` is the
whole new version of the table, ``returning`` the rows a RETURNING clause
would give. All SET expressions read the *old* row (one projection). A change
becomes visible only when its snapshot is published (``sinks.Catalog``),
which writes a fresh directory and then swaps the table pointer: readers see
the old or the new version, never a mix. A batch of changes published once is
therefore atomic, and an unpublished version is simply discarded.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.joins import not_in
from tessera.operators.settlement import accept_in_order
from tessera.session import materialize
from tessera.sources.literals import apply_defaults, assign, assign_serial, cast_to_schema


@dataclass
class Change:
    snapshot: DataFrame
    returning: DataFrame


def _hit(where: Column | None) -> Column:
    return F.lit(True) if where is None else F.coalesce(where, F.lit(False))


def update(df: DataFrame, assignments: Mapping[str, Column], where: Column | None = None,
           returning: Sequence[str | Column] | None = None, old_prefix: str = "old_") -> Change:
    """UPDATE df SET col = expr, ... WHERE where [RETURNING ...].

    Rows where ``where`` is NULL are left untouched. Assigned values are cast
    to the column's type (assignment rounding to integers, see
    ``literals.cast_to_schema``). ``returning`` may name ``old_<col>`` to get
    pre-update values.
    """
    hit = _hit(where)
    types = {f.name: f.dataType for f in df.schema.fields}
    new_values = {c: assign(e, types[c]) for c, e in assignments.items()}
    snapshot = df.select(*[
        F.when(hit, new_values[c]).otherwise(F.col(c)).alias(c) if c in new_values else F.col(c)
        for c in df.columns])
    changed = df.where(hit).select(
        *[F.col(c).alias(f"{old_prefix}{c}") for c in df.columns],
        *[(new_values[c] if c in new_values else F.col(c)).alias(c) for c in df.columns])
    ret = changed.select(*(returning or df.columns))
    return Change(snapshot, ret)


def update_to_default(df: DataFrame, col: str, defaults: Mapping[str, object],
                      where: Column | None = None) -> Change:
    """UPDATE ... SET col = DEFAULT: the registered default, else NULL."""
    value = defaults.get(col)
    expr = value if isinstance(value, Column) else F.lit(value)
    return update(df, {col: expr}, where)


def delete(df: DataFrame, where: Column, returning: Sequence[str | Column] | None = None) -> Change:
    """DELETE FROM df WHERE where [RETURNING ...]: only rows where it is TRUE go."""
    hit = _hit(where)
    return Change(df.where(~hit), df.where(hit).select(*(returning or df.columns)))


def delete_not_in(df: DataFrame, key: str, sub: DataFrame, sub_key: str) -> Change:
    """DELETE FROM df WHERE key NOT IN (SELECT sub_key FROM sub) (null-aware)."""
    victims = materialize(not_in(df, key, sub, sub_key), "delete_victims")
    gone = victims.select(F.col(key).alias("__victim")).distinct()
    kept = df.join(gone, F.col(key).eqNullSafe(F.col("__victim")), "left_anti")
    return Change(kept, victims)


def insert(target: DataFrame, rows: DataFrame, id_col: str | None = None,
           order: Sequence[str] = (), returning: Sequence[str | Column] | None = None,
           defaults: Mapping[str, object] | None = None, last_id: int = 0) -> Change:
    """INSERT INTO target SELECT ... [RETURNING ...], with defaults and generated ids.

    Values are assigned to the target's types (numbers round into integer
    columns); columns that ``rows`` does not carry take their default, else
    NULL. With ``id_col``, new rows get ids after the highest of the table and
    ``last_id`` (``Catalog.last_serial``: the mark that deleted rows leave
    behind), in ``order``; gaps are allowed, reuse is not.
    """
    if id_col:
        start = F.greatest(target.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar(), F.lit(last_id))
        rows = assign_serial(rows, list(order), id_col, start=start)
    aligned = apply_defaults(rows, target.schema, defaults or {})
    extra = [c for c in rows.columns if c not in target.columns]
    given = aligned if not extra else apply_defaults(
        rows, T.StructType([*target.schema.fields, *[rows.schema[c] for c in extra]]), defaults or {})
    return Change(target.unionByName(aligned), given.select(*(returning or given.columns)))


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> Change:
    """INSERT ... SELECT ... WHERE NOT EXISTS (same key in target)."""
    key = list(key)
    existing = target.select(*[F.col(k).alias(f"__e{i}") for i, k in enumerate(key)])
    fresh = rows.join(existing, [F.col(k) == F.col(f"__e{i}") for i, k in enumerate(key)], "left_anti")
    return Change(target.unionByName(cast_to_schema(fresh, target.schema)), fresh)


def view_insert(target: DataFrame, rows: DataFrame, predicate: Column | None = None,
                defaults: Mapping[str, object] | None = None) -> tuple[Change, DataFrame]:
    """INSERT through an updatable view: (change, refused rows).

    Columns that the view hides take their defaults. With a check option
    (``predicate``) only rows that the view would show are written.
    """
    full = apply_defaults(rows, target.schema, defaults or {})
    shown = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    return insert(target, full.where(shown)), full.where(~shown)


def view_update(target: DataFrame, view: Column, assignments: Mapping[str, Column],
                where: Column | None = None) -> Change:
    """UPDATE through an updatable view: only rows that the view shows are reached."""
    return update(target, assignments, view if where is None else view & where)


def archive_move(df: DataFrame, where: Column) -> tuple[DataFrame, DataFrame]:
    """INSERT INTO archive SELECT ... WHERE p; DELETE ... WHERE p -> (live, archived)."""
    hit = _hit(where)
    return df.where(~hit), df.where(hit)


def apply_moves(balances: DataFrame, key: str, balance: str, moves: DataFrame,
                src: str, dst: str, amount: str) -> DataFrame:
    """Apply a batch of paired moves (debit ``src``, credit ``dst``) at once.

    Each move becomes two signed deltas; deltas are summed per account (partial
    aggregation before the shuffle) and added with one left join. The total
    over all accounts is unchanged when every move stays inside ``balances``.
    """
    deltas = (moves.select(F.col(src).alias("__acct"), (-F.col(amount)).alias("__delta"))
              .unionByName(moves.select(F.col(dst).alias("__acct"), F.col(amount).alias("__delta"))))
    per_acct = deltas.where(F.col("__acct").isNotNull()).groupBy("__acct").agg(F.sum("__delta").alias("__sum"))
    joined = balances.join(per_acct, F.col(key) == F.col("__acct"), "left")
    new_balance = (F.col(balance) + F.coalesce(F.col("__sum"), F.lit(0))).cast(balances.schema[balance].dataType)
    return joined.withColumn(balance, new_balance).drop("__acct", "__sum")


def eligible_moves(balances: DataFrame, key: str, balance: str, moves: DataFrame,
                   src: str, amount: str, order: str) -> DataFrame:
    """Moves that their source can pay, served per source in ``order`` (credits post at batch end)."""
    funds = balances.select(F.col(key).alias("__src"), F.col(balance).alias("__funds"))
    known = moves.join(funds, F.col(src) == F.col("__src"))
    return accept_in_order(known, src, order, amount, amount, "__funds").where("accepted") \
        .drop("__src", "__funds", "accepted")


class Versions:
    """Named, immutable versions of one table (savepoints / what-if branches).

    ``save`` records a version; ``rollback_to`` forgets the later ones; the
    caller publishes the version it chooses through the catalog.
    """

    def __init__(self, base: DataFrame, name: str = "base"):
        self._order: list[str] = [name]
        self._frames: dict[str, DataFrame] = {name: base}

    @property
    def current(self) -> DataFrame:
        return self._frames[self._order[-1]]

    def save(self, name: str, df: DataFrame) -> DataFrame:
        if name in self._frames:
            raise ValueError(f"version {name!r} exists")
        self._order.append(name)
        self._frames[name] = df
        return df

    def rollback_to(self, name: str) -> DataFrame:
        idx = self._order.index(name)
        for later in self._order[idx + 1:]:
            del self._frames[later]
        self._order = self._order[: idx + 1]
        return self.current

    def names(self) -> list[str]:
        return list(self._order)
