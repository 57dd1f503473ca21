"""Wide tables kept up to date: the anchors that changes in any input reach, and their new rows.

Changes are given as images: of a changed row the old and the new one, of an added or removed row that one. They
travel back through the entries, from each changed table to the table it was joined to and on to the anchor, so that
only the rows a change touches are joined again.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tideline.operators.quality import fan_out
from tideline.operators.wide import (
    EQUALITIES, Entry, FanOutError, _condition, _flat, _left_join, _looks_up, _needed, _sides, check_entries, join_order, references,
)
from tideline.session import scratch_dir

# Masks of touched keys that go to every task: 16 bytes and an entry of a hash table each, for up to 64 keys.
MASK_ROWS = 2_000_000


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that one state has more often than the other, each once: the images of what changed between them.

    Copies are counted in the map tasks. Where a merge logs what it wrote and replaced, use that instead."""
    columns = before.columns
    signed = before.select(*columns, F.lit(1).alias("_sign")).unionByName(after.select(*columns, F.lit(-1).alias("_sign")))
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0").drop("_sign")


def used_columns(entries: Sequence[Entry], table: str, key: Sequence[str] = ()) -> list[str]:
    """The columns of a table that the wide table shows or joins by, and of the anchor its key: changes in others are none."""
    found = list(key) if entries[0].table == table else []
    for entry in entries:
        if entry.table == table:
            found += [c for c, _ in entry.outputs] + [c for e in entries for a, c in references(e.on) if a == entry.alias] + list(entry.lookup_key or [])
    return list(dict.fromkeys(found))


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _linking(df: DataFrame, entry: Entry, entries: Sequence[Entry], more: Sequence[str] = ()) -> DataFrame:
    """The columns of an entry that conditions use, and some more, named by alias and column."""
    used = [c for e in entries for a, c in references(e.on) if a == entry.alias]
    return df.select(*[F.col(c).alias(_flat(entry.alias, c)) for c in dict.fromkeys([*used, *more])])


def _written(df: DataFrame, label: str) -> DataFrame:
    """Stored once, so that it is built once and the planner knows its size."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class KeySet:
    """The keys in some columns, to tell the rows that have one of them from the others.

    A single whole-number column becomes masks of 64 neighbouring numbers. Up to `MASK_ROWS` of these, counted first, go
    to every task, so that rows are tested where they lie; other and more widely scattered keys are joined as Spark chooses.
    """

    def __init__(self, rows: DataFrame, columns: Sequence[str]):
        self.keys, self.masks = rows.select(*[F.col(c).alias(f"_key{n}") for n, c in enumerate(columns)]).distinct(), None
        if [isinstance(f.dataType, IntegralType) for f in self.keys.schema] == [True]:
            masks = _written(_masks(self.keys), "masks")
            if masks.count() <= MASK_ROWS:
                self.masks, self.has_null = masks, not masks.filter("_word IS NULL").isEmpty()

    def cut(self, rows: DataFrame, names: Sequence[str], among: bool = True, nulls: bool = True) -> DataFrame:
        """The rows whose columns `names` are among the keys, or the others; with `nulls`, null equals null."""
        if self.masks is None or not isinstance(rows.schema[names[0]].dataType, IntegralType):
            pairs = zip(names, self.keys.columns)
            on = same(names, self.keys.columns) if nulls else reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in pairs])
            return rows.join(self.keys, on, "left_semi" if among else "left_anti")
        key = F.col(names[0]).cast("long")
        marked = F.coalesce(F.getbit("_mask", key.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
        held = F.when(key.isNull(), F.lit(nulls and self.has_null)).otherwise(marked)
        placed = rows.withColumn("_word", F.shiftright(key, 6))
        return placed.join(F.broadcast(self.masks), "_word", "left").filter(held if among else ~held).select(*rows.columns)


def _masks(keys: DataFrame) -> DataFrame:
    """Whole-number keys as masks of 64 neighbours, one row each, and a row without a number for null."""
    key = F.col(keys.columns[0]).cast("long")
    bits = keys.select(F.shiftright(key, 6).alias("_word"), key.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
    return bits.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_mask"))


def touched_anchors(tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], entries: Sequence[Entry], key: Sequence[str]) -> DataFrame:
    """Distinct anchor keys whose rows in the wide table may differ; `tables` hold the new state.

    An anchor none of whose own rows along the way changed has the same way in both states, so following the images
    through the new state finds every other one. Where a condition is made of equalities with one earlier entry, the
    rows of that entry which the images meet take their place; any other condition, which null-extended rows might
    fulfil, is tried on the joined earlier entries it needs.
    """
    check_entries(entries)
    by_alias = {e.alias: e for e in entries}
    anchor, flat_key = entries[0], [_flat(entries[0].alias, c) for c in key]
    met: dict[str, list[DataFrame]] = {e.alias: [] for e in entries}
    found: list[DataFrame] = []
    for entry in reversed(entries[1:]):
        if entry.table in changes:
            met[entry.alias].append(_linking(changes[entry.table], entry, entries))
        if not met[entry.alias]:
            continue
        images = reduce(DataFrame.unionByName, met[entry.alias]).distinct()
        others = {a for a, _ in references(entry.on)} - {entry.alias}
        if len(others) == 1 and EQUALITIES.fullmatch(entry.on):
            other = by_alias[others.pop()]
            more = key if other is anchor else ()
            rows = _linking(tables[other.table], other, entries, more)
            if sides := _sides(entry):
                met[other.alias].append(KeySet(images, sides[1]).cut(rows, sides[0], nulls=False))
            else:
                met[other.alias].append(rows.join(images, _condition(entry), "left_semi"))
        else:
            joined = _joined(tables, entries, entry, key)
            found.append(joined.join(images, _condition(entry), "left_semi").select(*flat_key))
    if anchor.table in changes:
        met[anchor.alias].append(_linking(changes[anchor.table], anchor, entries, key))
    found += [rows.select(*flat_key) for rows in met[anchor.alias]]
    if not found:
        return tables[anchor.table].select(*[F.col(c).alias(f) for c, f in zip(key, flat_key)]).limit(0)
    return reduce(DataFrame.unionByName, found).distinct()


def _joined(tables: Mapping[str, DataFrame], entries: Sequence[Entry], last: Entry, key: Sequence[str]) -> DataFrame:
    """The anchor with the entries before `last` on which its condition depends, by their linking columns."""
    needed, todo = set(), [last]
    while todo:
        for alias, _ in references(todo.pop().on):
            if alias != last.alias and alias not in needed:
                needed.add(alias)
                todo += [e for e in entries if e.alias == alias]
    rows = _linking(tables[entries[0].table], entries[0], entries, key)
    for entry in entries[1:]:
        if entry.alias in needed:
            rows = rows.join(_linking(tables[entry.table], entry, entries).distinct(), _condition(entry), "left")
    return rows


def check_changed_lookups(tables: Mapping[str, DataFrame], changes: Mapping[str, DataFrame], entries: Sequence[Entry]) -> None:
    """Raise if a changed key of a lookup table has several rows; unchanged keys were checked when they were joined."""
    for entry in entries:
        if entry.lookup_key and entry.table in changes:
            keys = changes[entry.table].select(*entry.lookup_key).distinct()
            if not fan_out(tables[entry.table].join(keys, list(entry.lookup_key), "left_semi"), entry.lookup_key).isEmpty():
                raise FanOutError(f"{entry.table} has several rows per {', '.join(entry.lookup_key)}")


def wide_increment(
    tables: Mapping[str, DataFrame],
    changes: Mapping[str, DataFrame],
    entries: Sequence[Entry],
    key: Sequence[str],
    derived: Mapping[str, Column] | None = None,
    verify: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Keys of the anchors that the changes reach, and all rows these have in the wide table of the new state.

    `key` names the anchor's columns that tell its rows apart; nulls count as a value. An anchor that was removed has
    its key among the first and no row among the second. Each further table is cut down to what the touched rows
    can meet before it is joined, and what has been joined so far is stored before that, so that Spark knows how
    little it is. Lookups of a table that multiplies rows are joined to its rows before these meet the anchors.
    Tables without an entry in `changes` are taken as unchanged.
    """
    if verify:
        check_changed_lookups(tables, changes, entries)
    touched = _written(touched_anchors(tables, changes, entries, key), "touched")
    anchor = entries[0]
    used = [c for c, _ in anchor.outputs] + [c for e in entries for a, c in references(e.on) if a == anchor.alias] + list(key)
    rows = tables[anchor.table].select(*[F.col(c).alias(_flat(anchor.alias, c)) for c in dict.fromkeys(used)])
    flat_key = [_flat(anchor.alias, c) for c in key]
    wanted = KeySet(touched, flat_key)
    rows = stored = _written(wanted.cut(rows, flat_key), "anchors")
    todo = join_order(entries)[1:]

    def cut_down(entry: Entry, left: DataFrame) -> DataFrame:
        """The rows of an entry that those on the left can meet."""
        right, sides = _needed(tables[entry.table], entry, entries), _sides(entry)
        if not EQUALITIES.fullmatch(entry.on):
            return right
        if sides and sides[0] == flat_key and wanted.masks is not None:
            return wanted.cut(right, sides[1], nulls=False)
        used = dict.fromkeys(_flat(a, c) for a, c in references(entry.on) if a != entry.alias)
        # Left joins lose no row, so what was stored before them has the same values of its columns.
        held = stored if set(used) <= set(stored.columns) else left
        return right.join(held.select(*used).distinct(), _condition(entry), "left_semi")

    while todo:
        entry = todo.pop(0)
        right = plain = cut_down(entry, rows)
        if entry.lookup_key is None:
            # Its own lookups first: they move its rows alone, without the anchors' columns.
            for lookup in [e for e in todo if _looks_up(e, entry)]:
                right = _left_join(right, cut_down(lookup, plain), _condition(lookup), lookup)
                todo.remove(lookup)
        rows = _left_join(rows, right, _condition(entry), entry, plain)
        if entry.lookup_key is None and todo:
            rows = stored = _written(rows, "widened")
    rows = rows.select(*[F.col(_flat(e.alias, c)).alias(name) for e in entries for c, name in e.outputs])
    return touched, rows.withColumns(dict(derived)) if derived else rows


def replace_anchors(wide: DataFrame, touched: DataFrame, rows: DataFrame, entries: Sequence[Entry], key: Sequence[str]) -> DataFrame:
    """The wide table with all rows of the touched anchors replaced; the other rows are passed on without a shuffle
    as long as the touched keys are few enough, as keys or as masks, to be sent to every task."""
    names = {c: name for c, name in entries[0].outputs}
    keys = KeySet(touched, [_flat(entries[0].alias, c) for c in key])
    kept = keys.cut(wide, [names[c] for c in key], among=False)
    return kept.unionByName(rows.select(*wide.columns))
