"""Table modification as DataFrame rewrites; the result is written by the caller.

Never overwrite a path that is being read: write a new version and switch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bannerloom.operators import skew

# kinds of an unordered bulk, in the order in which they are applied
UNORDERED_RANK = {"insert": 0, "upsert": 1, "set": 1, "inc": 1, "delete": 2}

COUNTS = ["inserted", "matched", "modified", "upserted", "removed", "rejected"]


def update_many(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.when(condition, new).otherwise(F.col(c)) for c, new in changes.items()})


def delete_many(df: DataFrame, condition: Column) -> DataFrame:
    """A row whose condition is NULL stays."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def last_per_key(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """The last change of every key, reduced before the shuffle."""
    values = [c for c in changes.columns if c not in (key, seq)]
    return changes.groupBy(key).agg(*[F.max_by(c, seq).alias(c) for c in values])


def _by_key(old: DataFrame, new: DataFrame, key: str, how: str) -> DataFrame:
    """The join of old and new rows on the key, in which NULL is a value like any other.

    Both sides are packed: struct columns ``_old`` and ``_new``, NULL where a side is missing.
    """
    right = new.withColumnRenamed(key, "_new_key")
    joined = old.join(right, F.col(key).eqNullSafe(F.col("_new_key")), how)
    there = F.when(F.col("_old").isNotNull(), F.col(key)).otherwise(F.col("_new_key"))
    return joined.select(there.alias(key), *[c for c in joined.columns if c not in (key, "_new_key")])


def _packed(df: DataFrame, key: str, columns: Sequence[str], out: str) -> DataFrame:
    """(key, out): never NULL in ``out``, also without columns."""
    return df.select(F.col(key), F.struct(F.lit(1).alias("_is"), *columns).alias(out))


def replace_by_key(base: DataFrame, replacements: DataFrame, key: str, upsert: bool = False) -> DataFrame:
    """Rows with a replacement take all its columns; the key stays. One replacement per key.

    With ``upsert`` a replacement without a row becomes a row. NULL is a key like any other.
    """
    values = [c for c in base.columns if c != key]
    both = _by_key(_packed(base, key, values, "_old"), _packed(replacements, key, values, "_new"), key, "full" if upsert else "left")
    row = F.coalesce("_new", "_old")
    return both.select(key, *[row[c].alias(c) for c in values])


def replace_counts(base: DataFrame, replacements: DataFrame, key: str, upsert: bool = False) -> DataFrame:
    """One row: matched, modified, upserted. A replacement equal to its row modifies nothing."""
    values = [c for c in base.columns if c != key]
    both = _by_key(_packed(replacements, key, values, "_old"), _packed(base, key, values, "_new"), key, "left")
    found = F.col("_new").isNotNull()
    return both.agg(
        F.count_if(found).alias("matched"),
        F.count_if(found & ~F.col("_new").eqNullSafe(F.col("_old"))).alias("modified"),
        (F.count_if(~found) if upsert else F.lit(0).cast("long")).alias("upserted"),
    )


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Set the columns of ``changes`` where the key exists, else insert. One change per key. NULL is a key like any other."""
    values = [c for c in base.columns if c != key]
    given = [c for c in changes.columns if c != key]
    both = _by_key(_packed(base, key, values, "_old"), _packed(changes, key, given, "_new"), key, "full")
    old, new = F.col("_old"), F.col("_new")
    pick = {c: F.when(new.isNotNull(), new[c]).otherwise(old[c]) if c in given else old[c] for c in values}
    return both.select(key, *[e.alias(c) for c, e in pick.items()])


def upsert_counts(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """(matched, modified, upserted) of the upsert; a match that changes nothing is not modified."""
    given = [c for c in changes.columns if c != key]
    return replace_counts(base.select(key, *given), changes, key, upsert=True)


# --- bulk writes -------------------------------------------------------------
#
# A run of operations on one key is a function of the row before it, and that
# function has a short form. For an absent row: is there a row afterwards, and
# its value. For a present row with value v: is there a row afterwards, and its
# value, which is either a constant or v plus a sum. Two neighbouring runs merge
# into one such form, so operations fold in parts whatever their number per key.
#
# Whether the first assignment to a present row changes it depends on v. That
# comparison stays open (open, open_add, open_to) until the row is known.
#
# Numbers are folded as two doubles, a sum and what its rounding has lost (about 32
# digits together), so that sums do not depend on how runs are cut and neither very small
# nor very large numbers lose their digits. Other columns are only ever assigned. A run
# also tells whether a present row is still the same row (p_kept): a row that was
# deleted and created again has nothing of the old one.


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _lift(c: Column, kind: T.DataType) -> Column:
    """A number as a sum of two doubles, exact for up to about 32 digits; NULL for NULL."""
    hi = c.cast("double")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        lo = F.lit(0.0)
    else:
        whole = f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "decimal(38,0)"
        lo = (c.cast(whole) - hi.cast(whole)).cast("double")
    return F.when(c.isNotNull(), F.struct(hi.alias("hi"), lo.alias("lo")))


def _number(acc: Column, kind: T.DataType) -> Column:
    """The folded number as a value of the column."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return (acc["hi"] + acc["lo"]).cast(kind)
    whole = f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else "decimal(38,0)"
    return (acc["hi"].cast(whole) + acc["lo"].cast(whole)).cast(kind)


def _plus(a: Column, b: Column) -> Column:
    """The sum of two folded numbers; NULL if one is."""
    s = a["hi"] + b["hi"]
    part = s - a["hi"]
    lost = F.when(F.abs(s) < float("inf"), (a["hi"] - (s - part)) + (b["hi"] - part)).otherwise(0.0)
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(s.alias("hi"), (a["lo"] + b["lo"] + lost).alias("lo")))


class _Field(NamedTuple):
    """A column that operations change: its place in the folded form, and its type in the table."""

    at: int
    kind: T.DataType

    def lift(self, c: Column, kind: T.DataType) -> Column:
        return _lift(c, kind) if _is_number(self.kind) else c.cast(self.kind)

    def result(self, folded: Column) -> Column:
        return _number(folded, self.kind) if _is_number(self.kind) else folded

    def after(self, g: Column, value: Column) -> Column:
        """The value behind run ``g`` of a present row that had ``value``."""
        stays = _plus(value, g[f"p_{self.at}"]) if _is_number(self.kind) else value
        return F.when(g[f"adds_{self.at}"], stays).otherwise(g[f"p_{self.at}"])


def _zero_counts(**given: Column) -> dict[str, Column]:
    zero = F.lit(0).cast("long")
    return {c: given.get(c, zero) for c in COUNTS}


def _counts(prefix: str, values: Mapping[str, Column]) -> list[Column]:
    return [values[c].alias(f"{prefix}_{c}") for c in COUNTS]


def _effect(op: Column, fields: Sequence[_Field], new: Sequence[Column], touched: Sequence[Column]) -> list[Column]:
    """The short form of a single operation that gives the lifted values ``new`` to the ``touched`` fields."""
    creates, deletes = op.isin("insert", "upsert"), op == "delete"
    out = [creates.alias("a_exists"), (~deletes).alias("p_exists"), (~deletes).alias("p_kept")]
    for field, value, is_touched in zip(fields, new, touched):
        number = _is_number(field.kind)
        zero = _lift(F.lit(0.0), T.DoubleType()) if number else F.lit(None).cast(field.kind)
        assigned, added = op.isin("upsert", "set") & is_touched, (op == "inc") & is_touched & F.lit(number)
        out += [
            F.when(creates & is_touched, value).alias(f"a_{field.at}"),
            (~deletes & ~assigned).alias(f"adds_{field.at}"),
            F.when(deletes, F.lit(None)).when(assigned | added, value).otherwise(zero).alias(f"p_{field.at}"),
        ]
    return out


def _operation(op: Column, amount: Column, counted: bool) -> Column:
    """The short form of a single operation on one number, with what is needed for counts if wanted."""
    one_field = _Field(0, T.DoubleType())
    value = _lift(amount, T.DoubleType())
    effect = _effect(op, [one_field], [value], [F.lit(True)])
    if not counted:
        return F.struct(*effect)

    def one(test: Column) -> Column:
        return F.when(test, 1).otherwise(0).cast("long")

    def is_op(*names: str) -> Column:
        return op.isin(*names)

    assigns = is_op("upsert", "set")
    absent = _zero_counts(inserted=one(is_op("insert")), upserted=one(is_op("upsert")))
    present = _zero_counts(
        matched=one(is_op("upsert", "set", "inc")),
        modified=one(is_op("inc") & (amount != 0)),
        removed=one(is_op("delete")),
        rejected=one(is_op("insert")),
    )
    return F.struct(
        *effect,
        assigns.alias("open"),
        F.when(assigns, _lift(F.lit(0.0), T.DoubleType())).alias("open_add"),
        F.when(assigns, value).alias("open_to"),
        *_counts("a", absent),
        *_counts("p", present),
    )


def _resolved(g: Column, value: Column) -> Column:
    """1 when the open comparison of ``g`` finds a change on a row with this value."""
    double = T.DoubleType()
    changed = g["open"] & ~_number(g["open_to"], double).eqNullSafe(_number(_plus(value, g["open_add"]), double))
    return F.when(changed, 1).otherwise(0).cast("long")


def _merged_effect(f: Column, g: Column, fields: Sequence[_Field]) -> list[Column]:
    """The effect of run ``f`` followed by run ``g``."""
    out = [
        F.when(f["a_exists"], g["p_exists"]).otherwise(g["a_exists"]).alias("a_exists"),
        F.when(f["p_exists"], g["p_exists"]).otherwise(g["a_exists"]).alias("p_exists"),
        (f["p_kept"] & g["p_kept"]).alias("p_kept"),
    ]
    for field in fields:
        a, adds, p = f"a_{field.at}", f"adds_{field.at}", f"p_{field.at}"
        out += [
            F.when(f["a_exists"], field.after(g, f[a])).otherwise(g[a]).alias(a),
            (f["p_exists"] & f[adds] & g[adds]).alias(adds),
            F.when(f["p_exists"], field.after(g, f[p])).otherwise(g[a]).alias(p),
        ]
    return out


_ONE = [_Field(0, T.DoubleType())]


def _merge(f: Column, g: Column) -> Column:
    return F.struct(*_merged_effect(f, g, _ONE))


def _merge_counted(f: Column, g: Column) -> Column:
    """Effect and counts of run ``f`` followed by run ``g``, of one number."""
    f_const = f["p_exists"] & ~f["adds_0"]
    keeps_open = f["p_exists"] & f["adds_0"] & g["open"]

    def total(start: str, c: str, exists: Column, value: Column, value_known: Column) -> Column:
        after = F.when(exists, g[f"p_{c}"]).otherwise(g[f"a_{c}"])
        extra = F.when(exists & value_known, _resolved(g, value)).otherwise(0) if c == "modified" else F.lit(0)
        return f[f"{start}_{c}"] + after + extra

    absent = {c: total("a", c, f["a_exists"], f["a_0"], F.lit(True)) for c in COUNTS}
    present = {c: total("p", c, f["p_exists"], f["p_0"], f_const) for c in COUNTS}
    return F.struct(
        *_merged_effect(f, g, _ONE),
        (f["open"] | keeps_open).alias("open"),
        F.when(f["open"], f["open_add"]).when(keeps_open, _plus(f["p_0"], g["open_add"])).alias("open_add"),
        F.when(f["open"], f["open_to"]).when(keeps_open, g["open_to"]).alias("open_to"),
        *_counts("a", absent),
        *_counts("p", present),
    )


def _folded(base: DataFrame, ops: DataFrame, key: str, ordered: bool, element: Column, merge: Callable[[Column, Column], Column]) -> DataFrame:
    """base full join folded operations, by a null-safe key: _old row struct, _new with the short form ``f``."""
    order = ["seq"]
    if not ordered:
        rank = F.create_map(*[F.lit(x) for kv in UNORDERED_RANK.items() for x in kv])[F.col("op")]
        ops, order = ops.withColumn("_rank", rank), ["_rank", "seq"]
    folded = skew.ordered_fold(ops, [key], order, element, merge, "f")
    values = [c for c in base.columns if c != key]
    return _by_key(_packed(base, key, values, "_old"), folded.select(key, F.struct("f").alias("_new")), key, "full")


def bulk_rows(
    base: DataFrame, ops: DataFrame, key: str, fields: Sequence[str], touched: str | None = None, ordered: bool = True
) -> DataFrame:
    """Apply ops(seq, key, op, fields...) to the rows of ``base``.

    insert creates an absent row, upsert assigns or creates, set and inc change
    a present row, delete removes it. Ordered: by seq. Unordered: inserts, then
    updates, then deletes. An insert of an existing key is rejected and counted
    and does not stop the operations behind it. ``touched`` names an array column of
    ``ops`` with the fields that an operation gives; the others stay as they are, or are
    NULL in a row it creates. Without it every operation gives all fields, NULL included.
    inc adds to numeric fields and leaves others alone. A created row has NULL in all
    columns that are not given, also where a row of that key was deleted before. NULL is a
    key like any other. Numbers keep about 32 digits while they are added up.
    """
    kinds = [_Field(i, base.schema[c].dataType) for i, c in enumerate(fields)]
    is_touched = [F.coalesce(F.array_contains(touched, c), F.lit(False)) if touched else F.lit(True) for c in fields]
    lifted = [k.lift(F.col(c), ops.schema[c].dataType) for k, c in zip(kinds, fields)]
    element = F.struct(*_effect(F.col("op"), kinds, lifted, is_touched))
    effects = _folded(base, ops, key, ordered, element, lambda f, g: F.struct(*_merged_effect(f, g, kinds)))
    f, old = F.col("_new.f"), F.col("_old")
    was = old.isNotNull()
    untouched = F.col("_new").isNull()
    exists = F.when(untouched, was).when(was, f["p_exists"]).otherwise(f["a_exists"])

    def value(c: str) -> Column:
        if c not in fields:
            return F.when(untouched | f["p_kept"], old[c]).alias(c)
        k = kinds[list(fields).index(c)]
        changed = F.when(was, k.after(f, k.lift(old[c], k.kind))).otherwise(f[f"a_{k.at}"])
        return F.when(untouched, old[c]).otherwise(k.result(changed)).alias(c)

    return effects.where(exists).select(key, *[value(c) for c in base.columns if c != key])


def bulk_write(base: DataFrame, ops: DataFrame, key: str, value: str, ordered: bool = True) -> DataFrame:
    """``bulk_rows`` for ops(seq, key, op, amount) on the one column ``value``."""
    return bulk_rows(base, ops.select("seq", key, "op", F.col("amount").alias(value)), key, [value], ordered=ordered)


def bulk_counts(base: DataFrame, ops: DataFrame, key: str, value: str, ordered: bool = True) -> DataFrame:
    """One row: inserted, matched, modified, upserted, removed, rejected, for the operations of ``bulk_write``."""
    element = _operation(F.col("op"), F.col("amount"), True)
    touched = _folded(base, ops, key, ordered, element, _merge_counted).where(F.col("_new").isNotNull())
    f, old = F.col("_new.f"), F.col("_old")
    was = old.isNotNull()

    def count(c: str) -> Column:
        n = F.when(was, f[f"p_{c}"]).otherwise(f[f"a_{c}"])
        if c == "modified":
            n = n + F.when(was, _resolved(f, _lift(old[value], base.schema[value].dataType))).otherwise(0)
        return F.coalesce(F.sum(n), F.lit(0)).alias(c)

    return touched.agg(*[count(c) for c in COUNTS])


# --- change feed -------------------------------------------------------------


def change_feed(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Changes between two versions: op, key, changed column names, old and new row.

    NULL is a key like any other.
    """
    values = [c for c in before.columns if c != key]
    old = before.select(F.col(key).alias("_old_key"), F.struct(*values).alias("before"))
    new = after.select(F.col(key).alias("_new_key"), F.struct(*values).alias("after"))
    op = (
        F.when(F.col("before").isNull(), "insert")
        .when(F.col("after").isNull(), "delete")
        .when(~F.col("before").eqNullSafe(F.col("after")), "update")
    )
    changed = F.filter(
        F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in values]),
        lambda c: c.isNotNull(),
    )
    return (
        old.join(new, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full")
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(F.coalesce("_old_key", "_new_key").alias(key), "op", F.when(F.col("op") == "update", changed).alias("updated"), "before", "after")
    )
