"""Write rules on keyed tables: insert-if-absent and the guarded upsert.

Both are pure functions of frames and run no job. A key with a null part never conflicts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirframe.operators.dedup import first_wins, split_null_keys
from weirframe.operators.heavy import HeavyKeys, piece_of

SO_FAR = "rows between unbounded preceding and current row"


def absent(batch: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key is not in the target.

    The target's keys are made distinct first, so repeated keys collapse before the
    shuffle that the join needs anyway.
    """
    return batch.join(target.select(*keys).distinct(), keys, "left_anti")


def insert_ignore(
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    target: DataFrame | None = None,
    null_keys: bool = True,
) -> DataFrame:
    """The rows of the batch that an insert with "ignore on conflict" would add.

    First row per key wins and existing rows stay. ``null_keys=False`` is for keys
    whose columns are required, and saves a pass over the batch.
    """
    keyed, keyless = split_null_keys(batch, keys) if null_keys else (batch, None)
    added = first_wins(keyed, keys, order)
    if target is not None:
        added = absent(added, target, keys)
    return added if keyless is None else added.unionByName(keyless)


@dataclass(frozen=True)
class UpsertRule:
    """How a conflicting row changes the stored one.

    ``guard`` columns are compared null-safely with the stored row; when one differs,
    ``guard`` and ``carried`` columns are replaced. All other columns keep the value
    of the row that created the key.
    """

    keys: list[str]
    guard: list[str]
    carried: list[str] = field(default_factory=list)

    def immutable(self, columns: list[str]) -> list[str]:
        changing = {*self.keys, *self.guard, *self.carried}
        return [c for c in columns if c not in changing]


ACTIONS = ["n_insert", "n_update", "n_noop"]


def fold(
    batch: DataFrame,
    rule: UpsertRule,
    order: list[str],
    stored: DataFrame | None = None,
    null_keys: bool = True,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Applies the batch row by row, in order, to the stored rows.

    Returns the merged table with the number of inserts, updates and no-ops of each
    key. A row changes the table iff its guard differs from the preceding row's guard,
    so the state after any prefix is the last guard and the label of the last changing
    row. One shuffle by key brings a key's rows together.

    A key that ``heavy`` names (see ``heavy.heavy_keys``) would overload its task. State and
    counts combine over pieces of the order, so such a key is folded per (key, piece) first.
    The result is the same. Stored rows are one per key and come before the batch.
    """
    columns = [c for c in batch.columns if c not in order]
    keyed, keyless = split_null_keys(batch, rule.keys) if null_keys else (batch, None)
    kept, stored_keyless = None, None
    if stored is not None:
        kept = stored.select(*columns)
        kept, stored_keyless = split_null_keys(kept, rule.keys) if null_keys else (kept, None)
    rows, names = _with_stored(keyed, kept, columns, order, {"_place": _place(heavy)})
    merged = _fold_rows(rows, heavy, rule, columns, names)
    if keyless is not None:
        merged = merged.unionByName(unfolded(keyless, order, inserted=True))
    if stored_keyless is not None:
        merged = merged.unionByName(unfolded(stored_keyless, order, inserted=False))
    return merged


def _place(heavy: HeavyKeys | None) -> Column:
    return heavy.place.cast("long") if heavy and heavy.found else F.lit(None).cast("long")


def _with_stored(
    batch: DataFrame, stored: DataFrame | None, columns: list[str], order: list[str], more: dict[str, Column]
) -> tuple[DataFrame, list[str]]:
    """Batch rows with their order and ``more`` columns, stored rows without; and the order's names."""
    positions = {f"_order_{i}": F.col(c) for i, c in enumerate(order)} | more
    rows = batch.select(*columns, *[c.alias(name) for name, c in positions.items()], F.lit(True).alias("_new"))
    if stored is not None:
        nothing = [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in positions]
        rows = rows.unionByName(stored.select(*columns, *nothing, F.lit(False).alias("_new")))
    return rows, [f"_order_{i}" for i in range(len(order))]


#: Pieces of a heavy key in one step, as a power of two.
PIECE_BITS = 16


def fold_steps(
    batch: DataFrame,
    rule: UpsertRule,
    order: list[str],
    step: Column,
    stored: DataFrame | None = None,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """``fold`` over batches that follow each other, told apart by the whole number ``step``.

    Returns the state of every key after each step that has rows of it, with that step's
    actions, ``step`` (null for stored rows) and ``is_last``: the rows with ``is_last`` are the
    table after all steps. All steps cost one shuffle by key. ``order`` and the place of ``heavy`` must not decrease from step to step.
    """
    columns = [c for c in batch.columns if c not in order]
    keyed, keyless = split_null_keys(batch, rule.keys)
    kept, stored_keyless = split_null_keys(stored.select(*columns), rule.keys) if stored is not None else (None, None)
    rows, names = _with_stored(keyed, kept, columns, order, {"_place": _place(heavy), "_step": step.cast("long")})

    def run(part: DataFrame, piece: Column) -> DataFrame:
        chunk = F.shiftleft("_step", PIECE_BITS) + piece
        return _running_chunks(_chunk_summaries(part.withColumn("_chunk", chunk), rule, columns, names), rule)

    if heavy and heavy.found:
        table = F.broadcast(heavy.table(rows.sparkSession, rows.select(*rule.keys).schema))
        light = run(rows.join(table, rule.keys, "left_anti").repartition(*rule.keys), F.lit(0))
        found = light.unionByName(_per_step(run(rows.join(table, rule.keys), piece_of("_place", "_cuts")), rule))
    else:
        found = run(rows.repartition(*rule.keys), F.lit(0))
    # The windows over (key, chunk) and over the key both follow the partitioning by key.
    placed = found.selectExpr("* except (n_insert, n_update, _rows)", "_own_insert as n_insert", "_own_update as n_update", "_own_rows as _rows")
    extra = [F.shiftright("_chunk", PIECE_BITS).cast("int").alias("step"), F.col("_is_last").alias("is_last")]
    steps = _result(placed, rule, columns, extra)
    alone = [F.lit(True).alias("is_last")]
    own_step = step.cast("int").alias("step")
    steps = steps.unionByName(unfolded(keyless.withColumn("_step", own_step), order, inserted=True).withColumnRenamed("_step", "step").select("*", *alone))
    if stored_keyless is not None:
        steps = steps.unionByName(unfolded(stored_keyless, order, inserted=False).select("*", F.lit(None).cast("int").alias("step"), *alone))
    return steps


def _per_step(pieces: DataFrame, rule: UpsertRule) -> DataFrame:
    """The last piece of each step, with the counts of all of them."""
    step = f"partition by {_names(rule.keys)}, shiftright(_chunk, {PIECE_BITS})"
    counts = ["_own_rows", "_own_update", "_own_insert"]
    summed = pieces.selectExpr(
        f"* except ({', '.join(counts)})",
        *[f"sum({name}) over ({step}) as {name}" for name in counts],
        f"lead(true) over ({step} order by _chunk) is null as _ends",
    )
    return summed.filter("_ends").drop("_ends")


def unfolded(keyless: DataFrame, order: list[str], inserted: bool) -> DataFrame:
    """Rows with a null key part as ``fold`` returns them: all kept, each an insert if new."""
    counts = zip(ACTIONS, (int(inserted), 0, 0))
    return keyless.drop(*order).select("*", *[F.lit(n).cast("long").alias(name) for name, n in counts])


def _fold_rows(rows: DataFrame, heavy: HeavyKeys | None, rule: UpsertRule, columns: list[str], order: list[str]) -> DataFrame:
    """Heavy keys in two levels, all others in one."""
    if not heavy or not heavy.found:
        return _fold_whole(rows, rule, columns, order)
    # A row for each of heavy.MOST_KEYS keys at most.
    table = F.broadcast(heavy.table(rows.sparkSession, rows.select(*rule.keys).schema))
    light = _fold_whole(rows.join(table, rule.keys, "left_anti"), rule, columns, order)
    cut = rows.join(table, rule.keys).withColumn("_chunk", piece_of("_place", "_cuts"))
    return light.unionByName(_merge_chunks(_chunk_summaries(cut, rule, columns, order), rule, columns))


def _fold_whole(rows: DataFrame, rule: UpsertRule, columns: list[str], order: list[str]) -> DataFrame:
    """All rows of a key in one window."""
    window = f"partition by {_names(rule.keys)} order by _new, {_names(order)}"
    changed = " or ".join(f"`{g}` is distinct from _previous.`{g}`" for g in rule.guard)
    linked = rows.selectExpr(
        "*",
        f"row_number() over ({window}) as _row",
        f"lead(true) over ({window}) is null as _is_last",
        f"lag({_value(rule.guard)}) over ({window}) as _previous",
    ).selectExpr("*", f"_row > 1 and ({changed}) as _changed")
    so_far = f"({window} {SO_FAR})"
    running = linked.selectExpr(
        *_quoted(rule.keys),
        *_quoted(rule.guard),
        "_is_last",
        f"first({_value(rule.immutable(columns))}) over {so_far} as _created",
        f"last(if(_changed or _row = 1, {_value(rule.carried)}, null), true) over {so_far} as _label",
        f"count_if(_changed) over {so_far} as n_update",
        f"count_if(_new) over {so_far} as _rows",
        f"if(first(_new) over {so_far}, 1L, 0L) as n_insert",
    )
    return _result(running.filter("_is_last"), rule, columns)


def _result(folded: DataFrame, rule: UpsertRule, columns: list[str], extra: list[Column] | None = None) -> DataFrame:
    found = [
        *[F.col(f"`{c}`") for c in rule.keys],
        *[F.col(f"_created.`{c}`").alias(c) for c in rule.immutable(columns)],
        *[F.col(f"`{c}`") for c in rule.guard],
        *[F.col(f"_label.`{c}`").alias(c) for c in rule.carried],
    ]
    noop = (F.col("_rows") - F.col("n_insert") - F.col("n_update")).alias("n_noop")
    more = extra or []
    made = folded.select(*found, "n_insert", "n_update", noop, *more)
    return made.select(*columns, *ACTIONS, *made.columns[len(made.columns) - len(more) :])


def _chunk_summaries(rows: DataFrame, rule: UpsertRule, columns: list[str], order: list[str]) -> DataFrame:
    """One row per (key, chunk): first row, last guard, last label set inside it, and counts.

    Running values over the sorted chunk are read off its last row. That reuses the
    window's sort, where an aggregate of structs would copy a buffer per row. The first
    row is kept in three parts, so that parts nobody asks for are pruned before the shuffle.
    """
    window = f"partition by {_names(rule.keys)}, _new, _chunk order by {_names(order)}"
    changed = " or ".join(f"`{g}` is distinct from _previous.`{g}`" for g in rule.guard)
    linked = rows.selectExpr(
        "*",
        f"row_number() over ({window}) as _row",
        f"lead(true) over ({window}) is null as _is_last",
        f"lag({_value(rule.guard)}) over ({window}) as _previous",
    ).selectExpr("*", f"_row > 1 and ({changed}) as _changed")
    so_far = f"({window} {SO_FAR})"
    running = linked.selectExpr(
        *_quoted(rule.keys),
        "_new",
        "_chunk",
        *_quoted(rule.guard),
        "_is_last",
        "cast(_row as bigint) as _rows",
        f"first({_value(rule.immutable(columns))}) over {so_far} as _created",
        f"first({_value(rule.guard)}) over {so_far} as _first_guard",
        f"first({_value(rule.carried)}) over {so_far} as _first_label",
        f"last(if(_changed, {_value(rule.carried)}, null), true) over {so_far} as _label",
        f"count_if(_changed) over {so_far} as _changes",
    )
    return running.filter("_is_last").drop("_is_last")


def _running_chunks(chunks: DataFrame, rule: UpsertRule) -> DataFrame:
    """State and counts after each chunk of a key, and the chunk's own counts."""
    window = f"partition by {_names(rule.keys)} order by _new, _chunk"
    changed = " or ".join(f"_first_guard.`{g}` is distinct from _previous.`{g}`" for g in rule.guard)
    linked = chunks.selectExpr(
        "*",
        f"row_number() over ({window}) as _part",
        f"lead(true) over ({window}) is null as _is_last",
        f"lag({_value(rule.guard)}) over ({window}) as _previous",
    ).selectExpr("*", f"_part > 1 and ({changed}) as _changed")
    so_far = f"({window} {SO_FAR})"
    return linked.selectExpr(
        *_quoted(rule.keys),
        *_quoted(rule.guard),
        "_chunk",
        "_is_last",
        f"first(_created) over {so_far} as _created",
        f"last(coalesce(_label, if(_changed or _part = 1, _first_label, null)), true) over {so_far} as _label",
        f"sum(if(_new, _rows, 0)) over {so_far} as _rows",
        f"sum(_changes + if(_changed, 1, 0)) over {so_far} as n_update",
        f"if(first(_new) over {so_far}, 1L, 0L) as n_insert",
        "if(_new, _rows, 0L) as _own_rows",
        "_changes + if(_changed, 1L, 0L) as _own_update",
        "if(_new and _part = 1, 1L, 0L) as _own_insert",
    )


def _merge_chunks(chunks: DataFrame, rule: UpsertRule, columns: list[str]) -> DataFrame:
    """One row per key, from the summaries of its chunks."""
    return _result(_running_chunks(chunks, rule).filter("_is_last"), rule, columns)


def _quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def _names(columns: list[str]) -> str:
    return ", ".join(_quoted(columns))


def _value(columns: list[str]) -> str:
    """The columns as one value that is never NULL itself."""
    return f"struct({', '.join(['true as _set', *_quoted(columns)])})"


def guarded_upsert(
    batch: DataFrame,
    rule: UpsertRule,
    order: list[str],
    stored: DataFrame | None = None,
    null_keys: bool = True,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """The table after the batch."""
    return fold(batch, rule, order, stored, null_keys, heavy).drop(*ACTIONS)


def action_totals(folded: DataFrame) -> DataFrame:
    """One row: inserts, updates, no-ops, and inserts plus updates as "stored"."""
    totals = folded.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ACTIONS])
    return totals.withColumn("n_stored", F.col("n_insert") + F.col("n_update"))


def drop_replayed(batch: DataFrame, stored: DataFrame, keys: list[str], row_id: str = "id") -> DataFrame:
    """Drops keyless batch rows whose row id is already stored, so a re-run adds nothing.

    Keyed rows pass: the write rules handle them.
    """
    keyed, keyless = split_null_keys(batch, keys)
    _, stored_keyless = split_null_keys(stored, keys)
    return keyed.unionByName(absent(keyless, stored_keyless, [row_id]))
