"""Entity windows that stay parallel when one entity holds a large share of the rows.

A plain ``Window.partitionBy(entity)`` gives every row of an entity to one task. Here the
entities above a row limit are found with a partial aggregate and cut into consecutive
*slices* of time; each slice also receives the few earlier rows its windows look back on
(its *halo*), so a window over ``(entity, slice)`` returns what the window over the whole
entity would. All other entities are a single slice.

Hot entities and cut points are tables in the shared folder, however many there are: nothing of them
reaches the driver, the planner knows their sizes and broadcasts small ones only, and a recomputed
task sees the same slices.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlake.session import stored

HOT_ROWS = 2_000_000  # rows of one entity a single task may sort

_SLICE, _HALO, _POS, _LAST, _NEXT, _TAIL, _CELL = "__slice", "__halo", "__pos", "__last", "__next", "__tail", "__cell"


def hot_entities(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """Entities with more than ``hot_rows`` rows as ``(key, __n)``, or None when there are none."""
    if df.count() <= hot_rows:  # then no entity can have more
        return None, hot_rows
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    hot = stored(counts.where(F.col("__n") > hot_rows), "hot-entities")
    return (None if hot.isEmpty() else hot), hot_rows


def split_hot(df: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary entities, rows of hot entities)."""
    if hot is None:
        return df, None
    keys = hot.select(key)
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def _cut_table(rows: DataFrame, key: str, cell: int, limit: int, tail: int) -> DataFrame:
    """Per hot entity and cell of time: its slice, the slice of the next cell, and whether the cell holds some of the
    slice's last ``tail`` rows.

    Derived from an exact histogram of positions, so it is the same in every run.
    """
    cells = rows.groupBy(key, F.floor(F.col(_POS) / cell).alias(_CELL)).agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy(key).orderBy(_CELL)
    before = F.sum("n").over(in_order) - F.col("n")
    # Slice numbers follow each other: a cell of more than ``limit`` rows would skip some.
    raw = cells.withColumn("s", F.floor(before / limit))
    new = F.coalesce((F.col("s") != F.lag("s").over(in_order)).cast("int"), F.lit(0))
    sliced = raw.withColumn("new", new).withColumn(_SLICE, F.sum("new").over(in_order).cast("int"))
    after = F.sum("n").over(Window.partitionBy(key, _SLICE).orderBy(F.desc(_CELL))) - F.col("n")
    follows = F.lead(_CELL).over(in_order) == F.col(_CELL) + 1
    placed = sliced.withColumns({
        _NEXT: F.when(follows, F.lead(_SLICE).over(in_order)).otherwise(F.col(_SLICE)),
        _TAIL: after < tail,
    })
    return stored(placed.select(F.col(key).alias("__entity"), _CELL, _SLICE, _NEXT, _TAIL), "cuts")


def _with_halo(rows: DataFrame, key: str, seq: str, tail: int, span: int, cell: int, limit: int, hot: DataFrame
               ) -> DataFrame:
    """Rows with their slice, and copies (``__halo``) of the rows each slice has to look back on."""
    if span > cell:
        raise ValueError("a cell must be as long as the windows look back")
    usual, busy = split_hot(rows, key, hot)
    cuts = _cut_table(busy, key, cell, limit, tail)
    data_cols = rows.columns
    placed = busy.withColumn("__at", F.floor(F.col(_POS) / cell))
    ends = F.floor((F.col(_POS) + span) / cell) == F.col("__at")
    tagged = (
        placed.join(cuts, (F.col(key) == F.col("__entity")) & (F.col("__at") == F.col(_CELL)))
        .withColumn(_LAST, F.when(ends, F.col(_SLICE)).otherwise(F.col(_NEXT)))
        .select(*data_cols, _SLICE, _LAST, _TAIL)
    )
    reached = F.explode(F.sequence(_SLICE, _LAST)) if span else F.col(_SLICE)
    out = (
        tagged.withColumn("__to", reached)
        .select(*data_cols, F.col("__to").alias(_SLICE), (F.col("__to") > F.col(_SLICE)).alias(_HALO))
        .unionByName(usual.withColumns({_SLICE: F.lit(0), _HALO: F.lit(False)}))
    )
    if not tail:
        return out
    # The last `tail` rows before a slice are among the last `tail` rows of the earlier slices.
    # The histogram tells where those begin, so few rows are ranked: at most slices * tail remain.
    newest = Window.partitionBy(key, _SLICE).orderBy(F.desc(_POS), F.desc(seq))
    tails = (
        tagged.where(_TAIL)
        .select(*data_cols, _SLICE, _LAST)
        .withColumn("__r", F.row_number().over(newest))
        .where(F.col("__r") <= tail)
    )
    in_order = Window.partitionBy(key).orderBy(_POS, seq)
    lookback = F.collect_list(F.struct(*data_cols, _LAST)).over(in_order.rowsBetween(-tail, -1))
    carried = (
        tails.withColumns({"__prev": F.lag(_SLICE).over(in_order), "__carry": lookback})
        .where(F.col("__prev") < F.col(_SLICE))  # first row of every later slice
        .select(F.col(_SLICE), F.explode("__carry").alias("h"))
        .where(F.col(f"h.{_LAST}") < F.col(_SLICE))  # the others were copied for their nearness
        .select(*[F.col(f"h.{c}").alias(c) for c in data_cols], _SLICE, F.lit(True).alias(_HALO))
    )
    return out.unionByName(carried)


def over_entity(
    df: DataFrame,
    *,
    key: str,
    pos: Column,
    seq: str,
    build: Callable[[WindowSpec], dict[str, Column]],
    derive: Callable[[], dict[str, Column]],
    tail: int = 0,
    span: int = 0,
    cell: int = 60_000_000,
    hot_rows: int = HOT_ROWS,
    hot: tuple[DataFrame | None, int] | None = None,
) -> DataFrame:
    """Add ``derive()`` columns computed per entity in order of ``(pos, seq)``.

    ``build(window)`` names the window columns they are derived from. These are evaluated once
    each and dropped again: a window inside a larger expression would be computed once per mention.

    ``pos`` is a whole-number position (microseconds, days). The frames ``build`` uses may look
    back at most ``tail`` rows or ``span`` units of ``pos``, and never ahead. ``cell`` is the
    finest unit of ``pos`` a slice boundary falls on; it should be at least ``span``, so that a
    row is copied at most once.
    """
    found, limit = hot if hot is not None else hot_entities(df, key, hot_rows)
    placed = df.withColumn(_POS, pos.cast("bigint"))

    def computed(rows: DataFrame, *partition: str) -> DataFrame:
        # Rows without an entity belong to no group: their columns stay null, and each is its
        # own partition so that many of them do not meet in one task.
        lone = F.when(F.col(key).isNull(), F.col(seq))
        windows = build(Window.partitionBy(key, lone, *partition).orderBy(_POS, seq))
        known = F.col(key).isNotNull()
        return rows.select("*", *[c.alias(name) for name, c in windows.items()]).select(
            *rows.columns, *[F.when(known, c).alias(name) for name, c in derive().items()]
        )

    if found is None:
        return computed(placed).drop(_POS)
    sliced = _with_halo(placed, key, seq, tail, span, cell, limit, found)
    return computed(sliced, _SLICE).where(~F.col(_HALO)).drop(_POS, _SLICE, _HALO)
