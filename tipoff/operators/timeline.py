"""Running totals and look-back windows that hold under hot keys.

Groups of at most ``GROUP_ROWS`` rows take one exchange and one window by their keys (the
``whole`` forms). A window partitioned by team would send all rows of a hot team to one task, so
the timeline of a larger group is cut into days: rows are ranked and summed inside a day, the day
totals, few per group, get their opening balance from a small window, and both are added.
Look-backs cut it into fixed-length blocks and repeat the few rows before each block. ``by_size``
counts the groups and gives each its form; both give the same rows. Null keys and null days are
values like any other; a null day comes first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Rows per look-back block.
BLOCK_ROWS = 4096
# Rows of a group that one task may take whole.
GROUP_ROWS = 50_000


def by_size(
    rows: DataFrame,
    keys: Sequence[str],
    whole: Callable[[DataFrame], DataFrame],
    cut: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``whole`` of the groups of at most ``GROUP_ROWS`` rows, and ``cut`` of the larger ones.

    The groups are counted at once; the driver gets the keys of the larger ones only, of which
    there is at most one per ``GROUP_ROWS`` rows.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > GROUP_ROWS).drop("_rows")
    large = sizes.collect()
    if not large:
        return whole(rows)
    known = F.broadcast(rows.sparkSession.createDataFrame(large, sizes.schema))
    usual = whole(join_same(rows, known, keys, "left_anti"))
    return usual.unionByName(cut(join_same(rows, known, keys, "left_semi")))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on equal key columns in which null equals null; the right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{k}"))
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def _before(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    partition = list(keys) or [F.lit(0)]
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _whole(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("long")


def _total(value: Column | str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def leveled_totals(
    rows: DataFrame,
    keys: Sequence[str],
    levels: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, Column],
    prefix: str = "prior_",
) -> DataFrame:
    """Add, per measure, its total over the rows of the same keys that sort earlier.

    Rows sort by ``levels`` and then ``order``; together with ``keys`` they must be
    unique. The row itself is never included. No task
    gets more than the rows of one (keys, levels) value, or the distinct values of one
    level below its parent.
    """
    names = list(measures)
    rows = rows.withColumns({f"_m_{n}": _whole(c) for n, c in measures.items()})
    inside = _before([*keys, *levels], order)
    result = rows.withColumns({f"{prefix}{n}": _total(f"_m_{n}", inside) for n in names})
    totals = rows
    for depth in range(len(levels), 0, -1):
        here = [*keys, *levels[:depth]]
        totals = totals.groupBy(*here).agg(*[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in names])
        window = _before(here[:-1], [here[-1]])
        opening = totals.select(*here, *[_total(f"_m_{n}", window).alias(f"_open_{n}") for n in names])
        result = join_same(result, opening, here)
        result = result.withColumns({f"{prefix}{n}": F.col(f"{prefix}{n}") + F.col(f"_open_{n}") for n in names})
        result = result.drop(*[f"_open_{n}" for n in names])
    return result.drop(*[f"_m_{n}" for n in names])


def prior_totals(
    rows: DataFrame, keys: Sequence[str], day: str, order: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """``prior_<measure>`` over the rows of the same keys that sort earlier by day and order."""
    return by_size(
        rows,
        keys,
        lambda usual: leveled_totals(usual, keys, [], [day, *order], measures),
        lambda large: leveled_totals(large, keys, [day], order, measures),
    )


def entering_whole(
    rows: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    counted: Column,
    measures: Mapping[str, Column],
    labels: Mapping[str, Column],
) -> DataFrame:
    """:func:`entering` for groups that one task may take whole."""
    earlier = _before(keys, [day, *order])
    sums = {"counted": F.when(counted, 1), **measures}
    known = rows.withColumns({f"_m_{n}": _whole(c) for n, c in sums.items()})
    known = known.withColumns(
        {
            "position": _total("_m_counted", earlier) + 1,
            "previous_day": F.lag(day).over(Window.partitionBy(*keys).orderBy(day, *order)),
            **{f"prior_{n}": _total(f"_m_{n}", earlier) for n in measures},
        }
    )
    at = {n: F.when(counted & flag, F.col("position")) for n, flag in labels.items()}
    known = known.withColumns({f"last_{n}": F.coalesce(F.max(c).over(earlier), F.lit(0)) for n, c in at.items()})
    return known.drop(*[c for c in known.columns if c.startswith("_")])


def entering(
    rows: DataFrame,
    keys: Sequence[str],
    day: str,
    order: Sequence[str],
    counted: Column,
    measures: Mapping[str, Column],
    labels: Mapping[str, Column],
) -> DataFrame:
    """Everything known about a timeline just before each row, in one pass.

    Adds ``position`` (one plus the number of counted rows before), ``prior_<measure>``
    totals, ``last_<label>`` (position of the latest earlier counted row carrying the
    label, 0 if none) and ``previous_day`` (day of the row before). Rows sort by
    ``day`` and ``order``.
    """
    sums = {"counted": F.when(counted, 1), **measures}
    rows = rows.withColumns({f"_m_{n}": _whole(c) for n, c in sums.items()})
    inside = _before([*keys, day], order)

    # Inside one day: totals so far, and the in-day position of each label.
    in_day = rows.withColumns({f"_in_{n}": _total(f"_m_{n}", inside) for n in sums})
    in_day = in_day.withColumns(
        {
            f"_at_{n}": F.when(counted & flag, F.col("_in_counted") + 1).otherwise(0)
            for n, flag in labels.items()
        }
    )
    result = in_day.withColumns(
        {
            **{f"_seen_{n}": F.coalesce(F.max(f"_at_{n}").over(inside), F.lit(0)) for n in labels},
            "_row_in_day": F.count(F.lit(1)).over(inside),
        }
    )

    # One row per day, and the balance each day opens with.
    days = in_day.groupBy(*keys, day).agg(
        *[F.sum(f"_m_{n}").alias(f"_m_{n}") for n in sums],
        *[F.max(f"_at_{n}").alias(f"_at_{n}") for n in labels],
    )
    earlier = _before(keys, [day])
    opening = days.withColumns(
        {
            "_day_before": F.lag(day).over(Window.partitionBy(*keys).orderBy(day)),
            **{f"_open_{n}": _total(f"_m_{n}", earlier) for n in sums},
        }
    )
    reached = {
        n: F.when(F.col(f"_at_{n}") > 0, F.col("_open_counted") + F.col(f"_at_{n}")) for n in labels
    }
    opening = opening.select(
        *keys,
        day,
        "_day_before",
        *[f"_open_{n}" for n in sums],
        *[F.coalesce(F.max(c).over(earlier), F.lit(0)).alias(f"_open_at_{n}") for n, c in reached.items()],
    )

    joined = join_same(result, opening, [*keys, day])
    joined = joined.withColumns(
        {
            "position": F.col("_open_counted") + F.col("_in_counted") + 1,
            "previous_day": F.when(F.col("_row_in_day") > 0, F.col(day)).otherwise(F.col("_day_before")),
            **{f"prior_{n}": F.col(f"_open_{n}") + F.col(f"_in_{n}") for n in measures},
            **{
                f"last_{n}": F.when(
                    F.col(f"_seen_{n}") > 0, F.col("_open_counted") + F.col(f"_seen_{n}")
                ).otherwise(F.col(f"_open_at_{n}"))
                for n in labels
            },
        }
    )
    return joined.drop(*[c for c in joined.columns if c.startswith("_")])


def look_back_whole(
    rows: DataFrame, keys: Sequence[str], position: str, features: Mapping[str, tuple[int, Column]]
) -> DataFrame:
    """:func:`look_back` for groups that one task may take whole: rows that are not counted share the
    position of the next counted one, so the last ``n`` counted rows are a range of positions."""
    ordered = Window.partitionBy(*keys).orderBy(position)
    return rows.withColumns({name: agg.over(ordered.rangeBetween(-n, -1)) for name, (n, agg) in features.items()})


def look_back(
    rows: DataFrame,
    keys: Sequence[str],
    position: str,
    counted: Column,
    features: Mapping[str, tuple[int, Column]],
) -> DataFrame:
    """Aggregate over the last ``n`` counted rows before each row.

    ``features`` maps an output name to ``(n, aggregate)``; aggregates must ignore rows
    that are not counted. Where nothing precedes a row its features are null or zero.

    The counted rows, whose positions are unique, are cut into blocks of ``BLOCK_ROWS``
    positions, with the last rows of a block repeated in the next one. What they yield up
    to and including a position is then joined to all rows that stand one position further.
    """
    blocks = _in_blocks(rows.where(counted), position, max(n for n, _ in features.values()))
    ordered = Window.partitionBy(*keys, "_block").orderBy(position)
    known = blocks.select(
        *keys,
        (F.col(position) + 1).alias(position),
        "_copy",
        *[agg.over(ordered.rangeBetween(1 - n, 0)).alias(name) for name, (n, agg) in features.items()],
    )
    return join_same(rows, known.where(~F.col("_copy")).drop("_copy"), [*keys, position], "left")


def _in_blocks(rows: DataFrame, position: str, longest: int) -> DataFrame:
    """Rows with their block, and copies of each block's last rows in the next block."""
    size = max(BLOCK_ROWS, longest + 1)
    block = F.floor(F.col(position) / size)

    def place(number: Column, copy: bool) -> Column:
        return F.struct(number.alias("number"), F.lit(copy).alias("copy"))

    own, repeated = place(block, False), place(block + 1, True)
    reaches_next = F.col(position) % size >= size - longest
    places = F.when(reaches_next, F.array(own, repeated)).otherwise(F.array(own))
    return rows.withColumn("_place", F.explode(places)).select(
        *rows.columns, F.col("_place.number").alias("_block"), F.col("_place.copy").alias("_copy")
    )
