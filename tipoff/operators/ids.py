"""Sequential ids without a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipoff.operators.timeline import leveled_totals


def with_sequential_id(
    rows: DataFrame, last: int, day: str = "date", url: str = "source_url", name: str = "id"
) -> DataFrame:
    """Number rows from ``last + 1``.

    Ids follow (day, shard, url), the shard being two hex digits of the url's hash: a
    day that holds a large share of all rows is still numbered by 256 tasks.
    """
    sharded = rows.withColumn("_shard", F.substring(F.sha2(url, 256), 1, 2))
    numbered = leveled_totals(sharded, [], [day, "_shard"], [url], {"rows": F.lit(1)}, prefix="_before_")
    ids = (F.col("_before_rows") + last + 1).cast("long")
    return numbered.withColumn(name, ids).drop("_before_rows", "_shard")


def greatest_id(table: DataFrame, name: str = "id") -> int:
    """The greatest id, 0 for an empty table: one number from a distributed aggregate."""
    return table.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
