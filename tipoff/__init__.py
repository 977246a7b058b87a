"""Schedule and box-score analytics as Spark DataFrame jobs.

Layers: ``sources`` (landing files, bronze, legacy extracts), ``functions``
(column expressions), ``operators`` (upsert, latest-record, running totals),
``plans`` (calendar, silver, gold, quality, lineage, migration, models) and
``streaming`` (the batch code behind a file stream).
"""

from tipoff.session import configure, get_session

__all__ = ["configure", "get_session"]
