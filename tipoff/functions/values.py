"""Small column expressions on payload fields, hashes and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(text: Column | str) -> Column:
    """SHA-256 of the landed text itself; re-serialized JSON would hash differently."""
    return F.sha2(text, 256)


def hash_prefix(digest: Column | str) -> Column:
    return F.substring(digest, 1, 10)


def score(text: Column) -> Column:
    """Score text as a number: empty means not played, zero stays zero."""
    return F.nullif(text, F.lit("")).try_cast("int")


def bad_score(text: Column) -> Column:
    """True for score text that is neither empty nor a whole number."""
    present = F.coalesce(text, F.lit("")) != ""
    return present & score(text).isNull()


def iso_timestamp(text: Column) -> Column:
    """``2023-03-11T16:00Z`` or ``...T19:00:00Z`` as a timestamp, else null."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm[:ss]X"))


def hex_color(text: Column) -> Column:
    """``143624`` as ``#143624``; null stays null."""
    return F.concat(F.lit("#"), F.upper(F.ltrim(text, F.lit("#"))))


def game_status(state: Column, name: Column) -> Column:
    """One of scheduled / in_progress / final, null when neither field tells."""
    return (
        F.when((state == "post") | (name == "STATUS_FINAL"), "final")
        .when((state == "pre") | (name == "STATUS_SCHEDULED"), "scheduled")
        .when((state == "in") | (name == "STATUS_IN_PROGRESS"), "in_progress")
    )


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` as a double, 0 when there is nothing to divide by."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def fill_template(template: Column, **fields: Column) -> Column:
    """Replace each ``{name}`` of a path template by a column value."""
    for name, value in fields.items():
        template = F.replace(template, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return template
