"""Row keys and clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_key(*parts: Column) -> Column:
    """C11: parts joined by `_`; NULL if any part is NULL."""
    pieces = []
    for part in parts:
        pieces += [F.lit("_"), part]
    return F.concat(*pieces[1:])


def event_key(movie_id: Column, timestamp: Column) -> Column:
    """Movie and a timestamp of 13 digits, so that keys of one movie sort by time. NULL without a time."""
    # format_string writes NULL as a word.
    return joined_key(movie_id, F.when(timestamp.isNotNull(), F.format_string("%013d", timestamp)))


def clock_ms(now_ms: int | None) -> Column:
    """Epoch milliseconds, of the query unless given."""
    return F.lit(now_ms).cast("bigint") if now_ms is not None else F.unix_millis(F.current_timestamp())
