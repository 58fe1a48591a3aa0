"""The streaming job: normalised ratings in; console, cells, recent ratings, source statistics and archive out.

    python -m ratingloom.plans.live <output> files <lines folder> <messages folder> [options]
    python -m ratingloom.plans.live <output> kafka <servers> <lines topic> <messages topic> [options]
    python -m ratingloom.plans.live <output> mixed <servers> <topic> [options]

Two queries read the source, each at its own interval, and hand every micro-batch to several sinks:

    statistics   running statistics per movie and source in streaming state, shown and written as cells
    ratings      the ratings themselves: CSV archive, recent ratings per movie, statistics per source
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratingloom.fixed_values import (
    ARCHIVE_TRIGGER,
    CELL_TIME_TO_LIVE_MS,
    CONSOLE_ROWS,
    MOVIE_STATS_TRIGGER,
    RECENT_PER_MOVIE,
)
from ratingloom.session import build_session
from ratingloom.sinks.archive import HOUR_MS, drop_hours, write_archive
from ratingloom.sinks.cells import maintain_cells
from ratingloom.sources.streams import read_text_stream, read_topic
from ratingloom.streaming import queries
from ratingloom.streaming.normalise import from_json_messages, from_lines, from_mixed, unify
from ratingloom.streaming.queries import Sink


@dataclass(frozen=True)
class Settings:
    """What the job may be told; every field is an option of the command line."""

    statistics_interval: str | None = MOVIE_STATS_TRIGGER
    ratings_interval: str | None = ARCHIVE_TRIGGER
    # What one micro-batch takes at most, so that the first one does not hold the whole backlog.
    offsets_per_trigger: int = 50_000_000
    files_per_trigger: int = 1_000
    # State partitions of the statistics, for the life of their checkpoint.
    state_partitions: int = 200
    console_rows: int = CONSOLE_ROWS
    recent_per_movie: int = RECENT_PER_MOVIE
    # After so many batches, parts of tables are folded together, and cells merged into their days.
    fold_every: int = queries.FOLD_EVERY
    cell_hours: int = CELL_TIME_TO_LIVE_MS // HOUR_MS
    archive_hours: int = 24 * 365


def start(
    unified: DataFrame, output_path: str, settings: Settings = Settings(), once: bool = False
) -> list[StreamingQuery]:
    """Both queries, each with its own name, interval and checkpoint. `once` handles what is there and stops."""

    def tend_cells(spark: SparkSession, batch_id: int, now_ms: int) -> None:
        if (batch_id + 1) % settings.fold_every == 0:
            maintain_cells(spark, f"{output_path}/cells", batch_id, now_ms, settings.cell_hours * HOUR_MS)

    def archive(rows: DataFrame, batch_id: int) -> None:
        write_archive(rows, f"{output_path}/raw-stream", batch_id)
        if (batch_id + 1) % settings.fold_every == 0:
            now_ms = rows.selectExpr("max(unix_millis(seen))").first()[0]
            if now_ms is not None:
                drop_hours(rows.sparkSession, f"{output_path}/raw-stream", now_ms, settings.archive_hours)

    statistics = queries.start_fan_out(
        queries.running_statistics(unified),
        [queries.console_sink(settings.console_rows), queries.cell_sink(f"{output_path}/cells", tend_cells)],
        f"{output_path}/checkpoints/statistics",
        "statistics",
        None if once else settings.statistics_interval,
        mode="complete",
        partitions=settings.state_partitions,
    )
    ratings = queries.start_fan_out(
        queries.with_time(unified),
        [
            Sink("archive", archive),
            queries.recent_sink(f"{output_path}/recent", settings.recent_per_movie, settings.fold_every),
            queries.source_sink(f"{output_path}/sources", settings.fold_every, show=True),
        ],
        f"{output_path}/checkpoints/ratings",
        "ratings",
        None if once else settings.ratings_interval,
    )
    return [statistics, ratings]


def parsed(arguments: list[str] | None = None) -> tuple[str, str, list[str], Settings]:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("output")
    parser.add_argument("kind", choices=["files", "kafka", "mixed"])
    parser.add_argument("where", nargs="+")
    for name, field in Settings.__dataclass_fields__.items():
        kind = int if field.type.startswith("int") else str
        parser.add_argument(f"--{name.replace('_', '-')}", type=kind, default=field.default)
    given = vars(parser.parse_args(arguments))
    if len(given["where"]) != {"files": 2, "kafka": 3, "mixed": 2}[given["kind"]]:
        parser.error("wrong number of places to read from")
    output, kind, where = given.pop("output"), given.pop("kind"), given.pop("where")
    return output, kind, where, Settings(**given)


def source(spark: SparkSession, kind: str, where: list[str], settings: Settings) -> DataFrame:
    if kind == "mixed":
        servers, topic = where
        return from_mixed(read_topic(spark, servers, topic, settings.offsets_per_trigger))
    if kind == "kafka":
        servers, lines, messages = where
        return unify(
            from_lines(read_topic(spark, servers, lines, settings.offsets_per_trigger)),
            from_json_messages(read_topic(spark, servers, messages, settings.offsets_per_trigger)),
        )
    lines, messages = where
    return unify(
        from_lines(read_text_stream(spark, lines, settings.files_per_trigger)),
        from_json_messages(read_text_stream(spark, messages, settings.files_per_trigger)),
    )


def main() -> None:
    output, kind, where, settings = parsed()
    spark = build_session("live ratings")
    start(source(spark, kind, where, settings), output, settings)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
