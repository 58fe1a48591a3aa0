"""Schemas of everything the engine reads and writes, as DDL strings."""

from __future__ import annotations

RATINGS = "userId INT, movieId INT, rating DOUBLE, timestamp BIGINT"
MOVIES = "movieId INT, title STRING, genres STRING"

# What a JSON rating message may carry; the older producers send three more fields, which nothing reads.
JSON_MESSAGE = "userId STRING, movieId STRING, rating DOUBLE, source STRING, timestamp BIGINT"
OLDER_JSON_MESSAGE = (
    "userId STRING, movieId STRING, rating DOUBLE, ratingRaw DOUBLE, title STRING, voteCount INT, "
    "source STRING, timestamp BIGINT"
)

MOVIE_STATS = "movieId INT, title STRING, avgRating DOUBLE, totalVotes BIGINT"
GENRE_STATS = "genre STRING, avgRating DOUBLE, totalRatings BIGINT"
RATING_DISTRIBUTION = "rating DOUBLE, count BIGINT"
ARCHIVE = "userId STRING, movieId STRING, rating DOUBLE, source STRING, event_ts BIGINT"
ARCHIVE_COLUMNS = ("userId", "movieId", "rating", "source", "event_ts")

CELLS = (
    "row_key STRING, family STRING, qualifier STRING, value STRING, version_ts BIGINT, put_id BIGINT, "
    "level STRING, batch_id BIGINT, day BIGINT, bucket INT"
)
CELL_COLUMNS = ("row_key", "family", "qualifier", "value", "version_ts", "put_id")
