"""Values that results depend on and that are therefore not free to choose."""

# Input formats, tags, names and defaults. They must stay as they are for results to match.
FIELD_SEPARATOR = "::"
GENRE_SEPARATOR = "|"
TEXT_OUTPUT_SEPARATOR = "\t"
LINE_FIELD_COUNT = 4
JSON_FIRST_CHARACTER = "{"

LINE_SOURCE = "movielens"
JSON_SOURCE = "letterboxd"
BATCH_SOURCE = "batch"

PAGE_ROW_CLASS = "table-film-detail"
RATED_CLASS_PREFIX = "rated-"

MIN_VOTES = 100
TOP_MOVIES = 10
TOP_STRICT_MEANS = 20
RECENT_PER_MOVIE = 15
SAMPLE_SIZE = 120
FEED_SIZE = 30
CONSOLE_ROWS = 20
STRICT_OUTPUT_PARTITIONS = 2

MOVIE_STATS_TRIGGER = "5 seconds"
SOURCE_STATS_TRIGGER = "10 seconds"
ARCHIVE_TRIGGER = "10 seconds"
CELL_TRIGGER = "10 seconds"

MAX_CELL_VERSIONS = 5
CELL_TIME_TO_LIVE_MS = 7 * 24 * 60 * 60 * 1000

CELL_FAMILIES = {
    "movie_stats": ("info", "ratings", "meta"),
    "genre_stats": ("info", "ratings"),
    "real_time_ratings": ("info", "ratings", "meta"),
    "rating_alerts": ("info", "meta"),
}

MISSING_NAME = "—"
UNKNOWN_MOVIE = "unknown"
