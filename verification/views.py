"""The given tables seen as ratings, movies, rating lines, messages and pages; each view once for Spark, once in SQL.

No view leaves rows out. Lines and messages get one of several defects by a remainder of the user, so that every parser
rule meets many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.fixed_values import LINE_SOURCE, PAGE_ROW_CLASS
from ratingloom.functions.html import LINK_PATTERN
from ratingloom.functions.once import computed_once
from ratingloom.sources.streams import read_table_stream

NOW_MS = 1_700_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_as_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_table_stream(spark, path, spark.read.parquet(path).schema)


def with_views(sql: str, *views: str) -> str:
    """The query with the SQL of the named views, and of those they build on, in front."""
    needed: list[str] = []

    def add(name: str) -> None:
        text, parents = SQL_VIEWS[name]
        for parent in parents:
            add(parent)
        entry = f"{name}_view AS ({text})"
        if entry not in needed:
            needed.append(entry)

    for view in views:
        add(view)
    return f"WITH {', '.join(needed)} {sql}"


def round2(expression: str) -> str:
    """Round the printed decimals half up, as Spark does; DuckDB would round the binary value."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def exact_mean(rating: str) -> str:
    """The mean of two-decimal values, from a sum that no order of rows can change."""
    return round2(f"CAST(sum(CAST({rating} AS DECIMAL(18, 2))) AS DOUBLE) / nullif(count({rating}), 0)")


# Ratings: half steps from 0.5 to 5.0; seconds do not depend on the time zone of the session.
_SPARK_RATING = [
    "l_orderkey AS userId",
    "l_partkey AS movieId",
    "CAST(((CAST(l_quantity AS INT) % 10) + 1) / 2.0D AS DOUBLE) AS rating",
    "CAST(l_shipdate - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS BIGINT) AS timestamp",
]

# One line per remainder of the user by 16: most defects a line can have, and two lines without any.
LINE_TEMPLATES = [
    "{u}::{m}::{r}::{t}",
    "{u}::{m}::x::{t}",
    "{u}::{m}",
    "",
    "{u}::{m}::{r}::",
    "{u}::{m}::{r}::{t}::",
    "{u}::{m}::{r}::{t}::5",
    "  {u}::{m}::{r}::{t} ",
    "\t{u}::{m}::{r}::{t}\t",
    "::{m}::{r}::{t}",
    "{u}::{m}::{r}f::{t}",
    "{u}::{m}::{r}e0::{t}",
    "{u}.0::{m}.7::{r}::{t}",
    "{u}::::{r}::{t}",
    None,
    "{u}::{m}::{r}::{t}",
]

# One message per remainder of the user by 8.
JSON_TEMPLATES = [
    '{"userId":"{u}","movieId":"{m}","rating":{r},"source":"s","timestamp":{t}}',
    "garbage {u}",
    '{"userId":"{u}","movieId":"{m}","rating":"{r}","source":"s","timestamp":{t}}',
    '{"userId":"{u}","movieId":"{m}","rating":4,5,"source":"s","timestamp":{t}}',
    '{"userId":"{u}","rating":{r},"source":"s","timestamp":{t}}',
    '{"userId":"{u}","movieId":"{m}","rating":{r},"ratingRaw":9,"title":"A \\"b\\"","voteCount":3,"source":"s",'
    '"timestamp":{t}}',
    '{"userId":"{u}","movieId":"{m}","rating":{r},"source":"s","timestamp":"x"}',
    '{"userId":"{u}","movieId":"{m}","rating":{r},"source":"s","timestamp":{t}}',
]

# One line per remainder of the movie by 6.
MOVIE_TEMPLATES = ["{m}::{n}::{g}", "{m}::{n}", "{m}::{n}::", "x{m}::{n}::{g}", "{m}", "{m}::{n}::{g}"]


def filled(templates: list[str | None], number: str, parts: str) -> Column:
    """The template for the column `number`, with the one-letter columns `parts` put in."""
    text = F.element_at(F.array(*[F.lit(t) for t in templates]), (F.col(number) % len(templates) + 1).cast("int"))
    for part in parts:
        text = F.replace(text, F.lit(f"{{{part}}}"), F.col(part))
    return text


def filled_sql(templates: list[str | None], number: str, parts: str) -> str:
    """The same for DuckDB."""
    texts = ", ".join("NULL" if t is None else "'" + t.replace("'", "''") + "'" for t in templates)
    sql = f"list_extract([{texts}], {number} % {len(templates)} + 1)"
    for part in parts:
        sql = f"replace({sql}, '{{{part}}}', {part})"
    return sql


def _rating_parts(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(*_SPARK_RATING, "l_linenumber").selectExpr(
        "userId AS n",
        "l_linenumber",
        "CAST(userId AS STRING) AS u",
        "CAST(movieId AS STRING) AS m",
        "CAST(rating AS STRING) AS r",
        "CAST(timestamp AS STRING) AS t",
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_SPARK_RATING)


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS movieId", "p_name AS title", "concat(p_type, '|', p_brand) AS genres"
    )


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(table(spark, sf_dir, "lineitem"), "value")


def lines_of(lineitem: DataFrame, name: str) -> DataFrame:
    return computed_once(_rating_parts(lineitem), name, filled(LINE_TEMPLATES, "n", "umrt"))


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = movies(spark, sf_dir).selectExpr("movieId", "CAST(movieId AS STRING) AS m", "title AS n", "genres AS g")
    return computed_once(parts, "value", filled(MOVIE_TEMPLATES, "movieId", "mng"))


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return computed_once(_rating_parts(table(spark, sf_dir, "lineitem")), "raw", filled(JSON_TEMPLATES, "n", "umrt"))


def mixed_texts(lineitem: DataFrame) -> DataFrame:
    text = F.when(F.col("l_linenumber") % 2 == 0, filled(LINE_TEMPLATES, "n", "umrt")).otherwise(
        filled(JSON_TEMPLATES, "n", "umrt")
    )
    return computed_once(_rating_parts(lineitem), "raw", text)


def event_messages(events: DataFrame) -> DataFrame:
    """Events as JSON rating messages of several sources, with slugs for movies."""
    return events.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("user"), F.col("user_id")).alias("userId"),
                F.concat(F.lit("item-"), F.get_json_object("props", "$.k")).alias("movieId"),
                F.col("value").alias("rating"),
                F.col("event_type").alias("source"),
                event_ms(F.col("ts")).alias("timestamp"),
            )
        ).alias("raw")
    )


def event_ms(ts: Column) -> Column:
    seconds = (ts - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).cast("decimal(20,6)")
    return F.floor(seconds * 1000).cast("bigint")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an archive of normalised ratings."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        F.get_json_object("props", "$.k").alias("movieId"),
        F.col("value").alias("rating"),
        F.col("event_type").alias("source"),
        event_ms(F.col("ts")).alias("event_ts"),
    )


def rated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page followed by a table of ratings, one row per link of the page; a third of them without marked rows."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id AS movieId",
        f"""concat(html, '<table><tbody>', array_join(transform(regexp_extract_all(html, {_quoted(LINK_PATTERN)}, 1),
            (x, i) -> concat('<tr',
                CASE WHEN page_id % 3 <> 0 AND i % 4 <> 0 THEN ' class="odd {PAGE_ROW_CLASS}"' ELSE '' END,
                '><td><a class="name" href="', x, '/">who</a></td><td><span class="rating ',
                {_PAGE_TOKEN}, '">*</span></td></tr>')), ''), '</tbody></table>') AS html""",
    )


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


_PAGE_TOKEN = """CASE (i + page_id) % 7 WHEN 0 THEN 'unrated-9' WHEN 1 THEN 'rated-8x rated-7' WHEN 2 THEN 'rated-0'
    ELSE concat('rated-', (i * 3 + page_id) % 10 + 1) END"""

_SQL_PARTS = """SELECT userId AS n, l_linenumber, CAST(userId AS VARCHAR) AS u, CAST(movieId AS VARCHAR) AS m,
    CAST(rating AS VARCHAR) AS r, CAST(timestamp AS VARCHAR) AS t FROM ratings_view"""

_LINK_SQL = "'" + LINK_PATTERN.replace("'", "''") + "'"

# The last character of a number may be a Java type suffix; ids may have a fraction, which is cut off.
_SQL_REAL = "TRY_CAST(regexp_replace(trim({0}, ' ' || chr(9)), '[fFdD]$', '') AS DOUBLE)"
_SQL_WHOLE = r"TRY_CAST(regexp_extract({0}, '^\s*([+-]?\d+)(?:\.\d*)?\s*$', 1) AS {1})"


def sql_real(text: str) -> str:
    return _SQL_REAL.format(text)


def sql_whole(text: str, kind: str = "INTEGER") -> str:
    return _SQL_WHOLE.format(text, kind)


# name -> (SQL, views it builds on)
SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "ratings": (
        """SELECT l_orderkey AS userId, l_partkey AS movieId, l_linenumber,
            CAST(((CAST(l_quantity AS INTEGER) % 10) + 1) / 2.0 AS DOUBLE) AS rating,
            CAST(floor(epoch(l_shipdate)) AS BIGINT) AS timestamp FROM lineitem""",
        (),
    ),
    "movies": ("SELECT p_partkey AS movieId, p_name AS title, concat(p_type, '|', p_brand) AS genres FROM part", ()),
    "genres": ("SELECT movieId, unnest(string_split(genres, '|')) AS genre FROM movies_view", ("movies",)),
    "movie_stats": (
        f"""SELECT movieId, title, avgRating, totalVotes FROM (SELECT movieId, {round2('avg(rating)')} AS avgRating,
            count(rating) AS totalVotes FROM ratings_view GROUP BY movieId) JOIN movies_view USING (movieId)""",
        ("ratings", "movies"),
    ),
    "genre_stats": (
        f"""SELECT genre, {round2('avg(rating)')} AS avgRating, count(rating) AS totalRatings
            FROM ratings_view JOIN genres_view USING (movieId) GROUP BY genre""",
        ("ratings", "genres"),
    ),
    "movie_lines": (
        f"""SELECT {filled_sql(MOVIE_TEMPLATES, 'movieId', 'mng')} AS value
            FROM (SELECT movieId, CAST(movieId AS VARCHAR) AS m, title AS n, genres AS g FROM movies_view)""",
        ("movies",),
    ),
    "lines": (f"SELECT {filled_sql(LINE_TEMPLATES, 'n', 'umrt')} AS value FROM ({_SQL_PARTS})", ("ratings",)),
    "lenient": (
        f"""SELECT {sql_whole('p[1]')} AS userId, {sql_whole('p[2]')} AS movieId, {sql_real('p[3]')} AS rating,
            {sql_whole('p[4]', 'BIGINT')} AS timestamp
            FROM (SELECT string_split(value, '::') AS p FROM lines_view WHERE value IS NOT NULL)""",
        ("lines",),
    ),
    "strict": (
        # Empty fields at the end do not count.
        """SELECT line, p[2] AS movieId, p[3] AS rating FROM (
            SELECT line, string_split(regexp_replace(line, '(::)+$', ''), '::') AS p
            FROM (SELECT trim(value, ' ' || chr(9)) AS line FROM lines_view) WHERE line <> '') WHERE len(p) = 4""",
        ("lines",),
    ),
    "strict_means": (
        f"""SELECT movieId, printf('%.2f', {round2('avg(r)')}) AS avg, count(r) AS count
            FROM (SELECT movieId, {sql_real('rating')} AS r FROM strict_view) WHERE r IS NOT NULL GROUP BY movieId""",
        ("strict",),
    ),
    "line_stream": (
        f"""SELECT p[1] AS userId, p[2] AS movieId, {sql_real('p[3]')} AS rating, '{LINE_SOURCE}' AS source,
            {sql_whole('p[4]', 'BIGINT')} * 1000 AS event_ts
            FROM (SELECT string_split(value, '::') AS p FROM lines_view WHERE value IS NOT NULL)
            WHERE p[2] IS NOT NULL AND {sql_real('p[3]')} IS NOT NULL""",
        ("lines",),
    ),
    "events_archive": (
        """SELECT CAST(user_id AS VARCHAR) AS userId, json_extract_string(props, '$.k') AS movieId, value AS rating,
            event_type AS source, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS event_ts FROM events""",
        (),
    ),
    "event_stream": (
        """SELECT 'user' || userId AS userId, 'item-' || movieId AS movieId, rating, source, event_ts
            FROM events_archive_view""",
        ("events_archive",),
    ),
    "unified": ("SELECT * FROM line_stream_view UNION ALL SELECT * FROM event_stream_view", ("line_stream", "event_stream")),
    "json_texts": (f"SELECT {filled_sql(JSON_TEMPLATES, 'n', 'umrt')} AS raw FROM ({_SQL_PARTS})", ("ratings",)),
    "mixed": (
        f"""SELECT CASE WHEN l_linenumber % 2 = 0 THEN {filled_sql(LINE_TEMPLATES, 'n', 'umrt')}
            ELSE {filled_sql(JSON_TEMPLATES, 'n', 'umrt')} END AS raw FROM ({_SQL_PARTS})""",
        ("ratings",),
    ),
    "recent": (
        """SELECT userId, movieId, rating, source, event_ts FROM (SELECT *, row_number() OVER (PARTITION BY movieId
            ORDER BY event_ts DESC, userId, rating, source) AS rank FROM events_archive_view) WHERE rank <= 15""",
        ("events_archive",),
    ),
    "sample": (
        """SELECT * FROM recent_view ORDER BY md5(concat_ws('|', '0', movieId, userId, source,
            CAST(event_ts AS VARCHAR))), rating LIMIT 120""",
        ("recent",),
    ),
    "links": (
        f"""SELECT page_id, unnest(l) AS link, unnest(range(len(l))) AS i
            FROM (SELECT page_id, regexp_extract_all(html, {_LINK_SQL}, 1) AS l FROM pages)""",
        (),
    ),
}


def sql_json_rows(raw: str, view: str, keep: str = "TRUE") -> str:
    """Valid messages whose rating and timestamp are JSON numbers, of the texts `raw` in `view`."""
    return f"""SELECT json_extract_string({raw}, '$.userId') AS userId, json_extract_string({raw}, '$.movieId') AS movieId,
        TRY_CAST(json_extract_string({raw}, '$.rating') AS DOUBLE) AS rating,
        json_extract_string({raw}, '$.source') AS source,
        TRY_CAST(json_extract_string({raw}, '$.timestamp') AS BIGINT) AS event_ts
        FROM (SELECT {raw} FROM {view} WHERE {keep} AND json_valid({raw}))
        WHERE json_type({raw}, '$.rating') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
        AND json_type({raw}, '$.timestamp') IN ('UBIGINT', 'BIGINT')
        AND json_extract_string({raw}, '$.movieId') IS NOT NULL"""
