"""Ratings in the table rows of HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions import html
from ratingloom.functions.once import computed_once


def page_ratings(pages: DataFrame) -> DataFrame:
    """userId, movieId, rating, ratingRaw from `movieId` (the key of the page) and `html`.

    Rows are those of the marked class, or all rows of a page that has none. A row needs a link to a user and, in its
    first element of a `rated-` class, a positive number.
    """
    searched = computed_once(pages, "marked", html.marked_rows(F.col("html")), "movieId", "html")
    rating_rows = F.when(F.size("marked") > 0, F.col("marked")).otherwise(html.all_rows(F.col("html")))
    rows = searched.select("movieId", F.explode(rating_rows).alias("row"))
    found = F.struct(
        html.first_link(F.col("row")).alias("link"), html.rated_class(F.col("row")).alias("rated_class")
    )
    return (
        computed_once(rows, "found", found, "movieId")
        .select(
            html.user_name(F.col("found.link")).alias("userId"),
            "movieId",
            html.raw_rating(F.col("found.rated_class")).alias("ratingRaw"),
        )
        .where(F.col("userId").isNotNull() & F.col("ratingRaw").isNotNull())
        .select("userId", "movieId", html.scaled_rating(F.col("ratingRaw")).alias("rating"), "ratingRaw")
    )


def page_links(pages: DataFrame, *keys: str) -> DataFrame:
    """The user each link of a page points to, links to anything else left out."""
    return (
        pages.select(*keys, F.explode(html.links(F.col("html"))).alias("link"))
        .select(*keys, html.user_name(F.col("link")).alias("userId"))
        .where(F.col("userId").isNotNull())
    )
