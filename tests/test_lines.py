"""Rating and movie lines: three levels of strictness."""

import math

import pytest
from conftest import rows_of

from ratingloom.functions.text import is_numeric_id, real_number, strip_slashes, trimmed, whole_number, words_from_slug
from ratingloom.sources import lines
from pyspark.sql import functions as F

LENIENT = [
    ("1::2::3.5::9", (1, 2, 3.5, 9)),
    ("1::2::x::9", (1, 2, None, 9)),
    ("a::b", (None, None, None, None)),
    ("", (None, None, None, None)),
    ("1::2::3::", (1, 2, 3.0, None)),
    ("1::2::3::4::", (1, 2, 3.0, 4)),
    ("1::2::3::4::5", (1, 2, 3.0, 4)),
    ("  1::2::3::4 ", (1, 2, 3.0, 4)),
    ("\t1::2::3::4\t", (1, 2, 3.0, 4)),
    ("::2::3::4", (None, 2, 3.0, 4)),
    ("1::2::4.0f::1", (1, 2, 4.0, 1)),
    ("1::2::1e1::1", (1, 2, 10.0, 1)),
    ("1::2::inf::1", (1, 2, None, 1)),
    ("1.9::2.0::3::4", (1, 2, 3.0, 4)),
    ("99999999999::2::3::99999999999", (None, 2, 3.0, 99999999999)),
    ("1::2::3:::4", (1, 2, 3.0, None)),
]

STRICT = [
    ("1::2::3.5::9", ("2", "3.5")),
    ("1::2::x::9", ("2", "x")),
    ("a::b", None),
    ("", None),
    (" \t ", None),
    ("::::", None),
    ("1::2::3::", None),
    ("1::2::3::4::", ("2", "3")),
    ("1::2::3::4::::", ("2", "3")),
    ("1::2::3::4::5", None),
    ("1::2::3::::5", None),
    ("  1::2::3::4 ", ("2", "3")),
    ("\t1::2::3::4\t", ("2", "3")),
    ("\x001::2::3::4\x1f", ("2", "3")),
    ("::2::3::4", ("2", "3")),
    ("1::::3::4", ("", "3")),
    ("1::2::3:::", ("2", "3")),  # the fourth field is ":"
    ("1::2::3:: ::", ("2", "3")),  # the fourth field is a blank
    ("1::2::3:: ", None),
]


def values(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "value STRING")


@pytest.mark.parametrize("line, expected", LENIENT)
def test_lenient_ratings(spark, line, expected):
    assert rows_of(lines.lenient_ratings(values(spark, [line]))) == [expected]


def test_lenient_ratings_leave_out_null_lines_only(spark):
    texts = [text for text, _ in LENIENT] + [None, None]
    assert lines.lenient_ratings(values(spark, texts)).count() == len(LENIENT)


def test_nan_is_a_rating_in_one_spelling(spark):
    rows = lines.lenient_ratings(values(spark, ["1::2::NaN::1", "1::2::nan::1", "1::2::1e999::1"])).collect()
    assert math.isnan(rows[0].rating) and rows[1].rating is None and rows[2].rating == math.inf


@pytest.mark.parametrize("line, expected", STRICT)
def test_strict_ratings(spark, line, expected):
    assert rows_of(lines.strict_ratings(values(spark, [line]))) == ([] if expected is None else [expected])


def test_replay_keeps_the_line_without_blanks_around_it(spark):
    rows = lines.replay_lines(values(spark, ["\t1::2::3::4 ", "1::2::3", None, "1::a b::x::y::"]))
    assert rows_of(rows) == [("2", "1::2::3::4"), ("a b", "1::a b::x::y::")]


def test_movies(spark):
    rows = lines.lenient_movies(values(spark, ["1::A: b (1995)::Comedy|Drama", "2::B", "3::C::", "x::D::E", None]))
    assert rows_of(rows) == sorted(
        [(1, "A: b (1995)", "Comedy|Drama"), (2, "B", None), (3, "C", ""), (None, "D", "E")], key=repr
    )


def test_text_files_and_other_charsets(spark, tmp_path):
    (tmp_path / "a.dat").write_bytes("1::Amélie::Comedy\n\n2::Léon::Crime\n".encode("latin-1"))
    rows = lines.read_movies(spark, str(tmp_path), charset="ISO-8859-1")
    assert [row for row in rows_of(rows) if row[0]] == [(1, "Amélie", "Comedy"), (2, "Léon", "Crime")]
    (tmp_path / "utf").mkdir()
    (tmp_path / "utf" / "b.dat").write_text("3::Amélie::Comedy\n")
    assert rows_of(lines.read_movies(spark, str(tmp_path / "utf"))) == [(3, "Amélie", "Comedy")]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("7", 7), (" 7 ", 7), ("+7", 7), ("-7", -7), ("7.", 7), ("7.9", 7), ("-7.9", -7), ("\t7", 7),
        ("", None), (" ", None), ("x", None), ("7x", None), ("1e3", None), ("0x1", None), ("2147483648", None),
        ("1.2.3", None), (None, None),
    ],
)
def test_whole_number(spark, text, expected):
    frame = values(spark, [text]).select(whole_number(F.col("value")))
    assert frame.first()[0] == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("4.5", 4.5), (" 4.5 ", 4.5), (".5", 0.5), ("-.5", -0.5), ("4d", 4.0), ("1e2", 100.0), ("-3", -3.0),
        ("Infinity", math.inf), ("-Infinity", -math.inf), ("inf", None), ("-inf", None), ("infinity", None),
        (" nan", None), ("INF", None), ("", None), ("x", None), ("4,5", None), (None, None),
    ],
)
def test_real_number(spark, text, expected):
    assert values(spark, [text]).select(real_number(F.col("value"))).first()[0] == expected


@pytest.mark.parametrize(
    "slug, expected",
    [
        ("inception", "Inception"),
        ("the-dark-knight", "The Dark Knight"),
        ("l'avventura", "L'Avventura"),
        ("3-idiots", "3 Idiots"),
        ("iPhone-the-movie", "IPhone The Movie"),
        ("snake_case x", "Snake_case X"),
        ("élan-vital", "éLan Vital"),
        ("a--b", "A  B"),
    ],
)
def test_words_from_slug(spark, slug, expected):
    assert values(spark, [slug]).select(words_from_slug(F.col("value"))).first()[0] == expected


def test_numeric_ids(spark):
    numeric = ["1", "-2.5", "1e3", "0x1F", "0b11", ".5", "5.", "Infinity", " 7 ", " "]
    slugs = ["inception", "NaN", "1a", "1d", "0x", "e3", "1 2", "infinity", "--1"]
    frame = values(spark, numeric + slugs).where(is_numeric_id(F.col("value")))
    assert {row.value for row in frame.collect()} == set(numeric)


def test_trim_and_slashes(spark):
    frame = values(spark, ["\x00\t /a/b/ \n"]).select(trimmed(F.col("value")).alias("t"))
    assert frame.first().t == "/a/b/"
    assert frame.select(strip_slashes(F.col("t"))).first()[0] == "a/b"
    for text, expected in [("/", ""), ("//", ""), ("///", "/"), ("a", "a"), ("", "")]:
        assert values(spark, [text]).select(strip_slashes(F.col("value"))).first()[0] == expected
