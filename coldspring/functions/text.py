"""Titles, genres, tags and tokens."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker for "no genres", the articles that are moved to the
# front of a title, and the token pattern.
NO_GENRES = "(no genres listed)"
ARTICLES = "The|A|An"
TOKEN = r"(?U)\b[a-z][a-z0-9']+\b"


def _trimmed(raw: Column) -> Column:
    return F.regexp_replace(raw, r"^\s+|\s+$", "")


def title_year(raw: Column) -> Column:
    found = F.regexp_extract(_trimmed(raw), r"\((\d{4})\)$", 1)
    return F.when(found != "", found.cast("int"))


def clean_title(raw: Column) -> Column:
    """Drop a closing ``(year)`` and move a trailing article to the front."""
    body = F.regexp_replace(_trimmed(raw), r"\s*\(\d{4}\)$", "")
    bracket = F.instr(body, " (")
    main = F.when(bracket > 0, body.substr(F.lit(1), bracket - 1)).otherwise(body)
    rest = F.when(bracket > 0, body.substr(bracket, F.length(body))).otherwise(F.lit(""))
    return F.concat(F.regexp_replace(main, rf"^(.*), ({ARTICLES})$", "$2 $1"), rest)


def genre_list(raw: Column) -> Column:
    return (F.when(raw == NO_GENRES, F.array().cast("array<string>"))
            .otherwise(F.split(raw, r"\|")))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def tokens(text: Column, stop_words) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    if not stop_words:
        return found
    stop = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(found, lambda t: ~F.array_contains(stop, t))


def english_stop_words() -> tuple:
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def display_title(title: Column, year: Column) -> Column:
    return F.concat(title, F.when(year.isNull(), F.lit("")).otherwise(
        F.concat(F.lit(" ("), year.cast("string"), F.lit(")"))))


def contains_text(title: Column, query: Column) -> Column:
    """Case-blind substring match; a query below two characters finds nothing."""
    needle = F.lower(F.trim(query))
    return (F.length(needle) >= 2) & F.contains(F.lower(title), needle)
