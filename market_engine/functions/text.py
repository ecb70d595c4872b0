"""Article text: cleaning, scoring input and term checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def clean_text(text: Column) -> Column:
    """Lower case without punctuation; NULL gives an empty string."""
    return F.coalesce(F.trim(F.lower(F.regexp_replace(text, r"[^\w\s]", ""))), F.lit(""))


def sentiment_text(title: Column, text: Column) -> Column:
    return F.when(~blank(text), F.concat_ws(" ", title, text)).otherwise(title)


def _mentions(text: Column, term: Column) -> Column:
    return F.contains(F.upper(F.coalesce(text, F.lit(""))), F.upper(term))


def term_in_either(title: Column, text: Column, term: Column) -> Column:
    return _mentions(title, term) | _mentions(text, term)


def term_in_both(title: Column, text: Column, term: Column) -> Column:
    return _mentions(title, term) & _mentions(text, term)


def search_terms(terms: Column) -> Column:
    return F.when(F.size(terms) > 0, F.array_join(terms, ", ")).otherwise(F.lit("ticker"))
