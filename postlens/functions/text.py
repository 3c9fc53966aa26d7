"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.isspace() accepts. Spark's trim strips only
# U+0020 and Java's \s only ASCII blanks, so both are told the full set.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value, but for the look-ahead, which spares the engine an attempt at every other character.
URL = f"(?i)(?=[hw])(?:http|www)[^{UNICODE_SPACE}]+"


def remove_urls(c: Column) -> Column:
    """Drop every ``http...`` or ``www...`` run up to the next white space; NULL gives ``""``."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), URL, "")


def strip(c: Column) -> Column:
    """Strip Unicode white space at both ends; NULL gives ``""``."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit(UNICODE_SPACE))


def clean_field(c: Column) -> Column:
    """The stored form of a title or text: no URLs, stripped, lower case."""
    return F.lower(strip(remove_urls(c)))


def unmarked(c: Column) -> Column:
    """Lower-case text without links and removal marks."""
    # Links and marks.
    c = F.regexp_replace(F.lower(c), r"http\S+", "")
    return F.regexp_replace(c, r"\[removed\]|\[deleted\]", "")


def topic_text(c: Column) -> Column:
    """Text for topic models: ``unmarked``, with a blank for all but ASCII letters and blanks."""
    return F.trim(F.regexp_replace(unmarked(c), r"[^a-z\s]", " "))
