"""Lexicon measures of one text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# First-person singular pronouns.
FIRST_PERSON = ("i", "me", "my", "myself", "mine")


def lexicon_hits(c: Column, words: Sequence[str] = FIRST_PERSON) -> Column:
    """How often any of ``words`` occurs as a whole word, ignoring case.

    The look-ahead for a first letter spares the engine the word-boundary test elsewhere. Without words there are no hits
    (null for a null text, as with words).
    """
    words = [w.lower() for w in words if w]
    if not words:
        return F.when(c.isNotNull(), F.lit(0))
    initials = "".join(sorted({re.escape(w[0]) for w in words}))
    alternatives = "|".join(re.escape(w) for w in words)
    pattern = rf"(?U)(?=[{initials}])\b(?:{alternatives})\b"
    return F.regexp_count(F.lower(c), F.lit(pattern))


def word_count(c: Column) -> Column:
    """Number of single-space separated pieces; an empty text counts as one piece."""
    return F.size(F.split(c, " "))
