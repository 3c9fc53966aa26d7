"""Column functions: text, date and lexicon expressions built from Spark built-ins."""

from .dates import parse_ts
from .lexicon import FIRST_PERSON, lexicon_hits, word_count
from .text import clean_field, remove_urls, strip, topic_text, unmarked

__all__ = [
    "FIRST_PERSON",
    "clean_field",
    "lexicon_hits",
    "parse_ts",
    "remove_urls",
    "strip",
    "topic_text",
    "unmarked",
    "word_count",
]
