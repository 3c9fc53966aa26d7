"""Lexicon use per class."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import FIRST_PERSON, lexicon_hits, word_count

#: Bytes of word lists up to which they are sent to every task; larger ones meet the words by a shuffle.
BROADCAST_BYTES = 8 << 20


def with_lexicon(df: DataFrame, words: Sequence[str] = FIRST_PERSON) -> DataFrame:
    """Add ``hits`` and ``words``, the two counts of one text.

    To be called before a join that brings the label: the join then moves two numbers a post and
    not its text.
    """
    text = F.coalesce("text", F.lit(""))
    return df.withColumns(
        {"hits": lexicon_hits(text, words), "words": word_count(text)}
    )


def lexicon_ratio(
    posts: DataFrame, words: Sequence[str] = FIRST_PERSON, name: str = "avg_self_ref"
) -> DataFrame:
    """Mean over posts of (lexicon hits / words), per label; counts ``with_lexicon`` are kept.

    The mean of per-post ratios, not the ratio of sums. An empty or missing text has no hits and
    counts as ratio 0, also where it was missing from the side that was measured.
    """
    if "hits" not in posts.columns:
        posts = with_lexicon(posts, words)
    return posts.groupBy("label").agg(F.avg(F.coalesce(F.try_divide("hits", "words"), F.lit(0.0))).alias(name))


def _entries(spark: SparkSession, lexicons: Mapping[str, Sequence[str]]) -> tuple[DataFrame, int]:
    """``(category, nth, n, p0, p1, ...)``, every entry of the lists by its words and what stands between, and the most pieces of one."""
    rows = []
    for category, words in lexicons.items():
        for nth, word in enumerate(dict.fromkeys(w.lower() for w in words if w)):
            pieces = re.findall(r"\w+|\W+", word)
            if not (re.match(r"\w", pieces[0]) and re.match(r"\w", pieces[-1])):
                raise ValueError(f"an entry begins and ends with a letter or digit: {word!r}")
            rows.append((category, nth, len(pieces), pieces))
    most = max((len(r[3]) for r in rows), default=1)
    filled = [(*r[:3], *r[3], *[None] * (most - r[2])) for r in rows]
    schema = "category string, nth int, n int, " + ", ".join(f"e{i} string" for i in range(most))
    entries = spark.createDataFrame(filled, schema)
    size = sum(len(piece) + 32 for r in rows for piece in r[3])
    return (F.broadcast(entries) if size <= BROADCAST_BYTES else entries), most


def with_lexicons(df: DataFrame, lexicons: Mapping[str, Sequence[str]], key: str = "post_id") -> DataFrame:
    """Add ``words`` and ``hits_by``, the hits of one text by list, for any number of word lists in one reading.

    Each list counts as in ``lexicon_hits``: whole words or phrases, ignoring case, from left to right without overlaps, an entry before
    the later ones of its list. A list without hits is not in ``hits_by``. ``key`` tells the rows apart; entries begin and end with a letter or digit.

    A text is cut into words and what stands between. A word that begins an entry meets it in a join on that word, and the pieces behind it are
    compared there. Lists of a size that is checked are sent to every task, and then only hits are shuffled.
    """
    entries, most = _entries(df.sparkSession, lexicons)
    pieces = df.select(key, F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?U)\w+|\W+"), F.lit(0)).alias("p"))
    each = pieces.select(key, "p", F.posexplode("p").alias("at", "p0"))
    rows = each.select(key, "at", "p0", *[F.get("p", F.col("at") + i).alias(f"p{i}") for i in range(1, most)])
    same = F.col("p0") == F.col("e0")
    for i in range(1, most):
        same = same & (F.col(f"e{i}").isNull() | (F.col(f"e{i}") == F.col(f"p{i}")))
    found = rows.join(entries, same).groupBy(key, "category").agg(F.array_sort(F.collect_list(F.struct("at", "nth", "n"))).alias("c"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("hits"))
    counted = F.aggregate("c", start, lambda s, c: F.when(c["at"] >= s["end"], F.struct((c["at"] + c["n"]).alias("end"), (s["hits"] + 1).alias("hits"))).otherwise(s))
    hits = found.select(key, F.struct("category", counted["hits"].alias("hits")).alias("h")).groupBy(key).agg(F.map_from_entries(F.collect_list("h")).alias("hits_by"))
    none = F.create_map().cast("map<string,int>")
    return df.withColumn("words", word_count(F.coalesce("text", F.lit("")))).join(hits, key, "left").withColumn("hits_by", F.coalesce("hits_by", none))


def lexicon_ratios(posts: DataFrame, lexicons: Mapping[str, Sequence[str]], key: str = "post_id") -> DataFrame:
    """``(label, category, ratio)``: the mean of ``lexicon_ratio`` for every list, all in one reading; counts ``with_lexicons`` are kept."""
    if "hits_by" not in posts.columns:
        posts = with_lexicons(posts, lexicons, key)
    hits = [F.coalesce(F.try_element_at("hits_by", F.lit(c)), F.lit(0)) for c in lexicons]
    means = [F.avg(F.coalesce(F.try_divide(h, "words"), F.lit(0.0))) for h in hits]
    per_label = posts.groupBy("label").agg(F.array(*[F.struct(F.lit(c).alias("category"), m.alias("ratio")) for c, m in zip(lexicons, means)]).alias("each"))
    return per_label.select("label", F.inline("each"))
