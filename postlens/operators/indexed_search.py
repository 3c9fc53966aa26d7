"""Keyword search in a stored posts table with trigrams, and texts fetched last."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.search_index import PAGE_ROWS, SIZE, SearchIndex, part_of
from .search import ORDER, RESULT, matches

#: Trigrams that are looked up, the rarest of a keyword; a keyword whose rarest is in more than this share of posts is looked for in all texts.
LOOKED_UP, FREQUENT = 6, 0.02
#: Pages with candidates beyond which all texts are read, and row ranges that are asked for at once.
MOST_PAGES, MOST_RANGES = 20_000, 200


def _any(conditions: list[Column]) -> Column:
    """A balanced tree, as deep as the logarithm of the conditions."""
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def ranges(numbers: list[int], most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges, both ends included, that hold the sorted ``numbers``; the widest gaps between them stay out."""
    if not numbers:
        return []
    gaps = sorted(range(1, len(numbers)), key=lambda i: numbers[i] - numbers[i - 1], reverse=True)[: most - 1]
    cuts = [0, *sorted(i for i in gaps if numbers[i] - numbers[i - 1] > 1), len(numbers)]
    return [(numbers[a], numbers[b - 1]) for a, b in zip(cuts, cuts[1:])]


def candidate_pages(index: SearchIndex, keyword: str) -> list[int] | None:
    """Pages with posts that hold the rarest trigrams of ``keyword``, in order; ``None`` if the index cannot narrow them down.

    What comes to the driver is a count for each trigram of the keyword and at most ``MOST_PAGES`` page numbers.
    """
    needle = keyword.lower()
    wanted = sorted({needle[i : i + SIZE] for i in range(len(needle) - SIZE + 1)})
    if not wanted:
        return None
    counts = {r.gram: r.n for r in index.counts.where(F.col("gram").isin(["", *wanted])).collect()}
    total, rarest = counts.pop("", 0), sorted(wanted, key=lambda g: counts.get(g, 0))[:LOOKED_UP]
    if rarest[0] not in counts:
        return []
    if counts[rarest[0]] > FREQUENT * total:
        return None
    rarest = [g for g in rarest if counts[g] <= 100 * counts[rarest[0]]]
    parts = index.counts.sparkSession.createDataFrame([(g,) for g in rarest], "gram string").select(part_of(F.col("gram")).alias("p")).distinct().collect()
    found = index.postings.where(F.col("part").isin([r.p for r in parts]) & F.col("gram").isin(rarest))
    rows = found.groupBy("row").agg(F.count("*").alias("n")).where(F.col("n") == len(rarest))
    pages = rows.select(F.floor(F.col("row") / PAGE_ROWS).alias("page")).distinct().limit(MOST_PAGES + 1).collect()
    return sorted(r.page for r in pages) if len(pages) <= MOST_PAGES else None


def _in_ranges(spans: list[tuple[int, int]]) -> Column:
    """Posts by row, in a form that the folders and the pages of the stored table are pruned by."""
    tasks = sorted({t for a, b in spans for t in range(a >> 33, (b >> 33) + 1)})
    return F.col("task").isin(tasks) & _any([F.col("row").between(a, b) for a, b in spans])


def _candidates(index: SearchIndex, keyword: str) -> DataFrame:
    pages = candidate_pages(index, keyword)
    if pages is None:
        return index.posts
    if not pages:
        return index.posts.where(F.lit(False))
    return index.posts.where(_in_ranges([(a * PAGE_ROWS, (b + 1) * PAGE_ROWS - 1) for a, b in ranges(pages)]))


def search_count_indexed(index: SearchIndex, keyword: str) -> DataFrame:
    """What ``search_count`` gives."""
    return _candidates(index, keyword).where(matches(keyword)).agg(F.count("*").alias("hits"))


def search_indexed(index: SearchIndex, keyword: str, limit: int = 100) -> DataFrame:
    """What ``keyword_search`` gives on the stored posts, ordered.

    The trigrams of the keyword narrow the posts down and every candidate is checked, so no hit is lost and none is added. Keywords of
    under three characters, and those in very many posts, are looked for in all texts.

    Hits are ranked by their number alone, which follows id and date. Then the ``limit`` first are fetched, with those of the same id and date as the
    last of them, since among these title and text decide.
    """
    hits = _candidates(index, keyword).where(matches(keyword))
    first = hits.select("row", "id", "date").orderBy("row").limit(limit).collect()
    if not first:
        return index.posts.where(F.lit(False)).select(*RESULT)
    if len(first) == limit:
        last = first[-1]
        tied = F.col("id").eqNullSafe(last.id) & F.col("date").eqNullSafe(last.date)
        beyond = hits.where(tied & (F.col("row") > last.row))
    else:
        beyond = hits.where(F.lit(False))
    winners = index.posts.where(_in_ranges(ranges([r.row for r in first]))).where(matches(keyword))
    return winners.select(*RESULT).unionByName(beyond.select(*RESULT)).orderBy(*ORDER).limit(limit)
