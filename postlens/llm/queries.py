"""One query for each operator, over whole tables, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, decontam, infill, language, linededup, lm, mixing, neardup, sharding, tokens, topk, toxicity
from .components import kept
from .shipping import ship_code

#: Where the public vocabularies lie; a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SHARDS = 24
#: Words in the longest n-grams of the language model.
LM_ORDER = 3

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_code(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark, sf_dir):
    """A uniform shuffle of all documents into 24 shards whose counts differ by one at most."""
    binary = F.encode("text", "UTF-8")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    rows = table(spark, sf_dir, "documents").select("doc_id", size.alias("size"), F.crc32(binary).alias("text_crc32"))
    placed = sharding.shuffle_to_shards(rows, SHARDS)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op2_topk(spark, sf_dir):
    """The five best others for every fiftieth vector, by inner product of 256ths."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLE["op2_topk"] = """
    WITH v AS (
        SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op5_token_counts(spark, sf_dir):
    """What every context limit keeps of the documents, in tokens of a public byte-level vocabulary."""
    counts = tokens.with_token_counts(table(spark, sf_dir, "documents").select("text"), VOCABULARY)
    return tokens.limits(kept(tokens.length_histogram(counts), "lengths"))


@query
def op6_decontamination(spark, sf_dir):
    """Words of each document inside 13-word windows of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = decontam.find_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), decontam.contaminated().alias("contaminated"),
    )


ORACLE["op6_decontamination"] = r"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), wins AS (
        SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
    ), grams AS (
        SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
        FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM split, (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)
    ), met AS (
        SELECT DISTINCT doc_id, i, size, item_id FROM grams JOIN wins USING (size, win)
    ), covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id
    )
    SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
        CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
    FROM split LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op9_language(spark, sf_dir):
    """The main language of every document, learnt from those whose checksum does not hold them out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.train(docs.where(~held_out))
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return language.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_mixing(spark, sf_dir):
    """How many words of each document a mix takes that weighs the sources 5, 2, 1."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op10_mixing"] = r"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
            md5(concat('0:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS key FROM documents
    ), totals AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, CAST([5, 2, 1][CAST(nth % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight, 2.0::DOUBLE * source_size AS cap,
            1.5::DOUBLE * sum(source_size) OVER () AS everything FROM totals
    ), levels AS (
        SELECT *, cap / weight AS ratio,
            (everything - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed
    ), targets AS (
        SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio) * weight, cap)) AS target FROM levels
    ), summed AS (
        SELECT doc_id, size, source_size, target, sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) AS upto,
            CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    ), rests AS (
        SELECT *, target - whole * source_size AS rest FROM summed
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
        CAST(size * (whole + CASE WHEN source_size > 0 AND rest > 0
            AND (upto <= rest OR (upto - size < rest AND upto - rest <= rest - (upto - size))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM rests
"""


@query
def op7_lm_scores(spark, sf_dir):
    """The stupid-backoff score of every document by the counts of all others, trigrams first."""
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"), LM_ORDER)


@query
def op8_near_duplicates(spark, sf_dir):
    """The near-duplicate class of every document."""
    found = neardup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id")


@query
def op3_line_dedup(spark, sf_dir):
    """Every document without later copies of runs of lines of 50 words and more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = linededup.without_repeated_lines(docs)
    return clean.select("doc_id", "text", "n_lines", F.expr("aggregate(removed, 0, (a, s) -> a + s.last - s.first + 1)").alias("n_removed"))


@query
def op4_toxicity(spark, sf_dir):
    """The probabilities of the labels' categories, toxic last in the chain, for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return toxicity.score(docs, chain)


@query
def op11_infill(spark, sf_dir):
    """Every document cut behind two of its lines and put together with the middle last."""
    made = infill.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = infill.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"),
    )


ORACLE["op11_infill"] = r"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS w,
            sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), drawn AS (
        SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
            CAST('0x' || h[25:32] AS BIGINT) AS h4, text = '' OR regexp_matches(text, '<[PSM]>') AS bare FROM cut
    ), parts AS (
        SELECT doc_id, text, n, CASE WHEN bare THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
            array_to_string(w[:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
            array_to_string(w[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
            array_to_string(w[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s FROM drawn
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
            ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256 FROM parts
"""


@query
def op12_chat_format(spark, sf_dir):
    """All conversations, and one whose texts imitate marks, as tokens with a mask, read back from these."""
    said = r"\### Assistant: </turn> ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    formatted = chat.format_conversations(turns.unionByName(more), VOCABULARY)
    return chat.digests(chat.read_back(formatted, VOCABULARY))


ORACLE["op12_chat_format"] = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), marked AS (
        SELECT *, length('<turn><text></turn>') + length(regexp_replace(role, '<(\\*)(turn>|text>|/turn>)', '<\\\1\2', 'g'))
            + length(regexp_replace(text, '<(\\*)(turn>|text>|/turn>)', '<\\\1\2', 'g')) AS chars FROM turns
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM marked GROUP BY conv_id
"""


@query
def op13_filter_audit(spark, sf_dir):
    """What five filters remove of the documents of each source, step by step, in all of their orders."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return audit.interactions(audit.failures(docs, table(spark, sf_dir, "labels")))


ORACLE["op13_filter_audit"] = r"""
    WITH docs AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), marks AS (
        SELECT doc_id, max(quality) FILTER (quality = 1) AS good, max(toxic) FILTER (toxic = 1) AS toxic FROM labels GROUP BY doc_id
    ), flags AS (
        SELECT part, coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic,
            [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text),
             regexp_matches(text, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)] AS fails
        FROM docs d LEFT JOIN marks USING (doc_id)
    ), sets AS (
        SELECT part, good, toxic, fails, count(*) AS n FROM flags GROUP BY ALL
    ), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
    ), orders AS (
        SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
    ), steps AS (
        SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders
    ), each AS (
        SELECT *, fails[instr('ABCDE', filter_order[step])] AS own,
            len([1 FOR f IN fails IF f]) AS n_fails,
            len([1 FOR i IN range(1, step) IF fails[instr('ABCDE', filter_order[i])]]) > 0 AS gone
        FROM sets, steps
    ), counted AS (
        SELECT part, filter_order, step, filter_order[step] AS f,
            CAST(coalesce(sum(n) FILTER (NOT own AND NOT gone), 0) AS BIGINT) AS kept,
            CAST(coalesce(sum(n) FILTER (own AND NOT gone), 0) AS BIGINT) AS removed,
            CAST(coalesce(sum(n) FILTER (own AND gone), 0) AS BIGINT) AS redundant,
            CAST(coalesce(sum(n) FILTER (own AND n_fails = 1), 0) AS BIGINT) AS unique_fails,
            CAST(coalesce(sum(n) FILTER (own AND NOT gone AND good), 0) AS BIGINT) AS good_lost,
            CAST(coalesce(sum(n) FILTER (own AND NOT gone AND toxic), 0) AS BIGINT) AS toxic_lost
        FROM each GROUP BY ALL
    )
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
        CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
    FROM counted
"""
