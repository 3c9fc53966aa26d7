"""The registered queries in plain SQL, written against the raw tables.

No text here is made from the Spark side, so that the two can disagree.
"""

from __future__ import annotations

# The English stop words of three letters and more that consist of letters only.
# (A token never holds an apostrophe, so the other stop words cannot match one.)
STOPS = (
    "myself", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves", "him", "his",
    "himself", "she", "her", "hers", "herself", "its", "itself", "they", "them", "their", "theirs",
    "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "are", "was", "were",
    "been", "being", "have", "has", "had", "having", "does", "did", "doing", "the", "and", "but", "because",
    "until", "while", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "from", "down", "out", "off", "over", "under", "again", "further", "then",
    "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "nor", "not", "only", "own", "same", "than", "too", "very", "can",
    "will", "just", "don", "should", "now", "cannot", "could", "ought", "would",
)
# Frequent words removed on top.
TRAINING = (
    "like", "get", "one", "think", "really", "know", "even", "actually", "also", "good", "well", "would",
    "could", "haha", "yea", "yup",
)
TOPIC = (
    "like", "just", "know", "think", "really", "want", "people", "make", "good", "time",
)


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# The text of a document as a post, and everything a post has.
TEXTS = r"""
    SELECT d.doc_id AS post_id,
           split_part(d.text, chr(10), 1) AS title,
           d.text || CASE WHEN d.source IN ('src0', 'src1', 'src2', 'src3', 'src4')
                          THEN ' I told myself it was mine'
                          WHEN d.source IN ('src5', 'src6', 'src7', 'src8')
                          THEN ' see http://ex.org/a?b=1 or WWW.ex.org now'
                          WHEN d.source IN ('src9', 'src10', 'src11') THEN ' [removed]'
                          ELSE '' END AS text,
           d.source AS info
    FROM documents d
"""
EVENTS = r"""
    SELECT event_id AS post_id, user_id,
           'u' || CAST(user_id AS VARCHAR) AS id,
           CASE WHEN event_type = 'error' AND value < 20 THEN ''
                WHEN event_type = 'error' AND value >= 100 THEN '2024-13-01 00:00:00'
                ELSE strftime(
                    ts - to_months(CAST(12 * least(floor(value / 30), 3) AS INT)
                                   + CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
                                                     WHEN 'purchase' THEN 3 ELSE 0 END),
                    '%Y-%m-%d %H:%M:%S') END AS date
    FROM events
"""
LABELS = r"""
    SELECT doc_id AS user_id,
           CASE WHEN toxic = 1 AND quality = 0 THEN 'n/a' WHEN toxic = 1 THEN '2'
                WHEN quality = 1 THEN '1' WHEN quality = 0 THEN '0' END AS label
    FROM labels
"""
WITH = f"""
WITH texts AS ({TEXTS}), authored AS ({EVENTS}), labelled AS ({LABELS}),
raw AS (
    SELECT a.post_id, a.id, t.title, a.date, t.text, t.info, l.label,
           coalesce(length(t.title) + length(t.text), 0) AS total_len
    FROM authored a LEFT JOIN labelled l ON a.user_id = l.user_id
                    LEFT JOIN texts t ON a.post_id = t.post_id
),
posts AS (
    SELECT post_id, coalesce(id, '') AS id, coalesce(title, '') AS title,
           coalesce(date, '') AS date, coalesce(text, '') AS text, coalesce(info, '') AS info,
           try_cast(label AS INT) AS label, CAST(total_len AS INT) AS total_len,
           try_strptime(date, '%Y-%m-%d %H:%M:%S') AS ts
    FROM raw WHERE try_cast(label AS INT) IS NOT NULL
),
dated AS (SELECT * FROM posts WHERE ts IS NOT NULL),
names(label, label_name) AS (VALUES (0, 'Control (Sani)'), (1, 'Depression'), (2, 'Anorexia')),
hours AS (
    SELECT label, CAST(hour(ts) AS INT) AS hour, count(*) AS count FROM dated GROUP BY ALL
),
daily AS (
    SELECT CAST(ts AS DATE) AS post_date, count(*) AS post_count FROM dated GROUP BY 1
)
"""

ORACLE: dict[str, str] = {}


def _add(name: str, select: str, ctes: str = "") -> None:
    ORACLE[name] = WITH + ("," + ctes if ctes else "") + select


_add("clean_posts", "SELECT post_id, id, title, date, text, info, label, total_len, ts FROM posts")

_add("overview", "SELECT count(*) AS total_posts, count(DISTINCT id) AS unique_users FROM posts")

_add("cached_overview", "SELECT count(*) AS total_posts, count(DISTINCT id) AS unique_users, CAST(count(*) AS INT) AS cached_rows FROM posts")
_add("empty_topics", "SELECT count(*) AS topics, count(*) AS terms FROM posts WHERE label = 9")

_add(
    "label_counts_share",
    """
    SELECT label, count, round(count / sum(count) OVER (), 6) AS share, label_name
    FROM (SELECT label, count(*) AS count FROM posts GROUP BY 1) LEFT JOIN names USING (label)
    """,
)

_add(
    "label_names_joined",
    """
    SELECT label, count, label_name
    FROM (SELECT label, count(*) AS count FROM posts GROUP BY 1) LEFT JOIN names USING (label)
    """,
)

_add(
    "label_length_stats",
    """
    SELECT label, round(v, 3) AS normalized_volume, round(s, 3) AS variance,
           round(v / sum(v) OVER (), 3) AS share, label_name
    FROM (SELECT label, avg(total_len) AS v, var_samp(total_len) AS s FROM posts GROUP BY 1)
         LEFT JOIN names USING (label)
    """,
)

_add(
    "label_summary",
    """
    SELECT label, n AS count, round(v, 3) AS normalized_volume, round(s, 3) AS variance,
           round(n / sum(n) OVER (), 3) AS count_share, round(v / sum(v) OVER (), 3) AS volume_share,
           label_name
    FROM (SELECT label, count(*) AS n, avg(total_len) AS v, var_samp(total_len) AS s
          FROM posts GROUP BY 1) LEFT JOIN names USING (label)
    """,
)

_add(
    "top_users",
    """
    SELECT id, label, total_length, label_name
    FROM (SELECT id, label, CAST(sum(total_len) AS BIGINT) AS total_length FROM posts GROUP BY 1, 2
          ORDER BY 3 DESC, 1, 2 LIMIT 30) LEFT JOIN names USING (label)
    """,
)

BOX = """
    box AS (
        SELECT label, count(*) AS n, min({v}) AS min, quantile_cont({v}, 0.25) AS q1,
               quantile_cont({v}, 0.5) AS median, quantile_cont({v}, 0.75) AS q3, max({v}) AS max,
               q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence
        FROM {t} GROUP BY label
    )
"""
_add(
    "length_box",
    """
    SELECT b.label, n, min, q1, median, q3, max, lower_fence, upper_fence,
           min(CASE WHEN total_len BETWEEN lower_fence AND upper_fence THEN total_len END)
               AS lower_whisker,
           max(CASE WHEN total_len BETWEEN lower_fence AND upper_fence THEN total_len END)
               AS upper_whisker,
           count(*) FILTER (total_len NOT BETWEEN lower_fence AND upper_fence) AS outliers
    FROM posts p JOIN box b ON p.label = b.label GROUP BY ALL
    """,
    BOX.format(v="total_len", t="posts"),
)
_add(
    "hour_density",
    """
    SELECT label, h.hour, h.count, round(h.count / n, 6) AS density, n, min, q1, median, q3, max
    FROM hours h JOIN box USING (label)
    """,
    BOX.format(v="CAST(hour(ts) AS INT)", t="dated"),
)

for _name, _n, _seed in (("eda_sample", 5000, 42), ("eda_sample_small", 100, 7)):
    _add(
        _name,
        f"""
        SELECT label, total_len, CAST(hour(ts) AS INT) AS hour
        FROM dated ORDER BY md5('{_seed}:' || CAST(post_id AS VARCHAR)), post_id LIMIT {_n}
        """,
    )

# Words are maximal runs of letters, marks, digits and underscores.
RATIO = r"""
    SELECT label, avg(len(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{Nd}_]+'),
                                      lambda w: w IN (@)))
                      / len(string_split(text, ' '))) AS ratio
    FROM posts GROUP BY label
"""
_add(
    "lexicon_ratio",
    f"""
    SELECT label, round(ratio, 9) AS avg_self_ref, label_name
    FROM ({RATIO.replace('@', "'i', 'me', 'my', 'myself', 'mine'")}) LEFT JOIN names USING (label)
    """,
)
_add(
    "lexicon_ratio_articles",
    f"""
    SELECT label, round(ratio, 9) AS avg_articles
    FROM ({RATIO.replace('@', "'the', 'la', 'der', 'el', 'été', 'è'")})
    """,
)

_add(
    "lexicon_ratios",
    f"""
    SELECT label, 'self' AS category, round(ratio, 9) AS ratio FROM ({RATIO.replace('@', "'i', 'me', 'my', 'myself', 'mine'")})
    UNION ALL SELECT label, 'articles', round(ratio, 9) FROM ({RATIO.replace('@', "'the', 'la', 'der', 'el', 'été', 'è'")})
    UNION ALL SELECT label, 'phrases',
        round(avg(len(regexp_extract_all(lower(text), '\\b(?:i told|it was mine|told myself|see http)\\b')) / len(string_split(text, ' '))), 9)
    FROM posts GROUP BY label
    """,
)
_add(
    "hour_density_smooth",
    """
    SELECT label, place / 4 AS at, round(height / sum(height) OVER (PARTITION BY label) * 4, 6) AS density
    FROM (
        SELECT label, place, sum(count * exp((cos(2 * pi() * (place / 96 - hour / 24)) - 1) / (width * width))) AS height
        FROM hours JOIN (
            SELECT label, greatest(1.06 * least(sqrt(-2 * ln(least(greatest(r, 1e-12), 1.0))), pi() / sqrt(3)) * pow(n, -0.2), pi() / 24) AS width
            FROM (
                SELECT label, sum(count) AS n, sqrt(pow(sum(count * cos(2 * pi() * hour / 24)), 2) + pow(sum(count * sin(2 * pi() * hour / 24)), 2)) / sum(count) AS r
                FROM hours GROUP BY label
            )
        ) USING (label), (SELECT unnest(range(96)) AS place)
        GROUP BY label, place
    )
    """,
)
_add(
    "hourly_profile",
    """
    SELECT label, hour, count,
           round(count / sum(count) OVER (PARTITION BY label) * 100, 6) AS percentage
    FROM hours
    """,
)
ORACLE["rollup_hourly_profile"] = ORACLE["hourly_profile"]
ORACLE["rollup_label_summary"] = ORACLE["label_summary"]
_add(
    "hourly_profile_filled",
    """
    SELECT g.label, g.hour, coalesce(count, 0) AS count,
           round(coalesce(count, 0) / sum(count) OVER (PARTITION BY g.label) * 100, 6)
               AS percentage
    FROM (SELECT label, CAST(unnest(range(24)) AS INT) AS hour
          FROM (SELECT DISTINCT label FROM hours)) g
         LEFT JOIN hours h ON g.label = h.label AND g.hour = h.hour
    """,
)
_add("daily_posts", "SELECT post_date, post_count FROM daily")
_add("available_years", "SELECT DISTINCT CAST(year(post_date) AS INT) AS year FROM daily")
_add(
    "available_months",
    """
    SELECT DISTINCT CAST(month(post_date) AS INT) AS month FROM daily WHERE year(post_date) = 2023
    """,
)
_add(
    "period_slice",
    """
    SELECT post_date, post_count FROM daily
    WHERE year(post_date) = 2023 AND month(post_date) = 11
    """,
)
TOTALS = """
    SELECT post_count, prev_count,
           CASE WHEN prev_count > 0
                THEN round((post_count - prev_count) / prev_count * 100, 6) END AS delta_pct
    FROM (SELECT CAST(coalesce(sum(post_count) FILTER (year(post_date) = 2023), 0) AS BIGINT)
                     AS post_count,
                 CAST(coalesce(sum(post_count) FILTER (year(post_date) = 2022), 0) AS BIGINT)
                     AS prev_count
          FROM daily WHERE @)
"""
_add("period_totals_year", TOTALS.replace("@", "true"))
_add("period_totals_month", TOTALS.replace("@", "month(post_date) = 1"))
_add(
    "period_totals_all",
    """
    SELECT CAST(sum(post_count) AS BIGINT) AS post_count, CAST(0 AS BIGINT) AS prev_count,
           CAST(NULL AS DOUBLE) AS delta_pct
    FROM daily
    """,
)
YOY = """
    SELECT {cols}, cur.n AS post_count, coalesce(prev.n, 0) AS prev_count,
           CASE WHEN prev.n > 0 THEN round((cur.n - prev.n) / prev.n * 100, 6) END AS delta_pct
    FROM periods cur LEFT JOIN periods prev ON {on}
"""
_add(
    "yoy_year",
    YOY.format(cols="cur.year", on="cur.year = prev.year + 1"),
    """
    periods AS (SELECT CAST(year(post_date) AS INT) AS year, CAST(sum(post_count) AS BIGINT) AS n
                FROM daily GROUP BY 1)
    """,
)
_add(
    "yoy_month",
    YOY.format(cols="cur.year, cur.month", on="cur.year = prev.year + 1 AND cur.month = prev.month"),
    """
    periods AS (SELECT CAST(year(post_date) AS INT) AS year, CAST(month(post_date) AS INT) AS month,
                       CAST(sum(post_count) AS BIGINT) AS n
                FROM daily GROUP BY 1, 2)
    """,
)

SEARCH = """
    SELECT id, title, date, text, label FROM posts
    WHERE contains(lower(title), '{0}') OR contains(lower(text), '{0}')
    ORDER BY id, date, title, text, label LIMIT {1}
"""
_add("keyword_search", SEARCH.format("myself it was", 100))
_add("search_indexed", SEARCH.format("myself it was", 100))
_add("keyword_search_literal", SEARCH.format("a?b=1", 300))
_add(
    "search_count",
    "SELECT count(*) AS hits FROM posts WHERE contains(lower(title), 'the') OR contains(lower(text), 'the')",
)

# A blank is what RE2 calls \s, a Unicode separator, or one of the controls between.
CLEAN = (
    r"lower(regexp_replace(regexp_replace(coalesce({0}, ''),"
    r" '(?i)(http|www)[^\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+', '', 'g'),"
    r" '^[\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+|[\s\p{{Z}}\x0b\x1c-\x1f\x{{85}}]+$', '', 'g'))"
)
_add(
    "url_clean",
    f"""
    SELECT post_id, {CLEAN.format('title')} AS title, trim(coalesce(date, '')) AS date,
           {CLEAN.format('text')} AS text, trim(coalesce(info, '')) AS info
    FROM raw
    """,
)
ORACLE["url_clean_pages"] = (
    f"SELECT page_id, {CLEAN.format('url')} AS url, {CLEAN.format('html')} AS html FROM pages"
)

ORACLE["truth_labels"] = """
    SELECT 'u' || CAST(user_id AS VARCHAR) AS id,
           arg_max(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), event_id) AS raw_label
    FROM events WHERE event_type <> 'error' GROUP BY 1
"""

ETL = """
    SELECT 'subject' || CAST(l.doc_id AS VARCHAR) AS id, {title} AS title, {date} AS date,
           {text} AS text, info, {label} AS label
    FROM {source} JOIN labels l ON l.doc_id = w.post_id
"""
_PARTS = {
    "title": CLEAN.format("title"),
    "date": "coalesce(date, '')",
    "text": CLEAN.format("line"),
    "source": "(SELECT *, unnest(string_split(text, chr(10))) AS line FROM raw) w",
}
_add(
    "etl_flatten",
    ETL.format(label="quality", **_PARTS)
    + " UNION ALL "
    + ETL.format(label="CASE WHEN toxic = 1 THEN 2 ELSE 0 END", **_PARTS),
)
_add(
    "etl_parse",
    ETL.format(
        label="CASE WHEN toxic = 1 THEN 2 ELSE 0 END",
        title=CLEAN.format("title"),
        date="''",
        text=CLEAN.format("text"),
        source="texts w",
    ),
)

_add("csv_roundtrip", "SELECT id, title, date, text, info, label, total_len FROM posts")
_add("csv_one_file", "SELECT id, title, date, text, info, label, total_len FROM posts")
_add("table_roundtrip", "SELECT post_id, id, label, ts, total_len FROM posts WHERE label = 1")

TERMS = """
    tokens AS (SELECT post_id, {tokens} AS words FROM posts),
    terms AS (
        SELECT term, count(*) AS tf, count(DISTINCT post_id) AS df
        FROM (SELECT post_id, unnest(words) AS term FROM tokens) GROUP BY term
    )
"""
TRAINING_TOKENS = (
    "list_filter(regexp_extract_all(lower(text), '[a-zA-Z]{3,}'),"
    f" lambda w: NOT list_contains({_list(STOPS + TRAINING)}, w))"
)
TOPIC_TOKENS = (
    "list_filter(string_split_regex(trim(regexp_replace(regexp_replace(regexp_replace("
    r"lower(text), 'http\S+', '', 'g'), '\[removed\]|\[deleted\]', '', 'g'), '[^a-z\s]', ' ', 'g')),"
    rf" '\s+'), lambda w: length(w) >= 4 AND NOT list_contains({_list(STOPS + TOPIC)}, w))"
)
VOCABULARY = """
    SELECT term, tf, df, round(ln((m + 1) / (df + 1)), 6) AS idf
    FROM (SELECT *, (SELECT count(*) FROM posts) AS m FROM terms)
    WHERE df BETWEEN {min_df} AND {max_share} * m
    ORDER BY tf DESC, term LIMIT {size}
"""
_add(
    "term_stats",
    VOCABULARY.format(min_df=1, max_share=1, size=2000),
    TERMS.format(tokens=TRAINING_TOKENS),
)
_add(
    "importance_pairs",
    """
    SELECT term AS word, CAST(label AS VARCHAR) AS class
    FROM (SELECT term FROM terms ORDER BY tf DESC, term LIMIT 2000), (SELECT DISTINCT label FROM posts)
    """,
    TERMS.format(tokens=TRAINING_TOKENS),
)
_add("importance_classes", "SELECT DISTINCT CAST(label AS VARCHAR) AS class FROM posts")
_add(
    "weights_certificate",
    """
    SELECT CAST(label AS VARCHAR) AS class, least((SELECT count(*) FROM terms), 2000) + 1 AS components, true AS optimal
    FROM (SELECT DISTINCT label FROM posts)
    """,
    TERMS.format(tokens=TRAINING_TOKENS),
)
_add(
    "class_separation",
    """
    SELECT CAST(label AS VARCHAR) AS class, count(*) AS posts, true AS recognised
    FROM posts WHERE text <> '' GROUP BY label
    """,
)
_add(
    "top_terms_ranks",
    """
    SELECT '1' AS class, CAST(r AS INT) AS rank, true AS falling
    FROM (SELECT unnest(range(1, 1 + CAST((SELECT least(20, count(*)) FROM terms) AS INT))) AS r)
    """,
    TERMS.format(tokens=TRAINING_TOKENS),
)
_add(
    "topic_shapes",
    f"""
    SELECT CAST(t AS INT) AS topic_id, n AS n_terms, n AS n_known, true AS titled
    FROM (SELECT unnest(range(5)) AS t),
         (SELECT least(10, count(*)) AS n FROM ({VOCABULARY.format(min_df=2, max_share=0.9, size=1000)}))
    """,
    TERMS.format(tokens=TOPIC_TOKENS),
)
_add(
    "csv_import",
    "SELECT id, 't' AS title, 'a text' AS text, info, label, CAST(7 AS INT) AS total_len, ts FROM posts",
)
_add(
    "topic_terms",
    VOCABULARY.format(min_df=2, max_share=0.9, size=1000),
    TERMS.format(tokens=TOPIC_TOKENS),
)
_add(
    "topic_tokens",
    "SELECT post_id, array_to_string(words, ' ') AS tokens FROM tokens",
    TERMS.format(tokens=TOPIC_TOKENS),
)

_add(
    "stream_label_counts",
    """
    SELECT label, count, label_name
    FROM (SELECT label, count(*) AS count FROM posts GROUP BY 1) LEFT JOIN names USING (label)
    """,
)
_add(
    "adhoc_sql",
    """
    SELECT info, label, count(*) AS posts, max(total_len) AS longest
    FROM posts WHERE total_len >= 500 AND ts >= TIMESTAMP '2022-01-01 00:00:00' GROUP BY 1, 2
    """,
)
