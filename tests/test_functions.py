import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from postlens import functions as fn
from postlens.schema import label_dimension, label_name
from postlens.sources import task_label


def apply(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_space_set_is_pythons():
    from postlens.functions.text import UNICODE_SPACE

    assert set(UNICODE_SPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def test_clean_field_agrees_with_python(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    texts = ["", "plain", "HTTP://A.b/c d", "awww.x.org end", "https://x", "(www.a.b)\tz", "ht tp://a", "www http", "wwwhttp x"]
    texts += [f"{s}See http://x{s}Y{s}{s}" for s in spaces] + [s * 3 for s in spaces]
    pattern = re.compile(r"http\S+|www\S+|https\S+", re.IGNORECASE)
    wanted = [pattern.sub("", t).strip().lower() for t in texts]
    assert apply(spark, fn.clean_field, texts) == wanted
    assert apply(spark, fn.remove_urls, [None, ""]) == ["", ""]
    assert apply(spark, fn.strip, [None, " a b\n"]) == ["", "a b"]


DATES = [
    "2015-01-02 03:04:05", "2016-02-29 23:59:59", "2015-02-29 00:00:00", "2015-02-30 00:00:00",
    "2015-13-01 00:00:00", "2015-01-02", "2015-01-02 03:04:05.5", " 2015-01-02 03:04:05",
    "2015-01-02 03:04:05 ", "2015-01-02 03:04:05\n", "2015-1-2 3:04:05", "2015-01-02T03:04:05",
    "2015-01-02 24:00:00", "2015-01-02 23:60:00", "2015-01-02 23:59:60", "0000-01-01 00:00:00",
    "9999-12-31 23:59:59", "+2015-01-02 03:04:05", "-015-01-02 03:04:05", "2015-00-01 00:00:00",
    "2015-01-00 00:00:00", "", "n/a", "2015-01-02 03:04:05Z", "2015/01/02 03:04:05",
]


def test_parse_ts_is_the_strict_format(spark):
    df = spark.createDataFrame([(d,) for d in [*DATES, None]], "d string")
    strict = F.try_to_timestamp("d", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    rows = df.select("d", fn.parse_ts(F.col("d")).alias("ours"), strict.alias("strict"))
    assert rows.where(~F.col("ours").eqNullSafe(F.col("strict"))).collect() == []
    assert rows.where(F.col("ours").isNotNull()).count() == 4
    assert dict(rows.dtypes)["ours"] == "timestamp_ntz"


def test_parse_ts_on_random_dates(spark):
    rng = random.Random(1)
    values = []
    for _ in range(20000):
        parts = [rng.randrange(1, 2100), rng.randrange(14), rng.randrange(33), rng.randrange(26), rng.randrange(62), rng.randrange(62)]
        text = "{:04}-{:02}-{:02} {:02}:{:02}:{:02}".format(*parts)
        if rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(" -:.T0+Z") + text[at + rng.randrange(2):]
        values.append((text,))
    df = spark.createDataFrame(values, "d string")
    strict = F.try_to_timestamp("d", F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    rows = df.select("d", fn.parse_ts(F.col("d")).alias("ours"), strict.alias("strict"))
    signed = F.col("d").rlike("^[+-]")
    assert rows.where(signed & F.col("ours").isNotNull()).count() == 0
    assert rows.where(~signed & ~F.col("ours").eqNullSafe(F.col("strict"))).select("d").collect() == []
    assert 5000 < rows.where(F.col("ours").isNotNull()).count() < 15000


def test_hour_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",)], "d string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")  # no such hour there
        assert df.select(F.hour(fn.parse_ts(F.col("d")))).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_lexicon_hits(spark):
    texts = ["I'm sure it's mine", "mineral image", "", "My MYSELF me_ me", "mé émi i", "i i,i"]
    assert apply(spark, fn.lexicon_hits, texts) == [2, 0, 0, 3, 1, 3]
    assert apply(spark, lambda c: fn.lexicon_hits(c, ["a.b", "Der"]), ["a.b axb der DER"]) == [3]
    assert apply(spark, lambda c: fn.lexicon_hits(c, []), ["a", "", None]) == [0, 0, None]


def test_word_count(spark):
    assert apply(spark, fn.word_count, ["", " ", "a", "a b", "a  b", "a\nb c"]) == [1, 2, 1, 2, 3, 2]


def test_topic_text(spark):
    texts = ["See HTTP://x.y/z now", "[removed]", "a [Deleted] b", "it's 5 o'clock", " tab\tend\n"]
    assert apply(spark, fn.topic_text, texts) == ["see  now", "", "a  b", "it s   o clock", "tab\tend\n"]


def test_label_name(spark):
    names = ["Control (Sani)", "Depression", "Anorexia", None, None]
    assert apply(spark, label_name, ["0", "1", "2", "3", "x"]) == names
    assert label_dimension(spark).count() == 3


@pytest.mark.parametrize(
    "task, wanted", [("depression", [0, 1, 2, 1, None, None]), ("anorexia", [0, 2, 0, 2, None, None])]
)
def test_task_label(spark, task, wanted):
    got = apply(spark, lambda c: task_label(c, task), ["0", "1", "2", "+1", "x", "1.0"])
    assert got == wanted


def test_unknown_task():
    with pytest.raises(ValueError):
        task_label(F.lit("1"), "other")
