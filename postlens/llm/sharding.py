"""A uniform random shuffle into shards of exact sizes, by a communication matrix.

How many rows each partition sends to each shard is drawn first, from the hypergeometric law that a uniform
permutation has. Then every partition permutes its rows and cuts them at its counts, the rows are
exchanged, and each shard is permuted once more. The matrix is drawn down a tree of partitions, ``FAN`` children to a
node, so that no task draws more than ``FAN`` rows of it. All steps are DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Children of a node in the tree of partitions: 2 ** FAN_BITS.
FAN_BITS = 6


def uniform(*parts: str) -> str:
    """SQL of a number in [0, 1) that depends on ``parts`` alone."""
    return f"(shiftrightunsigned(xxhash64({', '.join(parts)}), 11) / 9007199254740992.0D)"


def let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(total: str, marked: str, draws: str, u: str) -> str:
    """SQL of the number of marked among ``draws`` of ``total``, by inversion at ``u``.

    Weights follow from their neighbours, beginning with 1 at the mode, out to ten standard deviations and ten
    more; what lies beyond is less than the last bit of their sum. The walk goes down from the mode, then up from it.
    """
    mode = f"""greatest(0L, {draws} - {total} + {marked}, least({draws}, {marked},
        CAST(floor(({draws} + 1D) * ({marked} + 1D) / ({total} + 2D)) AS BIGINT)))"""
    reach = f"""CAST(10 + ceil(10 * sqrt({draws} * ({marked} / greatest({total}, 1L))
        * ((greatest({total}, 1L) - {marked}) / greatest({total}, 1L))
        * (({total} - {draws}) / greatest({total} - 1, 1L)))) AS BIGINT)"""
    bounds = f"""named_struct('mode', b.mode,
        'down', b.mode - greatest(0L, {draws} - {total} + {marked}, b.mode - b.reach),
        'up', least({draws}, {marked}, b.mode + b.reach) - b.mode)"""
    lower = f"""(CAST(c.mode - t AS DOUBLE) * ({total} - {marked} - {draws} + c.mode - t)
        / (({marked} - c.mode + t + 1D) * ({draws} - c.mode + t + 1D)))"""
    higher = f"""(({marked} - c.mode - t + 0D) * ({draws} - c.mode - t)
        / ((c.mode + t + 1D) * ({total} - {marked} - {draws} + c.mode + t + 1D)))"""

    def mass(steps: str, ratio: str) -> str:
        return f"""aggregate(sequence(0L, {steps}), named_struct('w', 1D, 's', 0D),
            (a, t) -> named_struct('w', a.w * {ratio}, 's', a.s + a.w)).s"""

    def walk(steps: str, ratio: str, left: str, x: str, skip: str) -> str:
        return f"""aggregate(sequence(0L, {steps}), named_struct('w', 1D, 'left', {left}, 'x', CAST(NULL AS BIGINT)),
            (a, t) -> IF(a.x IS NOT NULL, a, IF({skip}, named_struct('w', a.w * {ratio}, 'left', a.left, 'x', a.x),
                IF(a.left < a.w OR t = {steps}, named_struct('w', a.w, 'left', a.left, 'x', {x}),
                    named_struct('w', a.w * {ratio}, 'left', a.left - a.w, 'x', a.x))))).x"""

    down = walk("c.down", lower, "d.at", "c.mode - t", "false")
    up = walk("c.up", higher, "d.at - d.down", "c.mode + t", "t = 0")
    pick = f"IF(d.at < d.down OR c.up = 0, {down}, {up})"
    sums = f"named_struct('down', m.down, 'at', {u} * (m.down + m.up - 1))"
    masses = f"named_struct('down', {mass('c.down', lower)}, 'up', {mass('c.up', higher)})"
    start = f"named_struct('mode', {mode}, 'reach', {reach})"
    return let("b", start, let("c", bounds, let("m", masses, let("d", sums, pick))))


def communication_matrix(spark: SparkSession, counts: DataFrame, sizes: list[int], parts: int, seed: int) -> DataFrame:
    """``(part, row)``: for each part of ``counts`` ``(part, n)`` how many of its rows go to each of ``sizes``.

    Rows sum to the parts' counts, columns to ``sizes``; the matrix has the law of a uniform permutation.
    """
    draw = hypergeometric("rest.total", "sofar.margins[s]", "rest.draws", uniform(f"{seed}L", "child.id", "s", "level"))
    row = f"""aggregate(sequence(0, {len(sizes) - 1}),
        named_struct('draws', child.n, 'total', aggregate(sofar.margins, 0L, (x, y) -> x + y), 'row', CAST(array() AS ARRAY<BIGINT>)),
        (rest, s) -> {let("k", draw, "named_struct('draws', rest.draws - k, 'total', rest.total - sofar.margins[s], 'row', rest.row || array(k))")}).row"""
    after = "zip_with(sofar.margins, r, (x, y) -> x - y)"
    step = let("r", row, f"named_struct('margins', {after}, 'out', sofar.out || array(named_struct('id', child.id, 'row', r)))")
    dealt = f"""aggregate(children, named_struct('margins', margins, 'out', CAST(array() AS ARRAY<STRUCT<id: BIGINT, row: ARRAY<BIGINT>>>)),
        (sofar, child) -> {step}).out"""
    nodes = spark.range(1).select(F.col("id").alias("node"), F.expr(f"array({', '.join(f'{x}L' for x in sizes)})").alias("margins"))
    depth = max(1, -(-max(parts - 1, 1).bit_length() // FAN_BITS))
    for level in reversed(range(depth)):
        child = counts.groupBy(F.expr(f"shiftright(CAST(part AS BIGINT), {FAN_BITS * level})").alias("id")).agg(F.sum("n").alias("n"))
        family = child.groupBy(F.expr(f"shiftright(id, {FAN_BITS})").alias("node"))
        family = family.agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("children"))
        nodes = nodes.join(family, "node").withColumn("level", F.lit(level))
        nodes = nodes.select(F.explode(F.expr(dealt)).alias("x")).select(F.col("x.id").alias("node"), F.col("x.row").alias("margins"))
    return nodes.select(F.col("node").cast("int").alias("part"), F.col("margins").alias("row"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its rows stay as they are, and Spark knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_to_shards(df: DataFrame, shards: int, seed: int = 0, block_rows: int = 65_536) -> DataFrame:
    """Every row of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot``, its place in the shard, gapless from 0.

    Shards differ by one row at most, and each assignment of rows to places is as likely as any other. ``block_rows``: rows of a
    shard that one task permutes; larger shards are dealt to more tasks by the random key. Equal rows, nulls and long texts
    are rows like any other, since only their position counts; an empty table stays empty. Columns ``shard`` and ``slot`` are replaced.
    """
    spark = df.sparkSession
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")])
    local = df.select(row.alias("row"), F.spark_partition_id().alias("part"), F.rand(seed).alias("u")).sortWithinPartitions("u")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = _kept(local.select("row", "part", position.alias("pos")), "shard-rows")

    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    rows, last = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0))).first()
    sizes = [rows // shards + (s < rows % shards) for s in range(shards)]
    matrix = communication_matrix(spark, counts, sizes, last + 1, seed)
    ends = "transform(row, (x, i) -> aggregate(slice(row, 1, i + 1), 0L, (a, y) -> a + y))"
    cuts = _kept(matrix.select("part", F.expr(ends).alias("cuts")), "shard-cuts")

    blocks = max(1, -(-rows // (shards * block_rows)))
    block = F.expr(f"CAST(floor({uniform(f'{seed}L', 'part', 'pos')} * {blocks}) AS INT)")

    def dealt(columns: list[str]) -> DataFrame:
        sent = placed.select(*columns, "part", "pos").join(cuts, "part")
        shard = F.expr("size(filter(cuts, c -> c <= pos))")
        return sent.select(*columns, shard.alias("shard"), "part", "pos", block.alias("block"))

    block_counts = dealt([]).groupBy("shard", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = _kept(block_counts.select("shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "shard-starts")
    within = Window.partitionBy("shard", "block").orderBy(F.xxhash64(F.lit(seed), "part", "pos"), "part", "pos")
    ranked = dealt(["row"]).withColumn("nth", F.row_number().over(within) - 1).join(starts, ["shard", "block"])
    return ranked.select("row.*", "shard", (F.col("start") + F.col("nth")).alias("slot"))
