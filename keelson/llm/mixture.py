"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame operations only.

The mix is a sequence of slots of ``block`` words. Slot ``i`` has the point ``i x golden ratio``
modulo 1, and the source whose share of the cumulated targets holds that point fills it; any
stretch of the mix therefore keeps the target weights within a few slots. Each source lays its
documents in hashed order end to end and cuts the stream into blocks of equal words; its k-th slot
takes block k, starting again at the first block after the last.

Targets: sources by code point, NULL last, weigh 5, 2, 1, repeating, and share all words; a target
stops at ``cap`` times the words of its source, and the excess goes to the others by weight.

Ranks and positions inside a hot source are sums over hashed chunks plus a rank in the chunk, so no
source is sorted in one task.

Defined cases: NULL text counts no words and takes none; rows with the same id are separate rows;
NULL is a source of its own, apart from the empty string; a source without words has target 0; an
empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import stored

WEIGHTS = (5, 2, 1)
BLOCK = 64
CAP = 3
CHUNKS = 256
#: 2^32 over the golden ratio: the step of the point sequence, in units of 2^-32.
STEP = 2654435769
CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(rows: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target``: a level times the weight, but at most the cap.

    Sources ordered by cap over weight are capped from the front; the level is what the capped
    ones leave, over the weights of the others, at the first source it does not exceed.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*map(F.lit, weights))
    return (
        sizes.selectExpr("*", "row_number() over (order by source asc nulls last) as place")
        .withColumn("w", F.element_at(cycle, (F.col("place") - 1) % len(weights) + 1).cast("double"))
        .withColumn("top", F.col("source_size").cast("double") * cap)
        .selectExpr(
            "*",
            "sum(source_size) over () as total",
            "coalesce(sum(top) over (order by top / w, place rows between unbounded preceding and 1 preceding), 0D) as capped",
            "sum(w) over (order by top / w, place rows between current row and unbounded following) as open",
        )
        .selectExpr("*", "(total - capped) / open as level")
        .selectExpr("*", "max(case when level * w <= top then level end) over () as final")
        .selectExpr("source", "source_size", "place", "least(top, coalesce(final * w, top)) as target", "total")
    )


def positions(documents: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """Each row with ``size``, ``source`` and its stretch ``[start, start + size)`` in the stream of its source."""
    rows = documents.select(
        "*",
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )
    return rows.withColumn("_order", F.xxhash64("doc_id", "size")).withColumn(
        "_chunk", F.pmod("_order", F.lit(chunks)).cast("int")
    )


def mix_sources(documents: DataFrame, block: int = BLOCK, cap: int = CAP, weights=WEIGHTS) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row: the words the mix takes of it."""
    return _mixed(documents.select("doc_id", "text", "source"), block, cap, weights, [])


def _mixed(documents: DataFrame, block: int, cap: int, weights, keep: list[str]) -> DataFrame:
    rows = stored(
        positions(documents).select("doc_id", "source", "size", "_order", "_chunk", *keep), "mix-rows"
    )
    goals = stored(targets(rows, weights, cap), "mix-targets")
    starts = (
        rows.groupBy("source", "_chunk").agg(F.sum("size").alias("n"))
        .selectExpr("source as s", "_chunk", "sum(n) over (partition by source order by _chunk) - n as base")
    )
    placed = (
        rows.selectExpr(
            "*",
            "sum(size) over (partition by source, _chunk order by _order, doc_id rows unbounded preceding) - size as inner_start",
            "row_number() over (partition by source, _chunk order by _order, doc_id) as _row",
        )
        .join(starts, (F.col("source").eqNullSafe(F.col("s"))) & (rows["_chunk"] == starts["_chunk"]))
        .drop(starts["_chunk"])
        .join(goals.selectExpr("source as g", "place as source_no", "source_size", "target"), F.col("source").eqNullSafe(F.col("g")))
        .withColumn("start", F.col("base") + F.col("inner_start"))
    )
    placed = stored(placed.drop("s", "g", "base", "inner_start", "_order"), "mix-placed")
    uses = _uses(goals, block, cap)
    pieces = placed.where("size > 0").select(
        "source_no", "_chunk", "_row", "start", "size",
        F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("number"),
    )
    taken = (
        pieces.join(uses, ["source_no", "number"])
        .select(
            "source_no", "_chunk", "_row",
            F.expr(f"times * (least(start + size, (number + 1) * {block}) - greatest(start, number * {block}))").alias("n"),
        )
        .groupBy("source_no", "_chunk", "_row")
        .agg(F.sum("n").alias("taken"))
    )
    return placed.join(taken, ["source_no", "_chunk", "_row"], "left").select(
        "doc_id", *[c for c in ("source",) if keep], "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), *keep,
    )


def _uses(goals: DataFrame, block: int, cap: int) -> DataFrame:
    """``source_no, number, times``: how often the schedule takes each block of each source."""
    shares = goals.where("target > 0").selectExpr(
        "place as source_no", "source_size", "sum(target) over () as mass",
        "sum(target) over (order by place) - target as low", "sum(target) over (order by place) as high",
    ).selectExpr("source_no", "source_size", "low / mass as low", "high / mass as high", "mass",
                 "row_number() over (order by source_no desc) = 1 as is_last")
    # Each share is cut at the borders of a fixed grid, so slots find their source by an equi-join.
    cells = shares.select(
        "source_no", "source_size", "low", F.when(F.col("is_last"), 2.0).otherwise(F.col("high")).alias("high"),
        F.explode(F.expr(f"sequence(cast(floor(low * {CELLS}) as int), cast(least(floor(high * {CELLS}), {CELLS - 1}) as int))")).alias("cell"),
    )
    spark = goals.sparkSession
    total = goals.agg(F.sum("target")).first()[0] or 0.0
    slots = spark.range(int(-(-total // block))).select(
        F.col("id").alias("slot"),
        F.expr(f"((id % 2147483648 + 1) * {STEP} % 4294967296) / 4294967296D").alias("point"),
    ).withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    filled = (
        slots.join(cells, "cell").where("point >= low and point < high")
        .select("slot", "source_no", "source_size", F.expr("slot div 256").alias("part"))
    )
    filled = stored(filled, "mix-slots")
    starts = (
        filled.groupBy("source_no", "part").count()
        .selectExpr("source_no", "part", "sum(count) over (partition by source_no order by part) - count as base")
    )
    ranked = filled.selectExpr(
        "*", "row_number() over (partition by source_no, part order by slot) - 1 as inner_rank"
    ).join(starts, ["source_no", "part"])
    blocks = F.expr(f"(source_size + {block - 1}) div {block}")
    return (
        ranked.withColumn("blocks", blocks)
        .withColumn("rank", F.col("base") + F.col("inner_rank"))
        .where(f"rank < blocks * {cap}")
        .groupBy("source_no", F.expr("rank % blocks").alias("number"))
        .agg(F.count("*").alias("times"))
    )


def mixed_documents(documents: DataFrame, block: int = BLOCK, cap: int = CAP, weights=WEIGHTS) -> DataFrame:
    """The mix as documents: each row once per full copy taken, and once more for the rest of it.

    The rest holds the first words of the text, up to the words still due, joined by spaces;
    ``n_chars``, where there is one, follows.
    """
    columns = documents.columns
    others = [c for c in columns if c not in ("doc_id", "source")]
    plain = documents.select("doc_id", "source", *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)])
    held = [f"_{i}" for i in range(len(others))]
    text = held[others.index("text")]
    mixed = _mixed(plain.withColumn("text", F.col(text)), block, cap, weights, held).where("taken > 0")
    words = F.expr(f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")
    parts = mixed.select(
        "*", F.explode(F.expr("sequence(1, cast((taken + size - 1) div size as int))")).alias("_copy")
    ).withColumn("_due", F.expr("least(size, taken - (_copy - 1) * size)"))
    parts = parts.withColumn(
        text, F.when(F.col("_due") == F.col("size"), F.col(text)).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("_due").cast("int")), " "))
    )
    if "n_chars" in others:
        parts = parts.withColumn(held[others.index("n_chars")], F.char_length(text).cast("long"))
    names = dict(zip(others, held))
    return parts.select([F.col(names.get(c, c)).alias(c) for c in columns])
