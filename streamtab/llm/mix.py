"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length, a bounded knapsack over these counts fits each source's remaining budget, and
the documents of a length are chosen by a seeded hash. Only counts meet in one task; documents never do.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamtab.llm.common import packed, saved

SEED = 20240607
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    parts = F.split(text, r"[\x20\x09-\x0D]+")
    return F.coalesce(F.size(F.filter(parts, lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size) with `target`: `share` of all sizes dealt by weight, no target above `most` times its source.

    Sources take the weights in code point order, null last, repeating. With sources ordered by cap / weight, the level at which
    the rest is dealt rises while sources reach their cap and falls afterwards, so its greatest value is the level that holds.
    These windows see one row per source.
    """
    everywhere = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    dealt = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn % len(weights) + 1))
    dealt = dealt.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(rank.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    budget = F.lit(float(share)) * F.sum("source_size").over(everywhere)
    level = dealt.withColumn("level", (budget - before) / rest)
    level = level.withColumn("level", F.max("level").over(everywhere))
    return level.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def fit_budget(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their sizes add up to `budget`, or as near below as can be.

    Longest first, each length gets its share of the budget less what a knapsack needs to work with (twice the longest length);
    a bounded subset-sum over what is left of each length then fits the rest. Reached sums are the bits of an integer; of each sum
    the step that reached it first is kept to walk back, one number a sum whatever the number of steps.
    """
    taken = [0] * len(lengths)
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return [c if n > 0 else 0 for n, c in zip(lengths, counts)]
    order = sorted((i for i in range(len(lengths)) if lengths[i] > 0), key=lambda i: -lengths[i])
    spread = max(0, budget - 2 * lengths[order[0]])
    due = used = 0
    for i in order:
        due += lengths[i] * counts[i] * spread
        taken[i] = min(counts[i], max(0, due // total - used) // lengths[i])
        used += taken[i] * lengths[i]
    rest = budget - used
    reach, mask, steps = 1, (1 << (rest + 1)) - 1, []
    first = np.zeros(rest + 1, np.int32)
    for i in order:
        left, lot = counts[i] - taken[i], 1
        while left and lot * lengths[i] <= rest and not reach >> rest & 1:
            lot = min(lot, left)
            new = (reach << lot * lengths[i]) & mask & ~reach
            if new:
                bits = np.frombuffer(new.to_bytes(rest // 8 + 1, "little"), np.uint8)
                filled = np.flatnonzero(bits)
                byte, bit = np.nonzero(np.unpackbits(bits[filled, None], axis=1, bitorder="little"))
                first[filled[byte] * 8 + bit] = len(steps)
                steps.append((i, lot))
                reach |= new
            left -= lot
            lot *= 2
    at = reach.bit_length() - 1
    # The sum before a step was reached by an earlier step, so no step is taken twice.
    while at:
        i, lot = steps[first[at]]
        taken[i] += lot
        at -= lot * lengths[i]
    return taken


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    whole = int(target // size) if size else 0
    lengths = [int(x) for x in group["size"]]
    taken = fit_budget(lengths, [int(x) for x in group["n"]], round(target - whole * size) if size else 0)
    return pd.DataFrame({"source": group["source"], "size": group["size"], "source_size": group["source_size"],
                         "target": group["target"], "whole": whole, "extra": taken})


def mix(
    spark: SparkSession,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: int = 2,
    seed: int = SEED,
) -> DataFrame:
    """(key, size, source, source_size, target, times, taken): how often the mix takes each row, one row out per row in.

    A source is taken whole as often as its target allows; the rest of the target is a subset of its documents, each at most
    once more, so no row is taken more than `most` times. Rows without words (null, empty) have size 0 and are taken
    only with the whole source. The choice depends on `seed`, the key and the counts alone; among repeated rows of one key any may
    be the one taken, which leaves the same rows. A null source is a source of its own. Other columns of `docs` are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    mark = F.xxhash64(F.lit(seed), F.col("id"))
    rows = saved(spark, rows.withColumn("mark", mark).withColumn("bucket", F.pmod("mark", F.lit(BUCKETS)).cast("int")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    counts = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    t = targets.alias("t")
    counts = counts.alias("c").join(t, F.col("c.source").eqNullSafe(F.col("t.source"))).select("c.source", "size", "n", "source_size", "target")
    plan = counts.groupBy("source").applyInPandas(
        _fit, "source string, size long, source_size long, target double, whole int, extra long"
    )
    plan = saved(spark, plan, "mix-plan")

    # Each bucket of the seeded hash is taken whole, in part (one bucket of a length at most) or not at all.
    part = rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    w = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = part.withColumn("upto", F.sum("n").over(w)).alias("a")
    p = plan.alias("p")
    part = part.join(p, F.col("a.source").eqNullSafe(F.col("p.source")) & (F.col("a.size") == F.col("p.size"))).select(
        "a.source", "a.size", "bucket", "n", "source_size", "target", "whole", (F.col("extra") - F.col("upto") + F.col("n")).alias("need")
    )
    b = part.alias("b")
    joined = rows.alias("r").join(
        b,
        F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.size") == F.col("b.size")) & (F.col("r.bucket") == F.col("b.bucket")),
    ).select("r.*", "source_size", "target", "whole", "n", "need")
    divided = (F.col("need") > 0) & (F.col("need") < F.col("n"))
    order = Window.partitionBy("source", "size", "bucket").orderBy("mark", "id")
    edge = joined.where(divided).withColumn("once_more", (F.row_number().over(order) <= F.col("need")).cast("int"))
    inner = joined.where(~divided).withColumn("once_more", (F.col("need") >= F.col("n")).cast("int"))
    out = edge.unionByName(inner).withColumn("times", F.col("whole") + F.col("once_more"))
    return out.select(
        F.col("id").alias(key), "size", "source", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken")
    )


def mixed_rows(
    spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options: object
) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, with all their columns; rows without words as often as their whole source.

    Rows are matched to the mix by key, source and text; repeated rows are taken as often together as the mix takes them.
    """
    digest = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    marked = docs.select(F.struct(F.col(f"`{key}`").alias("key"), digest.alias("digest")).alias("doc"), F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source"))
    times = mix(spark, marked, "doc", "text", "source", **options).groupBy("doc.key", "doc.digest", "source").agg(
        F.sum("times").alias("times"), F.count("*").alias("rows")
    )
    t = saved(spark, times, "mix-times").where("times > 0").alias("t")
    d = packed(docs, key=F.col(f"`{key}`"), digest=digest, source=F.col(f"`{source}`")).alias("d")
    same = F.col("d.key").eqNullSafe(F.col("t.key")) & (F.col("d.digest") == F.col("t.digest")) & F.col("d.source").eqNullSafe(F.col("t.source"))
    found = d.join(t, same).select("d.*", "times", "rows")
    # Of repeated rows each comes times / rows times, the first of them once more for what is left.
    nth = F.row_number().over(Window.partitionBy("key", "digest", "source").orderBy(F.lit(0)))
    several = found.where("rows > 1").withColumn("n", F.floor(F.col("times") / F.col("rows")) + (nth <= F.col("times") % F.col("rows")).cast("int"))
    out = found.where("rows = 1").withColumn("n", F.col("times")).unionByName(several)
    return out.where("n > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).select("row.*")
