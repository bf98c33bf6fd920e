"""Line dedup: a suffix order over line-ID sequences by prefix doubling, and removal of later copies of repeated line runs.

Only column expressions, joins, windows and grouped counts are used. Lines that occur once end every repeated run, so they leave
before the first round, as do stretches too short to hold a run; a suffix whose rank no other suffix has leaves after each round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamtab.llm.common import WORD, packed, saved

MIN_WORDS = 50
MAX_LEVEL = 62
# About 20 MB.
BROADCAST_CUTS = 200_000
# A class of equal windows with more than one of so many windows is hot; there are fewer such classes than this.
HOT_SHARE = 1000


def line_words(line: Column) -> Column:
    """Words of a line: runs of anything but ASCII white space."""
    return F.regexp_count(line, F.lit(WORD)).cast("long")


def document_key(key: Column, text: Column) -> Column:
    """One value per document: the same for repeated rows, different for different texts under one key."""
    return F.unhex(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("\n"), F.md5(text))))


def _ranked(spark: SparkSession, values: DataFrame, name: str, label: str) -> DataFrame:
    """`values` (distinct rows) with a rank in column `name`: increasing in their order, unique, dealt without gathering them.

    A range shuffle and a sort within partitions put them in order; the generated id then rises along that order.
    """
    ordered = values.repartitionByRange(*values.columns).sortWithinPartitions(*values.columns)
    return saved(spark, ordered.withColumn(name, F.monotonically_increasing_id()), label)


def positions(spark: SparkSession, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, id, i, rank, words) of the lines that occur more than once, `rank` ordering the lines; repeated rows count once."""
    body = F.col(f"`{text}`")
    split = docs.where(body.isNotNull()).select(
        document_key(F.col(f"`{key}`"), body).alias("doc"),
        F.col(f"`{key}`").alias("id"),
        F.posexplode(F.split(body, "\n")).alias("i", "line"),
    )
    lines = split.select("doc", "id", "i", F.unhex(F.md5("line")).alias("digest"), line_words(F.col("line")).alias("words"))
    lines = saved(spark, lines.groupBy("doc", "i").agg(F.first("id").alias("id"), F.first("digest").alias("digest"), F.first("words").alias("words")), "lines-all")
    repeated = lines.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    return saved(spark, lines.join(_ranked(spark, repeated, "rank", "lines-ids"), "digest").drop("digest"), "lines-repeated")


def windows_of(spark: SparkSession, lines: DataFrame, min_words: int) -> tuple[DataFrame, DataFrame]:
    """(lines, windows): the lines of unbroken stretches of at least `min_words` words, and (doc, i, span) of the shortest windows of so many
    words that start at a line or end at one.

    A repeated run of at least `min_words` words is the union of such windows: a line of it is in the window that ends there, or, too near the
    start for that, in the window that starts with the run; both lie inside the run.
    """
    in_run = Window.partitionBy("doc", "run")
    lines = lines.withColumn("run", F.col("i") - F.row_number().over(Window.partitionBy("doc").orderBy("i")))
    lines = lines.withColumn("before", F.sum("words").over(in_run.orderBy("i")) - F.col("words"))
    lines = lines.withColumns({"total": F.sum("words").over(in_run), "first": F.min("i").over(in_run), "last": F.max("i").over(in_run)})
    lines = lines.where(F.col("total") >= min_words)
    # A line's count before it is the count up to the line above, so ends are found one line further on, and the run's last line apart.
    ahead = in_run.orderBy(F.col("before").desc()).rangeBetween(Window.unboundedPreceding, -min_words)
    behind = in_run.orderBy("before").rangeBetween(Window.unboundedPreceding, -min_words)
    lines = lines.withColumns({"past": F.min("i").over(ahead), "opens": F.max("i").over(behind)})
    lines = lines.withColumn("closing", F.max(F.when(F.col("before") <= F.col("total") - min_words, F.col("i"))).over(in_run))
    lines = saved(spark, lines, "lines-windows")
    end = F.coalesce(F.col("past") - 1, F.when(F.col("total") - F.col("before") >= min_words, F.col("last")))

    def window(start: Column, end: Column, when: Column) -> Column:
        return F.when(when, F.struct(start.cast("int").alias("i"), (end - start + 1).cast("int").alias("span")))

    from_here = window(F.col("i"), end, end.isNotNull())
    to_above = window(F.col("opens"), F.col("i") - 1, F.col("opens").isNotNull())
    to_last = window(F.col("closing"), F.col("last"), F.col("i") == F.col("last"))
    windows = lines.select("doc", F.explode(F.array_compact(F.array(from_here, to_above, to_last))).alias("w"))
    return lines.select("doc", "id", "i", "rank"), saved(spark, windows.select("doc", "w.i", "w.span").distinct(), "lines-spans")


def _later_copies(spark: SparkSession, ends: DataFrame, hot: int) -> DataFrame:
    """(doc, i, span) of all windows of a class but the first. Classes of more than `hot` windows are broadcast, fewer than `HOT_SHARE`; others
    meet their windows by a shuffle."""
    keys = ["span", "rank", "last"]
    ends = saved(spark, ends, "lines-ends")
    groups = ends.groupBy(*keys).agg(F.min(F.struct("id", "doc", "i")).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = saved(spark, groups, "lines-classes")
    marked = ends.join(F.broadcast(groups.where(F.col("n") > hot).select(*keys, "first")), keys, "left")
    cool = marked.where("first IS NULL").drop("first").join(groups.where(F.col("n") <= hot).select(*keys, "first"), keys)
    both = marked.where("first IS NOT NULL").unionByName(cool)
    return saved(spark, both.where(F.struct("id", "doc", "i") != F.col("first")).select("doc", "i", "span"), "lines-later")


def repeated_windows(spark: SparkSession, lines: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, i, span): the windows that repeat an earlier one, earlier by key, then document, then line.

    Round a ranks every suffix by its first 2**a lines, from the ranks of the round before at the suffix and 2**(a-1) lines on. A
    window of 2**a <= span < 2**(a+1) lines is known by its span and the ranks where its first and its last 2**a lines begin: windows
    with these three in common are one interval of the suffix order with a common prefix of at least `span` lines.
    """
    level, ranks, found = 0, lines, None
    hot = windows.count() // HOT_SHARE
    while True:
        size = 1 << level
        due = windows.where((F.col("span") >= size) & (F.col("span") < 2 * size))
        tails = ranks.select("doc", F.col("i").alias("tail"), F.col("rank").alias("last"))
        ends = ranks.join(due, ["doc", "i"]).withColumn("tail", F.col("i") + F.col("span") - size).join(tails, ["doc", "tail"])
        later = _later_copies(spark, ends.drop("tail"), hot)
        found = later if found is None else found.unionByName(later)
        if level == MAX_LEVEL or ranks.join(windows.where(F.col("span") >= 2 * size), ["doc", "i"], "left_semi").isEmpty():
            return found
        # Suffixes may have left, so the next rank is the one exactly `size` lines on or none.
        ahead = ranks.select("doc", (F.col("i") - size).alias("i"), F.col("rank").alias("next"))
        paired = saved(spark, ranks.join(ahead, ["doc", "i"]), "lines-pairs")
        both = paired.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1").select("rank", "next")
        both = _ranked(spark, both, "new", "lines-ranks")
        level += 1
        ranks = paired.join(both, ["rank", "next"])
        ranks = saved(spark, ranks.drop("rank", "next").withColumnRenamed("new", "rank"), "lines-level")


def dedup_lines(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with later copies of repeated line runs cut from `text`, and `n_lines` and `n_deleted`.

    A line goes when it is part of a stretch of whole lines of at least `min_words` words (1 or more) that occurs earlier, in another document
    or in the same one; a later copy of a maximal repeated run thus goes whole. Words are runs of anything but ASCII white space.
    Documents come in key order (null first). First copies stay, except lines of them that are themselves in a
    later copy. Repeated rows of a document count once and all get the same text. A null text stays null with no lines; an empty
    text is one empty line. Other columns pass through.
    """
    later = repeated_windows(spark, *windows_of(spark, positions(spark, docs, key, text), min_words))
    # Deleted stretches of a document, overlapping ones joined, as (kept lines before, deleted lines).
    before = Window.partitionBy("doc").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    joined = later.withColumn("reach", F.max(F.col("i") + F.col("span")).over(before))
    joined = joined.withColumn("opens", (F.coalesce("reach", F.lit(-1)) < F.col("i")).cast("int"))
    joined = joined.withColumn("part", F.sum("opens").over(Window.partitionBy("doc").orderBy("i")))
    parts = joined.groupBy("doc", "part").agg(F.min("i").alias("start"), F.max(F.col("i") + F.col("span")).alias("stop"))
    past = F.coalesce(F.lag("stop").over(Window.partitionBy("doc").orderBy("start")), F.lit(0))
    parts = parts.select("doc", "start", (F.col("start") - past).alias("keep"), (F.col("stop") - F.col("start")).alias("cut"))
    cuts = saved(spark, parts.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "keep", "cut"))).alias("cuts")), "lines-cuts")

    docs = docs.drop("n_lines", "n_deleted")
    body = F.col(f"`{text}`")
    rows = packed(docs, doc=document_key(F.col(f"`{key}`"), body), body=body)
    # Few documents have cuts: up to so many cuts are broadcast, so that texts stay where they are; more are joined by shuffle.
    number = cuts.agg(F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()[0]
    rows = rows.join(F.broadcast(cuts) if number <= BROADCAST_CUTS else cuts, "doc", "left")
    body = F.col("body")
    flags = F.flatten(F.transform("cuts", lambda c: F.concat(F.array_repeat(F.lit(True), c["keep"]), F.array_repeat(F.lit(False), c["cut"]))))
    kept = F.zip_with(F.split(body, "\n"), flags, lambda line, on: F.struct(line.alias("line"), F.coalesce(on, F.lit(True)).alias("on")))
    left = F.array_join(F.transform(F.filter(kept, lambda p: p["on"]), lambda p: p["line"]), "\n")
    deleted = F.coalesce(F.aggregate("cuts", F.lit(0), lambda n, c: n + c["cut"]), F.lit(0)).cast("long")
    n_lines = F.when(body.isNull(), 0).otherwise(F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1).cast("long")
    columns = [F.when(F.col("cuts").isNull(), body).otherwise(left).alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    return rows.select(*columns, n_lines.alias("n_lines"), deleted.alias("n_deleted"))
