"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A word is a longest run of characters other than blanks and the controls from tab to return.
WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often than this.
MOST_COPIES = 3


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """One row for each source: source, source_size, target (double).

    ``sizes`` has a row for each source, so the windows over all of it see names
    of sources only. Sources in code-point order, NULL last, have the weights in
    turn. All sizes together are shared by weight; a target stops at ``most``
    times its source's size and the excess goes to the others by weight. A source
    is stopped from a certain share on, so in the order of size to weight the
    stopped sources come first, and one running sum finds them.
    """
    by_name = Window.orderBy(F.col(source).asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1)
    rows = sizes.select(F.col(source), F.col(size).alias("source_size"), weight.cast("long").alias("_weight"))
    everything = Window.partitionBy()
    tightest = Window.orderBy(F.col("source_size") / F.col("_weight"), F.col(source).asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    left_weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0))
    shared = rows.select("*", (left_words / left_weight).alias("_share"))
    stopped = F.col("_share") * F.col("_weight") > most * F.col("source_size")
    # The share of the first source that isn't stopped holds for all after it.
    level = F.min(F.when(~stopped, F.struct(F.col("source_size") / F.col("_weight"), F.col("_share").alias("share"))))
    full = F.col("_weight") * level.over(everything)["share"]
    target = F.least(F.coalesce(full, F.lit(0.0)), (most * F.col("source_size")).cast("double"))
    return shared.select(source, "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = 0,
) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and copies (how often each is taken).

    Every document of a source is expected ``target / source_size`` times. The
    documents of a source stand in a fixed order, by size class, then by a hash
    of the id; with one random offset for each source, a document is taken once
    for each integer that the running sum of expected copies crosses. Since the
    order follows the sizes, the words taken come near the target, too.

    The running sum over a source is put together from totals of (source, size
    class, slice of the hash), so a source with any share of the rows is spread
    over many tasks. Offset and order come from hashes of ``seed``, names and ids:
    a rerun takes the same. Rows alike in id and size are interchangeable.

    Defined cases: a NULL source is a source of its own; a NULL or empty text has
    size 0 and takes no words; NULL ids count as the empty id; an empty table
    gives no rows. Columns of ``docs`` that have the names of results are replaced.
    """
    keys = ["_source", "_class", "_slice"]
    results = ["size", "source_size", "target", "copies"]
    # All that stays lies in one column, so that no name of a user's column is in the way.
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in results]).alias("_kept")
    size = word_count(F.col(text))
    binary = F.bin(F.col("size"))
    named = docs.select(
        kept,
        size.alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("_source"),
        F.col(doc_id).alias("_id"),
    )
    rows = (
        named
        .withColumn("_class", F.concat(F.lpad(F.length(binary).cast("string"), 2, "0"), F.substring(binary, 1, 4)))
        .withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary")))
        .withColumn("_slice", F.substring("_hash", 1, 2))
        .select("_kept", "_id", "size", *keys, "_hash")
        .repartition(*keys)
    )
    # Grouped as they lie: the count of a slice needs no shuffle of its own.
    slices = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    classes = slices.groupBy("_source", "_class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    totals = classes.groupBy("_source").agg(F.sum("words").alias("words"))
    name = F.when(F.col("_source") != "", F.substring("_source", 2, 1 << 30))
    targets = source_targets(totals.select(name.alias("_name"), "words"), "_name", "words", weights, most)
    targets = targets.select(
        F.coalesce(F.concat(F.lit("="), F.col("_name")), F.lit("")).alias("_source"),
        "source_size",
        "target",
    )
    ahead = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    class_start = classes.select(
        "_source", "_class", F.coalesce(F.sum("n").over(ahead("_source", "_class")), F.lit(0)).alias("_class_start")
    ).join(targets, "_source")
    slice_start = slices.select(
        *keys, F.coalesce(F.sum("n").over(ahead(*keys)), F.lit(0)).alias("_slice_start")
    ).join(class_start, ["_source", "_class"])
    within = Window.partitionBy(*keys).orderBy("size", "_hash", F.col("_id").asc_nulls_first())
    ranked = rows.withColumn("_rank", F.row_number().over(within)).join(slice_start, keys)
    rank = F.col("_class_start") + F.col("_slice_start") + F.col("_rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    mark = F.md5(F.concat(F.lit(f"{seed}/"), F.col("_source")).cast("binary"))
    offset = F.conv(F.substring(mark, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    copies = F.floor(offset + rank * rate) - F.floor(offset + (rank - 1) * rate)
    return ranked.select(
        "_kept.*", "size", "source_size", "target", F.least(copies, F.lit(most)).cast("long").alias("copies")
    )


def take(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the columns of ``docs``, whatever their names."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    rows = docs.select(whole, F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    mixed = mix(rows, **options).where("copies > 0")
    return mixed.select("whole", F.explode(F.expr("sequence(1, copies)"))).select("whole.*")
