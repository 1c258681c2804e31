"""Mix sources to target weights.

Every document gets a hash-random key. Keys are uniform, so ranges of equal
width are even by design: the documents of a source are cut into key ranges by
their number, ranges are summed with a map-side step, the sums of the ranges
before a range come from one row per range, and only then are rows sorted
inside their range. No task sees more than a range, however large a source is,
and the same rows give the same mix on every run.

Nulls: a null source is a source of its own and comes last; a null text has no
words; a null id takes part like any other. Repeated rows are documents of
their own. An empty table gives no rows. Columns of the input other than those
named are left out of ``mix_plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayflow.llm.common import SPACED_WORD, word_count
from stayflow.session import materialize

#: Documents of one key range, about. A memory setting: the mix is the same for any value.
RANGE_ROWS = 2_000
#: Targets are sent to every task up to this many sources, and joined by shuffle above.
SOURCES_TO_BROADCAST = 10_000
KEY_BITS = 48


def mix_key(doc_id: Column, seed: str) -> Column:
    """The hash-random key of a document as 32 hex digits; text order is its order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(sources: DataFrame, weights: tuple[int, ...], share_pct: int, max_epochs: int) -> DataFrame:
    """Targets per source: (source, source_size, target).

    Weights repeat over the sources by code point with null last. All targets
    together are ``share_pct`` percent of all words; a target stops at
    ``max_epochs`` times its source and what is above goes to the others by
    weight. With sources in the order of size over weight those that stop are
    the first ones, so the level of the rest follows from running sums. Input
    has one row per source.
    """
    sizes = sources.select("source", F.col("source_size").cast("bigint").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    after = fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    leveled = (
        sizes.withColumn("weight", weight)
        .withColumn("words", F.sum("source_size").over(W.partitionBy()))
        .withColumn("held", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("rest_weight", F.sum("weight").over(after))
        # 100 times what is left for this source and all after it
        .withColumn("rest", F.lit(share_pct) * F.col("words") - F.lit(100 * max_epochs) * F.col("held"))
        .withColumn("stops", F.col("weight") * F.col("rest").cast("double") > F.lit(100.0 * max_epochs) * F.col("source_size") * F.col("rest_weight"))
    )
    # the first source that does not stop sets the level of itself and all after it
    open_at = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "rest", "rest_weight"))).over(W.partitionBy())
    level = open_at.alias("level")
    return leveled.select("source", "source_size", "weight", level).select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("source_size") * F.lit(float(max_epochs)))
        .otherwise(F.least(F.col("source_size") * F.lit(float(max_epochs)), (F.col("weight") * F.col("level.rest")).cast("double") / (F.lit(100) * F.col("level.rest_weight")).cast("double")))
        .alias("target"),
    )


def mix_plan(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_pct: int = 150, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """What the mix takes of every document: doc_id, source, size, source_size, target, taken, epochs, part, mix_key.

    A source's target is met to the word: whole epochs first, then documents in
    key order until the budget is used, the last one in part. ``taken`` counts
    repeats, ``epochs`` the times the document starts, ``part`` the words of
    the epoch that the budget ends.
    """
    return _taken(documents.select("doc_id", "text", "source"), weights, share_pct, max_epochs, seed)


def _sources(words: DataFrame) -> DataFrame:
    """(source, source_size, rows) in a table of the shared folder: one row per source."""
    return materialize(words.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "sources")


def _taken(rows: DataFrame, weights: tuple[int, ...], share_pct: int, max_epochs: int, seed: str) -> DataFrame:
    """``rows`` with doc_id, text, source and whatever else is carried along; without more, the text is left behind."""
    words = rows.withColumn("size", word_count(F.col("text"))).withColumn("mix_key", mix_key(F.col("doc_id"), seed))
    ties = ["text"] if "row" in rows.columns else []
    words = words if ties else words.drop("text")
    per_source = _sources(words)
    same_source = F.col("t.source").eqNullSafe(F.col("p.source"))
    targets = source_targets(per_source, weights, share_pct, max_epochs).alias("t").join(per_source.alias("p"), same_source)
    targets = targets.select(
        F.col("t.source").alias("source"),
        F.col("t.source_size").alias("source_size"),
        "target",
        F.ceil(F.col("rows") / F.lit(RANGE_ROWS)).cast("bigint").alias("ranges"),
        F.when(F.col("t.source_size") > 0, F.floor(F.col("target") / F.col("t.source_size"))).otherwise(F.lit(0)).cast("bigint").alias("rounds"),
        F.floor("target").cast("bigint").alias("budget"),
        # a number stands for the source, nulls included, in all that is dealt by source
        F.row_number().over(W.orderBy(F.col("t.source").asc_nulls_last())).alias("source_no"),
    )
    if per_source.count() <= SOURCES_TO_BROADCAST:
        targets = F.broadcast(targets)
    key_number = F.conv(F.substring("mix_key", 1, KEY_BITS // 4), 16, 10).cast("double")
    ranged = words.alias("w").join(targets.alias("g"), F.col("w.source").eqNullSafe(F.col("g.source")))
    ranged = ranged.select(
        "w.*", "source_size", "target", "rounds", "source_no",
        F.expr("budget - rounds * source_size").alias("rest"),
        F.floor(key_number * F.col("ranges") / F.lit(float(1 << KEY_BITS))).cast("bigint").alias("range"),
    )
    sums = ranged.groupBy("source_no", "range").agg(F.sum("size").alias("range_size"))
    before = W.partitionBy("source_no").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("range_size").over(before), F.lit(0))).drop("range_size")
    joined = ranged.join(sums, ["source_no", "range"])
    inside = W.partitionBy("source_no", "range").orderBy("mix_key", F.col("doc_id").asc_nulls_first(), "size", *ties).rowsBetween(W.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    placed = joined.withColumn("start", start)
    placed = placed.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("start"))).cast("bigint"))
    placed = placed.withColumn("taken", (F.col("rounds") * F.col("size") + F.col("part")).cast("bigint"))
    placed = placed.withColumn("epochs", (F.col("rounds") + (F.col("part") > 0).cast("bigint")).cast("bigint"))
    return placed.drop("range", "source_no", "rest", "rounds", "before", "start")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, blanks as they are."""
    runs = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + SPACED_WORD), F.lit(0))
    return F.array_join(F.slice(runs, F.lit(1), n.cast("int")), "")


def mix(documents: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_pct: int = 150, max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """The mixed corpus: the documents' columns and ``epoch``, one row per document and epoch.

    The document that meets its source's budget is cut after its last word that
    counts. Documents the mix leaves out have no row, nor have those without
    words. A column named ``epoch`` is replaced.
    """
    # the row travels as one struct, so its columns meet none of the plan's
    rows = documents.drop("epoch").select("doc_id", "text", "source", F.struct(*[c for c in documents.columns if c not in ("epoch", "text")]).alias("row"))
    taken = _taken(rows, weights, share_pct, max_epochs, seed).where("epochs > 0")
    taken = taken.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("epochs"))))
    cut = (F.col("epoch") == F.col("epochs")) & (F.col("part") > 0) & (F.col("part") < F.col("size"))
    text = F.when(cut, first_words(F.col("text"), F.col("part"))).otherwise(F.col("text"))
    kept = [F.col("text_out").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns if c != "epoch"]
    return taken.withColumn("text_out", text).select(*kept, "epoch")
