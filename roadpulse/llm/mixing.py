"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source size`` copies. Documents of a
source stand in a fixed order, their expected copies are summed up, one offset
between 0 and 1 is added, and a document is emitted once for each integer its part
of the sum crosses. So a source's copies differ from the expected number by less
than one, and ordering by size keeps its words as close.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.frames import WORD, only, ranked
from roadpulse.storage import materialise

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_COPIES = 2


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``sizes`` with ``weight`` and ``target``.

    ``sizes`` has ``source`` and ``source_size``, one row per source; they are weighted in code point order, null
    last. The total is shared by weight. A source stops at ``max_copies`` times its
    size and the excess goes to the others by weight until none is above; sorted by
    size per weight, the capped sources are a prefix, which sums find without
    iterating. All but the last division is in whole numbers. The windows hold one
    row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_need = Window.orderBy(
        (F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    big = "decimal(19,0)"
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place.cast("int") + 1).cast("bigint")
    # Hundredths of a word, so that the share is a whole number.
    cap = F.col("source_size") * (100 * max_copies)
    rest = F.col("total") - F.col("capped_before")
    row = (
        sizes.withColumn("weight", weight)
        .withColumn("total", F.sum("source_size").over(everything) * share_percent)
        .withColumn("cap", cap)
        .withColumn("capped_before", F.sum("cap").over(by_need) - F.col("cap"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.sum("weight").over(by_need) + F.col("weight"))
        .withColumn(
            "is_capped",
            rest.cast(big) * F.col("weight").cast(big) > F.col("cap").cast(big) * F.col("weight_left").cast(big),
        )
    )
    free = ~F.col("is_capped")
    # The first source in that order that is not capped tells what the free ones share.
    row = row.withColumn("free_rest", F.max(F.when(free, rest)).over(everything)).withColumn(
        "free_weight", F.max(F.when(free, F.col("weight_left"))).over(everything)
    )
    share = (F.col("free_rest") * F.col("weight")).cast("double") / (F.col("free_weight") * 100).cast("double")
    target = F.when(F.col("is_capped"), (F.col("source_size") * max_copies).cast("double")).otherwise(share)
    return row.withColumn("target", target).select(*sizes.columns, "weight", "target")


def offset(source: Column) -> Column:
    """A fixed draw between 0 and 1 per source, the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit("offset:"), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def mixture(
    documents: DataFrame,
    carry: Sequence[str] = (),
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, one row per row of ``documents``.

    Reads ``doc_id``, ``text`` and ``source``; other columns are not looked at, but
    those named in ``carry`` come along as the struct ``row``. A null or empty text
    has size 0 and takes no words. A null source is a source of its own; a null
    ``doc_id`` comes first among equal sizes; repeated rows are documents of their
    own. An empty table gives an empty result. A source of size 0 has target 0.

    A source may hold any share of the rows: only counts are shuffled by source.
    """
    extra = {"row": F.struct(*[documents[c] for c in carry])} if carry else {}
    rows = only(documents, doc_id="doc_id", source="source", size=words(documents["text"]), **extra)
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]
    placed = ranked(rows, order, "mix-order")
    sums = placed.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.min("at").alias("first")
    )
    shares = materialise(targets(sums, weights, share_percent, max_copies), "mix-targets")
    shares = shares.withColumnRenamed("source", "of")
    per_document = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    before = (F.col("at") - F.col("first")).cast("double")
    up_to = F.floor((before + 1) * F.col("each") + F.col("draw"))
    crossed = up_to - F.floor(before * F.col("each") + F.col("draw"))
    return (
        placed.join(shares, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("each", per_document)
        .withColumn("draw", offset(F.col("source")))
        .withColumn("copies", crossed.cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", "taken", *extra)
    )


def mixed(documents: DataFrame, **settings) -> DataFrame:
    """The mixture itself: each row of ``documents`` as often as it is taken, with all its columns."""
    taken = mixture(documents, carry=documents.columns, **settings).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
