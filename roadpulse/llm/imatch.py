"""Document fingerprints by I-Match, in DataFrame functions alone.

The lexicon holds the terms within a band of document frequency: neither so rare
that they are noise nor so common that they say nothing. A document's distinct terms
of a lexicon, sorted, are hashed. Besides the whole lexicon there are randomised
subsets of it, ``SETS`` at each of the rates in ``RATES``: a change moves only the
hashes of the subsets its terms are in, and there is a rate at which a subset takes a
few terms of a document, whether that is short or long. A fingerprint is the list of
these hashes, empty where a document has no term of the subset.

A text that many rows hold counts once where the band asks whether a term is too common,
so that copies do not take their own words out of the lexicon.

A text without any term of the lexicon is known by the hash of the text alone.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.frames import only, width
from roadpulse.storage import materialise

# A term is in the lexicon if at least one row in LEAST_OF has it, two anyway, and no
# more than one text in MOST_OF. Texts are rows, but one that more than one row in
# OFTEN_OF holds, and more than one row, is a single text however many hold it.
LEAST_OF, MOST_OF, OFTEN_OF = 1000, 5, 10_000
RATES, SETS = (32, 128, 512), 16
# All documents have their distinct terms, so no more than LEAST_OF times their mean
# number can each be in one of LEAST_OF documents. A lexicon up to this size is held by
# every task; a larger one, as of a corpus of books, is joined by a shuffle.
MOST_TERMS = 2_000_000
_GAP = r"[\x20\x09-\x0D]+"
_NOTHING = md5(b"").hexdigest()[:16]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """Distinct words of a text, A-Z in lower case."""
    words = F.split(F.translate(text, _UPPER, _LOWER), _GAP, -1)
    return F.array_remove(F.array_distinct(words), "")


def _counted(documents: DataFrame) -> DataFrame:
    """``text, copies``: each row, but a text that is held often as one row with its number of copies.

    Only hashes are shuffled, and one text per task of those held often: each is held by more
    than one row in ``OFTEN_OF`` and by two at least, so there are fewer than ``OFTEN_OF``.
    """
    n_docs = documents.count()
    hashed = documents.select("text", F.md5("text").alias("hash"))
    often = hashed.groupBy("hash").agg(F.count("*").alias("copies")).filter(F.col("copies") > max(1, n_docs // OFTEN_OF))
    often = F.broadcast(materialise(often, "imatch-copies"))
    rare = hashed.join(often, "hash", "left_anti").select("text", F.lit(1).cast("bigint").alias("copies"))
    held = hashed.join(often.select("hash"), "hash").groupBy("hash").agg(F.any_value("text").alias("text"))
    return rare.unionByName(held.join(often, "hash").select("text", "copies"))


def lexicon(documents: DataFrame) -> DataFrame:
    """``term, df, mask`` of the band over all of ``documents`` (``text``); ``df`` counts rows.

    Bit 0 of ``mask`` is the whole lexicon, then ``SETS`` bits per rate: at a rate of
    one in ``r`` the hash of a term modulo ``r`` names its subset, if it is below
    ``SETS``.
    """
    counted = _counted(documents)
    n_docs, n_texts = counted.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")).first()
    least, most = max(2, -(-n_docs // LEAST_OF)), max(2, n_texts // MOST_OF)
    counts = counted.select(F.explode(terms(F.col("text"))).alias("term"), "copies").groupBy("term")
    band = counts.agg(F.sum("copies").alias("df"), F.count("*").alias("texts"))
    band = band.filter((F.col("df") >= least) & (F.col("texts") <= most))
    digest = F.md5("term")
    mask = F.lit(1).cast("bigint")
    for i, rate in enumerate(RATES):
        number = F.conv(F.substring(digest, 1 + 4 * i, 4), 16, 10).cast("bigint") % rate
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (number + 1 + SETS * i).cast("int"))
        mask = mask.bitwiseOR(F.when(number < SETS, bit).otherwise(F.lit(0).cast("bigint")))
    return band.select("term", "df", mask.alias("mask"))


def joined(found: DataFrame) -> tuple[DataFrame, str]:
    """The lexicon as a side of a join, and the kind of join that keeps texts without a term of it.

    The small one is broadcast, with an empty term that every text has, so that rows without
    a term of the lexicon end at the join.
    """
    found = materialise(found, "imatch-lexicon")
    words = found.select("term", "mask")
    if found.count() > MOST_TERMS:
        return words, "left"
    marker = found.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(0).cast("bigint").alias("mask"))
    return F.broadcast(words.union(marker)), "inner"


def _hashes(known: Column, text_hash: Column) -> Column:
    """The fingerprint of a text from its sorted terms of the lexicon."""

    def hashed(some: Column) -> Column:
        # Terms are not empty, so only a list of none has the hash of nothing.
        joined = F.array_join(F.transform(some, lambda x: x["term"]), " ")
        return F.replace(F.substring(F.md5(joined), 1, 16), F.lit(_NOTHING), F.lit(""))

    def with_bits(some: Column, bits: int) -> Column:
        return F.filter(some, lambda x: x["mask"].bitwiseAND(F.lit(bits).cast("bigint")) != 0)

    def subsets(bits: list[int]) -> Column:
        # Through a list of one, so that a rate's terms are sought out once.
        some = F.array(with_bits(known, sum(bits)))
        return F.get(F.transform(some, lambda x: F.array(*[hashed(with_bits(x, b)) for b in bits])), F.lit(0))

    whole = F.when(F.size(known) > 0, hashed(known)).otherwise(
        F.concat(F.lit("x"), F.substring(text_hash, 1, 15))
    )
    rates = [[1 << (1 + SETS * i + s) for s in range(SETS)] for i in range(len(RATES))]
    return F.concat(F.array(whole), *map(subsets, rates))


def _prints(rows: DataFrame, key: list[str], keep: list[str], bodies: list[str], words: tuple[DataFrame, str]) -> DataFrame:
    """``key``, ``keep`` and per column of ``bodies`` its fingerprint, as ``print_<column>``.

    Terms are exploded, joined with the lexicon and collected per ``key``.
    """
    whole = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(b).alias("body")) for i, b in enumerate(bodies)])
    hashes = [F.md5(b).alias(f"hash_{b}") for b in bodies]
    carried = [*key, *keep, *[f"hash_{b}" for b in bodies]]
    bodied = rows.select(*key, *keep, *hashes, F.explode(whole).alias("b")).filter("b.body is not null")
    with_marker = F.concat(terms(F.col("b.body")), F.array(F.lit("")))
    spread = bodied.select(*carried, F.col("b.kind").alias("kind"), F.explode(with_marker).alias("term"))
    seen = spread.join(words[0], "term", words[1])
    first = [F.any_value(c).alias(c) for c in carried if c not in key]
    kinds = [
        F.collect_list(F.when((F.col("kind") == i) & (F.col("mask") != 0), F.struct("term", "mask"))).alias(f"terms_{b}")
        for i, b in enumerate(bodies)
    ]
    found = seen.groupBy(*key).agg(*first, *kinds)
    # Sorted in a step of its own, as the hashes look at the list several times.
    found = found.withColumns({f"terms_{b}": F.sort_array(f"terms_{b}") for b in bodies})
    prints = [_hashes(F.col(f"terms_{b}"), F.col(f"hash_{b}")).alias(f"print_{b}") for b in bodies]
    return found.select(*key, *keep, *prints)


def likeness(left: Column, right: Column) -> Column:
    """Of the subsets that either document has terms of, the share whose hashes are equal."""
    same = F.zip_with(left, right, lambda a, b: F.when((a != "") & (a == b), 1).otherwise(0))
    either = F.zip_with(left, right, lambda a, b: F.when((a != "") | (b != ""), 1).otherwise(0))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda x, y: x + y)

    return total(same).cast("double") / total(either).cast("double")


def written(hashes: Column) -> Column:
    return F.array_join(hashes, "-")


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of each row of ``documents``, over the lexicon of all of them.

    A null text is empty. Ids may be null or repeat; an empty table gives an empty
    result; other columns are not looked at.
    """
    rows = only(documents, doc_id="doc_id", text=F.coalesce(documents["text"], F.lit("")))
    words = joined(lexicon(rows))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    found = _prints(rows, ["_row"], ["doc_id"], ["text"], words)
    return found.select("doc_id", written(F.col("print_text")).alias("fingerprint"))


def _bucket(place: Column, borders: list[int]) -> Column:
    """The number of borders at or below ``place``, less one, found in two steps."""
    step = max(1, round(len(borders) ** 0.5))
    groups = [borders[i : i + step] for i in range(0, len(borders), step)]
    tops = F.array(*[F.lit(g[0]) for g in groups])
    lists = F.array(*[F.array(*map(F.lit, g)) for g in groups])

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= place))

    top = F.greatest(below(tops), F.lit(1))
    return (top - 1) * step + below(F.element_at(lists, top)) - 1


def _with_next(rows: DataFrame) -> DataFrame:
    """``rows`` (``place, text, ...``) with ``next_text``, the text next in ``place``; the first follows the last.

    Rows are dealt by ranges of ``place`` whose borders are places of rows, and get
    their number ``seq`` in the ``range``. The first row of a range is also sent to the
    range before, as the next of its last; it is marked by ``tail``.
    """
    n = 4 * width(rows.sparkSession)
    asked = F.percentile_approx("place", F.array(*[F.lit(i / n) for i in range(n)]), 20 * n)
    got = rows.agg(asked.alias("b"), F.min("place").alias("first")).first()
    borders = sorted({got["first"], *(got["b"] or [])}) if got["first"] is not None else [0]
    bucket = F.col("bucket")
    before = F.when(bucket == 0, F.lit(len(borders) - 1)).otherwise(bucket - 1)
    here = F.struct(bucket.alias("range"), F.lit(False).alias("tail"))
    there = F.struct(before.alias("range"), F.lit(True).alias("tail"))
    opens = F.element_at(F.array(*map(F.lit, borders)), bucket + 1) == F.col("place")
    targets = F.when(opens, F.array(here, there)).otherwise(F.array(here))
    sent = rows.withColumn("bucket", _bucket(F.col("place"), borders)).select(
        *rows.columns, F.explode(targets).alias("to")
    )
    sent = sent.select(*rows.columns, "to.range", "to.tail")
    order = Window.partitionBy("range").orderBy("tail", "place", "text")
    return sent.select("*", F.lead("text").over(order).alias("next_text"), F.row_number().over(order).alias("seq"))


def edit_test(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of an edited copy and of the next document.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``, one row per row of ``documents``. The edited copy ends, for its last
    quarter, with the beginning of the next document in ``doc_id`` order (null first,
    equal ids by text); after the last comes the first. A single document follows
    itself. A null text is empty; an empty table gives an empty result; other columns
    are not looked at.

    Texts are shuffled once, by ranges of ``doc_id``; all that follows stays in the
    ranges.
    """
    place = F.coalesce(documents["doc_id"].cast("bigint"), F.lit(-(2**63)))
    rows = only(documents, doc_id="doc_id", place=place, text=F.coalesce(documents["text"], F.lit("")))
    words = joined(lexicon(rows))
    n_chars = F.length("text")
    cut = F.floor(n_chars / 4).cast("int")
    edited = F.concat(F.left(F.col("text"), n_chars - cut), F.left(F.col("next_text"), cut))
    pairs = _with_next(rows).select(
        "range", "seq", "tail", "doc_id", "text", n_chars.cast("bigint").alias("n_chars"),
        F.when(~F.col("tail"), edited).alias("edited"),
    )
    pairs = pairs.withColumn("edited_sha256", F.sha2("edited", 256))
    found = _prints(pairs, ["range", "seq"], ["tail", "doc_id", "n_chars", "edited_sha256"], ["text", "edited"], words)
    in_range = Window.partitionBy("range").orderBy("seq")
    found = found.withColumn("print_next", F.lead("print_text").over(in_range)).filter(~F.col("tail"))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("print_text")).alias("fingerprint"),
        written(F.col("print_edited")).alias("edited_fingerprint"),
        likeness(F.col("print_text"), F.col("print_edited")).alias("near_edited"),
        likeness(F.col("print_text"), F.col("print_next")).alias("near_next"),
    )
