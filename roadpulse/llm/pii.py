"""Personal data by weak supervision, in DataFrame functions alone.

1. Regular expressions propose spans: the strict (base) ones, which always stay, and
   looser ones (addresses written with "at" and "dot", dotted numbers in brackets,
   national phone numbers, card numbers that fail their check digit).
2. Five labelers vote yes, no or nothing on each span: shape, check digit or range,
   gazetteer, words before it, and the characters around it.
3. Only the number of spans per kind and vote pattern leaves the executors, at most
   4 * 3**5 numbers. From them expectation-maximisation estimates how reliable each
   labeler is and how likely each pattern is personal data.
4. With these probabilities as soft labels a naive Bayes classifier over the look of
   a span and its surroundings is trained, from sums per feature value, and decides on
   every proposed span.

Start and end of a span are code points, end exclusive. A match's place is the sum
of the lengths of the matches and of the text between them, taken by a window over the
document's matches.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.frames import only
from roadpulse.storage import materialise

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "check", "gazetteer", "context", "edge")
FEATURES = ("size", "digits", "before", "after", "word", "valid")
ROUNDS = 30

# The patterns of the contract, written without repeated groups that
# could overflow the stack and without starts that rescan a run. A match may begin
# after a character of its own first class only where the last match ended.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9](?<![0-9].)[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
# Single separators between digits are marked first, so that a run is one class.
_MARK, _OTHER = "\x01", "\x02"
_CARD = rf"[0-9][0-9{_MARK}]{{11,}}"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The looser ones.
_AT = r"(?:\x20?[\[({](?i:at)[\])}]\x20?|\x20(?:at|AT)\x20)"
_DOT = r"(?:\x20?[\[({](?i:dot|\.)[\])}]\x20?|\x20(?:dot|DOT)\x20)"
_LOOSE_EMAIL = rf"(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:(?:{_DOT}|\.)[A-Za-z0-9-]++)++"
_LOOSE_IP = r"(?<![0-9])[0-9]{1,3}(?:[\[({]?\.[\])}]?[0-9]{1,3}){3}(?![0-9])"
_LOOSE_PHONE = r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
# Which texts can hold a match at all, in one quick scan each.
_NUMBERS = r"[0-9][0-9.()\[\]{}\x20-]{5,}[0-9]"
_WRITTEN = r"[\[({](?i:at)[\])}]|\x20(?:dot|DOT)\x20"

# Gazetteers and cue words.
_DOMAINS = "com|org|net|edu|gov|int|mil|info|biz|io|eu|uk|de|fr|es|it|nl|ch|at|be|us|ca|au|jp|cn|in|br|ru|example"
_COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5|2))"
_CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|correo|courriel|kontakt|reach)[^A-Za-z]{0,4}\w{0,6}[^A-Za-z]{0,4}$",
    "ip": r"(?i)(?:\bip|address|host|server|login|client|from)[^A-Za-z]{0,4}$",
    "card": r"(?i)(?:card|visa|master|amex|credit|carte|karte|tarjeta)[^A-Za-z]{0,4}\w{0,6}[^A-Za-z]{0,4}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|telefon|móvil|tél)[^A-Za-z]{0,4}\w{0,6}[^A-Za-z]{0,4}$",
}
_COUNTER_CUES = r"(?i)(?:isbn|issn|doi|version|v|page|figure|section|chapter|invoice|order|serial)[^A-Za-z]{0,3}$"
_LEFT, _RIGHT = 32, 1


def _none() -> Column:
    return F.array().cast("array<string>")


def _proposals(text: Column) -> list[tuple[str, bool, Column, Column]]:
    """Kind, whether strict, the matches and the text between them."""
    plain = F.translate(text, _MARK, _OTHER)
    joined = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", _MARK)
    has_at = text.contains("@")
    has_numbers = text.rlike(_NUMBERS)
    has_plus = has_numbers & text.contains("+")
    written = text.rlike(_WRITTEN)
    rules = [
        ("email", True, _EMAIL, text, has_at),
        ("ip", True, _IP, text, has_numbers),
        ("card", True, _CARD, joined, has_numbers),
        ("phone", True, _PHONE, text, has_plus),
        ("email", False, _LOOSE_EMAIL, text, written),
        ("ip", False, _LOOSE_IP, text, has_numbers),
        ("phone", False, _LOOSE_PHONE, text, has_numbers),
    ]
    out = []
    for kind, strict, pattern, where, likely in rules:
        found = F.when(likely, F.regexp_extract_all(where, F.lit(pattern), F.lit(0))).otherwise(_none())
        between = F.when(F.size(found) > 0, F.split(where, pattern, -1)).otherwise(_none())
        out.append((kind, strict, found, between))
    return out


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right counts double."""
    worth = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda total, x: total + x) % 10 == 0


def _spans(documents: DataFrame, key: str) -> DataFrame:
    """Proposed spans by ``key``, with votes and features; a document without any has one row of nulls."""
    # Each rule's results are kept as columns of one projection, so that each pattern runs once.
    names, columns = [], []
    for n, (kind, strict, found, between) in enumerate(_proposals(F.col("text"))):
        names.append((n, kind, strict))
        columns += [found.alias(f"found{n}"), between.alias(f"between{n}")]
    tried = documents.select(key, *columns)

    def listed(n: int, kind: str, strict: bool) -> Column:
        between = F.col(f"between{n}")
        return F.transform(
            f"found{n}",
            lambda found, i: F.struct(
                F.lit(n).alias("rule"),
                F.lit(kind).alias("kind"),
                F.lit(strict).alias("strict"),
                i.alias("i"),
                found.alias("found"),
                F.length(between[i]).alias("gap"),
                F.right(between[i], F.lit(_LEFT)).alias("left"),
                F.left(between[i + 1], F.lit(_RIGHT)).alias("right"),
            ),
        )

    listed = F.concat(*[listed(*name) for name in names])
    matches = tried.select(key, F.explode_outer(listed).alias("m")).select(key, "m.*")
    so_far = Window.partitionBy(key, "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("found")
    placed = matches.withColumn("end", F.sum(F.col("gap") + size).over(so_far).cast("int")).withColumn(
        "start", F.col("end") - size
    )
    kind, found = F.col("kind"), F.col("found")
    digits = F.regexp_replace(found, "[^0-9]", "")
    parts = F.split(F.regexp_replace(found, r"[\[\](){}]", ""), r"\.")
    # A part may have any number of zeros before it.
    in_range = F.forall(parts, lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n_digits = F.length(digits)
    valid = (
        F.when(kind == "email", found.rlike(r"[A-Za-z]{2,}$"))
        .when(kind == "ip", in_range)
        .when(kind == "card", n_digits.between(12, 19) & F.when(n_digits.between(12, 19), _luhn(digits)))
        .when(F.col("strict"), n_digits.between(9, 15))
        .otherwise(digits.rlike("^[2-9][0-9]{2}[2-9]"))
    )
    base = F.col("strict") & (valid | (kind == "email"))
    known = (
        F.when(kind == "email", F.when(found.rlike(rf"(?i)(?:{_DOMAINS})$"), 1).otherwise(0))
        .when(kind == "ip", F.when(found.rlike(r"^(?:0|127|22[4-9]|2[3-9][0-9])\D"), -1).otherwise(1))
        .when(kind == "card", F.when(digits.rlike(_ISSUER), 1).otherwise(-1))
        .otherwise(F.when(~F.col("strict"), 0).when(found.rlike(_COUNTRY), 1).otherwise(-1))
    )
    cue = F.lit(0)
    for name in KINDS:
        cue = F.when((kind == name) & F.col("left").rlike(_CUES[name]), 1).otherwise(cue)
    cue = F.when(F.col("left").rlike(_COUNTER_CUES), -1).otherwise(cue)
    before, after = F.right(F.col("left"), F.lit(1)), F.col("right")
    inside = before.rlike("[A-Za-z0-9_/=]") | after.rlike("[A-Za-z0-9_/=@]")

    def look(c: Column) -> Column:
        letter, digit, space = c.rlike(r"\p{L}"), c.rlike("[0-9]"), c.rlike(r"\s")
        named = F.when(c == "", "end").when(letter, "letter").when(digit, "digit").when(space, "space")
        return named.otherwise("sign")

    word = F.lower(F.regexp_extract(F.col("left"), r"(\p{L}+)[^\p{L}]*$", 1))
    judged = placed.select(
        key, "kind", "start", "end", F.coalesce(base, F.lit(False)).alias("base"),
        F.when(base, 1).otherwise(-1).alias("shape"),
        F.when(valid, 1).otherwise(-1).alias("check"),
        known.alias("gazetteer"), cue.alias("context"), F.when(inside, -1).otherwise(1).alias("edge"),
        F.least(F.floor(size / 4), F.lit(12)).cast("string").alias("size"),
        F.floor(4 * n_digits / size).cast("string").alias("digits"),
        look(before).alias("before"), look(after).alias("after"),
        F.pmod(F.xxhash64(word), F.lit(32)).cast("string").alias("word"),
        F.coalesce(valid, F.lit(False)).cast("string").alias("valid"),
    )
    # A loose span goes if it overlaps a base one.
    by_start = Window.partitionBy(key).orderBy("start", F.col("base").desc())
    base_start, base_end = F.when(F.col("base"), F.col("start")), F.when(F.col("base"), F.col("end"))
    earlier = F.max(base_end).over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    later = F.min(base_start).over(by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    clear = judged.withColumn("overlaps", (earlier > F.col("start")) | (later < F.col("end")))
    keep = F.col("kind").isNull() | F.col("base") | ~F.coalesce("overlaps", F.lit(False))
    emptied = F.when(keep, F.col("kind")).alias("kind")
    return clear.select(key, emptied, "start", "end", F.col("base") & keep, *LABELERS, *FEATURES).toDF(
        key, "kind", "start", "end", "base", *LABELERS, *FEATURES
    )


def estimate(counts: dict[tuple, int], rounds: int = ROUNDS) -> dict[tuple, float]:
    """The probability that a span with these votes is personal data, per (kind, votes...).

    Labelers are independent given the truth; each answers yes, no or nothing with
    its own chances. Starts from the majority of the votes and alternates between the
    chances and the probabilities. One span's worth of even votes is added to every
    chance, so a labeler that never speaks weighs nothing.
    """
    truth = {}
    for kind in KINDS:
        seen = {votes: n for (k, *votes), n in counts.items() if k == kind for votes in [tuple(votes)]}
        if not seen:
            continue
        yes = {v: 1 / (1 + math.exp(-sum(v))) for v in seen}
        for _ in range(rounds):
            share = [1.0, 1.0]
            chance = [[dict.fromkeys((-1, 0, 1), 1.0) for _ in LABELERS] for _ in range(2)]
            for votes, n in seen.items():
                for state, p in ((1, yes[votes]), (0, 1 - yes[votes])):
                    share[state] += n * p
                    for j, vote in enumerate(votes):
                        chance[state][j][vote] += n * p
            def log_chance(state: int, votes: tuple) -> float:
                return math.log(share[state]) + sum(
                    math.log(c[v] / sum(c.values())) for c, v in zip(chance[state], votes, strict=True)  # noqa: B023
                )
            yes = {v: 1 / (1 + math.exp(max(-500, min(500, log_chance(0, v) - log_chance(1, v))))) for v in seen}
        truth |= {(kind, *v): p for v, p in yes.items()}
    return truth


def _lookup(values: dict[tuple, float], columns: list[Column], missing: float) -> Column:
    """A bounded table as a map literal over its joined keys."""
    if not values:
        return F.lit(missing)
    entries = [x for key, value in sorted(values.items()) for x in (F.lit("|".join(map(str, key))), F.lit(value))]
    key = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(missing))


def _classifier(spans: DataFrame, truth: dict[tuple, float]) -> Column:
    """Log odds of a span by naive Bayes over its features, trained on the soft labels.

    Sums per feature value; a feature has at most 32 values, so the model is bounded.
    """
    label = _lookup(truth, [F.col(c) for c in ("kind", *LABELERS)], 0.5)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES]))
    seen = spans.filter("kind is not null").withColumn("p", label).select("kind", "p", pairs.alias("f"))
    sums = seen.groupBy("kind", "f.feature", "f.value").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    totals: dict = defaultdict(lambda: [1.0, 1.0])
    rows = sums.collect()
    for r in rows:
        totals[r["kind"], r["feature"]][0] += r["yes"]
        totals[r["kind"], r["feature"]][1] += r["no"]
    odds = F.lit(0.0)
    prior = {(k,): math.log(yes / no) for (k, f), (yes, no) in totals.items() if f == FEATURES[0]}
    odds = odds + _lookup(prior, [F.col("kind")], 0.0)
    for feature in FEATURES:
        weight = {}
        for r in rows:
            if r["feature"] == feature:
                yes, no = totals[r["kind"], feature]
                weight[r["kind"], r["value"]] = math.log((r["yes"] + 0.5) / yes) - math.log((r["no"] + 0.5) / no)
        odds = odds + _lookup(weight, [F.col("kind"), F.col(feature)], 0.0)
    return odds


def _found(documents: DataFrame, key: str, label: str) -> DataFrame:
    """By ``key`` the spans of each document: ``start, kind, end, base``, sorted; all that is kept."""
    spans = materialise(_spans(documents, key), label)
    patterns = spans.filter("kind is not null").groupBy("kind", *LABELERS).agg(F.count("*").alias("n")).collect()
    truth = estimate({tuple(r)[:-1]: r["n"] for r in patterns})
    kept = spans.withColumn("is_kept", F.col("kind").isNotNull() & (F.col("base") | (_classifier(spans, truth) > 0)))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    one = F.when(F.col("is_kept"), F.struct("start", rank.alias("rank"), "end", "kind", "base"))
    return kept.groupBy(key).agg(F.array_sort(F.collect_list(one)).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(documents: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``, one row per row of ``documents``.

    The counts and the digest are of the base spans; ``spans`` lists all that are
    kept, as ``kind:start:end`` by start, then kind. A null text is empty and has none.
    Ids may be null or repeat, and rows may be equal: each row is found on its own.
    An empty table gives an empty result; other columns are not looked at.

    Texts are scanned in place; only spans are shuffled, by document.
    """
    rows = only(documents, doc_id="doc_id", text=F.coalesce(documents["text"], F.lit("")))
    # A scan gives the same rows to a task that is run again, so the ids hold.
    rows = rows.withColumn("_row", F.struct(F.monotonically_increasing_id().alias("n"), "doc_id"))
    found = _found(rows, "_row", "pii-spans")
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        *map(number, KINDS),
        F.sha2(_written(base), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with each kept span of ``text`` replaced by its kind in brackets.

    Overlapping spans count as one, named after the first. All other columns, and
    null texts, stay as they are; ``n_chars``, if there is one, follows the text.
    """
    columns = documents.columns
    whole = documents.select(F.struct(*[documents[c] for c in columns]).alias("_all"))
    whole = materialise(whole.withColumn("_row", F.monotonically_increasing_id()), "pii-documents")
    texts = whole.select("_row", F.coalesce("_all.text", F.lit("")).alias("text"))
    found = materialise(_found(texts, "_row", "pii-spans").filter(F.size("spans") > 0), "pii-found")
    text = F.col("_all.text")
    # A span is shown where it reaches beyond all before it.
    empty = F.struct(F.lit(0).alias("at"), _none().alias("parts"))

    def add(done: Column, span: Column) -> Column:
        fresh = span["start"] >= done["at"]
        gap = F.substr(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        shown = F.when(fresh, F.array(F.concat(gap, F.lit("["), F.upper(span["kind"]), F.lit("]")))).otherwise(_none())
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["parts"], shown).alias("parts"))

    clean = F.aggregate(
        "spans", empty, add, lambda done: F.concat(F.array_join(done["parts"], ""), F.substr(text, done["at"] + 1))
    )
    joined = whole.join(found, "_row", "left").withColumn("_text", F.when(F.col("spans").isNull(), text).otherwise(clean))
    out = [
        F.col("_text").alias(c)
        if c == "text"
        else F.length("_text").cast(documents.schema[c].dataType).alias(c)
        if c == "n_chars"
        else F.col("_all")[c].alias(c)
        for c in columns
    ]
    return joined.select(*out)
