"""Operator 1: personal data by weak supervision.

Spans of four kinds (email, ip, card, phone). The *base* spans are what fixed patterns find, less
those that fail a test of their kind; they are always returned. A second, wider pattern per kind
finds *candidates*: the base forms and looser ones (spelled-out marks in addresses, numbers with
other separators, without country code, with digits outside the base lengths). Labelers vote on
every candidate for, against or not at all:

* regex: whether it has the strict form and passes the tests of its kind;
* gazetteer: known endings of host names, network ranges, issuer prefixes, dialling codes;
* context: telling words within ``CONTEXT`` characters before it, of that kind or against it;
* border: whether it stands free of letters, digits and joining marks.

How reliable each labeler is follows from expectation-maximisation over the counts of vote
patterns per kind, starting from the majority. The posteriors then train the final classifier, a
logistic regression on votes and shape, by the same counts: there are at most a few thousand
different patterns, so both run on one small table, however large the corpus. A candidate that is
no base span is added if the classifier gives it ``ACCEPT`` or more and at least ``NEEDED`` labelers
speak for it and none against; it must not overlap a base span or an earlier addition.

Offsets come from running sums over the pieces between matches, so they cost one pass. Texts
without a digit or ``@`` (and without a spelled-out one) have no spans and are not searched.
Patterns use possessive repeats and never rescan a run of characters, so long texts neither
overflow the matcher's stack nor take quadratic time.

Defined results: NULL texts are empty: no spans; rows that repeat a ``doc_id`` each have their own
row; touching spans of different kinds are all kept; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scalargrid.llm.common import documents, stage

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 40
ACCEPT = 0.9
NEEDED = {"email": 2, "ip": 2, "card": 3, "phone": 2}
_BACK = 8  # a match has 5 characters or more, so so many before one reach back over CONTEXT
LABELERS = ("regex", "gazetteer", "context", "border")

# Equal to the plain patterns: repeats are possessive where what follows cannot give back, and a
# match starts behind the previous one or at the start of a run, never within a run that failed.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:\x20?(?:@|\(at\)|\[at\])\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9.]))[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?:\G|(?<![0-9]))(?:[0-9]{3,6}+(?:[\x20./-]?[0-9]{3,7}+){2,4}|[0-9]{13,15}+)(?![0-9])",
    "phone": r"(?:\G|(?<![0-9+]))(?:\+|00)?\(?[0-9]{1,5}+(?:[\x20./()-]{1,3}+[0-9]{2,5}+){2,5}(?![0-9])",
}
# What labelers know.
ENDINGS = "com org net edu gov io info biz de fr es uk eu it nl at ch be pt us ca au jp cn in br mx"
DIALLING = "1 7 20 27 30 31 32 33 34 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 420"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
RESERVED = r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|169\.254)\."
TELLING = {
    "email": r"e-?mail|contact|write|mailto|correo|courriel|kontakt",
    "ip": r"\bip\b|host|server|addr|network|subnet|\bping\b",
    "card": r"card|visa|credit|mastercard|amex|payment|tarjeta|karte|carte",
    "phone": r"phone|\btel\b|call|mobile|\bfax\b|telefon|téléphone|teléfono",
}
AGAINST = r"version|isbn|order|serial|invoice|\bref\b|commit|revision|page|figure|\bno\b"
_BORDER = r"[A-Za-z0-9_@/#=-]"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of digits from the right, every second doubled and its own digits added, divisible by ten."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def passes(kind: Column, text: Column) -> Column:
    """Whether a match of a base pattern passes the test of its kind."""
    digits = _digits(text)
    n = F.length(digits)
    octets = r"^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
    octet = F.forall(F.split(text, r"\."), lambda p: F.regexp_like(F.regexp_replace(p, "^0++(?=[0-9])", ""), F.lit(octets.replace("0*+", ""))))
    return (
        F.when(kind == "email", True).when(kind == "ip", octet)
        .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )


def _pieces(kind: str, pattern: str, base: bool) -> Column:
    """Matches in order, each with the length of what lies before it and what stands around it."""
    text = F.col("text")
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def before(gap: Column, i: Column) -> Column:
        """The text before a match, through earlier matches."""
        first = F.greatest(i - _BACK, F.lit(0)) + 1
        earlier = F.zip_with(F.slice(gaps, first, F.least(i, F.lit(_BACK))), F.slice(matches, first, F.least(i, F.lit(_BACK))),
                             lambda g, m: F.concat(F.right(g, F.lit(CONTEXT)), F.right(m, F.lit(CONTEXT))))
        return F.right(F.concat(F.array_join(earlier, ""), F.right(gap, F.lit(CONTEXT))), F.lit(CONTEXT))

    # The piece after the last match has no match of its own and is dropped later.
    zipped = F.arrays_zip(
        matches.alias("match"),
        F.transform(gaps, lambda g, i: F.struct(
            F.length(g).alias("n"), F.right(g, F.lit(1)).alias("left"), (F.lit("") if base else before(g, i)).alias("before"))).alias("gap"),
        F.slice(F.transform(gaps, lambda g: F.left(g, F.lit(1))), 2, 2_000_000_000).alias("right"),
    )
    part = F.transform(zipped, lambda z, i: F.struct(
        F.lit(kind).alias("kind"), F.lit(base).alias("base"), i.alias("place"), z["match"].alias("match"),
        z["gap"]["n"].alias("gap"), z["gap"]["left"].alias("left"), z["gap"]["before"].alias("before"), z["right"].alias("right")))
    return F.filter(part, lambda z: z["match"].isNotNull())


def found(docs: DataFrame) -> DataFrame:
    """Staged ``rid, doc_id, pieces``: all matches of all patterns; NULL for texts that are not searched."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    hits = F.concat(*(_pieces(k, p, base) for base, patterns in ((True, BASE), (False, WIDE)) for k, p in patterns.items()))
    worth = F.regexp_like(F.col("text"), F.lit(r"@|[0-9]|\(at\)|\[at\]"))
    return stage(rows.select("rid", "doc_id", F.when(worth, hits).alias("pieces")), "matches")


def spans_of(matches: DataFrame) -> DataFrame:
    """One row per match with ``start`` and ``end`` in code points."""
    each = matches.where("size(pieces) > 0").select("rid", F.inline("pieces"))
    order = Window.partitionBy("rid", "kind", "base").orderBy("place")
    n = F.length("match")
    return each.withColumn("end", F.sum(F.col("gap") + n).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "start", F.col("end") - n
    )


def _vote(favour: Column, against: Column) -> Column:
    return F.when(favour, 1).when(against, -1).otherwise(0)


def voted(spans: DataFrame) -> DataFrame:
    """Candidates with a vote per labeler and a shape."""
    kind, text = F.col("kind"), F.col("match")
    plain = F.regexp_replace(F.regexp_replace(text, r"\x20?[\[(]at[\])]\x20?", "@"), r"\x20?[\[(](?:dot|\.)[\])]\x20?", ".")
    digits, left = _digits(text), F.lower("before")
    strict = F.lit(False)
    for k, pattern in BASE.items():
        strict = F.when(kind == k, F.regexp_like(text, F.lit(f"^(?:{pattern})$"))).otherwise(strict)
    n = F.length(digits)
    possible = (
        F.when(kind == "email", True).when(kind == "ip", passes(kind, plain))
        .when(kind == "card", n.between(13, 19) & F.when(n.between(13, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )
    ends = F.element_at(F.split(F.lower(plain), r"\."), -1).isin(ENDINGS.split())
    code = F.regexp_like(text, F.lit(rf"^(?:\+|00)(?:{'|'.join(DIALLING.split())})"))
    known = (
        F.when(kind == "email", ends).when(kind == "ip", F.regexp_like(plain, F.lit(RESERVED)))
        .when(kind == "card", F.regexp_like(digits, F.lit(ISSUERS))).otherwise(code)
    )
    unknown = F.when(kind == "card", ~F.regexp_like(digits, F.lit(ISSUERS))).otherwise(False)
    telling = F.lit(False)
    for k, pattern in TELLING.items():
        telling = F.when(kind == k, F.regexp_like(left, F.lit(pattern))).otherwise(telling)
    # Border marks inside the match's own last character class do not count for addresses.
    joined = F.regexp_like(F.right("left", F.lit(1)), F.lit(_BORDER)) | F.regexp_like(F.coalesce("right", F.lit("")), F.lit(_BORDER))
    marks = F.least(F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")), F.lit(4))
    return spans.select(
        "rid", "kind", "base", "start", "end",
        _vote(strict & possible, ~possible).alias("regex"), _vote(known, unknown).alias("gazetteer"),
        _vote(telling, F.regexp_like(left, F.lit(AGAINST)) & ~telling).alias("context"),
        _vote(~joined, joined).alias("border"),
        F.concat_ws("/", marks, F.least(F.floor(n / 4), F.lit(5)), F.when(F.regexp_like(text, F.lit(r"^\+")), "+").otherwise("-")).alias("shape"),
    )


Pattern = tuple[str, tuple[int, ...], str]


def reliabilities(counts: dict[Pattern, int], rounds: int = 50) -> dict[Pattern, float]:
    """Posterior of each pattern by expectation-maximisation, every kind by itself.

    A labeler's chances of each vote, given a true or a false span, are estimated from posteriors,
    and posteriors from these chances; a vote of 0 counts as a vote of its own.
    """
    posterior: dict[Pattern, float] = {}
    for kind in KINDS:
        own = {p: c for p, c in counts.items() if p[0] == kind}
        belief = {p: min(0.95, max(0.05, 0.5 + 0.2 * sum(p[1]))) for p in own}
        for _ in range(rounds):
            total = sum(own.values())
            true = sum(c * belief[p] for p, c in own.items())
            if not total:
                break
            chance: dict[tuple[int, int, bool], float] = defaultdict(float)
            for (_, votes, _), c in ((p, c) for p, c in own.items()):
                for at, vote in enumerate(votes):
                    chance[at, vote, True] += c * belief[kind, votes, _]
                    chance[at, vote, False] += c * (1 - belief[kind, votes, _])
            prior = (true + 1) / (total + 2)
            for p in own:
                odds = math.log(prior / (1 - prior))
                for at, vote in enumerate(p[1]):
                    # One imagined candidate that votes rightly keeps the two sides from changing places.
                    yes = (chance[at, vote, True] + (vote > 0) + 0.5) / (true + 2.5)
                    no = (chance[at, vote, False] + (vote < 0) + 0.5) / (total - true + 2.5)
                    odds += math.log(yes / no)
                belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        posterior |= belief
    return posterior


def _signals(p: Pattern) -> list[str]:
    return [f"{p[0]}", *(f"{p[0]}:{at}={v}" for at, v in enumerate(p[1])), f"{p[0]}~{p[2]}"]


def classifier(counts: dict[Pattern, int], posterior: dict[Pattern, float], rounds: int = 200) -> dict[Pattern, float]:
    """Probability of each pattern by logistic regression on votes and shape, trained on the posteriors."""
    weight: dict[str, float] = defaultdict(float)
    total = sum(counts.values()) or 1
    seen: dict[str, float] = defaultdict(float)
    for p, c in counts.items():
        for s in _signals(p):
            seen[s] += c
    result = {}
    for _ in range(rounds):
        slope: dict[str, float] = defaultdict(float)
        for p, c in counts.items():
            result[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weight[s] for s in _signals(p))))))
            for s in _signals(p):
                slope[s] += c * (posterior[p] - result[p])
        for s, g in slope.items():
            weight[s] += 1.5 * (g - 0.01 * weight[s]) / (seen[s] + 0.001 * total)
    return result


def accepted(candidates: DataFrame) -> list[Pattern]:
    """Patterns whose spans are added. The table of counts has a row per vote pattern and shape."""
    rows = candidates.groupBy("kind", *LABELERS, "shape").count().collect()
    counts = {(r["kind"], tuple(r[n] for n in LABELERS), r["shape"]): r["count"] for r in rows}
    chances = classifier(counts, reliabilities(counts))
    return sorted(
        p for p, chance in chances.items()
        if chance >= ACCEPT and sum(v > 0 for v in p[1]) >= NEEDED[p[0]] and min(p[1]) >= 0
    )


def personal_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staged matches, and ``rid, kind, base, start, end`` of all spans that hold."""
    matches = found(docs)
    spans = spans_of(matches)
    strict = spans.where("base").where(passes(F.col("kind"), F.col("match"))).select("rid", "kind", "base", "start", "end")
    candidates = stage(voted(spans.where("NOT base")), "candidates")
    wanted = accepted(candidates)
    spark = docs.sparkSession
    names = ["kind", *LABELERS, "shape"]
    table = spark.createDataFrame([(k, *votes, shape) for k, votes, shape in wanted], ", ".join(f"{n} {'string' if n in ('kind', 'shape') else 'int'}" for n in names))
    added = candidates.join(F.broadcast(table), names, "left_semi").select("rid", "kind", "base", "start", "end")
    both = strict.unionByName(added)
    # An addition goes where no base span and no earlier addition reaches.
    # Both windows run from one end: a frame that reaches the far end would be summed anew for every row.
    order = Window.partitionBy("rid").orderBy("start", F.col("end").desc(), F.col("base").desc(), "kind")
    back = Window.partitionBy("rid").orderBy(F.col("start").desc(), "end", "base", F.col("kind").desc())
    earlier = (Window.unboundedPreceding, -1)
    placed = both.withColumn("_reach", F.max("end").over(order.rowsBetween(*earlier))).withColumn(
        "_next", F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(*earlier))
    )
    free = (F.coalesce(F.col("_reach"), F.lit(0)) <= F.col("start")) & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))
    return matches, placed.where(F.col("base") | free).select("rid", "kind", "base", "start", "end")


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["order"]), s["start"], s["end"])), ",")


def op1_weak_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    matches, spans = personal_spans(documents(spark, sf_dir))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    one = F.struct(number.alias("order"), "start", "end")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    summed = spans.groupBy("rid").agg(
        *counts, F.collect_list(F.when(F.col("base"), one)).alias("_base"), F.collect_list(one).alias("_all")
    )
    shown = matches.select("rid", "doc_id").join(summed, "rid", "left")
    none = F.array().cast("array<struct<order:int,start:bigint,end:bigint>>")
    base, every = (_shown(F.coalesce(F.col(c), none)) for c in ("_base", "_all"))
    return shown.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"),
    )
