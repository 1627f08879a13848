"""Personal data in texts by weak supervision.

Patterns propose candidate spans. Labelers vote on each: the strict pattern, a
checksum or shape test, a gazetteer of known prefixes and domains, and the
words around the span. Expectation-maximisation over the counts of vote
patterns estimates, per kind, how reliable each labeler is. Its posteriors
train a naive Bayes span classifier on features the labelers do not see alone,
and that classifier decides on candidates which the strict patterns leave out.
Only built-in functions are used; all that leaves a task is counts per vote
pattern and per feature value, both bounded by their definitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stored
from tagloom.llm.spans import find_all, let

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context")

# Shapes of the strict kinds, and wider ones that propose more; fixed values.
LOCAL = "A-Za-z0-9._%+-"
STRICT = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": rf"(?<![{LOCAL}])[{LOCAL}]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+)-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.][0-9]{4}(?![0-9-])",
}
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

# Gazetteers: mail domains and endings, private networks, card and country prefixes.
MAIL_ENDS = r"(?i)\.(?:com|net|org|edu|gov|info|io|de|fr|es|uk|eu)$"
CARD_HEADS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
PHONE_HEADS = r"^(?:\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])|\(?[2-9])"
IP_ODD = r"^0*(?:0|22[4-9]|2[3-5][0-9])\."

# Words around a span that speak for or against each kind.
FOR = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|reach)\b",
    "ip": r"(?i)\b(?:ip|host|server|login|from|address|client)\b",
    "card": r"(?i)\b(?:card|credit|visa|mastercard|payment|pay|cc)\b",
    "phone": r"(?i)\b(?:phone|call|tel|mobile|fax|contact|dial)\b",
}
AGAINST = r"(?i)\b(?:version|build|isbn|issn|doi|serial|model|release|hash|order|page|chapter)\b"


@dataclass(frozen=True)
class PiiSettings:
    rounds: int = 20  # of expectation-maximisation
    trust: float = 0.8  # reliability of a labeler before any data
    prior_weight: float = 10.0  # of that belief, in spans
    context: int = 30  # characters looked at on each side
    accept: float = 0.5  # posterior from which the classifier adds a span


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.length(digits))

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """Whether a match of the strict pattern is kept."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    """1 for, -1 against, 0 for no opinion."""
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes_of(kind: str, value: Column, around: Column, strict: Column, wide: bool) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    tests = {
        "email": (F.rlike(value, F.lit(r"\.[A-Za-z]{2,24}$")), ~F.rlike(value, F.lit(r"\.[A-Za-z]{2,24}$")),
                  F.rlike(value, F.lit(MAIL_ENDS)), F.lit(False)),
        "ip": (is_valid("ip", value), ~is_valid("ip", value), F.lit(False), F.rlike(value, F.lit(IP_ODD))),
        "card": (is_valid("card", value), ~is_valid("card", value),
                 F.rlike(digits, F.lit(CARD_HEADS)) & n.between(14, 16), ~F.rlike(digits, F.lit(CARD_HEADS))),
        "phone": (n.between(9, 15), ~n.between(9, 15),
                  F.rlike(value, F.lit(PHONE_HEADS)), ~F.rlike(value, F.lit(PHONE_HEADS))),
    }
    check_yes, check_no, known, unknown = tests[kind]
    return F.array(
        F.when(strict, 1).otherwise(0 if wide else -1),
        vote(check_yes, check_no),
        vote(known, unknown),
        vote(F.rlike(around, F.lit(FOR[kind])), F.rlike(around, F.lit(AGAINST))),
    )


def features_of(value: Column, before: Column, after: Column) -> Column:
    """Values of the classifier's features; each has a bounded number of values."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]+", "0"), "[A-Za-z]+", "a"), "(.)\\1+", "$1")
    edge = lambda c: F.when(c == "", "none").when(F.rlike(c, F.lit(r"^\s$")), "space").when(
        F.rlike(c, F.lit("^[0-9]$")), "digit").when(F.rlike(c, F.lit(r"^\p{L}$")), "letter").otherwise("other")
    word = F.lower(F.regexp_extract(before, r"([\p{L}]+)[^\p{L}]*$", 1))
    return F.array(
        F.concat(F.lit("length:"), F.least(F.length(value), F.lit(40)).cast("string")),
        F.concat(F.lit("digits:"), F.least(F.length(F.regexp_replace(value, "[^0-9]", "")), F.lit(20)).cast("string")),
        F.concat(F.lit("shape:"), (F.crc32(shape.cast("binary")) % 64).cast("string")),
        F.concat(F.lit("before:"), edge(F.right(before, F.lit(1)))),
        F.concat(F.lit("after:"), edge(F.left(after, F.lit(1)))),
        F.concat(F.lit("word:"), (F.crc32(word.cast("binary")) % 256).cast("string")),
    )


def candidates_of(text: Column, settings: PiiSettings) -> Column:
    """All candidate spans of a text with votes and features."""
    size = settings.context

    def seen(kind: str, spans: Column, strict: bool) -> Column:
        def one(s: Column) -> Column:
            before = F.substring(text, F.greatest(s["start"] - size, F.lit(0)) + 1, F.least(s["start"], F.lit(size)))
            after = F.substring(text, s["end"] + 1, F.lit(size))
            base = is_valid(kind, s["value"]) if strict else F.lit(False)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("place"), s["start"].alias("start"), s["end"].alias("end"),
                F.lit(kind).alias("kind"), base.alias("base"),
                votes_of(kind, s["value"], F.concat(before, F.lit(" "), after), base, not strict).alias("votes"),
                features_of(s["value"], before, after).alias("features"),
            )

        return F.transform(spans, one)

    strict = [seen(k, find_all(text, p), True) for k, p in STRICT.items()]
    wide = [seen(k, find_all(text, p), False) for k, p in WIDE.items()]
    return F.array_sort(F.concat(*strict, *wide))


def log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def posterior(state: Column, votes: Column) -> Column:
    """Probability that a span is personal data, by prior and reliabilities."""
    terms = [
        F.when(votes[j] == 1, F.log(state["right"][j] / (1 - state["wrong"][j])))
        .when(votes[j] == -1, F.log((1 - state["right"][j]) / state["wrong"][j]))
        .otherwise(0.0)
        for j in range(len(LABELERS))
    ]
    return 1 / (1 + F.exp(-(log_odds(state["prior"]) + reduce(lambda a, b: a + b, terms))))


def reliabilities(spans: DataFrame, settings: PiiSettings) -> DataFrame:
    """Per kind ``state``: prior, and how often each labeler is right on true and on false spans.

    ``spans(kind, votes)`` is reduced to counts of vote patterns, at most
    3 ** 4 per kind; the rounds run on those.
    """
    patterns = (
        spans.groupBy("kind", "votes").agg(F.count("*").cast("double").alias("n"))
        .groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
    )
    w, t = settings.prior_weight, settings.trust
    each = F.array([F.lit(t)] * len(LABELERS))
    first = F.struct(F.lit(0.5).alias("prior"), each.alias("right"), each.alias("wrong"))

    def total(marked: Column, value) -> Column:
        return F.aggregate(marked, F.lit(0.0), lambda acc, m: acc + value(m))

    def one_round(state: Column, _: Column) -> Column:
        marked = F.transform(
            F.col("patterns"), lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), posterior(state, p["votes"]).alias("p"))
        )
        return F.element_at(F.transform(F.array(marked), learned), 1)

    def learned(marked: Column) -> Column:
        def share(j: int, side: int) -> Column:
            sure = (lambda m: m["p"]) if side == 1 else (lambda m: 1 - m["p"])
            hit = total(marked, lambda m: F.when(m["votes"][j] == side, m["n"] * sure(m)).otherwise(0.0))
            out_of = total(marked, lambda m: F.when(m["votes"][j] != 0, m["n"] * sure(m)).otherwise(0.0))
            return F.least(F.lit(0.99), F.greatest(F.lit(0.5), (hit + w * t) / (out_of + w)))

        prior = (total(marked, lambda m: m["n"] * m["p"]) + 1) / (total(marked, lambda m: m["n"]) + 2)
        return F.struct(
            prior.alias("prior"),
            F.array(*[share(j, 1) for j in range(len(LABELERS))]).alias("right"),
            F.array(*[share(j, -1) for j in range(len(LABELERS))]).alias("wrong"),
        )

    return patterns.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(settings.rounds)), first, one_round).alias("state"))


def classifier(spans: DataFrame, states: DataFrame) -> DataFrame:
    """Per kind ``prior`` and ``weights``: log-likelihood ratio of each feature value.

    Trained on the posteriors of all ``spans(kind, votes, features)``.
    """
    # One state per kind: a bounded table.
    soft = spans.groupBy("kind", "votes", "features").count().join(F.broadcast(states), "kind")
    soft = soft.select("kind", "features", "count", posterior(F.col("state"), F.col("votes")).alias("p"))
    yes, no = F.sum(F.col("count") * F.col("p")), F.sum(F.col("count") * (1 - F.col("p")))
    totals = soft.groupBy("kind").agg((yes + 1).alias("yes"), (no + 1).alias("no"))
    by_value = soft.select("kind", "count", "p", F.explode("features").alias("feature")).groupBy("kind", "feature")
    by_value = by_value.agg(yes.alias("f_yes"), no.alias("f_no"))
    weight = F.log((F.col("f_yes") + 0.5) / (F.col("yes") + 1)) - F.log((F.col("f_no") + 0.5) / (F.col("no") + 1))
    return (
        by_value.join(F.broadcast(totals), "kind")
        .groupBy("kind")
        .agg(
            F.first(F.log(F.col("yes") / F.col("no"))).alias("prior"),
            F.map_from_entries(F.collect_list(F.struct("feature", weight.alias("weight")))).alias("weights"),
        )
    )


def find_pii(
    df: DataFrame, settings: PiiSettings = PiiSettings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Spans of personal data in every whole text.

    Returns one row per input row: the id and ``spans``, an array of
    ``(place, start, end, kind, base, score)`` by the order of ``KINDS`` and
    start. ``base`` spans match a strict pattern and its check and are always
    there; others were added by the classifier and overlap none of them. Null and empty texts have an
    empty array, as has every text when there is no candidate at all.
    Repeated rows and null ids stay; other columns are not carried. The
    candidates, without the texts, are written to the shared folder once.
    """
    rows = id_and_text(df, id_col, text_col)
    found = stored(rows.select(id_col, candidates_of(F.col("text"), settings).alias("found")), "pii")
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.votes", "s.features")
    states = reliabilities(spans, settings)
    model = states.join(F.broadcast(classifier(spans, states)), "kind").agg(
        F.map_from_entries(F.collect_list(F.struct("kind", F.struct("prior", "weights", "state")))).alias("models")
    )  # one row: a model per kind

    def scored(s: Column) -> Column:
        model = F.element_at(F.col("models"), s["kind"])
        known = F.aggregate(
            s["features"], model["prior"], lambda acc, f: acc + F.coalesce(F.element_at(model["weights"], f), F.lit(0.0))
        )
        # The labelers' verdict and the classifier's, each worth half.
        seen = posterior(model["state"], s["votes"])
        bounded = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), known))
        score = (seen + 1 / (1 + F.exp(-bounded))) / 2
        return F.struct(s["place"], s["start"], s["end"], s["kind"], s["base"], score.alias("score"))

    joined = found.withColumn("models", model.scalar())

    def kept(spans: Column) -> Column:
        base = F.filter(spans, lambda s: s["base"])
        free = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.filter(spans, lambda s: F.when(s["base"], True).when(s["score"] < settings.accept, False).otherwise(free(s)))

    none = F.array().cast("array<struct<place:int,start:int,end:int,kind:string,base:boolean,score:double>>")
    spans = F.array_distinct(let(F.transform("found", scored), kept))
    some = (F.size("found") > 0) & F.col("models").isNotNull()
    return joined.select(id_col, F.when(some, spans).otherwise(none).alias("spans"))
