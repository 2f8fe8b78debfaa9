"""Personal data by weak supervision (operator 5). DataFrame functions only.

Candidates are the matches of strict patterns (base spans, which always count) and of looser ones:
national phone formats, spelled-out e-mail addresses, card-like numbers that fail the checksum. On each
candidate four labelers vote yes, no or nothing: the strict pattern, a gazetteer (top-level domains,
country codes, issuer prefixes, reserved networks), context words before it, and its shape. How far each
labeler can be trusted is estimated per kind by expectation-maximisation over the counts of vote
patterns (at most 81 a kind, whatever the input). The resulting probabilities are the soft
labels of the final span classifier, naive Bayes over votes and bucketed span features, which adds
looser candidates that reach ``ACCEPT`` and overlap no base span.

The corpus is read once for the statistics and once for the spans; only counts of a bounded number
of patterns and features leave it. All patterns run in linear time on any text; holding loose candidates against base spans and
masking take the square of their number in one text (88 KB of contacts: about 20 s).

Cases: null text counts as empty: no spans. Very long texts are searched whole. Repeated rows and
null ids give a row each. An empty table or one without candidates leaves the base spans. Extra
columns are passed through by ``mask``, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import prepare
from regfold.llm.spans import cover, listed, with_spans

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
EM_ROUNDS = 50
LABELERS = ("strict", "gazetteer", "context", "shape")

# Strict patterns, stated so that no start is tried twice: a match can only begin where a run of its
# first characters begins, or (e-mail) where the last match ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser ones
_SPELLED = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]++)++"
_NATIONAL = r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"

# Gazetteers and context words: fixed values
_DOMAINS = r"(?i)(com|org|net|edu|gov|info|io|de|fr|es|uk|it|eu|at|ch)$"
_COUNTRIES = r"^\+ ?(1|7|20|27|3[0-46-9]|4[0-46-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6)"
_RESERVED = r"^(0|10|127|255|192\.168|169\.254|172\.(1[6-9]|2[0-9]|3[01]))\."
_CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write|correo|courriel)\W{0,4}(to|at|us|me|address)?\W{0,4}$",
    "ip": r"(?i)\b(ip|host|server|address|adresse|from)\W{0,6}$",
    "card": r"(?i)(card|visa|mastercard|amex|credit|karte|carte|tarjeta)\W{0,4}(no|number|nr)?\W{0,4}$",
    "phone": r"(?i)(phone|tel|call|mobile|cell|fax|telefon|fono|dial)\W{0,4}(no|number|nr)?\W{0,4}$",
}
_COUNTER = {
    "email": r"(?i)(example|sample)\W{0,3}$",
    "ip": r"(?i)\b(v|ver|version|release|section|chapter)\W{0,3}$",
    "card": r"(?i)(order|invoice|isbn|sku|serial|part|id|nr|no|ref)\W{0,4}$",
    "phone": r"(?i)(order|invoice|isbn|sku|serial|part|version|id|ref)\W{0,4}$",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    turned = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _strict(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & luhn(F.substring(digits, 1, 20))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "y").when(no, "n").otherwise("-")


def _gazetteer(kind: str, value: Column) -> Column:
    if kind == "email":
        return _vote(value.rlike(_DOMAINS), F.lit(False))
    if kind == "ip":
        return _vote(F.lit(False), value.rlike(_RESERVED))
    if kind == "card":
        return _vote(_digits(value).rlike(_ISSUERS), F.lit(True))
    return _vote(value.rlike(_COUNTRIES), value.startswith("+"))


def _shape(kind: str, value: Column) -> Column:
    if kind == "email":
        return _vote(value.rlike("^[A-Za-z][^@]{0,63}(@| ?[\\[(])"), value.rlike("^[^A-Za-z]*(@| ?[\\[(])"))
    if kind == "ip":
        return _vote(~value.rlike(r"(^|\.)0[0-9]"), F.lit(True))
    if kind == "card":
        return _vote(value.rlike(r"^([0-9]{4}[ -]?){3}[0-9]{1,7}$"), value.rlike(r"[ -]"))
    return _vote(F.length(_digits(value)).between(10, 13), F.length(_digits(value)) > 13)


def _traits(kind: str, strict: Column, s: Column) -> Column:
    """What labelers say, and features of the span, as ``name=value`` strings."""
    value = s["value"]
    votes = [_vote(strict, F.lit(kind != "email")), _gazetteer(kind, value),
             _vote(s["before"].rlike(_CUES[kind]), s["before"].rlike(_COUNTER[kind])), _shape(kind, value)]
    named = [F.concat(F.lit(f"{n}="), v) for n, v in zip(LABELERS, votes, strict=True)]
    features = [
        F.concat(F.lit("length="), F.least(F.floor(F.length(value) / 4), F.lit(10)).cast("string")),
        F.concat(F.lit("gaps="), F.least(F.length(value) - F.length(F.translate(value, " -().", "")), F.lit(6)).cast("string")),
        F.concat(F.lit("left="), _char_class(F.right(s["before"], F.lit(1)))),
        F.concat(F.lit("right="), _char_class(F.left(s["after"], F.lit(1)))),
    ]
    return F.array(*named, *features)


def _char_class(char: Column) -> Column:
    return (F.when(char == "", "none").when(char.rlike(r"[0-9]"), "digit").when(char.rlike(r"[\x20\x09-\x0D]"), "space")
            .when(char.rlike(r"[\p{L}]"), "letter").otherwise("mark"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_cand``: all candidates, strict (base spans) or not, with their traits."""
    text = "_text"
    df = docs.withColumn(text, F.coalesce("text", F.lit("")))
    has = lambda c: F.contains(F.col(text), F.lit(c))
    digits = F.col(text).rlike("[0-9]")
    df = df.withColumn("_digits", digits)
    df = with_spans(df, "_email", text, _EMAIL, has("@"))
    df = with_spans(df, "_ip", text, _IP, F.col("_digits") & has("."))
    df = with_spans(df, "_card", text, _CARD, F.col("_digits"))
    df = with_spans(df, "_phone", text, _PHONE, F.col("_digits") & has("+"))
    df = with_spans(df, "_spelled", text, _SPELLED, F.col(text).rlike(r"(?i)[\[(]at[\])]"))
    df = with_spans(df, "_national", text, _NATIONAL, F.col("_digits"))
    df = df.withColumn("_card", F.filter("_card", lambda s: F.length(_digits(s["value"])).between(12, 19)))
    parts = []
    for rank, kind in enumerate(KINDS):
        sources = [(f"_{kind}", None)] + {"email": [("_spelled", False)], "phone": [("_national", False)]}.get(kind, [])
        for column, strict in sources:
            fixed = f"{column}_c"
            df = df.withColumn(fixed, F.transform(column, _judge(kind, rank, strict)))
            parts.append(F.col(fixed))
    df = df.withColumn("_cand", F.concat(*parts))
    return df.select(*docs.columns, "_cand")


def _judge(kind: str, rank: int, strict: bool | None):
    """Span -> candidate; ``strict`` is known, or None if the strict pattern's conditions decide."""
    def judged(s: Column) -> Column:
        sure = F.coalesce(_strict(kind, s["value"]) if strict is None else F.lit(strict), F.lit(False))
        return F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"),
                        F.lit(kind).alias("kind"), sure.alias("strict"), _traits(kind, sure, s).alias("traits"))

    return judged


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def expectation_maximisation(patterns: list[tuple[tuple[str, ...], int]], rounds: int = EM_ROUNDS) -> dict:
    """Probability that a candidate is personal data, by vote pattern.

    Labelers are independent given the truth; each has its own chance of y, n and - for either
    truth. They start out as better than chance, which fixes which class is which.
    """
    n_labelers = len(LABELERS)
    chance = [{True: {"y": 0.6, "n": 0.1, "-": 0.3}, False: {"y": 0.1, "n": 0.6, "-": 0.3}} for _ in range(n_labelers)]
    prior, out = 0.5, {}
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        out = {}
        for votes, _n in patterns:
            odds = math.log(prior / (1 - prior))
            for c, v in zip(chance, votes, strict=True):
                odds += math.log(c[True][v] / c[False][v])
            out[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        good = sum(out[v] * n for v, n in patterns)
        prior = min(0.99, max(0.01, (good + 1) / (total + 2)))
        for k, c in enumerate(chance):
            for truth in (True, False):
                # the starting point counts as 10 candidates, so rare kinds don't drift
                weight = {"y": 6.0, "n": 1.0, "-": 3.0} if truth else {"y": 1.0, "n": 6.0, "-": 3.0}
                for votes, n in patterns:
                    weight[votes[k]] += n * (out[votes] if truth else 1 - out[votes])
                whole = sum(weight.values())
                c[truth] = {v: w / whole for v, w in weight.items()}
    return out


def train(cands: DataFrame) -> dict[str, tuple[float, dict[str, float]]]:
    """Per kind the prior log-odds and the log-odds of every trait, from counts alone."""
    votes = F.slice(F.col("c.traits"), 1, len(LABELERS))
    # explode() would push a filter on the array below the columns it is made of, and compute those twice and more
    rows = (cands.select(F.explode_outer("_cand").alias("c")).filter("c is not null")
            .select(F.col("c.kind").alias("kind"), "c.traits", votes.alias("votes")))
    by_trait = (rows.select("kind", "votes", F.explode("traits").alias("trait")).groupBy("kind", "trait", "votes")
                .agg(F.count(F.lit(1)).alias("n")).collect())  # bucketed features: bounded as well
    # a candidate has its first vote among its traits, once: at most 81 patterns a kind
    counted = [r for r in by_trait if r["trait"] == r["votes"][0]]
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        patterns = [(tuple(v[-1] for v in r["votes"]), r["n"]) for r in counted if r["kind"] == kind]
        if patterns:
            posterior |= {(kind, v): p for v, p in expectation_maximisation(patterns).items()}
    yes: dict[str, dict[str, float]] = {k: {} for k in KINDS}
    no: dict[str, dict[str, float]] = {k: {} for k in KINDS}
    for r in by_trait:
        p = posterior[(r["kind"], tuple(v[-1] for v in r["votes"]))]
        for side, w in ((yes, p), (no, 1 - p)):
            own = side[r["kind"]]
            own[r["trait"]] = own.get(r["trait"], 0.0) + w * r["n"]
    model = {}
    for kind in KINDS:
        patterns = [(tuple(v[-1] for v in r["votes"]), r["n"]) for r in counted if r["kind"] == kind]
        n_yes = sum(posterior[(kind, v)] * n for v, n in patterns)
        n_no = sum(n for _, n in patterns) - n_yes
        weights = {t: math.log((yes[kind][t] + 1) / (n_yes + 10)) - math.log((no[kind][t] + 1) / (n_no + 10))
                   for t in yes[kind]}
        model[kind] = (math.log((n_yes + 1) / (n_no + 1)), weights)
    return model


def _looked_up(weights: Column):
    return lambda t: F.coalesce(F.element_at(weights, t), F.lit(0.0))


def _chance(model: dict, c: Column) -> Column:
    """The classifier's probability for a candidate."""
    odds = F.lit(0.0)
    for kind, (prior, weights) in model.items():
        if weights:
            table = F.create_map(*[F.lit(x) for t, w in sorted(weights.items()) for x in (t, float(w))])
            each = F.transform(c["traits"], _looked_up(table))
            total = F.aggregate(each, F.lit(float(prior)), lambda a, w: a + w)
            odds = F.when(c["kind"] == kind, total).otherwise(odds)
    return 1 / (1 + F.exp(-odds))


def find(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: sorted marks (start, rank, end, kind) of base and of all spans."""
    prepare(docs.sparkSession)
    found = candidates(docs)
    if model is None:
        model = train(candidates(docs.select("text")))
    mark = lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"),
                              c["kind"].alias("kind"))
    found = found.withColumn("_base", F.array_sort(F.transform(F.filter("_cand", lambda c: c["strict"]), mark)))
    loose = F.filter("_cand", lambda c: ~c["strict"] & (_chance(model, c) >= ACCEPT) & ~F.exists(
        F.col("_base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    found = found.withColumn("_spans", F.array_sort(F.concat("_base", F.transform(loose, mark))))
    return found.drop("_cand")


def report(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """doc_id, a count of base spans of each kind, base_sha256 and spans of every row."""
    found = find(docs.select("doc_id", "text"), model)
    counts = [F.size(F.filter("_base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"),
                        listed(F.col("_spans")).alias("spans"))


def mask(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and n_chars (if there) counted anew."""
    names = docs.columns
    # the caller's columns under names that the operator does not use
    own = docs.select(*[F.col(f"`{c}`").alias(c if c == "text" else f"own {k}") for k, c in enumerate(names)])
    found = find(own, model)
    text = F.when(F.col("text").isNull(), F.col("text")).otherwise(cover(F.col("text"), F.col("_spans")))
    found = found.withColumn("masked", text)
    out = {c: F.col("masked" if c == "text" else f"`own {k}`") for k, c in enumerate(names)}
    if "n_chars" in names:
        out["n_chars"] = F.when(F.size("_spans") > 0, F.length("masked").cast(dict(docs.dtypes)["n_chars"])).otherwise(out["n_chars"])
    return found.select(*[out[c].alias(c) for c in names])
