"""URL filter: host rules first, gradient-boosted trees for the rest (operator 9). DataFrame functions only.

A rule names a host (with all its subdomains) and the start of a path; the longest rule that fits
decides. URLs that no rule fits are judged by boosted trees over lexical features: lengths, depth,
digit share, character entropy, parameter counts and statistics of the host's suffix. The trees learn
from labelled URLs: those that a rule decides, or a table of labels (url, blocked). They are fitted on
at most ``TRAIN_ROWS`` distinct labelled URLs (the first by hash); suffix statistics cover all of them.

Cases: a null URL, or one without ``://``, has empty host and path and fits no rule. If labelled URLs
lack one of the two verdicts, there is nothing to learn: every URL without a rule gets the only
verdict known, or ``allow`` if there is none. Repeated rows and null ids give a row each; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import prepare

# (verdict, host and start of path): fixed values
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 7
FOLDS = 5  # of labelled URLs; fold 0 is trained without its suffix
NEUTRAL = 5.0  # weight of an even rate in a suffix's statistics
FEATURES = ("url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_share", "host_digits",
            "entropy", "n_params", "query_length", "hyphens", "longest_part", "suffix_log_count", "suffix_block_rate")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest that fits, or null."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: len(r[1])):
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def _lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    def count(text: Column, chars: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")

    size = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    shares = F.transform(F.array_distinct(F.split(url, "")),
                         lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / size)
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return {
        "url_length": F.length(url).cast("double"), "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"), "host_depth": count(host, "."), "path_depth": count(path, "/"),
        "digit_share": count(url, "0123456789") / size, "host_digits": count(host, "0123456789"), "entropy": entropy,
        "n_params": F.when(F.length(query) > 0, count(query, "&") + 1).otherwise(0.0),
        "query_length": F.length(query).cast("double"), "hyphens": count(url, "-"),
        "longest_part": F.array_max(F.transform(F.split(host, r"\."), lambda p: F.length(p))).cast("double"),
    }


def _suffix() -> Column:
    return F.substring_index("host", ".", -1).alias("suffix")


def _ruled(pages: DataFrame, rules, *names: str) -> DataFrame:
    """names, url, host, path, rule, ruled (the rule's verdict) and suffix of every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(*names, F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("ruled"), _suffix())


def _known(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """url, host, path, suffix and blocked (1.0 or 0.0) of every distinct labelled URL; blocked wins a dispute."""
    if labels is None:
        known = rows.filter("ruled is not null").select("url", "host", "path", "suffix",
                                                        (F.col("ruled") == "block").cast("double").alias("blocked"))
    else:
        host, path = host_and_path(F.col("url"))
        known = (labels.filter("url is not null and blocked is not null")
                 .select("url", F.col("blocked").cast("double").alias("blocked"))
                 .select("url", host.alias("host"), path.alias("path"), "blocked").select("*", _suffix()))
    return known.groupBy("url", "host", "path", "suffix").agg(F.max("blocked").alias("blocked"))


def _featured(df: DataFrame, stats: DataFrame, on: list[str]) -> DataFrame:
    df = df.join(stats, on, "left").fillna({"suffix_log_count": 0.0, "suffix_block_rate": 0.5})
    df = df.withColumns(_lexical(F.col("url"), F.col("host"), F.col("path")))
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(df)


def _fit(known: DataFrame, train_rows: int):
    """(trees, statistics of all suffixes), or (the only verdict there is, None)."""
    fold = F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(FOLDS)).alias("fold")
    known = known.select("*", fold)
    counts = known.groupBy("suffix", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("bad")).checkpoint()
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total["n"] or total["bad"] in (0, total["n"]):
        return ("block" if total["n"] and total["bad"] else "allow"), None
    weigh = {True: total["n"] / (2 * total["bad"]), False: total["n"] / (2 * (total["n"] - total["bad"]))}

    def statistics(df: DataFrame, *names: str) -> DataFrame:
        bad, good = F.col("bad") * weigh[True], (F.col("n") - F.col("bad")) * weigh[False]
        return df.select(*names, F.log1p("n").alias("suffix_log_count"),
                         ((bad + NEUTRAL / 2) / (bad + good + NEUTRAL)).alias("suffix_block_rate"))

    whole = counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # every fold but 0 gets what the others say; a fold absent here is filled in as an unknown suffix
    rest = (counts.filter("fold > 0").withColumnsRenamed({"n": "own", "bad": "own_bad"}).join(whole, "suffix")
            .select("suffix", "fold", (F.col("n") - F.col("own")).alias("n"), (F.col("bad") - F.col("own_bad")).alias("bad")))
    sample = known.orderBy(F.xxhash64("url"), "url").limit(train_rows)
    weight = F.when(F.col("blocked") == 1, weigh[True]).otherwise(weigh[False]).alias("weight")
    train = (_featured(sample, statistics(rest, "suffix", "fold"), ["suffix", "fold"])
             .select("features", "blocked", weight).checkpoint())
    trees = GBTClassifier(labelCol="blocked", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(train)
    return trees, statistics(whole, "suffix")


def _judged(df: DataFrame, model) -> DataFrame:
    """``df`` (url, host, path, suffix) with ``judged`` and ``score``, its probability of block."""
    trees, stats = model
    if stats is None:
        return df.withColumns({"judged": F.lit(trees), "score": F.lit(None).cast("double")})
    judged = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return trees.transform(_featured(df, stats, ["suffix"])).withColumns(
        {"judged": judged, "score": vector_to_array("probability")[1]})


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, rules=RULES,
               train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and blocked_score (null where a rule decides) of every row."""
    prepare(pages.sparkSession)
    rows = _ruled(pages, rules, "page_id").checkpoint()
    scored = _judged(rows, _fit(_known(rows, labels), train_rows))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", "judged").alias("verdict"),
                         F.when(F.col("ruled").isNull(), F.col("score")).alias("blocked_score"))


def accuracy(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, train_rows: int = TRAIN_ROWS,
             whole_suffixes: bool = False) -> DataFrame:
    """suffix, n, n_right, n_block and n_block_right of labelled URLs that the fit has not seen.

    A quarter of the URLs by hash is kept from the fit; with ``whole_suffixes`` a quarter of the suffixes,
    which measures verdicts on suffixes without labels.
    """
    prepare(pages.sparkSession)
    known = _known(_ruled(pages, rules), labels).checkpoint()
    kept = F.pmod(F.xxhash64("suffix" if whole_suffixes else "url", F.lit("kept")), F.lit(4)) == 0
    judged = _judged(known.filter(kept), _fit(known.filter(~kept), train_rows))
    bad, right = F.col("blocked") == 1, (F.col("judged") == "block") == (F.col("blocked") == 1)
    count = lambda c: F.count(F.when(c, 1))
    return judged.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), count(right).alias("n_right"),
                                        count(bad).alias("n_block"), count(bad & right).alias("n_block_right"))
