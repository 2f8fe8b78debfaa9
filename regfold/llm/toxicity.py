"""Toxic passages as maximum-scoring segments (operator 7).

Features are words and their first characters. Each has a log-odds score, toxic against other labelled
documents that hold it, under a Dirichlet prior that follows its frequency in the whole corpus. Counts are kept by
the feature itself, summed by Spark, so no two features share a score; the model holds the significant ones only.
A word scores as its best significant feature; all other words carry a small negative drift. In every text all
maximal scoring segments are found in linear time (Ruzzo and Tompa); a segment's score S over n tokens
is held against the extreme-value law for chance segments, P = 1 - exp(-K n exp(-lambda S)), and those
with ``-ln(K n) + lambda S > 0`` are significant. A logistic curve over the best and the summed
normalised scores gives the document's score between 0 and 1.

Only rows whose crc32(doc_id as text) mod 5 is not 0 lend labels, at most ``TRAIN_ROWS`` of them (the
first by hash); frequencies for the prior cover all documents. A score depends on the text alone.

Cases: null and empty texts have no segments and get the score of a text without any. Rows without a
label are scored like others. If labels of one kind are missing, every score is the smoothed share
of toxic labels. Repeated labels of a document count once (toxic if any says so). A null doc_id has
no label and isn't held out. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import factorize, map_batches, portions, prepare

TRAIN_ROWS = 50_000
PRIOR_TOKENS = 20_000.0  # weight of the prior, in tokens
SIGNIFICANT = 3.0  # z value from which a feature counts as toxic
LEAST_ODDS = 1.5  # and its least log-odds
DRIFT = -0.1  # score of all other words
STEMS = (4, 5, 6)  # a word's first characters are features too, for inflected forms

_TOKEN = re.compile(r"\w+")


def _word_features(word: str) -> list[str]:
    """The word and its first characters, these with a ``*``, which no word holds."""
    return [word, *[f"{word[:n]}*" for n in STEMS if len(word) >= n]]


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of all texts, distinct words, and the number of words of each text."""
    split = [_TOKEN.findall(t.lower()) for t in texts]
    ids, uniques = factorize([w for s in split for w in s])
    return ids, uniques, np.array([len(s) for s in split], dtype=np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by feature: all (a document counts once for each word of its own), clean and toxic ones."""
    for part in portions(batches):
        ids, uniques, sizes = _tokens([t or "" for t in part.column(0).to_pylist()])
        if not len(ids):
            continue
        names: dict[str, int] = {}
        of_word = np.full((len(uniques), 1 + len(STEMS)), -1, dtype=np.int64)
        for i, w in enumerate(uniques):
            for j, f in enumerate(_word_features(w)):
                of_word[i, j] = names.setdefault(f, len(names))
        toxic = np.array([-1 if v is None else v for v in part.column(1).to_pylist()])
        pairs = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(uniques) + ids)
        doc, word = pairs // len(uniques), pairs % len(uniques)
        seen = np.zeros((3, len(names)), dtype=np.int64)
        has = of_word >= 0
        words = np.bincount(word, minlength=len(uniques))
        seen[0] = np.bincount(of_word[has], np.broadcast_to(words[:, None], has.shape)[has], len(names))
        for kind in (0, 1):
            own = toxic[doc] == kind
            features = of_word[word[own]]
            flat = (doc[own][:, None] * len(names) + features)[features >= 0]
            seen[1 + kind] = np.bincount(np.unique(flat) % len(names), minlength=len(names))
        yield pa.record_batch([pa.array(list(names), pa.string()), *(pa.array(s, pa.int64()) for s in seen)],
                              names=["feature", "n_all", "n_clean", "n_toxic"])


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end, score), in order; only positive scores open one.

    Every candidate points to the nearest one before it whose left sum is smaller. A search follows these pointers and
    its result becomes the new candidate's pointer, so no pointer is followed twice and the time is linear.
    """
    total = np.concatenate([[0.0], np.cumsum(scores)]).tolist()
    kept: list[tuple] = []  # start, end, total before, total after, pointer
    for i in np.flatnonzero(scores > 0).tolist():
        start, before, after = i, total[i], total[i + 1]
        j = len(kept) - 1
        while j >= 0 and kept[j][2] >= before:
            j = kept[j][4]
        while j >= 0 and kept[j][3] < after:  # joins that candidate and all behind it
            start, _, before, _, pointer = kept[j]
            del kept[j:]
            j = pointer
        kept.append((start, i + 1, before, after, j))
    return [(a, b, after - before) for a, b, before, after, _ in kept]


def _features(texts: list[str], model: dict) -> list[tuple[float, float, list]]:
    """Best and summed normalised score, and the significant segments of each text."""
    ids, uniques, sizes = _tokens(texts)
    known = model["scores"]
    by_word = np.array([max([DRIFT, *[known[f] for f in _word_features(w) if f in known]]) for w in uniques], dtype=np.float64)
    scores = by_word[ids]
    out, at = [], 0
    for n in sizes.tolist():
        own = scores[at : at + n]
        at += n
        chance = np.log(max(model["k"] * max(n, 1), 1.0))
        found = [(a, b, model["lam"] * s - chance) for a, b, s in maximal_segments(own)] if (own > 0).any() else []
        sure = [f for f in found if f[2] > 0]
        best = max((f[2] for f in found), default=-chance)
        out.append((max(best, -20.0), sum(f[2] for f in sure), sure))
    return out


def _measure(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for part in portions(batches):
        got = _features([t or "" for t in part.column(0).to_pylist()], model)
        yield pa.record_batch([part.column(1), pa.array([g[0] for g in got], pa.float64()),
                               pa.array([g[1] for g in got], pa.float64())], names=["toxic", "best", "summed"])


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _inputs(best, summed) -> np.ndarray:
    best, summed = np.asarray(best, dtype=float), np.asarray(summed, dtype=float)
    return np.stack([np.ones_like(best), best / 10, np.log1p(np.maximum(summed, 0))], axis=-1)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps; the ridge keeps separable data finite."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = _chance(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _score(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    segment = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for part in portions(batches):
        got = _features([t or "" for t in part.column(2).to_pylist()], model)
        score = _chance(_inputs([g[0] for g in got], [g[1] for g in got]) @ model["weights"])
        segments = [[{"start": a, "end": b, "score": s} for a, b, s in g[2]] for g in got]
        yield pa.record_batch([part.column(0), part.column(1), pa.array(score, pa.float64()),
                               pa.array(segments, segment)], names=["doc_id", "held_out", "score", "segments"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _training_labels(labels: DataFrame, train_rows: int) -> DataFrame:
    """At most ``train_rows`` rows, so they may be broadcast."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    each = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)


def _token_scores(counts: DataFrame) -> dict | None:
    """Log-odds and the constants of the extreme-value law. Only significant features come to the driver; of the others,
    which all score ``DRIFT``, their common share is enough."""
    total = counts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("n_all", "n_clean", "n_toxic")]).first()
    if not total["n_clean"] or not total["n_toxic"]:
        return None
    weight = PRIOR_TOKENS + 0.5 * total["n"]  # of the prior over all features
    n_toxic, n_clean = total["n_toxic"] + weight, total["n_clean"] + weight
    prior = (F.col("n_all") + 0.5) / (total["n_all"] + 0.5 * total["n"]) * PRIOR_TOKENS + 0.5
    rows = counts.select("feature", (F.col("n_toxic") + prior).alias("toxic"), (F.col("n_clean") + prior).alias("clean"))
    odds = F.ln(F.col("toxic") / (n_toxic - F.col("toxic"))) - F.ln(F.col("clean") / (n_clean - F.col("clean")))
    rows = rows.withColumn("odds", odds).filter(
        (F.col("odds") / F.sqrt(1 / F.col("toxic") + 1 / F.col("clean")) >= SIGNIFICANT) & (F.col("odds") >= LEAST_ODDS))
    kept = rows.select("feature", "odds", "clean").toPandas().sort_values("feature")
    score = np.append(kept["odds"].to_numpy(float), DRIFT)
    share = kept["clean"].to_numpy(float) / n_clean
    share = np.append(share, 1 - share.sum())
    low, high = 0.0, 50.0  # lambda solves sum share * exp(lambda * score) = 1
    if len(kept) and (share * score).sum() < 0:
        for _ in range(100):
            lam = (low + high) / 2
            low, high = (lam, high) if (share * np.exp(np.minimum(lam * score, 700))).sum() < 1 else (low, lam)
    return {"scores": dict(zip(kept["feature"], score[:-1].tolist(), strict=True)), "lam": max(low, 1e-3), "k": 1.0}


def toxic_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and significant segments (token positions) of every row."""
    spark = prepare(docs.sparkSession)
    known = _training_labels(labels, train_rows).checkpoint()
    # of equal labelled texts one is learned from, or copies would pass for evidence
    known = (docs.select("doc_id", F.md5("text").alias("content")).join(F.broadcast(known), "doc_id")
             .groupBy("content").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
             .select("doc_id", "toxic").checkpoint())
    marked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id", "left").select("text", "toxic")
    counts = (map_batches(marked, _count, "feature string, n_all long, n_clean long, n_toxic long").groupBy("feature")
              .agg(*[F.sum(n).alias(n) for n in ("n_all", "n_clean", "n_toxic")]).checkpoint())
    model = _token_scores(counts)
    kind = dict(docs.dtypes)["doc_id"]
    if model is None:
        n, bad = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        share = (bad + 0.5) / (n + 1.0) if n else 0.0
        empty = F.array().cast("array<struct<start:long,end:long,score:double>>")
        out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.lit(float(share)).alias("score"),
                          empty.alias("segments"))
    else:
        train = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "toxic")
        shared = spark.sparkContext.broadcast(model)
        seen = map_batches(train, lambda it: _measure(it, shared.value), "toxic int, best double, summed double")
        rows = seen.toPandas()  # one row per training label
        clean = rows.loc[rows["toxic"] == 0, "best"].to_numpy()
        # mean of the Gumbel law is (ln(K n) + 0.577) / lambda: the clean texts give K
        chance = clean[clean > -np.inf].mean() - 0.5772 if len(clean) else 0.0
        model = model | {"k": float(np.exp(np.clip(chance, -10, 10)))}
        shared = spark.sparkContext.broadcast(model)
        rows = map_batches(train, lambda it: _measure(it, shared.value),
                           "toxic int, best double, summed double").toPandas()
        rows = rows.sort_values(["toxic", "best", "summed"])
        model = model | {"weights": _fit(_inputs(rows["best"], rows["summed"]), rows["toxic"].to_numpy(float))}
        final = spark.sparkContext.broadcast(model)
        src = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
        out = map_batches(src, lambda it: _score(it, final.value),
                          f"doc_id {kind}, held_out boolean, score double, "
                          "segments array<struct<start:long,end:long,score:double>>")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
