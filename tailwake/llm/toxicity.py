"""Toxicity: maximum-scoring segments of token log-odds, with extreme-value calibration.

Learning. Each token gets the log-odds of occurring in a toxic rather than a clean document, with a
Dirichlet prior in proportion to its overall frequency. Tokens whose log-odds are neither large nor
significant get a small negative score instead, so that a text without toxic words drifts down.
Tokens are hashed into BUCKETS scores, so the table has one size whatever the corpus. It is learned
on at most SAMPLE labelled documents, those with the smallest hash of their id.

Scoring. One linear scan of a text's token scores finds all maximal scoring segments. For segment
score s in a text of n tokens, K * n * exp(-lambda * s) segments of at least that score are expected
by chance, where lambda solves sum(p * exp(lambda * score)) = 1 over the clean token distribution p.
Segments expected fewer than EXPECT times are significant passages. A document's evidence is the sum
of lambda * s - ln(1 + K * n) over its passages, and a logistic curve over its logarithm, fitted on
labelled rows that had no part in the scores, turns it into a probability.

Only the text enters a score. Held out are rows whose crc32(doc_id as text) modulo 5 is 0; rest 1 to
3 teach the scores, 4 the curve.

Defined cases: null and empty texts have no passage and the score of a text without evidence. A null
doc_id counts as the empty text for the remainder and has no label. Labels that are null are
ignored; of several for one id the largest counts. Without labels every score is 0. Repeated rows
are scored each. Scoring adds columns to the given ones through one Arrow function over the text;
it has no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake.llm.common import column, remainder

BUCKETS = 1 << 18
SAMPLE = 20_000
FOLDS = 5
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Share of the corpus that the prior weighs.
PRIOR = 0.01
#: Log-odds and likelihood ratio (G) that a token needs to count as toxic.
LEAST_ODDS, LEAST_RATIO = 1.0, 20.0
DRIFT = -0.3
K = 0.1
EXPECT = 0.05
BIN = 0.125
BINS = 64
PASSAGE = "struct<start:bigint,stop:bigint,score:double,expected:double>"


@dataclass
class Model:
    """Token scores by bucket, the two constants of the chance distribution, the logistic curve."""

    scores: np.ndarray = field(default_factory=lambda: np.full(BUCKETS, DRIFT, np.float32))
    decay: float = 1.0
    curve: tuple[float, float] = (-50.0, 0.0)


def tokens(text: str | None) -> np.ndarray:
    """Bucket of each token."""
    if not text:
        return np.empty(0, np.int64)
    found = TOKEN.findall(text.encode("utf-8", "surrogatepass").lower())
    return np.array([crc32(t) for t in found], np.int64) & (BUCKETS - 1)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, stop, score), by a scan over the positive scores.

    Each segment remembers the last one before it that starts from a lower sum. Those in between start
    no lower than it does, so a search goes from link to link and no link is followed twice: the time is
    linear in the positive scores."""
    total = np.cumsum(scores, dtype=np.float64)
    kept: list[tuple[int, int, float, float, int]] = []  # start, stop, sum before, sum through, link
    for at in np.flatnonzero(scores > 0).tolist():
        start, through = at, float(total[at])
        before = float(total[at - 1]) if at else 0.0
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= before:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= through:
                kept.append((start, at + 1, before, through, j))
                break
            start, _, before, _, link = kept[j]
            del kept[j:]
            j = link
    return [(a, b, through - before) for a, b, before, through, _ in kept]


def judge(text: str | None, model: Model) -> tuple[float, list[dict]]:
    """A text's evidence and its significant passages."""
    scores = model.scores[tokens(text)]
    passages, evidence = [], 0.0
    chance = K * len(scores)
    for start, stop, score in segments(scores):
        expected = chance * np.exp(-model.decay * score)
        if expected < EXPECT:
            passages.append({"start": start, "stop": stop, "score": score, "expected": float(expected)})
            evidence += max(0.0, model.decay * score - np.log1p(chance))
    return float(evidence), passages


def probability(evidence: float, model: Model) -> float:
    a, b = model.curve
    return float(1 / (1 + np.exp(-(a + b * np.log1p(evidence)))))


# -- learning ------------------------------------------------------------------------------------


def log_odds(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Token scores from how many toxic and clean documents each token occurs in."""
    both = toxic + clean
    prior = PRIOR * both
    weight = prior.sum()

    def logit(seen: np.ndarray) -> np.ndarray:
        return np.log((seen + prior) / (seen.sum() + weight - seen - prior))

    scores = np.full(len(both), DRIFT, np.float32)
    seen = both > 0
    share = toxic.sum() / both.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        odds = logit(toxic) - logit(clean)
        ratio = 2 * (
            np.where(toxic > 0, toxic * np.log(toxic / (both * share)), 0)
            + np.where(clean > 0, clean * np.log(clean / (both * (1 - share))), 0)
        )
    strong = seen & (odds >= LEAST_ODDS) & (ratio >= LEAST_RATIO)
    scores[strong] = odds[strong]
    return scores


def chance_decay(scores: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """The positive lambda with sum(p * exp(lambda * score)) = 1 over the clean distribution."""
    share = clean + PRIOR * (toxic + clean)
    share = share / share.sum()
    keep = share > 0
    share, scores = share[keep], scores[keep].astype(np.float64)
    low, high = 1e-6, 10.0
    if not (scores > 0).any() or (share * scores).sum() >= 0:
        return 1.0
    for _ in range(80):
        middle = (low + high) / 2
        if (share * np.exp(np.minimum(middle * scores, 700))).sum() < 1:
            low = middle
        else:
            high = middle
    return low


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """Logistic curve over log(1 + evidence) from counts per value, with a weak ridge."""
    x = np.stack([np.ones(len(evidence)), np.log1p(evidence)], axis=1)
    seen, beta = toxic + clean, np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        ridge = np.diag([1e-6, 1e-3])
        slope = x.T @ (toxic - seen * p) - ridge @ beta
        bend = (x * (seen * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled ids outside the held-out fold, joined with their texts."""
    order = F.xxhash64("doc_id")
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("toxic"))
        .where("doc_id is not null and toxic is not null")
        .where(remainder(F.col("doc_id"), FOLDS) != 0)
    )
    # Hashes are spread evenly: of many labels only those that may be among the smallest go on.
    share = 4 * sample / max(known.count(), 1)
    if share < 1:
        known = known.where(order < -(2**63) + int(share * 2**64))
    chosen = (
        known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    # Bounded by the limit above. A text that several of the ids share teaches once.
    return (
        texts.join(F.broadcast(chosen), "doc_id")
        .select("text", "toxic", remainder(F.col("doc_id"), FOLDS).alias("fold"))
        .groupBy("text")
        .agg(F.max("toxic").cast("int").alias("toxic"), F.min("fold").alias("fold"))
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled(docs, labels, sample)
    counts = pa.schema([("bucket", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(parts):
        seen = np.zeros((2, BUCKETS), np.int64)
        for part in parts:
            for text, toxic in zip(column(part, "text"), column(part, "toxic"), strict=True):
                seen[0 if toxic else 1, np.unique(tokens(text))] += 1
        hit = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit.astype(np.int32)), pa.array(seen[0, hit]), pa.array(seen[1, hit])],
            schema=counts,
        )

    teaching = rows.where(F.col("fold") != FOLDS - 1).select("text", "toxic")
    summed = (
        teaching.mapInArrow(count, "bucket int, toxic long, clean long")
        .groupBy("bucket")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .toArrow()  # at most BUCKETS rows
    )
    seen = np.zeros((2, BUCKETS))
    at = summed.column("bucket").to_numpy()
    seen[0, at], seen[1, at] = summed.column("toxic").to_numpy(), summed.column("clean").to_numpy()
    model = Model()
    if seen[0].any() and seen[1].any():
        model.scores = log_odds(*seen)
        model.decay = chance_decay(model.scores, *seen)

    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def evidence(text: pa.Array) -> pa.Array:
        return pa.array([judge(t, shared.value)[0] for t in text.to_pylist()], pa.float64())

    bins = F.least(F.floor(F.log1p(evidence("text")) / BIN), F.lit(BINS)).alias("bin")
    found = (
        rows.where(F.col("fold") == FOLDS - 1)
        .select(bins, "toxic")
        .groupBy("bin")
        .agg(F.sum(F.expr("int(toxic != 0)")).alias("toxic"), F.count("*").alias("seen"))
        .collect()  # at most BINS + 1 rows
    )
    if found:
        found.sort()
        low = np.expm1(np.array([r["bin"] for r in found]) * BIN)
        toxic = np.array([r["toxic"] for r in found], np.float64)
        model.curve = fit_curve(low, toxic, np.array([r["seen"] for r in found]) - toxic)
    elif seen.any():
        model.curve = (0.0, 1.0)
    return model


# -- scoring -------------------------------------------------------------------------------------


def toxicity(text: Column, model: Model, spark) -> Column:
    """A struct of ``score`` (0 to 1) and ``passages``: places in tokens, segment score, and how many
    such segments chance would give."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct(
        [
            ("score", pa.float64()),
            (
                "passages",
                pa.list_(
                    pa.struct(
                        [
                            ("start", pa.int64()),
                            ("stop", pa.int64()),
                            ("score", pa.float64()),
                            ("expected", pa.float64()),
                        ]
                    )
                ),
            ),
        ]
    )

    @F.arrow_udf(f"struct<score:double,passages:array<{PASSAGE}>>")
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for item in texts:
            evidence, passages = judge(item.as_py(), shared.value)
            rows.append({"score": probability(evidence, shared.value), "passages": passages})
        return pa.array(rows, kind)

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, passages; one row per row of ``docs``."""
    model = fit(docs, labels, sample)
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        toxicity(F.col("text"), model, docs.sparkSession).alias("found"),
    ).select(
        "doc_id",
        "held_out",
        F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("found.passages").alias("passages"),
    )
