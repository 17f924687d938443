import random
import time

import numpy as np
import pytest

from tailwake.llm import toxicity


def brute_segments(scores):
    """Maximal scoring segments by their definition: take the best, then go on left and right."""
    out = []

    def split(low, high):
        best = None
        for a in range(low, high):
            total = 0
            for b in range(a, high):
                total += scores[b]
                if total > 0 and (best is None or (total, a - b) > (best[0], best[1] - best[2])):
                    best = (total, a, b)
        if best:
            out.append((best[1], best[2] + 1, best[0]))
            split(low, best[1])
            split(best[2] + 1, high)

    split(0, len(scores))
    return sorted(out)


def test_segments_match_definition():
    rng = random.Random(5)
    for _ in range(200):
        scores = np.array([rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(25)])
        found = toxicity.segments(scores)
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in found], [s for *_, s in want])


@pytest.mark.parametrize("shape", ["falling", "rising", "level", "random"])
def test_segments_take_linear_time(shape):
    """Isolated positives on a sum that falls, rises or neither."""

    def seconds(n):
        gap = {"falling": -3.0, "rising": -0.5, "level": -1.0}
        scores = np.ones(2 * n)
        scores[1::2] = gap.get(shape, 0)
        if shape == "random":
            scores[1::2] = np.random.default_rng(1).normal(-1, 1, n)
        start = time.perf_counter()
        toxicity.segments(scores)
        return time.perf_counter() - start

    assert seconds(400_000) < 40 * seconds(20_000) + 0.5


def test_chance_decay_solves_its_equation():
    scores = np.array([2.0, -0.3, -0.3])
    toxic, clean = np.array([5.0, 100, 100]), np.array([1.0, 5000, 5000])
    decay = toxicity.chance_decay(scores, toxic, clean)
    share = clean + toxicity.PRIOR * (toxic + clean)
    assert abs((share / share.sum() * np.exp(decay * scores)).sum() - 1) < 1e-6


@pytest.fixture(scope="module")
def scored(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = toxicity.score_documents(docs, labels)
    return found.join(labels.select("doc_id", "toxic"), "doc_id", "left").toPandas()


def test_held_out_accuracy(scored):
    assert len(scored) == 10_000
    held = scored[scored.held_out & scored.toxic.notna()]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert toxic.predicted.mean() > 0.75 and clean.predicted.mean() < 0.02
    order = held.score.rank()
    auc = (order[held.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / len(toxic) / len(clean)
    assert auc > 0.85
    assert (scored.predicted == (scored.score >= 0.5)).all() and scored.score.between(0, 1).all()


def test_passages_hold_the_toxic_words(scored):
    row = scored[scored.passages.map(len) > 0].iloc[0]
    assert all(p["expected"] < toxicity.EXPECT and p["stop"] > p["start"] for p in row.passages)


def test_odd_rows_and_no_labels(spark, odd_documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score_documents(odd_documents, labels).collect()
    assert len(rows) == 10 and all(r["score"] < 1e-6 and r["predicted"] == 0 for r in rows)
    some = spark.createDataFrame([(1, None, 1), (2, 0, None), (None, 1, 1), (4, 1, 0)], labels.schema)
    assert toxicity.score_documents(odd_documents, some).count() == 10
    assert toxicity.score_documents(odd_documents.limit(0), some).count() == 0
