"""The forest as a node table, and versions of models in a running stream."""

import pytest
from pyspark.sql import functions as F

from tailwake.operators.reports import add_features, clean_reports
from tailwake.plans import forest, silver, training
from tailwake.plans.models import VERSION, ModelStore, ScoredSilver
from tailwake.sources import envelopes, events, runs
from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs

KEY = ("flight_id", "ingested_at")


@pytest.fixture(scope="module")
def rows(reports):
    featured = add_features(clean_reports(reports))
    return featured.withColumn(training.LABEL, F.col("given_delay")).persist()


@pytest.fixture(scope="module", params=[(1, 1), (7, 5), (20, 8)])
def model(request, rows):
    trees, depth = request.param
    return training.fit_delay(training.laid_out(rows, *KEY), trees=trees, depth=depth)


def by_key(frame):
    return {(r[0], r[1]): r[2] for r in frame.select(*KEY, "prediction").collect()}


def test_walk_equals_the_model(spark, rows, model):
    nodes = forest.node_table(spark, model)
    trees = model.stages[-1].trees
    assert nodes.count() == sum(t.numNodes for t in trees)
    walked = forest.predict(model, rows, nodes.repartition(5))
    assert by_key(walked) == by_key(training.predict_delay(model, rows))
    got = forest.Forest.of(nodes)
    assert len(got.roots) == len(trees) and got.depth == max(t.depth for t in trees)


def test_walk_of_a_stored_table(spark, rows, model, tmp_path):
    path = str(tmp_path / "nodes")
    forest.node_table(spark, model).write.parquet(path)
    strange = rows.limit(20).withColumns({"airline_icao": F.lit("???"), "aircraft_model": F.lit("")})
    walked = forest.predict(model, strange, spark.read.parquet(path))
    assert by_key(walked) == by_key(training.predict_delay(model, strange))
    plan = walked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_a_forest_of_leaves(spark):
    nodes = spark.createDataFrame(
        [(0, 0, -1, None, -1, -1, 4.0), (1, 0, -1, None, -1, -1, 6.0)],
        "tree int, node int, feature int, threshold double, left int, right int, value double",
    )
    got = forest.predicted(forest.Forest.of(nodes), F.array(F.lit(1.0)))
    assert spark.range(1).select(got).first()[0] == 5.0


def test_features_are_worked_out_once_a_row(spark):
    """The walk sees them as a variable, and a row's null goes right, as in the model."""
    nodes = spark.createDataFrame(
        [(0, 0, 0, 1.5, 1, 2, 0.0), (0, 1, 0, 0.5, 3, 4, 0.0), (0, 2, -1, None, -1, -1, 9.0)]
        + [(0, 3, -1, None, -1, -1, 5.0), (0, 4, -1, None, -1, -1, 7.0)],
        "tree int, node int, feature int, threshold double, left int, right int, value double",
    )
    walker = forest.Forest.of(nodes)
    rows = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "x double")
    got = rows.select(forest.predicted(walker, F.array("x"))).collect()
    assert [r[0] for r in got] == [5.0, 7.0, 9.0, 9.0]
    plan = rows.select(forest.predicted(walker, F.array("x")).alias("y"))._jdf.queryExecution().analyzed().toString()
    assert "transform(array(array(x#" in plan and plan.count("array(x#") == 1


def test_versions(spark, rows, tmp_path):
    store = ModelStore(str(tmp_path / "models"))
    assert store.newest(spark) == (0, None, None)
    first = training.train(training.laid_out(rows, *KEY), trees=1, depth=1, k=2)
    assert store.publish(spark, *first) == 1
    version, delay, clusters = store.newest(spark)
    assert version == 1 and delay.stages[-1].getNumTrees == 1
    assert store.newest(spark)[1] is delay  # loaded once
    second = training.train(training.laid_out(rows, *KEY), trees=2, depth=1, k=3)
    assert store.publish(spark, *second) == 2
    assert store.newest(spark)[1].stages[-1].getNumTrees == 2
    assert ModelStore(store.base).newest(spark)[0] == 2


def test_a_running_stream_takes_over_a_retrained_model(spark, sf_dir, rows, monkeypatch):
    """Each batch is scored by the version that was newest when it ran, and says so."""
    monkeypatch.setattr(runs, "FAN", 2)
    base = new_folder(spark, "versions")
    messages = events.messages(events.read_events(spark, sf_dir))
    messages.repartition(3).write.parquet(f"{base}/topic")
    store = ModelStore(f"{base}/models")
    laid = training.laid_out(rows, *KEY)
    models = {n: training.train(laid, trees=n, depth=2, k=2) for n in (1, 2)}

    class Retraining(ScoredSilver):
        """Publishes a model between batches of one run."""

        def update(self, parsed, batch_id):
            if batch_id in models:
                store.publish(parsed.sparkSession, *models[batch_id])
            super().update(parsed, batch_id)

    scored = Retraining(f"{base}/silver", store)
    source = envelopes.read_envelope_stream(spark, "parquet", f"{base}/topic", {"maxFilesPerTrigger": "1"})
    query = jobs.start_scored(envelopes.decode_reports(source), scored, f"{base}/ck", jobs.ONCE)
    jobs.drain(query)
    got = scored.read(spark)
    assert {r[0] for r in got.select(VERSION).distinct().collect()} == {0, 1, 2}
    parsed = envelopes.decode_reports(spark.read.parquet(f"{base}/topic"))
    shown = (*KEY, "predicted_delay_minutes", "spatial_cluster")
    for version in (0, 1, 2):
        delay, clusters = models.get(version, (None, None))
        want = silver.enrich(parsed, delay_model=delay, cluster_model=clusters).select(*shown)
        some = got.filter(F.col(VERSION) == version).select(*shown)
        assert some.exceptAll(want).count() == 0 and some.count() > 0
    assert got.count() == silver.enrich(parsed).count()
    assert len(scored.store.newest(spark).runs["silver"]) < 3
