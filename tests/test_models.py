"""Training, storage and inference with small forests."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tailwake import schemas as S
from tailwake.operators import summaries
from tailwake.operators.reports import add_base_features, add_features, clean_reports
from tailwake.plans import silver, training


@pytest.fixture(scope="module")
def rows(reports):
    featured = add_features(clean_reports(reports))
    return featured.withColumn("delay_minutes", F.col("given_delay")).persist()


@pytest.fixture(scope="module")
def models(rows):
    return training.train(rows, trees=5, depth=4, k=3)


def test_split_is_stable_and_complete(rows):
    fit, held = training.split(rows, "flight_id", "ingested_at")
    again, _ = training.split(rows.repartition(13), "flight_id", "ingested_at")
    key = ["flight_id", "ingested_at"]
    assert fit.count() + held.count() == rows.count()
    assert fit.select(key).exceptAll(again.select(key)).count() == 0
    assert 0.7 < fit.count() / rows.count() < 0.9


def test_inference_and_fallback(reports, models):
    delay_model, cluster_model = models
    modelled = silver.enrich(reports, delay_model=delay_model, cluster_model=cluster_model)
    ruled = silver.enrich(reports)
    assert modelled.count() == ruled.count()
    assert {r[0] for r in modelled.select("spatial_cluster").distinct().collect()} == {0, 1, 2}
    assert ruled.filter("spatial_cluster <> -1").count() == 0
    assert silver.silver(modelled).columns == [*S.SILVER_COLUMNS, "processing_date"]
    one_decimal = F.round("predicted_delay_minutes", 1).cast("float") == F.col("predicted_delay_minutes")
    assert modelled.filter(~one_decimal).count() == 0
    assert modelled.select("predicted_delay_minutes").distinct().count() > 5


def test_unseen_and_blank_categories(spark, rows, models):
    strange = rows.limit(5).withColumns({"airline_icao": F.lit("???"), "aircraft_model": F.lit("")})
    assert training.predict_delay(models[0], strange).filter("prediction IS NULL").count() == 0
    assert training.predict_delay(models[0], strange).count() == 5


def test_rows_with_null_features_are_skipped(rows, models):
    broken = rows.limit(4).withColumn("wind_knots", F.lit(None).cast("float"))
    assert models[0].transform(broken).count() == 0


def test_save_and_load(spark, rows, models, tmp_path):
    path = str(tmp_path / "models")
    assert training.load_models(spark, path) == (None, None)
    training.save_models(path, *models)
    training.save_models(path, *models)
    delay_model, cluster_model = training.load_models(spark, path)
    key = ["flight_id", "ingested_at", "prediction"]
    before, after = models[0].transform(rows).select(key), delay_model.transform(rows).select(key)
    assert before.exceptAll(after).count() == 0
    assert cluster_model.transform(rows).select("spatial_cluster").distinct().count() == 3


def test_metrics_agree_with_the_evaluator(rows, models):
    scored = models[0].transform(rows).persist()
    got = summaries.regression_metrics(scored).first()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(
            labelCol="delay_minutes", predictionCol="prediction", metricName=name
        )
        assert got[name] == pytest.approx(evaluator.evaluate(scored), abs=1e-4)
    assert summaries.prediction_sample(scored).count() == 15


def test_training_rows_bring_their_own_clock(spark):
    row = ("A320", "GIA", 1.0, 30.0, 2000.0, 61, 36000, 150, 10, 18, 7, 0.5, 9, 1000.0, 9.0, 42.0, 1.0, 2.0)
    table = spark.createDataFrame([row], S.TRAINING)
    got = add_base_features(table).first()
    assert (got.is_raining, got.is_high_wind, got.is_low_visibility, got.is_bad_weather) == (1, 1, 1, 1)
    assert (got.flight_phase, got.is_slow, got.is_peak_hour, got.is_weekend) == (2, 1, 1, 1)


def test_metrics_of_a_constant_label(spark):
    rows = spark.createDataFrame([(5.0, 4.0), (5.0, 7.0)], "delay_minutes double, prediction double")
    got = summaries.regression_metrics(rows).first()
    assert (got.rmse, got.mae, got.r2) == (1.5811, 1.5, None)


def test_sample_is_the_first_rows_by_key(rows, models):
    scored = training.predict_delay(models[0], rows)
    one = summaries.prediction_sample(scored).collect()
    assert one == summaries.prediction_sample(scored.repartition(7)).collect()
    assert [r.flight_id for r in one] == sorted(r.flight_id for r in one)


def test_a_model_depends_on_rows_and_seed_only(rows):
    key = ("flight_id", "ingested_at")
    fits = [
        training.fit_delay(training.laid_out(some, *key, partitions=3), trees=3, depth=3)
        for some in (rows, rows.repartition(9, "destination"))
    ]
    scored = [
        sorted(training.predict_delay(m, rows).select(*key, "prediction").collect()) for m in fits
    ]
    assert scored[0] == scored[1]


def test_default_model_is_whole():
    assert (training.TREES, training.DEPTH) == (100, 8)


def test_rows_are_worked_out_once_for_all_passes(rows, monkeypatch):
    """Both fits see rows that are kept, and let them go."""
    seen = []

    class Seen:
        def fit(self, some):
            seen.append(some)
            assert some.storageLevel.useDisk and not some.storageLevel.useMemory

    monkeypatch.setattr(training, "delay_pipeline", lambda *_: Seen())
    monkeypatch.setattr(training, "cluster_pipeline", lambda *_: Seen())
    training.fit_delay(rows.filter("altitude_ft > 1"))
    training.train(rows.filter("altitude_ft > 2"))
    assert len(seen) == 3 and not any(some.storageLevel.useDisk for some in seen)


def test_kept_nodes_leave_the_model_as_it_is(rows, monkeypatch):
    laid = training.laid_out(rows, "flight_id", "ingested_at").limit(400)
    models = []
    for fit in (True, False):
        monkeypatch.setattr(training, "nodes_fit", lambda *_, fit=fit: fit)
        models.append(training.fit_delay(laid.repartition(1).sortWithinPartitions("flight_id", "ingested_at"), trees=4, depth=5))
    forests = [m.stages[-1] for m in models]
    assert [f.getCacheNodeIds() for f in forests] == [True, False]
    assert forests[0].toDebugString.split("\n")[1:] == forests[1].toDebugString.split("\n")[1:]


def test_nodes_are_kept_only_where_memory_holds_them(rows):
    some = rows.limit(10)
    assert training.nodes_fit(some, 100) and not training.nodes_fit(some, 10**9)
