"""Every query by name, over the event log of a data folder.

``given`` reports use the observed delay of the log, ``ruled`` ones the rule-based delay.
"""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tailwake import schemas as S
from tailwake.functions import impact, parse, weather
from tailwake.operators import airlines as A
from tailwake.operators import alerts as AL
from tailwake.operators import dimensions, heading, rotation, summaries, weather_join
from tailwake.operators import reports as R
from tailwake.operators.latest import newest_timestamp
from tailwake.plans import forest, gold, live, lookup, serving, silver, training
from tailwake.plans.incremental import IncrementalGold
from tailwake.sources import envelopes, events, feed
from tailwake.sources.compaction import CompactedTable
from tailwake.sources.workspace import new_folder
from tailwake.streaming import jobs
from tailwake.streaming.dashboard import Dashboard
from tailwake.streaming.latest_reports import latest_reports
from tailwake.streaming.live_tables import LiveTables

ROW = ("flight_id", "ingested_at")


class Inputs:
    """The derived inputs of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = events.read_events(spark, sf_dir)

    @property
    def reports(self) -> DataFrame:
        return events.flight_reports(self.events)

    @property
    def clean(self) -> DataFrame:
        return R.clean_reports(self.reports)

    @property
    def featured(self) -> DataFrame:
        return R.add_features(self.clean)

    @property
    def given(self) -> DataFrame:
        return silver.enrich(self.reports, delay=F.col("given_delay"))

    @property
    def ruled(self) -> DataFrame:
        return silver.enrich(self.reports)

    @property
    def live(self) -> DataFrame:
        return live.live_state(self.given)

    @property
    def rippled(self) -> DataFrame:
        return live.with_ripple(self.live)

    def rippled_only(self, *columns: str) -> DataFrame:
        """``rippled`` over just the columns a query shows and the ripple score needs."""
        return live.with_ripple(
            live.live_state(self.given, columns=(*rotation.RIPPLE_INPUTS, *columns))
        )

    @property
    def performance(self) -> DataFrame:
        return A.airline_performance(self.rippled_only(*A.PERFORMANCE_INPUTS))

    @property
    def labelled(self) -> DataFrame:
        """Featured reports with their observed delay as label."""
        return self.featured.withColumn(training.LABEL, F.col("given_delay"))

    @property
    def rule_predicted(self) -> DataFrame:
        """Observed delay beside the rule-based one as prediction."""
        return self.ruled.select(
            "aircraft_model",
            "airline_icao",
            F.col("given_delay").alias(training.LABEL),
            F.col("predicted_delay_minutes").alias("prediction"),
        )


# --- sources and lake layers ---


def src_events_parse(i: Inputs) -> DataFrame:
    decoded = envelopes.decode_reports(events.messages(i.events))
    return decoded.select(
        F.unix_seconds("kafka_timestamp").alias("kafka_epoch_s"), *S.BRONZE_COLUMNS
    )


def clean_flights(i: Inputs) -> DataFrame:
    return i.clean.select(*S.BRONZE_COLUMNS)


def bronze_projection(i: Inputs) -> DataFrame:
    return silver.bronze(i.reports)


def silver_projection(i: Inputs) -> DataFrame:
    return silver.rebuild_silver(silver.bronze(i.reports)).drop("processing_date")


def feed_normalize(i: Inputs) -> DataFrame:
    return feed.normalize_feed(events.feed_snapshots(i.events), F.col("ingested_at"))


def kafka_payload(i: Inputs) -> DataFrame:
    return envelopes.encode_predictions(i.given)


def kafka_payload_decoded(i: Inputs) -> DataFrame:
    """The payload text read back, column by column."""
    body = F.from_json("value", i.given.select(*S.PAYLOAD_COLUMNS).schema)
    return kafka_payload(i).select("key", body.alias("body")).select("key", "body.*")


def _emitted(i: Inputs) -> DataFrame:
    readings = events.weather_readings(i.events)
    return envelopes.encode_events(weather_join.attach_weather(feed_normalize(i), readings))


def event_emission(i: Inputs) -> DataFrame:
    return _emitted(i)


def event_emission_decoded(i: Inputs) -> DataFrame:
    body = F.from_json("value", S.EVENT)
    decoded = _emitted(i).select("key", body.alias("body")).select("key", "body.*")
    return weather_join.flatten_weather(decoded)


def gold_summary(i: Inputs) -> DataFrame:
    base = new_folder(i.spark, "gold")
    gold.refresh(i.given, base)
    return gold.gold_summary(i.spark, base)


def gold_refresh_range(i: Inputs) -> DataFrame:
    """A full refresh, then one of 10 to 13 January after the reports of the 11th and those of an
    airline on the 12th are gone."""
    base, name = new_folder(i.spark, "gold-range"), "airline_daily_performance"
    gold.refresh(i.given, base, names=[name])
    day = F.floor(F.col("timestamp") / 86400)
    gone = (day == 19733) | ((day == 19734) & F.col("airline_icao").eqNullSafe("GIA"))
    gold.refresh(i.given.filter(~gone), base, date(2024, 1, 10), date(2024, 1, 14), [name])
    table = gold.gold_table(i.spark, base, name)
    return table.select(*gold.build(i.given, name).columns)


def _in_batches(i: Inputs, name: str) -> DataFrame:
    """A gold table from three batches, one of them replayed, refreshed before and after the last."""
    kept = IncrementalGold(new_folder(i.spark, "gold-incremental"), names=[name])
    share = F.pmod(F.xxhash64(*ROW), F.lit(3))
    for batch, again in ((0, 1), (1, 2), (2, 1)):
        for _ in range(again):
            kept.update(i.given.filter(share == batch), batch)
        if batch:
            kept.refresh(i.spark)
    return gold.gold_table(i.spark, kept.base, name).select(*gold.build(i.given, name).columns)


def gold_incremental(i: Inputs) -> DataFrame:
    return _in_batches(i, "airline_daily_performance")


def gold_incremental_routes(i: Inputs) -> DataFrame:
    return _in_batches(i, "route_daily_statistics")


def gold_by_name(i: Inputs) -> DataFrame:
    """One stored gold table, read back by its name."""
    base, name = new_folder(i.spark, "gold-name"), "hourly_delay_trends"
    gold.refresh(i.given, base, names=[name])
    return gold.gold_table(i.spark, base, name).select(*gold.build(i.given, name).columns)


def bronze_odd_times(i: Inputs) -> DataFrame:
    """Bronze rows whose times are in seconds, milli- or microseconds, or negative."""
    kind = F.pmod(F.col("timestamp"), F.lit(4))
    odd = (
        F.when(kind == 1, F.col("timestamp") * 1000)
        .when(kind == 2, F.col("timestamp") * 1000000)
        .when(kind == 3, -F.col("timestamp"))
        .otherwise(F.col("timestamp"))
    )
    rows = silver.bronze(i.reports.withColumn("timestamp", odd))
    return rows.select(*ROW, "timestamp", "ingestion_date")


def gold_json(i: Inputs) -> DataFrame:
    name = "route_daily_statistics"
    return gold.gold_json(gold.build(i.given, name), name)


def gold_json_decoded(i: Inputs) -> DataFrame:
    table = gold.build(i.given, "route_daily_statistics")
    body = F.from_json("json", table.schema)
    return gold_json(i).select(body.alias("body")).select("body.*")


def gold_date_range(i: Inputs) -> DataFrame:
    return gold.build(i.given, "airline_daily_performance", date(2024, 1, 10), date(2024, 1, 15))


def _gold(name: str):
    def query(i: Inputs) -> DataFrame:
        return gold.presented(gold.build(i.given, name), name)

    return query


# --- features and impact ---


def _featured(*columns: str):
    def query(i: Inputs) -> DataFrame:
        return i.featured.select(*ROW, *columns)

    return query


def rule_delay(i: Inputs) -> DataFrame:
    return i.ruled.select(*ROW, "predicted_delay_minutes", "delay_category")


def weather_condition(i: Inputs) -> DataFrame:
    condition = weather.weather_condition(F.col("weather_code"))
    return i.clean.select(*ROW, condition.alias("weather_condition"))


def safe_parse(i: Inputs) -> DataFrame:
    """Numbers out of text that is partly not numeric."""
    k = F.get_json_object("props", "$.k")
    forms = [
        k, F.concat(k, F.lit(".75")), F.concat(F.lit("-"), k, F.lit(".5")), F.lit("n/a"),
        F.lit(""), F.lit(None).cast("string"), F.concat(k, F.lit("d")),
        F.concat(F.lit(" "), k, F.lit("e1 ")),
    ]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 8 + 1).cast("int"))
    return i.events.select(
        "event_id",
        parse.to_double(text).alias("as_double"),
        parse.to_int(text).alias("as_int"),
    )


def capacity_lookup(i: Inputs) -> DataFrame:
    return i.given.select(*ROW, "aircraft_model", "capacity", "affected_passengers")


def capacity_join(i: Inputs) -> DataFrame:
    seated = dimensions.add_capacity(i.clean.select(*ROW, "aircraft_model"))
    return seated.withColumn("affected_passengers", impact.affected_passengers(F.col("capacity")))


def flight_delay_index(i: Inputs) -> DataFrame:
    return i.given.select(*ROW, "normalized_delay", "fdi", "fdi_category")


def compensation(i: Inputs) -> DataFrame:
    return i.given.select(*ROW, "affected_passengers", "estimated_compensation_eur")


# --- joins ---


def weather_asof_join(i: Inputs) -> DataFrame:
    located = i.reports.select(*ROW, "timestamp", "latitude", "longitude")
    joined = weather_join.attach_weather(located, events.weather_readings(i.events))
    return weather_join.flatten_weather(joined.drop("latitude", "longitude"))


def airline_name_join(i: Inputs) -> DataFrame:
    return dimensions.add_airline_name(i.clean.select(*ROW, "airline_icao"))


def route_airport_join(i: Inputs) -> DataFrame:
    return dimensions.add_route_airports(i.clean.select(*ROW, "origin", "destination"))


def rotation_self_join(i: Inputs) -> DataFrame:
    flights = live.live_state(
        i.given, columns=(*rotation.KEY, "destination", "delay_category")
    )
    return rotation.next_flight_records(
        flights.withColumn("last_seen", F.col("timestamp")),
        ("destination", "delay_category", "last_seen"),
    )


# --- live view and windows ---


def live_state(i: Inputs) -> DataFrame:
    return i.live


def live_active(i: Inputs) -> DataFrame:
    return live.live_state(i.given, now=newest_timestamp(i.given))


def rotation_index(i: Inputs) -> DataFrame:
    return rotation.rotation_index(i.given)


def rotation_recent(i: Inputs) -> DataFrame:
    return rotation.rotation_index(i.given, now=newest_timestamp(i.given))


def _onward(i: Inputs) -> DataFrame:
    flights = live.live_state(i.given, columns=rotation.KEY)
    return rotation.add_onward_legs(flights, rotation.onward_legs(rotation.rotations(flights)))


def downstream_count(i: Inputs) -> DataFrame:
    return _onward(i).select("flight_id", *rotation.KEY, "downstream_flight_count")


def next_flight(i: Inputs) -> DataFrame:
    return _onward(i).select("flight_id", *rotation.KEY, "next_flight_id", "next_flight_gap_min")


def track_heading(i: Inputs) -> DataFrame:
    return heading.track_heading(i.reports, slice_s=3600).withColumn("heading", F.round("heading", 6))


def ripple_effect(i: Inputs) -> DataFrame:
    return serving.ripple_effect(i.rippled_only())


def flight_impact(i: Inputs) -> DataFrame:
    shown = [c for c in serving.IMPACT_COLUMNS if c in S.LIVE_COLUMNS]
    return serving.flight_impact(i.rippled_only(*shown))


def ripple_active(i: Inputs) -> DataFrame:
    """Flights heard from within five minutes, over the rotations of the last 24 hours."""
    now = newest_timestamp(i.given)
    index = rotation.rotation_index(i.given, now=now)
    return serving.ripple_effect(live.with_ripple(live.live_state(i.given, now=now), index))


def ripple_effect_one(i: Inputs) -> DataFrame:
    return serving.ripple_effect(live.one_with_ripple(i.live, "F0-78929"))


def flight_impact_one(i: Inputs) -> DataFrame:
    return serving.flight_impact(live.one_with_ripple(i.live, "F0-78929"))


# --- aggregates ---


def batch_stats(i: Inputs) -> DataFrame:
    return summaries.batch_stats(i.given)


def aggregate_impact(i: Inputs) -> DataFrame:
    return summaries.aggregate_impact(i.rippled_only(*A.PERFORMANCE_INPUTS)).withColumns(
        {name: F.round(name, 6) for name in ("avg_fdi", "avg_res")}
    )


def airline_performance(i: Inputs) -> DataFrame:
    return i.performance


def dashboard_totals(i: Inputs) -> DataFrame:
    flights = live.live_state(i.given, columns=["delay_category"])
    return serving.dashboard_totals(flights, AL.scan_alerts(flights))


def delay_category_distribution(i: Inputs) -> DataFrame:
    return summaries.delay_category_distribution(i.labelled)


def label_summary(i: Inputs) -> DataFrame:
    return summaries.label_summary(i.labelled)


def error_distribution(i: Inputs) -> DataFrame:
    return summaries.error_distribution(i.rule_predicted)


def regression_metrics(i: Inputs) -> DataFrame:
    return summaries.regression_metrics(i.rule_predicted)


# --- served lists ---


def list_flights(i: Inputs) -> DataFrame:
    return serving.list_flights(
        i.rippled, airline="lni", delay_category="CRITICAL DELAY", fdi_category="HIGH"
    )


def list_flights_limited(i: Inputs) -> DataFrame:
    return serving.list_flights(i.rippled, res_category="MODERATE", limit=100)


def flight_detail(i: Inputs) -> DataFrame:
    return serving.flight_detail(i.live, "F0-78929")


def _stored_by_key(i: Inputs) -> DataFrame:
    path = new_folder(i.spark, "by-key")
    lookup.store(i.live, path, "flight_id", ("registration", "airline"))
    return i.spark.read.parquet(path)


def flight_lookup(i: Inputs) -> DataFrame:
    """One flight out of a live view that is stored for lookups by flight."""
    return serving.flight_detail(_stored_by_key(i), "F0-78929")


def aircraft_lookup(i: Inputs) -> DataFrame:
    """The flights of one aircraft out of the same table."""
    return _stored_by_key(i).filter(F.col("registration") == "PK-00042")


def list_airlines(i: Inputs) -> DataFrame:
    return A.list_airlines(i.performance, min_api_score=70, category="good", limit=500)


def airline_detail(i: Inputs) -> DataFrame:
    flights = live.live_state(i.given, columns=(*rotation.RIPPLE_INPUTS, *A.PERFORMANCE_INPUTS))
    return serving.airline_detail(live.airline_with_ripple(flights, "gia"), "gia")


def airline_ranking(i: Inputs) -> DataFrame:
    return A.rank_airlines(i.performance)


def top_airlines(i: Inputs) -> DataFrame:
    return A.top_airlines(i.performance)


def critical_alerts(i: Inputs) -> DataFrame:
    return AL.critical_alerts(live.live_columns(i.given))


def active_alerts(i: Inputs) -> DataFrame:
    return AL.critical_alerts(live.live_columns(i.given), now=newest_timestamp(i.given))


def alert_scan(i: Inputs) -> DataFrame:
    return AL.list_alerts(AL.scan_alerts(i.rippled))


def top_alerts(i: Inputs) -> DataFrame:
    return AL.top_alerts(AL.scan_alerts(i.rippled)).drop("alert_created_at")


def alert_severity(i: Inputs) -> DataFrame:
    return AL.add_severity(AL.scan_alerts(i.rippled_only("delay_category"))).select(
        "flight_id", "fdi", "res", "res_category", "fdi_severity", "ripple_advice"
    )


def kpi_header(i: Inputs) -> DataFrame:
    return summaries.kpi_header(aggregate_impact(i), batch_stats(i))


# --- streams ---


def _stream(i: Inputs, label: str):
    """Streaming messages of the log, and fresh folders for tables and checkpoints."""
    log = events.read_event_stream(i.spark, i.sf_dir)
    base = new_folder(i.spark, label)
    return events.messages(log), base, f"{base}/checkpoints"


def stream_silver(i: Inputs) -> DataFrame:
    source, base, checkpoints = _stream(i, "stream-silver")
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_silver(enriched, f"{base}/silver", checkpoints, jobs.ONCE))
    return i.spark.read.parquet(f"{base}/silver").select(*S.SILVER_COLUMNS)


def silver_compacted(i: Inputs) -> DataFrame:
    """Silver as the stream stores it, after its days up to the 20th were packed."""
    source, base, checkpoints = _stream(i, "silver-compacted")
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_silver(enriched, f"{base}/silver", checkpoints, jobs.ONCE))
    table = CompactedTable(f"{base}/silver", f"{base}/compacted", silver.EVENT_DATE)
    table.compact(i.spark, date(2024, 1, 20))
    return table.read(i.spark).select(*S.SILVER_COLUMNS)


def stream_fanout(i: Inputs) -> DataFrame:
    """Rows in each append sink after one run over the log."""
    source, base, checkpoints = _stream(i, "stream-fanout")
    parsed = envelopes.decode_reports(source)
    enriched = silver.enrich(parsed)
    jobs.drain(
        jobs.start_bronze(parsed, f"{base}/bronze", checkpoints, jobs.ONCE),
        jobs.start_silver(enriched, f"{base}/silver", checkpoints, jobs.ONCE),
        jobs.start_predictions(
            enriched, checkpoints, jobs.ONCE, "parquet", f"{base}/predictions"
        ),
    )
    sinks = ("bronze", "silver", "predictions")
    tagged = None
    for sink in sinks:
        rows = i.spark.read.parquet(f"{base}/{sink}").select(F.lit(sink).alias("sink"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    return tagged.agg(
        *[F.count_if(F.col("sink") == s).alias(f"{s.removesuffix('s')}_rows") for s in sinks]
    )


def stream_alerts(i: Inputs) -> DataFrame:
    """Flights whose latest report in the stream's alert table is critical, and how late."""
    source, base, checkpoints = _stream(i, "stream-alerts")
    tables = LiveTables(f"{base}/live", live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None)
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_live(enriched, tables, checkpoints, jobs.ONCE))
    return tables.alert_list(i.spark).select("flight_id", "timestamp", "predicted_delay_minutes")


def stream_rotations(i: Inputs) -> DataFrame:
    """The rotation index that the stream keeps."""
    source, base, checkpoints = _stream(i, "stream-rotations")
    tables = LiveTables(f"{base}/live", live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None)
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_live(enriched, tables, checkpoints, jobs.ONCE))
    return tables.rotation_list(i.spark).select("registration", "flight_id", "timestamp")


def stream_latest(i: Inputs) -> DataFrame:
    """The last report of each flight in each hour that has closed."""
    source, base, checkpoints = _stream(i, "stream-latest")
    latest = latest_reports(envelopes.decode_reports(source), every="1 hour", late="10 minutes")
    jobs.drain(jobs.start_bronze(latest, f"{base}/latest", checkpoints, jobs.ONCE))
    return i.spark.read.parquet(f"{base}/latest").select(*S.BRONZE_COLUMNS)


def stream_live_state(i: Inputs) -> DataFrame:
    source, base, checkpoints = _stream(i, "stream-live")
    tables = LiveTables(f"{base}/live", live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None)
    enriched = silver.enrich(envelopes.decode_reports(source))
    jobs.drain(jobs.start_live(enriched, tables, checkpoints, jobs.ONCE))
    return tables.flights(i.spark).select(*S.LIVE_COLUMNS)


def _board(i: Inputs) -> Dashboard:
    """The dashboard after two batches of the log; the second changes most flights of the first."""
    board = Dashboard(
        new_folder(i.spark, "dashboard"), live_ttl_s=None, rotation_ttl_s=None, alert_ttl_s=None
    )
    share = F.pmod(F.xxhash64(*ROW), F.lit(2))
    for batch in range(2):
        board.update(i.given.filter(share == batch), batch)
    return board


def dashboard_impact(i: Inputs) -> DataFrame:
    return _board(i).impact(i.spark).withColumns(
        {name: F.round(name, 6) for name in ("avg_fdi", "avg_res")}
    )


def dashboard_airlines(i: Inputs) -> DataFrame:
    return _board(i).airlines(i.spark)


def dashboard_live_totals(i: Inputs) -> DataFrame:
    return _board(i).totals(i.spark)


# --- models ---


def _delay_model(i: Inputs):
    fit, held_out = training.split(i.labelled, *ROW)
    return training.fit_delay(training.laid_out(fit, *ROW)), held_out


def ml_string_index(i: Inputs) -> DataFrame:
    """The number that the indexer gives each known category."""
    rows = training.without_blanks(i.labelled)
    numbered = training.delay_pipeline().getStages()[0].fit(rows).transform(rows)
    parts = [
        numbered.where(F.col(c).isNotNull())
        .select(F.lit(c).alias("category"), F.col(c).alias("value"), F.col(f"{c}_idx").cast("int").alias("number"))
        .distinct()
        for c in training.CATEGORIES
    ]
    return parts[0].unionByName(parts[1])


def ml_split(i: Inputs) -> DataFrame:
    """Which rows teach the model and which are held out."""
    fit, held_out = training.split(i.labelled, *ROW)
    return fit.select(*ROW, F.lit(True).alias("teaches")).unionByName(
        held_out.select(*ROW, F.lit(False).alias("teaches"))
    )


def ml_one_hot(i: Inputs) -> DataFrame:
    """The place of each known category in the vector that is scaled for the forest."""
    rows = training.without_blanks(i.labelled)
    stages = Pipeline(stages=training.delay_pipeline().getStages()[:3]).fit(rows)
    place = F.array_position(
        F.slice(vector_to_array("features_raw"), F.col("low") + 1, F.col("high") - F.col("low")), 1.0
    )
    parts, low = [], len(training.NUMERIC)
    for c, width in zip(training.CATEGORIES, stages.stages[1].categorySizes, strict=True):
        some = stages.transform(rows.where(F.col(c).isNotNull()))
        some = some.withColumns({"low": F.lit(low), "high": F.lit(low + width)})
        where = (F.col("low") + place - 1).cast("int")
        parts.append(some.select(F.lit(c).alias("category"), F.col(c).alias("value"), where.alias("place")).distinct())
        low += width
    return parts[0].unionByName(parts[1])


def ml_null_skip(i: Inputs) -> DataFrame:
    """Rows that the assembler keeps when wind is missing from some."""
    gone = F.col("altitude_ft") % 7 == 0
    rows = i.featured.withColumn("wind_knots", F.when(~gone, F.col("wind_knots")))
    assembler, _ = training.scaled(training.NUMERIC, "features")
    return assembler.transform(rows).select(*ROW)


def ml_scaler(i: Inputs) -> DataFrame:
    """Mean and deviation that the scaler takes from each numeric feature."""
    assembler, scaler = training.scaled(training.NUMERIC, "features")
    model = scaler.fit(assembler.transform(i.labelled))
    figures = zip(training.NUMERIC, model.mean.toArray(), model.std.toArray(), strict=True)
    rows = [(name, round(float(mean), 4), round(float(std), 4)) for name, mean, std in figures]
    return i.spark.createDataFrame(rows, "feature string, mean double, deviation double")


def ml_cluster_nearest(i: Inputs) -> DataFrame:
    """Rows of the cluster model, and those whose cluster has the nearest centre."""
    model = training.cluster_pipeline().fit(training.laid_out(i.featured, *ROW))
    centers = model.stages[-1].clusterCenters()
    place = vector_to_array("cluster_features")

    def distance(center) -> Column:
        return sum(((place[j] - float(x)) * (place[j] - float(x)) for j, x in enumerate(center)), F.lit(0.0))

    far = F.array(*[distance(c) for c in centers])
    own = F.element_at(far, F.col("spatial_cluster") + 1)
    return model.transform(i.featured).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(own <= F.array_min(far) + 1e-9).alias("nearest"),
    )


def ml_forest_walk(i: Inputs) -> DataFrame:
    """Rows scored by the forest, and those where walking its node table gives the same number."""
    model, _ = _delay_model(i)
    walker = forest.Forest.of(forest.node_table(i.spark, model))
    scored = training.predict_delay(model, i.labelled)
    walked = forest.predicted(walker, vector_to_array("features"))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") == walked).alias("equal")
    )


def ml_delay_predict(i: Inputs) -> DataFrame:
    model, held_out = _delay_model(i)
    return training.predict_delay(model, held_out).select(
        *ROW, training.LABEL, "prediction", "pred_category"
    )


def prediction_sample(i: Inputs) -> DataFrame:
    model, held_out = _delay_model(i)
    return summaries.prediction_sample(model.transform(held_out))


def spatial_clusters(i: Inputs) -> DataFrame:
    model = training.cluster_pipeline().fit(training.laid_out(i.featured, *ROW))
    return model.transform(i.featured).select(
        *ROW, "latitude", "longitude", "altitude_ft", "spatial_cluster"
    )


def stream_predict(i: Inputs) -> DataFrame:
    """Model inference on the stream: train on the log, score it as it streams in."""
    source, base, checkpoints = _stream(i, "stream-predict")
    delay_model, cluster_model = training.train(training.laid_out(i.labelled, *ROW))
    enriched = silver.enrich(
        envelopes.decode_reports(source), delay_model=delay_model, cluster_model=cluster_model
    )
    jobs.drain(jobs.start_silver(enriched, f"{base}/silver", checkpoints, jobs.ONCE))
    return i.spark.read.parquet(f"{base}/silver").select(*S.SILVER_COLUMNS)


QUERIES = {
    "src_events_parse": src_events_parse,
    "clean_flights": clean_flights,
    "bronze_projection": bronze_projection,
    "silver_projection": silver_projection,
    "feed_normalize": feed_normalize,
    "kafka_payload": kafka_payload,
    "kafka_payload_decoded": kafka_payload_decoded,
    "event_emission": event_emission,
    "event_emission_decoded": event_emission_decoded,
    "gold_json": gold_json,
    "gold_json_decoded": gold_json_decoded,
    "gold_summary": gold_summary,
    "base_features": _featured(
        "is_raining", "is_high_wind", "is_low_visibility", "is_bad_weather", "flight_phase",
        "is_slow", "speed_altitude_ratio", "is_peak_hour", "is_weekend",
    ),
    "weather_score": _featured("weather_score"),
    "distance_route": _featured("distance_km", "route_deviation"),
    "time_features": _featured(
        "hour_utc", "is_peak_hour", "day_of_week", "is_weekend", "traffic_density"
    ),
    "risk_score": _featured("risk_score_manual"),
    "rule_delay": rule_delay,
    "weather_condition": weather_condition,
    "safe_parse": safe_parse,
    "capacity_lookup": capacity_lookup,
    "capacity_join": capacity_join,
    "flight_delay_index": flight_delay_index,
    "compensation": compensation,
    "weather_asof_join": weather_asof_join,
    "airline_name_join": airline_name_join,
    "route_airport_join": route_airport_join,
    "rotation_self_join": rotation_self_join,
    **{f"gold_{name}": _gold(name) for name in gold.TABLES},
    "gold_date_range": gold_date_range,
    "gold_refresh_range": gold_refresh_range,
    "gold_by_name": gold_by_name,
    "gold_incremental": gold_incremental,
    "gold_incremental_routes": gold_incremental_routes,
    "bronze_odd_times": bronze_odd_times,
    "live_state": live_state,
    "live_active": live_active,
    "rotation_index": rotation_index,
    "rotation_recent": rotation_recent,
    "downstream_count": downstream_count,
    "next_flight": next_flight,
    "track_heading": track_heading,
    "ripple_effect": ripple_effect,
    "flight_impact": flight_impact,
    "ripple_active": ripple_active,
    "ripple_effect_one": ripple_effect_one,
    "flight_impact_one": flight_impact_one,
    "batch_stats": batch_stats,
    "aggregate_impact": aggregate_impact,
    "airline_performance": airline_performance,
    "dashboard_totals": dashboard_totals,
    "delay_category_distribution": delay_category_distribution,
    "label_summary": label_summary,
    "error_distribution": error_distribution,
    "regression_metrics": regression_metrics,
    "list_flights": list_flights,
    "list_flights_limited": list_flights_limited,
    "flight_detail": flight_detail,
    "flight_lookup": flight_lookup,
    "aircraft_lookup": aircraft_lookup,
    "list_airlines": list_airlines,
    "airline_detail": airline_detail,
    "airline_ranking": airline_ranking,
    "top_airlines": top_airlines,
    "critical_alerts": critical_alerts,
    "active_alerts": active_alerts,
    "alert_scan": alert_scan,
    "top_alerts": top_alerts,
    "alert_severity": alert_severity,
    "kpi_header": kpi_header,
    "stream_silver": stream_silver,
    "silver_compacted": silver_compacted,
    "stream_fanout": stream_fanout,
    "stream_latest": stream_latest,
    "stream_live_state": stream_live_state,
    "stream_alerts": stream_alerts,
    "stream_rotations": stream_rotations,
    "stream_predict": stream_predict,
    "dashboard_impact": dashboard_impact,
    "dashboard_airlines": dashboard_airlines,
    "dashboard_live_totals": dashboard_live_totals,
    "ml_string_index": ml_string_index,
    "ml_split": ml_split,
    "ml_one_hot": ml_one_hot,
    "ml_null_skip": ml_null_skip,
    "ml_scaler": ml_scaler,
    "ml_forest_walk": ml_forest_walk,
    "ml_cluster_nearest": ml_cluster_nearest,
    "ml_delay_predict": ml_delay_predict,
    "prediction_sample": prediction_sample,
    "spatial_clusters": spatial_clusters,
}
