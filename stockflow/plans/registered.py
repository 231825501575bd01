"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.fixed_values import NOT_AVAILABLE, PIPELINE
from stockflow.functions.numbers import decode_little_endian, encode_little_endian
from stockflow.functions.timestamps import date_parts, render
from stockflow.operators import metrics as M
from stockflow.operators import notify as N
from stockflow.operators import reports as R
from stockflow.operators import series as S
from stockflow.operators.forest_anomalies import grouped_anomalies, record_anomalies
from stockflow.operators.ingest import (
    as_messages,
    new_rows,
    next_batch_number,
    product_batch_id,
)
from stockflow.operators.moments import judge_new, table_of, with_stored_zscore
from stockflow.operators.moving_average import moving_average
from stockflow.operators.post_process import post_process, turnover_rate
from stockflow.operators.sampling import apply_overrides, outlier_overrides, sample_exact
from stockflow.operators.sketches import (
    MEASURES,
    RANK_ERROR,
    TIMES_ERROR,
    merged_sketches,
    read_sketches,
    run_sketches,
)
from stockflow.operators.zscore import GROUP, flagged, with_zscore, zscore_anomalies
from stockflow.plans.arima import arima_forecast
from stockflow.plans.forecasts import (
    baseline_forecast,
    boosted_forecast,
    trend_seasonal_forecast,
)
from stockflow.plans.grouped_forecasts import trend_seasonal_by_store
from stockflow.schemas import FORECASTS, INVENTORY
from stockflow.session import materialize, new_location
from stockflow.sources import adapters as A
from stockflow.sources import versions as V
from stockflow.sources.key_index import new_rows_indexed
from stockflow.sources.readers import read_table
from stockflow.sources.updates import fill_stored_actuals, override_stored
from stockflow.sources.writers import append, replace_model
from stockflow.streaming import jobs as J
from stockflow.streaming.state import unique_events_by_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Registers a function under ``name``."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def timed(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamp columns as text, as the stored tables keep them."""
    return df.withColumns({c: render(F.col(c)) for c in columns})


# --- metrics ----------------------------------------------------------------


@query("parse_events")
def parse_events(spark: SparkSession, folder: str) -> DataFrame:
    parsed = M.decode_messages(A.damaged_messages(A.inventory_events(spark, folder)))
    return timed(parsed, "ts")


@query("hourly_metrics")
def hourly_metrics(spark: SparkSession, folder: str) -> DataFrame:
    hourly = M.hourly_metrics(A.inventory_events(spark, folder))
    hourly = timed(hourly, "window_start", "window_end")
    return rounded(rounded(hourly, 8, "avg_price"), 2, "total_stock_value")


@query("flat_metrics")
def flat_metrics(spark: SparkSession, folder: str) -> DataFrame:
    flat = M.flat_metrics(A.inventory_events(spark, folder))
    return rounded(rounded(flat, 8, "avg_price"), 2, "total_stock_value")


@query("flat_metrics_by_event")
def flat_metrics_by_event(spark: SparkSession, folder: str) -> DataFrame:
    flat = M.flat_metrics_by_event(A.inventory_events(spark, folder))
    return rounded(rounded(flat, 8, "avg_price"), 2, "total_stock_value")


@query("category_stock")
def category_stock(spark: SparkSession, folder: str) -> DataFrame:
    hourly = M.hourly_metrics(A.inventory_events(spark, folder))
    return rounded(M.category_stock(hourly), 2, "stock_value_by_category")


@query("stock_metrics")
def stock_metrics(spark: SparkSession, folder: str) -> DataFrame:
    table = M.stock_metrics(A.inventory_events(spark, folder))
    table = rounded(table, 2, "total_stock_value", "stock_value_by_category")
    return rounded(table, 8, "avg_price")


@query("moving_average")
def moving_average_of_value(spark: SparkSession, folder: str) -> DataFrame:
    hourly = M.hourly_metrics(A.inventory_events(spark, folder))
    hourly = hourly.withColumnRenamed("window_start", "event_timestamp").drop("window_end")
    averaged = moving_average(hourly)
    return rounded(timed(averaged, "event_timestamp"), 4, "moving_avg_stock_value").select(
        "product_id", "store_location", "category", "event_timestamp", "moving_avg_stock_value"
    )


@query("turnover_rate")
def turnover(spark: SparkSession, folder: str) -> DataFrame:
    rated = turnover_rate(M.stock_metrics(A.inventory_events(spark, folder)))
    return rounded(rated, 12, "turnover_rate").select(
        "product_id", "store_location", "category", "event_timestamp", "turnover_rate"
    )


@query("post_processed_metrics")
def post_processed_metrics(spark: SparkSession, folder: str) -> DataFrame:
    table = post_process(M.stock_metrics(A.inventory_lines(spark, folder)))
    table = rounded(table, 2, "total_stock_value", "stock_value_by_category")
    table = rounded(table, 4, "moving_avg_stock_value")
    return rounded(rounded(table, 8, "avg_price"), 12, "turnover_rate")


# --- ingestion --------------------------------------------------------------


@query("ingest_new_rows")
def ingest_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines arrive; the finished ones are stored already."""
    lines = materialize(A.inventory_lines(spark, folder), "lines")
    stored = lines.filter(F.col("line_status") == "F").select(*INVENTORY.names)
    return new_rows(lines.select(*INVENTORY.names), stored)


@query("ingest_indexed")
def ingest_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same against a stored table whose files are found by their keys."""
    lines = materialize(A.inventory_lines(spark, folder), "lines")
    path = new_location(spark, "inventory")
    append(lines.filter(F.col("line_status") == "F"), path, INVENTORY)
    fresh, _ = new_rows_indexed(lines.select(*INVENTORY.names), path)
    return fresh


@query("publish_json")
def publish_json(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(A.inventory_lines(spark, folder))


@query("next_batch_number")
def next_batch(spark: SparkSession, folder: str) -> DataFrame:
    part = A.table(spark, folder, "part")
    batch_id = product_batch_id(F.col("p_partkey"), F.col("p_size"))
    return next_batch_number(part.select(batch_id.alias("product_id")))


def _sampled(lines: DataFrame) -> DataFrame:
    key = ["product_id", "event_timestamp", "store_location", "category", "quantity"]
    return sample_exact(lines, key=key)


@query("sample_exact")
def sample_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _sampled(A.inventory_lines(spark, folder).select(*INVENTORY.names))


@query("apply_overrides")
def override_sampled(spark: SparkSession, folder: str) -> DataFrame:
    lines = A.inventory_lines(spark, folder).select(*INVENTORY.names)
    lines = materialize(lines, "lines")
    return apply_overrides(lines, outlier_overrides(_sampled(lines)))


@query("apply_overrides_stored")
def override_stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a stored table, of which only touched files are rewritten."""
    path = new_location(spark, "inventory")
    append(A.inventory_lines(spark, folder), path, INVENTORY)
    stored = read_table(spark, path, INVENTORY)
    override_stored(spark, path, outlier_overrides(_sampled(stored)))
    return read_table(spark, path, INVENTORY)


@query("overridden_rows")
def overridden_rows(spark: SparkSession, folder: str) -> DataFrame:
    changed = override_sampled(spark, folder)
    return changed.filter((F.col("quantity") == 1000) & (F.col("price") == 5000.0))


# --- reports over metrics ---------------------------------------------------


@query("value_by_store")
def value_by_store(spark: SparkSession, folder: str) -> DataFrame:
    hourly = M.hourly_metrics(A.inventory_lines(spark, folder))
    return rounded(R.value_by_store(hourly), 1, "total_stock_value")


@query("turnover_over_time")
def turnover_over_time(spark: SparkSession, folder: str) -> DataFrame:
    rated = turnover_rate(M.stock_metrics(A.inventory_events(spark, folder)))
    return rounded(R.turnover_over_time(rated), 12, "turnover_rate")


@query("stock_pivot")
def stock_pivot(spark: SparkSession, folder: str) -> DataFrame:
    pivot = R.stock_pivot(M.hourly_metrics(A.inventory_events(spark, folder)))
    return rounded(pivot, 2, *[c for c in pivot.columns if c != "category"])


@query("quantity_price_points")
def quantity_price_points(spark: SparkSession, folder: str) -> DataFrame:
    points = R.quantity_price_points(M.stock_metrics(A.inventory_lines(spark, folder)))
    return rounded(rounded(points, 8, "avg_price"), 2, "total_stock_value")


@query("raw_preview")
def raw_preview(spark: SparkSession, folder: str) -> DataFrame:
    events = A.inventory_events(spark, folder).select(*INVENTORY.names)
    order = ["event_timestamp", "product_id", "store_location", "category", "quantity", "price"]
    return R.preview(events, order)


# --- series and forecasts ---------------------------------------------------


def _event_hours(spark: SparkSession, folder: str) -> DataFrame:
    return M.hourly_metrics(A.inventory_events(spark, folder))


def _written_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The same, evaluated once for all that reads them."""
    return materialize(_event_hours(spark, folder), "hours")


@query("store_series")
def store_series(spark: SparkSession, folder: str) -> DataFrame:
    return timed(S.store_series(_event_hours(spark, folder), "window_start"), "event_timestamp")


@query("global_series")
def global_series(spark: SparkSession, folder: str) -> DataFrame:
    return timed(S.global_series(_event_hours(spark, folder), "window_start"), "event_timestamp")


@query("series_extent")
def series_extent(spark: SparkSession, folder: str) -> DataFrame:
    extent = S.series_extent(_event_hours(spark, folder), "window_start")
    return timed(extent, "first_timestamp", "last_timestamp")


@query("holdout_split")
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    split = S.holdout_split(S.store_series(_event_hours(spark, folder), "window_start"))
    split = timed(split, "last_timestamp", "previous_timestamp")
    return rounded(split, 6, "fallback_quantity")


@query("forecast_horizon")
def forecast_horizon(spark: SparkSession, folder: str) -> DataFrame:
    days = S.horizon(_event_hours(spark, folder), time="window_start")
    days = days.select("*", *date_parts(F.col("forecast_timestamp")))
    return timed(days, "last_timestamp", "forecast_timestamp")


def _day_ahead(spark: SparkSession, folder: str, hourly: DataFrame | None = None) -> DataFrame:
    hourly = hourly or _written_hours(spark, folder)
    keys = ["store_location", "category", "forecast_timestamp"]
    return S.attach_actuals(A.day_ahead_forecasts(hourly), A.observed_quantities(hourly), keys)


@query("attach_actuals")
def attach_actuals(spark: SparkSession, folder: str) -> DataFrame:
    return _day_ahead(spark, folder)


@query("attach_actuals_stored")
def attach_actuals_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same on a stored forecast table, of which only touched files are rewritten."""
    hourly = _written_hours(spark, folder)
    path = new_location(spark, "forecasts")
    replace_model(A.day_ahead_forecasts(hourly), path)
    keys = ["store_location", "category", "forecast_timestamp"]
    fill_stored_actuals(spark, path, A.observed_quantities(hourly), keys)
    return read_table(spark, path, FORECASTS).select(*FORECASTS.names)


@query("predicted_vs_actual")
def predicted_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    return R.predicted_vs_actual(_day_ahead(spark, folder))


@query("predicted_over_time")
def predicted_over_time(spark: SparkSession, folder: str) -> DataFrame:
    return R.predicted_over_time(A.stand_in_forecasts(_event_hours(spark, folder)))


@query("forecast_summary")
def forecast_summary(spark: SparkSession, folder: str) -> DataFrame:
    both = A.stand_in_forecasts(_event_hours(spark, folder)).unionByName(_day_ahead(spark, folder))
    summary = R.forecast_summary(materialize(both, "forecasts"), "day-ahead")
    return rounded(summary, 6, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("forecast_summary_sketched")
def forecast_summary_sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of single days merged over all days, and whether what they say lies
    within their errors: shares of rows below each quartile, and distinct times."""
    forecasts = _day_ahead(spark, folder)
    day = F.substring("forecast_timestamp", 1, 10)
    forecasts = materialize(forecasts.withColumn("day", day), "forecasts")
    daily = materialize(run_sketches(forecasts, ["model_name", "day"]), "sketches")
    found = read_sketches(merged_sketches(daily, ["model_name"]))
    rows = forecasts.select(
        "model_name",
        "forecast_timestamp",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("v")) for m in MEASURES])
        ).alias("m"),
    ).select("model_name", "forecast_timestamp", "m.*")
    checked = rows.join(F.broadcast(found), ["model_name", "measure"])  # two rows a model
    within = [
        (
            (F.count_if(F.col("v") < F.col(p)) <= (share + RANK_ERROR) * F.count("v"))
            & (F.count_if(F.col("v") <= F.col(p)) >= (share - RANK_ERROR) * F.count("v"))
        ).alias(f"{p}_within")
        for p, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    times = F.count_distinct("forecast_timestamp")
    close = F.abs(F.first("unique_timestamps") - times) <= TIMES_ERROR * times
    return checked.groupBy("model_name", "measure").agg(
        F.first("count").alias("count"),
        F.first("min").alias("min"),
        F.first("max").alias("max"),
        *within,
        close.alias("times_within"),
    )


@query("decode_le_bytes")
def decode_le_bytes(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    stored = A.table(spark, folder, "lineitem").select(
        encode_little_endian(number).alias("actual_quantity")
    )
    return stored.select(decode_little_endian(F.col("actual_quantity")).alias("actual_quantity"))


@query("decode_le_bytes_by_version")
def decode_by_version(spark: SparkSession, folder: str) -> DataFrame:
    """The same from a table whose first half holds bytes and whose second numbers."""
    number = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    lines = A.table(spark, folder, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    stored = lines.filter(odd).select(encode_little_endian(number).alias("actual_quantity"))
    path = new_location(spark, "quantities")
    V.create(spark, path, stored.schema)
    V.append_version(stored, path)
    V.change_column_type(spark, path, "actual_quantity", T.LongType())
    V.append_version(lines.filter(~odd).select(number.alias("actual_quantity")), path)
    return V.read_versions(spark, path)


@query("arima_forecast")
def arima(spark: SparkSession, folder: str) -> DataFrame:
    forecast = arima_forecast(_event_hours(spark, folder), "window_start")
    return timed(forecast, "forecast_timestamp", "event_timestamp")


@query("gbt_forecast")
def boosted_trees(spark: SparkSession, folder: str) -> DataFrame:
    forecast = boosted_forecast(_event_hours(spark, folder), "window_start")
    return timed(forecast, "forecast_timestamp", "event_timestamp")


@query("iforest_baseline_forecast")
def outlier_filtered_baseline(spark: SparkSession, folder: str) -> DataFrame:
    table = post_process(M.stock_metrics(A.inventory_events(spark, folder)))
    table = table.withColumn("event_timestamp", F.to_timestamp("event_timestamp"))
    forecast = baseline_forecast(materialize(table, "metrics"))
    return timed(forecast, "forecast_timestamp", "event_timestamp")


@query("trend_seasonal_forecast")
def trend_and_season(spark: SparkSession, folder: str) -> DataFrame:
    forecast = trend_seasonal_forecast(_event_hours(spark, folder), "window_start")
    return timed(forecast, "forecast_timestamp", "event_timestamp")


@query("trend_seasonal_by_store")
def trend_and_season_by_store(spark: SparkSession, folder: str) -> DataFrame:
    forecast = trend_seasonal_by_store(_event_hours(spark, folder), "window_start")
    return timed(forecast, "forecast_timestamp", "event_timestamp")


# --- anomalies --------------------------------------------------------------


def _zscore(spark: SparkSession, folder: str, hourly: DataFrame | None = None) -> DataFrame:
    hourly = hourly or _written_hours(spark, folder)
    return zscore_anomalies(A.stand_in_forecasts(hourly))


def _numerical(spark: SparkSession, folder: str, hourly: DataFrame | None = None) -> DataFrame:
    forecasts = materialize(_day_ahead(spark, folder, hourly), "forecasts")
    return A.as_numerical(zscore_anomalies(forecasts))


@query("zscore_anomalies")
def zscore_flags(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_zscore(spark, folder), 6, "score")


@query("zscore_anomalies_by_batch")
def zscore_flags_of_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows from the stored figures of four batches."""
    forecasts = materialize(A.stand_in_forecasts(_written_hours(spark, folder)), "forecasts")
    batch = F.pmod(F.xxhash64(*forecasts.columns), F.lit(4))
    path = new_location(spark, "figures")
    for number in range(4):
        judge_new(spark, forecasts.filter(batch == number), path)
    figures = read_table(spark, path, table_of(GROUP))
    return rounded(flagged(with_stored_zscore(forecasts, figures)), 6, "score")


@query("flagged_per_group")
def flagged_per_group(spark: SparkSession, folder: str) -> DataFrame:
    scored = with_zscore(A.stand_in_forecasts(_event_hours(spark, folder)))
    return scored.groupBy("store_location", "category").agg(
        F.max("group_size").alias("group_size"),
        F.count_if(F.round(F.abs("z_score"), 9) > 1.5).alias("flagged"),
    )


@query("anomalies_by_store")
def anomalies_by_store(spark: SparkSession, folder: str) -> DataFrame:
    return R.counts_by(_zscore(spark, folder), "store_location")


@query("anomalies_by_category")
def anomalies_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return R.counts_by(_zscore(spark, folder), "category")


@query("iforest_group_anomalies")
def forest_flags_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return grouped_anomalies(materialize(_day_ahead(spark, folder), "forecasts"))


@query("iforest_record_anomalies")
def forest_flags_of_records(spark: SparkSession, folder: str) -> DataFrame:
    return record_anomalies(A.inventory_lines(spark, folder))


# --- notifications ----------------------------------------------------------


def _all_notifications(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _written_hours(spark, folder)
    return N.all_notifications(_zscore(spark, folder, hourly), _numerical(spark, folder, hourly))


@query("notifications_numerical")
def notifications_numerical(spark: SparkSession, folder: str) -> DataFrame:
    return N.numerical_notifications(_numerical(spark, folder))


@query("notifications_zscore")
def notifications_zscore(spark: SparkSession, folder: str) -> DataFrame:
    return N.pipeline_notifications(_zscore(spark, folder))


@query("notifications_all")
def notifications_all(spark: SparkSession, folder: str) -> DataFrame:
    return _all_notifications(spark, folder)


@query("category_backfill")
def category_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Notifications of the old layout, and free texts that name no category."""
    texts = A.table(spark, folder, "conversations").select(
        F.lit(PIPELINE).alias("type"),
        F.col("text").alias("notification"),
        F.lit("none").alias("store_location"),
        F.col("role").alias("event_timestamp"),
        F.lit(NOT_AVAILABLE).alias("product_id"),
    )
    old = _all_notifications(spark, folder).drop("category").unionByName(texts)
    return N.backfill_category(old)


def _rollup_rows(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _event_hours(spark, folder)
    by_store = S.forecast_rows(
        timed(S.store_series(hourly, "window_start"), "event_timestamp"),
        "store series",
        forecast_time=F.col("event_timestamp"),
        predicted=F.col("quantity"),
        event_time=F.col("event_timestamp"),
        store=F.col("store_location"),
    )
    overall = S.forecast_rows(
        timed(S.global_series(hourly, "window_start"), "event_timestamp"),
        "global series",
        forecast_time=F.col("event_timestamp"),
        predicted=F.col("quantity"),
        event_time=F.col("event_timestamp"),
    )
    return by_store.unionByName(overall)


@query("rollup_marker_check")
def rollup_marker_check(spark: SparkSession, folder: str) -> DataFrame:
    checks = {"zscore": _zscore(spark, folder), "rollup": _rollup_rows(spark, folder)}
    first, second = [
        N.has_rollup_marker(rows).withColumn("table_name", F.lit(name))
        for name, rows in checks.items()
    ]
    return first.unionByName(second)


@query("drill_down")
def drill_down(spark: SparkSession, folder: str) -> DataFrame:
    key = ["model_name", "store_location", "forecast_timestamp"]
    return N.drill_down(_rollup_rows(spark, folder), key=key)


@query("detail_lookup")
def detail_lookup(spark: SparkSession, folder: str) -> DataFrame:
    hourly = _written_hours(spark, folder)
    pipeline = materialize(_zscore(spark, folder, hourly), "anomalies")
    numerical = materialize(_numerical(spark, folder, hourly), "numerical_anomalies")
    found = N.detail_lookup(
        N.all_notifications(pipeline, numerical), N.tagged_anomalies(pipeline, numerical)
    )
    return rounded(found, 6, "score")


@query("route_questions")
def route_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns, anomaly descriptions and notifications as questions."""
    turns = A.table(spark, folder, "conversations").select("text")
    zscore = materialize(_zscore(spark, folder), "anomalies")
    said = zscore.select(F.col("description").alias("text"))
    told = N.pipeline_notifications(zscore).select(F.col("notification").alias("text"))
    return N.route_questions(turns.unionByName(said).unionByName(told))


# --- streams ----------------------------------------------------------------


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return J.read_file_stream(spark, f"{folder}/events.parquet*", A.EVENTS_SCHEMA, files=1)


@query("stream_hourly_metrics")
def stream_hourly_metrics(spark: SparkSession, folder: str) -> DataFrame:
    events = A.events_as_inventory(_event_stream(spark, folder))
    hourly = J.streamed_hourly_metrics(events, new_location(spark, "hourly"))
    hourly = timed(hourly, "window_start", "window_end")
    return rounded(rounded(hourly, 8, "avg_price"), 2, "total_stock_value")


def _line_stream(spark: SparkSession, folder: str) -> DataFrame:
    lines = J.read_file_stream(spark, f"{folder}/lineitem.parquet*", A.LINEITEM_SCHEMA, files=1)
    dimensions = [A.table(spark, folder, name) for name in ("part", "supplier", "nation")]
    return A.lines_as_inventory(lines, *dimensions)


@query("stream_dedup")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    unique = J.streamed_unique_events(_line_stream(spark, folder), new_location(spark, "unique"))
    return unique.select("product_id", "event_timestamp", "store_location")


@query("stream_dedup_by_state")
def stream_dedup_by_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same from keyed state, without reading what is stored."""
    events = _line_stream(spark, folder).select(*INVENTORY.names)
    unique = unique_events_by_state(events, new_location(spark, "unique"))
    return unique.select("product_id", "event_timestamp", "store_location")
