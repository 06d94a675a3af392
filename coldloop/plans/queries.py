"""One registered query per operator, over the whole event table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldloop.config import FEATURES, OPTIMISATION_COLUMNS, TwinConfig
from coldloop.functions.calendar import date_text, epoch_micros, timestamp_text
from coldloop.functions.numeric import half_even
from coldloop.operators import days as D
from coldloop.operators import (
    batched, cadence, calls, evaluate, kpi, learning, metrics, recurrent, registry, sequences,
    tables,
)
from coldloop.operators.artifacts import MeanArtifact
from coldloop.operators.cadence import to_cadence
from coldloop.operators.layout import Layout
from coldloop.operators.ordering import (
    positions_by_range, positions_by_segment, with_positions,
)
from coldloop.operators.pages import PageIndex
from coldloop.operators.routed import extended, summarise
from coldloop.operators.scorers import ModelPower, PowerLine, array_mean_udf
from coldloop.operators.slopes import slope_degrees, with_rolling_slopes, with_slopes
from coldloop.plans.twin import (
    controlled, forecast, twin_date, twin_days, twin_from_frames, twin_routed,
)
from coldloop.session import scratch_path
from coldloop.sources import results
from coldloop.sources.readings import from_events, read_events, with_time_features
from coldloop.streaming.keyed import KeyedTwin, run_available

CFG = TwinConfig()
RECORDED = ("T_ext", "T_int", "Etat_Compresseur", "Puissance_Elec_kW")
DAY_ROW = ("asset_id", "d", "k")
TWIN_COLUMNS = DAY_ROW + ("timestamp",) + FEATURES + (
    "Puissance_Elec_kW", "t_int_pred", "pwr_pred_ia", "t_int_opt", "etat_opt",
    "pente_chauffe", "pente_froid", "pwr_opt")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def edge(df: DataFrame, *columns: str) -> DataFrame:
    """Plain output types: dates and timestamps as text, whole numbers as bigint."""
    df = df.select(*columns) if columns else df
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            col = date_text(col)
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            col = timestamp_text(col)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        out.append(col.alias(f.name))
    return df.select(*out)


def six(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c).cast("double"), 6) for c in columns})


CYCLIC = ("day_sin", "day_cos", "hour_sin", "hour_cos")


# Readings, order and features ------------------------------------------------------------


@register
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_positions(read_events(spark, sf_dir))
    return edge(rows, "asset_id", "reading_id", "timestamp", "d", "pos", *RECORDED)


@register
def readings_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by ten-minute segments, the way large assets are numbered."""
    rows = positions_by_segment(read_events(spark, sf_dir), 600)
    return edge(rows, "asset_id", "reading_id", "timestamp", "d", "pos", *RECORDED)


@register
def readings_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions by a global sort, the way crowded segments are numbered."""
    rows = positions_by_range(read_events(spark, sf_dir))
    return edge(rows, "asset_id", "reading_id", "timestamp", "d", "pos", *RECORDED)


@register
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_time_features(with_positions(read_events(spark, sf_dir)))
    return edge(six(rows, *CYCLIC), "asset_id", "reading_id", "timestamp", *FEATURES)


@register
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    rows = with_time_features(with_positions(source))
    scaled = sequences.Scaler.fit(source).apply(rows)
    return edge(six(scaled, *FEATURES), "asset_id", "reading_id", *FEATURES)


@register
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    counts = source.groupBy("asset_id").agg(
        F.count("*").alias("readings"), F.countDistinct("d").alias("dates"))
    rows = D.day_frames(source, CFG).slices(CFG).groupBy("asset_id").agg(
        F.count("*").alias("slice_rows"))
    joined = counts.join(rows, "asset_id", "left")
    return joined.select("asset_id", "readings", "dates",
                         F.coalesce("slice_rows", F.lit(0)).alias("slice_rows"),
                         F.col("slice_rows").isNull().alias("is_empty"))


# Days ------------------------------------------------------------------------------------


def _frames(spark: SparkSession, sf_dir: str, assets: int | None = 2) -> D.Frames:
    return D.day_frames(read_events(spark, sf_dir, assets), CFG)


def _requests(days: DataFrame) -> DataFrame:
    """Requested asset-days: every indexed date, 15 days on, so that some do not exist."""
    return days.select("asset_id", F.date_add("d", 15).alias("d"))


@register
def day_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(D.day_index(read_events(spark, sf_dir)))


@register
def day_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = D.day_index(read_events(spark, sf_dir))
    return edge(D.lookup_days(_requests(days), days))


@register
def day_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = D.day_index(read_events(spark, sf_dir))
    return edge(D.reject_days(_requests(days), days))


@register
def day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _frames(spark, sf_dir).slices(CFG)
    return edge(rows, *DAY_ROW, "pos", "timestamp", *RECORDED)


@register
def day_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeded = D.with_seed(_frames(spark, sf_dir)).df.where("k = 0")
    return edge(seeded, "asset_id", "d", "t_init", "etat_init")


@register
def day_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(tables.day_labels(D.day_index(read_events(spark, sf_dir))))


@register
def lookback_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    frames = D.with_lag_feature(D.day_frames(source, CFG)).map(with_time_features)
    scaled = frames.map(sequences.Scaler.fit(source).apply)
    rows = sequences.with_lookback(scaled, CFG).slices(CFG)
    return edge(six(sequences.lookback_values(rows), "value"))


# Forecast, slopes, controller ------------------------------------------------------------


@register
def thermal_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(forecast(_frames(spark, sf_dir), CFG), *DAY_ROW, "t_int_pred")


@register
def pandas_udf_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = forecast(_frames(spark, sf_dir), CFG, array_mean_udf(CFG.lookback))
    return edge(scored, *DAY_ROW, "t_int_pred")


@register
def batched_scorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean forecast by a stored artifact that each worker opens once, in Arrow batches."""
    path = scratch_path(spark, "artifact")
    batched.save(spark, MeanArtifact([1] * CFG.lookback), path)
    scorer = batched.batched(spark, batched.load(spark, path))
    return edge(forecast(_frames(spark, sf_dir), CFG, scorer), *DAY_ROW, "t_int_pred")


@register
def energy_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    scored = PowerLine.fit(source).apply(
        forecast(D.day_frames(source, CFG), CFG), "t_int_pred", "Etat_Compresseur", "pwr_pred_ia")
    return edge(scored, *DAY_ROW, "t_int_pred", "Etat_Compresseur", "pwr_pred_ia")


@register
def slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = slope_degrees(with_slopes(forecast(_frames(spark, sf_dir), CFG)))
    return edge(rows, *DAY_ROW, "heating", "slope")


@register
def rolling_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_rolling_slopes(with_slopes(forecast(_frames(spark, sf_dir), CFG)), CFG)
    return edge(rows, *DAY_ROW, "pente_chauffe", "pente_froid")


@register
def hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = controlled(forecast(_frames(spark, sf_dir), CFG), CFG)
    return edge(rows, *DAY_ROW, "t_int_opt", "etat_opt")


def _twin(spark: SparkSession, sf_dir: str, assets: int | None = 2) -> DataFrame:
    return twin_days(read_events(spark, sf_dir, assets), CFG)


@register
def energy_optimised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(_twin(spark, sf_dir), *DAY_ROW, "t_int_opt", "etat_opt", "pwr_opt")


def full_twin(source: DataFrame, frames: D.Frames) -> DataFrame:
    frames = D.with_lag_feature(frames).map(with_time_features)
    return edge(six(twin_from_frames(frames, PowerLine.fit(source), CFG), *CYCLIC), *TWIN_COLUMNS)


@register
def twin_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    return full_twin(source, D.day_frames(source, CFG))


def _routed(source: DataFrame, target: Callable[[Layout], int]) -> DataFrame:
    """The twin with each asset's own plan, for another target size."""
    summary = summarise(source)
    layout = replace(summary.layout, target_rows=max(1, target(summary.layout)))
    rows = twin_routed(
        source, replace(summary, layout=layout), CFG,
        prepare=lambda frames: D.with_lag_feature(frames).map(with_time_features))
    return edge(six(rows, *CYCLIC), *TWIN_COLUMNS)


@register
def twin_day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for crowded days; small tables lower the target so that theirs are, too."""
    return _routed(read_events(spark, sf_dir),
                   lambda layout: min(layout.target_rows, layout.busiest_day // 4))


@register
def twin_day_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans by asset: the largest asset is split by day, the smaller ones are ordered whole."""
    return _routed(read_events(spark, sf_dir), lambda layout: layout.busiest_asset - 1)


@register
def twin_day_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twin on ten-minute means of all readings, where the day cap leaves nothing out."""
    source = to_cadence(read_events(spark, sf_dir))
    return full_twin(source, D.day_frames(source, CFG))


@register
def day_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that the day cap leaves out of the uncondensed table."""
    return edge(cadence.day_overflow(D.day_index(read_events(spark, sf_dir)), CFG))


@register
def fleet_twin_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user an asset of its own: many assets with sparse days."""
    source = read_events(spark, sf_dir, assets=None)
    return full_twin(source, D.day_frames(source, CFG))


@register
def fleet_twin_day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse days: every asset with more readings than the fullest day has is split by day."""
    return _routed(read_events(spark, sf_dir, assets=None), lambda layout: layout.busiest_day)


@register
def twin_latest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for one date, the newest one, answered from a stored index of all dates.

    The index comes in two parts: the earlier readings, and the last ten days added to it.
    """
    source = read_events(spark, sf_dir)
    newest = source.agg(F.max("d")).first()[0]
    added = F.col("d") > F.date_sub(F.lit(newest), 10)
    summary = extended(summarise(source.where(~added)), source.where(added))
    rows = twin_date(source, newest, summary.power_lines(), CFG, index=summary.index())
    return edge(rows, *DAY_ROW, "t_int_pred", "pwr_pred_ia", "t_int_opt", "etat_opt", "pwr_opt")


# Figures and tables ----------------------------------------------------------------------


@register
def day_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.kpis(_twin(spark, sf_dir), cfg=CFG))


@register
def day_kpi_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.kpis(_twin(spark, sf_dir), cfg=CFG, optimise=False))


@register
def fleet_day_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.kpis(_twin(spark, sf_dir, assets=None), cfg=CFG))


@register
def running_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.running_kpis(_twin(spark, sf_dir), CFG))


@register
def kpi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.kpi_labels(kpi.kpis(_twin(spark, sf_dir), cfg=CFG)))


@register
def switch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.switch_events(_twin(spark, sf_dir)))


@register
def day_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.day_series(_twin(spark, sf_dir), CFG))


@register
def day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to JSON records and back."""
    series = kpi.day_series(_twin(spark, sf_dir), CFG)
    records = tables.to_records(series, list(D.KEY))
    return edge(tables.from_records(records, series.schema))


@register
def optimisation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.optimisation_rows(_twin(spark, sf_dir)).drop("d")
    return edge(tables.rounded(tables.newest_first(rows)))


@register
def optimisation_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.optimisation_rows(_twin(spark, sf_dir)).drop("d")
    return edge(tables.rounded(tables.page(rows, 2)))


@register
def optimisation_page_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first, the middle and the last page, each from the parts that hold it."""
    rows = tables.optimisation_rows(_twin(spark, sf_dir)).drop("d")
    index = PageIndex.build(rows, scratch_path(spark, "pages"))
    last = max(index.pages() - 1, 0)
    shown = [tables.rounded(index.page(number)).withColumn("page", F.lit(number).cast("bigint"))
             for number in sorted({0, last // 2, last})]
    return edge(reduce(DataFrame.unionByName, shown))


@register
def optimisation_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = results.OptimisationStore(spark, scratch_path(spark, "optimisations"))
    store.create()
    store.upsert(tables.optimisation_rows(_twin(spark, sf_dir)))
    return edge(store.read(), "asset_id", *OPTIMISATION_COLUMNS)


@register
def optimisation_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two results are stored one after the other; the table holds and shows the latest."""
    rows = tables.optimisation_rows(_twin(spark, sf_dir))
    cutoff = evaluate.split_date(read_events(spark, sf_dir), 0.5)
    store = results.OptimisationStore(spark, scratch_path(spark, "optimisations"))
    store.create()
    store.replace(rows.where(F.col("d") < F.lit(cutoff)))
    store.replace(rows.where(F.col("d") >= F.lit(cutoff)))
    return edge(tables.rounded(tables.newest_first(store.read().drop("d"))))


@register
def optimisation_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets stored one after the other on the same dates; each keeps its own rows."""
    rows = tables.optimisation_rows(_twin(spark, sf_dir)).persist()
    store = results.OptimisationStore(spark, scratch_path(spark, "optimisations"))
    store.create()
    for asset in (0, 1, 0):
        store.upsert(rows.where(F.col("asset_id") == asset))
    rows.unpersist()
    return edge(store.read(), "asset_id", *OPTIMISATION_COLUMNS)


def _cadence_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twin of ten-minute means: a day is its 144 rows, so the cap leaves out no reading."""
    return twin_days(to_cadence(read_events(spark, sf_dir)), CFG)


@register
def day_kpi_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(kpi.kpis(_cadence_twin(spark, sf_dir), cfg=CFG))


@register
def optimisation_sink_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = results.OptimisationStore(spark, scratch_path(spark, "optimisations"))
    store.create()
    store.upsert(tables.optimisation_rows(_cadence_twin(spark, sf_dir)))
    return edge(store.read(), "asset_id", *OPTIMISATION_COLUMNS)


@register
def variant_sweep_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = to_cadence(read_events(spark, sf_dir))
    return edge(evaluate.variant_kpis(source, D.day_frames(source, CFG), CFG))


@register
def simulation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_time_features(_frames(spark, sf_dir).slices(CFG))
    return edge(tables.simulation_table(six(rows, *CYCLIC)))


@register
def result_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the dates are asked for first, then all: only the rest is computed."""
    source = read_events(spark, sf_dir)
    power = PowerLine.fit(source)

    def compute(wanted: DataFrame) -> DataFrame:
        return kpi.kpis(twin_days(source, CFG, power=power, wanted=wanted), cfg=CFG)

    days = D.day_index(source).select(*D.KEY)
    cutoff = evaluate.split_date(source, 0.5)
    cache = results.DayCache(spark, scratch_path(spark, "day-cache"), compute(days).schema)
    cache.fetch(days.where(F.col("d") < F.lit(cutoff)), "default", compute)
    return edge(cache.fetch(days, "default", compute))


# Models ----------------------------------------------------------------------------------


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    frames = D.day_frames(source, CFG)
    return evaluate.model_errors(source, frames, evaluate.split_date(source))


@register
def model_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(_errors(spark, sf_dir))


@register
def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(evaluate.leaderboard(_errors(spark, sf_dir), registry.registry(spark)))


@register
def model_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows and paths of the labels that readings are dealt to, with their numbers."""
    labels = F.array(*(F.lit(f" {label} ") for _, label, _ in registry.MODELS))
    dealt = read_events(spark, sf_dir).select(
        F.element_at(labels, (F.col("reading_id") % len(registry.MODELS) + 1).cast("int"))
        .alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    found = registry.with_paths(registry.lookup(dealt, registry.registry(spark), "name"))
    return edge(found, "family", "label", "artifact", "model_path", "scaler_path",
                "picture_path", "importance_path", "curve_path", "n")


@register
def metrics_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured errors written as CSV, then read without a header and tagged by family."""
    path = scratch_path(spark, "metrics")
    text = {m: F.format_string("%.4f", half_even(F.col(m), 4)) for m in ("mae", "rmse")}
    results.write_metrics(_errors(spark, sf_dir).withColumns(text), path)
    rows = results.read_metrics(spark, path)
    return rows.withColumn("family", registry.family_tag(F.col("model")))


@register
def variant_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = read_events(spark, sf_dir)
    return edge(evaluate.variant_kpis(source, D.day_frames(source, CFG), CFG))


@register
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_counts(_twin(spark, sf_dir))


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days scored by the stored means behind the four thermal labels, one call each."""
    models = {}
    for label, (steps, recency) in evaluate.thermal_shapes().items():
        path = scratch_path(spark, "artifact")
        batched.save(spark, MeanArtifact(range(1, steps + 1) if recency else [1] * steps), path)
        models[label] = batched.load(spark, path)
    scored, path = calls.measured(spark, _frames(spark, sf_dir), models, CFG), scratch_path(
        spark, "measured")
    scored.write.parquet(path)
    return spark.read.schema(scored.schema).parquet(path)


@register
def measured_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(_measured(spark, sf_dir), *DAY_ROW, "model", "t_int_pred")


@register
def scoring_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured calls per model and day, beside the calls that the model's histogram holds."""
    scored = _measured(spark, sf_dir)
    held = calls.latency_histogram(scored).where(F.col("le") == float("inf")).select(
        "model", F.col("calls").alias("in_histogram"))
    found = calls.day_calls(scored).join(F.broadcast(held), "model")
    return edge(found.withColumn("timed", (F.col("seconds") > 0) & F.col("loaded_at").isNotNull()),
                "model", "asset_id", "d", "calls", "rows_asked", "rows_scored", "in_histogram",
                "timed")


@register
def thermal_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear regression on the lookback: trained on earlier dates, scored on later ones."""
    source = read_events(spark, sf_dir)
    cutoff = evaluate.split_date(source)
    scaler_path = scratch_path(spark, "scaler")
    sequences.Scaler.fit(source.where(F.col("d") < F.lit(cutoff))).save(spark, scaler_path)
    vectors = learning.lookback_vectors(
        D.day_frames(source, CFG), sequences.Scaler.load(spark, scaler_path), CFG)
    model = learning.save_and_load(
        learning.train_thermal(vectors, cutoff), source, "thermal-model")
    later = learning.score_thermal(model, vectors.where(F.col("d") >= F.lit(cutoff)))
    return edge(six(later, "t_int_pred"), *DAY_ROW, "t_int_pred")


@register
def thermal_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four trained thermal models, stored and loaded by label; which later rows they score."""
    source = read_events(spark, sf_dir)
    cutoff, root = evaluate.split_date(source), scratch_path(spark, "models")
    frames, parts = D.day_frames(source, CFG), []
    for label in evaluate.thermal_variants():
        recurrent.save(recurrent.train(frames, cutoff, label, CFG), spark, root, label)
        scored = forecast(frames, CFG, recurrent.trained(recurrent.load(spark, root, label)))
        parts.append(scored.where(F.col("d") >= F.lit(cutoff)).select(
            *DAY_ROW, F.lit(label).alias("label"), F.col("t_int_pred").isNotNull().alias("scored")))
    return edge(reduce(DataFrame.unionByName, parts))


@register
def energy_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees of each registered depth: trained on earlier dates, scored on later ones."""
    source = read_events(spark, sf_dir)
    cutoff = evaluate.split_date(source)
    scored = forecast(D.day_frames(source, CFG), CFG).where(F.col("d") >= F.lit(cutoff))
    names = []
    cells = learning.power_cells(learning.power_rows(source, cutoff)).coalesce(1).persist()
    for depth in evaluate.DEPTHS:
        model = learning.save_and_load(
            learning.train_power_cells(cells, depth), source, f"power-model-{depth}")
        names.append(f"pwr_depth_{depth}")
        scored = ModelPower(model).apply(scored, "t_int_pred", "Etat_Compresseur", names[-1])
    cells.unpersist()
    return edge(six(scored, *names), *DAY_ROW, *names)


# Events are dealt to files of ten days; six in seven go by up to six hours later.
STREAM_FILE, STREAM_SHIFT = dt.timedelta(days=10), dt.timedelta(hours=6)


def _streamed(spark: SparkSession, sf_dir: str,
              allowance: dt.timedelta) -> tuple[KeyedTwin, DataFrame]:
    """A period after the other, each as the same number of files, which are one batch."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sent = epoch_micros(F.col("ts")) + (F.col("event_id") % 7) * F.lit(
        int(STREAM_SHIFT.total_seconds() * 1e6) // 6)
    width = int(STREAM_FILE.total_seconds() * 1e6)
    dealt = events.withColumn("file", F.floor(sent / F.lit(width))).persist()
    periods = dealt.groupBy("file").agg(F.count("*").alias("n")).orderBy("file").collect()
    least = min((p.n for p in periods), default=0)
    files = max(1, min(least // 1_000, spark.sparkContext.defaultParallelism))
    folder = scratch_path(spark, "stream-files")
    for period in periods:
        part = F.pmod("event_id", F.lit(files)).cast("int")
        dealt.where(F.col("file") == period.file).drop("file").repartitionById(
            files, part).write.mode("append").parquet(folder)
    dealt.unpersist()
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
              .parquet(folder))
    twin = KeyedTwin(spark, scratch_path(spark, "stream"), CFG, allowance=allowance)
    return twin, run_available(from_events(stream), twin)


@register
def stream_controller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controller over several event files as a stream, out of order within the allowance."""
    return edge(_streamed(spark, sf_dir, STREAM_SHIFT)[1], *DAY_ROW, "t_int_opt", "etat_opt")


@register
def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the same stream rejects without an allowance."""
    twin, _ = _streamed(spark, sf_dir, dt.timedelta(0))
    return edge(twin.rejected(), "batch", "asset_id", "reading_id", "timestamp")
