"""The optimisation table, the metrics file and the day cache."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import types as T

from coldloop.config import OPTIMISATION_SCHEMA
from coldloop.operators.ordering import with_positions
from coldloop.operators.registry import family_tag, lookup, registry, with_paths
from coldloop.operators.sequences import Scaler
from coldloop.plans import oracle
from coldloop.plans.queries import QUERIES
from coldloop.session import scratch_path
from coldloop.sources.readings import with_time_features
from coldloop.sources.results import DayCache, OptimisationStore, read_metrics, write_metrics
from tests.compare import difference, duckdb_tables

D1, D2 = dt.date(2026, 5, 1), dt.date(2026, 5, 2)

# The published model errors.
PUBLISHED = [
    ("LSTM_128u_NoAttention", "Température (°C)", "0.0201", "0.0237"),
    ("LSTM_128u_Attention", "Température (°C)", "0.2733", "0.2866"),
    ("LSTM_64u_NoAttention", "Température (°C)", "0.4721", "0.4808"),
    ("LSTM_64u_Attention", "Température (°C)", "0.1043", "0.1239"),
    ("XGBoost_Depth_3", "Puissance (kW)", "1.3718", "2.2303"),
    ("XGBoost_Depth_5", "Puissance (kW)", "1.3719", "2.2312"),
    ("XGBoost_Depth_7", "Puissance (kW)", "1.3723", "2.2319"),
    ("XGBoost_Depth_9", "Puissance (kW)", "1.3727", "2.2327"),
]


def rows(spark, date, values):
    return spark.createDataFrame(
        [(0, f"{date} 00:00:{i:02d}", v, 1.0, 2.0, 0.04, -0.12, date)
         for i, v in enumerate(values)], OPTIMISATION_SCHEMA)


def session_with(folder, master):
    """The two settings ``scratch_path`` reads; a running session cannot change them."""
    conf = SimpleNamespace(get=lambda name, default: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_written_tables_go_below_the_checkpoint_folder():
    cluster = session_with("hdfs://shared/work/", "yarn")
    first, second = scratch_path(cluster, "x"), scratch_path(cluster, "x")
    assert first.startswith("hdfs://shared/work/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_with(None, "yarn"), "x")


def test_store_create_replace_upsert_clear(spark):
    store = OptimisationStore(spark, scratch_path(spark, "store"))
    store.create()
    assert store.read().isEmpty()
    store.upsert(rows(spark, D1, [1.0, 2.0]))
    store.create()
    assert store.read().count() == 2
    store.upsert(rows(spark, D2, [3.0]))
    store.upsert(rows(spark, D1, [9.0]))
    assert sorted((r.d, r.t_int_opt) for r in store.read().collect()) == [(D1, 9.0), (D2, 3.0)]
    store.replace(rows(spark, D2, [5.0]))
    assert [(r.d, r.t_int_opt) for r in store.read().collect()] == [(D2, 5.0)]
    store.clear()
    assert store.read().isEmpty()


def test_upsert_query_stores_both_assets_and_frees_its_rows(spark, tmp_path):
    """Four users are two assets; readings every half hour of three dates."""
    duckdb.sql("""
        SELECT i AS event_id, TIMESTAMP '2026-05-01' + to_minutes((i // 4) * 30) AS ts,
               i % 4 AS user_id, CASE WHEN i % 3 = 0 THEN 'click' ELSE 'view' END AS event_type,
               (i * 37 % 900) / 4 AS value
        FROM range(4 * 48 * 3) r(i)""").write_parquet(str(tmp_path / "events.parquet"))
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = set(persisted())
    got = QUERIES["optimisation_upsert"](spark, str(tmp_path))
    assert set(persisted()) <= before
    want = duckdb_tables(str(tmp_path)).execute(oracle.oracle_sql()["optimisation_upsert"]).df()
    assert difference(got.toPandas(), want) is None
    assert want["asset_id"].value_counts().to_dict() == {0: 276, 1: 276}


def test_metrics_file_loses_its_header_and_keeps_text(spark):
    path = scratch_path(spark, "metrics")
    published = spark.createDataFrame(PUBLISHED + [(None, "x", "1", "2")],
                                      "model string, target string, mae string, rmse string")
    write_metrics(published, path)
    got = read_metrics(spark, path)
    assert sorted(tuple(r) for r in got.where("model is not null").collect()) == sorted(PUBLISHED)
    assert got.where("model is null").count() == 1
    tags = {r[0]: r[1] for r in got.select("model", family_tag(got["model"])).collect()}
    assert tags["XGBoost_Depth_9"] == "energy" and tags["LSTM_64u_Attention"] == "thermal"


def test_registry_lookup_trims_and_builds_paths(spark):
    names = spark.createDataFrame([(" LSTM 64u Attention ",), ("XGBoost Depth 7",), ("?",)],
                                  "name string")
    found = {r.label: r for r in with_paths(lookup(names, registry(spark), "name")).collect()}
    assert set(found) == {"LSTM 64u Attention", "XGBoost Depth 7"}
    thermal, energy = found["LSTM 64u Attention"], found["XGBoost Depth 7"]
    root = "trained_models/modeles_physiciens/lstm_64u_Attention"
    assert thermal.model_path == f"{root}/modele_physicien_lstm_64u_Attention.keras"
    assert thermal.scaler_path == f"{root}/scaler.pkl"
    assert thermal.picture_path == f"{root}/validation_vs_test_64u_Attention.png"
    assert energy.model_path == (
        "trained_models/modeles_energetiques/modele_financier_depth_7.json")
    assert thermal.importance_path == f"{root}/feature_importance_lstm_64u_Attention.png"
    assert thermal.curve_path == f"{root}/learning_curve_64u_Attention.png"
    assert energy.scaler_path is energy.curve_path is energy.importance_path is None


def test_cache_computes_each_day_once_and_remembers_empty_ones(spark):
    schema = T.StructType([T.StructField("asset_id", T.LongType()),
                           T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())])
    calls = []

    def compute(missing):
        calls.append(sorted(tuple(r) for r in missing.collect()))
        return missing.where("asset_id <> 2").selectExpr("asset_id", "d", "asset_id * 1.5D AS x")

    cache = DayCache(spark, scratch_path(spark, "cache"), schema)
    keys = "asset_id long, d date"
    first = spark.createDataFrame([(1, D1), (2, D1)], keys)
    both = spark.createDataFrame([(1, D1), (2, D1), (3, D2)], keys)
    assert [tuple(r) for r in cache.fetch(first, "a", compute).collect()] == [(1, D1, 1.5)]
    got = sorted(tuple(r) for r in cache.fetch(both, "a", compute).collect())
    assert got == [(1, D1, 1.5), (3, D2, 4.5)]
    cache.fetch(both, "a", compute).collect()
    assert calls == [[(1, D1), (2, D1)], [(3, D2)]]
    cache.fetch(first, "b", compute).collect()
    assert calls[-1] == [(1, D1), (2, D1)]


def test_cache_ignores_rows_of_a_batch_that_never_finished(spark):
    schema = T.StructType([T.StructField("asset_id", T.LongType()),
                           T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())])
    cache = DayCache(spark, scratch_path(spark, "cache"), schema)
    stale = spark.createDataFrame([(1, D1, -1.0)], schema)
    stale.write.parquet(f"{cache.path}/rows/variant=a/batch=lost")
    wanted = spark.createDataFrame([(1, D1)], "asset_id long, d date")
    got = cache.fetch(wanted, "a", lambda m: m.selectExpr("asset_id", "d", "2.0D AS x"))
    assert [r.x for r in got.collect()] == [2.0]


def test_cache_merges_batches_and_removes_them_later(spark):
    """Six batches become one; a read planned before the merge still ends, empty days stay known."""
    schema = T.StructType([T.StructField("asset_id", T.LongType()),
                           T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())])
    calls = []

    def compute(missing):
        calls.append(missing.count())
        return missing.where("asset_id <> 2").selectExpr("asset_id", "d", "asset_id * 1.5D AS x")

    cache = DayCache(spark, scratch_path(spark, "cache"), schema)
    keys = "asset_id long, d date"
    days = [D1 + dt.timedelta(days=i) for i in range(6)]
    for d in days:
        cache.fetch(spark.createDataFrame([(1, d), (2, d)], keys), "a", compute).collect()
    cache.fetch(spark.createDataFrame([(1, D1)], keys), "b", compute).collect()
    # The same day from an overlapping call, with another value: the smallest batch is read.
    for name, rows, columns in (("rows", [(1, D1, -1.0)], schema), ("keys", [(1, D1)], keys)):
        spark.createDataFrame(rows, columns).write.parquet(f"{cache.path}/{name}/variant=a/batch=z")
    wanted = spark.createDataFrame([(i, d) for i in (1, 2) for d in days], keys)
    want = [(1, d, 1.5) for d in days]
    before = cache.fetch(wanted, "a", compute)
    assert cache.compact("a") == 7 and cache.vacuum() == 0
    after = cache.fetch(wanted, "a", compute)
    assert sorted(map(tuple, before.collect())) == want == sorted(map(tuple, after.collect()))
    assert cache.vacuum(0) == 7 and cache.vacuum(0) == 0
    assert cache.compact("a") == 1 and cache.compact("none") == 0
    computed = len(calls)
    assert sorted(map(tuple, cache.fetch(wanted, "a", compute).collect())) == want
    assert len(calls) == computed
    left = spark.read.parquet(f"{cache.path}/keys").select("variant", "batch").distinct()
    assert sorted(r.variant for r in left.collect()) == ["a", "b"]
    # A second merge with a batch that came after the first one.
    cache.fetch(spark.createDataFrame([(3, D1)], keys), "a", compute).collect()
    assert cache.compact("a") == 2 and cache.vacuum(0) == 2
    cache.forget("b")
    assert cache.missing(spark.createDataFrame([(1, D1), (3, D1)], keys), "a").count() == 0
    assert cache.missing(spark.createDataFrame([(1, D1)], keys), "b").count() == 1


def test_scaler_centres_constants_and_reloads(spark, make_readings):
    stamps = [dt.datetime(2026, 5, 1) + dt.timedelta(minutes=10 * i) for i in range(20)]
    readings = make_readings([(0, ts, 7.0 + (i % 4) / 10, 1.0) for i, ts in enumerate(stamps)])
    scaler = Scaler.fit(readings)
    temperatures = [7.0 + (i % 4) / 10 for i in range(20)]
    mean = sum(temperatures) / 20
    spread = (sum((t - mean) ** 2 for t in temperatures) / 20) ** 0.5
    assert scaler.mean["T_int"] == pytest.approx(mean)
    assert scaler.std["T_int"] == pytest.approx(spread)
    lags = temperatures[:-1]
    assert scaler.mean["T_int_lag_1"] == pytest.approx(sum(lags) / 19)
    assert scaler.std["Etat_Compresseur"] == pytest.approx(0, abs=1e-6)
    scaled = scaler.apply(with_time_features(with_positions(readings))).collect()
    assert {r.Etat_Compresseur for r in scaled} == {0.0}
    path = scratch_path(spark, "scaler")
    scaler.save(spark, path)
    assert Scaler.load(spark, path) == scaler
