"""Several forecasts in one fold give what each of them gives alone."""

from __future__ import annotations

import random
import re

import pytest

from coldloop.config import TwinConfig
from coldloop.operators import days as D
from coldloop.operators import evaluate
from coldloop.operators.lanes import replay_lanes, with_lane_slopes
from coldloop.plans.twin import controlled
from coldloop.sources.readings import read_events
from tests.test_keyed_stream import with_gaps
from tests.test_stream import random_feed

CFG = TwinConfig()
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", [2, 9])
def test_each_lane_equals_its_own_run(spark, make_readings, seed):
    readings = make_readings(with_gaps(random_feed(seed, dates=4), seed))
    frames = D.with_seed(D.frames_by_asset(readings, CFG))
    lanes = [f"t_{i}" for i in range(4)]
    scored = evaluate.score_thermal_variants(frames, CFG).persist()
    run = replay_lanes(with_lane_slopes(scored, lanes, CFG), lanes, CFG).persist()
    for lane in lanes:
        got = run.select(*D.KEY, "k", f"opt_{lane}", f"state_{lane}", f"heat_{lane}", f"cool_{lane}")
        want = controlled(scored.withColumnRenamed(lane, "t_int_pred"), CFG).select(
            *D.KEY, "k", "t_int_opt", "etat_opt", "pente_chauffe", "pente_froid")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_the_sweep_shuffles_rows_and_not_variants(spark):
    source = read_events(spark, SF_DIR)
    df = evaluate.variant_kpis(source, D.day_frames(source, CFG), CFG)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by_asset = re.findall(r"Exchange hashpartitioning\(asset_id#\d+L?, \d+\)", text)
    assert len(by_asset) == 1 and text.count("ObjectHashAggregate") <= 2
    # The 16 variants of a row appear above the fold, and only their totals are exchanged.
    assert text.index("Generate inline(array(struct(thermal") < text.index("aggregate(")
