"""Single-machine definitions of the day twin, for checking small fixtures."""

from __future__ import annotations

from collections import defaultdict


def ordered(rows):
    """asset -> rows sorted by (timestamp, reading_id); rows are Spark Rows or dicts."""
    by_asset = defaultdict(list)
    for row in rows:
        by_asset[row["asset_id"]].append(row)
    return {a: sorted(r, key=lambda x: (x["timestamp"], x["reading_id"]))
            for a, r in by_asset.items()}


def slices(rows, lookback=12, cap=144):
    """(asset, date) -> (positions of the slice, the asset's rows)."""
    found = {}
    for asset, history in ordered(rows).items():
        dates = [r["timestamp"].date() for r in history]
        for date in sorted(set(dates)):
            first, last = dates.index(date), len(dates) - 1 - dates[::-1].index(date)
            start = max(first, lookback)
            positions = range(start, min(start + cap, last + 1))
            if len(positions):
                found[asset, date] = (positions, history)
    return found


def mean_before(history, pos, steps=12):
    units = [round(r["T_int"] * 1e9) for r in history[pos - steps:pos] if r["T_int"] is not None]
    return round(sum(units) / len(units)) / 1e9


def control(preds, recorded, t_init, state_init, high=7.5, low=6.7, memory=10,
            default_heat=0.04, default_cool=-0.12):
    """Rows of (t_opt, etat_opt, heating slope, cooling slope)."""
    changes = [b - a for a, b in zip([t_init, *preds], preds, strict=False)]
    out, temperature, state = [], t_init, state_init
    for k in range(len(preds)):
        seen = list(zip(changes[:k + 1], recorded[:k + 1], strict=True))
        heat = [c for c, s in seen if s == 0][-memory:]
        cool = [c for c, s in seen if s != 0][-memory:]
        up = sum(heat) / len(heat) if heat else default_heat
        down = sum(cool) / len(cool) if cool else default_cool
        if temperature > high:
            state = 1.0
        elif temperature < low:
            state = 0.0
        out.append((temperature, state, up, down))
        temperature += down if state == 1.0 else up
    return out
