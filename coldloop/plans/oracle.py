"""DuckDB SQL for each registered query, written against the event table.

The statements are straight definitions (one window per asset over its whole history, a
recursive controller), independent of how the Spark side splits the work.
"""

from __future__ import annotations

from coldloop.operators.registry import MODELS, THERMAL

TWO_ASSETS, FLEET = "user_id % 2", "user_id"
TS_TEXT = "replace(strftime({0}, '%Y-%m-%d %H:%M:%S.%f'), '.000000', '')"
KPI_COLUMNS = ("real_kwh", "pred_kwh", "opt_kwh", "real_minutes", "pred_minutes", "opt_minutes")


def ts_text(col: str) -> str:
    return TS_TEXT.format(col)


def even(expr: str, digits: int) -> str:
    return f"round_even(({expr}) * 1e{digits}::DOUBLE, 0) / 1e{digits}::DOUBLE"


def fixed(expr: str, digits: int) -> str:
    return f"CAST(round_even(({expr}) * 1e{digits}::DOUBLE, 0) AS BIGINT)"


def base(asset: str) -> dict[str, str]:
    cents = "CAST(round(value * 100) AS BIGINT)"
    running = "event_type IN ('click', 'purchase')"
    return {
        "source": f"""
            SELECT {asset} AS asset_id, event_id AS reading_id, ts, CAST(ts AS DATE) AS d,
                   CAST(1000 + {cents} % 2500 AS DOUBLE) / 100::DOUBLE AS "T_ext",
                   CAST(550 + {cents} % 300 AS DOUBLE) / 100::DOUBLE AS "T_int",
                   CAST(CASE WHEN {running} THEN 1 ELSE 0 END AS DOUBLE) AS "Etat_Compresseur",
                   CAST(CASE WHEN {running} THEN 3000 + {cents} % 1500 ELSE {cents} % 200 END
                        AS DOUBLE) / 100::DOUBLE AS "Puissance_Elec_kW",
                   sin(2 * pi() * dayofyear(ts) / 365) AS day_sin,
                   cos(2 * pi() * dayofyear(ts) / 365) AS day_cos,
                   sin(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440) AS hour_sin,
                   cos(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440) AS hour_cos
            FROM events""",
        "ordered": """
            SELECT *, row_number() OVER w - 1 AS pos, lag("T_int") OVER w AS "T_int_lag_1"
            FROM source WINDOW w AS (PARTITION BY asset_id ORDER BY ts, reading_id)""",
        "days": """
            SELECT asset_id, d, min(pos) AS first_pos, max(pos) AS last_pos
            FROM ordered GROUP BY asset_id, d""",
        "slice": """
            SELECT o.*, CAST(pos - greatest(first_pos, 12) AS BIGINT) AS k,
                   greatest(first_pos, 12) AS s
            FROM ordered o JOIN days USING (asset_id, d)
            WHERE pos >= greatest(first_pos, 12)
              AND pos < least(greatest(first_pos, 12) + 144, last_pos + 1)""",
        "seeded": """
            SELECT l.*, p."T_int" AS t_init, p."Etat_Compresseur" AS etat_init
            FROM slice l JOIN ordered p ON p.asset_id = l.asset_id AND p.pos = l.s - 1""",
    }


def condensed(parts: dict[str, str]) -> dict[str, str]:
    """The same parts on ten-minute means of the readings."""
    def mean(name: str, digits: int) -> str:
        units = fixed(f'"{name}"', digits)
        return (f"round_even(sum({units})::DOUBLE / count({units})::DOUBLE, 0)"
                f' / 1e{digits}::DOUBLE AS "{name}"')

    features = parts["source"][parts["source"].index("sin("):parts["source"].index("FROM events")]
    return {
        "raw": parts["source"],
        "windows": f"""
            SELECT asset_id, time_bucket(INTERVAL 10 MINUTE, ts) AS opened,
                   min(reading_id) AS reading_id, {mean('T_ext', 9)}, {mean('T_int', 9)},
                   arg_max("Etat_Compresseur", (ts, reading_id)) AS "Etat_Compresseur",
                   {mean('Puissance_Elec_kW', 6)}
            FROM raw GROUP BY 1, 2""",
        "source": f"""
            SELECT *, CAST(ts AS DATE) AS d, {features}
            FROM (SELECT * RENAME (opened AS ts) FROM windows)""",
        **{name: body for name, body in parts.items() if name != "source"},
    }


def weighted(steps: int) -> str:
    terms = [f"{steps + 1 - age} * lag(u, {age}) OVER w" for age in range(1, steps + 1)]
    return (f"round_even(CAST({' + '.join(terms)} AS DOUBLE) / {steps * (steps + 1) // 2}::DOUBLE, 0)"
            " / 1e9::DOUBLE")


def plain(steps: int) -> str:
    frame = f"(PARTITION BY asset_id ORDER BY pos ROWS BETWEEN {steps} PRECEDING AND 1 PRECEDING)"
    return (f"round_even(CAST(sum(u) OVER {frame} AS DOUBLE) / count(u) OVER {frame}, 0)"
            " / 1e9::DOUBLE")


def forecasts() -> dict[str, str]:
    return {
        "units": f"SELECT *, {fixed('\"T_int\"', 9)} AS u FROM ordered",
        "all_forecasts": f"""
            SELECT asset_id, pos, {plain(12)} AS plain_12, {plain(6)} AS plain_6,
                   {weighted(12)} AS weighted_12, {weighted(6)} AS weighted_6
            FROM units WINDOW w AS (PARTITION BY asset_id ORDER BY pos)""",
        "forecast": """
            SELECT s.*, f.plain_12 AS t_int_pred
            FROM seeded s JOIN all_forecasts f USING (asset_id, pos)""",
    }


def control(keys: str = "asset_id, d", source: str = "forecast") -> dict[str, str]:
    """Slopes, rolling slopes and the recursive controller, per group of ``keys``."""
    day = f"PARTITION BY {keys} ORDER BY k"
    recent = "ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    state = ("CASE WHEN {t} > 7.5::DOUBLE THEN 1::DOUBLE WHEN {t} < 6.7::DOUBLE "
             "THEN 0::DOUBLE ELSE {s} END")
    match = " AND ".join(f"n.{k.strip()} = c.{k.strip()}" for k in keys.split(","))
    chosen = ", ".join(f"n.{k.strip()}" for k in keys.split(","))
    advance = "CASE WHEN etat_opt = 1 THEN pente_froid ELSE pente_chauffe END"
    return {
        "sloped": f"""
            SELECT *, forecast_units - CASE WHEN k = 0 THEN {fixed('t_init', 9)}
                        ELSE lag(forecast_units) OVER ({day}) END AS slope_units,
                   coalesce("Etat_Compresseur" = 0, FALSE) AS heating
            FROM (SELECT *, {fixed('t_int_pred', 9)} AS forecast_units FROM {source})""",
        "means": f"""
            SELECT *, CAST(sum(slope_units) OVER m AS DOUBLE)
                      / CAST(count(slope_units) OVER m * 1000000000 AS DOUBLE) AS mean_slope
            FROM sloped WINDOW m AS (PARTITION BY {keys}, heating ORDER BY k {recent})""",
        "rolling": f"""
            SELECT *,
                   coalesce(last_value(CASE WHEN heating THEN mean_slope END IGNORE NULLS)
                            OVER ({day} {so_far}), 0.04::DOUBLE) AS pente_chauffe,
                   coalesce(last_value(CASE WHEN NOT heating THEN mean_slope END IGNORE NULLS)
                            OVER ({day} {so_far}), -0.12::DOUBLE) AS pente_froid
            FROM means""",
        "controller": f"""
            SELECT {keys}, k, t_int_opt, etat_opt, t_int_opt + {advance} AS following
            FROM (SELECT {keys}, k, t_init AS t_int_opt, pente_chauffe, pente_froid,
                         {state.format(t='t_init', s='etat_init')} AS etat_opt
                  FROM rolling WHERE k = 0)
            UNION ALL
            SELECT {keys}, k, t_int_opt, etat_opt, t_int_opt + {advance} AS following
            FROM (SELECT {chosen}, n.k, c.following AS t_int_opt, n.pente_chauffe, n.pente_froid,
                         {state.format(t='c.following', s='c.etat_opt')} AS etat_opt
                  FROM controller c JOIN rolling n ON {match} AND n.k = c.k + 1)""",
        "controlled": f"""
            SELECT r.*, c.t_int_opt, c.etat_opt
            FROM rolling r JOIN controller c USING ({keys}, k)""",
    }


def power_lines() -> dict[str, str]:
    def line(t: str) -> str:
        return even(f"slope * {t} + intercept", 6)
    return {
        "lines": """
            SELECT coalesce("Etat_Compresseur" = 1, FALSE) AS line,
                   regr_slope("Puissance_Elec_kW", "T_int") AS slope,
                   regr_intercept("Puissance_Elec_kW", "T_int") AS intercept
            FROM source GROUP BY 1""",
        "predicted": f"""
            SELECT f.*, {line('t_int_pred')} AS pwr_pred_ia
            FROM forecast f LEFT JOIN lines ON line = coalesce("Etat_Compresseur" = 1, FALSE)""",
        "twin": f"""
            SELECT c.*, p.pwr_pred_ia, {line('c.t_int_opt')} AS pwr_opt
            FROM controlled c JOIN predicted p USING (asset_id, d, k)
            LEFT JOIN lines ON line = coalesce(c.etat_opt = 1, FALSE)""",
    }


def kpi_sql(keys: str, source: str, optimise: bool = True) -> str:
    def kwh(col: str) -> str:
        return (f"CAST(coalesce(sum({fixed(col, 6)}), 0) AS DOUBLE) / 1e6::DOUBLE"
                " * (10::DOUBLE / 60::DOUBLE)")

    def minutes(col: str) -> str:
        return f"CAST(coalesce(sum(CASE WHEN {col} = 1 THEN 1 ELSE 0 END), 0) * 10 AS BIGINT)"

    real_minutes = minutes('"Etat_Compresseur"')
    optimised = kwh("pwr_opt") if optimise else "0::DOUBLE"
    opt_minutes = minutes("etat_opt") if optimise else "0::BIGINT"
    return f"""
        SELECT *, opt_kwh - real_kwh AS saving_kwh FROM (
            SELECT {keys}, {kwh('"Puissance_Elec_kW"')} AS real_kwh,
                   {kwh('pwr_pred_ia')} AS pred_kwh, {optimised} AS opt_kwh,
                   {real_minutes} AS real_minutes, {real_minutes} AS pred_minutes,
                   {opt_minutes} AS opt_minutes
            FROM {source} GROUP BY {keys})"""


def leaves(source: str, depths=(3, 5, 7, 9)) -> dict[str, str]:
    """Leaf means per state and nested temperature bin, 256 between the extremes."""
    spec = {
        "bounds": f'SELECT min("T_int") AS low, max("T_int") AS high FROM {source}',
        "leaf_rows": f"""
            SELECT coalesce("Etat_Compresseur" = 1, FALSE) AS line, {leaf_bin('"T_int"')} AS bin,
                   {fixed('"Puissance_Elec_kW"', 6)} AS u FROM {source}""",
        "state_means": "SELECT line, sum(u)::DOUBLE / count(*) AS mean FROM leaf_rows GROUP BY 1",
    }
    for depth in depths:
        spec[f"leaves_{depth}"] = f"""
            SELECT line, bin // {2 ** (9 - depth)} AS bin, sum(u)::DOUBLE / count(*) AS mean
            FROM leaf_rows GROUP BY 1, 2"""
    return spec


def leaf_bin(t: str) -> str:
    low, high = "(SELECT low FROM bounds)", "(SELECT high FROM bounds)"
    return (f"greatest(least(CAST(floor(({t} - {low}) * 256::DOUBLE / ({high} - {low})) AS BIGINT),"
            " 255), 0)")


def with_leaves(source: str, t: str, state: str, prefix: str, depths=(3, 5, 7, 9)) -> str:
    joins, columns = [], []
    for depth in depths:
        name = f"{prefix}{depth}"
        joins.append(
            f"LEFT JOIN leaves_{depth} {name} ON {name}.line = coalesce(a.{state} = 1, FALSE)"
            f" AND {name}.bin = {leaf_bin('a.' + t)} // {2 ** (9 - depth)}")
        columns.append(f"CASE WHEN a.{t} IS NOT NULL THEN coalesce({name}.mean, m.mean)"
                       f" / 1e6::DOUBLE END AS {prefix}_{depth}")
    return f"""
        SELECT a.*, {', '.join(columns)} FROM {source} a
        LEFT JOIN state_means m ON m.line = coalesce(a.{state} = 1, FALSE) {' '.join(joins)}"""


# Thermal variant label to its forecast column.
VARIANT_COLUMN = {
    label: ("plain" if "NoAttention" in label else "weighted") + ("_12" if "128u" in label else "_6")
    for family, label, _ in MODELS if family == "physiciens"
}


CUTOFF = ("(SELECT min(d) + CAST(floor((max(d) - min(d) + 1) * (2::DOUBLE / 3)) AS INTEGER)"
          " FROM source)")


def errors() -> dict[str, str]:
    thermal = " UNION ALL ".join(
        f"SELECT '{label.replace(' ', '_')}' AS model, 'Température (°C)' AS target, "
        f"\"T_int\" - {column} AS e FROM slice JOIN all_forecasts USING (asset_id, pos)"
        for label, column in VARIANT_COLUMN.items())
    energy = " UNION ALL ".join(
        f"SELECT 'XGBoost_Depth_{d}', 'Puissance (kW)', \"Puissance_Elec_kW\" - p_{d} FROM scored"
        for d in (3, 5, 7, 9))
    return {
        "earlier": f"SELECT * FROM source WHERE d < {CUTOFF}",
        "later": f"SELECT * FROM source WHERE d >= {CUTOFF}",
        **leaves("earlier"),
        "scored": with_leaves("later", '"T_int"', '"Etat_Compresseur"', "p"),
        "error_rows": f"{thermal} UNION ALL {energy}",
        "errors": f"""
            SELECT model, target, count(e) AS n, {even('avg(abs(e))', 6)} AS mae,
                   {even('sqrt(avg(e * e))', 6)} AS rmse
            FROM error_rows GROUP BY model, target""",
        "registry": "SELECT * FROM (VALUES " + ", ".join(
            f"('{f}', '{label}', '{a}')" for f, label, a in MODELS)
            + ") AS r(family, label, artifact)",
    }


def statement(parts: dict[str, str], final: str) -> str:
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    return f"WITH RECURSIVE {ctes}\n{final}"


FEATURES = ("T_ext", "T_int", "Etat_Compresseur", "T_int_lag_1",
            "day_sin", "day_cos", "hour_sin", "hour_cos")
RECORDED = '"T_ext", "T_int", "Etat_Compresseur", "Puissance_Elec_kW"'
D_TEXT = "strftime(d, '%Y-%m-%d') AS d"
ROW = f"asset_id, {D_TEXT}, k"


def _cyclic(table: str = "") -> str:
    return ", ".join(f"{even(f'{table}{c}', 6)} AS {c}" for c in FEATURES[4:])


def _scaler(source: str) -> str:
    stats = ", ".join(
        f'avg("{f}") AS {f}_mean, CASE WHEN stddev_pop("{f}") < 1e-9::DOUBLE THEN 1::DOUBLE '
        f'ELSE stddev_pop("{f}") END AS {f}_std' for f in FEATURES)
    return f"SELECT {stats} FROM {source}"


def _scaled(f: str, table: str) -> str:
    return f'({table}."{f}" - {f}_mean) / {f}_std'


def _label(col: str) -> str:
    return f"printf('%.1f kWh', {even(col, 1)})"


def oracle_sql() -> dict[str, str]:
    b = base(TWO_ASSETS)
    f = {**b, **forecasts()}
    c = {**f, **control()}
    t = {**c, **power_lines()}
    fleet = {**base(FLEET), **forecasts(), **control(), **power_lines()}
    cadence = {**condensed(b), **forecasts(), **control(), **power_lines()}
    e = {**f, **errors()}
    day_kpi = kpi_sql("asset_id, d", "twin")
    kpi_out = f"SELECT * REPLACE (strftime(d, '%Y-%m-%d') AS d) FROM ({day_kpi})"
    full = f"""
        SELECT {ROW}, {ts_text('ts')} AS timestamp, "T_ext", "T_int", "Etat_Compresseur",
               "T_int_lag_1", {_cyclic()}, "Puissance_Elec_kW", t_int_pred, pwr_pred_ia,
               t_int_opt, etat_opt, pente_chauffe, pente_froid, pwr_opt FROM twin"""
    stored = f"""
        SELECT asset_id, {ts_text('ts')} AS timestamp, t_int_opt, etat_opt, pwr_opt,
               pente_chauffe, pente_froid FROM twin"""
    shown = ", ".join(
        f"{even(col, 4 if col.startswith('pente') else 2)} AS {col}"
        for col in ("t_int_opt", "etat_opt", "pwr_opt", "pente_chauffe", "pente_froid"))
    newest = ("ORDER BY timestamp DESC, asset_id, t_int_opt, etat_opt, pwr_opt, pente_chauffe,"
              " pente_froid")
    series = f"""
        SELECT {ROW}, {ts_text('ts')} AS timestamp, "T_ext", 7.0::DOUBLE AS setpoint, "T_int",
               t_int_pred, t_int_opt, "Puissance_Elec_kW", pwr_pred_ia, pwr_opt FROM twin"""
    all_readings = f"""
        SELECT asset_id, reading_id, {ts_text('ts')} AS timestamp, {D_TEXT}, pos, {RECORDED}
        FROM ordered"""
    requests = "SELECT asset_id, CAST(d + 15 AS DATE) AS d FROM days"
    forecast_out = f"SELECT {ROW}, t_int_pred FROM forecast"
    control_out = f"SELECT {ROW}, t_int_opt, etat_opt FROM controlled"
    steps = " UNION ALL ".join(
        f"SELECT l.asset_id, l.d, l.k, CAST({step} AS BIGINT) AS step, '{name}' AS feature, "
        f"{even(f'CAST(CAST({_scaled(name, 'o')} AS FLOAT) AS DOUBLE)', 6)} AS value "
        f"FROM slice l JOIN ordered o ON o.asset_id = l.asset_id AND o.pos = l.pos - 12 + {step}, "
        "scaler" for step in range(12) for name in FEATURES)

    def switches(name: str, state: str, value: str) -> str:
        return f"""
            SELECT asset_id, d, k, ts, '{name}' AS series, {value} AS temperature,
                   {state} - lag({state}) OVER (PARTITION BY asset_id, d ORDER BY k) AS change
            FROM twin"""

    cumulative = kpi_sql("a.asset_id, a.d, a.k", """
        (SELECT a.asset_id, a.d, a.k, b."Puissance_Elec_kW", b."Etat_Compresseur", b.pwr_pred_ia,
                b.pwr_opt, b.etat_opt
         FROM twin a JOIN twin b ON a.asset_id = b.asset_id AND a.d = b.d AND b.k <= a.k) a""")
    kpi_list = KPI_COLUMNS + ("saving_kwh",)
    running = f"""
        SELECT asset_id, strftime(d, '%Y-%m-%d') AS d, n, {', '.join(kpi_list)} FROM (
            SELECT asset_id, d, k + 1 AS n, {', '.join(
                f'CASE WHEN k = 0 THEN coalesce(lead({m}) OVER w, {m}) ELSE {m} END AS {m}'
                for m in kpi_list)}
            FROM ({cumulative}) WINDOW w AS (PARTITION BY asset_id, d ORDER BY k)
            UNION ALL
            SELECT asset_id, d, 0 AS n, {', '.join(
                f'0::{"BIGINT" if m.endswith("minutes") else "DOUBLE"} AS {m}' for m in kpi_list)}
            FROM twin WHERE k = 0)"""
    sweep_parts = {
        **f,
        "forecast": " UNION ALL ".join(
            f"SELECT s.*, '{label}' AS thermal, f.{column} AS t_int_pred "
            "FROM seeded s JOIN all_forecasts f USING (asset_id, pos)"
            for label, column in VARIANT_COLUMN.items()),
        **control("thermal, asset_id, d"),
        **leaves("source"),
        "with_pred": with_leaves("controlled", "t_int_pred", '"Etat_Compresseur"', "pred"),
        "with_opt": with_leaves("with_pred", "t_int_opt", "etat_opt", "opt"),
        "pairs": " UNION ALL ".join(
            f"SELECT thermal, 'XGBoost Depth {d}' AS energy, asset_id, \"Puissance_Elec_kW\", "
            f"\"Etat_Compresseur\", etat_opt, {even(f'pred_{d}', 6)} AS pwr_pred_ia, "
            f"{even(f'opt_{d}', 6)} AS pwr_opt FROM with_opt" for d in (3, 5, 7, 9)),
    }
    root = "'trained_models/modeles_'"
    thermal = "family = 'physiciens'"
    return {
        "readings": statement(b, all_readings),
        "readings_split": statement(b, all_readings),
        "readings_by_range": statement(b, all_readings),
        "features": statement(b, f"""
            SELECT asset_id, reading_id, {ts_text('ts')} AS timestamp, "T_ext", "T_int",
                   "Etat_Compresseur", "T_int_lag_1", {_cyclic()} FROM ordered"""),
        "scaled_features": statement({**b, "scaler": _scaler("ordered")}, "SELECT asset_id, "
            "reading_id, " + ", ".join(
                f'{even(_scaled(n, "o"), 6)} AS "{n}"' for n in FEATURES)
            + " FROM ordered o, scaler"),
        "row_counts": statement(b, """
            SELECT r.asset_id, readings, dates, coalesce(slice_rows, 0) AS slice_rows,
                   slice_rows IS NULL AS is_empty
            FROM (SELECT asset_id, count(*) AS readings, count(DISTINCT d) AS dates
                  FROM source GROUP BY 1) r
            LEFT JOIN (SELECT asset_id, count(*) AS slice_rows FROM slice GROUP BY 1) s
            ON r.asset_id = s.asset_id"""),
        "day_index": statement(b, f"SELECT asset_id, {D_TEXT}, first_pos, last_pos FROM days"),
        "day_lookup": statement(b, f"""
            SELECT asset_id, {D_TEXT}, first_pos, last_pos
            FROM ({requests}) JOIN days USING (asset_id, d)"""),
        "day_rejects": statement(b, f"""
            SELECT asset_id, {D_TEXT} FROM ({requests}) ANTI JOIN days USING (asset_id, d)"""),
        "day_slice": statement(b, f"""
            SELECT {ROW}, pos, {ts_text('ts')} AS timestamp, {RECORDED} FROM slice"""),
        "day_seed": statement(b, f"""
            SELECT asset_id, {D_TEXT}, t_init, etat_init FROM seeded WHERE k = 0"""),
        "day_labels": statement(b, f"""
            SELECT asset_id, {D_TEXT}, strftime(d, '%d/%m/%Y') AS label,
                   strftime(d, '%Y-%m-%d 00:00:00') AS axis_start,
                   strftime(CAST(d + 1 AS DATE), '%Y-%m-%d 00:00:00') AS axis_end FROM days"""),
        "lookback_sequences": statement(
            {**b, "scaler": _scaler("ordered"), "steps": steps},
            f"SELECT {ROW}, step, feature, value FROM steps"),
        "thermal_forecast": statement(f, forecast_out),
        "pandas_udf_scorer": statement(f, forecast_out),
        "batched_scorer": statement(f, forecast_out),
        "thermal_models": statement({
            **f,
            "complete": """
                SELECT asset_id, pos, count("T_int") OVER (
                    PARTITION BY asset_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING
                ) = 12 AS scored FROM ordered""",
            "labels": f"SELECT unnest({[m[1] for m in MODELS if m[0] == THERMAL]}) AS label"},
            f"""SELECT {ROW}, label, scored FROM slice JOIN complete USING (asset_id, pos), labels
                WHERE d >= {CUTOFF}"""),
        "energy_predicted": statement(t, f"""
            SELECT {ROW}, t_int_pred, "Etat_Compresseur", pwr_pred_ia FROM predicted"""),
        "slopes": statement(c, f"""
            SELECT {ROW}, heating, CAST(slope_units AS DOUBLE) / 1e9::DOUBLE AS slope
            FROM sloped"""),
        "rolling_slopes": statement(c, f"SELECT {ROW}, pente_chauffe, pente_froid FROM rolling"),
        "hysteresis": statement(c, control_out),
        "stream_controller": statement(c, control_out),
        "stream_rejected": statement({
            **b,
            "sent": """
                SELECT *, floor((epoch_us(ts) + (reading_id % 7) * 3600000000)
                                / (10 * 86400 * 1000000::BIGINT)) AS file
                FROM source""",
            "files": """
                SELECT asset_id, file, max((ts, reading_id)) AS newest FROM sent GROUP BY 1, 2""",
            "earlier": """
                SELECT asset_id, file, max(newest) OVER (
                    PARTITION BY asset_id ORDER BY file
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM files"""},
            f"""SELECT CAST(CAST(s.file - (SELECT min(file) FROM sent) AS BIGINT) AS VARCHAR) AS batch,
                       asset_id, reading_id, {ts_text('ts')} AS timestamp
                FROM sent s JOIN earlier e USING (asset_id, file)
                WHERE (ts, reading_id) <= e.newest"""),
        "energy_optimised": statement(t, f"SELECT {ROW}, t_int_opt, etat_opt, pwr_opt FROM twin"),
        "twin_day": statement(t, full),
        "twin_day_split": statement(t, full),
        "twin_day_routed": statement(t, full),
        "twin_day_cadence": statement(cadence, full),
        "day_overflow": statement(b, f"""
            SELECT asset_id, {D_TEXT}, last_pos - first_pos + 1 AS readings,
                   least(available, 144) AS in_slice, greatest(available - 144, 0) AS beyond_cap
            FROM (SELECT *, greatest(last_pos + 1 - greatest(first_pos, 12), 0) AS available
                  FROM days)"""),
        "run_metrics": statement(f, """
            SELECT count(t_int_pred) AS rows_scored, count(*) FILTER (WHERE k = 0) AS days_scored,
                   count(*) FILTER (WHERE k = 0) AS thermal_calls,
                   2 * count(*) FILTER (WHERE k = 0) AS power_calls FROM forecast"""),
        "measured_scoring": statement(f, " UNION ALL ".join(
            f"SELECT {ROW}, '{label}' AS model, {column} AS t_int_pred"
            " FROM slice JOIN all_forecasts USING (asset_id, pos)"
            for label, column in VARIANT_COLUMN.items())),
        "scoring_calls": statement(f, " UNION ALL ".join(
            f"SELECT '{label}' AS model, asset_id, {D_TEXT}, 1 AS calls, count(*) AS rows_asked,"
            f" count({column}) AS rows_scored, count(*) OVER () AS in_histogram, true AS timed"
            " FROM slice JOIN all_forecasts USING (asset_id, pos) GROUP BY asset_id, d"
            for label, column in VARIANT_COLUMN.items())),
        "fleet_twin_day": statement(fleet, full),
        "fleet_twin_day_split": statement(fleet, full),
        "twin_latest_date": statement(t, f"""
            SELECT {ROW}, t_int_pred, pwr_pred_ia, t_int_opt, etat_opt, pwr_opt FROM twin
            WHERE d = (SELECT max(d) FROM source)"""),
        "day_kpi": statement(t, kpi_out),
        "day_kpi_cadence": statement(cadence, kpi_out),
        "result_cache": statement(t, kpi_out),
        "day_kpi_disabled": statement(t, f"""
            SELECT * REPLACE (strftime(d, '%Y-%m-%d') AS d)
            FROM ({kpi_sql('asset_id, d', 'twin', optimise=False)})"""),
        "fleet_day_kpi": statement(fleet, kpi_out),
        "running_kpi": statement(t, running),
        "kpi_labels": statement(t, f"""
            SELECT asset_id, {D_TEXT}, {_label('real_kwh')} AS real_energy,
                   real_minutes || ' mn' AS real_time, {_label('pred_kwh')} AS pred_energy,
                   pred_minutes || ' mn' AS pred_time, {_label('opt_kwh')} AS opt_energy,
                   opt_minutes || ' mn' AS opt_time,
                   CASE WHEN saving_kwh < 0 THEN '' ELSE '+' END || {_label('saving_kwh')}
                   AS saving
            FROM ({day_kpi})"""),
        "switch_events": statement(t, f"""
            SELECT {ROW}, {ts_text('ts')} AS timestamp, series,
                   CASE WHEN change = 1 THEN 'ON' ELSE 'OFF' END AS event, temperature
            FROM ({switches('real', '"Etat_Compresseur"', '"T_int"')} UNION ALL
                  {switches('opt', 'etat_opt', 't_int_opt')})
            WHERE change IN (1, -1)"""),
        "day_series": statement(t, series),
        "day_records": statement(t, series),
        "optimisation_table": statement(t, f"""
            SELECT asset_id, timestamp, {shown} FROM ({stored} {newest})"""),
        "optimisation_page": statement(t, f"""
            SELECT asset_id, timestamp, {shown} FROM ({stored} {newest} LIMIT 20 OFFSET 40)"""),
        "optimisation_page_by_rank": statement(t, f"""
            SELECT asset_id, timestamp, {shown}, (r - 1) // 20 AS page
            FROM (SELECT *, row_number() OVER ({newest}) AS r, count(*) OVER () AS n
                  FROM ({stored}))
            WHERE (r - 1) // 20 IN (0, (n - 1) // 20 // 2, (n - 1) // 20)"""),
        "optimisation_sink": statement(t, stored),
        "optimisation_sink_cadence": statement(cadence, stored),
        "optimisation_upsert": statement(t, stored),
        "optimisation_replace": statement(t, f"""
            SELECT asset_id, timestamp, {shown} FROM ({stored} WHERE d >=
                (SELECT min(d) + CAST(floor((max(d) - min(d) + 1) * 0.5::DOUBLE) AS INTEGER)
                 FROM source) {newest})"""),
        "simulation_table": statement(b, f"""
            SELECT {ROW}, {ts_text('ts')} AS timestamp, {', '.join(
                f'{even(f"{col}", 2)} AS {col}'
                for col in ('"T_ext"', '"T_int"', '"Etat_Compresseur"', '"Puissance_Elec_kW"'))},
                {', '.join(f'{even(even(col, 6), 2)} AS {col}' for col in FEATURES[4:])}
            FROM slice"""),
        "model_eval": statement(e, "SELECT * FROM errors"),
        "model_leaderboard": statement(e, """
            SELECT target, rank() OVER (PARTITION BY target ORDER BY rmse) AS rank, model, mae,
                   rmse, family, label, artifact
            FROM errors JOIN registry
            ON lower(replace(model, ' ', '_')) = lower(replace(label, ' ', '_'))"""),
        "model_registry": statement(e, f"""
            SELECT family, label, artifact,
                   concat_ws('/', {root} || family, artifact, CASE WHEN {thermal}
                       THEN 'modele_physicien_' || artifact || '.keras' END) AS model_path,
                   CASE WHEN {thermal} THEN {root} || family || '/' || artifact || '/scaler.pkl'
                   END AS scaler_path,
                   {', '.join(f"""CASE WHEN {thermal} THEN {root} || family || '/' || artifact
                       || '/{start}' || replace(artifact, 'lstm_', '') || '.png'
                   END AS {name}""" for name, start in (
                       ("picture_path", "validation_vs_test_"),
                       ("importance_path", "feature_importance_lstm_"),
                       ("curve_path", "learning_curve_")))}, n
            FROM (SELECT reading_id % 8 AS i, count(*) AS n FROM source GROUP BY 1)
            JOIN (SELECT *, row_number() OVER () - 1 AS i FROM registry) USING (i)"""),
        "metrics_table": statement(e, f"""
            SELECT model, target, printf('%.4f', {even('mae', 4)}) AS mae,
                   printf('%.4f', {even('rmse', 4)}) AS rmse,
                   CASE WHEN model LIKE '%LSTM%' THEN 'thermal'
                        WHEN model LIKE '%XGB%' THEN 'energy' END AS family
            FROM errors"""),
        "variant_sweep": statement(sweep_parts, kpi_sql("thermal, energy, asset_id", "pairs")),
        "variant_sweep_cadence": statement(
            {**condensed(b), **{name: body for name, body in sweep_parts.items() if name not in b}},
            kpi_sql("thermal, energy, asset_id", "pairs")),
    }
