"""DuckDB SQL for the registered queries, written against the same tables."""

from __future__ import annotations

_SENSOR = """s AS (
 SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date, ts, epoch_us(ts) / 1000000.0 AS at, event_id, user_id, event_type, value,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS sc450, value * 0.7::DOUBLE AS sc550, value * 0.4::DOUBLE AS sc700,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE value * 0.05::DOUBLE END AS abs470, value * 0.04::DOUBLE AS abs532, value * 0.03::DOUBLE AS abs660,
  (20 + (event_id * 7) % 60)::DOUBLE AS rh, (20 + (user_id % 10) * 5)::DOUBLE / 100 AS gamma,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE (65 + event_id % 35)::DOUBLE / 100 END AS ssa550, (100 + (user_id % 11) * 15)::DOUBLE / 100 AS ae,
  CASE WHEN event_id % 19 = 0 THEN 1 WHEN event_id % 29 = 0 THEN NULL ELSE 0 END AS inlet,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_type = 'error' AND value > 150 THEN value ELSE 0 END AS n_cdp,
  CASE WHEN event_type = 'click' AND value > 250 THEN 0.01 ELSE 0 END AS lwc_cdp,
  (epoch_us(ts) // 3600000000) * 3600 AS window_start
 FROM events)"""

_ADJUST = "({sc} / exp(gamma * ln((100 - {to}) / (100 - {frm}))))"
_DRY = {c: f"CASE WHEN rh > 40 THEN {_ADJUST.format(sc=c, to=40, frm='rh')} ELSE {c} END" for c in ("sc450", "sc550", "sc700")}
_QC = (
    _SENSOR
    + f""", o AS (
 SELECT *, {_DRY['sc450']} AS sc450_dry, {_DRY['sc550']} AS sc550_dry, {_DRY['sc700']} AS sc700_dry,
  (coalesce(n_cdp > 1, FALSE) OR coalesce(lwc_cdp > 0.001, FALSE)) AS cloud_raw FROM s),
m AS (
 SELECT *, max(CAST(cloud_raw AS INTEGER)) OVER (PARTITION BY flight_date ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) = 1 AS cloudy,
  coalesce(inlet <> 0, TRUE) AS inlet_bad, NOT coalesce(sc450_dry > 10, FALSE) AS low_signal, coalesce(ssa550 <= 0.7, FALSE) AS low_ssa FROM o),
q AS (SELECT *, NOT (cloudy OR inlet_bad OR low_signal OR low_ssa) AS valid FROM m)"""
)

_COUNTS = "count(*) AS n_total, " + ", ".join(f"count(*) FILTER (WHERE {r}) AS n_{r}" for r in ("cloudy", "inlet_bad", "low_signal", "low_ssa", "valid"))
_STATS = ", ".join(f"avg({c}) FILTER (WHERE valid) AS {c}_mean, stddev_samp({c}) FILTER (WHERE valid) AS {c}_std" for c in ("sc450_dry", "sc550", "abs532", "abs470", "ae"))


def _flag(unstable: str) -> str:
    return (
        f"(CASE WHEN n_valid < 5 THEN 1 ELSE 0 END + CASE WHEN coalesce({unstable}, TRUE) THEN 2 ELSE 0 END"
        " + CASE WHEN sc450_dry_mean IS NULL OR sc550_mean IS NULL OR abs532_mean IS NULL THEN 4 ELSE 0 END)::BIGINT AS window_qc_flag"
    )


_WINDOWS = (
    _QC
    + f""", a AS (SELECT window_start, {_COUNTS}, {_STATS} FROM q GROUP BY window_start),
w AS (SELECT *, {_flag('ae_std > 0.3 * abs(ae_mean)')} FROM a)"""
)

_SPECTRUM = ", p AS (SELECT *, [" + ", ".join(f"CASE WHEN (event_id + {5 * i}) % 17 = 0 THEN NULL ELSE value * (1 + (event_id + {13 * i}) % 10) / 10 END" for i in range(12)) + "] AS psd FROM {of})"


def _bin_means(least: int) -> str:
    bins = ", ".join(f"CASE WHEN count(psd[{i}]) FILTER (WHERE valid) >= {least} THEN avg(psd[{i}]) FILTER (WHERE valid) END" for i in range(1, 13))
    return f", b AS (SELECT window_start, [{bins}] AS psd FROM p GROUP BY window_start)"


_ATTEMPTS = """, t AS (SELECT window_start, (CASE WHEN (window_start // 3600) % 3 = 0 THEN 1 ELSE 2 END)::BIGINT AS attempt_flag_cri, ae_mean / 2 AS rri
 FROM w WHERE window_qc_flag = 0 AND n_valid % 5 <> 0)"""

_KEY = "flight_date, event_id"

SQL: dict[str, str] = {
    "gamma_adjust": f"WITH {_SENSOR} SELECT {_KEY}, round({_ADJUST.format(sc='sc550', to=80, frm='rh')}, 6) AS sc550_wet FROM s",
    "derive_optical": f"WITH {_QC} SELECT {_KEY}, round(sc450_dry, 6) AS sc450_dry, round(sc550_dry, 6) AS sc550_dry, round(sc700_dry, 6) AS sc700_dry, "
    f"round({_ADJUST.format(sc='sc550_dry', to=80, frm=40)}, 6) AS sc550_wet FROM o",
    "cloud_mask_raw": f"WITH {_QC} SELECT {_KEY}, CAST(cloud_raw AS VARCHAR) AS cloud_raw FROM o",
    "cloud_dilate": f"WITH {_QC} SELECT {_KEY}, CAST(cloudy AS VARCHAR) AS cloudy FROM m",
    "cloud_dilate_global": f"WITH {_QC} SELECT {_KEY}, CAST(max(CAST(cloud_raw AS INTEGER)) OVER (ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) = 1 AS VARCHAR) AS cloudy FROM o",
    "row_qc": f"WITH {_QC} SELECT {_KEY}, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("cloudy", "inlet_bad", "low_signal", "low_ssa", "valid")) + " FROM q",
    "row_qc_flag": f"WITH {_QC} SELECT {_KEY}, (cloudy::INT + 2 * inlet_bad::INT + 4 * low_signal::INT + 8 * low_ssa::INT)::BIGINT AS row_qc_flag FROM q",
    "row_qc_totals": f"WITH {_QC} SELECT count(*) AS n_rows, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS n_{c}" for c in ("cloudy", "inlet_bad", "low_signal", "low_ssa", "valid")) + " FROM q",
    "angstrom": f"WITH {_SENSOR} SELECT {_KEY}, round(abs532 * pow(550.0::DOUBLE / 532, -1), 6) AS abs550 FROM s",
    "ssa_methods": f"""WITH {_SENSOR}, e AS (SELECT {_KEY}, sc550, (sc450 + abs470) * (532.0::DOUBLE / 550) AS ext, abs532 * (532.0::DOUBLE / 550) AS ab FROM s)
 SELECT {_KEY}, round(CASE WHEN ext > 0 THEN sc550 / ext END, 6) AS ssa_ext, round(CASE WHEN ab + sc550 > 0 THEN sc550 / (ab + sc550) END, 6) AS ssa_abs FROM e""",
    "window_reason_counts": f"WITH {_WINDOWS} SELECT window_start, n_total, n_cloudy, n_inlet_bad, n_low_signal, n_low_ssa, n_valid FROM w",
    "window_valid_stats": f"WITH {_WINDOWS} SELECT window_start, " + ", ".join(f"round({c}_{x}, 6) AS {c}_{x}" for c in ("sc450_dry", "abs470", "ae") for x in ("mean", "std")) + " FROM w",
    "window_psd_mean": f"WITH {_QC}{_SPECTRUM.format(of='q')}{_bin_means(5)} SELECT window_start, (i - 1)::BIGINT AS bin, round(psd[i], 6) AS mean FROM b, range(1, 13) AS g(i)",
    "window_qc_flag": f"WITH {_WINDOWS} SELECT window_start, n_total, n_cloudy, n_inlet_bad, n_low_signal, n_low_ssa, n_valid, round(ae_mean, 6) AS ae_mean, round(ae_std, 6) AS ae_std, window_qc_flag FROM w",
    "window_qc_flag_abs": f"WITH {_WINDOWS}, v AS (SELECT * EXCLUDE (window_qc_flag), {_flag('ae_std > 0.45')} FROM w) SELECT window_start, window_qc_flag FROM v",
    "window_bounds": f"WITH {_WINDOWS} SELECT window_start, window_start AS time_start, window_start + 3600 AS time_end, (window_start + 1800)::DOUBLE AS time_centre FROM w",
    "max_windows": f"WITH {_WINDOWS}, r AS (SELECT window_start, window_qc_flag, row_number() OVER (PARTITION BY window_qc_flag = 0 ORDER BY window_start) AS k FROM w) "
    "SELECT window_start, window_qc_flag FROM r WHERE window_qc_flag <> 0 OR k <= 100",
    "qc_funnel": f"""WITH {_WINDOWS}, r AS (SELECT window_qc_flag = 0 AS ok, (window_start // 3600) % 3 = 0 AS cri, (window_start // 3600) % 2 = 0 AS kappa FROM w)
 SELECT count(*) AS n_windows, count(*) FILTER (WHERE ok) AS n_pass, count(*) FILTER (WHERE ok AND cri) AS n_cri, count(*) FILTER (WHERE ok AND cri AND kappa) AS n_kappa FROM r""",
    "native_step": f"""WITH {_SENSOR}, d AS (SELECT flight_date, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY flight_date ORDER BY ts)) / 1e6 AS step FROM s)
 SELECT flight_date, round(coalesce(quantile_cont(step, 0.5), 1), 6) AS step_s FROM d GROUP BY flight_date""",
    "window_raw_stats": f"WITH {_SENSOR} SELECT window_start, " + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, count({c}) AS {c}_n" for c in ("sc450", "abs470")) + " FROM s GROUP BY window_start",
    "vector_wind": f"""WITH {_SENSOR}, d AS (SELECT window_start, avg(-value * sin(radians((event_id * 37 % 360)::DOUBLE))) AS u, avg(-value * cos(radians((event_id * 37 % 360)::DOUBLE))) AS v FROM s GROUP BY window_start)
 SELECT window_start, round(sqrt(u * u + v * v), 6) AS wind_speed, round(CASE WHEN degrees(atan2(-u, -v)) < 0 THEN degrees(atan2(-u, -v)) + 360 ELSE degrees(atan2(-u, -v)) END, 6) AS wind_direction FROM d""",
    "qc_composition": f"WITH {_WINDOWS}, c AS (SELECT window_start, n_cloudy, n_inlet_bad, n_low_signal, n_low_ssa, n_valid FROM w) UNPIVOT c ON n_cloudy, n_inlet_bad, n_low_signal, n_low_ssa, n_valid INTO NAME reason VALUE n",
    "retrieval_inputs": f"""WITH {_WINDOWS}{_SPECTRUM.format(of='q')}{_bin_means(5)}
 SELECT window_start, round(sc450_dry_mean, 6) AS sca_per_m_0, round(sc550_mean, 6) AS sca_per_m_1, round(abs470_mean, 6) AS abs_per_m_0, round(abs532_mean, 6) AS abs_per_m_1,
  0.04::DOUBLE AS radius_3, round(psd[3], 6) AS bin_2 FROM w JOIN b USING (window_start) WHERE window_qc_flag = 0""",
    "retrieval_failures": f"""WITH {_QC}{_SPECTRUM.format(of='q')}{_bin_means(9)}, f AS (SELECT window_start, len([x FOR x IN psd IF x IS NOT NULL]) < 2 AS few FROM b)
 SELECT window_start, (CASE WHEN few THEN 0 END)::BIGINT AS attempt_flag_cri, CASE WHEN few THEN 'fewer than 2 valid bins' END AS retrieval_error FROM f""",
    "assemble": f"WITH {_WINDOWS}{_ATTEMPTS} SELECT window_start, window_qc_flag, attempt_flag_cri, round(rri, 6) AS rri FROM w LEFT JOIN t USING (window_start)",
    "retrieval_qc_flag": f"""WITH {_WINDOWS}{_ATTEMPTS} SELECT window_start,
 (CASE WHEN window_qc_flag <> 0 THEN 1 WHEN coalesce(attempt_flag_cri, 0) = 2 THEN 0 ELSE 2 END)::BIGINT AS retrieval_qc_flag FROM w LEFT JOIN t USING (window_start)""",
    "retrieval_select_si": f"WITH {_WINDOWS} SELECT window_start, round(sc450_dry_mean * 1e-6 * 1e9, 6) AS sca_450, round(sc550_mean * 1e-6 * 1e9, 6) AS sca_550 FROM w",
    "window_broadcast": f"WITH {_WINDOWS} SELECT s.flight_date, s.event_id, s.window_start, round(w.ae_mean, 6) AS ae_mean FROM s LEFT JOIN w ON s.window_start = w.window_start AND w.window_qc_flag = 0",
    "hist30": """WITH l AS (SELECT min(value) AS lo, max(value) AS hi, count(*) AS n_total, quantile_cont(value, 0.5) AS median FROM events WHERE value IS NOT NULL)
 SELECT least(floor((value - lo) * 30 / (hi - lo)), 29)::BIGINT AS bin, n_total, round(median, 6) AS median, count(*) AS n FROM events, l WHERE value IS NOT NULL GROUP BY 1, 2, 3""",
    "closure_pairs": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450, 6) AS sc450, round(abs470, 6) AS abs470 FROM s WHERE sc450 IS NOT NULL AND abs470 IS NOT NULL",
    "psd_quartiles": f"""WITH {_SENSOR}{_SPECTRUM.format(of='s')}, l AS (SELECT (i - 1)::BIGINT AS bin, psd[i] AS v FROM p, range(1, 13) AS g(i))
 SELECT bin, round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75 FROM l WHERE v IS NOT NULL GROUP BY bin""",
    "moving_mean": f"WITH {_SENSOR} SELECT {_KEY}, round(avg(sc450) OVER (PARTITION BY flight_date ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING), 6) AS smooth FROM s",
    "best_window": f"""WITH {_SENSOR}, d AS (SELECT flight_date, quantile_cont(sc450, 0.5) AS med FROM s GROUP BY flight_date),
n AS (SELECT a.flight_date, a."at", a.sc450, count(*) AS k, count(b.sc450) AS k1, count(b.abs470) AS k2, count(b.ssa550) AS k3
 FROM s a JOIN s b ON a.flight_date = b.flight_date AND b."at" BETWEEN a."at" - 900 AND a."at" + 900 GROUP BY ALL),
r AS (SELECT flight_date, "at", sc450, CASE WHEN k = k1 AND k = k2 AND k = k3 THEN 1 WHEN k = k1 AND k = k2 THEN 2 WHEN k = k1 THEN 3 END AS priority FROM n),
c AS (SELECT r.*, row_number() OVER (PARTITION BY flight_date ORDER BY priority, sc450 DESC, "at") AS place FROM r JOIN d USING (flight_date) WHERE priority IS NOT NULL AND sc450 >= med)
 SELECT flight_date, priority::BIGINT AS priority, round("at", 6) AS "at", round(sc450, 6) AS sc450 FROM c WHERE place = 1""",
    "derived_stats": f"""WITH {_SENSOR}, d AS (SELECT flight_date, CASE WHEN abs470 > 0 THEN sc450 / abs470 END AS ratio, sc550 + abs532 AS total FROM s)
 SELECT flight_date, """
    + ", ".join(f"round(min({c}), 6) AS {c}_min, round(max({c}), 6) AS {c}_max, round(quantile_cont({c}, 0.5), 6) AS {c}_median" for c in ("ratio", "total"))
    + " FROM d GROUP BY flight_date",
    "date_sufficiency": f"WITH {_SENSOR} SELECT flight_date, count(sc450) AS n_sc450, count(abs470) AS n_abs470 FROM s GROUP BY flight_date HAVING count(sc450) >= 310 AND count(abs470) >= 310",
    "date_subset": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450, 6) AS sc450 FROM s WHERE flight_date IN ('2024-01-05', '2024-01-11')",
}

#: Curves of the lag frame: pairs, correlation, interpolation, smoothing, peaks and shapes.
_LAG = """b AS (SELECT CAST(ts AS DATE) AS d, ts, event_id, value, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events),
rr AS (SELECT *, avg(value) OVER (PARTITION BY d ORDER BY rn ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS ref_raw FROM b),
l AS (SELECT CAST(r.d AS VARCHAR) AS flight_date, r.rn, r.event_id, count(*) OVER (PARTITION BY r.d) AS n,
  CASE WHEN r.event_id % 53 = 0 THEN NULL ELSE r.ref_raw END AS ref,
  CASE WHEN r.event_id % 59 = 0 THEN NULL ELSE s.ref_raw + (r.event_id % 5)::DOUBLE END AS tgt_a,
  CASE WHEN day(r.d) % 4 = 0 THEN NULL ELSE r.value END AS tgt_b
 FROM rr r LEFT JOIN rr s ON s.d = r.d AND s.rn = r.rn - (day(r.d) % 7 - 3))"""
_PAIRS = (
    _LAG
    + """, g AS (SELECT flight_date, rn, 'a' AS grp, tgt_a AS t FROM l UNION ALL SELECT flight_date, rn, 'b', tgt_b FROM l),
pairs AS (SELECT l.flight_date, g.grp, l.rn, (g.rn - l.rn)::BIGINT AS lag, l.ref AS r, g.t
 FROM l JOIN g ON g.flight_date = l.flight_date AND g.rn BETWEEN l.rn - 30 AND l.rn + 30 WHERE l.n >= 90 AND l.rn > 30 AND l.rn <= l.n - 30)"""
)
_CURVE = (
    _PAIRS
    + """, cs AS (SELECT flight_date, grp, lag, count(*) FILTER (WHERE r IS NOT NULL AND t IS NOT NULL) AS n_valid, covar_pop(r, t) AS cov,
  stddev_pop(r) FILTER (WHERE t IS NOT NULL) AS sr, stddev_pop(t) FILTER (WHERE r IS NOT NULL) AS st, avg(r * t) AS dot FROM pairs GROUP BY ALL),
curve AS (SELECT flight_date, grp, lag, n_valid, CASE WHEN n_valid >= 2 AND sr > 0 AND st > 0 THEN cov / (sr * st) END AS corr, dot FROM cs)"""
)
_FILLED = (
    _CURVE
    + """, nb AS (SELECT *, last_value(corr IGNORE NULLS) OVER p AS v0, last_value(CASE WHEN corr IS NOT NULL THEN lag END IGNORE NULLS) OVER p AS l0,
  first_value(corr IGNORE NULLS) OVER f AS v1, first_value(CASE WHEN corr IS NOT NULL THEN lag END IGNORE NULLS) OVER f AS l1 FROM curve
 WINDOW p AS (PARTITION BY flight_date, grp ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  f AS (PARTITION BY flight_date, grp ORDER BY lag ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT flight_date, grp, lag, n_valid, corr, coalesce(corr, CASE WHEN l1 > l0 THEN v0 + (v1 - v0) * (lag - l0) / (l1 - l0) END, v0, v1) AS filled FROM nb)"""
)
_SMOOTH = (
    _FILLED
    + """, kr AS (SELECT k, exp(-k * k / 18.0) / sum(exp(-k * k / 18.0)) OVER () AS wt FROM range(-12, 13) AS x(k)),
sm AS (SELECT a.flight_date, a.grp, a.lag, a.n_valid, a.corr, CASE WHEN a.corr IS NOT NULL THEN sum(b.filled * kr.wt) END AS sm
 FROM filled a CROSS JOIN kr JOIN filled b ON b.flight_date = a.flight_date AND b.grp = a.grp
  AND b.lag = CASE WHEN a.lag + k < -30 THEN -61 - a.lag - k WHEN a.lag + k > 30 THEN 61 - a.lag - k ELSE a.lag + k END GROUP BY ALL)"""
)
_SMOOTH = _SMOOTH.replace(", CASE WHEN a.corr IS NOT NULL THEN sum(b.filled * kr.wt) END AS sm", ", sum(CASE WHEN a.corr IS NOT NULL THEN b.filled * kr.wt END) AS sm")
_PEAKS = (
    _SMOOTH
    + """, pk AS (SELECT flight_date, grp, arg_min(lag, (-sm, lag)) FILTER (WHERE sm IS NOT NULL) AS optimal_shift_s, max(sm) AS peak_r, max(sm) FILTER (WHERE lag = 0) AS zero_lag_r,
  max(n_valid) FILTER (WHERE lag = 0) AS n_valid FROM sm GROUP BY ALL),
peaks AS (SELECT pk.*, sm.corr AS peak_r_raw FROM pk LEFT JOIN sm ON sm.flight_date = pk.flight_date AND sm.grp = pk.grp AND sm.lag = pk.optimal_shift_s)"""
)
_SHAPE = (
    _PEAKS
    + """, j AS (SELECT sm.flight_date, sm.grp, sm.lag, sm.sm, pk.optimal_shift_s AS p, pk.peak_r FROM sm JOIN pk USING (flight_date, grp)),
second AS (SELECT flight_date, grp, max(sm) FILTER (WHERE abs(lag - p) > 5) AS second_peak_r, max(peak_r) - max(sm) FILTER (WHERE abs(lag - p) > 5) AS peak_margin FROM j GROUP BY ALL),
hs AS (SELECT *, coalesce(sm <= lead(sm) OVER v, FALSE) AS lf, coalesce(sm <= lag(sm) OVER v, FALSE) AS rf FROM j WINDOW v AS (PARTITION BY flight_date, grp ORDER BY lag)),
hw AS (SELECT flight_date, grp, (max(p) - coalesce(max(lag) FILTER (WHERE lag < p AND NOT lf) + 1, min(lag)))::BIGINT AS left_halfwidth_s,
  (coalesce(min(lag) FILTER (WHERE lag > p AND NOT rf) - 1, max(lag)) - max(p))::BIGINT AS right_halfwidth_s FROM hs WHERE p IS NOT NULL GROUP BY ALL),
g1 AS (SELECT *, CASE WHEN lag = -30 THEN lead(sm) OVER v - sm WHEN lag = 30 THEN sm - lag(sm) OVER v ELSE (lead(sm) OVER v - lag(sm) OVER v) / 2 END AS g FROM j WINDOW v AS (PARTITION BY flight_date, grp ORDER BY lag)),
g2 AS (SELECT *, CASE WHEN lag = -30 THEN lead(g) OVER v - g WHEN lag = 30 THEN g - lag(g) OVER v ELSE (lead(g) OVER v - lag(g) OVER v) / 2 END AS h FROM g1 WINDOW v AS (PARTITION BY flight_date, grp ORDER BY lag)),
cc AS (SELECT flight_date, grp, avg(CASE WHEN h < 0 THEN 1.0::DOUBLE ELSE 0 END) AS concavity_fraction FROM g2 WHERE abs(lag - p) <= 10 AND h IS NOT NULL GROUP BY ALL),
dg AS (SELECT * FROM peaks LEFT JOIN second USING (flight_date, grp) LEFT JOIN (SELECT *, least(left_halfwidth_s, right_halfwidth_s) AS monotonic_halfwidth_s FROM hw) USING (flight_date, grp) LEFT JOIN cc USING (flight_date, grp)),
rs AS (SELECT *, concat_ws('; ', CASE WHEN n_valid < 200 THEN 'n_valid=' || n_valid || '<200' END, CASE WHEN coalesce(peak_r < 0.2, TRUE) THEN 'peak_r<0.2' END,
  CASE WHEN coalesce(monotonic_halfwidth_s < 5, TRUE) THEN 'monotonic_halfwidth_s<5' END) AS reason FROM dg),
dec AS (SELECT *, CASE WHEN reason = '' THEN 'SHIFT' ELSE 'SKIP' END AS decision FROM rs),
ev AS (SELECT DISTINCT flight_date, n, grp, av, nv FROM l, (VALUES ('a', 'tgt_a', 3), ('b', 'tgt_b', 1), ('c', 'absent_c|absent_d', 1)) AS x(grp, av, nv)),
ok AS (SELECT dec.* FROM dec JOIN ev USING (flight_date, grp) WHERE ev.n >= 320),
tab AS (SELECT flight_date, grp, av AS alignment_variable, coalesce(n_valid, 0) AS n_valid, optimal_shift_s, round(peak_r, 4) AS peak_r, round(peak_r_raw, 4) AS peak_r_raw, round(zero_lag_r, 4) AS zero_lag_r,
  round(second_peak_r, 4) AS second_peak_r, round(peak_margin, 4) AS peak_margin, round(concavity_fraction, 4) AS concavity_fraction, monotonic_halfwidth_s, left_halfwidth_s, right_halfwidth_s,
  coalesce(decision, 'SKIP') AS decision, CASE WHEN grp = 'c' THEN 'no alignment_variable candidate present in DataFrame' WHEN n < 320 THEN 'insufficient data for cross-correlation' ELSE reason END AS reason,
  (CASE WHEN decision = 'SHIFT' AND optimal_shift_s <> 0 THEN nv ELSE 0 END)::BIGINT AS n_vars_shifted FROM ev LEFT JOIN ok USING (flight_date, grp))"""
)

_PIVOT = ", ".join(
    f"{x}  AS {g}_{n}"
    for g in ("a", "b", "c")
    for n, x in (
        ("applied_shift_s", f"max(CASE WHEN decision = 'SHIFT' THEN optimal_shift_s::DOUBLE ELSE 0 END) FILTER (WHERE grp = '{g}')"),
        ("decision_code", f"max(CASE WHEN decision = 'SHIFT' THEN 1 ELSE 0 END::BIGINT) FILTER (WHERE grp = '{g}')"),
        ("peak_r", f"max(peak_r) FILTER (WHERE grp = '{g}')"),
        ("n_valid", f"max(n_valid) FILTER (WHERE grp = '{g}')"),
        ("halfwidth_s", f"max(monotonic_halfwidth_s) FILTER (WHERE grp = '{g}')"),
        ("reason", f"max(reason) FILTER (WHERE grp = '{g}')"),
    )
)

SQL |= {
    "bin_sum_half": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, round(CASE WHEN (12 - len([x FOR x IN psd IF x IS NOT NULL])) / 12.0 < 0.5 THEN list_sum(psd) END, 6) AS total FROM p",
    "bin_sum_min1": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, round(list_sum(psd), 6) AS total FROM p",
    "lag_pairs": f"WITH {_PAIRS} SELECT flight_date, grp, lag, count(*) AS n, round(sum(r), 4) AS sum_r, round(sum(t), 4) AS sum_t FROM pairs GROUP BY ALL",
    "lag_correlation": f"WITH {_CURVE} SELECT flight_date, grp, lag, n_valid, round(corr, 6) AS corr FROM curve",
    "lag_dot_product": f"WITH {_CURVE} SELECT flight_date, grp, lag, round(dot, 4) AS dot FROM curve",
    "curve_interp": f"WITH {_FILLED.replace('FROM cs)', 'FROM cs WHERE TRUE)').replace('AS corr, dot FROM', 'AS corr0, dot FROM').replace('nb AS (SELECT *', 'c7 AS (SELECT *, CASE WHEN lag % 7 <> 0 THEN corr0 END AS corr FROM curve), nb AS (SELECT *').replace('AS l1 FROM curve', 'AS l1 FROM c7')} SELECT flight_date, grp, lag, round(filled, 6) AS filled FROM filled",
    "gauss_smooth": f"WITH {_SMOOTH} SELECT flight_date, grp, lag, round(sm, 6) AS sm FROM sm",
    "peak_pick": f"WITH {_PEAKS} SELECT flight_date, grp, optimal_shift_s, round(peak_r, 6) AS peak_r, round(peak_r_raw, 6) AS peak_r_raw, round(zero_lag_r, 6) AS zero_lag_r, n_valid FROM peaks",
    "second_peak": f"WITH {_SHAPE} SELECT flight_date, grp, round(second_peak_r, 6) AS second_peak_r, round(peak_margin, 6) AS peak_margin FROM second",
    "mono_halfwidth": f"WITH {_SHAPE} SELECT flight_date, grp, left_halfwidth_s, right_halfwidth_s, least(left_halfwidth_s, right_halfwidth_s) AS monotonic_halfwidth_s FROM hw",
    "concavity_fraction": f"WITH {_SHAPE} SELECT flight_date, grp, round(concavity_fraction, 6) AS concavity_fraction FROM cc",
    "shift_decision": f"WITH {_SHAPE} SELECT flight_date, grp, n_valid, decision, reason FROM dec",
    "apply_shift": f"""WITH {_SHAPE}, ks AS (SELECT flight_date, grp, optimal_shift_s AS k FROM dec WHERE decision = 'SHIFT')
 SELECT l.flight_date, l.rn, round(a.tgt_a, 6) AS tgt_a, round(b.tgt_b, 6) AS tgt_b FROM l
 LEFT JOIN ks ka ON ka.flight_date = l.flight_date AND ka.grp = 'a' LEFT JOIN l a ON a.flight_date = l.flight_date AND a.rn = l.rn + coalesce(ka.k, 0)
 LEFT JOIN ks kb ON kb.flight_date = l.flight_date AND kb.grp = 'b' LEFT JOIN l b ON b.flight_date = l.flight_date AND b.rn = l.rn + coalesce(kb.k, 0)""",
    "shift_diagnostics": f"WITH {_SHAPE} SELECT * FROM tab",
    "shift_summary": f"""WITH {_SHAPE} SELECT grp, count(*) FILTER (WHERE decision = 'SHIFT') AS n_shift, count(*) FILTER (WHERE decision = 'SKIP') AS n_skip,
 min(optimal_shift_s) FILTER (WHERE decision = 'SHIFT') AS min_shift, quantile_cont(optimal_shift_s, 0.5) FILTER (WHERE decision = 'SHIFT') AS median_shift, max(optimal_shift_s) FILTER (WHERE decision = 'SHIFT') AS max_shift FROM tab GROUP BY grp""",
    "skip_reasons": f"WITH {_SHAPE} SELECT reason, count(*) AS n FROM tab WHERE decision = 'SKIP' GROUP BY reason",
    "shift_pivot": f"WITH {_SHAPE} SELECT flight_date, {_PIVOT} FROM tab GROUP BY flight_date",
    "align_var_pick": f"""WITH {_SENSOR}, c AS (SELECT * FROM (VALUES ('optical', 1, 'missing_var'), ('optical', 2, 'n_error'), ('optical', 3, 'n_click'), ('micro', 1, 'n_refund'), ('nav', 1, 'n_purchase'), ('nav', 2, 'n_view')) AS x(grp, pos, variable)),
pr AS (SELECT DISTINCT flight_date, 'n_' || event_type AS variable FROM s),
ds AS (SELECT DISTINCT flight_date FROM pr), gs AS (SELECT DISTINCT grp FROM c)
 SELECT ds.flight_date, gs.grp, arg_min(c.variable, c.pos) FILTER (WHERE pr.variable IS NOT NULL) AS picked FROM ds CROSS JOIN gs JOIN c ON c.grp = gs.grp
 LEFT JOIN pr ON pr.flight_date = ds.flight_date AND pr.variable = c.variable GROUP BY ALL""",
    "shift_table_groups": """WITH st AS (SELECT p_partkey AS pos, p_name AS variable, p_brand AS shift_group, ' ' || p_type || ' |' || p_name || '| ' AS alignment_variable, CASE WHEN p_size % 3 = 0 THEN 'YES' ELSE 'NO' END AS use FROM part)
 SELECT shift_group, array_to_string([trim(x) FOR x IN string_split(arg_min(alignment_variable, pos), '|') IF trim(x) <> ''], ',') AS candidates, array_to_string(list_sort(list(variable)), ',') AS variables
 FROM st WHERE use = 'YES' GROUP BY shift_group""",
}

_ROWS = """r AS (SELECT event_id, epoch_us(ts) / 1000000.0 AS t, value, CAST(ts AS DATE) AS d FROM events WHERE value IS NOT NULL),
z AS (SELECT *, CASE WHEN t - lag(t) OVER (ORDER BY t) > 1200 OR lag(t) OVER (ORDER BY t) IS NULL THEN 1 ELSE 0 END AS o FROM r),
y AS (SELECT *, sum(o) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS k FROM z),
ses AS (SELECT min(t) AS start_s, max(t) AS end_s, count(*) AS n_rows FROM y GROUP BY k)"""


def _assigned(of: str, out: str) -> str:
    return f"""{out}_p AS (SELECT start_s, end_s, CASE WHEN lag(end_s) OVER w + 120 > start_s - 120 THEN (lag(end_s) OVER w + start_s) / 2 ELSE start_s - 120 END AS lo,
  CASE WHEN end_s + 120 > lead(start_s) OVER w - 120 THEN (end_s + lead(start_s) OVER w) / 2 ELSE end_s + 120 END AS hi FROM {of} WINDOW w AS (ORDER BY start_s)),
{out} AS (SELECT r.event_id, r.t, r.value, max(q.start_s) AS span_s FROM r LEFT JOIN {out}_p q ON r.t BETWEEN q.lo AND q.hi GROUP BY ALL)"""


_SPANS = _ROWS + ", sp AS (SELECT start_s, end_s FROM ses WHERE n_rows >= 60 AND day(make_timestamp(CAST(start_s * 1000000 AS BIGINT))) % 5 <> 0), " + _assigned("sp", "asg")
_ORPHANS = (
    _SPANS
    + """, orp AS (SELECT strftime(make_timestamp(CAST(t * 1000000 AS BIGINT)), '%Y-%m-%d') AS date, min(t) AS start_s, max(t) AS end_s FROM asg
 WHERE span_s IS NULL AND strftime(make_timestamp(CAST(t * 1000000 AS BIGINT)), '%Y-%m-%d') NOT IN (SELECT strftime(make_timestamp(CAST(start_s * 1000000 AS BIGINT)), '%Y-%m-%d') FROM sp) GROUP BY 1)"""
)
#: As the whole segmentation has it: sessions take the envelopes' part where no envelope is left.
_FLIGHTS = (
    _ORPHANS.replace("sp AS (SELECT start_s, end_s FROM ses WHERE", "sp0 AS (SELECT start_s, end_s FROM ses WHERE", 1).replace(
        "asg_p AS", "sp AS (SELECT * FROM sp0 UNION ALL SELECT start_s, end_s FROM ses WHERE NOT EXISTS (SELECT 1 FROM sp0)), asg_p AS", 1
    )
    + ", alls AS (SELECT start_s, end_s FROM sp UNION ALL SELECT start_s, end_s FROM orp), "
    + _assigned("alls", "fin")
    + """, ft AS (SELECT row_number() OVER (ORDER BY start_s) AS flight_no, start_s, end_s, n_rows, CAST(floor(start_s / 86400) * 86400 AS BIGINT) AS midnight_s FROM alls
  JOIN (SELECT span_s, count(*) AS n_rows FROM fin WHERE span_s IS NOT NULL GROUP BY 1) ON span_s = start_s),
gr AS (SELECT event_id, t, value, flight_no, t - midnight_s AS sod, CAST(round_even((t - midnight_s) / 600, 0) AS BIGINT) AS slot FROM fin JOIN ft ON fin.span_s = ft.start_s)"""
)

_R2 = "pow(5.0::DOUBLE * pow(2, {i}), 2)"


def _sigma(positions: list[int]) -> str:
    values = ", ".join(f"psd[{i + 1}] * {_R2.format(i=i)}" for i in positions)
    missing = " + ".join(f"CASE WHEN psd[{i + 1}] IS NULL THEN 1 ELSE 0 END" for i in positions)
    return f"CASE WHEN ({missing}) / {len(positions)}.0 <= 0.5 THEN pi() * 1e-6 * coalesce(list_sum([{values}]), 0) END"


SQL |= {
    "presence_sessions": f"WITH {_ROWS} SELECT round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, n_rows FROM ses",
    "flight_legs": f"""WITH {_ROWS}, d AS (SELECT *, strftime(make_timestamp(CAST(start_s * 1000000 AS BIGINT)), '%Y-%m-%d') AS date FROM ses),
n AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY date) > 1 THEN row_number() OVER (PARTITION BY date ORDER BY start_s) ELSE 0 END AS leg FROM d)
 SELECT CASE WHEN leg > 0 THEN date || '_L' || leg ELSE date END AS flight_id, date, leg, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM n""",
    "interval_assign": f"WITH {_SPANS} SELECT event_id, round(t, 6) AS \"at\", round(span_s, 6) AS span_s FROM asg",
    "orphan_days": f"WITH {_ORPHANS} SELECT date, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM orp",
    "flight_table": f"WITH {_FLIGHTS} SELECT flight_no, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s, n_rows, midnight_s, round(start_s - midnight_s, 6) AS takeoff_sod, round(end_s - midnight_s, 6) AS landing_sod FROM ft",
    "flight_grid": f"WITH {_FLIGHTS} SELECT event_id, flight_no, round(sod, 6) AS sod, slot FROM gr",
    "segment_dropped": f"WITH {_FLIGHTS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE span_s IS NULL) AS n_dropped, round(count(*) FILTER (WHERE span_s IS NULL) * 100.0 / count(*), 6) AS percent_dropped FROM fin",
    "envelope_select": f"WITH {_ROWS}, h AS (SELECT floor(t / 3600) AS hour, min(t) AS start_s, max(t) AS end_s FROM r GROUP BY 1) SELECT round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM h",
    "dropped_rows": f"WITH {_SPANS} SELECT count(*) AS n_rows, count(*) FILTER (WHERE span_s IS NULL) AS n_dropped, round(count(*) FILTER (WHERE span_s IS NULL) * 100.0 / count(*), 6) AS percent_dropped FROM asg",
    "densify": f"""WITH {_FLIGHTS}, ls AS (SELECT flight_no, slot, arg_max(value, t) AS value FROM gr GROUP BY ALL)
 SELECT ft.flight_no, x.slot, round(coalesce(ls.value, -999), 6) AS value FROM ft CROSS JOIN range(0, 200) AS x(slot) LEFT JOIN ls ON ls.flight_no = ft.flight_no AND ls.slot = x.slot""",
    "marker_spans": """WITH f AS (SELECT 'marker_HU25_' || strftime(ts, '%Y%m%d') || '_R0_L' || (user_id % 3) || '.ict' AS file, event_id, epoch_us(ts) / 1000000.0 AS t FROM events)
 SELECT file, (regexp_extract(file, '_L([0-9]+)[.]ict$', 1))::BIGINT AS leg, round(arg_min(t, event_id), 6) AS start_s, round(arg_max(t, event_id), 6) AS end_s FROM f GROUP BY file""",
    "bin_grid": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, 6::BIGINT AS n_bins, round(list_sum(psd[2:7]), 6) AS total FROM p",
    "edges_from_centers": """WITH c AS (SELECT DISTINCT p_brand, p_size::DOUBLE AS centre FROM part), n AS (SELECT *, row_number() OVER w - 1 AS pos, lag(centre) OVER w AS a, lead(centre) OVER w AS b FROM c WINDOW w AS (PARTITION BY p_brand ORDER BY centre))
 SELECT p_brand, pos, centre, round(CASE WHEN a IS NULL AND b IS NULL THEN centre * 0.9 WHEN a IS NULL THEN centre - (b - centre) / 2 ELSE (a + centre) / 2 END, 6) AS lower,
  round(CASE WHEN a IS NULL AND b IS NULL THEN centre * 1.1 WHEN b IS NULL THEN centre + (centre - a) / 2 ELSE (centre + b) / 2 END, 6) AS upper FROM n""",
    "bin_name_parse": """WITH n AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'X_' || replace(p_brand, '#', '') || '_Bin' || lpad(p_size::VARCHAR, 3, '0')
  WHEN 1 THEN 'dNdlogD_' || lpad(p_size::VARCHAR, 3, '0') || '_' || replace(p_brand, '#', '') ELSE p_name END AS name, lower(replace(p_brand, '#', '')) AS tag, p_size FROM part)
 SELECT p_partkey, name, CASE WHEN p_partkey % 3 < 2 THEN tag END AS tag, (CASE WHEN p_partkey % 3 < 2 THEN p_size END)::BIGINT AS number FROM n""",
    "bin_compact": f"""WITH {_SENSOR}{_SPECTRUM.format(of='s')}, c AS (SELECT {_KEY}, 'smps' AS tag, psd[1:6] AS bins FROM p UNION ALL SELECT {_KEY}, 'las', psd[7:12] FROM p)
 SELECT {_KEY}, tag, len(bins) AS n_bins, round(bins[3], 6) AS bin_2, round(list_sum(bins), 6) AS total FROM c""",
    "sigma_geo": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, round({_sigma(list(range(7)))}, 6) AS sigma_geo FROM p",
    "dndlogdp_to_n": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, round(psd[1] * log10(2), 6) AS n_0, round(psd[6] * log10(2), 6) AS n_5, round(list_sum([x * log10(2) FOR x IN psd]), 6) AS total FROM p",
    "scattering_efficiency": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')}, g AS (SELECT {_KEY}, sc550, {_sigma(list(range(12)))} AS sg FROM p) SELECT {_KEY}, round(CASE WHEN sg > 0 THEN sc550 / sg END, 6) AS efficiency FROM g",
    "bin_pattern": f"WITH {_SENSOR}{_SPECTRUM.format(of='s')} SELECT {_KEY}, array_to_string([i - 1 FOR i IN range(1, 13) IF psd[i] IS NOT NULL], ',') AS pattern FROM p",
    "bin_pattern_counts": f"""WITH {_SENSOR}{_SPECTRUM.format(of='s')}, k AS (SELECT [i - 1 FOR i IN range(1, 13) IF psd[i] IS NOT NULL] AS pt FROM p)
 SELECT array_to_string(pt, ',') AS pattern, count(*) AS n FROM k GROUP BY pt HAVING count(*) >= 5 AND len(pt) >= 2""",
    "lut_grid_search": """WITH e AS (SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings),
w AS (SELECT vec_id AS window_start, v, [CASE WHEN vec_id % 3 <> 0 THEN v[1] + 2 END, CASE WHEN vec_id % 5 <> 0 THEN v[2] + 2 END] AS m FROM e),
p AS (SELECT vec_id % 20 AS candidate, (vec_id // 20) % 2 AS channel, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e), a AS (SELECT candidate, channel, pos, avg(x) AS x FROM p GROUP BY ALL),
k AS (SELECT candidate, channel, list(x ORDER BY pos) AS v FROM a GROUP BY ALL),
rz AS (SELECT window_start, candidate, avg(pow((10 * list_inner_product(w.v, k.v) - m[channel + 1]) / m[channel + 1], 2)) AS residual FROM w CROSS JOIN k WHERE m[channel + 1] IS NOT NULL GROUP BY ALL),
bs AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY residual, candidate) AS place FROM rz)
 SELECT window_start, candidate, round(residual, 6) AS residual, (CASE WHEN residual <= 0.5 THEN 2 ELSE 1 END)::BIGINT AS attempt_flag_cri FROM w LEFT JOIN (FROM bs WHERE place = 1) USING (window_start)""",
}

_FILES = """f AS (SELECT event_type || '_HU25_' || strftime(ts, '%Y%m%d') || '_R0.ict' AS file, strftime(ts, '%Y-%m-%d') AS flight_date, event_type,
  row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY event_id) - 1 AS pos, floor((epoch_us(ts) / 1000000.0) % 86400)::DOUBLE AS seconds, CASE WHEN event_id % 31 <> 0 THEN value END AS value, user_id FROM events)"""

_SLOTS = """ds AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date FROM events),
v AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date, floor(((epoch_us(ts) / 1000000.0) % 86400) / 180)::BIGINT * 180 AS slot_s, avg(value) FILTER (WHERE event_id % 31 <> 0) AS value FROM events GROUP BY 1, 2),
tl AS (SELECT ds.flight_date, x.slot_s, v.value FROM ds CROSS JOIN range(0, 86400, 180) AS x(slot_s) LEFT JOIN v ON v.flight_date = ds.flight_date AND v.slot_s = x.slot_s),
nb AS (SELECT *, last_value(value IGNORE NULLS) OVER p AS v0, last_value(CASE WHEN value IS NOT NULL THEN slot_s END IGNORE NULLS) OVER p AS t0,
  first_value(value IGNORE NULLS) OVER n AS v1, first_value(CASE WHEN value IS NOT NULL THEN slot_s END IGNORE NULLS) OVER n AS t1 FROM tl
 WINDOW p AS (PARTITION BY flight_date ORDER BY slot_s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY flight_date ORDER BY slot_s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

_CLEAN = "regexp_replace(replace(replace(replace(trim({x}), '%', 'percent'), '_+_', '+'), '-->', 'to'), '[] ,.\"*!@#$^&()=?/\\\\:;~`<>\\[{{}}]', '_', 'g')"

_FAMILY = """nm AS (SELECT p_partkey, p_type || '_' || p_name || '_' || p_size AS name FROM part),
ti AS (SELECT * FROM (VALUES ('ECONOMY', 'bulk'), ('SMALL', 'bulk'), ('SMALL_red widget', 'red'), ('SMALL_red', 'never'), ('PROMO', 'PROMO')) AS x(title, family)),
mt AS (SELECT p_partkey, name, arg_max(ti.family, length(ti.title)) AS family, arg_max(ti.title, length(ti.title)) AS title FROM nm LEFT JOIN ti ON starts_with(name, ti.title || '_') GROUP BY ALL),
fam AS (SELECT p_partkey, name, coalesce(family, 'other') AS family, coalesce(title, string_split(name, '_')[1]) AS title FROM mt)"""

_CHANNELS = """ch AS (SELECT p_partkey AS pos, 400 + p_size * 7 AS wavelength,
  CASE p_type WHEN 'SMALL' THEN '_submicron' WHEN 'LARGE' THEN '_total_amb' WHEN 'PROMO' THEN '_total' WHEN 'MEDIUM' THEN '_submicron_amb' ELSE '' END AS k FROM part),
rk AS (SELECT *, 'Sc' || wavelength || k || '_' || pos AS col, CASE WHEN k LIKE '%total%' THEN 0 WHEN k LIKE '%submicron%' THEN 1 ELSE 2 END AS a, CASE WHEN k LIKE '%amb%' THEN 1 ELSE 0 END AS b FROM ch),
pf AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wavelength ORDER BY a, b, pos) AS place FROM rk) WHERE place = 1)"""

SQL |= {
    "icartt_scan": f"""WITH {_FILES}, u AS (SELECT file, flight_date, pos, seconds, 'Probe_' || event_type || '_value' AS variable, value FROM f UNION ALL SELECT file, flight_date, pos, seconds, 'Probe_' || event_type || '_user', user_id::DOUBLE FROM f)
 SELECT file, flight_date, pos, seconds, variable, round(value, 6) AS value FROM u""",
    "icartt_header_vars": f"""WITH {_FILES}, d AS (SELECT DISTINCT file, 'Probe ' || event_type AS title FROM f)
 SELECT file, title, v.* FROM d CROSS JOIN (VALUES (0::BIGINT, 'value', 'counts', 'std_STP', 'the value, in counts'), (1::BIGINT, 'user', 'none', '', '')) AS v(pos, name, units, standard, description)""",
    "file_select": r"""WITH f AS (SELECT page_id, regexp_extract(url, '^https?://[a-z.]+/([a-z]{2})/', 1) AS instr, lpad((page_id % 40 + 1)::VARCHAR, 2, '0') AS dd, regexp_extract(url, '/(\d+)', 1) AS nr FROM pages)
 SELECT page_id, instr || '_HU25_202401' || dd || '_R' || nr || '.ict' AS file, instr, '2024-01-' || dd AS flight_date FROM f WHERE instr IN ('fr', 'de') AND nr <> '' AND dd::INT BETWEEN 5 AND 25""",
    "timeline": "SELECT flight_date, slot_s FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date FROM events) CROSS JOIN range(0, 86400, 600) AS x(slot_s)",
    "merge_beside": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date, (epoch_us(ts) // 600000000) * 600 AS slot, "
    + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in ("click", "error", "purchase", "signup", "view"))
    + " FROM events WHERE value IS NOT NULL GROUP BY 1, 2",
    "gap_fill_linear": f"WITH {_SLOTS} SELECT flight_date, slot_s, round(coalesce(value, CASE WHEN t1 - t0 <= 720 THEN v0 + (v1 - v0) * (slot_s - t0) / (t1 - t0) END), 6) AS filled FROM nb",
    "gap_fill_nearest": f"""WITH {_SLOTS} SELECT flight_date, slot_s, round(CASE WHEN coalesce(slot_s - t0 <= 360, FALSE) AND (NOT coalesce(t1 - slot_s <= 360, FALSE) OR slot_s - t0 <= t1 - slot_s) THEN v0
 WHEN coalesce(t1 - slot_s <= 360, FALSE) THEN v1 END, 6) AS filled FROM nb""",
    "stack_on_top": "SELECT event_id, " + ", ".join(f"round(CASE WHEN event_type = '{t}' THEN value END, 6) AS {t}_value" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events",
    "dedupe_keep_first": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS flight_date, epoch_us(ts) // 600000000 AS slot, min(event_id) AS event_id, round(arg_min(value, event_id), 6) AS value FROM events GROUP BY 1, 2",
    "clean_title": f"SELECT p_partkey, {_CLEAN.format(x="' ' || p_name || ' 5% (a_+_b) --> ' || p_brand || '.x '")} AS title FROM part",
    "provenance_text": """SELECT field, string_agg(line, chr(10) ORDER BY line) AS text FROM (SELECT DISTINCT 'field' || (user_id % 3) AS field, event_type || ': ' || (user_id % 7) AS line FROM events) GROUP BY field""",
    "channel_preference": f"WITH {_CHANNELS} SELECT wavelength::BIGINT AS wavelength, col AS \"column\" FROM pf",
    "wavelength_match": f"""WITH {_CHANNELS}, sc AS (SELECT wavelength AS w, CASE WHEN k = '' THEN 'total' ELSE substr(k, 2) END AS kind FROM pf),
ex AS (SELECT pos, wavelength AS w2, 'Ext' || wavelength || k || '_' || pos AS col, CASE WHEN k = '' THEN 'unknown' ELSE substr(k, 2) END AS kind2 FROM ch),
mm AS (SELECT w, w2, col, row_number() OVER (PARTITION BY w, w2 ORDER BY CASE WHEN kind = kind2 THEN 0 WHEN kind2 = 'total' THEN 1 ELSE 2 END, pos) AS place FROM sc JOIN ex ON abs(w - w2) <= 50)
 SELECT w::BIGINT AS wavelength, w2::BIGINT AS other_wavelength, col AS other_column FROM mm WHERE place = 1""",
    "longest_prefix_family": f"WITH {_FAMILY} SELECT p_partkey, name, family, title FROM fam",
    "family_members": f"WITH {_FAMILY} SELECT family, count(*) AS n, min(name) AS first_name FROM fam GROUP BY family",
    "family_order": f"""WITH {_FAMILY}, d AS (SELECT DISTINCT family FROM fam)
 SELECT family, row_number() OVER (ORDER BY CASE family WHEN 'red' THEN 1 WHEN 'absent' THEN 2 WHEN 'bulk' THEN 3 WHEN 'other' THEN 5 ELSE 4 END, family) AS place FROM d""",
    "short_name": f"WITH {_FAMILY} SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 AND starts_with(name, title || '_') THEN substr(name, length(title) + 2) ELSE name END AS short FROM fam",
    "guess_units": """WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'Latitude' WHEN p_partkey % 50 = 1 THEN 'GPS_altitude'
  ELSE p_name || ['_ppm', '_ppb', '_cm3', '_percent', '_degC', '', '_ppt'][p_partkey % 7 + 1] END AS short FROM part)
 SELECT p_partkey, short, CASE WHEN short = 'Latitude' THEN 'degrees_north' WHEN short = 'GPS_altitude' THEN 'm' WHEN short LIKE '%!_ppm' ESCAPE '!' THEN 'ppm' WHEN short LIKE '%!_ppb' ESCAPE '!' THEN 'ppb'
  WHEN short LIKE '%!_ppt' ESCAPE '!' THEN 'ppt' WHEN short LIKE '%!_cm3' ESCAPE '!' THEN 'cm-3' WHEN short LIKE '%!_percent' ESCAPE '!' THEN 'percent' WHEN short LIKE '%!_degC' ESCAPE '!' THEN 'degC' END AS units FROM n""",
    "measurement_basis": """WITH n AS (SELECT p_partkey, coalesce(['X_STP', 'X_AMB', 'Mass_STP_y', '', NULL][p_partkey % 5 + 1], '') AS std, coalesce(['ppmv', 'unitless', 'm-1', 'degrees', 'um', '', NULL][p_partkey % 7 + 1], '') AS u,
  replace(lower(['At Standard_Temperature', 'ambient temperature', '', 'STP_used', 'none'][p_partkey % 5 + 1]), '_', ' ') AS i,
  CASE WHEN p_partkey % 11 = 0 THEN p_name || '_stp' WHEN p_partkey % 13 = 0 THEN 'frac_x' ELSE p_name END AS nm FROM part)
 SELECT p_partkey, CASE WHEN std = 'X_STP' OR std = 'Mass_STP_y' THEN 'STP' WHEN std = 'X_AMB' THEN 'ambient' WHEN nm LIKE '%!_stp' ESCAPE '!' THEN 'STP'
  WHEN u IN ('ppmv', 'unitless', 'degrees') OR nm LIKE '%frac%' THEN 'not_applicable' WHEN i LIKE '%standard temperature%' OR i LIKE '%stp%' THEN 'STP' WHEN i LIKE '%ambient temperature%' THEN 'ambient' ELSE 'unspecified' END AS basis FROM n""",
    "dedupe_names": """WITH n AS (SELECT p_partkey, p_type, p_name, count(*) OVER (PARTITION BY p_type, p_name) AS k, CASE WHEN p_size % 2 = 0 THEN 'XY' || CASE WHEN length(p_brand) > 7 THEN substr(p_brand, 7) ELSE '' END || 'LAS' WHEN length(p_brand) > 7 THEN substr(p_brand, 7) ELSE replace(p_brand, '#', '') END AS tag FROM part)
 SELECT p_partkey, CASE WHEN k > 1 THEN p_name || '_' || tag ELSE p_name END AS unique_name FROM n""",
    "metadata_resolve": """WITH h AS (SELECT p_type, p_name, min(p_brand) AS units, min(p_size)::VARCHAR AS standard FROM part WHERE p_size < 25 GROUP BY ALL),
o AS (SELECT p_name, arg_min(units, p_type) AS units, arg_min(standard, p_type) AS standard FROM h GROUP BY p_name)
 SELECT p_partkey, coalesce(h.units, o.units) AS units, coalesce(h.standard, o.standard) AS standard FROM part LEFT JOIN h USING (p_type, p_name) LEFT JOIN o ON o.p_name = part.p_name WHERE p_size >= 25""",
    "shift_group_lookup": """WITH t AS (SELECT p_name, arg_min(p_type, p_partkey) AS shift_group FROM part WHERE p_size < 4 GROUP BY p_name) SELECT p_name AS name, p_partkey, coalesce(shift_group, 'none') AS shift_group FROM part LEFT JOIN t USING (p_name)""",
}

_VARIED = _FILES + """, vf AS (SELECT DISTINCT file, event_type AS instr, flight_date, replace(flight_date, '-', '') AS dd, day(CAST(flight_date AS DATE)) % 4 = 0 AS broken FROM f)"""


def _bins_rows(lower: str, upper: str, centre: str) -> str:
    return f"SELECT p_partkey, i AS pos, round({centre}, 6) AS centre, round({lower}, 6) AS lower, round({upper}, 6) AS upper FROM part, range(3) AS x(i)"


_RUN = (
    _QC
    + """, a AS (SELECT window_start, count(*) FILTER (WHERE valid) AS n_valid, avg(sc450_dry) FILTER (WHERE valid) AS m0, avg(sc550_dry) FILTER (WHERE valid) AS m1,
  avg(abs532) FILTER (WHERE valid) AS ab, avg(ae) FILTER (WHERE valid) AS ae_mean, stddev_samp(ae) FILTER (WHERE valid) AS ae_std FROM q GROUP BY 1),
w AS (SELECT *, (CASE WHEN n_valid < 5 THEN 1 ELSE 0 END + CASE WHEN coalesce(ae_std > 0.3 * abs(ae_mean), TRUE) THEN 2 ELSE 0 END + CASE WHEN m0 IS NULL OR m1 IS NULL OR ab IS NULL THEN 4 ELSE 0 END)::BIGINT AS window_qc_flag FROM a)"""
)

#: Passing windows against three candidates' kernels over two scattering channels and one of absorption, in SI units.
_OFF = "pow((list_sum([(cand + 1) * {k} * i * 1e-8::DOUBLE * coalesce(psd[i], 0) FOR i IN range(1, 13)]) - {m} * 1e-6) / ({m} * 1e-6), 2)"
_RETRIEVED = f"""{_RUN}{_SPECTRUM.format(of='q')}{_bin_means(5)},
g AS (SELECT window_start, m0, m1, ab, psd FROM w JOIN b USING (window_start) WHERE window_qc_flag = 0),
c AS (SELECT window_start, cand, ({_OFF.format(k=1, m='m0')} + {_OFF.format(k=2, m='m1')} + {_OFF.format(k=3, m='ab')}) / 3 AS residual, len([x FOR x IN psd IF x IS NOT NULL]) < 2 AS few FROM g, range(3) AS r(cand)),
t AS (SELECT window_start, few, arg_min(cand, (residual, cand)) AS cand, min(residual) AS residual FROM c GROUP BY ALL),
u AS (SELECT window_start, CASE WHEN NOT few THEN cand END AS candidate, CASE WHEN NOT few THEN residual END AS residual, (CASE WHEN few THEN 0 WHEN residual <= 0.5 THEN 2 ELSE 1 END)::BIGINT AS attempt_flag_cri, CASE WHEN few THEN 'fewer than 2 valid bins' END AS retrieval_error FROM t)"""
_RESULT = "window_start, window_qc_flag, candidate, round(residual, 6) AS residual, attempt_flag_cri, retrieval_error, (CASE WHEN window_qc_flag <> 0 THEN 1 WHEN coalesce(attempt_flag_cri, 0) = 2 THEN 0 ELSE 2 END)::BIGINT AS retrieval_qc_flag"

SQL |= {
    "header_union": f"""WITH {_VARIED}, g AS (SELECT * FROM vf WHERE NOT broken), e AS (SELECT instr, min(dd) AS d0, max(dd) AS d1 FROM g GROUP BY 1)
 SELECT instr, 'value' AS name, 'u' || d0 AS units, 'std_STP' AS standard, 'the value, in counts' AS description FROM e
 UNION SELECT instr, 'user_' || d0, 'none', '', '' FROM e UNION SELECT instr, 'user_' || d1, 'none', '', '' FROM e""",
    "bad_files": f"WITH {_VARIED} SELECT file, (count(*) * 2 * CASE WHEN bool_or(broken) THEN 0 ELSE 1 END)::BIGINT AS n_values FROM f JOIN vf USING (file) GROUP BY file",
    "bins_from_descriptions": "SELECT p_partkey AS pos, p_name AS name, round(p_size / 10.0::DOUBLE, 6) AS centre FROM part WHERE p_size > 10",
    "bins_from_edges": _bins_rows("(p_size + i)::DOUBLE", "(p_size + i + 1)::DOUBLE", "sqrt((p_size + i)::DOUBLE * (p_size + i + 1))"),
    "bins_from_bounds": _bins_rows("(p_size * 10 + 10 * i)::DOUBLE / 1000", "(p_size * 10 + 10 * i + 10)::DOUBLE / 1000", "(p_size * 10 + 10 * i + 5)::DOUBLE / 1000"),
    "bin_match": """WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos, count(*) OVER (PARTITION BY p_brand) AS n, count(*) FILTER (WHERE p_type <> 'PROMO') OVER (PARTITION BY p_brand) AS h FROM part)
 SELECT p_brand AS tag, 'c' || p_partkey AS name, pos, (CASE WHEN p_type = 'SMALL' THEN p_size WHEN n = h THEN p_size ELSE p_size * 2 END)::DOUBLE AS centre FROM p""",
    "synthetic_bins": f"""WITH {_SENSOR}{_SPECTRUM.format(of='s')}, k AS (SELECT pow(5.0::DOUBLE * 0.99, 0.25) AS g), b AS (SELECT {_KEY}, psd, [psd[1] * pow(g, i) / 5 FOR i IN range(5)] AS made, g FROM p, k)
 SELECT {_KEY}, 17::BIGINT AS n_bins, round(made[1], 6) AS bin_0, round(made[5], 6) AS bin_4, round(CASE WHEN psd[1] IS NULL THEN list_sum(psd) ELSE list_sum(made) + list_sum(psd) END, 6) AS total, round(pow(g, 4), 6) AS radius_4 FROM b""",
    "bin_table": "SELECT DISTINCT p_size - 0.5::DOUBLE AS dpl, p_size::DOUBLE AS dpg, p_size + 0.5::DOUBLE AS dpu FROM part",
    "shift_table_load": "SELECT p_name AS variable, p_brand AS shift_group, p_type || '|' || p_name AS alignment_variable, CASE WHEN p_size % 3 = 0 THEN 'YES' ELSE 'NO' END AS apply_time_shift FROM part",
    "family_map": "SELECT p_brand AS title, min(p_type) AS family FROM part GROUP BY 1",
    "diagnostics_load": f"WITH {_SHAPE} SELECT flight_date AS date, grp AS shift_group, alignment_variable, n_valid, optimal_shift_s::DOUBLE AS optimal_shift_s, peak_r, monotonic_halfwidth_s::DOUBLE AS monotonic_halfwidth_s, decision, nullif(reason, '') AS reason, n_vars_shifted FROM tab",
    "merged_table": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450, 6) AS sc450, round(abs470, 6) AS abs470, round(ssa550, 6) AS ssa550 FROM s",
    "observation_product": f"WITH {_QC} SELECT {_KEY}, round(sc450::FLOAT::DOUBLE, 6) AS sc450, round(sc550_dry::FLOAT::DOUBLE, 6) AS sc550_dry, (cloudy::INT + 2 * inlet_bad::INT + 4 * low_signal::INT + 8 * low_ssa::INT)::BIGINT AS row_qc_flag, 'Mm-1' AS units FROM q",
    "windowed_product": f"WITH {_WINDOWS} SELECT window_start, n_valid, window_qc_flag, round(ae_mean, 6) AS ae_mean, 12::BIGINT AS n_bins, 20480::DOUBLE AS largest FROM w",
    "rename_coefficients": f"WITH {_WINDOWS} SELECT window_start, round(sc450_dry_mean, 6) AS dry_calculated_sca_coef_450nm, round(ae_mean, 6) AS wet_calculated_ssa_550nm, round(abs532_mean, 6) AS other FROM w",
    "narrow_floats": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450::FLOAT::DOUBLE, 6) AS sc450, round(abs470::FLOAT::DOUBLE, 6) AS abs470, round(rh::FLOAT::DOUBLE, 6) AS rh FROM s",
    "stage_by_date": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450 * CASE WHEN day(CAST(flight_date AS DATE)) % 2 = 0 THEN 10 ELSE 1 END, 6) AS sc450 FROM s",
    "result_checkpoint": f"WITH {_WINDOWS}{_ATTEMPTS} SELECT window_start, attempt_flag_cri, round(rri, 6) AS rri, 3600::BIGINT AS window_s, 'relative' AS mode FROM t",
    "provenance_row": f"""WITH {_SPANS} SELECT 'Events' AS title, '{{"min_valid": 5, "mode": "relative"}}' AS config_json, 'data-presence gaps' AS segmentation_source, 'click, error, purchase, signup, view' AS instruments, 'r2' AS version, 3600::BIGINT AS window_s,
 count(*) FILTER (WHERE span_s IS NULL) AS n_dropped, round(count(*) FILTER (WHERE span_s IS NULL) * 100.0 / count(*), 6) AS percent_dropped FROM asg""",
    "concat_dates": f"WITH {_SENSOR} SELECT {_KEY}, round(sc450, 6) AS sc450, round(CASE WHEN day(CAST(flight_date AS DATE)) % 2 = 0 THEN abs470 END, 6) AS abs470, row_number() OVER (PARTITION BY flight_date ORDER BY ts, event_id) AS place FROM s",
    "drop_columns": f"WITH {_SENSOR} SELECT {_KEY}, user_id, event_type, round(value, 6) AS value, round(sc450, 6) AS sc450, round(sc700, 6) AS sc700, round(rh, 6) AS rh, round(gamma, 6) AS gamma, round(ae, 6) AS ae, inlet FROM s",
    "metadata_merge": "SELECT DISTINCT event_type AS title, 'field' || (user_id % 3) AS field, (user_id % 7)::VARCHAR AS value FROM events",
    "campaign_merge": f"WITH {_FILES} SELECT flight_date, (floor(seconds / 600) * 600)::BIGINT AS slot_s, "
    + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{t}'), 6) AS Probe_{t}_value" for t in ("click", "error", "purchase", "signup", "view"))
    + " FROM f GROUP BY 1, 2",
    "campaign_run": f"WITH {_RETRIEVED} SELECT {_RESULT} FROM w LEFT JOIN u USING (window_start)",
    "campaign_run_first": f"""WITH {_RETRIEVED.replace(' FROM q GROUP BY 1)', ' FROM q WHERE day(CAST(flight_date AS DATE)) >= 3 GROUP BY 1)', 1)},
og AS (SELECT window_start, row_number() OVER (ORDER BY window_start) AS k FROM w WHERE window_qc_flag = 0)
 SELECT {_RESULT} FROM w LEFT JOIN u USING (window_start) LEFT JOIN og USING (window_start) WHERE window_qc_flag <> 0 OR k <= 50""",
    "campaign_products": f"""WITH {_RETRIEVED}, fl AS (SELECT *, cloudy::INT + 2 * inlet_bad::INT + 4 * low_signal::INT + 8 * low_ssa::INT AS flag FROM q),
rt AS (SELECT *, CASE WHEN window_qc_flag <> 0 THEN 1 WHEN coalesce(attempt_flag_cri, 0) = 2 THEN 0 ELSE 2 END AS flag FROM w LEFT JOIN u USING (window_start)),
tm AS (SELECT "at", lag("at") OVER (ORDER BY "at") AS p FROM q)
 SELECT 'scattering flag ' || flag AS part, count(*) AS n, round(sum(sc550_dry::FLOAT::DOUBLE), 6) AS total FROM fl GROUP BY flag
 UNION ALL SELECT 'absorption flag ' || flag, count(*), round(sum(abs532::FLOAT::DOUBLE), 6) FROM fl GROUP BY flag
 UNION ALL SELECT 'retrievals flag ' || flag, count(*), round(sum(residual), 6) FROM rt GROUP BY flag
 UNION ALL SELECT 'windows', count(*), 0.0::DOUBLE FROM w UNION ALL SELECT 'psd_bin', 12, 40.95::DOUBLE
 UNION ALL SELECT 'flights', count(*) FILTER (WHERE p IS NULL OR "at" - p > 1200), count(*)::DOUBLE FROM tm UNION ALL SELECT 'provenance r3', 0, 3600.0::DOUBLE""",
    "clock_alignment": f"""WITH {_SHAPE}, ks AS (SELECT flight_date, grp, optimal_shift_s AS k FROM dec WHERE decision = 'SHIFT'),
ct AS (SELECT dd.flight_date, coalesce(sum(CASE WHEN k <> 0 THEN 1 ELSE 0 END), 0)::BIGINT AS n_shifted, 3 - count(k) AS n_skipped FROM (SELECT DISTINCT flight_date FROM l) dd LEFT JOIN ks ON ks.flight_date = dd.flight_date GROUP BY 1)
 SELECT l.flight_date, l.rn, l.event_id, round(a.tgt_a, 6) AS tgt_a, round(b.tgt_b, 6) AS tgt_b, ct.n_shifted, ct.n_skipped FROM l JOIN ct ON ct.flight_date = l.flight_date
 LEFT JOIN ks ka ON ka.flight_date = l.flight_date AND ka.grp = 'a' LEFT JOIN l a ON a.flight_date = l.flight_date AND a.rn = l.rn + coalesce(ka.k, 0)
 LEFT JOIN ks kb ON kb.flight_date = l.flight_date AND kb.grp = 'b' LEFT JOIN l b ON b.flight_date = l.flight_date AND b.rn = l.rn + coalesce(kb.k, 0)""",
}

_PAIRED = """e AS (SELECT event_id, event_type, epoch_us(ts) / 1000000.0::DOUBLE AS "at", value, user_id % 3 AS probe FROM events),
r AS (SELECT * FROM e WHERE event_type IN ('error', 'purchase')),
p AS (SELECT l.event_id, r.value AS other_value, r.event_id AS other_id, r."at" AS matched_at, row_number() OVER (PARTITION BY l.event_id ORDER BY abs(r."at" - l."at"), r."at", r.value DESC, r.event_id DESC) AS place
 FROM e l JOIN r ON {on} WHERE l.event_type = 'click')"""


def _asof(on: str) -> str:
    return f"WITH {_PAIRED.format(on=on)} SELECT e.event_id, round(other_value, 6) AS other_value, other_id, round(matched_at, 6) AS matched_at FROM e LEFT JOIN p ON p.event_id = e.event_id AND place = 1 WHERE event_type = 'click'"


SQL |= {
    "asof_backward": _asof('r."at" BETWEEN l."at" - 900 AND l."at"'),
    "asof_forward": _asof('r.probe = l.probe AND r."at" BETWEEN l."at" AND l."at" + 900'),
    "asof_nearest": _asof('r."at" BETWEEN l."at" - 900 AND l."at" + 900'),
}

_SPOILT = (
    _FILES
    + """, sp AS (SELECT *, day(CAST(flight_date AS DATE)) % 6 = 0 AS lost, CASE WHEN (pos + 15) % 11 = 0 THEN 'number can''t be read' WHEN (pos + 15) % 13 = 0 THEN 'too many fields'
  WHEN (pos + 15) % 17 = 0 THEN 'too few fields' WHEN (pos + 15) % 19 = 0 THEN 'time can''t be read' END AS reason FROM f)"""
)
_BAD_BY_DATE = "SELECT flight_date, count(DISTINCT file) AS n_files, count(DISTINCT file) FILTER (WHERE lost) AS n_bad_files, count(*) FILTER (WHERE NOT lost AND reason IS NOT NULL) AS n_bad_rows, CAST(bool_and(lost) AS VARCHAR) AS failed FROM sp {where} GROUP BY flight_date"

SQL |= {
    "icartt_scan_lines": SQL["icartt_scan"],
    "row_quarantine": f"""WITH {_SPOILT}, c AS (SELECT count(*) AS n_lines, count(reason) AS n_bad FROM sp WHERE NOT lost),
p AS (SELECT file, reason, count(*) AS n, sum(pos)::BIGINT AS places FROM sp WHERE NOT lost AND reason IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT 'all', 'values', 2 * count(*), 2 * sum(pos)::BIGINT FROM sp WHERE NOT lost AND reason IS NULL)
 SELECT p.*, c.* FROM p CROSS JOIN c""",
    "failures_by_date": f"WITH {_SPOILT} {_BAD_BY_DATE.format(where='')}",
    "campaign_merge_lines": f"""WITH {_SPOILT}, b AS ({_BAD_BY_DATE.format(where="WHERE event_type IN ('click', 'view')")}),
v AS (SELECT flight_date, (floor(seconds / 600) * 600)::BIGINT AS slot_s, avg(value) FILTER (WHERE event_type = 'click') AS a, avg(value) FILTER (WHERE event_type = 'view') AS b, avg(user_id) FILTER (WHERE event_type = 'view') AS c
 FROM sp WHERE NOT lost AND reason IS NULL AND event_type IN ('click', 'view') GROUP BY 1, 2)
 SELECT d.flight_date, g.slot_s, round(a, 6) AS "Probe_click_value", round(v.b, 6) AS "Probe_view_value", round(c, 6) AS "Probe_view_user", n_files, n_bad_files, n_bad_rows, failed
 FROM (SELECT DISTINCT flight_date FROM v) d CROSS JOIN range(0, 86400, 600) AS g(slot_s) LEFT JOIN v ON v.flight_date = d.flight_date AND v.slot_s = g.slot_s JOIN b ON b.flight_date = d.flight_date""",
    "campaign_metadata": f"""WITH {_SPOILT}, t AS (SELECT DISTINCT 'Probe ' || event_type AS title FROM sp WHERE NOT lost AND event_type IN ('click', 'view'))
 SELECT title, v.* FROM t CROSS JOIN (VALUES ('value.units', 'counts'), ('value.standard', 'std_STP'), ('value.description', 'the value, in counts'), ('user.units', 'none'), ('DATA_INFO', 'made')) AS v(field, value)""",
}

SQL |= {
    "stage_rerun": f"""WITH {_QC}, ch AS (SELECT flight_date, ts, event_id, cloud_raw OR flight_date = '2024-01-10' AS c FROM o)
 SELECT flight_date, event_id, CAST(max(CAST(c AS INTEGER)) OVER (ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) = 1 AS VARCHAR) AS cloudy FROM ch""",
    "window_broadcast_bucketed": SQL["window_broadcast"],
    "assemble_bucketed": SQL["assemble"],
    "stream_legs": SQL["flight_legs"],
}
