"""Composites, yearly statistics, trends, phenology and intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import composite, events, intervals, phenology, recovery, series
from .catalogue import query
from .standins import MONTHLY, MONTHLY_CLS, MONTHS, OBS, SALES, YEARLY, breaks, monthly_cls, monthly_nir, sales, yearly

RULES = [(0, "fallback_occurrence", 2, 2, None, None), (1, "fallback_occurrence", 1, 2, 60, 300)]
ANY = [(2, "any_occurrence", 1, 1, None, None), (0, "fallback_occurrence", 1, 2, 300, 90)]


@query("px l, month s, cls l, votes l", f"WITH {OBS} SELECT px, date_trunc('month', obs_date)::DATE AS month, cls, count(*) AS votes FROM obs GROUP BY ALL")
def monthly_vote_counts(spark, sf):
    return composite.vote_counts(sales(spark, sf), SALES)


def _composite_sql(rules: list[tuple]) -> str:
    rule = "CASE " + " ".join(
        f"WHEN cls = {c} AND {('mid BETWEEN %s AND %s' % (a, b) if a <= b else '(mid >= %s OR mid <= %s)' % (a, b)) if a and k == 'fallback_occurrence' else 'true'} THEN '{k}'" for c, k, _, _, a, b in rules
    ) + " ELSE 'median' END"
    prio = "CASE cls " + " ".join(f"WHEN {r[0]} THEN {r[2]}" for r in rules) + " ELSE 0 END"
    least = "CASE cls " + " ".join(f"WHEN {r[0]} THEN {r[3]}" for r in rules) + " ELSE 1 END"
    return f"""WITH {OBS}, v0 AS (SELECT px, date_trunc('month', obs_date)::DATE AS month, cls, count(*) AS n FROM obs GROUP BY ALL),
    v1 AS (SELECT *, dayofyear(month + INTERVAL 14 DAY) AS mid FROM v0),
    v2 AS (SELECT *, {rule} AS rule, {prio} AS prio, {least} AS least FROM v1),
    v3 AS (SELECT *, sum(n) OVER g AS tot, sum(CASE WHEN rule <> 'fallback_occurrence' THEN n ELSE 0 END) OVER g AS plain FROM v2 WINDOW g AS (PARTITION BY px, month)),
    pass AS (SELECT px, month, cls, CASE WHEN rule = 'any_occurrence' THEN 1 WHEN rule = 'median' AND 2 * n > plain THEN 2 WHEN rule = 'fallback_occurrence' AND n >= least(least, tot) THEN 3 WHEN rule = 'fallback_occurrence' THEN 4 END AS p,
      CASE WHEN rule = 'fallback_occurrence' AND n < least(least, tot) THEN -prio ELSE prio END AS o FROM v3),
    win AS (SELECT px, month, cls FROM pass WHERE p IS NOT NULL QUALIFY row_number() OVER (PARTITION BY px, month ORDER BY p, o, cls DESC) = 1)
    SELECT DISTINCT v0.px, v0.month, win.cls FROM v0 LEFT JOIN win USING (px, month)"""


@query("px l, month s, cls l", _composite_sql(RULES))
def monthly_class_composite(spark, sf):
    return composite.monthly_class(sales(spark, sf), RULES, SALES)


@query("px l, month s, cls l", _composite_sql(ANY))
def monthly_class_any_occurrence(spark, sf):
    return composite.monthly_class(sales(spark, sf), ANY, SALES)


@query(
    "px l, month s, index_name s, median d, min d, max d, n_obs l",
    f"""WITH {OBS}, u AS (SELECT px, date_trunc('month', obs_date)::DATE AS month, 'nir' AS index_name, nir AS v FROM obs UNION ALL SELECT px, date_trunc('month', obs_date)::DATE, 'red', red FROM obs)
    SELECT px, month, index_name, median(v) AS median, min(v) AS min, max(v) AS max, count(v) AS n_obs FROM u GROUP BY ALL""",
)
def monthly_index_stats(spark, sf):
    return composite.monthly_stats(sales(spark, sf), ["nir", "red"], SALES)


@query(
    "px l, sensor s, bin l, bin_date s, nir d, n_obs l, cls l",
    f"""WITH {OBS}, f AS (SELECT tile, min(obs_date) AS d0 FROM obs GROUP BY tile),
    sc AS (SELECT DISTINCT o.tile, o.sensor, o.obs_date, floor((o.obs_date - d0) / 15)::INT AS bin FROM obs o JOIN f USING (tile)),
    pl AS (SELECT *, DATE '1970-01-01' + round_even(avg(obs_date - DATE '1970-01-01') OVER (PARTITION BY tile, sensor, bin), 0)::INT AS bin_date FROM sc),
    b AS (SELECT obs.*, bin, bin_date FROM obs JOIN pl USING (tile, sensor, obs_date)),
    m0 AS (SELECT px, sensor, bin, bin_date, cls, count(*) AS n FROM b GROUP BY ALL),
    m AS (SELECT * FROM m0 QUALIFY row_number() OVER (PARTITION BY px, sensor, bin, bin_date ORDER BY n DESC, cls) = 1)
    SELECT b.px, b.sensor, b.bin, b.bin_date, median(nir) AS nir, count(*) AS n_obs, any_value(m.cls) AS cls FROM b JOIN m USING (px, sensor, bin, bin_date) GROUP BY ALL""",
)
def sensor_bin_median(spark, sf):
    return composite.binned_medians(sales(spark, sf), ["nir"], ["tile"], SALES, 15)


@query(
    "px l, sensor s, scene_id s",
    f"WITH {OBS} SELECT px, sensor, scene_id FROM obs QUALIFY row_number() OVER (PARTITION BY px ORDER BY CASE sensor WHEN 's2' THEN 1 WHEN 'l9' THEN 2 WHEN 'l8' THEN 3 WHEN 'l7' THEN 4 ELSE 5 END, scene_id) = 1",
)
def reference_scene_pick(spark, sf):
    return composite.reference_scene(sales(spark, sf), ["px"], SALES, ["s2", "l9", "l8", "l7", "l5"])


@query(
    "px l, year l, gs_mean d, annual_max d, n_obs l",
    f"""WITH {MONTHLY}, y AS (SELECT px, year(month) AS year, avg(CASE WHEN month(month) BETWEEN 5 AND 10 THEN v END) AS a, max(v) AS b, count(CASE WHEN month(month) BETWEEN 5 AND 10 THEN v END) AS n_obs FROM mon GROUP BY ALL)
    SELECT px, year, CASE WHEN n_obs >= 2 THEN a END AS gs_mean, CASE WHEN n_obs >= 2 THEN b END AS annual_max, n_obs FROM y""",
)
def yearly_season_stats(spark, sf):
    return series.yearly_stats(monthly_nir(spark, sf), "v", MONTHS)


@query("px l, low d, n_obs l", f"WITH {MONTHLY}, s AS (SELECT px, list_sort(list(v)) AS a FROM mon GROUP BY px) SELECT px, a[least(len(a) - 1, floor(0.1 * (len(a) - 1) + 0.5)::INT) + 1] AS low, len(a) AS n_obs FROM s")
def nearest_rank_low(spark, sf):
    return series.low_values(monthly_nir(spark, sf), "v", MONTHS)


CLIM = MONTHLY + """, c0 AS (SELECT px, month(month) AS moy, v, median(v) OVER (PARTITION BY px, month(month)) AS centre FROM mon),
cl AS (SELECT px, moy, any_value(centre) AS centre, greatest(coalesce(median(abs(v - centre)) * 1.4826, 0), 0.02) AS scale, count(v) AS n FROM c0 GROUP BY ALL HAVING count(v) >= 5)"""


@query("px l, moy l, centre f, scale f, n l", f"WITH {CLIM} SELECT * FROM cl")
def climatology_mad(spark, sf):
    return series.climatology(monthly_nir(spark, sf), "v", MONTHS)


@query(
    "px l, moy l, centre d, scale d, n l",
    f"WITH {MONTHLY} SELECT px, month(month) AS moy, avg(v) AS centre, greatest(coalesce(stddev_samp(v), 0), 0.02) AS scale, count(v) AS n FROM mon WHERE year(month) BETWEEN 1995 AND 2000 GROUP BY ALL HAVING count(v) >= 5",
)
def climatology_mean(spark, sf):
    return series.climatology(monthly_nir(spark, sf), "v", MONTHS, base=(1995, 2000), robust=False)


Z = CLIM + ", z AS (SELECT mon.px, mon.month, mon.v, (mon.v - centre) / scale AS z FROM mon LEFT JOIN cl ON mon.px = cl.px AND month(mon.month) = cl.moy)"


@query("px l, month s, v d, z d", f"WITH {Z} SELECT * FROM z")
def anomaly_zscores(spark, sf):
    return series.z_scores(monthly_nir(spark, sf), "v", MONTHS)


@query(
    "px l, year l, gs_mean_z d, min_z d, n_low l, n_high l",
    f"WITH {Z} SELECT px, year(month) AS year, avg(CASE WHEN month(month) BETWEEN 5 AND 10 THEN z END) AS gs_mean_z, min(z) AS min_z, count(*) FILTER (z <= -2) AS n_low, count(*) FILTER (z >= 2) AS n_high FROM z WHERE z IS NOT NULL GROUP BY ALL",
)
def anomaly_yearly(spark, sf):
    return series.yearly_anomaly(series.z_scores(monthly_nir(spark, sf), "v", MONTHS), MONTHS)


@query("px l, worst_time s, worst_z d", f"WITH {Z} SELECT px, month AS worst_time, z AS worst_z FROM z WHERE z IS NOT NULL QUALIFY row_number() OVER (PARTITION BY px ORDER BY abs(z) DESC, month) = 1")
def anomaly_worst(spark, sf):
    return series.worst_anomaly(series.z_scores(monthly_nir(spark, sf), "v", MONTHS), MONTHS)


@query(
    "px l, n_years l, cv d, mean_abs_change d",
    f"""WITH {YEARLY}, s AS (SELECT *, CASE WHEN year - lag(year) OVER w = 1 THEN abs(v - lag(v) OVER w) END AS step FROM yr WINDOW w AS (PARTITION BY px ORDER BY year))
    SELECT px, count(v) AS n_years, CASE WHEN count(v) >= 5 AND abs(avg(v)) > 1e-3 THEN stddev_samp(v) / abs(avg(v)) END AS cv, CASE WHEN count(v) >= 5 THEN avg(step) END AS mean_abs_change FROM s GROUP BY px""",
)
def variability_cv(spark, sf):
    return series.variability(yearly(spark, sf), "v", MONTHS)


ERFC = "(1/(1+0.3275911*x))*(0.254829592+(1/(1+0.3275911*x))*(-0.284496736+(1/(1+0.3275911*x))*(1.421413741+(1/(1+0.3275911*x))*(-1.453152027+(1/(1+0.3275911*x))*1.061405429))))*exp(-x*x)"


def _trend_sql(years: str, least: int) -> str:
    return f"""{years}, pr AS (SELECT a.px, b.v - a.v AS d, (b.v - a.v) / (b.year - a.year) AS m FROM ty a JOIN ty b ON a.px = b.px AND a.year < b.year),
    ag AS (SELECT px, median(m) AS slope, sum(sign(d)) AS s FROM pr GROUP BY px), n AS (SELECT px, count(*) AS n_years FROM ty GROUP BY px),
    zz AS (SELECT n.px, n_years, slope, coalesce(s, 0) AS s, CASE WHEN s = 0 THEN 0 ELSE (s - sign(s)) / sqrt(n_years * (n_years - 1) * (2 * n_years + 5) / 18.0) END AS z FROM n LEFT JOIN ag USING (px)),
    x AS (SELECT *, abs(z) / sqrt(2) AS x FROM zz)
    SELECT px, n_years, CASE WHEN n_years >= {least} THEN slope END AS slope, CASE WHEN n_years >= {least} THEN s END AS mk_s, CASE WHEN n_years >= {least} THEN z END AS mk_z, CASE WHEN n_years >= {least} THEN {ERFC} END AS mk_p FROM x"""


@query("px l, n_years l, slope d, mk_s l, mk_z d, mk_p d", _trend_sql(f"WITH {YEARLY}, ty AS (SELECT * FROM yr)", 6))
def theil_sen_trend(spark, sf):
    return series.trend(yearly(spark, sf), "v", MONTHS, least=6)


@query(
    "px l, n_years l, slope d, mk_s l, mk_z d, mk_p d",
    _trend_sql(f"WITH {YEARLY}, lb AS (SELECT px, year(min(obs_date)) + 1 AS y0 FROM obs WHERE nir > 0.9 GROUP BY px), ty AS (SELECT yr.* FROM yr JOIN lb USING (px) WHERE year >= y0)", 4),
)
def trend_since_break(spark, sf):
    first = breaks(spark, sf).groupBy("px").agg((F.year(F.min("t_break")) + 1).alias("y0"))
    return series.trend(yearly(spark, sf).join(first, "px"), "v", MONTHS, least=4, since="y0")


@query(
    "px l, water_year l, observed l, snow l, firn l, ice l, water l, first_snow l, last_snow l",
    f"""WITH {MONTHLY_CLS}, w AS (SELECT px, cls, CASE WHEN month(month) >= 10 THEN year(month) ELSE year(month) - 1 END AS water_year, (month(month) - 10 + 12) % 12 + 1 AS m FROM mc)
    SELECT px, water_year, count(*) AS observed, count(*) FILTER (cls = 0) AS snow, 0 AS firn, count(*) FILTER (cls = 1) AS ice, count(*) FILTER (cls = 2) AS water, min(CASE WHEN cls = 0 THEN m END) AS first_snow, max(CASE WHEN cls = 0 THEN m END) AS last_snow FROM w GROUP BY ALL""",
)
def water_year_summary(spark, sf):
    return series.water_years(monthly_cls(spark, sf), MONTHS, 0, 9, 1, 2)


@query(
    "px l, year l, n_obs l, a d, n d",
    f"WITH {MONTHLY_CLS} SELECT px, year(month) AS year, count(*) AS n_obs, avg((cls = 0)::INT) AS a, avg((cls = 1)::INT) AS n FROM mc WHERE month(month) BETWEEN 5 AND 10 GROUP BY ALL",
)
def season_class_shares(spark, sf):
    return series.season_shares(monthly_cls(spark, sf), MONTHS, {"a": [0], "n": [1]})


PHENO = MONTHLY + """, lo AS (SELECT px, list_sort(list(v)) AS a FROM mon GROUP BY px), lw AS (SELECT px, a[least(len(a) - 1, floor(0.1 * (len(a) - 1) + 0.5)::INT) + 1] AS low FROM lo),
m AS (SELECT mon.px, year(month) AS year, month(month) - 1 AS m, v, low FROM mon JOIN lw USING (px)),
p AS (SELECT *, count(*) OVER g AS n, max(v) OVER g AS peak FROM m WINDOW g AS (PARTITION BY px, year)),
t AS (SELECT *, min(CASE WHEN v = peak THEN m END) OVER (PARTITION BY px, year) AS pm, low + 0.5 * (peak - low) AS cut FROM p),
s AS (SELECT *, lead(m) OVER w AS m1, lead(v) OVER w AS v1, lag(m) OVER w AS m0, lag(v) OVER w AS v0 FROM t WINDOW w AS (PARTITION BY px, year ORDER BY m)),
fwd AS (SELECT px, year, min(CASE WHEN m1 - m > 2 OR v1 < cut THEN m END) AS stop FROM s WHERE m >= pm AND m1 IS NOT NULL GROUP BY ALL),
bwd AS (SELECT px, year, max(CASE WHEN m - m0 > 2 OR v0 < cut THEN m END) AS stop FROM s WHERE m <= pm AND m0 IS NOT NULL GROUP BY ALL),
e AS (SELECT s.px, s.year, round((m + 0.5 + (v - cut) / (v - v1) * (m1 - m)) * 30.4375) AS end_doy FROM s JOIN fwd USING (px, year) WHERE m = stop AND m1 - m <= 2 AND v1 < cut),
b AS (SELECT s.px, s.year, round((m + 0.5 + (v - cut) / (v - v0) * (m0 - m)) * 30.4375) AS start_doy FROM s JOIN bwd USING (px, year) WHERE m = stop AND m - m0 <= 2 AND v0 < cut),
y AS (SELECT px, year, any_value(n) AS n, any_value(pm) + 1 AS peak_month, any_value(peak) AS peak, any_value(peak - low) AS amplitude FROM t GROUP BY ALL),
r AS (SELECT y.*, CASE WHEN n >= 5 AND amplitude >= 0.08 THEN start_doy END AS start_doy, CASE WHEN n >= 5 AND amplitude >= 0.08 THEN end_doy END AS end_doy FROM y LEFT JOIN b USING (px, year) LEFT JOIN e USING (px, year))"""


@query(
    "px l, year l, peak_month l, peak d, amplitude d, start_doy l, end_doy l, season_days l",
    f"WITH {PHENO} SELECT px, year, CASE WHEN n >= 5 THEN peak_month END AS peak_month, CASE WHEN n >= 5 THEN peak END AS peak, CASE WHEN n >= 5 THEN amplitude END AS amplitude, start_doy, end_doy, CASE WHEN end_doy > start_doy THEN end_doy - start_doy END AS season_days FROM r",
)
def phenology_dates(spark, sf):
    m = monthly_nir(spark, sf)
    return phenology.phenology(m.join(series.low_values(m, "v", MONTHS).select("px", "low"), "px"), "v", "low", MONTHS)


INTERVALS = MONTHLY_CLS + """, iv0 AS (SELECT px, (year(month) - 1970) * 12 + month(month) - 1 AS m, (cls = 1)::INT AS hit FROM mc),
iv1 AS (SELECT *, row_number() OVER w AS k, sum(hit) OVER f AS hits, min(CASE WHEN hit = 1 THEN m END) OVER f AS fh, lead(m) OVER w AS nx FROM iv0 WINDOW w AS (PARTITION BY px ORDER BY m), f AS (PARTITION BY px ORDER BY m ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
iv2 AS (SELECT *, last_value(CASE WHEN hit = 1 THEN nx END IGNORE NULLS) OVER (PARTITION BY px ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ah FROM iv1),
iv3 AS (SELECT *, CASE WHEN k >= 5 AND hits >= 3 THEN 1 WHEN k >= 5 AND hits <= 1 THEN -1 END AS d FROM iv2),
iv4 AS (SELECT *, coalesce(lag(d) OVER (PARTITION BY px ORDER BY m), -1) AS pd FROM iv3 WHERE d IS NOT NULL),
iv5 AS (SELECT *, lead(ah) OVER (PARTITION BY px ORDER BY m) AS en FROM iv4 WHERE d <> pd),
iv6 AS (SELECT *, row_number() OVER (PARTITION BY px ORDER BY m) AS interval FROM iv5 WHERE d = 1),
lm AS (SELECT px, max(m) AS lm FROM iv0 GROUP BY px),
iv AS (SELECT px, 1 AS class, interval, (DATE '1970-01-01' + to_months(fh::INT))::DATE AS start_month, (DATE '1970-01-01' + to_months(en::INT))::DATE AS end_month FROM iv6 JOIN lm USING (px) WHERE interval <= 8 AND coalesce(en, lm + 1) - fh >= 6)"""


def _intervals(spark, sf):
    return intervals.intervals(monthly_cls(spark, sf), 1, MONTHS, start_share=0.6, least_months=6)


@query("px l, class l, interval l, start_month s, end_month s", f"WITH {INTERVALS} SELECT * FROM iv")
def persistence_intervals(spark, sf):
    return _intervals(spark, sf)


@query(
    "px l, interval l, start_month s, break_date s",
    f"""WITH {INTERVALS}, bk AS (SELECT px, obs_date AS t, max(red) AS d FROM obs WHERE nir > 0.9 GROUP BY ALL HAVING max(red) >= 0.1),
    nr AS (SELECT iv.px, interval, t, (year(t) - year(start_month)) * 12 + month(t) - month(start_month) AS gap FROM iv JOIN bk USING (px)),
    bs AS (SELECT px, interval, t FROM nr WHERE gap BETWEEN -18 AND 6 QUALIFY row_number() OVER (PARTITION BY px, interval ORDER BY abs(gap), t) = 1)
    SELECT iv.px, iv.interval, start_month, t AS break_date FROM iv LEFT JOIN bs USING (px, interval)""",
)
def interval_break_match(spark, sf):
    return intervals.match_breaks(_intervals(spark, sf), breaks(spark, sf), MONTHS)


@query("px l, class l, n l, first_start s, last_end s, active b", f"WITH {INTERVALS} SELECT px, class, count(*) AS n, min(start_month) AS first_start, max(end_month) AS last_end, bool_or(end_month IS NULL) AS active FROM iv GROUP BY ALL")
def interval_summary(spark, sf):
    return intervals.summarize(_intervals(spark, sf), MONTHS)


DOMINANT = MONTHLY_CLS + """, dk AS (SELECT px, year(month) AS year, cls, count(*) AS n FROM mc WHERE month(month) BETWEEN 5 AND 10 GROUP BY ALL),
dc AS (SELECT px, year, CASE WHEN sum(n) OVER (PARTITION BY px, year) >= 2 THEN cls END AS cls, sum(n) OVER (PARTITION BY px, year) AS n_obs FROM dk QUALIFY row_number() OVER (PARTITION BY px, year ORDER BY n DESC, cls) = 1)"""


@query("px l, year l, cls l, n_obs l", f"WITH {DOMINANT} SELECT * FROM dc")
def dominant_class_season(spark, sf):
    return recovery.dominant_class(monthly_cls(spark, sf), MONTHS)


SEQ = DOMINANT + """, ev AS (SELECT px, year(min(obs_date)) AS event_year, CASE WHEN px % 2 = 0 THEN 'fire' ELSE 'cutblock' END AS event_type FROM obs WHERE nir > 0.9 GROUP BY px),
sq AS (SELECT ev.*, dc.cls, year - event_year AS k FROM ev JOIN dc USING (px) WHERE year - event_year BETWEEN 0 AND 20)"""


def _events(spark, sf):
    return breaks(spark, sf).groupBy("px").agg(F.year(F.min("t_break")).alias("event_year")).withColumn("event_type", F.when(F.col("px") % 2 == 0, "fire").otherwise("cutblock"))


def _sequence(spark, sf):
    return recovery.since_event(recovery.dominant_class(monthly_cls(spark, sf), MONTHS), _events(spark, sf), MONTHS)


@query(
    "event_type s, from_class l, to_class l, count l, prob d",
    f"""WITH {SEQ}, p AS (SELECT *, lag(cls) OVER w AS f, k - lag(k) OVER w AS g FROM sq WINDOW w AS (PARTITION BY px ORDER BY k)), c AS (SELECT event_type, f AS from_class, cls AS to_class, count(*) AS count FROM p WHERE f IS NOT NULL AND cls IS NOT NULL AND g = 1 GROUP BY ALL)
    SELECT *, count / sum(count) OVER (PARTITION BY event_type, from_class) AS prob FROM c""",
)
def transition_matrix(spark, sf):
    return recovery.transitions(_sequence(spark, sf), ["px"], "event_type", "cls")


@query(
    "event_type s, years_since l, cls l, n_observed l, share d",
    f"WITH {SEQ}, c AS (SELECT event_type, k AS years_since, cls, count(*) AS n FROM sq WHERE cls IS NOT NULL GROUP BY ALL) SELECT event_type, years_since, cls, sum(n) OVER w AS n_observed, n / sum(n) OVER w AS share FROM c WINDOW w AS (PARTITION BY event_type, years_since)",
)
def class_share_by_age(spark, sf):
    return recovery.class_shares(_sequence(spark, sf), "event_type", "cls")


@query(
    "px l, n_changes l, first_forest l, final_class l, n_observed l",
    f"""WITH {SEQ}, p AS (SELECT *, coalesce(k - lag(k) OVER w = 1 AND cls <> lag(cls) OVER w, false) AS st FROM sq WINDOW w AS (PARTITION BY px ORDER BY k))
    SELECT px, count(*) FILTER (st) AS n_changes, min(CASE WHEN cls = 1 THEN k END) AS first_forest, max_by(cls, k) AS final_class, count(*) AS n_observed FROM p WHERE cls IS NOT NULL GROUP BY px""",
)
def succession_summary(spark, sf):
    return recovery.succession(_sequence(spark, sf), ["px"], "cls", 1)


@query("px l, cls l, years l", f"WITH {SEQ} SELECT px, cls, count(*) AS years FROM sq WHERE cls IS NOT NULL GROUP BY ALL")
def time_in_class(spark, sf):
    return recovery.time_in_class(_sequence(spark, sf), ["px"], "cls")


CURVES = YEARLY + """, ev AS (SELECT DISTINCT px, 1998 AS event_year, CASE WHEN px % 2 = 0 THEN 'fire' ELSE 'cutblock' END AS event_type FROM obs),
q AS (SELECT ev.*, year - event_year AS k, v FROM ev JOIN yr USING (px) WHERE year - event_year BETWEEN -3 AND 20),
ba AS (SELECT px, event_year, event_type, CASE WHEN count(*) FILTER (k < 0) >= 2 THEN median(v) FILTER (k < 0) END AS baseline FROM q GROUP BY ALL),
rl AS (SELECT q.px, k, v / baseline AS r FROM q JOIN ba USING (px) WHERE k >= 0 AND baseline >= 0.05),
tr AS (SELECT px, min(r) AS trough, arg_min(k, (r, k)) AS trough_year, max(k) AS last_observed_year FROM rl GROUP BY px),
su AS (SELECT rl.px, k, r >= 0.95 AND lead(r) OVER (PARTITION BY rl.px ORDER BY k) >= 0.95 AS ok FROM rl),
rc AS (SELECT su.px, min(k) AS recovery_year FROM su JOIN tr USING (px) WHERE ok AND k >= trough_year GROUP BY su.px),
cu AS (SELECT ba.*, trough, trough_year, recovery_year, last_observed_year, CASE WHEN NOT coalesce(baseline >= 0.05, false) THEN 'no_baseline' WHEN recovery_year IS NOT NULL THEN 'recovered' ELSE 'censored' END AS status, trough < 0.95 AS dropped,
  CASE WHEN coalesce(recovery_year, last_observed_year) > trough_year THEN ((SELECT any_value(r) FROM rl WHERE rl.px = ba.px AND rl.k = coalesce(recovery_year, last_observed_year)) - trough) / (coalesce(recovery_year, last_observed_year) - trough_year) END AS rate
  FROM ba LEFT JOIN tr USING (px) LEFT JOIN rc USING (px))"""


def _curves(spark, sf):
    ev = sales(spark, sf).select("px").distinct().withColumn("event_year", F.lit(1998)).withColumn("event_type", F.when(F.col("px") % 2 == 0, "fire").otherwise("cutblock"))
    return recovery.curves(yearly(spark, sf), ev, "v", MONTHS, threshold=0.95)


@query("px l, baseline d, trough d, trough_year l, recovery_year l, last_observed_year l, status s, dropped b, rate d", f"WITH {CURVES} SELECT * FROM cu")
def recovery_curve(spark, sf):
    return _curves(spark, sf)


@query(
    "factor s, kind s, bin s, n l, n_recovered l, median_years d, by_2 d, share_recovered d",
    f"""WITH {CURVES}, u AS (SELECT *, 'size' AS factor, CASE WHEN px >= 60 THEN '2' WHEN px >= 30 THEN '1' ELSE '0' END AS bin FROM cu UNION ALL SELECT *, 'parity', (px % 2)::VARCHAR FROM cu),
    g AS (SELECT *, unnest(['all', event_type]) AS kind FROM u WHERE baseline IS NOT NULL AND last_observed_year IS NOT NULL)
    SELECT factor, kind, bin, count(*) AS n, count(recovery_year) AS n_recovered, median(recovery_year) AS median_years, CASE WHEN count(*) FILTER (last_observed_year >= 5) >= 5 THEN count(*) FILTER (last_observed_year >= 5 AND recovery_year <= 5) / count(*) FILTER (last_observed_year >= 5) END AS by_2, count(recovery_year) / count(*) AS share_recovered
    FROM g GROUP BY factor, kind, bin HAVING count(*) >= 5""",
)
def factor_bins(spark, sf):
    from ..functions.ids import bin_index

    c = _curves(spark, sf)
    return recovery.factor_summary(c, {"size": bin_index(F.col("px"), [0, 30, 60, 1000]), "parity": F.col("px") % 2}, "event_type").withColumnRenamed("by_5", "by_2")


LADDER = events.Rules(min_drop=0.1, forest=0.6, cleared=0.4, pre_forest=0.35, cleared_years=2, burned=0.3)


def _seasons(spark, sf):
    b = breaks(spark, sf).withColumnRenamed("t_break", "break_date").select("px", "break_date", "drop", "rise")
    return events.seasons_around(b, monthly_cls(spark, sf), MONTHS, 1, 2, 0, LADDER)


# The seasons of a break go one by one through a recursion that has the fold's state as its columns.
SEASONS = MONTHLY_CLS + """, ss AS (SELECT px, year(month) AS y, avg((cls = 1)::INT) AS f, avg((cls = 2)::INT) AS b, avg((cls = 0)::INT) AS g FROM mc WHERE month(month) BETWEEN 5 AND 10 GROUP BY ALL HAVING count(*) >= 2),
bk AS (SELECT px, obs_date AS break_date, max(red) AS drop_, max(green) AS rise FROM obs WHERE nir > 0.9 GROUP BY ALL),
be AS (SELECT bk.px, break_date, f, row_number() OVER (PARTITION BY bk.px, break_date ORDER BY y DESC) AS k FROM bk JOIN ss ON ss.px = bk.px AND y < year(break_date)),
pf AS (SELECT px, break_date, count(*) >= 2 AND sum(f) / 2 >= 0.35 AS pre_forest FROM be WHERE k <= 2 GROUP BY ALL),
af AS (SELECT bk.px, break_date, y, f, b, g, row_number() OVER w AS k, lead(f) OVER w AS nf FROM bk JOIN ss ON ss.px = bk.px AND y >= year(break_date) + CASE WHEN month(break_date) < 5 THEN 0 ELSE 1 END WINDOW w AS (PARTITION BY bk.px, break_date ORDER BY y)),
rc AS (SELECT px, break_date, 0::BIGINT AS k, 0 AS stage, 0 AS cleared, 0 AS gaps, 0.0::DOUBLE AS burned, 0.0::DOUBLE AS bare, NULL::BIGINT AS back, NULL::BIGINT AS last FROM bk
  UNION ALL SELECT px, break_date, k, CASE WHEN clear THEN 0 WHEN again THEN 2 WHEN stage = 0 THEN 1 ELSE stage END, cleared + clear::INT, gaps + (clear AND noisy)::INT, burned + CASE WHEN clear AND cleared < 2 THEN b ELSE 0 END, bare + CASE WHEN clear THEN g ELSE 0 END, CASE WHEN again THEN y ELSE back END, CASE WHEN stage < 2 THEN y ELSE last END
  FROM (SELECT *, stage < 2 AND NOT clear AND f >= 0.6 AS again FROM (SELECT *, stage = 0 AND (f <= 0.4 OR noisy) AS clear FROM (SELECT rc.* EXCLUDE (k), af.k, y, f, b, g, f > 0.4 AND f < 0.6 AND gaps < 1 AND cleared >= 1 AND coalesce(nf <= 0.4, false) AS noisy FROM rc JOIN af ON af.px = rc.px AND af.break_date = rc.break_date AND af.k = rc.k + 1)))),
se AS (SELECT bk.*, coalesce(pre_forest, false) AS pre_forest, cleared AS cleared_seasons, burned / greatest(least(cleared, 2), 1) AS burned_fraction, bare / greatest(cleared, 1) AS bare_fraction, back AS recovered_year, last AS last_year, (SELECT max(year(month)) FROM mc WHERE mc.px = bk.px) AS stack_year
  FROM bk JOIN (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY px, break_date ORDER BY k DESC) = 1) USING (px, break_date) LEFT JOIN pf USING (px, break_date))"""
LADDER_SQL = SEASONS + """, q0 AS (SELECT *, (coalesce(recovered_year, greatest(coalesce(last_year, year(break_date)), year(break_date))) - year(break_date)) * 12 AS duration_months, recovered_year IS NOT NULL AS recovered, drop_ >= 0.1 AS big, burned_fraction >= 0.3 AND month(break_date) BETWEEN 6 AND 8 AS burned FROM se),
q1 AS (SELECT *, CASE WHEN big AND burned AND pre_forest AND cleared_seasons >= 1 THEN 'fire' WHEN big AND pre_forest AND cleared_seasons >= 2 AND NOT burned AND NOT recovered AND duration_months >= 96 AND bare_fraction >= 0.6 THEN 'permanent_clearing' WHEN big AND pre_forest AND cleared_seasons >= 2 AND NOT burned THEN 'cutblock'
  WHEN big AND pre_forest AND NOT recovered AND cleared_seasons = 1 AND stack_year - year(break_date) <= 2 THEN 'recent_clearing' WHEN big AND pre_forest AND cleared_seasons = 0 THEN 'canopy_decline' WHEN big AND NOT pre_forest THEN 'open_land_disturbance' WHEN big THEN 'other_loss' WHEN rise >= 0.1 THEN 'gain' ELSE 'none' END AS kind FROM q0),
ladder AS (SELECT * EXCLUDE (kind), CASE WHEN kind = 'open_land_disturbance' AND coalesce(sum((kind IN ('fire', 'cutblock', 'permanent_clearing', 'recent_clearing'))::INT) OVER (PARTITION BY px ORDER BY break_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) > 0 THEN 'regrowth_change' ELSE kind END AS event_type FROM q1)"""


def _open_runs_sql(least: int) -> str:
    """Open years one by one: the run that goes on, and the last long one before it."""
    state = ("start", "last", "seen", "total", "open", "bare", "years")
    return f"""os AS (SELECT px, year(month) AS y, avg((cls IN (0, 1))::INT) AS o, avg((cls = 0)::INT) AS g, count(*) AS n FROM mc WHERE month(month) BETWEEN 6 AND 9 GROUP BY ALL HAVING count(*) >= 2),
    ok AS (SELECT *, row_number() OVER w AS k, lead(o) OVER w AS nxt FROM os WINDOW w AS (PARTITION BY px ORDER BY y)),
    orun AS (SELECT px, 0::BIGINT AS k, {', '.join(f"NULL::DOUBLE AS n_{c}, NULL::DOUBLE AS b_{c}" for c in state)} FROM (SELECT DISTINCT px FROM os)
      UNION ALL SELECT px, k, CASE WHEN on_ THEN coalesce(n_start, y) WHEN over_ THEN NULL ELSE n_start END, {_settled('start', least)}, CASE WHEN on_ THEN y WHEN over_ THEN NULL ELSE n_last END, {_settled('last', least)}, CASE WHEN on_ THEN coalesce(n_seen, 0) + 1 WHEN over_ THEN NULL ELSE n_seen END, {_settled('seen', least)},
      CASE WHEN on_ THEN coalesce(n_total, 0) + n WHEN over_ THEN NULL ELSE n_total END, {_settled('total', least)}, CASE WHEN on_ THEN coalesce(n_open, 0) + o * n WHEN over_ THEN NULL ELSE n_open END, {_settled('open', least)}, CASE WHEN on_ THEN coalesce(n_bare, 0) + g * n WHEN over_ THEN NULL ELSE n_bare END, {_settled('bare', least)}, CASE WHEN on_ THEN coalesce(n_years, 0) + (g > 0)::INT WHEN over_ THEN NULL ELSE n_years END, {_settled('years', least)}
      FROM (SELECT *, NOT on_ AND o < 0.5 AND NOT (n_seen IS NOT NULL AND coalesce(nxt >= 0.8, false)) AS over_ FROM (SELECT orun.* EXCLUDE (k), ok.k, y, o, g, n, nxt, o >= 0.5 AND (n_seen IS NOT NULL OR o >= 0.8) AS on_ FROM orun JOIN ok ON ok.px = orun.px AND ok.k = orun.k + 1))),
    oend AS (SELECT * FROM orun QUALIFY row_number() OVER (PARTITION BY px ORDER BY k DESC) = 1),
    runs AS (SELECT px, {', '.join(f"CASE WHEN coalesce(n_seen >= {least}, false) THEN n_{c} ELSE b_{c} END AS {c}" for c in state)} FROM oend WHERE coalesce(n_seen >= {least}, false) OR b_seen IS NOT NULL)"""


def _settled(c: str, least: int) -> str:
    return f"CASE WHEN over_ AND coalesce(n_seen >= {least}, false) THEN n_{c} ELSE b_{c} END"


@query("px l, break_date s, pre_forest b, cleared_seasons l, burned_fraction d, bare_fraction d, recovered_year l, last_year l", f"WITH RECURSIVE {SEASONS} SELECT * FROM se")
def seasons_around_breaks(spark, sf):
    return _seasons(spark, sf)


@query("px l, break_date s, event_type s, duration_months l, recovered b", f"WITH RECURSIVE {LADDER_SQL} SELECT * FROM ladder")
def event_ladder(spark, sf):
    return events.name_events(_seasons(spark, sf), MONTHS, LADDER)


@query(
    "px l, event_type s, event_year l, cut_months l",
    f"WITH RECURSIVE {LADDER_SQL} SELECT px, max_by(event_type, break_date) AS event_type, year(max(break_date)) AS event_year, max_by(duration_months, break_date) FILTER (event_type IN ('cutblock', 'permanent_clearing')) AS cut_months FROM ladder WHERE event_type <> 'none' GROUP BY px",
)
def latest_event(spark, sf):
    return events.latest_event(events.name_events(_seasons(spark, sf), MONTHS, LADDER), MONTHS)


@query("px l, start_year l, end_year l, years l, closed_share d, bare_share d, bare_years l", f"WITH RECURSIVE {MONTHLY_CLS}, {_open_runs_sql(3)} SELECT px, start AS start_year, last AS end_year, seen AS years, 1 - open / total AS closed_share, bare / total AS bare_share, years AS bare_years FROM runs")
def open_land_runs(spark, sf):
    return events.open_runs(monthly_cls(spark, sf), MONTHS, 1, 0, r=events.Rules(crop_years=3))


@query("px l, event_type s, break_date s", f"WITH RECURSIVE {LADDER_SQL}, {_open_runs_sql(5)} SELECT px, CASE WHEN event_type <> 'none' AND px IN (SELECT px FROM runs) THEN 'cropland_change' ELSE event_type END AS event_type, break_date FROM ladder")
def cropland_membership(spark, sf):
    """Events of series with an open run, retyped."""
    named = events.name_events(_seasons(spark, sf), MONTHS, LADDER)
    fields = events.open_runs(monthly_cls(spark, sf), MONTHS, 1, 0, r=events.Rules(crop_years=5))
    return events.in_cropland(named, fields, MONTHS)
