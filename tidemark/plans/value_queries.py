"""Radiometry, indices, dates, ids and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import ids, indices, radiometry
from ..sources import products
from .catalogue import query
from .standins import OBS, sales, table

KEY = "ok l, ln l"
ND = ", ".join(f"({a} - {b}) / ({a} + {b} + 1e-6) AS {n}" for n, (a, b) in indices.NORMALIZED.items())


@query(KEY + ", " + ", ".join(f"{n} d" for n in indices.NORMALIZED), f"WITH {OBS} SELECT ok, ln, {ND} FROM obs")
def spectral_indices(spark, sf):
    return indices.with_indices(sales(spark, sf), list(indices.NORMALIZED))


@query(KEY + ", CHROMA_R d, CHROMA_G d, CHROMA_B d, BSI d, SAVI d", f"WITH {OBS} SELECT ok, ln, red / (red + green + blue + 1e-6) AS CHROMA_R, green / (red + green + blue + 1e-6) AS CHROMA_G, blue / (red + green + blue + 1e-6) AS CHROMA_B, ((swir1 + red) - (nir + blue)) / ((swir1 + red) + (nir + blue) + 1e-6) AS BSI, 1.5 * (nir - red) / (nir + red + 0.5) AS SAVI FROM obs")
def chromaticity_bsi_savi(spark, sf):
    return indices.with_indices(sales(spark, sf), ["CHROMA_R", "CHROMA_G", "CHROMA_B", "BSI", "SAVI"])


@query(KEY + ", EVI d", f"WITH {OBS}, d AS (SELECT *, nir + 6.0 * red - 7.5 * blue + 1.0 AS u FROM obs) SELECT ok, ln, greatest(-1.0, least(1.0, 2.5 * (nir - red) / CASE WHEN abs(u) < 1e-6 THEN 1e-6 ELSE u END)) AS EVI FROM d")
def evi_clipped(spark, sf):
    return indices.with_indices(sales(spark, sf), ["EVI"])


def _tc(n: int) -> str:
    return "CASE sensor " + " ".join(f"WHEN '{k}' THEN " + " + ".join(f"({w[n][i]}) * {b}" for i, b in enumerate(indices.BANDS)) for k, w in indices.TASSELED_CAP.items()) + " END"


@query(KEY + ", TC_BRIGHTNESS f, TC_GREENNESS f, TC_WETNESS f", f"WITH {OBS} SELECT ok, ln, {_tc(0)} AS TC_BRIGHTNESS, {_tc(1)} AS TC_GREENNESS, {_tc(2)} AS TC_WETNESS FROM obs")
def tasseled_cap(spark, sf):
    return indices.with_indices(sales(spark, sf), list(indices.TC_NAMES))


@query(KEY + ", " + ", ".join(f"{b} d" for b in indices.BANDS), f"WITH {OBS} SELECT ok, ln, " + ", ".join(f"CASE WHEN sensor = 's2' THEN {b} ELSE {b} * {s} + ({o}) END AS {b}" for b, (s, o) in indices.bandpass_table().items()) + " FROM obs")
def bandpass_adjust(spark, sf):
    return radiometry.harmonize(sales(spark, sf))


@query(KEY + ", q l, back d", f"WITH {OBS}, q AS (SELECT ok, ln, CASE WHEN nir * 7 - 0.2 >= 0 THEN trunc(least((nir * 7 - 0.2) * 10000, 65534))::INT ELSE 65535 END AS q FROM obs) SELECT *, CASE WHEN q <> 65535 THEN q / 10000.0 END AS back FROM q")
def reflectance_quantise(spark, sf):
    d = sales(spark, sf).withColumn("q", radiometry.quantise(F.col("nir") * 7 - 0.2))
    return d.withColumn("back", radiometry.dequantise(F.col("q")))


@query(KEY + ", s d, c d, h3 d", f"WITH {OBS} SELECT ok, ln, sin(2 * pi() * dayofyear(obs_date) / 365.25) AS s, cos(2 * pi() * dayofyear(obs_date) / 365.25) AS c, sin(6 * pi() * dayofyear(obs_date) / 365.25) AS h3 FROM obs")
def doy_cyclic(spark, sf):
    d = sales(spark, sf)
    s, c = cal.doy_cycle(F.col("obs_date"))
    return d.select("ok", "ln", s.alias("s"), c.alias("c"), cal.harmonics(F.col("obs_date"))[5].alias("h3"))


@query("ok l, ln l", f"WITH {OBS} SELECT ok, ln FROM obs WHERE dayofyear(obs_date) BETWEEN 152 AND 258")
def season_window_filter(spark, sf):
    return sales(spark, sf).where(cal.doy_in_window(F.dayofyear("obs_date"), 152, 258))


@query("ok l, ln l", f"WITH {OBS} SELECT ok, ln FROM obs WHERE dayofyear(obs_date) >= 330 OR dayofyear(obs_date) <= 45")
def doy_wrap_filter(spark, sf):
    return sales(spark, sf).where(cal.doy_in_window(F.dayofyear("obs_date"), 330, 45))


@query(
    KEY + ", key s, n l, code l, ord l, back s, mid l, wy l, wm l, nxt s",
    f"""WITH {OBS} SELECT ok, ln, strftime(obs_date, '%Y-%m') AS key, (year(obs_date) - 1970) * 12 + month(obs_date) - 1 AS n, year(obs_date) * 100 + month(obs_date) AS code, obs_date - DATE '1970-01-01' + 719163 AS ord, obs_date AS back,
    dayofyear(make_date(year(obs_date), month(obs_date), 15)) AS mid, CASE WHEN month(obs_date) >= 10 THEN year(obs_date) ELSE year(obs_date) - 1 END AS wy, (month(obs_date) + 2) % 12 + 1 AS wm, (date_trunc('month', obs_date) + INTERVAL 1 MONTH)::DATE AS nxt FROM obs""",
)
def month_arithmetic(spark, sf):
    d = F.col("obs_date")
    return sales(spark, sf).select(
        "ok", "ln", cal.month_key(d).alias("key"), cal.month_number(d).alias("n"), cal.month_code(cal.month_key(d)).alias("code"), cal.ordinal(d).alias("ord"), cal.from_ordinal(cal.ordinal(d)).alias("back"),
        cal.mid_month_doy(F.year(d), F.month(d)).alias("mid"), cal.water_year(d).alias("wy"), cal.water_month(d).alias("wm"), cal.month_from_number(cal.month_number(d) + 1).alias("nxt"),
    )


@query(
    KEY + ", d s, tile_id s, sensor s, scene_id s",
    f"WITH {OBS} SELECT ok, ln, obs_date AS d, 'tile_' || px AS tile_id, sensor, CASE WHEN sensor = 's2' THEN strftime(obs_date, '%Y%m%d') || 'T191911_x' ELSE 'LT05_048021_' || strftime(obs_date, '%Y%m%d') END AS scene_id FROM obs",
)
def scene_id_parse(spark, sf):
    day = F.date_format("obs_date", "yyyyMMdd")
    sid = F.when(F.col("sensor") == "s2", F.concat(day, F.lit("T191911_x"))).otherwise(F.concat(F.lit("LT05_048021_"), day))
    d = sales(spark, sf).select("ok", "ln", F.concat(F.lit("tile_"), F.col("px"), F.lit("_"), F.upper("sensor"), F.lit("_"), sid).alias("k"))
    parts = ids.split_scene_key(F.col("k"))
    d = d.withColumns(parts)
    return d.withColumn("d", ids.scene_date(F.col("sensor"), F.col("scene_id")))


@query("p_partkey l, label s, zone l, epsg l, bin l", r"SELECT p_partkey, regexp_replace(regexp_replace(trim('  ' || p_type || ' #' || p_brand || '! '), '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS label, least(60, greatest(1, floor((p_size * 7.3 - 180 + 180) / 6) + 1)) AS zone, CASE WHEN p_size >= 25 THEN 32600 ELSE 32700 END + least(60, greatest(1, floor((p_size * 7.3) / 6) + 1)) AS epsg, CASE WHEN p_size >= 30 THEN 3 WHEN p_size >= 20 THEN 2 WHEN p_size >= 10 THEN 1 ELSE 0 END AS bin FROM part")
def labels_zones_bins(spark, sf):
    p = table(spark, sf, "part")
    lon = F.col("p_size") * 7.3 - 180
    return p.select("p_partkey", ids.safe_label(F.concat(F.lit("  "), "p_type", F.lit(" #"), "p_brand", F.lit("! "))).alias("label"), ids.utm_zone(lon).alias("zone"), ids.utm_epsg(lon, F.col("p_size") - 25).alias("epsg"), ids.bin_index(F.col("p_size"), [0, 10, 20, 30, 100]).alias("bin"))


@query("n_nationkey l, sig s", """SELECT n_nationkey, sha1('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS sig FROM nation""")
def json_signature(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", ids.signature("n_regionkey", "n_name").alias("sig"))


IL = "cos(radians(90 - 30 - blue * 20)) * cos(radians(red * 200)) + sin(radians(90 - 30 - blue * 20)) * sin(radians(red * 200)) * cos(radians(green * 2000) - radians(150))"


def _terrain(spark, sf):
    return sales(spark, sf).withColumns({"slope": F.col("red") * 200, "aspect": F.col("green") * 2000, "sun_elevation": 30 + F.col("blue") * 20, "sun_azimuth": F.lit(150.0)})


@query(KEY + ", il d, north d, east d, sector l", f"WITH {OBS} SELECT ok, ln, {IL} AS il, CASE WHEN red * 200 >= 10 THEN cos(radians(green * 2000)) END AS north, CASE WHEN red * 200 >= 10 THEN sin(radians(green * 2000)) END AS east, CASE WHEN red * 200 >= 10 THEN floor(((green * 2000 + 22.5) % 360) / 45) END AS sector FROM obs")
def illumination_and_aspect(spark, sf):
    d = _terrain(spark, sf)
    n, e = radiometry.northness(F.col("slope"), F.col("aspect"), 10.0)
    return d.select("ok", "ln", radiometry.illumination(F.col("slope"), F.col("aspect"), F.col("sun_elevation"), F.col("sun_azimuth")).alias("il"), n.alias("north"), e.alias("east"), radiometry.aspect_sector(F.col("slope"), F.col("aspect"), 8, 10.0).alias("sector"))


@query(
    KEY + ", scs_c d, nir d",
    f"""WITH {OBS}, t AS (SELECT *, {IL} AS il, cos(radians(red * 200)) AS cs FROM obs), f AS (SELECT px, CASE WHEN count(*) >= 30 AND abs(regr_slope(nir, il)) >= 1e-9 AND min(il) + regr_intercept(nir, il) / regr_slope(nir, il) > 0.05 THEN regr_intercept(nir, il) / regr_slope(nir, il) ELSE 0 END AS c FROM t GROUP BY px)
    SELECT ok, ln, c AS scs_c, nir * greatest(0.2, least(5.0, CASE WHEN abs(il + c) > 1e-6 THEN (cs + c) / (il + c) ELSE 1 END)) AS nir FROM t JOIN f USING (px)""",
)
def scs_c_correction(spark, sf):
    return radiometry.scs_c(_terrain(spark, sf), ["px"], ["nir"])


SUN_G = "(2 * pi() / 365.0 * (doy - 1 + (hour - 12.0) / 24.0))"


@query(
    KEY + ", elevation d, azimuth d",
    f"""WITH {OBS}, a AS (SELECT ok, ln, dayofyear(obs_date)::DOUBLE AS doy, 8 + blue * 10 AS hour, nir * 60 AS lat, red * 900 - 60 AS lon FROM obs), b AS (SELECT *, {SUN_G} AS g FROM a),
    c AS (SELECT *, 229.18 * (0.000075 + 0.001868 * cos(g) - 0.032077 * sin(g) - 0.014615 * cos(2 * g) - 0.040849 * sin(2 * g)) AS eq, 0.006918 - 0.399912 * cos(g) + 0.070257 * sin(g) - 0.006758 * cos(2 * g) + 0.000907 * sin(2 * g) - 0.002697 * cos(3 * g) + 0.00148 * sin(3 * g) AS de, radians(lat) AS la FROM b),
    d AS (SELECT *, hour * 60 + eq + 4 * lon AS mm FROM c), e AS (SELECT *, radians((mm - 1440 * floor(mm / 1440)) / 4 - 180) AS ha FROM d),
    f AS (SELECT *, degrees(atan2(sin(ha), cos(ha) * sin(la) - tan(de) * cos(la)) + pi()) AS az FROM e)
    SELECT ok, ln, 90 - degrees(acos(greatest(-1, least(1, sin(la) * sin(de) + cos(la) * cos(de) * cos(ha))))) AS elevation, az - 360 * floor(az / 360) AS azimuth FROM f""",
)
def sun_position(spark, sf):
    d = sales(spark, sf)
    el, az = radiometry.sun_position(F.dayofyear("obs_date"), 8 + F.col("blue") * 10, F.col("nir") * 60, F.col("red") * 900 - 60)
    return d.select("ok", "ln", el.alias("elevation"), az.alias("azimuth"))


@query(KEY + ", nir l", f"WITH {OBS}, e AS (SELECT px, quantile_cont(nir, 0.02) AS a, quantile_cont(nir, 0.98) AS z FROM obs GROUP BY px) SELECT ok, ln, floor(greatest(0, least(1, (nir - a) / (z - a))) * 255) AS nir FROM obs JOIN e USING (px)")
def percentile_stretch(spark, sf):
    return radiometry.percentile_stretch(sales(spark, sf), ["px"], ["nir"])


@query(KEY + ", x d", f"WITH {OBS} SELECT ok, ln, pow(asinh(greatest(0, least(1, nir)) * 10) / asinh(10), 1 / 1.2) AS x FROM obs")
def shadow_stretch(spark, sf):
    return sales(spark, sf).select("ok", "ln", radiometry.shadow_stretch(F.col("nir")).alias("x"))


@query("l_partkey l, p s", "SELECT l_partkey, CASE WHEN bool_or(l_linestatus = 'O') AND max(l_quantity) > 45 THEN 'unknown' WHEN bool_or(l_linestatus = 'O') THEN 'resampled' WHEN max(l_quantity) > 45 THEN 'unknown' ELSE 'native' END AS p FROM lineitem GROUP BY l_partkey")
def worst_provenance(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.max(F.col("l_linestatus") == "O").alias("o"), F.max("l_quantity").alias("q"))
    a = F.when(F.col("o"), "resampled").otherwise("native")
    b = F.when(F.col("q") > 45, "guess").otherwise("native")
    return g.select("l_partkey", indices.worst_provenance(a, b).alias("p"))


@query(
    "px l, v_1996 d, v_1997 d, v_1998 d, n_1996 l, n_1997 l, n_1998 l",
    f"WITH {OBS}, y AS (SELECT px, year(obs_date) AS y, avg(nir) AS v, count(*) AS n FROM obs GROUP BY ALL) SELECT px, " + ", ".join(f"max(CASE WHEN y = {y} THEN v END) AS v_{y}, max(CASE WHEN y = {y} THEN n END) AS n_{y}" for y in (1996, 1997, 1998)) + " FROM y GROUP BY px",
)
def wide_band_export(spark, sf):
    y = sales(spark, sf).groupBy("px", F.year("obs_date").alias("y")).agg(F.avg("nir").alias("v"), F.count(F.lit(1)).alias("n"))
    return products.wide_bands(y, ["px"], "y", ["v", "n"], [1996, 1997, 1998])


@query("vec_id l, e_a d, e_b d, e_c d", "SELECT vec_id, embedding[1] AS e_a, embedding[2] AS e_b, embedding[3] AS e_c FROM embeddings")
def array_column_export(spark, sf):
    return products.flat_columns(table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("e")), {"e": ["a", "b", "c"]})


@query("sensor s, month s, n l", f"WITH {OBS} SELECT DISTINCT 's' AS sensor, date_trunc('month', obs_date)::DATE AS month, 1 AS n FROM obs")
def discover_months(spark, sf):
    return products.months(sales(spark, sf).withColumn("month", F.trunc("obs_date", "MM"))).withColumn("sensor", F.lit("s")).withColumn("n", F.lit(1))


@query("tile_id s, sensor s, scene_id s, obs_date s", f"WITH {OBS} SELECT DISTINCT tile::VARCHAR AS tile_id, sensor, scene_id, obs_date FROM obs WHERE year(obs_date) BETWEEN 1997 AND 1998 AND cls = 1")
def classified_scenes(spark, sf):
    o = sales(spark, sf).withColumn("tile_id", F.col("tile").cast("string"))
    return products.classified_scenes(o, o.where("cls = 1"), 1997, 1998)


@query("n_nationkey l, report s", """SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS report FROM nation""")
def json_report(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", F.to_json(F.struct("n_nationkey", "n_name")).alias("report"))


@query(KEY + ", r d, g d, b d", f"WITH {OBS}, m AS (SELECT px, avg(red) AS r0, avg(green) AS g0, avg(blue) AS b0 FROM obs GROUP BY px), k AS (SELECT *, (r0 + g0 + b0) / 3 AS k FROM m) SELECT ok, ln, red * k / r0 AS r, green * k / g0 AS g, blue * k / b0 AS b FROM obs JOIN k USING (px)")
def gray_world_balance(spark, sf):
    from ..functions.features import gray_world

    return gray_world(sales(spark, sf), ["px"], ["red", "green", "blue"]).select("ok", "ln", F.col("red").alias("r"), F.col("green").alias("g"), F.col("blue").alias("b"))


@query(KEY + ", n l, c0 d, c1 d, c2 d, c3 d, f0 d, f1 d", f"WITH {OBS} SELECT ok, ln, 5 AS n, list_position(['l5','l7','l8','l9','s2'], sensor) - 1 AS c0, sin(2 * pi() * dayofyear(obs_date) / 365.25) AS c1, cos(2 * pi() * dayofyear(obs_date) / 365.25) AS c2, nir * 60 / 90 AS c3, red AS f0, nir AS f1 FROM obs")
def scene_context_vector(spark, sf):
    from ..functions.features import feature_stack, scene_context

    d = feature_stack(sales(spark, sf), ["red", "nir"], "f").withColumn("c", scene_context(F.col("sensor"), F.col("obs_date"), F.col("nir") * 60, F.col("red")))
    return d.select("ok", "ln", F.size("c").alias("n"), *[F.get("c", F.lit(i)).alias(f"c{i}") for i in range(4)], *[F.get("f", F.lit(i)).alias(f"f{i}") for i in range(2)])


@query("n_nationkey l, label l", "SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 5 END AS label FROM nation")
def mask_labels(spark, sf):
    from ..schema import class_dim

    n = table(spark, sf, "nation")
    k = F.pmod("n_nationkey", F.lit(3))
    pick = lambda a, b: F.when(k == 0, a).when(k == 1, b).otherwise(1)
    mask = n.select("n_nationkey", pick(34, 40).alias("r"), pick(94, 96).alias("g"), pick(42, 191).alias("b"), F.lit(255).alias("a"))
    return products.mask_labels(mask, class_dim(spark))
