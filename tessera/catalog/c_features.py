"""Registered distribution and feature-preparation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.operators import distributions as D
from tessera.operators import features as FE
from tessera.plans import energy as EN
from tessera.plans import hr as HRP
from tessera.plans import wine as WI
from tessera.sources import bindings as B

HR_NUM = ("satisfaction_level", "last_evaluation", "number_project", "average_montly_hours",
          "time_spend_company", "Work_accident", "left", "promotion_last_5years")
TOP_VARIETIES = ("red plate", "small widget", "hot plate", "hot ring", "large rod", "old rod")
TOP_COUNTRIES = ("LARGE", "MEDIUM", "PROMO", "SMALL")
WINE_CLEAN = "(SELECT *, ln(price) AS ln_price FROM wine WHERE price IS NOT NULL AND points IS NOT NULL)"


def _q(c: str) -> str:
    return '"' + c + '"'


def _r(c, d=9):
    return F.round(c, d)


def _unpivot_sql(source: str, cols, keys: str = "") -> str:
    sel = ", ".join(f"CAST({_q(c)} AS DOUBLE) AS {_q(c)}" for c in cols)
    names = ", ".join(_q(c) for c in cols)
    k = f"{keys}, " if keys else ""
    return (f'(SELECT {k}"column", value FROM (SELECT {k}{sel} FROM {source}) '
            f'UNPIVOT (value FOR "column" IN ({names})))')


# ------------------------------------------------------------ histograms ---

def _bins_sql(source: str, x: str, bins: str, keys: list[str]) -> str:
    """Equal-width bins of ``x`` over [min, max] per key, as ``histogram_bins``."""
    k = ", ".join(keys)
    kk = (k + ", ") if k else ""
    join = f"JOIN s USING ({k})" if keys else ", s"
    w = f"((mx - mn) / {bins})"
    return f"""WITH src AS (SELECT {kk}CAST({x} AS DOUBLE) AS x FROM {source} WHERE {x} IS NOT NULL),
s AS (SELECT {kk}min(x) AS mn, max(x) AS mx FROM src {'GROUP BY ' + k if k else ''}),
b AS (SELECT {kk}CAST(CASE WHEN {w} = 0 THEN 0 ELSE least(floor((x - mn) / {w}), {bins} - 1) END AS INTEGER) AS bin,
  mn, mx FROM src {join})
SELECT {kk}bin, mn + bin * {w} AS lo, mn + (bin + 1) * {w} AS hi, count(*) AS "count" FROM b
GROUP BY {kk}bin, mn, mx"""


@register("hist_fixed_bins", _bins_sql("wine", "points", "21", []))
def hist_fixed_bins(spark, sf):
    return D.histogram_bins(B.wine(spark, sf), "points", 21)


@register("hist_fixed_width", """
SELECT floor(price / 0.5) * 0.5 AS lo, floor(price / 0.5) * 0.5 + 0.5 AS hi, count(*) AS "count"
FROM wine WHERE price IS NOT NULL AND price >= 0 AND price <= 100 GROUP BY 1""")
def hist_fixed_width(spark, sf):
    return D.histogram_width(B.wine(spark, sf), "price", 0.5, 0, 100)


@register("hist_density", f"""
WITH s AS (SELECT series_id, min(value) AS mn, max(value) AS mx, count(value) AS n,
    CAST(ceil(log2(count(value)) + 1) AS BIGINT) AS nb FROM series WHERE value IS NOT NULL GROUP BY 1),
z AS (SELECT *, greatest(abs(mn), abs(mx)) AS size, nb // 3 AS least_bins FROM s),
c AS (SELECT *, CASE WHEN size = 0 OR mx - mn < size * 1.4 * 3 * pow(2.0, -52) * nb
    THEN 0.75 * (CASE WHEN size = 0 THEN 1 WHEN size > 10 THEN 9 + size / 10 ELSE size END) / greatest(least_bins, 1)
    ELSE (mx - mn) / nb END AS cell FROM z),
u0 AS (SELECT *, pow(10.0, floor(log10(cell))) AS base FROM c),
u2 AS (SELECT *, CASE WHEN 2 * base - cell < 1.5 * (cell - base) THEN 2 * base ELSE base END AS unit2 FROM u0),
u5 AS (SELECT *, CASE WHEN 5 * base - cell < 2.75 * (cell - unit2) THEN 5 * base ELSE unit2 END AS unit5 FROM u2),
u AS (SELECT *, CASE WHEN 10 * base - cell < 1.5 * (cell - unit5) THEN 10 * base ELSE unit5 END AS unit FROM u5),
e AS (SELECT *, CAST(floor(mn / unit + 1e-7) AS BIGINT) AS k0, CAST(ceil(mx / unit - 1e-7) AS BIGINT) AS k1 FROM u),
m AS (SELECT *, greatest(least_bins - (k1 - k0), 0) AS more FROM e),
f AS (SELECT *, CASE WHEN mn = 0 AND k0 = 0 AND mx <> 0 THEN 0 WHEN k0 >= 0 THEN more // 2 + more % 2 ELSE more // 2 END AS below FROM m),
g AS (SELECT series_id, n, unit, k0 - below AS k0, k1 + more - below AS k1 FROM f),
b AS (SELECT x.series_id, n, unit, k0, CAST(greatest(0, least(CAST(ceil(value / unit - 1e-7) AS BIGINT) - 1 - k0, k1 - k0 - 1)) AS INTEGER) AS bin
    FROM series x JOIN g ON x.series_id = g.series_id WHERE value IS NOT NULL)
SELECT series_id, bin, {r_up('(k0 + bin) * unit', 9)} AS lo, {r_up('(k0 + bin + 1) * unit', 9)} AS hi, count(*) AS "count",
  {r_up('count(*) / (n * unit)', 9)} AS density
FROM b GROUP BY series_id, bin, n, unit, k0""")
def hist_density(spark, sf):
    h = D.histogram_density(B.series(spark, sf), "value", by="series_id")
    return h.withColumns({c: _r(F.col(c)) for c in ("lo", "hi", "density")})


@register("hist_all_numeric", _bins_sql(_unpivot_sql("hr", HR_NUM), "value", "10", ['"column"']))
def hist_all_numeric(spark, sf):
    return D.histogram_all(B.hr(spark, sf), HR_NUM, 10)


def _box_sql(long_sql: str, keys: list[str]) -> str:
    kk = "".join(k + ", " for k in keys)
    on = " AND ".join(f"l.{k} = s.{k}" for k in keys + ['"column"'])
    g = ", ".join(f"s.{k}" for k in keys + ['"column"'])
    return f"""WITH l AS {long_sql},
s AS (SELECT {kk}"column", count(value) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM l GROUP BY ALL)
SELECT {g}, s.n, {r_up('s.q1', 9)} AS q1, {r_up('s.median', 9)} AS median, {r_up('s.q3', 9)} AS q3,
  {r_up('min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END)', 9)} AS lower_whisker,
  {r_up('max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END)', 9)} AS upper_whisker,
  count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM l JOIN s ON {on} GROUP BY {g}, s.n, s.q1, s.median, s.q3"""


def _round_box(df):
    return df.withColumns({c: _r(F.col(c)) for c in ("q1", "median", "q3", "lower_whisker", "upper_whisker")})


@register("box_stats", _box_sql(_unpivot_sql("hr", HR_NUM), []))
def box_stats(spark, sf):
    return _round_box(D.box_stats(B.hr(spark, sf), HR_NUM))


@register("box_stats_grouped", _box_sql(_unpivot_sql(WINE_CLEAN, ["ln_price"], "points"), ["points"]))
def box_stats_grouped(spark, sf):
    return _round_box(D.box_stats(WI.clean(B.wine(spark, sf)), ["ln_price"], by="points"))


def _kde_sql(source: str, x: str, key: str, points: int = 100, bins: int = 512, cut: float = 3.0, margin: float = 4.0,
             where: str = "TRUE") -> str:
    """Linear binning and the kernel sum at the two places around each grid point, which the convolution gives at once."""
    return f"""WITH src AS (SELECT {key}, CAST({x} AS DOUBLE) AS x FROM {source} WHERE {x} IS NOT NULL AND {where}),
st AS (SELECT {key}, count(x) AS n, coalesce(stddev_samp(x), 0) AS sd, quantile_cont(x, 0.25) AS q1,
  quantile_cont(x, 0.75) AS q3, min(x) AS mn, max(x) AS mx FROM src GROUP BY {key}),
st2 AS (SELECT *, 0.9 * (CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34)
  WHEN sd > 0 THEN sd ELSE 1.0 END) * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st),
st3 AS (SELECT *, mn - {cut + margin} * bw AS first_place, (mx - mn + {2 * (cut + margin)} * bw) / {bins - 1} AS step FROM st2),
pos AS (SELECT src.{key}, (x - first_place) / step AS pos FROM src JOIN st3 ON src.{key} = st3.{key}),
lf AS (SELECT {key}, pos, least(floor(pos), {bins - 2}) AS b FROM pos),
bn AS (SELECT {key}, b, sum(w) AS w FROM (SELECT {key}, b, 1 - (pos - b) AS w FROM lf UNION ALL SELECT {key}, b + 1, pos - b FROM lf)
  GROUP BY 1, 2),
g AS (SELECT {key}, i, (mn - {cut} * bw) + i * ((mx + {cut} * bw) - (mn - {cut} * bw)) / {points - 1} AS x, n, bw, first_place, step
  FROM st3, range({points}) r(i)),
g2 AS (SELECT *, (x - first_place) / step AS place FROM g),
s AS (SELECT g2.{key}, i, x, place, sum(w * exp(-0.5 * pow((floor(place) - b) * step / bw, 2))) / (n * bw * sqrt(2 * pi())) AS y0,
  sum(w * exp(-0.5 * pow((floor(place) + 1 - b) * step / bw, 2))) / (n * bw * sqrt(2 * pi())) AS y1
  FROM g2 JOIN bn ON g2.{key} = bn.{key} GROUP BY g2.{key}, i, x, place, n, bw)
SELECT {key}, CAST(i AS INTEGER) AS i, {r_up('x', 9)} AS x, {r_up('y0 + (place - floor(place)) * (y1 - y0)', 9)} AS density FROM s"""


def _round_kde(df):
    return df.withColumns({"x": _r(F.col("x")), "density": _r(F.col("density"))})


@register("kde_1d", _kde_sql("series", "value", "series_id"))
def kde_1d(spark, sf):
    return _round_kde(D.kde(B.series(spark, sf), "value", by="series_id"))


_VAR_IN = ", ".join("'" + v + "'" for v in TOP_VARIETIES)


@register("kde_grouped", _kde_sql(f"(SELECT * FROM {WINE_CLEAN} WHERE variety IN ({_VAR_IN}))", "price", "variety",
                                  where="price >= 0 AND price <= 200"))
def kde_grouped(spark, sf):
    w = WI.clean(B.wine(spark, sf)).where(F.col("variety").isin(*TOP_VARIETIES))
    return _round_kde(D.kde(w, "price", by="variety", lo=0, hi=200))


@register("normal_overlay", f"""
WITH s AS (SELECT series_id, avg(value) AS mu, stddev_samp(value) AS sigma FROM series GROUP BY 1),
g AS (SELECT series_id, i, (mu - 3 * sigma) + i * ((mu + 3 * sigma) - (mu - 3 * sigma)) / 99 AS x, mu, sigma
  FROM s, range(100) r(i))
SELECT series_id, CAST(i AS INTEGER) AS i, {r_up('x', 9)} AS x,
  {r_up('exp(-0.5 * ((x - mu) / sigma) * ((x - mu) / sigma)) / (sigma * sqrt(2 * pi()))', 9)} AS density FROM g""")
def normal_overlay(spark, sf):
    return _round_kde(D.normal_overlay(B.series(spark, sf), "value", by="series_id"))


_C_IN = ", ".join("'" + v + "'" for v in TOP_COUNTRIES)


def _loess_sql(source: str, x: str, y: str, key: str, span: float = 0.75, vertices: int = 17) -> str:
    """CTEs of the local regression: ``fits (key, i, v, step, f, sl)``, value and slope at the vertices."""
    near = "abs(p.x - v.v)"
    return f"""p AS (SELECT {key}, CAST({x} AS DOUBLE) AS x, count(*) AS n, sum({y}) AS sy FROM {source}
  WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1, 2),
e AS (SELECT {key}, min(x) AS mn, max(x) AS mx, sum(n) AS total FROM p GROUP BY 1),
v AS (SELECT {key}, i, mn + i * (mx - mn) / {vertices - 1} AS v, (mx - mn) / {vertices - 1} AS step,
  least(total, greatest(1, floor(total * {span} + 1e-5))) AS q FROM e, range({vertices}) r(i)),
cum AS (SELECT v.*, {near} AS d, sum(n) OVER (PARTITION BY v.{key}, i ORDER BY {near}) AS upto
  FROM v JOIN p ON p.{key} = v.{key}),
h AS (SELECT {key}, i, v, step, min(d) AS h FROM cum WHERE upto >= q GROUP BY ALL),
w AS (SELECT h.*, n, sy, CASE WHEN h > 0 THEN (x - v) / h ELSE 0 END AS u,
  CASE WHEN abs(x - v) < h THEN pow(1 - pow(abs(x - v) / h, 3), 3) ELSE 0 END AS w
  FROM h JOIN p ON p.{key} = h.{key} WHERE abs(x - v) <= h),
sums AS (SELECT {key}, i, v, step, h, count_if(w > 0) AS k, sum(n) AS m, sum(sy) AS t, sum(w * n) AS s0, sum(w * n * u) AS s1,
  sum(w * n * u * u) AS s2, sum(w * n * u * u * u) AS s3, sum(w * n * u * u * u * u) AS s4,
  sum(w * sy) AS t0, sum(w * sy * u) AS t1, sum(w * sy * u * u) AS t2 FROM w GROUP BY ALL),
dets AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS det FROM sums),
fits AS (SELECT {key}, i, v, step,
  CASE WHEN k >= 3 THEN (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / det
    WHEN k = 2 THEN (t0 * s2 - t1 * s1) / (s0 * s2 - s1 * s1) WHEN k = 1 THEN t0 / s0 ELSE t / m END AS f,
  CASE WHEN k >= 3 THEN (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / (det * h)
    WHEN k = 2 THEN (s0 * t1 - s1 * t0) / ((s0 * s2 - s1 * s1) * h) ELSE 0 END AS sl FROM dets)"""


@register("trend_by_x", f"""
WITH src AS (SELECT * FROM {WINE_CLEAN} WHERE country IN ({_C_IN})),
line AS (SELECT country, regr_slope(ln_price, points) AS b, regr_intercept(ln_price, points) AS a FROM src GROUP BY 1),
m AS (SELECT country, points, count(*) AS n, avg(ln_price) AS mean_y FROM src GROUP BY 1, 2),
{_loess_sql('src', 'points', 'ln_price', 'country')},
j AS (SELECT m.*, a + b * points AS fitted, mn, (mx - mn) / 16 AS step,
  CASE WHEN mx > mn THEN least(floor((points - mn) / ((mx - mn) / 16)), 15) ELSE 0 END AS cell
  FROM m JOIN line ON m.country = line.country JOIN e ON m.country = e.country),
c AS (SELECT j.*, p.f AS f0, p.sl AS s0, q.f AS f1, q.sl AS s1, CASE WHEN j.step > 0 THEN (points - p.v) / j.step ELSE 0 END AS t
  FROM j JOIN fits p ON p.country = j.country AND p.i = cell JOIN fits q ON q.country = j.country AND q.i = cell + 1)
SELECT country, points, n, {r_up('mean_y', 9)} AS mean_y, {r_up('fitted', 9)} AS fitted,
  {r_up('f0 * (2*t*t*t - 3*t*t + 1) + s0 * step * (t*t*t - 2*t*t + t) + f1 * (3*t*t - 2*t*t*t) + s1 * step * (t*t*t - t*t)', 6)} AS smooth
FROM c""")
def trend_by_x(spark, sf):
    w = WI.clean(B.wine(spark, sf)).where(F.col("country").isin(*TOP_COUNTRIES))
    t = D.trend(w, "points", "ln_price", by="country")
    return t.withColumns({"mean_y": _r(F.col("mean_y")), "fitted": _r(F.col("fitted")), "smooth": _r(F.col("smooth"), 6)})


@register("hourly_profile", f"""
SELECT CAST(hour(datetime) AS INTEGER) AS hour, {r_up('avg(power_demand)', 6)} AS power_demand,
  {r_up('avg(spot_price)', 6)} AS spot_price FROM energy GROUP BY 1""")
def hourly_profile(spark, sf):
    return EN.hourly_profile(B.energy(spark, sf), digits=6)


# -------------------------------------------------------- feature steps ---

ENC_NUM = ("satisfaction_level", "last_evaluation", "number_project", "average_montly_hours", "time_spend_company")
_DEPTS = [d for d in HRP.DEPARTMENTS if d not in ("support", "IT")]
ENCODED_SQL = ("(SELECT id, satisfaction_level, last_evaluation, number_project, average_montly_hours, "
               "time_spend_company, Work_accident, promotion_last_5years, \"left\", "
               + ", ".join(f"CASE WHEN salary = '{v}' THEN 1 ELSE 0 END AS salary_{v}" for v in HRP.SALARIES) + ", "
               + ", ".join(f"CASE WHEN dept = '{v}' THEN 1 ELSE 0 END AS department_{v}" for v in _DEPTS)
               + " FROM (SELECT *, CASE WHEN sales IN ('support', 'IT') THEN 'technical' ELSE sales END AS dept FROM hr))")


@register("fe_set_target", 'SELECT * EXCLUDE ("left", sales), sales AS department, "left" AS target FROM hr')
def fe_set_target(spark, sf):
    h = HRP.prepare(B.hr(spark, sf), merge_departments=False)
    return h.withColumnRenamed("left", "target")


@register("fe_onehot", f"SELECT * FROM {ENCODED_SQL}")
def fe_onehot(spark, sf):
    return HRP.encoded(B.hr(spark, sf))


def _enc_cols():
    return list(ENC_NUM) + ["Work_accident", "promotion_last_5years"] + \
        [f"salary_{v}" for v in HRP.SALARIES] + [f"department_{v}" for v in _DEPTS]


@register("fe_summary", "WITH e AS " + ENCODED_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS \"column\", stat, value FROM (SELECT {r_up(f'CAST(count({_q(c)}) AS DOUBLE)', 6)} AS \"count\", "
    f"{r_up(f'avg({_q(c)})', 6)} AS mean, {r_up(f'stddev_samp({_q(c)})', 6)} AS std, "
    f"{r_up(f'CAST(count(DISTINCT {_q(c)}) AS DOUBLE)', 6)} AS \"distinct\" FROM e) "
    f"UNPIVOT INCLUDE NULLS (value FOR stat IN (\"count\", mean, std, \"distinct\"))" for c in _enc_cols()))
def fe_summary(spark, sf):
    e = HRP.encoded(B.hr(spark, sf))
    aggs, parts = [], []
    for c in _enc_cols():
        aggs += [F.count(c).cast("double").alias(f"c_{c}"), F.avg(c).alias(f"m_{c}"),
                 F.stddev_samp(c).alias(f"s_{c}"), F.count_distinct(c).cast("double").alias(f"d_{c}")]
        for stat, src in (("count", f"c_{c}"), ("mean", f"m_{c}"), ("std", f"s_{c}"), ("distinct", f"d_{c}")):
            parts.append(F.struct(F.lit(c).alias("column"), F.lit(stat).alias("stat"),
                                  F.round(F.col(src), 6).alias("value")))
    return e.agg(*aggs).select(F.explode(F.array(*parts)).alias("s")).select("s.*")


def _outlier_sql() -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in ENC_NUM)
    cond = " OR ".join(f"({c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}))"
                       for c in ENC_NUM)
    return f"WITH e AS {ENCODED_SQL}, s AS (SELECT {q} FROM e) SELECT id FROM e, s WHERE {cond}"


@register("fe_outliers", _outlier_sql())
def fe_outliers(spark, sf):
    return FE.outlier_rows(HRP.encoded(B.hr(spark, sf)), ENC_NUM, "id")


@register("drop_samples", "WITH o AS (" + _outlier_sql() + ") SELECT * FROM " + ENCODED_SQL
          + " x WHERE id NOT IN (SELECT id FROM o)")
def drop_samples(spark, sf):
    e = HRP.encoded(B.hr(spark, sf))
    return FE.drop_rows(e, FE.outlier_rows(e, ENC_NUM, "id"), "id")


IMP_FEATS = tuple(_enc_cols())


def _importance_sql(anchors: int = 100, k: int = 10) -> str:
    fs = IMP_FEATS
    rng = ", ".join(f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in fs)
    sc = ", ".join(f"CASE WHEN hi_{c} > lo_{c} THEN (CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.0 END AS {c}"
                   for c in fs)
    d = ", ".join(f"abs(s.{c} - a.{c}) AS d_{c}" for c in fs)
    dist = " + ".join(f"abs(s.{c} - a.{c})" for c in fs)
    pa = ", ".join(f"avg(CASE WHEN NOT hit THEN d_{c} END) - avg(CASE WHEN hit THEN d_{c} END) AS {c}" for c in fs)
    fin = ", ".join(f"avg({c}) AS {c}" for c in fs)
    names = ", ".join(fs)
    return f"""WITH e AS {ENCODED_SQL}, rg AS (SELECT {rng} FROM e),
sc AS (SELECT id, "left" AS y, {sc} FROM e, rg),
a AS (SELECT * FROM sc ORDER BY id LIMIT {anchors}),
p AS (SELECT a.id AS aid, s.id AS nid, s.y = a.y AS hit, {d}, round({dist}, 9) AS dist FROM sc s, a WHERE s.id <> a.id),
r AS (SELECT *, row_number() OVER (PARTITION BY aid, hit ORDER BY dist, nid) AS rn FROM p),
pa AS (SELECT aid, {pa} FROM r WHERE rn <= {k} GROUP BY aid),
w AS (SELECT {fin} FROM pa)
SELECT feature, {r_up('importance', 9)} AS importance FROM w UNPIVOT (importance FOR feature IN ({names}))"""


def _importance(spark, sf):
    e = HRP.encoded(B.hr(spark, sf))
    return FE.relieff(e, IMP_FEATS, "left", "id").withColumn("importance", _r(F.col("importance")))


@register("fe_feature_importance", _importance_sql())
def fe_feature_importance(spark, sf):
    return _importance(spark, sf)


@register("fe_drop_by_importance", "WITH imp AS (" + _importance_sql() + ") SELECT feature FROM imp WHERE importance >= "
          + str(HRP.IMPORTANCE_THRESHOLD))
def fe_drop_by_importance(spark, sf):
    """Features kept at the 0.05 threshold."""
    return _importance(spark, sf).where(F.col("importance") >= HRP.IMPORTANCE_THRESHOLD).select("feature")


_DISC_ONEHOT = [f"{c}_{n}" for c, (_, names) in HRP.DISCRETIZE.items() for n in names]


def _disc_sql() -> str:
    cases = []
    for c, (bins, names) in HRP.DISCRETIZE.items():
        for i, ((lo, hi), n) in enumerate(zip(bins, names)):
            low = f"{c} >= {lo}" if i == 0 else f"{c} > {lo}"
            cases.append(f"CASE WHEN {low} AND {c} <= {hi} THEN 1 ELSE 0 END AS {c}_{n}")
    return "(SELECT id, " + ", ".join(cases) + " FROM hr)"


@register("fe_drop_constant", "WITH d AS " + _disc_sql() + " SELECT \"column\" FROM (SELECT " + ", ".join(
    f"count(DISTINCT {c}) AS {c}" for c in _DISC_ONEHOT) + " FROM d) UNPIVOT (n FOR \"column\" IN ("
    + ", ".join(_DISC_ONEHOT) + ")) WHERE n <= 1")
def fe_drop_constant(spark, sf):
    """Columns of the discretised table holding one value only."""
    d = HRP.discretized(B.hr(spark, sf)).select("id", *_DISC_ONEHOT)
    return FE.constant_flags(d, _DISC_ONEHOT).unpivot([], _DISC_ONEHOT, "column", "one").where("one").select("column")


def _skew_sql(source: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS \"column\", sum(pow({c} - m, 3)) / n / pow(sum(pow({c} - m, 2)) / n, 1.5) AS sk "
                     f"FROM {source}, (SELECT avg({c}) AS m, count({c}) AS n FROM {source}) GROUP BY m, n")
    return "\nUNION ALL ".join(parts)


@register("fe_skewed_features", "WITH e AS " + ENCODED_SQL + ", k AS (" + _skew_sql("e", _enc_cols()) + ")\n"
          f"SELECT \"column\", {r_up('sk', 6)} AS skewness FROM k WHERE abs(sk) > 0.75")
def fe_skewed_features(spark, sf):
    t = FE.skewed(HRP.encoded(B.hr(spark, sf)), _enc_cols())
    return t.withColumn("skewness", F.round("skewness", 6))


@register("fe_fix_skewness", "WITH e AS " + ENCODED_SQL + ", k AS (" + _skew_sql("e", ENC_NUM) + "),\n"
          "l AS " + _unpivot_sql("e", ENC_NUM, "id") + ",\n"
          "mins AS (SELECT \"column\", min(value) AS mn FROM l GROUP BY 1)\n"
          f"SELECT id, l.\"column\", {r_up('ln(1 + value - mn)', 9)} AS value FROM l JOIN mins ON l.\"column\" = mins.\"column\"\n"
          "WHERE l.\"column\" IN (SELECT \"column\" FROM k WHERE abs(sk) > 0.75)")
def fe_fix_skewness(spark, sf):
    """``log1p(x - min)`` on the skewed numeric columns, long ``(id, column, value)``."""
    e = HRP.encoded(B.hr(spark, sf))
    cols = [r["column"] for r in FE.skewed(e, ENC_NUM).collect()]
    fixed = FE.fix_skewness(e, cols)
    if not cols:
        return fixed.select("id", F.lit(None).cast("string").alias("column"),
                            F.lit(None).cast("double").alias("value")).where(F.lit(False))
    return fixed.unpivot(["id"], cols, "column", "value").withColumn("value", F.round("value", 9))


@register("fe_minmax_scale", "WITH e AS " + ENCODED_SQL + ", mm AS (SELECT " + ", ".join(
    f"min(CAST({c} AS DOUBLE)) AS lo_{c}, max(CAST({c} AS DOUBLE)) AS hi_{c}" for c in ENC_NUM) + " FROM e)\nSELECT id, "
    + ", ".join(f"{r_up(f'CASE WHEN hi_{c} > lo_{c} THEN (CAST({c} AS DOUBLE) - lo_{c}) / (hi_{c} - lo_{c}) ELSE 0.0 END', 9)} AS {c}"
                for c in ENC_NUM) + " FROM e, mm")
def fe_minmax_scale(spark, sf):
    e = FE.minmax(HRP.encoded(B.hr(spark, sf)), ENC_NUM)
    return e.select("id", *[F.round(c, 9).alias(c) for c in ENC_NUM])


@register("fe_split", """
SELECT id, CASE WHEN CAST(concat('0x', substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 THEN 'test'
  ELSE 'train' END AS split FROM hr""")
def fe_split(spark, sf):
    return FE.with_split(B.hr(spark, sf), "id").select("id", "split")
