"""Statistical tests."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.functions import features
from tidewheel.operators import glm, joins, metrics, stats
from tidewheel.operators.splits import mixed_number
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rnd, rounded

BOOK = Book()
add = BOOK.add
P = 2147483647


def erfc_sql(x: str) -> str:
    """SQL twin of the complementary error function for a non-negative argument."""
    t = f"(1.0 / (1 + ({x}) / 2.0))"
    poly = f"CAST({stats.ERFC[-1]} AS DOUBLE)"
    for c in reversed(stats.ERFC[:-1]):
        poly = f"({poly} * {t} + ({c}))"
    return f"({t} * exp({poly} - ({x}) * ({x})))"


def tail_sql(z: str) -> str:
    pos, neg = erfc_sql(f"({z}) / sqrt(2.0)"), erfc_sql(f"-({z}) / sqrt(2.0)")
    return f"(CASE WHEN ({z}) >= 0 THEN {pos} ELSE 2 - {neg} END / 2)"


def chi2_tail_sql(x: str, dof: str) -> str:
    h = f"(({x}) / 2.0)"
    even = f"list_sum([exp(-{h} + (j - 1) * ln({h}) - lgamma(CAST(j AS DOUBLE))) FOR j IN range(1, CAST({dof} // 2 + 1 AS BIGINT))])"
    odd = f"({erfc_sql(f'sqrt({h})')} + coalesce(list_sum([exp(-{h} + (j - 0.5) * ln({h}) - lgamma(j + 0.5)) FOR j IN range(1, CAST(({dof} - 1) // 2 + 1 AS BIGINT))]), 0))"
    return f"CASE WHEN ({x}) <= 0 THEN 1.0 WHEN ({dof}) % 2 = 0 THEN {even} ELSE {odd} END"


def mixed_sql(a: str, b: str) -> str:
    x = f"((({a}) * 48271 + ({b}) * 69621) % {P})"
    step = "(((x * x) % {p}) * 48271 + x) % {p}".format(p=P)
    return f"list_reduce([{x}, 0, 0], lambda x, y: {step})"


RANKS = """rk AS (SELECT *, rank() OVER (ORDER BY duration_minutes) + (count(*) OVER (PARTITION BY duration_minutes) - 1) / 2.0::DOUBLE AS r FROM trips_li),
    tie AS (SELECT sum(n * n * n - n) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM trips_li GROUP BY duration_minutes)),
    g AS (SELECT CAST(count(*) FILTER (WHERE member_casual = 'casual') AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE member_casual <> 'casual') AS DOUBLE) AS n2,
        sum(r) FILTER (WHERE member_casual = 'casual') AS r1 FROM rk),
    u AS (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2 AS u, sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sigma FROM g, tie)"""


def riders(spark, sf):
    return v.trips_li(spark, sf).select("duration_minutes", "member_casual")


@add("mann_whitney_u", "trips_li", f"""WITH {RANKS} SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u, {r6("(u - n1 * n2 / 2) / sigma")} AS z,
    {r6(tail_sql("(u - n1 * n2 / 2 - 0.5) / sigma"))} AS p_greater, {r6(f"least(1.0, 2 * {tail_sql('(abs(u - n1 * n2 / 2) - 0.5) / sigma')})")} AS p_two_sided FROM u""")
def mann_whitney_u(spark, sf):
    out = stats.mann_whitney(riders(spark, sf), "duration_minutes", F.col("member_casual") == "casual")
    return rounded(out.drop("cliffs_delta"), "z", "p_greater", "p_two_sided")


@add("cliffs_delta", "trips_li", f"""WITH {RANKS} SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {r6("2 * u / (n1 * n2) - 1", 9)} AS cliffs_delta FROM u""")
def cliffs_delta(spark, sf):
    out = stats.mann_whitney(riders(spark, sf), "duration_minutes", F.col("member_casual") == "casual")
    return rounded(out.select("n1", "n2", "cliffs_delta"), "cliffs_delta", digits=9)


REPS = 200
BOOT = f"""v AS (SELECT member_casual AS g, duration_minutes AS x, row_number() OVER (PARTITION BY member_casual ORDER BY duration_minutes) - 1 AS at FROM trips_li),
    s AS (SELECT g, count(*) AS size FROM v GROUP BY 1),
    d AS (SELECT rep, g, size, CAST(sum({mixed_sql("slot", "rep + CASE WHEN g = 'casual' THEN 0 ELSE 1000003 END")}) AS DOUBLE) AS t FROM range({REPS}) r(rep), range(12) k(slot), s GROUP BY ALL),
    p AS (SELECT rep, g, greatest(0, least(size - 1, CAST(floor(CAST(size AS DOUBLE) * (0.5::DOUBLE + (t / {P}.0::DOUBLE - 6.0::DOUBLE) / (2.0::DOUBLE * sqrt(CAST(size AS DOUBLE))))) AS BIGINT))) AS at FROM d),
    m AS (SELECT rep, p.g, x AS med FROM p JOIN v ON v.g = p.g AND v.at = p.at),
    diff AS (SELECT rep, max(CASE WHEN g = 'casual' THEN med END) - max(CASE WHEN g = 'member' THEN med END) AS d FROM m GROUP BY 1),
    ci AS (SELECT {r6("quantile_cont(d, 0.025)")} AS ci_low, {r6("quantile_cont(d, 0.975)")} AS ci_high, count(d) AS replicates FROM diff)"""


def interval(spark, sf):
    return rounded(stats.bootstrap_median_diff(riders(spark, sf), "duration_minutes", "member_casual", "casual", "member", REPS), "ci_low", "ci_high")


@add("bootstrap_median_diff", "trips_li", f"WITH {BOOT} SELECT * FROM ci")
def bootstrap_median_diff(spark, sf):
    return interval(spark, sf)


@add("hypothesis_report", "trips_li", f"""WITH {RANKS}, {BOOT}, md AS (SELECT median(duration_minutes) FILTER (WHERE member_casual = 'casual') AS c,
        median(duration_minutes) FILTER (WHERE member_casual = 'member') AS m FROM trips_li)
    SELECT CAST(n1 AS BIGINT) AS n_casual, CAST(n2 AS BIGINT) AS n_member, {r6("c", 9)} AS median_casual, {r6("m", 9)} AS median_member, {r6("c - m", 9)} AS median_difference,
        ci_low, ci_high, u AS mann_whitney_u, {r6(tail_sql("(u - n1 * n2 / 2 - 0.5) / sigma"))} AS one_sided_p_value, {r6("2 * u / (n1 * n2) - 1", 9)} AS cliffs_delta FROM u, md, ci""")
def hypothesis_report(spark, sf):
    """Group sizes, medians, interval, test and effect size in one row; every part is a one-row table."""
    rows = riders(spark, sf)
    test = stats.mann_whitney(rows, "duration_minutes", F.col("member_casual") == "casual")
    medians = stats.group_medians(rows, "duration_minutes", "member_casual")
    med = medians.agg(F.struct(*[F.max(F.when(F.col("member_casual") == g, F.col("median"))).alias(g) for g in ("casual", "member")]).alias("v")).scalar()
    ci = interval(spark, sf).select(F.struct("ci_low", "ci_high").alias("v")).scalar()
    return test.select(
        F.col("n1").alias("n_casual"), F.col("n2").alias("n_member"), rnd(med["casual"], 9).alias("median_casual"), rnd(med["member"], 9).alias("median_member"),
        rnd(med["casual"] - med["member"], 9).alias("median_difference"), ci["ci_low"].alias("ci_low"), ci["ci_high"].alias("ci_high"),
        F.col("u").alias("mann_whitney_u"), rnd("p_greater").alias("one_sided_p_value"), rnd("cliffs_delta", 9).alias("cliffs_delta"))


CITY = """city AS (SELECT time, CAST(sum(trips) AS BIGINT) AS trips FROM zone_hour GROUP BY 1),
    c AS (SELECT c.*, CAST(hour(time) AS INTEGER) AS hour, CAST(day(time) AS INTEGER) % 3 AS block, CASE WHEN isodow(time) >= 6 THEN 'weekend' ELSE 'weekday' END AS daytype,
        precipitation_mm, CASE WHEN precipitation_mm = 0 THEN 'dry' WHEN precipitation_mm >= 0.5 THEN 'wet' ELSE 'drizzle' END AS wet FROM city c JOIN weather USING (time))"""
STRATA = """st AS (SELECT hour, daytype, avg(trips) FILTER (WHERE wet = 'wet') AS mean_one, avg(trips) FILTER (WHERE wet = 'dry') AS mean_other,
        CAST(count(*) FILTER (WHERE wet = 'wet') AS BIGINT) AS n_one, CAST(count(*) FILTER (WHERE wet = 'dry') AS BIGINT) AS n_other FROM c GROUP BY 1, 2),
    ok AS (SELECT *, ln(mean_one / mean_other) AS log_ratio FROM st WHERE mean_one > 0 AND mean_other > 0)"""


def city_hours(spark, sf):
    """City totals per hour with the conditions of the hour."""
    city = demand.zone_hour(spark, sf).groupBy("time").agg(F.sum("trips").alias("trips"))
    rows = joins.join_hourly(city, v.weather(spark, sf), "time", "time", ["precipitation_mm", "temperature_c", "wind_kmh"])
    ts = F.col("time")
    return rows.where("precipitation_mm is not null").withColumns({
        "hour": F.hour(ts), "daytype": features.daytype(ts), "month": F.month(ts), "wet": features.wet_class(F.col("precipitation_mm")), "day": cal.day_floor(ts)})


@add("wilcoxon_signed_rank", "preds", f"""WITH d AS (SELECT zone, abs(trips - pred_a) - abs(trips - pred_b) AS d FROM preds), nz AS (SELECT zone, d, abs(d) AS a FROM d WHERE d <> 0),
    r AS (SELECT *, rank() OVER (PARTITION BY zone ORDER BY a) + (count(*) OVER (PARTITION BY zone, a) - 1) / 2.0::DOUBLE AS r FROM nz),
    t AS (SELECT zone, sum(n * n * n - n) AS ties FROM (SELECT zone, a, CAST(count(*) AS DOUBLE) AS n FROM nz GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT zone, count(*) AS n, coalesce(sum(r) FILTER (WHERE d > 0), 0) AS w_plus, coalesce(sum(r) FILTER (WHERE d < 0), 0) AS w_minus FROM r GROUP BY 1),
    z AS (SELECT s.*, (w_plus - CAST(n AS DOUBLE) * (n + 1) / 4) / sqrt(CAST(n AS DOUBLE) * (n + 1) * (2 * n + 1) / 24 - ties / 48) AS z FROM s JOIN t USING (zone))
    SELECT zone, n, w_plus, w_minus, least(w_plus, w_minus) AS statistic, {r6("z")} AS z, {r6(tail_sql("-z"))} AS p_less, {r6(f"2 * {tail_sql('abs(z)')}")} AS p_two_sided FROM z""")
def wilcoxon_signed_rank(spark, sf):
    d = F.abs(F.col("trips") - F.col("pred_a")) - F.abs(F.col("trips") - F.col("pred_b"))
    return rounded(stats.wilcoxon(demand.predictions(spark, sf).select("zone", d.alias("d")), "d", ["zone"]), "z", "p_less", "p_two_sided")


@add("matched_strata_ratio", "zone_hour weather", f"""WITH {CITY}, {STRATA} SELECT hour, daytype, {r6("mean_one")} AS mean_one, {r6("mean_other")} AS mean_other, n_one, n_other, {r6("log_ratio")} AS log_ratio FROM ok""")
def matched_strata_ratio(spark, sf):
    out = stats.matched_strata(city_hours(spark, sf), ["hour", "daytype"], "wet", "trips", "wet", "dry")
    return rounded(out, "mean_one", "mean_other", "log_ratio")


@add("chi2_cramers_v", "trips_li", f"""WITH o AS (SELECT CASE WHEN isodow(started_at) >= 6 THEN 'weekend' ELSE 'weekday' END AS a, hour(started_at) AS b, CAST(count(*) AS DOUBLE) AS o FROM trips_li GROUP BY 1, 2),
    e AS (SELECT o, sum(o) OVER (PARTITION BY a) * sum(o) OVER (PARTITION BY b) / sum(o) OVER () AS e, sum(o) OVER () AS n FROM o),
    x AS (SELECT max(n) AS n, sum((o - e) * (o - e) / e) AS chi2, (SELECT (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) FROM o) AS dof FROM e)
    SELECT n, {r6("chi2")} AS chi2, CAST(dof AS BIGINT) AS dof, {r6("sqrt(chi2 / n)")} AS cramers_v, {r6(chi2_tail_sql("chi2", "dof"))} AS p_value FROM x""")
def chi2_cramers_v(spark, sf):
    ts = F.col("started_at")
    rows = v.trips_li(spark, sf).select(features.daytype(ts).alias("daytype"), F.hour(ts).alias("hour"))
    return rounded(stats.chi_square(rows, "daytype", "hour"), "chi2", "cramers_v", "p_value")


GAPPY = ["kind", "size", "noise_1"]


@add("chi2_missingness", "cases", f"""WITH long AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, ({c} IS NULL) AS gone, class = 'p' AS bad FROM cases" for c in GAPPY)}),
    t AS (SELECT feature, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE gone AND bad) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE gone) AS DOUBLE) AS r, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS c FROM long GROUP BY 1),
    x AS (SELECT *, power(greatest(0, abs(a - r * c / n) - 0.5), 2) * n * n * n / (r * (n - r) * c * (n - c)) AS chi2 FROM t)
    SELECT feature, {r6("a / r")} AS rate_missing, {r6("(c - a) / (n - r)")} AS rate_present, {r6("chi2")} AS chi2, {r6("sqrt(chi2 / n)")} AS cramers_v, {r6(f"CASE WHEN chi2 <= 0 THEN 1.0 ELSE {erfc_sql('sqrt(chi2 / 2)')} END")} AS p_value FROM x""")
def chi2_missingness(spark, sf):
    gaps = v.cases(spark, sf).select((F.col("class") == "p").alias("bad"), *[F.col(c).isNull().alias(c) for c in GAPPY])
    long = gaps.unpivot(["bad"], GAPPY, "feature", "gone")
    rates = long.groupBy("feature").agg(
        rnd(F.avg(F.when(F.col("gone"), F.col("bad").cast("int")))).alias("rate_missing"), rnd(F.avg(F.when(~F.col("gone"), F.col("bad").cast("int")))).alias("rate_present"))
    test = rounded(stats.chi_square(long, "gone", "bad", ["feature"]).drop("n", "dof"), "chi2", "cramers_v", "p_value")
    return rates.join(test, "feature")


@add("welch_t_test", "trips_li", f"""WITH m AS (SELECT avg(duration_minutes) FILTER (WHERE member_casual = 'casual') AS m1, avg(duration_minutes) FILTER (WHERE member_casual <> 'casual') AS m2,
        var_samp(duration_minutes) FILTER (WHERE member_casual = 'casual') AS v1, var_samp(duration_minutes) FILTER (WHERE member_casual <> 'casual') AS v2,
        count(*) FILTER (WHERE member_casual = 'casual') AS n1, count(*) FILTER (WHERE member_casual <> 'casual') AS n2 FROM trips_li)
    SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {r6("m1 - m2")} AS difference, {r6("(m1 - m2) / sqrt(v1 / n1 + v2 / n2)")} AS t,
        {r6("power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1))", 4)} AS dof FROM m""")
def welch_t_test(spark, sf):
    out = stats.welch(riders(spark, sf), "duration_minutes", F.col("member_casual") == "casual")
    return rounded(rounded(out, "difference", "t"), "dof", digits=4)


@add("spearman_corr", "trips_li", f"""WITH r AS (SELECT rank() OVER (ORDER BY duration_minutes) + (count(*) OVER (PARTITION BY duration_minutes) - 1) / 2.0::DOUBLE AS a,
        rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS b FROM trips_li) SELECT count(*) AS n, {r6("corr(a, b)")} AS rho FROM r""")
def spearman_corr(spark, sf):
    return rounded(stats.spearman(v.trips_li(spark, sf).select("duration_minutes", "l_quantity"), "duration_minutes", "l_quantity"), "rho")


@add("corr_matrix", "scores_li", " UNION ALL ".join(f"SELECT '{a}~{b}' AS pair, {r6(f'corr({a}, {b})')} AS r FROM scores_li"
                                                     for a, b in [("p_a", "p_b"), ("p_a", "p_c"), ("p_b", "p_c"), ("p_a", "y"), ("l_quantity", "p_a")]))
def corr_matrix(spark, sf):
    pairs = [("p_a", "p_b"), ("p_a", "p_c"), ("p_b", "p_c"), ("p_a", "y"), ("l_quantity", "p_a")]
    one = v.scores_li(spark, sf).agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in pairs])
    return rounded(one.unpivot([], [f"`{c}`" for c in one.columns], "pair", "r"), "r")


@add("morning_share_by_day", "trips_li", f"""WITH d AS (SELECT date_trunc('day', started_at) AS day, any_value(CASE WHEN isodow(started_at) >= 6 THEN 'weekend' ELSE 'weekday' END) AS daytype,
        count(*) FILTER (WHERE hour(started_at) BETWEEN 7 AND 9) * 1.0::DOUBLE / count(*) AS share FROM trips_li GROUP BY 1)
    SELECT daytype, count(*) AS days, {r6("median(share)", 9)} AS median_share FROM d GROUP BY 1""")
def morning_share_by_day(spark, sf):
    """Per day first; the medians are over calendar days."""
    ts = F.col("started_at")
    days = v.trips_li(spark, sf).groupBy(cal.day_floor(ts).alias("day")).agg(
        F.sum(features.morning(ts)).alias("m"), F.count(F.lit(1)).alias("n"))
    share = F.col("m") / F.greatest(F.col("n"), F.lit(1))
    return days.groupBy(features.daytype(F.col("day")).alias("daytype")).agg(
        F.count(F.lit(1)).alias("days"), rnd(F.percentile(share, 0.5), 9).alias("median_share"))


@add("paired_block_bootstrap", "preds", f"""WITH d AS (SELECT date_trunc('day', time) AS day, sum(abs(trips - pred_a)) AS sa, sum(abs(trips - pred_b)) AS sb, count(*) AS n FROM preds GROUP BY 1),
    p AS (SELECT row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS k, sa, sb, n FROM d),
    g AS (SELECT rep, ({mixed_sql("slot", "rep")}) % (SELECT max(k) FROM p) AS pos FROM range(2000) r(rep), range((SELECT max(k) FROM p)) s(slot)),
    x AS (SELECT rep, sum(sb) / sum(n) - sum(sa) / sum(n) AS d FROM g JOIN p USING (pos) GROUP BY 1)
    SELECT {r6("avg(d)")} AS gain, {r6("quantile_cont(d, 0.025)")} AS ci_low, {r6("quantile_cont(d, 0.975)")} AS ci_high, {r6("avg((d > 0)::INTEGER)")} AS p_better FROM x""")
def paired_block_bootstrap(spark, sf):
    errors = demand.predictions(spark, sf).select("time", F.abs(F.col("trips") - F.col("pred_a")).alias("a"), F.abs(F.col("trips") - F.col("pred_b")).alias("b"))
    return rounded(stats.block_bootstrap(spark, errors, "time", "a", "b", 2000), "gain", "ci_low", "ci_high", "p_better")


METRIC_REPS = 100


def _steps() -> list[float]:
    out, term, total = [], math.exp(-1.0), 0.0
    for k in range(12):
        total += term
        out.append(round(total, 12))
        term /= k + 1
    return out


WEIGHT = " + ".join(f"(u >= {s!r}::DOUBLE)::INTEGER" for s in _steps())


@add("metric_bootstrap", "scores_li", f"""
    WITH w AS (SELECT rep, y, p_a, {WEIGHT} AS w FROM (SELECT rep, y, p_a, ({mixed_sql("l_orderkey * 7 + l_linenumber", "l_partkey + rep * 1000003")}) / {P}.0::DOUBLE AS u FROM scores_li, range({METRIC_REPS}) r(rep))),
    c AS (SELECT rep, p_a, CAST(sum(w * y) AS DOUBLE) AS p, CAST(sum(w * (1 - y)) AS DOUBLE) AS n FROM w GROUP BY 1, 2),
    k AS (SELECT rep, p, n, p_a, sum(n) OVER (PARTITION BY rep ORDER BY p_a) - n AS below FROM c),
    m AS (SELECT rep, sum(p * (below + n / 2)) / (sum(p) * sum(n)) AS auc, sum(p) FILTER (WHERE p_a >= 0.3) / sum(p) AS recall, sum(n) FILTER (WHERE p_a < 0.3) / sum(n) AS specificity FROM k GROUP BY 1),
    l AS (UNPIVOT m ON auc, recall, specificity INTO NAME metric VALUE value)
    SELECT metric, {r6("avg(value)")} AS mean, {r6("quantile_cont(value, 0.025)")} AS ci_low, {r6("quantile_cont(value, 0.975)")} AS ci_high FROM l GROUP BY 1""")
def metric_bootstrap(spark, sf):
    """Poisson bootstrap: a weight per row and replicate, added up where the row's range of scores is walked."""
    rows = v.scores_li(spark, sf)
    out = metrics.bootstrap_scores(rows, "p_a", "y", F.col("l_orderkey") * 7 + F.col("l_linenumber"), F.col("l_partkey"), METRIC_REPS, cut=0.3)
    long = out.unpivot(["rep"], ["auc", "recall", "specificity"], "metric", "value")
    return rounded(long.groupBy("metric").agg(F.avg("value").alias("mean"), F.percentile("value", 0.025).alias("ci_low"), F.percentile("value", 0.975).alias("ci_high")),
                   "mean", "ci_low", "ci_high")


# --- regression with fixed effects ---------------------------------------------------------------


def wet_or_dry(spark, sf):
    rows = city_hours(spark, sf).where("wet <> 'drizzle'")
    return rows.withColumns({"wet_hour": (F.col("wet") == "wet").cast("double"),
                             "hour_weekday": F.when(F.col("daytype") == "weekday", F.col("hour")).otherwise(0).cast("string"),
                             "hour_weekend": F.when(F.col("daytype") == "weekend", F.col("hour")).otherwise(0).cast("string")})


FIXED = ["hour_weekday", "hour_weekend"]


@add("poisson_glm_effects")
def poisson_glm_effects(spark, sf):
    """Factor by which a wet hour multiplies departures, against dry hours of the same day."""
    return glm.absorbed_effects(spark, glm.fit_absorbed(wet_or_dry(spark, sf), "trips", FIXED, ["wet_hour"], "day"), ["wet_hour"], clustered=False)


@add("cluster_robust_se")
def cluster_robust_se(spark, sf):
    return glm.absorbed_effects(spark, glm.fit_absorbed(wet_or_dry(spark, sf), "trips", FIXED, ["wet_hour"], "day"), ["wet_hour"], clustered=True)


@add("dose_response")
def dose_response(spark, sf):
    """Effect of each rain class against dry hours, with day-clustered intervals."""
    rows = city_hours(spark, sf).withColumns({
        "hour_weekday": F.when(F.col("daytype") == "weekday", F.col("hour")).otherwise(0).cast("string"),
        "hour_weekend": F.when(F.col("daytype") == "weekend", F.col("hour")).otherwise(0).cast("string")})
    rain = F.col("precipitation_mm")
    classes = {"rain_to_half": (rain > 0) & (rain <= 0.5), "rain_to_2": (rain > 0.5) & (rain <= 2), "rain_to_5": (rain > 2) & (rain <= 5)}
    rows = rows.withColumns({k: t.cast("double") for k, t in classes.items()})
    return glm.absorbed_effects(spark, glm.fit_absorbed(rows, "trips", FIXED, list(classes), "day"), list(classes), clustered=True)


@add("deviance_explained")
def deviance_explained(spark, sf):
    """Share of the deviance explained by the calendar, and by the calendar with the weather."""
    rows = city_hours(spark, sf).withColumns({"slot": cal.slot(F.col("time")).cast("string"), "log_rain": F.log1p("precipitation_mm")})
    rows = glm.spline(rows, "temperature_c", 4)
    spline = [c for c in rows.columns if c.startswith("temperature_c_b")]
    return glm.deviance_table(spark, {
        "calendar": glm.fit(rows, "trips", ["slot"], []), "calendar and weather": glm.fit(rows, "trips", ["slot"], [*spline, "log_rain", "wind_kmh"])})
