"""Top-k, samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewheel.functions import calendar as cal
from tidewheel.operators import splits
from tidewheel.operators.order import running_totals
from tidewheel.plans import demand
from tidewheel.plans import views as v
from tidewheel.plans.views import Book, r6, rounded

BOOK = Book()
add = BOOK.add
LI_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI = ", ".join(LI_KEY)
ORDER = ", ".join(v.TRIP_ORDER)
TIES = ["l_orderkey", "l_linenumber", "l_partkey", "width", "height"]
DRAW = "((l_orderkey * 48271 + l_linenumber * 69621) % 2147483647)"
CASE_ORDER = f"{DRAW}, {', '.join(TIES)}"


def narrow_trips(spark, sf):
    return v.trips_li(spark, sf).select(*v.TRIP_ORDER)


def draw():
    return splits.pick_number(F.col("l_orderkey"), F.col("l_linenumber"))


@add("legacy_row_id", "trips_li", f"""SELECT strftime(started_at, '%Y%m') || '-legacy-' || CAST(row_number() OVER (PARTITION BY strftime(started_at, '%Y%m')
    ORDER BY {ORDER}) - 1 AS VARCHAR) AS ride_id, {LI} FROM trips_li""")
def legacy_row_id(spark, sf):
    """Position within the source, for rows that came without an id."""
    rows = narrow_trips(spark, sf).withColumn("source", F.date_format("started_at", "yyyyMM"))
    placed = running_totals(rows, ["source"], v.TRIP_ORDER, {"one": F.lit(1)}, spread_copies=True)
    return placed.select(F.concat("source", F.lit("-legacy-"), F.col("one_before").cast("string")).alias("ride_id"), *LI_KEY)


@add("top_k", "trips_li", f"""(SELECT 'longest' AS side, {LI}, duration_minutes FROM trips_li ORDER BY duration_minutes DESC, {ORDER} LIMIT 15)
    UNION ALL (SELECT 'shortest', {LI}, duration_minutes FROM trips_li ORDER BY duration_minutes, {ORDER} LIMIT 10)""")
def top_k(spark, sf):
    trips = v.trips_li(spark, sf).select(*v.TRIP_ORDER, "duration_minutes")

    def pick(side, first, k):
        return trips.orderBy(first, *v.TRIP_ORDER).limit(k).select(F.lit(side).alias("side"), *LI_KEY, "duration_minutes")

    return pick("longest", F.desc("duration_minutes"), 15).unionByName(pick("shortest", F.asc("duration_minutes"), 10))


@add("top_abs_error_days", "preds", f"""WITH d AS (SELECT date_trunc('day', time)::TIMESTAMP AS day, CAST(sum(trips) AS BIGINT) AS trips, sum(pred_a) AS pred FROM preds GROUP BY 1)
    SELECT day, trips, {r6("pred")} AS pred, {r6("(pred / trips - 1) * 100")} AS error_pct FROM d WHERE trips > 0 ORDER BY abs(pred / trips - 1) DESC, day LIMIT 8""")
def top_abs_error_days(spark, sf):
    daily = demand.predictions(spark, sf).groupBy(cal.day_floor(F.col("time")).alias("day")).agg(
        F.sum("trips").alias("trips"), F.sum("pred_a").alias("pred")).where("trips > 0")
    error = (F.col("pred") / F.col("trips") - 1) * 100
    return rounded(daily.withColumn("error_pct", error).orderBy(F.abs(F.col("pred") / F.col("trips") - 1).desc(), "day").limit(8), "pred", "error_pct")


INDEXED = f"i AS (SELECT {LI}, row_number() OVER (ORDER BY {ORDER}) - 1 AS i, count(*) OVER () AS n FROM trips_li)"


@add("systematic_sample", "trips_li", f"WITH {INDEXED} SELECT {LI} FROM i WHERE i % greatest(1, CAST(ceil(n / 5000.0) AS BIGINT)) = 0")
def systematic_sample(spark, sf):
    return splits.systematic_sample(narrow_trips(spark, sf), v.TRIP_ORDER, 5000).select(*LI_KEY)


@add("linspace_sample", "trips_li", f"""WITH {INDEXED}, m AS (SELECT (j * ((SELECT count(*) FROM trips_li) - 1)) // 999 AS i FROM range(1000) t(j))
    SELECT {LI} FROM i WHERE i IN (SELECT i FROM m)""")
def linspace_sample(spark, sf):
    return splits.linspace_sample(narrow_trips(spark, sf), v.TRIP_ORDER, 1000).select(*LI_KEY)


@add("bernoulli_sample", "trips_li", f"SELECT {LI} FROM trips_li WHERE (l_orderkey * 48271 + l_partkey * 69621) % 2147483647 % 10000 < 20")
def bernoulli_sample(spark, sf):
    """A repeatable 0.2 % of the rows, decided row by row."""
    pick = F.pmod(splits.pick_number(F.col("l_orderkey"), F.col("l_partkey")), F.lit(10000)) < 20
    return v.trips_li(spark, sf).where(pick).select(*LI_KEY)


RANKED = f"r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY {CASE_ORDER}) - 1 AS rk, count(*) OVER (PARTITION BY class) AS cn FROM cases)"


def small_cases(spark, sf):
    return v.cases(spark, sf).select(*TIES, "class")


@add("stratified_sample", "cases", f"WITH {RANKED} SELECT class, {', '.join(TIES)} FROM r WHERE rk < 500")
def stratified_sample(spark, sf):
    ranked = splits.class_ranked(small_cases(spark, sf), "class", draw(), TIES)
    return ranked.where("_rank < 500").select("class", *TIES)


@add("stratified_split", "cases", f"""WITH {RANKED} SELECT class, {', '.join(TIES)}, CASE WHEN rk < floor(cn * 0.7::DOUBLE + 0.5) THEN 'train'
    WHEN rk < floor(cn * 0.85::DOUBLE + 0.5) THEN 'validation' ELSE 'test' END AS split FROM r""")
def stratified_split(spark, sf):
    out = splits.stratified_split(small_cases(spark, sf), "class", draw(), TIES, {"train": 0.7, "validation": 0.15, "test": 0.15})
    return out.select("class", *TIES, "split")


@add("temporal_split", "trips_li", f"""WITH {INDEXED}, c AS (SELECT *, greatest(1, least(n - 1, CAST(floor(n * 0.8::DOUBLE) AS BIGINT))) AS outer_cut FROM i)
    SELECT {LI}, CASE WHEN i < greatest(1, least(outer_cut - 1, CAST(floor(outer_cut * 0.8::DOUBLE) AS BIGINT))) THEN 'train' WHEN i < outer_cut THEN 'validation' ELSE 'test' END AS split FROM c""")
def temporal_split(spark, sf):
    return splits.nested_temporal_split(narrow_trips(spark, sf), v.TRIP_ORDER).select(*LI_KEY, "split")


@add("split_last_week", "trips_li", """SELECT date_trunc('month', started_at)::TIMESTAMP AS month, CASE WHEN day(started_at) > day(last_day(started_at)) - 7 THEN 'test' ELSE 'train' END AS split,
    count(*) AS trips FROM trips_li GROUP BY 1, 2""")
def split_last_week(spark, sf):
    ts = F.col("started_at")
    return v.trips_li(spark, sf).groupBy(cal.month_floor(ts).alias("month"), splits.last_week_label(ts).alias("split")).agg(F.count(F.lit(1)).alias("trips"))


@add("split_last_months", "orders_day", """SELECT day, trips, CASE WHEN day >= (SELECT max(day) + INTERVAL 1 HOUR - INTERVAL 12 MONTH FROM orders_day) THEN 'test' ELSE 'train' END AS split FROM orders_day""")
def split_last_months(spark, sf):
    days = v.orders_day(spark, sf)
    cut = splits.last_months_cut(days, "day", 12)
    return days.select("day", "trips", F.when(F.col("day") >= cut, "test").otherwise("train").alias("split"))


@add("backtest_folds", "orders_day", """WITH b AS (SELECT f AS fold, (SELECT max(day) + INTERVAL 1 HOUR FROM orders_day) - to_months(CAST(12 * (2 - f) AS INTEGER)) AS stop FROM range(3) t(f)),
    c AS (SELECT fold, stop, stop - INTERVAL 12 MONTH AS start FROM b)
    SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN day < start THEN 'train' ELSE 'validate' END AS role, count(*) AS days, CAST(sum(trips) AS BIGINT) AS trips, min(day) AS first_day, max(day) AS last_day
    FROM orders_day JOIN c ON day < stop GROUP BY 1, 2""")
def backtest_folds(spark, sf):
    out = splits.backtest_folds(v.orders_day(spark, sf), "day", 3, 12)
    return out.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("days"), F.sum("trips").alias("trips"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@add("group_kfold_week", "trips_li", """
    WITH RECURSIVE g AS (SELECT grp, n, row_number() OVER (ORDER BY n DESC, grp) AS i FROM
        (SELECT CAST(isoyear(started_at) * 100 + weekofyear(started_at) AS INTEGER) AS grp, count(*) AS n FROM trips_li GROUP BY 1)),
    r AS (SELECT CAST(0 AS BIGINT) AS i, CAST([0, 0, 0, 0, 0] AS BIGINT[]) AS loads, CAST(0 AS INTEGER) AS grp, CAST(-1 AS INTEGER) AS fold, CAST(0 AS BIGINT) AS n
        UNION ALL SELECT g.i, [CASE WHEN k = list_position(r.loads, list_min(r.loads)) THEN r.loads[k] + g.n ELSE r.loads[k] END FOR k IN [1, 2, 3, 4, 5]],
            g.grp, CAST(list_position(r.loads, list_min(r.loads)) - 1 AS INTEGER), g.n FROM r JOIN g ON g.i = r.i + 1)
    SELECT grp, fold, n FROM r WHERE i > 0""")
def group_kfold_week(spark, sf):
    return splits.group_folds(v.trips_li(spark, sf), cal.iso_week_group(F.col("started_at")), 5).select("grp", "fold", "n")


@add("stratified_kfold", "cases", f"WITH {RANKED} SELECT class, {', '.join(TIES)}, CAST(rk % 5 AS INTEGER) AS fold FROM r")
def stratified_kfold(spark, sf):
    return splits.stratified_folds(small_cases(spark, sf), "class", draw(), TIES, 5).select("class", *TIES, "fold")


@add("training_window", sql="""WITH c AS (SELECT max(o_orderdate) + INTERVAL 1 HOUR - INTERVAL 12 MONTH AS cut FROM orders),
    w AS (SELECT * FROM (VALUES ('last 1', 1), ('last 2', 2), ('last 3', 3), ('last 5', 5), ('all', 1000)) t(training_window, y))
    SELECT training_window, count(*) AS orders, min(o_orderdate) AS first_day FROM orders, c, w WHERE o_orderdate < cut AND o_orderdate >= cut - to_years(y) GROUP BY 1""")
def training_window(spark, sf):
    orders = v.table(spark, sf, "orders").select("o_orderdate")
    out = splits.training_windows(orders, "o_orderdate", splits.last_months_cut(orders, "o_orderdate", 12), [1, 2, 3, 5, None])
    return out.groupBy("training_window").agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_day"))
