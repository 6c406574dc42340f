"""Queries over features, clustering, regression and the delay model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from punctua.functions import delays, times
from punctua.functions.draws import draw_sql
from punctua.operators import clustering, delay_history, delay_model, features, regression, trends
from punctua.operators.aggregates import bootstrap_mean_ci
from punctua.plans.derived import LINE_DELAYS_SQL, STOP_EVENTS_SQL, T, bin_sql, line_delays, stop_events
from punctua.plans.queries_series import FOLDS_SQL
from punctua.plans.registry import query, row_count
from punctua.session import cut_lineage, scratch_path
from punctua.sources.catalog import holdout
from punctua.sources.writers import kept, load_model, save_model


@query("fea_1", "SELECT event_type, round(sum(value), 4) AS first_sum, CAST(sum(user_id) AS DOUBLE) AS second_sum FROM events GROUP BY event_type")
def fea_1(spark, sf):
    rows = features.assemble(T(spark, sf, "events"), ["value", "user_id"]).withColumn("v", vector_to_array("features"))
    return rows.groupBy("event_type").agg(F.round(F.sum(F.col("v")[0]), 4).alias("first_sum"), F.sum(F.col("v")[1]).alias("second_sum"))


@query("fea_2", """
    SELECT event_id, round((value - m) / s, 6) AS z, round(value / s, 6) AS scaled
    FROM events CROSS JOIN (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
""")
def fea_2(spark, sf):
    rows = features.standardise(T(spark, sf, "events"), ["value"], True, "z")
    rows = features.standardise(rows, ["value"], False, "scaled")
    first = lambda c: F.round(vector_to_array(c)[0], 6).alias(c)
    return rows.select("event_id", first("z"), first("scaled"))


@query("fea_3", """
    WITH ranked AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i FROM customer GROUP BY c_mktsegment)
    SELECT c_mktsegment, CAST(sum(CAST(i = 0 AS INTEGER)) AS BIGINT) AS slot_0, CAST(sum(CAST(i = 1 AS INTEGER)) AS BIGINT) AS slot_1, CAST(sum(CAST(i = 2 AS INTEGER)) AS BIGINT) AS slot_2
    FROM customer JOIN ranked USING (c_mktsegment) GROUP BY c_mktsegment
""")
def fea_3(spark, sf):
    rows, _ = features.one_hot(T(spark, sf, "customer"), ["c_mktsegment"])
    rows = rows.withColumn("v", vector_to_array("c_mktsegment_ohe"))
    return rows.groupBy("c_mktsegment").agg(*[F.sum(F.col("v")[i]).cast("bigint").alias(f"slot_{i}") for i in range(3)])


@query("fea_4", """
    SELECT CAST(minute(ts) AS INTEGER) AS minute, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
           CAST(week(ts) AS INTEGER) AS week_of_year, CAST(dayofyear(ts) AS INTEGER) AS day_of_year, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, count(*) AS n
    FROM events GROUP BY ALL
""")
def fea_4(spark, sf):
    return T(spark, sf, "events").groupBy(*[c.alias(n) for n, c in times.calendar_features("ts").items()]).agg(row_count())


@query("fea_5", f"""
    SELECT vehicle, count(*) AS n, count(arr_delay) AS known, round(avg(arr_delay / 60.0), 6) AS mean_minutes, max(arr_delay / 60.0) AS worst FROM ({STOP_EVENTS_SQL}) GROUP BY vehicle
""")
def fea_5(spark, sf):
    events = stop_events(spark, sf)
    due, real = times.safe_ts("sched_arr", times.MINUTE_PATTERN), times.safe_ts("act_arr", times.SECOND_PATTERN)
    late = events.withColumn("late", delays.delay_minutes(due, real))
    return late.groupBy("vehicle").agg(row_count(), F.count("late").alias("known"), F.round(F.avg("late"), 6).alias("mean_minutes"), F.max("late").alias("worst"))


def _vectors(spark, sf):
    rows = T(spark, sf, "embeddings")
    return rows.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"d{i}") for i in range(64)])


_DIMS = [f"d{i}" for i in range(64)]


#: Lloyd's fixed point: every border lies halfway between two neighbouring means.
@query("clu_1", """
    SELECT 4 AS clusters, count(*) AS n, round(min(c_acctbal), 2) AS lowest, round(max(c_acctbal), 2) AS highest, TRUE AS apart, TRUE AS halfway FROM customer
""")
def clu_1(spark, sf):
    found = clustering.kmeans(T(spark, sf, "customer"), ["c_acctbal"], k=4, seed=0, name="balance_cluster")
    each = found.groupBy("balance_cluster").agg(row_count(), F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest"), F.avg("c_acctbal").alias("mean"))
    # One row per cluster from here on.
    after = Window.orderBy("lowest")
    each = each.withColumns({"next": F.lead("lowest").over(after), "next_mean": F.lead("mean").over(after)})
    middle, slack = (F.col("mean") + F.col("next_mean")) / 2, F.lit(5.0)
    fine = F.col("next").isNull() | ((F.col("highest") <= middle + slack) & (F.col("next") >= middle - slack))
    return each.agg(
        F.count(F.lit(1)).cast("int").alias("clusters"), F.sum("n").alias("n"), F.round(F.min("lowest"), 2).alias("lowest"), F.round(F.max("highest"), 2).alias("highest"),
        F.every(F.col("next").isNull() | (F.col("highest") < F.col("next"))).alias("apart"), F.every(fine).alias("halfway"),
    )


#: One cluster has the whole variance, evenly spread values about 1/k^2 of it, and more clusters never cost more.
@query("clu_2", """
    SELECT k.range::INTEGER AS k, TRUE AS falling, TRUE AS near_even, round(v, 2) AS total FROM range(2, 10) k, (SELECT count(*) * var_pop(c_acctbal) AS v FROM customer)
""")
def clu_2(spark, sf):
    customer = T(spark, sf, "customer")
    total = customer.agg(F.count("c_acctbal") * F.var_pop("c_acctbal")).scalar()
    costs = clustering.kmeans_elbow(customer, ["c_acctbal"])
    before = F.lag("distortion").over(Window.orderBy("k"))
    share = F.col("distortion") / total * F.col("k") * F.col("k")
    return costs.select("k", (before.isNull() | (F.col("distortion") < before)).alias("falling"), share.between(0.8, 1.25).alias("near_even"), F.round(total, 2).alias("total"))


#: A silhouette lies between -1 and 1; of ten labelled groups it finds more than chance.
@query("clu_3", "SELECT k.range::INTEGER AS k, TRUE AS in_range FROM range(2, 10) k")
def clu_3(spark, sf):
    scores = clustering.kmeans_silhouette(_vectors(spark, sf), _DIMS)
    return scores.select("k", F.col("score").between(-1.0, 1.0).alias("in_range"))


@query("clu_4", """
    WITH c AS (SELECT user_id, CAST(dayofyear(ts) AS INTEGER) AS day, count(*) AS n FROM events GROUP BY ALL)
    SELECT count(DISTINCT user_id) AS members, sum(n)::BIGINT AS counted, 4 AS clusters, TRUE AS sizes, TRUE AS nearest, TRUE AS means, TRUE AS better_than_one FROM c
""")
def clu_4(spark, sf):
    """What the members and centres of the clustered series must satisfy."""
    counts = trends.daily_counts(T(spark, sf, "events"), "ts", "user_id")
    members, centres = clustering.cluster_series(counts, "user_id")
    with kept(members) as members:
        sums = counts.join(members, "user_id").groupBy("cluster", "day").agg(F.sum("count").alias("total"), (F.sum("count") / F.max("size")).alias("mean"))
        off = sums.join(centres, ["cluster", "day"], "full").agg(F.max(F.abs(F.coalesce("mean", F.lit(0.0)) - F.coalesce("value", F.lit(0.0)))).alias("off"), F.sum("total").alias("counted"))
        near = clustering.series_distances(counts, centres, "user_id")
        best = near.groupBy("user_id").agg(F.min("distance").alias("least"))
        own = near.join(members, ["user_id", "cluster"]).join(best, "user_id")
        per = own.groupBy("cluster", "size").agg(row_count(), F.every(F.col("distance") <= F.col("least") + 1e-6).alias("nearest"), F.sum("distance").alias("cost"))
        row = per.agg(F.sum("n").alias("members"), F.count(F.lit(1)).cast("int").alias("clusters"), F.every(F.col("n") == F.col("size")).alias("sizes"), F.every("nearest").alias("nearest"), F.sum("cost").alias("cost"))
        n = F.lit(members.count())
        squares = counts.agg(F.sum(F.col("count") * F.col("count"))).scalar()
        whole = counts.groupBy("day").agg(F.sum("count").alias("t")).agg(F.sum(F.col("t") * F.col("t"))).scalar()
        out = row.join(off).select(
            "members", "counted", "clusters", "sizes", "nearest", (F.col("off") < 0.01).alias("means"), (F.col("cost") < squares - whole / n).alias("better_than_one")
        )
        return spark.createDataFrame(out.collect(), out.schema)


@query("reg_1", """
    WITH t AS (SELECT l_extendedprice AS y, l_quantity AS x, l_shipdate FROM lineitem),
         f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t WHERE l_shipdate < TIMESTAMP '1999-01-01')
    SELECT x AS l_quantity, round(any_value(a + b * x), 2) AS reg_l_extendedprice, count(*) AS n FROM t, f GROUP BY x
""")
def reg_1(spark, sf):
    rows = regression.reconstruct(T(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"], "l_shipdate", "1999-01-01")
    return rows.groupBy("l_quantity").agg(F.round(F.max("reg_l_extendedprice"), 2).alias("reg_l_extendedprice"), row_count())


@query("reg_2", f"""
    WITH f AS (SELECT fold, value AS y, CAST(hour(ts) AS DOUBLE) AS x FROM ({FOLDS_SQL})),
         s AS (SELECT k.range AS split, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n_train FROM range(1, 21) k JOIN f ON f.fold < k.range GROUP BY 1)
    SELECT CAST(split AS INTEGER) AS fold, n_train, count(*) AS n_test, round(sqrt(avg(pow(y - a - b * x, 2))), 6) AS rmse FROM s JOIN f ON f.fold = s.split GROUP BY ALL
""")
def reg_2(spark, sf):
    events = T(spark, sf, "events").withColumn("hour", F.hour("ts").cast("double"))
    return regression.cv_rmse(events, "value", ["hour"], ["ts", "event_id"], 20).withColumn("rmse", F.round("rmse", 6))


@query("reg_2_interval")
def reg_2_interval(spark, sf):
    """Bootstrap interval of the fold errors, as drawn around a reconstruction."""
    events = T(spark, sf, "events").withColumn("hour", F.hour("ts").cast("double"))
    errors = regression.cv_rmse(events, "value", ["hour"], ["ts", "event_id"], 20)
    band = bootstrap_mean_ci(errors, "rmse", 10_000, 3, ["fold"])
    fitted = regression.reconstruct(events, "value", ["hour"], "ts", "2024-01-24")
    return regression.interval_band(fitted, band, "reg_value").groupBy("hour").agg(
        F.max("lower").alias("lower"), F.max("reg_value").alias("predicted"), F.max("upper").alias("upper")
    )


_TARGET = "d0"


@query("reg_3")
def reg_3(spark, sf):
    fit = regression.fit_linear(_vectors(spark, sf), _TARGET, _DIMS[1:])
    chosen = regression.select_by_coefficient(fit)
    return regression.coefficients(spark, fit).withColumn("kept", F.col("feature").isin(*chosen))


@query("reg_4")
def reg_4(spark, sf):
    rows = _vectors(spark, sf)
    chosen = regression.rfe(rows, _TARGET, _DIMS[1:], 3)
    return regression.coefficients(spark, regression.fit_linear(rows, _TARGET, chosen))


@query("reg_5", """
    WITH d AS (SELECT event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day, avg(value) AS y, avg(user_id) AS x FROM events GROUP BY ALL),
         p AS (SELECT * FROM d WHERE day <= TIMESTAMP '2024-01-22'),
         f AS (SELECT event_type, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p GROUP BY event_type),
         s AS (SELECT event_type, sqrt(sum(pow(y - a - b * x, 2)) / (count(*) - 2)) AS sigma FROM p JOIN f USING (event_type) GROUP BY event_type)
    SELECT event_type, day, round(a + b * x, 5) AS predicted, round(y - a - b * x, 5) AS effect, round(y - a - b * x - 1.959963984540054 * sigma, 5) AS effect_lower,
           round(sum(y - a - b * x) OVER w, 5) AS cumulative_effect,
           round(sum(y - a - b * x) OVER w + 1.959963984540054 * sigma * sqrt(count(*) OVER w), 5) AS cumulative_upper
    FROM d JOIN f USING (event_type) JOIN s USING (event_type) WHERE day BETWEEN TIMESTAMP '2024-01-23' AND TIMESTAMP '2024-01-30'
    WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING)
""")
def reg_5(spark, sf):
    daily = T(spark, sf, "events").groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.avg("value").alias("y"), F.avg("user_id").alias("x")
    )
    found = regression.impact(daily, ["event_type"], "day", "y", ["x"], ("2024-01-01", "2024-01-22"), ("2024-01-23", "2024-01-30"))
    wanted = ["predicted", "effect", "effect_lower", "cumulative_effect", "cumulative_upper"]
    return found.select("event_type", "day", *[F.round(c, 5).alias(c) for c in wanted])


def _model_rows(spark, sf):
    events = stop_events(spark, sf).withColumnRenamed("stop_name", "stop_id").filter(F.col("arr_status") != "PROGNOSE")
    return delay_model.model_rows(events.withColumn("stop_id", F.substring("stop_id", 10, 9)))


@query("cls_1")
def cls_1(spark, sf):
    """Mean predicted chance of each bin beside its frequency in the data."""
    with kept(_model_rows(spark, sf)) as rows:
        model = delay_model.fit_delay_model(rows, max_iter=100)
        scored = delay_model.score(rows, model)
        # No row lacks chances.  The plain form would filter the scored rows first, which scores them again.
        chances = scored.select(F.posexplode_outer("chances").alias("delay_bin", "p")).groupBy("delay_bin").agg(F.avg("p").alias("mean_chance"))
        total = rows.agg(F.count(F.lit(1)))
        seen = rows.groupBy("delay_bin").agg((F.count(F.lit(1)) / total.scalar()).alias("frequency"))
        return cut_lineage(chances.join(seen, "delay_bin", "left").na.fill(0.0))


@query("cls_2")
def cls_2(spark, sf):
    """Chance of staying within five minutes, per transport type."""
    with kept(_model_rows(spark, sf)) as rows:
        model = delay_model.fit_delay_model(rows, max_iter=100)
        p = delay_model.chance_from_bins(F.col("chances"), F.lit(5.0))
        return cut_lineage(delay_model.score(rows, model).groupBy("transport_type").agg(row_count(), F.avg(p).alias("p_within_5")))


#: A model with free intercepts that has converged predicts each bin as often as it occurs.
@query("cls_2_stored", f"""
    SELECT CAST(b AS INTEGER) AS delay_bin, count(*) AS n, TRUE AS as_frequent, TRUE AS whole, TRUE AS equal
    FROM (SELECT DISTINCT strftime(l_shipdate, '%d.%m.%Y') AS trip_day, vehicle, s, due, act_arr, {bin_sql('late / 60.0')} AS b
          FROM (SELECT *, l_suppkey AS s, greatest(0, epoch(date_trunc('second', act_arr)) - epoch(date_trunc('minute', due))) AS late FROM ({STOP_EVENTS_SQL}) WHERE status <> 'PROGNOSE'))
    GROUP BY b
""")
def cls_2_stored(spark, sf):
    """Raw events scored by a model that was stored and loaded, against the model itself."""
    events = stop_events(spark, sf).filter(F.col("arr_status") != "PROGNOSE").withColumn("stop_id", F.substring("stop_name", 10, 9))
    rows = delay_model.labelled_events(events.select("trip_day", "vehicle", "stop_id", "sched_arr", "act_arr"))
    with kept(rows) as rows:
        model = delay_model.fit_event_model(rows)
        loaded = load_model(save_model(model, scratch_path(spark, "delay_model")))
        both = rows
        for scorer, name in ((model, "own"), (loaded, "again")):
            both = delay_model.score_events(both, scorer).withColumnRenamed("chances", name)
        total = F.aggregate("again", F.lit(0.0), lambda a, x: a + x)
        apart = F.array_max(F.zip_with("own", "again", lambda a, b: F.abs(a - b)))
        # Per row, before the bins are rows of their own; no row lacks chances.
        whole = both.select("delay_bin", "again", total.alias("total"), apart.alias("apart"))
        checked = whole.select("delay_bin", F.posexplode_outer("again").alias("bin", "p"), "total", "apart")
        per_bin = checked.groupBy("bin").agg(
            F.sum("p").alias("expected"), F.count_if(F.col("bin") == F.col("delay_bin")).alias("n"),
            F.max(F.abs(F.col("total") - 1)).alias("off"), F.max("apart").alias("apart"), F.count(F.lit(1)).alias("rows"),
        )
        return cut_lineage(per_bin.filter("n > 0").select(
            F.col("bin").alias("delay_bin"), "n", (F.abs(F.col("expected") - F.col("n")) < 0.002 * F.col("rows")).alias("as_frequent"),
            (F.col("off") < 1e-9).alias("whole"), (F.col("apart") == 0).alias("equal"),
        ))


@query("cls_3")
def cls_3(spark, sf):
    """Grid of penalties on the label column of the vectors."""
    return delay_model.grid_search(_vectors(spark, sf), numeric=_DIMS, categories=[], label="label", max_iter=100)


@query("cls_4", f"""
    SELECT place <= 1000 AS held_out, count(*) AS n, sum(event_id)::BIGINT AS ids, round(sum(value), 4) AS total
    FROM (SELECT *, row_number() OVER (ORDER BY {draw_sql(3, 'event_id')}, event_id) AS place FROM events) GROUP BY 1
""")
def cls_4(spark, sf):
    rest, out = holdout(T(spark, sf, "events"), 1000, ["event_id"], seed=3)
    both = rest.withColumn("held_out", F.lit(False)).unionByName(out.withColumn("held_out", F.lit(True)))
    return both.groupBy("held_out").agg(row_count(), F.sum("event_id").alias("ids"), F.round(F.sum("value"), 4).alias("total"))


@query("cls_5", f"""
    WITH b AS (SELECT vehicle, l_linestatus, {bin_sql('delay_minutes')} AS b FROM ({LINE_DELAYS_SQL})),
         t AS (SELECT vehicle, l_linestatus, count(*) AS samples FROM b GROUP BY ALL)
    SELECT vehicle, l_linestatus, samples, CAST(bin AS INTEGER) AS delay_bin, round(upto::DOUBLE / samples, 8) AS p FROM t JOIN (
        SELECT vehicle, l_linestatus, g.range AS bin, count(CASE WHEN b.b <= g.range THEN 1 END) AS upto FROM b CROSS JOIN range(0, 15) g GROUP BY ALL)
    USING (vehicle, l_linestatus)
""")
def cls_5(spark, sf):
    cdf = delay_history.delay_cdf(line_delays(spark, sf), ["vehicle", "l_linestatus"])
    return delay_history.cdf_rows(cdf).withColumn("p", F.round("p", 8))


@query("cls_5_lookup", f"""
    WITH d AS (SELECT * FROM ({LINE_DELAYS_SQL})),
         b AS (SELECT vehicle, {bin_sql('delay_minutes')} AS b FROM d WHERE vehicle <> 'R'),
         c AS (SELECT vehicle, g.range AS bin, count(CASE WHEN b <= g.range THEN 1 END) / count(*) AS p FROM b CROSS JOIN range(0, 15) g GROUP BY ALL),
         s AS (SELECT l_returnflag AS vehicle, l_quantity - 10 AS slack, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT s.vehicle, slack AS slack_minutes, n, round(coalesce(p, least(pow(0.99, 10 - slack), 1)), 8) AS p
    FROM s LEFT JOIN c ON c.vehicle = s.vehicle AND c.bin = {bin_sql('slack')}
""")
def cls_5_lookup(spark, sf):
    """Chance of making a connection; one transport type has no history."""
    known = line_delays(spark, sf).filter(F.col("vehicle") != "R")
    slack = T(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("vehicle"), (F.col("l_quantity") - 10).alias("slack_minutes")).agg(row_count())
    found = delay_history.p_on_time(slack, delay_history.delay_cdf(known, ["vehicle"]), ["vehicle"])
    return found.withColumn("p", F.round("p", 8))
