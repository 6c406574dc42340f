"""The delay model that takes raw events."""

from pyspark.sql import functions as F

from punctua.operators import delay_model
from punctua.session import scratch_path
from punctua.sources.writers import load_model, save_model

SCHEMA = "trip_day STRING, vehicle STRING, stop_id STRING, sched_arr STRING, act_arr STRING, chances STRING"


def test_stored_model_scores_raw_events(spark):
    rows = [
        (f"{1 + k % 28:02d}.03.2022", "Zug" if k % 2 else "BUS", f"Parent850000{k % 3}:0:A", f"{1 + k % 28:02d}.03.2022 {8 + k % 9:02d}:30",
         f"{1 + k % 28:02d}.03.2022 {8 + k % 9:02d}:{31 + k % 2 * 12}:05", "kept elsewhere")
        for k in range(120)
    ]
    events = spark.createDataFrame(rows + rows[:5] + [("x", None, None, "bad", None, None), ("01.03.2022", "Zug", "1", "01.03.2022 09:00", None, None)], SCHEMA)
    labelled = delay_model.labelled_events(events)
    assert labelled.count() == 120 and {r[0] for r in labelled.select("delay_bin").distinct().collect()} == {2, 11}
    model = delay_model.fit_event_model(labelled, reg=0.001)
    loaded = load_model(save_model(model, scratch_path(spark, "model")))
    got, again = (delay_model.score_events(events, m) for m in (model, loaded))
    assert got.columns == ["trip_day", "vehicle", "stop_id", "sched_arr", "act_arr", "chances"]
    order = lambda df: sorted(df.collect(), key=str)
    assert order(got) == order(again) and len(order(got)) == 127
    # No arrival time, no chances; a new stop and a missing label are fine.
    assert [r.sched_arr for r in got.filter("chances is null").collect()] == ["bad"]
    late = delay_model.chance_from_bins(F.col("chances"), F.lit(5.0))
    by_type = {r.vehicle: r.p for r in got.filter("act_arr is not null").groupBy("vehicle").agg(F.avg(late).alias("p")).collect()}
    assert by_type["BUS"] > 0.95 and by_type["Zug"] < 0.05
    assert delay_model.score_events(events.limit(0), loaded).count() == 0


def test_calendar_fields_are_those_of_the_operating_day(spark):
    """A night trip belongs to the day before its arrival."""
    rows = [("31.12.2022", "Zug", "1", "01.01.2023 00:10", None, None), (None, "Zug", "1", "01.01.2023 00:10", None, None)]
    got = delay_model.EventFeatures().transform(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.year, r.month, r.day_of_year, r.hour, r.minute) for r in got] == [(2022, 12, 365, 0, 10), (2023, 1, 1, 0, 10)]
    named = delay_model.EventFeatures(dueCol="chances").transform(spark.createDataFrame(rows, SCHEMA)).first()
    assert (named.year, named.hour) == (0, 0)
