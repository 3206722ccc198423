import json

from pyspark.sql import functions as F

from tickengine.operators import feed as FD
from tickengine.sources.envelope import generated_events, received_records


def test_chart_labels(spark):
    df = spark.createDataFrame([(1705309200, 1234.5, "2024-01-15T09:00:00Z"), (0, 0.004, None)],
                               "t long, p double, ts string")
    got = df.select(FD.axis_label(F.col("t")).alias("a"), FD.price_label(F.col("p")).alias("p"),
                    FD.update_label(F.col("ts")).alias("u"), FD.date_label(F.col("ts")).alias("d")).collect()
    assert tuple(got[0]) == ("09:00", "1,234.50", "09:00:00", "Monday, January 15, 2024")
    assert tuple(got[1]) == ("00:00", "0.00", "No updates", "No date")


def test_generated_learning_events(spark):
    rows = received_records(generated_events(spark, 10)).orderBy("offset").collect()
    assert [r.key for r in rows[:4]] == ["user-1", "user-2", "user-0", "user-1"]
    msg = json.loads(rows[9].value)
    assert (msg["event"], msg["count"]) == ("page_view", 10) and msg["at"].endswith("Z")
