"""Small frames for the tests."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)
KEY = ["series"]


def day(i: float) -> datetime:
    return START + timedelta(days=i)


def prices(spark, selling, buying=None, series="a", step=1.0):
    """One series, one row per `step` days."""
    buying = buying or selling
    rows = [
        (series, day(i * step), None if s is None else float(s), None if b is None else float(b))
        for i, (s, b) in enumerate(zip(selling, buying))
    ]
    df = spark.createDataFrame(rows, "series string, ts timestamp, selling_price double, buying_price double")
    return df.withColumn("spread", df.selling_price - df.buying_price)


def predictions(spark, y_true, y_pred, series="a", model="m"):
    rows = [(model, series, day(i), float(t), float(p)) for i, (t, p) in enumerate(zip(y_true, y_pred))]
    return spark.createDataFrame(rows, "model string, series string, ts timestamp, y_true double, y_pred double")


def by_time(df, column, ts="ts"):
    return [r[column] for r in df.orderBy(ts).collect()]
