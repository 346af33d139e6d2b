"""Aggregates after a lookup in a session without this library's settings, broadcast off."""

import re

import pytest
from frames import KEY, prices
from pyspark.sql import functions as F

from tidemark.functions.numeric import aggregate_apart, attach
from tidemark.operators.cleaning import quality_report
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.reporting import histogram
from tidemark.schemas import BUY_FIELD, SELL_FIELD, TIME_FIELD
from tidemark.session import stored

PLAIN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def plain(spark):
    before = {k: spark.conf.get(k, None) for k in PLAIN}
    for k, v in PLAIN.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 97)).alias("series"),
        ((F.col("id") * 7919) % 10_007 / 10).alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("ballast"),
    )
    return stored(rows.repartition(12))


def test_a_hot_key_is_split_between_lookup_and_aggregate(plain):
    rows = _hot(plain)
    sizes = rows.groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    met = attach(rows, sizes, KEY)
    found = aggregate_apart(met, KEY, F.max("_n").alias("n"), F.count(F.lit(1)).alias("m"), F.max("ballast").alias("b"))
    got = {r.series: (r.n, r.m) for r in found.collect()}
    assert got["hot"] == (40_000, 40_000) and all(a == b for a, b in got.values())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan.split("Initial Plan")[0]
    # A plain join and grouping by the same key keep the hot key in one task.
    bare = rows.join(stored(sizes), KEY).groupBy(*KEY).agg(F.max("_n"), F.max("ballast"))
    bare.collect()
    assert "skew=true" not in bare._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _aggregated_over(plan: str) -> list[str]:
    """Grouping keys of aggregates that sit on a join with no exchange between."""
    lines, out = plan.split("Initial Plan")[0].splitlines(), []
    for i, line in enumerate(lines):
        if "Aggregate(" in line and "partial" in line:
            below = next((x for x in lines[i + 1 :] if re.search("Exchange|Join|Scan|QueryStage", x)), "")
            if "Join" in below:
                out.append(re.search(r"keys=\[(.*?)\], f", line)[1])
    return out


def test_results_and_plans_of_the_operators(plain):
    rows = _hot(plain)
    binned = histogram(rows, "v", 10, KEY)
    n = {(r.series, r.bin): r.n for r in binned.collect()}
    assert sum(v for (s, _), v in n.items() if s == "hot") == 40_000
    grouped = _aggregated_over(binned._jdf.queryExecution().executedPlan().toString())
    assert all(g.startswith("__group") or g.startswith("struct(") or "_groupingexpression" in g for g in grouped)
    q = {r.series: r.q0 for r in exact_quantiles(rows, KEY, "v", (0.5,)).collect()}
    assert q["hot"] == pytest.approx(rows.filter("series = 'hot'").agg(F.percentile("v", 0.5)).first()[0])
    records = rows.select("series", F.col("v").cast("int").cast("string").alias(SELL_FIELD), F.col("v").cast("string").alias(BUY_FIELD), F.lit("2024-01-01").alias(TIME_FIELD))
    report = {(r.series, r["check"]): r.n_bad for r in quality_report(records, KEY, 10).collect()}
    assert report["hot", "duplicate_dates"] == 39_999 and report["hot", "insufficient_rows"] == 0


def test_null_keys_and_no_keys(spark):
    df = prices(spark, [1, 2]).unionByName(prices(spark, [5, 6, 7], series=None))
    got = {r.series: r.n for r in aggregate_apart(df, KEY, F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"a": 2, None: 3}
    assert aggregate_apart(df, [], F.count(F.lit(1)).alias("n")).first().n == 5
