import json
import os
from datetime import datetime, timedelta

from frames import by_time, day, prices
from pyspark.sql import functions as F

from tidemark.operators.cleaning import split_bad_records
from tidemark.operators.features import add_indicators
from tidemark.schemas import BUY_FIELD, SELL_FIELD, SUCCESS_CODE, TIME_FIELD
from tidemark.session import shared_folder, stored
from tidemark.sources.payloads import (
    explode_records,
    land_payloads,
    latest_snapshot,
    parse_payloads,
    read_price_payloads,
    to_payload_text,
    validate_payload,
)
from tidemark.sources.tables import read_prices, write_bucketed, write_prices
from tidemark.streaming.payloads import KINDS, land_price_stream, landed, landed_prices, stream_price_payloads, write_stream

KEY = ["series"]


def record(i, **changes):
    r = {SELL_FIELD: str(100 + i), BUY_FIELD: str(90 + i), TIME_FIELD: f"2024-01-{i + 1:02d}"}
    r.update(changes)
    return {k: v for k, v in r.items() if v != "absent"}


def payload(records, code=SUCCESS_CODE):
    return json.dumps({"responseCode": code, "data": {"priceList": records}})


CASES = {
    "good": payload([record(i) for i in range(7)]),
    "numbers": payload([{SELL_FIELD: 101.5, BUY_FIELD: 91, TIME_FIELD: "2024-01-01"}]),
    "code": payload([record(0)], "500"),
    "empty": payload([]),
    "third": payload([record(i) if i != 2 else record(2, **{BUY_FIELD: "absent"}) for i in range(7)]),
    "sixth": payload([record(i) if i != 5 else record(5, **{BUY_FIELD: "absent"}) for i in range(7)]),
    "null": payload([record(0, **{BUY_FIELD: None}), record(1)]),
    "no_data": json.dumps({"responseCode": SUCCESS_CODE}),
    "no_list": json.dumps({"responseCode": SUCCESS_CODE, "data": {}}),
}
REASONS = {
    "good": None,
    "numbers": None,
    "code": "response_code",
    "empty": "empty_price_list",
    "third": f"missing_{BUY_FIELD}",
    "sixth": None,
    "null": None,
    "no_data": "missing_price_list",
    "no_list": "missing_price_list",
}


def texts(spark):
    return spark.createDataFrame(list(CASES.items()), "name string, value string")


def test_validation(spark):
    checked = validate_payload(parse_payloads(texts(spark)))
    assert {r["name"]: r.reject_reason for r in checked.collect()} == REASONS
    assert {r["name"] for r in checked.filter("is_valid").collect()} == {k for k, v in REASONS.items() if v is None}


def test_records_and_quarantine(spark):
    checked = validate_payload(parse_payloads(texts(spark))).filter("is_valid")
    records = explode_records(checked, ["name"])
    good, bad = split_bad_records(records, ["name"], ["ordinal"])
    assert {(r["name"], r.ordinal) for r in bad.collect()} == {("sixth", 5), ("null", 0)}
    assert good.filter("name = 'numbers'").first().selling_price == 101.5
    assert [r.ordinal for r in good.filter("name = 'good'").orderBy("ts").collect()] == list(range(7))


def test_files(spark, tmp_path):
    for name, text in CASES.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(json.loads(text), indent=2))
    checked = validate_payload(read_price_payloads(spark, str(tmp_path)))
    found = {r.source.rsplit("/", 1)[1][:-5]: r.reject_reason for r in checked.collect()}
    assert found == REASONS


def test_text_round_trip(spark):
    df = spark.createDataFrame([("a", i, str(i), str(i), f"2024-01-0{i}") for i in (3, 1, 2)], f"series string, ordinal int, {SELL_FIELD} string, {BUY_FIELD} string, {TIME_FIELD} string")
    back = explode_records(validate_payload(parse_payloads(to_payload_text(df, ["series"]))), ["series"])
    assert [r[SELL_FIELD] for r in back.orderBy("ordinal").collect()] == ["1", "2", "3"]


def test_snapshots(spark, tmp_path):
    rows = [("a", datetime(2024, 1, 1), 1), ("a", datetime(2024, 1, 3, 11), 2), ("b", datetime(2024, 1, 3, 10, 59, 59), 3), ("c", datetime(2024, 1, 3, 11, 0, 1), 4)]
    path = str(tmp_path / "landed")
    df = spark.createDataFrame(rows, "source string, ingest_ts timestamp, v int")
    land_payloads(df.filter("v < 3"), path)
    land_payloads(df.filter("v >= 3"), path)
    landed = spark.read.parquet(path)
    assert landed.select("ingest_date").distinct().count() == 2
    now = F.lit("2024-01-03 12:00:00").cast("timestamp")
    # One hour ago exactly is already too old.
    assert [r.v for r in latest_snapshot(landed, now=now).collect()] == [4]
    stale = {r.source: (r.v, r.is_fresh) for r in latest_snapshot(landed, now=now, stale_ok=True).collect()}
    assert stale == {"a": (2, False), "b": (3, False), "c": (4, True)}


def test_price_table_by_year(spark, tmp_path, capsys):
    path = str(tmp_path / "prices")
    write_prices(prices(spark, range(1, 800)), path)
    recent = read_prices(spark, path).filter("year = 2025")
    assert recent.count() == 365
    recent.explain()
    assert "PartitionFilters: [isnotnull(year" in capsys.readouterr().out


def test_bucketed_tables_need_no_shuffle(spark, tmp_path):
    rows = prices(spark, range(1, 90)).unionByName(prices(spark, range(5, 60), series=None)).unionByName(prices(spark, [3, 4], series="b"))
    table = write_bucketed(rows, "prices_by_series", KEY, buckets=4, path=str(tmp_path / "prices"))
    assert sorted(table.collect(), key=repr) == sorted(rows.collect(), key=repr)
    made = add_indicators(table, KEY, blocks=None)
    assert sorted(made.collect(), key=repr) == sorted(add_indicators(rows, KEY, blocks=None).collect(), key=repr)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan and "Window" in plan
    # Rows of a series meet in one file, and further writes are refused unless they replace the table.
    files = table.select("series", F.col("_metadata.file_name").alias("f")).distinct().groupBy("series").count().collect()
    assert {r["count"] for r in files} == {1}
    spark.sql("DROP TABLE prices_by_series")


def test_stored_tables_live_in_the_shared_folder(spark):
    df = stored(spark.range(5))
    assert sorted(r.id for r in df.collect()) == [0, 1, 2, 3, 4]
    assert df.inputFiles()[0].replace("file://", "").startswith(shared_folder(spark).replace("file:", ""))


def test_stream_drops_repeated_deliveries_and_late_rows(spark, tmp_path):
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    (tmp_path / "in").mkdir()

    def deliver(name, days):
        records = [record(0, **{TIME_FIELD: day(d).strftime("%Y-%m-%d")}) for d in days]
        (tmp_path / "in" / f"{name}.json").write_text(payload(records))
        df = stream_price_payloads(spark, source, "10 days")
        write_stream(df, sink, marks).awaitTermination()

    deliver("first", [0, 1, 2])
    deliver("second", [1, 2, 3, 40])
    deliver("third", [5, 35, 40, 41])
    got = [t.day + 31 * (t.month - 1) - 1 for t in by_time(spark.read.parquet(sink), "ts")]
    # Day 5 arrives more than ten days behind day 40 and is late.
    assert got == [0, 1, 2, 3, 35, 40, 41]


def test_stream_keeps_all_that_arrives(spark, tmp_path):
    """Against a plain loop over batches: first copies, late copies, unreadable records and rejected payloads."""
    source, target = tmp_path / "in", str(tmp_path / "landed")
    late, quarantined, rejected, state, seen, closed = [], [], [], [], {}, None

    def deliver(*files):
        nonlocal closed
        batch, newest = [], closed
        for age, (name, code, records) in enumerate(files):
            folder = source / f"series={name[0]}"
            folder.mkdir(parents=True, exist_ok=True)
            file = folder / f"{name}.json"
            file.write_text(payload([record(0, **{SELL_FIELD: p, TIME_FIELD: t}) for p, t in records], code))
            os.utime(file, (1_700_000_000 + deliver.clock - age,) * 2)  # later files are older
            if code != SUCCESS_CODE or not records:
                rejected.append((name[0], "response_code" if code != SUCCESS_CODE else "empty_price_list"))
                continue
            for ordinal, (price, time) in enumerate(records):
                if price == "n/a" or time == "?":
                    quarantined.append((name[0], ordinal, "bad_time" if time == "?" else "bad_selling_price"))
                else:
                    batch.append((deliver.clock - age, file.name, ordinal, name[0], datetime.fromisoformat(time), float(price)))
        deliver.clock += 100
        for *_, series, ts, price in sorted(batch):
            if closed is not None and ts <= closed:
                late.append((series, ts, price))
            else:
                seen.setdefault((series, ts), price)
            newest = max(x for x in (newest, ts - timedelta(days=10)) if x is not None)
        closed = newest
        query = land_price_stream(spark, str(source), target, f"{target}/checkpoint", ["series"], watermark="10 days")
        query.awaitTermination()
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"] if query.lastProgress else None)

    deliver.clock = 0
    ok = SUCCESS_CODE
    deliver(("a1", ok, [("1", "2024-01-01"), ("2", "2024-01-01"), ("-3", "2024-01-02"), ("n/a", "2024-01-03")]), ("a2", ok, [("9", "2024-01-01")]), ("b1", "500", [("1", "2024-01-01")]))
    deliver(("a3", ok, [("7", "2024-01-02"), ("8", "2024-01-04"), ("4", "?")]), ("b2", ok, [("5", "2024-01-01")]), ("b3", ok, []))
    deliver(("a4", ok, [("6", "2024-03-01"), ("6", "2024-02-20")]))
    deliver(("a5", ok, [("7", "2024-01-01"), ("7", "2024-02-20"), ("7", "2024-02-21"), ("n/a", "2024-01-01")]), ("a6", ok, [("8", "2024-02-21"), ("8", "2024-02-20"), ("3", "2024-02-25")]))
    deliver(("b4", ok, [("6", "2024-06-01")]))
    query = land_price_stream(spark, str(source), target, f"{target}/checkpoint", ["series"], watermark="10 days")
    query.awaitTermination()  # nothing new
    got = {k: sorted(tuple(r) for r in landed(spark, target, k).select("series", "ts", "selling_price", "ordinal", "reason").collect()) if k not in ("quarantined", "rejected") else
           sorted(tuple(r) for r in landed(spark, target, k).select("series", "ordinal", "reason", "payload").collect()) for k in KINDS}
    assert [r[:3] for r in got["price"]] == sorted((s, t, p) for (s, t), p in seen.items())
    assert [r[:3] for r in got["late"]] == sorted(late) and late
    assert [r[:3] for r in got["quarantined"]] == sorted(quarantined)
    assert [(r[0], r[2]) for r in got["rejected"]] == sorted(rejected) and all(json.loads(r[3])["responseCode"] for r in got["rejected"])
    assert sorted((r.series, r.ts, r.selling_price) for r in landed_prices(spark, target).collect()) == sorted((s, t, p) for (s, t), p in seen.items() if p > 0)
    # Closed timestamps leave the state: after the last delivery only its own is open.
    assert state[-1] < max(state)
