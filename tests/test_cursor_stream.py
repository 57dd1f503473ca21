"""Extracts whose offsets are cursor values, and repeats dropped by arrival."""

from datetime import date, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from tideline.sources.cursor import CursorRange, CursorSource, CursorTable, cursor_stream, cut
from tideline.sources.store import StoredTable
from tideline.streaming.merge import run_to_end, state_rows, suppress_repeats

T0 = datetime(2025, 1, 1)
SCHEMA = "id bigint, at timestamp_ntz, name string"


def write(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(str(path))


def batch(spark, path, cursor, **options):
    spark.dataSource.register(CursorSource)
    return spark.read.format("cursor").options(path=str(path), cursor=cursor, **options).load()


def test_ranges_cover_every_row_once(spark, tmp_path):
    rows = [(i, T0 + timedelta(hours=i * i % 97), "x") for i in range(200)] + [(900, None, "null"), (901, T0, None)]
    write(spark, tmp_path / "t", rows)
    for slices in (1, 3, 500):
        got = batch(spark, tmp_path / "t", "at", slices=slices)
        assert got.schema == spark.read.parquet(str(tmp_path / "t")).schema
        assert sorted(r["id"] for r in got.collect()) == sorted(r[0] for r in rows if r[1] is not None)
        assert got.rdd.getNumPartitions() <= max(slices, 1)


def test_since_is_exclusive(spark, tmp_path):
    write(spark, tmp_path / "t", [(i, T0 + timedelta(days=i), None) for i in range(5)])
    since = (T0 + timedelta(days=2)).isoformat()
    assert sorted(r["id"] for r in batch(spark, tmp_path / "t", "at", since=since).collect()) == [3, 4]
    assert batch(spark, tmp_path / "t", "at", since=(T0 + timedelta(days=9)).isoformat()).count() == 0


@pytest.mark.parametrize("kind, values", [
    ("bigint", [-5, 0, 3, 2**53 + 1, 2**53 + 2]), ("date", [date(2025, 1, d) for d in (1, 2, 9, 20, 31)]),
    ("timestamp", [T0 + timedelta(microseconds=m) for m in (0, 1, 2, 10**9, 10**12)]),
])
def test_kinds_of_cursor(spark, tmp_path, kind, values):
    write(spark, tmp_path / "t", [(i, v) for i, v in enumerate(values)], f"id bigint, c {kind}")
    got = batch(spark, tmp_path / "t", "c", slices=3)
    assert sorted(got.collect()) == sorted(spark.read.parquet(str(tmp_path / "t")).collect())


def test_tables_without_cursor_values(spark, tmp_path):
    write(spark, tmp_path / "t", [(1, None, "a")])
    assert batch(spark, tmp_path / "t", "at").count() == 0
    write(spark, tmp_path / "empty", [])
    assert batch(spark, tmp_path / "empty", "at").count() == 0


def test_wrong_options(tmp_path, spark):
    write(spark, tmp_path / "t", [(1, T0, "a")])
    for options, message in [
        ({"path": str(tmp_path / "t")}, "cursor"), ({"path": str(tmp_path / "t"), "cursor": "at", "slices": "0"}, "slices"),
        ({"path": str(tmp_path / "t"), "cursor": "gone"}, "no column"), ({"path": str(tmp_path / "t"), "cursor": "name"}, "whole number"),
    ]:
        with pytest.raises(ValueError, match=message):
            CursorTable(options).bounds()


def test_cut():
    assert cut(0, 10, 4) == [2, 5, 7, 10] and cut(0, 2, 8) == [1, 2] and cut(5, 5, 3) == [5]
    assert cut(date(2025, 1, 1), date(2025, 1, 3), 2) == [date(2025, 1, 2), date(2025, 1, 3)]


def test_stream_goes_on_at_its_cursor(spark, tmp_path):
    seen = []

    def load():
        stream = cursor_stream(spark, str(tmp_path / "t"), "at", slices=2)
        writer = stream.writeStream.foreachBatch(lambda df, _: seen.append(sorted(r["id"] for r in df.collect())))
        run_to_end(writer.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        return [ids for ids in seen if ids]

    write(spark, tmp_path / "t", [(1, T0, "a"), (2, T0 + timedelta(days=1), "b")])
    assert load() == [[1, 2]]
    assert load() == [[1, 2]]
    # A changed row comes again with a newer cursor; a row at the offset is not seen.
    write(spark, tmp_path / "t", [(1, T0 + timedelta(days=3), "c"), (5, T0 + timedelta(days=1), "late"), (6, None, "null")])
    assert load() == [[1, 2], [1]]


def deliver(spark, root, events, delay, target):
    events.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    passed = []

    def apply(df, number):  # one action a batch: each one runs the stateful plan, and its metrics add up
        rows = df.collect()
        passed.extend(rows)
        if rows:
            target.insert_if_absent(spark.createDataFrame(rows, events.schema), "at")

    writer = suppress_repeats(stream, "id", delay).writeStream.foreachBatch(apply)
    query = writer.option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    run_to_end(query)
    return len(passed), state_rows(query)[-1]


def test_repeats_within_the_delay_stop_at_the_state(spark, tmp_path):
    events = spark.createDataFrame([(i, T0 - timedelta(days=400 * i), "x") for i in range(20)] + [(3, T0, "y")], SCHEMA)
    target = StoredTable(spark, str(tmp_path / "t"), "id", 4)
    assert deliver(spark, str(tmp_path), events, "1 hour", target) == (20, 20)
    # Old rows are not late: a new key far below all event times still passes.
    more = events.unionByName(spark.createDataFrame([(99, T0 - timedelta(days=90_000), "old")], SCHEMA))
    assert deliver(spark, str(tmp_path), more, "1 hour", target) == (1, 21)
    assert target.read().count() == 21


def test_repeats_beyond_the_delay_stop_at_the_merge(spark, tmp_path):
    events = spark.createDataFrame([(i, T0, "x") for i in range(20)], SCHEMA)
    target = StoredTable(spark, str(tmp_path / "t"), "id", 4)
    for _ in range(3):
        passed, kept = deliver(spark, str(tmp_path), events, "0 seconds", target)
        assert (passed, kept) == (20, 0)
    assert sorted(r["id"] for r in target.read().collect()) == list(range(20))


def test_reserved_name(spark):
    stream = spark.readStream.format("rate").load().withColumnRenamed("value", "_arrived")
    with pytest.raises(ValueError, match="_arrived"):
        suppress_repeats(stream, "timestamp", "1 hour")


def test_a_row_group_is_decoded_in_pieces(spark, tmp_path):
    table = pa.table({"id": range(1_000_000), "at": range(1_000_000), "x": range(1_000_000)})
    pq.write_table(table, tmp_path / "one.parquet", row_group_size=1_000_000, use_dictionary=False)
    del table
    rows = CursorTable({"path": str(tmp_path), "cursor": "at"}, T.StructType.fromDDL("id long, at long, x long")).rows(CursorRange("9", "999989"))
    before, most, n = pa.total_allocated_bytes(), 0, 0
    for batch in rows:
        most, n = max(most, pa.total_allocated_bytes() - before), n + batch.num_rows
    assert n == 999_980 and most < 12 << 20  # of 24 MB
