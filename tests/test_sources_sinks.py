"""Readers and writers. Topics and databases are out of reach here, so for those the options,
the encoding and the statements are tested; files and memory stand in for the rest."""

import json

from pyspark.sql import functions as F

from meterline.sources import jdbc, topics
from meterline.sources.specs import RESULTS, RIDES, TableSpec
from meterline.streaming import jobs, sinks
from tests.streams import ms, ride, rows_of, run, write_batches

PAIR = TableSpec("pair", "k INT, v STRING, n BIGINT", topic="pairs", key=("k",))


def test_topic_options():
    assert topics.kafka_options(RIDES, "broker:9092", topics.LATEST, 1000, 64) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "rides",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    assert topics.kafka_options(PAIR, "b")["subscribe"] == "pairs"  # the name is not the topic
    assert json.loads(topics.offsets("t", {1: 5, 0: -2})) == {"t": {"0": -2, "1": 5}}


def test_records_are_decoded_with_event_time_and_position(spark):
    records = spark.createDataFrame(
        [(json.dumps(ride(1.5)).encode(), 3, 17)], "value BINARY, partition INT, offset LONG"
    )
    row = topics.decode(RIDES, records, ("partition", "offset")).first()
    assert (row["driver_id"], row["partition"], row["offset"]) == (1, 3, 17)
    assert row["tpep_pickup_datetime"] == ms(1.5)


def test_records_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6)], PAIR.schema)
    appended = [json.loads(r["value"]) for r in sinks.append_records(df).collect()]
    assert appended == [{"k": 1, "v": "a", "n": 5}, {"k": 2, "n": 6}]
    upserts = sinks.upsert_records(df, ["k"]).collect()
    assert [r["key"] for r in upserts] == ['{"k":1}', '{"k":2}']
    decoded = topics.decode(PAIR, sinks.append_records(df))
    assert decoded.select(*PAIR.schema.names).collect() == df.collect()


def test_changelog_is_a_keyed_table_and_replays_are_harmless(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.create_if_missing(spark, PAIR, path)
    sinks.create_if_missing(spark, PAIR, path)
    assert sinks.current_rows(spark, path, PAIR.schema, PAIR.key).count() == 0
    write = sinks.changelog(path, PAIR.key, ["n"])
    first = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1)], PAIR.schema)
    second = spark.createDataFrame([(2, "y", 1)], PAIR.schema)
    for batch, batch_id in ((first, 0), (second, 1), (second, 1)):
        write(batch, batch_id)
    current = [(1, "new", 2), (2, "y", 1)]
    assert rows_of(sinks.current_rows(spark, path, PAIR.schema, PAIR.key)) == current
    assert sinks.read_changelog(spark, path, PAIR.schema).count() == 3
    sinks.create_if_missing(spark, PAIR, path)
    assert rows_of(sinks.current_rows(spark, path, PAIR.schema, PAIR.key)) == current

    into = str(tmp_path / "compacted")
    sinks.compact(spark, path, PAIR.schema, PAIR.key, 1, into)
    sinks.changelog(into)(spark.createDataFrame([(1, "newest", 3)], PAIR.schema), 2)
    assert rows_of(sinks.current_rows(spark, into, PAIR.schema, PAIR.key)) == [
        (1, "newest", 3), (2, "y", 1),
    ]
    assert sinks.read_changelog(spark, into, PAIR.schema).count() == 3


def test_files_per_batch(spark, tmp_path):
    rows = spark.range(100).repartition(8).selectExpr("cast(id as int) k", "'v' v", "id n")
    sinks.changelog(str(tmp_path / "many"))(rows, 0)
    sinks.changelog(str(tmp_path / "few"), files=2)(rows, 0)
    assert len(list((tmp_path / "many").glob("run=*/batch_id=0/*.parquet"))) == 8
    assert len(list((tmp_path / "few").glob("run=*/batch_id=0/*.parquet"))) == 2


def test_batch_counts(spark, tmp_path):
    write = sinks.batch_counts(str(tmp_path), ["v"])
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], PAIR.schema)
    for batch_id in (0, 1, 1):
        write(df, batch_id)
    assert rows_of(sinks.total_counts(spark, str(tmp_path), "v STRING")) == [("a", 4), ("b", 2)]


def test_statements(spark):
    assert jdbc.create_table(PAIR) == (
        'CREATE TABLE IF NOT EXISTS "pair" ("k" INTEGER, "v" TEXT, "n" BIGINT, '
        'PRIMARY KEY ("k"))'
    )
    assert jdbc.upsert_from(PAIR, "stage") == (
        'INSERT INTO "pair" ("k", "v", "n") SELECT "k", "v", "n" FROM "stage" '
        'ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v", "n" = EXCLUDED."n"'
    )
    assert jdbc.insert_absent_from(PAIR, "stage").endswith('ON CONFLICT ("k") DO NOTHING')
    only_key = TableSpec("seen", "k INT", key=("k",))
    assert jdbc.upsert_from(only_key, "s").endswith("DO NOTHING")
    for spec in RESULTS.values():
        assert jdbc.create_table(spec).count("PRIMARY KEY") == bool(spec.key)


def test_dimension_is_read_again_after_its_ttl(spark):
    now, reads = [0.0], []

    def load():
        reads.append(now[0])
        return spark.createDataFrame([(1, f"read {len(reads)}")], "zone_id INT, zone_name STRING")

    dimension = jdbc.JdbcDimension(
        spark, PAIR, {}, ttl_seconds=3600, clock=lambda: now[0], load=load
    )
    for moment, expected in ((0.0, "read 1"), (3599.0, "read 1"), (3600.0, "read 2")):
        now[0] = moment
        assert dimension.current().first()["zone_name"] == expected
    assert reads == [0.0, 3600.0]


def test_console_and_memory_and_catalog(spark, tmp_path, capfd):
    folder = write_batches(tmp_path / "in", [ride(0)], [ride(1)])
    source = lambda: topics.read_files(spark, RIDES, folder).select("driver_id", "total_amount")
    run(sinks.to_memory(source(), "peeked"), tmp_path / "cp1")
    assert spark.table("peeked").count() == 2
    assert "peeked" in sinks.list_tables(spark)
    run(sinks.to_console(source()), tmp_path / "cp2")
    spark.catalog.dropTempView("peeked")


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(
        [tuple(ride(0)[c] for c in RIDES.schema.names)], RIDES.schema
    ).write.parquet(path)
    stream = topics.read_files(spark, RIDES, path, "parquet")
    run(sinks.to_memory(stream, "from_parquet"), tmp_path / "cp")
    assert spark.table("from_parquet").count() == 1


def test_late_rows_dropped_by_default_are_counted(spark, tmp_path):
    batches = [[ride(0)], [ride(1000)], [ride(2000)], [ride(1)], [ride(2)]]
    rides = topics.read_files(spark, RIDES, write_batches(tmp_path / "in", *batches))
    from meterline.operators.windows import tumbling_revenue

    out = str(tmp_path / "out")
    job = jobs.Output("dropping", tumbling_revenue(rides), sinks.changelog(out), "append")
    query = jobs.start(job, str(tmp_path / "cp"), once=True)
    jobs.await_all([query], 120)
    assert jobs.dropped_as_late(query) == 2
    first = spark.read.parquet(out).where(F.col("window_start") < F.lit("2024-01-01 12:01:00"))
    assert rows_of(first, "trip_count") == [(1,)]


def test_peek_reads_a_topic_that_ends_now(spark, monkeypatch):
    """The options given to the reader; no connector is installed here."""
    from pyspark.sql.readwriter import DataFrameReader

    from meterline.sources import topics
    from meterline.sources.specs import RIDES

    given = {}
    records = spark.createDataFrame([('{"PULocationID": 3}',)] * 20, "value STRING")
    monkeypatch.setattr(DataFrameReader, "format", lambda self, name: self)
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: given.update(o) or self)
    monkeypatch.setattr(DataFrameReader, "load", lambda self: records)
    assert topics.peek_topic(spark, RIDES, "b:9092", 7).count() == 7
    assert given["endingOffsets"] == "latest" and given["startingOffsets"] == "earliest"


def test_zero_delay_drops_what_is_older_than_the_newest(spark, tmp_path):
    """An ordered source needs no delay; then any older row is late."""
    from dataclasses import replace

    from meterline.operators import windows
    from meterline.sources.specs import RIDES
    from meterline.sources.topics import read_files
    from meterline.streaming.sinks import to_memory
    from tests.streams import ride, rows_of, run, write_batches

    strict = replace(RIDES, delay="0 seconds")
    folder = write_batches(tmp_path / "in", [ride(0), ride(61)], [ride(62)],
                           [ride(59), ride(63)], [ride(200)], [ride(201)])
    counts = windows.tumbling_revenue(read_files(spark, strict, folder), "1 minute")
    run(to_memory(counts, "strict"), tmp_path / "cp")
    assert rows_of(spark.table("strict"), "trip_count") == [(1,), (3,)]
