"""Streams over replayed files give the batch result."""

from conftest import same_rows, ts
from pyspark.sql import functions as F

from checks import base
from checks.streams import land
from tidemark.operators import daily
from tidemark.session import shared_folder
from tidemark.specs import SPECS
from tidemark.sources import tables
from tidemark.streaming import corrections, jobs

SF = "/root/testdata/sf0.001"
PRICE = SPECS["dispatchprice"]
KEY = list(PRICE.key)


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes])


def test_running_outcome_equals_batch_however_often_it_is_restarted(spark):
    root = shared_folder(spark, "daily")
    final = base.price_final(spark, SF).select("regionid", "settlementdate", "rrp", "trading_day")
    rows = final.drop("trading_day")
    cut = F.col("settlementdate") < F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (rows.where(cut), rows.where(~cut)):
        part.write.mode("append").parquet(f"{root}/landing")
        stream = jobs.landed(spark, f"{root}/landing", rows.schema)
        jobs.finish(jobs.stream_daily_outcome(stream, f"{root}/out", f"{root}/cp"))
    got = jobs.latest(spark.read.parquet(f"{root}/out"), ["regionid", "trading_day"])
    same_rows(rounded(got), rounded(daily.daily_outcome(final, expected=1, exact=False)))


def test_late_rows_are_dropped_then_recovered(spark):
    root = shared_folder(spark, "late")
    p = base.a_price(spark, SF).select("event_id", *KEY)
    t = F.col("settlementdate")
    late = (t < F.lit("2024-01-06").cast("timestamp_ntz")) & (F.col("event_id") % 2 == 0)
    land(p.where(~late), f"{root}/landing", "settlementdate")
    stream = jobs.landed(spark, f"{root}/landing", p.schema, 1)
    jobs.finish(jobs.stream_dedup(stream, KEY, "settlementdate", f"{root}/t", f"{root}/cp"))
    p.where(late).write.mode("append").parquet(f"{root}/landing")
    jobs.finish(jobs.stream_dedup(jobs.landed(spark, f"{root}/landing", p.schema, 1), KEY, "settlementdate",
                                  f"{root}/t", f"{root}/cp"))
    stored = spark.read.schema(p.schema).parquet(f"{root}/t")
    lost = jobs.late_rows(p, stored, KEY, [F.col("event_id")])
    assert lost.count() > 0
    same_rows(stored.unionByName(lost).select(*KEY), p.select(*KEY).distinct())


def test_a_repeated_batch_adds_nothing(spark):
    root = shared_folder(spark, "twice")
    p = base.a_price(spark, SF).select("event_id", *KEY, "rrp", "known_at", "source_file")
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint replays everything
        p.write.mode("overwrite").parquet(f"{root}/landing")
        stream = jobs.landed(spark, f"{root}/landing", p.schema)
        jobs.finish(jobs.stream_merge(stream, f"{root}/t", PRICE, f"{root}/{checkpoint}", [F.col("event_id")]))
    assert spark.read.parquet(f"{root}/t").count() == p.select(*KEY).distinct().count()


# ------------------------------------------------------------------ corrections and compaction

COUNT = "day date, n_rows bigint"


def write_version(spark, root, batch, rows):
    corrections._write(spark.createDataFrame(rows, COUNT), f"{root}/batch_id={batch}")


def test_folders_stay_few_after_a_hundred_batches():
    """The plan alone: every batch adds a folder, every merge hides the folders it covers."""
    parts, written = [], 0
    for batch in range(1000):
        parts.append((batch, batch))
        while chosen := corrections.plan(parts):
            written += sum(b - a + 1 for a, b in chosen)
            parts = parts[:-len(chosen)] + [(chosen[0][0], chosen[-1][1])]
        assert len(parts) <= 10 * len(str(batch + 1))
        assert [p[0] for p in parts[1:]] == [p[1] + 1 for p in parts[:-1]]
    assert written <= 3 * 1000  # a batch is rewritten once for every power of ten


def test_a_merge_keeps_the_newest_version_and_old_readers_their_files(spark):
    import datetime as dt
    root = shared_folder(spark, "compact")
    day = dt.date(2024, 1, 1)
    schema = spark.createDataFrame([], COUNT).schema
    for batch in range(3):
        write_version(spark, root, batch, [(day, batch), (day + dt.timedelta(batch), 100 + batch)] if batch else [(day, 0)])
    before = corrections.versions(spark, root, schema)
    want = {day: 2, day + dt.timedelta(1): 101, day + dt.timedelta(2): 102}
    assert {r.day: r.n_rows for r in corrections.latest(spark, root, schema, ["day"]).collect()} == want
    assert corrections.compact(spark, root, schema, ["day"], whole=True) == 1
    assert list(corrections.current(spark, root)) == [(0, 2)]
    assert before.count() == 5  # its folders are still there
    assert {r.day: r.n_rows for r in corrections.latest(spark, root, schema, ["day"]).collect()} == want
    write_version(spark, root, 3, [(day, 9)])
    write_version(spark, root, 2, [(day, 2), (day + dt.timedelta(2), 102)])  # a replay of a merged batch
    assert corrections.compact(spark, root, schema, ["day"], whole=True) == 1
    assert {r.day: r.n_rows for r in corrections.latest(spark, root, schema, ["day"]).collect()} == {**want, day: 9}
    assert "batch_id=0" not in tables.children(spark, root)  # dropped one merge later


def test_an_unfinished_merge_is_not_seen(spark):
    import datetime as dt
    root = shared_folder(spark, "unfinished")
    schema = spark.createDataFrame([], COUNT).schema
    for batch in range(2):
        write_version(spark, root, batch, [(dt.date(2024, 1, 1), batch)])
    corrections._write(spark.createDataFrame([(dt.date(2024, 1, 1), 77, 1)], COUNT + ", _version bigint"), f"{root}/span=0-1")
    tables.drop(spark, f"{root}/span=0-1/_SUCCESS")
    assert corrections.latest(spark, root, schema, ["day"]).first().n_rows == 1
    assert corrections.latest(spark, f"{root}/none", schema, ["day"]).count() == 0


def test_corrections_follow_rows_older_than_any_watermark(spark):
    """A day is published again, with null and repeated rows, each time rows of it arrive; a lost checkpoint changes nothing."""
    root = shared_folder(spark, "corrected")
    schema = "region string, ts timestamp_ntz, rrp double"

    def result(rows):
        return rows.groupBy("region", F.to_date("ts").alias("day")).agg(F.max("rrp").alias("high"), F.count("*").alias("n"))

    keys = {"region": F.col("region"), "day": F.to_date("ts")}
    parts = [[("A", "2024-03-01 10:00:00", 5.0), ("B", "2024-03-01 10:00:00", None)], [("A", "2024-05-01 00:00:00", 1.0)],
             [("A", "2023-01-01 00:00:00", 2.0), ("A", "2024-03-01 11:00:00", 9.0), (None, None, 3.0)], [("A", "2024-03-01 11:00:00", 9.0)]]

    def frame(rows):
        return spark.createDataFrame([(a, None if t is None else ts(t), r) for a, t, r in rows], schema)

    def run(checkpoint):
        stream = jobs.landed(spark, f"{root}/landing", frame([]).schema, 1)
        jobs.finish(corrections.corrected(stream, keys, F.to_date("ts"), result, f"{root}/out", f"{root}/{checkpoint}", fan_in=2))

    for part in parts:
        frame(part).coalesce(1).write.mode("append").parquet(f"{root}/landing")
        run("cp")
    whole = result(frame([r for part in parts for r in part]))
    same_rows(corrections.latest(spark, f"{root}/out", whole.schema, ["region", "day"]), whole)


def test_archives_land_as_files_and_are_taken_once(spark):
    import io
    import zipfile
    root = shared_folder(spark, "zips")
    head = "I,DISPATCH,PRICE,5,SETTLEMENTDATE,RUNNO,REGIONID,INTERVENTION,RRP"
    system, folder = tables._place(spark, f"{root}/landing")
    for k in range(3):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(f"PUBLIC_X_20240801000{k}_2024080100031{k}.CSV", f'{head}\nD,DISPATCH,PRICE,5,"2024/08/01 00:0{k}:00",1,NSW1,0,{k}')
        stream = system.create(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/landing/PUBLIC_X_20240801000{k}_1.zip"))
        stream.write(bytearray(out.getvalue()))
        stream.close()
        jobs.finish(jobs.stream_ingest(jobs.landed_archives(spark, f"{root}/landing"), f"{root}/t", PRICE, f"{root}/cp"))
    assert sorted(r.rrp for r in spark.read.parquet(f"{root}/t").collect()) == [0.0, 1.0, 2.0]


def test_landings_work_their_rows_out_once(spark):
    """A landing reads stored rows; an expensive input is not computed again for each of the three."""
    root, seen = shared_folder(spark, "once"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    p = base.a_price(spark, SF).select("event_id", "settlementdate")
    land(p.mapInArrow(count, p.schema), f"{root}/landing", "settlementdate")
    assert seen.value == p.count() == spark.read.parquet(f"{root}/landing").count()


def test_files_of_a_landing_are_one_batch(spark, monkeypatch):
    """However many files a landing has, none is late for another, and the stream runs a bounded number of batches."""
    from checks import streams
    from checks.base import QUERIES
    one = streams.once
    monkeypatch.setattr(streams, "once", lambda df, folder: one(df, folder).repartition(9))
    out = QUERIES["stream_late_dedup"](spark, SF).groupBy("how").count().collect()
    late = base.a_price(spark, SF).groupBy(*KEY).agg(F.bool_and(
        (F.col("settlementdate") < F.lit("2024-01-06").cast("timestamp_ntz")) & (F.col("event_id") % 10 == 0)).alias("late"))
    assert dict(map(tuple, out)) == {("recovered" if r.late else "kept"): r["count"] for r in late.groupBy("late").count().collect()}
