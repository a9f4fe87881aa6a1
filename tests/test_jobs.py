"""The jobs end to end: monthly files, event file, replayed lines, all reports."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from tarmac import jobs
from tarmac.schema import EVENTS
from tarmac.settings import DAY_MS, HOUR_MS, Settings
from tarmac.sources.files import read_preagg
from tarmac.sources.lines import stream_lines
from tarmac.streaming.replay import write_replay
from tarmac.streaming.sinks import finish, to_folders
from tarmac.streaming.spans import airport_spans_stream, start_with_rocksdb

MONTHS = EVENTS.fieldNames()[:-1]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    rng = random.Random(11)
    for month in (1, 2, 3, 4):
        rows = []
        for _ in range(400):
            cancelled = rng.random() < 0.05
            delay = "" if cancelled else str(float(rng.choice([-3, 0, 12, 31, 45, 90, 200])))
            rows.append(
                [2025, month, rng.randrange(1, 4), rng.choice(["AA", "DL", "UA", "WN", "OO"]),
                 rng.choice([10397, 11298, 13930]), rng.choice([12266, 14107]),
                 rng.randrange(0, 24) * 100 + rng.randrange(60), delay, "",
                 "1.00" if cancelled else "0.00", "0.00", "", "", "", "", ""]
            )
        text = "\n".join(",".join(map(str, r)) for r in [MONTHS, *rows])
        (root / f"2025_0{month}.csv").write_text(text + "\n")
    jobs.prepare(spark, str(root), f"{root}/events")
    events = spark.read.option("header", True).csv(f"{root}/events")
    events = events.select(
        *[F.col(f.name).cast(f.dataType) for f in EVENTS], F.col("seq").cast("bigint")
    )
    write_replay(events, f"{root}/lines", 3, close=True)
    return root


SETTINGS = Settings(min_flights=2, top_k=2, list_length=5)


def test_events_are_complete_and_ordered(spark, world):
    events = spark.read.option("header", True).csv(f"{world}/events")
    got = events.select(F.col("seq").cast("int"), F.col("event_time").cast("bigint")).orderBy("seq")
    times = [r.event_time for r in got.collect()]
    assert len(times) == 1600 and times == sorted(times)
    assert [r.seq for r in got.collect()] == list(range(1600))


def test_carrier_job_prints_published_lines(spark, world):
    jobs.carriers_by_hour(spark, f"{world}/lines", f"{world}/q1", f"{world}/q1-state")
    lines = spark.read.text(f"{world}/q1")
    pattern = (
        r"^\d{4}-\d\d-\d\d \d\d:00:00,\d{4}-\d\d-\d\d \d\d:00:00,(AA|DL|UA|WN),"
        r"\d+,\d+,\d+,\d+,-?\d+\.\d\d,\d+\.\d\d,\d+\.\d\d$"
    )
    assert lines.count() > 300 and lines.where(~F.col("value").rlike(pattern)).isEmpty()
    flights = lines.select(F.sum(F.split("value", ",")[3].cast("int"))).first()[0]
    events = spark.read.option("header", True).csv(f"{world}/events")
    assert flights == events.where("OP_UNIQUE_CARRIER <> 'OO'").count()


def test_batch_and_streamed_airport_reports_agree(spark, world):
    jobs.airports(spark, f"{world}/events", f"{world}/reports", SETTINGS)
    jobs.preaggregate(
        spark, f"{world}/lines", f"{world}/preagg", f"{world}/preagg-state", SETTINGS, 1
    )
    written = jobs.postprocess(
        spark, f"{world}/preagg", f"{world}/events", f"{world}/post", SETTINGS
    )
    assert written == ["q2_1h_final", "q2_6h_final", "q2_global_final"]
    for span, name in (("1h", "q2_1h_final"), ("6h", "q2_6h_final"), ("global", "q2_global_final")):
        def read(path):
            df = spark.read.option("header", True).csv(path)
            return df.select("num_flights", "severe_delays")

        batch, post = read(f"{world}/reports/span={span}"), read(f"{world}/post/{name}")
        assert batch.count() > (1 if span == "global" else 10)
        assert sorted(batch.collect()) == sorted(post.collect())
    first = spark.read.option("header", True).csv(f"{world}/reports/span=global").first()
    assert first.delayed_flights.startswith("[(") and first.delayed_flights.count("(") == 5


def test_no_report_without_preaggregates(spark, world, tmp_path):
    (tmp_path / "q2_6h").mkdir()
    assert jobs.postprocess(spark, str(tmp_path), f"{world}/events", str(tmp_path / "out")) == []


def test_preaggregate_with_lists(spark, world):
    """The list is an eighth column, which readers of the seven may ignore."""
    jobs.preaggregate(
        spark, f"{world}/lines", f"{world}/listed", f"{world}/listed-state", SETTINGS, lists=True
    )
    jobs.preaggregate(spark, f"{world}/lines", f"{world}/bare", f"{world}/bare-state", SETTINGS)
    for folder in ("q2_1h", "q2_6h", "q2_global"):
        listed, bare = (read_preagg(spark, f"{world}/{root}/{folder}") for root in ("listed", "bare"))
        assert sorted(listed.collect()) == sorted(bare.collect())
    lines = spark.read.option("recursiveFileLookup", True).text(f"{world}/listed/q2_global")
    parts = [row.value.split(",") for row in lines.collect()]
    assert {len(p) for p in parts} == {8} and max(len(p[7].split(";")) for p in parts) == 5
    # 120-day windows count from 1970, so these four months fall into two of them.
    assert len({p[0] for p in parts}) == 2


def test_one_query_reads_the_lines_once(spark, world):
    """Three window lengths take in each line once: one source, as many rows as there are lines."""
    spans = {"1h": HOUR_MS, "6h": 6 * HOUR_MS, "120d": 120 * DAY_MS}
    stream = airport_spans_stream(stream_lines(spark, f"{world}/lines", 1), spans)
    folders = {span: f"{world}/once/{span}" for span in spans}
    query = start_with_rocksdb(spark, lambda: to_folders(stream, "span", folders, f"{world}/once-state"))
    finish(query)
    progress = query.recentProgress
    assert {len(p["sources"]) for p in progress} == {1}
    assert sum(p["numInputRows"] for p in progress) == spark.read.text(f"{world}/lines").count()
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    # No folder for a window length that closed nothing in a micro-batch.
    longest = [b.name for b in pathlib.Path(folders["120d"]).iterdir()]
    assert 0 < len(longest) < len([b for b in pathlib.Path(folders["1h"]).iterdir()])


def test_top_airports_job_ranks_each_window(spark, world):
    jobs.top_airports(spark, f"{world}/lines", f"{world}/top", f"{world}/top-state", "6h", SETTINGS)
    rows = [r.value.split(",") for r in spark.read.option("recursiveFileLookup", True).text(f"{world}/top").collect()]
    batch = spark.read.option("header", True).csv(f"{world}/reports/span=6h")
    want = sorted((r["ts"], r["rank"], r.num_flights, r.severe_delays) for r in batch.collect())
    assert sorted((r[0], r[1], r[3], r[4]) for r in rows) == want


def test_job_resumes_from_its_checkpoint(spark, world):
    """A second run over the same folder finds nothing new."""
    out, state = f"{world}/again", f"{world}/again-state"
    jobs.carriers_by_hour(spark, f"{world}/lines", out, state)
    before = spark.read.text(out).count()
    jobs.carriers_by_hour(spark, f"{world}/lines", out, state)
    assert spark.read.text(out).count() == before
    assert stream_lines(spark, f"{world}/lines").isStreaming
