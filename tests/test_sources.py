import pytest
from pyspark.sql import functions as F

from tarmac.plans.airports import airport_report
from tarmac.plans.prepare import prepare_events
from tarmac.schema import EVENTS
from tarmac.session import scratch
from tarmac.sinks.files import (
    write_by_hour,
    write_events,
    write_preagg,
    write_ranking,
    write_rankings,
)
from tarmac.sources.files import read_flights, read_flights_tolerant, read_monthly, read_preagg
from tarmac.sources.lines import (
    END_CARRIER,
    end_line,
    parse_airport_flights,
    parse_carrier_flights,
    parse_events,
    socket_lines,
    to_lines,
)

GOOD = "2025,1,1,AA,11298,13303,1230,20.0,15.0,0.0,0.0,,,,,,1735734600000"


def line(**changes):
    fields = dict(zip(EVENTS.fieldNames(), GOOD.split(",")))
    fields.update(changes)
    return ",".join(fields.values())


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_carrier_lines(spark):
    got = parse_carrier_flights(
        lines(
            spark,
            GOOD,
            line(DEP_DELAY=""),
            line(CANCELLED=""),
            line(CANCELLED="1.0", DIVERTED="1.0"),
            line(CANCELLED="nan"),
            line(ORIGIN_AIRPORT_ID="11298.0"),
            GOOD + ",more,fields",
            GOOD + "\r",
            " " + GOOD,
            # dropped from here on
            line(DEP_DELAY="abc"),
            GOOD.rsplit(",", 1)[0],
            line(event_time="1735734600000.0"),
            line(event_time=""),
            line(OP_UNIQUE_CARRIER="OO"),
            line(OP_UNIQUE_CARRIER=" AA"),
            "",
            ",".join(EVENTS.fieldNames()),
        )
    ).collect()
    assert len(got) == 9
    assert [r.dep_delay for r in got] == [20.0, 0.0] + [20.0] * 7
    assert [(r.cancelled, r.diverted) for r in got][2:5] == [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    assert {r.event_time for r in got} == {1735734600000}
    assert {r.seq for r in got} == {None}


def test_airport_lines(spark):
    got = parse_airport_flights(
        lines(
            spark,
            line(OP_UNIQUE_CARRIER="OO"),
            line(CANCELLED=""),
            GOOD + ",42",
            line(CANCELLED="1.0"),
            line(DIVERTED="1.0"),
            line(ORIGIN_AIRPORT_ID="11298.0"),
            line(DEST_AIRPORT_ID=""),
            line(DEP_DELAY="late"),
        )
    ).collect()
    assert [(r.carrier, r.origin, r.dest) for r in got] == [
        ("OO", 11298, 13303), ("AA", 11298, 13303), ("AA", 11298, 13303)
    ]
    assert [r.seq for r in got] == [None, None, 42]


def test_end_line_is_for_streams_only(spark):
    both = lines(spark, GOOD).unionByName(end_line(spark))
    assert parse_carrier_flights(both).count() == 1
    assert parse_airport_flights(both).count() == 1
    ends = parse_carrier_flights(both, keep_end=True).where(F.col("carrier") == END_CARRIER)
    assert ends.count() == parse_airport_flights(both, keep_end=True).count() - 1 == 1


def test_full_lines_and_back(spark):
    got = parse_events(lines(spark, line(ORIGIN_AIRPORT_ID="11298.0", CRS_DEP_TIME="")))
    row = got.first()
    assert (row.ORIGIN_AIRPORT_ID, row.CRS_DEP_TIME, row.LATE_AIRCRAFT_DELAY) == (11298, 0, 0.0)
    again = parse_events(to_lines(got, seq=None))
    assert again.first() == row


def test_socket_source_has_the_line_schema(spark):
    stream = socket_lines(spark, "localhost", 9)
    assert stream.isStreaming and stream.columns == ["value"]


def write_text(spark, path, *texts):
    lines(spark, *texts).coalesce(1).write.mode("append").text(path)


def month_file(tmp_path, name, columns, *rows):
    (tmp_path / name).write_text("\n".join([",".join(columns), *[",".join(r) for r in rows]]) + "\n")


def test_monthly_files_of_different_layouts(spark, tmp_path):
    names = EVENTS.fieldNames()[:-1]
    first = dict(zip(names, GOOD.split(",")))
    late = {**first, "CRS_DEP_TIME": "2400", "DEP_DELAY": "1.0"}
    early = {**first, "CRS_DEP_TIME": "5", "DEP_DELAY": "2.0"}
    tie = {**first, "CRS_DEP_TIME": "5", "DEP_DELAY": "3.0", "MONTH": "1"}
    month_file(tmp_path, "2025_01.csv", names, late.values(), early.values())
    other = ["EXTRA", *[n for n in reversed(names) if n != "NAS_DELAY"]]
    month_file(tmp_path, "2025_02.csv", other, [{**tie, "EXTRA": "x"}[n] for n in other])
    (tmp_path / "2024_12.csv").write_text("not read\n")
    (tmp_path / "2025_notes.txt").write_text("not read\n")

    events = prepare_events(read_monthly(spark, str(tmp_path))).orderBy("seq").collect()
    assert [(r.seq, r.DEP_DELAY) for r in events] == [(0, 2.0), (1, 3.0), (2, 1.0)]
    assert events[2].event_time - events[0].event_time == (22 * 60 + 55) * 60_000
    assert events[1].NAS_DELAY is None and events[1].ORIGIN_AIRPORT_ID == 11298


def test_no_monthly_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_monthly(spark, str(tmp_path))


def test_folder_header_is_checked_against_every_part(spark, tmp_path):
    names = EVENTS.fieldNames()[:-1]
    row = GOOD.split(",")[:-1]
    month_file(tmp_path, "2025_a.csv", names, row)
    month_file(tmp_path, "2025_b.csv", list(reversed(names)), list(reversed(row)))
    assert read_monthly(spark, str(tmp_path)).count() == 2
    mixed = read_monthly(spark, str(tmp_path), header_per="folder")
    with pytest.raises(Exception, match="header"):
        mixed.collect()


def test_row_order_within_one_long_split(spark, tmp_path):
    """Rows of one minute in a single split are spread over ranges and keep their order."""
    names = EVENTS.fieldNames()[:-1]
    row = dict(zip(names, GOOD.split(",")))
    month_file(
        tmp_path, "2025_01.csv", names,
        *[{**row, "DEP_DELAY": str(float(n))}.values() for n in range(1000)],
    )
    monthly = read_monthly(spark, str(tmp_path))
    got = sorted((r.seq, r.DEP_DELAY) for r in prepare_events(monthly).collect())
    assert got == [(n, float(n)) for n in range(1000)]


def test_row_order_within_split_files(spark, tmp_path):
    """Rows of one minute keep file order even when a file is read in several splits."""
    names = EVENTS.fieldNames()[:-1]
    row = dict(zip(names, GOOD.split(",")))
    rows = [{**row, "DEP_DELAY": str(float(n))}.values() for n in range(3000)]
    month_file(tmp_path, "2025_01.csv", names, *rows[:2000])
    month_file(tmp_path, "2025_02.csv", names, *rows[2000:])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        monthly = read_monthly(spark, str(tmp_path))
        assert monthly.select("src_file", "src_block").distinct().count() > 4
        events = prepare_events(monthly).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.seq, r.DEP_DELAY) for r in events) == [(n, float(n)) for n in range(3000)]


def test_event_file_scans(spark, tmp_path):
    columns = EVENTS.fieldNames()
    bad = line(DEP_DELAY="abc").split(",")
    blank = line(DEP_DELAY="", CANCELLED="").split(",")
    month_file(tmp_path, "events.csv", columns, GOOD.split(","), blank)
    typed = read_flights(spark, str(tmp_path / "events.csv")).orderBy("seq").collect()
    assert [r.dep_delay for r in typed] == [20.0, None] and typed[0].seq < typed[1].seq
    month_file(tmp_path, "events.csv", columns, GOOD.split(","), bad, blank)
    tolerant = read_flights_tolerant(spark, str(tmp_path / "events.csv")).orderBy("seq").collect()
    assert [(r.dep_delay, r.cancelled) for r in tolerant] == [(20.0, 0.0), (0.0, 0.0)]
    assert tolerant[0].seq < tolerant[1].seq


@pytest.mark.parametrize(
    "wrong", [{"DEP_DELAY": "abc"}, {"event_time": "xx"}, {"ORIGIN_AIRPORT_ID": "x"}, {"CANCELLED": "no"}]
)
def test_typed_scan_fails_on_unreadable_numbers(spark, tmp_path, wrong):
    month_file(tmp_path, "events.csv", EVENTS.fieldNames(), GOOD.split(","), line(**wrong).split(","))
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|malformed|Malformed"):
        read_flights(spark, str(tmp_path / "events.csv")).collect()


@pytest.mark.parametrize("wrong", [{"CRS_DEP_TIME": "xx"}, {"DAY_OF_MONTH": "x"}, {"DEP_DELAY": "abc"}])
def test_monthly_scan_fails_on_unreadable_numbers(spark, tmp_path, wrong):
    columns = EVENTS.fieldNames()[:-1]
    month_file(tmp_path, "2025_01.csv", columns, line(**wrong).split(",")[:-1])
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|malformed|Malformed"):
        read_monthly(spark, str(tmp_path)).collect()


def test_nan_and_infinite_delays_are_delays(spark):
    got = parse_carrier_flights(lines(spark, GOOD, line(DEP_DELAY="nan"), line(DEP_DELAY="inf")))
    assert got.count() == 3 and got.where(F.isnan("dep_delay")).count() == 1


def test_event_file_without_places_keeps_its_order(spark, tmp_path):
    """Flights of one minute with equal delays are listed as the file has them."""
    rows = [line(DEP_DELAY="40.0", DEST_AIRPORT_ID=str(n)).split(",") for n in range(500, 0, -1)]
    month_file(tmp_path, "events.csv", EVENTS.fieldNames(), *rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        flights = read_flights(spark, str(tmp_path / "events.csv"))
        report = airport_report(flights, None).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    listed = [item.split(",")[1] for item in report.delayed_flights[2:-2].split("), (")]
    assert listed == [str(n) for n in range(500, 480, -1)]


def test_event_file_is_in_order(spark, tmp_path):
    monthly = [line(event_time=str(t)).split(",") for t in (5, 3, 9, 3)]
    month_file(tmp_path, "in.csv", EVENTS.fieldNames(), *monthly)
    events = spark.read.option("header", True).schema(EVENTS).csv(str(tmp_path / "in.csv"))
    out = str(tmp_path / "out")
    write_events(events.withColumn("seq", F.monotonically_increasing_id()), out)
    parts = sorted((tmp_path / "out").glob("part-*.csv"))
    texts = [t for part in parts for t in part.read_text().splitlines()[1:]]
    assert [t.split(",")[16] for t in texts] == ["3", "3", "5", "9"]


def test_preagg_files(spark):
    root = scratch(spark, "test")
    row = "2025-01-01 08:00:00,2025-01-01 09:00:00,11298,30,2,100.50,60.00"
    write_text(spark, f"{root}/2026-06-30--16", row, "", "too,few", row + ",AA|1|60.00;DL|2|31.00")
    import glob
    import shutil

    part = glob.glob(f"{root.removeprefix('file:')}/*/part-*.txt")[0]
    shutil.copy(part, part.replace(".txt", ".csv"))
    shutil.copy(part, part.replace(".txt", ".inprogress.csv"))
    got = read_preagg(spark, root).collect()
    assert len(got) == 2 and got[0] == got[1]
    assert tuple(got[0])[2:] == (11298, 30, 2, 100.5, 60.0)
    again = scratch(spark, "test")
    lists = read_preagg(spark, root).withColumn("top_str", F.lit(""))
    write_preagg(lists, again)
    assert {r.value for r in spark.read.text(again).collect()} == {row + ","}
    assert read_preagg(spark, again).collect() == got


def test_report_files(spark, tmp_path):
    report = spark.createDataFrame(
        [("2025-01-01 01:00:00", 1, 2.675, 31.0, "[(AA,1,31.00), (DL,2,31.00)]"),
         ("2025-01-01 00:00:00", 2, 0.0, 0.0, "[]"),
         ("2025-01-01 00:00:00", 1, 0.125, 40.0, "[(AA,1,40.00)]")],
        "ts string, rank int, dep_delay_mean double, dep_delay_max double, delayed_flights string",
    )
    write_ranking(report, str(tmp_path / "r"), single_file=True)
    (part,) = (tmp_path / "r").glob("part-*.csv")
    assert part.read_text().splitlines() == [
        "ts,rank,dep_delay_mean,dep_delay_max,delayed_flights",
        '2025-01-01 00:00:00,1,0.12,40.00,"[(AA,1,40.00)]"',
        "2025-01-01 00:00:00,2,0.00,0.00,[]",
        '2025-01-01 01:00:00,1,2.67,31.00,"[(AA,1,31.00), (DL,2,31.00)]"',
    ]


def test_reports_of_several_windows(spark, tmp_path):
    reports = spark.createDataFrame(
        [("6h", "2025-01-01 00:00:00", 1, 2.675, 31.0, "[(AA,1,31.00), (DL,2,31.00)]"),
         ("1h", "2025-01-01 01:00:00", 1, 0.0, 0.0, "[]"),
         ("1h", "2025-01-01 00:00:00", 1, 0.125, 40.0, "[(AA,1,40.00)]")],
        "span string, ts string, rank int, dep_delay_mean double, dep_delay_max double, "
        "delayed_flights string",
    )
    write_rankings(reports, str(tmp_path / "r"))
    header = "ts,rank,dep_delay_mean,dep_delay_max,delayed_flights"

    def rows(span):
        parts = sorted((tmp_path / "r" / f"span={span}").glob("part-*.csv"))
        texts = [part.read_text().splitlines() for part in parts]
        assert {t[0] for t in texts} == {header}
        return [row for t in texts for row in t[1:]]

    assert rows("6h") == ['2025-01-01 00:00:00,1,2.67,31.00,"[(AA,1,31.00), (DL,2,31.00)]"']
    assert rows("1h") == [
        '2025-01-01 00:00:00,1,0.12,40.00,"[(AA,1,40.00)]"',
        '2025-01-01 01:00:00,1,0.00,0.00,"[]"',
    ]
    back = spark.read.option("header", True).csv(str(tmp_path / "r"))
    assert {r.delayed_flights for r in back.collect()} == {
        "[]", "[(AA,1,40.00)]", "[(AA,1,31.00), (DL,2,31.00)]"
    }


def test_folders_by_processing_hour(spark, tmp_path):
    write_by_hour(spark.range(3), str(tmp_path / "out"))
    (folder,) = (tmp_path / "out").glob("proc_hour=*")
    assert len(folder.name) == len("proc_hour=2026-06-30--16")
