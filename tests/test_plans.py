"""What the physical plans must and must not hold."""

import re

import pytest

from tarmac import jobs
from tarmac.operators import ordering
from tarmac.operators.airports import airport_stats, rank_airports, stats_for_spans, with_bounds
from tarmac.operators.carriers import hourly_carrier_stats
from tarmac.operators.flights import flown
from tarmac.plans.airports import airport_preagg, airport_report, airport_reports, severe_flights
from tarmac.plans.postprocess import reports_from_preagg
from tarmac.schema import EVENTS
from tarmac.session import scratch, settle, stored
from tarmac.settings import HOUR_MS, Settings
from tarmac.sinks.files import write_event_table
from tarmac.sources.files import read_event_table, read_flights
from tarmac.sources.lines import parse_airport_flights, parse_carrier_flights, read_lines, to_lines
from tarmac.sources.tables import table_monthly


@pytest.fixture(scope="module")
def table(spark, flights):
    path = scratch(spark, "table")
    write_event_table(table_monthly(flights), path)
    return read_event_table(spark, path)


def plan_of(frame) -> str:
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else filters are cut off
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(plan: str) -> set:
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)))


def test_carrier_report_reads_its_columns_and_filters_in_the_scan(table):
    plan = plan_of(hourly_carrier_stats(table))
    assert "In(OP_UNIQUE_CARRIER, [AA,DL,UA,WN])" in plan
    assert read_columns(plan) == {
        "OP_UNIQUE_CARRIER", "DEP_DELAY", "CANCELLED", "DIVERTED", "event_time"
    }
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_severe_flights_filter_in_the_scan(table):
    plan = plan_of(severe_flights(table))
    assert "GreaterThan(DEP_DELAY,30.0)" in plan
    assert "Or(IsNull(CANCELLED),LessThan(CANCELLED,1.0))" in plan


@pytest.mark.parametrize("step", [HOUR_MS, None])
def test_airport_statistics_use_hash_aggregates(table, step):
    plan = plan_of(rank_airports(airport_stats(flown(table), step)))
    assert "SortAggregate" not in plan and "partial_count" in plan
    assert plan.count("Scan parquet") == 1


def test_statistics_of_all_windows_scan_once(table):
    stats = stats_for_spans(flown(table), {"1h": HOUR_MS, "6h": 6 * HOUR_MS, "global": None})
    plan = plan_of(rank_airports(stats, window=("span", "slot")))
    assert plan.count("Scan parquet") == 1 and "SortAggregate" not in plan


def test_rank_limit_goes_below_the_shuffle_and_bounds_after_it(spark, table):
    """Of an airport's window rows, the whole dataset's too, only possible winners are shuffled."""
    spans = {"1h": HOUR_MS, "global": None}
    stats = settle(stats_for_spans(flown(table), spans))
    plan = plan_of(with_bounds(rank_airports(stats, window=("span", "slot")), stats, spans))
    limits = re.search(r"WindowGroupLimit[^\n]*Final.*?Exchange hashpartitioning\(span.*?WindowGroupLimit[^\n]*Partial", plan, re.S)
    assert limits and "SinglePartition" not in plan


def test_event_order_takes_one_shuffle(spark, flights, monkeypatch):
    plans = []

    def looked_at(frame, label):
        plans.append(plan_of(frame))
        return stored(frame, label)

    monkeypatch.setattr(ordering, "stored", looked_at)
    result = ordering.with_position(flights.drop("seq"), ["event_time", "origin", "dest"])
    assert len(plans) == 1 and plans[0].count("Exchange rangepartitioning") == plans[0].count("Exchange") == 1
    assert "Exchange" not in plan_of(result) and "Join" not in plan_of(result)


def test_reports_from_preaggregates_read_the_events_once(spark, table):
    settings = Settings(min_flights=2)
    preaggs = {size: settle(airport_preagg(table, step)) for size, step in (("1h", HOUR_MS), ("6h", 6 * HOUR_MS))}
    sources = {"1h": (preaggs["1h"], False, settings), "6h": (preaggs["6h"], False, settings), "all": (preaggs["1h"], True, settings)}
    plan = plan_of(reports_from_preagg(sources, table, settings))
    assert plan.count("Scan parquet") == 1


def test_plain_event_files_are_read_without_a_job(spark, flights, tmp_path):
    path = str(tmp_path / "plain")
    events = table_monthly(flights)
    events.select(*EVENTS.fieldNames()).write.option("header", True).csv(path)
    plan = plan_of(read_flights(spark, path))
    assert plan.count("Scan csv") == 1 and "Exchange" not in plan and "parquet" not in plan


def test_reports_run_without_python_or_cross_joins(table):
    for report in (
        airport_report(table, HOUR_MS, Settings(min_flights=2)),
        airport_reports(table, {"1h": HOUR_MS, "global": None}, Settings(min_flights=2)),
    ):
        plan = plan_of(report)
        for word in ("Python", "Arrow", "Cartesian", "NestedLoop"):
            assert word not in plan


@pytest.mark.parametrize("parse", [parse_carrier_flights, parse_airport_flights])
def test_lines_are_split_once(spark, flights, parse):
    path = scratch(spark, "lines")
    to_lines(table_monthly(flights)).write.text(path)
    assert plan_of(parse(read_lines(spark, path))).count("split(") == 1


def test_longer_windows_must_be_multiples(flights):
    with pytest.raises(ValueError):
        stats_for_spans(flown(flights), {"2h": 2 * HOUR_MS, "3h": 3 * HOUR_MS})


def test_airports_job_reads_tables_too(spark, flights, tmp_path):
    path = scratch(spark, "table")
    write_event_table(table_monthly(flights), path)
    jobs.airports(spark, path, str(tmp_path / "out"), Settings(min_flights=2), table=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() > 50
