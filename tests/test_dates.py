from datetime import date

import pytest
from pyspark.sql import functions as F

from tipoff.functions import dates
from tipoff.plans import calendar, silver


def column(df, name="date"):
    return [r[name] for r in df.collect()]


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_api_date_format(spark):
    assert one(spark, dates.api_date(dates.iso_date(F.lit("2019-12-30")))) == "20191230"


def test_single_digit_parts_are_accepted_and_other_forms_are_null(spark):
    assert one(spark, dates.iso_date(F.lit("1997-5-04"))) == date(1997, 5, 4)
    for bad in ("30.12.2019", "2019-11-31", "", "20191230"):
        assert one(spark, dates.iso_date(F.lit(bad))) is None


def test_malformed_scalar_date_is_an_error():
    with pytest.raises(ValueError, match="not a date"):
        dates.parse_date("30.12.2019")


def test_range_is_inclusive_on_both_ends(spark):
    days = calendar.date_range(spark, "2019-12-30", "2020-01-01")
    assert column(days) == [date(2019, 12, 30), date(2019, 12, 31), date(2020, 1, 1)]


def test_reversed_range_is_an_error(spark):
    with pytest.raises(ValueError, match="2020-01-01 .* after 2019-12-30"):
        calendar.date_range(spark, "2020-01-01", "2019-12-30")


def test_season_window():
    assert dates.season_window("2014-15") == (date(2014, 11, 1), date(2015, 4, 30))


def test_season_across_the_century_ends_the_next_year():
    assert dates.season_window("1999-00") == (date(1999, 11, 1), date(2000, 4, 30))
    assert dates.season_window("1998-99")[1] == date(1999, 4, 30)


@pytest.mark.parametrize("bad", ["2014", "2014-16", "2014_15", " 2014-15", None, "fall 2014"])
def test_malformed_season_is_an_error(bad):
    with pytest.raises(ValueError, match="not a season"):
        dates.season_window(bad)


def test_yesterday_and_today_follow_the_reference_day():
    assert dates.yesterday("2019-12-30") == date(2019, 12, 29)
    assert dates.today("2019-12-30") == date(2019, 12, 30)


@pytest.mark.parametrize(
    "args, first, last, count",
    [
        ({"day": "2019-12-30", "start": "2011-02-01", "end": "2011-02-02"}, "2019-12-30", "2019-12-30", 1),
        ({"start": "2019-12-30", "end": "2020-01-01", "today": True}, "2019-12-30", "2020-01-01", 3),
        ({"seasons": ["2014-15"], "yesterday": True}, "2014-11-01", "2015-04-30", 181),
        ({"seasons": ["2014-15", "2014-15", "2013-14"]}, "2013-11-01", "2015-04-30", 362),
        ({"yesterday": True, "today": True}, "2019-12-29", "2019-12-29", 1),
        ({"today": True, "year": 2020}, "2019-12-30", "2019-12-30", 1),
        ({"year": 2020, "history_start": "1997-5-04"}, "2020-01-01", "2020-12-31", 366),
        ({"history_start": "2019-12-9"}, "2019-12-09", "2019-12-29", 21),
    ],
)
def test_date_selection_precedence(spark, args, first, last, count):
    days = column(calendar.select_dates(spark, as_of="2019-12-30", **args))
    assert (str(days[0]), str(days[-1]), len(days)) == (first, last, count)
    assert days == sorted(set(days))


def test_no_selector_is_an_error(spark):
    with pytest.raises(ValueError, match="selects no dates"):
        calendar.select_dates(spark)


def test_processed_dates_are_skipped_unless_forced(spark):
    requested = calendar.date_range(spark, "2019-12-30", "2020-01-01")
    processed = calendar.date_range(spark, "2019-12-30", "2019-12-30")
    assert [str(d) for d in sorted(column(calendar.pending_dates(requested, processed)))] == ["2019-12-31", "2020-01-01"]
    assert calendar.pending_dates(requested, processed, force=True).count() == 3


def test_days_between_seasons_have_no_season(spark):
    days = spark.createDataFrame(
        [(date(2022, 11, 1),), (date(2023, 4, 30),), (date(2023, 5, 1),), (date(2023, 10, 31),)], "date date"
    )
    placed = calendar.with_season(days, silver.seasons_of(days))
    assert {str(r.date): r.season_id for r in placed.collect()} == {
        "2022-11-01": "2022-23",
        "2023-04-30": "2022-23",
        "2023-05-01": None,
        "2023-10-31": None,
    }


def test_manifest_fills_templates_and_lists_unknown_endpoints(spark):
    endpoints = spark.createDataFrame(
        [("scoreboard", "scoreboard"), ("team_detail", "/teams/{team_id}")], "endpoint string, path string"
    )
    requests = spark.createDataFrame(
        [("scoreboard", date(2019, 12, 30), None), ("team_detail", date(2019, 12, 30), "150"), ("odds", None, None)],
        "endpoint string, date date, team_id string",
    )
    rows = {r.endpoint: r for r in calendar.request_manifest(requests, endpoints, "https://x.example.org").collect()}
    assert rows["scoreboard"].source_url == "https://x.example.org/scoreboard"
    assert rows["scoreboard"].parameters == '{"dates":"20191230","groups":"50","limit":200}'
    assert rows["team_detail"].source_url == "https://x.example.org/teams/150"
    assert column(calendar.unknown_endpoints(requests, endpoints), "endpoint") == ["odds"]
