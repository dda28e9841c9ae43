from datetime import date

from tillroll.plans.calendar import calendar, calendar_for


def test_iso_calendar_2024(spark):
    cal = calendar(spark, "2024-01-01", "2024-12-31", "iso")
    assert cal.count() == 366
    got = {r.date: (r.day_of_week, r.is_weekend, r.week_of_year, r.month_name, r.quarter)
           for r in cal.where("date IN ('2024-01-01', '2024-12-29', '2024-12-31')").collect()}
    assert got == {
        date(2024, 1, 1): ("Mon", False, 1, "January", 1),
        date(2024, 12, 29): ("Sun", True, 52, "December", 4),
        date(2024, 12, 31): ("Tue", False, 1, "December", 4),
    }


def test_strftime_calendar_2024(spark):
    cal = calendar(spark, "2024-01-01", "2024-12-31", "strftime")
    assert cal.count() == 366
    got = {r.calendar_date: (r.year, r.month, r.day, r.weekday, r.week)
           for r in cal.where("calendar_date IN ('2024-01-01', '2024-12-29', '2024-12-31')").collect()}
    assert got == {
        date(2024, 1, 1): (2024, 1, 1, 2, 2),
        date(2024, 12, 29): (2024, 12, 29, 1, 53),
        date(2024, 12, 31): (2024, 12, 31, 3, 54),
    }


def test_calendar_for_covers_the_data_span(spark):
    facts = spark.createDataFrame([(date(2024, 2, 27),), (date(2024, 3, 2),)], "d date")
    cal = calendar_for(facts, "d", "strftime")
    assert [r.calendar_date for r in cal.collect()] == [date(2024, 2, d) for d in (27, 28, 29)] + \
        [date(2024, 3, 1), date(2024, 3, 2)]
