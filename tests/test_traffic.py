from __future__ import annotations

import pytest

from footfall.operators import traffic
from footfall.sources.dims import courses
from tests.helpers import lines, rows

GOOD = "10.0.0.1\t2024-01-05 10:11:12\t\"GET /class/112.html HTTP/1.1\"\t-\t200"


def line(path="class/112.html", referer="-", time="2024-01-05 10:11:12", status="200"):
    return f'10.0.0.1\t{time}\t"GET /{path} HTTP/1.1"\t{referer}\t{status}'


def test_parse(spark):
    source = lines(
        spark, line(), line("class/130.html", status="404"), line("course/list"), line("learn/821"),
        line("class/0.html"), line("class/abc.html"), line("class/"), line("class/12"),
        line(status="x"), line(time="yesterday"), line(time="2024-01-05"), "too\tshort",
        line("classes/7.a.html"), line("class/8.html/more"),
    )
    got = rows(traffic.render_clicks(traffic.parse_access_log(source)))
    assert got == [
        ("10.0.0.1", "20240105101112", 112, 200, "-"),
        ("10.0.0.1", "20240105101112", 130, 404, "-"),
        ("10.0.0.1", "20240105101112", 8, 200, "-"),
    ]
    assert traffic.count_access_lines(source).first() == (14, 8)


@pytest.mark.parametrize("referer, host", [
    ("https://www.baidu.com/s?wd=Spark SQL Action", "www.baidu.com"),
    ("http://a.b/c/d/", "a.b"),
    ("https://cn.bing.com/", None),
    ("https://cn.bing.com", None),
    ("https://cn.bing.com//", None),
    ("-", None),
    ("", None),
    ("a/b/c", "b"),
])
def test_referer_host(spark, referer, host):
    clicks = traffic.parse_access_log(lines(spark, line(referer=referer)))
    got = [r["host"] for r in traffic.with_search_host(clicks).collect()]
    assert got == ([host] if host else [])


@pytest.fixture(scope="module")
def clicks(spark):
    x, y = "https://x.com/s", "https://y.com/s"
    return traffic.parse_access_log(lines(
        spark, line(referer=x), line(referer=x), line(referer=y), line("class/999.html", x),
        line("class/128.html"), line("class/128.html", x, "2024-01-06 00:00:00"),
    ))


def test_counts(clicks):
    assert rows(traffic.course_daily(clicks)) == [
        ("20240105", 112, 3), ("20240105", 128, 1), ("20240105", 999, 1), ("20240106", 128, 1)
    ]
    assert rows(traffic.course_search_daily(clicks)) == [
        ("20240105", "x.com", 112, 2), ("20240105", "x.com", 999, 1), ("20240105", "y.com", 112, 1),
        ("20240106", "x.com", 128, 1),
    ]


def test_day_scan(clicks):
    assert rows(traffic.day_scan(traffic.course_daily(clicks), "20240105")) == [
        ("20240105_112", 3), ("20240105_128", 1), ("20240105_999", 1)
    ]
    searches = traffic.course_search_daily(clicks)
    assert rows(traffic.day_scan(searches, "20240106", traffic.SEARCH_KEYS)) == [
        ("20240106_x.com_128", 1)
    ]


def test_reports(spark, clicks):
    daily, searches = traffic.course_daily(clicks), traffic.course_search_daily(clicks)
    assert rows(traffic.course_report(daily, courses(spark), "20240105"), "name", "click_count") == [
        (None, 1), ("spark in action", 3), ("spark streaming", 1)
    ]
    report = traffic.course_search_report(searches, courses(spark), "20240105")
    assert rows(report) == [
        (112, "spark in action", "x.com", 2), (112, "spark in action", "y.com", 1),
        (999, None, "x.com", 1),
    ]
    shares = traffic.course_shares(daily, courses(spark))
    assert rows(shares, "day", "course_id", "share") == [
        ("20240105", 112, 60.0), ("20240105", 128, 20.0), ("20240105", 999, 20.0),
        ("20240106", 128, 100.0),
    ]


def test_reports_of_an_empty_day(spark, clicks):
    searches = traffic.course_search_daily(clicks)
    assert traffic.course_search_report(searches, courses(spark), "20230101").count() == 0
