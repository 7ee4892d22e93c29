from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from footfall import __main__ as command
from footfall.operators import area, scans
from footfall.params import TaskParams, task_params_from_json
from footfall.plans import jobs
from footfall.plans.queries import queries
from footfall.session import RUNTIME_SETTINGS, run_dir, shared_dir, spread_join
from footfall.sinks.results import ResultSink, replace_table
from footfall.sources import dims, fixtures, tables
from tests.helpers import plan, rows

SF_DIR = "/root/testdata/sf0.001"
ADULTS = TaskParams("2024-01-01", "2024-01-31", 20, 50)


@pytest.fixture(scope="module")
def actions(spark):
    return fixtures.visit_actions(fixtures.events(spark, SF_DIR)).cache()


def test_params_from_json(spark):
    text = '{startDate:"2020-01-01", endDate:"2020-01-30", startAge: 20, endAge: 50, ' \
        'professionals: "", cities: "", sex:"", keywords:"", categoryIds:"", ' \
        'targetPageFlow:"1,2,3,4,5,6,7"}'
    assert task_params_from_json(spark, text) == TaskParams("2020-01-01", "2020-01-30", 20, 50)
    p = task_params_from_json(
        spark, '{"keywords": "a, b", "categoryIds": "3,4", "sex": "male", "startAge": ""}'
    )
    assert p == TaskParams(
        sex="male", keywords=("a", "b"), category_ids=(3, 4), target_page_flow=()
    )


def test_session_job(spark, actions, tmp_path):
    sink = ResultSink(path=str(tmp_path))
    users = fixtures.users(spark, SF_DIR)
    task = jobs.run_session_job(actions, users, ADULTS, sink, "task-1")
    assert task == "task-1"
    for table, query in (
        ("session_stat_ratio", "session_ratio"), ("session_stat_top10category", "top10_categories"),
        ("session_stat_top10session", "top10_sessions"),
    ):
        got, want = sink.read(spark, table), queries()[query](spark, SF_DIR)
        assert got.columns == want.columns
        assert rows(got) == rows(want)
    extract = sink.read(spark, "session_random_extract")
    assert extract.columns == [
        "taskid", "sessionid", "startTime", "searchKeywords", "clickCategoryIds"
    ]
    other = jobs.run_session_job(actions, users, ADULTS, sink)
    ratios = spark.read.parquet(f"{tmp_path}/session_stat_ratio")
    assert {r["taskid"] for r in ratios.collect()} == {"task-1", other}


def test_task_that_runs_again_leaves_its_rows_once(spark, tmp_path):
    sink = ResultSink(path=str(tmp_path))
    for task, n in (("a/1", 1), ("b", 2), ("a/1", 3)):
        sink.append(spark.createDataFrame([(n,)], "n INT"), "t", task)
    assert rows(sink.read(spark, "t")) == [("a/1", 3), ("b", 2)]


def _fails_half_way(spark):
    return spark.range(0, 4, 1, 4).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
        .cast("int").alias("n"))


def test_failed_results_leave_the_old_ones(spark, tmp_path):
    sink = ResultSink(path=str(tmp_path))
    sink.append(spark.createDataFrame([(1,)], "n INT"), "t", "a")
    replace_table(spark.createDataFrame([(1,)], "n INT"), "whole_or_old")
    for write in (lambda df: sink.append(df, "t", "a"), lambda df: sink.append(df, "t", "b"),
                  lambda df: replace_table(df, "whole_or_old")):
        with pytest.raises(PySparkException):
            write(_fails_half_way(spark))
    assert rows(sink.read(spark, "t")) == [("a", 1)]
    assert rows(spark.table("whole_or_old")) == [(1,)]
    replace_table(spark.createDataFrame([(2,)], "n INT"), "whole_or_old")
    assert rows(spark.table("whole_or_old")) == [(2,)]
    assert [t.name for t in spark.catalog.listTables() if "whole" in t.name] == ["whole_or_old"]


def test_page_job(spark, actions, tmp_path):
    jobs.run_page_job(actions, ADULTS, ResultSink(path=str(tmp_path)), "t")
    row = spark.read.parquet(f"{tmp_path}/page_convert_ratio").first()
    assert row["taskid"] == "t"
    assert [part.split("=")[0] for part in row["convertRate"].split("|")] == [
        "1_2", "2_3", "3_4", "4_5", "5_6", "6_7"
    ]


def test_area_job(spark, actions, tmp_path):
    jobs.run_area_job(spark, actions, ADULTS, ResultSink(path=str(tmp_path)), "t")
    got = spark.read.parquet(f"{tmp_path}/area_top3_product").drop("taskid")
    clicks = scans.click_scan(actions, ADULTS)
    want = area.top_area_products(area.area_product_clicks(clicks, dims.cities(spark)))
    assert rows(got) == rows(want)
    assert spark.table("temp_area_basic_info").count() == clicks.count()


def test_command_line_and_tables(spark, actions, tmp_path):
    replace_table(actions, "user_visit_action", ("date",))
    replace_table(fixtures.users(spark, SF_DIR), "user_info")
    replace_table(fixtures.users(spark, SF_DIR), "user_info")
    ranged = scans.action_scan(tables.user_visit_actions(spark), ADULTS)
    assert "PartitionFilters: [isnotnull(date" in plan(ranged)
    text = '{startDate:"2024-01-01", endDate:"2024-01-31", startAge: 20, endAge: 50}'
    for job in ("session", "page", "area"):
        params = text if job != "page" else text[:-1] + ', targetPageFlow: "1,2"}'
        command.main([job, "--params", params, "--output", str(tmp_path)])
    got = spark.read.parquet(f"{tmp_path}/session_stat_top10category").drop("taskid")
    assert rows(got) == rows(queries()["top10_categories"](spark, SF_DIR).drop("taskid"))
    assert spark.read.parquet(f"{tmp_path}/page_convert_ratio").count() == 1


def test_stream_command(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1704067200123 4 5 6 7\n")
    command.main([
        "ad-stream", "--text", f"{tmp_path}/in", "--tables", f"{tmp_path}/t", "--checkpoint",
        f"{tmp_path}/c", "--once",
    ])
    from footfall.streaming.ad_stream import AdTables
    assert rows(AdTables.at(spark, f"{tmp_path}/t").city_clicks.read()) == [
        ("20240101", "4", "5", 7, 1)
    ]


def test_state_lives_in_the_checkpoint_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    assert run_dir(spark, "x").startswith(f"{folder}/footfall/x-")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_report_command(spark, tmp_path, capsys):
    line = '10.0.0.1\t2024-01-05 10:11:12\t"GET /class/112.html HTTP/1.1"\thttps://x.com/s\t200'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(line + "\n")
    command.main([
        "traffic-stream", "--text", f"{tmp_path}/in", "--tables", f"{tmp_path}/t", "--checkpoint",
        f"{tmp_path}/c", "--once",
    ])
    command.main(["report", "--tables", f"{tmp_path}/t", "--day", "20240105",
                  "--output", f"{tmp_path}/out"])
    assert rows(spark.read.parquet(f"{tmp_path}/out/course_report").drop("taskid")) == [
        (112, "spark in action", 1, 100.0)
    ]
    assert rows(spark.read.parquet(f"{tmp_path}/out/course_search_report").drop("taskid")) == [
        (112, "spark in action", "x.com", 1)
    ]


def test_configure_leaves_the_other_settings_alone(spark):
    assert RUNTIME_SETTINGS == {"spark.sql.session.timeZone": "UTC"}


def test_spread_join_equals_a_join(spark):
    rows_ = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(60)], "k INT, v INT")
    side = spark.createDataFrame([(0, "a"), (None, "n"), (9, "x")], "k INT, name STRING")
    semi = spread_join(rows_, side.select("k"), ["k"], ["v"], "left_semi")
    assert rows(semi) == rows(rows_.filter("k = 0 OR k IS NULL"))
    anti = spread_join(rows_, side.select("k"), ["k"], ["v"], "left_anti")
    assert rows(anti) == rows(rows_.filter("k > 0"))
    left = spread_join(rows_, side, ["k"], ["v"], "left")
    assert left.columns == ["k", "v", "name"] and left.count() == 60
    assert left.filter("name = 'n'").count() == 15
