"""Awkward and hostile pages, and archives that are read back in parallel."""

import time

import pytest

from roomtide.llm import html_text, warc

SENTENCES = "A long sentence, with words and marks. " * 12
P = f"<p>{SENTENCES}</p>"
TEXT = SENTENCES.strip()


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id=aspnet action=x><div>{P * 3}</div><input><button>Go</button></form></body>",
        f"<body><main><form>{P * 3}</form></main></body>",
        f"<body><form><main>{P * 3}</main></form></body>",
        f"<body><nav><a href=x>Home</a> <a href=y>News</a><article>{P * 3}</article></body>",
        f"<body><header><h1>Site</h1><main>{P * 3}</main></body>",
        f"<body><nav><a href=x>Home</a></nav><aside><p>Short.</p></aside><div>{P * 3}</div></body>",
    ],
)
def test_text_inside_forms_and_after_open_navigation(page):
    assert html_text.main_text(page) == "\n".join([TEXT] * 3)


def test_small_forms_and_closed_asides_are_no_text():
    page = f"<body><aside><article><p>Other story, in short.</p></article></aside><article>{P * 2}<form><label>Name</label><input></form></article></body>"
    assert html_text.main_text(page) == "\n".join([TEXT] * 2)


def test_formulas_stay_in_their_line():
    page = f"<article>{P}<p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds, as shown.</p></article>"
    assert html_text.main_text(page) == f"{TEXT}\nHere x=2 holds, as shown."


@pytest.mark.parametrize(
    "page",
    ["<a " * 1_000_000, '<p a="' * 500_000, "<!" * 1_500_000, "<div>text, " * 40_000, "<div>" * 40_000 + "</x>" * 40_000, "<p><table><tr><td>" + "<div>a" * 40_000],
)
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 5


def test_archives_are_read_by_a_task_each(spark):
    df = spark.createDataFrame([(i, f"http://h{i % 7}.org/{i}", f"<p>{i % 9}</p>" * 50) for i in range(300)], "page_id bigint, url string, html string")
    runs = warc.write_archives(
        df.selectExpr("url as url_key", "0L as captured", "page_id", "url", "cast(html as binary) as payload", "cast(null as bigint) as refers_to").repartition(6),
        warc.new_folder(spark, "archives"),
    )
    rows = warc.read_archives(runs)
    assert rows.count() == 300 and rows.select("archive").distinct().count() == 6
    assert len(rows.inputFiles()) == 6
