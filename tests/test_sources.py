"""Grid, landed pages, history and files."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from partyard.contracts import MARKET_SUMMARY, RANKED_PARTS, RAW_LISTINGS, SOLD_HISTORY
from partyard.sources import files, grid, history, pages

CELLS = "vehicle_key string, search_year int, search_make string, search_model string, search_part string"
CELL = ("2018|Ford|F-150", 2018, "Ford", "F-150", "door")


def test_grid_order_and_pending(spark):
    cars = spark.createDataFrame([("Ford", "F-150", 0), ("Ram", "1500", 1)], "make string, model string, position int")
    cells = grid.search_grid(cars, first_year=2012, last_year=2014, parts=["door", "hood"])
    rows = cells.orderBy("grid_position").collect()
    assert [r.grid_position for r in rows] == list(range(12))
    assert rows[0].execution_key == "2012|Ford|F-150|door|sold"
    assert rows[7].search_key == "2012|Ram|1500|hood"
    assert rows[2].rank_key == "2013 Ford F-150"
    done = spark.createDataFrame([(rows[0].execution_key,)] * 2, "execution_key string")
    assert grid.pending_searches(cells, done).count() == 11


def test_grid_of_one_file_is_several_tasks(spark):
    cars = spark.range(0, 100, numPartitions=1).select(F.lit("Ford").alias("make"), F.col("id").cast("string").alias("model"), F.col("id").alias("position"))
    cells = grid.search_grid(cars, first_year=2012, last_year=2013, parts=["door"])
    tasks = cells.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 200


def cards(spark, html):
    df = spark.createDataFrame([(*CELL, html)], CELLS + ", html string")
    return pages.page_listings(df).orderBy("position_in_page").collect()


def card(title='<div class="s-card__title">A door</div>', price='<span class="s-card__price">$5.00</span>', rest="", klass="s-card"):
    return f'<li class="{klass}">{title}{price}{rest}</li>'


def test_page_that_opens_with_a_card(spark):
    (row,) = cards(spark, card())
    assert (row.title, row.price_raw, row.listing_url, row.sold_date) == ("A door", "$5.00", "", None)
    assert row.vehicle_key == CELL[0]


def test_fields_of_a_full_card(spark):
    html = card(
        "<div role='x' class='big s-card__title'><!-- x --><span> Caf&eacute; &amp; </span><b>2 &#62; 1 &#x1F600;</b></div>",
        '<span class="s-card__price positive"><i>$1,</i>234.50</span>',
        '<ul><li>nested</li></ul><a class="s-card__link" data-href="no" href="/itm/1?a=1&amp;b=2">go</a>'
        '<div class="s-card__caption"><span>Sold  May 14, 2026</span></div>',
        klass="a s-card--wide",
    )
    (row,) = cards(spark, "<html><li>menu</li><ul>" + html + "</ul></html>")
    assert row.title == "Café & 2 > 1 😀"
    assert row.price_raw == "$1,234.50"
    assert row.listing_url == "/itm/1?a=1&b=2"
    assert str(row.sold_date) == "2026-05-14"


def test_cards_that_are_dropped(spark):
    html = (
        card('<div class="s-card__title">Shop on eBay</div>')
        + card("")
        + card('<div class="s-card__title">  </div>')
        + card(price='<div class="s-card__price">$1</div>')
        + card(price='<span class="s-card__price">call</span>')
        + card(title='<div class="s-card__titles">x</div>')
        + card()
    )
    rows = cards(spark, html)
    assert [r.position_in_page for r in rows] == [6]


def test_pages_without_cards(spark):
    assert cards(spark, "<html><li class='item'>x</li></html>") == []
    assert cards(spark, None) == []


def sold(spark, *rows):
    """Rows of (part, title, url, scraped_at)."""
    df = spark.createDataFrame(
        [(CELL[0], 2018, "Ford", "F-150", p, t, "$1", u, None, s) for p, t, u, s in rows],
        CELLS + ", title string, price_raw string, listing_url string, sold_date string, scraped_at string",
    )
    return df.withColumns({"scraped_at": F.col("scraped_at").cast("timestamp"), "sold_date": F.col("sold_date").cast("date")})


def test_recency(spark):
    rows = sold(spark, ("door", "old", "u", "2024-01-01 00:00:00"), ("door", "edge", "u", "2024-01-17 00:00:00"), ("door", "new", None, "2024-01-30 00:00:00"))
    recent = history.recent_listings(rows, "2024-01-31 00:00:00")
    assert {r.title for r in recent.collect()} == {"edge", "new"}
    assert [r.title for r in history.newest_first(recent).collect()] == ["new", "edge"]
    assert history.listing_history(rows, datetime(2024, 1, 31)).count() == 3


def test_history_first(spark):
    stored = sold(spark, ("door", "stored", None, "2024-01-30 00:00:00"), ("hood", "stale", "u", "2023-01-01 00:00:00"))
    parsed = sold(spark, ("door", "page door", "u", "2024-01-31 00:00:00"), ("hood", "page hood", "u", "2024-01-31 00:00:00"))
    out = history.history_first(stored, parsed, run_id="r", as_of="2024-01-31 00:00:00")
    assert out.columns == RAW_LISTINGS.names
    got = {r.search_part: r for r in out.collect()}
    assert len(got) == out.count() == 2
    assert (got["door"].title, got["door"].search_url, got["door"].listing_url) == ("stored", "(db_cache)", "")
    assert (got["hood"].title, got["hood"].search_url, got["hood"].raw_text) == ("page hood", "", "page hood")
    assert got["hood"].subtitle is None


def test_active_snapshot(spark):
    cars = spark.createDataFrame([("Ford", "F-150")], "make string, model string")
    cells = grid.search_grid(cars, first_year=2018, last_year=2018, parts=["door", "hood"])
    counts = spark.createDataFrame([(2018, "Ford", "F-150", "door", 12)], "search_year int, search_make string, search_model string, search_part string, result_count int")
    out = history.active_snapshot(cells, counts, run_id="r", scrape_ts=F.lit("t"))
    assert out.columns == MARKET_SUMMARY.names
    got = {r.search_part: r for r in out.collect()}
    assert (got["door"].result_count, got["hood"].result_count) == (12, 0)
    assert got["hood"].execution_key == "2018|Ford|F-150|hood|all"


def test_append_history_prunes_dates(spark, tmp_path):
    path = str(tmp_path / "history")
    history.append_history(sold(spark, ("door", "a", "u", "2024-01-01 00:00:00")), path)
    history.append_history(sold(spark, ("door", "b", "u", "2024-01-30 00:00:00")), path)
    stored = spark.read.parquet(path)
    assert set(SOLD_HISTORY.names) <= set(stored.columns)
    recent = history.recent_listings(stored, "2024-01-31 00:00:00")
    assert [r.title for r in recent.collect()] == ["b"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "scrape_date" in filters[: filters.index("]") + 200]
    assert "GreaterThanOrEqual(scraped_at" in plan


def test_csv_round_trip_and_rankings(spark, tmp_path):
    row = (2018, "Ford", 'F "x", 150', "2018 Ford F-150", "door", 1.5, 0.5, 3, 4, 0.25, 9.0)
    ranked = spark.createDataFrame([(*row, 1), (*row, 2)], RANKED_PARTS)
    files.save_rankings(ranked, str(tmp_path / "all"), str(tmp_path / "top"), 1)
    back = files.read_run_csv(spark, str(tmp_path / "all"), RANKED_PARTS)
    assert back.schema.names == RANKED_PARTS.names
    assert sorted(back.collect()) == sorted(ranked.collect())
    assert files.read_run_csv(spark, str(tmp_path / "top"), RANKED_PARTS).count() == 1
    partial = files.read_run_csv(spark, str(tmp_path / "top"), RAW_LISTINGS)
    assert partial.first().title is None


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "table")
    files.publish_snapshot(spark.range(3), path, 1)
    files.publish_snapshot(spark.range(5), path, 10)
    files.publish_snapshot(spark.range(4), path, 9)
    (tmp_path / "table" / "version=11").mkdir()
    assert files.snapshot_versions(spark, path) == [1, 9, 10]
    assert files.read_snapshot(spark, path).count() == 5


def test_nested_elements_close_where_they_should(spark):
    html = (
        card('<div class="s-card__title"><div>New</div><div>Left <div>door</div></div></div>',
             '<span class="s-card__price"><span>$5</span><span>.00</span></span>')
        + '<span class="s-card__price">$7</span>'
        + card(price="")
        + '<span class="s-card__price">$9</span><!-- ' + card() + " -->"
    )
    (row,) = cards(spark, html)
    assert (row.title, row.price_raw) == ("New Left door", "$5.00")


TITLE, PRICE = '<div class="s-card__title">A</div>', '<span class="s-card__price">$5</span>'


def found(spark, html):
    return [(r.position_in_page, r.title, r.price_raw, r.listing_url) for r in cards(spark, html)]


def test_quoted_values_may_hold_tags(spark):
    html = f"""<li data-t="a > b" title='</li><li class="s-card">' class="s-card">{TITLE}<b x="</li>"></b>{PRICE}</li>"""
    assert found(spark, html) == [(0, "A", "$5", "")]
    link = """<a title="x class=&quot;s-card__link" href="/no"></a><a data-u=' href="/no"' href=/itm/1?a=1&amp;b=2 class='s-card__link'>z</a>"""
    assert found(spark, f"<li class=s-card>{TITLE}{PRICE}{link}</li>") == [(0, "A", "$5", "/itm/1?a=1&b=2")]


def test_scripts_styles_and_comments_hold_no_cards(spark):
    hidden = f"<li class='s-card'>{TITLE}{PRICE}</li>"
    html = (
        f"<SCRIPT type='a>b'>x = \"{hidden}\"</SCRIPT ><style>{hidden}</style><!-- {hidden} -->"
        f"<li class='s-card'>{TITLE}<script>'</li>{PRICE}'</script><span class='s-card__price'>$<!-- x -->6</span></li>"
        f"<script>{hidden}"
    )
    assert found(spark, html) == [(0, "A", "$6", "")]


def test_nested_cards_are_cards_of_their_own(spark):
    inner = "<li class='s-card s-card--row'><b class='s-card__title'>B<!-- c -->2</b><span class='s-card__price'>$7</span></li>"
    html = f"<ul><li class='s-card'>{TITLE}<ul>{inner}</ul>{PRICE}</li><li class='s-card'>{TITLE}{PRICE}</li></ul>"
    # The outer card's first price is the one of the card inside it.
    assert found(spark, html) == [(0, "A", "$7", ""), (1, "B 2", "$7", ""), (2, "A", "$5", "")]


def test_elements_that_are_left_open(spark):
    html = f"<ul><li class='s-card'>{TITLE}<p><i>x{PRICE}</ul>{PRICE}<li class='s-card'><br><img class='s-card__title'>{TITLE}{PRICE}"
    assert found(spark, html) == [(0, "A", "$5", "")]
    assert found(spark, f"</b></li><li class='s-card'></i>{TITLE}</u>{PRICE}") == [(0, "A", "$5", "")]
    assert found(spark, "<li class='s-card'><div class='s-card__title'>A<span class='s-card__price'>$5") == [(0, "A $5", "$5", "")]


def test_marks_and_broken_tags_do_no_harm(spark):
    html = f"<li class='s-card'>\u0001{TITLE}\u0002<b title=\"x>{PRICE}</b></li>"
    assert len(found(spark, html)) <= 1
    assert found(spark, "a < b s-card <li") == []
    long = f"<li class='s-card' data-x='{'=' * 50_000}' {'y=z ' * 5_000}>{TITLE}{PRICE}</li>"
    assert found(spark, "<p>" * 3_000 + long) == [(0, "A", "$5", "")]


def test_all_named_references(spark):
    """Every name is found in its bucket, the longest one without a semicolon too."""
    import html as standard

    samples = ["&" + name + ";" for name in pages.NAMED] + ["&" + name + "x" for name in pages.BARE]
    df = spark.createDataFrame([(t,) for t in samples], "t string")
    got = [r.u for r in df.select(pages.unescape(F.col("t")).alias("u")).collect()]
    assert got == [standard.unescape(t) for t in samples]


def test_character_references(spark):
    import html as standard

    samples = [
        "&check;", "&amp", "&ampx", "&#150;", "&#0;", "&#00000038;", "&#x00000026;", "&#xD800;", "&#9999999999;",
        "&notit;", "&notin;", "&unknown;", "&", "&;", "&#;", "&#x;", "&lt;b&gt", "&#1;x", "&#x1F600;", "a&b&c", "&#129;",
        "&NewLine;", "&fjlig;", "&#11;", "&#65534;",
    ]
    df = spark.createDataFrame([(t,) for t in samples], "t string")
    got = [r.u for r in df.select(pages.unescape(F.col("t")).alias("u")).collect()]
    assert got == [standard.unescape(t) for t in samples]


def test_csv_files_of_other_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("year,make\n2018,Ford\n")
    (tmp_path / "b.csv").write_text("make,year,more\nRam,2019,x\n")
    (tmp_path / "c.csv").write_text('make\n"Kia, Inc"\n')
    from pyspark.sql import types as T

    schema = T.StructType().add("year", "integer").add("make", "string")
    rows = files.read_run_csv(spark, str(tmp_path), schema).collect()
    assert sorted(map(tuple, rows), key=str) == [(2018, "Ford"), (2019, "Ram"), (None, "Kia, Inc")]


def test_many_small_csv_files(spark, tmp_path):
    from pyspark.sql import types as T

    names = ["year", "make", "price"]
    for k in range(10_000):
        order = names[k % 3 :] + names[: k % 3]
        cells = {"year": str(2000 + k % 20), "make": f"m{k}", "price": "7.5"}
        (tmp_path / f"{k}.csv").write_text(",".join(order) + "\n" + ",".join(cells[n] for n in order) + "\n")
    schema = T.StructType().add("price", "double").add("make", "string").add("year", "integer")
    rows = files.read_run_csv(spark, str(tmp_path), schema)
    got = rows.agg(F.count("*"), F.countDistinct("make"), F.sum("price"), F.sum("year")).first()
    assert tuple(got) == (10_000, 10_000, 75_000.0, 500 * sum(range(2000, 2020)))


def test_split_csv_file_keeps_its_header(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text("make,year\n" + "".join(f"m{k},{k}\n" for k in range(5000)))
    (tmp_path / "b.csv").write_text("year,make\n" + "".join(f"{k},n{k}\n" for k in range(50)))
    schema = T.StructType().add("year", "integer").add("make", "string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = files.read_run_csv(spark, str(tmp_path), schema)
        assert rows.filter("substr(make, 2) = year").count() == 5050 == rows.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_odd_csv_files(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType().add("year", "integer").add("make", "string")
    assert files.read_run_csv(spark, str(tmp_path), schema, faults="bad").columns == ["year", "make", "bad"]
    (tmp_path / "a.csv").write_text("\n \n\ufeffyear,make\n\n2018,Ford\nyear,make\nx,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("make,year,make\nRam\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("year,make\n")
    rows = files.read_run_csv(spark, str(tmp_path), schema, faults="bad").collect()
    expected = [(2018, "Ford", 0), (None, "make", 1), (None, None, 1), (None, "Ram", 0)]
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_csv_with_line_breaks_in_values(spark, tmp_path):
    from pyspark.sql import types as T

    (tmp_path / "a.csv").write_text('make,year\n"Ford\nF-150 ""x""",2018\n')
    (tmp_path / "b.csv").write_text("year\n2019\n")
    schema = T.StructType().add("year", "integer").add("make", "string")
    rows = files.read_run_csv(spark, str(tmp_path), schema, multi_line=True).collect()
    assert sorted(map(tuple, rows), key=str) == [(2018, 'Ford\nF-150 "x"'), (2019, None)]


def test_trend_and_recency_prune_dates(spark, tmp_path):
    from partyard.operators.trend import price_trend

    rows = [(*CELL, "t", "$5", "/1", None, f"2024-01-{d:02d} 00:00:00") for d in range(1, 29)]
    df = spark.createDataFrame(rows, CELLS + ", title string, price_raw string, listing_url string, sold_date date, scraped_at string")
    history.append_history(df.withColumn("scraped_at", F.col("scraped_at").cast("timestamp")), str(tmp_path / "h"))
    stored = spark.read.parquet(str(tmp_path / "h"))
    as_of = "2024-01-28 00:00:00"
    for plan in (history.recent_listings(stored, as_of), price_trend(stored, as_of, window_days=3)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "scrape_date" in text.split("PartitionFilters: [")[1].split("]")[0]
