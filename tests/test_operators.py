from __future__ import annotations

import datetime as dt
import random
import uuid
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from harbormill.functions import ids, numeric, temporal, text, vectors
from harbormill.functions.engagement import coverage_flag, positive_rate, realization_ratio
from harbormill.models import catalog
from harbormill.operators import aggregates, columns, documents, html, joins, ranking, vectorsearch, windows
from harbormill.plans import finance


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0]["x"]


# --- functions ----------------------------------------------------------------


@pytest.mark.parametrize("name", ["", "a", "issue:AB-1:0", "Zürich ✓", "x" * 5000])
def test_uuid5_equals_python(spark, name):
    assert one(spark, ids.uuid5(F.lit(name), uuid.NAMESPACE_URL)) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))
    nil = uuid.UUID(int=0)
    assert one(spark, ids.uuid5(F.lit(name), nil)) == str(uuid.uuid5(nil, name))


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("carlos", "Carlos"),
        ("MARY ann", "Mary Ann"),
        ("o'NEIL-smith", "O'neil-Smith"),
        ("a_b|c\\d[e]{f}<g>", "A_B|C\\D[E]{F}<G>"),
        ("st. john/paul", "St. John/Paul"),
        ("a--b", "A--B"),
        ("", ""),
    ],
)
def test_title_case(spark, raw, expected):
    assert one(spark, text.title_case(F.lit(raw))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("TotalRevenue", "total_revenue"),
        ("EBITDA", "ebitda"),
        ("NormalizedEBITDA", "normalized_ebitda"),
        ("NetPPE", "net_ppe"),
        ("BasicEPS", "basic_eps"),
        ("operatingCashFlow", "operating_cash_flow"),
        ("DilutedNIAvailtoComStockholders", "diluted_ni_availto_com_stockholders"),
    ],
)
def test_snake_case(spark, raw, expected):
    assert one(spark, text.snake_case(F.lit(raw), ("EBIT", "EBITDA", "EPS", "NI", "PPE"))) == expected


def test_rounding_modes(spark):
    half = F.lit("0.125").cast("decimal(10,4)")
    assert one(spark, numeric.rounded(half, 2)) == Decimal("0.13")
    assert one(spark, numeric.rounded(half, 2, "half_even")) == Decimal("0.12")
    assert one(spark, numeric.ratio(F.lit(1), F.lit(32), 4)) == Decimal("0.0313")
    assert one(spark, numeric.ratio(F.lit(1), F.lit(32), 4, "half_even")) == Decimal("0.0312")
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0), 4)) == Decimal("0.0000")
    assert one(spark, numeric.percent(F.lit(2), F.lit(21))) == 9.52
    assert one(spark, numeric.percent(F.lit(0), F.lit(0))) == 0.0


def test_numbers_that_do_not_fit_count_as_zero(spark):
    for raw in ("NaN", "1e30", "x", None):
        assert one(spark, numeric.number_or_zero(F.lit(raw).cast("string"))) == 0
    assert one(spark, numeric.number_or_zero(F.lit("7.0"))) == 7


@pytest.mark.parametrize(("raw", "expected"), [("0.25", 0), ("0.5", 1), ("12", 12), ("", None), ("x", None)])
def test_whole_number(spark, raw, expected):
    assert one(spark, numeric.whole_number(F.lit(raw))) == expected


@pytest.mark.parametrize(("raw", "expected"), [(" 24.99 ", Decimal("24.99")), ("", None), ("call us", None)])
def test_price_or_null(spark, raw, expected):
    assert one(spark, numeric.price_or_null(F.lit(raw))) == expected


def test_division_by_zero_keeps_its_sign(spark):
    assert one(spark, numeric.divide(F.lit(3), F.lit(0))) == float("inf")
    assert one(spark, numeric.divide(F.lit(-3), F.lit(0))) == float("-inf")
    assert one(spark, numeric.divide(F.lit(0), F.lit(0))) is None
    assert one(spark, numeric.finite(F.lit(float("inf")))) is None
    assert one(spark, numeric.finite(F.lit(float("nan")))) is None


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("'es_Travel'", "travel"), (" 'food' ", "food"), ("es_es_x", "es_x"), ('"HOME"', "home")],
)
def test_market_key(spark, raw, expected):
    assert one(spark, text.market_key(F.lit(raw))) == expected


def test_dates(spark):
    assert one(spark, temporal.day_first_date(F.lit("7/03/2025"))) == dt.date(2025, 3, 7)
    assert one(spark, temporal.day_first_date(F.lit("soon"))) is None
    assert one(spark, temporal.embedded_date(F.lit("Paid 15/12/2024 final"))) == dt.date(2024, 12, 15)
    assert one(spark, temporal.epoch_ms_date(F.lit(1735689599999))) == dt.date(2024, 12, 31)
    moment = F.lit(dt.datetime(2024, 12, 31, 23, 59, 59)).cast("timestamp_ntz")
    assert one(spark, temporal.year_range(moment, 2024)) is True
    assert one(spark, temporal.year_range(moment, 2025)) is False


def test_trailing_characters_are_a_set(spark):
    assert one(spark, text.strip_trailing_chars(F.lit("5.69% pa"), "% pa")) == "5.69"
    assert one(spark, text.last_segment(F.lit("https://a.example/b/c.pdf/"))) == "c.pdf"
    assert one(spark, text.path_join("file", F.lit("A"), F.lit(None).cast("string"))) is None


@pytest.mark.parametrize(
    ("tier", "potential", "actual", "touches", "pos", "neg", "f2f", "expected"),
    [
        ("High", 1000, 249, 2, 0, 0, 0, "Under-served high-value"),
        ("High", 1000, 250, 2, 0, 0, 0, "Adequate"),
        ("HIGH", 1000, 900, 3, 3, 0, 0, "Well-served high-value"),
        ("HIGH", 1000, 100, 3, 3, 0, 0, "Well-served high-value"),
        ("low", 1000, 10, 2, 0, 1, 1, "Over-served low-value"),
        ("low", 1000, 10, 2, 0, 1, 0, "Adequate"),
        (None, 1000, 10, 2, 0, 1, 1, "Adequate"),
        ("High", None, 10, 1, 0, 0, 0, "Adequate"),
        ("High", 0, 0, 0, 0, 0, 0, "Adequate"),
    ],
)
def test_coverage_flag(spark, tier, potential, actual, touches, pos, neg, f2f, expected):
    text_or_null = F.lit(tier).cast("string")
    numbers = [F.lit(v).cast("bigint") for v in (potential, actual, touches, pos, neg, f2f)]
    assert one(spark, coverage_flag(text_or_null, *numbers)) == expected


def test_ratios_without_base(spark):
    assert one(spark, realization_ratio(F.lit(5), F.lit(None).cast("bigint"))) == Decimal("0.0000")
    assert one(spark, positive_rate(F.lit(1), F.lit(3))) == Decimal("0.3333")


# --- windows and aggregates ---------------------------------------------------


def test_pct_change_fills_forward(spark):
    data = [("k", i, v) for i, v in enumerate([1.0, None, 2.0, 0.0, 3.0])]
    df = spark.createDataFrame(data, "k string, i int, v double")
    out = windows.pct_change(df, ["k"], "i", {"c": "v"}).orderBy("i")
    assert [r["c"] for r in out.collect()] == [None, 0.0, 1.0, -1.0, float("inf")]


def test_pct_change_random_against_loop(spark):
    rng = random.Random(7)
    data = [(k, i, rng.choice([None, 0.0, 1.5, -2.0, 8.0])) for k in "abc" for i in range(60)]
    expected = {}
    for k in "abc":
        last = None
        for _, i, v in sorted(r for r in data if r[0] == k):
            current = v if v is not None else last
            if last is None or current is None:
                expected[k, i] = None
            elif last == 0:
                expected[k, i] = None if current == 0 else float("inf") if current > 0 else float("-inf")
            else:
                expected[k, i] = current / last - 1
            last = current
    df = spark.createDataFrame(data, "k string, i int, v double")
    got = windows.pct_change(df, ["k"], "i", {"c": "v"}).collect()
    assert {(r["k"], r["i"]): r["c"] for r in got} == expected


def test_year_end_takes_the_last_value_that_is_not_null(spark):
    day = lambda y, m, d: dt.datetime(y, m, d)
    data = [
        ("a", day(2020, 1, 5), 1.0),
        ("a", day(2020, 6, 5), 2.0),
        ("a", day(2020, 12, 30), None),
        ("a", day(2022, 3, 1), None),
        (None, day(2020, 1, 1), 9.0),
    ]
    df = spark.createDataFrame(data, "symbol string, date timestamp_ntz, close double")
    for unique in (False, True):
        out = aggregates.year_end_last(df, "symbol", "date", "close", unique)
        assert rows(out) == [("a", day(2020, 12, 31), 2.0), ("a", day(2022, 12, 31), None)]


def test_pivot_mean_averages_duplicates_and_drops_empty_rows(spark):
    data = [("a", 1, "x", 1.0), ("a", 1, "x", 3.0), ("a", 1, "y", None), ("a", 2, "y", None), ("a", 3, "z", 5.0)]
    df = spark.createDataFrame(data, "s string, d int, m string, v double")
    assert rows(aggregates.pivot_mean(df, ["s", "d"], "m", "v", ["x", "y"])) == [("a", 1, 2.0, None)]


def test_yearly_sum_counts_nulls_as_zero(spark):
    data = [("a", dt.datetime(2020, 1, 1), None), ("b", dt.datetime(2020, 1, 1), 2.5), (None, dt.datetime(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(data, "k string, d timestamp_ntz, v double")
    assert rows(aggregates.yearly_sum(df, "k", "d", "v")) == [("a", 2020, 0.0), ("b", 2020, 2.5)]


def test_first_seen_and_latest(spark):
    data = [(1, 2, "b"), (1, 1, "z"), (1, 1, "a"), (2, 5, "c")]
    df = spark.createDataFrame(data, "id int, o int, v string")
    assert rows(windows.first_seen(df, "id", [F.col("o")])) == [(1, 1, "a"), (2, 5, "c")]
    assert rows(windows.latest_by(df, ["id"], [F.col("o")])) == [(1, 2, "b"), (2, 5, "c")]


# --- growth and sustainability ------------------------------------------------


def test_growth_on_a_small_history(spark):
    d = dt.datetime
    history = spark.createDataFrame(
        [("A", d(2020, 12, 30), 10.0), ("A", d(2021, 12, 31), 15.0), ("A", d(2022, 5, 1), None), ("B", d(2021, 2, 1), 4.0)],
        "symbol string, date timestamp_ntz, close double",
    )
    statements = spark.createDataFrame(
        [
            ("net_income", d(2021, 12, 31), 5.0, "A"),
            ("total_revenue", d(2021, 12, 31), 100.0, "A"),
            ("total_revenue", d(2022, 6, 30), 150.0, "A"),
            ("other", d(2022, 7, 30), 1.0, "A"),
        ],
        "metric string, date timestamp_ntz, value double, symbol string",
    )
    got = {(r["symbol"], r["date"].year): r for r in finance.growth(history, statements).collect()}
    assert got["A", 2020]["total_revenue"] is None and got["A", 2020]["annual_return"] is None
    assert got["A", 2021]["annual_return"] == 0.5
    assert got["A", 2021]["net_income"] == 5.0 and got["A", 2021]["total_revenue"] == 100.0
    # a year without a close keeps its row; its return is 0 after filling forward
    assert got["A", 2022]["close"] is None and got["A", 2022]["annual_return"] == 0.0
    assert got["A", 2022]["revenue_growth"] == 0.5 and got["A", 2022]["net_income"] is None
    assert got["B", 2021]["close"] == 4.0 and got["B", 2021]["net_income"] is None


def test_first_year_is_conservative_and_unknown_symbols_stay(spark):
    d = dt.date
    paid = spark.createDataFrame(
        [("Westpac", d(2020, 5, 1), Decimal("1.00")), ("Westpac", d(2021, 5, 1), Decimal("1.50")), ("X", d(2020, 1, 1), Decimal("1.00"))],
        "bank string, payment_date date, dividend_per_share decimal(4,2)",
    )
    cash = spark.createDataFrame(
        [
            ("operating_cash_flow", dt.datetime(2020, 6, 1), 100.0, "WBC.AX"),
            ("operating_cash_flow", dt.datetime(2021, 6, 1), 100.0, "WBC.AX"),
            ("other", dt.datetime(2021, 6, 1), 900.0, "WBC.AX"),
            ("operating_cash_flow", dt.datetime(2020, 6, 1), 7.0, "X"),
        ],
        "metric string, date timestamp_ntz, value double, symbol string",
    )
    got = {(r["bank"], r["year"]): r for r in finance.dividend_sustainability(paid, cash).collect()}
    assert set(got) == {("Westpac", 2020), ("Westpac", 2021), ("X", 2020)}
    assert got["Westpac", 2020]["sustainability_flag"] == "CONSERVATIVE GROWTH"
    assert got["Westpac", 2021]["sustainability_flag"] == "GROWING FASTER THAN OCF"
    assert got["Westpac", 2021]["dividend_per_share"] == Decimal("1.50")


# --- joins, columns, ranking --------------------------------------------------


def test_orphans_count_null_keys_and_ignore_parent_duplicates(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    parents = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(joins.orphan_count(facts, parents, "k")) == [(4, 2)]
    assert rows(joins.orphan_count(facts.limit(0), parents, "k")) == [(0, 0)]


def test_unmatched_rate_gives_null(spark):
    facts = spark.createDataFrame([(1, 10.0), (2, 10.0)], "d int, amount double")
    rates = spark.createDataFrame([(1, 1.5)], "d int, rate double")
    assert rows(joins.convert_by_date(facts, rates, "d", "amount", "rate", "out").select("d", "out")) == [(1, 15.0), (2, None)]


def test_conform_safe_turns_overflow_into_null(spark):
    df = spark.createDataFrame([("A", "2024-01-02", "123.456"), ("B", "x", "1.005")], "bank string, payment_date string, dividend_per_share string")
    out = rows(columns.conform(df, catalog.DIVIDENDS, safe=True))
    assert out == [("A", dt.date(2024, 1, 2), None), ("B", None, Decimal("1.01"))]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE|malformed|cannot"):
        columns.conform(df, catalog.DIVIDENDS).collect()


def test_first_or_null_row(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 2, 6.0)], "symbol string, date int, revenue double")
    hit = ranking.first_or_null(df, [F.col("date")], {"symbol": "?"})
    assert rows(hit) == [("b", 2, 6.0)]
    miss = ranking.first_or_null(df.where("date > 9"), [F.col("date")], {"symbol": "?"})
    assert rows(miss) == [("?", None, None)]


def test_brackets_are_open_below_and_closed_above(spark):
    df = spark.createDataFrame([(0, 70), (70, 80), (80, 100)], "low int, high int")
    got = ranking.bracket_targets(df, "low", "high", [70, 71, 100, 101])
    assert rows(got) == [(0, 70, 70), (70, 80, 71), (80, 100, 100)]


# --- text ---------------------------------------------------------------------


def test_recursive_split_known_example():
    source = (
        "Hi.\n\nI'm Harrison.\n\nHow? Are? You?\nOkay then f f f f.\n"
        "This is a weird text to write, but gotta test the splittingggg some how.\n\nBye!\n\n-H."
    )
    expected = (
        "Hi.|I'm|Harrison.|How? Are?|You?|Okay then|f f f f.|This is a|weird|text to|write,|but gotta|"
        "test the|splitting|gggg|some how.|Bye!|-H."
    ).split("|")
    assert documents.split_recursive(source, 10, 1) == expected


@pytest.mark.parametrize("seed", range(8))
def test_recursive_split_keeps_the_whole_text(seed):
    rng = random.Random(seed)
    # numbered words make every position unambiguous; the longest exceed a chunk
    letters = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuv", k=n))
    word = lambda i: f"w{i}" + letters(rng.choice([0, 3, 40, 130]))
    source = "".join(word(i) + rng.choice([" ", " ", "  ", "\n", "\n\n"]) for i in range(rng.randrange(1, 200)))
    chunks = documents.split_recursive(source, 50, 10)
    assert all(0 < len(c) <= 50 and c == c.strip() for c in chunks)
    pieces = [p for c in chunks for p in c.split()]
    rebuilt = "".join(source.split())
    position = 0
    for piece in pieces:
        start = rebuilt.find(piece, max(0, position - 10))
        assert 0 <= start <= position
        position = max(position, start + len(piece))
    assert position == len(rebuilt)


def test_rich_text_trees(spark):
    tree = (
        '{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":"one"},{"type":"text","text":""}]},'
        '{"type":"mention","attrs":{"text":"@x"}},[["two"],{"text":"three","content":["no"]}],null]}'
    )
    deep = '{"content":' * 900 + '"end"' + "}" * 900
    df = spark.createDataFrame([(1, tree), (2, "plain {text"), (3, None), (4, deep), (5, "42")], "id int, raw string")
    got = {r["id"]: r["t"] for r in df.select("id", documents.rich_text("raw").alias("t")).collect()}
    assert got == {1: "one\ntwo\nthree", 2: "plain {text", 3: "", 4: "end", 5: "42"}


def test_stride_and_token_chunks_cover_everything(spark):
    source = "héllo wörld \n" * 101
    chunks = one(spark, documents.stride_chunks(F.lit(source), 64))
    assert "".join(chunks) == source and max(map(len, chunks)) == 64
    tokens = one(spark, documents.token_chunks(F.lit(source), 7))
    assert " ".join(tokens).split() == source.split()
    assert one(spark, documents.token_chunks(F.lit("  "), 7)) == []


# --- HTML and vectors ---------------------------------------------------------


def test_listing_cards_without_link_or_price(spark):
    page = (
        '<div class="row product"><h3 class="mb-0"><a href="https://s.example/product/7/">Box &amp; Co</a></h3>'
        '<div class="price"> 24.99 </div></div><div class="row product"><h3>no link</h3></div>'
        '<div class="row product">\n <h3><a class="q" href="/product/8">\n Eight </a></h3></div>'
    )
    got = html.listing_cards(spark.createDataFrame([(page,)], "html string")).drop("position")
    assert rows(got) == [("7", "Box & Co", "https://s.example/product/7/", "24.99"), ("8", "Eight", "/product/8", "")]


def test_links_of_any_spelling(spark):
    page = (
        "<a href='/one'>One</a><A class=\"x\" HREF=\"/two?a=1&amp;b=2\">T<b>w</b>o &eacute;&#8212;&#x2603;</A><a name=\"no\">skip</a>"
        "<a\n data-href=\"/wrong\"\n href=/three >Three &unknown; &amp;lt;</a ><abbr href=\"/no\">x</abbr>"
    )
    got = html.links(spark.createDataFrame([(page,)], "html string")).select("href", "text")
    assert [tuple(r) for r in got.collect()] == [("/one", "One"), ("/two?a=1&b=2", "Two é—☃"), ("/three", "Three &unknown; &lt;")]


def test_an_unlisted_category_comes_last(spark):
    from harbormill.plans.documents import shop_catalog

    card = '<div class="row product"><h3><a href="/p/1">A</a></h3></div>'
    pages = spark.createDataFrame([("toys", 1, card), ("apparel", 1, card)], "category string, page int, html string")
    details = spark.createDataFrame([("/p/1", "<h2>Description</h2><p>x</p>")] * 2, "url string, html string")
    got = shop_catalog(pages, details, ["apparel"], F.lit("2024-01-01").cast("timestamp")).collect()
    assert [(r["category"], r["description"]) for r in got] == [("Apparel", "x")]


def test_details_and_failed_pages(spark):
    page = (
        "<h2>Product Description</h2><div><p>Soft <b>wool</b></p></div><table><tr><th>Size</th><td>M</td></tr>"
        "<tr><td>BRAND</td><td>Acme</td></tr></table>from $39.99"
    )
    details = html.product_details(spark.createDataFrame([("u1", page), ("u2", "<p>x</p>")], "url string, html string"))
    assert rows(details) == [("u1", "Soft wool", "Acme", Decimal("39.99")), ("u2", "", "", None)]
    stubs = spark.createDataFrame([("u1", "5"), ("u9", "bad")], "product_url string, price_text string")
    full = html.with_details(stubs, details).select("product_url", "price", "brand", "description")
    assert rows(full) == [("u1", Decimal("5.00"), "Acme", "Soft wool"), ("u9", None, "", "")]


def test_cosine_search(spark):
    data = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0]), (5, [1.0])]
    df = spark.createDataFrame(data, "id int, embedding array<float>")
    got = [(r["id"], r["score"]) for r in vectorsearch.top_k(df, [2.0, 0.0], 3).collect()]
    assert got == [(1, 1.0), (2, 0.7071), (4, -1.0)]
    assert vectorsearch.top_k(df, [], 3).count() == 0
    assert vectorsearch.top_k(df, None, 1).columns == ["id", "score"]
    many = spark.range(100).select("id", F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    assert vectorsearch.top_k(many, [0.0, 1.0], 1000).count() == 100
    assert vectorsearch.top_k(many, [0.0, 1.0], 40).count() == 40
    assert one(spark, vectors.cosine(F.array(F.lit(3.0)), F.array(F.lit(3.0)))) == 1.0


# --- markup -------------------------------------------------------------------


def one_page(spark, text):
    return spark.createDataFrame([(1, text)], "id int, html string")


def test_markup_with_angles_comments_scripts_and_missing_ends(spark):
    page = (
        '<!DOCTYPE html><!-- <a href="/comment">no</a> --><script>var s = "<a href=\'/script\'>";</script>'
        '<style>a > b {}</style><A title="a > b" HREF = \'/one\'>On<b>e</b> &lt;1&gt;</a> 3 < 4 <a href=/two>two<a href="/three" href="/not">three</a>'
        "<a name=x>no address</a><a href>empty</a><a class='l' data-y=\"'\" href=\"/fi've?a=1&amp;b=2\">f\n ive</a></p></div>"
        '<a href="/open>x</a>'
    )
    got = rows(html.links(one_page(spark, page)).select("href", "text"))
    want = [("/one", "One <1>"), ("/two", "two"), ("/three", "three"), ("", "empty"), ("/fi've?a=1&b=2", "f\n ive")]
    assert sorted(got) == sorted([*want, ('"/open', "x")])  # a quote that never ends is a character


def test_nested_tables_and_cells_without_ends(spark):
    page = (
        "<table><tr><th>A<th>B<tr><td>1<td><table><tr><th>C</th></tr><tr><td>inner</td></tr></table> after"
        "<tr><td>2</td><td>two</td></tr></table><table><tr><th>A</th></tr><tr><td>last</td></tr></table>"
    )
    read = lambda n, names: rows(html.table_records(one_page(spark, page), names, nth=n).drop("id"))
    assert read(0, {"a": "A", "b": "B", "z": "Z"}) == [(1, "1", "Cinner after", None), (2, "2", "two", None)]
    assert read(1, {"c": "C"}) == [(1, "inner")]
    assert read(2, {"a": "A"}) == [(1, "last")]
    assert read(3, {"a": "A"}) == []


def test_nested_cards_prices_and_details(spark):
    cards = (
        '<div class="row product"><div class="description"><h3><a href="/p/1">One</a></h3></div>'
        '<div class="price-wrap"><div class="price"><div class="was"><s>9.00</s></div> 8.00</div></div>'
        '<div class="product inner row"><h3><a href="/p/2" title="x > y">Two</a></h3></div></div>'
        '<div class="rows products"><h3><a href="/p/3">not a card</a></h3></div>'
    )
    got = rows(html.listing_cards(one_page(spark, cards)).drop("id", "product_url"))
    assert got == [(0, "1", "One", "9.00 8.00"), (1, "2", "Two", "")]
    details = (
        "<h2>Other</h2><p>no</p><!-- <h3>Description</h3><p>hidden</p> --><h4>The <i>DESCRIPTION</i></h4><div><p>it &amp; that</p></div>"
        "<table><tr><td>Size</td><td><table><tr><td>x</td></tr></table></td></tr><tr><th>Brand:</th><td>Acme &reg;</td></tr></table>"
        "<b>from </b>$1.00 <i>from $12.5</i><i>from $13.50</i>"
    )
    got = rows(html.product_details(one_page(spark, details), "id").drop("product_url"))
    assert [(d, b, str(p)) for d, b, p in got] == [("it & that", "Acme ®", "12.00")]
    blank = spark.createDataFrame([(1, None), (2, "")], "id int, html string")
    assert rows(html.product_details(blank, "id")) == [(1, "", "", None), (2, "", "", None)]
    for read in (html.links, html.listing_cards, lambda p: html.table_records(p, {"a": "A"})):
        assert rows(read(blank)) == []


def test_markup_of_any_text_ends_and_stays_linear():
    import random
    import time

    from harbormill.functions.markup import Page

    r = random.Random(5)
    parts = ["<", ">", "a", " ", "=", '"', "'", "/", "<a href=", "<td>", "</td>", "<table>", "</table>", "<!--", "-->", "<script>", "</script>", "&amp;", "\n"]
    for _ in range(2_000):
        page = Page("".join(r.choice(parts) for _ in range(r.randrange(60))))
        assert all(i < end <= len(page.names) for i, end in enumerate(page.last))
        # extents nest: none ends between another's start and end
        assert all(page.last[j] <= page.last[i] for i in range(len(page.names)) for j in range(i + 1, page.last[i]))
    start = time.perf_counter()
    for text in ("<a " * 40_000, "<div>" * 40_000, "<a b='" * 20_000, "<!--" * 40_000, "<a =" * 40_000, "<td>" * 40_000):
        Page(text)
    assert time.perf_counter() - start < 30


# --- chunks bounded by a tokenizer --------------------------------------------


@pytest.fixture(scope="module")
def tokenizer_file():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_bounded_chunks_give_the_text_back_and_fit(spark, tokenizer_file):
    import random

    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_file)
    coder.encode_special_tokens = True
    r = random.Random(9)
    parts = ["word", " ", ". ", "\n", "\n\n", "é", "漢字", "🙂👩‍👩‍👧", "<|endoftext|>", "1234567", "\u0000", "x" * 40, "   ", "… "]
    texts = ["", "a", "🙂" * 50, "x" * 3000, " " * 500, "漢" * 300, "first. second. " * 200]
    texts += ["".join(r.choice(parts) for _ in range(r.randrange(400))) for _ in range(40)]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "id int, text string").withColumn("start", F.lit("mine"))
    for budget in (1, 7, 64):
        seen = {}
        for row in sorted(documents.bounded_chunks(df.drop("start"), "text", tokenizer_file, budget).collect(), key=lambda c: (c["id"], c["chunk"])):
            ids = len(coder.encode(row["content"], add_special_tokens=False).ids)
            assert row["tokens"] == ids and (ids <= budget or len(row["content"]) == 1)
            place = seen.setdefault(row["id"], [])
            assert row["start"] == sum(map(len, place)) and row["end"] == row["start"] + len(row["content"]) and row["chunk"] == len(place)
            place.append(row["content"])
        assert {n: "".join(p) for n, p in seen.items()} == {n: t for n, t in enumerate(texts) if t}
    sentences = [c["content"] for c in documents.bounded_chunks(df.where("id = 6").drop("start"), "text", tokenizer_file, 31).collect()]
    assert all(c.endswith(". ") for c in sentences) and len(sentences) > 10


def test_announcements_by_a_tokenizer(spark, tokenizer_file):
    from harbormill.plans.documents import announcement_chunks

    texts = spark.createDataFrame([("p", "S", "h", "k", "one two three. " * 30)], "path string, symbol string, headline string, document_key string, contents string")
    got = announcement_chunks(texts, 20, tokenizer_file)
    assert got.columns == announcement_chunks(texts).columns and got.count() >= 6
    assert "".join(r["page_content"] for r in got.collect()) == "one two three. " * 30


# --- declared keys ------------------------------------------------------------


def test_keys_with_differing_rows_are_an_error(spark):
    from harbormill.operators import joins

    good = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, 7), (None, "x", 1), (None, "y", 1)], "k int, v string, other int")
    assert rows(joins.one_row_per_key(good, "k", ["v"])) == [(1, "a"), (2, None)]
    assert rows(joins.one_row_per_key(good, "k", ["k"])) == [(1,), (2,)]
    bad = good.unionByName(spark.createDataFrame([(1, "b", 5)], good.schema))
    assert joins.repeated_keys(bad, "k", ["v"]).collect()[0][0] == 1 and joins.repeated_keys(good, "k", ["v"]).collect()[0][0] == 0
    assert rows(joins.one_row_per_key(bad, "k", ["k"])) == [(1,), (2,)]
    for read in (joins.one_row_per_key(bad, "k", ["v"]), joins.one_row_per_key(bad, "k", ["v"], F.col("k") == 2)):
        with pytest.raises(Exception, match="1 values of k stand with differing v"):
            read.collect()


def test_a_dimension_filter_reaches_the_scan(spark, sf_dir):
    from harbormill.operators import joins

    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    found = joins.one_row_per_key(customers, "c_custkey", ["c_mktsegment"], F.col("c_mktsegment") == "MACHINERY")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,MACHINERY)" in plan and "SortAggregate" not in plan
    assert 0 < found.count() < customers.count()


# --- many queries at once -----------------------------------------------------


def test_many_queries_give_what_each_gives_alone(spark):
    import random

    r = random.Random(2)
    data = [(n, [r.choice([-1.0, 0.0, 0.5, 2.0]) for _ in range(6)]) for n in range(120)]  # many equal scores
    data += [(200, None), (201, [0.0] * 6), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6), (204, [1.0] * 5), (205, []), (None, [1.0] * 6)]
    rows_ = spark.createDataFrame(data, "id int, embedding array<float>")
    queries = rows_.where("id % 10 = 0 or id > 199").withColumnRenamed("id", "q")
    got = {}
    for x in vectorsearch.top_k_many(rows_, queries, 9, "id", "q", block_rows=25, query_rows=3).collect():
        got.setdefault(x["q"], []).append((x["rank"], x["id"], x["score"]))
    asked = [n for n, v in data if n is not None and (n % 10 == 0 or n > 199)]
    assert set(got) == {n for n in asked if n < 200 and any(dict(data)[n])} | {204}
    good = rows_.where("id < 200 or id = 204").where(F.exists("embedding", lambda x: x != 0))
    for q in list(got)[:6]:
        alone = vectorsearch.top_k(good, dict(data)[q], 9, ties=["id"]).collect()
        assert sorted(got[q]) == [(n, x["id"], x["score"]) for n, x in enumerate(alone, 1)]
    assert vectorsearch.top_k_many(rows_, queries.limit(0), 3, "id", "q").count() == 0
    assert vectorsearch.top_k_many(rows_.limit(0), queries, 3, "id", "q").count() == 0


def test_blocks_grow_with_the_table_and_send_the_best_rows_only():
    # 360 times the small table: each vector used to travel 10,000 times, each query 3,600 times
    assert vectorsearch.blocks_of(72_360, 64, 7, vectorsearch.QUERY_NUMBERS) <= 20
    assert vectorsearch.blocks_of(720_000, 64, 200, vectorsearch.BLOCK_NUMBERS) <= 50
    assert vectorsearch.blocks_of(120, 6, 25, vectorsearch.BLOCK_NUMBERS) == 5 and vectorsearch.blocks_of(0, 1, 7, 1) == 1
    # a block holds no more of wide vectors than of narrow ones
    assert vectorsearch.blocks_of(720_000, 1536, 200, vectorsearch.BLOCK_NUMBERS) * vectorsearch.BLOCK_NUMBERS >= 720_000 * 1536
    # equal vectors, as from copies, and vectors that are equal but for their length
    block = pd.DataFrame({"_id": range(400), "_vector": [[1.0, 2.0]] * 200 + [[n + 1.0, 2 * n + 2.0] for n in range(100)] + [[1.0, float(n)] for n in range(100)]})
    block = block.sample(frac=1, random_state=3)
    asked = pd.DataFrame({"_id": [7, 8], "_vector": [[2.0, 4.0], [1.0, 90.0]]})
    found = vectorsearch._nearest_in_cell(3)(block, asked)
    assert len(found) == 6
    assert sorted(found["_row"][found["_query"] == 8]) == [389, 390, 391]
    assert list(found["_row"][found["_query"] == 7]) == _best_by_one(block, [2.0, 4.0], 3)


def _best_by_one(block, query, k):
    unit = np.array(query) / np.sqrt(sum(x * x for x in query))
    score = [(-(v[0] * unit[0] + v[1] * unit[1]) / np.sqrt(v[0] * v[0] + v[1] * v[1]), n) for n, v in zip(block["_id"], block["_vector"])]
    return [n for _, n in sorted(score)[:k]]


def test_slow_work_on_rows_of_one_file_is_dealt_over_all_cores(spark, tmp_path, tokenizer_file):
    spark.range(400).select("id", F.lit('<a href="x">t</a>').alias("html"), F.lit("a text").alias("text")).coalesce(1).write.parquet(f"{tmp_path}/one")
    landed = spark.read.parquet(f"{tmp_path}/one")
    chunks = documents.bounded_chunks(landed.select("id", "text"), "text", tokenizer_file, 31)
    for found in (html.links(landed.select("id", "html")), chunks):
        per_task = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("id").alias("n")).collect()]
        assert sum(per_task) == 400 and len(per_task) > spark.sparkContext.defaultParallelism and max(per_task) < 100
