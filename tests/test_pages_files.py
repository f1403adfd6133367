"""Page extraction on HTML fixtures and the file-zone sources."""

import os
import tempfile

from pyspark.sql import functions as F

from estatelake.sources import files, pages

DETAIL = """<html><head><meta property="og:title" content="OG title"></head><body>
<h1>Appartement <b>lumineux</b> &amp; calme</h1>
<div class="price"><span class="value">€ 325.000</span></div>
<table><tr><th>Living area</th><td>95 m²</td></tr><tr><th>Bedrooms</th><td>2</td></tr></table>
<dl><dt>Construction year</dt><dd>1998</dd><dt>EPC</dt><dd>B</dd></dl>
<ul><li>Postal code: 1030</li><li>City: Schaerbeek</li><li>no colon here</li></ul>
</body></html>"""
URL = "https://example.be/en/detail/apartment/for-sale/1030/schaarbeek/VBC1"
LEGACY = """<html><body><div class="detail__header_title_main">Apartment for sale</div>
<span class="detail__header_price_data">€ 250.000</span>
<div class="detail__header_address">Rue Royale 12, 1000 Brussels</div>
<h4>Number of bedrooms</h4><p>3</p><h4>Livable surface</h4><p> 110 m² </p></body></html>"""


def _pages(spark, html, url=URL):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_label_pairs(spark):
    got = {r["label"]: r["value"] for r in pages.label_pairs(_pages(spark, DETAIL)).collect()}
    assert got["living area"] == "95 m²" and got["bedrooms"] == "2"
    assert got["construction year"] == "1998" and got["epc"] == "B"
    assert got["postal code"] == "1030" and got["city"] == "Schaerbeek"


def test_listing_record(spark):
    r = pages.listing_records(_pages(spark, DETAIL), run_date="2025-01-01").collect()[0]
    assert r["title"] == "Appartement lumineux & calme"
    assert r["surface_m2"] == 95.0 and r["price"] == 325000.0
    assert r["bedrooms"] == 2 and r["year_built"] == 1998 and r["energy_label"] == "B"
    assert r["postal_code"] == "1030" and r["city"] == "Schaerbeek"
    assert r["property_type"] == "apartment" and r["is_sale"] is True


def _one(spark, html):
    return pages.listing_records(_pages(spark, html), run_date="2025-01-01").collect()[0]


def test_ordered_price_selectors(spark):
    assert _one(spark, '<div class="price"><span>Price</span><span class="value">250000</span></div>')["price"] == 250000.0
    assert _one(spark, "<div class=price>now<p>only<span class=value>250000")["price"] == 250000.0         # unclosed
    assert _one(spark, '<b class="value">7</b><div class="a PriceBox"><i>x</i> 125 000 &euro;</div>')["price"] == 125000.0
    assert _one(spark, '<div class="price"></div><i class="value">9</i><meta itemprop="price" content="99000">')["price"] == 99000.0
    assert _one(spark, '<div class="price"><div>a</div><div class="value">310000</div></div><b class="value">1</b>')["price"] == 310000.0


def _pairs(spark, html):
    return {r["label"]: r["value"] for r in pages.label_pairs(_pages(spark, html)).collect()}


def test_nested_and_unclosed_pairs(spark):
    assert _pairs(spark, "<table><tr><td>a<td>1<tr><td>b<td>2<td>3</table><li>c: 4<li>d : 5 : 6") == {"a": "1", "b": "3", "c": "4", "d": "5 : 6"}
    assert _pairs(spark, "<table><tr><td>out</td><td><table><tr><td>in</td><td>1</td></tr></table></td></tr></table>") == {"out": "in 1", "in": "1"}
    assert _pairs(spark, "<dl><dt>a<dd>1<dt>b<dd>2</dl><dl><dt>c</dt></dl><dl><dd>9</dd></dl>") == {"a": "1", "b": "2"}
    assert _pairs(spark, "<ul><li>x: <ul><li>y: 1</li></ul></li><li>z: 2</li></ul>") == {"x": "y: 1", "y": "1", "z": "2"}
    assert _pairs(spark, "</table></tr><tr><td>a</td><td title='<b>'>1 &lt; 2 &#233;&#xE9; m&sup2;</td></tr>") == {"a": "1 < 2 éé m²"}
    assert _pairs(spark, "<!-- <li>no: 1</li> --><script>var a='<li>no: 2</li>'</script><li>a: b</li><!-- open <li>no: 3") == {"a": "b"}
    assert _pairs(spark, "<li>a: 1</li><li>a: 2</li><li>: 3</li><li>e:</li>") == {"a": "2"}
    assert _pairs(spark, "") == {} and pages.label_pairs(_pages(spark, None)).count() == 0


def test_repeated_page_ids_do_not_mix(spark):
    df = spark.createDataFrame([(1, "u", "<li>a: 1</li><li>b: 1</li>"), (1, "u", "<ul><li>c: 2")], "page_id long, url string, html string")
    assert {r["label"] for r in pages.label_pairs(df).collect()} == {"a", "b", "c"}


def test_elements_take_linear_time(spark):
    import time
    for unit in ("<li>a: 1", "<a", "<table><tr><td>", "<!--", "<x '", "</td>"):
        t0 = time.time()
        pages.label_pairs(_pages(spark, unit * 4000)).count()
        assert time.time() - t0 < 30, unit


def test_legacy_value_is_the_next_paragraph(spark):
    html = "<h4>Number of bedrooms</h4><div><i></i></div><div><p>4</p></div><h4>Build Year</h4>"
    r = pages.legacy_records(_pages(spark, html, "u")).collect()[0]
    assert r["bedrooms"] == "4" and r["year_built"] is None


def test_legacy_record(spark):
    r = pages.legacy_records(_pages(spark, LEGACY, "u")).collect()[0]
    assert r["property_type"] == "Apartment" and r["price"] == "€ 250.000"
    assert r["postal_code"] == "1000" and r["city"] == "Brussels"
    assert r["bedrooms"] == "3" and r["surface_livable"] == "110 m²"


def test_outlinks(spark):
    html = ('<a href="/en/detail/house/for-sale/1000/brussels/1?x=1">a</a>'
            '<a href="#top">t</a><a href="https://www.example.be/en/search?q">s</a>'
            "<a href='/classified/9'>c</a>")
    got = sorted(r["url"] for r in pages.outlinks(_pages(spark, html)).collect())
    assert got == ["https://www.example.be/classified/9",
                   "https://www.example.be/en/detail/house/for-sale/1000/brussels/1"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_consolidate_and_compact(spark):
    day = tempfile.mkdtemp(prefix="day-")
    _write(f"{day}/apartments/t1/partial_urls_page_1_t1_r.csv", "URL\nhttps://x/apartment/1\nhttps://x/apartment/2\n")
    _write(f"{day}/apartments/t1/partial_urls_page_2_t1_r.csv", "href,page\nhttps://x/apartment/2,2\n")
    _write(f"{day}/apartments/t1/stats_t1.csv", "town,total\nt1,2\n")
    _write(f"{day}/legacy_r/urls.csv", "link\nhttps://x/apartment/3\nhttps://x/house/4\n")
    urls = sorted(r["url"] for r in files.consolidate_urls(spark, day, "apartments").collect())
    assert urls == ["https://x/apartment/1", "https://x/apartment/2", "https://x/apartment/3"]
    _write(f"{day}/apartments/details_a.csv", "url,price\nhttps://x/apartment/1,100\n")
    _write(f"{day}/apartments/details_b.csv", "url,price\nhttps://x/apartment/1,100\nhttps://x/apartment/2,90\n")
    d = files.compact_details(spark, f"{day}/apartments")
    got = sorted((r["url"], r["price"]) for r in d.collect() if r["price"] is not None)
    assert got == [("https://x/apartment/1", "100"), ("https://x/apartment/2", "90")]


def test_csv_quotes_width_and_paths(spark):
    day = tempfile.mkdtemp(prefix="day ") + "/2024 01"
    wide = ",".join(["url"] + [f"c{i}" for i in range(80)])
    _write(f"{day}/apartments/w.csv", wide + "\n" + ",".join(["https://x/apartment/1"] + [str(i) for i in range(80)]) + "\n")
    _write(f"{day}/apartments/q.csv", 'url,title\n"https://x/apartment/2","two\nlines, ""quoted"""\n')
    df = files.consolidate_urls(spark, day, "apartments")
    got = {r["url"]: r for r in df.collect()}
    assert set(got) == {"https://x/apartment/1", "https://x/apartment/2"} and got["https://x/apartment/1"]["c79"] == "79"
    assert got["https://x/apartment/2"]["title"] == 'two\nlines, "quoted"'


def test_label_pairs_per_list_and_unclosed_tags(spark):
    html = ("<dl><dt>A<dt>B<dd>1</dl><dl><dt>C</dt><dd>3</dd></dl><ul><li>Rooms: 2<li>Bath : 1</ul>"
            "<table><tr><td>Area<td>90<tr><td>Year<td>1999</table><ul><li>Rooms: 5</ul>")
    rows = pages.label_pairs(_pages(spark, html)).orderBy("ord").collect()
    assert [(r["label"], r["value"]) for r in rows] == [
        ("area", "90"), ("year", "1999"), ("a", "1"), ("c", "3"), ("rooms", "5"), ("bath", "1")]


def test_towns_seed_and_frontier(spark):
    p = tempfile.mkdtemp(prefix="towns-") + "/towns.csv"
    _write(p, " Gemeente ,x\nGent,1\n Leuven ,2\n")
    towns = files.towns_seed(spark, p)
    f = files.crawl_frontier(towns, "https://e.be/search?town={town}", -1)
    assert f.count() == 100
    assert f.where(F.col("page") == 2).orderBy("town").first()["url"] == "https://e.be/search?town=Gent&page=2"


def test_load_input_urls_and_read_details(spark):
    d = tempfile.mkdtemp(prefix="urls-")
    _write(f"{d}/c.csv", "only_col\nhttps://x/1\n\nhttps://x/2\n")
    got = sorted(r["url"] for r in files.load_input_urls(spark, f"{d}/c.csv", None).collect())
    assert got == ["https://x/1", "https://x/2"]
    p = f"{d}/details.parquet"
    spark.createDataFrame([("https://x/1", 1.0)], "url string, price double").write.parquet(p)
    df = files.read_details(spark, p, "apartments")
    assert df.collect()[0]["kind"] == "apartments"


def test_registry_routes_and_falls_back(spark):
    from estatelake.operators import ml
    from estatelake.session import shared_path
    from estatelake.sources import tpch
    from conftest import SF001
    lst = tpch.listing(spark, SF001).where(F.col("surface_m2").isNotNull())
    reg = ml.Registry(spark, shared_path(spark, "models-test"))
    num, cat = ml.select_feature_columns(lst, "price")
    reg.save(ml.fit_model(lst, "price", "linear", num, cat), "linear", "price", {}, True)
    req = lst.select("surface_m2", "bedrooms", "bathrooms", "year_built", "postal_code", "city",
                     "property_type", "energy_label", "region").limit(20)
    req = req.withColumn("surface_m2", F.when(F.col("bedrooms") % 2 == 0, F.col("surface_m2")))
    out = ml.auto_predict(req, reg).collect()
    assert len(out) == 20 and all(r["target"] == "price" for r in out)   # only a price model exists
    assert all(r["prediction"] > 0 for r in out)


def test_duplicate_runs_over_many_partitions(spark):
    import random
    rng, rows, want = random.Random(2), [], {}
    for run in ("a", "b", None, "long"):
        last, n = None, 0
        for page in range(400 if run == "long" else 25):
            urls = ["x", "y"] if run == "long" and 20 < page < 390 else rng.choice([["x", "y"], ["y", "x", "x"], ["z"], []])
            n = n + 1 if last is not None and set(urls) == last else 0
            last = set(urls)
            want[run, page] = n
            rows.append((run, page, urls, page))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "run string, page int, urls array<string>, first int").repartition(5)
    got = {(r["run"], r["page"]): r["dup_run"] for r in files.duplicate_page_runs(df, "run", "page", "urls").collect()}
    assert got == want and max(want.values()) > 300
    stopped = {(r["run"], r["page"]) for r in files.duplicate_page_runs(df, "run", "page", "urls", stop_after=10).collect()}
    ends = {run: min([p for (q, p), n in want.items() if q == run and n >= 10], default=10 ** 9) for run, *_ in rows}
    assert stopped == {(run, p) for run, p in want if p < ends[run]}


def test_union_skips_failures_and_reconciles_types(spark):
    import pytest
    a = spark.createDataFrame([(1, "x", None)], "i int, t string, d date")
    b = spark.createDataFrame([(2.5, 7, 3)], "I double, t long, only long")
    def broken():
        return spark.read.parquet("/nowhere/at/all")
    out = files.union_tolerant([a, broken, None, lambda: b])
    assert out.dtypes == [("i", "double"), ("t", "string"), ("d", "date"), ("only", "bigint")]
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, "x", None, None), (2.5, "7", None, 3)]
    with pytest.raises(FileNotFoundError):
        files.union_tolerant([None, broken])
