"""Many CSV layouts in one scan, and pages folded as tag streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ampere.sources import tag_stream
from ampere.sources.files import existing_paths, scan_fuel_csv, scan_hist_csv
from ampere.sources.html import element_texts, html_headings, html_list_items
from ampere.sources.lines import csv_cells

PAGES = "/root/testdata/sf0.01/pages.parquet"


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x"))).first()[0]


CELLS = [
    ("a,b,c", ["a", "b", "c"]), ("", [None]), (",", [None, None]), ("a,,c,", ["a", None, "c", None]), ('"a,b",c', ["a,b", "c"]),
    ('"say ""hi""",2', ['say "hi"', "2"]), ('""', [""]), ('5" pipe,6"', ['5" pipe', '6"']), (' "a" ,b', [' "a" ', "b"]),
    ("x" * 50000 + ',"' + "y," * 20000 + '"', ["x" * 50000, "y," * 20000]), ('"' + '""' * 5000 + '",z', ['"' * 5000, "z"]),
]


@pytest.mark.parametrize("i", range(len(CELLS)))
def test_cells(spark, i):
    line, want = CELLS[i]
    assert one(spark, csv_cells, line) == want


def test_a_cell_over_two_lines_is_an_error(spark):
    with pytest.raises(Exception, match="does not end in its line"):
        one(spark, csv_cells, 'a,"b')


def test_many_layouts_in_one_scan(spark, scratch):
    """2,000 small files with five layouts: one scan, no job while the plan is built."""
    layouts = [
        "Date,Hour,Nuclear,Gas,Total", " Date , Hour ,Gas,Nuclear,Total", "Hour,Date,Total,Nuclear", "Note,Date,Hour,Nuclear,Gas,Extra,Total", '"Date","Hour","Gas","Total"',
    ]
    os.makedirs(f"{scratch}/many")
    want = {}
    for i in range(2000):
        layout = layouts[i % 5]
        day, hour = dt.date(2020, 1, 1) + dt.timedelta(days=i // 24), i % 24 + 1
        cells = {"date": day.isoformat(), "hour": hour, "nuclear": i, "gas": i + 0.5, "total": 2 * i, "note": '"a, note"', "extra": "?"}
        names = [c.strip().strip('"').lower() for c in layout.split(",")]
        with open(f"{scratch}/many/{i:04d}.csv", "w") as f:
            f.write(layout + "\n" + ",".join(str(cells[n]) for n in names) + "\n")
        at = dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hour - 1)
        want[at] = (float(i) if "nuclear" in names else None, i + 0.5 if "gas" in names else None, 2.0 * i)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    df = scan_fuel_csv(spark, [f"{scratch}/many/*.csv"], ["nuclear", "gas", "total"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not tracker.getJobIdsForGroup("plan")
    # both branches (headers, lines) read the same files: two file scans in all, whatever the number of files
    assert plan.count("Scan text") == 2 and "Union" not in plan
    spark.sparkContext.setJobGroup("run", "run")
    got = {r.timestamp: (r.nuclear, r.gas, r.total) for r in df.collect()}
    assert got == want and len(tracker.getJobIdsForGroup("run")) <= 4
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_historical_files_of_any_layout(spark, scratch):
    os.makedirs(f"{scratch}/h")
    for name, text in (("2001", ",A , B\nr1,1,2\nr2,3,\n"), ("2002", ",C,A\nr1,9,8,extra\nr3,7\n\n"), ("2003", ",A\n")):
        with open(f"{scratch}/h/{name}.csv", "w") as f:
            f.write(text)
    df = scan_hist_csv(spark, [f"{scratch}/h/*.csv"], index="k", label="year")
    assert df.columns == ["k", "A", "B", "C", "year", "_row"]
    rows = [tuple(r)[:5] for r in df.orderBy("_row").collect()]
    assert rows == [("r1", "1", "2", None, "2001"), ("r2", "3", None, None, "2001"), ("r1", "8", None, "9", "2002"), ("r3", None, None, "7", "2002")]
    chosen = scan_hist_csv(spark, [f"{scratch}/h/*.csv"], index="k", columns=["C", "Z"])
    assert [tuple(r)[:3] for r in chosen.orderBy("_row").collect()] == [("r1", None, None), ("r2", None, None), ("r1", "9", None), ("r3", "7", None)]
    assert scan_hist_csv(spark, [f"{scratch}/none/*.csv"]) is None


def test_a_folder_is_listed_once(spark, scratch):
    os.makedirs(f"{scratch}/f")
    for n in ("a.csv", "b.csv"):
        open(f"{scratch}/f/{n}", "w").close()
    paths = [f"{scratch}/f/{n}.csv" for n in "abc"] + [f"{scratch}/f/*.csv", f"{scratch}/g/a.csv", f"{scratch}/f"]
    assert existing_paths(spark, paths) == [paths[0], paths[1], paths[3], paths[5]]


TEXTS = [
    ("p", "<p>a<p>b</p>", ["a", "b"]),
    ("p", "<p>a <b>bold<br>x</b> c</p>out<p class='x>y'>d", ["a boldx c", "d"]),
    ("p", "<div><p>a</div><ul><li>no</ul><p>b<h2>no</h2>", ["a", "b"]),
    ("p", "<!-- <p>no</p> --><script>'<p>no</p>'</script><style>p{}</style><p>a<!-- <p> -->b</p>", ["ab"]),
    ("p", "<pre>no</pre><param><p/>a</p>", ["a"]),
    ("p", "<P>a &amp;amp; b &lt;c&gt; &#65;&#x1F600;&eacute;&nbsp;&hellip; &unknown; &amp</P>", ["a &amp; b <c> A\U0001f600é\xa0… &unknown; &amp"]),
    ("p", "<p>1 < 2 > 0</p>", ["1 < 2 > 0"]),
    ("p", "<p></p><p>", ["", ""]),
    ("h1", "<h1>A</h1><h1>B<h2>C</h2><h1>D</h3>x</h1>", ["A", "B", "D"]),
    ("h1", "<h1><a href=x>A</a> &copy;</h1>", ["A ©"]),
    ("li", "<ul><li>a<li>b</ul>c", ["a", "b"]),
    ("td", "<table><tr><td>1<td>2<tr><th>h<td>3</table>4", ["1", "2", "3"]),
    ("em", "<p><em>x</em> y <em>z</p>", ["x", "z"]),
    ("p", "", []), ("p", "no tags", []), ("p", None, None), ("p", "<p>a<!-- open", ["a"]), ("p", "<p>a<p", ["a"]),
]


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_element_texts(spark, i):
    tag, page, want = TEXTS[i]
    got = spark.createDataFrame([(page,)], "html string").select(element_texts("html", tag)).first()[0]
    assert got == want


def test_list_links(spark):
    page = (
        "<ul><li><a href='/a?x=1&amp;y=2'>A &amp; <b>B</b></a><li> <a class=c href=/b>b</li><li>text <a href=/no>no</a>"
        "<li><b><a href=/no>no</a></b></li><li><!-- c --><a href=\"/c\">c<li><a name=x>no</a></ul><a href=/no>no</a>"
    )
    got = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert [(r.href, r.text) for r in html_list_items(got).collect()] == [("/a?x=1&y=2", "A & B"), ("/b", "b"), ("/c", "c")]


def test_references_of_every_kind(spark):
    text = "&#0;&#xD800;&#1114112;&#99999999999;&notaname;&&amp;&lt;"
    assert one(spark, tag_stream.decode_references, text) == "����&notaname;&&<"
    assert one(spark, tag_stream.decode_references, "plain") == "plain" and one(spark, tag_stream.decode_references, None) is None


@pytest.mark.skipif(not os.path.isfile(PAGES), reason="driver test data not present")
def test_every_paragraph_of_the_pages(spark):
    pages = spark.read.parquet(PAGES)
    n = pages.select(F.sum(F.size(element_texts("html", "p")))).first()[0]
    starts = sum(r.html.count("<p>") for r in pages.collect())
    assert n == starts == 2358
    left = pages.select(F.explode(element_texts("html", "p")).alias("t")).where("t like '%&amp;%' or t like '%<p%'")
    assert left.count() == 0
    assert html_headings(pages).count() == pages.count()
