"""Main text of hand-written pages, of pages that mark nothing, and of the
given pages against the oracle."""

import duckdb
import numpy as np
import pytest

from ampere.llm import maintext as M

P1 = "The council met on Tuesday, and after a long debate it voted for the new bridge; work begins in May."
P2 = "Opponents had asked for a tunnel. They argued that a bridge would harm the river's birds, fish and plants."
P3 = "Short one."
NAV = "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav>"
FOOT = "<footer>&copy; 2024 A very long legal notice, with commas, and many words; it never ends, does it? No, it does not.</footer>"


def page(body, head="<title>Title, of the page.</title><style>p{margin:0}</style><script>var a='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html lang=en><head>{head}</head><body>{body}</body></html>"


CASES = [
    (page(f"{NAV}<article><h1>Bridge &amp; river</h1><p>{P1}</p><p>{P3}</p></article>{FOOT}"), ["Bridge & river", P1, P3]),
    # unclosed and implied ends, line breaks, inline markup, white space
    (page(f"{NAV}<article><h1>T</h1><p><b>{P1}<br><p>One\n  <i>two</i>\tthree<br>four</p></article>{FOOT}"), ["T", P1, "One two three four"]),
    (page(f"<article><ul><li>a<li>b</ul>tail<table><tr><td>1<td>2<tr><td>3</table></article>"), ["a", "b", "tail", "1", "2", "3"]),
    (page(f"<article><p>{P1}"), [P1]),
    # references: without a semicolon, numeric, cut short
    (page("<article><p>a&amp;lt;b &lt;c&gt; &#39;&#x41;&quot; &eacute;&nbsp;x &amp</p><p>&am</p></article>"), ["a&lt;b <c> 'A\" é x &", "&am"]),
    # comments, scripts, forms, adverts and reader comments within the article
    (
        page(
            f"<article><header><h1>T</h1><span>By me</span></header><!-- <p>gone</p> --><p>{P1}</p><div class='ad-box'>Buy, buy, buy!</div>"
            f"<script>1<2</script><form><p>Mail?</p></form><aside>more</aside><p>{P2}</p><section id=comments><article><p>{P1} nice!</p></article></section></article>"
        ),
        ["T", P1, P2],
    ),
    (page(f"<div class='page has-sidebar'><main><div><p>{P1}</p></div></main><div class=sidebar><p>{P2}</p></div></div>"), [P1]),
    (page(f"<article class=teaser><p>x, y.</p></article><article><p>{P1}</p><p>{P2}</p></article>"), [P1, P2]),
    (page(f"<form action=/><article><p>{P1}</p></article></form>"), [P1]),
    # no element marks the article
    (
        page(
            f"<div><a href=/>Home</a> <a href=/b>Blog</a></div><div><h2>Head</h2><p>{P1}</p><p>{P3}</p><p>{P2}</p></div>"
            "<div><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li><li><a href=/3>Three</a></li></ul></div><div>Imprint</div>"
        ),
        ["Head", P1, P3, P2],
    ),
    (page(f"<table><tr><td><a href=/>x</a></td><td><p>{P1}</p><p>See <a href=/y>the long report of the council</a>, page 3.</p><p>{P2}</p></td></tr></table>"), [P1, "See the long report of the council, page 3.", P2]),
    (page("<p>Hi</p>"), ["Hi"]),
    ("plain words only", ["plain words only"]),
    (page(NAV + FOOT), []),
    (page("<article></article>"), []),
    ("<article><p>a</p></article", ["a"]),
    ("<script>never closed <article><p>x</p></article>", []),
    ("", []), (None, []), (" \n", []), ("<", ["<"]), ("<p", []), ("<p>1 < 2", ["1 < 2"]),
    ("<article><p>a</p><!-- cut <p>b</p>", ["a"]), ("<article><p>a</p><!-- b --><p>c</p>", ["a", "c"]),
]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cases(i):
    html, want = CASES[i]
    assert M.main_text(html) == "\n\n".join(want)


def test_long_and_deep_pages():
    text = "\n\n".join(f"Paragraph {i}, with a comma." for i in range(30000))
    html = "<article>" + "".join(f"<p>{t}</p>" for t in text.split("\n\n")) + "</article>"
    assert len(html) > 1 << 20 and M.main_text(page(html)) == text
    assert M.main_text("<div>" * 5000 + P1) == P1


def test_paths_that_reach_the_threshold():
    lengths = np.array([5, 5, 5, 90, 4, 80, 95, 6, 6], dtype=float)
    marks = np.array([0, 0, 0, 3, 0, 2, 3, 0, 0], dtype=float)
    paths = [1, 1, 1, 2, 2, 2, 2, 3, 3]
    scores = M.fused_scores(paths, lengths, marks, sigma=0.3)
    assert scores.max() == 1 and M.content_paths(paths, scores) == {2}
    assert M.content_paths([], M.fused_scores([], lengths[:0], marks[:0])) == set()
    assert M.content_paths([7], M.fused_scores([7], lengths[:1], marks[:1])) == {7}
    # the marked article decides whatever the ratios are
    inside = np.array([1, 0, 0, 0, 0, 0, 0, 0, 0])
    assert M.content_paths([9, 1, 1, 2, 2, 2, 2, 3, 3], scores + M.MARKED * inside) == {9}


def test_table(spark):
    rows = [(i, f"u{i}", html) for i, (html, _) in enumerate(CASES)] + [(0, "u0", CASES[0][0]), (None, None, CASES[0][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS block")
    got = M.op11_main_text(df.repartition(2)).collect()
    want = [(i, u, M.main_text(h), len(M.main_text(h))) for i, u, h in rows]
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert M.op11_main_text(df.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_oracle(spark, sf):
    path = f"/root/testdata/{sf}/pages.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}')")
    got = sorted(tuple(r) for r in M.op11_main_text(spark.read.parquet(path)).collect())
    assert got == sorted(con.execute(M.ORACLE).fetchall())
