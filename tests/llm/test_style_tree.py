"""The site style tree against brute force, and pages that are long, deep or say nothing by their names."""

import math
import time
from collections import Counter, defaultdict

import pandas as pd
import pytest

from millrace.llm import htmltree

SCHEMA = "page_id bigint, url string, html string"


def importances(pages: list[str]):
    """Branch and block importances of the different pages of one host, recomputed from the parsed pages."""
    styles, blocks, below = defaultdict(Counter), Counter(), defaultdict(dict)
    for html in pages:
        found, shape, _ = htmltree.parse(html)
        for path, style in shape.items():
            styles[path][style] += 1
        for text, branch in {(t, tuple(b)) for t, b, _ in found}:
            blocks[branch[-1], text] += 1
            for path in branch:
                below[path][branch[-1], text] = True
    pages_of = {path: sum(c.values()) for path, c in styles.items()}
    content = {(leaf, t): 1 - (math.log(k) / math.log(pages_of[leaf]) if pages_of[leaf] > 1 else 0) for (leaf, t), k in blocks.items()}
    branches = {}
    for path, held in below.items():
        m = pages_of[path]
        entropy = -sum(n / m * math.log(n / m) for n in styles[path].values()) / math.log(m) if m > 1 else 1.0
        weight = sum(blocks[f] for f in held)
        branches[path] = 0.9 * sum(blocks[f] * content[f] for f in held) / weight + 0.1 * entropy
    return branches, content


def page(k: int, inner: str = "") -> str:
    body = "".join(f"<p>Paragraph {j} of page {k} tells of matter {k * 7 + j}.</p>" for j in range(k % 3 + 2))
    return f"<html><body><div class=q1>Same line everywhere</div><div class=q2>{body}{inner}</div><div class=q3><p>Line {k % 2}</p></div></body></html>"


def test_importances_equal_brute_force(spark):
    pages = [page(k) for k in range(14)]
    rows = [(k, "http://h.example/x", h) for k, h in enumerate(pages)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("page_id", "url", "'h' host", "html")
    parsed = df.mapInPandas(htmltree._parse_pages, htmltree._SCHEMA.format(id="bigint")).selectExpr("*", "page_id row")
    branches, content = htmltree.style_tree(htmltree.without_copies(parsed))
    want_branches, want_content = importances(pages)
    got = {r.path: r.importance for r in branches.collect()}
    assert got.keys() == want_branches.keys()
    assert all(got[p] == pytest.approx(want_branches[p]) for p in got)
    got = {(r.leaf, r.content): r.importance for r in content.collect()}
    want = {(leaf, htmltree._key(t)): v for (leaf, t), v in want_content.items()}
    assert got.keys() == want.keys() and all(got[f] == pytest.approx(want[f]) for f in got)


def test_tree_decides_where_names_say_nothing(spark):
    rows = [(k, "http://plain.example/x", page(k)) for k in range(40)]
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, text in got.items():
        assert text.split("\n") == [f"Paragraph {j} of page {k} tells of matter {k * 7 + j}." for j in range(k % 3 + 2)]


def test_tree_removes_branches_inside_a_main_container(spark):
    def html(k):
        return f"<body><article><p>Story {k} in its own words.</p><div class=z9><p>Offer {k % 2}</p></div></article></body>"
    rows = [(k, "http://many.example/x", html(k)) for k in range(200)]
    rows += [(1000 + k, "http://few.example/x", html(k)) for k in range(12)]
    got = {r.page_id: r.text for r in htmltree.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[k] == f"Story {k} in its own words." for k in range(200))
    assert all(got[1000 + k] == f"Story {k} in its own words.\nOffer {k % 2}" for k in range(12))  # too few pages to tell


@pytest.mark.parametrize("html, n", [
    ("<div>a" * 50_000, 50_000), ("<div>" * 50_000 + "a" + "</div>" * 50_000 + "<p>a", 2), ("<p><b>a" * 50_000, 50_000),
    ("<article>a" * 50_000, 50_000), ("<ul><li>a" * 50_000, 50_000), ("<div>" * 25_000 + "<dl><dt>a</dt></dl>" * 25_000, 25_000),
])
def test_pages_cost_their_length(html, n):
    start = time.time()
    blocks, _, _ = htmltree.parse(html)
    assert [t for t, _, _ in blocks] == ["a"] * n
    assert time.time() - start < 10


def test_deep_page_through_spark(spark):
    deep = "<article>" + "<div>" * 30_000 + "deep text" + "</div>" * 30_000 + "<p>after it</p></article><p>outside</p>"
    got = {r.page_id: (r.text, r.n_chars) for r in htmltree.extract(spark.createDataFrame(pd.DataFrame(
        [(1, "http://d.example/", deep), (2, "http://d.example/", "<p>flat")], columns=["page_id", "url", "html"]), SCHEMA)).collect()}
    assert got == {1: ("deep text\nafter it", 18), 2: ("flat", 4)}
