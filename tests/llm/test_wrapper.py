import html
import random
import re
from pathlib import Path

from snapfeed.llm import wrapper
from snapfeed.session import ensure_checkpoint_dir, read_table
from llm_cases import SF_SMALL

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><main><article class="post">
<header class="post-header"><h1>Title &amp; more</h1></header><div class="notice">Note!</div><p>One <b>bold</b> text<p>Two &eacute;<br>lines<ul><li>a<li>b</ul>
<form><input><p>Form</form><table><tr><td>x<td>y</table><div class="share-buttons">Share</div><script>if(a<b){"</p>"}</script><!-- c --><p title="a > b">Three
<span class="ad">BUY</span>end</p></article><section class="comments"><article class="comment">Nice</article></section></main><aside>side</aside><footer>F</footer>"""


def texts(source):
    return [t for _, t, _ in wrapper.Page(source).blocks]


def test_blocks_of_a_page():
    assert texts(PAGE) == ["Title & more", "One bold text", "Two é lines", "a", "b", "x", "y", "Three end"]
    assert texts("") == [] and texts("plain <b>x") == ["plain x"] and texts("a < b & c") == ["a < b & c"]
    assert texts("<div>" * 5000 + "deep") == ["deep"]
    assert texts("<p>a<script>x") == ["a"] and texts("<p>a<!-- never closed <p>b") == ["a"]
    assert texts('<p hidden>no<p style="display: none">no<p role="alert">no<p>yes') == ["yes"]


def tree(text):
    """Indented lines to a skeleton."""
    return wrapper.parse_skeleton("\n".join(f"{(len(x) - len(x.lstrip())) // 1} {x.strip()}" for x in text.split("\n")))


def test_simple_tree_matching():
    a = tree("r\n a\n  x\n b\n c\n  y\n  z")
    b = tree("r\n a\n  w\n c\n  z\n d")
    assert wrapper.match(a, b, {})[0] == 4  # r, a, c, z
    wrapper.merge(a, b)
    assert wrapper.write_skeleton(a) == wrapper.write_skeleton(tree("r\n a\n  x\n  w\n b\n c\n  y\n  z\n d"))
    a = wrapper.parse_skeleton(wrapper.write_skeleton(a))
    lines = wrapper.write_skeleton(a).split("\n")
    assert [lines[i] for i in wrapper.align(a, b)] == wrapper.write_skeleton(b).split("\n")


def test_constant_slots_go(spark):
    """Same-host pages without telling names: the slots that repeat are template."""
    pages, much = [], " and so on with more to tell" * 6  # template is a small part of a page
    for i in range(30):
        pages.append((i, f"http://h.test/{i}", f"<body><div class=k1>Welcome to us</div><div class=k2><p>Story {i} begins{much}<p>and goes on {i * 7}</div><div class=k3>Read our terms {i % 2}</div></body>"))
        pages.append((100 + i, f"http://g.test/{i}", f"<article><p>Only {i}{much}</p><div class=zz>Like this? Tell a friend</div><p>More of {i * 3}</p></article>"))
    pages += [(200, None, "<p>alone"), (201, "http://one.test/", "<p>single page"), (202, "x", None), (202, "x", ""), (None, "http://h.test/x", "<div class=k2><p>odd")]
    df = spark.createDataFrame([(*p, "s") for p in pages], "page_id long, url string, html string, slot string")
    rows = wrapper.extract(df).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    assert got[3] == f"Story 3 begins{much}\n\nand goes on 21" and got[104] == f"Only 4{much}\n\nMore of 12"
    assert got[200] == "alone" and got[201] == "single page" and got[202] == "" and got[None] == "odd"
    assert wrapper.extract(df.where("false")).count() == 0


def test_given_pages(spark):
    pages = read_table(spark, SF_SMALL, "pages")
    got = {r.page_id: r.text for r in wrapper.extract(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|<footer|$)", p.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[p.page_id] == "\n\n".join(x for x in parts if x)


def test_hints_are_votes(spark):
    """Hinted wrappers, text outside of the article and small articles beside it keep their varying text."""
    pages, much = [], " and so on with more to tell" * 6
    for i in range(12):
        story = f"<h1>Head {i}</h1><p>Story {i} begins{much}"
        pages += [(i, f"http://wrap.test/{i}", f"<nav>Go {i}</nav><div class='content-sidebar-wrap'><article>{story}</article><aside>Aside {i}</aside></div><div>All rights</div>"),
                  (100 + i, f"http://form.test/{i}", f"<form><div class='page sidebar-right'>{story}<p>Then <span class=ad>buy {i}</span> more</div></form><footer>Foot {i}</footer>"),
                  (200 + i, f"http://teaser.test/{i}", f"<article>Short {i}</article><div id=story>{story}</div><div>Terms of use</div>")]
    pages += [(300, "http://few.test/", f"<nav>Go</nav><div class='content-sidebar-wrap'><article><p>One{much}</article><aside>no</aside></div><p>out"),
              (400, "http://two.test/", f"<article>Small</article><div><p>Much{much}</div><footer>no</footer>")]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(12):
        story = f"Head {i}\n\nStory {i} begins{much}"
        assert got[i] == story
        assert got[100 + i] == f"{story}\n\nThen more"
        assert got[200 + i] == f"Short {i}\n\n{story}"
    assert got[300] == f"One{much}" and got[400] == f"Small\n\nMuch{much}"


def test_copies_count_once(spark):
    """A host of copies of one article keeps it whole; copies beside other articles don't make slots constant."""
    pages, much = [], " and so on with more to tell" * 6

    def page(i, host, n, at):
        return i, f"http://{host}.test/{i}", f"<nav>Go {at}</nav><article><h1>Head {n}</h1><ul><li>Point {n}</ul><p>Story {n}{much}</p><div class=zz>Tell a friend</div></article><div>Seen in {n}</div>"

    pages += [page(i, "one", 0, i) for i in range(40)]
    pages += [page(100 + 60 * n + i, "many", n, i) for n in range(10) for i in range(60)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == len(pages)
    for i in range(40):  # one article: nothing to compare it with
        assert got[i] == f"Head 0\n\nPoint 0\n\nStory 0{much}\n\nTell a friend"
    for n in range(10):
        assert {got[100 + 60 * n + i] for i in range(60)} == {f"Head {n}\n\nPoint {n}\n\nStory {n}{much}\n\nSeen in {n}"}


def test_headings_that_all_pages_share_stay_in_the_article(spark):
    """Constant headings and lines between varying blocks, and constant words in a block of its
    own text, are article text; constant runs at the article's edges and constant divs are not."""
    much = " and so on with more to tell" * 4
    pages = [(i, f"http://cook.test/{i}", f"<nav>Go</nav><article><div class=aa>Our kitchen</div><h1>Dish {i}</h1><h2>Ingredients</h2><ul><li><b>Salt:</b> {i} g<li>Pepper {i}</ul>"
              f"<h3>Method</h3><p>Stir dish {i}{much}</p><p>Serve.</p><div class=yy>Buy now</div><p>Taste of {i}{much}</p><div class=zz>Tell a friend</div></article><footer>Foot</footer>") for i in range(30)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == f"Dish {i}\n\nIngredients\n\nSalt: {i} g\n\nPepper {i}\n\nMethod\n\nStir dish {i}{much}\n\nServe.\n\nTaste of {i}{much}"


def test_texts_are_neither_stored_nor_shuffled(spark, monkeypatch):
    """Between the steps only hashes, sizes and lines to drop are written; the texts are not dealt
    out where those lines are few, and give the same rows where they are too many to broadcast."""
    draw = random.Random(4)
    pages = [(i, f"http://long.test/{i}", f"<div class=k1>Welcome</div><div class=k2><p>Story {i} {draw.randbytes(10_000).hex()}</div>") for i in range(20)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    wrote = []

    def stored(frame, *args, keep=wrapper.stored):
        out = keep(frame, *args)
        wrote.append(sum(f.stat().st_size for file in out.inputFiles() for f in [Path(file.removeprefix("file://"))]))
        return out

    monkeypatch.setattr(wrapper, "stored", stored)
    out = wrapper.extract(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert sum(wrote) < 10_000 * len(pages) / 2 and not list(Path(ensure_checkpoint_dir(spark).removeprefix("file:")).glob("parsed-*/*.parquet"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    got = sorted(map(tuple, out.collect()))
    assert [r[2] for r in got] == [re.search("<p>(.*)</div>", p[2])[1] for p in pages]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = wrapper.extract(df)
        assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, merged.collect())) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
