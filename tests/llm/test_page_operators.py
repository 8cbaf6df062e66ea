"""Main text, WARC and exact search on small tables with edge cases."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixmart.llm import boost, pages, topk, warc
from helixmart.session import scratch_path

PAGES = "page_id long, url string, html string, text string"

ARTICLE = """<!DOCTYPE html><html><head><title>No</title><style>p{x:"</p>"}</style><script>var t="<p>no</p>"</script></head><body>
<header class="masthead"><h1>The Site</h1><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies to do all sorts of things. Accept them.</p><button>Ok</button></div>
<main><article><h1>A &amp; B &lt;report&gt;</h1>
<p>First   paragraph,
 with <b>bold</b> and a <a href=x>link</a>.<p>Second one is not closed
<blockquote>A quote &copy; 2020.</blockquote>
<div class="ad">Buy this thing now. It is cheap.</div>
<ul><li>one point<li>another point</ul>
</article>
<section id="comments"><h3>Comments</h3><div>I do not agree with any of this text. It is all wrong, and it was wrong before.</div></section></main>
<aside class="sidebar"><h3>Related</h3><ul><li><a href=1>Story</a></ul></aside>
<form><label>Search</label><input></form><!-- <p>hidden</p> -->
<footer>&copy; The Site. All rights reserved.</footer>"""
MAIN = "A & B <report>\nFirst paragraph, with bold and a link.\nSecond one is not closed\nA quote © 2020.\none point\nanother point"


def test_main_text(spark):
    plain = "<html><body><article>" + "<p>Long text. </p>" * 5000 + "</article></body></html>"
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (2, None, None, None), (3, "", "", ""), (4, "u", "<nav><a href=1>only</a></nav>", ""), (5, "u", plain, ""), (6, "u", "<article><p>cut &am", ""), (7, "u", "<!-- <p>open", "")]
    got = pages.extract(spark.createDataFrame(rows, PAGES)).select("page_id", "text").collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 8 and texts[1] == MAIN and [texts[i] for i in (2, 3, 4, 7)] == [""] * 4
    assert texts[5].count("\n") == 4999 and texts[6] == "cut &am"
    assert pages.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_attributes_are_read_one_by_one():
    text = "This is a long sentence of the article. Here is one more of them. "
    for attributes in ['data-title="The hidden cost of x"', "title='A hidden gem'", "hiddenfield=1", 'alt="x" data-x="style=display:none"', 'title="a > b"', 'data-a=x"']:
        node = pages.parse(f"<article {attributes}><p>{text}</p></article>").children[0]
        assert not node.hidden and [n.tag for n in node.children] == ["p"] and not node.own, attributes
    for attributes in ["hidden", 'HIDDEN=""', "id=a hidden class=b", "style='display: none'", 'aria-hidden="true"', "/hidden"]:
        assert pages.parse(f"<article {attributes}><p>{text}</p></article>").children[0].hidden, attributes
    stray = pages.parse('<p>one <a href="x"">two</a> three</p><p class=y>"four"</p>')
    assert ["".join(n.items) for n in stray.children] == ["one two three", '"four"'] and stray.children[0].links == 3
    assert pages.parse("<a x=" * 1_000).own == 5_000


def test_formulas_and_fallback_text():
    formula = '<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding="t">\\x</annotation></semantics></math>'
    line = "This is a long sentence of the article, and it says something. Here is one more of them. "
    page = f"<article><p>{line}Let {formula} hold. {line}</p><object><p>{line}</p></object><p>{line}</p></article>"
    long = line.strip()
    assert pages.main_text([page], pages.model()) == [f"{line}Let x=2 hold. {long}\n{long}\n{long}"]


def test_held_out_nodes_and_agreement():
    rng, trees = random.Random(123), pages.model()
    wrong = total = 0
    for _ in range(120):
        source = pages.training_page(rng)
        import re

        order, x = pages.features(pages._marked(re.sub(r"<(\w+)([^<>]*) data-drop>", r'<\1\2 style="--drop">', source)))
        kept = pages.decode(order, trees.margin(x))
        place = {id(n): i for i, n in enumerate(order)}
        assert all(n.parent is None or place[id(n.parent)] in kept for i, n in enumerate(order) if i in kept)
        for i, n in enumerate(order[1:], 1):
            if n.own:
                total += 1
                wrong += (i in kept) == bool(n.label)
    assert wrong < 0.02 * total


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 5))
    y = ((x[:, 0] > 0.6) ^ (x[:, 3] > 0.5)).astype(float)
    model = boost.BoostedTrees(trees=40).fit(x[:2000], y[:2000])
    assert ((model.margin(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.97


def test_warc_round_trip(spark):
    fake = "text WARC/1.1\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n more"
    rows = [(i, f"http://x/{i}", html) for i, html in enumerate(["a" * 50, "ü" * 70_000, fake, "", None, fake, "x\r\n\r\n", "WARC/1.1\r\n", "same", "same", "same"])]
    rows += [(8, "http://x/8", "same"), (None, None, "same"), (None, "u", "alone"), (70, "bad\r\nurl", "q"), (71, None, "WARC/1.1\r\n" * 40)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, value string").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write(warc.plan_records(df, "page_id", "url", "html", 0), path, records_per_file=4)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.replay(spark, path).collect()), key=repr)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = first.get(html or "") not in (i, None)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first[html or ""] if again else None))
    assert got == sorted(want, key=repr)
    texts = [r["payload"] for r in warc.read(spark, path).where("record_type = 'response'").collect()]
    assert fake in texts and "WARC/1.1\r\n" * 40 in texts
    assert all(r["intact"] for r in warc.replay(spark, path).where("record_type = 'response'").collect())


def test_warc_of_small_payloads_and_no_rows(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.archive(df, path, least=3)
    assert {r["page_id"]: r["record_type"] for r in warc.replay(spark, path).collect()} == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    path = scratch_path(spark, "warc-test")
    warc.archive(df.limit(0), path)
    assert warc.replay(spark, path).collect() == []


@pytest.mark.parametrize("scale,spread", [(1, 1.0), (0.001, 1.0), (3, 1e4)])
def test_top_k(spark, scale, spread):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(5, 24))
    x = (centres[rng.integers(0, 5, 700)] + 0.3 * rng.normal(size=(700, 24))) * scale * spread
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x.astype(np.float32))]
    rows += [(1000, rows[100][1]), (1001, rows[100][1]), (1002, None), (1003, [float("nan")] * 24), (1004, [None] * 24), (1005, [1.0] * 3), (None, rows[0][1]), (1100, [float("inf")] * 24), (1200, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0).collect()))
    whole = [(i, np.floor(1024 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = []
    for q, v in whole:
        if q % 100 == 0:
            best = sorted((-int(sum(int(a) * int(b) for a, b in zip(v, w))), i) for i, w in whole if i != q and len(w) == len(v))[:10]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_top_k_of_no_rows(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect() == []
