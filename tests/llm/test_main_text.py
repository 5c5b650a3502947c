import time

import numpy as np
import pytest

from logweave.llm.main_text import extract_text, main_blocks, op11_html_extraction

LONG = "The first words of a long paragraph, with commas, and a full stop. Then another sentence follows; it ends here."


def sentences(rng, n):
    return " ".join(f"Word{rng.integers(99)} and {'some ' * int(rng.integers(1, 9))}more, it says." for _ in range(n))


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html><head><title>T &amp; t</title><style>p > a {{}}</style><script>var t="</p>";</script></head>
      <body class="has-sidebar"><header><h1>Site</h1>{LONG}</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- {LONG} -->
      <div class="cookie-notice"><p>{LONG}</p></div><div id="page"><div class="post-content"><h2>A  heading</h2>
      <p>One &lt;b&gt; &eacute;&#233;&#x20AC;&nbsp;two<br>three <a href=x>four</a> <b>five</b>six.<p>{LONG}</p>
      <ul><li>item one<li>item <i>two</i></ul><p>End.</p><div class="share"><a>share</a></div></div></div>
      <aside><p>{LONG}</p></aside><form><p>{LONG}</p><textarea>{LONG}</textarea></form><section id="comments"><article><p>{LONG}</p></article></section>
      <div class=advert><p>{LONG}</p></div><footer>&copy; {LONG}</footer></body></html>"""
    assert main_blocks(page) == ["A heading", "One <b> éé€ two three four fivesix.", LONG, "item one", "item two", "End."]


def test_paths_decide_without_names():
    rng = np.random.default_rng(2)
    for _ in range(60):
        links = "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(int(rng.integers(3, 40))))
        paragraphs = [sentences(rng, int(rng.integers(1, 12))) for _ in range(int(rng.integers(4, 20)))] + ["Short.", sentences(rng, 9)]
        body = "".join(f"<p>{x}</p>" for x in paragraphs)
        page = f"<body><div><ul>{links}</ul></div><div><div><h1>Title</h1>{body}</div><ul>{links}</ul></div><div><span>c 2020 Somebody</span></div>"
        assert main_blocks(page) == ["Title", *(" ".join(p.split()) for p in paragraphs)]


@pytest.mark.parametrize("page, blocks", [
    ("", []), ("   \n", []), ("plain text", ["plain text"]), ("a < b &amp c &am", ["a < b & c &am"]), ("<p>x<p>y", ["x", "y"]), ("<p>x</p", ["x"]),
    ("<p>x<!-- never closed <p>y", ["x"]), ("<p>x<script>y", ["x"]), ("<SCRIPT>a</Script ><P>b", ["b"]), ("<!--><p>x", ["x"]), ("<p a=\"1>2\" b='<p>'>x", ["x"]),
    ("<p title=it's>x</p><p>y's", ["x", "y's"]), ("<p>x</b>y</div>z", ["xyz"]), ("<div>a<p>b</div>c", ["a", "b", "c"]), ("x</p>y", ["x", "y"]), ("<p>a<", ["a<"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]), ("<nav>a</nav>", []), ("<article></article><div class=ad>Some, text. More.</div>", []),
    ("<div class=widget><h1>T</h1><p>x</p></div>", ["T", "x"]), ("<form><main><p>x</p></main><p>y</p></form>", ["x"]), ("<form>x</form>", []),
    ("<article><header><h1>T</h1></header><p>x</p><footer>y</footer></article>", ["T", "x"]), ("<p>a\x00\u2003b\tc", ["a\x00 b c"]), ("<?php ?><p>x</>y", ["xy"]),
    ("<body><p>x</body></html><p>y", ["x", "y"]), ("<article>Only <a>linked</a></article>", ["Only linked"]), ("<article><p><a>All of it is a link</a></p></article>", ["All of it is a link"]),
])
def test_pages(page, blocks):
    assert main_blocks(page) == blocks


def test_unclosed_bold_and_entities():
    page = "<body><nav><a>x</a></nav><div class=\"ad\">Buy, now. Or never.</div><article><h1>Ab&amp;</h1><p><b>Ab&amp; c.<br><p>D.</p><p><b>E<br></article><footer>F. G.</footer>"
    assert main_blocks(page) == ["Ab&", "Ab& c.", "D.", "E"]


def test_time_follows_length():
    def took(page):
        t = time.process_time()
        main_blocks(page)
        return time.process_time() - t

    for unit in ("<div>x", "<b>x", "<p>x", "<a href=\"", "<", "</i><i>", "<li>x", "<h1 class=ad>", "<article class=sidebar>", "<!", "&#x", "x</p>", "<td>", "<ul><li>y"):
        assert took(unit * 40000) < 12 * took(unit * 8000) + 1, unit


def test_table(spark, tmp_path):
    rows = [(1, "u1", f"<article><p>{LONG}</p><p>x</p></article>"), (2, None, None), (3, "u3", ""), (None, "u4", "<p>é\U0001F600</p>"), (None, "u4", "<p>é\U0001F600</p>"),
            (5, "u5", "<article>" + f"<p>{LONG}</p>" * 20000)]
    pages = spark.createDataFrame([(*r, "t", 7, "z") for r in rows], "page_id long, url string, html string, text string, N_CHARS int, blocks string").repartition(3)
    out = extract_text(pages)
    assert out.columns == ["page_id", "url", "html", "blocks", "text", "n_chars"]
    got = sorted((r.url or "", r.text, r.n_chars) for r in out.collect())
    long = "\n\n".join([LONG] * 20000)
    assert got == sorted([("u1", f"{LONG}\n\nx", len(LONG) + 3), ("", "", 0), ("u3", "", 0), ("u4", "é\U0001F600", 2), ("u4", "é\U0001F600", 2), ("u5", long, len(long))])
    assert extract_text(pages.limit(0)).count() == 0
    assert [r.text for r in extract_text(spark.createDataFrame([("<p>a",)], "text string"), html="text").collect()] == ["a"]
    pages.select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    assert op11_html_extraction(spark, str(tmp_path)).columns == ["page_id", "url", "text", "n_chars"]
