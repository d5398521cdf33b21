import html
import re

from pyspark.sql import functions as F

from wattgrade.llm import html_text
from wattgrade.llm.common import table
from wattgrade.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LONG = (
    "It was in the spring of that year that they went to the sea and saw how the ships were built by the men of the "
    "town, and it is from them that the story of the long way to the north was first heard by those who wrote it down."
)
MIDDLING = "Harbour towns traded copper, timber and amber with northern islands before roads existed in the region."
SHORT = "Only ships."


def texts(page: str) -> list[str]:
    return [b.text for b in html_text.blocks_of(page) if b.label == "good"]


def test_query_equals_the_marked_article(spark):
    """By another way: the given pages mark their article, whose blocks are cut out by patterns alone."""
    found = {r["page_id"]: r for r in QUERIES["op11_main_text"](spark, SF).collect()}
    pages = table(spark, SF, "pages").collect()
    assert len(found) == len(pages)
    for page in pages:
        body = re.search(r"<article>(.*?)(</article>|$)", page["html"], re.S).group(1)
        parts = [re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?p>|</?h1>", body)]
        parts = [re.sub(r"\s+", " ", html.unescape(p)).strip() for p in parts]
        want = "\n\n".join(p for p in parts if p)
        assert found[page["page_id"]]["text"] == want
        assert found[page["page_id"]]["n_chars"] == len(want)


def test_page_without_marked_article():
    page = f"""<html><head><title>Ships</title><style>p{{}}</style></head><body class="no-sidebar">
    <div id="top"><a href="/">Home</a> <a href="/a">About the town</a></div>
    <div class="text"><h2>Ships</h2><p>{LONG}</p><p>{SHORT}</p><p>{MIDDLING}</p><p>{LONG}</p></div>
    <div class="sidebar"><p>{LONG}</p></div>
    <div id="comments"><h3>Comments</h3><p>{LONG}</p></div>
    <form><p>{LONG}</p><input><button>Send</button></form>
    <div><a href="/1">One</a> | <a href="/2">Two</a></div><p>© 2020 The town</p></body></html>"""
    assert texts(page) == ["Ships", LONG, SHORT, MIDDLING, LONG]


def test_ambiguous_blocks_follow_their_neighbours():
    figures = "48 17 22 90 11 73 65 2048 4096 8192 16384 32768 65536 131072 262144 524288 1048576 2097152"
    page = f"<div><p>{LONG}</p><p>{SHORT}</p></div><div><p>{figures}</p><p>tail</p><p>{figures}</p></div>"
    assert texts(page) == [LONG, SHORT]
    # Inside an article figures and short blocks belong to it, whatever stands beside it.
    assert texts(f"<nav>{LONG}</nav><article><p>Be.</p><p>{figures}</p></article><footer>{LONG}</footer>") == ["Be.", figures]


def test_parts_of_an_article_that_are_not_its_text():
    page = f"""<article><header><h1>Title</h1></header><p>{LONG}</p><aside>{LONG}</aside><script>if (a<b) x="</p>"</script>
    <div class="ad-box">{LONG}</div><ul><li><a href=x>More of this</a></li><li><a href=y>And of that</a></li></ul>
    <p hidden>{LONG}</p><p>Last.</p><section class="reader-comments">{LONG}</section></article><p>{LONG}</p>"""
    assert texts(page) == ["Title", LONG, "Last."]


def test_markup_and_references():
    page = "<main><p>a &lt;b&gt; &amp;amp; &eacute;&nbsp;&#x41;&am <b>bold<i>er</i>\n\t text<br>line<p>x < y and 1<2<p>\ud83d\ude00</main>"
    page = page.encode("utf-16", "surrogatepass").decode("utf-16")
    assert texts(page) == ["a <b> &amp; é A&am bolder text line", "x < y and 1<2", "😀"]
    assert texts('<main><p title="a > b">one</p><p class="x>two</p><p>three</p></main>') == ["one", "two", "three"]
    assert texts("<main><p>one</p><!-- <p>no</p> --><p>two</p><p>three</p") == ["one", "two", "three"]


def test_defined_results_of_unusual_rows(spark):
    long = "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>"
    rows = [(1, None, 7), (2, "", 7), (3, "<nav>x</nav>", 7), (4, "<article><p>y", 7), (4, "<article><p>y", 7), (None, long, 7)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text long").withColumn("row", F.lit(1))
    found = html_text.extract(pages)
    got = sorted((r["row"]["page_id"] or 0, r["text"], r["n_chars"]) for r in found.collect())
    whole = "\n\n".join([LONG] * 3000)
    assert got == [(0, whole, len(whole)), (1, "", 0), (2, "", 0), (3, "", 0), (4, "y", 1), (4, "y", 1)]
    assert found.where("row.page_id = 3").first()["blocks"][0]["good"] is False
    assert html_text.extract(pages.limit(0)).count() == 0
