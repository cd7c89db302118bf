from carepanel.llm import html_text, queries
from carepanel.llm.html_text import main_text

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var s='</p>';</script></head><body>"
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav><header>Site name</header>"
    "<div class='ad'>Buy now cheap</div><!-- ad --><article><h1>Title &amp; more</h1><p><b>Lead.<br><p>First   paragraph\n"
    "with  space and &eacute;t&eacute; and &#x263A;.</p><p>Short.</p><aside>Side links</aside>"
    "<div class='comments'>Reader: nice</div></article><form>Sign up</form><footer>&copy; 2024</footer></body></html>"
)


def test_article_blocks_in_page_order():
    assert main_text(PAGE) == "Title & more\n\nLead.\n\nFirst paragraph with space and été and ☺.\n\nShort."


def test_edges_have_defined_results():
    assert main_text(None) == ""
    assert main_text("") == ""
    assert main_text("   ") == ""
    assert main_text("<script>x</script>") == ""
    assert main_text("plain   words\n here") == "plain words here"
    assert main_text("<p>a</b></div></p></p>b") == "a\n\nb"
    assert main_text("<div><p>x</div>") == "x"


def test_link_lists_inside_the_content_go():
    page = "<body><div>" + "<p>" + "word " * 200 + "</p>" + "<ul>" + "<li><a href=x>link</a></li>" * 30 + "</ul><p>end words here</p></div></body>"
    text = main_text(page)
    assert "link" not in text and text.endswith("end words here") and text.startswith("word word")


def test_long_and_deep_pages_are_whole():
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    assert main_text(deep) == "deep text"
    long = "<body><article>" + "".join(f"<p>paragraph {i} " + "x" * 50 + "</p>" for i in range(20000)) + "</article></body>"
    assert main_text(long).count("\n\n") == 19999


def test_query_keeps_every_page_and_clashing_columns(spark, sf_dir):
    found = queries.op12_html(spark, sf_dir)
    assert found.columns[:4] == ["page_id", "url", "text", "n_chars"]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert found.count() == pages.count()
    rows = found.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    odd = spark.createDataFrame([(1, None, "x"), (2, PAGE, "y"), (None, "", "z")], "page_id long, html string, main_text string")
    got = {r.page_id: r.main_text for r in html_text.with_main_text(odd).collect()}
    assert got == {1: "", 2: main_text(PAGE), None: ""}
