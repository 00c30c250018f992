import re

import pytest

from ledgerflow.llm.catalog import QUERIES
from ledgerflow.llm.common import table
from ledgerflow.llm.html_blocks import blocks
from ledgerflow.llm.html_text import LABELLED, extract, judge, main_text, train

SF = "/root/testdata/sf0.01"
PARA = "The committee met again on Tuesday to discuss the budget for the coming year, and members spoke at length about it."


@pytest.fixture(scope="module")
def tree(spark):
    return train(spark)


def test_tree_learns_its_table(tree):
    wrong = sum(judge(tree, row[:-1]) != bool(row[-1]) for row in LABELLED)
    assert wrong / len(LABELLED) < 0.05 and len(LABELLED) <= 200


def test_held_out_blocks(spark):
    """Four fifths of the table predict the other fifth."""
    wrong = 0
    for fold in range(5):
        own = train(spark, tuple(r for i, r in enumerate(LABELLED) if i % 5 != fold))
        wrong += sum(judge(own, r[:-1]) != bool(r[-1]) for r in LABELLED[fold::5])
    assert wrong / len(LABELLED) < 0.15


@pytest.mark.parametrize(
    "html,wanted",
    [
        (f"<body><nav><a href=x>Home</a> <a href=y>News</a></nav><div class='ad'>{PARA}</div><article><h1>T &amp; U</h1><p><b>{PARA}<br>x<p>Short.</article><footer>&copy; me</footer>", f"T & U\n{PARA} x\nShort."),
        (f"<div id=content><h2>Big news today</h2><p>{PARA}</p><p>{PARA}</p></div><div class='side-bar sidebar'><p>{PARA}</p></div>", f"Big news today\n{PARA}\n{PARA}"),
        (f"<main><p>{PARA}</p><section class='comments'><p>{PARA} I agree!</p></section></main>", PARA),
        (f"<article><p>{PARA}</p><form><label>Your mail</label><input></form><aside><p>{PARA}</p></aside><p>End.</p></article>", f"{PARA}\nEnd."),
        (f"<div class='cookie-notice'>{PARA}</div><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>a<i>b</i>c &lt;d&gt; &nbsp; e</p></article>", "Title\nabc <d> e"),
        (f"<article><p hidden>{PARA}</p><p>One</p><script>if (a < b) {{ x('</p>') }}</script><style>p{{}}</style><!-- no <p>not this</p> --><p>Two</p></article>", "One\nTwo"),
        (f"<p>{PARA}</p><p>{PARA}</p>", f"{PARA}\n{PARA}"),
        (f"<article><p title=Don't>One it's here</p><p>{PARA}</p></article>", f"One it's here\n{PARA}"),
        (f"<article><p class=\"a\"\">{PARA}</p><p data-x=a\"b title='x>y'>Two</p></article>", f"{PARA}\nTwo"),
        (f"<article><p title=\"never closed>{PARA}</p><p>Two</p></article>", f"{PARA}\nTwo"),
        (f"<body class='has-sidebar no-comments'><div class='main-menu-open content'><p>{PARA}</p></div></body>", PARA),
        ("", ""),
        ("   <nav>menu</nav>", ""),
        ("<article>" + "<p>x y z</p>" * 3000 + "</article>", "\n".join(["x y z"] * 3000)),
        ("<p <<< &#x110000; &bogus; < 5 > 3 <article", None),
    ],
)
def test_pages(tree, html, wanted):
    assert wanted is None or main_text(html, tree) == wanted


def test_registered_query_on_pages(spark):
    rows = {r["page_id"]: r for r in QUERIES["op9_main_text"](spark, SF).collect()}
    import html as h

    for page in table(spark, SF, "pages").collect():
        own = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        parts = [h.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))) for x in re.split("</?(?:p|h1)>", own)]
        wanted = "\n".join(t for t in (re.sub(r"\s+", " ", x).strip() for x in parts) if t)
        assert rows[page["page_id"]]["text"] == wanted and rows[page["page_id"]]["n_chars"] == len(wanted)


def test_odd_rows(spark, tree):
    rows = [(None, None, None, "c"), (1, "u", "", "c"), (1, "u", "", "c"), (2, None, "<article>" + "é" * 300_000, "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(pages, tree)
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(len(r["text"]) for r in got.collect()) == [0, 0, 0, 300_000]
    assert extract(pages.limit(0), tree).collect() == []


def test_neighbours_of_a_block():
    found = blocks("<ul><li><a>one two</a><li>three</ul>tail")
    assert [(b.text, b.words, b.link_density) for b in found] == [("one two", 2, 1.0), ("three", 1, 0.0), ("tail", 1, 0.0)]


@pytest.mark.parametrize(
    "html,wanted",
    [
        ("<p>a</p><video-player src=x></video-player><p>b</p>", "a b"),
        ("<p>a</p><map-view><button-group><select-menu><p>b</p>", "a b"),
        ("<p>a</p><title-bar>t</title-bar><p>b</p>", "a t b"),
        ("<p>a</p><svg class=i /><p>b</p><svg/><math/><p>c</p>", "a b c"),
        ("<p>a</p><svg><title/><style/><svg/>no</svg><p>b</p>", "a b"),
        ("<p>a</p><svg><g><svg>no</svg></g>no</svg><p>b</p>", "a b"),
        ("<p>a</p><object data=x><p>b</p><map name=m><p>c</p><button><p>d</p>", "a b c d"),
        ("<p>a</p><button>x<p>b</p><button>no</button><p>c</p></button-x><p>d</p>", "a x b c d"),
        ("<p>a</p><SELECT size='>'><option>no</SELECT ><p>b</p>", "a b"),
        ("<p>a</p><script>'<svg>' + '<video>'</script><p>b</p><!-- <video> --><p>c</p>", "a b c"),
        ("<p>a</p><script/>no</script><p>b</p><style>no <p>no</p>", "a b"),
        ("<p>a</p><textarea><p>no</p>", "a"),
        ("<p>a</p>" + "<button><p>b</p>" * 20_000, "a" + " b" * 20_000),
    ],
)
def test_unseen_elements_take_no_more_than_they_hold(html, wanted):
    assert " ".join(b.text for b in blocks(html)) == wanted
