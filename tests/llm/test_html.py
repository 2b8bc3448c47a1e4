"""Pages whose markup differs from the given ones: wrappers with class words, articles in several containers."""

import pytest

from folio.llm.html_extract import Page, consensus_extraction

BODY = "<h1>Head</h1>" + "".join(f"<p>Sentence number {k} of an article that is long enough to be one.</p>" for k in range(6))
WANT = Page(f"<article>{BODY}</article>").text(None)
NAV, AD = '<nav><a href="/x">menu</a></nav>', '<div class="ad">Buy this now</div>'
WRAPPERS = [
    f'<html class="no-ads"><body>{NAV}{AD}<article>{BODY}</article></body></html>',
    f'<body class="single has-sidebar">{NAV}{AD}<div class="post">{BODY}</div></body>',
    f'<body id="popup">{NAV}<main class="related">{AD}{BODY}</main></body>',
    f'<body>{NAV}<div id="content" class="with-sidebar">{AD}<div class="post">{BODY}</div><div class="sidebar">more on this</div></div></body>',
    f'<body>{NAV}<div class="sidebar-left"><div class="no-ads">{AD}{BODY}</div></div></body>',
    f'<body>{NAV}{AD}<article class="comments-open">{BODY}</article></body>',
    f'<body>{NAV}<form method="post">{AD}<div class="post">{BODY}</div></form></body>',
    f'<body>{NAV}<div class="no-sidebar"><main>{BODY}</main></div><div class="ad">{"long advertisement " * 60}</div></body>',
]


@pytest.mark.parametrize("markup", WRAPPERS)
def test_class_words_spare_wrappers(markup):
    assert Page(markup).text(None) == WANT


@pytest.mark.parametrize("rest", [
    '<div id="comments">' + "<article class='comment'><p>I have a long opinion on this and on other things.</p></article>" * 30 + "</div>",
    "<article class='comment'><p>I have an opinion on this.</p></article>" * 3,
    '<div class="ad">' + "Buy this now. " * 200 + "</div>",
    '<form><p>Your name and your address, please</p><input></form><section class="related-posts"><p>Read this too</p></section>',
])
def test_class_words_still_condemn_sections(rest):
    assert Page(f"<body>{NAV}<article class='post'>{BODY}</article>{rest}</body>").text(None) == WANT
    assert Page(f"<body>{NAV}<div class='post'>{BODY}</div>{rest}</body>").text(None) == WANT
    assert Page(f"<body>{NAV}<article></article><div class='ad'>Buy</div></body>").text(None) == ""


def test_wrappers_by_host(spark):
    pages = spark.createDataFrame([(k, f"http://a.example/{k}", m) for k, m in enumerate(WRAPPERS)], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in consensus_extraction(spark, pages).collect()} == {k: WANT for k in range(len(WRAPPERS))}


P = "".join(f"<p>Sentence number {k} of a body that is long enough to win the vote.</p>" for k in range(12))
LEAD, END = "<p>A lead of one sentence.</p>", "<p>And an end.</p>"
LINKS = '<ul><li><a href="/a">another article of this site</a></li><li><a href="/b">and a third one</a></li></ul>'
TEXT = "\n".join(f"Sentence number {k} of a body that is long enough to win the vote." for k in range(12))


@pytest.mark.parametrize("markup", [
    f'<body>{NAV}<article><h1>Head</h1>{LEAD}<div class="entry">{P}</div>{END}</article></body>',
    f'<body>{NAV}<main><h1>Head</h1>{LEAD}<article>{P}</article>{END}</main></body>',
    f'<body>{NAV}<main><h1><a href="/">Head</a></h1>{LEAD}<div>{P}</div>{LINKS}{END}</main></body>',
    f'<body>{NAV}<div class="post"><section class="intro"><h1>Head</h1>{LEAD}</section><section class="text">{P}{END}</section></div>{LINKS}</body>',
    f'<body>{NAV}<div class="logo">My site</div><div id="a"><h1>Head</h1>{LEAD}<div class="entry">{P}</div>{END}</div>{LINKS}<div>All rights reserved</div></body>',
    f'<h1>Head</h1>{LEAD}<div class="entry">{P}</div>{END}',
])
def test_the_whole_article(markup):
    assert Page(markup).text(None) == f"Head\nA lead of one sentence.\n{TEXT}\nAnd an end."


def test_teaser_on_the_hosts_path(spark):
    usual = f'<body>{NAV}<div class="post">{P}</div></body>'
    other = f'<body>{NAV}<article><h1>Head</h1>{P}</article><div class="post"><p>Read our other text, too.</p></div></body>'
    pages = spark.createDataFrame([(k, f"http://a.example/{k}", other if k == 5 else usual) for k in range(6)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in consensus_extraction(spark, pages).collect()}
    assert got == {k: ("Head\n" if k == 5 else "") + TEXT for k in range(6)}
