"""Hand-made pages with their expected text."""

import time

import pytest

from riskloom.llm.pages import main_text

LONG = "The committee met twice in the spring, heard four witnesses, and published a report that few people read; it was thorough."
MORE = "A second paragraph, somewhat shorter, explains what happened next and why it mattered to the town."
P = f"<p>{LONG}</p><p>{MORE}</p>"
TEXT = f"{LONG}\n{MORE}"
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">About</a></li></ul></nav>'
COMMENT = '<div class="comment"><p>I read this twice, and I think that it is wrong in every respect, sorry.</p></div>'

PAGES = {
    "a form around the page": (f'<body><form id="aspnetForm" method="post"><input type="hidden" name="a">{NAV}<article>{P * 3}</article></form></body>', "\n".join([TEXT] * 3)),
    "a form around a page without article": (f'<body><form id="form1"><div id="page"><div class="text">{P * 3}</div></div></form></body>', "\n".join([TEXT] * 3)),
    "a search form": (f'<body><form><input name="q"><button>Search the site</button></form><article>{P}</article></body>', TEXT),
    "a comment form": (f'<article>{P}<form><p>Leave a reply, your address is not shown.</p><label>Name</label><input><textarea></textarea></form></article>', TEXT),
    "a heading's id discussion": (f'<article>{P}<h2 id="discussion">Discussion</h2><p>{LONG}</p></article>', f"{TEXT}\nDiscussion\n{LONG}"),
    "a heading's id search": (f'<article>{P}<h2 id="search-strategy">Search strategy</h2><p>{LONG}</p></article>', f"{TEXT}\nSearch strategy\n{LONG}"),
    "a heading's id share": (f'<article>{P}<h2 id="share-of-trade">Share of trade</h2><p>{LONG}</p></article>', f"{TEXT}\nShare of trade\n{LONG}"),
    "a heading's id comments": (f'<article>{P}<h2 id="comments-on-method">Comments on method</h2><p>{LONG}</p></article>', f"{TEXT}\nComments on method\n{LONG}"),
    "a paragraph's id": (f'<article>{P}<p id="related-work">{LONG}</p></article>', f"{TEXT}\n{LONG}"),
    "a paragraph's class": (f'<article>{P}<p class="legal">{LONG}</p></article>', f"{TEXT}\n{LONG}"),
    "a section's id": (f'<article>{P}<section id="discussion" class="level2"><h2>Discussion</h2>{P}</section></article>', f"{TEXT}\nDiscussion\n{TEXT}"),
    "a section's id, no article": (f'<body><div id="doc">{P}<section id="related-work"><h2>Related work</h2>{P}</section></div></body>', f"{TEXT}\nRelated work\n{TEXT}"),
    "a div's id with other words": (f'<article>{P}<div id="search-strategy"><p>{LONG}</p></div></article>', f"{TEXT}\n{LONG}"),
    "a list item's id": (f'<article>{P}<ul><li id="menu-item-of-note">{LONG}</li></ul></article>', f"{TEXT}\n{LONG}"),
    "a closed svg": (f'<article>{P}<p><svg class="i"/>{LONG}</p></article>', f"{TEXT}\n{LONG}"),
    "an svg never closed": (f'<article><svg viewBox="0 0 1 1">{P}</article>', TEXT),
    "an svg with text": (f'<article>{P}<svg><title>Icon</title><text>12</text></svg></article>', TEXT),
    "math in a sentence": (f"<article>{P}<p>Let <math><mi>x</mi></math> be, say, a number.</p></article>", f"{TEXT}\nLet x be, say, a number."),
    "math with its source": (f'<article>{P}<p>Let <math><semantics><mi>x</mi><annotation encoding="tex">\\x</annotation></semantics></math> be one.</p></article>', f"{TEXT}\nLet x be one."),
    "comments by class": (f'<article>{P}<section class="comments">{COMMENT * 3}</section></article>', TEXT),
    "comments by id": (f'<article>{P}<div id="comments">{COMMENT * 3}</div></article>', TEXT),
    "comments by a filled-up id": (f'<article>{P}<div id="comments-area">{COMMENT * 3}</div></article>', TEXT),
    "an advert by class": (f'<article>{P}<div class="advert"><p>{LONG}</p></div><p class="sponsored">{MORE}</p></article>', TEXT),
    "a cookie notice": (f'<div id="cookie-consent"><p>We use cookies, as all sites do, to make this page better for you.</p></div><article>{P}</article>', TEXT),
    "a sidebar by id": (f'<body><div id="sidebar"><p>{MORE}</p></div><article>{P}</article></body>', TEXT),
    "a forum thread's first post": (f'<main><div class="post">{P}</div></main><footer><p>{MORE}</p></footer>', TEXT),
    "an article called a teaser": (f'<body><article class="teaser">{P}</article></body>', TEXT),
    "documentation": (f'<body><div role="navigation">{NAV}</div><main><h1 id="install">Install</h1>{P}<pre>pip  list</pre><h2 id="menu">Menu</h2><p>{MORE}</p></main></body>', f"Install\n{TEXT}\npip list\nMenu\n{MORE}"),
    "misnested inline elements": (f"<article><b>{P}<div></b><p>{LONG}</p></div></article>", f"{TEXT}\n{LONG}"),
    "a separator in a bare container": (f'<body><div id="page"><div class="text">{P * 2}<div class="sep">|</div>{P}</div></div></body>', "\n".join([TEXT] * 3)),
    "a short cell beside long text": (f'<body><div id="page"><div class="text">{P * 2}<table><tr><td>7</td></tr></table>{P}</div></div></body>', f"{TEXT}\n{TEXT}\n7\n{TEXT}"),
    "a separator in an article": (f'<article>{P}<div class="sep">|</div>{P}</article>', f"{TEXT}\n|\n{TEXT}"),
    "a paragraph in a cell": (f"<article><p>{LONG}<table><tr><td><p>{MORE}<p>{LONG}</table></article>", f"{LONG}\n{MORE}\n{LONG}"),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    page, want = PAGES[name]
    assert main_text(page) == want


@pytest.mark.parametrize("page", [
    lambda n: "<b>" * n + "<div>" * n + "</b>" * n, lambda n: "<p><button>" + "<b>" * n + "<div>" * n, lambda n: "<svg>" * n,
    lambda n: "<div><form>x</div>" * n, lambda n: "<ul><li>" * n + "x</li>" * n, lambda n: "<i><p>" * n + "</i>" * n,
])
def test_hostile_pages_take_linear_time(page):
    def seconds(n):
        text = page(n)
        start = time.process_time()
        main_text(text)
        return time.process_time() - start

    seconds(1_000)
    assert seconds(60_000) <= 12 * max(seconds(10_000), 0.05)
