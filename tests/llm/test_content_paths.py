"""Paths decide on pages without semantic elements; names of furniture never delete the densest text."""

from feedmill.llm import html_extract
from feedmill.llm.html_extract import main_text

LONG = "<p>" + "This is a long sentence, with some words; and it goes on. " * 6 + "</p>"
MENU = "<div><a href=/>Home</a> <a href=/b>About</a> <a href=/c>News</a></div>"


def count(html):
    return main_text(html).count("This is a long")


def test_paths_refuse_nameless_furniture(monkeypatch):
    page = f"<body>{MENU}<div><h1>Head</h1>{LONG}<h2>Sub</h2>{LONG}<ul><li>one item</li><li>two</li></ul>{LONG}</div><div>© 2024 Example Corp. All rights reserved.</div></body>"
    got = main_text(page).split("\n\n")
    assert [x[:8] for x in got] == ["Head", "This is ", "Sub", "This is ", "one item", "two", "This is "]
    monkeypatch.setattr(html_extract, "content_paths", lambda blocks, share=0.5: {b.node.path for b in blocks})
    assert "Home About News" in main_text(page) and "©" in main_text(page)


def test_names_do_not_delete_the_text():
    assert count(f"<body>{MENU}<div class='search-results-story'>{LONG}{LONG}</div></body>") == 12
    got = main_text(f"<div class=teaser><p>Another story, short.</p></div><div class='article-share-body'>{LONG}{LONG}<p>End.</p></div>")
    assert got.count("This is a long") == 12 and got.endswith("End.") and "Another" not in got
    assert count(f"<form id=aspnet><div class=nav><a href=1>x</a></div><div>{LONG}{LONG}</div></form>") == 12
    assert main_text(f"<div class='page-with-sidebar'><div class='sidebar-content'><p>Short news. Read it.</p></div><h1>Title</h1>{LONG}</div>").startswith("Title")


def test_names_still_refuse_what_is_less_than_the_text():
    assert count(f"<div class=post>{LONG}</div><div class=comments>{LONG}{LONG}{LONG}</div>") == 6
    short = "A short article of a page, with an advert beside it; the advert is longer than the whole of it is, by far."
    assert main_text(f"<article><p>{short}</p></article><div class=ad>{LONG}</div>") == short
    assert count(f"<article>{LONG}<div class='related-posts'><p>More, to read. And more.</p></div></article>") == 6
    assert "More" not in main_text(f"<article>{LONG}<div class='related-posts'><p>More, to read. And more.</p></div></article>")


def test_short_ends_beside_the_text_stay():
    got = main_text(f"<div id=wrap><div class=intro><p>Intro is short.</p></div><div class=body>{LONG}{LONG}</div><p>Conclusion here.</p><p>Copyright 2024 X.</p></div>")
    assert got.startswith("Intro is short.") and got.endswith("Conclusion here.")
