"""Pages without article or main."""

from feedmill.llm.html_extract import main_text


def test_pages_of_divs_keep_all_content():
    p = "A sentence of the text, with a comma; and it goes on for a while, as sentences do."
    body = "".join(f"<p>{p} {i}</p>" for i in range(12))
    got = main_text(f"<div id=wrap><div class=intro><p>Intro. {p}</p></div><div class=body>{body}</div><p>Conclusion. {p}</p></div>")
    assert "Intro." in got and "Conclusion." in got and got.count(p) == 14
    got = main_text(f"<body><h1>The heading</h1><div class=text>{body}</div></body>")
    assert got.startswith("The heading") and got.count(p) == 12
    got = main_text(f"<body><section><h2>One</h2><p>Short. {p}</p></section><section><h2>Two</h2>{body}</section></body>")
    assert "One" in got and "Short." in got and got.count(p) == 13
