"""Names of elements that hold the page's own text."""

import pytest

from anonkit.llm import html_text

TEXT = "The article has a long story, told at length and with many words."


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (f"<body class='no-sidebar'><p>{TEXT}</body>", TEXT),
        (f"<body class='sidebar'><p>{TEXT}</body>", TEXT),
        (f"<div class='content has-sidebar'><p>{TEXT}</div><div class=sidebar>s</div>", TEXT),
        (f"<article class='post has-comments'>{TEXT}<div class='comments'>c</div></article>", TEXT),
        (f"<article class='sponsored'>{TEXT}</article>", TEXT),
        (f"<main><section id='related-work'>{TEXT}</section><section id='search'>more</section></main>", f"{TEXT}\nmore"),
        (f"<section id='search-algorithms'>{TEXT}</section><section id='related-work'>b</section>", f"{TEXT}\nb"),
        (f"<h2 id='social-impact'>T</h2><h2 id='search'>U</h2><p>{TEXT}", f"T\nU\n{TEXT}"),
        (f"<div class='overlay'><article>{TEXT}</article></div><p>outside", TEXT),
        (f"<div class='page-header'><h1>T</h1></div><p>{TEXT}", f"T\n{TEXT}"),
        (f"<div class='widget'><p>{TEXT}</div><p>end", f"{TEXT}\nend"),
        (f"<p>{TEXT}<div class='site-footer'>f</div><div class='ad-300x250'>a</div><span class=ad>b</span><div role=navigation>n</div>", TEXT),
        (f"<nav><h1>Site</h1></nav><div class='sidebar left'><h3>More</h3>s</div><p>{TEXT}", TEXT),
    ],
)
def test_names_remove_no_text_of_the_page(source, text):
    assert html_text.Page(source).main_text(set()) == text
