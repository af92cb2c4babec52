"""HTML extraction: what the template decides, misleading names, and elements that close themselves."""

import random

import pytest

from lumentab.llm import templates

WHOLE = {
    "<article><p>one</p><svg class='i'/><p>two</p></article>": "one\n\ntwo",
    "<p>a</p><math/><p>b</p>": "a\n\nb",
    "<p>a</p><svg viewBox='0 0 1 1'><path d='M0 0'/><text>no</text></svg><p>b</p>": "a\n\nb",
    "<div class='page with-sidebar'><p>one</p><p>two</p></div>": "one\n\ntwo",
    "<div class='content related-work'><p>one</p></div>": "one",
    "<div class='post notice-board'><p>one</p></div>": "one",
    "<article><p>a</p><p class='market-share'>b</p></article>": "a\n\nb",
    "<main><div class='social-media-story'><p>x</p></div></main>": "x",
    # A wrapper with the very name of a part, and a real part in it.
    "<div class='sidebar'><p>The story goes on and on.</p><div class='ad'>buy</div></div><div>(c)</div>": "The story goes on and on.\n\n(c)",
    "<div><p>text</p></div><div class='comments'><p>nice one, and a longer one than the text</p></div>": "text",
    "<article><p>a</p><div class='share-buttons'><p>tell it</p></div></article>": "a",
}


@pytest.mark.parametrize("page", list(WHOLE))
def test_names_decide_only_where_text_remains(page):
    assert templates.main_text(page, "") == WHOLE[page]


def prose(rng):
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta".split()) + str(rng.randrange(1000)) for _ in range(12)) + "."


@pytest.fixture(scope="module")
def plain_site():
    """Pages of one host without article, menu tags or telling names: repeated text and link lists surround the story."""
    rng = random.Random(9)
    rows = []
    for n in range(12):
        story = [prose(rng) for _ in range(3)]
        links = "".join(f"<li><a href='/{rng.randrange(99)}'>{prose(rng)}</a></li>" for _ in range(4))
        html = (f"<html><body><div class='x1'><p>Welcome to our site</p><p>All about letters</p></div><div class='x2'><ul>{links}</ul></div>"
                f"<div class='x3'>{''.join(f'<p>{s}</p>' for s in story)}</div><div class='x4'><p>Rights reserved by us</p><p>Call us any time</p></div></body></html>")
        rows.append((n, f"http://plain.example/{n}", html, "\n\n".join(story)))
    return rows


def test_the_template_finds_the_story_without_names(spark, plain_site):
    table = spark.createDataFrame([r[:3] for r in plain_site], "page_id long, url string, html string").repartition(3)
    got = {r["page_id"]: r["text"] for r in templates.extract(table).collect()}
    assert got == {n: story for n, _, _, story in plain_site}


def test_results_differ_without_the_template(plain_site):
    for _, _, html, story in plain_site:
        alone = templates.main_text(html, "")
        assert alone != story and story.split("\n\n")[0] in alone and "Rights reserved" in alone


def test_misleading_wrappers_of_a_host(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for n in range(8):
        story = [prose(rng) for _ in range(2)]
        want[n] = "\n\n".join(story)
        rows.append((n, "http://odd.example/", f"<body><div class='sidebar'><p>{story[0]}</p><p>{story[1]}</p></div><div class='footer'>Same words</div></body>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in templates.extract(table).collect()} == want
