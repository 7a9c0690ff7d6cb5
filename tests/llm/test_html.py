"""Layouts of pages, and time in proportion to their depth."""

import time

import pytest
from lectern.llm.html_text import Page

MENU = "<nav><a href=/a>one</a></nav>"
TEXT = "<h1>Head</h1><p>First part of the article, long enough to count.</p><p>Second part, just as long as that.</p>"
WANT = "Head\nFirst part of the article, long enough to count.\nSecond part, just as long as that."


@pytest.mark.parametrize(
    "opening",
    ["<main class='content with-sidebar'>", "<div class=no-sidebar>", "<article class='post has-comments'>", "<article class='post comments-open'>", "<div id=search-results-article class=search-result>", "<div class=article-header-img>", "<div class='content has-sidebar'>", "<section role=main class=without-ads>"],
)
def test_articles_are_kept(opening):
    tag = opening[1:].split()[0]
    html = f"<body>{MENU}{opening}{TEXT}</{tag}><div class=sidebar-left><p>Other things that are not it.</p></div><footer>f</footer></body>"
    assert Page(html).text(None) == WANT


@pytest.mark.parametrize("name", ["sidebar", "sidebar-left", "left-sidebar", "cookie-notice", "comments", "comments-area", "post-comments", "comment-list", "ad", "ad-300x250", "site-footer", "main-nav", "newsletter-box", "share_bar", "related-links"])
def test_what_is_not_the_article_goes(name):
    other = f"<div class='{name}'><p>This is not a part of the article at all.</p></div>"
    for html in (f"<body>{other}<article>{TEXT}</article></body>", f"<body><article>{TEXT}{other}</article></body>", f"<body><div class=post>{TEXT}{other.replace('class', 'id')}</div></body>"):
        assert Page(html).text(None) == WANT


def test_comments_longer_than_the_article_go():
    comments = "<div id=comments>" + "<article class=comment-body><p>I think that this is so, and I say it at length.</p></article>" * 12 + "</div>"
    assert Page(f"<body><article class=post>{TEXT}</article>{comments}</body>").text(None) == WANT


def test_an_element_with_the_whole_text_is_taken_back():
    assert Page(f"<body><form id=form1>{MENU}<div class=post>{TEXT}</div></form></body>").text(None) == WANT
    assert Page(f"<body><div class=modal><div class=widget>{TEXT}</div><div class=ad>Buy.</div></div></body>").text(None) == WANT


@pytest.mark.parametrize(
    "html",
    [
        "<article><h1>Head</h1><div class=w><div class=body><p>First part of the article, long enough to count.</p><p>Second part, just as long as that.</p></div></div></article>",
        "<article><header class=entry-header><h1>Head</h1></header><div class=entry-content><p>First part of the article, long enough to count.<p>Second part, just as long as that.</div><footer>tags</footer></article>",
        "<div class=post><div class=lead><h1>Head</h1></div><div class=text><p>First part of the article, long enough to count.</p><p>Second part, just as long as that.</p></div></div>",
        "<div class=page><div class=post><h1>Head</h1><p>First part of the article, long enough to count.</p><div class=more><p>Second part, just as long as that.</p></div></div><div class=list><a href=x>One more</a> <a href=y>Another one</a></div></div>",
    ],
)
def test_leads_and_headlines_stay(html):
    for around in ("{}", "<body>" + MENU + "{}<footer>f</footer></body>"):
        assert Page(around.format(html)).text(None) == WANT


def test_the_hosts_path_wins():
    page = Page("<body><div class=a><p>" + "Short text. " * 12 + "</p></div><div class=b><p>" + "Much longer text. " * 20 + "</p></div></body>")
    path = next(p for p in page.path if p.endswith(".a"))
    assert page.text(path) == " ".join(["Short text."] * 12)


ARTICLE = [f"Paragraph {k} of the article goes on for a while, so that it is plainly running text and nothing else here." for k in range(13)]
PARAS = "".join(f"<p>{p}</p>" for p in ARTICLE)


def test_the_article_is_elsewhere_than_on_the_host():
    page = Page(f"<body><div class=content><p>Short teaser.</p></div><div class=story>{PARAS}</div></body>")
    path = next(p for p in page.path if p.endswith(".content"))
    assert page.text(path) == "\n".join(ARTICLE)


def test_names_that_say_little():
    rest = "<p>" + "Other words. " * 16 + "</p>"
    for html in (f"<div class=text-widget>{PARAS}</div><div>{rest}</div>", f"<div class=search>{PARAS}</div>{rest}"):
        assert "\n".join(ARTICLE) in Page(f"<body>{html}</body>").text(None)


def test_an_article_in_two_containers_below_body():
    html = f"<body>{MENU}<div class=one>{''.join(f'<p>{p}</p>' for p in ARTICLE[:7])}</div><div class=ad>Buy.</div><div class=two>{''.join(f'<p>{p}</p>' for p in ARTICLE[7:])}</div></body>"
    assert Page(html).text(None) == "\n".join(ARTICLE)


def test_links_around_blocks_are_links():
    for card in ("<a href=/x><div class=card>Title of another story</div></a>", "<div><a href=/x>Title of another story</a></div>"):
        html = f"<body><div class=page><div class=post>{PARAS}</div><div class=more>{card * 12}</div></div></body>"
        assert Page(html).text(None) == "\n".join(ARTICLE)
    # An anchor that is never closed is no link; one with an address ends with the element it is in.
    assert Page(f"<body><a name=top><div class=post>{PARAS}</div></body>").text(None) == "\n".join(ARTICLE)
    assert Page(f"<body><p><a href=/x>Home<div class=post>{PARAS}</div></body>").text(None) == "\n".join(ARTICLE)


def test_varied_layouts():
    """Words of the article found, and words found that are of it, over random layouts of several hosts."""
    import random
    from collections import Counter

    rng, scores = random.Random(3), []
    for _ in range(300):
        words = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet one two three four".split()) for _ in range(n))  # noqa: E731, B023
        paras = [f"w{rng.randrange(10**6)} {words(rng.randint(8, 60))}." for _ in range(rng.randint(3, 12))]
        cut = rng.randint(1, len(paras) - 1)
        body = lambda ps: "".join(f"<p>{p}</p>" for p in ps)
        kept = rng.choice([
            f"<article>{body(paras)}</article>", f"<div class=post><div class=lead>{body(paras[:cut])}</div><div class=body>{body(paras[cut:])}</div></div>", f"<main><section>{body(paras[:cut])}</section><section>{body(paras[cut:])}</section></main>",
            f"<div id=content><div class=text-widget>{body(paras)}</div></div>", f"<table><tr><td class=main-cell>{body(paras)}</td></tr></table>", f"<div class=story>{body(paras[:cut])}<div class=ad>{words(5)}</div>{body(paras[cut:])}</div>",
        ])
        links = "".join(f"<li><a href=/{k}>{words(4)}</a></li>" for k in range(rng.randint(3, 20)))
        around = [f"<nav><ul>{links}</ul></nav>", f"<div class=sidebar><h3>{words(3)}</h3><p>{words(40)}</p></div>", f"<ul class=menu>{links}</ul>", f"<div class=links>{links}</div>", f"<footer><p>{words(20)}</p></footer>", f"<div class=cookie-notice><p>{words(25)}</p></div>", f"<section class=comments>{body([words(30)] * 5)}</section>", f"<form><p>{words(12)}</p></form>"]
        before, after = rng.sample(around, 2), rng.sample(around, 3)
        got, want = Counter(Page(f"<html><body>{''.join(before)}{kept}{''.join(after)}</body></html>").text(None).split()), Counter(" ".join(paras).split())
        same = sum((got & want).values())
        scores.append(2 * same / (got.total() + want.total()))
    assert sum(scores) / len(scores) >= 0.97 and sum(s >= 0.999 for s in scores) >= 0.9 * len(scores)


def test_depth_takes_linear_time():
    start = time.time()
    for html in ("<div class=a>" * 100_000 + "<p>some text here" * 10, "<div>text <p>more" * 100_000 + "</section>" * 100_000, "<li>" + "<ul>" + "<x-a>" * 100_000 + "<li>" * 1000, "<!--" * 200_000):
        page = Page(html)
        page.votes(), page.text(None), page.text("none")
    assert time.time() - start < 60
