"""Main text of pages that wrap it in elements named or tagged like noise."""

import pytest

from ledgerlake.llm.html_extract import extract

TEXT = "Main text of the page. " * 40
COMMENTS = "<section class='comments'><article class='comment'><p>" + "me too " * 30 + "</p></article></section>"


@pytest.mark.parametrize("wrap", [
    "<div class='layout has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class='post comments-open'>{}</div>",
    "<form id='aspnetForm'>{}</form>", "<form><fieldset>{}</fieldset></form>", "<div class='sidebar-layout'>{}</div>",
    "<form><div class='social widget'>{}</div></form>", "<main><h1>T</h1><form>{}</form></main>"])
@pytest.mark.parametrize("inner", ["<article><p>{}</p></article>", "<div class='c'><p>{}</p></div>"])
def test_wrapped_pages_keep_their_text(wrap, inner):
    page = "<body><nav>Menu</nav>" + wrap.format(inner.format(TEXT) + COMMENTS + "<div class='sidebar'>side</div>") + "<footer>f</footer>"
    assert extract(page, None).split("\n")[-1] == TEXT.strip()


def test_noise_stays_noise():
    page = f"<body><article><p>Short text. {TEXT[:90]}</p></article><section class='comments'><article><p>{TEXT}</p></article></section>"
    assert extract(page, None) == f"Short text. {TEXT[:90]}".strip()
    page = f"<body><div class='c'><p>{TEXT}</p></div><form><p>Name</p></form><div class='sidebar'><p>side</p></div>"
    assert extract(page, None) == TEXT.strip()


SHORT = "One sentence is all there is."
THREAD = "".join(f"<div class='c{{0}}'><p>Reader {i} has much more to say about this than the page.</p></div>" for i in range(40))
ARTICLES = THREAD.replace("<div", "<article").replace("</div", "</article")


@pytest.mark.parametrize("main", [
    "<article><p>{}</p></article>", "<div class='post'><h1>T</h1><p>{}</p></div>", "<main><p>{}</p></main>",
    "<div class='content'><p>{}</p></div>", "<div class='x'><p>{}</p></div>", "<h1>T</h1><p>{}</p>", "<article><h1>T</h1><div class='body'><p>{}</p></div></article>"])
@pytest.mark.parametrize("thread", [
    f"<div id='comments'>{THREAD}</div>", f"<section class='comments content'>{THREAD}</section>", f"<section class='comments'>{ARTICLES}</section>",
    f"<div class='comment-list'><h2>40 comments</h2>{ARTICLES}</div>", f"<div id='disqus_thread'><div class='content'>{THREAD}</div></div>"])
def test_comments_never_displace_an_article(main, thread):
    page = f"<body><nav>Menu</nav>{main.format(SHORT)}{thread}<footer>f</footer></body>"
    text = extract(page, None)
    assert text.split("\n")[-1] == SHORT and "Reader" not in text
    page = f"<body><div class='page'>{main.format(SHORT)}{thread}</div></body>"
    assert extract(page, None).split("\n")[-1] == SHORT


@pytest.mark.parametrize("page", [
    f"<article><p>{SHORT}</p></article><form>" + "<div><label>Name of the applicant and all that</label></div>" * 30 + "</form>",
    f"<article><p>{SHORT}</p></article><div class='promo'>" + "<p>Buy this and that today.</p>" * 30 + "</div>",
    f"<div class='text'><p>{SHORT}</p></div><div class='widget'><h2>More</h2>" + "<p>Buy this and that today.</p>" * 30 + "</div>"])
def test_other_noise_never_displaces_an_article(page):
    assert extract(f"<body>{page}</body>", None) == SHORT


@pytest.mark.parametrize("page", [
    f"<div class='comments-layout'><h1>T</h1><p>{TEXT}</p></div>", f"<p>date</p><div class='sidebar-layout'><article><h1>T</h1><p>{TEXT}</p></article></div>",
    f"<div id='comments-page'><div class='c'><article><h1>T</h1><p>{TEXT}</p></article></div>{COMMENTS}</div>"])
def test_wrappers_with_the_structure_of_an_article_stay(page):
    assert extract(f"<body>{page}</body>", None).endswith(f"T\n{TEXT.strip()}")
