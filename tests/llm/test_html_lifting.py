"""Headings and sections next to the best container stay with it."""

import pytest

from ledgerlake.llm import html_extract
from ledgerlake.llm.html_extract import extract, votes


def words(word, chars):
    return (f"{word} " * chars)[:chars].strip()


INTRO, BODY, OUTRO = words("intro", 300), words("body", 1000), words("outro", 300)
SECTIONS = f"<div class='intro'><p>{INTRO}</p></div><div class='body'><p>{BODY}</p></div><div class='outro'><p>{OUTRO}</p></div>"


@pytest.mark.parametrize("page, text", [
    (f"<main><h1>T</h1><div class='c'><p>{BODY}</p></div></main>", f"T\n{BODY}"),
    (f"<div class='content'>{SECTIONS}</div>", f"{INTRO}\n{BODY}\n{OUTRO}"),
    (f"<main><h1>T</h1><article><p>{BODY}</p></article></main>", f"T\n{BODY}"),
    (f"<div class='page'><div class='nav'><p>m</p></div><div class='content'>{SECTIONS}</div></div>", f"{INTRO}\n{BODY}\n{OUTRO}"),
    (f"<article><h1>T</h1>{SECTIONS}</article><div class='x'><p>{INTRO}</p></div>", f"T\n{INTRO}\n{BODY}\n{OUTRO}"),
])
def test_siblings_stay(page, text):
    page = f"<body><nav>Menu</nav>{page}<footer>f</footer></body>"
    assert extract(page, None) == extract(page, votes(page)[0][0]) == text


def test_a_path_with_a_third_of_the_text_does_not_win():
    page = f"<body><div class='content'>{SECTIONS}</div></body>"
    for path in ("body>div.content>div.body", "body>div.content>div.intro"):
        assert extract(page, path) == f"{INTRO}\n{BODY}\n{OUTRO}"
    page = f"<body><div class='a'><p>{BODY}</p></div><div class='b'><p>{BODY[:400]}</p></div></body>"
    assert extract(page, "body>div.b") == BODY


def test_every_container_votes():
    page = "<body>" + "".join(f"<div class='{c}'><p>{BODY[:300]}</p></div>" for c in "abcde")
    assert {p for p, _ in votes(page)} >= {f"body>div.{c}" for c in "abcde"}


def test_all_pages_of_a_host(llm):
    page = f"<body><main><h1>T</h1><div class='c'><p>{BODY}</p></div></main></body>"
    df = llm.createDataFrame([(i, "https://h.example/", page) for i in range(3)], "page_id bigint, url string, html string")
    assert {r.text for r in html_extract.extract_pages(df).collect()} == {f"T\n{BODY}"}
