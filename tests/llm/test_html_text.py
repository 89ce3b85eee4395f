import html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import html_text

TREE = html_text.train()


def text(page):
    return html_text.main_text(page, TREE)


BODY = "A paragraph that is long enough to be read as the text of a page, with more than a few words in it."

PAGE = f"""<!DOCTYPE html><html><head><title>Title &amp; more</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>
<body><header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies. {BODY}</div><article><h1>Heading</h1><p><b>{BODY}<br>
 after&nbsp;the  break<p>Second &lt;p&gt; with <a href="/x">a link</a>.</p><aside>Aside {BODY}</aside>
<div class="ad">Buy {BODY}</div><form><label>Mail</label><input></form><section id="comments"><p>Reader: {BODY}</p></section>
<footer>By someone</footer></article><div id="sidebar">{BODY}</div><footer>&copy; {BODY}</footer>"""


def test_article_without_furniture():
    assert text(PAGE) == f"Heading\n{BODY} after the break\nSecond <p> with a link."


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("no markup at all", ""),
        ("<article>bare text</article>", "bare text"),
        ("<article><p>1 < 2 & 3 > 2</article>", "1 < 2 & 3 > 2"),
        ("<article><p>one<!-- <p>two --><!-- open <p>three", "one"),
        ("<article><p>one<script>never closed <p>two", "one"),
        ("<article><p>one</b></i></div></p><p>two</article></article>", "one\ntwo"),
        ("<ARTICLE><P>One<BR/>two</P></ARTICLE>", "One two"),
        ("<article><p>a &#233; &eacute; &amp;lt; &bogus; &#x1F600;</p></article>", "a é é &lt; &bogus; \U0001f600"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
        ('<article><p title="a > b">yes</p></article>', "yes"),
        ('<article><p title="never closed>yes</p></article>', "yes"),
        ("<main><ul><li>one<li>two</ul></main>", "one\ntwo"),
        ("<article><p>x</p><nav><p>menu</article>", "x"),
        (f"<body><div><p>{BODY}</p><p>{BODY}</p></div><ul><li><a>x</a></li><li><a>y</a></li></ul></body>", f"{BODY}\n{BODY}"),
    ],
)
def test_cases(page, want):
    assert text(page) == want


@pytest.mark.parametrize("name", ["related-work", "search-algorithms", "privacy-law", "social-history", "search", "privacy", "entry-header"])
def test_a_topic_in_a_name_keeps_its_section(name):
    for element in (f'section id="{name}"', f'div class="{name}"'):
        assert text(f"<article><p>{BODY}</p><{element}><h2>Topic</h2><p>{BODY}</p><p>{BODY}</p></article>") == f"{BODY}\nTopic\n{BODY}\n{BODY}"


@pytest.mark.parametrize("name", ["ad", "ad-slot-1", "comments", "comment-list", "related-posts", "share-buttons", "cookie-notice", "main-menu", "post sidebar"])
def test_a_name_of_furniture_drops_its_element(name):
    assert text(f'<article><p>{BODY}</p><div class="{name}"><p>{BODY} No.</p></div><p>{BODY}</p></article>') == f"{BODY}\n{BODY}"


COMMENT_NAMES = [
    "comment", "comment-123", "user-comments", "reader-comments", "wp-block-comments", "c-comments__list", "commentBody", "disqus_thread",
    "js-ad", "cookie-law-info-bar", "you-may-also-like", "blog-comment", "Comments-Area", "visitor-comments",
]


@pytest.mark.parametrize("name", COMMENT_NAMES)
def test_reader_comments_and_notices_go_wherever_they_stand(name):
    box = f'<div class="{name}"><p>{BODY} No.</p><p>{BODY} No.</p></div>'
    assert text(f"<article><p>{BODY}</p>{box}<p>{BODY}</p></article>") == f"{BODY}\n{BODY}"
    assert text(f"<article><p>{BODY}</p></article>{box}<p>{BODY}</p>") == f"{BODY}\n{BODY}"
    assert text(f"<article><p>{BODY}</p><section id={name}><p>{BODY} No.</p></section></article>") == BODY


def test_comments_as_articles_and_repeated_answers():
    comments = f'<article class="comment depth-1"><p>{BODY} No.</p></article><article id="div-comment-7" class="even comment-body"><p>{BODY} No.</p></article>'
    assert text(f"<article><p>{BODY}</p></article><section><h3>2</h3>{comments}</section>").splitlines()[0] == BODY
    assert "No." not in text(f"<article><p>{BODY}</p></article><section>{comments}</section>")
    answers = f'<div class="reply"><p>{BODY} No.</p></div>' * 3
    assert text(f"<article><p>{BODY}</p>{answers}</article>") == BODY


@pytest.mark.parametrize("name", ["related-work", "closing-comments", "comments-open", "has-comments", "no-comment", "commentary", "cookie-baking"])
def test_names_that_only_sound_like_comments_keep_their_text(name):
    assert text(f'<article class="post {name}"><p>{BODY}</p><div class="{name}"><p>{BODY}</p></div></article>') == f"{BODY}\n{BODY}"


def test_one_answer_is_text():
    assert text(f'<article><p>{BODY}</p><div class="reply"><p>{BODY}</p></div></article>') == f"{BODY}\n{BODY}"


FURNITURE = st.sampled_from(
    ["<nav><a href='/'>Home</a></nav>", f"<aside>{BODY}</aside>", f'<div class="user-comments"><p>{BODY}</p></div>', "<script>var p='<p>';</script>",
     f'<div class="ad">{BODY}</div>', "<form><input><label>Mail</label></form>", "<!-- <p>no</p> -->", f"<footer>{BODY}</footer>"]
)
WORD = st.sampled_from(["one", "two", "three", "é", "&amp;", "&lt;b&gt;", "x"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(FURNITURE, st.tuples(st.sampled_from("p blockquote li div h2".split()), st.lists(WORD, min_size=1, max_size=30))), max_size=12))
def test_made_pages(pieces):
    """Pages put together from blocks that are known to be text or furniture, against a plain list of the texts."""
    body, want = "", []
    for piece in pieces:
        if isinstance(piece, str):
            body += piece
        else:
            tag, words = piece
            body += f"<{tag}>" + " \n ".join(words) + f"</{tag}>"
            want.append(html.unescape(" ".join(words)))
    page = f"<html><body><header>Site</header><article><p>{BODY}</p>{body}</article></body></html>"
    assert text(page) == "\n".join([BODY, *want])


def test_weak_names_are_weighed_against_links():
    links = '<li><a href="/x">one more page</a>' * 4
    assert text(f'<article><p>{BODY}</p><div class="related"><ul>{links}</ul></div></article>') == BODY


@pytest.mark.parametrize("name", ["select", "svg", "math", "object", "noscript", "iframe", "template"])
def test_elements_left_open_keep_the_page(name):
    assert text(f"<article><p>{BODY}</p><{name}><p>{BODY}</p></article>") == f"{BODY}\n{BODY}"
    assert text(f"<article><p>{BODY}</p><{name}><p>{BODY}</p><{name}>no</{name}><p>{BODY}</p></article>").count(BODY) >= (1 if name == "template" else 3)


def test_math_is_text_and_choices_are_not():
    math = "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math>"
    assert text(f"<article><p>Let {math} hold in <object data='a'>a drawing</object>.</p></article>") == "Let x=2 hold in a drawing."
    assert text("<article><p>one <select><option>no<option>no</select> <svg><text>no</text></svg> two</p></article>") == "one two"


def test_tree_learns_its_table():
    rows = [[float(x) for x in line.split()] for line in html_text.LABELLED.strip().splitlines()]
    assert all(TREE.accepts(row[:-1]) == bool(row[-1]) for row in rows)
    assert all(len(row) == len(html_text.FEATURES) + 1 for row in rows)


def test_a_very_long_page_is_kept_whole():
    paragraphs = [f"paragraph {i} with some words" for i in range(20_000)]
    page = "<article>" + "".join(f"<p>{p}" for p in paragraphs) + "</article>"
    assert text(page) == "\n".join(paragraphs)


def test_rows(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<article>x")]
    pages = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(pages).collect()
    assert sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in got) == sorted(
        (str(p), str(u), text(h or ""), len(text(h or ""))) for p, u, h in rows
    )
    assert html_text.extract(pages.limit(0)).collect() == []
