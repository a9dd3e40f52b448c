import random
import time

import pytest

from opinio.llm.html_extract import extract_text, main_text

PARA = "This is a long sentence, with several commas, that makes a good paragraph of an article. " * 3


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("just text", "just text"), ("a < b &amp; c", "a < b & c"),
    (page("<article><h1>Head</h1><p>One.</p></article><footer>f</footer>"), "Head\nOne."),
    (page("<nav><a href=x>Menu</a></nav><article><p>A&nbsp;b\n c<br>d</article>"), "A b c d"),
    (page("<article><p><b>one<br><p>two</p>three</article>"), "one\ntwo\nthree"),
    ("<article><p>cut off &am", "cut off &am"), ("<article><p>cut &#233;&lt;<foo bar=\"", "cut é<"),
    (page("<article><p>x</p><!-- <p>no</p> --><script>var t='</p>';</script><p>y</article>"), "x\ny"),
    (page("<article><p>x</p><form><p>name, street, town, and so on, please</p></form></article>"), "x"),
    (page("<article><p>x</p><div class='ad'>buy</div><div hidden>h</div><p style='display: none'>s</p></article>"), "x"),
    (page("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table></article>"), "one\ntwo\na\nb"),
    (page("<article><p>x<p title='a>b'>y</article>"), "x\ny"), ("<script>never closed <p>x", ""),
])
def test_small_pages(html, text):
    assert main_text(html) == text


def test_container_without_an_article_element():
    html = page(f"<div id='top' class='header'>Site</div><div class='menu'><a href=a>Home</a></div>"
                f"<div class='wrap'><div class='post-body'><p>{PARA}</p><p>{PARA}</p><p>Short end.</p></div>"
                f"<div class='sidebar'><p>{PARA}</p></div><div id='comments'><p>{PARA}</p></div></div>"
                f"<div class='cookie-notice'>We use cookies, really, lots, of them</div>")
    para = " ".join(PARA.split())
    assert main_text(html) == f"{para}\n{para}\nShort end."


def test_siblings_and_link_lists():
    links = "<ul>" + "".join(f"<li><a href=/{i}>Another story {i}</a></li>" for i in range(9)) + "</ul>"
    html = page(f"<section><p>{PARA}</p><p>{PARA}</p></section><p>{PARA}</p>{links}")
    para = " ".join(PARA.split())
    assert main_text(html) == "\n".join([para] * 3)


def test_a_page_that_is_one_form():
    para = " ".join(PARA.split())
    body = f"<div class='x'><h1>T</h1><p>{PARA}</p><p>{PARA}</p></div><input><select><option>no</select>"
    assert main_text(page(f"<form id='aspnetForm' action='x'>{body}</form>")) == f"T\n{para}\n{para}"
    login = f"<form><p>Your name, your password, and so on, please, or go away. {PARA}</p></form>"
    assert main_text(page(f"{login}<article><p>{PARA}</p><p>{PARA}</p></article>")) == f"{para}\n{para}"
    assert main_text(page(f"<div>{login}</div><div><p>{PARA}</p><p>{PARA}</p></div>")) == f"{para}\n{para}"


def test_like_sections_stay_together():
    para = " ".join(PARA.split())
    section = lambda k: f"<div><h2>H{k}</h2><div><p>{PARA}</p><p>{PARA}</p></div></div>"
    want = "\n".join(f"H{k}\n{para}\n{para}" for k in range(3))
    for around in ("{}", "<div id='w'>{}</div>", "<main>{}</main>", "<section><div>{}</div></section>"):
        html = page("<nav><a href=a>Home</a></nav>" + around.format("".join(map(section, range(3))))
                    + f"<div class='sidebar'><p>{PARA}</p></div><footer>f</footer>")
        assert main_text(html) == want


def test_an_article_s_own_header_and_sources():
    para = " ".join(PARA.split())
    links = "<ul>" + "".join(f"<li><a href=/{i}>Source {i}</a></li>" for i in range(4)) + "</ul>"
    html = page(f"<header><h2>Site</h2></header><article><header><h1>Title</h1><nav>n</nav></header><p>{PARA}</p>"
                f"<h2>Sources</h2>{links}<ul class='share'><li><a>x</a></ul><footer>f</footer></article>")
    assert main_text(html) == f"Title\n{para}\nSources\n" + "\n".join(f"Source {i}" for i in range(4))


def test_a_reference_ends_at_a_tag():
    assert main_text("<article><p>&<i>copy;</i> &amp;copy; &l<!-- -->t; &lt;</article>") == "&copy; &copy; &lt; <"


def test_ties_of_scores():
    para = " ".join(PARA.split())
    html = page(f"<div><p>{PARA}</p></div><hr><div><p>{PARA}</p></div>")
    assert main_text(html) == f"{para}\n{para}"


def test_linear_in_the_page():
    rnd = random.Random(3)
    tags = ["<p>", "</p>", "<div>", "</div>", "<b>", "</i>", "<li>", "<ul>", "text, ", "<td>", "<table>", "<a href='x'>"]
    for _ in range(300):
        assert isinstance(main_text("".join(rnd.choice(tags) for _ in range(200))), str)
    for html in ("<div>" * 100_000 + "x", "<p " * 30_000, "<b>" * 100_000 + "</i>" * 100_000, "<!--" * 50_000,
                 "<a href=\"" * 20_000, "<li>" * 100_000):
        start = time.process_time()
        main_text(html)
        assert time.process_time() - start < 5
    assert main_text("<article>" + "<b>" * 3000 + "deep" + "<p>" + "x" * 2_000_000).endswith("x")


def test_table(spark):
    rows = [(1, "u", page("<article><p>é😀</p></article>"), "t"), (1, "u", None, "t"), (None, None, "", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(str, (tuple(r) for r in extract_text(df).collect())))
    assert got == sorted(map(str, [(1, "u", "é😀", 2), (1, "u", "", 0), (None, None, "", 0)]))
    assert extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("words", ["content no-sidebar", "content has-sidebar", "main-content with-sidebar",
                                   "post hentry category-social", "article comments-open", "content sidebar-right",
                                   "post_body menu_closed", "social", "overflow-hidden", "wide-banner-layout"])
@pytest.mark.parametrize("tag", ["div", "article", "main", "section"])
def test_layout_topic_and_status_words(tag, words):
    para = " ".join(PARA.split())
    html = page(f"<div class='sidebar'><p>{PARA}</p></div><{tag} class='{words}'><p>{PARA}</p><p>{PARA}</p>"
                f"<div class='related-posts'><p>Other things, to read, on this site</p></div></{tag}>")
    assert main_text(html) == f"{para}\n{para}"


def test_parts_that_words_leave_out():
    para = " ".join(PARA.split())
    more = f"<p>{PARA}</p>" * 5
    for words in ("sidebar", "comments", "comment-list", "related-posts", "share-buttons text-center", "post-footer",
                  "widget widget_text", "sidebar content", "cookie-notice"):
        part = f"<div class='{words}'>{more}</div>"
        assert main_text(page(f"<article><p>{PARA}</p>{part}</article>")) == para
        assert main_text(page(f"<div id='content'><p>{PARA}</p></div>{part}")) == para
        assert main_text(page(f"<div class='x'><div id='content'><p>{PARA}</p>{part}</div></div>")) == para
        assert main_text(page(f"<div class='social'><div class='post'><p>{PARA}</p>{part}</div></div>")) == para


def test_headings_code_lists_and_tables_beside_the_container():
    para = " ".join(PARA.split())
    entry = f"<div class='entry-content'><p>{PARA}</p><p>{PARA}</p></div>"
    links = "".join(f"<li><a href=/{i}>Story {i}</a></li>" for i in range(9))
    lost = "<div class='sidebar'><p>no</p></div><div>plain</div>"
    for body, before, after in [
        (f"<h1>T</h1>{entry}<pre>code</pre>", "T\n", "\ncode"),
        (f"<div class='hd'><h1><a href=x>T</a></h1></div><div>{entry}</div><ul><li>one<li>two</ul>", "T\n", "\none\ntwo"),
        (f"<figure><img src=x><figcaption>cap</figcaption></figure>{entry}<table><tr><td>a<td>b</table>", "cap\n", "\na\nb"),
        (f"<h2>T</h2><div><h3>U</h3>{entry}</div><ul>{links}</ul><ol><li><a href=x>only a link</a></ol>", "T\nU\n", ""),
    ]:
        text = f"{before}{para}\n{para}{after}"
        for html in (f"<div class='post'>{body}</div>", f"<div class='post'>{body}{lost}</div>", body, body + lost,
                     f"<div><div class='post'>{body}</div></div>{lost}"):
            assert main_text(page(html)) == text, html
