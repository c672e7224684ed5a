from __future__ import annotations

import hashlib
import html
import io
import random
import time
from html.parser import HTMLParser

import pytest

from pacewise.llm import articles, warc

ARTICLE = "<article><h1>T &amp; U</h1><p>One <b>bold</b>\n text.<p>Two&nbsp;more<br>here.</article>"


@pytest.mark.parametrize("page, text", [
    (f"<html><body><nav><a href=/>Home</a></nav>{ARTICLE}<footer>f</footer></body></html>",
     "T & U\nOne bold text.\nTwo more here."),
    ("<body><header><h1>Site</h1></header><main><h1>A</h1><div class='ad'>Buy</div><p>b</p>"
     "<section class=comments><p>nice</p></section></main><aside>x</aside>", "A\nb"),
    ("<body><div id=wrap9><h2>H</h2><div class=text><p>" + "long text " * 20 + "</p></div></div>"
     "<div class='cookie-notice'>We use cookies</div><form><p>Your mail</p></form>",
     "H\n" + ("long text " * 20).strip()),
    ("<p>a &lt; b, x<y &#233;&unknown; &copy", "a < b, x"),
    ("<article><p>cut in a ta<a href='x", "cut in a ta"),
    ("<article><p>t</p><script>var x='</p>';<p>no</p></script><style>p{}</style><!-- <p>no --></article>",
     "t"),
    ("<p title=don't>kept</p><p>it's</p>", "kept\nit's"),
    ("<div class=comments><p>only this</p></div>", "only this"),
    ("plain text", "plain text"),
    ("<nav>only a menu</nav>", ""),
    ("", ""),
    (None, ""),
])
def test_main_text(page, text):
    assert articles.main_text(page) == text


def test_a_host_agrees_on_its_path(spark):
    story = "<div class='body-{n}'><p>" + "some text of the page " * 10 + "</p></div>"
    fooled = "<div class=body-7><p>brief</p></div><div class=more><p>" + "other words " * 20 + "</p></div>"
    rows = [(i, f"http://h.org/{i}", "<body>" + story.format(n=i), "x") for i in range(5)]
    rows += [(9, "http://H.org/9", "<body>" + fooled, "x"), (10, "http://i.org/", "<body>" + fooled, "x"),
             (11, None, None, "x"), (None, "http://h.org/z", "", "x"), (12, "http://h.org/", "<p>bare</p>", "x"),
             (12, "http://h.org/", "<p>bare</p>", "x")]
    got = articles.extract(spark.createDataFrame(rows, "page_id long, url string, html string, path string"))
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert sorted(texts, key=str) == sorted(
        [(i, ("some text of the page " * 10).strip()) for i in range(5)]
        # Alone, the page would give the longer container.
        + [(9, "brief"), (10, ("other words " * 20).strip()), (11, ""), (None, ""), (12, "bare"), (12, "bare")],
        key=str,
    )
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert articles.extract(pages).count() == 0
    assert warc.round_trip(spark, pages).count() == 0


def page_rows():
    big = "<p>" + "xé" * 200_000
    return [
        (5, "http://a/ b\r\nc%", big), (3, None, big), (8, "u", big), (4, "u", "short"),
        (6, "u", "short"), (7, "u", None), (9, "u", ""), (None, "u", "y" * 100), (10, "u", "y" * 100),
        (11, "u", "z" * 99), (12, "u", "z" * 99), (13, "u", "\x00\r\n\r\nWARC/1.0\r\n" * 20),
        (14, "u", "q" * 100), (14, "u", "q" * 100), (15, "u", "q" * 100),
    ]


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    written = warc.write_archives(pages, str(tmp_path))
    assert sum(r.n_records for r in written.collect()) == len(rows) and written.count() > 1
    assert all(len(open(r.path, "rb").read()) == r.n_bytes for r in written.collect())
    back = warc.read_archives(written).collect()
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(html or "", i)
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and first[html or ""] != i
        name = "urn:page" if i is None else f"urn:page:{i}"
        want.append((name, "revisit" if again else "response", url,
                     f"urn:page:{first[html or '']}" if again else None, len(data),
                     hashlib.sha256(data).hexdigest(), None if again else data))
    assert sorted(map(str, (tuple(r[:6]) + (r[6] and bytes(r[6]) if r[6] is not None else None,) for r in back))) == sorted(map(str, want))


def test_text_ids_come_back_whole(spark):
    ids = ["None", "a:b", "urn:page:7", "ü/%41 +&", "", None, "5"]
    rows = [(i, "u", f"payload {n} " * 20) for n, i in enumerate(ids)] + [("again", "u", "payload 1 " * 20)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect()}
    assert got == {i: ("response", None) for i in ids} | {"again": ("revisit", "a:b")}


def record(**change):
    data = b"payload " * 50
    args = dict(record_id="urn:page:1", url="u", payload=data, digest=hashlib.sha256(data).hexdigest()) | change
    return warc.record_bytes(**args)


def read(data):
    return [warc.read_record(m) for m in warc.members(io.BytesIO(data))]


def test_reader_goes_member_by_member(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    records = read(record() + record(record_id="urn:page:2", refers_to="urn:page:1"))
    assert [(r.record_type, r.payload_bytes) for r in records] == [("response", 400), ("revisit", 400)]
    assert read(b"") == []


@pytest.mark.parametrize("data", [
    record(digest="0" * 64), record()[:-9], record() + b"junk junk junk", record()[:40],
])
def test_broken_archives_are_refused(data):
    with pytest.raises((ValueError, warc.zlib.error)):
        read(data)


@pytest.mark.parametrize("name", ["topnav", "sideMenu", "ad-slot", "Cookie_Banner", "user-comments", "site-header", "legal"])
def test_furniture_by_its_name(name):
    page = f"<body><div id=text><p>{'good words ' * 9}</p></div><div class='{name}'><p>bad words</p></div></body>"
    assert articles.main_text(page) == ("good words " * 9).strip()
    assert articles.main_text(page.replace("class=", "id=")) == ("good words " * 9).strip()


def test_paths_survive_odd_names(spark):
    page = "<body><article id='post-9/a'><h1>H</h1><div class='w-1/2'><p>text</p></div></article><p>more</p></body>"
    found, _ = articles.best_path(articles.page_blocks(page))
    assert found == ("html", "body", "article#post-a") or found == ("body", "article#post-a")
    assert articles.main_text(page, "/".join(found)) == "H\ntext"


@pytest.mark.parametrize("name", ["category-legal", "tag-social", "category-trending", "comments-open"])
def test_topics_and_states_are_no_furniture(name):
    page = f"<body><{{0}} class='post-7 post {name}'><h1>T</h1><p>the text</p></{{0}}><div>stray</div></body>"
    assert articles.main_text(page.format("article")) == "T\nthe text"
    assert "the text" in articles.main_text(page.format("div"))


@pytest.mark.parametrize("name", ["related-work", "search-algorithms", "recommendations", "navigating-menus", "legal"])
def test_slugs_are_no_furniture(name):
    page = f"<body><article><h1>T</h1><section id='{name}'><h2 id='{name}'>H</h2><p id='{name}'>text</p></section></article></body>"
    assert articles.main_text(page) == "T\nH\ntext"
    bare = f"<body><h2 id='{name}' class='{name}'>H</h2><p>text</p><p class='{name}'>more</p></body>"
    assert articles.main_text(bare) == "H\ntext\nmore"


@pytest.mark.parametrize("name, kept", [
    ("ad", False), ("ad-slot", False), ("social-share", False), ("commentList", False), ("topnav", False),
    ("related-posts", False), ("category-legal", True), ("commentary", True), ("search-algorithms", True),
    ("header", True),
])
def test_in_an_article_the_whole_class_says_it(name, kept):
    page = f"<article><h1>T</h1><div class='x {name}'><p>part</p></div><p>text</p></article>"
    assert ("part" in articles.main_text(page)) is kept


def test_main_holds_furniture_by_any_word():
    page = "<body><main><div class='header'>H</div><p>text</p><div class='sidebar-left'><p>bad</p></div></main></body>"
    assert articles.main_text(page) == "H\ntext"


COMMENTS_AND_ADVERTS = [
    "<div id=comments>{}</div>", "<section id=comments>{}</section>", "<div id=respond>{}</div>",
    "<div id=disqus_thread>{}</div>", "<div class=post-comments>{}</div>",
    "<div class=article-comments>{}</div>", "<div class=entry-comments>{}</div>",
    "<div class=comment-thread>{}</div>", "<article class=comment>{}</article>",
    "<div class=inline-ad>{}</div>", "<div class=ad-top>{}</div>", "<div class=google-ads>{}</div>",
    "<div class=site-notice>{}</div>", "<ol class=commentlist><li>{}</ol>", "<div id=sidebar>{}</div>",
    "<div style='display: none'>{}</div>", "<ul id='comment-list'><li>{}</ul>",
]


@pytest.mark.parametrize("part", COMMENTS_AND_ADVERTS)
def test_no_comments_or_adverts_in_an_article(part):
    page = f"<body><article><h1>T</h1><p>text</p>{part.format('<p>bad words</p>')}<p>more</p></article>"
    assert articles.main_text(page) == "T\ntext\nmore"


@pytest.mark.parametrize("inline, text", [
    ("text<button>Share</button> more", "text more"),
    ("text <label>Name</label>more", "text more"),
    ("text <select><option>one</option><option>two</option></select>more", "text more"),
    ("text <svg><title>x</title><text>drawn</text></svg>more", "text more"),
    ("text <span class=ad>Buy</span>more", "text more"),
    ("text <span hidden>unseen</span>more", "text more"),
    ("text <b>bold <span class='ad-slot'>x</span><i>slanted</i></b> more", "text bold slanted more"),
    ("text <a href=x class=topic>linked</a> more", "text linked more"),
])
def test_inline_furniture(inline, text):
    assert articles.main_text(f"<article><p>{inline}</p></article>") == text


@pytest.mark.parametrize("page, text", [
    ("<body><div class=a><p>one block of text</p></div><div class=b><p>another block</p></div>",
     "one block of text\nanother block"),
    ("<div class=a>one block of text</div><div class=b>another block</div>",
     "one block of text\nanother block"),
    ("<body><article class=x><p>one story</p></article><article class=y><p>two stories</p></article><div>stray</div>",
     "one story\ntwo stories"),
    ("<body><div id=page><div class=a><p>one block</p></div><div class=b><p>another block, longer</p></div></div>",
     "one block\nanother block, longer"),
    ("<body><main><h1>Head</h1><article><p>" + "long story " * 9 + "</p></article></main><div>stray</div>",
     "Head\n" + ("long story " * 9).strip()),
    ("<body><div class=links><a href=1>one link</a> <a href=2>two links</a></div><div class=t>the text itself</div>",
     "the text itself"),
])
def test_siblings_stay_together(page, text):
    assert articles.main_text(page) == text


@pytest.mark.parametrize("mark", ["class=legal-text", "id=search-engines", "class='social-history'"])
def test_one_word_does_not_drop_most_of_a_page(mark):
    long = ("all the text of it " * 20).strip()
    assert articles.main_text(f"<body><div {mark}><p>{long}</p></div><p>stray</p>") == long
    inner = "<div class='sidebar-left'><p>brief</p></div>"
    assert articles.main_text(f"<body><div {mark}><p>{long}</p>{inner}</div><p>stray</p>") == long
    assert articles.main_text(f"<body><p>{long}</p><div {mark}><p>brief</p></div>") == long


@pytest.mark.parametrize("page", [
    "<div>t" * 17_000, "<i>" * 25_000 + "</b>" * 25_000, "<p>" * 33_000, "<h1>t" * 20_000,
    "<b><div>" + "<i>" * 12_000 + "</b>" * 12_000, "<a x=\"" * 15_000, "<script>" + "</script " * 11_000,
    "<ul><li>t" * 12_000, "<div class='sidebar-left x'>t" * 3_500, "<span class=ad>x" * 6_000,
])
def test_time_grows_with_the_page(page):
    began = time.process_time()
    articles.main_text(page)
    assert time.process_time() - began < 3  # a second, on an idle machine


class Reader(HTMLParser):
    """An independent reader of well-formed pages: a tree of lists, then its article's blocks."""

    BLOCKS = set("article h1 h2 p div section ul ol li blockquote table tr td figure figcaption pre".split())
    OUT = set("nav aside footer form button select svg script style".split())
    BAD = {"ad", "comments", "sidebar", "related-posts", "social-share"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = self.top = ["root", {}, [], None]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.top[2].append(" ")
        elif tag not in ("meta", "img", "hr"):
            node = [tag, dict(attrs), [], self.top]
            self.top[2].append(node)
            self.top = node

    def handle_endtag(self, tag):
        self.top = self.top[3]

    def handle_data(self, data):
        self.top[2].append(data)

    def article(self):
        out, held = [], []

        def flush():
            if text := " ".join("".join(held).split()):
                out.append(text)
            held.clear()

        def walk(node):
            tag, attrs, parts, _ = node
            if tag in self.OUT or attrs.get("class") in self.BAD or "hidden" in attrs:
                return
            if tag in self.BLOCKS:
                flush()
            for part in parts:
                held.append(part) if isinstance(part, str) else walk(part)
            if tag in self.BLOCKS:
                flush()

        def find(node):
            if node[0] == "article":
                walk(node)
            else:
                for part in node[2]:
                    if not isinstance(part, str):
                        find(part)

        find(self.root)
        flush()
        return "\n".join(out)


def generated(seed):
    rng = random.Random(seed)

    def words(n=8):
        return html.escape(" ".join(rng.choice(["tea", "x & y", "été", "a<b", "10", "漢字", "it's"]) for _ in range(rng.randint(1, n))))

    def inline(depth=2):
        parts = [words()]
        for _ in range(rng.randint(0, 3)):
            tag = rng.choice(["b", "i", "a href=/x", "span class=ad", "span", "button", "em", "span hidden"])
            inner = inline(depth - 1) if depth else words()
            parts.append(f"<{tag}>{inner}</{tag.split()[0]}>" + rng.choice([" ", "", "\n", "&nbsp;", "<br>"]) + words())
        return "".join(parts)

    def block(depth=3):
        kind = rng.choice(["p", "p", "h2", "ul", "blockquote", "div", "section", "table", "bad", "out", "figure", "note"])
        inner = "".join(block(depth - 1) for _ in range(rng.randint(1, 3))) if depth else f"<p>{inline()}</p>"
        return {
            "p": f"<p>{inline()}</p>", "h2": f"<h2 id='related-work'>{inline()}</h2>",
            "ul": "<ul>" + "".join(f"<li>{inline()}</li>" for _ in range(3)) + "</ul>",
            "blockquote": f"<blockquote>{inner}</blockquote>", "div": f"<div class='body-{rng.randint(0, 9)}'>{inner}</div>",
            "section": f"<section id=s{rng.randint(0, 9)}>{inner}</section>",
            "table": f"<table><tr><td>{inline()}</td><td>{inline()}</td></tr></table>",
            "bad": f"<div class={rng.choice(['ad', 'comments', 'sidebar', 'related-posts', 'social-share'])}>{inner}</div>",
            "out": f"<{(t := rng.choice(['aside', 'form', 'nav', 'svg', 'footer']))}>{inline()}</{t}>",
            "figure": f"<figure><img src=x><figcaption>{inline()}</figcaption></figure>",
            "note": "<!-- <p>no</p> --><script>var x='<p>';</script><style>p{}</style>",
        }[kind]

    story = "".join(block() for _ in range(rng.randint(1, 6)))
    return (
        f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{words()}</title></head><body><nav>{inline()}</nav>"
        f"<div class=ad>{inline()}</div><article><h1>{words()}</h1>{story}</article><footer>{inline()}</footer></body></html>"
    )


def test_agrees_with_an_independent_reader():
    for seed in range(300):
        page = generated(seed)
        assert articles.main_text(page) == Reader(page).article(), page


def test_agrees_on_the_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    for r in rows:
        # The pages leave <b> open and put <p> into it, which the reader doesn't mend.
        page = r.html.replace("<p><b>", "<p>").replace("<br><p>", "</p><p>")
        assert articles.main_text(r.html) == Reader(page).article()
