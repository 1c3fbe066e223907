from __future__ import annotations

import random
from functools import cache

from encore.llm import html_extraction as h
from encore.llm.common import table

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Head &amp; line</h1><p>by someone</p></header><p><b>Fish &#38; chips&nbsp;é.<br>next
 line<p>Second <i>par</i>a<button>Buy</button>graph</p><!-- note --><div class="ad">Advert</div><ul><li>one<li>two</ul>
<form><input value="x">Subscribe</form><table><tr><td>c1<td>c2</table><noscript>no</noscript><pre>a
  b</pre><div hidden>secret</div></article>
<aside>Side</aside><section id="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; foot</footer></body></html>"""
SCHEMA = "page_id long, url string, html string"


def text_of(html):
    return "\n\n".join(t for _, t in h.blocks_of(html))


def test_article_without_its_surroundings():
    assert text_of(PAGE) == "\n\n".join(["Head & line", "Fish & chips é. next line", "Second paragraph", "one", "two", "c1", "c2", "a b"])


def test_without_article():
    assert text_of("<div role=main><p>in</div><div>out</div>") == "in"
    assert text_of("<body><div id=nav>m</div><div id=content>a<p>b</div>tail") == "a\n\nb\n\ntail"
    assert text_of("plain &lt;b&gt; text") == "plain <b> text"
    assert text_of("<ul><li><a href=/x>Menu</a><li>a <a href=/y>link</a> told</ul><p><a href=/z>Go</a></p>") == "a link told\n\nGo"
    assert text_of("<article><ul><li><a href=/x>Source</a></ul></article>") == "Source"


def test_an_article_is_not_lost_by_words_of_what_holds_it():
    body = "<article><p>told</article>"
    for page in (f"<div class='site has-sidebar'>{body}</div>", f"<form>{body}</form>", f"<div class=ad-free>{body}</div>",
                 "<article class='post comments-open'><p>told</article>", f"<div class='widget-area'><div>{body}</div></div>",
                 f"<div role=form>{body}</div>", "<section class=banner><main><p>told</main></section>"):
        assert text_of(page) == "told", page
    for page in (f"<nav>{body}</nav>", f"<div id=comments>{body}</div>", f"<div class=related>{body}</div>", "<form><p>Name</form>",
                 "<div class=cookie-notice>We use cookies</div>", "<article class=comment><p>First</article>", f"<div hidden>{body}</div>"):
        assert text_of(page) == "", page
    assert text_of(f"{body}<div class=widget><article><p>{'a longer teaser ' * 9}</article></div>") == "told"


def test_main_text_beside_articles_stays():
    assert text_of("<main><h1>Title</h1><p>lead</p><article><p>told</article></main>") == "Title\n\nlead\n\ntold"
    long = "a body of many words " * 9
    assert text_of(f"<div><p>{long}</div><article><p>teaser</article>") == f"{long.strip()}\n\nteaser"
    assert text_of(f"<div><p>by line</div><article><p>{long}</article>") == long.strip()
    assert text_of(f"<article><p>teaser</article><main><p>{long}</main>") == long.strip()
    assert text_of(f"<article><p>{long}</article><main><p>short</main>") == long.strip()


def test_comment_without_an_end():
    assert text_of("<article><p>told</p><!-- left <p>open</p></article>") == "told"
    assert text_of("<script>var x = '<!--';</script><p>told</p>") == "told"


def test_broken_markup():
    for html, text in ((None, ""), ("", ""), ("<", "<"), ("<p>a</div></span>b", "ab"), ("<article><p>x", "x"), ("<script>x", ""),
                       ("<div>" * 3000 + "deep", "deep"), ("</p></p>a&#0;b&bogus;", "a�b&bogus;")):
        assert text_of(html) == text


def test_constant_slots_of_a_host_are_template(spark):
    def page(i):
        return f"<body><div class='top'>Welcome to our site</div><div class='body'><p>Story {i} is long and told once.</p></div><div class='end'>All rights</div></body>"

    rows = [(i, f"http://H.org/{i}", page(i)) for i in range(5)]
    rows += [(9, "http://other.org/", page(9)), (10, None, None), (11, "http://copies.org/", page(1))] + [(12, "http://copies.org/", page(1))] * 3
    frame = spark.createDataFrame([(*r, "t") for r in rows], SCHEMA + ", text string").repartition(3)
    found = {(r.page_id, r.text, r.n_chars) for r in h.extract(frame, keep=["page_id", "text"]).collect()}
    story = "Story {} is long and told once."
    whole = "Welcome to our site\n\n{}\n\nAll rights"
    wanted = {(i, story.format(i)) for i in range(5)} | {(9, whole.format(story.format(9))), (10, "")}
    wanted |= {(11, whole.format(story.format(1))), (12, whole.format(story.format(1)))}
    assert found == {(i, t, len(t)) for i, t in wanted}
    assert {r.host for r in h.templates(frame).collect()} == {"h.org"}


def test_a_constant_paragraph_among_varying_siblings_is_template(spark):
    notice = "Subscribe to our newsletter today."

    def page(i):
        own = [f"Part {j} of story {i} is long and told once." for j in range(2 + i % 4)]
        own.insert(i % 3, notice)
        return "<article><h1>Title %d</h1>%s</article>" % (i, "".join(f"<p>{t}</p>" for t in own))

    frame = spark.createDataFrame([(i, f"http://h.org/{i}", page(i)) for i in range(6)], SCHEMA)
    for r in h.extract(frame.repartition(3)).collect():
        assert r.text == "\n\n".join([f"Title {r.page_id}"] + [f"Part {j} of story {r.page_id} is long and told once." for j in range(2 + r.page_id % 4)])


def test_near_copies_keep_their_text(spark):
    same = "".join(f"<p>The same paragraph {j} on all of them.</p>" for j in range(5))
    rows = [(i, "http://h.org/", f"<article>{same}<p>word {i}</p></article>") for i in range(30)]
    rows += [(100 + i, "http://h.org/", f"<article><p>A page of its own, the {i}th of some.</p></article>") for i in range(20)]
    for r in h.extract(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.text == text_of(dict((i, p) for i, _, p in rows)[r.page_id])


def random_tree(rng, depth):
    def grow(parent, level):
        for _ in range(rng.randint(1, 3)):
            if level < depth and rng.random() < 0.5:
                labels.append(rng.randint(1, 2))
                parents.append(parent)
                grow(len(labels) - 1, level + 1)
            else:
                at.append(parent)
    labels, parents, at = [0], [-1], []
    grow(0, 0)
    return h.tree(labels, parents, at, [rng.randint(1, 6) for _ in at])


def heaviest(a, b):
    """The weight of the heaviest ordered matching, by trying everything."""
    def pair(x, y):
        if x[0] != y[0]:
            return 0
        return (h.EQUAL if x[1] == y[1] else 1) if x[0] == h.TEXT else 1 + heaviest(x[3], y[3])

    @cache
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        return max(best(i + 1, j), best(i, j + 1), pair(a[i], b[j]) + best(i + 1, j + 1) if a[i][0] == b[j][0] else 0)

    return best(0, 0)


def test_matching_is_the_heaviest(monkeypatch):
    rng = random.Random(5)
    trees = [random_tree(rng, 3) for _ in range(60)]
    for a, b in zip(trees, trees[1:]):
        m = h.Matching()
        assert m.siblings(a, b)[0] == heaviest(a, b)
        blocks = list(m.blocks(a, b))
        assert blocks == sorted(blocks) and [x[1] for x in blocks] == sorted({x[1] for x in blocks})
    monkeypatch.setattr(h, "SIBLING_PAIRS", 3)
    for a, b in zip(trees, trees[1:]):
        assert h.Matching().siblings(a, b)[0] <= heaviest(a, b)
        assert h.Matching().siblings(a, a)[0] == heaviest(a, a)


def test_very_long_pages(spark):
    def page(i):
        own = [f"<p>Paragraph {j} of page {i}, told once.</p>" for j in range(20 if i else 20_000)]
        return "<article><p>A notice on all pages.</p>%s<p>Rights.</p></article>" % "".join(own)

    rows = [(i, "http://h.org/", page(i)) for i in range(6)]
    for r in h.extract(spark.createDataFrame(rows, SCHEMA)).collect():
        texts = r.text.split("\n\n")
        assert len(texts) == (20 if r.page_id else 20_000) and texts[0] == f"Paragraph 0 of page {r.page_id}, told once."


def test_given_pages_read_plainly(spark):
    """The given pages have one article each, in which only adverts are no content."""
    import html
    import re

    pages = table(spark, "/root/testdata/sf0.001", "pages")
    texts = {r.page_id: r.text for r in h.extract(pages).collect()}
    for r in pages.collect():
        found = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        inner = re.sub(r"<(script|style|aside|nav|footer|form)\b.*?</\1>|<!--.*?-->|<div class=.?ad.?>.*?</div>", "", found[1] if found else "", flags=re.S)
        words = html.unescape(re.sub(r"<[^>]*>", " ", inner)).split()
        assert "".join(texts[r.page_id].split()) == "".join(words), r.page_id


def test_no_rows(spark):
    assert h.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def texts_of(spark, htmls):
    frame = spark.createDataFrame([(i, "http://h.org/", html) for i, html in enumerate(htmls)], SCHEMA)
    return [r.text for r in h.extract(frame).orderBy("page_id").collect()]


def test_template_that_the_pages_of_least_digest_lack(spark):
    def page(i, sign):
        return f"<body><div><h1>Title {i}</h1><p>{f'told {i} ' * 9}</p>{'<div class=sign>Write to us</div>' if sign else ''}</div>"

    rows = [(i, "http://h.org/", page(i, i < 18)) for i in range(118)]
    digest = {r.k0: r.digest for r in h.read_pages(spark.createDataFrame(rows, SCHEMA), "url", "html", ["page_id"]).collect()}
    lacking = sorted(range(18, 118), key=digest.get)[:2]
    assert max(digest[i] for i in lacking) < min(digest[i] for i in range(18))
    texts = texts_of(spark, [rows[i][2] for i in [*range(18), *lacking]])
    assert not any("Write to us" in t for t in texts) and all(f"told {i}" in texts[i] for i in range(18))


def test_template_of_a_host_of_long_pages(spark):
    texts = texts_of(spark, [
        f"<body><div>{''.join(f'<p>told {i} {j}</p>' for j in range(h.REFERENCE_BLOCKS + 20))}<div class=sign>Write to us</div></div>" for i in range(5)])
    assert not any("Write to us" in t for t in texts)
    assert all(t.count("told") == h.REFERENCE_BLOCKS + 20 for t in texts)


def test_matching_of_long_lists_is_the_heaviest(monkeypatch):
    rng = random.Random(6)
    trees = [random_tree(rng, 3) for _ in range(60)]
    monkeypatch.setattr(h, "SIBLING_PAIRS", 0)
    monkeypatch.setattr(h, "WEIGHTS_AT_ONCE", 5)
    for a, b in zip(trees, trees[1:]):
        weight, pairs = h.Matching().siblings(a, b)
        assert weight == heaviest(a, b) == sum(h.Matching().weight(x, y) for x, y in pairs)
        blocks = list(h.Matching().blocks(a, b))
        assert blocks == sorted(blocks) and [x[1] for x in blocks] == sorted({x[1] for x in blocks})


def test_a_repeated_notice_among_many_siblings_is_template(spark):
    notice = "<p>Write to us.</p>"

    def page(i):
        own = [f"<p>told {i} {j}</p>" for j in range(60 + i)]
        return "<article>%s</article>" % "".join([*own[:10 + 3 * i], notice, *own[10 + 3 * i:40 + i], notice, *own[40 + i:]])

    for i, text in enumerate(texts_of(spark, [page(i) for i in range(6)])):
        assert text.split("\n\n") == [f"told {i} {j}" for j in range(60 + i)]


def test_template_that_the_pages_of_least_digest_show_elsewhere(spark):
    def page(i, sign):
        own = f"<h1>Title {i}</h1><p>{f'told {i} ' * 9}</p>"
        return f"<body><div>{own}{'<div class=sign>Write to us</div>' if sign else '<p>They said:</p><blockquote>Write to us</blockquote>'}</div>"

    rows = [(i, "http://h.org/", page(i, i < 18)) for i in range(118)]
    digest = {r.k0: r.digest for r in h.read_pages(spark.createDataFrame(rows, SCHEMA), "url", "html", ["page_id"]).collect()}
    elsewhere = sorted(range(18, 118), key=digest.get)[:2]
    assert max(digest[i] for i in elsewhere) < min(digest[i] for i in range(18))
    texts = texts_of(spark, [rows[i][2] for i in [*range(18), *elsewhere]])
    assert not any("Write to us" in t for t in texts[:18]) and all(t.endswith("Write to us") for t in texts[18:])


def test_every_page_is_aligned_with_every_wrapper_page(monkeypatch):
    aligned, blocks = [], h.Matching.blocks
    monkeypatch.setattr(h.Matching, "blocks", lambda self, a, b: aligned.append((a, b)) or blocks(self, a, b))
    page = [0, 5], [-1, 0], [0, 1], [1, 2]
    other = [0, 5], [-1, 0], [0, 1], [3, 4]
    known = [(h.tree(*p), {0, 1}) for p in (page, other)]
    assert list(h._shown(known, *other)) == [[], [(0, 0), (1, 1)]] and len(aligned) == 2


def test_very_deep_pages(spark):
    def page(i):
        return "<div><b>Our site</b>" + "<div>" * 3000 + f"<p>{f'told {i} ' * 9}</p><div class=sign><p>Write to us</p></div>" + "<p>more " * (i % 3)

    assert len(h.page_of(page(0))[0]) == 3005
    for i, text in enumerate(texts_of(spark, [page(i) for i in range(6)])):
        assert text == "\n\n".join([f"told {i} " * 8 + f"told {i}"] + ["more"] * (i % 3))
