import random
import time

from helpers import clashing, frame, prose, rows_of

from tidemark.llm import pages
from tidemark.llm.pages import Page, extract_text, main_blocks

SCHEMA = "page_id bigint, url string, html string"


def text_of(source, template=()):
    return main_blocks(Page(source), list(template))


def test_marked_article():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="with-sidebar">
    <nav><ul><li><a href="/">Home</a><li>Menu</ul></nav><div class="ad">Buy</div><div id="cookie-notice"><p>We use cookies</div>
    <article><header><h1>Big &amp; bold</h1><p>by someone</p></header><p>One <b>bold</b>word<br>next&nbsp;line<p>Two
      lines <i>x</i>.</p><script>bad()</script><form><input value=x><label>mail</label></form><aside>see also</aside>
    <ul><li>first<li>second</ul><table><tr><td>c1<td>c2</table><!-- hidden --><div class="comments"><article class="comment"><p>nice</article></div></article>
    <footer>&copy; us</footer></body>"""
    assert text_of(source) == ["Big & bold", "One boldword next line", "Two lines x.", "first", "second", "c1", "c2"]


def test_odd_markup():
    assert text_of("") == [] and text_of("<") == ["<"] and text_of("a < b & c > d &amp") == ["a < b & c > d &"]
    assert text_of("<article><p>cut &lt;b&gt;<p title='a>b'>x</p><p cl") == ["cut <b>", "x"]
    assert text_of("<article>" + "<div>" * 3000 + "deep") == ["deep"]
    assert text_of("<main><p>one</p></main><p>out</p>") == ["one"]
    assert text_of("<p>out</p><div class='post-content'><p>one</p><div class='advertorial'>ad</div></div>") == ["one"]
    assert text_of("<div id=content><p>lead</p><main><p>in main</p><article><p>in it</p></article></main></div>") == ["in it"]
    assert text_of("<article><p>a</p><ins class='adsbygoogle'>buy</ins><p>b <span class='share-box'>tweet</span>c</p></article>") == ["a", "b c"]
    assert text_of("<div class='sidebar-wrap'><article>kept</article></div><!-- open") == ["kept"]
    assert text_of("<script>never closed <article>no</article>") == []
    long = "word " * 200_000
    assert text_of(f"<article><p>{long}</p></article>") == [long.strip()]


def site(host, n, seed, marked, rng=random.Random(1)):
    rng = random.Random(seed)
    out, want = [], []
    for k in range(n):
        body = [prose(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 5))]
        inner = "".join(f"<p>{p}</p>" for p in body)
        main = f"<article><h1>Title {k}</h1>{inner}</article>" if marked else f'<div class="x9"><h2>Title {k}</h2>{inner}</div>'
        out.append((f"http://{host}/{k}", f'<html><body><div class="q1"><p>Welcome to {host}</p><p>Pick a topic</p></div>{main}<div class="q2"><p>Written by {host}</p></div></body></html>'))
        want.append("\n".join([f"Title {k}", *body]))
    return out, want


def test_templates_find_unmarked_articles(spark):
    a, want_a = site("a.org", 12, 1, False)
    b, want_b = site("b.org", 9, 2, True)
    rows = [(k, u, h) for k, (u, h) in enumerate(a + b)]
    got = extract_text(clashing(frame(spark, rows, SCHEMA), "text", "n_chars", "host", "template").repartition(3)).collect()
    assert [(r.text, r.n_chars) for r in sorted(got)] == [(t, len(t)) for t in want_a + want_b]
    templates = {r.host: r.template for r in pages.deduce_templates(frame(spark, rows, SCHEMA)).collect()}
    assert set(templates) == {"a.org", "b.org", None}
    assert len(templates["a.org"]) >= 6  # frame elements and the three fixed texts


def test_copies_of_an_article_are_kept(spark):
    page = site("c.org", 1, 3, True)
    rows = [(k, f"http://c.org/{k}", page[0][0][1]) for k in range(20)]
    assert {r.text for r in extract_text(frame(spark, rows, SCHEMA)).collect()} == {page[1][0]}


def test_copies_do_not_vote_a_text_into_the_template(spark):
    two, want_two = site("d.org", 1, 4, False)
    half, want_half = site("e.org", 9, 5, False)
    copies = [(f"http://e.org/copy{k}", half[0][1].replace("<body>", f"<body><script>track({k})</script>")) for k in range(9)]
    rows = [(k, u, h) for k, (u, h) in enumerate(two * 2 + half + copies)]
    got = [r.text for r in sorted(extract_text(frame(spark, rows, SCHEMA).repartition(3)).collect())]
    assert all(want_two[0] in t for t in got[:2]) and got[0] == got[1]
    assert got[2:] == want_half + [want_half[0]] * 9
    sizes = {(r.host, r.pages, r.vector != 0) for r in pages.occurrences(frame(spark, rows, SCHEMA)).where("token = 0").collect()}
    assert sizes == {("d.org", 1, True), ("e.org", 9, True), (None, 10, True)}


def test_the_template_decides_inside_marked_articles(spark):
    rng = random.Random(7)
    bodies = [[prose(rng, 9), prose(rng, 8)] for _ in range(10)]
    shared = prose(rng, 10)  # a real paragraph on half of the pages

    def page(k, start, end):
        own = "".join(f"<p>{p}</p>" for p in bodies[k]) + (f"<p>{shared}</p>" if k % 2 else "")
        return f'<body>{start}<h1>T{k}</h1>{own}<div class="zz9"><p>Tell your friends</p></div><p>Thanks for reading</p>{end}</body>'

    want = ["\n".join([f"T{k}", *bodies[k]] + [shared] * (k % 2)) for k in range(10)]
    ways = {"m.org": ("<article>", "</article>"), "u.org": ('<div class="x9">', "</div>"), "f.org": ("<form id=aspnet><article>", "</article></form>"), "w.org": ('<div class="page-banner">', "</div>")}
    rows = [(100 * n + k, f"http://{host}/{k}", page(k, *way)) for n, (host, way) in enumerate(ways.items()) for k in range(10)]
    got = [r.text for r in sorted(extract_text(frame(spark, rows, SCHEMA).repartition(3)).collect())]
    assert got == want * 4


def test_nothing_is_lost_where_nothing_varies(spark):
    same = "<article><h1>One title</h1><p>one text</p></article>"
    bare = '<div class="x9"><h2>Two title</h2><p>two text</p></div>'
    near = '<div class="x9"><h2>Title</h2><p>shared text</p><p>only {}</p></div>'
    rows = [(k, f"http://{h}/{k}", f"<nav>menu {k}</nav>" + b.format(k)) for k, (h, b) in enumerate([("g.org", same)] * 2 + [("h.org", bare)] * 2 + [("i.org", near)] * 2)]
    got = [r.text for r in sorted(extract_text(frame(spark, rows, SCHEMA)).collect())]
    assert got == ["One title\none text"] * 2 + ["Two title\ntwo text"] * 2 + ["Title\nshared text\nonly 4", "Title\nshared text\nonly 5"]


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "http://h/", None), (2, "http://h/", ""), (None, "x", "<p>t</p>"), (3, "://", "<article>é\U0001f600</article>"), (3, "://", "<article>é\U0001f600</article>")]
    got = rows_of(extract_text(frame(spark, rows, SCHEMA)))
    assert got == sorted([(1, None, "", 0), (2, "http://h/", "", 0), (2, "http://h/", "", 0), (None, "x", "t", 1), (3, "://", "é\U0001f600", 2), (3, "://", "é\U0001f600", 2)], key=repr)
    assert extract_text(frame(spark, [], SCHEMA)).collect() == []


def test_classes_must_be_in_order_and_nest():
    page = Page("<div class=a><div class=b><p>x</p></div></div><div class=c>y</div>")
    h = [t[0] for t in page.tokens]
    both = [(h[0], 1, 0.0, 9), (h[1], 1, 1.0, 9)]
    assert pages.placed_classes(page, both) == {0, 1}
    assert pages.placed_classes(page, [(h[0], 1, 5.0, 9), (h[1], 1, 1.0, 9)]) == set()  # other order than on the host
    crossing = [(h[0], 1, 0.0, 9), (h[3], 1, 3.0, 9), (h[1], 2, 1.0, 8), (h[4], 2, 4.0, 8)]
    assert pages.placed_classes(page, crossing) == {0, 3}
    assert pages.placed_classes(page, [(h[0], 1, 0.0, 9), (12345, 1, 1.0, 9)]) == set()


def near_copies(n, marked, part, article):
    """Pages of one host that differ in a date or a counter only; ``part`` gives body and date elements of their own."""
    tag = "article" if marked else "div class='x9'"
    end = tag.split()[0]
    out = []
    for k in range(n):
        head = f"<p>{k + 1} May</p>" if part != "inline" else ""
        body = "".join(f"<p>{t}{f' ({k} views)' if part == 'inline' and i == 0 else ''}</p>" for i, t in enumerate(article))
        if part == "own":
            head, body = f"<div class='d1'>{head}</div>", f"<div class='b1'>{body}</div>"
        out.append((k, f"http://one.example/{n}/{k}", f"<html><body><nav><a>Home</a> <a>News</a></nav><{tag}>{head}{body}</{end}><footer>About us</footer></body></html>"))
    return out


def test_near_copies_keep_their_articles(spark):
    rng = random.Random(6)
    article = [prose(rng, 40), prose(rng, 30), prose(rng, 50)]
    for n in (2, 10, 100):
        for marked in (True, False):
            for part in ("block", "own", "inline"):
                rows = near_copies(n, marked, part, article)
                got = {r.page_id: r.text for r in extract_text(frame(spark, rows, SCHEMA)).collect()}
                for k, _, _ in rows:
                    for t in article:
                        assert t in got[k], (n, marked, part)


def test_near_copies_beside_other_articles(spark):
    rng = random.Random(7)
    article = [prose(rng, 40), prose(rng, 30)]
    for marked in (True, False):
        rows = near_copies(10, marked, "block", article)
        other = [prose(rng, 60), prose(rng, 20)]
        rows += [(50, "http://one.example/50", near_copies(1, marked, "block", other)[0][2])]
        got = {r.page_id: r.text for r in extract_text(frame(spark, rows, SCHEMA)).collect()}
        assert all(t in got[k] for k in range(10) for t in article) and all(t in got[50] for t in other)


def test_stray_quotes_and_attributes():
    assert text_of("<article><p title=it's>One two three.</p><p>Four five.</p><p>They don't six.</p><p>Seven</p></article>") == ["One two three.", "Four five.", "They don't six.", "Seven"]
    assert text_of("<article><p title=it's>One</p><p>Two</p></article>") == ["One", "Two"]
    assert text_of("<article><p title = 'a > b' x=\"c > d\" y=1'>One</p><p '>Two</p></article>") == ["One", "Two"]
    assert text_of("<article><p>kept</p><p x=\"never closed>in the tag</p>") == ["kept", "in the tag"]


def test_tokeniser_is_linear():
    for piece in ("<!", "<a ", "<a b=\"", "<a b='", "<?", "<!--", "<a b=\"x\" ", "<p>x<!", "=\"", "<a =>"):
        for tail in ("", ">", "\">"):
            took = []
            for size in (250_000, 1_000_000):
                source = piece * (size // len(piece)) + tail
                start = time.time()
                Page(source)
                took.append(time.time() - start)
            assert took[1] < 12 * max(took[0], 0.1), (piece, tail, took)
