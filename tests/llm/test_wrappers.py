import html
import json
import random
import re
import time

from tagloom.llm import wrappers


def plain(page):
    """The article of the test pages, by their fixed form."""
    inside = page.split("<article>")[1].split("</article>")[0]
    parts = re.split("</?(?:p|h1)>", inside)
    parts = [" ".join(html.unescape(re.sub("</?b>", "", p).replace("<br>", " ")).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    given = {r.page_id: r for r in pages.collect()}
    got = wrappers.extract(pages).collect()
    assert len(got) == len(given)
    for r in got:
        assert r.text == plain(given[r.page_id].html) and r.n_chars == len(r.text) and r.url == given[r.page_id].url


def test_set_apart_parts():
    page = (
        "<html><head><title>T</title></head><body><header>H</header><nav>N</nav><div class='cookie-notice'>C</div>"
        "<article><h1>A &amp; B</h1><p>one <i>two</i>\n three<p>four&nbsp;five &#8364;<div class=\"share\">S</div>"
        "<aside>X</aside><form>F<input></form><ul><li>l1<li>l2</ul><script>var a='</p>';</script><!-- c -->"
        "<section id=comments><article><p>reader</p></article></section></article><footer>F</footer></body>"
    )
    assert wrappers.main_text(page, None) == "A & B\none two three\nfour five €\nl1\nl2"


def test_broken_pages():
    for page, want in [
        ("", ""),
        ("plain & text", "plain & text"),
        ("<p>one<p>two</b></div>", "one\ntwo"),
        ("<article><p>open", "open"),
        ("<p title=\"a>b\">x</p><p title='>'>y", "x\ny"),
        ("a < b <p>c", "a < b\nc"),
        ("<script>never closed <p>x", ""),
        ("<!-- never closed <p>x", ""),
        ("<p>x<![CDATA[ y ]]></p>", "x y"),
        ("<" * 5000, "<" * 5000),
        ("<p>" * 3000 + "deep", "deep"),
        ("<div>" * 3000 + "deep", "deep"),
    ]:
        assert wrappers.main_text(page, None) == want, page[:40]


def host(k, body):
    return f"<body><div><p>Welcome</p><p>All rights</p></div><div><section>{body}</section></div><p>Imprint {'.' * 0}</p></body>"


def test_wrapper_decides_without_article():
    texts = [["alpha beta " * 20, "gamma"], ["delta " * 30], ["epsilon " * 25, "zeta", "eta"], ["theta " * 40, "iota"]]
    pages = [host(k, "".join(f"<p>{t}</p>" for t in body)) for k, body in enumerate(texts)]
    told = wrappers.infer([wrappers.skeleton(p) for p in pages])
    assert told["main"] == "body/div/section"
    for page, body in zip(pages, texts, strict=True):
        assert wrappers.main_text(page, told) == "\n".join(" ".join(t.split()) for t in body)


def test_alignment_finds_groups():
    tags = lambda s: [("tag", t) if t[0] == "<" else ("text", "p", hash(t), len(t)) for t in s.split()]
    a = wrappers._fold(tags("<ul <li a </li <li b </li <li c </li </ul <p same </p"))
    b = wrappers._fold(tags("<ul <li d </li <li e </li </ul <hr <p same </p"))
    assert [x[0] for x in a] == ["tag", "plus", "tag", "tag", "text", "tag"]
    both = wrappers.align(a, b)
    assert [x[0] for x in both] == ["tag", "plus", "tag", "opt", "tag", "text", "tag"]
    assert both[1][1][1][2] is None and both[5][2] == hash("same")


def test_odd_rows(spark):
    rows = [
        (1, "http://a.b/c", "<p>x"), (1, "http://a.b/c", "<p>x"), (2, None, None), (None, "::bad::", "<p>y"),
        (3, "http://a.b:80/d", ""), (4, "http://[bad", "<p>" + "w " * 50000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS wrapper")
    got = wrappers.extract(pages).collect()
    assert sorted((repr(r.page_id), r.text[:3], r.n_chars) for r in got) == sorted(
        [("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("None", "y", 1), ("3", "", 0), ("4", "w w", 99999)]
    )
    assert wrappers.extract(pages.limit(0)).count() == 0


def test_wrappers_by_join(spark, sf, monkeypatch):
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", -1)
    test_pages(spark, sf)


def test_layout_classes_keep_the_article():
    for before, after in [
        ("<div class='content has-sidebar'><article>", "</article></div>"),
        ("<div class='no-sidebar layout header-fixed'><p>", "</p></div>"),
        ("<div class=sidebar><article>", "</article></div>"),
        ("<div class=widget><p>", "</p></div>"),
        ("<article class='post related'><p>r</p></article><article><header class=entry-header>", "</header></article>"),
        ("<article><div class=header><h1>", "</h1></div><div class='site-footer'>no</div></article>"),
    ]:
        assert wrappers.main_text(f"<body>{before}the text{after}<footer>F</footer></body>", None) == "the text", before
    page = "<div class='sidebar'><article>card</article></div><div><p>the whole of the text</p></div>"
    assert wrappers.main_text(page, None) == "the whole of the text"
    assert wrappers.main_text("<section id=comments><article>reader</article></section><p>a</p>", None) == "a"
    # The wrapper overrules a class where the host's changing text is.
    pages = [f"<body><div class=widget><p>{w * 30}</p></div><p>Imprint</p></body>" for w in ("a ", "b ", "c ", "d ")]
    told = wrappers.infer([wrappers.skeleton(p) for p in pages])
    assert wrappers.main_text(pages[0], told) == ("a " * 30).strip()


def test_all_pages_of_a_host(spark):
    """Two templates, a notice on most pages, a paragraph that four pages share."""
    words = lambda k, w: f"{w}{k} " * 25
    rows, want = [], {}
    for k in range(80):
        notice = "<p>We moved to a new office</p>" if k % 10 else ""
        same = "<p>The same words by chance</p>" if k in (3, 5, 7, 9) else ""
        if k % 8:
            body = f"<div class=top>{notice}</div><section class=text><p>{words(k, 'a')}</p>{same}</section>"
        else:
            body = f"<div class=top>{notice}</div><section class=text><p>note{k}</p></section><table><tr><td>{words(k, 'b')}</td></tr></table>"
        rows.append((k, f"http://h.org/{k}", f"<html><body>{body}</body></html>"))
        want[k] = words(k, "a" if k % 8 else "b").strip() + ("\nThe same words by chance" if same and k % 8 else "")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(pages).collect()}
    assert all("office" not in t for t in got.values())
    for k, t in want.items():
        assert t in got[k], k
        if k % 8:
            assert got[k] == t
    told = {r.host: json.loads(r.wrapper) for r in wrappers.learn(pages.selectExpr("'h.org' AS host", "url", "html")).collect()}
    assert len(told["h.org"]["shown"]) == 1


def test_wrapper_decides_on_marked_pages():
    def teasers(k):
        return "".join(f"<article class=card><h2>card {k} {n}</h2></article>" for n in range(3))

    words = [f"w{k} " * 60 for k in range(12)]
    # The main text is in a plain div, beside articles that are teasers.
    pages = [f"<body><div class=story><p>{w}</p></div><div class=more>{teasers(k)}</div></body>" for k, w in enumerate(words)]
    told = wrappers.infer([wrappers.skeleton(p) for p in pages])
    assert [wrappers.main_text(p, told) for p in pages] == [w.strip() for w in words]
    # A text inside every article of the host is not the page's own.
    pages = [f"<body><div><article><p>{w}</p><p>Read more here</p></article></div><p>x{k}</p></body>" for k, w in enumerate(words)]
    told = wrappers.infer([wrappers.skeleton(p) for p in pages])
    assert [wrappers.main_text(p, told) for p in pages] == [w.strip() for w in words]
    # Without a wrapper the tag decides.
    assert wrappers.main_text(pages[0], None) == words[0].strip() + "\nRead more here"


def test_long_groups_fold():
    card = "<div <h2 {0} </h2 <p {0}x </p <ul <li {0}y </li <li {0}z </li </ul <div q{0} </div <p more </p </div"
    tags = lambda s: [("tag", t) if t[0] == "<" else ("text", "p", hash(t), len(t)) for t in s.split()]
    two, five = (wrappers._fold(tags(" ".join(["<body", *(card.format(f"t{k}") for k in range(n)), "</body"]))) for n in (2, 5))
    assert [x[0] for x in two] == [x[0] for x in five] == ["tag", "plus", "tag"]
    both = wrappers.align(two, five)
    assert [x[0] for x in both] == ["tag", "plus", "tag"]
    assert [x[2] for x in both[1][1] if x[0] == "text"] == [None, None, None, hash("more")]
    # Nothing closes these, and these were never opened.
    assert [x[0] for x in wrappers._fold(tags("<li a <li b <li c </ul"))] == ["plus", "tag"]
    deep = wrappers._fold(tags("<div " * 3000 + "x " + "</p " * 3000))
    assert len(deep) == 6001


def test_headings_and_headlines_stay_on_hosts_of_any_size(spark):
    """Shared headings inside the article and the headline before it, with 3 to 1,000 pages."""
    words = [f"w{k} " * 60 for k in range(1000)]
    for mark in ("div class=story", "article"):
        body = "<h2>Introduction</h2><p>{w}</p><h2>Conclusion</h2><p>{w}end</p><p>Read more here</p>"
        page = "<body><h1>Site</h1><div class=top><h1>Title {k}</h1></div><" + mark + ">" + body + "</" + mark.split()[0] + "><p>Imprint</p></body>"
        for m in (3, 7, 8, 1000):
            rows = [(k, f"http://{m}.org/{k}", page.format(k=k, w=w)) for k, w in enumerate(words[:m])]
            pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
            for r in wrappers.extract(pages).collect():
                w = words[r.page_id]
                assert r.text == f"Title {r.page_id}\nIntroduction\n{w.strip()}\nConclusion\n{w}end", (mark, m)


def test_wrappers_stay_small():
    """A thousand pages of random blocks: the wrapper grows with the forms, not the pages."""
    random.seed(1)
    forms = ["<p>%s</p>", "<div><p>%s</p></div>", "<ul><li>%s</li><li>x</li></ul>", "<h2>%s</h2>", "<table><tr><td>%s</td></tr></table>"]
    wrapper, sizes = None, []
    for _ in range(1000):
        body = "".join(random.choice(forms) % f"t{random.random()}" for _ in range(random.randint(5, 20)))
        page = f"<body><div><p>Home</p></div><div class=story>{body}</div><p>Imprint</p></body>"
        wrapper = wrappers.joined(wrapper, wrappers.partial(wrappers.skeleton(page), frozenset()))
        sizes.append(len(json.dumps(wrapper)))
    assert sizes[-1] < 50_000 and sizes[-1] < 2.5 * sizes[255]


def test_deep_nesting_is_linear():
    started = time.time()
    for n in (20_000,):
        assert wrappers.main_text("<div>" * n + "deep" + "</div>" * n, None) == "deep"
    assert time.time() - started < 3
