import html
import random
import re

from courtline.llm import template_extract as X


def page(i, body, nav="<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>", extra="", foot="<footer>&copy; host</footer>"):
    return (f"<!DOCTYPE html><html><head><title>t{i}</title><style>p{{margin:0}}</style><script>var t=\"</p><p>no\";</script></head><body>{nav}{extra}"
            f"{body}{foot}</body></html>")


def test_article_with_everything_around():
    r = random.Random(1)
    pages, want = [], []
    for i in range(6):
        paras = [" ".join(r.choice(["a", "bé", "c&amp;d", "1 &lt; 2", "x\n\t y"]) + str(r.random())[2:6] for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 5))]
        body = f"<article><h1>Title {i}</h1>" + "".join(f"<p>{p}</p>" for p in paras) + \
            f"<aside>side {i}</aside><form><p>mail {i}</p><input></form><div class='share-bar'>share {i}</div></article><section id=comments><p>first! {i}</p></section>"
        pages.append(page(i, body, extra=f"<div class=\"ad\">buy {i}</div><div id='cookie-notice'><p>we use cookies {i}</p></div><div class=sidebar>s{i}</div>"))
        want.append("\n".join([f"Title {i}"] + [re.sub(r"\s+", " ", html.unescape(p)) for p in paras]))
    assert X.extract(pages) == want
    assert [X.extract([p])[0] for p in pages] == want               # alone too


def test_without_article_the_varying_region_is_content():
    pages = [page(i, f"<div class=top>Welcome to our site</div><div class=main-text><p>story {i} {'word ' * (20 + i)}</p><p>end {i}</p></div><div class=bottom><p>About us</p></div>",
                  extra=f"<div class=ad>ad {i}</div>") for i in range(8)]
    assert X.extract(pages) == [f"story {i} {'word ' * (20 + i)}".strip() + f"\nend {i}" for i in range(8)]


def test_constant_text_inside_the_article_is_template():
    pages = [page(i, f"<article><p>Read more like this</p><p>own {i}</p></article>") for i in range(6)]
    assert X.extract(pages) == [f"own {i}" for i in range(6)]
    assert X.extract(pages[:3]) == [f"Read more like this\nown {i}" for i in range(3)]      # too few pages to tell
    assert X.extract([pages[0]] * 9) == ["Read more like this\nown 0"] * 9                   # copies tell nothing


def test_every_layout_of_a_host_has_its_region():
    story = lambda i: f"<h1>Head {i}</h1><p>story {i} {'word ' * 30}</p>"
    want = lambda i: f"Head {i}\nstory {i} {'word ' * 30}".strip()
    for many, few in (("<article>{}</article>", "<div class=content>{}</div>"), ("<div class=a>{}</div>", "<div class=b>{}</div>")):
        pages = [page(i, (few if i % 12 == 5 else many).format(story(i)), extra=f"<div class=date>on {i}</div>") for i in range(60)]
        assert X.extract(pages) == [want(i) for i in range(60)]
    one = [page(i, f"<div class=a>{story(i)}</div>") for i in range(20)] + [page(99, f"<div class=a>more</div><div class=odd>{story(99)}</div>")]
    assert X.extract(one)[-1] == "more\n" + want(99)


def test_layout_classes_and_wrappers_keep_the_article():
    body = "<article><header class='entry-header banner'><h1>Head</h1></header><p>story one</p></article>"
    for mark in ("has-sidebar", "no-sidebar", "with-banner", "elementor-widget-text-editor", "sidebar", "widget", "menu main-nav"):
        assert X.extract([page(1, f"<div class='{mark}'>{body}</div>")]) == ["Head\nstory one"]
    assert X.extract([page(1, f"<form id=aspnet>{body}</form>")]) == ["Head\nstory one"]
    assert X.extract([page(1, f"<div class=banner><p>no</p><main>{body}</main></div><article>teaser</article>")]) == ["Head\nstory one\nteaser"]
    for mark in ("share-bar", "main-nav", "ad-300x250", "related-posts", "cookie_notice_box", "post-comments"):
        assert X.extract([page(1, body.replace("<p>", f"<div class='x {mark}'>no</div><p>"))]) == ["Head\nstory one"], mark
    assert X.extract([page(1, "<div class=site-header>no</div><div class=page-header>Head</div><p>story</p>")]) == ["Head\nstory"]
    # teasers and comments aren't the page's content
    for wrap in ("<aside>{}</aside>", "<section id=comments>{}</section>", "<div class=related-posts>{}</div>"):
        assert X.extract([page(1, "<div class=text><p>the story itself</p></div>" + wrap.format("<article>a teaser</article>"))]) == ["the story itself"]


def test_blocks_of_an_article_stay_when_they_repeat():
    story = lambda i: f"<p>first {i}</p><p class=by>By Jane</p><h2>Methods</h2><p>second {i} <a>see all</a><br></p>"
    for around in ("<article>{}</article>", "<main><div>{}</div></main>", "<div class=text>{}</div>"):
        pages = [page(i, around.format(f"<h2>Introduction</h2>{story(i)}<p>Read more</p>")) for i in range(9)]
        assert X.extract(pages) == [f"Introduction\nfirst {i}\nBy Jane\nMethods\nsecond {i} see all" for i in range(9)]


def test_near_copies_are_no_template():
    text = [" ".join(f"w{a}x{b}" for b in range(10)) for a in range(5)]
    for n in (3, 4, 30):
        pages = [page(i, "<article>" + "".join(f"<p>{t}</p>" for t in text[:2]) + f"<p>copy{i} {text[2]}</p>" + f"<p>{text[3]}</p></article>") for i in range(n)]
        pages += [page(i, f"<article><p>other {i * i} page{i}</p></article>") for i in range(n // 4)]
        assert X.extract(pages)[:n] == ["\n".join([*text[:2], f"copy{i} {text[2]}", text[3]]) for i in range(n)]
    r = random.Random(2)
    sets = [{f"w{r.randrange(60)}" for _ in range(40)} for _ in range(40)]
    sets += [(s | {f"new{i}"}) - set(sorted(s)[:r.randrange(4)]) for i, s in enumerate(sets * 3)] + [set(), set()]
    first = []
    for i, s in enumerate(sets):
        first.append(next((j for j in range(i) if first[j] == j and s and 100 * len(s & sets[j]) >= X.NEAR_PERCENT * len(s | sets[j])), i))
    assert X.near_copies(sets) == first and len(set(first)) < len(sets)


def test_markup_of_all_kinds():
    body = ("<ARTICLE class='x'><p>a <b>bold</B><i>er</i> &#233;&#x41;&nbsp;z<br>next<p>unclosed &copy<li>item<table><tr><td>c1<td>c2</table>"
            "<!-- no <p>no</p> --><![CDATA[raw <p>]]><pre> keeps\n  one </pre><noscript>no</noscript><textarea><p>no</textarea><svg><text>no</text></svg>"
            "<header><h2>in</h2></header><p hidden>no</p><p style='display:none'>no</p><div/>1 < 2 > 1<p title='a>b'>q</article>")
    assert X.extract([body])[0].split("\n") == ["a bolder éA z next", "unclosed ©", "item", "c1", "c2", "raw <p>", "keeps one", "in", "1 < 2 > 1", "q"]
    assert X.extract(["", "<", "text only", "<p>", "<article></article>", "<p>a</p><p>b</p>"])[2:] == ["text only", "", "", "a\nb"]


def test_classes_share_vectors_and_nest():
    pages = [X.parse(page(i, "<article>" + f"<p>v{i}</p>" * (1 + i % 3) + "</article>")) for i in range(6)]
    t = X.Template(pages)
    by = {token: c for c, tokens in enumerate(t.classes) for token in tokens}
    outer = by[("open", "/html/body")]
    assert by[("close", "/html/body/footer")] == outer and by[("open", "/html/body/article")] == outer
    inner = by[("open", "/html/body/article/p")]
    assert inner != outer and by[("close", "/html/body/article/p")] == inner and t.parents[inner] == outer


def test_documents_of_the_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r.page_id: r for r in X.main_text(spark.createDataFrame(rows).repartition(3)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        m = re.search(r"<article>(.*?)(?:</article>|<footer|$)", r.html, re.DOTALL)
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", m[1].replace("<br>", " "))]
        assert got[r.page_id].text == "\n".join(b for b in want if b) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_hosts_in_chunks_nulls_repeats_empty(spark, monkeypatch):
    monkeypatch.setattr(X, "CHUNK_BYTES", 400)
    rows = [(i, f"https://u:p@Big.example:80/{i}?x", page(i, f"<article><p>own {i}</p></article>")) for i in range(30)]
    rows += [(100, None, page(1, "<article>n</article>")), (101, "no url", None), (None, "http://h/", "<article>a</article>"), (102, "http://h/", ""), (5, rows[5][1], rows[5][2])]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, chunk int, host string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in X.main_text(df).collect()), key=str)
    text = lambda h: X.extract([h or ""])[0]
    assert got == sorted(((a, b, text(c), len(text(c))) for a, b, c in rows), key=str)
    assert X.main_text(df.limit(0)).count() == 0


def test_slots_that_are_fields_of_the_template_are_left_out():
    r = random.Random(3)
    story = lambda i: f"<h1>Head {i}</h1><p>story {i} {' '.join(f'w{r.random()}' for _ in range(9))}</p><div class=lead>own text of {' '.join(f'v{r.random()}' for _ in range(9))}</div>"
    box = lambda i: f"<div class=meta>Logged in as <b>user{i}</b>, {i * 7 % 40 + 1} degrees</div>"
    for around in ("<main>{}</main>", "<article>{}</article>", "<div class=text>{}</div>", "<div class=a>{}</div>"):
        bodies = [story(i) for i in range(12)]
        pages = [page(i, around.format(box(i) + body)) for i, body in enumerate(bodies)]
        want = X.extract([page(i, around.format(body)) for i, body in enumerate(bodies)])
        assert X.extract(pages) == want and all("Logged" not in t and f"Head {i}" in t and "own text" in t for i, t in enumerate(want))
        guest = page(99, around.format("<div class=meta>Welcome to the story of stories</div>" + story(99)))
        assert "Welcome to the story of stories" in X.extract([*pages, guest])[-1]              # not the template's line
        assert X.extract(pages[:3])[0].startswith("Logged in as user0, 1 degrees")              # too few pages to tell
    # unmarked paragraphs and headings are running text; a page that has nothing else keeps its line
    for body in ("<main><p>Logged in as user{}, today</p><p>x{}</p></main>", "<main><h2 class=m>Logged in as user{}, today</h2><p>x{}</p></main>",
                 "<main><div class=m>Logged in as user{}, today</div></main>"):
        pages = [page(i, body.format(i, i)) for i in range(9)]
        assert all(f"Logged in as user{i}, today" in t for i, t in enumerate(X.extract(pages))), body
    # a slot with a child class holds structure
    pages = [page(i, f"<main><p>x{i}</p><div class=m>Part one of <p>many {i}</p></div></main>") for i in range(9)]
    assert X.extract(pages) == [f"x{i}\nPart one of\nmany {i}" for i in range(9)]
