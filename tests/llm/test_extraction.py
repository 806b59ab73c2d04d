"""Tree matching against all alignments, parsing of loose markup, and pages whose main text is known."""

import random
from functools import lru_cache

import pytest
from churnkit.llm import extraction as X
from churnkit.llm.htmltree import blocks, dump, load, match, parse
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string"

PARTS = """<header><a href=/>Home</a> Site</header><nav><ul><li><a href=/a>A</a><li><a>B</a></ul></nav><div class="ad">Buy {n}</div>
<div class="cookie-notice">We use {n}</div><aside>Other {n}</aside><form>Search <input> <button>Go</button></form>
<script>var x = "<p>no</p>";</script><style>p {{}}</style>"""
COMMENTS = '<section id="comments"><p>Reader {n} says so</p></section><div class=sidebar>More {n}</div><footer>&copy; {n}</footer>'


def text(tree):
    return [b[1] for b, _ in blocks(tree)]


@pytest.mark.parametrize(("page", "found"), [
    ("", []), ("plain  text\n", ["plain text"]), ("<p>a<p>b &amp;c&#33;<br>d", ["a", "b &c! d"]), ("<ul><li>x<li>y</ul>z", ["x", "y", "z"]),
    ("<p><b>one<br><p>two</b> three", ["one", "two three"]), ("a <b>b</b><i>c</i><div>d</div>e", ["a bc", "d", "e"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("x<!-- <p>no</p> -->y<script>if (a<b) '</p>'</script>z", ["xyz"]),
    ("<title>T &lt;</title><p title=\"a>b\">q</p></div></p>w", ["q", "w"]), ("1 < 2 <3 &bogus; &nbsp; é", ["1 < 2 <3 &bogus; é"]),
    ("<nav>menu</nav>b<div hidden>h</div><div style='display: none'>i</div>", ["b"]), ("<script>never closed", []),
    ("<a <b>x", ["x"]), ("<div class='no-comments'>kept</div><div class='wpComments'>gone</div>", ["kept"]), ("<p>a<!-- open", ["a"]),
])
def test_blocks_of_loose_markup(page, found):
    tree = parse(page)[1]
    assert text(tree) == found
    assert load(dump(tree)) == tree


def test_matching_is_greatest():
    rng = random.Random(1)

    def tree(depth):
        if depth and rng.random() < 0.4:
            return [None, rng.choice("xy"), 0]
        return [rng.choice("ab"), False, [tree(depth + 1) for _ in range(rng.randint(0, 3 if depth < 3 else 0))]]

    def frozen(t):
        return (None, t[1]) if t[0] is None else (t[0], tuple(map(frozen, t[2])))

    @lru_cache(None)
    def most(a, b):
        if a[0] != b[0]:
            return (0, 0)
        if a[0] is None:
            return (1, 1)
        return tuple(map(sum, zip((1, 0), rows(a[1], b[1]), strict=True)))

    @lru_cache(None)
    def rows(x, y):
        if not x or not y:
            return (0, 0)
        with_both = tuple(map(sum, zip(most(x[-1], y[-1]), rows(x[:-1], y[:-1]), strict=True))) if most(x[-1], y[-1])[0] else (0, 0)
        return max(with_both, rows(x[:-1], y), rows(x, y[:-1]), key=lambda v: v[0])

    for _ in range(300):
        a, b = tree(0), tree(0)
        pairs = match(a, b)
        where = {id(t): i for side in (a, b) for i, (t, _) in enumerate(blocks(side))}
        places = sorted((where[id(x)], where[id(y)]) for x, y in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(places, places[1:], strict=False))
        assert bool(pairs) <= (most(frozen(a), frozen(b))[0] > 1)
        assert len(match(a, a)) == len(blocks(a))


def test_marked_articles_and_unmarked_ones(spark):
    """Pages whose authors marked the article, and plain ones where only comparison tells what is template."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, want = [], {}
    for i in range(40):
        title, body = word(), [" ".join(word() for _ in range(12)) for _ in range(rng.randint(1, 6))]
        paragraphs = "".join(f"<p>{p}" for p in body)
        marked = (f"<html><head><title>{title}</title></head><body>{PARTS.format(n=word())}<article><h1>{title}</h1>{paragraphs}</article>"
                  f"{COMMENTS.format(n=word())}</body></html>")
        plain = (f"<title>{title}</title><div><div>Welcome to our pages</div><div><a>{word()}</a> <a>{word()}</a></div>"
                 f"<div><h1>{title}</h1>{paragraphs}</div><div>All rights reserved here</div></div>")
        rows += [(2 * i, "http://marked.example/x", marked, "t"), (2 * i + 1, "https://plain.example:80/y?z", plain, "t")]
        want[2 * i] = want[2 * i + 1] = "\n".join([title, *body])
    rows += [(100, None, "<p>no address", "t"), (101, "http://alone.example", "<p>alone</p>", "t"), (102, "http://plain.example/", None, "t"),
             (103, "mailto:x", "", "t"), (104, "http://marked.example", "<div>" * 20_000 + "deep", "t"), (105, "http://b", "<p>w " + "long " * 50_000, "t")]
    want |= {100: "no address", 101: "alone", 102: "", 103: "", 104: "deep", 105: ("w " + "long " * 50_000).strip()}
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = X.extract_pages(df).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.url for r in got} == {r[0]: r[1] for r in rows}
    again = X.extract_pages(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert X.extract_pages(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "http://a", "<p>x"), (1, "http://a", "<p>x"), (None, "http://a", "<p>y")], df.select("page_id", "url", "html").schema)
    assert sorted((str(r.page_id), r.text) for r in X.extract_pages(twice).collect()) == [("1", "x"), ("1", "x"), ("None", "y")]


def test_copies_of_one_article_are_no_template(spark):
    page = "<title>Same</title><article><h1>Same</h1><p>All of it is the same</p></article>"
    df = spark.createDataFrame([(i, "http://a", page) for i in range(50)], PAGES)
    assert {r.text for r in X.extract_pages(df).collect()} == {"Same\nAll of it is the same"}


@pytest.mark.parametrize("n", [40, 257, 259, 520])
def test_a_notice_goes_from_every_page_however_many_there_are(spark, n):
    """No group of pages has a wrapper of its own: one host of any size, in any layout of the input."""
    page = lambda i: (f"<title>t{i}</title><div><div>Read this notice first</div><h1>t{i}</h1><p>Words of page {i} and {i * i}</p></div>")
    df = spark.createDataFrame([(i, "http://one.example/x", page(i)) for i in range(n)], PAGES)
    want = {i: f"t{i}\nWords of page {i} and {i * i}" for i in range(n)}
    for parts in (1, 7):
        assert {r.page_id: r.text for r in X.extract_pages(df.repartition(parts)).collect()} == want


def test_wrappers_equal_those_of_a_plain_count_over_all_pages(spark):
    rng = random.Random(5)
    rows, trees = [], {}
    for i in range(120):
        host, title = rng.choice("aab"), rng.randrange(60)
        parts = [f"<p>Notice {k}</p>" for k in range(4) if rng.random() < (0.5, 0.75, 0.85, 1.0)[k]]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{rng.random()}</p>" for _ in range(rng.randint(1, 3)))
        html = f"<title>{title}</title><div>{''.join(parts)}</div><div>{body}</div><div>{rng.choice(['Same', 'Same', 'Same', 'Other'])} end</div>"
        rows.append((i, f"http://{host}/", html))
        trees[i] = (host, title, parse(html)[1])
    df = spark.createDataFrame(rows, PAGES)
    got = {r.page_id: r.text for r in X.extract_pages(df).collect()}
    hashed = lambda i, raw: spark.range(1).select(F.xxhash64(*([] if i is None else [F.lit(i)]), F.lit(raw))).first()[0]
    for host in "ab":
        layouts: dict = {}
        for i, (h, t, tree) in trees.items():
            if h == host:
                layouts.setdefault(X._layout(tree), {}).setdefault(t, {})[i] = tree
        for titles in layouts.values():
            own = [min((hashed(None, bytearray(X._packed(t))), i) for i, t in pages.items())[1] for pages in titles.values()]
            references = [] if len(own) < 4 else list(dict.fromkeys(
                min((hashed(n, bytearray(X._packed(trees[i][2]))), i) for i in own)[1] for n in range(X.REFERENCES)))
            constants = []
            for ref in references:
                met, same = {}, {}
                for i in own:
                    for r, _, equal in X.aligned(trees[ref][2], trees[i][2]):
                        met[r] = met.get(r, 0) + 1
                        same[r] = same.get(r, 0) + equal
                constants.append({r for r in met if met[r] >= 4 and same[r] >= 0.8 * met[r]})
            for pages in titles.values():
                for i, tree in pages.items():
                    assert got[i] == X.main_text(tree, X.template_blocks(tree, [trees[r][2] for r in references], constants))


def test_given_pages_keep_their_whole_article(spark):
    import html
    import re
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for r in rows.collect():
        inner = r.html.partition("<article>")[2].partition("</article>")[0]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", x))).strip() for x in re.split(r"</?p>|</?h1>", inner)]
        want[r.page_id] = "\n".join(p for p in parts if p)
    assert {r.page_id: r.text for r in X.extract_pages(rows).collect()} == want


def test_representatives_are_chosen_without_their_trees(spark, monkeypatch):
    kept, store = {}, X.stored
    monkeypatch.setattr(X, "stored", lambda df, name: kept.setdefault(name, store(df, name)))
    pages = [(i, "http://h.x/a", f"<title>t{i}</title><body><div>always here</div><p>story {i} has words</p></body>") for i in range(6)]
    got = X.extract_pages(spark.createDataFrame([*pages, (9, *pages[0][1:])], "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: f"story {i % 9} has words" for i in (*range(6), 9)}
    assert "tree" in kept["trees"].columns and kept["representatives"].count() == 6
    assert not any(t in ("binary", "string") for _, t in kept["representatives"].drop("host").dtypes)
