"""Operators over pages: main text and URL verdicts."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from vitrine.llm import html_cut, url_rules

P1 = "The first paragraph of the article is long enough to look like text, with a comma and a full stop."
P2 = "A second one follows, which goes on for a while as well so that nobody takes it for a menu."
PAGES = {
    f'<article><p>{P1} <a title="5" tall">lnk</a> mid text</p><p>{P2} A "quoted" word.</p></article>':
        f'{P1} lnk mid text\n{P2} A "quoted" word.',
    f"<article><p>{P1} <i class='a'b'>it's</i> so</p><p data-x = 'a > b'>{P2}</p></article>": f"{P1} it's so\n{P2}",
    f"<article><h1>Head &amp; tail</h1><p>{P1}</p><p>Ok.</p><p>{P2}</p></article>": f"Head & tail\n{P1}\nOk.\n{P2}",
    f"<nav><ul><li><a href=/a>A<li><a href=/b>B</ul></nav><main><h1>T</h1><p>{P1}<p>{P2}</main><footer>© me</footer>": f"T\n{P1}\n{P2}",
    f"<header><a href=/>Site</a></header><article><header><h1>T</h1></header><p>{P1}</p></article>": f"T\n{P1}",
    f"<article><p>{P1}</p><div class='ad'>{P2}</div><aside>{P2}</aside><form><p>{P2}</p></form><p>{P2}</p></article>": f"{P1}\n{P2}",
    f"<div class=cookie-notice><p>{P2}</p></div><div id=content><p>{P1}</p></div><div id=comments><p>{P2}</p></div>": P1,
    f"<div id=sidebar><p>{P2}</p></div><div class=post><h2>T</h2><p>{P1}</p></div>": f"T\n{P1}",
    f"<article><p>{P1}</p><section class=comments><article class=comment><p>{P2}</p></article></section></article>": P1,
    f"<article><!-- <p>no</p> --><script>var a = '<p>no</p>'</script><style>p{{}}</style><p title='a > b'>{P1}</p></article>": P1,
    f"<article><p>one\n\t two&nbsp;three <b>fo</b>ur<br>five. {P1}</p></article>": f"one two three four five. {P1}",
    f"<body class='has-sidebar'><article><p>{P1}</p><ul><li>first point</li><li>second point</li></ul>": f"{P1}\nfirst point\nsecond point",
    f"<article><p>{P1}</p></article><div style='display: none'><p>{P2}</p></div><p hidden>{P2}</p>": P1,
    f"<article><p>{P1}<table><tr><td>cell a<td>cell b</table></article>": f"{P1}\ncell a\ncell b",
    f"<p>{P1}</p><p>{P2}</p>": f"{P1}\n{P2}",
    f"<div class='content-with-sidebar'><div class=sidebar>{P2}</div><p>{P1}</p></div>": P1,
    f"<form id=aspnet><div class=menu>{P2}</div><main><p>{P1}</p><div role=alert>{P2}</div></main></form>": P1,
    # Wrappers: names and forms around the article say nothing, those beside it and inside it do.
    f"<form id=aspnetForm><div class=menu>{P2}</div><h1>T</h1><p>{P1}</p><p>{P2}</p><div class=comments>{P1}</div></form>": f"T\n{P1}\n{P2}",
    f"<div class='site navbar-top'><nav>{P2}</nav><article><h1>T</h1><p>{P1}</p></article><div class=sidebar>{P2}</div></div>": f"T\n{P1}",
    f"<div class='article share-enabled'><h1>T</h1><p>{P1}</p><div class=share>{P2}</div></div><div class=related>{P2}</div>": f"T\n{P1}",
    f"<h1>T</h1><div id=content class=popular-science><p>{P1}</p><p>{P2}</p><form><p>{P2}</p></form></div>": f"T\n{P1}\n{P2}",
    f"<form><div class='page modal-open'><div class='post ad-free'><p>{P1}</p></div><div class=comments><article><p>{P2}</p>"
    f"<p>{P2}</p></article></div></div></form>": P1,
    f"<article><p>{P1}</p></article><div class=comments>" + f"<article><p>{P2}</p></article>" * 20 + "</div>": P1,
    f"<div><h1>T</h1><p>{P1}</p></div><div class='comments'>" + f"<div class=content><p>{P2}</p></div>" * 20 + "</div>": f"T\n{P1}",
    "": "", "<html><body></body></html>": "", "<nav>x</nav>": "",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_cut.main_text(page) == PAGES[page]


def test_odd_markup_ends():
    for page in ("<", "<a", "<!--", "<p", "a < b", "<p><p><p>", "</p></div>", "<a href='", "<script>", "&#xD800;&bogus;&amp", "<![CDATA[x"):
        html_cut.main_text(page)
    assert html_cut.main_text("<article>" + "<p>" * 50_000 + P1) == P1
    assert html_cut.main_text("<article>" + f"<p>{P1}</p>" * 3000).count("\n") == 2999
    assert html_cut.main_text("<article><p>" + "word " * 200_000 + ".</p></article>").count("word") == 200_000


def test_deep_trees_take_linear_time():
    began = time.monotonic()
    html_cut.main_text("<div>" * 50_000 + "<li>x" * 50_000)
    html_cut.main_text("<div class='nav post'><p>" * 30_000 + P1)
    html_cut.main_text("<article>" + f"<p>{P1}</p>{'<div>' * 20_000}{P1}{'</div>' * 20_000}" * 4)
    assert time.monotonic() - began < 20


PARTS = {  # beside the article
    "nav": f"<nav>{P2}</nav>", "menu": f"<ul class='menu'><li><a href=/>Home</a></ul>", "ad": f"<div class='ad-slot'>{P2}</div>",
    "notice": f"<div class='cookie-notice'><p>{P2}</p></div>", "footer": f"<footer>{P2}</footer>", "side": f"<aside>{P2}</aside>",
    "comments": f"<section id=comments><div class=comment-body><p>{P2} {P2}</p></div></section>", "form": f"<form><p>{P2}</p></form>",
}
WRAPPERS = ["<form id=f{}>", "<div class='site nav-top{}'>", "<div class='page-{} modal-ready'>", "<div class='wrap{}'>", "<section class='search-open{}'>"]


def test_articles_in_any_wrappers():
    """Generated pages: the text is exactly the article, whatever elements with misleading names are around it."""
    rnd = random.Random(8)
    for k in range(400):
        words = lambda: " ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randint(14, 60))).capitalize() + "."
        lines = [f"Title {k}", *[words() for _ in range(rnd.randint(4, 9))]]
        beside = [PARTS[p] for p in rnd.sample(sorted(PARTS), rnd.randint(0, 5))]
        at = rnd.randint(0, len(beside))
        holder = rnd.choice(["article", "div class='post share-ready'", "div id=content class=trending", "main", "div class=entry"])
        inner = f"<{holder}><h1>{lines[0]}</h1>" + "".join(f"<p>{x}" for x in lines[1:]) + f"</{holder.split()[0]}>"
        around = [rnd.choice(WRAPPERS).format(i) for i in range(rnd.randint(0, 3))]
        page = "".join(around) + "".join(beside[:at]) + inner + "".join(beside[at:]) + "".join(f"</{w[1:].split()[0]}>" for w in reversed(around))
        assert html_cut.main_text(page) == "\n".join(lines), page


def test_minimum_cut_is_the_smallest():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 7)
        odds = [rnd.randint(-9, 9) for _ in range(n)]
        edges = [(i, j, rnd.randint(0, 6)) for i in range(n) for j in range(i + 1, min(n, i + 3))]

        def cost(side):
            own = sum(-x if s and x < 0 else x if not s and x > 0 else 0 for s, x in zip(side, odds))
            return own + sum(c for i, j, c in edges if side[i] != side[j])

        best = min(itertools.product([False, True], repeat=n), key=lambda s: (cost(s), sum(s)))
        assert html_cut.minimum_cut(odds, edges) == list(best)


def test_pages_table(spark):
    rows = [(i, f"u{i}", p, 1) for i, p in enumerate(PAGES)] + [(1, None, None, 2), (None, "u", "", 3), (0, "u0", next(iter(PAGES)), 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int").repartition(3)
    got = html_cut.extract(df).collect()
    want = [(i, u, t := html_cut.main_text(h), len(t)) for i, u, h, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert html_cut.extract(df.where("false")).count() == 0


URLS = {
    "http://a.example.com/en/1": ("a.example.com", "/en/1", "example.com/en/", "block"),
    "http://WWW.Example.com/en/x?y=/q#z": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
    "http://example.com/fr/x": ("example.com", "/fr/x", "com/", "allow"),
    "http://example.com": ("example.com", "", None, "allow"),
    "https://x.y.net/es/1#a": ("x.y.net", "/es/1", "net/es/", "block"),
    "ftp://net/fr/": ("net", "/fr/", "net/fr/", "block"),
    "http://notnet.org/fr/": ("notnet.org", "/fr/", None, "allow"),
    "http://telecom/en/": ("telecom", "/en/", None, "allow"),
    "a://b://c/d": ("b:", "//c/d", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://é.com/É\n/x?": ("é.com", "/É\n/x", "com/", "allow"),
}


def test_fixed_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, list(URLS)[0], "x"), (None, "http://a.net/es/", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, verdict string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = url_rules.judge(pages, labels).collect()
    want = [(i, *URLS.get(u, ("a.net", "/es/", "net/es/", "block"))) for i, u, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert url_rules.judge(pages.where("false"), labels).count() == 0


def test_mined_rules_are_all_and_only_those_with_support_and_confidence(spark):
    rnd = random.Random(5)
    rows, labels = [], []
    for i in range(600):
        site, part, key = rnd.choice(["good", "mixed", "spam"]), rnd.choice(["news", "win", "shop"]), rnd.choice(["a", "b", ""])
        bad = site == "spam" and part == "win" or key == "b" and part == "shop" and rnd.random() < 0.97
        rows.append((i, f"http://{site}.org/{part}/{i}" + (f"?{key}=1" if key else "")))
        if i % 2:
            labels.append((i, 0 if bad and i % 3 else 1, int(bad and i % 3 == 0)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    table = spark.createDataFrame(labels + [(9999, 0, 1), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = {(tuple(r.tokens), round(r.confidence, 6)) for r in url_rules.mined_rules(pages, table, 0.9, 5).collect()}
    tokens = {r.page_id: set(r.t) for r in pages.select("page_id", url_rules.tokens_of(F.col("url")).alias("t")).collect()}
    marked = [(tokens[i], q == 0 or t == 1) for i, q, t in labels]
    found, every = {}, sorted(set().union(*tokens.values()))
    least = 5
    for size in range(1, 8):
        for combo in itertools.combinations([t for t in every if sum(t in x for x, _ in marked) >= least], size):
            both = [bad for x, bad in marked if x.issuperset(combo)]
            if sum(both) >= least and sum(both) >= 0.9 * len(both):
                found[combo] = sum(both) / len(both)
    kept = {(c, round(p, 6)) for c, p in found.items() if not any(set(o) < set(c) and q >= p for o, q in found.items())}
    assert got == kept and len(got) >= 2
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, table).collect()}
    strong = [set(c) for c in found if sum(bad for x, bad in marked if x.issuperset(c)) >= url_rules.LEAST_ROWS]
    assert strong and verdicts == {i: "block" if any(s <= t for s in strong) else "allow" for i, t in tokens.items()}


@pytest.mark.parametrize("labelled", [1_000, 100_000])
def test_the_same_evidence_gives_a_rule_at_every_size(spark, labelled):
    url = "CASE WHEN id < 25 THEN concat('http://spam.org/p', id) ELSE concat('http://site', id % 40, '.org/a/', id) END"
    pages = spark.range(labelled + 1).selectExpr("id AS page_id", f"{url} AS url")
    pages = pages.union(spark.createDataFrame([(-1, "http://www.spam.org/new"), (-2, "http://other.org/")], pages.schema))
    labels = spark.range(labelled).selectExpr("id AS doc_id", "IF(id < 25 OR id % 9 = 0, 0, 1) AS quality", "0 AS toxic")
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, labels).where("page_id < 25").collect()}
    assert verdicts == {-2: "allow"} | {i: "block" for i in [-1, *range(25)]}


def test_end_tags_without_an_element_are_passed_over():
    """Ten thousands of them in one page, as many elements open: linear, and the text around them is one block."""
    page = "<div>" * 50_000 + P1 + "</section></span></nav>" * 50_000 + " " + P2 + "</div>" * 60_000
    assert [b.text for b in html_cut.blocks_of(page)] == [f"{P1} {P2}"]
