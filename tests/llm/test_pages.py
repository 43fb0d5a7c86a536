import random
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from colloquy.llm import pages, queries

SCHEMA = "page_id long, url string, html string, text string"


def longest(a, b):
    """Lengths of the longest common subsequences of all prefixes."""
    rows = [[0] * (len(b) + 1)]
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(rows[-1][j] + 1 if x == y else max(rows[-1][j + 1], row[-1]))
        rows.append(row)
    return rows


@pytest.mark.parametrize("bits", [1 << 28, 60, 7])
def test_common_lines_against_dynamic_programming(bits, monkeypatch):
    monkeypatch.setattr(pages, "BITS", bits)
    rng = random.Random(bits)
    for _ in range(400):
        letters = rng.choice([2, 3, 7])
        a, b = ([rng.randrange(letters) for _ in range(rng.randrange(18))] for _ in range(2))
        taken = pages.common(np.array(a, np.int64), np.array(b, np.int64)).tolist()
        rest = iter(b)
        assert all(any(y == a[i] for y in rest) for i in taken) and taken == sorted(set(taken))
        assert len(taken) == longest(a, b)[-1][-1]


def lines(page):
    return [line for line, _ in pages.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain &amp; <b>bold</b>\n text", ["plain & bold text"]),
        ("<p>one<p>two <b>three<br>four<p>five", ["one", "two three four", "five"]),
        ("<p>a &lt;b&gt; &eacute;&#33;&nbsp;c</p>", ["a <b> é! c"]),
        ("<p>1 < 2 > 0 & x</p>", ["1 < 2 > 0 & x"]),
        ("<title>t</title><style>p{}</style><script>if (a</script>b) '</p>'</script><p>x", ["b) '", "'", "x"]),
        ("<p>a<!-- <p>no</p> -->b</p><!-- open <p>c", ["ab"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<nav><p>menu</nav><header>top</header><p>text</p><aside>side<p>x</aside><footer>end</footer>", ["text"]),
        ("<div class='cookie-notice'>we use</div><div id=sidebar><div>s</div></div><p>text<form>f<input value='>'></form></p><section class='comments'><article>c</article></section>", ["text"]),
        ("<div class='content-sidebar-wrap'><p>text</p><div class='has-comments'>more</div></div>", ["text", "more"]),
        ("<div>out</div><article><header><h1>T</h1></header><p>a</p><div class='share'>s</div><div class=section-header><h2>H</h2></div><footer>f</footer></article><div>out</div>", ["T", "a", "H"]),
        ("<main><h1>T</h1><article><p>a</article><p>b</main><p>out", ["T", "a", "b"]),
        ("<div itemprop='articleBody'><p>a</div><p>b", ["a"]),
        ("<div class='entry-content comment'>c</div><div class='post-content ad-free'>a</div>x", ["a"]),
        ("<form action='/'><div><article><p>a</article><p>b</div></form>", ["a"]),
        ("<div><a href=1>Home</a></div><div><a href=2>About</a></div><p>see <a href=3>this</a> text</p>", ["see this text"]),
        ("<div style='display: none'>x</div><p hidden>y</p><p aria-hidden=true>z</p><p>a", ["z", "a"]),
        ("<p title=\"a > b\" class='x'>c</p><p data-x='it''s'>d<p x=\"open>e</p>", ["c", "d", "e"]),
        ("<article><p>a</b></i></div> b</p></article></body></html>", ["a b"]),
        ("<p>a<![CDATA[<x>]]></p>", ["a<x>"]),
        ("<article><p>a <button>go</button> b <em>c</em></p><blockquote>q<p>r</blockquote><pre>x\n  y</pre></article>", ["a b c", "q", "r", "x y"]),
    ],
)
def test_markup(page, want):
    assert lines(page) == want


def test_long_pages_take_linear_time():
    page = "<p class='x' data-y=\"z\">word <b>word</b><br>" * 60_000
    assert len(lines(page)) == 60_000
    assert lines("<p x='" * 3000) == [] and lines("<" * 100_000) == ["<" * 100_000]
    assert len(lines("<div>a" * 3000)) == 3000


class Article(HTMLParser):
    """Blocks of the article element, by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.blocks += [""] if tag in ("p", "h1") else []

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.blocks += [""] if tag in ("p", "h1") else []

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    def text(self):
        return "\n".join(" ".join(b.split()) for b in self.blocks if b.split())


def test_whole_table(spark, sf):
    """No block of an article is lost where others repeat it, and nothing else is taken."""
    want = {(r.page_id, r.url, Article(r.html or "").text()) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = [tuple(r) for r in queries.op13_pages(spark, sf).collect()]
    assert {r[:3] for r in got} == want and len(got) == len(want) and all(len(r[2]) == r[3] for r in got)


def host_pages(rng, host, n, main):
    """Pages with a menu and a notice in plain blocks, and paragraphs of which some repeat."""
    common = [f"{host} menu {k}" for k in range(rng.randrange(1, 5))]
    body = [f"shared passage {k}" for k in range(3)]
    out = []
    for i in range(n):
        prose = [rng.choice(body) if rng.random() < 0.2 else f"{host} page {i} line {j}" for j in range(rng.randrange(1, 6))]
        if i % 5 == 4 and out:
            prose = out[-1][1]  # a copy elsewhere
        open_, close = ("<article>", "</article>") if main else ("", "")
        every = "<p>Subscribe to all of it</p>" if main else "<div>All rights kept</div>"
        page = "".join(f"<div>{c}</div>" for c in common) + open_ + "".join(f"<p>{p}</p>" for p in prose) + every + close
        out.append((f"http://{host}/{rng.choice('abc')}/{rng.randrange(99)}", prose, page))
    return out


def plain(rows):
    """What the docstring says, page by page."""
    hosts = defaultdict(dict)
    read = {}
    for url, page in rows:
        found = pages.blocks(page)
        read[url, page] = host, key = url.split("/")[2], tuple(found)
        path = "/" + url.split("/", 3)[3]
        hosts[host][key] = min(path, hosts[host].get(key, path))
    cut = {}
    for host, known in hosts.items():
        named = {key: tuple(hash(line) for line, _ in key) for key in known}
        ordered = sorted(known, key=lambda key: (known[key], digest(key)))
        for i, key in enumerate(ordered):
            near = ordered[max(0, i - 2) : i] + ordered[i + 1 : i + 3]
            votes = [0] * len(key)
            for other in near:
                for place in pages.common(np.array(named[key]), np.array(named[other])).tolist():
                    votes[place] += 1
            keep = []
            for (line, part), n in zip(key, votes):
                if part == pages.OPEN:
                    gone = near and n * 2 > len(near)
                else:
                    held = sum(line in [x for x, _ in other] for other in known)
                    gone = len(near) >= 2 and n == len(near) and held >= 8 and held >= 0.9 * len(known)
                keep += [] if gone else [line]
            cut[host, key] = "\n".join(keep)
    return {(url, cut[where]) for (url, _), where in read.items()}


def digest(key):
    return DIGESTS[tuple(line for line, _ in key), tuple(part for _, part in key)]


DIGESTS = {}


@pytest.mark.parametrize("main", [False, True])
def test_differences_of_neighbours(spark, main):
    rng = random.Random(main)
    made = [p for h, n in (("one.org", 1), ("two.org", 2), ("few.org", 9), ("many.org", 90)) for p in host_pages(rng, h, n, main)]
    rows = [(i, url, page, "x") for i, (url, _, page) in enumerate(made)]
    frame = spark.createDataFrame(rows, SCHEMA)
    from colloquy.llm.store import Store

    votes = pages.neighbour_votes(pages.read_pages(frame), Store(spark, "test"))
    by_hash = {}
    for r in pages.read_pages(frame).selectExpr("lines", "main", "transform(lines, x -> xxhash64(x)) AS hashes").collect():
        by_hash[tuple(r.hashes), tuple(r.main)] = (tuple(r.lines), tuple(int(m) for m in r.main))
    DIGESTS.update({by_hash[tuple(r.hashes), tuple(r.main)]: r.digest for r in votes.collect()})
    got = {(r.url, r.text) for r in pages.main_text(frame).collect()}
    assert got == plain([(url, page) for _, url, page, _ in rows])
    whole = {(url, "\n".join(prose)) for url, prose, _ in made}
    # The host's own lines are gone where the host has pages enough; what articles share stays in articles.
    if main:
        assert all("Subscribe" not in text for url, text in got if "many" in url)
        assert {r for r in got if "many" in r[0]} == {r for r in whole if "many" in r[0]}
    else:
        assert all("menu" not in text and "All rights" not in text for url, text in got if "one.org" not in url)
        assert len(got & whole) > 0.9 * len(whole)


def test_cells_and_partitions_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, url, page, "x") for i, (url, _, page) in enumerate(host_pages(rng, "many.org", 60, False))]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, pages.main_text(frame).collect()))
    monkeypatch.setattr(pages, "CELL", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, pages.main_text(frame.repartition(7)).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_edges(spark):
    page = "<article><p>a 😀</p></article>"
    rows = [(1, None, page, "x"), (2, "http://h/a", None, "x"), (None, "http://h/b", "", "x"), (3, "not a url", page, "x"), (3, "not a url", page, "x"), (4, "http://h/c", "<p>" + "w " * 300_000, "x"), (5, "HTTP://u@H:80", page, "x")]
    got = sorted(map(tuple, pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    long = "w " * 299_999 + "w"
    want = [(1, None, "a 😀", 3), (2, "http://h/a", "", 0), (None, "http://h/b", "", 0), (3, "not a url", "a 😀", 3), (3, "not a url", "a 😀", 3), (4, "http://h/c", long, len(long)), (5, "HTTP://u@H:80", "a 😀", 3)]
    assert got == sorted(want, key=str)
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).collect() == []
