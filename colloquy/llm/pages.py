"""Main text of web pages: what markup says, and what pages near by in their host repeat.

A page is read into blocks, each with the part that markup gives it: MAIN lies
in an article or another element named as the body of text, OPEN lies anywhere
else, and menus, forms, notices, comments and the like are left out at once.

Pages are then told apart from their neighbours. All pages are ordered by host
and URL path in one range partitioning and numbered; cells of consecutive
numbers, with the edges of the cells beside them, compare each page with the
REACH nearest ones on either side that are of its host and have other lines, by
a longest common subsequence of the hashes of their lines. Pages with the same
lines are compared once, so copies of an article don't delete each other.

* An OPEN block goes if more than half of these neighbours share it.
* A MAIN block is prose by the word of the markup. It goes if all neighbours
  share it, two at least, and nine in ten of the host's pages hold it, eight at
  least: then it belongs to the host, not to the article. Passages that some
  articles share stay.

Where a page has an article or a main element, blocks outside of both go; where
it has none, its OPEN blocks are its text.

Edge cases: a null or empty page gives an empty text; pages without a host are
read by markup alone; repeated rows and copies get the same text each; a very
long page is read whole, and its lines are compared by bits, in strips; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from .columns import lean, map_batches
from .store import Store

# Elements of HTML, and the names that authors give to parts of a page.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset("aside audio button canvas datalist dialog fieldset footer form label map menu nav object search select video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HEADERS = "banner header headers masthead topbar".split()
NAMES = (
    "ad ads advert adverts advertisement advertisements advertising adsense adslot alert alerts banners billboard breadcrumb breadcrumbs captcha colophon comment comments "
    "commentlist consent cookie cookies copyright dfp discussion disqus disclaimer dropdown flyout footer footers form forms gdpr legal login menu menus modal nav navbar "
    "navbars navigation navs newsletter notice notices notification notifications offcanvas outbrain overlay pager paginate pagination paywall popover popup popups promo "
    "promos promotion promoted recommendations recommended register related replies reply respond responses search share sharebar sharing sidebar sidebars signin signup "
    "skip social sponsor sponsored sponsors subscribe subscription taboola tagcloud toast toolbar tracking"
).split()
MAIN_NAMES = frozenset(
    "article-body article-content article-text articlebody body-text content-body entry entry-content main-content maincontent post post-body post-content post-text story "
    "story-body story-content text-content".split()
)
WHOLE_NAMES = frozenset([*NAMES, *HEADERS, "widget", "widgets", "widget-area"])
TABLE = frozenset("caption table tbody td tfoot th thead tr".split())
WALLS = frozenset("article aside blockquote body dl footer form header html main nav ol section select table td th ul".split())
#: What the start of an element ends, and the elements beyond which it doesn't look.
ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd", "p"}, {"dl", "table"}),
    "dd": ({"dt", "dd", "p"}, {"dl", "table"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}

OPEN, MAIN = 0, 1
#: Neighbours on either side that a page is compared with, pages of a cell, bits of a strip.
REACH, CELL, BITS = 2, 256, 1 << 28

_tag = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"
    r"|(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:[\"'][^>]*+)?)(?:>|\Z))",
    re.S,
)
_attribute = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_told = re.compile(r"(?i)\b(?:class|id|role|hidden|style|itemprop)\b").search
_unseen = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden").search
_camel = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _one_of(names: list[str]):
    return re.compile(r"(?:^|[-_])(?:" + "|".join(names) + r")(?:[-_\d]|$)").search


_name, _header = _one_of(NAMES), _one_of(HEADERS)
#: Names of elements that lie around the text and beside what they speak of.
_around = re.compile(r"(?:^|[-_])(?:has|no|with|without)[-_]|^is[-_]|(?:content|main|article).*[-_](?:wrap|wrapper|container)$").search


def _marks(said: str, name: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element's attributes leave it out, and whether they name it as the body of text."""
    found: dict[str, str] = {}
    for m in _attribute.finditer(said):
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    role = found.get("role", "").lower()
    if "hidden" in found or _unseen(found.get("style", "")) or role in ROLES:
        return True, False
    if role == "main" or "articlebody" in found.get("itemprop", "").lower():
        return False, True
    if name in ("html", "body", "main"):
        return False, False
    names = [one for key in ("class", "id") for one in _camel.sub("-", found.get(key, "")).lower().split()]
    if any(one in MAIN_NAMES for one in names):
        out = any(one in WHOLE_NAMES for one in names)
        return out, not out
    # A header within the text has its headings.
    return any(one in WHOLE_NAMES and not (inside and one in HEADERS) or not _around(one) and (_name(one) or not inside and _header(one)) for one in names), False


def blocks(page: str) -> list[tuple[str, int]]:
    """The page's blocks of text (text, MAIN or OPEN) in order, without those that markup leaves out."""
    found: list[tuple[str, int, bool, bool]] = []  # text, part, whether in a main element, whether links alone
    # Elements that are open; before each one the depth left out, in bodies of text, in main elements, in links.
    stack: list[tuple[str, int, int, int, int]] = []
    text: list[str] = []
    out = inside = within = links = linked = 0
    at, end = 0, len(page)

    def say(part: str) -> None:
        nonlocal linked
        if not out:
            text.append(part)
            if links:
                linked += len(part)

    def flush() -> None:
        nonlocal linked
        if text and not out:
            whole = "".join(text)
            line = " ".join(entities.unescape(whole).split())
            if line:
                found.append((line, MAIN if inside else OPEN, bool(within), linked * 5 >= len(whole.strip()) * 4))
            text.clear()
            linked = 0

    def leave(k: int) -> None:
        """Close the element k and all in it."""
        nonlocal out, inside, within, links
        if any(s[0] in BLOCK for s in stack[k:]):
            flush()
        _, out, inside, within, links = stack[k]
        del stack[k:]

    while at < end:
        m = _tag.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                say(entities.escape(m[0][9:].removesuffix("]]>")))
        elif m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    leave(k)
                    break
                if stack[k][0] in (("td", "th", "caption") if name in BLOCK else WALLS) and name not in TABLE:
                    break
            else:
                if name == "p":
                    flush()
                elif name == "br":
                    say(" ")
        elif name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        else:
            ends, walls = ENDS.get(name, ({"p"}, WALLS))
            if name in BLOCK:
                last = None
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in ends:
                        last = k
                    elif stack[k][0] in walls:
                        break
                if last is not None:
                    leave(last)
                flush()
            if name in VOID:
                if name == "br":
                    say(" ")
                continue
            gone, body = _marks(m[3], name, inside > 0) if m[3] and _told(m[3]) else (False, False)
            stack.append((name, out, inside, within, links))
            if gone or name in LEFT_OUT or name == "header" and not inside:
                out += 1
                continue
            if (name in ("article", "main") or body) and out == sum(s[0] == "form" for s in stack):
                out = 0  # a form around the whole page
            links += name == "a"
            inside += name == "article" or body
            within += name == "main"
    out = 0
    flush()
    if any(part == MAIN for _, part, *_ in found):
        return [(line, part) for line, part, in_main, _ in found if part == MAIN or in_main]
    if any(in_main for _, _, in_main, _ in found):
        return [(line, MAIN) for line, _, in_main, _ in found if in_main]
    # Without a body of text, links on end are a menu.
    menu = [a[3] and (i > 0 and found[i - 1][3] or i + 1 < len(found) and found[i + 1][3]) for i, a in enumerate(found)]
    return [(line, part) for (line, part, *_), gone in zip(found, menu) if not gone]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of a, ascending, that a longest common subsequence of a and b takes."""
    taken = []
    begin, end_a, end_b = 0, len(a), len(b)
    while begin < min(end_a, end_b) and a[begin] == b[begin]:
        begin += 1
    while end_a > begin and end_b > begin and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    taken = [np.arange(begin), np.arange(end_a, len(a))]
    # Only lines that both have can be taken.
    own, other = begin + np.flatnonzero(np.isin(a[begin:end_a], b[begin:end_b])), begin + np.flatnonzero(np.isin(b[begin:end_b], a[begin:end_a]))
    if len(own) and len(other):
        taken.append(own[_aligned(a[own].tolist(), b[other].tolist())])
    return np.sort(np.concatenate(taken))


def _rows(a: list, b: list):
    """After each element of a the bits of b: a zero where the length of the common subsequence grows."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        match = row & where.get(x, 0)
        row = ((row + match) | (row - match)) & full
        yield row


def _aligned(a: list, b: list) -> list[int]:
    """Places of a in a longest common subsequence; halves a while its rows of bits would not fit a strip."""
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > BITS:
        half = len(a) // 2
        *_, top = _rows(a[:half], b)
        *_, low = _rows(a[half:][::-1], b[::-1])
        bits = lambda row: np.frombuffer(bin(row | 1 << len(b))[3:][::-1].encode(), np.uint8) == ord("0")
        cut = int(np.argmax(np.append(0, np.cumsum(bits(top))) + np.append(0, np.cumsum(bits(low)))[::-1]))
        return _aligned(a[:half], b[:cut]) + [half + i for i in _aligned(a[half:], b[cut:])]
    rows = list(_rows(a, b))
    taken, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if not rows[i] >> j & 1:
            if i == 0 or rows[i - 1] >> j & 1:
                # The length grows here by a[i], unless it grew in the row before as well.
                taken.append(i)
                i -= 1
                j -= 1
            else:
                i -= 1
        else:
            j -= 1
    return taken[::-1]


def _host_and_path(url):
    """Lower-cased host without user and port, and the path that pages are ordered by."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*", 0), r"^.*@|:\d*$", ""))
    with_host = F.coalesce(url, F.lit("")).rlike(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//")
    return F.when(with_host, host).otherwise(""), F.when(with_host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def read_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path, lines, main): the blocks of each page, and which of them are MAIN."""

    def run(batches):
        for batch in batches:
            found = [blocks(page or "") for page in batch["html"]]
            out = batch.drop(columns="html")
            out["lines"] = [[line for line, _ in page] for page in found]
            out["main"] = [[part == MAIN for _, part in page] for page in found]
            yield out

    host, path = _host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), "html")
    return map_batches(rows, run, rows.drop("html").schema.add("lines", ArrayType(StringType())).add("main", ArrayType(BooleanType())), "page_id")


def _votes(cell: pd.DataFrame, reach: int) -> pd.DataFrame:
    """For the cell's own pages the number of neighbours and, for each line, how many of them share it."""
    hosts, hashes = cell["host"].tolist(), [np.asarray(h, np.int64) for h in cell["hashes"]]
    rows = []
    for i in np.flatnonzero(cell["own"].to_numpy()).tolist():
        near = [j for j in range(max(0, i - reach), min(len(cell), i + reach + 1)) if j != i and hosts[j] == hosts[i]]
        votes = np.zeros(len(hashes[i]), np.int32)
        for j in near:
            votes[common(hashes[i], hashes[j])] += 1
        rows.append((hosts[i], cell["digest"].iat[i], len(near), votes))
    return pd.DataFrame(rows, columns=["host", "digest", "near", "votes"])


def neighbour_votes(read: DataFrame, store: Store, reach: int = REACH) -> DataFrame:
    """(host, digest, hashes, main, near, votes) of the distinct lists of lines of each host.

    digest names a list of lines; near is the number of neighbours, votes how
    many of them share each line.
    """
    hashes = F.transform("lines", lambda line: F.xxhash64(line))
    listed = read.filter("host <> '' AND size(lines) > 0").select("host", "path", hashes.alias("hashes"), "main")
    listed = listed.withColumn("digest", F.concat(F.hex(F.xxhash64("hashes", "main")), F.hex(F.xxhash64(F.lit(1), "hashes", "main"))))
    # Copies are one page, at the first of their paths.
    pages = listed.groupBy("host", "digest").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes"), F.first("main").alias("main"))
    parts = max(1, int(read.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = ["host", "path", "digest"]
    ordered = store.save(pages).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    ordered = store.save(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    # One row for each partition: the number of pages before it.
    before = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    number = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    numbered = ordered.join(before, "part").select("host", "digest", "hashes", number.alias("number"))
    cell, place = F.floor(F.col("number") / CELL), F.col("number") % CELL
    cells = F.array_compact(F.array(cell, F.when(place < reach, cell - 1), F.when(place >= CELL - reach, cell + 1)))
    dealt = numbered.withColumn("cell", F.explode(cells)).withColumn("own", F.floor(F.col("number") / CELL) == F.col("cell"))

    def run(batches):
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = np.flatnonzero(rows["cell"].to_numpy() == rows["cell"].iat[-1])[0]
            for _, one in rows.iloc[:last].groupby("cell", sort=False):
                yield _votes(one, reach)
            held = rows.iloc[last:]
        if held is not None:
            yield _votes(held, reach)

    sent = dealt.repartition("cell").sortWithinPartitions("cell", "number")
    votes = sent.mapInPandas(lean(run), "host string, digest string, near int, votes array<int>")
    return ordered.select("host", "digest", "hashes", "main").join(store.save(votes), ["host", "digest"])


def template_lines(votes: DataFrame, half: float = 0.5, all_of: int = 2, share: float = 0.9, least: int = 8) -> DataFrame:
    """(host, digest, cut): the places of lines that belong to the host rather than the page."""
    told = F.transform(F.arrays_zip("hashes", "main", "votes"), lambda x, i: F.struct(i.alias("place"), x["hashes"].alias("hashes"), x["main"].alias("main"), x["votes"].alias("votes")))
    lines = votes.filter("near > 0").select("host", "digest", "near", F.inline(F.filter(told, lambda x: x["votes"] > 0)))
    own = lines.filter("NOT main").filter(F.col("votes") > half * F.col("near")).select("host", "digest", "place")
    # Prose that all neighbours share is counted over its host.
    asked = lines.filter("main").filter((F.col("near") >= all_of) & (F.col("votes") == F.col("near"))).select("host", "digest", "place", "hashes")
    wanted = asked.select("host", "hashes").distinct()
    held = votes.select("host", "digest", F.explode(F.array_distinct("hashes")).alias("hashes")).join(wanted, ["host", "hashes"], "left_semi").groupBy("host", "hashes").agg(F.count(F.lit(1)).alias("held"))
    sizes = votes.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    common_ = held.join(sizes, "host").filter((F.col("held") >= least) & (F.col("held") >= share * F.col("pages"))).select("host", "hashes")
    prose = asked.join(common_, ["host", "hashes"], "left_semi").select("host", "digest", "place")
    return own.unionByName(prose).groupBy("host", "digest").agg(F.collect_list("place").alias("cut"))


def main_text(pages: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    store = Store(pages.sparkSession, "pages")
    read = store.save(read_pages(pages), compression="zstd")
    cuts = store.save(template_lines(store.save(neighbour_votes(read, store, reach))))
    hashes = F.transform("lines", lambda line: F.xxhash64(line))
    named = read.withColumn("digest", F.concat(F.hex(F.xxhash64(hashes, F.col("main"))), F.hex(F.xxhash64(F.lit(1), hashes, F.col("main")))))
    kept = F.filter("lines", lambda line, i: ~F.coalesce(F.array_contains("cut", i), F.lit(False)))
    text = F.array_join(F.when(F.col("cut").isNull(), F.col("lines")).otherwise(kept), "\n")
    out = named.join(cuts, ["host", "digest"], "left").select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
