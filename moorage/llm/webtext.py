"""Main text of web pages: articles by their element and marks, other text by a suffix array over each host's pages.

A page is read into blocks. Blocks in ``article`` or ``main`` are the text of the page; blocks marked as menus, headers,
footers, sidebars, notices, adverts, forms or comments are not. Unmarked blocks of a closed article all stay, whatever they
share with other pages. Everything outside articles is the loose text of the page. The loose texts of a host's pages are
concatenated, each block behind the name of its element, and their suffixes sorted: substrings of at least ``RUN`` tokens
that stand on several distinct pages, the template of the host, are found as neighbours with that much in common. A page
without article keeps the runs of its unmarked blocks that are not so covered. Where a page never closes its article, the
suffixes of that are sorted among the others, and the article ends before the template that follows it.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import mix, run_starts, texts, tidy
from moorage.session import settled

# Words of a repeated substring at least, and the distinct pages it must stand on.
RUN, PAGES = 8, 3
# Pages of a host, and bytes of their html, whose suffixes are sorted together; larger hosts are dealt into parts by a hash,
# and windows of ``RUN`` tokens are counted over all parts, so that the parts do not show in the result.
PART_PAGES, PART_BYTES = 512, 32 << 20

_RAW = "script|style|title|textarea|noscript|template|svg|iframe|object|select|button|math|audio|video|canvas"
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:>|\Z).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
_TEXT = frozenset(("article", "main"))
_MARKED = frozenset("nav footer aside form menu dialog".split())
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form header login masthead menu modal nav navbar navigation newsletter notice popup promo related reply search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar".split()
)
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Known compounds, without what separates their parts.
_COMPOUNDS = frozenset(
    "adbanner adbox adcontainer adslot adunit adwrapper breadcrumbnav commentform commentlist commentssection cookiebanner cookiebar "
    "cookieconsent cookienotice footernav globalfooter globalheader loginform mainmenu mainnav mainnavigation navmenu newsletterform "
    "newslettersignup pagefooter pageheader popupoverlay relatedarticles relatedcontent relatedlinks relatedposts relatedstories searchbar "
    "searchbox searchform sharebuttons sharelinks sidebarleft sidebarright signupform sitefooter siteheader sitemenu sitenav "
    "sitenavigation socialicons sociallinks socialshare subscribeform topbar topnav usercomments".split()
)
_BETWEEN = re.compile(r"[\d_-]+")
# How an element is marked: by a class or id, which says nothing about an article inside, or by its tag, role or being hidden.
NAMED, BUILT = 1, 2
# Where a block stands: outside articles, in one that is closed, or in one that never is.
LOOSE, CLOSED, OPEN = 0, 1, 2
_BLOCKS = ("blocks", "marks", "elements", "kinds")


def _named(names: str, in_text: bool) -> bool:
    """Whether one of the class or id names is a whole mark or a known compound; an article's own header is text."""
    plain = {_BETWEEN.sub("", n) if n[:1].isalpha() else n for n in names.split()}
    if in_text:
        plain.discard("header")
        plain.discard("pageheader")
    return not _COMPOUNDS.isdisjoint(plain) or not _MARKS.isdisjoint(plain)


def _marked(name: str, rest: str, in_text: bool) -> int:
    if name in _MARKED or name == "header" and not in_text:
        return BUILT
    if not rest or "=" not in rest and "hidden" not in rest.lower():
        return 0
    named = 0
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return BUILT
        if key == "role" and value in _ROLES:
            return BUILT
        if key in ("class", "id") and name not in ("body", "html", *_TEXT) and _named(value, in_text):
            named = NAMED
    return named


def blocks(page: str) -> list[tuple[str, bool, bool, str]]:
    """(text, in an article, marked as boilerplate, name of its element) of each block that has text, in page order."""
    return _read(page)[0]


def _read(page: str) -> tuple[list[tuple[str, bool, bool, str]], int]:
    """The blocks of a page, and how many there are until an article that stays open begins or the last of its inner ones is closed."""
    out: list[tuple[str, bool, bool, str]] = []
    closed = 0
    stack: list[tuple[str, bool, int]] = []
    # Open elements of each name, so that a close without any is seen at once.
    opened: Counter[str] = Counter()
    text, marked, pieces, at = False, 0, [], 0

    def end() -> None:
        words = entities.unescape("".join(pieces)).split()
        if words:
            out.append((" ".join(words), text, marked > 0, stack[-1][0] if stack else ""))
        pieces.clear()

    for tag in _TAG.finditer(page):
        if tag.start() > at:
            pieces.append(page[at : tag.start()])
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in _BLOCK:
            end()
        if tag["close"]:
            if opened[name]:
                place = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name)
                if any(n in _BLOCK for n, _, _ in stack[place:]):
                    end()
                if any(n in _TEXT for n, _, _ in stack[place:]):
                    closed = len(out)
                _, text, marked = stack[place]
                opened.subtract(n for n, _, _ in stack[place:])
                del stack[place:]
        elif name not in _VOID:
            changed = _marked(name, tag["rest"], text)
            if changed and not marked:
                end()
            stack.append((name, text, marked))
            opened[name] += 1
            if name in _TEXT and not text:
                closed = len(out)
                marked = 0 if marked == NAMED else marked
            text, marked = text or name in _TEXT, max(marked, changed)
    if at < len(page):
        pieces.append(page[at:])
    end()
    return out, closed if text else len(out)


def repeated(streams: list[list[int]], run: int = RUN, pages: int = PAGES, holders: int | None = None) -> list[np.ndarray]:
    """Which words of each stream, that of a page, lie in a substring of ``run`` words that stands on ``pages`` distinct pages.

    With ``holders`` only so many streams, the first, count as pages; such substrings are found in the others too.
    """
    lengths = np.array([len(s) for s in streams], np.int64)
    ends = np.cumsum(lengths)
    text = np.concatenate([np.array(s, np.int64) for s in streams]) if streams else np.zeros(0, np.int64)
    page = np.repeat(np.arange(len(streams)), lengths)
    # Suffixes in the order of their first words, by doubling: the rank of twice as many is that of two ranks.
    _, rank = np.unique(text, return_inverse=True)
    order, width = np.argsort(rank, kind="stable"), 1
    while width < run and len(text):
        step = min(width, run - width)
        later = np.zeros(len(text), np.int64)
        inside = np.arange(len(text)) + step < ends[page]
        later[inside] = rank[np.flatnonzero(inside) + step] + 1
        pair = rank * (len(text) + 1) + later
        order = np.argsort(pair, kind="stable")
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], pair[order][1:] != pair[order][:-1]]))
        width += step
    covered = np.zeros(len(text) + 1, np.int64)
    if len(text):
        # Neighbours of one rank share at least ``run`` words, if these do not pass the end of their page.
        whole = np.arange(len(text)) + run <= ends[page]
        order = order[whole[order]]
        ranks, owners = rank[order], page[order]
        new = np.concatenate([[True], (ranks[1:] != ranks[:-1]) | (owners[1:] != owners[:-1])]) if len(order) else np.zeros(0, bool)
        new &= owners < (len(streams) if holders is None else holders)
        wide = np.bincount(ranks[new], minlength=len(text)) >= pages
        hits = order[wide[ranks]]
        np.add.at(covered, hits, 1)
        np.add.at(covered, hits + run, -1)
    inside = np.cumsum(covered)[:-1] > 0
    return [inside[b - n : b] for b, n in zip(ends, lengths)]


def host(url: str = "url"):
    """The host of an absolute address in lower case, else the empty text."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def main_text(pages: DataFrame, part_pages: int = PART_PAGES, part_bytes: int = PART_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Also, of pages without article or with one that is never closed, the words outside articles, those of them that are
    repeated on the host, and those that the text lost for that; null for pages whose articles are closed.

    Null pages are empty, and an empty page has the empty text. Broken and unclosed markup is read as far as it goes.
    Pages without host form one group. Repeated rows are pages of their own; a page whose unmarked text is repeated
    entirely is a copy of others and keeps it. An empty table gives no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), host().alias("host"), "html")
    # Few hosts have several parts, so that pages need not be shuffled to learn theirs.
    most = F.greatest(F.ceil(F.count(F.lit(1)) / part_pages), F.ceil(F.sum(F.octet_length("html").cast("long")) / part_bytes))
    sizes = settled(rows.groupBy("host").agg(most.alias("parts")).where("parts > 1"), "hosts")
    rows = rows.join(sizes, "host", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("page_id", "url", "html"), "parts"))

    @tidy
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            article, loose = [], []
            for page in texts(batch.column("html")):
                found, closed = _read(page)
                has = any(in_text for _, in_text, _, _ in found) and closed == len(found)
                article.append("\n\n".join(t for t, in_text, marked, _ in found if in_text and not marked) if has else None)
                kinds = [LOOSE if not b[1] else CLOSED if k < closed else OPEN for k, b in enumerate(found)]
                loose.append([(t, marked, name, kind) for (t, _, marked, name), kind in zip(found, kinds) if kind == LOOSE or not has])
            columns = [batch.column(name) for name in ("page_id", "url", "host", "part", "parts")]
            columns.append(pa.array(article, pa.string()))
            for k, of in enumerate((pa.string(), pa.bool_(), pa.string(), pa.int8())):
                columns.append(pa.array([[b[k] for b in own] for own in loose], pa.list_(of)))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "part", "parts", "article", *_BLOCKS])

    place = f"page_id {kind}, url string, host string, part long, parts long"
    read_rows = rows.select("page_id", "url", "host", "part", "parts", "html")
    parsed = f"{place}, article string, blocks array<string>, marks array<boolean>, elements array<string>, kinds array<tinyint>"
    # Pages are parsed once; what stands outside their articles, and articles without an end, is all that meets on the host.
    known = settled(read_rows.mapInArrow(read, parsed), "page-blocks")

    def sort_host(table: pa.Table, common: pa.Table) -> pa.Table:
        rows, streams, names = _streams(table)
        covered = repeated(streams, holders=len(rows))
        if common.num_rows:
            held = np.unique(np.concatenate([np.frombuffer(w, np.uint64) for w in common.column("windows").to_pylist()]))
            covered = _add_known(covered, streams, names, held)
        kept, loose, repeats, lost = [], [], [], []
        for own, outside, inside in zip(rows, covered, covered[len(rows) :]):
            around = _spans([b for b in own if b[3] == LOOSE], outside)
            within = _spans([b for b in own if b[3] != LOOSE], inside)
            text, less = _ended(within) if within else _unique(around)
            kept.append(text)
            lost.append(less)
            loose.append(sum(len(words) for words, *_ in around))
            repeats.append(int(sum(c.sum() for *_, c in around)))
        columns = [table.column("page_id"), table.column("url"), pa.array(kept, pa.string())]
        columns += [pa.array(c, pa.int64()) for c in (loose, repeats, lost)]
        found = pa.table(columns, names=["page_id", "url", "text", "loose_words", "repeated_words", "lost_words"])
        return found.filter(pa.array([not has for has in table.column("has_article").to_pylist()], pa.bool_()))

    out = f"page_id {kind}, url string, text string, loose_words long, repeated_words long, lost_words long"
    loose = known.select("page_id", "url", "host", "part", "parts", *_BLOCKS, F.col("article").isNotNull().alias("has_article"))
    own = loose.groupBy("host", "part")
    if sizes.isEmpty():
        found = own.applyInArrow(lambda table: sort_host(table, table.slice(0, 0)), out)
    else:
        held = loose.where("parts > 1").groupBy("host", "part")
        held = held.applyInArrow(_count_part, "host string, slice long, part long, windows binary, pages binary")
        common = settled(held.groupBy("host", "slice").applyInArrow(_count_host, "host string, part long, windows binary"), "host-windows")
        found = own.cogroup(common.groupBy("host", "part")).applyInArrow(sort_host, out)
    none = [F.lit(None).cast("long").alias(c) for c in ("loose_words", "repeated_words", "lost_words")]
    articles = known.where("article is not null").select("page_id", "url", F.col("article").alias("text"), *none)
    return articles.unionByName(found).withColumn("n_chars", F.length("text").cast("long"))


def _streams(table: pa.Table) -> tuple[list[list[tuple]], list[list[int]], dict[str, int]]:
    """The blocks of each page; the tokens of all loose texts, then of all articles, as numbers; and these numbers."""
    names: dict[str, int] = {}
    found = [list(zip(*own)) for own in zip(*(table.column(name).to_pylist() for name in _BLOCKS))]
    # Two streams of a page, so that no run leads from its loose text into its article.
    sides = [[(t, name) for t, _, name, kind in own if (kind == LOOSE) is side] for side in (True, False) for own in found]
    # No word holds a blank, so no word is the name of an element.
    streams = [[names.setdefault(w, len(names)) for t, name in own for w in (" " + name, *t.split(" "))] for own in sides]
    return found, streams, names


def _spans(own: list[tuple], covered: np.ndarray) -> list[tuple[list[str], bool, int, np.ndarray]]:
    """Words, mark and kind of each block of a stream, and which of its words are covered."""
    out, at = [], 0
    for text, marked, _, kind in own:
        words = text.split(" ")
        out.append((words, marked, kind, covered[at + 1 : at + 1 + len(words)]))
        at += 1 + len(words)
    return out


_PLACES = mix(np.arange(1, RUN + 1, dtype=np.uint64)) | np.uint64(1)


def _windows(streams: list[list[int]], names: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all windows of ``RUN`` words inside streams, and how many each stream has."""
    codes = np.array([xxhash.xxh3_64_intdigest(w) for w in names], np.uint64)
    lengths = np.array([len(s) for s in streams], np.int64)
    many = np.maximum(lengths - RUN + 1, 0)
    words = codes[np.concatenate([np.array(s, np.int64) for s in streams])] if lengths.sum() else codes[:0]
    first = np.repeat(run_starts(lengths)[:-1] - run_starts(many)[:-1], many) + np.arange(many.sum())
    total = np.zeros(len(first), np.uint64)
    for place in range(RUN):
        word = words[first + place]
        total += (word ^ (word >> np.uint64(29))) * _PLACES[place]
    return mix(total), many


def _count_part(table: pa.Table) -> pa.Table:
    """The windows of a part in slices by name, and on how many distinct pages each is (``PAGES`` stands for more)."""
    rows, streams, names = _streams(table)
    windows, many = _windows(streams, names)
    owner = np.repeat(np.arange(len(streams)), many)
    order = np.lexsort((owner, windows))
    windows, owner = windows[order], owner[order]
    new = np.concatenate([[True], (windows[1:] != windows[:-1]) | (owner[1:] != owner[:-1])])[: len(windows)]
    # Articles only ask for their windows; they are on no page.
    windows, place = np.unique(windows[new], return_inverse=True)
    pages = np.bincount(place, owner[new] < len(rows), len(windows))
    parts, part = table.column("parts")[0].as_py(), table.column("part")[0].as_py()
    slices = (windows % np.uint64(parts)).astype(np.int64)
    order = np.argsort(slices, kind="stable")
    windows, pages = windows[order], np.minimum(pages[order], PAGES).astype(np.uint8)
    ends = np.searchsorted(slices[order], np.arange(parts + 1))
    own = [(k, a, b) for k, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
    return pa.table(
        {
            "host": pa.array([table.column("host")[0].as_py()] * len(own), pa.string()),
            "slice": pa.array([k for k, _, _ in own], pa.int64()),
            "part": pa.array([part] * len(own), pa.int64()),
            "windows": pa.array([windows[a:b].tobytes() for _, a, b in own], pa.binary()),
            "pages": pa.array([pages[a:b].tobytes() for _, a, b in own], pa.binary()),
        }
    )


def _count_host(table: pa.Table) -> pa.Table:
    """For each part its windows that are on ``PAGES`` pages of the host, but not of the part."""
    parts = table.column("part").to_pylist()
    windows = [np.frombuffer(w, np.uint64) for w in table.column("windows").to_pylist()]
    pages = [np.frombuffer(n, np.uint8) for n in table.column("pages").to_pylist()]
    names, place = np.unique(np.concatenate(windows), return_inverse=True)
    wide = np.bincount(place, np.concatenate(pages), len(names)) >= PAGES
    held = [w[(n < PAGES) & wide[np.searchsorted(names, w)]] for w, n in zip(windows, pages)]
    own = [(part, w) for part, w in zip(parts, held) if len(w)]
    return pa.table(
        {
            "host": pa.array([table.column("host")[0].as_py()] * len(own), pa.string()),
            "part": pa.array([part for part, _ in own], pa.int64()),
            "windows": pa.array([w.tobytes() for _, w in own], pa.binary()),
        }
    )


def _add_known(covered: list[np.ndarray], streams: list[list[int]], names: dict[str, int], known: np.ndarray) -> list[np.ndarray]:
    windows, many = _windows(streams, names)
    hits = np.split(np.isin(windows, known), np.cumsum(many)[:-1])
    out = []
    for inside, own in zip(covered, hits):
        inside = inside.copy()
        for a in np.flatnonzero(own):
            inside[a : a + RUN] = True
        out.append(inside)
    return out


def _unique(spans: list[tuple[list[str], bool, int, np.ndarray]]) -> tuple[str, int]:
    """The unmarked blocks less repeated runs, and how many words these had."""
    spans = [(words, c) for words, marked, _, c in spans if not marked]
    lost = int(sum(c.sum() for _, c in spans))
    if lost == sum(len(words) for words, _ in spans):
        return "\n\n".join(" ".join(words) for words, _ in spans), 0
    left = (" ".join(w for w, c in zip(words, inside) if not c) for words, inside in spans)
    return "\n\n".join(t for t in left if t), lost


def _ended(spans: list[tuple[list[str], bool, int, np.ndarray]]) -> tuple[str, int]:
    """The unmarked blocks of articles until only template follows in one that is never closed, and how many words that had."""
    spans = [(words, kind == OPEN and c.all()) for words, marked, kind, c in spans if not marked]
    end = max((k + 1 for k, (_, template) in enumerate(spans) if not template), default=len(spans))
    return "\n\n".join(" ".join(words) for words, _ in spans[:end]), sum(len(words) for words, _ in spans[end:])
