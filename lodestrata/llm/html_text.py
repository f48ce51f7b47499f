"""Main text of web pages, with site templates removed by counted subtree hashes.

Each page is parsed once into blocks of text and the elements that hold them. Before any rule on
markup, every element's subtree of the whole page is hashed (tag, class, id, texts and
children); Spark counts on how many different pages of a host each hash occurs; a subtree that
recurs on many of them (a fixed number, or half of a small host's pages) is the site's template and
is deleted with all its text.

Markup adds to that, on what the counts leave: what it names as no part of an article goes
(menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments; by tag,
role, or a word in class or id) unless it holds most of the text, and where a page has articles (else
a main element) that are not just a small part of it, only those stay.

Counts are over pages whose texts differ, so copies of a page don't turn its content into a
template. Within articles, prose elements (paragraphs, headings, quotes) are never deleted, so
that a phrase that articles share stays.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by one space. Nothing is dropped for its length.

Defined cases: null or empty html gives an empty text; a null url has no host and no template;
broken markup is closed as browsers do (a new paragraph closes an open one, an unmatched end
tag is ignored, open elements end with the page; elements deeper than ``DEPTH`` are part of the one above; behind a quote that
nothing closes, tags end at the first ``>``); parsing is linear in the page; repeated rows each give their row; an empty
table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
import html
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.memory import lean
from lodestrata.llm.storage import Workspace

CONTAINER_PAGES, PROSE_PAGES = (8, 3), (16, 6)
"""Different pages of a host that a subtree must recur on, and the least number for hosts of few pages,
where half of the pages decide; the second pair holds for prose and inside articles and main."""
MOST, SMALL = 0.5, 1 / 3
"""Share of the text above which an element stays whatever its name; share below which articles are a small part of main or body."""

# Tags by how they are treated.
DROPPED = frozenset("script style noscript template head title nav footer aside form button input select textarea option label iframe svg canvas object audio video menu dialog fieldset".split())
RAW = frozenset("script style textarea title noscript template iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dd dt figcaption li td th".split())
BREAKS_NOT = INLINE | frozenset("img wbr input button select option textarea".split())
UNCOUNTED = INLINE | VOID | frozenset("html body head main article".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
SIBLINGS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in SIBLINGS.items()}
P_SCOPE = frozenset("article aside body button div dd dt li main section table td th blockquote figure".split())
# Words in class or id, and roles, of parts that are no article.
PART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored sponsors promo promos promotion banner banners cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars footer comment comments commentlist disqus respond reply replies "
    "related recommended recommendations share sharing social widget widgets pagination pager toolbar login masthead alert alerts paywall outbrain taboola discussion".split()
)
PAGE_WORDS = frozenset("header topbar".split())
# Words that name such a part alone, or with one of the words beside it (related-posts is one, related-work is none).
VAGUE_WORDS = frozenset("related notice notices alert alerts share sharing social reply replies respond banner banners menu menus promo promos promotion recommended widget widgets".split())
BESIDE_WORDS = frozenset(
    "post posts article articles link links story stories content contents news box bar button buttons list lists container wrapper wrap block area item items section sections form title head top bottom left right "
    "main site page primary secondary mobile header icon icons group row inner outer close info warning danger success error thread body text author meta date count first last global this media breaking".split()
)
REPLY_WORDS = frozenset("comment comments commentlist discussion disqus respond reply replies".split())
WRAPPERS = frozenset("form fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())

DEPTH = 512
"""Elements deeper than this are taken as part of the element that they lie in, as browsers do."""

_name = re.compile(r"/?[a-zA-Z][^\s/>]*")
_mark = re.compile(r"[\"'>]")
_attr = re.compile(r"(?<![\w-])(class|id|role|hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_elsewhere = re.compile(r"(?:no|with|has|without|show|hide)[-_]|.*[-_](?:enabled|disabled|open|closed|on|off|free|less)$", re.I)
_word = re.compile(r"[A-Za-z][a-z]+|[A-Z]+|[a-z]+")


def _attributes(rest: str) -> tuple[str, str, str, bool]:
    """(class, id, role, hidden) of a start tag."""
    named, anchor, role, hidden = "", "", "", False
    if "=" in rest or "hidden" in rest:
        for key, value in _attr.findall(rest):
            key, value = key.lower(), value.strip("\"'")
            if key == "class":
                named += " " + value
            elif key == "id":
                anchor = value.strip()
            elif key == "role":
                role = value.strip().lower()
            elif key == "hidden":
                hidden = True
            elif re.search(r"display\s*:\s*none", value):
                hidden = True
    return named.strip(), anchor, role, hidden


def _words(named: str) -> set[str]:
    """The words of class and id names that can name a part; a name such as has-sidebar or comments-open says what stands elsewhere, and
    is left out, and so is a vague word whose company says something else."""
    out: set[str] = set()
    for name in named.split():
        if not _elsewhere.match(name):
            words = [w.lower() for w in _word.findall(name)]
            out |= {w for w in words if w not in VAGUE_WORDS or all(x in BESIDE_WORDS or x in PART_WORDS for x in words if x != w)}
    return out


def _end_of_tag(page: str, at: int) -> int:
    """The place of the ``>`` that ends a tag, outside quotes; -1 where a quote stays open to the end."""
    while True:
        found = _mark.search(page, at)
        if found is None:
            return -1
        if found[0] == ">":
            return found.start()
        at = page.find(found[0], found.end()) + 1
        if not at:
            return -1


# What choose() knows of an element.
COUNTED, DROP, NEVER, HOLDS, ARTICLE, ROOT, HIDDEN, REPLIES = 1, 2, 4, 8, 16, 32, 64, 128


class _Element:
    __slots__ = ("tag", "parent", "depth", "named", "dropped", "root", "holds_root", "in_root", "in_replies", "hidden", "replies", "parts", "key")

    def __init__(self, tag, parent, named="", dropped=False):
        self.tag, self.parent, self.named, self.dropped = tag, parent, named, dropped
        self.root = self.holds_root = self.hidden = self.replies = False
        self.in_root = parent is not None and (parent.in_root or parent.root)
        self.in_replies = parent is not None and (parent.in_replies or parent.replies)
        self.depth = 0 if parent is None else parent.depth + 1
        self.parts, self.key = [], 0


class Tree(NamedTuple):
    """A page's blocks of text in page order, each with its innermost element that a rule or a count may
    ask for, and those elements, parents first; a key's last bit is set where the prose limit holds."""

    keys: list[int]
    parents: list[int]
    flags: list[int]
    texts: list[str]
    owners: list[int]


def tree(page: str) -> Tree:
    """All text of the page, no rule applied; only what RAW elements hold is no text."""
    top = _Element("#", None)
    node, runs, buffer = top, [], []

    held: dict[str, int] = {}  # open elements by tag

    def close(element):
        held[element.tag] = held.get(element.tag, 1) - 1
        digest = hashlib.blake2b(f"{element.tag}|{element.named}|{'|'.join(element.parts)}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
        element.key = int.from_bytes(digest, "little") >> 2 << 1
        element.parts = []
        if element.parent is not None:
            element.parent.parts.append(digest.hex())
        return element.parent

    def flush():
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                runs.append((text, node))
                node.parts.append(text)

    def shut(tags, scope):
        """End the nearest open element with one of these tags, if the scope has one."""
        nonlocal node
        at = node
        while at.tag not in tags:
            if at.parent is None or at.tag in scope:
                return
            at = at.parent
        while node is not at:
            node = close(node)
        node = close(node)

    at, n, last, strict = 0, len(page), page.rfind(">"), True
    below: dict[str, int] = {}  # open elements beyond DEPTH
    while at < n:
        begin = page.find("<", at)
        if begin < 0 or begin > last:  # no tag ends behind it
            end = page.find("<!--", at)
            buffer.append(page[at:] if end < 0 else page[at:end])
            break
        if begin > at:
            buffer.append(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        named_tag = _name.match(page, begin + 1)
        if named_tag is None:
            if page[begin + 1 : begin + 2] in ("!", "?", "/"):
                at = page.find(">", begin) + 1
            else:  # no tag: a character of the text
                buffer.append("<")
                at = begin + 1
            continue
        end = _end_of_tag(page, named_tag.end()) if strict else -1
        if end < 0:  # a quote that nothing closes: from here on, tags end at the first >
            strict, end = False, page.find(">", named_tag.end())
        at, rest = end + 1, page[named_tag.end() : end]
        name = named_tag[0].lower()
        if name[0] == "/":
            name = name[1:]
            if name not in BREAKS_NOT:
                flush()
            if below.get(name):
                below[name] -= 1
                continue
            if not held.get(name):
                continue
            above = node
            while above is not None and above.tag != name and above.tag not in ("article", "main", "body"):
                above = above.parent
            if above is not None and above.tag == name:
                if name in BREAKS_NOT and above is node and buffer and name in DROPPED:
                    flush()
                while node is not above:
                    if node.tag not in BREAKS_NOT:
                        flush()
                    node = close(node)
                if name not in BREAKS_NOT:
                    flush()
                node = close(node)
            continue
        if name not in BREAKS_NOT or name in DROPPED:
            flush() if name != "br" else buffer.append(" ")
        if name in VOID:
            continue
        if name in CLOSES_P:
            shut(("p",), P_SCOPE)
        if name in SIBLINGS:
            shut(*SIBLINGS[name])
        if node.depth >= DEPTH and name not in RAW:
            below[name] = below.get(name, 0) + 1
            continue
        said, anchor, role, hidden = _attributes(rest)
        named = f"{said} {anchor}".strip()
        element = _Element(name, node, named)
        element.root = (name in ("article", "main") or role == "main") and not element.in_replies  # an article among comments is one
        element.hidden = hidden
        if name not in ("html", "body", "article", "main"):
            words, anchors = _words(said), _words(anchor)
            if element.in_root:  # there an id is as often a heading's anchor: it names comments alone
                anchors &= REPLY_WORDS
            words |= anchors
            if name in INLINE:  # a token of code that is shown
                words -= {"comment", "comments", "discussion"}
            element.replies = bool(REPLY_WORDS.intersection(words))
            element.dropped = name in DROPPED or hidden or role in ROLES or bool(PART_WORDS.intersection(words)) or (not element.in_root and (name == "header" or bool(PAGE_WORDS.intersection(words))))
        elif name == "article":
            element.replies = bool(named) and not REPLY_WORDS.isdisjoint(_words(named))
            element.dropped = hidden or bool(named) and not _words(named).isdisjoint({"comment", "comments", "reply", "respond", "ad", "advert", "related", "sponsored"})
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            element.parts.append(page[at : end.start() if end else n])
            at = end.end() if end else n
            held[name] = held.get(name, 0) + 1
            close(element)
            continue
        if element.root and not element.dropped:
            above = node
            while above is not None:
                above.holds_root = True
                above = above.parent
        node = element
        held[name] = held.get(name, 0) + 1
        if rest.endswith("/") and name not in P_SCOPE and name in INLINE:
            node = close(node)
    flush()
    while node is not None:
        node = close(node)

    found = Tree([0], [-1], [0], [], [])
    at_of = {id(top): 0}

    def place(element):
        """The element's place in the tree, or that of the nearest one above it that any rule asks for."""
        if id(element) not in at_of:
            above, tag = place(element.parent), element.tag
            counted = tag not in UNCOUNTED and not (element.in_root and tag in PROSE)
            flags = COUNTED * counted | DROP * element.dropped | NEVER * (element.dropped and tag in DROPPED and tag not in WRAPPERS) | ARTICLE * (tag == "article") | ROOT * element.root
            if flags:
                flags |= HOLDS * element.holds_root | HIDDEN * element.hidden | REPLIES * element.replies
                found.keys.append(element.key | (tag in PROSE or element.in_root))
                found.parents.append(above)
                found.flags.append(flags)
                above = len(found.keys) - 1
            at_of[id(element)] = above
        return at_of[id(element)]

    for text, element in runs:
        at = place(element)
        if found.owners and found.owners[-1] == at:
            found.texts[-1] += " " + text
        else:
            found.texts.append(text)
            found.owners.append(at)
    return found


def choose(page: Tree, templates: frozenset[int] = frozenset()) -> list[int]:
    """The blocks of the main text: first all subtrees counted as templates go, wherever they are; then markup decides on what is left.

    An element that class, role or a wrapping form names as no article stays where it holds more than MOST of
    the text that the choice is about (comments: where they are all of it). Articles give way to the main element that they lie in,
    or to the body, of whose text they are less than SMALL; articles beside a main element count only where that is less than SMALL of both."""
    n = len(page.keys)
    gone, named, article, main = [False] * n, [False] * n, [0] * n, [0] * n
    for e in range(1, n):
        up, flags = page.parents[e], page.flags[e]
        drop = bool(flags & DROP) and not (flags & HOLDS and not flags & NEVER)
        gone[e] = gone[up] or bool(flags & COUNTED) and page.keys[e] in templates or drop and bool(flags & (NEVER | HIDDEN))
        named[e] = named[up] or drop
        article[e] = article[up] or (e if flags & ARTICLE and not named[e] else 0)
        main[e] = main[up] or (e if flags & ROOT and not flags & ARTICLE and not named[e] else 0)
    left = [k for k, e in enumerate(page.owners) if not gone[e]]

    def stays(scope: list[int]) -> list[bool]:
        """Which elements stay, where the text is that of the elements with a scope (its number: the part that they lie in)."""
        mass, total = [0] * n, {}
        for k in left:
            e, size = page.owners[k], len(page.texts[k])
            if scope[e] >= 0:
                mass[e] += size
                total[scope[e]] = total.get(scope[e], 0) + size
        for e in range(n - 1, 0, -1):
            mass[page.parents[e]] += mass[e]
        out = [False] * n
        for e in range(1, n):
            flags, whole = page.flags[e], total.get(scope[e], 0)
            drop = bool(flags & DROP) and not (flags & HOLDS and not flags & NEVER)
            most = mass[e] == whole if flags & REPLIES else mass[e] > MOST * whole
            out[e] = out[page.parents[e]] or drop and not most
        return [scope[e] >= 0 and not out[e] for e in range(n)]

    def size(good) -> int:
        return sum(len(page.texts[k]) for k in left if good(page.owners[k]))

    body, articles, mains = [0] * n, [a or -1 for a in article], [m or -1 for m in main]
    inside, outside = ([a if bool(m) == within else -1 for a, m in zip(articles, main, strict=True)] for within in (True, False))
    if any(mains[e] > 0 for e in page.owners):
        chosen, in_articles = stays(mains), size(lambda e: inside[e] > 0)
        whole = size(lambda e: inside[e] > 0 or chosen[e])
        if in_articles and in_articles >= SMALL * whole:
            chosen = stays(inside)
        beside = size(lambda e: outside[e] > 0)
        if whole < SMALL * (whole + beside):  # main is the smaller part: articles beside it are no teasers
            chosen = [a or b for a, b in zip(chosen, stays(outside), strict=True)]
    elif (in_articles := size(lambda e: article[e])) and in_articles >= SMALL * size(lambda e: article[e] or not named[e]):
        chosen = stays(articles)
    else:
        chosen = stays(body)
    return [k for k in left if chosen[page.owners[k]]]


def parse(page: str) -> list[tuple[str, tuple[int, ...]]]:
    """(text, hashes of the countable subtrees that it lies in) of each block that markup alone leaves."""
    whole, kept = tree(page), []
    for k in choose(whole):
        keys, e = [], whole.owners[k]
        while e > 0:
            if whole.flags[e] & COUNTED:
                keys.append(whole.keys[e])
            e = whole.parents[e]
        kept.append((whole.texts[k], tuple(keys)))
    return kept


TREE = "keys array<long>, parents array<int>, flags array<int>, texts array<string>, owners array<int>"
PARSED = f"page_id long, url string, host string, text_key long, {TREE}"


def _lists(trees: list[Tree]) -> list[pa.Array]:
    texts = [[x.encode("utf-8", "replace").decode() for x in t.texts] for t in trees]
    numbers = lambda name, kind: pa.array([getattr(t, name) for t in trees], pa.list_(kind))
    return [numbers("keys", pa.int64()), numbers("parents", pa.int32()), numbers("flags", pa.int32()), pa.array(texts, pa.list_(pa.string())), numbers("owners", pa.int32())]


@lean
def _parsed(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            trees = [tree(x or "") for x in part.column("html").to_pylist()]
            whole = [hashlib.blake2b("\n".join(t.texts[k] for k in choose(t)).encode("utf-8", "surrogatepass"), digest_size=8).digest() for t in trees]
            text_key = pa.array([int.from_bytes(x, "little", signed=True) for x in whole], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), part.column("host"), text_key, *_lists(trees)], ["page_id", "url", "host", "text_key", *Tree._fields])


@lean
def _chosen(batches):
    for batch in batches:
        rows = zip(*(batch.column(name).to_pylist() for name in (*Tree._fields, "found")), strict=True)
        texts = [" ".join(row[3][k] for k in choose(Tree(*row[:5]), frozenset(row[5] or ()))) for row in rows]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    """The host in lower case; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def counted() -> Column:
    """The distinct hashes of a page's countable subtrees, of the whole page."""
    marked = F.filter(F.arrays_zip("keys", "flags"), lambda e: e["flags"].bitwiseAND(F.lit(COUNTED)) != 0)
    return F.array_distinct(F.transform(marked, lambda e: e["keys"]))


def least_pages(prose: Column, pages: Column) -> Column:
    """On how many different pages a subtree must recur: a fixed number, or half of the host's pages if that is less."""
    least = lambda enough, few: F.least(F.lit(enough), F.greatest(F.lit(few), F.ceil(pages / 2)))
    return F.when(prose, least(*PROSE_PAGES)).otherwise(least(*CONTAINER_PAGES))


def templates(parsed: DataFrame) -> DataFrame:
    """(host, found): the hashes of each host's recurring subtrees. At most (hashes a page) / 3 of them a page of the host."""
    pages = parsed.where("host IS NOT NULL").select("host", "text_key", counted().alias("keys")).dropDuplicates(["host", "text_key"])
    total = pages.groupBy("host").agg(F.count("*").alias("pages"))
    counts = pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= CONTAINER_PAGES[1])
    return counts.join(total, "host").where(F.col("n") >= least_pages(F.col("key") % 2 != 0, F.col("pages"))).groupBy("host").agg(F.collect_set("key").alias("found"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page (page_id, url, html)."""
    work = Workspace(pages.sparkSession, "html")
    picked = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), "html")
    parsed = work.table(picked.mapInArrow(_parsed, PARSED), "parsed")
    found = work.table(templates(parsed), "templates")
    joined = parsed.drop("text_key").join(found, "host", "left").withColumn("found", F.array_intersect("keys", "found"))
    chosen = joined.select("page_id", "url", *Tree._fields, "found").mapInArrow(_chosen, "page_id long, url string, text string")
    return chosen.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
