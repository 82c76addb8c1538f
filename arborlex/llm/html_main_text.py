"""Operator 10: main text of web pages by consensus host paths.

Each page's elements are scored as containers: the text of paragraphs, less the text of their links, counts for
the element that holds them, and ``SHARE`` of it for the element above, and so on up, so that the common holder of
a split article wins unless one part has nearly all.  The best container's *generalised path* (tags with their classes,
digits as ``#``, from the body down) is the page's vote.  Votes are counted per host in Spark, and the pages
are extracted again at their host's winning path.  A page whose elements of that path hold less than half the text of
its own best container falls back on that, then on its body.

Inside the container, menus, headers, footers, sidebars, notices, adverts, forms, comments of
readers, scripts and styles are left out by tag, role and class.  A class alone is a weak sign (but for
readers' comments and notices): where less than a twentieth of a page's paragraphs would be left, the element with most of them
that a class has dropped is taken back, and so on; a class that says ``has-`` or ``no-`` something is no sign.  Character references are
decoded, white space inside a block becomes one blank, and blocks are joined by one blank.

Edge cases.  Null and empty pages give the empty text.  A null or odd url makes the empty host, whose pages
each follow their own best container.  Broken
markup is read as browsers do: unclosed elements end with their parent, stray end tags count for
nothing, an unclosed comment or script goes to the end of the page.  Ties of votes go to the
longer text, then to the path that sorts last.  Time and memory are linear in the page: paths are numbers (of the parent's path
and the element's own name), spelled out for the winner alone, and no element or character is walked over again for each
one after it.  Quoted values of more than ``QUOTED`` characters end at the next ``>``.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split())
DROP = RAW | frozenset("head nav header footer aside form button select menu dialog template svg canvas object".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Class and id words of what is not main text.
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar side aside widget related share sharing social newsletter subscribe "
    "signup login form search comment comments reply replies disqus cookie cookies consent gdpr notice notices alert popup "
    "modal overlay pagination pager toolbar".split())
#: Those of them that are a sure sign.
SURE_WORDS = frozenset("ad ads advert adverts advertisement comment comments reply replies disqus cookie cookies consent gdpr newsletter login signup".split())
#: Start tags that end an open element of the second set, if no element of the third stands between.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}

#: Parts that the pages of one host are dealt to.
SALTS = 64
#: What of an element's text counts for the element above it.
SHARE = 0.75

#: Characters of a quoted attribute value in which tags aren't looked for.
QUOTED = 8192

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]{0,%d}+\"|'[^']{0,%d}+')*+)>" % (QUOTED, QUOTED))
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"([^\s\"'<>/=]++)(?:\s*=\s*(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_SPACE = re.compile(r"\s+")


class Node:
    """An open element.  ``block`` is the nearest block, ``p`` an open paragraph that a block ends, ``ends`` for each kind of
    ``CLOSES`` the topmost element that another of its kind ends; ``own`` is how the element itself is dropped."""

    __slots__ = ("block", "drop", "ends", "link", "own", "p", "parent", "path", "root", "strong", "tag", "text")

    def __init__(self, tag: str, parent: Node | None, path: int, own: str, link: bool):
        self.tag, self.parent, self.path, self.own, self.link, self.text = tag, parent, path, own, link, 0
        self.drop, self.root = False, None
        self.strong = own == "strong" or parent is not None and parent.strong
        self.block = self if parent is None or tag in BLOCK else parent.block
        self.p = self if tag == "p" else None if parent is None or tag in _HOLDERS else parent.p
        if parent is None or tag not in _LISTED:
            self.ends = parent.ends if parent else (None,) * len(_KINDS)
        else:
            self.ends = tuple(None if tag in stops else e or (self if tag in kinds else None)
                              for (kinds, stops), e in zip(_KINDS, parent.ends, strict=True))


_HOLDERS = frozenset("table td th div article section body li".split())
_KINDS = tuple(CLOSES.values())
_PLACE = {tag: i for i, tag in enumerate(CLOSES)}
_LISTED = frozenset(x for kinds, stops in _KINDS for x in kinds | stops)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text) if text else ():
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _dropped(tag: str, attributes: dict[str, str]) -> str:
    """``strong``, ``weak`` or nothing."""
    if tag in DROP or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return "strong"
    if attributes.get("role", "").lower() in DROP_ROLES:
        return "strong"
    if tag in ("html", "body", "article", "main"):
        return ""
    found: set[str] = set()
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = re.split(r"[^a-z0-9]+", name)
        if words[0] not in ("has", "with", "no"):
            found = {*found, *(w for w in words if w in DROP_WORDS)}
    return "strong" if found & SURE_WORDS else "weak" if found else ""


class Page:
    """The pieces of a page in order (element, text), an empty text where a block begins or ends, its elements, and the
    numbers of their paths."""

    def __init__(self):
        self.pieces: list[tuple[Node, str]] = []
        self.nodes: list[Node] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.names: list[tuple[int, str]] = [(-1, "")]

    def path(self, parent: int, name: str) -> int:
        key = (parent, name)
        if key not in self.paths:
            self.paths[key] = len(self.names)
            self.names.append(key)
        return self.paths[key]

    def spelled(self, path: int) -> str:
        out = []
        while path > 0:
            path, name = self.names[path]
            out.append(name)
        return "".join(f">{x}" for x in reversed(out))

    def number(self, spelled: str) -> int | None:
        at = 0
        for name in spelled.split(">")[1:]:
            at = self.paths.get((at, name))
            if at is None:
                return None
        return at

    def judge(self) -> None:
        """Sets ``drop`` of all elements: what is dropped by tag or role, and by class unless that leaves too little."""
        lifted: set[int] = set()
        paragraphs = [(n, len(t)) for n, t in self.pieces if t and not n.strong and not n.link and n.block.tag in _PARAGRAPHS]
        total = sum(size for _, size in paragraphs)
        for step in range(_LIFTS + 1):
            for n in self.nodes:
                up = n.parent.root if n.parent else None
                n.root = up or (n if n.own == "weak" and step < _LIFTS and id(n) not in lifted else None)
                n.drop = n.strong or n.root is not None
            held: dict[int, list] = {}
            for n, size in paragraphs:
                if n.root is not None:
                    held.setdefault(id(n.root), [0, n.root])[0] += size
            kept = total - sum(x for x, _ in held.values())
            best = max(held.values(), key=lambda x: x[0], default=None)
            if best is None or 20 * kept >= total or best[0] < _LEAST:
                return
            lifted.add(id(best[1]))


#: Blocks whose text is a paragraph's, characters of a dropped element that may be taken back, and how many are taken back one by one.
_PARAGRAPHS = frozenset("p pre blockquote article main".split())
_LEAST, _LIFTS = 200, 8


def parse(page: str) -> Page:
    """The page as a browser would read it, as far as blocks go."""
    out = Page()
    root = Node("html", None, 0, "", False)
    out.nodes.append(root)
    pieces, stack, opened = out.pieces, [root], {"html": 1}
    at, size, last = 0, len(page), page.rfind(">")

    def say(text: str) -> None:
        if text:
            pieces.append((stack[-1], entities.unescape(text) if "&" in text else text))

    def close(until: Node) -> None:
        while stack[-1] is not until:
            opened[stack.pop().tag] -= 1

    while at < size:
        lt = page.find("<", at)
        if lt < 0 or lt > last and not page.startswith("<!--", lt):
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else size
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else size
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            say("<")
            at = lt + 1
            continue
        at, tag = m.end(), m[1].lower()
        if page[lt + 1] == "/":
            if opened.get(tag) and tag != "html":
                while stack[-1].tag != tag:
                    opened[stack.pop().tag] -= 1
                opened[stack.pop().tag] -= 1
            if tag in BLOCK:
                pieces.append((stack[-1], ""))
            continue
        if tag in ("html", "body") or tag == "head" and len(stack) > 1:
            continue
        if tag in VOID:
            pieces.append((stack[-1], " " if tag == "br" else ""))
            continue
        if tag in RAW:
            end = _END[tag].search(page, at)
            at = end.end() if end else size
            continue
        if tag in BLOCK and stack[-1].p is not None:
            close(stack[-1].p.parent)
        if tag in CLOSES and stack[-1].ends[_PLACE[tag]] is not None:
            close(stack[-1].ends[_PLACE[tag]].parent)
        node = stack[-1]
        attributes = _attributes(m[2])
        classes = ".".join(sorted(re.sub(r"\d+", "#", c) for c in attributes.get("class", "").replace(">", "").split()))
        node = Node(tag, node, out.path(node.path, tag + (f".{classes}" if classes else "")), _dropped(tag, attributes), node.link or tag == "a")
        out.nodes.append(node)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        if tag in BLOCK:
            pieces.append((node, ""))
        if m[2].endswith("/") and tag in ("svg", "path", "use"):
            opened[stack.pop().tag] -= 1
    out.judge()
    return out


_END = {tag: re.compile(rf"</{re.escape(tag)}\b[^>]*+>", re.I) for tag in RAW}


def best_container(page: Page) -> Node | None:
    """The element whose paragraphs hold the most text, links counted against it."""
    for node, text in page.pieces:
        if text and not node.drop:
            amount = len(text) - len(text) // 8 if not text.isspace() else 0
            x = node.block
            # text of a paragraph or heading counts for its holder, bare text for the block itself
            holder = x.parent if x.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "li") and x.parent else x
            if holder.tag in ("ul", "ol", "blockquote") and holder.parent:
                holder = holder.parent
            amount = -amount if node.link else amount
            while holder is not None and abs(amount) >= 1:
                holder.text += amount
                holder, amount = holder.parent, amount * SHARE
    best = None
    for x in page.nodes:
        if not x.drop and x.text > 0 and (best is None or x.text >= best.text):
            best = x
    return best


def vote(page: str) -> tuple[str, int] | None:
    parsed = parse(page)
    best = best_container(parsed)
    return (parsed.spelled(best.path), int(best.text)) if best else None


def _held(page: Page, path: int) -> str:
    """The text that isn't dropped inside elements of that path."""
    inside: set[int] = set()
    for n in page.nodes:  # an element comes after its parent
        if n.path == path or n.parent is not None and id(n.parent) in inside:
            inside.add(id(n))
    return _SPACE.sub(" ", "".join(t or " " for n, t in page.pieces if not n.drop and id(n) in inside)).strip()


def main_text(page: str, path: str | None) -> str:
    """The text at the host's path if it is at least half as long as that in the page's own best container, else
    that, or the text of the page."""
    parsed = parse(page)
    best = best_container(parsed)
    own = _held(parsed, best.path if best else 0)
    wanted = parsed.number(path) if path is not None else None
    if wanted is None or best and wanted == best.path:
        return own
    text = _held(parsed, wanted)
    return text if text and 2 * len(text) >= len(own) else own


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the winning container path of each host."""
    def run(batches):
        for batch in batches:
            votes = [vote(x) if x else None for x in batch.column(1).to_pylist()]
            keep = [i for i, v in enumerate(votes) if v]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int32())),
                                              pa.array([votes[i][0] for i in keep], pa.string()),
                                              pa.array([votes[i][1] for i in keep], pa.int64())], names=["host", "path", "score"])

    votes = pages.select(host(F.col("url")).alias("host"), "html").where("host <> ''").mapInArrow(run, "host string, path string, score bigint")
    votes = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    return votes.groupBy("host").agg(F.max(F.struct("n", "score", "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages(page_id, url, html, ...)``."""
    def run(batches):
        for batch in batches:
            texts = [main_text(x, p) if x else "" for x, p in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = bounded(pages).select(F.col("page_id").cast("bigint"), "url", "html", host(F.col("url")).alias("host"))
    # a host's pages are dealt by a salt, so a host of any size is spread
    salt = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(SALTS)).cast("int")
    paths = host_paths(pages).select("host", "path", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return rows.withColumn("salt", salt).join(paths, ["host", "salt"], "left").select("page_id", "url", "html", "path").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")
