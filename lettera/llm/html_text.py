"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of block elements from the root.  What by
its element or its declared role is never article text (scripts, navigation and so on) is set
aside first; what only its class, id or a form around it speaks against is set aside unless it holds
most of the page's prose.  For each path the length of its text and its punctuation are set in relation to
the number of blocks that share it; both ratios are smoothed along the page, fused, and paths
below the threshold are left out.  A path that stands among the blocks of a chosen container, a
heading above its paragraphs, is carried by its neighbours through the smoothing; where the page
declares no article, the container of the chosen blocks gives its other blocks as well (lists,
tables, code).

Every step is linear in the page, however broken it is: elements are numbered, each knows its
parent, and what holds for an element and all around it, or for all within it, is passed down or
added up along these numbers.  No search looks twice at what an earlier one has passed.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, texts

#: Element names of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
NEVER = RAW | set(
    "head template svg math object canvas audio video map select option datalist button "
    "nav footer aside menu dialog".split()
)
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr br img".split()
)
#: What ends an open p: any of these that begins.
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
BOUNDARY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}
CONTAINERS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "summary", "legend"}
GROUPS = {"ul", "ol", "dl", "table", "pre", "figure", "blockquote"}
ROLES = set("navigation banner contentinfo complementary search alert dialog menu menubar "
            "alertdialog status".split())
#: Words that an element's class or id may consist of where it is not the article.
ASIDE = set(
    "ad ads adv advert advertisement advertising adbox adsense sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login sidebar side aside menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer foot header masthead topbar toolbar comment comments comentarios "
    "kommentare commentaires disqus respond reply replies response responses discussion related recommended "
    "recommendations share sharing social widget widgets tags toc search skip hidden copyright legal disclaimer".split()
)
#: Parts of a name that say how a page is laid out (has-sidebar, header-fixed), not what an element is.
STATES_BEFORE = set("has have no not without with is".split())
STATES_AFTER = set("enabled disabled fixed sticky open opened closed active inactive on off visible collapsed "
                   "expanded free less".split())
#: Words whose compounds name other people's text or notices as well (comment-list, cookie-bar).
FOREIGN = set(
    "ad ads adv advert advertisement advertising adbox adsense sponsor sponsored promo promotion cookie cookies "
    "consent gdpr newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager comment "
    "comments comentarios kommentare commentaires disqus respond reply replies response responses discussion "
    "related recommended recommendations copyright legal disclaimer".split()
)
#: Words that speak for an element whatever else it is called.
ARTICLE = set("article content post entry story main body text maintext".split())
#: Ways to set an element aside: for good; if there is other prose; unless it holds nearly all of the
#: other prose; unless it holds most of it.
KEPT, ALWAYS, STRONG, PLAIN, WEAK = 0, 1, 2, 3, 4
#: What a heading above readers' comments consists of, with or without their number.
_READERS = re.compile(
    r"\W*(?:\d+\W*)?(?:comments?|responses?|replies|kommentare?|antworten|commentaires?|r\u00e9ponses?"
    r"|comentarios?|respuestas?)\W*(?:\d+\W*)?",
    re.I,
)
_NAME = re.compile(r"(/?)([A-Za-z][^\s/<>]*)")
_PLAIN_REST, _UNQUOTED = re.compile(r"[^<>]*"), re.compile(r"[^<>\"']*")
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？¿¡]")


def _named(value: str, inline: bool) -> int:
    """What the words of a class or id speak for."""
    names, found = value.split(), KEPT
    for word in names:
        parts = [p for p in re.split(r"[-_]+", word) if p]
        if word in ASIDE:
            way = STRONG if word in FOREIGN else PLAIN
        elif inline or not any(p in ASIDE for p in parts):
            continue
        elif parts[0] in STATES_BEFORE or parts[-1] in STATES_AFTER:
            continue
        else:
            way = STRONG if any(p in FOREIGN for p in parts) else PLAIN if all(p in ASIDE for p in parts) else WEAK
        found = way if found == KEPT else min(found, way)
    return WEAK if found in (STRONG, PLAIN) and ARTICLE.intersection(names) else found


def _set_aside(name: str, rest: str, inside: bool) -> int:
    """Whether an element is never part of the article, by its name or what it declares."""
    if name in NEVER or (name == "header" and not inside):
        return ALWAYS
    found = WEAK if name in ("form", "fieldset") else KEPT
    if not rest.strip() or name in ("html", "body"):
        return found
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" and (m.start() == 0 or rest[m.start() - 1].isspace()):
            return ALWAYS
        if key == "aria-hidden" and value == "true" and name != "main":
            return ALWAYS
        if key == "role" and value in ROLES:
            return ALWAYS
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return ALWAYS
        way = KEPT
        if key == "role" and value == "form":
            way = WEAK
        elif key in ("class", "id") and not (inside and name in INLINE):
            way = _named(value, name in INLINE)
            if name == "main" and way:
                way = WEAK
        found = way if found == KEPT else min(found, way or found)
    return ALWAYS if found and name in INLINE else found


class Scanner:
    """The marks and tags of a page from left to right; no part of it is searched twice."""

    def __init__(self, page: str) -> None:
        self.page, self.next, self.simple = page, {}, 0

    def find(self, mark: str, start: int) -> int:
        """The next place of ``mark``, the end of the page if there is none; starts never go back."""
        at = self.next.get(mark, -1)
        if at < start:
            at = self.page.find(mark, start)
            at = self.next[mark] = len(self.page) if at < 0 else at
        return at

    def tag_end(self, start: int) -> int:
        """Where the tag ends whose rest begins at ``start``: at a > outside of quotes, else at the
        first >, if no < comes before; -1 if it doesn't end.

        What one reading of quotes has passed in vain, no other tries again.
        """
        page, at = self.page, start
        if start >= self.simple:
            while (at := _UNQUOTED.match(page, at).end()) < len(page) and page[at] not in "<>":
                close = self.find(page[at], at + 1)
                if close == len(page):
                    at = close
                    break
                at = close + 1
            if at < len(page) and page[at] == ">":
                return at
            self.simple = at
        at = _PLAIN_REST.match(page, start).end()
        return at if at < len(page) and page[at] == ">" else -1

    def tokens(self) -> Iterator[tuple[str, str, str]]:
        """("text", text, ""), ("plain", text without references, ""), ("open", name, rest) and
        ("close", name, "").  What stands in raw elements, comments and declarations is left out."""
        page, begin, at, size = self.page, 0, 0, len(self.page)
        while at < size:
            start = page.find("<", at)
            if start < 0:
                break
            token, at = None, start + 1
            if page.startswith("<!--", start):
                end = next((start + 4 + len(x) for x in (">", "->") if page.startswith(x, start + 4)), None)
                if end is None:
                    ends = ((self.find(x, start + 4), len(x)) for x in ("-->", "--!>"))
                    end = min((place + more if place < size else size) for place, more in ends)
            elif page.startswith("<![CDATA[", start) and (close := self.find("]]>", start + 9)) < size:
                end, token = close + 3, ("plain", page[start + 9 : close], "")
            elif page.startswith(("<!", "<?"), start):
                close = self.find(">", start + 2)
                end = close + 1 if close < size else None
            elif m := _NAME.match(page, start + 1):
                close = self.tag_end(m.end())
                end = close + 1 if close >= 0 else None
                token = ("close" if m[1] else "open", m[2].lower(), page[m.end() : max(close, m.end())])
            else:
                end = None
            if end is None:
                continue
            if start > begin:
                yield "text", page[begin:start], ""
            begin = at = end
            if token:
                yield token
                if token[0] == "open" and token[1] in RAW:
                    stop = re.compile(rf"</{re.escape(token[1])}(?=[\s/>])", re.I).search(page, at)
                    begin = at = stop.start() if stop else size
        if begin < size:
            yield "text", page[begin:], ""


@dataclass(slots=True)
class Element:
    """A block element: its parent's number, name, whether it stands in an article, how it may be
    set aside, its path and the path that its text is counted for."""

    parent: int
    name: str
    inside: bool
    way: int
    path: int
    counted: int


@dataclass(slots=True)
class Block:
    """A block of text in page order, its element's number and its linked characters."""

    element: int
    text: str
    linked: int


@dataclass(slots=True)
class Frame:
    """An open block element with the inline elements that are open in it, by name."""

    element: int
    aside: bool
    link: bool
    inline: dict[str, list[bool]] = field(default_factory=lambda: defaultdict(list))
    hidden: int = 0

    @property
    def ignored(self) -> bool:
        return self.aside or self.hidden > 0

    @property
    def linked(self) -> bool:
        return self.link or bool(self.inline.get("a"))


def read(page: str) -> tuple[list[Element], list[Block]]:
    """The block elements, of which number 0 is the page itself, and the blocks of text."""
    elements, found = [Element(0, "", False, KEPT, 0, 0)], []
    paths: dict[tuple[int, str], int] = {}
    stack, opened = [Frame(0, False, False)], Counter()
    buffer: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(buffer).split())
        if text:
            found.append(Block(stack[-1].element, text, min(linked, len(text))))
        buffer.clear()
        linked = 0

    def close(names: set[str], boundary: set[str]) -> None:
        """Close the innermost open element of ``names`` unless one of ``boundary`` is within it."""
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            name = elements[stack[i].element].name
            if name in names:
                for frame in stack[i:]:
                    opened[elements[frame.element].name] -= 1
                del stack[i:]
                return
            if name in boundary:
                return

    for kind, name, rest in Scanner(page).tokens():
        top = stack[-1]
        if kind in ("text", "plain"):
            if not top.ignored:
                buffer.append(entities.unescape(name) if kind == "text" else name)
                if top.linked:
                    linked += len(" ".join(buffer[-1].split()))
            continue
        if name == "br":
            if not top.ignored:
                buffer.append(" ")
            continue
        if name in INLINE:
            if kind == "close":
                if top.inline.get(name):
                    top.hidden -= top.inline[name].pop()
            elif name not in VOID:
                inside = elements[top.element].inside
                aside = not top.ignored and _set_aside(name, rest, inside) == ALWAYS
                top.inline[name].append(aside)
                top.hidden += aside
            continue
        flush()
        if kind == "close":
            close({name}, set())
            continue
        if name in CLOSES_P:
            close({"p"}, {"article", "div", "section", "td", "th", "li", "body", "main", "button"})
        if name in ENDS_OWN:
            close(ENDS_OWN[name], BOUNDARY.get(name, {"table"}))
        if name in VOID or name in RAW or rest.endswith("/") and name in ("svg", "path"):
            continue
        if name == "body":
            del stack[2 if len(stack) > 1 and elements[stack[1].element].name == "html" else 1 :]
            opened = Counter(elements[frame.element].name for frame in stack[1:])
        top = stack[-1]
        parent, aside = elements[top.element], top.ignored and name != "body"
        inside = parent.inside or name in CONTAINERS
        way = KEPT if aside else _set_aside(name, rest, inside)
        path = paths.setdefault((parent.path, name), len(paths) + 1)
        counted = path if name in CONTAINERS or not parent.inside else parent.counted
        elements.append(Element(top.element, name, inside, way, path, counted))
        opened[name] += 1
        stack.append(Frame(len(elements) - 1, aside or way == ALWAYS, top.linked))
    flush()
    return elements, found


def summed(elements: list[Element], values: list[int]) -> list[int]:
    """For each element what ``values`` tells of it and of all elements within it."""
    out = list(values)
    for e in range(len(elements) - 1, 0, -1):
        out[elements[e].parent] += out[e]
    return out


def _smooth(values: list[float], reach: int = 2) -> list[float]:
    """Gaussian means along the page."""
    weight = [math.exp(-(d * d) / 2) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        near = [(weight[abs(d)], values[i + d]) for d in range(-reach, reach + 1) if 0 <= i + d < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def own_text(elements: list[Element], found: list[Block]) -> list[Block]:
    """The blocks without readers' comments: what follows a heading that announces them, within
    the element that holds the heading."""
    ends: dict[int, int] = {}
    for i, b in enumerate(found):
        if len(b.text) < 40 and elements[b.element].name in HEADINGS and _READERS.fullmatch(b.text):
            ends.setdefault(elements[b.element].parent, i)
    if not ends:
        return found
    # The earliest such heading of an element or of any around it.
    first = [len(found)] * len(elements)
    for e, element in enumerate(elements):
        first[e] = min(first[element.parent] if e else len(found), ends.get(e, len(found)))
    return [b for i, b in enumerate(found) if i < first[b.element]] or found


def undoubted(elements: list[Element], found: list[Block]) -> list[Block]:
    """The blocks without those of elements that their names, or a form, set aside.

    An element that holds most of the prose (paragraphs and sentences; of the declared articles if
    there are any, and outside of what is surely something else) is no such element.  Only where
    what is left holds next to no sentences, plain names such as "overlay" are judged by their
    share as well.
    """
    # The worst way of an element or of any around it: least number but 0.
    worst = [KEPT] * len(elements)
    for e, element in enumerate(elements):
        ways = [w for w in (worst[element.parent], element.way) if w > ALWAYS]
        worst[e] = min(ways, default=KEPT)
    if not any(worst[b.element] for b in found):
        return found
    sentence = {id(b): bool(_PUNCTUATION.search(b.text)) for b in found}
    prose = {
        id(b): len(b.text) if elements[b.element].name in ("p", "pre", "blockquote") or sentence[id(b)] else 0
        for b in found
    }
    if not any(prose.values()):
        prose = {id(b): len(b.text) for b in found}

    def judged(sure: list[Block]) -> list[Block]:
        for base in ([b for b in sure if elements[b.element].inside], sure):
            total = sum(prose[id(b)] for b in base)
            if total:
                break
        held = [0] * len(elements)
        for b in base:
            held[b.element] += prose[id(b)]
        held = summed(elements, held)
        fit = [True] * len(elements)
        for e, element in enumerate(elements):
            fit[e] = fit[element.parent] and (element.way <= ALWAYS or 2 * held[e] > total)
        return [b for b in found if fit[b.element]]

    kept = judged([b for b in found if worst[b.element] in (KEPT, WEAK)])
    own = [b for b in found if worst[b.element] != STRONG]
    told = [len(b.text) for b in kept if sentence[id(b)]]
    if len(told) < 2 and sum(told) < 200 and 5 * sum(prose[id(b)] for b in kept) < sum(prose[id(b)] for b in own):
        kept = judged(own)
    return kept if any(prose[id(b)] for b in kept) else judged(found)


def completed(elements: list[Element], found: list[Block], chosen: list[bool]) -> list[bool]:
    """``chosen`` with the other blocks of the chosen ones' container.

    The container is the innermost element with nearly all of the chosen text, widened as long as
    what is added isn't mostly links.  Chosen blocks outside of it bring the rest of their own
    element.  Where only the body or the page contains them, what stands between chosen blocks is
    added, and lists, tables and code that aren't mostly links.
    """
    taken, other, links = ([0] * len(elements) for _ in range(3))
    for b, mine in zip(found, chosen, strict=True):
        (taken if mine else other)[b.element] += len(b.text)
        links[b.element] += 0 if mine else b.linked
    taken, other, links = (summed(elements, x) for x in (taken, other, links))
    inner = max(e for e in range(len(elements)) if 10 * taken[e] >= 9 * taken[0])
    while inner and elements[inner].name not in ("html", "body"):
        parent = elements[inner].parent
        if 2 * (links[parent] - links[inner]) > other[parent] - other[inner]:
            break
        inner = parent
    over, at = {0}, inner
    while at:
        over.add(at)
        at = elements[at].parent
    whole = inner != 0 and elements[inner].name not in ("html", "body")
    # The innermost element around that also holds chosen text, the next one below it on the way,
    # whether a list, table or code lies on the way, and whether the container is around.
    near, below, group, within = [0] * len(elements), [0] * len(elements), [False] * len(elements), [False] * len(elements)
    for e in range(len(elements)):
        parent = elements[e].parent
        within[e] = e == inner or (e > 0 and within[parent])
        if taken[e] or e == 0:
            near[e] = e
        else:
            near[e], below[e] = near[parent], below[parent] or e
            group[e] = group[parent] or elements[e].name in GROUPS
    first, last = chosen.index(True), len(chosen) - 1 - chosen[::-1].index(True)

    def kept(i: int, b: Block) -> bool:
        e = b.element
        if whole and within[e]:
            return True
        plain = 2 * links[below[e]] <= other[below[e]] if below[e] else 2 * b.linked <= len(b.text)
        if near[e] not in over:
            return plain
        if whole:
            return False
        return first < i < last or plain and group[e]

    return [mine or kept(i, b) for i, (b, mine) in enumerate(zip(found, chosen, strict=True))]


def main_blocks(page: str, threshold: float = 0.1, undeclared: float = 0.05) -> list[str]:
    """The article's blocks: those of paths whose fused ratio reaches ``threshold`` of the best.

    A path ends at the innermost declared article, so a short heading shares the ratio of the
    paragraphs below it.  Where a page declares one, the ratios of all other paths are weighed
    with ``undeclared``: they have to be far denser to count as article.
    """
    elements, found = read(page)
    found = undoubted(elements, own_text(elements, found))
    inside = [elements[b.element].inside for b in found]
    articles = any(inside)
    paths = [elements[b.element].counted for b in found]
    sums: dict[int, list[int]] = {}
    for path, b in zip(paths, found, strict=True):
        s = sums.setdefault(path, [0, 0, 0])
        s[0] += len(b.text)
        s[1] += len(_PUNCTUATION.findall(b.text))
        s[2] += 1
    if not sums:
        return []
    length = _smooth([sums[p][0] / sums[p][2] for p in paths])
    points = _smooth([sums[p][1] / sums[p][2] for p in paths])
    score = dict.fromkeys(sums, 0.0)
    for path, declared, a, b in zip(paths, inside, length, points, strict=True):
        weight = 1.0 if declared or not articles else undeclared
        score[path] += weight * a * (1 + math.log1p(b)) / sums[path][2]
    least = threshold * max(score.values())
    chosen = [score[path] >= least for path in paths]
    if not articles:
        chosen = completed(elements, found, chosen)
    return [b.text for b, keep in zip(found, chosen, strict=True) if keep]


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    The text is the blocks of the article in page order, one to a line, white space inside a
    block as one space; empty for a null html or a page without any text.
    """
    def work(batches):
        for batch in batches:
            for page, url, page_html in zip(batch.column(0), batch.column(1), texts(batch, "html"), strict=True):
                text = "\n".join(main_blocks(page_html))
                yield {"page_id": page.as_py(), "url": url.as_py(), "text": text, "n_chars": len(text)}

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return map_batches(rows, work, "page_id long, url string, text string, n_chars long", rows=200)
