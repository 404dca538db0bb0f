"""Main text of HTML pages by two passes of block rules.

The page is cut into blocks at block-level tags. Navigation, headers, footers,
sidebars, notices, adverts, forms, comments of readers, scripts and styles are
known by element, role and class name. Every other block is classified first
by its length, the share of its characters in links, and the density of stop
words: good, bad, or undecided (short). In the second pass, undecided blocks
take the label of the nearest decided blocks of their container.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick

# Thresholds of the first pass.
MOST_LINKS, MOST_LINKS_INSIDE = 0.5, 0.8
LEAST_STOP = 0.15
LEAST_STOP_ALONE = 0.25
SHORT_CHARS, LONG_CHARS = 70, 200

# Common words of the languages served.
STOP_WORDS = frozenset(
    """
    the of and to in a is that it for as with was on are be by this at from or an have not had his her their which
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach bei
    le la les de des du un une et en à que qui dans pour pas au sur est par il elle ne se ce avec plus sont
    el los las de y en un una que del se por con no para su al lo como más o es ha
    """.split()
)

# Elements by their part in a page.
NEVER = frozenset("script style noscript template iframe object embed applet svg math canvas audio video map select textarea button datalist head title".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCK = frozenset(
    """
    address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot
    th thead tr ul
    """.split()
)
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same list item, row or paragraph kind.
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}

# Words in class and id names, and roles, of what is not the article.
CLASS_WORDS = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc
    header masthead footer foot colophon copyright
    sidebar aside widget widgets related recommended recommendations
    cookie cookies consent gdpr notice notices alert popup modal overlay
    comment comments disqus replies respond
    share sharing social newsletter subscribe subscription signup login search form
    """.split()
)
# Parts that say a name is about something else: no-sidebar, has-comments, alert-page.
DENIALS = frozenset("no not non without has have with hide".split())
WHOLES = frozenset("page layout site".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar toolbar alert alertdialog dialog".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>\x00]*)(?P<rest>(?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*?)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
RAW = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}
BLOCK_START = re.compile(rf"<(?:{'|'.join(sorted(BLOCK - {'option'}))})\b", re.IGNORECASE)
WORD = re.compile(r"\w+")
SENTENCE_END = re.compile(r"[.!?…](?=\s|$)")
SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("chars", "container", "heading", "linked", "marked", "outside", "text")

    def __init__(self, text: str, linked: int, outside: bool, container: int, heading: bool, marked: int = -1):
        self.text, self.linked, self.outside, self.container, self.heading, self.marked = text, linked, outside, container, heading, marked


def _dropped(tag: str, given: dict[str, str]) -> bool:
    """Whether the element is no part of an article by its name or role, or because it is hidden."""
    if tag in OUTSIDE or given.get("role", "").lower() in ROLES or "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.IGNORECASE))


def _marked(tag: str, given: dict[str, str]) -> bool:
    """Whether a class or id name says that the element is no part of an article.

    A name counts with one of its parts, unless another part denies it
    (``no-sidebar``, ``has-comments``) or it names the page (``alert-page``).
    """
    if tag in ("html", "body", *MAIN):
        return False
    for name in f"{given.get('class', '')} {given.get('id', '')}".split():
        parts = [w.lower() for w in NAME_PART.findall(name)]
        if not CLASS_WORDS.isdisjoint(parts) and DENIALS.isdisjoint(parts) and parts[-1] not in WHOLES:
            return True
    return False


class _Open:
    """Open elements: those that hold blocks and those that are no part of an article."""

    def __init__(self):
        # element, outside, container, innermost element marked by a class name
        self.stack: list[tuple[str, bool, int, int]] = []
        self.number: dict[str, int] = {}
        self.block_at: list[int] = []
        self.headings = 0

    def push(self, tag: str, outside: bool, container: int, marked: int) -> None:
        if tag in BLOCK:
            self.block_at.append(len(self.stack))
        self.headings += tag in HEADINGS
        self.number[tag] = self.number.get(tag, 0) + 1
        self.stack.append((tag, outside, container, marked))

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            self.number[tag] -= 1
            self.headings -= tag in HEADINGS
            if tag in BLOCK:
                self.block_at.pop()

    def close(self, tag: str) -> None:
        """Up to the last open one of the name; what is left out is open no longer, so all closing together is linear."""
        if self.number.get(tag):
            self.cut(next(i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag))

    def top(self) -> tuple[str, bool, int, int]:
        return self.stack[-1] if self.stack else ("", False, 0, -1)


def blocks(page: str) -> list[Block]:
    """Blocks of visible text in page order."""
    out: list[Block] = []
    held: list[tuple[str, bool]] = []
    opened = _Open()
    links, numbers = 0, 0
    over: list[int] = []  # of each element marked by a class name: the next one around it
    holds_main: set[int] = set()

    def flush() -> None:
        if held:
            text = SPACE.sub(" ", html.unescape("".join(t for t, _ in held))).strip()
            if text:
                linked = len(SPACE.sub(" ", html.unescape("".join(t for t, a in held if a))).strip())
                _, outside, container, marked = opened.top()
                out.append(Block(text, linked, outside, container, opened.headings > 0, marked))
            held.clear()

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            held.append((page[at:], links > 0))
            break
        if found.start() > at:
            held.append((page[at : found.start()], links > 0))
        at = max(found.end(), at + 1)
        if found["cdata"] is not None:
            held.append((html.escape(found["cdata"], quote=False), links > 0))
            continue
        if found["tag"] is None:
            continue
        tag = found["tag"].lower()
        if found["close"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "p" or tag in BLOCK or opened.number.get(tag):
                if tag in BLOCK or tag in OUTSIDE:
                    flush()
                opened.close(tag)
                if tag in BLOCK:
                    links = 0
            continue
        if tag in NEVER:
            if tag in RAW:
                end = RAW[tag].search(page, at)
                at = end.end() if end else _next_block(page, at) if tag == "textarea" else len(page)
            elif not found["rest"].endswith("/"):
                at = _skipped(page, at, tag)
            continue
        if tag in ("br", "img", "wbr"):
            held.append((" " if tag != "wbr" else "", links > 0))
            continue
        if tag in BLOCK:
            flush()
            links = 0
            if opened.block_at:
                last = opened.stack[opened.block_at[-1]][0]
                if last in SELF_CLOSING.get(tag, ()) or (last == "p" and tag != "p"):
                    opened.cut(opened.block_at[-1])
        if tag in VOID:
            continue
        if tag == "a":
            links += 1
            continue
        _, outside, container, marked = opened.top()
        rest = found["rest"]
        given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(rest)} if "=" in rest or "hidden" in rest.lower() else {}
        drops, marks = _dropped(tag, given), _marked(tag, given)
        if tag in BLOCK or drops or marks:
            if (drops and not outside) or marks:
                flush()
            if tag in MAIN and not outside:
                numbers += 1
                container = numbers
            if (tag in MAIN or tag == "h1") and marked >= 0:
                holds_main.add(marked)
            if marks:
                over.append(marked)
                marked = len(over) - 1
            opened.push(tag, outside or drops, container, marked)
    flush()
    _settle(out, over, holds_main)
    return out


def _settle(found: list[Block], over: list[int], holds_main: set[int]) -> None:
    """Blocks in elements marked by a class name are out, unless the element holds the page.

    It does if more than half of the text stands in it, and an article or main
    element or the page's first heading. Elements are numbered as they open,
    so one pass back adds up what they hold and one pass on decides.
    """
    if not over:
        return
    size, main = [0] * len(over), [i in holds_main for i in range(len(over))]
    total = 0
    for b in found:
        if not b.outside:
            total += len(b.text)
            if b.marked >= 0:
                size[b.marked] += len(b.text)
    for i in range(len(over) - 1, -1, -1):
        if over[i] >= 0:
            size[over[i]] += size[i]
            main[over[i]] |= main[i]
    out: list[bool] = []
    for i, around in enumerate(over):
        out.append((around >= 0 and out[around]) or not (main[i] and 2 * size[i] > total))
    for b in found:
        b.outside = b.outside or (b.marked >= 0 and out[b.marked])


def _next_block(page: str, at: int) -> int:
    found = BLOCK_START.search(page, at)
    return found.start() if found else len(page)


def _skipped(page: str, at: int, tag: str) -> int:
    """Position after the matching end tag, counting nested elements of the same name."""
    depth = 1
    for found in re.compile(rf"<(/?){tag}\b[^>]*>", re.IGNORECASE).finditer(page, at):
        depth += -1 if found[1] else 0 if found[0].endswith("/>") else 1
        if not depth:
            return found.end()
    # Never closed: it ends where the next block begins.
    return at if tag == "head" else _next_block(page, at)


def page_words(found: list[Block]) -> frozenset[str]:
    """Short words that come up again and again in the page's longer blocks: stop words of whatever language it is in."""
    held: dict[str, int] = {}
    for b in found:
        if not b.outside and len(b.text) >= LONG_CHARS and 4 * b.linked < len(b.text) and len(SENTENCE_END.findall(b.text)) > 1:
            for w in WORD.findall(b.text.lower()):
                if len(w) <= 4 and w.isalpha():
                    held[w] = held.get(w, 0) + 1
    return frozenset(w for w, n in held.items() if n >= 3)


def first_pass(block: Block, own_words: frozenset[str] = frozenset()) -> bool | None:
    """True: article; False: not; None: too short or too mixed to tell."""
    if block.outside:
        return False
    size = len(block.text)
    if block.linked / size > (MOST_LINKS_INSIDE if block.container else MOST_LINKS):
        return False if not block.heading else None
    words = WORD.findall(block.text.lower())
    stop = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if size < SHORT_CHARS:
        return None
    if stop >= LEAST_STOP or (size >= LONG_CHARS and block.container):
        return True
    if size >= LONG_CHARS and len(SENTENCE_END.findall(block.text)) > 1 and sum(w in STOP_WORDS or w in own_words for w in words) >= LEAST_STOP * len(words):
        return True
    return None if block.container or size < LONG_CHARS else False


def second_pass(page_blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Labels of all blocks: undecided ones follow the nearest decided blocks of the container.

    Blocks that are out by their element are no neighbours. Where both sides
    differ, the nearer one counts, the one before at equal distance. Without a
    decided neighbour, a block inside an article or main element belongs to
    it; elsewhere it needs some stop words, or a page without any article text.
    """
    out = list(labels)
    inside = [i for i, b in enumerate(page_blocks) if not b.outside]
    last: dict[int, int] = {}
    before: dict[int, int | None] = {}
    for place, i in enumerate(inside):
        before[i] = last.get(page_blocks[i].container)
        if labels[i] is not None:
            last[page_blocks[i].container] = place
    last.clear()
    for place in range(len(inside) - 1, -1, -1):
        i = inside[place]
        if labels[i] is None:
            left, right, own = before[i], last.get(page_blocks[i].container), page_blocks[i]
            if left is None and right is None:
                words = WORD.findall(own.text.lower())
                stop = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
                out[i] = bool(own.container) or (stop >= LEAST_STOP_ALONE and own.linked == 0) or (own.heading and own.linked == 0)
            elif own.container:
                out[i] = True
            elif left is None or (right is not None and right - place < place - left):
                out[i] = labels[inside[right]]
            else:
                out[i] = labels[inside[left]]
        else:
            last[page_blocks[i].container] = place
    return [bool(x) for x in out]


def _labels(found: list[Block]) -> list[bool]:
    own = page_words(found)
    kept = second_pass(found, [first_pass(b, own) for b in found])
    return kept if any(kept) else [not b.outside and 2 * b.linked <= len(b.text) for b in found]  # a page of short blocks alone


def main_text(page: str | None) -> str:
    """Article text of a page, blocks joined by an empty line; empty for null or a page without article.

    Article and main elements decide if they hold at least as much of it as
    the rest of the page. Else those with a link for a title or a line are
    cards beside the story and left out, and others count like all blocks.
    """
    found = blocks(page or "")
    kept = _labels(found)
    inside = sum(len(b.text) for k, b in zip(kept, found) if k and b.container)
    around = sum(len(b.text) for k, b in zip(kept, found) if k and not b.container)
    if inside >= around and inside:
        kept = [k and bool(b.container) for k, b in zip(kept, found)]
    elif inside:
        cards = {b.container for b in found if b.container and 2 * b.linked > len(b.text)}
        for b in found:
            b.outside, b.container = b.outside or b.container in cards, 0
        kept = _labels(found)
    return "\n\n".join(b.text for k, b in zip(kept, found) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points). Every row gets a row; null or empty pages have an empty text.

    The whole page is read, whatever its length; unclosed tags and comments
    end with the page, unclosed buttons and lists of choices with the next
    block. Where article and main elements hold at least half of the article
    text, blocks outside of such elements are left out.
    """
    rows = pick(pages, page_id=page_id, url=url, html=page)
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return mapped(rows, step, schema, "html")
