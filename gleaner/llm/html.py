"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import large_batches

# Frequent function words of the languages that the rules know.
STOP_WORDS = frozenset(
    """
    a an and are as at be but by can for from had has have he her his i in is it its not of on or she that the
    their there they this to was we were which will with you
    aber als am auf auch aus bei das dem den der des die durch ein eine einem einen einer er es für hat ich im
    in ist mit nach nicht noch oder sie sich sind so über um und von vor war wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou
    par pas plus pour qu que qui sa se ses son sont sur un une vous
    al como con de del el ella en entre es esta este fue ha hay la las lo los más me mi muy no o para pero por
    que se sin sobre son su sus un una y ya
    """.split()
)
# Elements that are never text, that stand outside the article, and that end a block.
# Those of NESTED may hold one of their own name, those of VERBATIM hold no tags.
RAW = frozenset("noscript template title textarea iframe object svg math canvas select button audio video".split())
NESTED = frozenset("noscript template object svg math".split())
VERBATIM = frozenset("title textarea iframe".split())
OUTSIDE = frozenset("nav footer aside form menu dialog head header".split())
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul
    """.split()
)
CONTAINERS = BLOCKS - frozenset("p hr h1 h2 h3 h4 h5 h6 html body".split())
# Words of class, id and role attributes that mark what is not the article.
MARKS = frozenset(
    """
    ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies
    copyright disqus footer masthead menu modal nav navbar navigation newsletter notice notices pager
    pagination popup promo promotion related replies share sharing sidebar social sponsor sponsored subscribe
    toolbar widget
    """.split()
)

LONG_WORDS = 25
SHORT_WORDS = 8
STOP_SHARE = 0.15
LINK_SHARE = 0.4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>[^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>"""
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Block:
    """``place``: -2 never text, -1 likely not the article by an element or mark, 1 inside an article, 0 unknown.

    ``origin`` is the number of the nearest marked container, or -1.
    """

    text: str
    link_chars: int
    place: int
    origin: int = -1
    heading: bool = False


def _marked(attrs: str) -> bool:
    for match in _MARKED.finditer(attrs):
        value = match[1] or match[2] or match[3] or ""
        if any(part.lower() in MARKS for part in _PARTS.findall(value)):
            return True
    return False


def _after_raw(page: str, at: int, name: str, enclosing: set[str], last_ends: dict[str, int]) -> int:
    """Where a raw element ends whose start tag ends at ``at``.

    That is behind its end tag. An element that is not closed before another of its name (if they do
    not nest) or before an element around it ends at the next start or end of a block.
    """
    if name not in last_ends:
        last_ends[name] = max((m.start() for m in re.finditer(rf"</{name}\s*>", page, re.I)), default=-1)
    closable = last_ends[name] >= at
    if closable and name in VERBATIM:
        found = re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I).search(page, at)
        if found and found[1]:
            return found.end()
        closable = False
    boundary, depth, inside = None, 1, dict.fromkeys(enclosing, 0)
    while token := _TOKEN.search(page, at):
        at = token.end()
        if token["name"] is None:
            continue
        other, ending = token["name"].lower(), token["end"] == "/"
        if other in BLOCKS and boundary is None:
            boundary = token.start()
        if boundary is not None and not closable:
            return boundary
        if other == name:
            if ending:
                depth -= 1
                if not depth:
                    return at
            elif name not in NESTED:
                closable = False
                if boundary is None:
                    return token.start()
                return boundary
            elif not (token["attrs"] or "").endswith("/"):
                depth += 1
        elif other in inside:
            inside[other] += -1 if ending else 1
            if inside[other] < 0:
                return boundary
    return len(page) if boundary is None else boundary


def page_blocks(page: str) -> list[Block]:
    """Cut a page into blocks of text, in page order."""
    blocks: list[Block] = []
    pieces: list[str] = []
    links: list[str] = []
    stack: list[tuple[str, int, int]] = []
    in_link, origins = False, 0

    def close() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                linked = len(" ".join(html.unescape("".join(links)).split()))
                _, place, origin = stack[-1] if stack else ("", 0, -1)
                heading = line is not None and line[0] == "h" and line != "hr"
                blocks.append(Block(text, linked, place, origin, heading))
            pieces.clear()
            links.clear()

    at, line, last_ends = 0, None, {}
    while token := _TOKEN.search(page, at):
        if token.start() > at:
            pieces.append(page[at : token.start()])
            if in_link:
                links.append(pieces[-1])
        at = token.end()
        name = token["name"]
        if name is None:
            if token["raw"]:
                pieces.append(" ")
            continue
        name, ending = name.lower(), token["end"] == "/"
        if name in RAW:
            pieces.append(" ")
            closed = name in ("svg", "math") and (token["attrs"] or "").endswith("/")
            if not ending and not closed:
                enclosing = {n for n, _, _ in stack} | ({line} if line else set())
                at = _after_raw(page, at, name, enclosing, last_ends)
            continue
        if name == "a":
            in_link = not ending
        elif name == "br":
            pieces.append(" ")
        if name not in BLOCKS:
            continue
        close()
        line = None if ending or name in CONTAINERS else name
        if ending:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        in_link = False
        if name not in CONTAINERS:
            continue
        _, place, origin = stack[-1] if stack else ("", 0, -1)
        attrs = token["attrs"] or ""
        body = name in ("article", "main")
        if body:
            # A menu that is never closed ends where the article begins.
            if place < 0 and all(n in OUTSIDE or p >= 0 for n, p, _ in stack):
                stack.clear()
                place, origin = 0, -1
            # A mark around an article does not decide: there it is judged by its blocks.
            if place == -1 and not any(n in OUTSIDE for n, _, _ in stack):
                place, origin = 0, -1
            elif place >= 0:
                place = 1
        if name == "head" or _HIDDEN.search(attrs):
            place = -2
        elif place > -2 and name in OUTSIDE and not (name == "header" and place > 0):
            place, origin = -1, -1
            if name == "form":
                origins += 1
                origin = origins
        elif place > -2 and not body and _marked(attrs):
            origins += 1
            place, origin = -1, origins
        stack.append((name, place, origin))
    pieces.append(page[at:])
    close()
    return blocks


def block_labels(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text.

    First pass: long blocks with function words and few links are, unless they stand under a mark and the
    page has at least as much such text without one; blocks full of links are not. Of the rest, what stands in a menu, footer, advert or the like is not, unless a
    long block shows that the mark is one of a wrapper; what stands in an article is, unless it has
    many links and few function words; elsewhere, blocks without function words are not. Short blocks
    stay open, as do headings in an article that are links. Second pass: an open block takes the
    label of the nearest decided block, the following one if two are as near; with none, it is text.
    """
    facts = []
    for block in blocks:
        words = block.text.split()
        links = block.link_chars / max(1, len(block.text))
        known = sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) / max(1, len(words))
        prose = len(words) >= LONG_WORDS and known >= STOP_SHARE and links <= LINK_SHARE / 2
        facts.append((len(words), links, known, prose))
    # Prose under a mark is the article only where there is more of it than of prose without a mark.
    unmarked, marked = 0, {}
    for block, (*_, prose) in zip(blocks, facts, strict=True):
        if prose and block.place == -1:
            marked[block.origin] = marked.get(block.origin, 0) + len(block.text)
        elif prose and block.place >= 0:
            unmarked += len(block.text)
    wrappers = {origin for origin, size in marked.items() if size > unmarked}
    first: list[bool | None] = []
    for block, (n, links, known, prose) in zip(blocks, facts, strict=True):
        freed = block.place == -1 and block.origin in wrappers
        place = 0 if freed and block.origin >= 0 else block.place
        if place == -2:
            first.append(False)
        elif prose and (place >= 0 or freed):
            first.append(True)
        elif place == -1:
            first.append(False)
        elif links > LINK_SHARE:
            first.append(None if place == 1 and block.heading else False)
        elif place == 1:
            first.append(n < SHORT_WORDS or links <= LINK_SHARE / 2 or known >= STOP_SHARE)
        elif n < SHORT_WORDS:
            first.append(None)
        elif known >= STOP_SHARE:
            first.append(True if n >= LONG_WORDS else None)
        else:
            first.append(False if n < LONG_WORDS else None)
    decided = np.array([k for k, label in enumerate(first) if label is not None], np.int64)
    if not len(decided):
        return [True] * len(blocks)
    out = []
    for k, label in enumerate(first):
        if label is None:
            right = int(np.searchsorted(decided, k))
            before = k - decided[right - 1] if right else len(blocks)
            after = decided[right] - k if right < len(decided) else len(blocks)
            label = first[decided[right - 1] if before < after else decided[right]]
        out.append(bool(label))
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, one line per block; empty if there is none."""
    if not page:
        return ""
    blocks = page_blocks(page)
    return "\n".join(b.text for b, keep in zip(blocks, block_labels(blocks), strict=True) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Null or empty html gives the empty text. Rows with the same id stay separate rows; other columns
    are not read. A page is worked on by itself, so there is no shuffle.
    """

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in large_batches(batches):
            texts = [main_text(page.as_py()) for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    given = pages.select("page_id", "url", F.col("html"))
    schema = given.select("page_id", "url", F.lit("").alias("text")).schema
    return given.mapInArrow(extract, schema).withColumn("n_chars", F.length("text").cast("bigint"))
