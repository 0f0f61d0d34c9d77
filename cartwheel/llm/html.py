"""Main text of web pages by two passes of block rules.

A page is cut into blocks of text at block elements. The first pass looks at each block alone: what stands
in navigation, page furniture or forms is boilerplate, so is a block of links; long blocks with
stop words are content; the rest, mostly short, stays open. The second pass gives every open block
the label of its nearest decided neighbour, blocks of its own section before others.

Stop words are known for four languages. A block that none of the lists fits, in another language or of terse prose, is judged by
its length and its sentences instead. A page without any good block keeps its open blocks of running text or
code and, if there are none, all of them: what is not furniture is never lost altogether.

Class and id names, and forms, also stand around whole pages (a layout "has-sidebar"). Whether such a mark counts is
decided for the page: not around its main element or only article, nor around most of its good text.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.llm.common import sliced, table

LONG = 200              # characters: a block of this length is decided by its stop words alone
SHORT = 70
STOP_DENSITY = 0.10     # share of stop words that makes a long block content
STOP_HIGH = 0.30        # .. and a block of middle length
LINK_DENSITY = 0.33     # share of a block's characters inside links that makes it boilerplate
STOP_NONE = 0.05        # share of stop words under which no list fits the block
WIDE = 3                # a character of a script without spaces counts as so many

# Common function words of the supported languages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which with you",
    "de": "als am an auch auf aus bei das dass dem den der des die ein eine er es für im in ist ich mit nach nicht oder sich sie sind und von war wie zu zum",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que qui sa se son sur un une vous",
    "es": "a al como con de del el ella en es esta este fue ha la las lo los más me no o para pero por que se sin su sus un una y ya",
}
_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())

# Elements that end a block of text.
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre "
                  "section summary table tbody td tfoot th thead title tr ul".split())
# Elements whose text is never page text, skipped as they stand.
RAW = "script|style|textarea|template|noscript|iframe|svg|math|title|noframes|xmp"
# Elements that hold page furniture, and those that mark content.
FURNITURE = frozenset("nav header footer aside form menu dialog button select fieldset".split())
CONTENT = frozenset(("article", "main"))
AROUND = frozenset(("form", "fieldset"))     # furniture that may also stand around a whole page
SECTIONS = frozenset("article aside body details dialog div dl fieldset footer form header main menu nav ol section table td ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# Parts of class and id names that mark furniture.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb "
                  "breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
                  "subscription signup login share sharing social related recommended comment comments reply replies respond disqus widget "
                  "pagination pager search toolbar copyright disclaimer".split())
_OWN = frozenset("article post entry story".split())
_TALK = frozenset("comment comments reply replies respond disqus".split())

_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^>]*\Z", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
_LETTERS = re.compile(r"[^\W\d_]+")
# Ends of sentences: marks that a space or the end follows, and those of scripts without spaces or with marks of their own.
_SENTENCE = re.compile(r"[.!?…](?=[\s\"'»”’)\]]|\Z)|[。！？｡।؟۔។။]")
_WIDE = re.compile(r"[\u0E00-\u0EFF\u1780-\u17FF\u3040-\u30FF\u3400-\u9FFF\uF900-\uFAFF]")


def attributes(source: str) -> dict[str, str]:
    """Attribute values by lower-case name, references decoded; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, attributes), ("close", name, "") and ("raw", name, whole) in page order. Names are
    in lower case, texts as they stand. Comments, declarations and an unfinished tag at the end are left out."""
    last = 0
    for m in _TOKEN.finditer(html):
        if m.start() > last:
            yield "text", html[last:m.start()], ""
        last = m.end()
        if m.group(1):
            yield "raw", m.group(1).lower(), m.group()
        elif m.group(3):
            yield ("close" if m.group(2) else "open"), m.group(3).lower(), m.group(4)
    if last < len(html):
        yield "text", html[last:], ""


@dataclass(eq=False)
class Mark:
    """An element that a name or a form marks as furniture; the first of a page is the page, which nothing marks."""
    parent: "Mark | None"
    talk: bool = False      # readers' comments
    mains: int = 0          # elements inside
    articles: int = 0
    good: int = 0           # characters inside of blocks that are good but for marks
    live: int = 0           # .. good or open
    own_good: int = 0       # .. good, in no mark further inside
    own_content: int = 0    # .. good or open, in an article or main element, in no mark further inside
    ignored: bool = False


@dataclass
class Block:
    text: str
    links: int              # characters inside links
    section: int            # number of the innermost section element
    furniture: bool
    content: bool           # inside an article or main element
    heading: bool
    mark: Mark
    code: bool = False      # inside a pre element
    label: str = ""


def _furniture(name: str, source: str) -> str:
    """always, name or talk (marks that may stand around the text of a page), or nothing."""
    if name in FURNITURE and name not in AROUND:
        return "always"
    around = "name" if name in AROUND else ""
    if not source or name in ("body", "html", "article", "main"):
        return around
    own = attributes(source)
    role = own.get("role", "").lower()
    if role in ROLES and role != "form" or "hidden" in own or own.get("aria-hidden", "").lower() == "true":
        return "always"
    parts = {p.lower() for p in _PART.findall(own.get("class", "") + " " + own.get("id", ""))}
    if parts & MARKS and not parts & _OWN or "comments" in parts or "comment" in parts:
        return "talk" if parts & _TALK else "name"
    return "name" if role == "form" else around


def blocks(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    return _scan(html)[0]


def _scan(html: str) -> tuple[list[Block], list[Mark]]:
    """The blocks of a page, and its marks, outer ones first."""
    out: list[Block] = []
    marks = [Mark(None, ignored=True)]
    stack: list[tuple[str, int, bool, bool, Mark]] = [("", 0, False, False, marks[0])]   # name, section, furniture, content, mark
    text: list[str] = []
    links = link = sections = code = 0
    heading = False

    def end() -> None:
        nonlocal links
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                _, section, furniture, content, mark = stack[-1]
                out.append(Block(joined, min(links, len(joined)), section, furniture, content, heading, mark, code > 0))
            text.clear()
        links = 0

    def marked(kind: str, furniture: bool, mark: Mark) -> tuple[bool, Mark]:
        if kind in ("name", "talk") and not furniture:
            mark = Mark(mark, kind == "talk")
            marks.append(mark)
        return furniture or kind == "always", mark

    for kind, name, source in tokens(html):
        if kind == "text":
            text.append(name)
            if link:
                links += len(" ".join(unescape(name).split()))
        elif kind == "raw":
            end()
        elif name == "a":
            link = int(kind == "open")
        elif name in BLOCK or name in FURNITURE:
            end()
            if name == "pre":
                code = max(0, code + (1 if kind == "open" else -1))
            heading = name[0] == "h" and name[1:].isdigit() and kind == "open"
            if kind == "open":
                if name in VOID or name == "p" or name in ("li", "dt", "dd", "tr"):
                    link = 0 if name != "br" else link
                    if name not in VOID and (found := _furniture(name, source)):
                        while stack[-1][0] == name:     # these end at the next of their kind
                            stack.pop()
                        _, section, furniture, content, mark = stack[-1]
                        furniture, mark = marked(found, furniture, mark)
                        stack.append((name, section, furniture, content, mark))
                    elif stack[-1][0] == name:
                        stack.pop()
                else:
                    _, section, furniture, content, mark = stack[-1]
                    if name in SECTIONS:
                        sections += 1
                        section = sections
                    furniture, mark = marked(_furniture(name, source), furniture, mark)
                    if name in CONTENT and not furniture:
                        mark.mains += name == "main"
                        mark.articles += name == "article"
                    stack.append((name, section, furniture, content or name in CONTENT, mark))
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        del stack[k:]
                        break
    end()
    return out, marks


def ignore_marks(page: list[Block], marks: list[Mark]) -> None:
    """Decide which marks of a page do not count, from the labels that its blocks have without them.

    Not counted are marks around a main element or the only article; where no article or main element has text outside of marks,
    also those around most of the good text and most of all text that may be good. Comments are no page text because
    they are long: their names are not counted only around nearly everything, where no good text is left otherwise."""
    for b in page:
        if b.label != "bad":
            good = len(b.text) * (b.label == "good")
            b.mark.good += good
            b.mark.own_good += good
            b.mark.live += len(b.text)
            b.mark.own_content += len(b.text) * b.content
    for m in reversed(marks[1:]):
        m.parent.mains += m.mains
        m.parent.articles += m.articles
        m.parent.good += m.good
        m.parent.live += m.live
    whole = marks[0]

    def outside() -> tuple[int, int]:
        return sum(m.own_good for m in marks if m.ignored), sum(m.own_content for m in marks if m.ignored)

    for m in marks[1:]:
        m.ignored = m.parent.ignored and (m.mains > 0 or not m.talk and whole.articles == m.articles == 1)
    _, content = outside()
    for m in marks[1:]:
        if m.parent.ignored and not m.ignored and not m.talk and not content and 2 * m.good > whole.good and 2 * m.live > whole.live:
            m.ignored = True
            content += m.own_content
    good, content = outside()
    for m in marks[1:]:
        if m.parent.ignored and not m.ignored and not good and not content and m.good and 10 * m.live > 9 * whole.live:
            m.ignored = True
            good, content = m.own_good, m.own_content


def first_pass(block: Block) -> str:
    """good, bad or open, from the block alone."""
    n = len(block.text)
    if block.furniture or block.links > LINK_DENSITY * n:
        return "bad"
    if block.text[0] == "©" and n < LONG:
        return "bad"
    words = _LETTERS.findall(block.text.lower())
    density = sum(w in _STOP for w in words) / len(words) if words else 0.0
    if n >= LONG and density >= STOP_DENSITY or n >= SHORT and density >= STOP_HIGH:
        return "good"
    if density < STOP_NONE and _extent(block.text) >= LONG and len(_SENTENCE.findall(block.text)) >= 2:
        return "good"
    return "open"


def _extent(text: str) -> int:
    """Length in characters of a script with spaces."""
    return len(text) + (WIDE - 1) * len(_WIDE.findall(text))


def second_pass(page: list[Block]) -> None:
    """Open blocks take the label of the nearest decided block of their section; without one, good in
    an article or main element; else that of the nearest decided block at all, the ends of the page
    counting as boilerplate. Where both sides are as near, one good side is enough in the own section, else both have to be
    good. A page without any good block keeps the open blocks in an article or main element, with stop words, with the end of
    a sentence, of some length or of code, and those of the same sections; with none of these, all open blocks."""
    decided = [b.label for b in page]
    if "good" not in decided:
        still = [b for b in page if b.label == "open"]
        kept = {id(b) for b in still if b.content or b.code or any(w in _STOP for w in _LETTERS.findall(b.text.lower())) or _SENTENCE.search(b.text)
                or _extent(b.text) >= SHORT}
        sections = {b.section for b in still if id(b) in kept}      # headings and short lines beside what is kept stay too
        for b in still:
            b.label = "good" if b.section in sections or not kept else "bad"
        return
    by_section: dict[int, list[int]] = {}
    for i, label in enumerate(decided):
        if label != "open":
            by_section.setdefault(page[i].section, []).append(i)
    every = [-1, *(i for i, label in enumerate(decided) if label != "open"), len(page)]
    decided += ["bad", "bad"]       # the ends: at len(page) and, counted from the end, at -1
    for i, b in enumerate(page):
        if b.label != "open":
            continue
        own = by_section.get(b.section)
        if own:
            b.label = _nearest(own, i, decided, both=False)
        elif b.content:
            b.label = "good"
        else:
            b.label = _nearest(every, i, decided, both=True)


def _nearest(places: list[int], i: int, labels: list[str], both: bool) -> str:
    k = bisect(places, i)
    near = [p for p in places[max(0, k - 1):k + 1]]
    best = min(abs(p - i) for p in near)
    found = {labels[p] for p in near if abs(p - i) == best}
    if len(found) == 1:
        return found.pop()
    return "bad" if both else "good"


def main_text(html: str | None) -> str:
    """The text of the content blocks, one space between blocks and between words."""
    if not html:
        return ""
    page, marks = _scan(html)
    for b in page:
        b.label = first_pass(b)
    ignore_marks(page, marks)
    for b in page:
        if not b.mark.ignored:
            b.label = "bad"
    second_pass(page)
    return " ".join(b.text for b in page if b.label == "good")


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``main_text`` to each page, from the whole html.

    Null and empty pages, and pages without text, give the empty string. Broken markup is read as far as it goes: an unclosed
    element reaches to the end of its parent, an unfinished tag at the end is dropped, unfinished
    character references stay as they are. Repeated rows give equal texts; no rows give no rows.
    Other columns stay; a column named main_text is refused."""
    if "main_text" in {c.lower() for c in pages.columns}:
        raise ValueError("column main_text exists already")

    def run(batches):
        for batch in sliced(batches, html):
            texts = pa.array([main_text(h) for h in batch.column(html).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "main_text"])

    return pages.mapInArrow(run, T.StructType(pages.schema.fields + [T.StructField("main_text", T.StringType())]))


def op4_html_extraction(spark, sf_dir):
    """Main text of all pages."""
    out = extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
