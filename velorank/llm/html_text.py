"""Main text of web pages by two passes over their blocks.

A page is cut into blocks at block-level elements.  The first pass decides a block
by itself: by link density, length and density of stop words, and by elements and
names that say what it is.  Blocks too short to tell, and those with few stop words,
stay ambiguous; in the second pass they inherit the label of the nearest decided
blocks around them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import small_batches, whole_text

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in a is that for it as was with be by on not he his at this are or from had have an they which one
    de la le les et des en un une du est que qui dans pour pas au sur se plus par avec il elle ce sont
    der die das und in den von zu mit sich auf für ist im nicht ein eine als auch es an werden aus er sie dem
    el los las y que por con no una su para del lo como más o pero sus al se
    """.split()
)
# Elements that start and end a block.
BLOCKS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup
    option p pre search section select summary table tbody td tfoot th thead tr ul
    """.split()
)
# Elements whose content is not text; raw ones hold no markup either.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN = frozenset("head template svg math object audio video canvas noscript datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr frame keygen basefont bgsound".split())
# Elements that hold no part of an article, and names (class, id, role) that say so.
ASIDE = frozenset("nav footer aside form button select menu dialog search fieldset".split())
NAMES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising adbox adsense banner breadcrumb breadcrumbs comment comments commentlist
    consent contentinfo cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal nav navbar navigation
    newsletter notice notices notification overlay pagination paywall popup promo promotion recommended related
    replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toc toolbar
    tooltip topbar widget widgets complementary banners dialog alert
    """.split()
)
# An article's own heading stands in these, a page's header outside of it.
HEADERS = frozenset(["header", "hgroup"])
_HEADER_NAMES = frozenset(["header", "masthead"])
MAIN = frozenset(["article", "main"])

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
_NAME = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDES = re.compile(r"""(?:^|[\s"'/])hidden(?=$|[\s=/])|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
# Elements whose end may be left out, those that a page's head holds, and beginnings of names that tell of a layout.
_IMPLIED = frozenset("p li dt dd option tr td th".split())
_IN_HEAD = frozenset("base basefont bgsound link meta script style title template noscript noframes".split())
_LAYOUT = frozenset("has no with without js".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")
_RIGHTS = re.compile(r"©|\(c\)|copyright", re.I)

GOOD, AMBIGUOUS, BAD = "good", "ambiguous", "bad"


@dataclass(frozen=True)
class Rules:
    """``link_density``: share of a block's characters in links above which it is no
    text.  ``short``: blocks of fewer characters are too short to tell.  ``stop_words``:
    least share of stop words in a long block of text; above ``few`` it is ambiguous.
    """

    link_density: float = 0.5
    short: int = 70
    stop_words: float = 0.2
    few: float = 0.08


@dataclass
class Block:
    text: str
    linked: int  # characters in links
    aside: bool  # its elements or their names say that it is no part of an article
    main: bool  # it stands in an article


def _marked_aside(name: str, rest: str, inside_main: bool) -> bool:
    """Whether an element, or a name it bears, is none of an article's."""
    if name in ASIDE or (name in HEADERS and not inside_main):
        return True
    if not rest or name in ("html", "body", "main"):
        return False
    for found in _NAME.finditer(rest):
        for value in (found[1] or found[2] or found[3] or "").split():
            # An article's names may tell of its layout or subject; only a whole one counts.
            parts = [value.lower()] if name == "article" else [p.lower() for p in _PART.findall(value)]
            if parts and parts[0] not in _LAYOUT:
                if not NAMES.isdisjoint(parts) or (not inside_main and not _HEADER_NAMES.isdisjoint(parts)):
                    return True
    return bool(_HIDES.search(rest))


class _Reader:
    """Cuts a page into blocks.

    ``stack`` holds the open elements that matter, each with what held before it:
    the element that set text aside (empty: none), whether an article and whether
    an element without text is open.
    """

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.linked: list[str] = []
        self.stack: list[tuple[str, str, bool, bool]] = []
        self.aside, self.main, self.hidden = "", False, False
        self.links = self.breaks = 0

    def close_block(self) -> None:
        if self.text:
            words = " ".join(html.unescape("".join(self.text)).split())
            if words:
                inside = " ".join(html.unescape("".join(self.linked)).split())
                self.blocks.append(Block(words, len(inside), bool(self.aside), self.main))
            self.text.clear()
            self.linked.clear()

    def piece(self, piece: str) -> None:
        if self.hidden:
            return
        if self.breaks and not piece.isspace():
            self.breaks = 0
        self.text.append(piece)
        if self.links:
            self.linked.append(piece)

    def leave(self, name: str) -> None:
        """Close the innermost open ``name`` and what is open in it."""
        if any(name == entry[0] for entry in self.stack):
            while True:
                open_name, self.aside, self.main, self.hidden = self.stack.pop()
                if open_name == name:
                    return

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.close_block()
        if name == "a":
            self.links = max(0, self.links - 1)
        self.leave(name)

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.close_block()
            elif not self.hidden:
                self.text.append(" ")
            return
        if self.stack and self.stack[-1][0] == "head" and name not in _IN_HEAD:
            self.leave("head")
        if name in BLOCKS:
            self.close_block()
            self.links = self.breaks = 0  # a link left open ends with its block
            if self.stack and self.stack[-1][0] in _IMPLIED and (self.stack[-1][0] == "p" or name in _IMPLIED):
                self.leave(self.stack[-1][0])
        if name == "a":
            self.links += 1
        elif name not in VOID and (name in BLOCKS or name in HIDDEN):
            marked = _marked_aside(name, rest, self.main or name in MAIN)
            if marked or name not in _IMPLIED:
                self.stack.append((name, self.aside, self.main, self.hidden))
                # None of these holds a page's article: one that seems to was left open.
                if name == "main" or (name == "article" and self.aside in ("nav", "header", "form")):
                    self.aside = ""
                self.hidden = self.hidden or name in HIDDEN
                self.main = self.main or name in MAIN
                self.aside = self.aside or (name if marked else "")


def page_blocks(page: str | None) -> list[Block]:
    """The non-empty blocks of a page in their order; comments, scripts and styles leave nothing."""
    page, reader, at = page or "", _Reader(), 0
    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token["name"]
        if name is None:
            if not token[0].startswith("<") or len(token[0]) == 1:
                reader.piece(token[0])
        elif token["end"]:
            reader.end(name.lower())
        else:
            name = name.lower()
            if name in RAW:
                closing = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                at = closing.start() if closing else len(page)
            else:
                reader.start(name, token["rest"])
    reader.close_block()
    return reader.blocks


def first_labels(blocks: list[Block], rules: Rules) -> list[str]:
    """Each block by itself.  Where a page has an article with text, what stands outside of it is decided."""
    inside = any(b.main and not b.aside for b in blocks)
    labels = []
    for b in blocks:
        if b.aside or (inside and not b.main) or b.linked > rules.link_density * len(b.text):
            labels.append(BAD)
        elif len(b.text) < rules.short:
            labels.append(BAD if not b.main and _RIGHTS.match(b.text) else AMBIGUOUS)
        else:
            words = _WORD.findall(b.text.lower())
            share = sum(w in STOP_WORDS for w in words) / max(1, len(words))
            # An article's author chose its blocks: one without stop words, say a table or code, is only ambiguous there.
            labels.append(GOOD if share >= rules.stop_words else AMBIGUOUS if share >= rules.few or b.main else BAD)
    return labels


def _reach(found: list[bool]) -> list[int]:
    """How many blocks away the nearest of ``found`` is."""
    n = len(found)
    reach = [2 * n] * n
    for order in (range(n), range(n - 1, -1, -1)):
        last = None
        for i in order:
            last = i if found[i] else last
            if last is not None:
                reach[i] = min(reach[i], abs(i - last))
    return reach


def second_labels(blocks: list[Block], labels: list[str]) -> list[bool]:
    """Whether each block is text: ambiguous ones go with the nearest decided block.

    Of an equally near good and bad block the good one decides, and with no decided
    block at all it is text.  An article's blocks are not decided by what is known to
    be none of it, wherever that stands.
    """
    good = _reach([label == GOOD for label in labels])
    bad = _reach([label == BAD for label in labels])
    own = _reach([label == BAD and b.main and not b.aside for b, label in zip(blocks, labels)])
    return [
        label == GOOD or (label == AMBIGUOUS and good[i] <= (own if b.main else bad)[i])
        for i, (b, label) in enumerate(zip(blocks, labels))
    ]


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The main text of a page, one line per block."""
    blocks = page_blocks(page)
    kept = second_labels(blocks, first_labels(blocks, rules))
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract_text(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), html_column: str = "html", rules: Rules = Rules()) -> DataFrame:
    """One row per page: the columns ``keep``, ``text`` and ``n_chars``, its code points.

    Null pages are empty, pages without main text have an empty text; nothing is cut
    or dropped, repeated rows give repeated results, other columns are ignored.  An
    empty table gives an empty result.
    """
    rows = pages.select(whole_text(html_column).alias("page"), *[F.col(c) for c in keep])

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [main_text(page.as_py(), rules) for page in batch.column(0)]
            columns = [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    schema = rows.select(*keep).schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(extracted, schema)


def page_block_labels(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", rules: Rules = Rules()) -> DataFrame:
    """One row per block: the page's id, ``block`` (from 0), ``first_label``, ``kept``, ``text``: why a page's text is what it is."""
    rows = pages.select(whole_text(html_column).alias("page"), F.col(id_column))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found: list[tuple[object, int, str, bool, str]] = []
            for page, key in zip(batch.column(0), batch.column(1)):
                blocks = page_blocks(page.as_py())
                labels = first_labels(blocks, rules)
                kept = second_labels(blocks, labels)
                found += [(key.as_py(), i, labels[i], kept[i], b.text) for i, b in enumerate(blocks)]
            kinds = [batch.schema.field(1).type, pa.int32(), pa.string(), pa.bool_(), pa.string()]
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "block", "first_label", "kept", "text"])

    schema = rows.select(id_column).schema.add("block", "integer").add("first_label", "string").add("kept", "boolean").add("text", "string")
    return rows.mapInArrow(labelled, schema)
