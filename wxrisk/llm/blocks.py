"""HTML as a sequence of text blocks with their tag paths. Plain helpers, no Spark."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Fixed values of HTML: tags that separate blocks, that have no content, and whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td textarea tfoot th thead tr ul video audio iframe".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = "script|style|noscript|template|svg|title|object|math|canvas"
#: An opening tag of the key's kind ends an open one of these.
ENDED_BY = {tag: frozenset({tag}) for tag in ("li", "option", "tr")} | {
    tag: frozenset(group) for group in (("dt", "dd"), ("td", "th")) for tag in group
}

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<silent>{SILENT})\b[^>]*+>.*?(?:</(?P=silent)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[a-zA-Z/!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text between two block tags, the open tags around it, and how much of it stands in links."""

    text: str
    path: tuple[tuple[str, ...], ...]
    linked: int = 0


@dataclass
class _Reader:
    stack: list[tuple[str, ...]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    links: int = 0
    linked: int = 0

    def text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def close(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, tuple(self.stack), min(self.linked, len(text))))
        self.parts.clear()
        self.linked = 0

    def open_tag(self, tag: str, rest: str) -> None:
        if tag == "a":
            self.links += 1
        if tag not in BLOCK_TAGS:
            return
        self.close()
        if tag in VOID_TAGS:
            return
        if self.stack and (self.stack[-1][0] == "p" or self.stack[-1][0] in ENDED_BY.get(tag, ())):
            self.stack.pop()
        names = " ".join("".join(m) for m in _NAMES.findall(rest)).lower() if "=" in rest else ""
        self.stack.append((tag, *_PARTS.findall(names)))

    def end_tag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag not in BLOCK_TAGS:
            return
        self.close()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                del self.stack[k:]
                self.links = 0
                return


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order, with white space turned into single spaces.

    Unclosed tags, comments and scripts end with the page. Scripts, styles, titles and the like
    have no text.
    """
    reader, at = _Reader(), 0
    for match in _TOKEN.finditer(page):
        reader.text(page[at:match.start()])
        at = match.end()
        if match["tag"]:
            if match["end"]:
                reader.end_tag(match["tag"].lower())
            else:
                reader.open_tag(match["tag"].lower(), match["rest"])
    reader.text(page[at:])
    reader.close()
    return reader.blocks
