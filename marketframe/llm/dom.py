"""Reading a page: a small HTML walker that yields text blocks with the style
path of their element. It needs nothing from Spark."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import xxhash

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp".split())
#: Elements that begin a block of text; all others, unknown ones too, are inline.
BLOCK = frozenset("""address article aside base blockquote body caption center col colgroup dd details dialog dir div dl dt
fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link listing
main menu meta nav noframes ol optgroup option p plaintext pre search section style summary table tbody td tfoot th thead
title tr ul xmp""".split())
#: A start tag here ends an open element of the value (end tags left out in the source).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
        "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}

# Mark-up that names a part of a page other than its article.
NOISE_TAGS = frozenset("""nav footer aside form script style noscript template iframe object embed canvas svg math button
select textarea dialog menu audio video head title""".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment
comments complementary consent contentinfo cookie cookies dialog discussion disqus footer gdpr hidden login menu
menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted
promotion related reply replies respond search share sharing sidebar signup social sponsor sponsored subscribe
subscription toolbar widget widgets""".split())
HEADER_WORDS = frozenset("header masthead topbar".split())
#: Elements that hold the whole page and are no branch of it.
PAGE = frozenset(["", "html", "body"])
MAIN_TAGS = frozenset("article main".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[.*?(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)
    | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:>|\Z)""",
                  re.S | re.X)  # a quote opens a quoted value only behind an equals sign
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_DIGITS = re.compile(r"\d+")
_NAMES = re.compile(r"[a-z]+")
_HIDE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def digest(*parts) -> int:
    """A signed 64-bit hash of strings and integers."""
    n = xxhash.xxh64_intdigest("\0".join(map(str, parts)))
    return n - (1 << 64) if n >> 63 else n


@dataclass
class Element:
    tag: str
    path: int  # hash of the style path from the root
    parent: "Element | None"
    noise: bool  # by its own mark-up or that of an element around it
    main: bool  # inside an article or main element
    named: bool = False  # a word of its own class, id or role names noise
    children: list[str] = field(default_factory=list)

    def paths(self) -> list[int]:
        """Paths of the element and those around it, below the body."""
        out, e = [], self
        while e.tag not in PAGE:
            out.append(e.path)
            e = e.parent
        return out


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _is_noise(tag: str, attrs: dict[str, str], main: bool) -> bool:
    if tag in NOISE_TAGS or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    if _HIDE.search(attrs.get("style", "").lower()):
        return True
    if tag in ("html", "body"):
        return False
    names = f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower().split()
    if tag in MAIN_TAGS:  # named as a whole only: "comment", but not "has-sidebar"
        return any(n in NOISE_WORDS for n in names)
    return tag == "header" and not main or any(r in NOISE_WORDS for r in attrs.get("role", "").lower().split())


def _is_named(tag: str, attrs: dict[str, str], main: bool) -> bool:
    if tag in PAGE or tag in MAIN_TAGS:
        return False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".lower().split():
        words = _NAMES.findall(name)
        if {"has", "no", "with", "without"} & set(words[:1]):
            continue
        if any(w in NOISE_WORDS or (w in HEADER_WORDS and not main) for w in words):
            return True
    return False


def _drop_named(elements: list[Element], blocks: list[tuple[Element, str]]) -> None:
    """Elements named by a word become noise with all in them, but for those around the
    page's article: of the outermost articles (main elements where there is none), those
    in the fewest named elements keep them; and where a page has neither, elements that hold
    more than half of its text."""
    def around(e: Element) -> list[Element]:
        out = []
        while e.parent is not None:
            e = e.parent
            out.append(e)
        return out

    spared: set[int] = set()
    if any(e.named for e in elements):
        for tag in ("article", "main"):
            wraps = [up for e in elements if e.tag == tag and not e.noise
                     for up in [around(e)] if not any(a.tag == tag for a in up)]
            if wraps:
                held = [[id(a) for a in up if a.named] for up in wraps]
                fewest = min(map(len, held))
                spared = {x for h in held if len(h) == fewest for x in h}
                break
        else:
            size: dict[int, int] = {}
            for e, text in blocks:
                for a in [e, *around(e)]:
                    size[id(a)] = size.get(id(a), 0) + len(text)
            whole = sum(len(text) for _, text in blocks)
            spared = {id(e) for e in elements if e.named and 2 * size.get(id(e), 0) > whole}
    for e in elements[1:]:  # parents come first
        e.noise = e.noise or e.parent.noise or (e.named and id(e) not in spared)


def walk(html: str) -> tuple[list[tuple[Element, str]], list[Element]]:
    """The text blocks of a page in order, each with the element it lies in, and
    all elements. Text in an element that is noise by its mark-up is left out. Character
    references are decoded, white space in a block is one space, comments, scripts, styles and mark-up are gone. Text cut off inside a
    tag or comment ends there."""
    root = Element("", 0, None, False, False)
    stack, blocks, elements, words, owner = [root], [], [root], [], None

    def close() -> None:
        nonlocal words, owner
        text = " ".join("".join(words).split())
        if text:
            blocks.append((owner or stack[-1], text))
        words, owner = [], None

    def add(text: str) -> None:
        nonlocal owner
        if stack[-1].noise:
            return
        if owner is None and text.strip():
            at = len(stack) - 1
            while at and stack[at].tag not in BLOCK:
                at -= 1
            owner = stack[at]
        words.append(unescape(text))

    pos, size = 0, len(html)
    while pos < size:
        m = _TAG.search(html, pos)
        if m is None:
            add(html[pos:])
            break
        if m.start() > pos:
            add(html[pos:m.start()])
        pos = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:  # end tag
            inline = name not in BLOCK
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == name:
                    if not inline:
                        close()
                    del stack[at:]
                    break
                if inline and stack[at].tag in BLOCK:
                    break
            else:
                if not inline:
                    close()
            continue
        if name in BLOCK:
            close()
            for at in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph, not one around a graphic or form part
                if stack[at].tag == "p":
                    del stack[at:]
                    break
                if stack[at].tag in BLOCK or stack[at].noise:
                    break
            if name in ENDS:
                for at in range(len(stack) - 1, 0, -1):
                    if stack[at].tag in SCOPE[name]:
                        break
                    if stack[at].tag in ENDS[name]:
                        del stack[at:]
                        break
        if name in ("br", "hr"):
            words.append(" ")
            continue
        up = stack[-1]
        attrs = _attributes(m[3] or "")
        style = " ".join([name, *sorted(_DIGITS.sub("", f"{attrs.get('class', '')} {attrs.get('id', '')}").split())])
        up.children.append(style)
        if name in VOID:
            continue
        noise = up.noise or _is_noise(name, attrs, up.main)
        named = not noise and _is_named(name, attrs, up.main)
        if named and name not in BLOCK:  # holds no article
            noise = True
        e = Element(name, digest(up.path, style), up, noise, up.main or (name in MAIN_TAGS and not noise), named)
        elements.append(e)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(html, pos)
            pos = size if end is None else (html.find(">", end.end()) + 1 or size)
            continue
        stack.append(e)
    close()
    _drop_named(elements, blocks)
    return [(e, text) for e, text in blocks if not e.noise], elements
