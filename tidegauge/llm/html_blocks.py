"""Text blocks of one HTML page, in one pass over its tags."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# HTML's own element names, and words that sites use in class and id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr br img input".split()
)
HEAD = frozenset(("head",))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("nav footer aside form menu dialog button select object canvas audio video head".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion"
    " cookie cookies consent gdpr notice notices notification alert disclaimer"
    " nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toc skip"
    " sidebar sidebars aside rail widget widgets footer masthead topbar toolbar"
    " comment comments commentlist disqus respond replies reply"
    " share sharing social related recommended newsletter subscribe subscription signup login"
    " popup modal overlay hidden".split()
)
#: In a class name, these say that the element only has to do with what the other words name.
ABOUT = frozenset("with without has no main".split())
#: A header with one of these words is the article's own.
ARTICLE_WORDS = frozenset("article post entry story content".split())
IN_HEAD = frozenset("meta link title style script base noscript template".split())
#: What an opening tag closes first, and where the search for it ends.
CLOSES = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=(?:\s*+(?:"[^"]*+"|'[^']*+'))?+)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
WORD = re.compile(r"[a-z]+")
MAIN = re.compile(r"<main[\s>]", re.IGNORECASE)


class Block(NamedTuple):
    """A line of text; whether it is in the page's article; whether it is mostly links.

    ``marked`` lines are in a menu, header, advert or the like by HTML or class names.
    """

    text: str
    main: bool
    links: bool
    marked: bool = False


#: Whether an element is dropped: no; only because a compound name has a word such as
#: ``sidebar``, as in ``sidebar-right``; for certain.
KEPT, DOUBTFUL, CERTAIN = range(3)


class Open(NamedTuple):
    name: str
    dropped: int
    main: bool
    header: bool


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _drop(name: str, own: dict[str, str]) -> int:
    if name in DROPPED:
        return CERTAIN
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true":
        return CERTAIN
    if re.search(r"display\s*:\s*none", own.get("style", "")):
        return CERTAIN
    if name in ("html", "body", "main"):
        return KEPT
    if own.get("role", "").lower() in DROPPED_ROLES:
        return CERTAIN
    names = f"{own.get('class', '')} {own.get('id', '')}".lower().split()
    words = [part for part in map(WORD.findall, names) if ABOUT.isdisjoint(part)]
    if name == "article":
        return CERTAIN if any({"comment", "comments", "reply"} & set(part) for part in words) else KEPT
    found = [part for part in words if not DROPPED_WORDS.isdisjoint(part)]
    if any(len(part) == 1 for part in found):
        return CERTAIN
    return DOUBTFUL if found else KEPT


def _is_header(name: str, own: dict[str, str]) -> bool:
    return name == "header" or name not in INLINE and "header" in WORD.findall(
        f"{own.get('class', '')} {own.get('id', '')}".lower()
    )


def _is_own_header(own: dict[str, str]) -> bool:
    return not ARTICLE_WORDS.isdisjoint(WORD.findall(f"{own.get('class', '')} {own.get('id', '')}".lower()))


def blocks_of(page: str | None) -> list[Block]:
    """The visible blocks of a page without menus, headers, footers, forms and the like.

    Elements that HTML closes by itself are closed; elements left open end with their
    parent. Of an article's own header only the headings stay. Compound names, such as
    ``sidebar-right``, may tell about the layout: they don't drop the page's first article
    or main element, and nothing at all if else no text would be left.
    """
    return [block for block in lines_of(page) if not block.marked]


def lines_of(page: str | None) -> list[Block]:
    """All visible lines of a page: those of :func:`blocks_of` and the marked ones.

    Marked text inside of a line is a line of its own, after it.
    """
    found = _blocks(page, True)
    return _blocks(page, False) if all(block.marked for block in found) else found


def _blocks(page: str | None, doubtful: bool) -> list[Block]:
    """``doubtful`` says whether compound names drop an element."""
    out: list[Block] = []
    if not page:
        return out
    stack: list[Open] = [Open("", KEPT, False, False)]
    has_main = MAIN.search(page) is not None  # then no article in front of it is the page's own
    parts: list[str] = []
    aside: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, stack[-1].main, 2 * linked > len(text)))
            parts.clear()
            linked = 0
        if aside:
            text = " ".join("".join(aside).split())
            if text:
                out.append(Block(text, False, False, True))
            aside.clear()

    opened: Counter = Counter()

    def cut(i: int) -> None:
        for element in stack[i:]:
            opened[element.name] -= 1
        del stack[i:]

    def close(names: frozenset, fence: frozenset) -> None:
        """Close the innermost of ``names``, if none of ``fence`` is open inside of it."""
        if not any(opened[name] for name in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                return cut(i)
            if stack[i].name in fence:
                return None

    def close_paragraph() -> None:
        i = len(stack) - 1
        while i and stack[i].name in INLINE:
            i -= 1
        if i and (stack[i].name == "p" or stack[i].name in HEADINGS):
            cut(i)

    place, size, lower = 0, len(page), None
    heading = 0
    while place < size:
        tag = page.find("<", place)
        end = size if tag < 0 else tag
        if end > place:
            top = stack[-1]
            text = html.unescape(page[place:end])
            if not top.dropped and (not top.header or heading):
                parts.append(text)
                if in_link:
                    linked += len(text.strip())
            else:
                aside.append(text)
        if tag < 0:
            break
        match = TAG.match(page, tag)
        if not match:
            if page.startswith("<!--", tag):
                stop = page.find("-->", tag + 4)
                place = size if stop < 0 else stop + 3
            elif page.startswith(("<!", "<?"), tag) or page.startswith("</", tag):
                stop = page.find(">", tag)
                place = size if stop < 0 else stop + 1
            elif tag + 1 < size and page[tag + 1].isalpha():
                place = size  # a tag that never ends
            else:
                shown = not stack[-1].dropped and (not stack[-1].header or heading)
                (parts if shown else aside).append("<")
                place = tag + 1
            continue
        place = match.end()
        name, closing = match[2].lower(), bool(match[1])
        if closing:
            if name == "a":
                in_link = 0
            if name in HEADINGS:
                flush()
                heading = 0
            elif name not in INLINE:
                flush()
            close(frozenset((name,)), frozenset())
            continue
        if name in RAW:
            if lower is None:
                lower = page.lower() if len(page.lower()) == size else page
            stop = lower.find(f"</{name}", place)
            place = size if stop < 0 else (page.find(">", stop) + 1 or size)
            continue
        if name == "br":
            parts.append(" ")
            aside.append(" ")
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name == "a":
            in_link = 1
        own = _attributes(match[3]) if match[3].strip() else {}
        if stack[-1].name == "head" and name not in IN_HEAD:
            close(HEAD, frozenset())
        if name not in INLINE:
            flush()
            close_paragraph()
            if name in CLOSES:
                close(*CLOSES[name])
            heading = int(name in HEADINGS)
        top = stack[-1]
        dropped = _drop(name, own)
        if dropped == DOUBTFUL and not doubtful:
            dropped = KEPT
        is_main = name in ("article", "main") or own.get("role", "") == "main"
        first = is_main and not has_main and top.dropped == DOUBTFUL
        if name != "main" and not first:
            dropped = max(dropped, top.dropped)
        main = top.main or not dropped and is_main
        has_main = has_main or main
        header = top.header
        if not main and name not in ("html", "body") or top.main:
            if _is_header(name, own):
                header = True
                if not (main or _is_own_header(own)):
                    dropped = CERTAIN
        if name not in INLINE or dropped:
            stack.append(Open(name, dropped, main, header))
            opened[name] += 1
    flush()
    return out
