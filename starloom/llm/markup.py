"""Reading a page's markup in one forward pass.

Every helper takes time linear in the page, also for pages whose tags or
quotes never end: see :func:`scan`.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

_QUOTED = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_PLAIN = r"[^>]*+"
# Elements whose content is no markup and, without an end tag, runs
# to the end of the page; elements that are left out only if they are closed.
RAW = "script|style|noscript|iframe"
CLOSED = frozenset("template svg object".split())
_SOME = re.compile(rf"<(?:{'|'.join(sorted(CLOSED))})(?=[\s/>])", re.I)
_REST = re.compile(r"<!--.*|(?!)()()()()()|([^<]++|<)", re.S)
_LONG = re.compile(r"&#(?:([0-9]{8,}+)|[xX]([0-9a-fA-F]{8,}+));?")


@lru_cache
def _pattern(raw: str, attrs: str) -> re.Pattern:
    return re.compile(
        rf"<!--.*?(?:-->|\Z)|<({raw})(?=[\s/>]){attrs}>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)|<(/?)([a-z][\w:-]*+)({attrs})>|<[!?][^>]*+>|(<(?=/?[a-z]|[!?]))|([^<]++|<)",
        re.I | re.S,
    )


def scan(page: str, raw: str = RAW) -> Iterator[re.Match]:
    """Comments, raw elements (name in group 1), tags (slash, name and
    attributes in groups 2 to 4), declarations and text (group 6), in page order and without gaps.

    A tag ends at the first ``>`` outside of quotes. Where a tag's quotes leave
    none up to the end of the page, it and the tags behind it end at their first
    ``>`` whatever the quotes; behind the last ``>`` all is text but a comment.
    """
    at = 0
    for pattern in (_pattern(raw, _QUOTED), _pattern(raw, _PLAIN), _REST):
        for m in pattern.finditer(page, at):
            if m.lastindex == 5:  # a tag without an end
                at = m.start()
                break
            yield m
        else:
            return


def unescape(text: str) -> str:
    """Character references decoded; numbers beyond Unicode, however long, are U+FFFD."""
    if "&" not in text:
        return text

    def short(m: re.Match) -> str:
        digits = (m[1] or m[2]).lstrip("0") or "0"
        return "�" if len(digits) > 7 else f"&#{'' if m[1] else 'x'}{digits};"

    return html.unescape(_LONG.sub(short, text))


def closed_elements(page: str, raw: str = RAW) -> list[tuple[int, int]]:
    """(start, end) of the outermost ``CLOSED`` elements, in page order. One
    without an end tag of its own, or a self-closed svg, has no content."""
    if not _SOME.search(page):
        return []
    out: list[tuple[int, int]] = []
    opened: list[tuple[str, int]] = []
    waiting = dict.fromkeys(CLOSED, 0)
    for m in scan(page, raw):
        name = (m[3] or "").lower()
        if name not in CLOSED:
            continue
        if not m[2]:
            if not (name == "svg" and m[4].endswith("/")):
                opened.append((name, m.start()))
                waiting[name] += 1
        elif waiting[name]:
            while True:  # elements opened inside and not closed end here
                last, start = opened.pop()
                waiting[last] -= 1
                if last == name:
                    break
            while out and out[-1][0] > start:
                out.pop()
            out.append((start, m.end()))
    return out
