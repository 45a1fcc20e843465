"""Pages as flat outlines, on the standard library's parser.

Elements are numbered in document order, so what is below an element is a range
of numbers, and its text a range of strings; sizes come from running sums.
Elements nest as they are written: only an end tag closes an element, together
with all that are open inside it; an end tag without a start is ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose strings are no text.
SILENT = frozenset(["script", "style", "template"])


class Outline:
    """Element ``i`` (0 is the page) has the elements ``i + 1 .. end[i] - 1`` and the strings ``first[i] .. last[i] - 1`` below it."""

    def __init__(self):
        self.name, self.attrs, self.parent = ["#root"], [{}], [0]
        self.first, self.last, self.end = [0], [0], [0]
        self.strings: list[str] = []
        self.owner: list[int] = []
        self.gone: list[bool] = []
        self.chars = self.words = [0]

    def close(self) -> Outline:
        """Strings are stripped and the sums made; call it when all is read."""
        self.strings = [s.strip() for s in self.strings]
        self.gone = [False] * len(self.name)
        self._sum()
        return self

    def _sum(self) -> None:
        quiet = [False] * len(self.name)
        for i in range(1, len(quiet)):
            quiet[i] = quiet[self.parent[i]] or self.gone[i] or self.name[i] in SILENT
        self.strings = ["" if quiet[o] else s for s, o in zip(self.strings, self.owner, strict=True)]
        self.chars = list(accumulate(map(len, self.strings), initial=0))
        self.words = list(accumulate((len(s.split()) for s in self.strings), initial=0))

    def remove(self, unwanted: Callable[[int], bool]) -> None:
        """Takes out the elements that are unwanted as the page stands now, with all below them."""
        marked = [not g and i > 0 and unwanted(i) for i, g in enumerate(self.gone)]
        for i in range(1, len(marked)):
            self.gone[i] = self.gone[i] or marked[i] or self.gone[self.parent[i]]
        self._sum()

    def below(self, i: int = 0) -> Iterator[int]:
        """Elements below that are still there, in document order."""
        return (k for k in range(i + 1, self.end[i]) if not self.gone[k])

    def named(self, names: Iterable[str], i: int = 0) -> Iterator[int]:
        return (k for k in self.below(i) if self.name[k] in names)

    def size(self, i: int) -> int:
        """Length of the text without joints."""
        return self.chars[self.last[i]] - self.chars[self.first[i]]

    def count(self, i: int) -> int:
        """Words of the text."""
        return self.words[self.last[i]] - self.words[self.first[i]]

    def text(self, i: int = 0, join: str = "") -> str:
        """Stripped strings joined, empty ones left out."""
        return join.join(filter(None, self.strings[self.first[i] : self.last[i]]))

    def marks(self, i: int) -> str:
        """Class and id in lower case."""
        a = self.attrs[i]
        return f"{' '.join((a.get('class') or '').split())} {a.get('id') or ''}".lower()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page, self.open = Outline(), [0]

    def handle_starttag(self, tag, attrs):
        page = self.page
        page.name.append(tag)
        page.attrs.append({k: v or "" for k, v in attrs})
        page.parent.append(self.open[-1])
        page.first.append(len(page.strings))
        page.last.append(len(page.strings))
        page.end.append(len(page.name))
        if tag not in VOID:
            self.open.append(len(page.name) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((n for n in range(len(self.open) - 1, 0, -1) if self.page.name[self.open[n]] == tag), None)
        if at is not None:
            self.shut(at)

    def shut(self, at: int) -> None:
        """Closes the open elements from the ``at``-th on."""
        for i in self.open[at:]:
            self.page.last[i], self.page.end[i] = len(self.page.strings), len(self.page.name)
        del self.open[at:]

    def handle_data(self, data):
        self.page.strings.append(data)
        self.page.owner.append(self.open[-1])


_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def _as_written(m: re.Match) -> str:
    """A character reference, or the sign & of what is none."""
    name = m[1]
    return m[0] if name and (name[0] == "#" or name in html5) else f"&amp;{name or ''}"


def parse(source: str | None, closed: bool = False) -> Outline:
    """The outline of a page; comments and declarations are left out.

    Browsers read some character references without their semicolon too; with ``closed`` these stay as they are written.
    """
    b = _Builder()
    b.feed(_REFERENCE.sub(_as_written, source or "") if closed else source or "")
    b.close()
    b.shut(0)
    return b.page.close()
