"""Many Python patterns over many titles: texts that a pattern cannot do without are looked up first, then it is tried.

For each pattern, `needed` gives a set of ASCII texts one of which stands in every title that it matches, or none where
no such set is known. All of them go into one automaton, so a title costs its own length however many patterns there
are; only patterns whose text is found, and those without any, are tried. The trial is Python's own, so the rows are
those of trying all.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

#: Characters of a text at least; shorter ones are in too many titles.
LEAST = 3
# Letters beyond ASCII that Python takes for an ASCII one without regard to case.
_SAME = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}


def folded(title: str) -> str:
    """A title as it is looked up in: each letter that equals an ASCII one becomes its lower case."""
    return title.translate(_SAME).lower()


def _best(options: list[set[str]]) -> set[str] | None:
    """Of several sets, each of which is needed, the one whose shortest text is longest."""
    return max(options, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def _sets(items) -> list[set[str]]:
    """Needed sets of a sequence of parsed parts."""
    out, run = [], ""

    def ended():
        nonlocal run
        if len(run) >= LEAST:
            out.append({run})
        run = ""

    for op, value in items:
        if op is C.LITERAL and value < 128:
            run += chr(value).lower()
            continue
        ended()
        if op is C.SUBPATTERN:
            out += _sets(value[3])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and value[0] > 0:
            out += _sets(value[2])
        elif op is C.ATOMIC_GROUP:
            out += _sets(value)
        elif op is C.BRANCH:
            ways = [_best(_sets(way)) for way in value[1]]
            if all(ways):
                out.append(set().union(*ways))
    ended()
    return out


def needed(pattern: str) -> set[str] | None:
    """Texts of which one is in the folded form of every title that the pattern matches; None where none is known."""
    return _best(_sets(_parser.parse(pattern, re.IGNORECASE)))


class Matcher:
    """The patterns (name, pattern) that a title matches, in their order."""

    def __init__(self, patterns: list[tuple[str, str]]):
        import ahocorasick

        self.names = [n for n, _ in patterns]
        self.found = [re.compile(p, re.IGNORECASE).search for _, p in patterns]
        self.always, by_text = [], {}
        for i, (_, p) in enumerate(patterns):
            texts = needed(p)
            if texts is None:
                self.always.append(i)
            for t in texts or ():
                by_text.setdefault(t, []).append(i)
        self.texts = ahocorasick.Automaton()
        for t, own in by_text.items():
            self.texts.add_word(t, own)
        if by_text:
            self.texts.make_automaton()

    def likely(self, title: str) -> list[int]:
        found = set(self.always)
        if len(self.texts):
            for _, own in self.texts.iter(folded(title)):
                found.update(own)
        return sorted(found)

    def __call__(self, title: str) -> list[str]:
        return [self.names[i] for i in self.likely(title) if self.found[i](title)]
