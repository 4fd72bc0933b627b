"""Plain searches that tell which patterns cannot match a text, so that they need not run.

A hint may be there where the pattern does not match, never the other way
round. Letters that match ASCII ones where case does not count, though lower()
does not make them so, set all hints.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from prosemill.functions.vocab import TYPOGRAPHIC

_FOLDED = re.compile("[\u017f\u0130\u0131\u212a]")
_PLAIN = re.compile(rf"[\x00-\x7f{TYPOGRAPHIC}]+")
#: What a line that is a heading holds, in lower case.
HEADING = ("chapter", "part", "scene", "episode", "act", "prologue", "epilogue")
#: Gates with hints, by their bits.
BITS = {name: 1 << i for i, name in enumerate(("format", "define", "label", "roman", "bullet", "sheet"))}
ALL = (1 << len(BITS)) - 1

_FORMAT = ("given the context", "possible answers", "answer:", "question:", "step ", "note:", "here is ", "here are ")
_DEFINE = ("type of", "a narrative in which")
_LABEL = ("Setting", "Character", "Date", "Genre", "Plot", "Theme", "Objective", "Synopsis")
_BULLET = ("Set up", "Give a", "Describe", "Explain", "Introduce", "Create a", "Write a", "Establish")
_SHEET = ("title", "plot", "character", "setting")


def folded(text: str) -> bool:
    return not text.isascii() and _FOLDED.search(text) is not None


def foreign_count(text: str) -> int:
    """Characters beyond ASCII, typographic marks aside."""
    return 0 if text.isascii() else len(_PLAIN.sub("", text))


def hints(text: str) -> int:
    """Bits of the gates whose patterns may match a normalised text."""
    if folded(text):
        return ALL
    low = text.lower()
    found = {
        "format": any(x in low for x in _FORMAT),
        "define": any(x in low for x in _DEFINE),
        "label": ":" in text and any(x in text for x in _LABEL),
        "roman": text.count("I.") + text.count("V.") >= 2,
        "bullet": any(f"{x}." in text for x in "ABCDE") and any(x in text for x in _BULLET),
        "sheet": "a." in low and any(x in low for x in _SHEET),
    }
    return sum(BITS[name] for name, may in found.items() if may)


def first_words_of(patterns: tuple[str, ...]) -> Callable[[str], bool]:
    """Whether a text may open with one of the patterns, by its first two letters; each pattern opens with a word in plain letters, or (?:A|The)."""
    words = [w for p in patterns for w in (("a", "the") if p.startswith("(?:A|The)") else (re.match("[A-Za-z]+", p)[0].lower(),))]
    pairs = {w[:2] for w in words if len(w) > 1}
    single = {w for w in words if len(w) == 1}

    def may(text: str) -> bool:
        start = text.lstrip()[:2].lower()
        return start in pairs or start[:1] in single and not start[1:].isalpha() or not start.isascii()

    return may
