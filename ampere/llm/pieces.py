"""Pre-tokens of a byte-level tokeniser, and values remembered for them."""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
#: What the pattern's classes are within Latin-1; the longest first.
_LATIN = {
    r"[^\s\p{L}\p{N}]": f"[^{_SPACE}{_LETTER}{_NUMBER}]",
    r"\p{L}": f"[{_LETTER}]",
    r"\p{N}": f"[{_NUMBER}]",
    r"\S": f"[^{_SPACE}]",
    r"\s": f"[{_SPACE}]",
}


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function from a text to the matches of ``pattern``. Texts within
    Latin-1 take the standard library's engine, which is the faster one, with
    the classes written out; all others take ``pattern`` as it is."""
    general = regex.compile(pattern).findall
    latin = pattern
    for a, b in _LATIN.items():
        latin = latin.replace(a, b)
    if re.search(r"\\|\[\^?:", latin.replace("\\t", "").replace("\\r", "")):
        return general  # other classes than those above
    simple = re.compile(latin).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general(text)
        return simple(text)

    return split


def byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, all others for the characters
    from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Memo(dict):
    """A dict of computed values of at most ``most`` entries, which bounds its
    memory and changes no value. When half of them are new, the older half is
    let go, so that what is met often stays."""

    def __init__(self, compute: Callable, most: int = 400_000):
        super().__init__()
        self.compute, self.most = compute, most
        self.old: dict = {}

    def __missing__(self, key):
        if len(self) >= self.most // 2:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value
