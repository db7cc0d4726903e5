"""Whether a pattern cuts a text as the tokenizers library does."""

from __future__ import annotations

from collections.abc import Callable


class LetterGuard:
    """Finds letters that two ways of cutting see otherwise, as their Unicode tables differ.

    A letter is asked once, in all contexts that the patterns distinguish, and on either side of marks of
    two combining classes: a mark that only one of the two reorders has another class than one of them.
    """

    def __init__(self, ours: Callable[[str], list], library: Callable[[str], list]):
        self.ours, self.library = ours, library
        self.asked: set[str] = set()
        self.odd: set[str] = set()

    def differs(self, letter: str) -> bool:
        probe = f"a{letter}1{letter}{letter} {letter}!{letter} a\u0301{letter}\u0323{letter}\u0301 a\u0323{letter}\u0301{letter}\u0323"
        return self.ours(probe) != self.library(probe)

    def trusts(self, text: str) -> bool:
        if text.isascii():
            return True
        if new := set(text) - self.asked:
            self.asked |= new
            self.odd |= {c for c in new if not c.isascii() and self.differs(c)}
        return not self.odd or self.odd.isdisjoint(text)
