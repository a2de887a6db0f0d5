"""Cutting texts into the pieces that a byte-level BPE encodes one by one.

The pieces are those of the pattern  's|'t|'re|'ve|'m|'ll|'d| ?letters| ?numbers| ?others|spaces  of the public
byte-level vocabularies. Texts of Latin letters and common punctuation are cut by an equal pattern of the fast
standard matcher; any other text is cut by the tokenizer library itself, whose Unicode tables then decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# fixed values: the letters, numbers and spaces below U+0250, in character-class form
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = "0-9²³¹¼½¾"
SPACES = "\t-\r \x85\xa0"

_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
_PLAIN = re.compile("[\x00-\x1b!-ɏ ‐-‧€]*")
_SAFE = re.compile(f"(?<=[{LETTERS}]) (?=[{LETTERS}])")
#: characters of a text that are cut at once
SPAN = 1 << 20


def spans(text: str, most: int = SPAN) -> Iterator[str]:
    """The text in runs of about `most` characters, cut where every piece ends: before a space between two letters."""
    at = 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Cutter:
    """Pieces of a text; the strings of special tokens inside it come out as their ids instead."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        added = tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("special tokens that strip, or match single words or normalised text, are not supported")
        self.special = {t.content: i for i, t in added.items()}
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def pieces(self, text: str) -> Iterator[list]:
        """Lists of pieces (str) and special ids (int), in order."""
        if self.split and any(s in text for s in self.special):
            for k, part in enumerate(self.split.split(text)):
                if k % 2:
                    yield [self.special[part]]
                elif part:
                    yield from self._plain(part)
        else:
            yield from self._plain(text)

    def _plain(self, text: str) -> Iterator[list[str]]:
        for span in spans(text):
            if _PLAIN.fullmatch(span):
                yield _PIECE.findall(span)
            else:
                yield [span[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(span)]
