"""Words of texts as bytes: runs of letters and digits, only A-Z lower-cased.

A word is a run of ASCII letters, ASCII digits and characters beyond ASCII. In UTF-8
the latter are bytes from 0x80 on, so a text is cut by its bytes.
"""

from __future__ import annotations

import re

_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
_LOWER = bytes(range(0x100)).lower()
#: Lower-cases A-Z and makes a space of every byte that is in no word.
TO_WORDS = bytes(b if b in _WORD_BYTES else 0x20 for b in _LOWER)
#: The same words in the text as it is written.
WRITTEN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TO_WORDS).split()
