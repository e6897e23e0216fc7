"""Words of UTF-8 texts by a 256-byte table, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

# A longer text is split into words piece by piece.
PIECE = 1 << 20
_BLANK = 0x20


def byte_table(is_word: Callable[[int], bool]) -> bytes:
    """Table for ``bytes.translate``: A-Z to a-z, bytes that are in no word to a blank.

    Bytes from 0x80 on only occur in characters beyond ASCII, so a rule over bytes is one over characters.
    """
    lowered = [b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)]
    return bytes(b if is_word(b) else _BLANK for b in lowered)


def word_pieces(text: bytes | None, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists; a word is never cut."""
    if not text:
        return
    bare = text.translate(table)
    if len(bare) <= piece:
        yield bare.split()
        return
    start = 0
    while start < len(bare):
        end = bare.find(b" ", start + piece)
        end = len(bare) if end < 0 else end
        yield bare[start:end].split()
        start = end
