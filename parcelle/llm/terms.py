"""Terms of a text: runs of letters, or of letters and digits, with A-Z lower-cased; every non-ASCII character counts as a letter."""

from __future__ import annotations

from collections.abc import Iterator

#: Texts are cut into terms this many bytes at a time, so a very long text never becomes one list of terms.
PIECE = 1 << 22


def term_table(digits: bool) -> bytes:
    """Translation of bytes under which a term's bytes stay (A-Z in lower case) and all others become a space."""
    keep = set(range(0x61, 0x7B)) | set(range(0x80, 0x100)) | (set(range(0x30, 0x3A)) if digits else set())
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in keep else 0x20 for b in range(256))


LETTERS, LETTERS_AND_DIGITS = term_table(False), term_table(True)


def term_lists(text: bytes | None, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Terms of a whole UTF-8 text, in order, in lists of at most about ``piece`` bytes; null text has none."""
    plain = (text or b"").translate(table)
    at = 0
    while len(plain) - at > piece:
        cut = plain.rfind(b" ", at, at + piece)
        if cut <= at:  # one term longer than a piece
            cut = plain.find(b" ", at + piece)
            if cut < 0:
                break
        yield plain[at:cut].split()
        at = cut
    yield (plain[at:] if at else plain).split()
