"""Words of texts as bytes, folded: runs of digits, a-z (A-Z lower-cased) and
characters from U+0080 on, whose UTF-8 bytes are all above 0x7F."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def _fold(byte: int) -> int:
    c = chr(byte)
    if "A" <= c <= "Z":
        return byte + 32
    return byte if byte >= 0x80 or "a" <= c <= "z" or "0" <= c <= "9" else 0x20


#: every byte folded in its place, what is no part of a word to a space
FOLD = bytes(_fold(b) for b in range(256))


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def each_text(column) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow string column's values, one at a time; null
    counts as empty."""
    wide = pa.types.is_large_string(column.type)
    for value in column.cast(pa.large_binary() if wide else pa.binary()):
        yield value.as_py() or b""
