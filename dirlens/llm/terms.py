"""Words of Latin letters A-Z, digits and everything outside ASCII, with A-Z in lower case."""

from __future__ import annotations

_UPPER = range(0x41, 0x5B)
#: Byte for byte: A-Z become a-z, every other ASCII sign but 0-9 and a-z becomes a space. The bytes of
#: characters outside ASCII are all at 0x80 or above and stay.
_TABLE = bytes(b + 32 if b in _UPPER else b if b >= 0x80 or chr(b).isascii() and chr(b).isalnum() else 0x20
               for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The maximal words of the whole text, in order, as UTF-8; none for null."""
    return (text or "").encode("utf-8", "replace").translate(_TABLE).split()
