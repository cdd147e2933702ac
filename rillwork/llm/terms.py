"""Terms of a text: runs of ASCII letters and digits and of all that is not ASCII, A-Z lower-cased."""

from __future__ import annotations

_TERM = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: Each byte as it is compared: capitals lower-cased, ASCII that belongs to no term a space.
_TABLE = bytes(b if b in _TERM or b >= 0x80 else 0x20 for b in bytes(range(256)).lower())


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; none for null."""
    return text.encode().translate(_TABLE).split() if text else []
