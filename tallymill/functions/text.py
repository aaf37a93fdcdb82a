"""Unicode text forms shared by the operators (Python side; Spark SQL has no NFKC)."""

from __future__ import annotations

import re
import unicodedata

import regex

_CF = regex.compile(r"\p{Cf}+")
_WORD = re.compile(r"[^\W_]+")
_NOT_WORD = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Category Cf dropped, then NFKC and case folding; null is empty."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", _CF.sub("", text)).casefold()


def words(text: str) -> list[str]:
    """Runs of letters and digits of a folded text."""
    return _WORD.findall(text)


def squeeze(text: str) -> str:
    """A folded text without anything but letters and digits."""
    return _NOT_WORD.sub("", text)
