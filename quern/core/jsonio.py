"""Lenient JSON reading and canonical JSON writing.

``loads`` gives None for null, blank, cut-off or otherwise unreadable text and
unwraps text that was encoded twice.  ``canonical`` writes sorted keys without
spaces, the form every content hash in this package is taken over.
"""

from __future__ import annotations

import hashlib
import json
from typing import Any


def loads(text: str | None) -> Any:
    """The value of ``text``, or None if it has none; a string value (encoded
    twice, or more often) is read again, and each time it is shorter."""
    while isinstance(text, str) and text.strip():
        try:
            text = json.loads(text)
        except (ValueError, RecursionError):
            return None
    return None if isinstance(text, str) else text


def load_list(text: str | None) -> list:
    """The array in ``text``; empty if it holds none."""
    value = loads(text)
    return value if isinstance(value, list) else []


def canonical(value: Any) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def digest(value: Any) -> str:
    """SHA-256 of the canonical form; lone surrogates are kept as they are."""
    return hashlib.sha256(canonical(value).encode("utf-8", "surrogatepass")).hexdigest()


def content_text(content: Any) -> str:
    """Text of a message's content: the string, its text blocks joined by a
    newline, or empty."""
    if isinstance(content, str):
        return content
    if isinstance(content, list):
        return "\n".join(b["text"] for b in content if isinstance(b, dict) and b.get("type") == "text" and isinstance(b.get("text"), str))
    return ""
