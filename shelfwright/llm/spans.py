"""Spans that scans report, as text."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

Span = tuple[str, int, int]  # kind, first code point, end


def joined(spans: Sequence[Span], kinds: Sequence[str]) -> str:
    """``kind:start:end``, comma-joined, by start and then by the place of the kind in ``kinds``."""
    rank = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], rank[s[0]], s[2])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
