"""Parts of a text that byte-level BPE encodes one by one, whatever stands around them.

The pattern that splits text before the merges always begins a match at a single space
before a character that is no white space, and what it matches before that space does not
depend on what follows. Texts are cut at those spaces, and each different part is encoded
once and kept for later texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: Parts kept at most from one block of texts to the next; then all are forgotten.
KEPT_PARTS = 300_000
#: Characters of a block of texts, about.
BLOCK_CHARS = 12_000_000

_CUT = re.compile(r"(?= \S)")


def _sound(part: str) -> bool:
    """Whether the part begins where a text may be cut, if it begins with a space."""
    return part[0] != " " or (len(part) > 1 and not part[1].isspace())


class UnitEncoder:
    """Encodes texts as ids in bytes; ``encode_parts`` encodes a list of parts."""

    def __init__(self, encode_parts: Callable[[list[str]], list[bytes]], kept: int = KEPT_PARTS) -> None:
        self.encode_parts, self.kept = encode_parts, kept
        #: Sound parts only, so that a text all of whose parts are here is rightly cut.
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.kept:
            self.known = {}
        known, new, odd = self.known, set(), {}
        for k, text in enumerate(texts):
            parts = _cut_at_spaces(text)
            fresh = set(parts).difference(known)
            if "\0" in text or not all(map(_sound, fresh)):
                odd[k] = parts = [p for p in _CUT.split(text) if p]
                # White space at the start of a text is a part of this text alone.
                fresh = {p for p in parts if _sound(p)}.difference(known)
            new |= fresh
        wanted = list(new)
        known.update(zip(wanted, self.encode_parts(wanted), strict=True))
        heads = list({p for parts in odd.values() for p in parts[:1] if not _sound(p)})
        own = dict(zip(heads, self.encode_parts(heads), strict=True))
        return [
            b"".join(own.get(p) or known[p] for p in odd[k])
            if k in odd
            else b"".join(map(known.__getitem__, _cut_at_spaces(text)))
            for k, text in enumerate(texts)
        ]


def _cut_at_spaces(text: str) -> list[str]:
    """The text cut before every space: rightly so if all parts are sound."""
    parts = text.replace(" ", "\0 ").split("\0")
    if not parts[0]:
        del parts[0]
    return parts


def blocks_of(texts: list[str], chars: int = BLOCK_CHARS) -> list[tuple[int, int]]:
    """Ranges of texts of about so many characters together."""
    out, start, size = [], 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= chars:
            out.append((start, k + 1))
            start, size = k + 1, 0
    if start < len(texts):
        out.append((start, len(texts)))
    return out
