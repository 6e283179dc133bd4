"""Pre-tokens of byte-level tokenizers."""

from __future__ import annotations

import regex

#: Fixed value: the published pattern of this tokenizer family.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def pieces(text: str, special: tuple[str, ...] = ()) -> list[str]:
    """The pre-tokens of ``text`` in order; strings in ``special`` stand for themselves."""
    if not any(s in text for s in special):
        return PATTERN.findall(text)
    out: list[str] = []
    for part in regex.splititer("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")", text):
        out += [part] if part in special else PATTERN.findall(part)
    return out
