"""Pieces of a text as the word-end BPE vocabulary splits it: normalised, lower-cased, blanks dropped.

The rules are those of the tokenizer's file: special strings are cut out of the raw text, the rest is
brought to NFC, lower-cased character by character (no final sigma) and matched against one pattern.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import regex

_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
# Letters and digits that the regex library knows and the tokenizer's older Unicode tables do not.
_YOUNG = (
    r"\U00000558\U0000058b-\U0000058c\U0000088f\U00000c5c\U00000cdc\U0000208f\U0000209d-\U0000209f"
    r"\U0000a7ce-\U0000a7cf\U0000a7d2\U0000a7d4\U0000a7dd\U0000a7e2\U0000a7f1\U0000ab6c-\U0000ab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    r"\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    r"\U0003d000-\U0003fc3f"
)
_ANY = regex.compile(
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_YOUNG}]]+|[\p{{N}}--[{_YOUNG}]]"
    rf"|[^\p{{White_Space}}[[\p{{L}}\p{{N}}]--[{_YOUNG}]]]+")
#: Letters below U+0250 other than A-Z; texts without anything else beyond ASCII take the faster pattern.
_LATIN = "ªµºÀ-ÖØ-öø-ɏ"
_LATIN_ONLY = re.compile(f"[\x00-\x7f{_LATIN}]*")
_LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\t-\r a-z0-9{_LATIN}]+")


def plain_pieces(text: str) -> list[str]:
    """Pieces of a text without special strings."""
    if text.isascii():
        return _ASCII.findall(text.lower())
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return (_LATIN_PIECES if _LATIN_ONLY.fullmatch(text) else _ANY).findall(text)


@cache
def specials(path: str) -> tuple[re.Pattern, dict[str, int]]:
    """The pattern of the special strings of a tokenizer file, and their ids."""
    with open(path, encoding="utf-8") as file:
        ids = {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}
    return re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")"), ids


def pieces(text: str, special: re.Pattern) -> list[str]:
    """All pieces of a text; a special string is a piece of its own."""
    if "<|" not in text or not special.search(text):
        return plain_pieces(text)
    out: list[str] = []
    for k, part in enumerate(special.split(text)):
        out += [part] if k % 2 else plain_pieces(part)
    return out


class Memo(dict):
    """Values by piece, computed when first asked for; emptied when ``limit`` values are held."""

    def __init__(self, make, limit: int = 1_000_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, piece: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[piece] = self.make(piece)
        return value
