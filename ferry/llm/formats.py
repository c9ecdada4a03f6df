"""All values of a surrogate's format, numbered, and a keyed order of them."""

from __future__ import annotations

import hmac
import string
from collections.abc import Callable
from typing import NamedTuple

# Places in a format's keyed order that are used; no table has half as many rows.
PLACES = 2**62
ROUNDS = 8
# What a widened format gets behind its value, a level at a time.
WIDER = {"email": "a" * 8, "secret": "a" * 12, "digits": "0" * 8}
# Stands for an IPv4 address where its format is used up (documentation addresses, RFC 3849).
IPV6 = "2001:db8" + ":0000" * 6
HEX = "0123456789abcdef"
# Locally administered: the second digit says so.
MAC = (HEX, "26ae", *[HEX] * 10)
# Letters of scripts; other letters become Latin ones.
LETTERS = (
    ("Ѐ", "ԯ", "абвгдежзийклмнопрстуфхцчшщъыьэюя"),
    ("Ͱ", "Ͽ", "αβγδεζηθικλμνξοπρστυφχψω"),
)
CARD_STARTS = {
    "4": ["4"],
    "5": [f"5{d}" for d in "12345"],
    "2": [f"2{d}" for d in "234567"],
    "3": ["34", "35", "37"],
}


class Space(NamedTuple):
    """Values made of one unit of each alphabet; units of an alphabet are equally long."""

    alphabets: list[list[str] | str]
    whole: Callable[[str], str] = str  # puts check digits in
    bare: Callable[[str], str] = str  # takes them out

    def size(self) -> int:
        n = 1
        for units in self.alphabets:
            n *= len(units)
        return n

    def value(self, index: int) -> str:
        out = []
        for units in reversed(self.alphabets):
            index, unit = divmod(index, len(units))
            out.append(units[unit])
        return self.whole("".join(reversed(out)))

    def index(self, value: str) -> int | None:
        """The number of ``value``, or None if it is not of this space."""
        body, at, index = self.bare(value), 0, 0
        for units in self.alphabets:
            width = len(units[0])
            unit = body[at : at + width]
            if len(unit) != width or unit not in units:
                return None
            index, at = index * len(units) + units.index(unit), at + width
        return index if at == len(body) and self.whole(body) == value else None


def letters(c: str) -> str:
    """The letters of the script and case of ``c``."""
    small = next((s for low, high, s in LETTERS if low <= c <= high), string.ascii_lowercase)
    return small.upper() if c.isupper() else small


def alike(text: str) -> list[list[str] | str]:
    """Letters for letters of the same case and script, digits for digits, the rest as it is."""
    return [string.digits if c.isdigit() else letters(c) if c.isalpha() else [c] for c in text]


def fixed(text: str) -> list[list[str] | str]:
    return [[c] for c in text]


def octets(width: int) -> list[str]:
    low, high = {1: (1, 10), 2: (10, 100), 3: (100, 255)}[width]
    return [str(n) for n in range(low, high)]


def _feistel(x: int, bits: int, key: bytes, tag: bytes, back: bool) -> int:
    half = bits // 2
    width, mask = (half + 7) // 8, (1 << half) - 1
    left, right = x >> half, x & mask
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        moved = left if back else right
        seed = tag + bytes([i]) + moved.to_bytes(width, "big")
        stream = b"".join(hmac.digest(key, n.to_bytes(4, "big") + seed, "sha256") for n in range(width // 32 + 1))
        mix = int.from_bytes(stream[:width], "big") & mask
        left, right = (right ^ mix, left) if back else (right, left ^ mix)
    return left << half | right


def permuted(x: int, size: int, key: bytes, tag: str, back: bool = False) -> int:
    """A keyed permutation of the numbers below ``size``, or its inverse."""
    bits = max((size - 1).bit_length(), 2)
    bits += bits % 2
    while (x := _feistel(x, bits, key, tag.encode(), back)) >= size:
        pass  # outside: go on along the cycle, which comes back inside
    return x
