"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Found and validated: e-mail addresses, card numbers (Luhn), IBANs (mod 97), US social
security numbers, phone numbers, IPv4 addresses and calendar dates. Each value is
split into its variable signs and its format; the signs are read as one mixed-radix
number below M, which a keyed Feistel network over the next even number of bits
permutes, walking until the result is below M and valid as its kind. Check digits are
computed anew, dates are permuted among the days of their two centuries (1900 to 2099,
and so on) that can be written in their form. Of a phone number the national digits are
permuted and the country code stays, so one number written with other signs, or without
its country code, stays linked. So formats stay, equal values get equal pseudonyms in
all documents, and the key holder can invert them. The key is a text of any length.

Dates are year-month-day with - or /, and day-month-year with / or ., parts of one or
two digits, with or without a time after a T. What is no day/month but a month/day is read
as that. A date stays among those of its order and widths, so it is read back alike.

Defined results. Null text stays null; text without such values stays as it is. Of
overlapping values the leftmost counts, of equal starts the first kind of KINDS.
Repeated rows get equal results; whole texts are read; empty tables give empty
results. All columns stay, also such as are named like the added ones, which come last.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from lorebase.llm.batches import with_columns

ROUNDS = 8
#: Years that are permuted among themselves.
ERA = 200
KINDS = ("email", "iban", "phone", "card", "ssn", "ipv4", "date")
_PATTERNS = {
    # from the beginning of a run of its signs, so that a long run is read once
    "email": r"(?<![A-Za-z0-9._%+-])[._%+-]*+[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "date": r"(?<![0-9A-Za-z/-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})"
    r"(?:(?=[Tt][0-9]{2}|Z(?![0-9A-Za-z]))|(?![0-9A-Za-z/-]))",
}
#: Signs before the @ of a valid address.
MAX_LOCAL = 64
#: Country codes of one and two digits, a public numbering plan; all others have three.
_CODES = {*"17", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
ANY = re.compile("|".join(f"(?P<{k}>{_PATTERNS[k]})" for k in KINDS))


@lru_cache(maxsize=64)
def _secret(key: str) -> bytes:
    return blake2b(key.encode()).digest()


@lru_cache(maxsize=1 << 16)
def permute(x: int, size: int, key: str, back: bool = False) -> int:
    """Keyed permutation of 0..size-1, or its inverse."""
    if size < 2:
        return x
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low = (1 << half) - 1

    def turn(i: int, v: int) -> int:
        seed = blake2b(f"{size}|{i}|{v}".encode(), key=_secret(key), digest_size=(half + 7) // 8).digest()
        return int.from_bytes(seed, "big") & low

    while True:
        left, right = x >> half, x & low
        if back:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ turn(i, left), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ turn(i, right)
        x = left << half | right
        if x < size:
            return x


def _signs(value: str, key: str, back: bool, places: list[int]) -> str:
    """Permutes the letters (case kept) and digits at ``places`` as one number."""
    x, size = 0, 1
    for p in places:
        c = value[p]
        base, digit = (10, ord(c) - 48) if c.isdigit() else (26, ord(c.lower()) - 97)
        x, size = x * base + digit, size * base
    x = permute(x, size, key, back)
    out = list(value)
    for p in reversed(places):
        c = value[p]
        base = 10 if c.isdigit() else 26
        x, digit = divmod(x, base)
        out[p] = chr(48 + digit) if base == 10 else chr((65 if c.isupper() else 97) + digit)
    return "".join(out)


def luhn(digits: str) -> int:
    """The check digit of the digits before it."""
    return -sum(sum(divmod(int(d) * (2 - k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


@lru_cache(maxsize=32)
def _days(era: int, month: int, day: int, late: bool):
    """Ordinals of the days of an era whose month and day fit so many digits; ``late``: those after the 12th."""
    years = max(1, era * ERA + 100), min(9999, era * ERA + 99 + ERA)
    every = range(date(years[0], 1, 1).toordinal(), date(years[1], 12, 31).toordinal() + 1)
    if month == day == 2 and not late:
        return every
    return [n for n in every if (d := date.fromordinal(n)).month < 10**month and d.day < 10**day and (d.day > 12 or not late)]


def _date(value: str, key: str, back: bool) -> str | None:
    parts = re.split("([/.-])", value)
    for order in ("Ymd",) if len(parts[0]) == 4 else ("dmY", "mdY"):
        text = {c: parts[2 * k] for k, c in enumerate(order)}
        try:
            found = date(*(int(text[c]) for c in "Ymd"))
        except ValueError:
            continue
        days = _days((found.year - 100) // ERA, len(text["m"]), len(text["d"]), order == "mdY")
        new = date.fromordinal(days[permute(bisect_left(days, found.toordinal()), len(days), key, back)])
        for k, c in enumerate(order):
            parts[2 * k] = str({"Y": new.year, "m": new.month, "d": new.day}[c]).zfill(len(text[c]))
        return "".join(parts)
    return None


def _valid_ssn(value: str) -> bool:
    return not (value[:3] in ("000", "666") or value[0] == "9" or value[4:6] == "00" or value[7:] == "0000")


def _country(digits: str) -> int:
    """How many of the digits after a plus are the country code."""
    return 1 if digits[0] in _CODES else 2 if digits[:2] in _CODES else 3


def pseudonym(kind: str, value: str, key: str, back: bool = False) -> str | None:
    """The pseudonym, or the value of one with ``back``; None for what is not valid."""
    key = f"{key}|{kind}"
    digits = [p for p, c in enumerate(value) if c.isdigit()]
    if kind == "email":
        if value.index("@") > MAX_LOCAL:
            return None
        return _signs(value, key, back, [p for p, c in enumerate(value[: value.index("@")]) if c.isalnum()])
    if kind == "phone":
        if not 7 <= len(digits) <= 15:
            return None
        skip = _country("".join(value[p] for p in digits)) if value.startswith("+") else 0
        return _signs(value, key, back, digits[skip:])
    if kind == "ssn":
        if not _valid_ssn(value):
            return None
        value = _signs(value, key, back, digits)
        while not _valid_ssn(value):
            value = _signs(value, key, back, digits)
        return value
    if kind == "card":
        plain = "".join(value[p] for p in digits)
        if luhn(plain[:-1]) != int(plain[-1]):
            return None
        out = _signs(value, key, back, digits[:-1])
        return out[: digits[-1]] + str(luhn("".join(out[p] for p in digits[:-1])))
    if kind == "iban":
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
            return None
        body = [p for p, c in enumerate(value) if c != " "][4:]
        out = _signs(value, key, back, body)
        check = 98 - _mod97(out[:2] + "00" + out[4:].replace(" ", ""))
        return f"{out[:2]}{check:02d}{out[4:]}"
    if kind == "ipv4":
        parts = value.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        x = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, back)
        return ".".join(map(str, x.to_bytes(4, "big")))
    return _date(value, key, back)


def _quick(text: str) -> bool:
    return "@" in text or any(d in text for d in "0123456789")


def replace(text: str | None, key: str, back: bool = False) -> tuple[str | None, list[int]]:
    """Text with pseudonyms, and how many of each kind."""
    counts = [0] * len(KINDS)
    if not text or not _quick(text):
        return text, counts
    out, at, done = [], 0, 0
    while (m := ANY.search(text, at)) is not None:
        kind, value = m.lastgroup, m[0]
        new = pseudonym(kind, value, key, back)
        if new is None:
            # not valid as this kind: another kind may still fit at the same place
            for other in KINDS[KINDS.index(kind) + 1 :]:
                if (again := re.compile(_PATTERNS[other]).match(text, m.start())) and (new := pseudonym(other, again[0], key, back)) is not None:
                    kind, m = other, again
                    break
        if new is None:
            at = m.start() + 1
            continue
        out += [text[done : m.start()], new]
        counts[KINDS.index(kind)] += 1
        at = done = m.end()
    return "".join([*out, text[done:]]), counts


def pseudonymise(docs: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the text's personal data replaced, and a count n_<kind> of each kind."""
    schema = docs.schema
    place = [f.name for f in schema].index(text)
    counts = [f"n_{k}" for k in KINDS]
    rows, kind = with_columns(docs, {c: T.IntegerType() for c in counts})
    names = kind.names

    def run(batches):
        for b in batches:
            new, found = [], [[] for _ in KINDS]
            for t in b.column(place):
                t, n = replace(t.as_py(), key, back)
                new.append(t)
                for k, x in enumerate(n):
                    found[k].append(x)
            columns = list(b.columns)
            columns[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.int32()) for x in found]], names)

    return rows.mapInArrow(run, kind).toDF(*schema.names, *counts)
