"""Format-preserving pseudonyms for personal data in texts.

Values are found by pattern and then validated (check digits, octet ranges,
calendar dates, phone lengths). A valid value is permuted by a keyed Feistel
network within the set of values of its own format, so the result is valid
again, the same value gets the same pseudonym in every document, and different
values never share one. The digits of a number are permuted together whatever
its punctuation, so a card with and without blanks stays linked.

=============  ======================================================================
kind           what is permuted
=============  ======================================================================
card           12 to 18 digits before the Luhn check digit, which is computed anew
iban           digits and letters after the country, then the check digits anew
phone          digits after the country code or a leading zero; at least 9 digits in all
ip             the 32 bits of a dotted IPv4 address
ssn            the nine digits of ddd-dd-dddd
date           the day within years 1900 to 2099, in ISO, slash or dotted order; dd/mm
               only where mm/dd is impossible, and then among days after the twelfth
email          letters and digits of the mailbox and of each domain label but the last
secret         runs of 16 and more with letters and digits after a word like token or key,
               and access keys by their public prefixes, which stay
=============  ======================================================================

Defined results: null stays null; texts without valid values keep every byte;
overlapping matches go to the kind listed first at the leftmost place, but a phone
never takes digits of a valid card. After a match that is not valid the search
goes on one character further. Digits long enough for a card that are none hold
a phone only if it starts with a zero. Matching takes time in proportion to the
text: every repetition in a pattern is bounded.
"""

from __future__ import annotations

import datetime as dt
import hmac
import re
import string
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 8
LONGEST_BLOCK = 128  # characters permuted together; half of them fit in one digest
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()

PATTERN = re.compile(r"""
    (?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9]))
  | (?P<secret>(?<![A-Za-z0-9])(?i:api[_-]?key|access[_-]?key|secret|token|password|passwd|key)["']?\s{0,3}[:=]\s{0,3}["']?(?P<value>[A-Za-z0-9_+/-]{16,}))
  | (?P<access>(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<iso>(?<![\w.-])\d{4}-\d{2}-\d{2}(?![\w-]))
  | (?P<slash>(?<![\w/.-])\d{1,2}/\d{1,2}/\d{4}(?![\w/]))
  | (?P<dotted>(?<![\w.])\d{1,2}\.\d{1,2}\.\d{4}(?![\w]))
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<card>(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-]))
  | (?P<phone>(?<![\w.-])(?:(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)|\d{2,4})[\x20.-]?\d{3,4}[\x20.-]?\d{3,4}
              |(?:\+\d{1,3}[\x20.-]?(?:\(\d{1,4}\)|\d{1,4})|\(0\d{1,3}\)|0\d{1,3})(?:[\x20.-]?\d{2,4}){2,3}(?:[\x20.-]?\d{2}){1,2})(?![\w-]))
""", re.VERBOSE | re.ASCII)
CARD = re.compile(r"\d(?:[\x20-]?\d){12,18}(?![\w-])", re.ASCII)
PHONE = re.compile(PATTERN.pattern[PATTERN.pattern.index("(?P<phone>"):], re.VERBOSE | re.ASCII)
# Characters of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}
REPORTED = {"iso": "date", "slash": "date", "dotted": "date", "access": "secret"}
_MAY_MATCH = re.compile(r"[0-9@]")
LATE_DAYS = [d for d in range(DAYS) if dt.date.fromordinal(FIRST_DAY + d).day > 12]


class Feistel:
    """Keyed permutation of the whole numbers below any size, by cycle walking over a balanced Feistel network."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: bytes, number: int, half: int, bits: int) -> int:
        message = tweak + bytes([number]) + half.to_bytes((bits + 7) // 8, "big")
        return int.from_bytes(hmac.digest(self.key, message, "sha512"), "big") & ((1 << bits) - 1)

    def permute(self, value: int, size: int, tweak: str, inverse: bool = False) -> int:
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        label = f"{tweak}:{size}:".encode()
        while True:
            left, right = value >> bits, value & ((1 << bits) - 1)
            if inverse:
                for k in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(label, k, left, bits), left
            else:
                for k in range(ROUNDS):
                    left, right = right, left ^ self._round(label, k, right, bits)
            value = left << bits | right
            if value < size:
                return value

    def digits(self, text: str, tweak: str, inverse: bool = False) -> str:
        return str(self.permute(int(text), 10 ** len(text), tweak, inverse)).zfill(len(text))

    def symbols(self, text: str, tweak: str, inverse: bool = False) -> str:
        """Each letter and digit stays of its kind and case; all are permuted together.

        Long texts go in stretches, each tweaked by the pseudonym of the one before.
        """
        if len(text) > LONGEST_BLOCK:
            out, before = [], ""
            for start in range(0, len(text), LONGEST_BLOCK):
                stretch = text[start:start + LONGEST_BLOCK]
                out.append(self.symbols(stretch, f"{tweak}+{before}", inverse))
                before = stretch if inverse else out[-1]
            return "".join(out)
        sets = [next((s for s in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in s), None) for c in text]
        value, size = 0, 1
        for c, s in zip(text, sets):
            if s:
                value, size = value * len(s) + s.index(c), size * len(s)
        # The shape is part of the tweak, so values of different shapes use different permutations.
        shape = "".join("." if s is None else s[0] for s in sets)
        value = self.permute(value, size, f"{tweak}:{shape}", inverse) if size > 1 else 0
        out = list(text)
        for at in reversed(range(len(text))):
            if sets[at]:
                value, rest = divmod(value, len(sets[at]))
                out[at] = sets[at][rest]
        return "".join(out)


def luhn_digit(digits: str) -> str:
    total = 0
    for at, c in enumerate(reversed(digits)):
        d = int(c) * (2 if at % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def luhn_valid(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in f"{rest}{country}00"))
    return f"{98 - number % 97:02d}"


def _refill(shape: str, symbols: str) -> str:
    """Letters and digits of ``shape`` replaced in order."""
    source = iter(symbols)
    return "".join(next(source) if c.isalnum() else c for c in shape)


def _bare(text: str) -> str:
    return "".join(c for c in text if c.isalnum())


class Pseudonyms:
    """Finds, validates and permutes; ``inverse`` turns pseudonyms back with the same key."""

    def __init__(self, key: str, inverse: bool = False):
        self.feistel, self.inverse = Feistel(key.encode()), inverse
        self.makers: dict[str, Callable[[str], str | None]] = {
            "email": self.email, "iban": self.iban, "ip": self.ip, "ssn": self.ssn, "card": self.card,
            "access": self.access, "phone": self.phone, "iso": self.iso, "slash": self.slash, "dotted": self.dotted}
        self.known = lru_cache(maxsize=100_000)(self._known)

    def _known(self, kind: str, text: str) -> str | None:
        return self.makers[kind](text)

    def card(self, text: str) -> str | None:
        digits = _bare(text)
        if not 13 <= len(digits) <= 19 or not luhn_valid(digits) or len(set(digits)) == 1:
            return None
        body = self.feistel.digits(digits[:-1], "card", self.inverse)
        return _refill(text, body + luhn_digit(body))

    def _card_ahead(self, text: str, first: int, last: int) -> tuple[int, int] | None:
        """The first valid card that starts with a group of digits in the stretch and ends with a group, the longest there."""
        for group in re.finditer(r"\d+", text[first:last]):
            start = first + group.start()
            match = CARD.match(text, start)
            if not match:
                continue
            ends = [start + m.end() for m in re.finditer(r"\d+", match[0]) if m.end() >= 13]
            for end in reversed(ends):
                if self.known("card", text[start:end]):
                    return start, end
        return None

    def _iban_end(self, text: str) -> int:
        """Where the IBAN at the start of the match ends: at its country's length, or the last place with valid check digits."""
        ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", text)]
        length = IBAN_LENGTHS.get(text[:2])
        ends.sort(key=lambda e: (len(_bare(text[:e])) != length, -e))
        return next((e for e in ends if self.known("iban", text[:e])), len(text))

    def iban(self, text: str) -> str | None:
        bare = _bare(text)
        country, check, rest = bare[:2], bare[2:4], bare[4:]
        if not 11 <= len(rest) <= 30 or iban_check(country, rest) != check:
            return None
        rest = self.feistel.symbols(rest, f"iban{country}", self.inverse)
        return _refill(text, country + iban_check(country, rest) + rest)

    def phone(self, text: str) -> str | None:
        digits = _bare(text)
        if not 9 <= len(digits) <= 15 or digits == text:
            return None
        country = _bare(re.match(r"\+\d{1,3}(?=[\x20.(-])|", text)[0])
        if text[0] == "+":
            return _refill(text, country + self.feistel.digits(digits[len(country):], f"phone{country}", self.inverse))
        # A leading zero stays, and none appears: numbers in pairs are known by it.
        if digits[0] == "0":
            return _refill(text, "0" + self.feistel.digits(digits[1:], "phone0", self.inverse))
        least = 10 ** (len(digits) - 1)
        return _refill(text, str(least + self.feistel.permute(int(digits) - least, 9 * least, "phone", self.inverse)))

    def ip(self, text: str) -> str | None:
        octets = text.split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in octets):
            return None
        value = int.from_bytes(bytes(map(int, octets)), "big")
        return ".".join(map(str, self.feistel.permute(value, 1 << 32, "ip", self.inverse).to_bytes(4, "big")))

    def ssn(self, text: str) -> str | None:
        return _refill(text, self.feistel.digits(_bare(text), "ssn", self.inverse))

    def _day(self, year: str, month: str, day: str, among: list[int] | range = range(DAYS)) -> dt.date | None:
        try:
            at = dt.date(int(year), int(month), int(day)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= at < DAYS:
            return None
        place = at if among == range(DAYS) else bisect_left(among, at)
        return dt.date.fromordinal(among[self.feistel.permute(place, len(among), "date", self.inverse)] + FIRST_DAY)

    def iso(self, text: str) -> str | None:
        day = self._day(*text.split("-"))
        return day and day.isoformat()

    def slash(self, text: str) -> str | None:
        first, second, year = text.split("/")
        late = int(first) > 12
        day = self._day(year, second, first, LATE_DAYS) if late else self._day(year, first, second)
        return day and (f"{day:%d/%m/}" if late else f"{day:%m/%d/}") + f"{day.year:04d}"

    def dotted(self, text: str) -> str | None:
        day, month, year = text.split(".")
        new = self._day(year, month, day)
        return new and f"{new:%d.%m.%Y}"

    def email(self, text: str) -> str | None:
        name, _, domain = text.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{self.feistel.symbols(name, 'mailbox', self.inverse)}@{self.feistel.symbols(host, 'domain', self.inverse)}.{top}"

    def secret(self, value: str) -> str | None:
        kinds = (any(c.isdigit() for c in value), any(c.isalpha() for c in value))
        return self.feistel.symbols(value, "secret", self.inverse) if all(kinds) else None

    def access(self, text: str) -> str | None:
        start = 4 if text[:4] in ("AKIA", "ASIA") else re.search(r"[_-]", text).end()
        return text[:start] + self.feistel.symbols(text[start:], f"access{text[:start]}", self.inverse)

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with its pseudonyms, and (kind, start, end) of each in the new text."""
        out, found, last, size, at = [], [], 0, 0, 0
        if not _MAY_MATCH.search(text):
            return text, found
        # A valid card ahead, the end of digits that are no card, and up to where no other card starts.
        limit, card, run_end, searched = len(text), None, 0, 0
        while (match := PATTERN.search(text, at, limit)) or card:
            if not match:
                kind, (start, end), limit, card = "card", card, len(text), None
                searched = end
                new = self.known(kind, text[start:end])
            else:
                kind = match.lastgroup if match.lastgroup != "value" else "secret"
                kind = "secret" if match["secret"] else kind
                start, end = match.span("value") if kind == "secret" else match.span()
                if kind in ("card", "phone") and not card:
                    card, searched = self._card_ahead(text, max(start, searched), end), max(searched, end)
                    if card:
                        at, limit, run_end = start, card[0], max(run_end, end)
                        continue
                if kind == "card":
                    # Digits that are no card are a phone only by their leading zero.
                    run_end, match = max(run_end, end), PHONE.match(text, start, limit)
                    kind, end = "phone", match.end() if match else start
                if kind == "iban":
                    end = start + self._iban_end(match[0])
                new = self.secret(match["value"]) if kind == "secret" else self.known(kind, text[start:end])
                if kind == "phone" and start < run_end and text[start] not in "0(+":
                    new = None
                if new is None:
                    at = start if kind == "secret" else start + 1
                    continue
            out += [text[last:start], new]
            size += start - last
            found.append((REPORTED.get(kind, kind), size, size + len(new)))
            size, last, at = size + len(new), end, end
        out.append(text[last:])
        return "".join(out), found


FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str | None = None,
                 inverse: bool = False) -> DataFrame:
    """All rows and columns with personal data replaced in the text.

    With ``found_col`` a column is added (or replaced) that lists kind and place
    of every pseudonym. Each row is handled alone: nothing is shuffled.
    """
    if found_col:
        docs = docs.withColumn(found_col, F.lit(None).cast(FOUND))
    schema = docs.schema
    at, listed = schema.names.index(text_col), schema.names.index(found_col) if found_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, inverse)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                results = [(None, []) if t is None else names.replace(t) for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array([r[0] for r in results], part.schema.field(at).type)
                if found_col:
                    columns[listed] = pa.array([[dict(zip(("kind", "start", "end"), f)) for f in r[1]] for r in results], _FOUND)
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)
