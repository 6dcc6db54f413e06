"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

A value is read as a number in the set of all values of its format, permuted
within that set by a Feistel network, and written back in the same format.
The permutation depends on the key, the kind and the format only, so equal
values get equal pseudonyms in every document, distinct ones stay distinct,
and the key's holder can go back (``Pseudonymizer.restore``).

Only validated values change: card numbers by Luhn digit, IBANs by their
check digits (both stay valid), dates by calendar, IPv4 octets, social
security numbers by area and group, telephone numbers by length.  Besides
numbers and dates, mail names and labelled secrets are permuted character by
character class.  Other text is returned as it is.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import small_batches

ROUNDS = 8
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()

KINDS = {
    "secret": r"(?<![A-Za-z0-9])(?:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key)\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9_+/-]{8,})",
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]+(?:\.[A-Za-z0-9_%+-]+)*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}(?P<mark>[./])\d{1,2}(?P=mark)\d{4})(?:(?=T\d\d)|(?![\w/-]|\.\d))",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)"}
PATTERN = re.compile("|".join(f"(?P<{k}>{x})" for k, x in KINDS.items()), re.IGNORECASE)
ALONE = {k: re.compile(x, re.IGNORECASE) for k, x in KINDS.items()}
#: Lengths of a country's IBANs; those of others are found by the check digits alone.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15,
    "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26}
#: Digits after the country code, where all numbers of a country have as many.
PHONE_LENGTHS = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "44": 10, "45": 8, "47": 8, "48": 9, "61": 9, "91": 10, "351": 9, "420": 9}
OTHER_SHAPES = re.compile(r"(?<![\w+-])(?:\d{3}-\d{3}-\d{4}|\d{3}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2})(?![\w-])")
CARD_SHAPES = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5}")
HINT = re.compile(r"[0-9@]|[=:]\s*[\"']?[A-Za-z0-9_+/-]{8}")


class Found(NamedTuple):
    kind: str
    start: int
    end: int
    pseudonym: str


def luhn_digit(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def iban_rest(text: str) -> int:
    """The IBAN's number modulo 97; 1 when it is valid."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonymizer:
    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, n: int, kind: str, half: int, right: int) -> int:
        data = f"{n}/{kind}/".encode() + right.to_bytes((half + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=(half + 7) // 8 or 1).digest(), "big") & ((1 << half) - 1)

    def permute(self, value: int, size: int, kind: str, back: bool = False) -> int:
        """``value`` in [0, size) under the permutation of ``kind``: a balanced
        Feistel network over the next even number of bits, walked along its
        cycle until the result is in range again."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            left, right = value >> half, value & ((1 << half) - 1)
            for n in range(ROUNDS):
                if back:
                    left, right = right ^ self._round(ROUNDS - 1 - n, kind, half, left), left
                else:
                    left, right = right, left ^ self._round(n, kind, half, right)
            value = left << half | right
            if value < size:
                return value

    def characters(self, text: str, kind: str, back: bool = False) -> str:
        """Digits stay digits, letters letters of their case; the rest stays."""
        value, size, shape = 0, 1, []
        for c in text:
            if "0" <= c <= "9":
                value, size = value * 10 + ord(c) - 48, size * 10
                shape.append("0")
            elif "a" <= (low := c.lower()) <= "z":
                value, size = value * 26 + ord(low) - 97, size * 26
                shape.append("a")
            else:
                shape.append(c)
        value = self.permute(value, size, f"{kind}:{''.join(shape)}", back) if size > 1 else 0
        out = []
        for c, s in zip(reversed(text), reversed(shape), strict=True):
            if s == "0" and "0" <= c <= "9":
                value, d = divmod(value, 10)
                out.append(chr(48 + d))
            elif s == "a" and c.isalpha():
                value, d = divmod(value, 26)
                out.append(chr((97 if c.islower() else 65) + d))
            else:
                out.append(c)
        return "".join(reversed(out))

    def digits(self, text: str, kind: str, back: bool = False) -> str:
        """Permutes the digits of ``text`` as one number; what stands between them stays."""
        own = "".join(c for c in text if c.isdigit())
        new = iter(f"{self.permute(int(own), 10 ** len(own), f'{kind}:{len(own)}', back):0{len(own)}d}")
        return "".join(next(new) if c.isdigit() else c for c in text)

    def card(self, text: str, back: bool = False) -> str | None:
        own = "".join(c for c in text if c.isdigit())
        if luhn_digit(own[:-1]) != int(own[-1]) or len(set(own)) == 1:
            return None
        body = self.digits(own[:-1], "card", back)
        new = iter(body + str(luhn_digit(body)))
        return "".join(next(new) if c.isdigit() else c for c in text)

    def iban(self, text: str, back: bool = False) -> str | None:
        own = text.replace(" ", "").upper()
        if not 15 <= len(own) <= 34 or iban_rest(own) != 1:
            return None
        body = self.characters(own[4:], "iban" + own[:2], back)
        new = iter(f"{own[:2]}{98 - iban_rest(own[:2] + '00' + body):02d}{body}")
        return "".join(c if c == " " else next(new) for c in text)

    def ip(self, text: str, back: bool = False) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        value = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def date(self, text: str, back: bool = False) -> str | None:
        """Dates of 1900 to 2099; one day has one pseudonym in all formats.
        With dots the day comes first; with slashes the day where it can, else the month."""
        if "-" in text:
            orders, parts = [(0, 1, 2)], text.split("-")
        else:
            parts = re.split(r"[./]", text)
            orders = [(2, 1, 0)] if "." in text else [(2, 1, 0), (2, 0, 1)]
        for order in orders:
            y, m, d = (int(parts[i]) for i in order)
            try:
                day = datetime.date(y, m, d).toordinal() - FIRST_DAY
            except ValueError:
                continue
            if 0 <= day < DAYS:
                new = datetime.date.fromordinal(FIRST_DAY + self.permute(day, DAYS, "date", back))
                if order == (2, 0, 1):  # stays readable as month first only
                    while new.day <= 12:
                        new = datetime.date.fromordinal(FIRST_DAY + self.permute(new.toordinal() - FIRST_DAY, DAYS, "date", back))
                out = [""] * 3
                for i, v in zip(order, (new.year, new.month, new.day), strict=True):
                    out[i] = f"{v:02d}"
                return ("-" if "-" in text else text[len(parts[0])]).join(out)
        return None

    def ssn(self, text: str, back: bool = False) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        value = self.permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn", back)
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, text: str, back: bool = False) -> str | None:
        """The country code stays."""
        if not 8 <= sum(c.isdigit() for c in text) <= 15:
            return None
        code = m.end() if (m := re.match(r"\+\d{1,3}(?=[ .(-])|\+", text)) else 0
        return text[:code] + self.digits(text[code:], "phone", back)

    def email(self, text: str, back: bool = False) -> str:
        """The name before the @; the mail host stays and is part of the format."""
        name, _, host = text.rpartition("@")
        return self.characters(name, f"email@{host.lower()}", back) + "@" + host

    def key_id(self, text: str, back: bool = False) -> str:
        return text[:4] + self.characters(text[4:], "key", back)

    def readings(self, kind: str, text: str, after: str = "") -> Iterator[str]:
        """What of a match may be the value, as the words or numbers after it may
        have been taken for its end: all of it, and shorter beginnings that end at
        a separator.  The likeliest comes first."""
        ends = [m.start() for m in re.finditer(r"[ .-]+", text)] + [len(text)]
        if kind == "iban":
            size = IBAN_LENGTHS.get(text[:2].upper())
            yield from (text[:e] for e in reversed(ends) if size is None or len(text[:e].replace(" ", "")) == size)
        elif kind == "card":
            sized = [text[:e] for e in ends if 13 <= sum(c.isdigit() for c in text[:e]) <= 19]
            usual = [x for x in sized if CARD_SHAPES.fullmatch(x)]
            yield from usual
            # digits before a card in a usual shape are no part of it, nor are other values
            run = re.match(r"\d(?:[ -]?\d)*", text + after)[0]
            cuts = [m.start() for m in re.finditer(r"[ -]", run)]
            if not OTHER_SHAPES.search(text) and not any(CARD_SHAPES.fullmatch(x) and self.card(x) for a in cuts for e in [*cuts, len(run)] if (x := run[a + 1:e])):
                yield from (x for x in reversed(sized) if x not in usual)
        elif kind == "phone":
            yield from sorted((text[:e] for e in ends), key=lambda x: (not self._whole_phone(x, text), -len(x)))
        else:
            yield text

    @staticmethod
    def _whole_phone(number: str, text: str) -> bool:
        """Whether ``number``, a beginning of ``text``, needs nothing of the rest: it
        has its country's length, or the rest follows a blank after ten digits
        and more that end in a part of seven, or that are joined by other marks."""
        digits = "".join(c for c in number if c.isdigit())
        if not number.startswith("+") or len(number) == len(text):
            return False
        if any(digits.startswith(c) and len(digits) == len(c) + n for c, n in PHONE_LENGTHS.items()):
            return True
        return text[len(number)] == " " and 10 <= len(digits) <= 15 and bool(re.search(r"\d{7}$|\d[.-]\d+$", number))

    def find(self, text: str, back: bool = False) -> Iterator[Found]:
        """All validated values of ``text``, from left to right."""
        kinds: dict[str, Callable[[str, bool], str | None]] = {
            "key": self.key_id, "email": self.email, "iban": self.iban, "ip": self.ip, "date": self.date,
            "ssn": self.ssn, "card": self.card, "phone": self.phone}
        if not HINT.search(text):
            return
        at = 0
        while m := PATTERN.search(text, at):
            if m["secret"] is not None:
                yield Found("secret", m.start("value"), m.end(), self.characters(m["value"], "secret", back))
                at = m.end()
                continue
            for kind, read in kinds.items():
                own = m[kind] and m or ALONE[kind].match(text, m.start())
                found = own and next(((x, new) for x in self.readings(kind, own[0], text[own.end():own.end() + 24]) if (new := read(x, back)) is not None), None)
                if found:
                    at = m.start() + len(found[0])
                    yield Found(kind, m.start(), at, found[1])
                    break
            else:  # not valid: what follows its first run of digits or letters is looked at again
                at = max(m.start() + 1, re.compile(r"\+?\w*").match(text, m.start()).end())

    def replace(self, text: str, back: bool = False) -> tuple[str, list[Found]]:
        found = list(self.find(text, back))
        out, at = [], 0
        for f in found:
            out += [text[at:f.start], f.pseudonym]
            at = f.end
        return "".join(out) + text[at:], found

    def restore(self, text: str) -> str:
        """The text before ``replace``, by the same key.  Days and months come back
        with two digits, and dates written month first are not restored."""
        return self.replace(text, back=True)[0]


#: The spans are those of the text as it was; pseudonyms of a date or address may differ in length.
REPLACED = "text string, found array<struct<kind: string, start: int, end: int>>"


def pseudonymize(text: Column, key: bytes) -> Column:
    """Struct of the text with all values replaced, and the places found.  A null
    text stays null with no places; an empty one stays empty."""

    @F.arrow_udf(REPLACED)
    def run(texts: pa.Array) -> pa.Array:
        own = Pseudonymizer(key)
        out = [(None, []) if t is None else own.replace(t) for t in texts.to_pylist()]
        found = [[{"kind": f.kind, "start": f.start, "end": f.end} for f in x] for _, x in out]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array([t for t, _ in out], pa.string()), pa.array(found, kind)], names=["text", "found"])

    return run(text)


def pseudonymize_documents(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` replaced; every row and all other columns stay."""
    small_batches(docs.sparkSession)
    changed = pseudonymize(F.col(f"`{text_col}`"), key).getField("text")
    return docs.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def pii_table(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, pseudonymised text, n_found, and the kinds and places found."""
    small_batches(docs.sparkSession)
    return (docs.select(F.col(id_col), pseudonymize(F.col(text_col), key).alias("p"))
            .select(id_col, F.col("p.text").alias("text"), F.size("p.found").alias("n_found"), F.col("p.found").alias("found")))
