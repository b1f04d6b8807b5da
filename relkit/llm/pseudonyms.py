"""Format-preserving pseudonyms for personal values in texts.

Values are found by their form and kept only if valid: card numbers by
their check digit, dates by the calendar, phone numbers, network addresses
and social security numbers by their ranges, bank accounts by their check
digits; mail addresses too.  A value's free characters are permuted within their
format by a keyed Feistel network, so the pseudonym looks and validates
like the value, equal values get equal pseudonyms in all documents, and
the key turns them back.  No table of values is kept, and documents are
processed on their own.

A Feistel network permutes the numbers 0..n-1: the number is split in two
digits of mixed radix a * b >= n; every round adds a keyed hash of one
digit to the other; results of n or more are permuted again until one lies
below n (cycle walking).

A match that is not valid gives way to shorter ends at the same start, to
the other kinds there, and then to matches that start later; cards come
last, as the other forms tell more.  A card that ends before its match
does, or follows another number, holds groups of three digits or more, but for the last.  A card's
pseudonym has the same sum at shifted places as the card, so digits that
stand after it make a longer number valid on both ways or on neither.
Where such digits are themselves part of another value, or the number
before a card joins it, the way back can read another card by chance.

Defined results: a null text stays null and counts no value; texts without
valid values stay as they are.  A null id is carried along; repeated rows
give repeated results; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import slices

ROUNDS = 8
KEY = b"corpus-key-1"

# Forms of the values.  The longest forms come first; a
# number that is part of a longer run of digits is not a value.
FORMS = (
    ("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])"),
    ("iban", r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    ("card", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w|[.-]\d)"),
    ("ssn", r"(?<![\w.-])\d{3}-\d{2}-\d{4}(?!\w|[.-]\d)"),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?!\w|[./-]\d)"),
    ("ip", r"(?<![\w.-])\d{1,3}(?:\.\d{1,3}){3}(?!\w|[.-]\d)"),
    ("phone", r"(?<![\w.-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,12}"
              r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w|[.-]\d)"),
)
KINDS = tuple(kind for kind, _ in FORMS)
_ANY = re.compile("|".join(f"(?P<{kind}>{form})" for kind, form in FORMS), re.ASCII)
_ONE = {kind: re.compile(form, re.ASCII) for kind, form in FORMS}
_TAIL = {kind: re.compile(form[form.rindex("(?!"):], re.ASCII) for kind, form in FORMS}     # what may follow a value
_ORDER = (*(kind for kind in KINDS if kind != "card"), "card")
_JOINED = re.compile(r"\d[ -]", re.ASCII)
_CARD_GROUPS = re.compile(r"(?:\d{3,}[ -])*\d+", re.ASCII)
# Characters of an account number, by country.
_IBAN_CHARS = {country: n for n, own in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in own.split()}
_HINT = re.compile("[0-9@]")             # every form holds one of them
_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutations of 0..n-1, one for each n and tweak."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = key, rounds

    def _add(self, tweak: str, n: int, r: int, x: int, m: int) -> int:
        said = f"{tweak}|{n}|{r}|{x}".encode()
        return int.from_bytes(hmac.digest(self.key, said, hashlib.sha256), "big") % m

    def apply(self, n: int, x: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            u, v = divmod(x, b)                       # u < a, v < b
            order = range(self.rounds)
            for r in reversed(order) if back else order:
                sign = -1 if back else 1
                if r % 2:
                    v = (v + sign * self._add(tweak, n, r, u, b)) % b
                else:
                    u = (u + sign * self._add(tweak, n, r, v, a)) % a
            x = u * b + v
            if x < n:
                return x


def check_digit(digits: str) -> str:
    """The digit that makes a card number valid when appended."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _shifted_sum(digits: str) -> int:
    """The last digit of the check sum of a card number with one more digit
    after it."""
    return int(check_digit(digits))


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _filled(form: str, digits: str) -> str:
    """``form`` with its digits replaced one by one."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def _permuted(f: Feistel, digits: str, tweak: str, back: bool) -> str:
    n = 10 ** len(digits)
    return str(f.apply(n, int(digits), tweak, back)).zfill(len(digits))


def _email(f: Feistel, value: str, back: bool) -> str | None:
    """Letters and digits of the part before the at sign, each within its
    own kind; the domain stays."""
    local, _, domain = value.partition("@")
    kinds = [("a", 26) if c.islower() else ("A", 26) if c.isupper() else ("0", 10) if c.isdigit() else None for c in local]
    n, x = 1, 0
    for c, kind in zip(local, kinds):
        if kind:
            n, x = n * kind[1], x * kind[1] + ord(c) - ord(kind[0])
    shape = "".join(k[0] if k else c for c, k in zip(local, kinds))
    x = f.apply(n, x, f"email|{shape}|{domain.lower()}", back)
    out = []
    for c, kind in zip(reversed(local), reversed(kinds)):
        if kind:
            x, d = divmod(x, kind[1])
            c = chr(ord(kind[0]) + d)
        out.append(c)
    return "".join(reversed(out)) + "@" + domain


def _card(f: Feistel, value: str, back: bool) -> str | None:
    digits = re.sub(r"\D", "", value)
    if not 13 <= len(digits) <= 19 or check_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = digits[:-1]
    while True:
        body = digits[0] + _permuted(f, body[1:], f"card|{digits[0]}", back)
        new = body + check_digit(body)
        if _shifted_sum(new) == _shifted_sum(digits) and len(set(new)) > 1:
            return _filled(value, new)


def _date(f: Feistel, value: str, back: bool) -> str | None:
    parts = re.split(r"[-/.]", value)
    # year first; day first with points; with slashes month first if that is a date
    orders = [(0, 1, 2)] if "-" in value else [(2, 1, 0)] if "." in value else [(2, 0, 1), (2, 1, 0)]
    for y, m, d in orders:
        try:
            day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d])).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return None
        # Only days that the form writes in the same way are permuted among
        # each other, so the way back reads the same date.
        def written(n: int) -> str:
            x = datetime.date.fromordinal(n)
            own = ["", "", ""]
            own[y], own[m], own[d] = f"{x.year:04}", f"{x.month:02}", f"{x.day:02}"
            sep = "-" if "-" in value else "." if "." in value else "/"
            return sep.join(own[k] if len(parts[k]) > 1 else own[k].lstrip("0") for k in range(3))

        def fits(n: int) -> bool:
            text = written(n)
            if [len(p) for p in re.split(r"[-/.]", text)] != [len(p) for p in parts]:
                return False
            if len(orders) == 2:                 # month first stays month first
                lead = int(re.split("/", text)[0])
                return (lead <= 12) == ((y, m, d) == orders[0])
            return True

        days = _LAST_DAY - _FIRST_DAY + 1
        shape = f"date|{'-'.join(str(len(p)) for p in parts)}|{y}{m}{d}"
        x = day - _FIRST_DAY
        while True:
            x = f.apply(days, x, shape, back)
            if fits(x + _FIRST_DAY):
                return written(x + _FIRST_DAY)
    return None


def _ip(f: Feistel, value: str, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = 0
    for p in parts:
        x = x * 256 + int(p)
    x = f.apply(1 << 32, x, "ip", back)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def _ssn(f: Feistel, value: str, back: bool) -> str | None:
    a, b, c = map(int, value.split("-"))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    areas = 898                                  # 001..899 without 666
    x = ((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1
    x = f.apply(areas * 99 * 9999, x, "ssn", back)
    x, c = divmod(x, 9999)
    a, b = divmod(x, 99)
    a += 1 + (a + 1 >= 666)
    return f"{a:03}-{b + 1:02}-{c + 1:04}"


def _iban(f: Feistel, value: str, back: bool) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return None
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if 98 - _iban_rest(country, body) != int(check):
        return None
    digits = "".join(c for c in body if c.isdigit())
    if not digits:
        return None
    shape = re.sub(r"\d", "0", body)
    body = _filled(body, _permuted(f, digits, f"iban|{country}|{shape}", back))
    whole = iter(f"{country}{98 - _iban_rest(country, body):02}{body}")
    return "".join(c if c == " " else next(whole) for c in value)


def _phone(f: Feistel, value: str, back: bool) -> str | None:
    """The country code stays, and so does the first digit of the rest."""
    m = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", value)
    head = m.group() if m else ""
    rest = value[len(head):]
    digits = re.sub(r"\D", "", rest)
    if not 7 <= len(digits) + len(re.sub(r"\D", "", head)) <= 15 or len(digits) < 6:
        return None
    shape = re.sub(r"\d", "0", rest)
    own = digits[0] + _permuted(f, digits[1:], f"phone|{head}|{digits[0]}|{shape}", back)
    return head + _filled(rest, own)


_BY_KIND: dict[str, Callable[[Feistel, str, bool], str | None]] = {
    "email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip, "phone": _phone}


def _ends(kind: str, text: str, start: int, end: int) -> Iterator[int]:
    """Ends of a value of a kind that starts at ``start``, from the longest
    match's down; for account numbers first the one of the country's
    length."""
    ends = [end, *(e for e in range(end - 1, start, -1)
                   if _TAIL[kind].match(text, e) and _ONE[kind].fullmatch(text, start, e))]
    if kind == "card":
        inside = _JOINED.match(text, max(0, start - 2), start)
        ends = [e for e in ends if (e == end and not inside) or _CARD_GROUPS.fullmatch(text, start, e)]
    if kind == "iban":
        own = _IBAN_CHARS.get(text[start:start + 2])
        ends.sort(key=lambda e: e - start - text.count(" ", start, e) != own)
    yield from ends


class Pseudonymiser:
    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS):
        self.feistel, self.kinds = Feistel(key), frozenset(kinds)
        self.of = lru_cache(100_000)(self._of)

    def _of(self, kind: str, value: str, back: bool) -> str | None:
        return _BY_KIND[kind](self.feistel, value, back)

    def _value(self, text: str, start: int, back: bool) -> tuple[int, int, str | None, str | None]:
        """The valid value at a place, as (start, end, kind, its
        pseudonym); if there is none, the next place to search from is the
        end."""
        for kind in _ORDER:
            m = _ONE[kind].match(text, start)
            for end in _ends(kind, text, start, m.end()) if m else ():
                new = self.of(kind, text[start:end], back)
                if new is not None:
                    return start, end, kind, new
        return start, start + 1, None, None

    def text(self, text: str, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and where the values stood in the
        given text: start, end and kind."""
        found: list[tuple[int, int, str]] = []
        if not _HINT.search(text):
            return text, found

        out, done, m = [], 0, _ANY.search(text)
        while m:
            start, end, kind, new = self._value(text, m.start(), back)
            if kind in self.kinds:
                out += [text[done:start], new]
                done = end
                found.append((start, end, kind))
            m = _ANY.search(text, end)
        return "".join([*out, text[done:]]), found


def _swapped(key: bytes, kinds: tuple[str, ...], back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonymiser(key, kinds)
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in slices(batches):
            texts, spans = [], []
            for text in batch.column("text").to_pylist():
                new, found = own.text(text, back) if text else (text, [])
                texts.append(new)
                spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string()),
                                              pa.array(spans, spans_type)], ["id", "text", "spans"])
    return run


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY,
                 kinds: tuple[str, ...] = KINDS, back: bool = False) -> DataFrame:
    """One row per document: id, text with pseudonyms, and spans (start,
    end, kind of each value in the given text).  ``back`` turns pseudonyms
    back into the values."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"id {own.schema['id'].dataType.simpleString()}, text string, "
              "spans array<struct<start: bigint, end: bigint, kind: string>>")
    return (own.mapInArrow(_swapped(key, tuple(kinds), back), schema)
               .withColumnRenamed("id", id_col).withColumnRenamed("text", text_col))
