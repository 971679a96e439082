"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation per format.

A finding is first validated (check digits, number ranges, calendar). Its digits, or its day, are
then a number in the set of all valid values of that format, and a keyed Feistel network permutes
that set: the pseudonym is valid in the same format and written in the same way. Equal values have
equal pseudonyms in all documents, whatever the separators, and the key's owner can undo them.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortml.llm.bpe import by_bytes
from cohortml.llm.common import worker_state


# ---------------------------------------------------------------- the permutation
class Feistel:
    """A keyed permutation of ``range(size)`` for every (kind, size).

    A generalised Feistel network on ``a * b >= size`` values (a, b near the square root); results
    outside the range walk on along their cycle until they fall inside.
    """

    def __init__(self, key: bytes, rounds: int = 10):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _round(self, kind, size, r, half, modulus):
        text = f"{kind}|{size}|{r}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big") % modulus

    def _sides(self, size):
        a = math.isqrt(size - 1) + 1
        return a, -(-size // a)

    def forward(self, kind: str, size: int, value: int) -> int:
        if size < 2:
            return value
        a, b = self._sides(size)
        while True:
            x, y = value % a, value // a
            for r in range(self.rounds):
                if r % 2:
                    y = (y + self._round(kind, size, r, x, b)) % b
                else:
                    x = (x + self._round(kind, size, r, y, a)) % a
            value = y * a + x
            if value < size:
                return value

    def backward(self, kind: str, size: int, value: int) -> int:
        if size < 2:
            return value
        a, b = self._sides(size)
        while True:
            x, y = value % a, value // a
            for r in reversed(range(self.rounds)):
                if r % 2:
                    y = (y - self._round(kind, size, r, x, b)) % b
                else:
                    x = (x - self._round(kind, size, r, y, a)) % a
            value = y * a + x
            if value < size:
                return value


# ---------------------------------------------------------------- formats
def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _refill(s: str, digits: str) -> str:
    """``s`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in s)


def luhn(payload: str) -> str:
    """The check digit of ``payload``."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(s, move):
    d = _digits(s)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    n = len(d) - 1
    new = str(move("card", 10 ** n, int(d[:-1]))).zfill(n)
    return _refill(s, new + luhn(new))


#: Calling codes begin with a code of one or two digits of this table; all others have three. No code begins with 0.
_CODES = frozenset("0 1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                   "81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(s, move):
    """The calling code stays, told by its digits alone; numbers written without one are North American.

    A first zero stays a zero and no other becomes one, so a trunk zero, ``+44 (0)20``, is no part of the number.
    """
    d = _digits(s)
    if not 7 <= len(d) <= 15:
        return None
    code = next((d[:k] for k in (1, 2) if d[:k] in _CODES), d[:3]) if s[0] == "+" else ""
    at = len(code)
    if code and re.match(rf"\+{code}[ .-]?\(0\)", s):
        at += 1
    zero = d[at] == "0"
    n = len(d) - at - zero
    low = 0 if zero else 10 ** (n - 1)
    kind = f"phone{code or 1}{'.0' if zero else ''}"
    return _refill(s, d[:at + zero] + str(low + move(kind, 10 ** n - low, int(d[at + zero:]) - low)).zfill(n))


def _address(s, move):
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = 0
    for p in parts:
        value = value << 8 | int(p)
    value = move("address", 1 << 32, value)
    return ".".join(str(value >> k & 255) for k in (24, 16, 8, 0))


def _ssn_rank(d):
    """Place among the valid numbers: area 1-665, 667-899, group 1-99, serial 1-9999."""
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1


def _ssn(s, move):
    rank = _ssn_rank(_digits(s))
    if rank is None:
        return None
    rank = move("ssn", 898 * 99 * 9999, rank)
    area = rank // (99 * 9999)
    area += 1 + (area >= 665)
    return _refill(s, f"{area:03d}{rank // 9999 % 99 + 1:02d}{rank % 9999 + 1:04d}")


def _iban_sum(s):
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _iban(s, move):
    flat = s.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_sum(flat) != 1:
        return None
    body = flat[4:]
    n = len(_digits(body))
    body = _refill(body, str(move(f"iban{flat[:2]}", 10 ** n, int(_digits(body)))).zfill(n)) if n else body
    flat = f"{flat[:2]}{98 - _iban_sum(flat[:2] + '00' + body):02d}{body}"
    it = iter(flat)
    return "".join(c if c == " " else next(it) for c in s)


def _date(s, move):
    """A day is permuted within its century, and with the days before or after the twelfth.

    So a day and a month never change places: ``02/28/1987`` can only be read in one way, and its
    pseudonym too. Days and months under 10 stay under 10, so ``3/7/1987`` and ``03/07/1987`` keep
    their digits and have the same pseudonym.
    """
    a, sep, b, _, c = re.split(r"([-/.])", s)
    first = len(a) == 4
    y, m, d = (int(a), int(b), int(c)) if first else (int(c), int(b), int(a))
    swapped = not first and m > 12
    if swapped:
        m, d = d, m

    def valid():
        try:
            return datetime.date(y, m, d)
        except ValueError:
            return None

    if not valid():
        return None
    begin = y // 100 * 100
    low, days = (13, 19) if d > 12 else (10, 3) if d > 9 else (1, 9)
    early, months = (10, 3) if m > 9 else (1, 9)
    value, kind = ((y - begin) * months + m - early) * days + d - low, f"date{begin}.{low}.{early}"
    while True:  # walks on over days that do not exist
        value = move(kind, 100 * months * days, value)
        y, m, d = begin + value // days // months, value // days % months + early, value % days + low
        if valid():
            break
    parts = (y, m, d) if first else (m, d, y) if swapped else (d, m, y)
    return sep.join(str(v).zfill(len(old)) for v, old in zip(parts, (a, b, c), strict=True))


def _email(s, move):
    """Letters and digits of the local part, each within its kind; the domain stays."""
    local, at, domain = s.rpartition("@")
    sizes, value = [], 0
    for c in local:
        k, low = (10, "0") if c.isdigit() else (26, "a") if c.islower() else (26, "A") if c.isupper() else (1, c)
        sizes.append((k, ord(low)))
        value = value * k + (ord(c) - ord(low) if k > 1 else 0)
    shape = "".join("9" if k == 10 else "a" if k == 26 else chr(low) for k, low in sizes)
    total = math.prod(k for k, _ in sizes)
    value = move(f"email{shape}@{domain.lower()}", total, value)
    out = []
    for k, low in reversed(sizes):
        out.append(chr(low + value % k))
        value //= k
    return "".join(reversed(out)) + at + domain


#: Kind, what a text must hold to be looked at, pattern, and validation with replacement.
KINDS = (
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"), _email),
    ("iban", "", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), _iban),
    ("card", "", re.compile(r"(?<![\d.-])(?:[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4}){2}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![\d-])"), _card),
    ("phone", "", re.compile(r"\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
                             r"|\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)(?:(?:[ .-]?[0-9]{2,4}(?![0-9])){1,4}|[ .-]?[0-9]{5,10}(?![0-9]))"
                             r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}(?![0-9])){2,5}|\+[0-9]{1,3}[ .-](?:[0-9]{1,5}[ .-][0-9]{5,8}|[0-9]{6,12})(?![0-9])|\+[0-9]{8,15}(?![0-9])"
                             r"|(?<![\w(])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])|(?<![\w.-])[0-9]{3}([-.])[0-9]{3}\1[0-9]{4}(?![\d-])"), _phone),
    ("ssn", "-", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    ("date", "", re.compile(r"(?<![\w.-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\2[0-9]{4})(?![\w-])"), _date),
    ("address", ".", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])"), _address),
)
_DIGIT = re.compile("[0-9]")


def find(text: str, move) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, pseudonym)`` of the valid findings, left to right without overlap.

    Of overlapping findings the one that begins first stays, then the longest, then the first kind.
    """
    if "@" not in text and _DIGIT.search(text) is None:
        return []
    found = []
    for order, (kind, need, pattern, replace) in enumerate(KINDS):
        if need and need not in text:
            continue
        for m in pattern.finditer(text):
            new = replace(m.group(0), move)
            if new is not None:
                found.append((m.start(), -m.end(), order, kind, new))
    out, at = [], 0
    for start, end, _, kind, new in sorted(found):
        if start >= at:
            out.append((start, -end, kind, new))
            at = -end
    return out


def substitute(text: str, found) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:]


def pseudonymise(docs: DataFrame, key: str, undo: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_found, spans, text``.

    ``spans`` joins ``kind:start:end`` of the findings (code points of the input, half-open) with
    commas; ``text`` has the pseudonyms in their places. ``undo`` maps pseudonyms back with the same
    key. A null text stays null and an empty one empty; texts without findings stay as they are;
    repeated rows get the same result; an empty table gives an empty one.
    """
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), StructField("n_found", LongType()),
                         StructField("spans", StringType()), StructField("text", StringType())])
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        import pyarrow as pa
        network = worker_state(("feistel", key), lambda: Feistel(key.encode()))
        move = network.backward if undo else network.forward
        for rows in by_bytes(batches, ("doc_id", "null", "text")):
            out = []
            for doc_id, null, text in rows:
                found = find(text, move)
                out.append((doc_id, len(found), ",".join(f"{k}:{i}:{j}" for i, j, k, _ in found),
                            None if null else substitute(text, found)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    return docs.select("doc_id", F.col("text").isNull().alias("null"), "text").mapInArrow(run, schema)
