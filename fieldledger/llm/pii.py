"""Format-preserving pseudonyms for personal data.

A value is found by its format and validated: check digits, ranges, calendar. Its free
digits and letters are then a number below a known bound, which a keyed Feistel network
permutes: two halves in mixed radix take turns, and a result beyond the bound is
permuted again. The outcome is written in the same format, with check digits made
anew. So equal values have equal pseudonyms in all documents, different values have
different ones, and lengths and separators stay. Whoever holds the key can invert it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldledger.llm.common import slices
from fieldledger.llm.registry import query, reach, table

ROUNDS = 10

#: Key of the registered query and the pipeline; a real run passes its own.
EXAMPLE_KEY = b"example key, not a secret"

KINDS = ["email", "ip", "iban", "ssn", "date", "phone", "card"]

_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permuted(key: bytes, tweak: str, value: int, size: int, back: bool = False) -> int:
    """`value` under the keyed permutation of range(size) that `tweak` names."""
    a = isqrt(size - 1) + 1 if size > 1 else 1
    b = -(-size // a)

    def part(i: int, other: int, bound: int) -> int:
        told = f"{tweak}|{size}|{i}|{other}".encode()
        return int.from_bytes(hashlib.blake2b(told, key=key[:64], digest_size=32).digest()) % bound

    while True:
        left, right = divmod(value, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * part(i, right, a)) % a
            else:
                right = (right + sign * part(i, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def _mixed(key: bytes, tweak: str, digits: list[int], bounds: list[int], back: bool) -> list[int]:
    """Digits of the given bounds, read as one number, permuted, and taken apart again."""
    value, size = 0, 1
    for digit, bound in zip(digits, bounds, strict=True):
        value, size = value * bound + digit, size * bound
    value, out = permuted(key, tweak, value, size, back), []
    for bound in reversed(bounds):
        value, digit = divmod(value, bound)
        out.append(digit)
    return out[::-1]


def _refill(pattern: str, characters: str) -> str:
    """`pattern` with its letters and digits replaced by `characters`, in order."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in pattern)


def luhn_sum(digits: str) -> int:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)


def _card(key, found, back):
    digits = re.sub(r"\D", "", found)
    if not 13 <= len(digits) <= 19 or luhn_sum(digits) % 10 or len(set(digits)) == 1:
        return None
    inner = list(map(int, digits[1:-1]))
    inner = _mixed(key, f"card{digits[0]}", inner, [10] * len(inner), back)
    body = digits[0] + "".join(map(str, inner))
    return _refill(found, body + str(-luhn_sum(body + "0") % 10))


_SSN = [[i for i in range(1, 900) if i != 666], list(range(1, 100)), list(range(1, 10_000))]


def _ssn(key, found, back):
    values = [int(x) for x in found.split("-")]
    if any(v not in known for v, known in zip(values, _SSN, strict=True)):
        return None
    places = [known.index(v) for v, known in zip(values, _SSN, strict=True)]
    places = _mixed(key, "ssn", places, [len(x) for x in _SSN], back)
    area, group, serial = (known[p] for p, known in zip(places, _SSN, strict=True))
    return f"{area:03}-{group:02}-{serial:04}"


def _ip(key, found, back):
    octets = found.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in octets):
        return None
    return ".".join(map(str, _mixed(key, "ip", list(map(int, octets)), [256] * 4, back)))


def _phone(key, found, back):
    """With a country code or brackets, any digits; without, the rules of ten-digit numbers.

    The country code stays, and a leading 1; of a number without separators the first two
    digits, as the length of its code is not known.
    """
    lead = re.match(r"\+\d{1,3}(?=[ .(-])|\+1(?=\d{10}$)|\+\d\d(?=\d{6,13}$)|1[ .-]|", found)[0]
    digits = re.sub(r"\D", "", found[len(lead) :])
    marked = lead.startswith("+") or "(" in found
    if not 6 <= len(digits) <= 13 or not lead.startswith("+") and len(digits) != 10:
        return None
    if not marked and (digits[0] < "2" or digits[3] < "2"):
        return None
    low = [0 if marked or i not in (0, 3) else 2 for i in range(len(digits))]
    free = [int(d) - n for d, n in zip(digits, low, strict=True)]
    out = _mixed(key, f"phone{lead}{marked}", free, [10 - n for n in low], back)
    return lead + _refill(found[len(lead) :], "".join(str(d + n) for d, n in zip(out, low, strict=True)))


_DATES = [
    (re.compile(r"\d{4}-\d{1,2}-\d{1,2}"), "ymd", "-"),
    (re.compile(r"\d{4}/\d{1,2}/\d{1,2}"), "ymd", "/"),
    (re.compile(r"\d{1,2}/\d{1,2}/\d{4}"), "mdy", "/"),
    (re.compile(r"\d{1,2}/\d{1,2}/\d{4}"), "dmy", "/"),
    (re.compile(r"\d{1,2}\.\d{1,2}\.\d{4}"), "dmy", "."),
    (re.compile(r"\d{1,2}-\d{1,2}-\d{4}"), "dmy", "-"),
]


def _written(value: int, like: str, padded: bool) -> str | None:
    """A day or month in the way of `like`; None where it has no such form.

    With `padded` all numbers have two digits. Otherwise a number has as many digits as
    `like`, and a leading 0 where that has one.
    """
    if padded:
        return f"{value:02}"
    form = f"{value:02}" if like[0] == "0" else str(value)
    return form if len(form) == len(like) and (form[0] == "0") == (like[0] == "0") else None


def _date(key, found, back):
    for form, order, mark in _DATES:
        if not form.fullmatch(found):
            continue
        given = dict(zip(order, found.split(mark), strict=True))
        try:
            day = datetime.date(int(given["y"]), int(given["m"]), int(given["d"])).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            continue
        padded = len(given["m"]) == len(given["d"]) == 2
        tweak, size = f"date{order}{mark}", _LAST_DAY - _FIRST_DAY + 1
        while True:
            day = _FIRST_DAY + permuted(key, tweak, day - _FIRST_DAY, size, back)
            moved = datetime.date.fromordinal(day)
            parts = {"y": f"{moved.year:04}"}
            parts |= {c: _written(v, given[c], padded) for c, v in (("m", moved.month), ("d", moved.day))}
            # With slashes, a day of 12 or less would read as month first.
            if all(parts.values()) and (order != "dmy" or mark != "/" or moved.day > 12):
                return mark.join(parts[c] for c in order)
    return None


def _iban(key, found, back):
    plain = found.replace(" ", "")
    numeric = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]))
    if not 15 <= len(plain) <= 34 or numeric % 97 != 1:
        return None
    bounds = [10 if c.isdigit() else 26 for c in plain[4:]]
    values = [int(c) if c.isdigit() else ord(c) - 65 for c in plain[4:]]
    values = _mixed(key, f"iban{plain[:2]}", values, bounds, back)
    body = "".join(str(v) if n == 10 else chr(65 + v) for v, n in zip(values, bounds, strict=True))
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    return _refill(found, f"{plain[:2]}{check:02}{body}")


#: Letters and digits of an address that are one number; longer local parts are several.
_TOGETHER = 64


def _email(key, found, back):
    local, host = found.rsplit("@", 1)
    spans = [(10, "0") if c.isdigit() else (26, "a") if c.islower() else (26, "A") for c in local if c.isalnum()]
    values = [ord(c) - ord(low) for c, (_, low) in zip(filter(str.isalnum, local), spans, strict=True)]
    done: list[int] = []
    for i in range(0, len(values), _TOGETHER):
        part = slice(i, i + _TOGETHER)
        tweak = f"email{host.lower()}" + (f"|{i}" if i else "")
        done += _mixed(key, tweak, values[part], [n for n, _ in spans[part]], back)
    new = "".join(chr(ord(low) + v) for v, (_, low) in zip(done, spans, strict=True))
    return _refill(local, new) + "@" + host


_MAKE = {"ip": _ip, "iban": _iban, "ssn": _ssn, "date": _date, "phone": _phone, "card": _card}

#: Formats that begin with a digit, a plus sign, a bracket or two capitals.
_NUMBER = re.compile(
    r"(?<![\w+-])(?<!\w[.@])(?:"
    r"(?P<ip>\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<iban>[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
    r"|(?P<ssn>\d{3}-\d\d-\d{4})"
    r"|(?P<date>\d{4}(?P<a>[-/])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[-/.])\d{1,2}(?P=b)\d{4})"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?|1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    r"|\+\d{1,3}(?:[ .-]\d{2,4}){2,5}|\+\d{8,15})"
    r"|(?P<card>\d(?:[ -]?\d){12,18})"
    r")(?!(?!T\d\d:\d\d)\w)",
    re.ASCII,
)
_HOST = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}", re.ASCII)
#: The characters of a local part; it is read backwards from its @.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+", re.ASCII)
_DIGIT = re.compile(r"\d", re.ASCII)



def _shorter(found: str, kind: str) -> list[str]:
    """`found`, and for grouped numbers also what is left without its last groups."""
    cuts = [m.start() for m in re.finditer("[ -]", found)] if kind in ("card", "iban") else []
    return [found, *(found[:i] for i in reversed(cuts))]


def _local(text: str, at: int) -> str:
    """The local part that ends at the @ at `at`, whatever its length."""
    back = _LOCAL.match(text[text.rfind("@", 0, at) + 1 : at][::-1])
    return back[0][::-1].lstrip("._%+-") if back else ""


def pseudonymised(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """`text` with its values replaced, and how many of each kind there were."""
    found: list[tuple[int, int, str, str]] = []
    at = text.find("@")
    while at >= 0:
        host = _HOST.match(text, at)
        local = host and _local(text, at)
        if local:
            begin = at - len(local)
            value = text[begin : host.end()]
            found.append((begin, host.end(), "email", _email(key, value, back)))
        at = text.find("@", host.end() if local else at + 1)
    if _DIGIT.search(text):
        at = 0
        while match := _NUMBER.search(text, at):
            kind = match.lastgroup
            at = match.start() + 1
            for value in _shorter(match[0], kind):
                if new := _MAKE[kind](key, value, back):
                    at = match.start() + len(value)
                    found.append((match.start(), at, kind, new))
                    break
    counts = dict.fromkeys(KINDS, 0)
    out, done = [], 0
    for begin, end, kind, new in sorted(found):
        if begin >= done:
            out += [text[done:begin], new]
            done = end
            counts[kind] += 1
    return "".join([*out, text[done:]]), counts


class _Replace:
    def __init__(self, text: str, key: bytes, counts: str | None):
        self.text, self.key, self.counts = text, key, counts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, self.text):
            at = batch.schema.get_field_index(self.text)
            texts = batch.column(at).to_pylist()
            done = [(None, None) if t is None else pseudonymised(t, self.key) for t in texts]
            field = batch.schema.field(at)
            batch = batch.set_column(at, field, pa.array([t for t, _ in done], field.type))
            if self.counts:
                kinds = pa.struct([(k, pa.int64()) for k in KINDS])
                column = pa.array([c for _, c in done], kinds)
                held = batch.schema.get_field_index(self.counts)
                named = pa.field(self.counts, kinds)
                batch = batch.append_column(named, column) if held < 0 else batch.set_column(held, named, column)
            yield batch


def pseudonymise(
    docs: DataFrame, key: bytes, text: str = "text", counts: str | None = None
) -> DataFrame:
    """`docs` with pseudonyms in `text`; with `counts`, also a struct of counts by kind.

    Every row keeps its other columns, whatever their names; a column that is called
    `counts` already is replaced. A null text stays null, with null counts; an empty one
    stays empty with counts of 0. Repeated rows are treated alike, an empty table gives an
    empty result, and texts of any length are read whole.
    """
    reach(docs.sparkSession)
    schema = docs.schema
    if counts:
        kinds = ", ".join(f"{k}: long" for k in KINDS)
        schema = docs.withColumn(counts, F.lit(None).cast(f"struct<{kinds}>")).schema
    return docs.mapInArrow(_Replace(text, key, counts), schema)


@query("op10_pii")
def op10_pii(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = pseudonymise(docs, EXAMPLE_KEY, counts="found")
    return done.select("doc_id", "text", *[F.col(f"found.{k}").alias(f"n_{k}") for k in KINDS])
