"""Personal data: format-preserving pseudonyms from a keyed Feistel network.

Numbers and dates are found by pattern and validated (check digits, calendar, ranges); each is permuted within
the set of valid values of its format, so that equal values get equal pseudonyms in all documents, different
values different ones, and lengths, separators and check digits hold. Mail addresses are permuted letter for
letter and digit for digit.

Defined cases: a null text stays null; an empty one empty; a text of any length is read whole; a mail address of any
length is permuted, a long one in blocks; a key of over 64 bytes is hashed first; what fails its check stays as it is; digits are those of ASCII, any others stay; of matches that begin at one place the first
kind of the pattern counts; rows are treated each for itself; columns but doc_id and text are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import arrow_map, blocks, table

#: For tests and examples; pass a secret one of your own, to the query by the session's setting ``KEY_SETTING``.
KEY, KEY_SETTING = b"change this key", "spark.scoreline.pii.key"
DIGITS = frozenset("0123456789")
ROUNDS = 8
#: Characters of an address that are permuted as one number.
BLOCK = 200
KINDS = ("card", "phone", "ip", "date", "ssn", "iban", "mail")


def permute(x: int, size: int, key: bytes, kind: str) -> int:
    """A keyed permutation of range(size): a balanced Feistel network over the next even number of bits, applied
    again while its value lies outside."""
    key = key if len(key) <= 64 else hashlib.blake2b(key).digest()
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    person = hashlib.blake2b(f"{kind}:{size}".encode(), digest_size=16).digest()
    while True:
        a, b = x >> half, x & mask
        for r in range(ROUNDS):
            f = hashlib.blake2b(b.to_bytes((half + 7) // 8, "big"), key=key, salt=bytes([r]), person=person, digest_size=(half + 7) // 8 + 1)
            a, b = b, a ^ int.from_bytes(f.digest(), "big") & mask
        x = a << half | b
        if x < size:
            return x


def _walk(x: int, size: int, key: bytes, kind: str, valid: Callable[[int], bool]) -> int:
    """The permutation's next valid value: again a permutation, of the valid ones."""
    while not valid(x := permute(x, size, key, kind)):
        pass
    return x


def _fill(template: str, digits: str) -> str:
    """The template with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in DIGITS else c for c in template)


def luhn(digits: str) -> int:
    """The digit that makes digits + it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def card(s: str, key: bytes) -> str | None:
    d = re.sub("[^0-9]", "", s)
    if not 13 <= len(d) <= 19 or d[0] == "0" or luhn(d[:-1]) != int(d[-1]):
        return None
    n = len(d) - 1
    new = str(_walk(int(d[:-1]), 10**n, key, "card", lambda x: x >= 10 ** (n - 1)))
    return _fill(s, new + str(luhn(new)))


# Country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _country(s: str) -> tuple[str, str] | None:
    """Country code and number, a trunk zero in brackets left out; None for code 1, which is read like a number
    without it."""
    d = re.sub("[^0-9]", "", s.replace("(0)", "", 1))
    if d[0] == "1":
        return None
    n = 1 if d[0] == "7" else 2 if d[:2] in TWO_DIGITS else 3
    return d[:n], d[n:]


def phone(s: str, key: bytes, any_area: bool = False) -> str | None:
    """``any_area``: ten digits after +1 or with a bracketed area code need no valid area code and exchange; those
    that have none are permuted among themselves."""
    if s.startswith("+") and (found := _country(s)):
        code, rest = found
        if not 6 <= len(rest) <= 12:
            return None
        new = f"{permute(int(rest), 10 ** len(rest), key, 'phone' + code):0{len(rest)}}"
        head, trunk, tail = s.partition("(0)")
        at = sum(c in DIGITS for c in head)
        return _fill(head, (code + new)[:at]) + trunk + _fill(tail, (code + new)[at:])
    d = re.sub("[^0-9]", "", s)
    head, rest = (d[0], d[1:]) if len(d) == 11 and d[0] == "1" else ("", d)
    good = lambda x: x // 10**9 >= 2 and x // 10**6 % 10 >= 2
    if len(rest) != 10:
        return None
    fits = good(int(rest))
    if not fits and not (any_area and s[0] in "+("):
        return None
    new = _walk(int(rest), 10**10, key, "phone", lambda x: good(x) == fits)
    return _fill(s, f"{head}{new:010}")


def ip(s: str, key: bytes) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


_FROM = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FROM


def _shape(d: datetime.date) -> tuple[int, bool]:
    """Dates of one shape fill one another's places in any format: as many digits, and a day that can be no month
    only for one such."""
    return (0 if d.day < 10 else 1 if d.day <= 12 else 2), d.month < 10


def date(s: str, key: bytes) -> str | None:
    """Year first, or year last with day and month as the separator has it: slash month first, else day first. What
    is no date so is read in the other order. A date goes to one of its shape, the same in every format."""
    a, sep, b, c = re.match("([0-9]+)([^0-9])([0-9]+)[^0-9]([0-9]+)", s).groups()
    for order in ["ymd"] if len(a) == 4 else ["mdy", "dmy"] if sep == "/" else ["dmy", "mdy"]:
        part = dict(zip(order, map(int, (a, b, c))))
        try:
            old = datetime.date(part["y"], part["m"], part["d"])
            break
        except ValueError:
            pass
    else:
        return None
    n = old.toordinal() - _FROM
    if not 0 <= n < _DAYS:
        return None
    at = lambda x: datetime.date.fromordinal(_FROM + x)
    new = at(_walk(n, _DAYS, key, "date", lambda x: _shape(at(x)) == _shape(old)))
    shown = {"y": new.year, "m": new.month, "d": new.day}
    return sep.join(f"{shown[k]:0{len(was)}}" for k, was in zip(order, (a, b, c)))


def ssn(s: str, key: bytes) -> str | None:
    good = lambda x: x // 10**6 not in (0, 666) and x // 10**6 < 900 and x // 10**4 % 100 and x % 10**4
    x = int(s.replace("-", ""))
    return _fill(s, f"{_walk(x, 10**9, key, 'ssn', good):09}") if good(x) else None


def _classes(s: str, key: bytes, kind: str) -> str:
    """Letters to letters of their case, digits to digits: ``BLOCK`` characters at a time, each block as one number in
    mixed radix, under a permutation that depends on what the blocks before it have become."""
    out = _block(s[:BLOCK], key, kind)
    if len(s) <= BLOCK:
        return out
    done, before = [out], hashlib.blake2b(out.encode(), digest_size=16)
    for at in range(BLOCK, len(s), BLOCK):
        done.append(_block(s[at : at + BLOCK], key, f"{kind}:{at}:{before.hexdigest()}"))
        before.update(done[-1].encode())
    return "".join(done)


def _block(s: str, key: bytes, kind: str) -> str:
    base = [10 if c in DIGITS else 26 if c.isalpha() and c.isascii() else 1 for c in s]
    x, size = 0, 1
    for c, b in zip(s, base):
        x, size = x * b + (0 if b == 1 else ord(c) - ord("0") if b == 10 else ord(c.lower()) - ord("a")), size * b
    x = permute(x, size, key, kind) if size > 1 else x
    out = []
    for c, b in zip(reversed(s), reversed(base)):
        x, v = divmod(x, b)
        out.append(c if b == 1 else chr(v + ord("0")) if b == 10 else chr(v + ord("A" if c.isupper() else "a")))
    return "".join(reversed(out))


def iban(s: str, key: bytes) -> str | None:
    plain = s.replace(" ", "")
    number = lambda t: int("".join(str(int(c, 36)) for c in t)) % 97
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) != 1:
        return None
    body = _classes(plain[4:], key, "iban" + plain[:2])
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00'):02}" + body)
    return "".join(c if c == " " else next(new) for c in s)


def mail(s: str, key: bytes) -> str | None:
    who, _, where = s.rpartition("@")
    name, _, top = where.rpartition(".")
    return f"{_classes(who, key, 'mail')}@{_classes(name, key, 'host')}.{top}"


_FIND = re.compile(
    r"(?P<mail>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}\b)"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9][0-9](?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<date>(?<![\w./-])(?:(?:19|20)[0-9][0-9]([-./])[0-9][0-9]?\4[0-9][0-9]?(?:(?=[Tt][0-9][0-9])|(?![\w/-]|\.[0-9]))|[0-9][0-9]?([-./])[0-9][0-9]?\5(?:19|20)[0-9][0-9](?![\w/-]|\.[0-9])))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9][0-9]-[0-9]{4}(?![\w-]))"
    r"|(?P<phone>\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)"
    r"|(?<![\w-])(?:1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[-.])[0-9]{3}[ .-][0-9]{4}(?!\w)|(?<![\w-])(?<![0-9] )(?:1 )?[0-9]{3} [0-9]{3}[ .-][0-9]{4}(?!\w|[ -][0-9]))"
    r"|(?P<card>(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?!\w))"
)
_MAKE = {"card": card, "phone": phone, "ip": ip, "date": date, "ssn": ssn, "iban": iban, "mail": mail}


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, value: str, key: bytes, any_area: bool = False) -> str | None:
    return phone(value, key, any_area) if kind == "phone" else _MAKE[kind](value, key)


def _numbers(run: str, key: bytes) -> tuple[str, int]:
    """A run of digit groups that is no card as a whole may be several cards side by side."""
    groups, n = re.split(r"([ -])", run), 0
    if len(groups) > 1:
        for i in range(0, len(groups), 2):
            if len(groups[i]) >= 13 and (new := pseudonym("card", groups[i], key)):
                groups[i], n = new, n + 1
    return "".join(groups), n


def pseudonymise(text: str, key: bytes = KEY, any_area: bool = False) -> tuple[str, dict[str, int]]:
    found: dict[str, int] = {}

    def swap(m: re.Match) -> str:
        kind = next(k for k in KINDS if m[k] is not None)
        new = pseudonym(kind, m[0], key, any_area)
        n = 1
        if new is None and kind in ("card", "phone"):
            new, n = _numbers(m[0], key)
            kind = "card"
        if new is None or not n:
            return m[0]
        found[kind] = found.get(kind, 0) + n
        return new

    return _FIND.sub(swap, text), found


def pseudonymise_documents(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_found, n_card, ...): no shuffle, nothing but the key is shared between tasks."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for b in blocks(batch, 512):
            got = [(None, {}) if t is None else pseudonymise(t, key, any_area=True) for t in b.column(1).to_pylist()]
            counts = [pa.array([f.get(k, 0) for _, f in got], pa.int64()) for k in KINDS]
            yield pa.record_batch([b.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([sum(f.values()) for _, f in got], pa.int64()), *counts], ["doc_id", "text", "n_found", *(f"n_{k}" for k in KINDS)])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, text string, n_found long, " + ", ".join(f"n_{k} long" for k in KINDS))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, KEY.decode()).encode()
    return pseudonymise_documents(table(spark, sf_dir, "documents", "doc_id", "text"), key)
