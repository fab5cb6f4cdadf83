"""Format-preserving pseudonyms from keyed Feistel permutations.

Found values are first validated (Luhn digit, IBAN remainder, octet ranges,
calendar, number ranges), then ranked inside the set of all valid values of
their own format, permuted there by a keyed Feistel network (cycle walking
keeps the permutation inside the set), and written back in the same format
with a right check digit.  The permutation depends on the key and on the
format alone, so equal values get equal pseudonyms in every document, on
every executor, and unequal values never collide, but for e-mail names with
letters outside ASCII: those come out in a-z, so two such names (or one and a
plain name) can get one pseudonym.

Kinds: payment card, IBAN, social security number, phone number, IPv4
address, calendar date, and, by the same permutation over their letters and
digits, e-mail names and quoted secrets (32 or more hexadecimal or
letter-digit characters).

Edge cases: null text stays null with no findings, empty text stays empty; a
number that fails its validation is left as it is; repeated rows change
alike; a text of any length is one value of one row; an empty table gives no
rows; all other columns pass through unchanged, whatever their names (the
added columns replace columns of the same name).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import row_slices, table

KEY = b"trimatch demonstration key"
ROUNDS = 8
SPANS = [(1900, 2099)]        # dates of these years keep to them, others to their century
KEY_SETTING = "spark.trimatch.pii.key"


def permute(value: int, n: int, key: bytes, tweak: bytes) -> int:
    """Keyed permutation of range(n): alternating Feistel over a x b >= n,
    walked until the value falls inside again."""
    if n <= 1:
        return value
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    bits = 16 + max(a, b).bit_length() // 8
    while True:
        left, right = divmod(value, b)
        for i in range(ROUNDS):
            half = right if i % 2 == 0 else left
            f = int.from_bytes(hashlib.blake2b(b"%d|%d|%d|" % (i, n, half) + tweak, key=key, digest_size=min(64, bits)).digest(), "big")
            if i % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        value = left * b + right
        if value < n:
            return value


# --- formats -------------------------------------------------------------------

def luhn_digit(body: str) -> int:
    digits = [int(c) for c in reversed(body)]
    total = sum(digits[1::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[::2])
    return -total % 10


def _fill(shape: str, digits: str) -> str:
    """Put ``digits`` in the digit places of ``shape``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def card(m: str, key: bytes) -> str | None:
    d = re.sub(r"\D", "", m)
    if int(d[-1]) != luhn_digit(d[:-1]):
        return None
    n = len(d) - 1
    body = str(permute(int(d[:-1]), 10 ** n, key, b"card")).zfill(n)
    return _fill(m, body + str(luhn_digit(body)))


def phone(m: str, key: bytes) -> str | None:
    code = re.match(r"\+\d{1,3}(?=\D)", m)
    head = code.group() if code else ""
    d = re.sub(r"\D", "", m[len(head):])
    if not 7 <= len(d) <= 14:
        return None
    return head + _fill(m[len(head):], str(permute(int(d), 10 ** len(d), key, b"phone")).zfill(len(d)))


def ipv4(m: str, key: bytes) -> str | None:
    o = [int(x) for x in m.split(".")]
    if max(o) > 255:
        return None
    v = permute(int.from_bytes(bytes(o), "big"), 1 << 32, key, b"ipv4")
    return ".".join(map(str, v.to_bytes(4, "big")))


def ssn(m: str, key: bytes) -> str | None:
    a, g, s = map(int, m.split("-"))
    if a in (0, 666) or a >= 900 or not g or not s:
        return None
    rank = ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1
    rank, s = divmod(permute(rank, 898 * 99 * 9999, key, b"ssn"), 9999)
    a, g = divmod(rank, 99)
    a += 1
    return f"{a + (a >= 666):03d}-{g + 1:02d}-{s + 1:04d}"


def date(m: str, key: bytes) -> str | None:
    sep = re.search(r"\D", m).group()
    p = m.split(sep)
    # year last: slashes are read month first, dots and dashes day first, and
    # the other way round where the numbers allow no other reading
    if len(p[0]) == 4:
        order, usual = (0, 1, 2), True
    elif sep == "/":
        usual = int(p[0]) <= 12
        order = (2, 0, 1) if usual else (2, 1, 0)
    else:
        usual = int(p[1]) <= 12
        order = (2, 1, 0) if usual else (2, 0, 1)
    try:
        day = dt.date(*(int(p[i]) for i in order)).toordinal()
    except ValueError:
        return None
    # a date stays in its span of years, and one whose order is told by its
    # numbers must read the same way afterwards
    year = int(p[order[0]])
    first, last = next((s for s in SPANS if s[0] <= year <= s[1]), (max(1, year // 100 * 100), year // 100 * 100 + 99))
    days = _days(usual, first, last)
    new = dt.date.fromordinal(days[permute(bisect_left(days, day), len(days), key, b"date/%d/%d" % (usual, first))])
    out = [""] * 3
    for i, v in zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"), strict=True):
        out[i] = v
    return sep.join(out)


@lru_cache(64)
def _days(usual: bool, first: int, last: int) -> Sequence[int]:
    """Days of a span of years that read in the usual order of their spelling
    (all), or those that can only be read the other way round."""
    span = range(dt.date(first, 1, 1).toordinal(), dt.date(last, 12, 31).toordinal() + 1)
    return span if usual else [d for d in span if dt.date.fromordinal(d).day > 12]


def _spread(text: str, key: bytes, tweak: bytes, hexa: bool = False) -> str:
    """Permute the letters and digits of ``text``, each within its class."""
    radix, digits = [], []
    for c in text:
        if hexa and c in "0123456789abcdefABCDEF":
            radix.append(16)
            digits.append(int(c, 16))
        elif c.isascii() and c.isdigit():
            radix.append(10)
            digits.append(int(c))
        elif c.isalpha():
            radix.append(26)
            digits.append((ord(c.lower()) - 97) % 26)
    n, v = 1, 0
    for r, d in zip(radix, digits, strict=True):
        n, v = n * r, v * r + d
    v = permute(v, n, key, tweak + hashlib.blake2b("".join(c for c in text if not c.isascii()).encode(), digest_size=8).digest())
    new = []
    for r in reversed(radix):
        v, d = divmod(v, r)
        new.append(d)
    upper = hexa and any(c in "ABCDEF" for c in text)
    out = []
    for c in text:
        if hexa and c in "0123456789abcdefABCDEF":
            x = "0123456789abcdef"[new.pop()]
            out.append(x.upper() if upper else x)
        elif c.isascii() and c.isdigit():
            out.append(str(new.pop()))
        elif c.isalpha():
            x = chr(97 + new.pop())
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def email(m: str, key: bytes) -> str | None:
    name, at, host = m.rpartition("@")
    return _spread(name, key, b"email") + at + host


def secret(m: str, key: bytes) -> str | None:
    hexa = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", m) is not None
    if not hexa and (not re.search(r"\d", m) or not re.search("[A-Za-z]", m)):
        return None
    return _spread(m, key, b"secret", hexa)


def iban(m: str, key: bytes) -> str | None:
    s = m.replace(" ", "")

    def rest(body: str, check: str) -> int:
        return int("".join(str(int(c, 36)) for c in body + s[:2] + check)) % 97
    if not 15 <= len(s) <= 34 or rest(s[4:], s[2:4]) != 1:
        return None
    body = _spread(s[4:], key, b"iban" + s[:2].encode())
    new = iter(s[:2] + f"{98 - rest(body, '00'):02d}" + body)
    return "".join(c if c == " " else next(new) for c in m)


KINDS: dict[str, tuple[str, Callable[[str, bytes], str | None]]] = {
    "email": (r"\w[\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", email),
    "secret": (r"(?<=[\"'])[A-Za-z0-9_/+-]{32,}(?=[\"'])|(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])", secret),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    "date": (r"(?<![\d.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\d-]|\.\d)", date),
    "ipv4": (r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)", ipv4),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    "card": (r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)", card),
    "phone": (r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)", phone),
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in KINDS.items()))
_EACH = {k: re.compile(p) for k, (p, _) in KINDS.items()}

#: Every kind has a digit, an @ or a run of hexadecimal letters.
_SOME = re.compile(r"[\d@]|[a-f]{32}|[A-F]{32}")


def _readings(text: str, m: re.Match) -> Iterator[tuple[str, int]]:
    """(kind, end) of each way to read what starts at a match, in the order of
    the kinds; an IBAN may end before any group that a blank parts."""
    order = list(KINDS)
    for kind in order[order.index(m.lastgroup):]:
        own = m if kind == m.lastgroup else _EACH[kind].match(text, m.start())
        if own:
            yield kind, own.end()
            if kind == "iban":
                yield from ((kind, at) for at in range(own.end() - 1, own.start() + 13, -1) if text[at] == " ")


class Pseudonymizer:
    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key).digest()[:32]

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """New text, and (start, end, kind) of each pseudonym in it."""
        out, spans, at, size, pos = [], [], 0, 0, 0
        while m := _ANY.search(text, pos):
            pos = m.start() + 1
            for kind, end in _readings(text, m):
                new = KINDS[kind][1](text[m.start():end], self.key)
                if new is not None:
                    out += [text[at:m.start()], new]
                    size += m.start() - at
                    spans.append((size, size + len(new), kind))
                    size += len(new)
                    at = pos = end
                    break
        return ("".join(out) + text[at:] if out else text), spans


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                  T.StructField("kind", T.StringType())]))


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names; without one, a demonstration key that
    anyone can read here (so set one for real data)."""
    return spark.conf.get(KEY_SETTING, "").encode() or KEY


def pseudonymize(docs: DataFrame, key: bytes | None = None, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """``docs`` with validated personal values replaced in ``text_col``, and
    ``spans_col``: where the pseudonyms stand and of which kind they are.
    Without ``key`` that of the session holds (:func:`session_key`)."""
    key = key or session_key(docs.sparkSession)
    keep = docs.drop(spans_col)
    schema = T.StructType([*keep.schema.fields, T.StructField(spans_col, _SPAN)])
    at = [f.name for f in keep.schema.fields].index(text_col)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = Pseudonymizer(key)
        for b in row_slices(batches):
            col = b.column(at)
            texts, spans = col.to_pylist(), [[]] * b.num_rows
            for i, text in enumerate(texts):
                if text and _SOME.search(text):
                    texts[i], found = change.apply(text)
                    spans[i] = [{"start": s, "end": e, "kind": k} for s, e, k in found]
            texts = pa.array(texts, pa.string())
            cols = list(b.columns)
            cols[at] = texts
            yield pa.RecordBatch.from_arrays([*cols, pa.array(spans, kind)], names=[*b.schema.names, spans_col])

    return keep.mapInArrow(run, schema)


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudonymise the whole documents table."""
    return pseudonymize(table(spark, sf_dir, "documents"))
