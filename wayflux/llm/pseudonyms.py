"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that pass validation (card numbers by checksum, account numbers by remainder, telephone
numbers by plan, addresses of machines by range, social security numbers by area, dates by calendar) are
mapped to the whole numbers below the size of their format, permuted there under the key, and
written back in the same layout.  The permutation depends on key, kind and size alone, so equal values
stay equal in all documents, whatever separators they use, and with the key it can be undone.  The
letters and digits of mail addresses are permuted in the same way.
"""

from __future__ import annotations

import calendar
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from wayflux.llm.common import only

ROUNDS = 8


class Feistel:
    """A keyed permutation of 0 .. size - 1: a Feistel network over just enough bits, walked until it
    lands inside again."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self._half = max((max(size - 1, 1).bit_length() + 1) // 2, 1)
        self._mask = (1 << self._half) - 1
        self._key = hmac.new(key, f"{kind}/{size}".encode(), hashlib.sha256).digest()

    def _mix(self, turn: int, value: int) -> int:
        found = hashlib.blake2b(value.to_bytes((self._half + 7) // 8, "big"), key=self._key, digest_size=64, salt=bytes([turn]))
        return int.from_bytes(found.digest(), "big") & self._mask

    def _once(self, value: int, turns: range) -> int:
        left, right = value >> self._half, value & self._mask
        for turn in turns:
            left, right = right, left ^ self._mix(turn, right)
        return right << self._half | left

    def forward(self, value: int) -> int:
        return self._walk(value, range(ROUNDS))

    def backward(self, value: int) -> int:
        return self._walk(value, range(ROUNDS - 1, -1, -1))

    def _walk(self, value: int, turns: range) -> int:
        if self.size < 2:
            return value
        value = self._once(value, turns)
        while value >= self.size:
            value = self._once(value, turns)
        return value


def _luhn(digits: str) -> int:
    """The check digit that has to follow."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _relaid(value: str, characters: str, kept=str.isdigit) -> str:
    """``value`` with its kept characters replaced in order, separators as they are."""
    new = iter(characters)
    return "".join(next(new) if kept(c) else c for c in value)


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isdigit())


Permute = Callable[[str, int, int], int]


def _card(value: str, permute: Permute) -> str | None:
    digits = _digits(value)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or _luhn(digits[:-1]) != int(digits[-1]):
        return None
    n = len(digits) - 2
    body = digits[0] + str(permute("card", 10 ** n, int(digits[1:-1]))).zfill(n)
    return _relaid(value, body + str(_luhn(body)))


def _account(value: str, permute: Permute) -> str | None:
    plain = re.sub(r"\s", "", value)
    if not 15 <= len(plain) <= 34:
        return None
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _classes(plain[4:], "account", permute)
    check = 98 - number(body + plain[:2] + "00") % 97
    return _relaid(value, plain[:2] + f"{check:02d}" + body, str.isalnum)


#: First digits of area and exchange, numbered: those of the plan, and the rest.
_PLAN = {f"{a}{e}": k for k, (a, e) in enumerate((a, e) for a in range(2, 10) for e in range(2, 10))}
_NO_PLAN = {h: k for k, h in enumerate(h for h in (f"{n:02d}" for n in range(100)) if h not in _PLAN)}


def _telephone(value: str, permute: Permute) -> str | None:
    """Ten digits after an optional country code, the same for each layout of a number.

    A number whose area and exchange are ones of the plan (they begin with 2 to 9) becomes another one
    of the plan.  Others are taken for telephone numbers only where a code or a bracket says so, and
    are permuted among themselves.
    """
    digits = _digits(value)
    lead, number = digits[:-10], digits[-10:]
    first = number[0] + number[3]
    kind, heads = ("telephone", _PLAN) if first in _PLAN else ("telephone-other", _NO_PLAN)
    if heads is _NO_PLAN and not lead and "(" not in value:
        return None
    index = heads[first] * 10 ** 8 + int(number[1:3] + number[4:])
    head, rest = divmod(permute(kind, len(heads) * 10 ** 8, index), 10 ** 8)
    area, exchange = list(heads)[head]
    tail = f"{rest:08d}"
    return _relaid(value, lead + area + tail[:2] + exchange + tail[2:])


def _security(value: str, permute: Permute) -> str | None:
    area, group, serial = int(value[:3]), int(value[4:6]), int(value[7:])
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    new = permute("security", 898 * 99 * 9999, index)
    area, rest = divmod(new, 99 * 9999)
    area += 1 + (area + 1 >= 666)
    return f"{area:03d}{value[3]}{rest // 9999 + 1:02d}{value[6]}{rest % 9999 + 1:04d}"


def _machine(value: str, permute: Permute) -> str | None:
    parts = [int(p) for p in value.split(".")]
    if max(parts) > 255:
        return None
    new = permute("machine", 1 << 32, int.from_bytes(bytes(parts), "big"))
    return ".".join(map(str, new.to_bytes(4, "big")))


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _date(value: str, permute: Permute) -> str | None:
    first, sep, second, _, third = re.split(r"([-/.])", value)
    year_first = len(first) == 4
    year, month, day = (first, second, third) if year_first else (third, second, first)
    month_first = not year_first and int(month) > 12 >= int(day)
    if month_first:
        month, day = day, month
    y, m, d = int(year), int(month), int(day)
    if not (1900 <= y <= 2099 and 1 <= m <= 12 and 1 <= d <= calendar.monthrange(y, m)[1]):
        return None
    new = date.fromordinal(_FIRST + permute("date", _LAST - _FIRST + 1, date(y, m, d).toordinal() - _FIRST))
    if year_first:
        return f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}"
    first, second = (new.month, new.day) if month_first else (new.day, new.month)
    return f"{first:02d}{sep}{second:02d}{sep}{new.year:04d}"


def _classes(value: str, kind: str, permute: Permute) -> str:
    """Each letter and digit anew within its class, all of them as one number."""
    sizes = [10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 1 for c in value]
    size, index = 1, 0
    for c, n in zip(value, sizes):
        size *= n
        if n > 1:
            index = index * n + (int(c) if n == 10 else ord(c.lower()) - 97)
    new, out = permute(kind, size, index), []
    for c, n in zip(reversed(value), reversed(sizes)):
        if n == 1:
            out.append(c)
            continue
        new, k = divmod(new, n)
        letter = str(k) if n == 10 else chr(97 + k)
        out.append(letter.upper() if c.isupper() else letter)
    return "".join(reversed(out))


def _mail(value: str, permute: Permute) -> str | None:
    local, _, host = value.partition("@")
    # Long names in pieces of a bounded size, each linked to its place.
    pieces = [local[k:k + 24] for k in range(0, len(local), 24)]
    return "".join(_classes(p, f"mail{k}", permute) for k, p in enumerate(pieces)) + "@" + host


#: Kinds in the order in which they claim text.
KINDS: dict[str, tuple[str, Callable[[str, Permute], str | None]]] = {
    "mail": (r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    "account": (r"\b[A-Za-z]{2}\d{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?\b", _account),
    "card": (r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)", _card),
    "telephone": (r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)", _telephone),
    "security": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _security),
    "machine": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _machine),
    "date": (r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?!(?!T\d)[\w/-]|\.\d)", _date),
}
_PATTERNS = {k: re.compile(p, re.ASCII) for k, (p, _) in KINDS.items()}
_MAY = re.compile(r"[0-9@]")


@dataclass(frozen=True)
class Pseudonyms:
    """``key``: keep it secret; equal keys keep values linked across runs.  ``kinds``: those to replace."""

    key: bytes
    kinds: tuple[str, ...] = tuple(KINDS)


@lru_cache(maxsize=4096)
def _network(key: bytes, kind: str, size: int) -> Feistel:
    return Feistel(key, kind, size)


def pseudonymised(text: str | None, rule: Pseudonyms) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with all valid values replaced, and their (kind, start, end) in the old text."""
    if not text or not _MAY.search(text):
        return text, []

    def permute(kind: str, size: int, value: int) -> int:
        return _network(rule.key, kind, size).forward(value)

    found: list[tuple[int, int, str, str]] = []
    taken: set[int] = set()
    for kind in rule.kinds:
        make = KINDS[kind][1]
        for m in _PATTERNS[kind].finditer(text):
            if taken and any(k in taken for k in range(*m.span())):
                continue
            new = make(m.group(), permute)
            if new is not None:
                found.append((*m.span(), kind, new))
                taken.update(range(*m.span()))
    out, at = [], 0
    for start, end, _, new in sorted(found):
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), [(kind, a, b) for a, b, kind, _ in sorted(found)]


def pseudonym_report(docs: DataFrame, rule: Pseudonyms) -> DataFrame:
    """``doc_id, text, n_values, spans`` for each row of ``docs``: the new text, and kind:start:end of
    each value that was replaced, by place in the old text (code points).

    Null texts stay null, texts without values are unchanged.  Repeated rows give the same; other columns
    are not read; an empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [pseudonymised(t.as_py(), rule) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in done], pa.string()),
                 pa.array([len(s) for _, s in done], pa.int64()),
                 pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in s) for _, s in done], pa.string())],
                names=["doc_id", "text", "n_values", "spans"])

    return only(docs, doc_id="bigint", text="string").mapInArrow(
        run, "doc_id bigint, text string, n_values bigint, spans string")
