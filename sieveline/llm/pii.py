"""PII (operator 5): format-preserving pseudonyms by a keyed Feistel permutation.

Found values are validated, mapped to an index in the set of all values of their format, permuted there by a Feistel
network, and written back in the same format. The permutation depends on the key and the kind alone, so equal values
get equal pseudonyms in every document, different values get different ones, and `reveal` undoes it with the key.

  email  local part of letters and digits: each character stays in its class, the domain stays (local parts of over
         64 letters and digits are permuted in runs of 64)
  card   13 to 19 digits, in groups by single spaces or hyphens if at all, with a valid Luhn check digit: the first
         digit stays, the check digit is made anew
  phone  +country (area) number in groups: the country code stays; a +1 number whose area and exchange don't begin
         with 0 or 1 becomes another such number, any other one a number of the rest
  ssn    three, two and four digits with hyphens, of an area, group and serial that can exist
  iban   country, check digits and account: letters and digits keep their classes, the check digits are made anew
  ip     IPv4 address with octets up to 255; one whose first is from 1 to 223 becomes another such, any other one of the rest
  date   a calendar date from 1900 to 2099 as 2001-02-03, 03/02/2001 (day first, or month first if only that is a date)
         or 03.02.2001: another date of the same format

If a match fails validation, the values that begin and end at its groups are tried: earlier ones first, then longer
ones. Values that fail validation stay as they are. Separators and numbers of digits are kept (an octet may change its
width), so a pseudonym is valid in its format. The spans tell where each value stood and where its pseudonym stands, by
which `reveal` undoes a text exactly.

All patterns are tried only where a run of their characters begins and give nothing back, so the work is linear in the
text. There is no key but the one that the caller gives: who knows it can undo every pseudonym.

Defined cases: null stays null and has no spans; an empty text stays empty; texts are rewritten whole; rows are
independent, so repeated rows give equal rows; an empty table gives an empty result; other columns are not read by
`pseudonymised` and are kept as they are by `rewritten`.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sieveline.llm.common import pick

ROUNDS = 8
KINDS = ("email", "card", "phone", "ssn", "iban", "ip", "date")
#: the session setting that holds the key; there is no other
KEY_SETTING = "spark.sieveline.pii.key"

_FIND = re.compile(
    r"""(?<![A-Za-z0-9_])(?:
    (?<![A-Za-z0-9._%+-])[._%+-]*+(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)
    |(?P<phone>(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![\w]))
    |(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,4})?(?!\w)(?!(?:(?<=[ ][0-9])|(?<=[ ][0-9]{2})|(?<=[ ][0-9]{3}))[./][0-9]))
    |(?P<date>(?<![\w.,/-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![\w/-]|[.,][0-9]))
    |(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
    |(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))
    |(?P<card>(?<![\w-])[0-9](?:[0-9]{12,18}|(?:[ -]?[0-9]){12,18})(?![\w-])
        # a short group before a point or slash belongs to an address or date
        (?!(?:(?<=[ -][0-9])|(?<=[ -][0-9]{2})|(?<=[ -][0-9]{3}))[./][0-9])))""",
    re.X,
)
_MAY = re.compile(r"[0-9@]")
#: the groups around a match that isn't valid, in which others may stand; a longer run is taken in steps
_RUN, _GROUP = re.compile(r"[A-Z0-9]+(?!\w)(?:[ -](?![0-9]{1,3}[./][0-9])[A-Z0-9]+(?!\w))*"), re.compile(r"[A-Z0-9]+")
RUN_STEP = 4096
#: characters of the longest value inside a run
_LONGEST = 50
#: letters and digits of a local part that are permuted together
_TOGETHER = 64


class Permutation:
    """A keyed permutation of range(size) for each kind: a balanced Feistel network on the next even number of bits,
    walked until it is back in the range."""

    def __init__(self, key: str):
        self.key = blake2b(key.encode(), digest_size=32).digest()

    def _round(self, kind: str, size: int, number: int, half: int, bits: int) -> int:
        out, block = 0, 0
        while 512 * block < bits:
            data = f"{kind}|{size}|{number}|{block}|{half}".encode()
            out |= int.from_bytes(blake2b(data, key=self.key, digest_size=64).digest(), "big") << 512 * block
            block += 1
        return out & ((1 << bits) - 1)

    def _walk(self, kind: str, size: int, value: int, rounds: range) -> int:
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, back = (1 << bits) - 1, rounds.step < 0
        while True:
            left, right = value >> bits, value & mask
            for r in rounds:
                if back:
                    left, right = right ^ self._round(kind, size, r, left, bits), left
                else:
                    left, right = right, left ^ self._round(kind, size, r, right, bits)
            value = left << bits | right
            if value < size:
                return value

    def forth(self, kind: str, size: int, value: int) -> int:
        return self._walk(kind, size, value, range(ROUNDS))

    def back(self, kind: str, size: int, value: int) -> int:
        return self._walk(kind, size, value, range(ROUNDS - 1, -1, -1))


# ---------------------------------------------------------------- formats: value -> value, or None if it isn't valid


def luhn(digits: str) -> int:
    """The check digit that follows the digits."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if i % 2 == 0 else d
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(pattern: str, chars: str) -> str:
    """The pattern with its letters and digits replaced in order."""
    own = iter(chars)
    return "".join(next(own) if c.isalnum() else c for c in pattern)


def _classes(chars: str) -> list[tuple[int, int]]:
    return [(48, 10) if c.isdigit() else (65, 26) if c.isupper() else (97, 26) for c in chars]


def _by_class(kind: str, chars: str, turn: Callable) -> str:
    """A permutation of all strings with the same character classes."""
    classes, size, value = _classes(chars), 1, 0
    for c, (low, n) in zip(chars, classes, strict=True):
        value, size = value * n + ord(c) - low, size * n
    value, out = turn(f"{kind}:{''.join('dDu'[(n == 26) + (low == 97)] for low, n in classes)}", size, value), []
    for low, n in reversed(classes):
        value, x = divmod(value, n)
        out.append(chr(low + x))
    return "".join(reversed(out))


def _email(text: str, turn: Callable) -> str:
    local, _, domain = text.partition("@")
    chars = "".join(c for c in local if c.isalnum())
    return f"{_refill(local, ''.join(_by_class('email', chars[i : i + _TOGETHER], turn) for i in range(0, len(chars), _TOGETHER)))}@{domain}"


def _card(text: str, turn: Callable) -> str | None:
    digits = re.sub("[ -]", "", text)
    if len(set(re.findall("[ -]", text))) > 1 or luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = digits[0] + _by_class("card", digits[1:-1], turn)
    if len(set(body)) == 1 and luhn(body) == int(body[0]):  # the one value that isn't valid: step over it
        body = digits[0] + _by_class("card", body[1:], turn)
    return _refill(text, body + str(luhn(body)))


def _walked(kind: str, digits: str, valid: Callable[[str], bool], turn: Callable) -> str | None:
    if not valid(digits):
        return None
    while True:
        digits = _by_class(kind, digits, turn)
        if valid(digits):
            return digits


def _phone(text: str, turn: Callable) -> str | None:
    head = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+1(?=[0-9]{10}$)|\+[0-9]{2}", text)[0]
    rest = text[len(head) :]
    digits = re.sub(r"\D", "", rest)
    if not 8 <= len(head) - 1 + len(digits) <= 15:
        return None
    usual = lambda d: len(d) == 10 and d[0] > "1" and d[3] > "1"
    # a number stays in its class, so that each class is permuted in itself
    group = usual if head == "+1" else lambda d: d[0] == "0"
    new = _walked(f"phone{head}", digits, lambda d: group(d) == group(digits), turn)
    return new and head + _refill(rest, new)


def _ssn(text: str, turn: Callable) -> str | None:
    valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    new = _walked("ssn", text.replace("-", ""), valid, turn)
    return new and _refill(text, new)


def _mod97(account: str, country: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in f"{account}{country}00")) % 97


def _iban(text: str, turn: Callable) -> str | None:
    chars = text.replace(" ", "")
    country, check, account = chars[:2], chars[2:4], chars[4:]
    if not 15 <= len(chars) <= 34 or int(check) != _mod97(account, country):
        return None
    account = _by_class(f"iban{country}", account, turn)
    return _refill(text, f"{country}{_mod97(account, country):02d}{account}")


_FIRST_OCTETS, _OCTET = (range(1, 224), (0, *range(224, 256))), 256


def _ip(text: str, turn: Callable) -> str | None:
    octets = text.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    usual = int(octets[0]) in _FIRST_OCTETS[0]
    firsts = _FIRST_OCTETS[0 if usual else 1]
    value = firsts.index(int(octets[0]))
    for o in octets[1:]:
        value = value * _OCTET + int(o)
    value = turn("ip" if usual else "ip/rest", len(firsts) * _OCTET**3, value)
    return f"{firsts[value >> 24]}.{value >> 16 & 255}.{value >> 8 & 255}.{value & 255}"


_FIRST_DAY, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def _date(text: str, turn: Callable) -> str | None:
    parts = list(map(int, re.split(r"[-/.]", text)))
    month_first = False
    try:
        if "-" in text:
            day = date(*parts)
        else:
            month_first = "/" in text and parts[1] > 12
            day = date(parts[2], parts[0], parts[1]) if month_first else date(parts[2], parts[1], parts[0])
    except ValueError:
        return None
    # month-first dates are known by their day; they are permuted among the dates of which the same holds
    kind = "date" if "/" not in text else "date/month" if month_first else "date/day"
    in_format = lambda d: kind == "date" or (d.day > 12) == month_first
    while True:
        day = _FIRST_DAY + timedelta(turn(kind, _DAYS, (day - _FIRST_DAY).days))
        if in_format(day) or kind == "date/day":
            break
    if "-" in text:
        return day.strftime("%Y-%m-%d")
    return day.strftime("%m/%d/%Y" if month_first else "%d/%m/%Y" if "/" in text else "%d.%m.%Y")


_FORMATS = {"email": _email, "card": _card, "phone": _phone, "ssn": _ssn, "iban": _iban, "ip": _ip, "date": _date}


def _valid_inside(run: str, turn: Callable) -> list[tuple[int, int, str]]:
    """The valid values (start, end, kind) that begin and end at groups of a run, earlier ones first, then longer ones."""
    groups, out, k = [g.span() for g in _GROUP.finditer(run)], [], 0
    ends = [b for _, b in groups]
    while k < len(groups):
        a, after = groups[k][0], k + 1
        for b in reversed(ends[k : bisect_right(ends, a + _LONGEST, k)]):
            if not (m := _FIND.fullmatch(run, a, b)) or m.lastgroup == "email":
                continue
            # numbers of other kinds don't stand beside a hyphen
            if m.lastgroup not in ("card", "iban") and "-" in (run[a - 1 : a], run[b : b + 1]):
                continue
            if turn(m.lastgroup, m[0]) is not None:
                out.append((a, b, m.lastgroup))
                after = bisect_right(ends, b)
                break
        k = after
    return out


class Pseudonyms:
    """Rewrites texts with one key. A span is (start, end, kind, start and end of the pseudonym in the new text)."""

    def __init__(self, key: str):
        if not key:
            raise ValueError(f"pseudonyms need a key; {KEY_SETTING} is not set")
        permutation = Permutation(key)
        self.one = lru_cache(100_000)(lambda kind, text: _FORMATS[kind](text, permutation.forth))
        self.other = lambda kind, text: _FORMATS[kind](text, permutation.back)

    def found(self, text: str) -> Iterator[tuple[int, int, str]]:
        """The valid values of a text, in order."""
        go = 0
        while m := _FIND.search(text, go):
            kind, (start, go) = m.lastgroup, m.span(m.lastgroup)
            if self.one(kind, m[kind]) is not None:
                yield start, go, kind
                continue
            limit = start + RUN_STEP
            run = _RUN.match(text, start, limit)
            if run is None:
                continue
            groups = [g.start() for g in _GROUP.finditer(run[0])]
            # the last group may begin a value of another form or, in a long run, of the next step
            last = groups[-1] if len(groups) > 1 else len(run[0])
            inside = _valid_inside(run[0], self.one)
            if run.end() + _LONGEST >= limit:  # cut off: what the next step sees whole is left to it
                last = next((g for g in groups if g > len(run[0]) - 2 * _LONGEST), last)
                inside = [x for x in inside if x[0] < last]
            for a, b, k in inside:
                yield start + a, start + b, k
            if groups[1:]:
                go = max(start + last, start + inside[-1][1] if inside else 0)

    def rewrite(self, text: str | None) -> tuple[str | None, list[tuple[int, int, str, int, int]]]:
        """The text with pseudonyms, and the spans in order."""
        if not text or not _MAY.search(text):
            return text, []
        parts, spans, at, size = [], [], 0, 0
        for a, b, kind in self.found(text):
            new = self.one(kind, text[a:b])
            parts += text[at:a], new
            size += a - at
            spans.append((a, b, kind, size, size + len(new)))
            size += len(new)
            at = b
        return ("".join(parts) + text[at:] if spans else text), spans

    def reveal(self, text: str | None, spans: list[tuple[int, int, str, int, int]]) -> str | None:
        """The text before, from the new text and its spans."""
        parts, at = [], 0
        for _, _, kind, a, b in spans:
            parts += text[at:a], self.other(kind, text[a:b])
            at = b
        return "".join(parts) + text[at:] if spans else text


def session_key(spark: SparkSession) -> str:
    """The key that the session holds; it is an error if there is none."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"{KEY_SETTING} is not set: pseudonyms need a secret key")
    return key


_SPAN = ("start", "end", "kind", "new_start", "new_end")


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text (rewritten), and spans of every row: start and end in the text before, kind, new_start and new_end in the new text."""

    def work(batches):
        own = Pseudonyms(key)
        for batch in batches:
            new = [own.rewrite(t) for t in batch.column(1).to_pylist()]
            spans = [[dict(zip(_SPAN, x, strict=True)) for x in s] for _, s in new]
            kind = pa.list_(pa.struct([(n, pa.string() if n == "kind" else pa.int32()) for n in _SPAN]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t for t, _ in new], pa.string()), pa.array(spans, kind)], ["doc_id", "text", "spans"])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(work, "doc_id long, text string, spans array<struct<start:int,end:int,kind:string,new_start:int,new_end:int>>")


def rewritten(docs: DataFrame, key: str) -> DataFrame:
    """The rows of docs with pseudonyms in text, all other columns as they are but n_chars, which follows the text."""
    names = docs.columns
    text = names.index("text")

    def work(batches):
        own = Pseudonyms(key)
        for batch in batches:
            new = [own.rewrite(t)[0] for t in batch.column(text).to_pylist()]
            batch = batch.set_column(text, batch.schema.field(text), pa.array(new, batch.schema.field(text).type))
            if "n_chars" in names:
                at = names.index("n_chars")
                batch = batch.set_column(at, batch.schema.field(at), pa.array([None if t is None else len(t) for t in new], batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(work, docs.schema)
