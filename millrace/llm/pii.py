"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Each kind of value is found by a pattern, validated, and replaced by another valid value
of the same kind and form: the same length, separators, letter case and alphabet. The
replacement is a permutation of the values of that form under a secret key, so equal
values get equal pseudonyms in all documents, different values different ones, and
whoever holds the key can turn them back.

``permute`` is a balanced Feistel network over ``range(n)`` with keyed BLAKE2 rounds; a
result outside the range is permuted again until it is inside (cycle walking). A value's
digits or letters are its number in mixed radix. Check digits are left out of the number
and computed anew. A date is permuted among the days of 400 years, an IPv4 address among
the public unicast ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b
from itertools import groupby

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from millrace.llm.common import plainly_named

ROUNDS = 10
#: Pseudonyms one task remembers.
REMEMBERED = 200_000

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FIRST_DAY, DAYS = date(1800, 1, 1), 146_097


def permute(x: int, n: int, key: bytes, tweak: str, back: bool = False) -> int:
    """The number that a keyed permutation of ``range(n)`` gives ``x``, or the reverse."""
    if n < 2:
        return x
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, size = (1 << half) - 1, half // 8 + 1
    person = blake2b(tweak.encode() + b"%d" % n, digest_size=16).digest()

    def turn(r: int, value: int) -> int:
        h = blake2b(value.to_bytes(size, "big"), digest_size=min(64, size + 8), key=key, person=person, salt=b"%d" % r)
        wide = h.digest()
        while len(wide) < size:
            wide += blake2b(wide, digest_size=64, key=key).digest()
        return int.from_bytes(wide, "big") & mask

    while True:
        left, right = x >> half, x & mask
        if back:
            for r in reversed(range(ROUNDS)):
                left, right = right ^ turn(r, left), left
        else:
            for r in range(ROUNDS):
                left, right = right, left ^ turn(r, right)
        x = left << half | right
        if x < n:
            return x


def _alphabet(c: str) -> str:
    for alphabet in (_DIGITS, _LOWER, _UPPER):
        if c in alphabet:
            return alphabet
    return c


def recoded(text: str, key: bytes, tweak: str, back: bool = False, alphabet: str = "") -> str:
    """Each digit and ASCII letter replaced by one of its kind; other characters stay.

    Characters of ``alphabet``, where it is given, are all of one kind.
    """
    kinds = [alphabet if c in alphabet else _alphabet(c) for c in text]
    x, n = 0, 1
    for c, kind in zip(text, kinds):
        n *= len(kind)
        x = x * len(kind) + kind.index(c)
    form = "".join("9" if k == _DIGITS else "a" if k == _LOWER else "A" if k == _UPPER else "x" if k == alphabet else k for k in kinds)
    x = permute(x, n, key, f"{tweak}:{form}", back)
    out = []
    for kind in reversed(kinds):
        x, i = divmod(x, len(kind))
        out.append(kind[i])
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _with_digits(form: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def card(text: str, key: bytes, back: bool) -> str | None:
    digits = _digits(text)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    new = recoded(digits[:-1], key, "card", back)
    return _with_digits(text, new + luhn_digit(new))


def iban(text: str, key: bytes, back: bool) -> str | None:
    """Country and layout stay; the account is permuted and the two check digits follow."""
    plain = text.replace(" ", "")
    country, account = plain[:2], plain[4:]

    def rest(check: str) -> int:
        return int("".join(str(int(c, 36)) for c in account + country + check)) % 97

    if not 15 <= len(plain) <= 34 or rest(plain[2:4]) != 1:
        return None
    account = recoded(account, key, "iban" + country, back)
    it = iter(f"{country}{98 - rest('00'):02d}{account}")
    return "".join(c if c == " " else next(it) for c in text)


def ssn(text: str, key: bytes, back: bool) -> str | None:
    """Areas 001-899 but 666, groups from 01, serials from 0001."""
    area, group, serial = (int(x) for x in re.split("[- ]", text))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(permute(x, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(x, 99)
    area += 1 + (area >= 665)
    return _with_digits(text, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


#: First address and size of the blocks that are not public unicast.
RESERVED = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16),
    ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24), ("192.88.99.0", 24), ("192.168.0.0", 16),
    ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("224.0.0.0", 3),
]


def _address(text: str) -> int:
    a, b, c, d = (int(x) for x in text.split("."))
    return a << 24 | b << 16 | c << 8 | d


_GAPS = [(_address(a), 1 << (32 - bits)) for a, bits in RESERVED]
_PUBLIC = (1 << 32) - sum(n for _, n in _GAPS)


def ip(text: str, key: bytes, back: bool) -> str | None:
    """Private and reserved addresses name nobody and stay."""
    x = _address(text)
    if any(first <= x < first + n for first, n in _GAPS):
        return None
    x -= sum(n for first, n in _GAPS if first < x)
    x = permute(x, _PUBLIC, key, "ip", back)
    for first, n in _GAPS:
        x += n * (x >= first)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


def phone(text: str, key: bytes, back: bool) -> str | None:
    """The country code and, in the plan of ten digits, the first digits' range stay."""
    digits = _digits(text)
    if text.startswith("+") and not (len(digits) == 11 and digits[0] == "1"):
        code = re.match(r"\+(\d{1,3})", text)[1][:2] if not re.match(r"\+\d{1,3}[ .(-]", text) else re.match(r"\+(\d{1,3})", text)[1]
        if not 8 <= len(digits) <= 15:
            return None
        return _with_digits(text, code + recoded(digits[len(code) :], key, "phone" + code, back))
    code, number = (digits[:-10], digits[-10:])
    if number[0] in "01" or number[3] in "01":
        return None
    x = (((int(number[0]) - 2) * 100 + int(number[1:3])) * 8 + int(number[3]) - 2) * 10**6 + int(number[4:])
    x = permute(x, 8 * 100 * 8 * 10**6, key, "phone", back)
    x, tail = divmod(x, 10**6)
    x, d = divmod(x, 8)
    a, bc = divmod(x, 100)
    return _with_digits(text, f"{code}{a + 2}{bc:02d}{d + 2}{tail:06d}")


def _day(x: date, key: bytes, back: bool) -> date | None:
    n = (x - FIRST_DAY).days
    return FIRST_DAY + timedelta(permute(n, DAYS, key, "date", back)) if 0 <= n < DAYS else None


def iso_date(text: str, key: bytes, back: bool) -> str | None:
    return _dated(text, "ymd", key, back)


def day_first(text: str, key: bytes, back: bool) -> str | None:
    return _dated(text, "dmy", key, back)


def month_first(text: str, key: bytes, back: bool) -> str | None:
    """Month first; day first where the second number can't be a day of a month."""
    return _dated(text, "mdy", key, back) or _dated(text, "dmy", key, back)


def _dated(text: str, order: str, key: bytes, back: bool) -> str | None:
    parts = dict(zip(order, (int(x) for x in re.findall(r"\d+", text))))
    try:
        new = _day(date(parts["y"], parts["m"], parts["d"]), key, back)
    except ValueError:
        return None
    if new is None:
        return None
    put = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    mark = re.search(r"\D", text)[0]
    return mark.join(put[c] for c in order)


def email(text: str, key: bytes, back: bool) -> str | None:
    """The part before the sign changes; the domain, which names a provider, stays."""
    local, _, domain = text.partition("@")
    return recoded(local, key, "email", back) + "@" + domain


def secret(text: str, key: bytes, back: bool) -> str | None:
    """A key or password: what stands before the value, and its quotes, stay."""
    head, value = re.fullmatch(r"(.*?[=:]\s*[\"']?|AKIA|ASIA|gh[pousr]_|sk-|)(.*)", text, re.S).groups()
    alphabet = "0123456789abcdef" if re.fullmatch("[0-9a-f]+", value) else ""
    if head in ("AKIA", "ASIA"):
        alphabet = _UPPER + "234567" if re.fullmatch("[A-Z2-7]+", value) else _UPPER + _DIGITS
    return head + recoded(value, key, "secret", back, alphabet)


Rule = Callable[[str, bytes, bool], "str | None"]

#: Kind, pattern and rule; the first that matches and validates at a place counts.
KINDS: list[tuple[str, str, Rule]] = [
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", secret),
    ("secret", r"(?<![A-Za-z0-9])(?:gh[pousr]_|sk-)[A-Za-z0-9]{20,}", secret),
    ("secret", r"(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]\s*[\"']?[A-Za-z0-9_\-+/]{6,}", secret),
    ("email", r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}", email),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])", ip),
    ("date", r"(?<![0-9\-])[12][0-9]{3}(?P<s1>[\-/.])[01]?[0-9](?P=s1)[0-3]?[0-9](?![0-9\-])", iso_date),
    ("date", r"(?<![0-9.])[0-3]?[0-9]\.[01]?[0-9]\.[12][0-9]{3}(?![0-9])", day_first),
    ("date", r"(?<![0-9/\-])[0-3]?[0-9](?P<s2>[/\-])[0-3]?[0-9](?P=s2)[12][0-9]{3}(?![0-9])", month_first),
    ("ssn", r"(?<![0-9\-])[0-9]{3}(?P<s3>[\- ])[0-9]{2}(?P=s3)[0-9]{4}(?![0-9\-])", ssn),
    ("phone", r"(?<![0-9A-Za-z+])\+1?[ .\-]?\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])", phone),
    ("phone", r"(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}(?:[ .\-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9])", phone),
    ("phone", r"(?<![0-9A-Za-z+(])(?:\([0-9]{3}\) ?|[0-9]{3}[.\-])[0-9]{3}[.\-][0-9]{4}(?![0-9])", phone),
    ("card", r"(?<![0-9\-])(?:[0-9]{13,19}|[0-9]{4}(?P<s4>[ \-])[0-9]{4}(?P=s4)[0-9]{4}(?P=s4)[0-9]{1,7}|[0-9]{4}(?P<s5>[ \-])[0-9]{6}(?P=s5)[0-9]{5})(?![0-9\-])", card),
]
FOUND = re.compile("|".join(f"(?P<k{i}>{p})" for i, (_, p, _) in enumerate(KINDS)))
#: What any pattern needs, for engines without look-around: most texts have none of it.
MAY_HOLD = r"[0-9@]|(?i:password|passwd|pwd|secret|token|api_?key)\s*[=:]|sk-|gh[pousr]_|AKIA|ASIA"
_EACH = [(kind, re.compile(pattern), rule) for kind, pattern, rule in KINDS]


def pseudonymised(
    text: str, key: bytes, back: bool = False, known: dict | None = None
) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the kind, start and end of each value in ``text``."""
    known = {} if known is None else known
    spans: list[tuple[str, int, int]] = []

    out, done, at = [], 0, 0
    while match := FOUND.search(text, at):
        start, at = match.start(), match.start() + 1
        for kind, pattern, rule in _EACH[int(match.lastgroup[1:]) :]:  # the outer group ends last
            match = pattern.match(text, start)
            if not match:
                continue
            value = match[0]
            if (kind, value) not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[kind, value] = rule(value, key, back)
            if known[kind, value] is not None:
                out += [text[done:start], known[kind, value]]
                done = at = match.end()
                spans.append((kind, start, done))
                break
    return "".join(out) + text[done:], spans


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a column ``found`` of (kind, number).

    ``back`` turns the pseudonyms of the same key into the values again. Values that fail
    their check (a wrong check digit, a day that no month has) stay as they are. A null
    or empty text stays and has nothing found. Other columns are passed on whatever they
    hold; a column ``found`` is replaced. Rows are treated alone, so ties, repeated rows
    and empty tables need no rule.
    """
    given = docs.drop("found")
    plain = plainly_named(given)
    kinds = list(dict.fromkeys(k for k, _, _ in KINDS))
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("number", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            at = batch.schema.get_field_index("text")
            text = batch.column(at)
            may = pc.match_substring_regex(text, MAY_HOLD).to_pylist()
            texts, found = [], []
            for value, maybe in zip(text, may):
                value, spans = value.as_py(), []
                if maybe:
                    value, spans = pseudonymised(value, key, back, known)
                texts.append(value)
                counted = groupby(sorted(k for k, _, _ in spans), kinds.index)
                found.append([{"kind": kinds[k], "number": len(list(g))} for k, g in counted])
            columns = batch.columns
            columns[at] = pa.array(texts, text.type)
            yield pa.record_batch(
                [*columns, pa.array(found, found_type)], [*batch.schema.names, "found"]
            )

    counts = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("number", T.IntegerType())]))
    out = plain.mapInArrow(run, T.StructType([*plain.schema, T.StructField("found", counts)]))
    return out.toDF(*given.columns, "found")
