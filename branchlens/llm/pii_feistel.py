"""Format-preserving Feistel pseudonyms for personal data.

A found value is validated (check digits, ranges, calendar), read as a number in the
mixed-radix system of its variable characters, permuted by a keyed Feistel network over
exactly that domain, and written back into the same characters' places. Values that the
permutation moves outside the valid set are permuted again until they are inside
(cycle walking), so the map is a bijection of valid values: equal values get equal
pseudonyms in every document, different values different ones, and ``reverse`` with the
key gives the text back. Lengths, separators, letter case and domains stay.

Kinds: card (Luhn; the first digit stays, the check digit is made anew), phone (North
American by rule, with +1 or behind a word such as "tel", others with their country code
kept), ssn, ipv4 and ipv6 (public stays public, private stays private; loopback and broadcast
are nobody's), iban (check digits made anew), date (1900-2099, in figures or with an English
month), email (local part), login (name and password in an address), access_key, token (with
a known prefix or behind "bearer"), private_key (the body), secret (values assigned to
password, token and the like). Values of any length are replaced whole, in pieces of at most
``PIECE`` characters.

Work per text is local to its row: one scan, no shuffle. Edge cases: null stays null, a
text without values is returned byte for byte; invalid look-alikes (a 16-digit number
that fails Luhn, 31.02.2020, 300.1.1.1) are left alone; overlapping finds: the earlier
kind of the list above wins; repeated rows are treated alike; columns called pii and
n_values are replaced, all others pass through. ``pii`` lists (kind, start, length) in
characters; places are the same in the old and the new text.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

ROUNDS = 10
PIECE = 48
_EPOCH = dt.date(1900, 1, 1)
_DAYS = (dt.date(2099, 12, 31) - _EPOCH).days + 1


class Permutation:
    """Keyed bijections of [0, n) by an alternating modular Feistel network."""

    def __init__(self, key: bytes):
        self.key = key
        self.rounds: dict[str, list] = {}

    def _mac(self, tweak: str, turn: int, value: int) -> int:
        data = f"{tweak}|{turn}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def step(self, x: int, n: int, tweak: str, reverse: bool) -> int:
        b = math.isqrt(n - 1) + 1
        a = -(-n // b)
        while True:
            left, right = divmod(x, b)
            for turn in (reversed(range(ROUNDS)) if reverse else range(ROUNDS)):
                sign = -1 if reverse else 1
                if turn % 2 == 0:
                    left = (left + sign * self._mac(tweak, turn, right)) % a
                else:
                    right = (right + sign * self._mac(tweak, turn, left)) % b
            x = left * b + right
            if x < n:
                return x

    def walk(self, x: int, n: int, tweak: str, valid: Callable[[int], bool], reverse: bool) -> int:
        if n < 2:
            return x
        while True:
            x = self.step(x, n, tweak, reverse)
            if valid(x):
                return x


def _luhn(digits: list[int]) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(odd) + sum(sum(divmod(2 * d, 10)) for d in even)) % 10 == 0


def _digits(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in text)


def _card(v: str, p: Permutation, reverse: bool) -> str | None:
    d = _digits(v)
    if not 13 <= len(d) <= 19 or d[0] == 0 or not _luhn(d) or len(set(d)) == 1:
        return None
    n = 10 ** (len(d) - 2)
    x = p.walk(int("".join(map(str, d[1:-1]))), n, f"card{len(d)}{d[0]}", lambda _: True, reverse)
    body = f"{d[0]}{x:0{len(d) - 2}d}"
    check = next(c for c in range(10) if _luhn([*map(int, body), c]))
    return _refill(v, f"{body}{check}")


def _phone_us(v: str, p: Permutation, reverse: bool) -> str | None:
    d = _digits(v)
    ten = d[-10:]

    def assignable(x: int) -> bool:
        s = f"{x:010d}"
        return s[0] >= "2" and s[3] >= "2"

    x = int("".join(map(str, ten)))
    real = assignable(x)
    if not real and not v.startswith("+"):  # only the country code tells that it is a phone number
        return None
    x = p.walk(x, 10 ** 10, "phone1", lambda y: assignable(y) == real, reverse)
    return _refill(v, "1" * (len(d) - 10) + f"{x:010d}")


def _phone(v: str, p: Permutation, reverse: bool) -> str | None:
    country = re.match(r"\+\d{1,3}", v)[0]
    rest = v[len(country):]
    d = _digits(rest)
    if not 7 <= len(d) <= 13:
        return None
    x = p.walk(int("".join(map(str, d))), 10 ** len(d), f"phone{country}{len(d)}", lambda _: True, reverse)
    return country + _refill(rest, f"{x:0{len(d)}d}")


def _ssn(v: str, p: Permutation, reverse: bool) -> str | None:
    def ok(x: int) -> bool:
        s = f"{x:09d}"
        return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"

    x = int("".join(map(str, _digits(v))))
    if not ok(x):
        return None
    return _refill(v, f"{p.walk(x, 10 ** 9, 'ssn', ok, reverse):09d}")


def _network(x: int) -> str | None:
    """Whether an address is one of a public or a private network; None for neither."""
    a, b = x >> 24, x >> 16 & 255
    if a in (0, 127) or a >= 224:
        return None
    private = a == 10 or (a, b) in ((192, 168), (169, 254)) or (a == 172 and 16 <= b < 32)
    return "private" if private else "public"


_SPANS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}  # first octet and number of octets of a written width


@functools.lru_cache(maxsize=None)
def _heads(kind: str, first: int, second: int) -> tuple[list[tuple[int, int]], dict[tuple[int, int], int]]:
    """The first two octets of all addresses of a network kind and written widths, numbered.
    The kind depends on them alone; at most 156 * 156 pairs, kept for the life of the worker."""
    (a0, an), (b0, bn) = _SPANS[first], _SPANS[second]
    pairs = [(a, b) for a in range(a0, a0 + an) for b in range(b0, b0 + bn) if _network(a << 24 | b << 16) == kind]
    return pairs, {pair: i for i, pair in enumerate(pairs)}


def _ipv4(v: str, p: Permutation, reverse: bool) -> str | None:
    """The valid addresses of the value's network kind and written widths (so that places in
    the text do not move) are numbered without gaps, so one step of the permutation does."""
    written = v.split(".")
    parts = [int(x) for x in written]
    if max(parts) > 255 or any(len(s) > 1 and s[0] == "0" for s in written):
        return None
    kind = _network(int.from_bytes(bytes(parts), "big"))
    if kind is None:
        return None
    widths = [len(s) for s in written]
    pairs, number = _heads(kind, widths[0], widths[1])
    (c0, cn), (d0, dn) = _SPANS[widths[2]], _SPANS[widths[3]]
    n = len(pairs) * cn * dn
    x = (number[parts[0], parts[1]] * cn + parts[2] - c0) * dn + parts[3] - d0
    if n > 1:
        x = p.step(x, n, f"ipv4{kind}" + "".join(map(str, widths)), reverse)
    x, d = divmod(x, dn)
    head, c = divmod(x, cn)
    return ".".join(map(str, (*pairs[head], c + c0, d + d0)))


@functools.lru_cache(maxsize=4096)
def _alphabet(c: str, hexadecimal: bool = False) -> str | None:
    """The characters among which a variable character is permuted: digits, letters of one
    case, or letters of one case in a block of 64 code points (of equal length in UTF-8)."""
    if "0" <= c <= "9":
        return "0123456789"
    if "a" <= c <= "z" or "A" <= c <= "Z":
        first, n = ("a" if c >= "a" else "A"), 6 if hexadecimal else 26
        return "".join(chr(ord(first) + i) for i in range(n))
    if ord(c) > 127 and c.isalpha():
        block = ord(c) & ~63
        return "".join(x for x in map(chr, range(block, block + 64))
                       if x.isalpha() and (x.islower(), x.isupper()) == (c.islower(), c.isupper()))
    return None


_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def _characters(v: str, p: Permutation, reverse: bool, kind: str, hexes: bool = False,
                base16: bool = False, valid: Callable[[str], bool] = lambda _: True) -> str | None:
    """Every digit and letter permuted within its class, the rest kept. Longer values are
    permuted piece by piece; with ``hexes`` a hexadecimal piece stays one and no other piece
    becomes one; with ``base16`` letters stay among a to f. ``valid`` holds for values of one piece."""
    out, changed = [], False
    for at in range(0, len(v), PIECE):
        piece = v[at: at + PIECE]
        hexadecimal = base16 or (hexes and _HEX.fullmatch(piece) is not None)
        alphabets = [_alphabet(c, hexadecimal) for c in piece]
        n = math.prod(len(r) for r in alphabets if r)
        if n < 2:
            out.append(piece)
            continue
        x = 0
        for c, r in zip(piece, alphabets):
            if r:
                x = x * len(r) + r.index(c)
        shape = "".join(r[0] if r else c for c, r in zip(piece, alphabets))

        def write(x: int) -> str:
            chars = list(piece)
            for i in range(len(piece) - 1, -1, -1):
                if alphabets[i]:
                    x, d = divmod(x, len(alphabets[i]))
                    chars[i] = alphabets[i][d]
            return "".join(chars)

        def ok(x: int) -> bool:
            new = write(x)
            return (not hexes or (_HEX.fullmatch(new) is not None) == hexadecimal) and valid(new)

        out.append(write(p.walk(x, n, f"{kind}{at or ''}{shape}{hexadecimal}", ok, reverse)))
        changed = True
    return "".join(out) if changed else None


def _iban_rest(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _iban(v: str, p: Permutation, reverse: bool) -> str | None:
    s = v.replace(" ", "")
    if not 15 <= len(s) <= 34 or _iban_rest(s) != 1:
        return None
    body = _characters(s[4:], p, reverse, f"iban{s[:2]}")
    s = f"{s[:2]}{98 - _iban_rest(s[:2] + '00' + body):02d}{body}"
    it = iter(s)
    return "".join(c if c == " " else next(it) for c in v)


def _date(v: str, p: Permutation, reverse: bool) -> str | None:
    a, b, c = re.split(r"[-/.]", v)
    order = "ymd" if len(a) == 4 else "dmy"
    day = None
    for o in ([order] if order == "ymd" else ["dmy", "mdy"]):
        f = dict(zip(o, map(int, (a, b, c))))
        try:
            day, order = dt.date(f["y"], f["m"], f["d"]), o
            break
        except ValueError:
            continue
    if day is None or not 0 <= (day - _EPOCH).days < _DAYS:
        return None
    widths = dict(zip(order, map(len, (a, b, c))))

    def write(x: int) -> str:
        d = _EPOCH + dt.timedelta(x)
        part = {"y": f"{d.year:04d}", "m": f"{d.month:0{widths['m']}d}", "d": f"{d.day:0{widths['d']}d}"}
        first, second, third = (part[k] for k in order)
        return f"{first}{v[len(a)]}{second}{v[len(a) + 1 + len(b)]}{third}"

    def ok(x: int) -> bool:
        """Same length; and a date written month first stays readable in that way only."""
        d = _EPOCH + dt.timedelta(x)
        return len(write(x)) == len(v) and (order != "mdy" or d.day > 12) and (
            len(str(d.month)) <= widths["m"] and len(str(d.day)) <= widths["d"])

    return write(p.walk((day - _EPOCH).days, _DAYS, f"date{order if order == 'mdy' else ''}{widths['m']}{widths['d']}",
                        ok, reverse))


# The names of the months.
_MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
           "November", "December")


def _named_date(v: str, p: Permutation, reverse: bool) -> str | None:
    """A date with the month's English name, or its first three letters."""
    gaps, words = re.split(r"[A-Za-z0-9]+", v), re.findall(r"[A-Za-z0-9]+", v)
    at = next(i for i, w in enumerate(words) if w.isalpha())
    month, day, year = words[at], words[1 - at], words[2]
    short = len(month) == 3 and month.lower() != "may"
    names = [m[:3] if short else m for m in _MONTHS]
    case = str.upper if month.isupper() else str.lower if month.islower() else str
    if not day.isdigit() or month not in map(case, names):
        return None
    try:
        x = (dt.date(int(year), [*map(case, names)].index(month) + 1, int(day)) - _EPOCH).days
    except ValueError:
        return None
    if not 0 <= x < _DAYS:
        return None

    def write(x: int) -> str:
        d = _EPOCH + dt.timedelta(x)
        new = [f"{d.day:0{len(day)}d}"] * 2
        new[at] = case(names[d.month - 1])
        return "".join(g + w for g, w in zip(gaps, [*new, f"{d.year:04d}"])) + gaps[-1]

    # Every part keeps its length. May is its own abbreviation, so it stays May.
    def ok(x: int) -> bool:
        d = _EPOCH + dt.timedelta(x)
        return len(names[d.month - 1]) == len(month) and len(str(d.day)) <= len(day) and (d.month == 5) == (month.lower() == "may")

    return write(p.walk(x, _DAYS, f"named{short}{len(day)}{len(month)}{month.lower() == 'may'}", ok, reverse))


def _ipv6(v: str, p: Permutation, reverse: bool) -> str | None:
    def kind(text: str) -> tuple | None:
        try:
            a = ipaddress.IPv6Address(text)
        except ValueError:
            return None
        return None if a.is_loopback or a.is_unspecified or a.is_multicast else (a.is_private, a.is_link_local)

    own = kind(v)
    if own is None:
        return None
    # A group keeps its classes of hexadecimal digits; IPv6 is short enough for one piece.
    return _characters(v, p, reverse, "ipv6", base16=True, valid=lambda new: kind(new) == own)


def _email(v: str, p: Permutation, reverse: bool) -> str | None:
    local, _, domain = v.rpartition("@")
    out = _characters(local, p, reverse, f"email{domain.lower()}")
    return None if out is None else f"{out}@{domain}"


def _login(v: str, p: Permutation, reverse: bool) -> str | None:
    name, _, password = v.partition(":")
    new = _characters(name, p, reverse, "login"), _characters(password, p, reverse, "secret", True)
    return None if new == (None, None) else f"{new[0] or name}:{new[1] or password}"


def _access_key(v: str, p: Permutation, reverse: bool) -> str | None:
    return v[:4] + _characters(v[4:], p, reverse, "key" + v[:4])


def _token(v: str, p: Permutation, reverse: bool) -> str | None:
    prefix = re.match(r"(?:gh[opsur]_|github_pat_|glpat-|xox[abprs]-|sk[-_]|npm_|pypi-)?", v)[0]
    out = _characters(v[len(prefix):], p, reverse, f"token{prefix}")
    return None if out is None else prefix + out


def _key_body(v: str, p: Permutation, reverse: bool) -> str | None:
    return _characters(v, p, reverse, "private key")


def _secret(v: str, p: Permutation, reverse: bool) -> str | None:
    return _characters(v, p, reverse, "secret", True)


def _told_phone(v: str, p: Permutation, reverse: bool) -> str | None:
    return _phone_us(v, p, reverse) if len(v) == 10 or v[0] == "1" else None


#: kind, pattern (group 1 is the value), what a text must contain, function
KINDS = [
    ("card", re.compile(r"(?<![\w+.-])((?:\d[ -]?){12,18}\d)(?![\w-])"), "0", _card),
    ("iban", re.compile(r"(?<!\w)([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)(?!\w)"), "0", _iban),
    ("phone", re.compile(r"(?<![\w+])((?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?![\w-])"), "0",
     _phone_us),
    ("phone", re.compile(r"(?<![\w+])(\+(?!1[ (.-])\d{1,3}(?:[ .-]?\(?\d{1,5}\)?){2,6})(?![\w-])"), "0", _phone),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])"), "0", _ssn),
    ("ipv4", re.compile(r"(?<![\w.])(\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)"), "0", _ipv4),
    ("phone", re.compile(r"(?i)(?<!\w)(?:tel|telephone|phone|mobile|cell|call|fax|whatsapp)[.:#]?\s{1,2}(\d{10,11})(?!\w)"),
     "0", _told_phone),
    ("ipv6", re.compile(r"(?<![\w:.])((?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:]|\.\d)"), ":", _ipv6),
    ("date", re.compile(r"(?<![\w/.-])(\d{4}-\d{1,2}-\d{1,2}|\d{1,2}([/.-])\d{1,2}\2\d{4})(?![\w/-]|\.\d)"), "0", _date),
    ("date", re.compile(r"(?i)(?<![\w/.-])(\d{1,2} (?:" + "|".join(f"{m}|{m[:3]}" for m in _MONTHS) + r")\.?,? \d{4}|(?:"
                        + "|".join(f"{m}|{m[:3]}" for m in _MONTHS) + r")\.? \d{1,2},? \d{4})(?!\w)"), "0", _named_date),
    ("login", re.compile(r"(?<=://)([^\s:/@]+:[^\s/@]+)(?=@)"), "/", _login),
    ("email", re.compile(r"(?<![\w.%+-])([\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"), "@", _email),
    ("access_key", re.compile(r"(?<!\w)((?:AKIA|ASIA)[A-Z0-9]{16})(?!\w)"), "A", _access_key),
    ("private_key", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----([^-]+)-----END"), "K", _key_body),
    ("token", re.compile(r"(?<!\w)((?:gh[opsur]_|github_pat_|glpat-|xox[abprs]-|sk[-_]|npm_|pypi-)[\w-]{16,})(?!\w)"), "t", _token),
    ("token", re.compile(r"(?i)(?<!\w)bearer\s{1,3}([\w.~+/-]{16,})"), "t", _token),
    ("secret", re.compile(r"(?i)(?<!\w)(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
                          r"([^\s\"']{6,})"), "s", _secret),
]
_ANY_DIGIT = re.compile(r"\d\W?\d", re.ASCII)
_TOKEN_SIGN = re.compile(r"gh[opsur]_|github_pat_|glpat-|xox[abprs]-|sk[-_]|npm_|pypi-|[Bb][Ee][Aa][Rr][Ee][Rr]\s")
_ASSIGNED = re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]")


def replace_values(text: str, p: Permutation, reverse: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms and (kind, start, length) of each."""
    has = {"0": _ANY_DIGIT.search(text) is not None, "@": "@" in text, "A": "AKIA" in text or "ASIA" in text,
           ":": text.count(":") > 1, "/": "://" in text and "@" in text, "K": "PRIVATE KEY" in text,
           "t": _TOKEN_SIGN.search(text) is not None,
           "s": ("=" in text or ":" in text) and _ASSIGNED.search(text) is not None}
    found: list[tuple[int, int, str, str]] = []
    taken: set[int] = set()
    for kind, pattern, needs, function in KINDS:
        if not has[needs]:
            continue
        for m in pattern.finditer(text):
            start, end = m.span(1)
            if start in taken or end - 1 in taken or (end - start > 40 and not taken.isdisjoint(range(start, end))):
                continue
            new = function(m[1], p, reverse)
            if new is not None:
                found.append((start, end, kind, new))
                taken.update(range(start, end))
    if not found:
        return text, []
    found.sort()
    parts, at = [], 0
    for start, end, _, new in found:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]]), [(kind, start, end - start) for start, end, kind, _ in found]


PII = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                T.StructField("length", T.IntegerType())]))


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", reverse: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with pseudonyms in ``text``, n_values and pii."""
    docs = docs.drop("pii", "n_values")
    at = docs.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches):
        p = Permutation(key)
        for b in batches:
            new, spans = [], []
            for t in b.column(at).to_pylist():
                out, found = (t, []) if not t else replace_values(t, p, reverse)
                new.append(out)
                spans.append([{"kind": k, "start": s, "length": n} for k, s, n in found])
            columns = list(b.columns)
            columns[at] = pa.array(new, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, kind)],
                names=[*b.schema.names, "n_values", "pii"])

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField("n_values", T.IntegerType()), T.StructField("pii", PII)]))
