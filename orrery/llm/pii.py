"""PII pseudonyms by format-preserving Feistel permutations (operator 10).

Validated values are replaced within the text: card numbers (Luhn), IBANs (mod 97), US social security
numbers, phone numbers (NANP, or international with a +), IPv4 and IPv6 addresses, dates, e-mail addresses with
their domain up to its last label, and secrets: keys of known forms, bearer tokens, private-key blocks, and what is
assigned to a word such as password. Numbers and dates are numbered within their format and permuted by a
keyed Feistel network over that range, with cycle-walking; texts of letters and digits by one over their two halves,
each character within its class. A round draws more bits from its keyed stream than the half that it changes has,
whatever the length. So a pseudonym is valid in the same format, keeps separators and widths, and equal
values get equal pseudonyms in all documents, whatever their separators (IPv6: whatever is spelt alike; dates in
another spelling where that spelling admits the new date). ``restore_documents`` inverts it with the key and the spans.
Keys have any length; values that
fail validation stay as they are, as do letters beyond ASCII in a value.

Defined results: a null text stays null, an empty one empty, with no finds; rows with null or repeated ids are
treated like others, an empty table gives an empty one, and a column named like a result is replaced. Texts
and values have any length. Where finds overlap the earlier one counts, at one place the longer.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import ipaddress
import math
import re
import struct
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

from orrery.llm.common import map_texts

KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")
_ROUNDS = 8
_CACHED = 256  # characters of a value that is remembered


class Stream:
    """Keyed bytes of any number for a tweak, a round and a half."""

    def __init__(self, key: bytes, tweak: str) -> None:
        self.base = hashlib.blake2b(tweak.encode(), key=hashlib.blake2b(key).digest(), digest_size=64)

    def take(self, i: int, half: bytes, n: int) -> bytes:
        h = self.base.copy()
        h.update(b"%d:" % i + half)
        return hashlib.shake_256(h.digest()).digest(n)


class Permutation:
    """A keyed permutation of 0 .. size - 1: a Feistel network over a x b >= size, walking back into range."""

    def __init__(self, key: bytes, tweak: str, size: int) -> None:
        self.size = size
        self.a = max(1, math.isqrt(size - 1) + 1)
        self.b = -(-size // self.a)
        self.stream = Stream(key, f"{tweak}|{size}")
        self.width = self.a.bit_length() // 8 + 1  # bytes that hold either half

    def _round(self, i: int, half: int) -> int:
        return int.from_bytes(self.stream.take(i, half.to_bytes(self.width, "big"), self.width + 8), "big")

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(_ROUNDS):
            if i % 2:
                right = (right + self._round(i, left)) % self.b
            else:
                left = (left + self._round(i, right)) % self.a
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(_ROUNDS)):
            if i % 2:
                right = (right - self._round(i, left)) % self.b
            else:
                left = (left - self._round(i, right)) % self.a
        return left * self.b + right

    def forward(self, x: int) -> int:
        x = self._once(x)
        while x >= self.size:
            x = self._once(x)
        return x

    def inverse(self, x: int) -> int:
        x = self._back(x)
        while x >= self.size:
            x = self._back(x)
        return x


def permute_symbols(key: bytes, tweak: str, radices: tuple[int, ...], symbols: list[int], back: bool = False) -> list[int]:
    """Permutes the symbols (each below its radix): a Feistel network whose halves are those of the sequence."""
    if len(symbols) < 2:
        only = [Permutation(key, tweak, r) for r in radices]
        return [p.inverse(x) if back else p.forward(x) for p, x in zip(only, symbols, strict=True)]
    stream, cut = Stream(key, tweak), len(symbols) // 2
    halves, sizes = [list(symbols[:cut]), list(symbols[cut:])], [radices[:cut], radices[cut:]]
    for i in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
        at = i % 2
        drawn = struct.unpack(f">{len(sizes[at])}Q", stream.take(i, bytes(halves[1 - at]), 8 * len(sizes[at])))
        halves[at] = [(x - d if back else x + d) % r for x, d, r in zip(halves[at], drawn, sizes[at], strict=True)]
    return halves[0] + halves[1]


class Cipher:
    """The permutations of a key, forwards or backwards; remembers short values."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.key, self.back = key, back
        self.permutation = functools.lru_cache(4_096)(functools.partial(Permutation, key))
        self._number = functools.lru_cache(65_536)(self._permute)
        self._symbols = functools.lru_cache(65_536)(lambda tweak, radices, symbols: permute_symbols(key, tweak, radices, list(symbols), back))

    def _permute(self, tweak: str, size: int, x: int) -> int:
        p = self.permutation(tweak, size)
        return p.inverse(x) if self.back else p.forward(x)

    def number(self, tweak: str, size: int, x: int, fits: Callable[[int], bool] = lambda x: True) -> int:
        """The image of ``x`` among the numbers that fit (as ``x`` does): walks until one fits."""
        x = self._number(tweak, size, x)
        while not fits(x):
            x = self._number(tweak, size, x)
        return x

    def symbols(self, tweak: str, radices: tuple[int, ...], symbols: tuple[int, ...]) -> list[int]:
        if len(symbols) > _CACHED:
            return permute_symbols(self.key, tweak, radices, list(symbols), self.back)
        return self._symbols(tweak, radices, symbols)


def _luhn(digits: str) -> int:
    """The check digit of a payload."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _put(digits: str, shape: str) -> str:
    """``digits`` in the places of the letters and digits of ``shape``."""
    source = iter(digits)
    return "".join(next(source) if c.isalnum() else c for c in shape)


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _classes(value: str, cipher: Cipher, tweak: str, lower: str = _LOWER, upper: str = _UPPER, fits: Callable[[str], bool] = lambda x: True) -> str:
    """Permutes all ASCII letters and digits of a value together, each within its class, among the values that fit."""
    alphabet = {c: x for x in (_DIGITS, lower, upper) for c in x}
    at = [i for i, c in enumerate(value) if c in alphabet]
    if not at:
        return value
    sets = [alphabet[value[i]] for i in at]
    tweak = f"{tweak}|{len(lower)}|" + "".join(alphabet[c][0] if c in alphabet else c for c in value)
    radices = tuple(map(len, sets))
    out = list(value)
    while True:
        new = cipher.symbols(tweak, radices, tuple(x.index(out[i]) for i, x in zip(at, sets, strict=True)))
        for i, x, k in zip(at, sets, new, strict=True):
            out[i] = x[k]
        if fits(text := "".join(out)):
            return text


def _card(m: re.Match, cipher: Cipher) -> str | None:
    digits = re.sub(r"\D", "", m.group())
    if not 13 <= len(digits) <= 19 or int(digits[-1]) != _luhn(digits[:-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 2

    def whole(x: int) -> str:
        body = digits[0] + str(x).zfill(n)
        return body + str(_luhn(body))

    return _put(whole(cipher.number(f"card|{len(digits)}|{digits[0]}", 10**n, int(digits[1:-1]), lambda x: len(set(whole(x))) > 1)), m.group())


def _iban_check(country: str, body: str) -> str:
    return str(98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97).zfill(2)


def _iban(m: re.Match, cipher: Cipher) -> str | None:
    plain = re.sub(r"\s", "", m.group())
    if not 15 <= len(plain) <= 34 or _iban_check(plain[:2], plain[4:]) != plain[2:4]:
        return None
    body = _classes(plain[4:], cipher, "iban" + plain[:2])
    return _put(plain[:2] + _iban_check(plain[:2], body) + body, m.group())


_AREAS = 898  # 001 to 899 but 666


def _ssn(m: re.Match, cipher: Cipher) -> str | None:
    area, group, serial = (int(x) for x in re.findall(r"\d+", m.group()))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    number = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    rest, serial = divmod(cipher.number("ssn", _AREAS * 99 * 9999, number), 9999)
    area, group = divmod(rest, 99)
    return _put(f"{area + 1 + (area >= 665):03}{group + 1:02}{serial + 1:04}", m.group())


def _nanp(local: str) -> bool:
    return local[0] not in "01" and local[3] not in "01"


def _phone(m: re.Match, cipher: Cipher) -> str | None:
    digits = re.sub(r"\D", "", m.group())
    country, local = digits[:-10], digits[-10:]
    abroad = m.group()[0] == "+"
    if len(digits) >= 10 and country in (("1",) if abroad else ("", "1")) and _nanp(local):
        number = ((int(local[:3]) - 200) * 800 + int(local[3:6]) - 200) * 10_000 + int(local[6:])
        rest, line = divmod(cipher.number("phone", 800 * 800 * 10_000, number), 10_000)
        area, exchange = divmod(rest, 800)
        return _put(f"{country}{area + 200}{exchange + 200}{line:04}", m.group())
    if not abroad or not 8 <= len(digits) <= 15:
        return None
    head, rest = (digits[:1], digits[1:]) if digits[0] == "1" else (digits[:2], digits[2:])
    n = len(rest)
    new = cipher.number(f"phone+{head}|{n}", 10**n, int(rest), lambda x: head != "1" or n != 10 or not _nanp(str(x).zfill(n)))
    return _put(head + str(new).zfill(n), m.group())


def _ip(m: re.Match, cipher: Cipher) -> str | None:
    octets = m.group().split(".")
    if any(int(o) > 255 or len(o) > 1 and o[0] == "0" for o in octets):
        return None
    number = cipher.number("ip", 1 << 32, int.from_bytes(bytes(map(int, octets)), "big"))
    return ".".join(map(str, number.to_bytes(4, "big")))


def _ipv6(m: re.Match, cipher: Cipher) -> str | None:
    value = m.group()
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return None
    if sum(map(bool, value.split(":"))) < 2 or not any(c.isdigit() for c in value):
        return None
    return _classes(value, cipher, "ipv6", "abcdef", "ABCDEF")


_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _date(m: re.Match, cipher: Cipher) -> str | None:
    a, sep, b, c = re.match(r"(\d+)(\D)(\d+)\D(\d+)", m.group()).groups()
    order = "ymd" if len(a) == 4 else "dmy" if sep == "." or int(a) > 12 else "mdy"
    part = dict(zip(order, (a, b, c), strict=True))
    try:
        day = datetime.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal()
    except ValueError:
        return None
    if not _FIRST_DAY <= day <= _LAST_DAY:
        return None

    def fits(x: int) -> bool:
        """Whether that day has a spelling of these widths that is read in this order."""
        new = datetime.date.fromordinal(_FIRST_DAY + x)
        return (len(part["m"]) == 2 or new.month < 10) and (len(part["d"]) == 2 or new.day < 10) and (order != "dmy" or sep == "." or new.day > 12)

    new = datetime.date.fromordinal(_FIRST_DAY + cipher.number("date", _LAST_DAY - _FIRST_DAY + 1, day - _FIRST_DAY, fits))
    text = {"y": str(new.year), "m": str(new.month).zfill(len(part["m"])), "d": str(new.day).zfill(len(part["d"]))}
    return sep.join(text[x] for x in order)


def _email(m: re.Match, cipher: Cipher) -> str | None:
    local, _, domain = m.group().partition("@")
    own, _, last = domain.rpartition(".")
    return _classes(local, cipher, "email") + "@" + _classes(own, cipher, "domain") + "." + last


def _hex(value: str) -> bool:
    return not re.search(r"[A-Zg-z]", value)


def _secret(m: re.Match, cipher: Cipher) -> str | None:
    head, value = m.groups()
    if not re.search(r"[A-Za-z0-9]", value):
        return None
    if _hex(value):
        return head + _classes(value, cipher, "secret", "abcdef")
    return head + _classes(value, cipher, "secret", fits=lambda x: not _hex(x))


#: kind, pattern, maker, a text that the pattern needs. The patterns take linear time.
_FIND = (
    ("email", r"(?<![\w.%+-])\w[\w.%+-]*@[\w-]+(?:\.[\w-]+)+", _email, "@"),
    ("secret", r"(?<![A-Za-z0-9])(AKIA|ASIA)([0-9A-Z]{16})(?![A-Za-z0-9])", _secret, "IA"),
    ("secret", r"(?<![\w-])(gh[oprsu]_|github_pat_|glpat-)([A-Za-z0-9_-]{20,})", _secret, "g"),
    ("secret", r"(?<![\w-])(xox[abeprs]-|sk-|sk_live_|pk_live_|AIza)((?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{16,})", _secret, ""),
    ("secret", r"(?<![\w-])(eyJ)([A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", _secret, "eyJ"),
    ("secret", r"\b([Bb]earer\s{1,4})((?=[A-Za-z._~+/=-]*[0-9])[A-Za-z0-9._~+/=-]{16,})", _secret, "earer"),
    ("secret", r"(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----)((?:(?!-----)[\s\S])+)", _secret, "PRIVATE KEY"),
    ("secret", r"(?i:(?<![a-z0-9])((?:password|passwd|pwd|token|secret|api[_-]?key)\s?[=:]\s?[\"']?))([^\s\"'<>]{8,})", _secret, ""),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban, ""),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]|\.\d)", _date, ""),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _ip, "."),
    ("ip", r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)", _ipv6, ":"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn, "-"),
    ("phone", r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", _phone, ""),
    ("phone", r"(?<![\w+])\+\d(?:[ .()-]{0,2}\d){7,14}(?!\d)", _phone, "+"),
    ("card", r"(?<![\w.])\d(?:[ -]?\d){12,18}(?![\d])", _card, ""),
)
_PATTERNS = [(k, re.compile(p), f, mark) for k, p, f, mark in _FIND]
_DIGIT = re.compile(r"\d")

Span = tuple[int, int, str, int, int, int]  # start, end, kind, number of the pattern, start and end of the pseudonym


def pseudonymise(text: str, cipher: Cipher) -> tuple[str, list[Span]]:
    """(the text with pseudonyms, the finds)."""
    digits = bool(_DIGIT.search(text))
    finds = []
    for form, (kind, pattern, make, mark) in enumerate(_PATTERNS):
        if mark and mark not in text or not digits and kind not in ("email", "secret"):
            continue
        for m in pattern.finditer(text):
            new = make(m, cipher)
            if new is not None:
                finds.append((m.start(), -m.end(), form, kind, new))
    out, spans, at, length = [], [], 0, 0
    for start, end, form, kind, new in sorted(finds):
        if start >= at:
            out += [text[at:start], new]
            length += start - at
            spans.append((start, -end, kind, form, length, length + len(new)))
            at, length = -end, length + len(new)
    return "".join([*out, text[at:]]), spans


def restore(text: str, spans: list[tuple[int, int, int]], back: Cipher) -> str:
    """The original text, given each pseudonym's ``form, new_start, new_end`` and the key's cipher backwards."""
    out, at = [], 0
    for form, start, end in sorted(spans, key=lambda s: s[1]):
        _, pattern, make, _ = _PATTERNS[form]
        m = pattern.fullmatch(text[start:end])
        old = make(m, back) if m else None
        if old is None:
            raise ValueError(f"no pseudonym at {start} to {end}")
        out += [text[at:start], old]
        at = end
    return "".join([*out, text[at:]])


_SPAN_FIELDS = {"start": pa.int32(), "end": pa.int32(), "kind": pa.string(), "form": pa.int32(), "new_start": pa.int32(), "new_end": pa.int32()}


def pseudonymise_documents(docs: DataFrame, key: bytes, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``pii_text``, ``n_pii`` and ``pii_spans``: start, end in code points of the original text, kind, form, and new_start, new_end in ``pii_text``."""

    def make():
        cipher = Cipher(key)

        def compute(texts):
            done = [(None, []) if t is None else pseudonymise(t, cipher) for t in texts.to_pylist()]
            spans = pa.array([[dict(zip(_SPAN_FIELDS, s, strict=True)) for s in x] for _, x in done], pa.list_(pa.struct(list(_SPAN_FIELDS.items()))))
            return [pa.array([t for t, _ in done], pa.string()), pa.array([len(x) for _, x in done], pa.int64()), spans]

        return compute

    return map_texts(docs, text_col, make, "pii_text string, n_pii bigint, pii_spans array<struct<start:int,end:int,kind:string,form:int,new_start:int,new_end:int>>", keep)


def restore_documents(docs: DataFrame, key: bytes, text_col: str = "pii_text", spans_col: str = "pii_spans", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``restored``, the text before ``pseudonymise_documents``; null where the text is. A null list of spans is none."""

    def make():
        back = Cipher(key, back=True)

        def compute(texts, spans):
            rows = zip(texts.to_pylist(), spans.to_pylist(), strict=True)
            return [pa.array([None if t is None else restore(t, [(s["form"], s["new_start"], s["new_end"]) for s in found or []], back) for t, found in rows], pa.string())]

        return compute

    return map_texts(docs, text_col, make, "restored string", keep, [spans_col])
