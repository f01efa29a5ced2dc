"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Values are found by form and kept only if they are valid (Luhn and mod-97 check digits, octet ranges,
real calendar dates, assignable number ranges). A valid value is a number below the size of its format,
which a balanced Feistel network over the next even number of bits permutes; results outside of the
format are permuted again until they are inside, so each format is mapped onto itself, one to one.
The same value gets the same pseudonym in every document, without any table of values.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from tidegate.llm.common import arrow_map

ROUNDS = 10
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size)."""
    if size <= 1:
        return value
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            seed = f"{tweak}|{size}|{r}|{right}".encode()
            left, right = right, left ^ (int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=(half + 7) // 8).digest(), "big") & mask)
        value = left << half | right
        if value < size:
            return value


#: The alphabets whose characters stand for one another.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
_ALPHABET = {c: a for a in ALPHABETS for c in a}


def permute_text(text: str, key: bytes, tweak: str, alphabets: dict[str, str] = _ALPHABET) -> str:
    """Permute a string among those with the same kind of character at each place."""
    value, size = 0, 1
    for c in text:
        if (a := alphabets.get(c)) is not None:
            value, size = value * len(a) + a.index(c), size * len(a)
    value = permute(value, size, key, tweak)
    out = []
    for c in reversed(text):
        if (a := alphabets.get(c)) is not None:
            value, k = divmod(value, len(a))
            c = a[k]
        out.append(c)
    return "".join(reversed(out))


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _refill(text: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _card(text: str, key: bytes) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1:
        return None
    size = 10 ** (len(digits) - 1)
    value = int(digits[:-1])
    while True:
        value = permute(value, size, key, "card")
        body = str(value).zfill(len(digits) - 1)
        whole = next(body + c for c in "0123456789" if luhn(body + c))
        if len(set(whole)) > 1:
            return _refill(text, whole)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = permute_text(plain[4:], key, "iban" + plain[:2])
    check = 98 - _mod97(plain[:2] + "00" + body)
    it = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(c if c == " " else next(it) for c in text)


def _ssn_ok(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(text: str, key: bytes) -> str | None:
    digits = _digits(text)
    if not _ssn_ok(digits):
        return None
    value = int(digits)
    while True:
        value = permute(value, 10**9, key, "ssn")
        if _ssn_ok(found := f"{value:09d}"):
            return _refill(text, found)


def _phone(text: str, key: bytes) -> str | None:
    """The country code, where it can be told, stays; +1 and national forms have ten more digits."""
    digits = _digits(text)
    head = re.match(r"\+(\d{1,3})(?=[ .(-])|\+(1)(?=\d{10}$)", text)
    code = (head[1] or head[2]) if head else ""
    rest = digits[len(code) :]
    if code == "1" and len(rest) != 10 or not code and not text.startswith("+") and len(rest) != 10 or not 7 <= len(rest) <= 14 or len(digits) > 15:
        return None
    return _refill(text, code + str(permute(int(rest), 10 ** len(rest), key, f"phone{len(rest)}")).zfill(len(rest)))


def _ip(text: str, key: bytes) -> str | None:
    octets = text.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    value = permute(int.from_bytes(bytes(map(int, octets)), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(text: str, key: bytes) -> str | None:
    """Year first, or day and month before the year: day first if that is a date, else month first."""
    parts = re.split(r"([-./])", text)
    a, b, c = (parts[k] for k in (0, 2, 4))
    orders = (((0, 2, 4), (a, b, c)),) if len(a) == 4 else (((4, 2, 0), (c, b, a)), ((4, 0, 2), (c, a, b)))
    for places, (year, month, day) in orders:
        try:
            when = datetime.date(int(year), int(month), int(day))
        except ValueError:
            continue
        if not FIRST_DAY <= when <= LAST_DAY:
            return None
        moved = FIRST_DAY + datetime.timedelta(permute((when - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, key, "date"))
        for place, n in zip(places, (moved.year, moved.month, moved.day), strict=True):
            parts[place] = str(n).zfill(4 if place == places[0] else 2 if len(parts[place]) == 2 else 1)
        return "".join(parts)
    return None


def _email(text: str, key: bytes) -> str | None:
    local, _, domain = text.rpartition("@")
    return permute_text(local, key, "email@" + domain.lower()) + "@" + domain


def _secret(text: str, key: bytes) -> str | None:
    hexadecimal = "0123456789ABCDEF" if text.isupper() else "0123456789abcdef"
    return permute_text(text, key, "secret", dict.fromkeys(hexadecimal, hexadecimal))


RULES: dict[str, Callable[[str, bytes], str | None]] = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date, "email": _email, "secret": _secret}

#: Forms that start with a digit, a plus sign or a bracket, in the order they are tried at a place.
_FORMS = (
    r"(?P<date>(?<![\w./-])(?:\d{4}([-./])\d{1,2}\2\d{1,2}|\d{1,2}([-./])\d{1,2}\3\d{4})(?![\w-]|[./]\d))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w)])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}(?P<gap>[-.])\d{3}(?P=gap)\d{4}(?![\w-]))"
)
_OTHERS = re.compile(_FORMS)
#: A run of digit groups of any length is a candidate for cards.
_NUMBERS = re.compile(_FORMS + r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,}(?!\w))")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)")
#: The countries whose IBANs have so many characters.
_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
IBAN_LENGTHS = {c: n for n, names in _COUNTRIES.items() for c in names.split()}
#: How the digits of cards are grouped in print.
_CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 5), (6, 13))
_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)+")
_SECRET = re.compile(r"""(?i:token|secret|password|passwd|api[_-]?key)["']?\s*[:=]\s*["']?([0-9a-f]{16,128}|[0-9A-F]{16,128})(?!\w)""")
_DIGIT = re.compile(r"[0-9]")
_CUE = re.compile(r"(?i)token|secret|passw|key")


Replace = Callable[[str, str], str | None]
Found = tuple[int, int, str, str]


def _cards(text: str, start: int, stop: int, replace: Replace) -> list[Found]:
    """The valid cards in a run of digit groups, in order: the whole run, or else spans of whole groups.

    Where valid spans overlap, one that is grouped as in print goes first, then an undivided one, then the longest.
    """
    if (new := replace("card", text[start:stop])) is not None:
        return [(start, stop, "card", new)]
    groups = [m.span() for m in re.compile(r"\d+").finditer(text, start, stop)]
    valid = []
    for k in range(len(groups)):
        digits = 0
        for n in range(k, len(groups)):
            digits += groups[n][1] - groups[n][0]
            if digits > 19:
                break
            if digits >= 13 and (new := replace("card", text[groups[k][0] : groups[n][1]])) is not None:
                sizes = tuple(b - a for a, b in groups[k : n + 1])
                valid.append((sizes not in _CARD_GROUPS, n > k, -digits, k, n, new))
    taken: set[int] = set()
    out = []
    for *_, k, n, new in sorted(valid):
        if taken.isdisjoint(range(k, n + 1)):
            taken.update(range(k, n + 1))
            out.append((groups[k][0], groups[n][1], "card", new))
    return sorted(out)


def _ibans(text: str, replace: Replace) -> Iterator[Found]:
    """Valid IBANs. What follows one may look like a part of it: the country's length is tried first, then the whole, then ends of groups."""
    at = 0
    while (m := _IBAN.search(text, at)) is not None:
        start, at = m.start(), m.start() + 1
        places = [k + 1 for k in range(start, m.end()) if text[k] != " "]
        ends = [m.end(), *(k for k in range(m.end() - 1, start, -1) if text[k] == " ")]
        if (n := IBAN_LENGTHS.get(m[0][:2], 99)) <= len(places):
            ends.insert(0, places[n - 1])
        for end in ends:
            if (new := replace("iban", text[start:end])) is not None:
                yield start, end, "iban", new
                at = end
                break


def _numbers(text: str, at: int, stop: int, replace: Replace) -> Iterator[Found]:
    """Valid number-like values of text[at:stop]. A run of digit groups may hold several cards and values of other kinds."""
    while (m := _NUMBERS.search(text, at, stop)) is not None:
        kind = next(k for k in RULES if k in _NUMBERS.groupindex and m[k])
        if kind != "card":
            new = replace(kind, m[0])
            at = m.start() + 1 if new is None else m.end()
            if new is not None:
                yield m.start(), m.end(), kind, new
            continue
        at = m.start()
        for card in [*_cards(text, m.start(), m.end(), replace), None]:
            while (o := _OTHERS.search(text, at, card[0] if card else stop)) is not None and o.start() < m.end():
                at = o.end()
                if (new := replace(kind := next(k for k in RULES if k in _OTHERS.groupindex and o[k]), o[0])) is not None:
                    yield o.start(), o.end(), kind, new
            if card:
                yield card
                at = card[1]
        at = max(at, m.end())


def find(text: str, replace: Replace) -> list[Found]:
    """(start, end, kind, pseudonym) of the valid values, in order and without overlap."""
    named: list[Found] = []
    if "@" in text:
        named += [(m.start(), m.end(), "email", new) for m in _EMAIL.finditer(text) if (new := replace("email", m[0])) is not None]
    if not _DIGIT.search(text):
        return named
    if _CUE.search(text):
        named += [(*m.span(1), "secret", new) for m in _SECRET.finditer(text) if (new := replace("secret", m[1])) is not None]
    named += _ibans(text, replace)
    found, end = [], 0
    for value in [*sorted(named), (len(text), len(text), "", "")]:
        if value[0] >= end:
            found += _numbers(text, end, value[0], replace)
            found.append(value)
            end = value[1]
    return found[:-1]


def pseudonymise(text: str, key: bytes, replace: Replace | None = None) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and how many of each kind there were."""
    counts: dict[str, int] = {}
    out, end = [], 0
    for start, stop, kind, new in find(text, replace or (lambda kind, value: RULES[kind](value, key))):
        out += [text[end:start], new]
        end = stop
        counts[kind] = counts.get(kind, 0) + 1
    return "".join([*out, text[end:]]), counts


def _batches(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = lru_cache(maxsize=100_000)(lambda kind, value: RULES[kind](value, key))
        for batch in batches:
            texts, counts = [], []
            for text in batch.column("text").to_pylist():
                new, n = pseudonymise(text, key, replace) if text else (text, {})
                texts.append(new)
                counts.append(n)
            columns = [pa.array([n.get(k, 0) for n in counts], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([sum(n.values()) for n in counts], pa.int64()), *columns], names=["doc_id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    return run


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, text with pseudonyms, n_replaced and a count per kind; one row per input row.

    Whole texts are read. A text without valid values is unchanged, a null stays null, ids may be null or
    repeat. Whoever holds the key can invert the mapping; choose it secretly, 1 to 64 bytes.
    """
    schema = "doc_id long, text string, n_replaced long, " + ", ".join(f"n_{k} long" for k in KINDS)
    return arrow_map(docs.select("doc_id", "text"), _batches(key), schema)
