"""Format-preserving pseudonyms for personal data and secrets.

Each value found is validated (check digits, calendar, octets), then permuted within its
format by a keyed alternating Feistel network over mixed radices: a bijection of the
values of that format, so equal values get equal pseudonyms in every document, different
ones stay different, and the holder of the key can undo it. Check digits are computed
anew, dates stay dates, separators stay in place. A date is the same day in every
spelling, and a phone number the same with and without its country code.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomcast.llm.common import worker_keeps

ROUNDS = 10
KINDS = ("email", "secret", "iban", "date", "ip", "card", "ssn", "phone")
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
#: Dates are permuted among the days of these years; others are left alone.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: Letters permuted at once; longer values go block by block, each with the one before it as part of its tweak.
BLOCK = 128
#: The session's configuration of the key.
KEY_SETTING = "spark.loomcast.pii.key"


def session_key(spark: SparkSession) -> bytes:
    """The key that the session's configuration holds under KEY_SETTING.

    Where none is set, a random one is made for this session and kept in it: equal values
    stay linked within the session, and nobody can undo them afterwards.
    """
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING).encode()


class Feistel:
    """Keyed permutation of sequences whose i-th number is below radices[i]."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, tweak: str, turn: int, radices: tuple[int, ...], value: int, below: int) -> int:
        text = f"{tweak}|{turn}|{radices}|{value}".encode()
        size = min(64, 16 + (below.bit_length() + 7) // 8)
        seed = hashlib.blake2b(text, key=self.key, digest_size=size).digest()
        if below.bit_length() > 384:  # wide halves: more bytes than one digest has
            seed = hashlib.shake_256(seed + self.key).digest(16 + (below.bit_length() + 7) // 8)
        return int.from_bytes(seed, "little") % below

    def permute(self, numbers: list[int], radices: list[int], tweak: str, undo: bool = False) -> list[int]:
        split, kept = len(numbers) // 2, tuple(radices)

        def join(part: list[int], bases: list[int]) -> tuple[int, int]:
            value, size = 0, 1
            for x, r in zip(part, bases, strict=True):
                value, size = value * r + x, size * r
            return value, size

        (left, lsize), (right, rsize) = join(numbers[:split], radices[:split]), join(numbers[split:], radices[split:])
        sign = -1 if undo else 1
        for turn in reversed(range(ROUNDS)) if undo else range(ROUNDS):
            if turn % 2:
                left = (left + sign * self._mix(tweak, turn, kept, right, lsize)) % lsize
            else:
                right = (right + sign * self._mix(tweak, turn, kept, left, rsize)) % rsize
        out: list[int] = []
        for value, bases in ((right, radices[split:]), (left, radices[:split])):
            for r in reversed(bases):
                out.append(value % r)
                value //= r
        return out[::-1]

    def text(self, value: str, alphabets: list[str | None], tweak: str, undo: bool = False) -> str:
        """Permutes the characters that have an alphabet; the others stay and are part of the format."""
        at = [i for i, a in enumerate(alphabets) if a]
        shape = "".join("*" if a else c for a, c in zip(alphabets, value, strict=True))
        if len(shape) > BLOCK:
            shape = hashlib.blake2b(shape.encode(), digest_size=16).hexdigest()
        out, before = list(value), ""
        for start in range(0, len(at), BLOCK):
            part = at[start : start + BLOCK]
            sizes = [len(alphabets[i]) for i in part]
            old = [alphabets[i].index(value[i]) for i in part]
            new = self.permute(old, sizes, f"{tweak}|{shape}{before}", undo)
            for i, x in zip(part, new, strict=True):
                out[i] = alphabets[i][x]
            before = f"|{start}|{old if undo else new}"
        return "".join(out)


def alphabet_of(c: str) -> str | None:
    return DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else None


def luhn_digit(digits: str) -> str:
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits)))
    return str(-total % 10)


def _respell(template: str, characters: str) -> str:
    """characters in the places of template's letters and digits."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in template)


def iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


#: What a secret after its name has and an ordinary word hasn't: a digit, or a capital behind a small letter.
_MIXED = re.compile("[0-9]|[a-z][A-Z]")


class Pseudonyms:
    """One method per kind: the pseudonym of a match, or None if it isn't valid."""

    def __init__(self, key: bytes, undo: bool = False) -> None:
        self.feistel, self.undo = Feistel(key), undo

    def _text(self, value: str, alphabets: list[str | None], tweak: str) -> str:
        return self.feistel.text(value, alphabets, tweak, self.undo)

    def email(self, m: re.Match) -> str | None:
        local, _, domain = m[0].rpartition("@")
        return self._text(local, [alphabet_of(c) for c in local], "email@" + domain.lower()) + "@" + domain if any(map(alphabet_of, local)) else None

    def secret(self, m: re.Match) -> str | None:
        kind = next(k for k in ("aws", "token", "pem", "value") if m[k])
        value, at = m[kind], m.start(kind) - m.start()
        if kind == "value" and (known := re.fullmatch(f"(?:(?P<t>{TOKEN})|(?P<a>{AWS}))(?P<rest>.*)", value)) and len(known["rest"]) >= 16:  # a token behind its name
            kind = "token" if known["t"] else "aws"
            at, value = at + known.start("rest"), known["rest"]
        if kind == "value" and not _MIXED.search(value):
            return None  # a word after a colon
        if kind == "aws" and set(value) <= set(UPPER + DIGITS):
            alphabets = [UPPER + DIGITS] * len(value)
        elif kind == "value" and set(value) <= set(HEX):
            alphabets = [HEX] * len(value)
        else:
            alphabets = [alphabet_of(c) for c in value]
            if not any(alphabets):
                return None
        new = self._text(value, alphabets, "secret" if kind == "value" else kind)
        while kind == "value" and not _MIXED.search(new):  # walked on within the permutation, so that it is found again
            new = self._text(new, alphabets, "secret")
        return m[0][:at] + new + m[0][at + len(value) :]

    def iban(self, m: re.Match) -> str | None:
        plain = m[0].replace(" ", "")
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, rest) != check:
            return None
        new = self._text(rest, [DIGITS if c in DIGITS else UPPER for c in rest], "iban" + country)
        return _respell(m[0], country + iban_check(country, new) + new)

    def date(self, m: re.Match) -> str | None:
        if m["y1"]:
            year, month, day, first = m["y1"], m["m1"], m["d1"], None
        else:
            year, first, second = m["y2"], m["a2"], m["b2"]
            day, month = (second, first) if int(first) <= 12 < int(second) else (first, second)
        try:
            ordinal = datetime.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= ordinal <= LAST_DAY:
            return None
        swapped = not m["y1"] and month is first  # month first: only days past 12 read so
        number = ordinal - FIRST_DAY
        while True:  # walk the cycle to the next date that reads back in every spelling: days past 12 go to such days
            number = self._walk(number, LAST_DAY - FIRST_DAY + 1, "date")
            new = datetime.date.fromordinal(number + FIRST_DAY)
            if (new.day > 12) == (int(day) > 12):
                break
        y, mo, d = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
        if m["y1"]:
            return y + m["s1"] + mo + m["s1"] + d
        pair = (mo, d) if swapped else (d, mo)
        return pair[0] + m["s2"] + pair[1] + m["s2"] + y

    def _walk(self, number: int, size: int, tweak: str) -> int:
        side = 1
        while side * side < size:
            side += 1
        while True:
            high, low = self.feistel.permute([number // side, number % side], [side, side], tweak, self.undo)
            number = high * side + low
            if number < size:
                return number

    def ip(self, m: re.Match) -> str | None:
        octets = m[0].split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in octets):
            return None
        return ".".join(map(str, self.feistel.permute([int(o) for o in octets], [256] * 4, "ip", self.undo)))

    def card(self, m: re.Match) -> str | None:
        digits = re.sub(r"\D", "", m[0])
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or digits[0] == "0":
            return None
        middle = self._text(digits[1:-1], [DIGITS] * (len(digits) - 2), "card" + digits[0])
        new = digits[0] + middle
        return _respell(m[0], new + luhn_digit(new))

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = m[0].split("-")
        if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
            return None
        areas = [a for a in range(1, 900) if a != 666]
        a, g, s = self.feistel.permute([areas.index(int(area)), int(group) - 1, int(serial) - 1], [len(areas), 99, 9999], "ssn", self.undo)
        return f"{areas[a]:03d}-{g + 1:02d}-{s + 1:04d}"

    def phone(self, m: re.Match) -> str | None:
        digits = re.sub(r"\D", "", m[0])
        if not 10 <= len(digits) <= 15:
            return None
        keep = len(digits) - 10 if m[0].startswith("+") else 0  # the country code and what lies before ten digits
        own = digits[keep:]  # the same with and without a country code
        places = [DIGITS] * len(own)
        for i in (0, 3):
            if len(own) == 10:
                places[i] = "01" if own[i] in "01" else "23456789"
        shape = "".join(str(len(p)) for p in places)
        return _respell(m[0], digits[:keep] + self._text(own, places, "phone" + shape))


#: How tokens of well-known services start.
TOKEN, AWS = r"gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-(?:proj-|ant-)?|[rs]k_(?:live|test)_|AIza|hf_", "A(?:KI|SI)A"

PATTERNS: dict[str, re.Pattern] = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![A-Za-z0-9-])"),
    "secret": re.compile(
        r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----(?P<pem>[A-Za-z0-9+/=\s\\:,-]{20,20000}?)-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"
        rf"|(?<![A-Za-z0-9])(?:{AWS}(?P<aws>[A-Z0-9]{{16}})(?![A-Za-z0-9])"
        rf"|(?:{TOKEN})(?P<token>[A-Za-z0-9_-]{{20,}}(?<![_-]))(?![A-Za-z0-9])"
        r"|(?:[Pp]ass(?:word|wd|phrase)|PASSWORD|[Pp]wd|[Tt]oken|TOKEN|[Ss]ecret|SECRET|[Aa]pi[_-]?[Kk]ey|API[_-]?KEY)\s{0,3}[=:]\s{0,3}[\"']?(?P<value>[A-Za-z0-9+/_.~-]{7,}[A-Za-z0-9+/_~-]))"
    ),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "date": re.compile(r"(?<![\w./-])(?:(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d{2})(?P=s1)(?P<d1>\d{2})|(?P<a2>\d{2})(?P<s2>[-/.])(?P<b2>\d{2})(?P=s2)(?P<y2>\d{4}))(?![\w/-]|\.\d)"),
    "ip": re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"),
    "card": re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-]|\.\d)|(?<![\w.+-])\+\d{1,3}(?:[ .-]?\d{2,4}){3,5}(?![\w-]|\.\d)"),
}
_DIGIT = re.compile("[0-9]")
#: What a text needs to hold for a kind to be looked for.
_NEEDS = {"email": "@", "ip": "."}


def pseudonymise(text: str, with_: Pseudonyms) -> tuple[str, dict[str, int]]:
    """The text with each valid value replaced, and how many of each kind; earlier kinds win overlaps.

    Matches of a kind come in order and are held against the sorted spans of the kinds
    before it, so the work grows with the text and with the values by n log n.
    """
    if not _DIGIT.search(text) and "@" not in text and "=" not in text and ":" not in text and "-----BEGIN" not in text:
        return text, {}
    spans: list[tuple[int, int, str, str]] = []
    starts: list[int] = []
    for kind in KINDS:
        if _NEEDS.get(kind, "") not in text:
            continue
        make: Callable = getattr(with_, kind)
        new_spans = []
        for m in PATTERNS[kind].finditer(text):
            i = bisect_right(starts, m.start())
            free = (i == 0 or spans[i - 1][1] <= m.start()) and (i == len(spans) or spans[i][0] >= m.end())
            if free and (new := make(m)) is not None:
                new_spans.append((m.start(), m.end(), new, kind))
        if new_spans:
            spans = sorted(spans + new_spans)
            starts = [s[0] for s in spans]
    if not spans:
        return text, {}
    out, at, counts = [], 0, {}
    for a, b, new, kind in spans:
        out += [text[at:a], new]
        at = b
        counts[kind] = counts.get(kind, 0) + 1
    return "".join([*out, text[at:]]), counts


def protect(docs: DataFrame, key: bytes, text_col: str = "text", counts_col: str | None = "pii_counts", undo: bool = False) -> DataFrame:
    """docs with text_col pseudonymised and, unless counts_col is None, a map of counts by kind.

    All other columns are kept as they are. A null text stays null and an empty one empty;
    repeated rows are treated alike; very long texts are scanned whole, in time that grows
    with them and their values; an empty table gives an empty result. An existing column of
    the name counts_col is replaced. key is a secret of the caller's; undo restores the
    values.
    """
    if counts_col is not None:
        docs = docs.drop(counts_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps()
        make = Pseudonyms(key, undo)
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(at).to_pylist():
                new, found = (None, {}) if text is None else pseudonymise(text, make)
                texts.append(new)
                counts.append(list(found.items()))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            names = list(batch.schema.names)
            if counts_col is not None:
                columns.append(pa.array(counts, pa.map_(pa.string(), pa.int32())))
                names.append(counts_col)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema + (f", `{counts_col}` map<string,int>" if counts_col is not None else ""))


def total(counts_col: str = "pii_counts") -> F.Column:
    return F.aggregate(F.map_values(counts_col), F.lit(0), lambda a, x: a + x)
