"""Operator 3, personal data: format-preserving Feistel pseudonyms.

Values are found by pattern and validated (Luhn numbers, mod-97 account
numbers, calendar dates, octets, telephone and social security number rules,
e-mail addresses, assigned secrets with their keyword in any case).  A validated value is replaced by another
valid value of the same format: its digits (or characters, class by class) are
read as a number below the format's size and permuted by a keyed, balanced
Feistel network with cycle walking.  A permutation keeps different values
apart and equal values linked, in whatever document or spelling they occur
(separators stay where they are; the same day in two date formats becomes the
same other day).  Check digits are recomputed, so pseudonyms validate again.

Formats are chosen so that a pseudonym reads back as the same kind of value: a
day is permuted among the days whose month and day have the same number of
digits and whose day could be a month as well or not, so widths are kept and no
pseudonym can stand for two days; secrets of digits alone keep to digits, those
of hexadecimal digits have a letter before and after.

One scan, no shuffle; whole texts.  Values are remembered per worker up to a
bound.

Card and account numbers that run into a following number or upper-case word
are tried at their shorter ends, at the issuer's or country's length first.

Edge cases: null text stays null, an empty text empty; numbers that fail
their check at every end stay as they are; repeated rows are treated alike; a value whose
format has a single member stays the same.  Left as they are by choice: days
outside FIRST_YEAR to LAST_YEAR, and after a keyword words without a digit
("token: internationalisation") or of under 12 characters.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from calendar import monthrange
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Memo, bounded_batches, ddl, pick, text_chunks, text_last
from quarry.sources.tables import load

#: default key of tests and of the query; a deployment passes its own secret
KEY = b"quarry-pseudonym-key"
ROUNDS = 10
FIRST_YEAR, LAST_YEAR = 1900, 2099
#: months of one and of two digits; days of one, of two that may be a month, others
MONTHS = ((1, 9), (10, 12))
DAYS = ((1, 9), (10, 12), (13, 31))


class Feistel:
    """Keyed permutations of 0 .. size-1, one per name."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key).digest()[:32], rounds

    def _round(self, name: str, k: int, half: int, bits: int) -> int:
        data = b"%s|%d|%x" % (name.encode(), k, half)
        size = (bits + 7) // 8
        out = b""
        while len(out) < size:
            out += hashlib.blake2b(data + b"|%d" % len(out), key=self.key, digest_size=min(64, max(1, size))).digest()
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def permute(self, value: int, size: int, name: str) -> int:
        """The image of ``value`` in 0 .. size-1 (cycle walking within the next
        power of four)."""
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        name = f"{name}|{size}"
        while True:
            left, right = value >> bits, value & ((1 << bits) - 1)
            for k in range(self.rounds):
                left, right = right, left ^ self._round(name, k, right, bits)
            value = (left << bits) | right
            if value < size:
                return value


# Patterns of the formats, tried in this order at each place.
PATTERN = re.compile(r"""
  (?P<email>(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+)
| (?P<secret>\b(?i:api[_-]?key|apikey|access[_-]?key|secret|token|password|passwd|pwd|key)\b\s*[=:]\s*["']?)(?P<hidden>[A-Za-z0-9_\-+/]{12,})
| (?P<access>\b(?:AKIA|ASIA)[0-9A-Z]{16}\b)
| (?P<iban>\b[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]{4}){2,7}(?:\ ?[A-Z0-9]{1,3})?\b)
| (?P<iso>(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-]))
| (?P<dot>(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?![\d]|\.\d))
| (?P<slash>(?<![\d/])\d{1,2}/\d{1,2}/\d{4}(?![\d/]))
| (?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d))
| (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
| (?P<phone>(?<![\w+])(?:\+?1[\ .-]?)?(?:\(\d{3}\)\ ?|\d{3}[.-])\d{3}[\ .-]\d{4}(?![\d-]))
| (?P<world>(?<![\w+])\+\d{1,3}(?:[\ .-]?\(?\d{1,4}\)?){2,6}(?!\d))
| (?P<card>(?<![\d-])\d(?:[\ -]?\d){12,18}(?![\d]|-\d))
""", re.X)
#: issuers' leading digits and the lengths of their card numbers, usual ones first
SCHEMES = [(re.compile(lead), lengths) for lead, lengths in (
    (r"4", (16, 13, 19)), (r"5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720", (16,)), (r"3[47]", (15,)),
    (r"30[0-5]|3[689]", (14, 16, 19)), (r"35(?:2[89]|[3-8])", (16, 19)), (r"6(?:011|4[4-9]|[25])", (16, 19)),
    (r"50|5[6-9]|6", (16, 19, 18, 17, 15, 14, 13)))]
#: digits in one run, in fours, or grouped 4-6-5 or 4-6-4
_GROUPED = re.compile(r"\d+|\d{4}(?:[ -]\d{4}){2,}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{4,5}")
#: characters of an account number by country (ISO 13616 registry)
IBAN_LENGTHS = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
#: characters without which no pattern can match
_ANY = re.compile(r"[0-9@=:]|A[KS]IA")


class Days:
    """The days of FIRST_YEAR to LAST_YEAR in one class of MONTHS and DAYS,
    numbered from 0."""

    def __init__(self, months: tuple[int, int], days: tuple[int, int]):
        self.low = days[0]
        self.months, self.starts, self.size = [], [], 0
        for year in range(FIRST_YEAR, LAST_YEAR + 1):
            for month in range(months[0], months[1] + 1):
                self.months.append((year, month))
                self.starts.append(self.size)
                self.size += min(days[1], monthrange(year, month)[1]) - days[0] + 1
        self.place = {m: k for k, m in enumerate(self.months)}

    def number(self, year: int, month: int, day: int) -> int:
        return self.starts[self.place[year, month]] + day - self.low

    def day(self, number: int) -> tuple[int, int, int]:
        k = bisect_right(self.starts, number) - 1
        return *self.months[k], number - self.starts[k] + self.low


def luhn_sum(digits: str) -> int:
    total = 0
    for k, ch in enumerate(reversed(digits)):
        d = int(ch)
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced one by one."""
    it = iter(digits)
    return "".join(next(it) if ch.isdigit() else ch for ch in shape)


class Pseudonyms:
    """Replacement of single values; None means: not valid, leave it."""

    def __init__(self, key: bytes):
        self.net = Feistel(key)
        self.days = {(m, d): Days(m, d) for m in MONTHS for d in DAYS}

    def _digits(self, digits: str, name: str) -> str:
        return str(self.net.permute(int(digits), 10 ** len(digits), name)).zfill(len(digits)) if digits else ""

    def _classes(self, s: str, name: str) -> str:
        """Characters permuted as one number of mixed radix: letters within
        their case, digits among digits, everything else kept."""
        sets = [("abcdefghijklmnopqrstuvwxyz", str.islower), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", str.isupper), ("0123456789", str.isdigit)]
        radix, value, size = [], 0, 1
        for ch in s:
            own = next((a for a, _ in sets if ch in a), None)
            radix.append(own)
            if own:
                value, size = value * len(own) + own.index(ch), size * len(own)
        got = self.net.permute(value, size, name + "|" + "".join("-" if a is None else a[0] for a in radix))
        out = []
        for ch, own in zip(reversed(s), reversed(radix)):
            if own:
                got, d = divmod(got, len(own))
                ch = own[d]
            out.append(ch)
        return "".join(reversed(out))

    def email(self, s: str) -> str:
        local, _, host = s.partition("@")
        host, dot, top = host.rpartition(".")
        return f"{self._classes(local, 'local')}@{self._classes(host, 'host')}{dot}{top}"

    def hidden(self, s: str) -> str | None:
        if not any(ch.isdigit() for ch in s):
            return None
        if s.isdigit():
            return self._digits(s, "digits")
        if _HEX.fullmatch(s):           # hexadecimal stays hexadecimal with a letter, in its case
            value = int(s, 16)
            while True:
                value = self.net.permute(value, 16 ** len(s), "hex")
                got = format(value, f"0{len(s)}{'X' if s.isupper() else 'x'}")
                if not got.isdigit():
                    return got
        while _HEX.fullmatch(s := self._classes(s, "secret")):
            pass
        return s

    def access(self, s: str) -> str:
        return s[:4] + self._classes(s[4:], "access")

    def card(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        if luhn_sum(digits) or len(set(digits)) == 1:
            return None
        body = self._digits(digits[:-1], "card")
        check = next(c for c in "0123456789" if luhn_sum(body + c) == 0)
        return _refill(s, body + check)

    def iban(self, s: str) -> str | None:
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or self._mod97(flat[4:] + flat[:4]) != 1:
            return None
        body = self._classes(flat[4:], "iban")
        check = 98 - self._mod97(body + flat[:2] + "00")
        it = iter(flat[:2] + f"{check:02d}" + body)
        return "".join(ch if ch == " " else next(it) for ch in s)

    @staticmethod
    def _mod97(s: str) -> int:
        return int("".join(str(int(ch, 36)) for ch in s)) % 97

    def _date(self, y: str, m: str, d: str) -> tuple[str, str, str] | None:
        """Another day, its parts as wide as those given."""
        year, month, day = int(y), int(m), int(d)
        if not (FIRST_YEAR <= year <= LAST_YEAR and 1 <= month <= 12 and 1 <= day <= monthrange(year, month)[1]):
            return None
        among = self.days[next(r for r in MONTHS if month <= r[1]), next(r for r in DAYS if day <= r[1])]
        name = f"day {len(str(month))} {among.low}"
        new = among.day(self.net.permute(among.number(year, month, day), among.size, name))
        return tuple(str(n).zfill(len(old)) for n, old in zip(new, (y, m, d)))

    def iso(self, s: str) -> str | None:
        new = self._date(*s.split("-"))
        return new and "-".join(new)

    def dot(self, s: str) -> str | None:
        d, m, y = s.split(".")
        new = self._date(y, m, d)
        return new and ".".join(reversed(new))

    def slash(self, s: str) -> str | None:
        """Month first; day first where only that is a date."""
        a, b, y = s.split("/")
        if int(a) <= 12:
            new = self._date(y, a, b)
            return new and f"{new[1]}/{new[2]}/{new[0]}"
        new = self._date(y, b, a)
        return new and f"{new[2]}/{new[1]}/{new[0]}"

    def ip(self, s: str) -> str | None:
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255:
            return None
        value = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, self.net.permute(value, 1 << 32, "ip").to_bytes(4, "big")))

    def ssn(self, s: str) -> str | None:
        a, g, n = map(int, s.split("-"))
        if a in (0, 666) or a >= 900 or not g or not n:
            return None
        areas, groups, serials = 898, 99, 9999          # 1-665 and 667-899
        value = ((a - 1 - (a > 666)) * groups + g - 1) * serials + n - 1
        value, n = divmod(self.net.permute(value, areas * groups * serials, "ssn"), serials)
        a, g = divmod(value, groups)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{n + 1:04d}"

    def phone(self, s: str) -> str | None:
        """North American numbers: area and exchange start with 2-9."""
        digits = re.sub(r"\D", "", s)
        head, ten = digits[:-10], digits[-10:]
        if head not in ("", "1"):
            return None
        if ten[0] in "01" or ten[3] in "01":        # not dialable: digits only
            return _refill(s, head + self._digits(ten, "plain"))
        value = (((int(ten[0]) - 2) * 100 + int(ten[1:3])) * 8 + int(ten[3]) - 2) * 10 ** 6 + int(ten[4:])
        value, rest = divmod(self.net.permute(value, 64 * 10 ** 8, "phone"), 10 ** 6)
        value, x = divmod(value, 8)
        a, area = divmod(value, 100)
        return _refill(s, head + f"{a + 2}{area:02d}{x + 2}{rest:06d}")

    def world(self, s: str) -> str | None:
        digits = re.sub(r"\D", "", s)
        if not 8 <= len(digits) <= 15:
            return None
        country = len(re.match(r"\+(\d{1,3})", s)[1])
        if country == len(digits):
            country = 2
        return _refill(s, digits[:country] + self._digits(digits[country:], "world"))


def _group_ends(s: str, sep: str) -> list[int]:
    """Ends of the groups of ``s``, the whole first."""
    return [len(s), *[k for k in range(len(s) - 1, 0, -1) if s[k] in sep]]


def _issued(s: str) -> list[str]:
    """Starts of ``s`` that end with a group and have an issuer's leading
    digits and length, conventional groups and usual lengths first."""
    lengths = next((n for lead, n in SCHEMES if lead.match(re.sub(r"\D", "", s[:7]))), ())
    found = []
    for end in _group_ends(s, " -"):
        n = sum(map(str.isdigit, s[:end]))
        if n in lengths:
            found.append((not _GROUPED.fullmatch(s[:end]), lengths.index(n), s[:end]))
    return [value for *_, value in sorted(found)]


def card_ends(s: str) -> list[str]:
    """What a match of the greedy card pattern may hold from its start on, in
    order of preference: numbers of an issuer's length, the whole match, other
    numbers of conventional groups."""
    shorter = [s[:end] for end in _group_ends(s, " -")[1:]]
    others = [v for v in shorter if _GROUPED.fullmatch(v) and sum(map(str.isdigit, v)) >= 13]
    return list(dict.fromkeys([*_issued(s), s, *others]))


def iban_ends(s: str) -> list[str]:
    """The same for account numbers: the country's length, the whole match,
    other ends of groups."""
    ends = [(len(s[:end].replace(" ", "")), s[:end]) for end in _group_ends(s, " ")]
    own = [v for n, v in ends if n == IBAN_LENGTHS.get(s[:2])]
    return list(dict.fromkeys([*own, *[v for n, v in ends if n >= 15]])) or [s]


ENDS = {"card": card_ends, "iban": iban_ends}


def _plain_card(s: str) -> bool:
    return _GROUPED.fullmatch(s) is not None and s in _issued(s)


def _later_card(text: str, begin: int, end: int, new: Memo) -> bool:
    """Whether a valid number of an issuer's length and conventional groups
    starts at a later group of the match, so that one of other form would cut
    it in two."""
    for k in range(begin + 1, end):
        if text[k - 1] == " " and (m := PATTERN.match(text, k)) and m.lastgroup == "card":
            if any(new["card", v] is not None for v in _issued(m["card"]) if _plain_card(v)):
                return True
    return False


def replace_text(text: str, new: Memo, tally: Counter) -> str:
    """The text with its validated values replaced; ``tally`` counts kinds."""
    if not _ANY.search(text):
        return text
    out, at, start = [], 0, 0
    while m := PATTERN.search(text, start):
        kind = m.lastgroup
        value, begin = m[kind], m.start(kind)
        if kind in ENDS:                # greedy: what follows may have been taken in
            value = next((v for v in ENDS[kind](value) if new[kind, v] is not None), value)
        got = new[kind, value]
        if got is not None and kind == "card" and not _plain_card(value) and _later_card(text, begin, m.end(), new):
            got = None
        if got is None:                 # not valid: another format may start inside
            start = m.start() + 1 if m.end() - m.start() < 64 else m.end()
            continue
        out += [text[at:begin], got]
        at = start = begin + len(value)
        tally[kind] += 1
    return "".join(out) + text[at:] if out else text


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: bytes = KEY) -> DataFrame:
    """All columns of ``docs`` with the text replaced, text last but for the
    counts of replaced values by kind, ``__pii``."""
    source, others = text_last(docs, text_col)
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Pseudonyms(key)
        new = Memo(lambda kv: getattr(made, kv[0])(kv[1]), 100_000)
        for cols, texts in text_chunks(batches):
            fresh, counts = [], []
            for t in texts:
                tally: Counter = Counter()
                fresh.append(replace_text(t, new, tally) if t else t)
                counts.append(sorted(tally.items()))
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(fresh, pa.string()), pa.array(counts, pa.map_(pa.string(), pa.int32()))],
                names=[*names, text_col, "__pii"])

    return source.mapInArrow(run, ddl(source.schema.fields) + ", `__pii` map<string,int>")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = pseudonymise(pick(load(spark, sf_dir, "documents"), "doc_id", "text"))
    total = F.aggregate(F.map_values("__pii"), F.lit(0), lambda a, b: a + b)
    return found.select("doc_id", "text", total.alias("n_replaced"), F.map_keys("__pii").alias("kinds"))
