"""Surrogates for personal data.

Entities are found by their format and checked where the format allows it (Luhn, IBAN remainder, octets). Each gets a
keyed replacement of its own type: numbers, addresses and keys are permuted within all strings of their format (a
Feistel network over mixed radices, so no two meet), names are composed for their gender and script. The same entity
has the same replacement everywhere, however it is spelled. A name is the whole run of capitalised words and particles
behind a title; its words are then replaced wherever else the text has them. A word is one entity in all texts: whether
it is a given name or a surname, and a given name's gender, is what most texts say by their titles. All distinct
entities of the corpus are then compared: where two have one replacement, or one is an original, further attempts are
drawn until all differ.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from ipaddress import IPv6Address, ip_address, ip_network
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CACHES, frugal, joined, limit_batches, salted_lookup, schema_of, text_of, written

DEFAULT_KEY = b"lindero-surrogates"
#: Bits that tell which texts have a replacement of their own: 4 MB that every task gets.
PLACES = 1 << 25
#: Attempts after which a replacement may be longer than its original (its format has too few free strings).
RELAXED = 16

# Titles by gender, and parts of names by script (fixed values).
MALE = "Mr Mister Herr Hr Monsieur Señor Sr Don Signor Господин Κύριος".split()
FEMALE = "Mrs Ms Miss Frau Madame Mme Mademoiselle Mlle Señora Sra Doña Signora Госпожа Κυρία".split()
NEUTRAL = "Dr Prof".split()
#: After these, two of three or more names are surnames.
TWO_SURNAMES = set("Señor Señora Sr Sra Don Doña".split())
PARTICLES = set("af al av bin da das de del della dem den der des di do dos du e el ibn la las le los ten ter van von y zu zum zur".split())
SYLLABLES = {
    "latin": "ba bel bri ca cor da del dor e fen fi ga hal i ja ka len li lo ma mar mi na nor o pa per ra ri ro sa sel ta tor u va ver vi wen ya zo".split(),
    "cyrillic": "ба бо ва ве га го да де жа за зо и ка ки ко ла ле ли ма ми на не по ра ро са се та ти фе ша".split(),
    "greek": "βα γα δα δη θα κα κο λα λε μα μι να νι ξε πα πε ρα ρο σα σο τα τι φα χα".split(),
}
ENDINGS = {"latin": ("n ro s do k".split(), "na la ra ne ta".split(), "son ley mann ez er".split()), "cyrillic": ("н р й м".split(), "на ля ра та".split(), "енко ский".split()), "greek": ("ς νος ρης".split(), "να ρα λια".split(), "ίδης όπουλος".split())}

# Calling codes of one and two digits; all others have three (fixed values).
SHORT_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: Digits that may stand for each other where a number that is not international begins.
BEGINNINGS = ("01", "2345", "6789")
CONTROL_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
_LOCAL = [ip_network(x) for x in ("0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16", "224.0.0.0/3")]

_TITLE = "|".join(sorted(map(re.escape, [*MALE, *FEMALE, *NEUTRAL]), key=len, reverse=True))
_CAPITAL = r"[^\W\d_a-zß-öø-ÿа-яѐ-џά-ώ]"
_WORD = rf"(?!(?:{_TITLE})(?!\w))(?:{_CAPITAL}[\w'’-]+|{_CAPITAL}\.?(?![\w'’-]))"
_PARTICLE = rf"(?:(?:{'|'.join(sorted(PARTICLES))})[ \xa0]+)*"
_NAME = re.compile(rf"(?<!\w)(?P<titles>(?:(?:{_TITLE})\.?[ \xa0]+)+)(?P<names>{_PARTICLE}{_WORD}(?:[ \xa0]+{_PARTICLE}{_WORD})*)")
_POSSESSIVE = re.compile(r"['’]s?$|-+$")
_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9_][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")
_DIGITS = [
    ("ip", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w|[.-]\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w]|[.-]\d)|(?<![\w.+,-])(?<!\d[ ])[6-9]\d{2}(?: \d{3} \d{3}|\.\d{3}\.\d{3}|-\d{3}-\d{3})(?!\w|[ .,-]\d)")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)")),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("national", re.compile(r"(?<![\w-])(?:\d{8}|[XYZ]\d{7})[A-HJ-NP-TV-Z](?![\w-])")),
    ("ip6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)")),
    ("key", re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)")),
    ("secret", re.compile(r"(?i)(?<!\w)(?:token|secret|api[_-]?key|password|passwd|pwd)\b[\"']?\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9+/_-]{8,})")),
]
_TRIGGER = re.compile(r"[0-9]")
_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]
_CLASS = {c: k for k, a in enumerate(_ALPHABETS) for c in a}
_HEX = [set("0123456789abcdef"), set("0123456789ABCDEF")]


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    canon: str


# --- detection ------------------------------------------------------------------------------------------------------


def luhn(digits: str) -> int:
    """Remainder modulo 10; 0 for a valid number."""
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _control_letter(number: str) -> str:
    """Of a national number of eight digits, or of X, Y or Z and seven."""
    return CONTROL_LETTERS[int(number.replace("X", "0").replace("Y", "1").replace("Z", "2")) % 23]


def _address6(raw: str) -> str | None:
    """The short form of an IPv6 address that says more than a few digits."""
    try:
        value = IPv6Address(raw)
    except ValueError:
        return None
    return str(value) if int(value) > 0xFFFF else None


def _two_series(digits: str) -> bool:
    return len(digits) == 16 and 2221 <= int(digits[:4]) <= 2720


def _canon(kind: str, raw: str) -> str | None:
    """One spelling for all of an entity's; None if ``raw`` is not of that kind after all."""
    if kind == "email":
        return raw.lower()
    if kind == "ip":
        return raw if all(int(x) < 256 and str(int(x)) == x for x in raw.split(".")) else None
    if kind in ("phone", "card", "ssn"):
        digits = re.sub(r"\D", "", raw)
        if kind == "card":
            return digits if (digits[0] in "3456" or _two_series(digits)) and not luhn(digits) and len(set(digits)) > 1 else None
        if kind == "phone":
            if len(digits) < 8:
                return None
            if raw[0] != "+":
                return digits
            code = next((digits[:k] for k in (1, 2) if digits[:k] in SHORT_CODES), digits[:3])
            return f"+{code}-{digits[len(code):]}"
        return digits
    if kind == "national":
        return raw if raw[-1] == _control_letter(raw[:-1]) else None
    if kind == "ip6":
        return _address6(raw)
    if kind == "iban":
        packed = raw.replace(" ", "")
        return packed if _iban_rest(packed) == 1 else None
    if kind == "secret":
        return raw if any(c.isdigit() for c in raw) else None
    return raw


def _script(name: str) -> str:
    return next((s for c in name if (s := "cyrillic" if "а" <= c.lower() <= "я" else "greek" if "ά" <= c.lower() <= "ώ" else "latin" if c.isalpha() else None)), "latin")


def _names(text: str) -> list[Entity]:
    """The words of titled names, and further mentions of those words with a capital; a word is one entity in a text."""
    words: list[tuple[int, str]] = []
    role: dict[str, tuple[bool, str]] = {}  # whether it stood beside other words, part of the name
    votes: Counter = Counter()
    for m in _NAME.finditer(text):
        titles = re.findall(r"\w+", m["titles"])
        gender = next(("m" if t in MALE else "f" for t in titles if t not in NEUTRAL), None)
        run: list[tuple[int, str]] = []
        behind = None  # names from here on stand behind a particle
        for part in re.finditer(r"[^ \xa0]+", m["names"]):
            if part[0] in PARTICLES:
                behind = len(run) if behind is None else behind
                continue
            word = _POSSESSIVE.sub("", part[0])
            run.append((m.start("names") + part.start(), word.rstrip(".")))
            if word != part[0]:
                break
        whole = [k for k, (_, word) in enumerate(run) if len(word) > 1]
        if not whole:
            continue
        surnames = whole[-2 if len(whole) > 2 and TWO_SURNAMES & set(titles) else -1]
        surnames = surnames if behind is None else min(surnames, behind)
        for k, (start, word) in enumerate(run):
            mine = (len(run) > 1, "surname" if k >= surnames and len(word) > 1 else "given")
            canon = word.lower()
            if canon not in role or mine[0] > role[canon][0]:
                role[canon] = mine
            if mine[1] == "given" and gender:
                votes[canon, gender] += 1
            words.append((start, word))
    if not words:
        return []
    seen = {start for start, _ in words}
    known = sorted({re.escape(word) for _, word in words if len(word) > 1}, key=len, reverse=True)
    for m in re.finditer(rf"(?i)(?<!\w)(?:{'|'.join(known)})(?!\w)", text):
        if m.start() not in seen and not m[0][0].islower() and m[0].lower() in role:
            words.append((m.start(), m[0]))
    out: list[Entity] = []
    for start, word in sorted(words):
        if out and start < out[-1].end:
            continue  # within a longer name
        canon, script = word.lower(), _script(word)
        m, f = votes[canon, "m"], votes[canon, "f"]
        kind = f"given:{'n' if not m + f else 'f' if f > m else 'm'}:{script}" if role[canon][1] == "given" else f"surname:n:{script}"
        out.append(Entity(start, start + len(word), kind, canon))
    return out


def detect(text: str) -> list[Entity]:
    """The entities of ``text`` in order, none within another; an earlier kind in the list of kinds has precedence."""
    found: list[Entity] = []

    def take(start: int, end: int, kind: str) -> None:
        canon = _canon(kind, text[start:end])
        if canon is not None and all(e.end <= start or end <= e.start for e in found):
            found.append(Entity(start, end, kind, canon))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            take(m.start(), m.end(), "email")
    if _TRIGGER.search(text):
        for kind, pattern in _DIGITS:
            for m in pattern.finditer(text):
                take(*m.span("value" if kind == "secret" else 0), kind)
    found += [n for n in _names(text) if all(e.end <= n.start or n.end <= e.start for e in found)]
    return sorted(found)


# --- replacement ----------------------------------------------------------------------------------------------------


def _number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), key=key[:64]).digest())


def permuted(x: int, n: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of the numbers below ``n``: six Feistel rounds over two near-equal factors, walked until
    the result is below ``n``."""
    if n <= 1:
        return x
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for r in range(0, 6, 2):
            left = (left + _number(key, tweak, r, right)) % a
            right = (right + _number(key, tweak, r + 1, left)) % b
        x = left * b + right
        if x < n:
            return x


def permuted_text(text: str, key: bytes, tweak: str, alphabet: str | None = None, first: str | None = None) -> str:
    """A permutation of all strings that have ``text``'s format: each letter or digit stays of its class; the rest is
    kept. With ``alphabet`` every character is one of it, with ``first`` the first one is one of that."""
    alphabets = [alphabet if alphabet else _ALPHABETS[k] if (k := _CLASS.get(c)) is not None else None for c in text]
    if first:
        alphabets[0] = first
    x, n, shape = 0, 1, []
    for c, a in zip(text, alphabets, strict=True):
        shape.append(c if a is None else str(len(a)) + a[0])
        if a is not None:
            x, n = x * len(a) + a.index(c), n * len(a)
    x = permuted(x, n, key, f"{tweak}|{'.'.join(shape)}")
    out = []
    for c, a in zip(reversed(text), reversed(alphabets), strict=True):
        if a is not None:
            x, i = divmod(x, len(a))
            c = a[i]
        out.append(c)
    return "".join(reversed(out))


def _name(kind: str, canon: str, key: bytes, attempt: int) -> str:
    part, gender, script = kind.split(":")
    seed = _number(key, kind, canon, attempt)
    out = []
    for _ in range(2 + attempt // 4):
        seed, i = divmod(seed, len(SYLLABLES[script]))
        out.append(SYLLABLES[script][i])
    endings = ENDINGS[script][2 if part == "surname" else 1 if gender == "f" else 0 if gender == "m" else seed % 2]
    return "".join(out) + endings[seed // 2 % len(endings)]


def _host_bits(value: int) -> int:
    """Bits of an address in a block for private or local use that say where in the block; 32 outside of those."""
    return next((32 - n.prefixlen for n in _LOCAL if value >> 32 - n.prefixlen == int(n.network_address) >> 32 - n.prefixlen), 32)


def format_of(kind: str, canon: str) -> str:
    """The set of strings that an entity's first replacement is a permutation of; names have none."""
    if ":" in kind:
        return ""
    if kind == "ip":
        value = int(ip_address(canon))
        bits = _host_bits(value)
        return f"ip {bits} {value >> bits if bits < 32 else 0}"
    return f"{kind} " + "".join(str(_CLASS.get(c, c)) for c in canon)


@lru_cache(maxsize=100_000)
def surrogate(kind: str, canon: str, key: bytes = DEFAULT_KEY, attempt: int = 0) -> str:
    """The replacement for an entity, in canonical spelling."""
    tweak = f"{kind}#{attempt}"
    extra = str(_number(key, tweak, canon, "more") % 10 ** (attempt - RELAXED + 1)) if attempt > RELAXED else ""
    if ":" in kind:
        return _name(kind, canon, key, attempt)
    if kind == "email":
        local, _, domain = canon.partition("@")
        labels = domain.split(".")
        kept = 2 if ".".join(labels[-2:]) in ("example.com", "example.org", "example.net") else 1
        own = ".".join(labels[:-kept])
        return (permuted_text(f"{local}@{own}", key, tweak) if own else permuted_text(local, key, tweak) + "@").replace("@", extra + "@", 1) + ("." if own else "") + ".".join(labels[-kept:])
    if kind == "phone":
        head, dash, rest = canon.rpartition("-")
        return head + dash + permuted_text(rest, key, tweak + head, first=next(x for x in BEGINNINGS if rest[0] in x)) + extra
    if kind == "card":
        if _two_series(canon):  # stays in its range of prefixes
            low = 2221 * 10**11
            inner = str(low + permuted(int(canon[:-1]) - low, 500 * 10**11, key, tweak + canon[0]))[1:] + extra
        else:
            inner = permuted_text(canon[1:-1], key, tweak + canon[0]) + extra
        return canon[0] + inner + str(-luhn(canon[0] + inner + "0") % 10)
    if kind == "ip":
        value = int(ip_address(canon))
        bits = _host_bits(value)
        x = value
        while True:  # stays within its block, or else outside of all blocks: a permutation of each
            x = x >> bits << bits | permuted(x & (1 << bits) - 1, 1 << bits, key, f"{tweak}{x >> bits}")
            if _host_bits(x) == bits:
                return str(ip_address(x))
    if kind == "national":
        inner = permuted_text(canon[:-1], key, tweak, None) if canon[0].isdigit() else canon[0] + permuted_text(canon[1:-1], key, tweak + canon[0])
        return inner + extra + _control_letter(inner)
    if kind == "ip6":
        value = int(IPv6Address(canon))
        bits = 64 if value >> 120 in (0xFC, 0xFD, 0xFE) else 112  # a local network, or the first group, stays
        while True:
            value = value >> bits << bits | permuted(value & (1 << bits) - 1, 1 << bits, key, f"{tweak}{value >> bits}")
            if value > 0xFFFF:
                return str(IPv6Address(value))
    if kind == "iban":
        inner = permuted_text(canon[4:], key, tweak + canon[:2]) + extra
        return f"{canon[:2]}{98 - _iban_rest(canon[:2] + '00' + inner):02d}{inner}"
    if kind == "key":
        return canon[:4] + permuted_text(canon[4:], key, tweak) + extra
    if kind == "secret":
        hexadecimal = next((h for h in _HEX if set(canon) <= h), None)
        return permuted_text(canon, key, tweak, "".join(sorted(hexadecimal)) if hexadecimal else None) + extra
    return permuted_text(canon, key, tweak) + extra


CACHES["surrogates"] = surrogate.cache_clear


def rendered(kind: str, raw: str, canon: str) -> str:
    """A replacement in the spelling of ``raw``: its punctuation, spaces and capitals."""
    if ":" in kind or kind == "email":
        if raw.isupper() and (kind == "email" or len(raw) > 1):
            return canon.upper()
        if kind == "email":
            if raw == raw.lower() or len(raw) != len(canon):
                return canon
            return "".join(c.upper() if r.isupper() else c for r, c in zip(raw, canon, strict=True))
        return canon[:1].upper() + (canon[1:] if len(raw) > 1 else "")  # of an initial, an initial
    if kind in ("phone", "card", "ssn", "iban"):
        fill = iter(c for c in canon if c.isalnum())
        out = "".join(next(fill, "") if c.isalnum() else c for c in raw)
        return out + "".join(fill)
    return canon.upper() if kind == "ip6" and raw.isupper() else canon


def replace(text: str, key: bytes = DEFAULT_KEY, special: dict[str, str] | None = None) -> tuple[str, list[tuple[Entity, str]]]:
    """(the text with every entity replaced, the entities with their replacements as written)."""
    out, at, done = [], 0, []
    for e in detect(text):
        canon = (special or {}).get(f"{e.kind}\x1f{e.canon}") or surrogate(e.kind, e.canon, key)
        new = rendered(e.kind, text[e.start : e.end], canon)
        out += [text[at : e.start], new]
        at = e.end
        done.append((e, new))
    return "".join([*out, text[at:]]), done


# --- Spark ----------------------------------------------------------------------------------------------------------


def _entities(docs: DataFrame, key: bytes) -> DataFrame:
    """Distinct (text_key, kind, canon, made) of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, e.kind, e.canon, surrogate(e.kind, e.canon, key)) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for e in set((x._replace(start=0, end=0)) for x in detect(t.as_py()))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)], names=["text_key", "kind", "canon", "made"])

    return limit_batches(docs).select(F.xxhash64(text_of()).alias("text_key"), text_of().alias("text")).mapInArrow(frugal(run), "text_key long, kind string, canon string, made string")


def _held(entities: DataFrame) -> DataFrame:
    """A table of entities, which several plans read."""
    return written(entities, "entities", narrow=True)


def _redrawn(batches: Iterator[pa.RecordBatch], key: bytes, attempt: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [surrogate(k, c, key, attempt) for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.string())], names=["kind", "canon", "made"])


def _space() -> Column:
    """What replacements must differ in: all names of a script are one space, whatever their role and gender."""
    return F.when(F.col("kind").contains(":"), F.concat(F.lit("name:"), F.split("kind", ":")[2])).otherwise(F.col("kind")).alias("space")


def _with_format(entities: DataFrame) -> DataFrame:
    """``entities`` (kind, canon, made) and ``format``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [format_of(k, c) for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["kind", "canon", "made", "format"])

    return entities.select("kind", "canon", "made").mapInArrow(frugal(run), "kind string, canon string, made string, format string")


def collisions_resolved(entities: DataFrame, key: bytes = DEFAULT_KEY, attempts: int = 24) -> DataFrame:
    """(kind, canon, made) of those ``entities`` (kind, canon, made) that need another replacement than their first.

    An entity keeps its replacement if that is no original of its space and no smaller one of the space has it, too; the
    others draw again, against all that are taken, until none is left. Where a format is too full for that (a small block
    of addresses, say: entities are left after ``attempts`` draws), all entities of the format go by its permutation, as
    at first: they all differ, but one's replacement may be another one's original.
    """
    known = _held(entities.groupBy("kind", "canon").agg(F.min("made").alias("made")).withColumn("space", _space()))
    taken = known.select("space", F.col("canon").alias("made"))

    def settled(drawn: DataFrame, taken: DataFrame) -> tuple[DataFrame, DataFrame]:
        first = drawn.groupBy("space", "made").agg(F.min(F.struct("canon", "kind")).alias("owner"))
        marked = joined(joined(drawn, first, ["space", "made"]), taken.distinct().withColumn("gone", F.lit(True)), ["space", "made"], "left")
        fine = (F.col("owner.canon") == F.col("canon")) & (F.col("owner.kind") == F.col("kind")) & F.col("gone").isNull()
        marked = _held(marked.withColumn("fine", fine).select("kind", "canon", "made", "space", "fine"))
        return marked.filter("fine").drop("fine"), marked.filter("not fine").drop("fine")

    # Only replacements drawn twice or equal to an original are looked at again; the rest stays where it is.
    twice = known.groupBy("space", "made").agg(F.count("*").alias("n")).filter("n > 1").select("space", "made")
    suspects = _held(joined(known, twice.unionByName(taken).distinct(), ["space", "made"], "left_semi"))
    _, losers = settled(suspects, taken)
    taken = taken.unionByName(known.select("space", "made"))
    moved: DataFrame | None = None
    for attempt in range(1, attempts + 1):
        if losers.isEmpty():
            break
        drawn = losers.select("kind", "canon").mapInArrow(frugal(lambda b, a=attempt: _redrawn(b, key, a)), "kind string, canon string, made string").withColumn("space", _space())
        won, losers = settled(drawn, taken)
        moved = won if moved is None else moved.unionByName(won)
        taken = taken.unionByName(won.select("space", "made"))
    else:
        named = F.col("kind").contains(":")  # names come from no permutation: what is left of them keeps its last draw
        full = _with_format(losers.filter(~named)).select("format").distinct()
        first = salted_lookup(_with_format(known), full.withColumn("full", F.lit(True)), ["format"], F.col("canon")).filter("full").select("kind", "canon", "made")
        rest = losers.filter(named & (F.col("made") != F.col("canon"))).select("kind", "canon", "made")
        rest = rest.unionByName(moved.select("kind", "canon", "made")) if moved is not None else rest
        return joined(rest, first.select("kind", "canon"), ["kind", "canon"], "left_anti").unionByName(first)
    return (moved if moved is not None else losers.limit(0)).select("kind", "canon", "made")


def _asking(rows: DataFrame, per_text: DataFrame) -> DataFrame:
    """``rows`` with ``asks``: true if their text_key is one of ``per_text``, and for few others. The keys are marked in a
    bitmap of a fixed size, so that no row has to move for the answer."""
    place = F.pmod("text_key", F.lit(PLACES))
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    marks = per_text.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("marks"))
    byte = F.conv(F.hex(F.substring("marks", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.call_function("getbit", byte, (bit % 8).cast("int")) == 1
    return rows.join(F.broadcast(marks), bucket == F.col("bucket"), "left").select(*rows.columns, F.coalesce(marked, F.lit(False)).alias("asks"))


def _with_special(source: DataFrame, per_text: DataFrame) -> DataFrame:
    """``source`` (own, text) with the ``special`` of its text_key in ``per_text``, else null. Only texts that ask for it
    are dealt out by their key; all others stay in the tasks that read them."""
    rows = _asking(source.withColumn("text_key", F.xxhash64(text_of())), per_text)
    asking = rows.filter("asks").drop("asks").withColumn("spread", F.monotonically_increasing_id())
    others = rows.filter("not asks").drop("asks").withColumn("special", F.lit(None).cast(per_text.schema["special"].dataType))
    return others.unionByName(salted_lookup(asking, per_text, ["text_key"], F.col("spread")).drop("spread"))


def _one_kind(entities: DataFrame, key: bytes) -> tuple[DataFrame, DataFrame | None]:
    """``entities`` (kind, canon, made) with each word of a name under one kind, that of most texts; and (kind, canon,
    resolved, made) of the words that some text has under another one (None if there are no names)."""
    of_name = F.col("kind").contains(":")
    named = entities.filter(of_name).groupBy("kind", "canon").agg(F.count("*").alias("texts"))
    named = _held(named.select("kind", "canon", "texts", *[F.split("kind", ":")[k].alias(c) for k, c in enumerate(("part", "gender", "script"))]))
    if named.isEmpty():
        return entities, None
    votes = [F.sum(F.when((F.col("part") == "given") & (F.col("gender") == g), F.col("texts")).otherwise(0)).alias(g) for g in "mfn"]
    votes.append(F.sum(F.when(F.col("part") == "surname", F.col("texts")).otherwise(0)).alias("s"))
    gender = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > 0, "m").otherwise("n")
    given = F.col("m") + F.col("f") + F.col("n")
    kind = F.when((given > 0) & (given >= F.col("s")), F.concat_ws(":", F.lit("given"), gender, "script")).otherwise(F.concat_ws(":", F.lit("surname:n"), "script"))
    resolved = named.groupBy("script", "canon").agg(*votes).select("script", "canon", kind.alias("kind"))
    made = _held(resolved.select("kind", "canon").mapInArrow(frugal(lambda b: _redrawn(b, key, 0)), "kind string, canon string, made string"))
    to = made.select(F.split("kind", ":")[2].alias("script"), "canon", F.col("kind").alias("resolved"), "made")
    changed = joined(named.select("script", "canon", "kind"), to, ["script", "canon"]).filter("kind <> resolved").select("kind", "canon", "resolved", "made")
    return entities.filter(~of_name).unionByName(made), _held(changed)


def with_surrogates(docs: DataFrame, key: bytes = DEFAULT_KEY) -> DataFrame:
    """``docs`` with ``text`` replaced, and n_entities and kinds (such as ``card:1,email:2``) behind the other columns.

    A null text stays null and an empty one empty, with no entities; rows that repeat get equal texts; an empty table
    gives no rows; texts are searched whole. Columns called n_entities or kinds are replaced.
    """
    entities = written(_entities(docs, key), "detected", narrow=True)
    resolved, changed = _one_kind(entities.select("kind", "canon", "made"), key)
    special = _held(collisions_resolved(resolved, key))
    if changed is not None:
        other = special.select(F.col("kind").alias("resolved"), "canon", F.col("made").alias("again"))
        moved = joined(changed, other, ["resolved", "canon"], "left").select("kind", "canon", F.coalesce("again", "made").alias("made"))
        special = _held(special.unionByName(moved))
    # The caller's columns travel as one, whatever they are called.
    others = [c for c in docs.columns if c not in ("text", "n_entities", "kinds")]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias(_none_of(others))).alias("own"), F.col("text").cast("string").alias("text"))
    if special.isEmpty():
        source = source.withColumn("special", F.lit(None).cast("map<string,string>"))
    else:
        per_text = salted_lookup(entities.select("text_key", "kind", "canon"), special, ["kind", "canon"], F.col("text_key")).filter("made is not null")
        per_text = per_text.groupBy("text_key").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "canon"), "made"))).alias("special"))
        source = _with_special(source, written(per_text, "special", narrow=True)).select("own", "text", "special")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n, kinds = [], [], []
            for text, its in zip(batch.columns[1], batch.columns[2], strict=True):
                new, done = (None, []) if not text.is_valid else replace(text.as_py(), key, dict(its.as_py()) if its.is_valid else None)
                texts.append(new)
                n.append(len(done))
                kinds.append(",".join(f"{k}:{v}" for k, v in sorted(Counter(e.kind.split(":")[0] for e, _ in done).items())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(n, pa.int32()), pa.array(kinds, pa.string())], names=["own", "text", "n_entities", "kinds"])

    kind = T.StructType([source.schema["own"], *schema_of("text string, n_entities int, kinds string").fields])
    done = source.mapInArrow(frugal(run), kind)
    kept = [F.col("text") if c == "text" else F.col("own").getField(c).alias(c) for c in docs.columns if c not in ("n_entities", "kinds")]
    return done.select(*kept, "n_entities", "kinds")


def _none_of(names: list[str]) -> str:
    """A name that is none of ``names``, so that a struct of them is never empty."""
    out = "_"
    while out in names:
        out += "_"
    return out
