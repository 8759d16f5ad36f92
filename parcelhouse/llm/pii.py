"""Replaces personal data by keyed surrogates of the same kind, script and format."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import itertools
import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.llm.common import id_and_text, table, written
from parcelhouse.llm.exact_dedup import key_filter, passes

# A word that makes up this share of all words in lower case, and is no oftener capitalised, is
# no part of a name. So there are at most 1 / COMMON_SHARE such words, at any size of the corpus.
COMMON_SHARE = 1 / 20_000
COUNTED_WORDS = 200_000
# Titles with the gender they tell, and common given names: f, m, or u if they do not tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Herr": "m", "Herrn": "m", "Frau": "f",
    "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f", "Sr": "m", "Sra": "f",
    "Señor": "m", "Señora": "f", "Dr": "u", "Prof": "u", "господин": "m", "госпожа": "f",
    "Господин": "m", "Госпожа": "f", "κύριος": "m", "Κύριος": "m", "κύριο": "m", "κυρία": "f",
    "Κυρία": "f", "κ": "u", "السيد": "m", "السيدة": "f", "الدكتور": "u", "श्री": "m", "श्रीमती": "f",
    "डॉ": "u", "מר": "m", "גברת": "f", "ד״ר": "u",
}
# Titles that follow the name, and words before a name in running text or a form.
SUFFIXES = {"先生": "m", "女士": "f", "小姐": "f", "さん": "u", "様": "u", " 씨": "u", "씨": "u"}
CUES = (
    "[Mm]y name is", "[Ii]ch heiße", "[Mm]ein Name ist", "[Jj]e m['’]appelle", "[Mm]e llamo",
    "[Мм]еня зовут", "(?:Full [Nn]ame|Name|Contact|Patient|Customer|Signed|Kontakt|Nom|Nombre|Имя):",
)
GIVEN = {
    "f": "Anna Maria Julia Laura Sophie Claire Marie Emma Olivia Elena Lucía Carmen Susan Mary "
         "Linda Sarah Petra Sabine Анна Мария Елена Ольга",
    "m": "John James Robert Michael David Peter Thomas Hans Klaus Stefan Pierre Jean Louis "
         "Carlos José Juan Miguel Иван Пётр Сергей Алексей",
}
GENDERS = {name: gender for gender, names in GIVEN.items() for name in names.split()}
# Vowels, syllables and endings surrogate names are made of; in other scripts, letters.
VOWELS = {"latin": "aeio", "cyrillic": "аеио", "greek": "αειο"}
SYLLABLES = {
    "greek": ("βα βε βο δα δε δο κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε πο ρα ρε ρι "
              "ρο σα σε σο τα τε το φα φε").split(),
    "latin": ("ba be bo da de do fa fe ga go ka ke ki ko la le li lo ma me mi mo na ne ni no pa "
              "pe ra re ri ro sa se si so ta te ti to va ve vi vo").split(),
    "cyrillic": ("ба бе бо да де до га го ка ке ки ко ла ле ли ло ма ме ми мо на не ни но па пе "
                 "ра ре ри ро са се си со та те ти то ва ве ви во").split(),
}
ENDINGS = {
    "greek": {"f": "να λα ρα λια".split(), "m": "νος ρος λος".split(), "u": "ι ε".split(),
              "surname": "κης πουλος ρας νου".split()},
    "latin": {"f": "na la ra lia nia".split(), "m": "n r l s rd".split(), "u": "y e ie".split(),
              "surname": "ner mann ley son rel".split()},
    "cyrillic": {"f": "на ла ра лия ния".split(), "m": "н р л с рд".split(), "u": "и е".split(),
                 "surname": "нов рин лев сон".split()},
}


def _upper_class() -> str:
    """All upper-case letters, as the inside of a character class."""
    codes = [c for c in range(sys.maxunicode + 1) if chr(c).isupper() and chr(c).isalpha()]
    starts = [c for c in codes if not (chr(c - 1).isupper() and chr(c - 1).isalpha())]
    ends = [c for c in codes if not (chr(c + 1).isupper() and chr(c + 1).isalpha())]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


_TITLES = "|".join(sorted(map(re.escape, TITLES), key=len, reverse=True))
_GIVENS = "|".join(sorted(map(re.escape, GENDERS), key=len, reverse=True))
_CUES = "|".join(CUES)
_SUFFIXES = "|".join(SUFFIXES)
_UPPER = _upper_class()
# Letters and marks of scripts without case; marks are no \w.
_FREE = (r"א-תؠ-ٟٮ-ۓऀ-ॣঀ-෿ก-๎"
         r"ぁ-ヺ㐀-鿿가-힣")
_HAN, _HANGUL = r"㐀-鿿", r"가-힣"
# A capitalised part of a name, or initials: J., J.R., or J before another part.
_PART = (
    rf"(?:(?!(?:{_TITLES})(?!\w))[{_UPPER}](?:[^\W\d_]|[’'-](?=[^\W\d_]))+(?!\w)"
    rf"|[{_UPPER}](?:\.-?[{_UPPER}])*\.(?!\w)|[{_UPPER}](?= [{_UPPER}]))")
_LINKS = r"(?:(?:von|van|vom|zu|zum|der|den|de|del|della|la|las|los|le|da|das|di|do|dos|du|el) ){0,3}"
_NAME = rf"{_LINKS}{_PART}(?: {_LINKS}{_PART})*"
_FREE_NAME = rf"[{_FREE}]{{2,}}(?: [{_FREE}]{{2,}})?(?![{_FREE}])"
FORMATS = re.compile(
    r"(?P<email>[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})"
    r"|(?P<ip>(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w]|\.\d))"
    r"|(?P<ipv6>(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:]))"
    r"|(?P<secret>(?<!\w)(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*\d)[0-9a-fA-F]{24,128}(?!\w))"
    r"|(?P<key>(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-(?=[A-Za-z_-]*\d)[\w-]{16,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[\w-]{10,}\.[\w-]{10,}(?:\.[\w-]+)?"
    r"|(?=[A-Za-z0-9]{24})(?=[a-z0-9]*[A-Z])(?=[A-Z0-9]*[a-z])(?=[A-Za-z]*\d)[A-Za-z0-9]{24,128})(?!\w))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?=(?:[A-Z ]*\d){8})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<national>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4}"
    r"|(?<![,:/-])0(?:\d(?:[ .]\d{2}){4}|\d{2,4}[ /-]\d{3,4}(?:[ -]?\d{2,4}){1,2}))(?!\w))")
NAMES = re.compile(
    rf"(?<!\w)(?:(?P<title>(?:(?:{_TITLES})\.? )+)(?P<titled>{_NAME}|{_FREE_NAME})"
    rf"|(?:{_CUES}) ?(?P<cued>{_NAME}|{_FREE_NAME})"
    rf"|(?P<full>(?:{_GIVENS})(?: {_LINKS}{_PART})+))"
    rf"|(?P<before>[{_HAN}]{{2,3}}|(?<!\w)[{_HANGUL}]{{2,4}})(?P<suffix>{_SUFFIXES})")
# What a text with an entity of either sort holds; found fast, as most texts hold neither.
_HINT = re.compile(r"[0-9@]")
_NAME_HINT = re.compile(rf"(?:{_TITLES}|{_GIVENS})(?!\w)")
_CUE_HINTS = (
    "y name is", "ch heiße", "ein Name ist", "appelle", "e llamo", "еня зовут", "ame:", "Contact:", "Patient:",
    "Customer:", "Signed:", "Kontakt:", "Nom:", "Nombre:", "Имя:", *SUFFIXES)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _person(
    at: int, names: str, gender: str, common: frozenset[str] = frozenset(),
) -> Iterator[tuple[int, int, str, str]]:
    """The parts of a name: given names, the last whole part as the surname, and initials.

    A name ends before a common word, unless that is its first part or follows a listed given name.
    """
    parts = []
    for token in names.split(" "):
        if token[:1].isupper() or (token and not token[0].islower()):
            core = token[:-2] if token[-2:] in ("'s", "’s") else token
            if core.lower() in common and parts and parts[-1][1] not in GENDERS:
                break
            parts.append((at, core, core[0].isupper() and ("." in core or len(core) == 1)))
        at += len(token) + 1
    surname = max((start for start, _, initial in parts if not initial), default=-1)
    for start, core, initial in parts:
        value = core.lower()
        if initial:
            kind = "initial"
        elif start == surname:
            kind = "surname"
        else:
            kind = f"given_{GENDERS.get(core, gender)}"
        yield start, start + len(core), kind, value


def _named(m: re.Match, common: frozenset[str]) -> list[tuple[int, int, str, str]]:
    """The parts of the name that a match of NAMES found by its title, cue or given name."""
    if m["title"]:
        told = [TITLES[t.rstrip(".")] for t in m["title"].split()]
        gender = next((g for g in told if g != "u"), "u")
        return list(_person(m.start("titled"), m["titled"], gender, common))
    if m["cued"]:
        gender = GENDERS.get(m["cued"].split(" ")[0], "u")
        return list(_person(m.start("cued"), m["cued"], gender, common))
    if m["before"]:
        return [(m.start("before"), m.end("before"), "surname", m["before"])]
    return list(_person(m.start("full"), m["full"], GENDERS[m["full"].split(" ")[0]], common))


def _formatted(text: str) -> Iterator[tuple[int, int, str, str]]:
    """The entities of a text that FORMATS describe."""
    for m in FORMATS.finditer(text):
        kind, value = m.lastgroup, m[0]
        if kind == "email" or kind == "secret":
            value = value.lower()
        elif kind == "ipv6":
            try:
                value = ipaddress.IPv6Address(value).exploded
            except ValueError:
                continue
        elif kind == "iban":
            value = value.replace(" ", "")
        elif kind in ("card", "phone", "national"):
            value = _digits(value)
        yield m.start(), m.end(), kind, value


def mentions(
    text: str, common: frozenset[str] = frozenset()
) -> list[tuple[int, int, str, str]]:
    """Start, stop, kind and canonical form of each detected entity, in text order.

    Names are taken apart, so that a person mentioned by title and family name refers to
    the same surrogate as by the full name. Where a name was detected, its parts are also
    entities where they stand alone in the same text, capitalised, if they are no `common` words.
    The gender in the kind of a given name is what this mention tells.
    """
    out = list(_formatted(text)) if _HINT.search(text) else []
    if not (_NAME_HINT.search(text) or any(cue in text for cue in _CUE_HINTS)):
        return out
    held = [(start, stop) for start, stop, _, _ in out]
    names: dict[str, str] = {}
    at = k = 0
    while m := NAMES.search(text, at):
        while k < len(held) and held[k][1] <= m.start():
            k += 1
        if k < len(held) and held[k][0] <= m.start():
            # Within an address or a number.
            at = held[k][1]
            continue
        found = _named(m, common)
        out += found
        # What the name does not hold is looked through again.
        at = found[-1][1]
        for _, _, part, value in found:
            if part != "initial" and value not in common:
                names.setdefault(value, part)
    if not names:
        return out
    # Nothing parts words in Han script.
    dense = re.compile(rf"[{_HAN}]+")
    bare = re.compile("|".join(
        re.escape(n) if dense.fullmatch(n) else rf"(?<!\w){re.escape(n)}(?!\w)"
        for n in sorted(names, key=len, reverse=True)), re.I)
    out.sort()
    spans, alone, at = list(out), [], 0
    for m in bare.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        value = m[0].lower()
        # Scripts without case have no capitals to ask for.
        if not m[0][0].islower() and value in names and (at == len(spans) or spans[at][0] >= m.end()):
            alone.append((m.start(), m.end(), names[value], value))
    return sorted(out + alone) if alone else out


def common_words(rows: DataFrame, share: float = COMMON_SHARE) -> frozenset[str]:
    """Words that make up `share` of all words or more in lower case, and that stand capitalised
    no oftener. There are at most 1 / share of them, whatever the size of the corpus.

    Words are counted within each task, so that a shuffle moves vocabularies and no texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counts(seen: Counter) -> pa.RecordBatch:
            lower, other = Counter(), Counter()
            for token, n in seen.items():
                word = token.strip(".,;:!?\"'()[]«»„“”")
                if word.isalpha():
                    (lower if word.islower() else other)[word.lower()] += n
            words = [*lower.keys(), *(w for w in other if w not in lower)]
            return pa.RecordBatch.from_arrays(
                [pa.array([*words, None], pa.string()),
                 pa.array([*(lower[w] for w in words), seen.total()], pa.int64()),
                 pa.array([*(other[w] for w in words), 0], pa.int64())], ["word", "lower", "other"])

        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(text.as_py().split())
                if len(seen) > COUNTED_WORDS:
                    yield counts(seen)
                    seen = Counter()
        yield counts(seen)

    found = written(
        rows.select("text").mapInArrow(run, "word string, lower long, other long")
        .groupBy("word").agg(F.sum("lower").alias("lower"), F.sum("other").alias("other")))
    total = found.where("word is null").select("lower").collect()
    if not total or not total[0]["lower"]:
        return frozenset()
    least = max(1, share * total[0]["lower"])
    # Their shares add up to one at most, which bounds what is collected.
    return frozenset(r["word"] for r in found.where(
        F.col("word").isNotNull() & (F.col("lower") >= F.lit(least)) & (F.col("lower") >= F.col("other"))
    ).select("word").collect())


class _Stream:
    """Keyed pseudo-random numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.block = key, 0
        self.seed = f"{kind}\x00{value}\x00{attempt}".encode("utf-8", "surrogatepass")
        self.data = b""

    def below(self, n: int) -> int:
        if len(self.data) < 4:
            self.data += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"),
                                  hashlib.sha256).digest()
            self.block += 1
        number, self.data = int.from_bytes(self.data[:4], "big"), self.data[4:]
        return number % n


CORE = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
# Scripts of which only the characters of a common character set are drawn.
DRAWN_FROM = {"cjk": "gb2312", "hangul": "euc_kr"}


@lru_cache(maxsize=100_000)
def _script(c: str) -> str:
    """The script of a letter, by the first word of its Unicode name."""
    return unicodedata.name(c, "latin").split(" ")[0].lower()


@lru_cache(maxsize=1000)
def _letters(script: str, core: bool) -> str:
    """The lower-case or caseless letters of a script: the CORE ones, or all others."""
    known = CORE.get(script, "")
    if core and known:
        return known
    coding, out = DRAWN_FROM.get(script), []
    block = None
    for code in range(0xC0, 0x10000):
        c = chr(code)
        if unicodedata.category(c) not in ("Ll", "Lo") or c in known or _script(c) != script:
            continue
        if unicodedata.normalize("NFKD", c) != c and script != "hangul":
            continue
        try:
            if coding:
                c.encode(coding)
        except UnicodeEncodeError:
            continue
        if not known and not coding:
            # Without rare additions, which lie elsewhere.
            block = code >> 8 if block is None else block
            if code >> 8 != block:
                continue
        out.append(c)
    return "".join(out)


def _alphabet(c: str) -> str:
    script = _script(c)
    return _letters(script, c in CORE.get(script, c))


def _like(text: str, stream: _Stream) -> str:
    """Letters for letters of the same script and case, digits for digits, the rest as it is."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(stream.below(10)))
        elif c.isalpha():
            # An accent goes with the letter it stands on.
            base = unicodedata.normalize("NFKD", c.lower())[0] if _script(c) != "hangul" else c
            letters = _alphabet(base) or base
            drawn = letters[stream.below(len(letters))]
            out.append(drawn.upper() if c.isupper() else drawn)
        else:
            out.append(c)
    return "".join(out)


@lru_cache(maxsize=1000)
def _turned(key: bytes, letters: str) -> dict[str, str]:
    """For each letter another one, different for different letters, in an order the key tells."""
    order = sorted(letters, key=lambda c: hmac.new(key, f"letter\x00{c}".encode(), hashlib.sha256).digest())
    return dict(zip(order, order[1:] + order[:1]))


def _initial(key: bytes, c: str) -> str:
    """The first letter of the surrogates of names that begin with c; accents stay on it."""
    if not c.isalpha():
        return c
    base, *marks = unicodedata.normalize("NFD", c)
    letters = _alphabet(base)
    return unicodedata.normalize("NFC", _turned(key, letters).get(base, base) + "".join(marks))


def _luhn(digits: str) -> int:
    """What the check digit of digits + "0" must be."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (2 if k % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def _iban_check(country: str, rest: str) -> int:
    """What the two check digits of an account number must be."""
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _classed(text: str, stream: _Stream) -> str:
    """ASCII letters and digits for ones of the same class, the rest as it is."""
    classes = (("0", "9", 10), ("a", "z", 26), ("A", "Z", 26))
    out = []
    for c in text:
        first = next(((a, n) for a, z, n in classes if a <= c <= z), None)
        out.append(chr(ord(first[0]) + stream.below(first[1])) if first else c)
    return "".join(out)


def draw(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical surrogate of a canonical entity; the same for the same key and attempt.

    Every eighth attempt widens short formats: more letters or digits, or numbers of any length.
    So there is always another surrogate to draw.
    """
    more = attempt // 8
    stream = _Stream(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        host = "".join(_like(label, stream) + "." for label in labels[:-2])
        return f"{_like(local, stream)}{_like('a' * more, stream)}@{host}example.{('com', 'org', 'net')[stream.below(3)]}"
    if kind == "ipv6" or kind == "ip" and more >= 8:
        # In the range kept for documentation; zero groups stay zero at first.
        groups = value.split(":")[2:] if kind == "ipv6" else ["1"] * 6
        return ":".join(["2001", "0db8"] + [
            f"{1 + stream.below(0xFFFF):04x}" if more or int(g, 16) else "0000" for g in groups])
    if kind == "ip":
        spans = {1: (1, 10), 2: (10, 100), 3: (100, 256)}
        if more:
            spans = dict.fromkeys(spans, (1, 256))
        return ".".join(
            str(spans[len(part)][0] + stream.below(spans[len(part)][1] - spans[len(part)][0]))
            for part in value.split("."))
    if kind == "secret":
        return "".join("0123456789abcdef"[stream.below(16)] for _ in value)
    if kind == "key":
        at = re.match(r"AKIA|ASIA|gh._|sk-|xox.-|eyJ|", value).end()
        return value[:at] + _classed(value[at:], stream) + _classed("0" * more, stream)
    if kind == "iban":
        country, rest = value[:2], _classed(value[4:], stream) + _classed("0" * more, stream)
        check, valid = _iban_check(country, rest), int(value[2:4]) == _iban_check(country, value[4:])
        return f"{country}{check if valid else (check + 1 + stream.below(96)) % 100:02d}{rest}"
    if kind == "national":
        # First digits that are never given out.
        first = str(stream.below(10)) if more else "9"
        return first + "".join(str(stream.below(10)) for _ in range(len(value) - 1 + max(0, more - 1)))
    if kind == "card":
        digits = value[0] + "".join(str(stream.below(10)) for _ in range(len(value) - 2 + more))
        valid = int(value[-1]) == _luhn(value[:-1])
        check = _luhn(digits)
        return digits + str(check if valid else (check + 1 + stream.below(9)) % 10)
    if kind == "phone":
        keep = 1 if len(value) > 10 or value[0] == "0" else 0
        return value[:keep] + str(2 + stream.below(8)) + "".join(
            str(stream.below(10)) for _ in range(len(value) - keep - 1 + more))
    if kind == "initial":
        return "".join(_initial(key, c) for c in value)
    script = _script(next((c for c in value if c.isalpha()), "a"))
    if script not in SYLLABLES:
        # Letter by letter; vowel signs stay. Short names grow soon, as they are soon used up.
        letters = _letters(script, True) or CORE["latin"]
        return _like(value, stream) + "".join(
            letters[stream.below(len(letters))] for _ in range(attempt // 2))
    # The first letter is that of the initials. Rising lengths for later attempts.
    first = _initial(key, value[0])
    vowels, syllables = VOWELS[script], SYLLABLES[script]
    ending = ENDINGS[script]["surname" if kind == "surname" else kind[-1]]
    start = first if unicodedata.normalize("NFD", first)[0] in vowels else first + vowels[
        stream.below(len(vowels))]
    size = 1 + stream.below(2) + attempt // 4
    return start + "".join(syllables[stream.below(len(syllables))] for _ in range(size)) + ending[
        stream.below(len(ending))]


def written_like(surrogate: str, kind: str, mention: str) -> str:
    """A canonical surrogate in the format of a mention: its case, or its separators."""
    if kind in ("card", "phone", "national"):
        digits = iter(surrogate)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if kind == "iban":
        signs = iter(surrogate)
        return "".join(c if c == " " else next(signs) for c in mention) + "".join(signs)
    if kind == "ipv6":
        address = ipaddress.IPv6Address(surrogate)
        found = address.compressed if "::" in mention else ":".join(
            f"{int(g, 16):x}" for g in address.exploded.split(":"))
        return found.upper() if any("A" <= c <= "F" for c in mention) else found
    if kind == "key":
        return surrogate
    if kind == "email" or kind == "ip":
        return surrogate.upper() if mention.isupper() else surrogate
    if mention.isupper():
        return surrogate.upper()
    if kind != "secret" and mention[:1].isupper():
        return surrogate[:1].upper() + surrogate[1:]
    return surrogate


def pseudonymised(
    text: str, key: bytes, special: dict[tuple[str, str], tuple[str, int]],
    common: frozenset[str] = frozenset(),
) -> tuple[str, int]:
    """The text with a surrogate for every mention, and how many were replaced.

    `special` holds the kind and attempt to draw by where these are not the mention's kind and 0.
    """
    out, at, n = [], 0, 0
    cached = _cached_draw
    for start, stop, kind, value in mentions(text, common):
        drawn, attempt = special.get((kind, value), (kind, 0))
        surrogate = cached(key, drawn, value, attempt)
        out += [text[at:start], written_like(surrogate, kind, text[start:stop])]
        at, n = stop, n + 1
    return ("".join(out) + text[at:], n) if n else (text, 0)


@lru_cache(maxsize=100_000)
def _cached_draw(key: bytes, kind: str, value: str, attempt: int) -> str:
    return draw(key, kind, value, attempt)


def entities(rows: DataFrame, common: frozenset[str] = frozenset()) -> DataFrame:
    """kind and value of all different entities of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(k, v) for t in batch.column("text") for _, _, k, v in mentions(t.as_py(), common)}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], pa.string()),
                 pa.array([v for _, v in found], pa.string())], ["kind", "value"])

    return rows.select("text").mapInArrow(run, "kind string, value string").distinct()


def redrawn(found: DataFrame, key: bytes) -> DataFrame:
    """kind, value and attempt of the entities whose first surrogate cannot be used.

    A surrogate is refused if another entity of its kind has it or if it is itself an
    entity of the texts. Of entities that draw the same one, the first keeps it; the others draw
    again until all surrogates differ. Only counts reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [draw(key, k, v, a) for k, v, a in zip(*(
                batch.column(c).to_pylist() for c in ("kind", "value", "attempt")))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(drawn, pa.string())],
                ["kind", "value", "attempt", "surrogate"])

    # Given names of either gender must differ from one another, too.
    family = F.regexp_replace("kind", "_.$", "")
    schema = "kind string, value string, attempt int, surrogate string"
    current = written(found.withColumn("attempt", F.lit(0)).mapInArrow(run, schema))
    real = found.select(family.alias("family"), F.col("value").alias("surrogate")).distinct()
    # Formats widen with the attempts, so this ends.
    for _ in itertools.count():
        named = current.withColumn("family", family)
        owners = named.groupBy("family", "surrogate").agg(
            F.min(F.struct("attempt", "value", "kind")).alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = owners.where("n > 1").select("family", "surrogate", "owner")
        taken = named.select("family", "surrogate").distinct().join(
            real, ["family", "surrogate"], "left_semi").withColumn(
            "owner", F.lit(None).cast(shared.schema["owner"].dataType))
        refused = written(
            shared.join(taken, ["family", "surrogate"], "left_anti").unionByName(taken))
        if refused.isEmpty():
            break
        own = F.struct("attempt", "value", "kind")
        again = (
            named.join(refused, ["family", "surrogate"])
            .where(F.col("owner").isNull() | (own != F.col("owner")))
            .select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        )
        rest = current.join(again, ["kind", "value"], "left_anti")
        current = written(rest.unionByName(again.mapInArrow(run, schema)))
    return current.where("attempt > 0").select("kind", "value", "attempt")


def resolved(found: DataFrame, key: bytes) -> DataFrame:
    """kind, value, drawn (the kind to draw by) and attempt of the entities that need more than
    a first draw by their kind.

    A given name has one gender: the one its mentions in all texts tell, or none if they tell
    both. Initials are not compared: the letters are exchanged for one another, so different ones
    differ.
    """
    whole = found.where("kind != 'initial'")
    given = F.col("kind").startswith("given_")
    female, male = (F.max(F.col("kind") == f"given_{g}") for g in "fm")
    genders = written(
        whole.where(given).groupBy("value").agg(
            F.when(female & ~male, "given_f").when(male & ~female, "given_m")
            .otherwise("given_u").alias("drawn")))
    kinds = written(
        whole.where(given).join(genders, "value").select("kind", "value", "drawn")
        .unionByName(whole.where(~given).select("kind", "value", F.col("kind").alias("drawn"))))
    again = redrawn(kinds.select(F.col("drawn").alias("kind"), "value").distinct(), key)
    again = again.withColumnRenamed("kind", "drawn")
    return (
        kinds.join(again, ["drawn", "value"], "left").na.fill(0, ["attempt"])
        .where("kind != drawn or attempt > 0").select("kind", "value", "drawn", "attempt")
    )


def pseudonymise(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with personal data replaced, and n_replaced.

    E-mail and IP addresses, account, card, phone and national numbers, secrets (long hexadecimal
    strings, keys of mixed letters and digits) and names of persons become surrogates that
    depend on the entity, the gender of a given name and the secret `key` only: the same entity
    has the same one everywhere. Names are found after or before a title, after words such as "my name
    is" or after a common given name, with all their parts and initials, up to a word that the
    corpus has often in lower case (`common_words`); and these parts also where they stand
    alone in the same text. Surrogates keep gender, script, case, separators, lengths of numbers
    and the validity of check digits. Names that begin with the same letter have surrogates that
    begin with the same one, so initials go on fitting. Different entities have different
    surrogates, and none but an initial is an entity of the texts: all surrogates are compared,
    and where two collide one is drawn again, longer if the format is used up.

    Only different entities are shuffled, and the few documents with a redrawn one, never the
    texts of all. Null texts stay null. Rows that repeat an id are treated alike; null ids are
    kept. Other columns stay; one called n_replaced is replaced. An empty table gives an
    empty one.
    """
    rows = id_and_text(docs, id_col, text_col)
    common = common_words(rows)
    again = written(resolved(written(entities(rows, common)), key))
    names = [c for c in docs.columns if c != "n_replaced"]
    keyed = docs.select(*names, F.xxhash64(docs[text_col]).alias("__pc_text_key"))

    def rewritten(frame: DataFrame) -> DataFrame:
        schema = frame.select(*names).schema.add("n_replaced", "long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(text_col).to_pylist()
                special = batch.column("__pc_again").to_pylist()
                new, counts = [], []
                for text, entries in zip(texts, special):
                    drawn = {(e["kind"], e["value"]): (e["drawn"], e["attempt"]) for e in entries or ()}
                    done = (None, 0) if text is None else pseudonymised(text, key, drawn, common)
                    new.append(done[0])
                    counts.append(done[1])
                arrays = [
                    pa.array(new, batch.column(c).type) if c == text_col else batch.column(c)
                    for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(counts, pa.int64())], [*names, "n_replaced"])

        return frame.mapInArrow(run, schema)

    kind = "array<struct<kind:string,value:string,drawn:string,attempt:int>>"
    if again.isEmpty():
        return rewritten(keyed.withColumn("__pc_again", F.lit(None).cast(kind)))

    def with_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (k, kind_, value)
                for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())
                for kind_, value in {(a, b) for _, _, a, b in mentions(t, common)}]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.string()),
                 pa.array([r[2] for r in found], pa.string())], ["key", "kind", "value"])

    holders = (
        rows.select(F.xxhash64("text").alias("key"), "text")
        .mapInArrow(with_entities, "key long, kind string, value string").distinct()
        .join(again, ["kind", "value"])
        .groupBy("key").agg(F.collect_list(F.struct("kind", "value", "drawn", "attempt")).alias("__pc_again"))
    )
    holders = written(holders)
    bits = key_filter(holders.select("key"))
    may = passes(bits, F.col("__pc_text_key"))
    plain = keyed.where(~may).withColumn("__pc_again", F.lit(None).cast(kind))
    held = holders.withColumnRenamed("key", "__pc_holder")
    special = keyed.where(may).join(
        held, keyed["__pc_text_key"] == held["__pc_holder"], "left").drop("__pc_holder")
    return rewritten(plain.unionByName(special))


def op2_pii(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # A real run passes its own secret.
    return pseudonymise(docs, key=b"parcelhouse")
