"""Personal data replaced by keyed surrogates of the same type and format."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from itertools import count
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import formats
from ferry.llm.formats import Space
from ferry.llm.sharding import number_rows
from ferry.llm.words import free_name, quoted, whole
from ferry.sources.scratch import materialize

# Entities whose first surrogate clashed, up to which they are broadcast.
BROADCAST_ENTITIES = 100_000
# Surrogates drawn for an entity; if all clash, it gets a free one by number.
DRAWS = 4

# What each type looks like.
EMAIL = re.compile(r"(?<![^\W_])[^\W_][\w.%+-]*@[^\W_][\w-]*(?:\.[\w-]+)*\.[^\W\d_]{2,}")
PHONE = re.compile(
    r"(?<![\w.])(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w)"
)
# A number with its country code, however grouped; digits are counted after it is found.
WORLD_PHONE = re.compile(r"(?<![\w.+])(?:\+|00)[1-9]\d*(?:[ .\-/()]{1,3}\d+)*")
SPACED_PHONE = re.compile(r"(?<![\w.+])(?<!\d[ .\-/])[2-9]\d\d \d{3} \d{4}(?!\w|[ .\-/]\d)")
# Nine or ten digits without a code: 217 5551234 and 912 345 678.
PLAIN_PHONE = re.compile(r"(?<![\w.+])(?<!\d[ .\-/])(?:([2-9]\d\d[ .-]\d{7})|[6-9]\d\d \d{3} \d{3})(?!\w|[ .\-/]\d)")
# Any number after a word that announces a phone; its digits are counted.
NUMBER = re.compile(r"\d+(?:[ .\-/()]{1,2}\d+)*(?!\w)")
PHONE_CUE = re.compile(
    r"(?i)(?<!\w)(?:tel|telephone|phone|mobile|cell|call|fax|whatsapp|telefon|handy|mobil|rufnummer|téléphone|portable|"
    r"teléfono|móvil|тел|телефон|τηλ|τηλέφωνο)(?!\w)[^\w\n+]{0,4}(?:(?:number|nummer|me|at|is|ist|no|nr)(?!\w)[^\w\n+]{1,3}){0,2}$"
)
CUE_CHARACTERS = 48  # more than a cue and what stands behind it
CUED_DIGITS = (7, 12)
# A national number that begins with the trunk digit 0, one separator throughout.
TRUNK_PHONE = re.compile(
    r"(?<![\w.+])(?<!\d[ .\-/])(?:\(0\d{1,4}\) ?\d{2,8}(?:[ \-]\d{2,8}){0,3}"
    r"|0[1-9]([ .\-])\d\d(?:\1\d\d){3}|0\d{2,4}([ .\-/])\d{2,8}(?:\2\d{2,8}){0,3})(?!\w|[ .\-/]\d)"
)
TRUNK_DIGITS = (9, 12)
# Country codes: 1 and 7, these, and three digits otherwise.
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 "
    "92 93 94 95 98".split()
)
# Digits after the code without the trunk digit, where a plan is known; else 7 up to 15 in all.
NATIONAL_DIGITS = {
    "1": (10, 10), "7": (10, 10), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9),
    "39": (6, 11), "41": (9, 9), "43": (7, 12), "44": (9, 10), "49": (6, 11), "52": (10, 10), "351": (9, 9),
}
IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)")
IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
# Both have one of these.
GROUPED = re.compile(r"[:-](?:[0-9A-Fa-f]{1,4}[:-]|:)")
MAC = re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}([:-])[0-9A-Fa-f]{2}(?:\1[0-9A-Fa-f]{2}){4}(?![\w:-])")
# What stands before four numbers that are a version and not an address.
VERSION = re.compile(r"(?i)(?<!\w)(?:version|release|firmware|build|ver|rev|v)[ .:=]*$")
CARD = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
SPACED_SSN = re.compile(r"(?<![\w-])(?<!\d )(?!000|666|9)\d{3} (?!00)\d\d (?!0000)\d{4}(?![\w-]| \d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
SECRET = re.compile(r"(?i)\b(?:token|secret|password|api[_-]?key)\W{0,6}[=:]\W{0,6}([A-Za-z0-9_\-]{16,})")
# Keys known by how they begin; what follows the beginning is the secret.
TOKEN = re.compile(
    r"(?<![\w-])(?:(?:AKIA|ASIA)([0-9A-Z]{16})(?!\w)"
    r"|(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk_live_|sk_test_|sk-|hf_|AIza)([A-Za-z0-9_-]{20,})"
    r"|Bearer[ ]+([A-Za-z0-9._~+/-]{16,}))"
)
TOKEN_STARTS = "AKIA ASIA ghp_ gho_ ghu_ ghs_ ghr_ github_pat_ glpat- xox sk_live_ sk_test_ sk- hf_ AIza Bearer".split()
PASSWORD = re.compile(
    r"(?i)(?<!\w)(?:password|passwd|pwd|passphrase|passwort|kennwort|mot de passe|contraseña|пароль|κωδικός)"
    r"[\"']?\s?[=:]\s?[\"']?([^\s\"'<>,;]{6,64})"
)
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Господин г-н Κύριος κ".split(),
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Госпожа г-жа Κυρία".split(),
    "x": "Dr Prof".split(),
}
NAME_REST = r"(?:[^\W\d_]|['’-](?=[^\W\d_]))*"
NAME = rf"[^\W\d_]{NAME_REST}"
# Patterns that begin with a set of letters are searched for fastest; a title is any such word of GENDER.
TITLE_STARTS = "".join(sorted({t[0] for ts in TITLES.values() for t in ts}))
TITLE = re.compile(rf"([{TITLE_STARTS}](?<!\w.)(?:-[^\W\d_]+|[^\W\d_]*))\.?(?=[  ])")
PARTICLES = "von van der den de del della di da dos du la le zu zum zur ter ten".split()
# Initials and particles stay; the name after them counts.
NEXT_NAME = re.compile(rf"(?:[^\W\d_]\.[  ]?)*(?:(?:{'|'.join(PARTICLES)})[  ])*({NAME})")
BARE_NAME = re.compile(rf"(?<!\w){NAME}(?!\w)")
MOST_NAMES = 6
# Names that need no title if a capitalised word follows.
GIVEN_NAMES = {
    "m": (
        "Alexander Andreas Anthony Antoine Antonio Carlos Charles Christian Christopher Daniel David Dieter Edward Fernando "
        "Francisco François Frank George Günter Hans Heinrich Henri Jacques James Javier Jean Johann John José Joseph Juan "
        "Jürgen Karl Klaus Laurent Louis Luis Manuel Martin Matthew Michael Michel Miguel Nicolas Olivier Pablo Patrick Paul "
        "Pedro Peter Philippe Pierre Rafael Richard Robert Stefan Stephen Thomas Uwe Werner William Wolfgang "
        "Александр Алексей Андрей Дмитрий Иван Сергей Γιώργος Δημήτρης Νίκος"
    ).split(),
    "f": (
        "Alice Ana Andrea Angela Anna Anne Barbara Birgit Brigitte Camille Carmen Catherine Christine Claire Cristina Elena "
        "Elizabeth Emily Emma Françoise Hannah Heike Helen Ingrid Isabel Isabelle Jane Jennifer Jessica Julia Karen Katharina "
        "Laura Linda Lisa Lucía Margaret Maria María Marie Martina Mary Michelle Monika Monique Nathalie Nicole Olivia Patricia "
        "Petra Pilar Rosa Sabine Sandra Sarah Silvia Sophie Susan Susanne Sylvie Teresa Ursula "
        "Анна Екатерина Елена Мария Наталья Ольга Ελένη Κατερίνα Μαρία"
    ).split(),
}
GIVEN = {n: g for g, names in GIVEN_NAMES.items() for n in names}
CAPITAL = "[A-ZÀ-ÖØ-ÞΆ-ΫА-Я]"
TWO_CAPITALS = re.compile(rf"{CAPITAL}(?<!\w.){NAME_REST}(?=[  ]{CAPITAL})")
# What a person says before the own name.
OWN_NAME = re.compile(
    r"(?<!\w)(?i:my name is|i am called|mein name ist|ich hei(?:ß|ss)e|je m['’]appelle|mon nom est|me llamo|mi nombre es|"
    r"меня зовут|με λένε)[ \u00a0](?=" + CAPITAL + ")"
)
OWN_WORDS = "name is|i am called|name ist|ich hei|appelle|nom est|me llamo|nombre es|зовут|λένε".split("|")
# Names that are words too: alone they are not taken for the person named before.
WORDS_TOO = frozenset(
    (
        "angel april august baker ball banks bauer becker berg bill bird bishop black blanc blanco brown bush butler campos "
        "carpenter castillo chance church cook costa cross cruz day dean drew earl east faith fischer ford forest forêt fox "
        "frank fuchs gold grace graf grant gray green groß hall hill hope hunter jäger joy june kaiser king kirche klein knight "
        "koch könig kurz lang lange law leblanc lee leroy little long major mark market march marsh mason may meier miller "
        "moreno moon norman north page park parker petit pope porter potter price prince rey reyes rich richter rivers roberts "
        "rojo rose roth ruiz schäfer schmied schneider schulz sharp shepherd short sierra silver smart sommer stein stern stone "
        "storm strong summer taylor torres turner vogel wagner walker ward weaver weber weiß west white will winter wolf wood "
        "woods young zimmermann"
    ).split()
)
CARD_PREFIX = re.compile(r"4|5[1-5]|2[2-7]|3[47]|35|6011|65")
# Syllables of invented names, and how given names end.
SYLLABLES = {
    "latin": ("b c d f g h j k l m n p r s t v w z".split(), "a e i o u".split()),
    "cyrillic": ("б в г д ж з к л м н п р с т ф х".split(), "а е и о у".split()),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ χ".split(), "α ε η ι ο".split()),
}
ENDINGS = {
    "latin": {"m": "n", "f": "a", "x": "l"},
    "cyrillic": {"m": "н", "f": "а", "x": "л"},
    "greek": {"m": "ς", "f": "α", "x": "ν"},
}
# Types written with separators that a surrogate takes over.
DRESSED = ("card", "phone", "ssn", "iban", "mac")
GENDER = {t: g for g, ts in TITLES.items() for t in ts}


class Mention(NamedTuple):
    start: int
    end: int
    kind: str  # with what the surrogate must match, as in given:f:latin
    name: str  # the same for all mentions of one entity


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` plus itself valid."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += int(d) if i % 2 else sum(divmod(2 * int(d), 10))
    return -total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _with_check(bare: str) -> str:
    """The IBAN of a country code and what follows its check digits."""
    return f"{bare[:2]}{98 - _mod97(f'{bare[:2]}00{bare[2:]}'):02d}{bare[2:]}"


def script(word: str) -> str:
    for name, low, high in (("cyrillic", "Ѐ", "ԯ"), ("greek", "Ͱ", "Ͽ")):
        if any(low <= c <= high for c in word):
            return name
    return "latin"


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _split_code(digits: str) -> tuple[str, str]:
    """The country code and the number after it, without a trunk digit."""
    code = digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3]
    rest = digits[len(code) :]
    return code, rest if code == "1" else rest.lstrip("0")


def _phone_name(code: str, rest: str) -> str:
    """One name with or without country code: 1 and the number in North America,
    0 and the number elsewhere."""
    return ("1" if code == "1" else "0") + rest


def _phones(text: str) -> Iterator[Mention]:
    for m in WORLD_PHONE.finditer(text):
        ends = [g.end() for g in re.finditer(r"\d+", m[0])]
        if m[0][0] == "0" and len(ends) == 1:  # 00 begins other numbers too
            continue
        for end in reversed(ends):  # digits that follow may not belong to it
            if re.match(r"\w", text[m.start() + end :][:1]):
                continue
            code, rest = _split_code(_digits(m[0][:end]).removeprefix("00"))
            low, high = NATIONAL_DIGITS.get(code, (7, 15 - len(code)))
            if low <= len(rest) <= high:
                yield Mention(m.start(), m.start() + end, "phone", _phone_name(code, rest))
                break
    for m in PHONE.finditer(text):
        digits = _digits(m[0])
        code, rest = _split_code(digits) if m[0][0] == "+" else ("1", digits)
        yield Mention(*m.span(), "phone", _phone_name(code, rest))
    for m in SPACED_PHONE.finditer(text):
        yield Mention(*m.span(), "phone", _phone_name("1", _digits(m[0])))
    for m in PLAIN_PHONE.finditer(text):
        yield Mention(*m.span(), "phone", _phone_name("1" if m[1] else "", _digits(m[0])))
    for m in TRUNK_PHONE.finditer(text):
        digits = _digits(m[0])
        if TRUNK_DIGITS[0] <= len(digits) <= TRUNK_DIGITS[1] and digits.lstrip("0"):
            yield Mention(*m.span(), "phone", _phone_name("", digits.lstrip("0")))
    for m in NUMBER.finditer(text):
        digits = _digits(m[0])
        if not CUED_DIGITS[0] <= len(digits) <= CUED_DIGITS[1] or not digits.lstrip("0"):
            continue
        if PHONE_CUE.search(text[max(m.start() - CUE_CHARACTERS, 0) : m.start()]):
            code = "1" if len(digits) == 10 and digits[0] in "23456789" else ""
            yield Mention(*m.span(), "phone", _phone_name(code, digits if code else digits.lstrip("0")))


def _name_at(match: re.Match, group: int = 0) -> tuple[int, int, str]:
    """Where a name stands without a possessive ending, and its lower-case form."""
    start, end = match.span(group)
    if match[group][-2:] in ("'s", "’s"):
        end -= 2
    return start, end, match[group][: end - start].lower()


def _names_from(text: str, at: int) -> list[tuple[int, int, str]]:
    """The capitalised names in a row that begin here."""
    names: list[tuple[int, int, str]] = []
    while len(names) < MOST_NAMES and (m := NEXT_NAME.match(text, at)):
        if not m[1][0].isupper() or m[1] in GENDER or len(names) > 1 and len(m[1]) == 1:
            break
        names.append(_name_at(m, 1))
        at = m.end() + 1
        if text[m.end() : at] not in (" ", "\u00a0"):
            break
    return names


def _introduced(text: str) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """Gender and names: after a title, after "my name is", and from a common given name on."""
    for title in TITLE.finditer(text):
        if title[1] in GENDER:
            yield GENDER[title[1]], _names_from(text, title.end() + 1)
    lower = text.lower()
    for own in OWN_NAME.finditer(text) if any(words in lower for words in OWN_WORDS) else ():
        names = _names_from(text, own.end())
        yield GIVEN.get(text[names[0][0] : names[0][1]], "x") if names else "x", names
    for first in TWO_CAPITALS.finditer(text):
        if first[0] in GIVEN and len(names := _names_from(text, first.start())) > 1:
            yield GIVEN[first[0]], names


def _persons(text: str) -> Iterator[Mention]:
    """Names that are introduced, and the same names wherever else they stand alone."""
    kinds: dict[str, str] = {}
    for gender, names in _introduced(text):
        for start, end, name in names:
            kind = "surname" if (start, end, name) == names[-1] else f"given:{gender}"
            kinds.setdefault(name, f"{kind}:{script(name)}")
            yield Mention(start, end, f"{kind}:{script(name)}", name)
    upto = -2
    for m in BARE_NAME.finditer(text) if kinds else ():
        start, end, name = _name_at(m)
        if name in kinds and len(name) > 1 and m[0][0].isupper():
            after = BARE_NAME.match(text, end + 1) if kinds[name][0] == "g" else None
            if name not in WORDS_TOO or start == upto + 1 or after and _name_at(after)[2] in kinds:
                yield Mention(start, end, kinds[name], name)
                upto = end


def _numbers(text: str) -> Iterator[Mention]:
    for m in IBAN.finditer(text):
        bare = m[0].replace(" ", "")
        if _mod97(bare) == 1:
            yield Mention(*m.span(), "iban", bare)
    for m in CARD.finditer(text):
        bare = _digits(m[0])
        if CARD_PREFIX.match(bare) and luhn(bare[:-1]) == int(bare[-1]):
            yield Mention(*m.span(), "card", bare)
    for m in IP.finditer(text):
        if all(int(part) < 256 for part in m[0].split(".")) and not VERSION.search(text[max(m.start() - 12, 0) : m.start()]):
            yield Mention(*m.span(), "ip", m[0])
    for ssn in (SSN, SPACED_SSN):
        for m in ssn.finditer(text):
            yield Mention(*m.span(), "ssn", _digits(m[0]))
    yield from _phones(text)


def _addresses(text: str) -> Iterator[Mention]:
    """Network addresses with colons or hyphens; IPv6 in the form of its surrogates."""
    if not GROUPED.search(text):
        return
    for m in IPV6.finditer(text):
        if len(re.findall(r"\w+", m[0])) >= 3 and re.search(r"\d", m[0]):
            try:
                groups = ipaddress.IPv6Address(m[0]).exploded.split(":")
            except ValueError:  # a time or something else with colons
                continue
            yield Mention(*m.span(), "ip", ":".join([f"{int(g, 16):x}" for g in groups[:2]] + groups[2:]))
    for m in MAC.finditer(text):
        yield Mention(*m.span(), "mac", re.sub("[:-]", "", m[0]).lower())


def _secrets(text: str) -> Iterator[Mention]:
    assigned = "=" in text or ":" in text
    for m in PASSWORD.finditer(text) if assigned else ():
        value = m[1].rstrip(".)]}")
        if len(value) >= 6 and re.search(r"\d", value) and re.search(r"[^\W\d_]", value) and not TOKEN.match(value):
            yield Mention(m.start(1), m.start(1) + len(value), "secret", value)
    for m in TOKEN.finditer(text) if any(start in text for start in TOKEN_STARTS) else ():
        if m[1] or re.search(r"\d", m[m.lastindex]):
            value = m[m.lastindex].rstrip(".")
            yield Mention(m.start(m.lastindex), m.start(m.lastindex) + len(value), "secret", value)
    for m in SECRET.finditer(text) if assigned else ():
        if not TOKEN.match(m[1]):
            yield Mention(*m.span(1), "secret", m[1])


def find(text: str) -> list[Mention]:
    """Mentions in order; of overlapping ones the first found type wins."""
    found: list[Mention] = []
    if "@" in text:
        found += [Mention(*m.span(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    found += _secrets(text)
    found += _addresses(text)
    if re.search(r"\d\D{0,3}\d", text):
        found += _numbers(text)
    found += _persons(text)
    kept, upto = [], 0
    for mention in sorted(found, key=lambda m: m.start):  # stable: types in the order above
        if mention.start >= upto:
            kept.append(mention)
            upto = mention.end
    return kept


class _Draw:
    """Numbers that depend on the key, the entity and the attempt alone."""

    def __init__(self, key: bytes, mention: str):
        self.key, self.mention, self.block, self.left = key, mention.encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            seed = self.block.to_bytes(4, "big") + self.mention
            self.left += hmac.new(self.key, seed, hashlib.sha256).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _alike(text: str, draw: _Draw) -> str:
    """Letters for letters of the same case and script, digits for digits, the rest as it is."""
    return "".join(units[draw.below(len(units))] if len(units) > 1 else units[0] for units in formats.alike(text))


def _octet(part: str, draw: _Draw) -> str:
    low, high = {1: (1, 10), 2: (10, 100), 3: (100, 255)}[len(part)]
    return str(low + draw.below(high - low))


def surrogate_host(domain: str, key: bytes) -> str:
    return _alike(domain.split(".")[0], _Draw(key, f"domain|{domain}"))


def surrogate(kind: str, name: str, key: bytes, attempt: int = 0) -> str:
    """A stand-in for an entity, in the form in which its name is kept."""
    draw = _Draw(key, f"{kind}|{attempt}|{name}")
    base, *rest = kind.split(":")
    if base == "email":
        local, _, domain = name.partition("@")
        return f"{_alike(local, draw)}@{surrogate_host(domain, key)}.example.org"
    if base == "card":
        body = name[0] + _alike(name[1:-1], draw)
        if not CARD_PREFIX.match(body):  # keep the issuer's range where one digit does not tell it
            body = name[:4] + body[4:]
        return body + str(luhn(body))
    if base == "ip" and ":" in name:
        return formats.IPV6[:8] + "".join(formats.HEX[draw.below(16)] if c != ":" else ":" for c in formats.IPV6[8:])
    if base == "mac":  # a locally administered address, which no device is made with
        return "".join(units[draw.below(len(units))] for units in formats.MAC)
    if base == "ip":
        return ".".join(_octet(part, draw) for part in name.split("."))
    if base == "iban":
        return _with_check(name[:2] + _alike(name[4:], draw))
    if base in ("given", "surname"):
        first, second = SYLLABLES[rest[-1]]
        long = 3 if base == "given" else 4
        made = "".join(first[draw.below(len(first))] + second[draw.below(len(second))] for _ in range(long))
        return made + (ENDINGS[rest[-1]][rest[0]] if base == "given" else "")
    if base == "phone":  # the first digit tells the plan; area codes do not begin with 0 or 1
        rest_of = _alike(name[1:], draw)
        return name[0] + str(2 + draw.below(8)) + rest_of[1:]
    if base == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", name):
        made = "".join("0123456789abcdef"[draw.below(16)] for _ in name)
        return made if name == name.lower() else made.upper()
    return _alike(name, draw)


def _spaces(base: str, value: str) -> Iterator[tuple[str, Space]]:
    """The formats that ``value`` may belong to, each with a name; formats of one
    name are equal, others share no value, except hexadecimal with other secrets."""
    made: list[tuple[str, Space]] = []
    if base == "email":
        local, _, domain = value.partition("@")
        made.append((base, Space(formats.alike(local) + formats.fixed("@" + domain))))
    elif base in DRESSED:
        body, x, more = value.partition("x")
        tail = formats.fixed(x) + formats.alike(more)

        def form(alphabets, whole=str, bare=str):
            split = lambda f: lambda v: f(v.partition("x")[0]) + "".join(v.partition("x")[1:])
            return base, Space(alphabets + tail, split(whole), split(bare))

        if base == "card":
            starts = formats.CARD_STARTS.get(body[:1]) or [next(s for s in ("6011", "65") if body.startswith(s))]
            digits = formats.alike("0" * (len(body) - 1 - len(starts[0])))
            made.append(form([starts, *digits], lambda v: v + str(luhn(v)), lambda v: v[:-1]))
        elif base == "iban":
            made.append(
                form(formats.fixed(body[:2]) + formats.alike(body[4:]), _with_check, lambda v: v[:2] + v[4:])
            )
        elif base == "phone":
            made.append(form([[body[0]], "23456789", *formats.alike(body[2:])]))
        else:
            made.append(form(list(formats.MAC) if base == "mac" else formats.alike(body)))
    elif base == "ip" and ":" in value:
        groups = [formats.HEX if c != ":" else ":" for c in formats.IPV6[8:]]
        made.append((base, Space([*formats.fixed(formats.IPV6[:8]), *groups])))
    elif base == "ip":
        parts = [a for part in value.split(".") for a in (".", formats.octets(len(part)))]
        made.append((base, Space(parts[1:])))
    elif base in ("given", "surname"):
        first, second = SYLLABLES[script(value)]
        units = [a + b for a in first for b in second]
        ends = [[value[-1]]] if base == "given" else []
        if (len(value) - len(ends)) % 2 == 0:
            made.append((base, Space([units] * ((len(value) - len(ends)) // 2) + ends)))
    else:
        for name, digits in (("hex", formats.HEX), ("HEX", formats.HEX.upper())):
            if base == "secret" and re.fullmatch(f"[{digits}]+", value):
                made.append((name, Space([digits] * len(value))))
        made.append((base, Space(formats.alike(value))))
    for name, space in made:
        yield f"{base}|{name}|{space.value(0)}", space


def _example(kind: str, name: str, key: bytes, level: int) -> str:
    """Any value of the format from which an entity gets its surrogate. Level 0 is
    the format of ``surrogate``; each level more is a format with more values."""
    base, *rest = kind.split(":")
    if base == "email":
        end = "net" if level else "org"
        local, _, domain = name.partition("@")
        host = surrogate_host(domain, key)
        return f"{local}{formats.WIDER['email'] * level}@{host}.example.{end}"
    if base in DRESSED:
        return name + ("x" + formats.WIDER["digits"] * level if level else "")
    if base == "ip":
        return formats.IPV6 if level else name
    if base in ("given", "surname"):
        first, second = SYLLABLES[rest[-1]]
        syllables = (first[0] + second[0]) * (level + (3 if base == "given" else 4))
        return syllables + (ENDINGS[rest[-1]][rest[0]] if base == "given" else "")
    return name + formats.WIDER["secret"] * level


def _dressed(mention: str, kind: str, made: str) -> str:
    """The surrogate in the layout and the case of this mention."""
    base = kind.split(":")[0]
    if base in DRESSED:
        made, x, more = made.partition("x")  # a widened format goes on behind the layout
        if base == "phone":  # country code, trunk digit and what stands for the plan stay
            digits = _digits(mention)
            made = digits[: len(digits) - len(made) + 1] + made[1:]
        left = iter(made.upper() if mention.isupper() else made)
        return "".join(next(left) if c.isalnum() else c for c in mention) + (x and f" {x}{more}")
    if base in ("given", "surname"):
        return made.upper() if len(mention) > 1 and mention.isupper() else made.capitalize()
    if base in ("email", "ip") and mention.isupper():
        return made.upper()
    return made


def rewrite(text: str, key: bytes, attempts: Callable[[str, str], int | str]) -> tuple[str, int]:
    """The text with its mentions replaced, and how many there were.

    ``attempts`` gives the surrogate of an entity, or the attempt that makes it.
    """
    out, upto, found = [], 0, find(text)
    for m in found:
        made = attempts(m.kind, m.name)
        made = made if isinstance(made, str) else surrogate(m.kind, m.name, key, made)
        out += [text[upto : m.start], _dressed(text[m.start : m.end], m.kind, made)]
        upto = m.end
    return "".join([*out, text[upto:]]), len(found)


def entities(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """kind and name of each different entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = {(m.kind, m.name) for t in batch.column(0) for m in find(t.as_py())}
            kinds, names = ([e[i] for e in seen] for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(names, pa.string())], names=["kind", "name"]
            )

    texts = docs.select(whole(quoted(text_column)).alias("text"))
    return texts.mapInArrow(run, "kind string, name string").distinct()


def _with_surrogates(rows: DataFrame, key: bytes) -> DataFrame:
    """``rows`` of kind, name, attempt with made, their surrogate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                surrogate(k.as_py(), n.as_py(), key, a.as_py())
                for k, n, a in zip(*(batch.column(i) for i in range(3)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=["kind", "name", "attempt", "made"]
            )

    return rows.select("kind", "name", "attempt").mapInArrow(
        run, "kind string, name string, attempt int, made string"
    )


def _mapped(rows: DataFrame, make: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """The tuples that ``make`` gives for each row, text unless the schema says bigint."""
    names, kinds = zip(*(column.split() for column in schema.split(", ")), strict=True)
    types = [pa.int64() if k == "bigint" else pa.int32() if k == "int" else pa.string() for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [t for row in zip(*map(pa.Array.to_pylist, batch.columns), strict=True) for t in make(*row)]
            columns = [pa.array([t[i] for t in made], type_) for i, type_ in enumerate(types)]
            yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return rows.mapInArrow(run, schema)


def _assigned(left: DataFrame, used: DataFrame, key: bytes) -> DataFrame:
    """``left`` (kind, name, attempt) with made: a free value of each one's format.

    ``used`` has the values (base, made) that are gone. The values of a format
    have places in a keyed order. With the used places counted down by those
    before them, a sort of used places and numbered entities leaves each entity
    at its free place. Those for whom no place is left go on to a wider format.
    """
    done = None
    for level in count():
        def wanted(kind, name, attempt, level=level):
            form, space = next(_spaces(kind.split(":")[0], _example(kind, name, key, level)))
            yield form, min(space.size(), formats.PLACES), kind, name, attempt

        def belongs(base, made):
            for form, _ in _spaces(base, made) if base != "card" or CARD_PREFIX.match(made) else ():
                yield form, base, made

        def placed(form, base, made):
            space = dict(_spaces(base, made))[form]
            index = space.index(made)
            if index is not None:
                place = formats.permuted(index, space.size(), key, form, back=True)
                if place < formats.PLACES:
                    yield form, place

        def valued(form, place, kind, name, attempt):
            base, _, example = form.split("|", 2)
            space = dict(_spaces(base, example))[form]
            yield kind, name, attempt, space.value(formats.permuted(place, space.size(), key, form))

        asked = _mapped(left.select("kind", "name", "attempt"), wanted, "form string, size bigint, kind string, name string, attempt int")
        asked = materialize(number_rows(asked, "form", ["kind", "name"], "rank"), "asked")
        some = asked.select("form").distinct()
        bases = some.select(F.split_part("form", F.lit("|"), F.lit(1)).alias("base")).distinct()
        rows = used.join(F.broadcast(bases), "base", "left_semi").select("base", "made")
        rows = _mapped(rows, belongs, "form string, base string, made string").join(some, "form", "left_semi").distinct()
        gone = _mapped(rows.select("form", "base", "made"), placed, "form string, place bigint")
        gone = number_rows(gone, "form", ["place"], "before").select("form", (F.col("place") - F.col("before")).alias("rank"))
        both = gone.withColumn("wants", F.lit(0)).unionByName(
            asked.withColumn("wants", F.lit(1)), allowMissingColumns=True
        )
        got = number_rows(both, "form", ["rank", "wants"], "place").where("wants = 1")
        got = materialize(got.select("form", "place", "size", "kind", "name", "attempt"), "placed")
        made = got.where("place < size").drop("size")
        made = materialize(_mapped(made, valued, "kind string, name string, attempt int, made string"), "assigned")
        done = made if done is None else done.unionByName(made)
        left = got.where("place >= size").select("kind", "name", "attempt")
        if left.isEmpty():
            return done
        used = used.unionByName(made.select(F.split_part("kind", F.lit(":"), F.lit(1)).alias("base"), "made"))


def settle(known: DataFrame, key: bytes) -> DataFrame:
    """kind, name, attempt, made: a surrogate for each entity, all different.

    A surrogate clashes if another entity of its type has it, or if it is itself
    an entity of the data. The entity with fewer attempts, then the smaller name,
    keeps it; the others draw again, ``DRAWS`` times in all, and those still left
    are given free values. So no format runs dry before its last value is used,
    and then a wider one follows: longer locals at example.net, IPv6 addresses of
    2001:db8::/32, more digits after an x (phone, card, social security number,
    IBAN), longer secrets, more syllables. The table stays on the cluster, and
    rounds after the first concern few rows.
    """
    known = materialize(known.select("kind", "name"), "entities")
    base = F.split_part("kind", F.lit(":"), F.lit(1))
    # Surrogates of names must differ whatever the gender; scripts cannot clash.
    table = materialize(_with_surrogates(known.withColumn("attempt", F.lit(0)), key), "surrogates")
    real = known.select(base.alias("base"), F.col("name").alias("made"), F.lit(True).alias("real")).distinct()
    for attempt in count(1):
        rows = table.withColumn("base", base)
        shared = (
            rows.groupBy("base", "made")
            .agg(F.min(F.struct("attempt", "kind", "name")).alias("owner"), F.count("*").alias("n"))
            .join(real, ["base", "made"], "left")
            .where("n > 1 OR real")
            .select(
                "base", "made", F.when(F.col("real").isNull(), F.col("owner")).alias("owner"), F.lit(True).alias("shared")
            )
        )
        shared = materialize(shared, "shared")
        if shared.isEmpty():
            return table
        own = F.struct("attempt", "kind", "name")
        moves = F.coalesce(F.col("shared"), F.lit(False)) & ~F.coalesce(F.col("owner") == own, F.lit(False))
        rows = rows.join(shared, ["base", "made"], "left").withColumn("moves", moves)
        stay = rows.where(~F.col("moves")).select("kind", "name", "attempt", "made")
        again = rows.where("moves").select("kind", "name", (F.col("attempt") + 1).alias("attempt"))
        if attempt < DRAWS:
            new = _with_surrogates(again, key)
        else:
            used = stay.select(base.alias("base"), "made").unionByName(real.select("base", "made"))
            new = _assigned(again, used, key)
        table = materialize(stay.unionByName(new), "surrogates")


def _one_kind(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities with one kind for each given name, and the other kinds it has, with
    ``first``, that one: a woman's title goes before a man's, and Dr comes last."""
    given = known.where("kind LIKE 'given:%'").withColumn("script", F.split_part("kind", F.lit(":"), F.lit(3)))
    firsts = given.groupBy("script", "name").agg(F.min("kind").alias("first"))
    alias = given.join(firsts, ["script", "name"]).where("kind <> first").select("kind", "name", "first")
    return known.join(alias, ["kind", "name"], "left_anti"), alias


def replace(
    docs: DataFrame, key: bytes, text_column: str = "text", broadcast_entities: int = BROADCAST_ENTITIES
) -> DataFrame:
    """``docs`` with surrogates in the text, and n_entities, the mentions replaced.

    A surrogate depends on the key, the entity and its attempt (where a format is
    nearly used up, also on the other entities), so an entity has
    the same one in every document, however it is written there, and different
    entities have different ones. Types: e-mail, phone, IPv4, IPv6, MAC, card (by check digit
    and issuer), social security number, IBAN (by check digits), secret after a
    word such as token or by how its kind begins, and names, by gender and script:
    after a title or "my name is", or from a common given name on, with the
    same names elsewhere in the document. Phones are one entity with and without
    country code, given names whatever the title. Null texts
    stay null with no entities; texts without entities stay as they are. Repeated
    ids and rows do no harm; an empty table gives an empty result.

    Only entities that needed a second attempt are looked up, by broadcast up to
    a number, beyond that by a join on the text's hash.
    """
    name = free_name(docs, "n_entities")
    known, alias = _one_kind(materialize(entities(docs, text_column), "mentioned"))
    settled = settle(known, key)
    moved = settled.where("attempt > 0").select("kind", "name", "made")
    same = alias.join(settled.select(F.col("kind").alias("first"), "name", "made"), ["first", "name"])
    moved = materialize(moved.unionByName(same.select("kind", "name", "made")), "moved")
    text, exceptions = free_name(docs, "given_text"), free_name(docs, "exceptions")
    rows = docs.withColumn(text, quoted(text_column))
    small = None
    if moved.count() <= broadcast_entities:
        small = docs.sparkSession.sparkContext.broadcast(
            {(r["kind"], r["name"]): r["made"] for r in moved.collect()}
        )
        rows = rows.withColumn(exceptions, F.lit(None).cast("array<struct<kind:string,name:string,made:string>>"))
    else:
        hash_ = F.md5(whole(quoted(text_column)))

        def mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = [(k, m.kind, m.name) for k, t in zip(*map(pa.Array.to_pylist, batch.columns), strict=True) for m in find(t)]
                columns = [pa.array([h[i] for h in hit], pa.string()) for i in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["hash", "kind", "name"])

        texts = docs.select(hash_.alias("hash"), whole(quoted(text_column)).alias("text"))
        found = texts.mapInArrow(mentions, "hash string, kind string, name string").distinct()
        by_text = (
            found.join(moved, ["kind", "name"])
            .groupBy(F.col("hash").alias(exceptions + "_of"))
            .agg(F.collect_list(F.struct("kind", "name", "made")).alias(exceptions))
        )
        rows = rows.join(by_text, hash_ == F.col(exceptions + "_of"), "left").drop(exceptions + "_of")

    @F.udf("struct<text:string,n:int>", useArrow=True)
    def rewritten(given, own):
        if given is None:
            return None, 0
        if small is not None:
            return rewrite(given, key, lambda k, n: small.value.get((k, n), 0))
        special = {(e["kind"], e["name"]): e["made"] for e in own or []}
        return rewrite(given, key, lambda k, n: special.get((k, n), 0))

    done = free_name(docs, "rewritten")
    rows = rows.withColumn(done, rewritten(F.col(text), F.col(exceptions)))
    out = [F.col(f"{done}.text").alias(c) if c == text_column else quoted(c) for c in docs.columns]
    return rows.select(*out, F.col(f"{done}.n").cast("long").alias(name))
