"""Personal data: detection and surrogates.

Detected: e-mail addresses, telephone numbers, IPv4 and IPv6 addresses (a
shortened IPv6 address of three groups and more, with a digit), payment cards
(13 to 19 digits that pass the Luhn sum), IBANs, US social security numbers,
access keys of common services, web tokens, and values of any length of
password/token/secret assignments on one line, with any blanks around the sign
(the keyword may be part of a longer name, names and values may be quoted as in
JSON; a quoted value goes to its closing quote). After ``=``, a quoted name or
a name with ``_`` every value counts; after another name and a colon only one
that looks like a secret (a digit, a sign, mixed case, 32 characters, quoted
without blanks) or that fills the rest of a line that the name begins: prose
goes on after "the secret: patience". Names are one or two capitalised words
after a title, or one after a known given name, in Latin, Greek or Cyrillic
script (after Mr, Mrs, Herr and Frau in capitals also words in capitals), and
every other mention of such a word in the same text, alone, in capitals or
inside a hyphenated word. Words for offices ("Mr President") are no names; up to
three may stand between a title and a name, up to four given names be joined.

Every entity is a (kind, value) unit in canonical form (digits of a number,
lower-case address, single words of a name), so mentions that differ in
format are the same unit. A unit's surrogate is drawn from a keyed hash of
kind, value and attempt, and matches it in type and format: same length and
character classes, Luhn and IBAN sums kept, country and issuer digits kept,
names of the same gender and script (given names are drawn from a list of
their own, single or joined by hyphens). Mentions take the surrogate in their own
punctuation and case.

Collision checks run over the whole corpus: a candidate that equals a real
value found anywhere, or that an earlier unit holds, is drawn again with the
next attempt, until every unit has a surrogate of its own. So different units
stay different and one unit is the same everywhere (coreference). A given name
is one unit per script and value; its gender is settled over the corpus.

Plan: rows are searched inside Arrow batches; distinct units are aggregated
(a unit in a third of all rows is one row per task), numbered off against each
other by grouped minima, and joined back to the rows that hold them; rows
without entities are never shuffled. The rows with entities are written once
to the shared folder so that their row numbers stay what they are.

Defined results: a null text stays null and an empty one empty, both with no
entities; repeated rows get the same replacements; an empty table stays empty;
input columns named like the outputs are replaced, all others pass through.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize, nullable, slices, without

KEY = b"starloom surrogates"  # callers with real data pass a secret of their own
MAX_ATTEMPTS = 64

# Titles that tell a gender, titles that tell none, words for offices.
MALE_TITLES = "Mr Herr Monsieur Señor Sr Don Господин Κύριος MR HERR"
FEMALE_TITLES = "Mrs Ms Miss Madam Frau Madame Mme Mlle Señora Sra Doña Госпожа Κυρία MRS FRAU"
OTHER_TITLES = "Dr Prof Professor Doktor Docteur Доктор"
OFFICES = (
    "President Chairman Chairwoman Chairperson Chair Speaker Secretary Minister Prime Justice Judge Ambassador Mayor Governor Senator Chancellor Director Commissioner "
    "Präsident Präsidentin Bundeskanzler Bundeskanzlerin Kanzler Kanzlerin Ministerin Bürgermeister Bürgermeisterin Professorin Direktor Direktorin Richter Richterin "
    "Président Présidente Ministre Maire Directeur Directrice Juge Ambassadeur Presidente Presidenta Ministro Ministra Alcalde Alcaldesa Directora Juez Embajador "
    "Президент Министр Председатель Директор Судья Посол Πρόεδρος Πρόεδρε Υπουργός Υπουργέ Πρωθυπουργός Δήμαρχος"
)
# Common given names by script and gender, which a name may begin with.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Thomas Peter Paul Hans Klaus Stefan Pierre Jean Michel Carlos Juan Luis Pedro Miguel",
    ("latin", "f"): "Mary Linda Barbara Elizabeth Susan Sarah Anna Laura Emma Julia Petra Sabine Claire Sophie Camille Marie Carmen Isabel Lucia Elena",
    ("cyrillic", "m"): "Иван Пётр Сергей Дмитрий Алексей Николай Андрей Михаил Павел Олег",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Светлана Татьяна Вера Юлия",
    ("greek", "m"): "Γιώργος Νίκος Κώστας Δημήτρης Γιάννης Παύλος",
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Άννα Σοφία Δέσποινα",
}
# Given names to draw from (a real one may also begin with them).
POOL = {
    ("latin", "m"): "Adam Albert Anton Arthur Benjamin Bernard Bruno Cesar Christian Conrad Daniel Diego Edgar Edward Emil Felix Frank Gabriel George Gustav Henry Hugo Jacob Joseph Julian Leo Lorenzo Marco Martin Matthew Maurice Oscar Patrick Raul Richard Roland Samuel Simon Theodore Victor",
    ("latin", "f"): "Adele Agnes Alice Amelia Andrea Angela Astrid Beatrice Bianca Caroline Cecilia Christine Clara Diana Dorothy Eleanor Emily Eva Gabriela Helen Irene Jane Johanna Katherine Leonie Lydia Margaret Martha Monica Nadine Nora Olivia Paula Rebecca Ruth Sylvia Teresa Ursula Veronica Yvonne",
    ("cyrillic", "m"): "Александр Борис Виктор Владимир Георгий Денис Евгений Игорь Константин Леонид Максим Никита Роман Степан Фёдор Юрий",
    ("cyrillic", "f"): "Александра Алина Валентина Варвара Галина Дарья Екатерина Зоя Ксения Лариса Людмила Маргарита Надежда Полина София Тамара",
    ("greek", "m"): "Αλέξανδρος Αντώνης Βασίλης Γρηγόρης Ηλίας Θανάσης Λευτέρης Μιχάλης Πέτρος Σπύρος Στέλιος Χρήστος",
    ("greek", "f"): "Αικατερίνη Αλεξάνδρα Βασιλική Γεωργία Δήμητρα Ειρήνη Ευαγγελία Ζωή Ιωάννα Κωνσταντίνα Παναγιώτα Χριστίνα",
}
SYLLABLES = {
    "latin": "bar ben bor cal dan del fen gar hal kel lan lor mar mel nor per ran ros sel tan tor val ver wen".split(),
    "cyrillic": "бар бел вор гал дан кор лан лев мар мел нор пет ран ров сел тар тов хол чер шел".split(),
    "greek": "βαρ γαλ δαν θεο καλ λαμ μαν νικ παπ ρου σαρ στα τζα φιλ χαρ".split(),
}
GENDER = {name: g for known in (GIVEN, POOL) for (_, g), names in known.items() for name in names.split()}


def _either(names: str) -> str:
    """Pattern for one of the words, longer ones first, grouped by their first letter."""
    by_letter: dict[str, list[str]] = {}
    for n in sorted(set(names.split()), key=lambda n: (-len(n), n)):
        by_letter.setdefault(n[0], []).append(n[1:])
    return "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_letter.items())


_TITLES = " ".join([MALE_TITLES, FEMALE_TITLES, OTHER_TITLES])
_NO_NAMES = {*_TITLES.split(), *OFFICES.split()}
_CAP = r"[A-ZÀ-ÖØ-ÞΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+(?:-[A-ZÀ-ÖØ-ÞΑ-ΫА-ЯЁ][a-zß-öø-ÿά-ώа-яё]+)?"
EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}")
NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}(?:(?P=gap)\d{3})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\w))"
)
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)")
IPV6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}|::[0-9A-Fa-f]{1,4}){2,7}(?![\w:])")
# How access keys of common services begin.
ACCESS_KEY = re.compile(
    r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,})(?!\w)"
)
_KEY_START = re.compile(r"AKIA|ASIA|gh._|xox.-|AIza|[rs]k_(?:live|test)_|eyJ|")
_BLANKS = r"[^\S\r\n]"
ASSIGNED = re.compile(
    rf"(?i)(?<![\w-])(?=[\w-]*(?:password|passwd|pwd|token|secret|api[_-]?key))(?P<name>[\w-]++)(?P<shut>\\?[\"'])?{_BLANKS}*+(?P<sign>[=:]){_BLANKS}*+"
    r"(?:\"(?P<double>(?:[^\"\\\r\n]|\\.)+)\"|'(?P<single>(?:[^'\\\r\n]|\\.)+)'|(?:\\?[\"'])?(?P<bare>[^\s\"']+))"
)
_LIKE_SECRET = re.compile(r"[0-9_@#$%^&*+=~|\\<>]|[^\W\d_A-Z][A-Z]|.{32}")
_OFFICE = rf"(?:{_either(' '.join([_TITLES, OFFICES]))})(?!\w)"
_GIVEN = _either(" ".join(GENDER))
NAME = re.compile(
    rf"(?<!\w)(?:(?P<male>{_either(MALE_TITLES)})|(?P<female>{_either(FEMALE_TITLES)})|(?P<other>{_either(OTHER_TITLES)}))\.?{_BLANKS}+(?:{_OFFICE}\.?{_BLANKS}+){{0,3}}"
    rf"(?:(?P<titled>(?!{_OFFICE}){_CAP}(?:{_BLANKS}+(?!{_OFFICE}){_CAP})?)|(?P<upper>(?<=[A-Z]{_BLANKS})[A-ZÀ-ÖØ-Þ]{{2,}}(?!\w)(?:{_BLANKS}+[A-ZÀ-ÖØ-Þ]{{2,}}(?!\w))?))"
    rf"|(?<!\w)(?P<given>(?:{_GIVEN})(?:-(?:{_GIVEN})){{0,3}}){_BLANKS}+(?P<family>(?!{_OFFICE}){_CAP})(?!\w)"
)
_WORDS = re.compile(r"(?<!\w)[^\W\d_]+(?:-[^\W\d_]+)*(?!\w)")
_AT = re.compile(r"@")
_DIGIT = re.compile(r"\d")
_COLONS = re.compile(r"[0-9A-Fa-f]::?[0-9A-Fa-f]{1,4}:")
_SECRET_WORDS = ("passw", "pwd", "token", "secret", "api")
_KEY_MARKS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "AIza", "k_live_", "k_test_", "eyJ")
_CAPITALISED = re.compile(r"[A-ZÀ-ÖØ-ÞΑ-ΫА-ЯЁ]\w+")
_NAME_WORDS = {*_TITLES.split(), *GENDER}

Span = tuple[int, int, str, str]  # start, end, kind, value


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _iban_sum(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def script(word: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", word) else "greek" if re.search("[Ͱ-Ͽἀ-῿]", word) else "latin"


def _names(text: str) -> list[Span]:
    """Names by title or known given name, then every other mention of their words."""
    named: list[tuple[int, str, str]] = []  # place, word, gender of a given name
    genders: dict[tuple[str, str], set[str]] = {}
    for m in NAME.finditer(text):
        gender = "m" if m["male"] else "f" if m["female"] else "x"
        if m["given"]:
            words = [(m.start("given"), m["given"]), (m.start("family"), m["family"])]
        else:
            group = "titled" if m["titled"] else "upper"
            words = [(m.start(group) + w.start(), w[0]) for w in re.finditer(r"\S+", m[group])]
            if group == "upper":  # in capitals only a known given name tells that a second word belongs to it
                words = [w for w in words[: 2 if words[0][1].capitalize() in GENDER else 1] if w[1].capitalize() not in _NO_NAMES]
        for i, (at, w) in enumerate(words):
            first = len(words) == 2 and i == 0
            named.append((at, w, "given" if first else "family"))
            if first:
                genders.setdefault((script(w), w.lower()), set()).add(GENDER.get(w.split("-")[0].capitalize(), gender))
    found: list[Span] = []
    forms: dict[str, tuple[str, str]] = {}
    for at, w, part in named:
        alphabet, value = script(w), w.lower()
        if part == "given":
            told = genders[alphabet, value] - {"x"}
            part = f"given:{next(iter(told)) if len(told) == 1 else 'x'}"
        unit = f"{part}:{alphabet}", value
        found.append((at, at + len(w), *unit))
        for form in (w, w.upper(), w.capitalize() if w.isupper() else w):
            forms.setdefault(form, unit)
    if forms:
        for m in _WORDS.finditer(text):
            if m[0] in forms:
                found.append((*m.span(), *forms[m[0]]))
            elif "-" in m[0]:
                found += [(m.start() + p.start(), m.start() + p.end(), *forms[p[0]]) for p in re.finditer("[^-]+", m[0]) if p[0] in forms]
    return found


def _secrets(text: str) -> Iterator[Span]:
    """Values of assignments that hold a secret."""
    for m in ASSIGNED.finditer(text):
        group = m.lastgroup
        v = m[group]
        if not any(map(str.isalnum, v)):
            continue
        told = m["sign"] == "=" or m["shut"] or "_" in m["name"] or _LIKE_SECRET.search(v) or group != "bare" and not re.search(r"\s", v)
        if not told:  # a line that holds nothing else
            before = text[text.rfind("\n", 0, m.start()) + 1 : m.start()] if m.start() < 64 or "\n" in text[m.start() - 64 : m.start()] else "prose"
            told = not before.strip(" \t-*#>") and re.compile(r"[\"']?[^\S\r\n]*+(?:[\r\n]|\Z)").match(text, m.end(group))
        if told:
            yield *m.span(group), "secret", v


def _addresses(text: str) -> Iterator[Span]:
    """IPv6 addresses, whole or shortened once."""
    for m in IPV6.finditer(text):
        if any(map(str.isdigit, m[0])) and (m[0].count(":") == 7 or m[0].count("::") == 1):
            try:
                yield *m.span(), "ip6", ipaddress.IPv6Address(m[0]).compressed
            except ValueError:
                pass


def spans(text: str) -> list[Span]:
    """Entities of a whole text, left to right, without overlaps."""
    found: list[Span] = []
    if _AT.search(text):
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    if any(k in text for k in _KEY_MARKS):
        found += [(m.start(), m.end(), "key", m[0]) for m in ACCESS_KEY.finditer(text)]
    low = text.lower()
    if any(w in low for w in _SECRET_WORDS):
        found += _secrets(text)
    if _DIGIT.search(text):
        at = 0
        while m := NUMBER.search(text, at):
            digits = re.sub(r"\D", "", m[0])
            kind = next(k for k in ("ip", "ssn", "phone", "card") if m[k])
            if kind == "card" and not luhn(digits) or kind == "phone" and len(digits) < 7:
                at = m.start() + 1  # another number may begin inside
                continue
            found.append((m.start(), m.end(), kind, m[0] if kind == "ip" else digits))
            at = m.end()
        if _COLONS.search(text):
            found += _addresses(text)
        found += [(m.start(), m.end(), "iban", v) for m in IBAN.finditer(text) if 15 <= len(v := m[0].replace(" ", "")) <= 34 and _iban_sum(v) == 1]
    if not _NAME_WORDS.isdisjoint(_CAPITALISED.findall(text)):
        found += _names(text)
    found.sort(key=lambda s: (s[0], -s[1]))
    out: list[Span] = []
    for s in found:
        if not out or s[0] >= out[-1][1]:
            out.append(s)
    return out


def _stream(key: bytes, kind: str, value: str, attempt: int) -> Callable[[int], int]:
    """Numbers below n, one after another, from a keyed hash."""
    state, block = 0, b""

    def draw(n: int) -> int:
        nonlocal state, block
        if len(block) < 4:
            block = hmac.new(key, f"{kind}\0{attempt}\0{state}\0{value}".encode("utf-8", "replace"), hashlib.sha256).digest()
            state += 1
        got, block = int.from_bytes(block[:4], "big"), block[4:]
        return got % n

    return draw


def _same_classes(text: str, draw: Callable[[int], int]) -> str:
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hexed = bool(re.fullmatch(r"(?=.*[a-f])(?=.*\d)[0-9a-f]{8,}", text))
    out = []
    for c in text:
        if hexed:
            out.append("0123456789abcdef"[draw(16)])
        elif c.isdigit():
            out.append(str(draw(10)))
        elif c in lower:
            out.append(lower[draw(26)])
        elif c in upper:
            out.append(upper[draw(26)])
        elif c.isalpha():
            out.append((upper if c.isupper() else lower)[draw(26)])
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """Canonical surrogate of a unit; every eighth attempt makes open-ended
    kinds one character, syllable or name longer, so a full domain can't block."""
    draw = _stream(key, kind, value, attempt)
    longer = attempt // 8
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        labels = domain.split(".")
        return f"{_same_classes(local + 'x' * longer, draw)}@{'.'.join([*(_same_classes(x, draw) for x in labels[:-1]), labels[-1]])}"
    if kind == "ip":
        return ".".join(str(1 + draw(254)) for _ in range(4))
    if kind == "ip6":  # no group begins with a zero
        return re.sub(r"[0-9]|[a-f]", lambda m: "abcdef"[draw(6)] if m[0].isalpha() else str(draw(10)) if m.start() and value[m.start() - 1] != ":" else str(1 + draw(9)), value)
    if kind in ("phone", "ssn"):
        keep = 1 if len(value) <= 11 else 2
        return value[:keep] + _same_classes(value[keep:] + "0" * longer, draw)
    if kind == "card":
        body = value[0] + _same_classes(value[1:-1], draw)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "iban":
        body = _same_classes(value[4:], draw)
        return f"{value[:2]}{98 - _iban_sum(value[:2] + '00' + body):02d}{body}"
    if kind == "key":
        if value[:4] in ("AKIA", "ASIA"):
            return value[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw(32)] for _ in value[4:])
        starts = [(p, _KEY_START.match(p).end()) for p in value.split(".")]
        return ".".join(p[:n] + _same_classes(p[n:], draw) for p, n in starts)
    if kind == "secret":  # escapes of a quoted value stay valid
        parts = re.split(r"(\\u[0-9a-fA-F]{4}|\\.)", value)
        new = [_same_classes(x, draw) if i % 2 == 0 else f"\\u{97 + draw(26):04x}" if len(x) > 2 else x for i, x in enumerate(parts)]
        return "".join(new) + "x" * longer
    part, *rest = kind.split(":")
    alphabet = rest[-1]
    if part == "given":
        pool = [n for (s, g), names in POOL.items() if s == alphabet and (g == rest[0] or rest[0] == "x") for n in names.split()]
        return "-".join(pool[draw(len(pool))].lower() for _ in range(1 + longer))
    return "".join(SYLLABLES[alphabet][draw(len(SYLLABLES[alphabet]))] for _ in range(2 + longer))


def render(mention: str, kind: str, new: str) -> str:
    """The surrogate in a mention's own punctuation and case."""
    if kind in ("phone", "ssn", "card", "iban"):
        chars = iter(new)
        body = "".join(next(chars, "") if c.isalnum() else c for c in mention)
        return body + "".join(chars)
    if kind.startswith(("given", "family")):
        return new.upper() if len(mention) > 1 and mention.isupper() else "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
    if kind in ("email", "ip6") and mention.isupper():
        return new.upper()
    return new


def replaced(text: str, units: dict[tuple[str, str], str]) -> str:
    out, at = [], 0
    for start, end, kind, value in spans(text):
        out += [text[at:start], render(text[start:end], kind, units[kind, value])]
        at = end
    return "".join([*out, text[at:]])


UNIT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])


def detect(df: DataFrame, text_col: str = "text", out_col: str = "entities") -> DataFrame:
    """``df`` with ``out_col``: the distinct (kind, value) units of each whole text."""
    src = without(df, out_col)
    names = [*src.columns, out_col]
    out = nullable(T.StructType([*src.schema.fields, T.StructField(out_col, T.ArrayType(UNIT))]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))
        for whole in batches:
            for b in slices(whole, text_col):
                got = [[{"kind": k, "value": v} for k, v in dict.fromkeys(s[2:] for s in spans(t))] if t else [] for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, kind)], names=names)

    return src.mapInArrow(run, out)


def settle(heard: DataFrame) -> DataFrame:
    """(kind, value, rows) -> with ``unit``: the kind the value has in the whole
    corpus. A given name is one unit per script and value, of the gender that
    most of its rows tell."""
    alphabet = F.regexp_extract("kind", r"^given:.:(.*)$", 1)
    told = lambda g: F.sum(F.when(F.col("kind").startswith(f"given:{g}:"), F.col("rows")).otherwise(0)).alias(g)
    votes = heard.where(alphabet != "").groupBy(alphabet.alias("_script"), "value").agg(told("m"), told("f"))
    gender = F.when(F.col("m") > F.col("f"), "m").when(F.col("f") > F.col("m"), "f").otherwise("x")
    joined = heard.withColumn("_script", alphabet).join(votes, ["_script", "value"], "left")
    unit = F.when(F.col("_script") != "", F.concat(F.lit("given:"), gender, F.lit(":"), F.col("_script"))).otherwise(F.col("kind"))
    return joined.select("kind", "value", unit.alias("unit"))


def _space(kind: str = "kind"):
    """Kinds whose values must differ: given names of a script, of any gender."""
    return F.regexp_replace(kind, "^given:.:", "given:").alias("_space")


def assign(units: DataFrame, key: bytes = KEY) -> DataFrame:
    """Distinct (kind, value) -> with ``surrogate``: unique within a kind (given
    names: within a script) and equal to no real value there."""

    def draw(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            got = [surrogate(key, k, v, a) for k, v, a in zip(*(b.column(i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(got, pa.string())], names=["kind", "value", "attempt", "surrogate"])

    real = units.select(_space(), F.col("value").alias("surrogate")).distinct()
    drawn = materialize(units.withColumn("attempt", F.lit(0)).mapInArrow(draw, "kind string, value string, attempt int, surrogate string"), "pii-units")
    for _ in range(MAX_ATTEMPTS):
        owner = drawn.groupBy(_space(), "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"))
        clash = owner.join(real.withColumn("_real", F.lit(True)), ["_space", "surrogate"], "left")
        judged = drawn.withColumn("_space", _space()).join(clash, ["_space", "surrogate"]).withColumn("_again", F.col("_real").isNotNull() | (F.col("first.value") != F.col("value")))
        if judged.where("_again").isEmpty():
            return drawn.select("kind", "value", "surrogate")
        kept = judged.where("NOT _again").select("kind", "value", "attempt", "surrogate")
        again = judged.where("_again").select("kind", "value", (F.col("attempt") + 1).cast("int").alias("attempt"))
        drawn = materialize(kept.unionByName(again.mapInArrow(draw, "kind string, value string, attempt int, surrogate string")), "pii-units")
    raise RuntimeError(f"no distinct surrogates after {MAX_ATTEMPTS} attempts")


def pseudonymise(df: DataFrame, text_col: str = "text", key: bytes = KEY, entities_col: str = "entities") -> DataFrame:
    """``df`` with every entity of ``text_col`` replaced by its surrogate, and
    ``entities_col``: the number of different units the text held."""
    src = without(df, entities_col, "_units", "_row")
    found = detect(src, text_col, "_units")
    held = materialize(found.where(F.size("_units") > 0).withColumn("_row", F.monotonically_increasing_id()), "pii-rows")
    each = held.select("_row", F.explode("_units").alias("u")).select("_row", "u.kind", "u.value")
    heard = materialize(each.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("rows")), "pii-units")
    units = materialize(settle(heard), "pii-units")
    drawn = assign(units.select(F.col("unit").alias("kind"), "value").distinct(), key).withColumnRenamed("kind", "unit")
    known = each.join(units.join(drawn, ["unit", "value"]).select("kind", "value", "surrogate"), ["kind", "value"])
    per_row = known.groupBy("_row").agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("_map"))
    joined = held.drop("_units").join(per_row, "_row").drop("_row")
    names = src.columns
    out = nullable(T.StructType([*src.schema.fields, T.StructField(entities_col, T.LongType())]))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in slices(whole, text_col):
                texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
                maps = [{(u["kind"], u["value"]): u["surrogate"] for u in m} for m in b.column(b.schema.get_field_index("_map")).to_pylist()]
                new = pa.array([replaced(t, m) for t, m in zip(texts, maps)], pa.string())
                cols = [new if c == text_col else b.column(b.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array([len(m) for m in maps], pa.int64())], names=[*names, entities_col])

    clean = found.where(F.size("_units") == 0).drop("_units").withColumn(entities_col, F.lit(0).cast("long"))
    return clean.unionByName(joined.mapInArrow(run, out))


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, text with surrogates, and the number of entities of every document."""
    return pseudonymise(documents.select("doc_id", "text")).select("doc_id", "text", "entities")
