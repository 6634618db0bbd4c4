"""Personal data found in texts and replaced by surrogates of the same kind and form.

Entities are e-mail addresses, telephone numbers, IPv4 addresses, card numbers
with a valid check digit, and person names behind a form of address, with all
other mentions of their words in the same text. A surrogate
is the entity under a keyed permutation of all strings of its form, so an entity
gets the same surrogate wherever it occurs (coreference) and two entities never
get the same one (distinctness), without any table of them:

* digits stay digits, letters keep their case and script and whether they are
  vowels; punctuation and length stay; octets stay octets; a card number keeps
  its first digit and gets its check digit anew;
* a known given name becomes another of the same gender and script, any other
  name part is respelled in its own script. A respelling that happens to be a
  listed name is respelled again, which keeps the mapping one to one (the
  collision check).

The permutation is a Feistel network over the mixed radix of the form, wrapped
around a keyed shift, so no entity is left as it is.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

KEY = b"surrogates-1"
ROUNDS = 8

# Given names by script and gender, forms of address by gender, and letters by class.
GIVEN_NAMES = {
    ("latin", "f"): ("Alice", "Anna", "Barbara", "Camille", "Carmen", "Charlotte", "Clara", "Diana", "Elena", "Elizabeth", "Emma", "Eva", "Hannah", "Helen", "Isabel", "Jane", "Julia", "Karen", "Laura", "Linda", "Louise", "Lucia", "Maria", "Marie", "Mary", "Nina", "Olivia", "Patricia", "Rosa", "Sarah", "Sofia", "Susan"),
    ("latin", "m"): ("Adam", "Albert", "Anton", "Carlos", "Charles", "Daniel", "David", "Diego", "Erik", "Felix", "Frank", "George", "Hans", "Henri", "Hugo", "Jack", "James", "Jean", "John", "Jorge", "Karl", "Leon", "Louis", "Luis", "Mark", "Michael", "Oscar", "Paul", "Peter", "Robert", "Thomas", "William"),
    ("cyrillic", "f"): ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья", "Татьяна", "Юлия"),
    ("cyrillic", "m"): ("Алексей", "Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Михаил", "Николай", "Павел", "Сергей"),
    ("greek", "f"): ("Άννα", "Ειρήνη", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
    ("greek", "m"): ("Ανδρέας", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
}
ADDRESS_FORMS = {
    "f": ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Г-жа", "Κυρία"),
    "m": ("Mr.", "Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr.", "Г-н", "Κύριος"),
    "": ("Dr.", "Prof."),
}
# Country codes other than 1 and 7 have two digits if they are here, else three.
TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
LETTER_CLASSES = ("aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "áàâäéèêëíìîïóòôöúùûü", "ÁÀÂÄÉÈÊËÍÌÎÏÓÒÔÖÚÙÛÜ", "ñç", "ÑÇ", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "άέήίόύώ", "ΆΈΉΊΌΎΏ", "0123456789")
# Words in small letters inside a name, and those that stand before an apostrophe or hyphen.
PARTICLES = frozenset("van von vom zu zum zur der den dem des de del della dello dei degli delle di da das do dos du la las le les lo los y e af av ten ter te op 't bin ibn bint ben al el abu san santa st ap фон де ван дер ла ντε φον βαν".split())
ELIDED = frozenset("d l dell dall all o al el as es ad ar ash".split())
# Words that, though part of a name found, say nothing where they stand alone.
COMMON = frozenset("A Am An And Are As At But By For From He Her His I If In Is It Its My No Not Of On Or Our She So That The Their Then There They This To Was We Were What When Who Will With You Your Das Der Die Den Dem Des Ein Eine Er Es Ich Im Ist Sie Und Wir Al Del El En Ella Es La Las Le Les Lo Los No Se Si Su Un Una Y Yo Au Ce Elle En Est Et Il Ils Je Nous On Par Un Une Vous А В И К На Не Но Он Она Они По С Это Я Η Ο Οι Το Τα Και Στο Στη".split())
CLASS_OF = {letter: letters for letters in LETTER_CLASSES for letter in letters}
POOL_OF = {name: (kind, names) for kind, names in GIVEN_NAMES.items() for name in names}

# A possessive ending is no part of a word.
_word = r"[^\W\d_]+(?:[-'’](?!s(?!\w))[^\W\d_]+)*"
_forms = "|".join(sorted((re.escape(f) for forms in ADDRESS_FORMS.values() for f in forms), key=len, reverse=True))
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "card": r"(?<![\d])\d(?:[ -]?\d){12,18}(?!\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})|\(\d{2,4}\)|\d{3}(?=[.-]\d{3}[.-]\d{4}))(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    # The words of the name follow in ``name_stop``.
    "name": rf"(?<!\w)(?:(?:{_forms})[  ])+(?=[^\W\d_])",
}
# Text without any of these cannot hold an entity: a run of digits, an at sign, or a form of address.
HINT = re.compile(rf"@|\d[\d .()-]{{5,}}\d|(?<!\w)(?:{_forms})[  ]")
ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
ADDRESSED = re.compile(rf"(?:(?:{_forms})[  ])+")

WORD = re.compile(_word)
BLANKS = (" ", " ")
BETWEEN, BETWEEN_INITIALS = re.compile("[  ]"), re.compile("\\.[  ]?")


def _number(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.digest(key, "\x1f".join(map(str, parts)).encode(), "sha256")[:16], "big")


def _feistel(value: int, left_size: int, right_size: int, key: bytes, form: str, back: bool) -> int:
    left, right = divmod(value, right_size)
    for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
        sign = -1 if back else 1
        if i % 2:
            right = (right + sign * _number(key, form, i, left)) % right_size
        else:
            left = (left + sign * _number(key, form, i, right)) % left_size
    return left * right_size + right


def permuted(digits: list[int], radix: list[int], key: bytes, form: str) -> list[int]:
    """Digits of a mixed radix under a keyed permutation that leaves none as it is."""
    size = prod(radix)
    if size < 2:
        return digits
    half = len(radix) // 2
    left_size, right_size = prod(radix[:half]), prod(radix[half:])
    value = 0
    for digit, base in zip(digits, radix):
        value = value * base + digit
    value = _feistel(value, left_size, right_size, key, form, False)
    value = (value + 1 + _number(key, form, "shift") % (size - 1)) % size
    value = _feistel(value, left_size, right_size, key, form, True)
    out = []
    for base in reversed(radix):
        value, digit = divmod(value, base)
        out.append(digit)
    return out[::-1]


def respelled(text: str, key: bytes, kind: str) -> str:
    """Another string of the same form; a character of no known class stays."""
    classes = [CLASS_OF.get(c, c) for c in text]
    form = kind + "\x1e" + "".join(c[0] for c in classes)
    digits = permuted([letters.index(c) for c, letters in zip(text, classes)], [len(c) for c in classes], key, form)
    return "".join(letters[digit] for letters, digit in zip(classes, digits))


def name_part(text: str, key: bytes) -> str:
    if text in POOL_OF:
        (script, gender), names = POOL_OF[text]
        place = permuted([names.index(text)], [len(names)], key, f"given\x1e{script}\x1e{gender}")
        return names[place[0]]
    out = respelled(text, key, "name")
    while out in POOL_OF:
        out = respelled(out, key, "name")
    return out


def check_digit(digits: list[int]) -> int:
    """Digit that makes the number's weighted sum a multiple of ten."""
    doubled = [sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(reversed(digits))]
    return -sum(doubled) % 10


def country_code(digits: str) -> str:
    """Country code that an international number starts with; no code is the start of another."""
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3]


def is_card(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    return len(digits) >= 13 and check_digit(digits[:-1]) == digits[-1]


def surrogate(kind: str, text: str, key: bytes) -> str:
    """Replacement of an entity."""
    if kind == "email":
        local, _, domain = text.rpartition("@")
        labels, _, top = domain.rpartition(".")
        # Addresses are the same whatever their case, so the permutation works on lower case.
        return respelled(f"{local}@{labels}".lower(), key, "email\x1e" + top.lower()) + "." + top
    if kind == "ip":
        return ".".join(map(str, permuted([int(x) for x in text.split(".")], [256] * 4, key, "ip")))
    if kind == "card":
        digits = [int(c) for c in text if c.isdigit()]
        body = [digits[0], *permuted(digits[1:-1], [10] * (len(digits) - 2), key, f"card\x1e{len(digits)}\x1e{digits[0]}")]
        new = iter([*body, check_digit(body)])
        return "".join(str(next(new)) if c.isdigit() else c for c in text)
    if kind == "phone":
        # The country code stays; the form of the number is not part of the entity, only its digits are.
        digits = "".join(c for c in text if c.isdigit())
        head = country_code(digits) if text[0] == "+" else ""
        rest = [int(c) for c in digits[len(head) :]]
        sign = "+" if text[0] == "+" else ""
        new = iter([*head, *permuted(rest, [10] * len(rest), key, f"phone\x1e{sign}{head}\x1e{len(rest)}")])
        return "".join(str(next(new)) if c.isdigit() else c for c in text)
    address = found.end() if (found := ADDRESSED.match(text)) else 0
    return text[:address] + WORD.sub(lambda m: name_part(m.group(), key) if is_name_word(m.group()) else m.group(), text[address:])


def is_name_word(word: str) -> bool:
    """Capitalised, or with a capital behind an elided word or particle (d'Artagnan, al-Hassan)."""
    first, *rest = re.split("[-'’]", word)
    return first[0].isupper() or (first in ELIDED or first in PARTICLES) and any(part[:1].isupper() for part in rest)


def name_stop(text: str, start: int) -> int:
    """Where the name that starts here ends: any number of name words, initials with their full stop, particles only before such words."""
    stop, at = start, start
    while match := WORD.match(text, at):
        word = match.group()
        if at > start and ADDRESSED.match(text, at):
            break
        if is_name_word(word):
            stop = match.end()
        elif word not in PARTICLES:
            break
        after = BETWEEN_INITIALS.match(text, match.end()) if len(word) == 1 and word.isupper() else None
        after = after or BETWEEN.match(text, match.end())
        if not after:
            break
        at = after.end()
    return stop


def mentions(text: str, start: int, stop: int, known: set[str]) -> Iterator[tuple[int, int]]:
    """Where words of names already found stand without a form of address; neighbours are one mention, with the particles between them."""
    first = last = None
    alone = False
    for match in WORD.finditer(text, start, stop):
        word = match.group()
        if first is not None and not (BETWEEN.fullmatch(text, last, match.start()) or BETWEEN_INITIALS.fullmatch(text, last, match.start())) and not _bridged(text, last, match.start()):
            if alone:
                yield first, last
            first, alone = None, False
        if word in known:
            first = match.start() if first is None else first
            last, alone = match.end(), alone or word not in COMMON and len(word) > 1
        elif "-" in word or "'" in word or "’" in word:
            if first is not None and alone:
                yield first, last
            first, alone = None, False
            for part in re.finditer(r"[^\W\d_]+", word):
                if part.group() in known and part.group() not in COMMON and len(part.group()) > 1:
                    yield match.start() + part.start(), match.start() + part.end()
    if first is not None and alone:
        yield first, last


def _bridged(text: str, start: int, stop: int) -> bool:
    """Whether only particles stand between two words."""
    between = text[start:stop]
    return between[:1] in BLANKS and between[-1:] in BLANKS and all(word in PARTICLES for word in between.split())


def entities(text: str | None) -> Iterator[tuple[str, int, int]]:
    """``kind, start, stop`` of the entities of a text, from left to right; names also where they are repeated without a form of address."""
    if not text or not HINT.search(text):
        return
    found = list(_direct(text))
    known = {m.group() for kind, start, stop in found if kind == "name" for m in WORD.finditer(text, ADDRESSED.match(text, start).end(), stop) if is_name_word(m.group())}
    if not known:
        yield from found
        return
    at = 0
    for kind, start, stop in [*found, ("", len(text), len(text))]:
        yield from (("name", a, b) for a, b in mentions(text, at, start, known))
        if kind:
            yield kind, start, stop
        at = stop


def _direct(text: str) -> Iterator[tuple[str, int, int]]:
    """Entities that are known by their own form; a name ends before its first word that is neither capitalised nor a particle inside it."""
    at = 0
    while match := ANY.search(text, at):
        kind, (start, stop) = match.lastgroup, match.span()
        at = stop
        if kind == "card":
            # Digit groups may stand beside a number: the longest run of whole groups with a valid check digit counts.
            ends = [start + m.end() for m in re.finditer(r"\d+", match.group())]
            stop = next((end for end in reversed(ends) if is_card(text[start:end])), None)
            at = ends[0] if stop is None else stop
            if stop is None:
                continue
        if kind == "name":
            at = stop = name_stop(text, match.end())
            if stop == match.end():
                continue
        yield kind, start, stop


@lru_cache(maxsize=50_000)
def _surrogate(kind: str, text: str, key: bytes) -> str:
    return surrogate(kind, text, key)


def replaced(text: str | None, key: bytes, make: Callable[[str, str, bytes], str] = _surrogate) -> tuple[str | None, list[dict]]:
    """The text with surrogates, and where they stand in it."""
    pieces, spans, at, length = [], [], 0, 0
    for kind, start, stop in entities(text):
        new = make(kind, text[start:stop], key)
        pieces += [text[at:start], new]
        length += start - at
        spans.append({"kind": kind, "start": length, "stop": length + len(new)})
        length += len(new)
        at = stop
    return (text if not spans else "".join([*pieces, text[at:]])), spans


def replace_entities(df: DataFrame, key: bytes = KEY, text: str = "text", text_out: str | None = None, spans_out: str = "pii_spans") -> DataFrame:
    """``df`` with ``text`` replaced (or ``text_out`` added) and ``spans_out``: kind and place of each surrogate.

    A null text stays null and an empty one empty, both without spans. Texts
    without entities come back as they are. Whole texts are searched, whatever
    their length; equal texts give equal results in any row or run with the same
    key. Other columns pass through, and columns named as the outputs are
    replaced.
    """
    kind = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))])

    def replace_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            done = [replaced(value.as_py(), key) for value in batch]
            columns = [pa.array([t for t, _ in done], pa.string()), pa.array([s for _, s in done], kind.field("spans").type)]
            yield pa.StructArray.from_arrays(columns, fields=list(kind))

    target = text_out or text
    hidden = f"__replaced_{len(df.columns)}"
    done = F.arrow_udf(replace_batches, "text string, spans array<struct<kind:string,start:bigint,stop:bigint>>")(F.col(f"`{text}`"))
    names = [c for c in df.columns if c != spans_out] + ([target] if target not in df.columns else [])
    with_done = df.withColumn(hidden, done)
    chosen = [F.col(hidden)["text"].alias(target) if c == target else F.col(f"`{c}`") for c in names]
    return with_done.select(*chosen, F.col(hidden)["spans"].alias(spans_out))


def collisions(df: DataFrame, key: bytes = KEY, text: str = "text") -> DataFrame:
    """``kind, surrogate, n, entity`` of surrogates that stand for several entities of a table, and of entities with several surrogates; there should be none.

    ``n`` counts the others; ``entity`` is null in the first case, ``surrogate`` in
    the second. An audit over all rows: entities are combined before they are
    shuffled.
    """

    def list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = {(kind, form(kind, body[start:stop]), form(kind, _surrogate(kind, body[start:stop], key))) for body in batch.column(0).to_pylist() for kind, start, stop in entities(body)}
            yield pa.RecordBatch.from_pylist([{"kind": k, "entity": e, "surrogate": s} for k, e, s in sorted(pairs)], schema=schema)

    schema = pa.schema([(c, pa.string()) for c in ("kind", "entity", "surrogate")])
    pairs = df.select(F.col(f"`{text}`")).mapInArrow(list_batches, "kind string, entity string, surrogate string").distinct()
    pairs = checkpoint_once(pairs)
    shared = pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n"), F.lit(None).cast("string").alias("entity"))
    split = pairs.groupBy("kind", "entity").agg(F.count("*").alias("n")).select("kind", F.lit(None).cast("string").alias("surrogate"), "n", "entity")
    return shared.union(split).filter("n > 1")


def form(kind: str, text: str) -> str:
    """What makes two mentions one entity: case aside for e-mail, punctuation aside for numbers, the form of address aside for names."""
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card"):
        return re.sub(r"[^\d+]", "", text)
    return ADDRESSED.sub("", text) if kind == "name" else text
