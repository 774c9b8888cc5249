"""Personal data: keyed, type-consistent surrogates with a collision check over the whole corpus."""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from larder.llm.arrow import map_text, prepare, with_field
from larder.session import settle

# Titles with the gender they tell, and given names by script and gender.
TITLES = {"mr": "m", "mister": "m", "sir": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "don": "m", "господин": "m", "г-н": "m",
          "κύριος": "m", "mrs": "f", "ms": "f", "miss": "f", "madam": "f", "frau": "f", "madame": "f", "mme": "f", "mlle": "f",
          "señora": "f", "sra": "f", "señorita": "f", "doña": "f", "госпожа": "f", "г-жа": "f", "κυρία": "f", "dr": "", "prof": ""}
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Greta Ines Julia Laura Marta Nora Paula Rosa Sofia",
    ("latin", "m"): "Adam Bruno David Emil Felix Hugo Jonas Leon Martin Oscar Paul Viktor",
    ("cyrillic", "f"): "Анна Вера Дарья Ирина Мария Нина Ольга Софья",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Иван Олег Павел Юрий",
    ("greek", "f"): "Άννα Ελένη Ζωή Μαρία Σοφία",
    ("greek", "m"): "Γιώργος Νίκος Πέτρος Σταύρος Λουκάς",
}
SYLLABLES = {"latin": ("b d f g h k l m n p r s t v w", "a e i o u"), "cyrillic": ("б в г д з к л м н п р с т", "а е и о у"),
             "greek": ("β γ δ κ λ μ ν π ρ σ τ", "α ε η ι ο")}
ENDINGS = {("latin", "f"): "a", ("latin", "m"): "o", ("cyrillic", "f"): "а", ("cyrillic", "m"): "ий", ("greek", "f"): "η", ("greek", "m"): "ος"}
SURNAME_ENDINGS = {("latin", ""): "ner", ("latin", "f"): "ner", ("latin", "m"): "ner", ("cyrillic", ""): "енко", ("cyrillic", "f"): "ова",
                   ("cyrillic", "m"): "ов", ("greek", ""): "ου", ("greek", "f"): "ίδη", ("greek", "m"): "ίδης"}

_GENDER_OF = {n.casefold(): g for (_, g), names in GIVEN.items() for n in names.split()}
_EMAIL = r"(?P<email>(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})"
_IP = r"(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w))"
_CARD = r"(?P<card>(?<![\w-])(?:[3-6]\d{3}(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{4}|3[47]\d{13})(?!\w))"
_PHONE = (r"(?P<phone>(?<![\w+(])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-.]\d{3}[-.]\d{4})"
          r"|\+\d{1,3}(?:[ .-]\d{2,4}){3,5})(?![\w]))")
_UPPER = r"[^\W\d_a-zà-öø-ÿа-яё]"
_CAPITAL = rf"(?:{_UPPER}['’])?{_UPPER}[^\W\d_]+(?:-{_UPPER}[^\W\d_]+)*"
_TITLED = rf"\b(?P<title>(?i:{'|'.join(sorted(map(re.escape, TITLES), key=len, reverse=True))}))\.? (?P<name>{_CAPITAL}(?: {_CAPITAL})?)"
_NAMED = rf"(?P<named>\b(?P<given>{'|'.join(sorted(n for names in GIVEN.values() for n in names.split()))}) (?P<surname>{_CAPITAL})\b)"
_FIND = re.compile("|".join((_EMAIL, _IP, _CARD, _PHONE, _TITLED, _NAMED)))
#: Texts without any of these hold no entity. Arrow's \b, \w and \d know ASCII only: no \b here, and digits by \p{Nd}.
_WORTH = (r"@|\p{Nd}{4}|\p{Nd}\.\p{Nd}+\.\p{Nd}|\([\p{Nd}]{3}\)|\p{Nd}{3}[-.]\p{Nd}{3}|\+\p{Nd}|(?i)(?:" + "|".join(map(re.escape, TITLES)) + r")\.? |"
          + "|".join(n for names in GIVEN.values() for n in names.split()))


@dataclass(frozen=True)
class Mention:
    """A place in a text: the entity's kind, its canonical form, and what a surrogate must match."""
    start: int
    end: int
    kind: str
    canon: str
    traits: str


def luhn(digits: str) -> bool:
    total = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "").split(" ")[0].lower()
    return name if name in SYLLABLES else "latin"


def _private(octets: list[int]) -> str:
    a, b = octets[:2]
    return "10" if a == 10 else "192.168" if (a, b) == (192, 168) else "172" if a == 172 and 16 <= b < 32 else "public"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def mentions(text: str) -> list[Mention]:
    """Entities of a text from left to right, without overlap."""
    found = []
    for m in _FIND.finditer(text):
        if m["email"]:
            found.append(Mention(m.start(), m.end(), "email", m[0].lower(), ""))
        elif m["ip"]:
            octets = [int(x) for x in m[0].split(".")]
            if all(o < 256 for o in octets):
                found.append(Mention(m.start(), m.end(), "ip", ".".join(map(str, octets)), _private(octets)))
        elif m["card"]:
            digits = _digits(m[0])
            found.append(Mention(m.start(), m.end(), "card", digits, "luhn" if luhn(digits) else ""))
        elif m["phone"]:
            code = re.match(r"\+(\d{1,3})(?=[ .(-])", m[0])
            national = _digits(m[0][code.end():] if code else m[0])
            canon = national if not code or code[1] == "1" else f"+{code[1]} {national}"
            found.append(Mention(m.start(), m.end(), "phone", canon, ""))
        else:
            if m["named"]:
                words = [("given", m.start("given"), m["given"]), ("surname", m.start("surname"), m["surname"])]
                gender = _GENDER_OF[m["given"].casefold()]
            else:
                gender, at, parts = TITLES[m["title"].lower()], m.start("name"), m["name"].split(" ")
                kinds = ["given", "surname"] if len(parts) == 2 else ["surname"]
                words = [(kinds[k], at + sum(len(p) + 1 for p in parts[:k]), p) for k, p in enumerate(parts)]
                gender = gender or (_GENDER_OF.get(parts[0].casefold(), "") if len(parts) == 2 else "")
            for kind, start, word in words:
                found.append(Mention(start, start + len(word), kind, word.casefold(), f"{script_of(word)} {gender}"))
    return found


class Stream:
    """Keyed pseudo-random choices for one entity and attempt."""

    def __init__(self, secret: bytes, kind: str, canon: str, attempt: int):
        self.secret, self.seed, self.count, self.pool = secret, f"{kind}\x00{canon}\x00{attempt}".encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 64:
            block = hmac.new(self.secret, self.seed + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.count = int.from_bytes(block, "big") | 1 << 256, self.count + 1
        self.pool, value = divmod(self.pool, n)
        return value

    def pick(self, choices: str) -> str:
        options = choices.split(" ") if " " in choices else choices
        return options[self.below(len(options))]


def surrogate(secret: bytes, kind: str, canon: str, traits: str, attempt: int) -> str:
    """Canonical surrogate of an entity: same kind, script, gender, length and format. From the fourth attempt on,
    when a format's space runs short, words and mail names grow longer."""
    s = Stream(secret, kind, canon, attempt)
    if kind == "email":
        name, _, domain = canon.rpartition("@")
        labels = domain.split(".")
        vary = lambda text: "".join(
            str(s.below(10)) if c.isdigit() else s.pick("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in text)
        extra = "".join(s.pick("abcdefghijklmnopqrstuvwxyz") for _ in range(max(0, attempt - 3)))
        return f"{vary(name)}{extra}@{'.'.join(map(vary, labels[:-1]))}.{labels[-1]}"
    if kind == "ip":
        if traits == "10":
            parts = ["10", s.below(256), s.below(256), s.below(256)]
        elif traits == "192.168":
            parts = ["192", "168", s.below(256), s.below(256)]
        elif traits == "172":
            parts = ["172", 16 + s.below(16), s.below(256), s.below(256)]
        else:
            parts = [1 + s.below(223), s.below(256), s.below(256), 1 + s.below(254)]
            while _private(parts) != "public" or parts[0] == 127:
                parts[0] = 1 + s.below(223)
        return ".".join(map(str, parts))
    if kind == "card":
        digits = canon[0] + "".join(str(s.below(10)) for _ in canon[2:])
        return next(digits + str(d) for d in range(10) if luhn(digits + str(d))) if traits == "luhn" else next(
            digits + str(d) for d in [(s.below(10) + k) % 10 for k in range(10)] if not luhn(digits + str(d)))
    if kind == "phone":
        head, _, national = canon.rpartition(" ")
        fresh = str(2 + s.below(8)) + "".join(str(s.below(10)) for _ in national[1:])
        return f"{head} {fresh}" if head else fresh
    script, _, gender = traits.partition(" ")
    consonants, vowels = SYLLABLES[script]
    if kind == "given":
        names = GIVEN[script, gender] if gender else GIVEN[script, "f"] + " " + GIVEN[script, "m"]
        if attempt < 3:
            return s.pick(names).casefold()
        body = "".join(s.pick(consonants) + s.pick(vowels) for _ in range(1 + attempt // 2))
        return body + s.pick(consonants) + (ENDINGS[script, gender] if gender else s.pick(vowels))
    body = "".join(s.pick(consonants) + s.pick(vowels) for _ in range(2 + attempt))
    return body + SURNAME_ENDINGS[script, gender]


#: Draws after which a format's space counts as crowded, as more than half of it would have to be taken for that to happen.
CROWDED = 16


def permuted(secret: bytes, space: str, value: int, size: int) -> int:
    """A keyed permutation of the numbers below ``size``: a Feistel network over the next even power of two, walked
    until it comes back below ``size``."""
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for turn in range(8):
            block = hmac.new(secret, f"{space}\x00{turn}\x00{right}".encode(), hashlib.sha256).digest()
            left, right = right, left ^ int.from_bytes(block[:16], "big") & mask
        value = left << half | right
        if value < size:
            return value


def space_of(kind: str, canon: str, traits: str) -> str:
    """The finite set an entity and its surrogates belong to; empty for words and mail names, which can grow."""
    if kind == "ip":
        return f"ip {traits}"
    if kind == "card":
        return f"card {traits} {canon[0]} {len(canon)}"
    if kind == "phone":
        head, _, national = canon.rpartition(" ")
        return f"phone {head} {len(national)} {national[0] > '1'}"
    return ""


def permuted_surrogate(secret: bytes, kind: str, canon: str, traits: str) -> str:
    """The surrogate of an entity of a crowded space: different for different entities, however many there are. It may
    be the entity of another place, or in rare cases the entity itself."""
    space = space_of(kind, canon, traits)
    if kind == "ip":
        number = int.from_bytes(bytes(map(int, canon.split("."))), "big")
        fixed, size = {"10": (10 << 24, 1 << 24), "192.168": (49320 << 16, 1 << 16), "172": (44048 << 16, 1 << 20)}.get(traits, (0, 1 << 32))
        while True:
            number = fixed + permuted(secret, space, number - fixed, size)
            octets = list(number.to_bytes(4, "big"))
            if _private(octets) == traits:
                return ".".join(map(str, octets))
    if kind == "card":
        # the digits between the first and the last, and which of the last digits that are possible it is
        def lasts(body: str) -> list[str]:
            return [str(d) for d in range(10) if luhn(body + str(d)) == (traits == "luhn")]

        body, each = canon[:-1], 1 if traits == "luhn" else 9
        value = int(canon[1:-1]) * each + lasts(body).index(canon[-1])
        middle, last = divmod(permuted(secret, space, value, 10 ** (len(canon) - 2) * each), each)
        body = f"{canon[0]}{middle:0{len(canon) - 2}d}"
        return body + lasts(body)[last]
    head, _, national = canon.rpartition(" ")
    unit = 10 ** (len(national) - 1)
    least, count = (2, 8) if national[0] > "1" else (0, 2)
    fresh = least * unit + permuted(secret, space, int(national) - least * unit, count * unit)
    return f"{head} {fresh:0{len(national)}d}".strip()


def rendered(shown: str, kind: str, new: str) -> str:
    """The canonical surrogate in the format of the mention it stands for."""
    if kind in ("card", "phone"):
        digits = list(_digits(new.rpartition(" ")[2] if kind == "phone" else new))
        out = list(shown)
        for at in range(len(out) - 1, -1, -1):
            if out[at].isdigit() and digits:
                out[at] = digits.pop()
        return "".join(out)
    if kind == "ip":
        return new
    if shown.isupper():
        return new.upper()
    if shown.islower():
        return new
    return new[0].upper() + new[1:]


def find_entities(frame: DataFrame, text: str, out: str) -> DataFrame:
    """All columns of ``frame`` and ``out``, an array of the text's mentions."""
    schema = with_field(frame.schema, out, "array<struct<start:int,end:int,kind:string,canon:string,traits:string>>")

    def work(batch: pa.RecordBatch) -> dict:
        texts = batch.column(text).fill_null("")
        worth = pc.match_substring_regex(texts, _WORTH).to_pylist()
        found = [[vars(m) for m in mentions(texts[k].as_py())] if worth[k] else [] for k in range(len(texts))]
        return dict(enumerate([*batch.columns, found]))

    return map_text(frame, work, schema, text)


def assign_surrogates(entities: DataFrame, secret: bytes) -> DataFrame:
    """Rows (kind, canon, surrogate) for rows (kind, canon, traits), one per entity.

    A surrogate is taken by one entity of its kind only and is no entity of the corpus itself. Where two
    entities draw the same, the one with the smaller canonical form keeps it, and the others draw again; every
    round settles at least one of each clash. Words and mail names grow with the rounds, so they always end. A
    space of numbers (the addresses of a private network, the phone numbers of a length and country) that still has
    entities without a surrogate after CROWDED rounds is too full for that: all its entities then get theirs from a
    keyed permutation of the space, which are different from each other but may be entities of the corpus.
    """
    spark = prepare(entities.sparkSession)

    def replaced(choose):
        """The rows of batches with what ``choose`` makes of an entity, without those it gives nothing for."""
        def work(batches):
            for batch in batches:
                rows = [(*x, new) for x in zip(*(batch.column(c).to_pylist() for c in ("kind", "canon", "traits"))) if (new := choose(*x))]
                columns = [pa.array(c, pa.string()) for c in zip(*rows)] or [pa.array([], pa.string())] * 4
                yield pa.RecordBatch.from_arrays(columns, ["kind", "canon", "traits", "surrogate"])
        return work

    shape = "kind string, canon string, traits string, surrogate string"
    entities = settle(entities.groupBy("kind", "canon").agg(F.max("traits").alias("traits")), "entities")
    real = entities.select("kind", F.col("canon").alias("surrogate"))
    pending, taken, attempt = entities, None, 0
    while True:
        if attempt == CROWDED:
            spaces = pending.mapInArrow(replaced(space_of), shape).select(F.col("surrogate").alias("space")).distinct()
            crowded = settle(entities.mapInArrow(replaced(space_of), shape).withColumnRenamed("surrogate", "space")
                             .join(spaces, "space", "left_semi").select("kind", "canon", "traits"), "crowded")
            fixed = crowded.mapInArrow(replaced(lambda *x: permuted_surrogate(secret, *x)), shape).select("kind", "surrogate", "canon")
            taken = settle(taken.join(crowded, ["kind", "canon"], "left_anti").select("kind", "surrogate", "canon").unionByName(fixed), "taken")
        else:
            drawn = settle(pending.mapInArrow(replaced(lambda *x, n=attempt: surrogate(secret, *x, n)), shape), "drawn")
            free = drawn.join(real if taken is None else real.unionAll(taken.select("kind", "surrogate")), ["kind", "surrogate"], "left_anti")
            won = free.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
            taken = settle(won if taken is None else taken.unionByName(won), "taken")
        pending = settle(pending.join(taken, ["kind", "canon"], "left_anti"), "pending")
        if pending.isEmpty():
            return taken.select("kind", "canon", "surrogate")
        attempt += 1


def replace_entities(frame: DataFrame, secret: bytes, text: str = "text", count: str = "n_entities") -> DataFrame:
    """All columns of ``frame`` with personal data in ``text`` replaced, and ``count``, the number of places replaced.

    Mail addresses, phone and card numbers, IPv4 addresses and names after titles or of known given names are
    found in whole texts. One entity gets one surrogate everywhere, whatever format it is mentioned in (a phone
    number with or without country code 1, a surname with or without given name, upper or lower case); two
    entities never share one. Surrogates depend on ``secret``, and on the corpus only where two clash. Null and
    empty texts stay as they are with count 0, repeated rows are treated alike, a column named ``count`` is
    replaced. Only texts with mentions are joined to their replacements.
    """
    spark = prepare(frame.sparkSession)
    frame = frame.drop(count)
    own, digest = "__mentions", "__digest"
    marked = settle(find_entities(frame, text, own), "mentions")
    plain = marked.filter(F.size(own) == 0).drop(own).withColumn(count, F.lit(0).cast("long"))
    some = marked.filter(F.size(own) > 0).withColumn(digest, F.sha2(F.col(text), 256))
    places = some.select(digest, F.posexplode(own).alias("place", "m")).select(digest, "place", "m.kind", "m.canon", "m.traits")
    drawn = assign_surrogates(places.select("kind", "canon", "traits"), secret)
    new = (places.select(digest, "place", "kind", "canon").distinct().join(drawn, ["kind", "canon"]).groupBy(digest)
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "surrogate"))), lambda x: x["surrogate"]).alias("__new")))
    schema = with_field(frame.schema, count, "long")
    arrow = to_arrow_schema(schema)
    names = frame.columns

    def rewrite(batches):
        for batch in batches:
            out = []
            for old, found, replacements in zip(*(batch.column(c).to_pylist() for c in (text, own, "__new"))):
                parts, end = [], 0
                for m, r in zip(found, replacements):
                    parts += [old[end:m["start"]], rendered(old[m["start"]:m["end"]], m["kind"], r)]
                    end = m["end"]
                out.append("".join([*parts, old[end:]]))
            sizes = pc.list_value_length(batch.column(own)).cast(pa.int64())
            columns = [pa.array(out, arrow.field(text).type) if c == text else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, sizes], schema=arrow)

    del spark
    rewritten = some.join(new, digest).select(*names, own, "__new").mapInArrow(rewrite, schema)
    return plain.unionByName(rewritten)
