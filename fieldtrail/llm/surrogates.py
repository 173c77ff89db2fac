"""PII surrogates: detected entities get keyed, type-consistent replacements.

Entities are e-mail addresses, phone numbers, card numbers, IBANs, social security numbers, IP
addresses, access keys, secrets after ``password=`` and the like, and names after a title. What
makes two mentions the same entity is its normal form: letters in lower case and digits, without
punctuation; names count word by word, so that a full name and a surname agree. The replacement is
drawn from a keyed hash of type and normal form: same mention, same replacement, in every text.

It keeps the format: digits for digits, letters for letters in the same case, all punctuation, the
country code of a phone number, the first digit and the check digit of a card, octets of as many
digits, the check digits of an IBAN, the prefix of an access key, the last label of a host. Names
keep script (Latin, Cyrillic, Greek) and the gender that their title tells.

All distinct entities are checked together: a replacement that is a real entity of the corpus, or
that a smaller entity has already, is drawn again with the next attempt, until none collides. From
``WIDEN`` attempts on, forms that leave too few choices grow by a character. Only entities drawn
again have to reach their texts; if there are none, texts are not shuffled.

Cases: NULL text stays NULL, empty stays empty; texts without entities stay as they are; repeated
rows are treated alike; an empty table gives no rows; other columns stay, and ``clean_text`` and
``entities`` replace columns of these names. Patterns start at the begin of a run only, so that
very long texts without spaces take linear time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldtrail.llm.common import kinds, stored, workers_can_import

WIDEN = 16
# Titles by the gender they tell.
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof"],
}
# Syllables of invented names, and endings of given names by gender.
SYLLABLES = {
    "latin": "ba be bo da do el fa ga ha jo ka la le lo ma me mi na no or pa ra re ri ro sa se ta te va ve wi".split(),
    "cyrillic": "ба бо ва во га да до ка ко ла ле ли ма ми на но ра ре ро са се та ти фа".split(),
    "greek": "βα γα δα δι θα κα κο λα λε μα μι να νι πα ρα ρο σα τα τι φα".split(),
}
ENDINGS = {
    "latin": {"m": ["n", "s", "rd", "l"], "f": ["na", "la", "ra", "sa"], "n": ["n", "r", "th", "m"]},
    "cyrillic": {"m": ["н", "р", "л", "д"], "f": ["на", "ла", "ра", "ва"], "n": ["нко", "рко", "лко", "тко"]},
    "greek": {"m": ["νος", "ρης", "λος"], "f": ["να", "ρα", "λα"], "n": ["του", "κου", "λου"]},
}
_TITLE_GENDER = {t.lower(): g for g, titles in TITLES.items() for t in titles}
_WORD = r"[A-ZÀ-ÖØ-ÞΑ-ΩА-ЯЁ][\w'’-]*"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<!\w)(?:[Pp]assword|PASSWORD|passwd|pwd|[Ss]ecret|[Tt]oken|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?(?P<secret_value>[^\s\"']{6,})",
    "key": r"(?<![0-9A-Za-z])(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![0-9A-Za-z])",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{4}[ -]?){3}\d{1,7}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3}[ .-]?\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)",
    "name": rf"(?<!\w)(?P<title>{'|'.join(sorted((re.escape(t) for t in {**{x: 1 for v in TITLES.values() for x in v}}), key=len, reverse=True))})\.?[ \t]+(?P<names>{_WORD}(?:[ \t]+{_WORD}){{0,2}})",
}
_FIND = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))

#: What a line must hold for an entity.
_MARK = re.compile("[0-9@=:]|A[KS]IA")
_TITLE_MARKS = tuple(sorted({f"{t}{end}" for v in TITLES.values() for t in v for end in (" ", ".")}))


def normal(text: str) -> str:
    return "".join(c for c in text.lower() if c.isalnum())


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normal form) of each entity, in order. No entity spans lines, and only
    lines with a character or title that one needs are searched."""
    out, begin = [], 0
    titled = any(t in text for t in _TITLE_MARKS)
    for line in text.split("\n"):
        if _MARK.search(line) or (titled and any(t in line for t in _TITLE_MARKS)):
            for m in _FIND.finditer(line):
                out += _mentions(m, begin)
        begin += len(line) + 1
    return out


def _mentions(m: re.Match, begin: int) -> list[tuple[int, int, str, str]]:
    kind = next(k for k in PATTERNS if m[k] is not None)
    start, end = m.start() + begin, m.end() + begin
    if kind == "secret":
        return [(m.start("secret_value") + begin, m.end("secret_value") + begin, kind, m["secret_value"])]
    if kind == "name":
        gender, words = _TITLE_GENDER[m["title"].lower()], list(re.finditer(r"\S+", m["names"]))
        at = m.start("names") + begin
        return [
            (at + w.start(), at + w.end(), f"name_{gender if i < len(words) - 1 else 'family'}", w[0].lower())
            for i, w in enumerate(words)
        ]
    if kind == "card":
        digits = normal(m[0])
        return [(start, end, kind, digits)] if 13 <= len(digits) <= 19 and digits[0] in "3456" else []
    if kind in ("email", "ip"):
        return [(start, end, kind, m[0].lower())]
    return [(start, end, kind, normal(m[0]))]


class Draw:
    """Numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.seed = hashlib.blake2b("\x00".join(parts).encode(), key=key, digest_size=32).digest()
        self.value, self.block = 0, 0

    def below(self, n: int) -> int:
        if self.value < n << 32:
            self.block += 1
            more = hashlib.blake2b(self.seed + self.block.to_bytes(8, "big"), digest_size=64).digest()
            self.value = self.value << 512 | int.from_bytes(more, "big")
        self.value, out = divmod(self.value, n)
        return out

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits; hexadecimal stays hexadecimal."""
        letters = "abcdef" if re.fullmatch(r"[0-9a-f]{8,}", text) else "abcdefghijklmnopqrstuvwxyz"
        out = []
        for c in text:
            if c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                drawn = letters[self.below(len(letters))]
                out.append(drawn.upper() if c.isupper() else drawn)
            else:
                out.append(c)
        return "".join(out)


def luhn_digit(body: str) -> str:
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(body)))
    return str(-total % 10)


def script_of(word: str) -> str:
    if re.search("[Ѐ-ӿ]", word):
        return "cyrillic"
    return "greek" if re.search("[Ͱ-Ͽ]", word) else "latin"


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The replacement's normal form."""
    draw = Draw(key, kind, entity, str(attempt))
    wide = attempt // WIDEN  # extra characters where the form leaves too few choices
    if kind.startswith("name_"):
        script, gender = script_of(entity), kind.removeprefix("name_")
        syllables = SYLLABLES[script]
        body = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + (gender == "family") + wide))
        endings = ENDINGS[script][gender if gender in "mf" else "n"]
        return body + endings[draw.below(len(endings))]
    if kind == "email":
        local, _, host = entity.partition("@")
        labels = host.split(".")
        return draw.like(local + "a" * wide) + "@" + ".".join([*(draw.like(x) for x in labels[:-1]), labels[-1]])
    if kind == "ip":
        ranges = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        if wide:
            ranges = dict.fromkeys((1, 2, 3), (0, 256))
        return ".".join(str(low + draw.below(n)) for low, n in (ranges[len(x)] for x in entity.split(".")))
    if kind == "key":
        return entity[:4] + draw.like(entity[4:])
    if kind == "card":
        valid = luhn_digit(entity[:-1]) == entity[-1]
        body = entity[0] + draw.like(entity[1:-1] + "0" * wide)
        return body + (luhn_digit(body) if valid else draw.like(entity[-1]))
    if kind == "iban":
        body = draw.like(entity[4:] + "0" * wide)
        number = "".join(str(int(c, 36)) for c in body + entity[:2] + "00")
        return f"{entity[:2]}{98 - int(number) % 97:02d}{body}"
    if kind == "phone" and len(entity) > 10:
        code = len(entity) - 10
        return entity[:code] + str(2 + draw.below(8)) + draw.like(entity[code + 1 :] + "0" * wide)
    return draw.like(entity + ("0" if entity[-1].isdigit() else "a") * wide)


def in_format(mention: str, kind: str, replacement: str) -> str:
    """The replacement with the punctuation and case of a mention."""
    if kind.startswith("name_"):
        return replacement.upper() if len(mention) > 1 and mention.isupper() else replacement.capitalize()
    if kind in ("secret", "ip"):
        return replacement
    rest = iter(replacement)
    out = []
    for c in mention:
        if kind == "email" or c.isalnum():
            new = next(rest, "")
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out) + "".join(rest)


def _distinct_entities(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {(kind, entity) for t in batch.column("text").to_pylist() if t for _, _, kind, entity in mentions(t)}
            kind, entity = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(entity, pa.string())], names=["kind", "entity"])

    return texts.mapInArrow(run, "kind string, entity string").distinct()


def _draw(key: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [surrogate(key, r["kind"], r["entity"], r["attempt"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(drawn, pa.string())], names=["kind", "entity", "attempt", "replacement"])

    return run


def resolved_attempts(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, attempt) of entities whose first draw collided."""
    schema = "kind string, entity string, attempt int, replacement string"
    drawn = entities.withColumn("attempt", F.lit(0)).mapInArrow(_draw(key), schema)
    real = entities.select("kind", F.col("entity").alias("replacement"), F.lit(True).alias("real"))
    while True:
        drawn = stored(drawn, "surrogates")
        holder = drawn.groupBy("kind", "replacement").agg(F.min(F.struct("attempt", "entity")).alias("holder"))
        judged = drawn.join(holder, ["kind", "replacement"]).join(real, ["kind", "replacement"], "left").withColumn(
            "collides", F.col("real").isNotNull() | (F.col("holder.entity") != F.col("entity"))
        )
        judged = stored(judged.select("kind", "entity", "attempt", "replacement", "collides"), "surrogates")
        if not judged.filter("collides").limit(1).count():
            return judged.filter("attempt > 0").select("kind", "entity", "attempt")
        again = judged.filter("collides").select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        drawn = judged.filter("NOT collides").drop("collides").union(again.mapInArrow(_draw(key), schema))


_ENTITY = "array<struct<kind:string,start:int,end:int,replacement:string>>"


def _apply(key: bytes) -> Callable:
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, entities = [], []
            for text, again in zip(batch.column("clean_text").to_pylist(), batch.column("__again").to_pylist()):
                attempts = {(a["kind"], a["entity"]): a["attempt"] for a in again or ()}
                parts, at, found = [], 0, []
                for start, end, kind, entity in mentions(text) if text else ():
                    new = in_format(text[start:end], kind, surrogate(key, kind, entity, attempts.get((kind, entity), 0)))
                    parts += [text[at:start], new]
                    at = end
                    found.append({"kind": kind, "start": start, "end": end, "replacement": new})
                clean.append("".join([*parts, text[at:]]) if found else text)
                entities.append(found)
            names = [n for n in batch.schema.names if n not in ("clean_text", "__again")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(clean, pa.string()), pa.array(entities, kind_type)],
                names=[*names, "clean_text", "entities"],
            )

    return run


def _mentioned(texts: DataFrame) -> DataFrame:
    """(t1, t2, kind, entity): the entities of each distinct text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"t1": t1, "t2": t2, "kind": kind, "entity": entity}
                for t1, t2, t in zip(*(batch.column(c).to_pylist() for c in ("t1", "t2", "text"))) if t
                for kind, entity in {(m[2], m[3]) for m in mentions(t)}
            ]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("t1", pa.int64()), ("t2", pa.int32()), ("kind", pa.string()), ("entity", pa.string())]))

    return texts.mapInArrow(run, "t1 long, t2 int, kind string, entity string").distinct()


def replace_entities(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with clean_text and the replaced ``entities`` (places in the input text)."""
    workers_can_import(docs.sparkSession)
    docs = docs.drop("clean_text", "entities")
    entities = stored(_distinct_entities(docs.select("text")), "entities")
    again = resolved_attempts(entities, key)
    out = docs.withColumn("clean_text", F.col("text"))
    if again.limit(1).count():
        keys = [F.xxhash64("text").alias("t1"), F.hash("text", F.length("text")).alias("t2")]
        lists = (
            _mentioned(docs.select("text", *keys)).join(again, ["kind", "entity"])
            .groupBy(F.col("t1").alias("__a1"), F.col("t2").alias("__a2"))
            .agg(F.collect_list(F.struct("kind", "entity", "attempt")).alias("__again"))
        )
        out = out.withColumns({"__t1": F.xxhash64("text"), "__t2": F.hash("text", F.length("text"))}).join(
            lists, [F.col("__t1") == F.col("__a1"), F.col("__t2") == F.col("__a2")], "left"
        ).select(*out.columns, "__again")
    else:
        out = out.withColumn("__again", F.expr("cast(null as array<struct<kind:string,entity:string,attempt:int>>)"))
    return out.mapInArrow(_apply(key), f"{kinds(docs)}, clean_text string, entities {_ENTITY}")
