"""Personal data: detected entities get keyed surrogates of their own kind and form."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, blocks, cut, cut_counted, free, in_batches, keyed

#: Key of the surrogates in the registered query. Whoever holds a corpus uses a secret one.
KEY = "replace-this-key"
#: Rounds after which forms that are full are permuted as they are.
ROUNDS = 12

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}")
_NUMBER = re.compile(
    r"(?P<ip>(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d))"
    r"|(?P<card>(?:\d{4}[ -]){3}\d{4}(?!\d)|\d{13,19}(?!\d))"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4}(?!\d))"
)
_DIGITS = re.compile(r"[0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}|[0-9A-F]{32,}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_ASSIGNED = re.compile(
    r"(?:token|secret|passw(?:or)?d|api[_-]?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9_+/.=-]{8,})", re.I
)
_ASSIGNED_WORDS = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey")
#: Titles before a name, and the gender that they tell (fixed values).
_TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "господин": "m",
    "Mrs": "f", "Ms": "f", "Frau": "f", "Madame": "f", "Señora": "f", "госпожа": "f",
}
_NAME = re.compile(
    r"\b(?P<title>" + "|".join(sorted(_TITLES, key=len, reverse=True)) + r")\.? "
    r"(?P<name>[^\W\d_a-zà-ÿа-я][^\W\d_]+(?:[ -][^\W\d_a-zà-ÿа-я][^\W\d_]+)?)"
)
#: Parts of made-up names by script and gender (fixed values).
_SYLLABLES = {
    "latin": "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со та те ти то ва ве ви во".split(),
    "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο τα τε τι το πα πε πι πο".split(),
}
_ENDINGS = {"latin": {"m": "n", "f": "a"}, "cyrillic": {"m": "н", "f": "я"}, "greek": {"m": "ς", "f": "α"}}
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of every entity, left to right; of overlapping ones the first, then the longest.

    Kinds are ``email``, ``ip``, ``phone``, ``card``, ``ssn``, ``iban``, ``secret``,
    ``name m`` and ``name f``. The time grows with the length of the text.
    """
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    floor = 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        while start < at and text[start] in ".%+-":
            start += 1
        floor = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((start, m.end(), "email"))
            floor = m.end()
        at = text.find("@", floor)
    done = 0
    for run in _DIGITS.finditer(text):
        if run.start() < done:
            continue
        start = run.start()
        for before in (2, 1, 0):  # a number may begin with +, ( or both
            if (
                start >= before
                and all(c in "+(" for c in text[start - before : start])
                and not (start > before and (text[start - before - 1] in _ALNUM or text[start - before - 1] in ".-" and text[start - before - 2 : start - before - 1].isdigit()))
                and (m := _NUMBER.match(text, start - before))
                and (m.lastgroup != "ip" or all(int(x) < 256 for x in m[0].split(".")))
            ):
                found.append((m.start(), m.end(), str(m.lastgroup)))
                done = m.end()
                break
        else:
            first, last = start, run.end()
            while first > done and text[first - 1] in _ALNUM:
                first -= 1
            while last < len(text) and text[last] in _ALNUM:
                last += 1
            done = last
            if last - first >= 15:
                token = text[first:last]
                kind = "secret" if _HEX.fullmatch(token) else "iban" if _IBAN.fullmatch(token) else ""
                if kind:
                    found.append((first, last, kind))
    low = text.lower()
    if any(word in low for word in _ASSIGNED_WORDS):
        for m in _ASSIGNED.finditer(text):
            if any(c.isdigit() for c in m[1]):
                found.append((m.start(1), m.end(1), "secret"))
    if any(title in text for title in _TITLES):
        for m in _NAME.finditer(text):
            found.append((m.start("name"), m.end("name"), f"name {_TITLES[m['title']]}"))
    found.sort(key=lambda e: (e[0], -e[1]))
    out: list[tuple[int, int, str]] = []
    for entity in found:
        if not out or entity[0] >= out[-1][1]:
            out.append(entity)
    return out


def _random(key: str, *parts: object, bits: int = 64) -> int:
    sent = "\x1f".join(map(str, parts)).encode()
    size = (bits + 7) // 8
    out = b""
    while len(out) < size:
        out += hashlib.blake2b(sent + len(out).to_bytes(4), key=hashlib.sha256(key.encode()).digest(), digest_size=64).digest()
    return int.from_bytes(out[:size]) & ((1 << bits) - 1)


def permuted(x: int, size: int, key: str, *tweak: object) -> int:
    """A keyed bijection of 0 … size - 1: a Feistel network, walked until it is back in range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = x >> half, x & mask
        for r in range(6):
            a, b = b, a ^ _random(key, *tweak, size, r, b, bits=half)
        x = a << half | b
        if x < size:
            return x


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _same_form(value: str, key: str, *tweak: object, alphabets=_CLASSES) -> str:
    """Letters and digits permuted together, each within its alphabet; the rest stays."""
    sets = [next((a for a in alphabets if c in a), "") for c in value]
    number, size = 0, 1
    for c, letters in zip(value, sets, strict=True):
        if letters:
            number = number * len(letters) + letters.index(c)
            size *= len(letters)
    if size == 1:
        return value
    form = "".join(letters[0] if letters else c for c, letters in zip(value, sets, strict=True))
    number = permuted(number, size, key, form, *tweak)
    out = []
    for c, letters in zip(reversed(value), reversed(sets), strict=True):
        if letters:
            number, digit = divmod(number, len(letters))
            c = letters[digit]
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _name(value: str, gender: str, key: str, attempt: int) -> str:
    script = "cyrillic" if re.search("[а-яА-Я]", value) else "greek" if re.search("[α-ωΑ-Ω]", value) else "latin"
    out = []
    for i, part in enumerate(re.split("([ -])", value)):
        if part in (" ", "-"):
            out.append(part)
            continue
        number = _random(key, "name", gender, value if attempt else "", part, i and 1, attempt)
        letters = _SYLLABLES[script]
        made = ""
        for _ in range(3 + (i > 0) + attempt):
            number, k = divmod(number, len(letters))
            made += letters[k]
        made += _ENDINGS[script][gender] if i == 0 else ""
        out.append(made.upper() if part.isupper() and len(part) > 1 else made.capitalize())
    return "".join(out)


def canonical(kind: str, value: str) -> str:
    """The spelling that stands for an entity: a mail domain is the same in capitals."""
    if kind != "email":
        return value
    local, _, domain = value.rpartition("@")
    return f"{local}@{domain.lower()}"


#: Kinds whose surrogates have the form of the value and no room beyond it.
_FIXED = ("ip", "phone", "card", "ssn", "iban")


def room_of(kind: str, value: str) -> str:
    """What a value shares with all others among which its surrogates are permuted."""
    if kind == "ip":
        parts = [int(x) for x in value.split(".")]
        fixed = 1 if parts[0] in (10, 127) else 2 if parts[:2] == [192, 168] or parts[0] == 172 and 16 <= parts[1] < 32 else 0
        return ".".join(map(str, parts[:fixed]))
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", value)))


def surrogate(kind: str, value: str, key: str, attempt: int = 0) -> str:
    """A replacement of the same kind and form; one value always gets the same.

    Digits and letters keep their classes and places; a card number stays valid
    or invalid by its check digit; a private address stays in its range; a mail
    domain has one surrogate whoever's it is; a name keeps script and gender.
    Except for names, different values have different surrogates per attempt.
    Names and the local parts of mail addresses grow with the attempt, so that
    there is always room for one more.
    """
    if kind.startswith("name "):
        return _name(value, kind[5:], key, attempt)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        number, more = _random(key, "more", value, attempt), ""
        for _ in range(attempt):
            number, k = divmod(number, 26)
            more += _CLASSES[1][k]
        return f"{_same_form(local, key, kind, attempt)}{more}@{_same_form(host.lower(), key, 'domain')}.{top.lower()}"
    if kind == "ip":
        parts = [int(x) for x in value.split(".")]
        number = int.from_bytes(bytes(parts))
        fixed = 1 if parts[0] in (10, 127) else 2 if parts[:2] == [192, 168] or parts[0] == 172 and 16 <= parts[1] < 32 else 0
        bits = 32 - 8 * fixed
        head, number = number >> bits << bits, number & ((1 << bits) - 1)
        while True:
            number = permuted(number, 1 << bits, key, kind, head, attempt)
            new = (head | number).to_bytes(4)
            private = new[0] in (0, 10, 127) or new[0] > 223 or new[:2] == b"\xc0\xa8" or new[0] == 172 and 16 <= new[1] < 32
            if fixed or not private or parts[0] == 0 or parts[0] > 223:
                return ".".join(map(str, new))
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        new = _same_form(digits[:-1], key, kind, attempt)
        new += str((_luhn(new) + int(digits[-1]) - _luhn(digits[:-1])) % 10)
        places = iter(new)
        return re.sub(r"\d", lambda m: next(places), value)
    if kind == "phone":
        m = re.match(r"\+\d{1,3}(?=[ .(-])", value)
        head = m[0] if m else ""
        return head + _same_form(value[len(head) :], key, kind, head, attempt)
    if kind == "secret" and _HEX.fullmatch(value):
        letters = ("0123456789abcdef" if value == value.lower() else "0123456789ABCDEF",)
        return _same_form(value, key, kind, attempt, alphabets=letters)
    if kind == "iban":
        return value[:2] + _same_form(value[2:], key, kind, attempt)
    return _same_form(value, key, kind, attempt)


_MENTIONS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("kind", pa.string()), ("value", pa.string())])


def mentions(docs: DataFrame) -> DataFrame:
    """Entities of every text, each once a document: ``doc_id``, ``key``, ``kind``, ``value``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for block in blocks(batch):
                for doc_id, key, raw in zip(*(block.column(x).to_pylist() for x in ("doc_id", "key", "text")), strict=True):
                    text = (raw or b"").decode("utf-8", "replace")
                    for kind, value in sorted({(kind, canonical(kind, text[a:b])) for a, b, kind in find_entities(text)}):
                        yield doc_id, key, kind, value

    return (
        keyed(docs)
        .withColumn("text", F.col("text").cast("binary"))
        .mapInArrow(lambda batches: in_batches(rows(batches), _MENTIONS), "doc_id long, key long, kind string, value string")
    )


def _with_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind``, ``value``, ``attempt`` with ``surrogate``."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("attempt", pa.int32()), ("surrogate", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(x).to_pylist() for x in ("kind", "value", "attempt")), strict=True)
            new = [surrogate(kind, value, key, attempt) for kind, value, attempt in rows]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("kind", "value", "attempt")), pa.array(new, pa.string())], schema=schema
            )

    return entities.select("kind", "value", "attempt").mapInArrow(work, "kind string, value string, attempt int, surrogate string")


def _rooms(entities: DataFrame) -> DataFrame:
    """``kind``, ``value`` with the ``room`` of the value."""
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("room", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rooms = [room_of(*row) for row in zip(*(batch.column(x).to_pylist() for x in ("kind", "value")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("kind", "value")), pa.array(rooms, pa.string())], schema=schema)

    return entities.select("kind", "value").mapInArrow(work, "kind string, value string, room string")


def settle_collisions(entities: DataFrame, key: str) -> DataFrame:
    """An attempt for every entity (``kind``, ``value``) such that surrogates differ.

    A surrogate may be neither a real value of its kind nor that of another
    entity; of those that share one the smallest value keeps it and the others
    try again, until none collides.

    Where a corpus holds so many values of one form that there is hardly room
    beside them (all addresses of a private network, say), that may never be.
    After ``ROUNDS`` the values of such a form are permuted among themselves by
    the first attempt: different ones stay different, but a surrogate may be the
    real value of another. Names and mail addresses always find room; should
    they not, it is an error that tells how many are left.
    """
    named = cut(
        _with_surrogates(entities.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), key), "pii-entities"
    )
    group = F.substring_index("kind", " ", 1)  # a name stands for one person, whichever the title
    done = None
    for round_ in count():
        real = named.select(group.alias("g"), F.col("value").alias("s")).distinct().withColumn("real", F.lit(True))
        least = named.groupBy(group.alias("g"), F.col("surrogate").alias("s")).agg(F.min("value").alias("least"), F.max("value").alias("most"))
        judged = (
            named.withColumn("g", group)
            .withColumn("s", F.col("surrogate"))
            .join(least.where("least <> most").select("g", "s", "least"), ["g", "s"], "left")
            .join(real, ["g", "s"], "left")
        )
        again = F.coalesce("real", F.lit(False)) | F.coalesce(F.col("least") != F.col("value"), F.lit(False))
        judged = cut(judged.select("kind", "value", "attempt", "surrogate", again.alias("again")), "pii-judged")
        if judged.where("again").isEmpty():
            return named if done is None else named.unionAll(done)
        if round_ >= ROUNDS and done is None:
            rooms = _rooms(judged.where(F.col("kind").isin(*_FIXED) & F.col("again"))).select("kind", "room").distinct()
            placed = _rooms(judged.where(F.col("kind").isin(*_FIXED))).join(rooms, ["kind", "room"], "left_semi")
            placed = cut(placed.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), "pii-full")
            done = cut(_with_surrogates(placed, key), "pii-entities")
            named = cut(named.join(placed, ["kind", "value"], "left_anti").select("kind", "value", "attempt", "surrogate"), "pii-entities")
            continue
        if round_ >= 4 * ROUNDS:
            raise RuntimeError(f"{judged.where('again').count()} entities found no surrogate of their own")
        changed = _with_surrogates(judged.where("again").withColumn("attempt", F.col("attempt") + 1), key)
        named = cut(judged.where("not again").select("kind", "value", "attempt", "surrogate").unionAll(changed), "pii-entities")


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities`` (a column of that name is replaced).

    All columns stay, in their order, and ``n_entities`` comes last. One entity
    has the same surrogate in all documents and different ones have different
    surrogates. Texts without entities are unchanged, null stays null (0
    entities), repeated rows are alike, an empty table gives an empty one.

    Surrogates are a keyed function of the entity, computed where the text is;
    only those that had to try again after a collision, few if any, are joined
    to the documents that mention them.
    """
    found = mentions(docs)
    settled = settle_collisions(found.select("kind", "value"), key)
    odd, n_odd = cut_counted(settled.where("attempt > 0"), "pii-odd")
    names = [name for name in docs.columns if name.lower() != "n_entities"]
    schema = docs.select(*names).schema
    rows = docs.select(*names)
    raw, own, odd_id, odd_key, odd_ones_of = free(names, "raw_text", "own_key", "odd_id", "odd_key", "odd_entities")
    extra: list[str] = []
    if n_odd:
        small = F.broadcast(odd) if n_odd <= BROADCAST_ROWS // 10 else odd
        of_doc = (
            found.join(small, ["kind", "value"])
            .groupBy(F.col("doc_id").alias(odd_id), F.col("key").alias(odd_key))
            .agg(F.collect_set(F.struct("kind", "value", "surrogate")).alias(odd_ones_of))
        )
        of_doc, n = cut_counted(of_doc, "pii-odd-docs")
        of_doc = F.broadcast(of_doc) if n <= BROADCAST_ROWS // 10 else of_doc
        same = (F.col(own) == F.col(odd_key)) & F.col("doc_id").cast("long").eqNullSafe(F.col(odd_id))
        rows = rows.withColumn(own, F.xxhash64("doc_id", "text")).join(of_doc, same, "left")
        rows = rows.select(*names, odd_ones_of)
        extra = [odd_ones_of]
    out = schema.add("n_entities", "long")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str] = {}
        for batch in batches:
            for block in blocks(batch, raw):
                odd_of = block.column(odd_ones_of).to_pylist() if extra else [None] * block.num_rows
                texts, counts = [], []
                for given, odd_ones in zip(block.column(raw).to_pylist(), odd_of, strict=True):
                    text = None if given is None else given.decode("utf-8", "replace")
                    entities = find_entities(text) if text else []
                    other = {(x["kind"], x["value"]): x["surrogate"] for x in odd_ones or ()}
                    parts, at = [], 0
                    for a, b, kind in entities:
                        name = kind, canonical(kind, text[a:b])
                        new = other.get(name) or known.get(name) or surrogate(*name, key)
                        if len(known) > 50_000:
                            known.clear()  # only saves work
                        if name not in other:
                            known[name] = new
                        parts += [text[at:a], new]
                        at = b
                    texts.append("".join([*parts, text[at:]]) if entities else text)
                    counts.append(len(entities))
                columns = [
                    pa.array(texts, pa.string()) if name == "text" else block.column(name) for name in names
                ]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*names, "n_entities"])

    return rows.withColumn(raw, F.col("text").cast("binary")).drop("text").withColumn("text", F.lit(None).cast("string")).mapInArrow(work, out)
