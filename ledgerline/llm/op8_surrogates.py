"""Surrogates for personal data: keyed, of the same type and format, distinct for distinct entities, the same wherever one occurs.

An entity is rewritten by a keyed permutation of the strings of its format (a Feistel network over a mixed radix, walked in
its cycle), so two entities of a format never get one surrogate. What a permutation cannot rule out is looked up in the
table of all distinct entities: surrogates that are entities of the corpus, of whatever type, or another entity's surrogate.
Those entities get further rounds, each with another permutation of the same format, until none is left. Only where every
one of many rounds has met an entity, so that the format must be all but full, it is widened by a character a round.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._common import BROADCAST_BYTES, in_batches, small_or_shuffled, stored

#: The last round without a widened format. Formats of fixed length are long; only a corpus with most of their strings gets beyond.
LAST_NARROW, LAST_NARROW_FIXED = 4, 40
FIXED_LENGTH = {"card", "ip", "phone", "ssn"}
# Given names by gender and script, and titles by gender.
NAMES = {
    ("f", "latin"): "Alice Anna Carla Clara Diana Elena Emma Eva Helen Ines Irene Julia Laura Lucia Maria Marta Nina Nora Olga Paula Rosa Sara Sofia Vera".split(),
    ("m", "latin"): "Adam Alan Anton Bruno Carl Daniel David Emil Erik Felix Hugo Ivan Jacob John Leo Lucas Marco Martin Oscar Paul Peter Simon Thomas Victor".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Григорий Денис Иван Максим Олег Павел Роман".split(),
}
TITLES = {"m": "Mr Herr Monsieur Señor Sr", "f": "Mrs Ms Miss Frau Madame Mme Señora Sra"}
_GENDER = {t: g for g, ts in TITLES.items() for t in ts.split()}
_GIVEN = {n: k for k, ns in NAMES.items() for n in ns}
_NAME = r"[^\W\d_a-zß-öø-ÿа-я][^\W\d_]+"

PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}\b",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\b(?:gh[pousr]_|sk-|xox[abprs]-)[A-Za-z0-9-]{16,}|(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b[\"']?\s{0,2}[=:]\s{0,2}[\"']?)(?P<secret_value>[^\s\"']{6,})",
    "card": r"(?<![\w.-])(?:\d[ -]?){12,18}\d(?![\w-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}(?!\.?\w)",
    "phone": r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w.+-])(?:\+\d{8,15}|[2-9]\d{9})(?![\w-])",
    "given": rf"\b(?:{'|'.join(_GIVEN)}) {_NAME}(?:[ -]{_NAME})?",
    "person": rf"\b(?:{'|'.join(_GENDER)})\b\.? (?P<person_value>{_NAME}(?:[ -]{_NAME}){{0,2}})",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "secret": "AKIA|gh[pousr]_|sk-|xox|(?i:passw|pwd|token|secret|api)", "card": r"\d", "iban": r"[A-Z]\d\d", "ssn": r"\d-\d", "ip": r"\d\.\d", "phone": r"\d", "person": "|".join(_GENDER)}
_COMPILED = {k: (re.compile(NEEDS.get(k, "")), re.compile(p)) for k, p in PATTERNS.items()}


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Spans (start, end, type, canonical form) that do not overlap, in order; an earlier pattern wins."""
    found: list[tuple[int, int, str, str]] = []
    digits = bool(re.search(r"\d", text))
    for kind, (needs, pattern) in _COMPILED.items():
        if (kind in ("card", "ssn", "ip", "phone") and not digits) or not needs.search(text):
            continue
        if kind == "given" and not any(name in text for name in _GIVEN):
            continue
        for m in pattern.finditer(text):
            part = f"{kind}_value"
            a, b = m.span(part) if part in pattern.groupindex and m[part] is not None else m.span()
            value = text[a:b]
            if kind == "person":
                title = re.match(r"\w+", m[0])[0]
                found.append((a, b, f"person {_GENDER[title]}", value))
            elif kind == "given":
                found.append((a, b, f"person {_GIVEN[re.match(r'[^ ]+', value)[0]][0]}", value))
            else:
                found.append((a, b, kind, value.lower() if kind == "email" else value))
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int, str, str]] = []
    for x in found:
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def permuted(index: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size): a Feistel network over the next even number of bits, walked until inside."""
    if size <= 1:
        return index
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = index >> half, index & mask
        for i in range(6):
            digest = hmac.digest(key, f"{tweak}|{i}|{right}".encode(), hashlib.sha256)
            while 8 * len(digest) < half:
                digest += hashlib.sha256(digest).digest()
            left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
        index = left << half | right
        if index < size:
            return index


@lru_cache(maxsize=512)
def alphabet(c: str) -> str:
    """The characters that may stand for c: of its script, case and kind; c alone if it must stay."""
    for a, b in ("09", "az", "AZ", "ая", "АЯ", "αω", "ΑΩ", "àö", "øÿ", "ÀÖ", "ØÞ", "一龥", "ぁん", "ァン", "가힣", "اي", "את"):
        if a <= c <= b:
            return "".join(x for x in map(chr, range(ord(a), ord(b) + 1)) if x.isalnum() and (not c.islower() or x.islower()) and (not c.isupper() or x.isupper()))
    if not c.isalpha():
        return c
    start = ord(c) & ~0x3F  # of other scripts, the letters around it
    return "".join(x for x in map(chr, range(start, start + 64)) if x.isalpha() and x.islower() == c.islower() and x.isupper() == c.isupper())


def rewritten(value: str, choices: list[str], key: bytes, tweak: str) -> str:
    """value with each character replaced within its choices, by one permutation of all such strings."""
    index, size = 0, 1
    for c, choice in zip(value, choices, strict=True):
        index, size = index * len(choice) + choice.index(c), size * len(choice)
    index, out = permuted(index, size, key, tweak), []
    for choice in reversed(choices):
        index, at = divmod(index, len(choice))
        out.append(choice[at])
    return "".join(reversed(out))


def _luhn(digits: list[int]) -> int:
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10


def widened(kind: str, value: str, more: int) -> str:
    """value with `more` characters more, of the kind of its last ones; check sums stay, e-mail addresses grow before the @."""
    if more <= 0:
        return value
    if kind == "email":
        at = value.index("@")
        return value[:at] + "a" * more + value[at:]
    if kind == "ip":
        return value + ".1" * more
    if kind == "card":
        longer = value + "0" * (more - 1)
        digits = [int(c) for c in longer if c.isdigit()]
        want = _luhn([int(c) for c in value if c.isdigit()])
        return longer + str((want - _luhn([*digits, 0])) % 10)
    last = value[-1]
    return value + (last.lower() if last.isalnum() else "a") * more


def surrogate(kind: str, value: str, key: bytes, round_: int = 0) -> str:
    """The surrogate of a canonical value; for a format and round, different values have different ones."""
    value = widened(kind, value, round_ - (LAST_NARROW_FIXED if kind in FIXED_LENGTH else LAST_NARROW))
    shape = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in value)
    tweak = f"{kind}|{shape}|{round_}"
    if kind == "card":
        digits = [int(c) for c in value if c.isdigit()]
        # all but the first and the last change; the last keeps the check sum what it was
        free = rewritten("".join(map(str, digits[1:-1])), ["0123456789"] * (len(digits) - 2), key, f"{tweak}|{digits[0]}|{_luhn(digits)}")
        body = [digits[0], *map(int, free)]
        new = iter([*body, (_luhn(digits) - _luhn([*body, 0])) % 10])
        return "".join(str(next(new)) if c.isdigit() else c for c in value)
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        first = range(1, 224) if 0 < octets[0] < 224 else [0, *range(224, 256)]
        choices = ["".join(map(chr, r)) for r in (first, *[range(256)] * (len(octets) - 1))]
        return ".".join(str(ord(c)) for c in rewritten("".join(map(chr, octets)), choices, key, f"ip|{first}|{len(octets)}|{round_}"))
    if kind.startswith("person"):
        gender, words = kind[-1], re.split(r"([ -])", value)
        return "".join(_name(w, gender if i == 0 and len(words) > 1 else "", key, round_) for i, w in enumerate(words))
    if kind == "phone" or kind == "ssn":
        start = [i == 0 or not value[i - 1].isdigit() for i in range(len(value))]
        country = re.match(r"\+\d{1,3}(?=\D)", value)
        fixed = country.end() if country else 0
        choices = [c if i < fixed or not c.isdigit() else ("23456789" if c > "1" else "01") if start[i] else "0123456789" for i, c in enumerate(value)]
        low = "".join(str(int(c > "1")) for i, c in enumerate(value) if c.isdigit() and start[i])
        return rewritten(value, choices, key, f"{tweak}|{value[:fixed]}|{low}")
    if kind == "email":
        top = value.rindex(".")
        choices = [alphabet(c) if i < top else c for i, c in enumerate(value)]
        return rewritten(value, choices, key, f"{tweak}|{value[top:]}")
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", value):
        return rewritten(value, ["0123456789abcdef"] * len(value), key, f"hex|{len(value)}|{round_}")
    fixed = 4 if value.startswith(("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_")) or kind == "iban" else 0
    return rewritten(value, [alphabet(c) if i >= fixed else c for i, c in enumerate(value)], key, f"{tweak}|{value[:fixed]}")


def _name(word: str, gender: str, key: bytes, round_: int) -> str:
    """A given name stays a given name of its gender and script if it is a known one; other words are rewritten letter by letter."""
    if gender and (group := _GIVEN.get(word)):
        names = NAMES[group]
        return names[permuted(names.index(word), len(names), key, f"given|{group}|{round_}")]
    new = rewritten(word, [alphabet(c) for c in word], key, f"name|{len(word)}|{[len(alphabet(c)) for c in word]}|{round_}")
    while gender and new in _GIVEN:  # known given names are permuted among themselves: walk on in the cycle
        new = rewritten(new, [alphabet(c) for c in new], key, f"name|{len(word)}|{[len(alphabet(c)) for c in word]}|{round_}")
    return new


def _like(text: str, original: str, canonical: str, replacement: str) -> str:
    """replacement with the capitals of the original spelling, where the canonical form has dropped them."""
    if original == canonical or len(original) != len(replacement):
        return replacement
    return "".join(r.upper() if o.isupper() else r for o, r in zip(original, replacement, strict=True))


def found_entities(docs: DataFrame) -> DataFrame:
    """Distinct (kind, value) of all whole texts."""

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            seen = {(k, v) for t in batch.column("text").to_pylist() if t for _, _, k, v in entities(t)}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in seen], pa.string()) for i in (0, 1)], ["kind", "value"])

    return docs.select("text").mapInArrow(scan, "kind string, value string").distinct()


def rounds(known: DataFrame, key: bytes) -> DataFrame:
    """Rows (kind, value, round) of the entities whose surrogate in earlier rounds is an entity of the corpus or another's surrogate."""

    def at(round_: int):
        def work(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                kinds, values = batch.column("kind").to_pylist(), batch.column("value").to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("value"), pa.array([surrogate(k, v, key, round_) for k, v in zip(kinds, values, strict=True)], pa.string())], ["kind", "value", "new"])

        return work

    schema = "kind string, value string, new string"
    values = known.select(F.col("value").alias("new")).distinct()
    todo, done, settled, r = known, None, None, 0
    while True:
        new = stored(todo.mapInArrow(at(r), schema), f"surrogates-{r}")
        bad = new.join(values, "new", "left_semi").select("kind", "value")
        # of several entities with one surrogate the first keeps it; a name that men and women share is one
        twice = new.groupBy("new").agg(F.min("value").alias("first"), F.max("value").alias("last")).where("first <> last")
        bad = bad.union(new.join(twice, "new").where("value <> first").select("kind", "value"))
        if settled is not None:
            bad = bad.union(new.join(settled, "new", "left_semi").select("kind", "value"))
        bad = stored(bad.distinct(), f"collisions-{r}")
        good = new.join(bad, ["kind", "value"], "left_anti")
        settled = good.select("new") if settled is None else settled.union(good.select("new"))
        if r:
            own = good.select("kind", "value", F.lit(r).alias("round"))
            done = own if done is None else done.union(own)
        if not bad.limit(1).count():
            return done if done is not None else known.limit(0).select("kind", "value", F.lit(0).alias("round"))
        todo, r = bad, r + 1


def pseudonymised(docs: DataFrame, key: bytes = b"surrogates") -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, text with surrogates, n_entities, kinds (sorted types), spans (start, length, kind in the new text).

    Defined results: null texts stay null with 0 entities; no surrogate is an entity of the corpus, and no two entities share
    one; a format that is all but full of entities gets longer surrogates; an entity has one surrogate wherever it occurs, e-mail
    addresses regardless of case; surrogates have the format, script and check sum of the original and, for known given
    names after a title, its gender; repeated rows are rewritten alike; an empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    in_batches(docs.sparkSession)
    known = stored(found_entities(rows), "entities")
    again = stored(rounds(known, key), "rounds")

    def owners(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            own = [(i, k, v) for i, t in zip(batch.column("th").to_pylist(), batch.column("text").to_pylist(), strict=True) if t for k, v in {x[2:] for x in entities(t)}]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in own], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))], ["th", "kind", "value"])

    def rewrite(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out: list[tuple] = []
            for text, other in zip(batch.column("text").to_pylist(), batch.column("other").to_pylist(), strict=True):
                if text is None:
                    out.append((None, 0, [], []))
                    continue
                later = {(x["kind"], x["value"]): x["round"] for x in other or ()}
                parts, spans, at, size = [], [], 0, 0
                for a, b, kind, value in entities(text):
                    new = _like(text, text[a:b], value, surrogate(kind, value, key, later.get((kind, value), 0)))
                    parts += [text[at:a], new]
                    size += a - at
                    spans.append({"start": size, "length": len(new), "kind": kind})
                    size += len(new)
                    at = b
                out.append(("".join([*parts, text[at:]]), len(spans), sorted({s["kind"] for s in spans}), spans))
            kinds = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("kind", pa.string())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[i] for x in out], k) for i, k in enumerate(kinds))], ["doc_id", "text", "n_entities", "kinds", "spans"])

    hashed = rows.withColumn("th", F.xxhash64("text"))
    if again.limit(1).count():
        later = hashed.select("th", "text").mapInArrow(owners, "th long, kind string, value string").join(small_or_shuffled(again, 200), ["kind", "value"])
        later = later.groupBy("th").agg(F.collect_set(F.struct("kind", "value", "round")).alias("other"))
        later = stored(later, "later")
        few = (later.agg(F.sum(F.size("other"))).first()[0] or 0) * 200 <= BROADCAST_BYTES
        hashed = hashed.join(F.broadcast(later) if few else later, "th", "left")
    else:
        hashed = hashed.withColumn("other", F.lit(None).cast("array<struct<kind: string, value: string, round: int>>"))
    return hashed.select("doc_id", "text", "other").mapInArrow(rewrite, "doc_id long, text string, n_entities int, kinds array<string>, spans array<struct<start: bigint, length: bigint, kind: string>>")
