"""Personal data and secrets replaced by surrogates.

Every detected entity gets a keyed replacement of its own kind and format: the
digits of a phone number become other digits in the same punctuation, a card
keeps its first digit and its checksum's validity, a name keeps its script, case
and gender. Entities are named by a canonical form (a phone number's digits, a
name's lower case), from which the surrogate follows, so an entity is replaced
alike in all documents.

A name is found after a title. Wherever else in that text one of its words stands as a
name is written, the same surrogate takes its place.

Formats with a fixed alphabet are permuted (a keyed Feistel network over all
values of the format), so different entities cannot meet. Names are drawn. For
all kinds the surrogates of the whole corpus are then checked: where two entities
share one, all but the smallest are drawn anew, and so is a surrogate that is
itself an entity of the corpus or equal to what it replaces, until none is left.
After ``STRICT`` rounds a format may be full, so what is drawn then gets longer from round
to round: four more digits, or a syllable of a name. So the rounds end, whatever
the corpus holds. Only entities are shuffled for that, each once; texts never are. The few
that were drawn anew reach the tasks in blocks of at most ``REDRAWN_BLOCK``, one pass
for each, and its result is stored before the next.

The permutations can be undone by who knows the key. It comes from the caller, else from
the session's setting ``spark.visitlog.surrogates.secret``; without either it is random,
for this call only and kept nowhere, and surrogates differ from call to call.

Defined cases: NULL text stays NULL and empty text empty, both without entities; a
password of signs only (``______``) is a blank field and no entity; repeated rows are
replaced alike; an empty table gives no rows; all other columns pass through unchanged.
"""

import hashlib
import re
import secrets
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlog.llm.frames import bounded_batches, free_name
from visitlog.session import stage

KEY_SETTING = "spark.visitlog.surrogates.secret"
REDRAWN_BLOCK = 200_000
# Rounds in which a surrogate keeps its format to the letter.
STRICT = 8
DIGITS, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Titles and the gender they tell.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Господин": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
    "Госпожа": "f", "Κυρία": "f", "Dr": "n", "Prof": "n",
}
# Syllables and endings of drawn names, by script and gender.
SYLLABLES = {
    "latin": "ba be bi do du fa fe ga go ha ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta te to va ve vi".split(),
    "cyrillic": "ба бе би до ду фа ге га го ка ке ла ле ли ло ма ме ми на не но па ра ре ри ро са се та те то ва ве ви".split(),
    "greek": "βα βε βι δο δα φα γα γο κα κε λα λε λι λο μα με μι να νε νο πα ρα ρε ρι ρο σα σε τα τε το".split(),
}
ENDINGS = {
    "latin": {"m": "n", "f": "a", "n": "l", "surname": "r"},
    "cyrillic": {"m": "н", "f": "я", "n": "ль", "surname": "в"},
    "greek": {"m": "ς", "f": "η", "n": "λ", "surname": "ρ"},
}

def _letters(wanted):
    """Latin, Greek and Cyrillic letters of one case, as the inside of a character class."""
    return "".join(chr(c) for c in (*range(0x41, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000)) if wanted(chr(c)))


_CAP, _SMALL = _letters(str.isupper), _letters(str.islower)
# Smith, O'Brien, McDonald, Meyer-Landrut, SMITH.
_NAME = (
    rf"(?:[{_CAP}](?=['’-]?[{_CAP}]?[{_SMALL}])[{_SMALL}]*(?:['’-][{_CAP}]?[{_SMALL}]+|[{_CAP}][{_SMALL}]+)*"
    rf"|[{_CAP}](?:['’-]?[{_CAP}])+(?![{_CAP}{_SMALL}]))"
)
NAME = re.compile(rf"(?<!\w){_NAME}(?!\w)")
ENTITY = re.compile(
    "|".join([
        r"(?P<email>(?<![\w.%+-])[A-Za-z0-9][\w.%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})",
        r"(?P<access>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))",
        r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
        r"(?P<secret>(?i:(?<![a-z])(?:password|passwd|pwd|token|secret|api[_-]?key))[ \t]*[=:][ \t]*[\"']?"
        r"(?P<value>(?=[_+/.-]*[A-Za-z0-9])[A-Za-z0-9_+/.-]{6,}))",
        r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
        r"(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d))",
        r"(?P<card>(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?!\d))",
        r"(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<!\w)\+\d{8,15}(?!\d))",
        rf"(?P<person>\b(?P<title>{'|'.join(TITLES)})\b\.?[ ]+(?P<first>{_NAME})(?:[ ]+(?P<last>{_NAME}))?)",
    ])
)
# A text without any of these holds no entity.
HINT = re.compile(rf"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|token|secret|api[_-]?key)|\b(?:{'|'.join(TITLES)})\b")


def _random(key, *parts):
    data = "\x1f".join(map(str, parts)).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=16).digest(), "big")


def permute(n, size, key, tweak):
    """Where a keyed permutation of ``range(size)`` takes ``n``: a Feistel network over
    the next even number of bits, walked until it falls inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = n >> half, n & mask
        for turn in range(6):
            left, right = right, left ^ (_random(key, tweak, turn, right) & mask)
        n = left << half | right
        if n < size:
            return n


def permute_text(text, key, tweak, alphabet=None):
    """Another text of the same format: each digit, small and capital letter by one of
    its kind (or each letter of ``alphabet`` by one of it), the rest as it is."""
    alphabets = [
        alphabet if alphabet else next((a for a in (DIGITS, LOWERS, UPPERS) if c in a), None) for c in text
    ]
    alphabets = [a if a and c in a else None for a, c in zip(alphabets, text)]
    form = "".join(c if a is None else str(len(a)) + "," for a, c in zip(alphabets, text))
    n, size = 0, 1
    for a, c in zip(alphabets, text):
        if a:
            n, size = n * len(a) + a.index(c), size * len(a)
    if size == 1:
        return text
    n, out = permute(n, size, key, f"{tweak}|{form}"), []
    for a, c in zip(reversed(alphabets), reversed(text)):
        if a:
            n, at = divmod(n, len(a))
            c = a[at]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits):
    """Checksum of card digits; 0 for a valid card."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_rest(text):
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script_of(word):
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "greek" if "Ͱ" <= word[0] <= "Ͽ" else "latin"


def surrogate(kind, canonical, attempt, key):
    """The canonical form of an entity's replacement."""
    tweak, longer = f"{kind}|{attempt}", max(0, attempt + 1 - STRICT)
    if longer and not kind.startswith(("given", "surname")):
        more = "".join(DIGITS[_random(key, tweak, canonical, i) % 10] for i in range(4 * longer))
        new = surrogate(kind, canonical, 0, key)
        return more + new if kind == "email" else new + more
    if kind == "email":
        local, _, domain = canonical.partition("@")
        host, _, top = domain.rpartition(".")
        # A reserved last label, so that the address can be nobody's.
        host = ".".join(permute_text(label, key, tweak + "host") for label in host.split("."))
        return f"{permute_text(local, key, tweak)}@{host}.{top}.example"
    if kind == "access":
        return canonical[:4] + permute_text(canonical[4:], key, tweak, DIGITS + UPPERS)
    if kind == "ip":
        n = int.from_bytes(bytes(map(int, canonical.split("."))), "big")
        while True:
            n = permute(n, 1 << 32, key, tweak)
            parts = n.to_bytes(4, "big")
            if 1 <= parts[0] <= 223 and parts[0] != 127:
                return ".".join(map(str, parts))
    if kind == "card":
        body = canonical[0] + permute_text(canonical[1:-1], key, tweak)
        check = next(c for c in DIGITS if luhn(body + c) == luhn(canonical))
        return body + check
    if kind == "iban":
        body = canonical[:2] + "00" + permute_text(canonical[4:], key, tweak)
        if _iban_rest(canonical) == 1:
            return body[:2] + f"{98 - _iban_rest(body):02d}" + body[4:]
        return canonical[:2] + permute_text(canonical[2:], key, tweak)
    if kind == "secret":
        hexadecimal = re.fullmatch(r"(?=.*\d)[0-9a-f]{8,}", canonical)
        return permute_text(canonical, key, tweak, "0123456789abcdef" if hexadecimal else None)
    if kind.startswith(("given", "surname")):
        script = script_of(canonical)
        syllables, n = SYLLABLES[script], _random(key, tweak, canonical)
        # As many syllables as the name is long, within limits.
        name = ""
        for _ in range(min(6, max(3, len(canonical) // 2)) + longer):
            n, at = divmod(n, len(syllables))
            name += syllables[at]
        return name + ENDINGS[script]["surname" if kind == "surname" else kind[-1]]
    return permute_text(canonical, key, tweak)


def _titled(m):
    """``(start, end, kind, canonical)`` of the words of a name after its title."""
    if m["last"]:
        yield m.start("first"), m.end("first"), "given_" + TITLES[m["title"]], m["first"].lower()
    last = "last" if m["last"] else "first"
    yield m.start(last), m.end(last), "surname", m[last].lower()


def detect(text):
    """``(start, end, kind, canonical)`` of the entities of a text, from left to right."""
    if not text or not HINT.search(text):
        return []
    out, names = [], {}
    for m in ENTITY.finditer(text):
        found = m.group()
        if m["title"]:
            for entity in _titled(m):
                out.append(entity)
                # A word that is a surname somewhere is one everywhere in the text.
                if entity[2] == "surname":
                    names[entity[3]] = entity[2]
                names.setdefault(entity[3], entity[2])
        elif m["secret"]:
            out.append((m.start("value"), m.end("value"), "secret", m["value"]))
        else:
            kind = m.lastgroup
            if kind == "email":
                canonical = found.lower()
            elif kind == "phone":
                canonical = re.sub(r"\D", "", found)[-10:]
            else:
                canonical = re.sub(r"[ -]", "", found) if kind in ("card", "iban") else found
            out.append((m.start(), m.end(), kind, canonical))
    if names:
        out = [(*e[:2], names.get(e[3], e[2]), e[3]) if e[2].startswith("given") else e for e in out]
        out = sorted(out + list(_untitled(text, names, out)))
    return out


def _untitled(text, names, found):
    """Further places of the names, outside of all that was found."""
    taken = iter([*found, (len(text) + 1, len(text) + 1)])
    start, end = next(taken)[:2]
    for m in NAME.finditer(text):
        while end <= m.start():
            start, end = next(taken)[:2]
        kind = names.get(m.group().lower())
        if kind and m.end() <= start:
            yield m.start(), m.end(), kind, m.group().lower()


def formatted(found, kind, new):
    """A canonical surrogate in the format of the text it replaces."""
    if kind in ("phone", "card", "iban"):
        skip = sum(c.isalnum() for c in found) - len(new)
        letters, out = iter(new), []
        for c in found:
            if not c.isalnum():
                out.append(c)
            elif skip > 0:
                skip -= 1
                out.append(c)
            else:
                out.append(next(letters))
        return "".join(out + list(letters))
    if kind.startswith(("given", "surname")):
        return new.upper() if found.isupper() and len(found) > 1 else new[0].upper() + new[1:]
    return new


def replace(text, key, attempts=None):
    """``(text with surrogates, kinds of the entities)``."""
    out, done, kinds, attempts = [], 0, [], attempts or {}
    for start, end, kind, canonical in detect(text):
        new = surrogate(kind, canonical, attempts.get(f"{kind}|{canonical}", 0), key)
        out += [text[done:start], formatted(text[start:end], kind, new)]
        done = end
        kinds.append(kind)
    return (text if not kinds else "".join(out) + text[done:]), kinds


def _drawn(entities, key):
    """``kind, canonical, attempt`` with the surrogate of each; narrow."""

    def task(batches):
        for batch in batches:
            rows = zip(*[batch.column(n).to_pylist() for n in ("kind", "canonical", "attempt")])
            new = pa.array([surrogate(*row, key) for row in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, new], [*batch.schema.names, "surrogate"])

    return entities.select("kind", "canonical", "attempt").mapInArrow(
        task, "kind string, canonical string, attempt int, surrogate string"
    )


def _entities(batches):
    for batch in batches:
        found = Counter((kind, canonical) for t in batch.column(0).to_pylist() for _, _, kind, canonical in detect(t))
        kinds, canonicals = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(canonicals, pa.string())], ["kind", "canonical"]
        )


def key_of(spark, key=None):
    """The caller's key, else the session's, else a random one."""
    key = key or spark.conf.get(KEY_SETTING, None) or secrets.token_bytes(32)
    key = key.encode() if isinstance(key, str) else key
    return key if len(key) <= 64 else hashlib.blake2b(key).digest()


def assign_surrogates(docs, key, text_col="text"):
    """``kind, canonical, attempt, surrogate`` of every entity of the corpus, without collisions."""
    bounded_batches(docs)
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    entities = texts.mapInArrow(_entities, "kind string, canonical string").distinct()
    drawn = stage(_drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    # Given names of any gender must differ from each other.
    family = F.substring_index("kind", "_", 1)
    while True:
        shared = (
            drawn.groupBy(family.alias("family"), "surrogate")
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("canonical", "kind")).alias("first"))
            .filter("n > 1")
        )
        real = drawn.select(family.alias("family"), F.col("canonical").alias("surrogate")).distinct()
        real = real.withColumn("real", F.lit(True))
        judged = (
            drawn.withColumn("family", family)
            .join(shared, ["family", "surrogate"], "left")
            .join(real, ["family", "surrogate"], "left")
        )
        again = F.col("real").isNotNull() | (F.col("n").isNotNull() & (F.col("first") != F.struct("canonical", "kind")))
        judged = stage(judged.select("kind", "canonical", "attempt", "surrogate", again.alias("again")), "judged")
        if judged.filter("again").isEmpty():
            return drawn
        redrawn = _drawn(judged.filter("again").withColumn("attempt", F.col("attempt") + 1), key)
        drawn = stage(judged.filter("NOT again").drop("again").unionByName(redrawn), "surrogates")


def _redrawn_blocks(drawn):
    block = {}
    for row in drawn.filter("attempt > 0").select("kind", "canonical", "attempt").toLocalIterator():
        block[f"{row.kind}|{row.canonical}"] = row.attempt
        if len(block) == REDRAWN_BLOCK:
            yield block
            block = {}
    yield block


def replace_entities(docs, text_col="text", key=None, entities="entities"):
    """``docs`` with surrogates in ``text_col``, and the kinds of each text's entities
    in the array column ``entities``."""
    key = key_of(docs.sparkSession, key)
    drawn = assign_surrogates(docs, key, text_col)
    entities, tries = free_name(docs, entities), free_name(docs, "attempts")
    text_at = docs.columns.index(text_col)
    out = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    if drawn.filter("attempt > 0").limit(REDRAWN_BLOCK + 1).count() <= REDRAWN_BLOCK:
        return _replaced(out, text_at, key, next(_redrawn_blocks(drawn)), None, entities)
    out = out.withColumn(tries, F.lit(None).cast("map<string,int>"))
    for block in _redrawn_blocks(drawn):
        # Stored, so that one block at a time is held.
        out = stage(_noted(out, text_at, block), "noted")
    return _replaced(out, text_at, key, {}, tries, entities)


def _noted(docs, text_at, block):
    """Note the attempts of this block's entities in the last column."""

    def task(batches):
        for batch in batches:
            noted = []
            for text, old in zip(batch.column(text_at).to_pylist(), batch.columns[-1].to_pylist()):
                own = {f"{kind}|{canonical}" for _, _, kind, canonical in detect(text)} & block.keys()
                noted.append(list((dict(old or ()) | {name: block[name] for name in own}).items()))
            last = pa.array(noted, batch.schema.field(batch.num_columns - 1).type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], schema=batch.schema)

    return docs.mapInArrow(task, docs.schema)


def _replaced(docs, text_at, key, attempts, tries, entities):
    fields = [f for f in docs.schema.fields if f.name != tries]
    schema = T.StructType([*fields, T.StructField(entities, T.ArrayType(T.StringType()))])

    def task(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            own = [dict(x or ()) for x in batch.columns[-1].to_pylist()] if tries else [attempts] * len(texts)
            done = [replace(t, key, a) if t else (t, []) for t, a in zip(texts, own)]
            arrays = list(batch.columns)[: len(fields)]
            arrays[text_at] = pa.array([t for t, _ in done], arrays[text_at].type)
            kinds = pa.array([k for _, k in done], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*arrays, kinds], schema.names)

    return docs.mapInArrow(task, schema)


def pseudonymize(docs, id_col="doc_id", text_col="text", key=None):
    """One row per document: its text with surrogates, and the kinds of its entities."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return replace_entities(rows, key=key).withColumn("n_entities", F.size("entities").cast("long"))


def remove_pii(docs, text_col="text", key=None):
    """``docs`` with surrogates in their texts; no other column changes."""
    return replace_entities(docs, text_col, key).select(*[F.col(f"`{c}`") for c in docs.columns])
