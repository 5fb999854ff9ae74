"""Operator 4, PII: keyed surrogates.

Entities are found by patterns, and each distinct entity gets one replacement
for the whole corpus, drawn with a keyed hash: digits for digits, letters of the
same script and case, names of the same gender and script.  A mention keeps its
own format: digits are poured into its punctuation, capitals into its letters.
So equal entities stay equal and, by the collision check, different ones differ.

The check is a Spark job on the table of distinct entities: where two have one
surrogate, or a surrogate is itself an entity of the corpus, the loser draws
again with the next counter, until no clash is left.  Texts meet their
replacements through the hash of the text, so copies of a text share them; only
texts that may hold an entity are shuffled.

Defined results: a null text stays null and an empty one empty; repeated rows
get equal texts; columns of the input stay as they are, apart from the text; an
empty table gives an empty result.  Without the key no original can be found
from its surrogate, other than by guessing the key.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treepref.session import materialize

#: Rounds of drawing again before the space of a format that cannot grow (addresses of IP) counts as full.
ROUNDS = 40
#: Draws before a name is composed, and before other surrogates get a character more with every draw.
LISTED, GROW = 2, 4

# Forms of address by the gender they state, and replacement names by script and gender.
_MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "г-н", "господин"]
_FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "г-жа", "госпожа"]
_ANY = ["Dr", "Prof"]
_NAMES = {
    ("LATIN", "m"): "Adam Brian Carl David Eric Frank George Henry Ivan Jack Kevin Louis Martin Nathan Oscar Paul Robert "
                    "Simon Thomas Victor".split(),
    ("LATIN", "f"): "Alice Bella Clara Diana Emma Fiona Grace Helen Irene Julia Karen Laura Marie Nora Olivia Paula Rosa "
                    "Sara Teresa Vera".split(),
    ("CYRILLIC", "m"): "Алексей Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег".split(),
    ("CYRILLIC", "f"): "Алла Вера Галина Дарья Елена Ирина Ксения Мария Ольга Юлия".split(),
    ("LATIN", "s"): "Abbot Baker Carter Dalton Ellis Foster Garner Harper Irving Jensen Keller Lawson Mercer Norton Osborne "
                    "Porter Quinn Ramsey Sutton Turner".split(),
    ("CYRILLIC", "s"): "Белов Волков Громов Данилов Ершов Жуков Зимин Котов Лапин Морозов".split(),
}
#: Parts of composed names, one syllable a draw and an ending by gender.
_SYLLABLES = {
    "LATIN": [c + v for c in "b br c d dr f g gr h j k l m n p r s st t tr v w z".split() for v in "aeiou"],
    "CYRILLIC": [c + v for c in "б бр в г гр д др ж з к л м н п р с ст т тр ф".split() for v in "аеиоу"],
}
_ENDINGS = {
    ("LATIN", "m"): "bert dan len mar nus rik ton vin".split(),
    ("LATIN", "f"): "da la lia na nia ra ria sa".split(),
    ("LATIN", "s"): "berg field ley man ner sen son ton".split(),
    ("CYRILLIC", "m"): "вин дор лан мир рий слав тин".split(),
    ("CYRILLIC", "f"): "дора ла лия мила на нара рия".split(),
    ("CYRILLIC", "s"): "дин ков лев лин нов ров сков тин".split(),
}
#: A row without any of these cannot hold an entity.
TRIGGER = (r"@|[0-9]{4}|[0-9][ .()-]{1,2}[0-9(]|[0-9a-fA-F]{32}|\b(?:" + "|".join(_MALE + _FEMALE + _ANY) + r")\b")
_TITLE = "|".join(re.escape(t) for t in sorted(_MALE + _FEMALE + _ANY, key=len, reverse=True))
_CAP = r"[^\W\d_a-zà-öø-ÿа-я][^\W\d_]+(?:-[^\W\d_]+)?"
PATTERNS = [
    ("email", re.compile(r"[^\W_][\w.+%-]*@[^\W_][\w-]*(?:\.[\w-]*[^\W_])+")),
    ("secret", re.compile(r"(?<![\w])(?=[0-9a-fA-F]*[0-9])[0-9a-fA-F]{32,128}(?!\w)")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)", re.A)),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", re.A)),
    ("card", re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w|\.\d)", re.A)),
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A)),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?![\w]|\.\d)", re.A)),
    ("name", re.compile(rf"(?<!\w)({_TITLE})(\.?\s{{1,2}})({_CAP}(?: {_CAP}){{0,2}})")),
]
_MARK = re.compile(r"\D", re.A)
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def _digits(text: str) -> str:
    return _MARK.sub("", text)


def _luhn(digits: str) -> int:
    """Check sum of a number whose last digit is the check digit."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities, in order and without overlaps.

    A name is one entity for each word, so that a person named in full and by the
    family name keeps the latter.  Where a text holds a name after a form of address,
    every capitalised mention of its words counts, with such a form or without.
    """
    out, taken, names = [], bytearray(len(text)), {}

    def add(start: int, end: int, kind: str, form: str) -> None:
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            out.append((start, end, kind, form))

    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            if kind == "name":
                gender = "m" if m[1] in _MALE else "f" if m[1] in _FEMALE else "u"
                words = list(re.finditer(r"\S+", m[3]))
                for k, w in enumerate(words):
                    part = "s" if k == len(words) - 1 else gender
                    names.setdefault(w[0].lower(), f"name-{part}")
                    add(m.start(3) + w.start(), m.start(3) + w.end(), f"name-{part}", w[0].lower())
            elif kind == "phone":
                n = len(_digits(m[0]))
                # Without a country code or brackets, only the usual lengths of a full number.
                if 7 <= n <= 15 and (m[0][0] in "+(" or n >= 9 or re.fullmatch(r"\d{3}[ .-]\d{4}", m[0])):
                    add(m.start(), m.end(), kind, _digits(m[0]))
            elif kind in ("card", "ssn"):
                add(m.start(), m.end(), kind, _digits(m[0]))
            elif kind == "iban":
                add(m.start(), m.end(), kind, m[0].replace(" ", ""))
            else:
                add(m.start(), m.end(), kind, m[0].lower())
    for m in _WORD.finditer(text) if names else ():
        for start, end in _spans(m):
            form = text[start:end].lower()
            # Words that run on in digits or underscores are other words.
            if form in names and text[start].isupper() and not _WIDER.search(text[max(start - 1, 0):start] + text[end:end + 1]):
                add(start, end, names[form], form)
    return sorted(out)


_WIDER = re.compile(r"\w")


def _spans(m: re.Match) -> Iterator[tuple[int, int]]:
    """The word itself, then two hyphenated parts of it, then single ones: names have two parts at most."""
    at = [(p.start() + m.start(), p.end() + m.start()) for p in re.finditer(r"[^-]+", m[0])]
    if len(at) > 1:
        yield from ((a[0], b[1]) for a, b in zip(at, at[1:]))
    yield from at


class _Stream:
    """Numbers below a bound from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.seed, self.n, self.pool = key, "\0".join(parts).encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 40:
            block = hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.n = int.from_bytes(block, "big"), self.n + 1
        self.pool, out = divmod(self.pool, n)
        return out


def script(text: str) -> str:
    """Script of the first letter, by its Unicode name."""
    return next((unicodedata.name(c, "LATIN").split()[0] for c in text if c.isalpha()), "LATIN")


#: Letters from which replacements are drawn, by script.
_LETTERS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшыэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}


def _letters(text: str, draw: _Stream) -> str:
    """The text with other digits and other letters of the same script; the rest stays."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            pool = _LETTERS.get(unicodedata.name(c, "LATIN").split()[0])
            out.append(pool[draw.below(len(pool))] if pool else chr(ord(c) - ord(c) % 16 + draw.below(16)) if c.isalpha() else c)
        else:
            out.append(c)
    return "".join(out)


def _gender(form: str) -> str:
    """Kind of a first name of which no mention states the gender: from the lists, else from its ending."""
    for kind in "mf":
        if form.capitalize() in _NAMES.get((script(form), kind), ()):
            return f"name-{kind}"
    return "name-f" if form[-1] in "aаяα" else "name-m"


def surrogate(key: bytes, kind: str, form: str, attempt: int) -> str:
    """Replacement of a canonical form, itself in canonical form."""
    draw = _Stream(key, kind, form, str(attempt))
    more = max(0, attempt + 1 - GROW)
    if kind == "email":
        local, _, domain = form.partition("@")
        labels = domain.split(".")
        # Reserved example domains name nobody; of others the owner's label is replaced.
        if "example" not in labels:
            labels[:-1] = [_letters(x, draw) for x in labels[:-1]]
        return f"{_letters(local + 'a' * more, draw)}@{'.'.join(labels)}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "secret":
        return "".join("0123456789abcdef"[draw.below(16)] for _ in range(len(form) + more))
    if kind.startswith("name-"):
        if kind == "name-u":
            kind = _gender(form)
        of = (script(form), kind[5:])
        if of in _NAMES:
            feminine = "а" if of == ("CYRILLIC", "s") and form.endswith(("а", "ая")) else ""
            if attempt < LISTED:
                return _NAMES[of][draw.below(len(_NAMES[of]))].lower() + feminine
            parts = [_SYLLABLES[of[0]]] * attempt + [_ENDINGS[of]]
            return "".join(p[draw.below(len(p))] for p in parts) + feminine
        return _letters((form if len(form) > 4 else form + form[-1] * 3) + form[-1] * more, draw)
    if kind == "iban":
        return form[:2] + "".join(str(draw.below(10)) if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[draw.below(26)]
                                  for c in form[2:] + "0" * more)
    digits = [str(draw.below(10)) if c == "0" else str(1 + draw.below(9)) for c in form + "0" * more]
    if kind == "phone" and len(form) > 10:
        digits[:len(form) - 10] = form[:-10]  # the country code
    if kind == "card":
        digits[0] = form[0]
        if _luhn(form) == 0:
            digits[-1] = "0"
            digits[-1] = str(-_luhn("".join(digits)) % 10)
    return "".join(digits)


def render(mention: str, kind: str, new: str) -> str:
    """The surrogate in the format of a mention."""
    if kind in ("phone", "card", "ssn"):
        rest = iter(new)
        return "".join(next(rest) if c.isascii() and c.isdigit() else c for c in mention) + "".join(rest)
    if kind == "iban":
        rest = iter(new)
        return "".join(c if c == " " else next(rest) for c in mention) + "".join(rest)
    if kind.startswith("name-"):
        return new.upper() if mention.isupper() and len(mention) > 1 else "-".join(x[:1].upper() + x[1:] for x in new.split("-"))
    if len(mention) == len(new):
        return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new))
    return new.upper() if mention.isupper() else new


def replace(text: str, known: dict[tuple[str, str], str]) -> tuple[str, int]:
    """(text with every entity of ``known`` replaced, how many mentions)."""
    out, at, n = [], 0, 0
    names = {form: new for (kind, form), new in known.items() if kind.startswith("name-")}
    for start, end, kind, form in find(text):
        new = names.get(form) if kind.startswith("name-") else known.get((kind, form))
        if new is not None:
            out += [text[at:start], render(text[start:end], kind, new)]
            at, n = end, n + 1
    return "".join([*out, text[at:]]), n


def _found(rows_in: DataFrame) -> DataFrame:
    """(key, kind, form) of the entities of (key, text)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(k, kind, form) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                   for kind, form in {(x[2], x[3]) for x in find(t)}]
            if got:
                keys, kinds, forms = zip(*got)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(kinds), pa.array(forms)],
                                                 ["key", "kind", "form"])

    return rows_in.mapInArrow(rows, "key long, kind string, form string")


def _drawn(rows_in: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt) with their surrogates."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [surrogate(key, *x) for x in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())],
                                             ["kind", "form", "attempt", "new"])

    return rows_in.select("kind", "form", "attempt").mapInArrow(
        rows, "kind string, form string, attempt int, new string")


def _space() -> Column:
    return F.when(F.col("kind").startswith("name"), F.lit("name")).otherwise(F.col("kind"))


def _entities(found: DataFrame) -> DataFrame:
    """(kind, form) of (key, kind, form), a name with the one kind that most texts give it; unknown genders count last."""
    votes = found.groupBy(_space().alias("space"), "form", "kind").agg(F.count("*").alias("n"))
    best = F.min(F.struct(F.col("kind") == "name-u", -F.col("n"), F.col("kind").alias("kind")))
    names = votes.where("space = 'name'").groupBy("form").agg(best.getField("kind").alias("kind"))
    return votes.where("space <> 'name'").select("kind", "form").unionByName(names)


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt, new): distinct surrogates for distinct (kind, form), none of them a form of its kind.

    Parts of names share a space across genders, as readers compare them as words.
    """
    space = _space()
    entities = materialize(entities.select("kind", "form").distinct(), "entities")
    forms = entities.select(space.alias("space"), F.col("form").alias("new"), F.lit(True).alias("real")).distinct()
    now = materialize(_drawn(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    for _ in range(ROUNDS):
        w = Window.partitionBy("space", "new").orderBy("attempt", "kind", "form")
        judged = now.withColumn("space", space).withColumn("place", F.row_number().over(w)).join(
            forms, ["space", "new"], "left")
        judged = judged.withColumn("lost", (F.col("place") > 1) | F.coalesce("real", F.lit(False)))
        lost = materialize(judged.where("lost").select("kind", "form", "attempt"), "lost")
        if lost.isEmpty():
            return now
        again = _drawn(lost.withColumn("attempt", (F.col("attempt") + 1).cast("int")), key)
        now = materialize(now.join(lost.select("kind", "form"), ["kind", "form"], "left_anti").unionByName(again),
                          "surrogates")
    raise ValueError("a format has too few surrogates for its entities")


def pseudonymise(df: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``df`` with the entities of ``text`` replaced; ``count`` names a column for the number of mentions."""
    secret = hashlib.sha256(key.encode()).digest()
    columns = df.columns
    at = columns.index(text)
    names = [f"c{k}" for k in range(len(columns))]
    rows_in = df.toDF(*names)
    body = F.col(names[at])
    may = F.coalesce(body.rlike(TRIGGER), F.lit(False))
    hashed = F.xxhash64(body, F.octet_length(body))
    some = rows_in.where(may).withColumn("key", hashed)
    found = materialize(_found(some.select("key", body)).distinct(), "mentions")
    drawn = assign(_entities(found), secret).select(_space().alias("space"), "kind", "form", "new")
    mapped = found.select("key", _space().alias("space"), "form").distinct().join(drawn, ["space", "form"]).groupBy("key").agg(
        F.collect_list(F.struct("kind", "form", "new")).alias("known"))  # bounded by the text's length
    fields = rows_in.schema.fields
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t, known in zip(b.column(at).to_pylist(), b.column(len(fields)).to_pylist()):
                new, n = replace(t, {(x["kind"], x["form"]): x["new"] for x in known}) if known else (t, 0)
                texts.append(new)
                counts.append(n)
            cols = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(b.columns[:len(fields)])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], [*names, "mentions"])

    changed = some.join(mapped, "key", "left").select(*names, "known").mapInArrow(rows, f"{head}, mentions long")
    out = changed.unionByName(rows_in.where(~may).withColumn("mentions", F.lit(0).cast("long")))
    out = out.select(*[F.col(n).alias(c) for n, c in zip(names, columns)], *([F.col("mentions").alias(count)] if count else []))
    return out
