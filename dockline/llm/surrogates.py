"""Surrogates for personal data.

Entities are found by pattern, and names by title or given name: each capitalised word is looked at,
so that a word before a name doesn't hide it, and all capitals count like capitalised words. A word found to be a
name is one wherever it stands in the same document, also alone. Every entity
gets one replacement, made from a keyed hash (HMAC) of its kind and canonical form, so that
all mentions of an entity, however they are formatted, get the same one, in every document. A
replacement is of the same kind and shape:

* e-mail addresses keep the lengths and character classes of their parts, and the top domain;
* phone numbers keep punctuation and country code, card numbers their first digit and validity (Luhn);
* IPv4 addresses stay valid, and private ones private; secrets keep length and alphabet;
* given names stay in their gender and script, surnames in their script; each word of a name is an
  entity of its own, so "Mary Smith" and "Mrs. Smith" still share a surname. Scripts without lists
  (all but Latin, Cyrillic and Greek) get letters of the same script; names in them are found after a title only.

Collision check: an entity takes its first candidate that no other entity holds and that is
not itself an entity of the corpus. Candidates are compared by joins and
grouped minima; the entities that lose take their next candidate, in rounds, until none is
left. Names get one word more in each round. Other kinds keep their shape for ``PLAIN`` rounds; then e-mails, secrets,
phone and social security numbers get longer with each round, and addresses go to 10.0.0.0/8 if they are private, then
to the unused 240.0.0.0/4. So the candidates of a round outnumber the entities left after few rounds.

Defined cases: null texts stay null and texts without entities stay as they are; overlapping matches go to
the earliest, then longest; repeated rows get equal results; rows are told apart by (doc_id, text), so
several texts may share a doc_id; an empty table gives an empty result.
"""
from __future__ import annotations

import functools
import hashlib
import hmac
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

KEY_CONF = "dockline.pii.key"
PLAIN = 4                   # rounds in which candidates have their entity's shape

# Given names by script and gender, surnames by script, titles by gender.
GIVEN = {
    ("latin", "f"): ("Mary Anna Laura Sophie Emma Julia Alice Clara Maria Elena Nora Ines Marta Lena Paula Rosa Eva Irene Carmen Helena "
                     "Sarah Emily Jennifer Linda Elizabeth Susan Jessica Karen Nancy Margaret Sandra Ashley Kimberly Donna Michelle Amanda "
                     "Melissa Deborah Stephanie Rebecca Sharon Cynthia Kathleen Amy Angela Anne Catherine Claire Camille Isabelle Nathalie "
                     "Brigitte Sabine Ursula Monika Petra Katharina Lucía Isabel Pilar").split(),
    ("latin", "m"): ("John Peter Paul Thomas Martin David Daniel Lucas Oscar Hugo Felix Simon Jonas Emil Victor Andreas Pablo Carlos Pierre Hans "
                     "James Robert Michael William Richard Joseph Charles Christopher Matthew Anthony Steven Andrew Kenneth Kevin Brian George "
                     "Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Jean Jacques François Nicolas Stefan "
                     "Klaus Wolfgang Jürgen Miguel Antonio José Javier").split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Ирина Татьяна Наталья Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Михаил Павел Владимир".split(),
    ("greek", "f"): "Μαρία Ελένη Άννα Σοφία Κατερίνα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Νίκος Πέτρος Παύλος Ανδρέας Δημήτρης".split(),
}
SURNAMES = {
    "latin": "Smith Miller Baker Fischer Weber Martin Garcia Lopez Moreau Laurent Novak Larsen Berg Romano Costa Silva Keller Wagner Dubois Navarro".split(),
    "cyrillic": "Иванов Петров Смирнов Кузнецов Попов Соколов Лебедев Козлов Новиков Морозов".split(),
    "greek": "Παπαδόπουλος Γεωργίου Νικολάου Δημητρίου Ιωάννου".split(),
}
TITLES = {
    "f": "Mrs Ms Miss Frau Mme Madame Señora Sra Госпожа Κυρία".split(),
    "m": "Mr Herr Monsieur Señor Sr Господин Κύριος".split(),
    "u": "Dr Prof".split(),
}
_GENDER = {n: g for (_, g), names in GIVEN.items() for n in names}
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
# words that stand after a name without being one
_COMMON = frozenset("""A An And Are As At But By For From Had Has Have He Her His How I If In Is It Its Not Of On Or Our Said Says She
So That The Their Then They This To Was We Were What When Where Who Will With You Your Der Die Das Und Ist Hat War Mit Von Für Auf
Le La Les Et Est Un Une Du Des Dans Pour El Los Las Y Es Una En Con Para И В На Не С Он Она Это Και Το Η Ο""".split())
# words that are more often something else than a surname: replaced beside a title or given name, not elsewhere
_ELSE = frozenset("""Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September
October November December Street Road Avenue Lane Square Park Bridge Church School Hall House Hill Lake River Montag Dienstag Mittwoch
Donnerstag Freitag Samstag Sonntag Januar Februar März Mai Juni Juli Oktober Dezember Straße Platz Weg Lundi Mardi Mercredi Jeudi
Vendredi Samedi Dimanche Janvier Février Mars Avril Juin Juillet Août Rue Place Lunes Martes Miércoles Jueves Viernes Sábado Domingo
Calle Plaza""".split())
_CAP = r"(?:[A-Z]['’])?[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ][^\W\d_]+(?:-[^\W\d_a-zß-öø-ÿа-яёα-ωά-ώ][^\W\d_]+)*"
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("secret", r"(?i:password|passwd|token|secret|api[_-]?key)\s?[=:]\s?[\"']?([A-Za-z0-9_/+-]{8,})"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("card", r"(?<![\w.])(?:\d[ -]?){12,18}\d(?![\w])"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\w)"),
]
_RX = [(k, re.compile(p)) for k, p in PATTERNS]
_HINT = re.compile(r"[@\d=:]")
_WORD = re.compile(r"\b" + _CAP)
_LOWER = re.compile(r"(?<!\w)[^\W\d_]+(?!\w)")
# what may stand between the words of a name: blanks, then initials and particles
_GAP = re.compile(r"[^\S\n]{1,3}(?:(?:[^\W\d_]\.[^\S\n]?|(?:van|von|de|der|den|del|della|da|di|du|dos|la|le)[^\S\n]))*")
_AFTER_TITLE = re.compile(r"\.?" + _GAP.pattern + r"|\.")


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def script(word: str) -> str:
    c = ord(word[0])
    if 0x400 <= c < 0x530:
        return "cyrillic"
    if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000:
        return "greek"
    return "latin" if unicodedata.name(word[0], "").startswith("LATIN") else "other"


@functools.lru_cache(None)
def _alike(c: str) -> str:
    """The letters of the script and kind of ``c`` that stand near it."""
    kind = lambda x: (unicodedata.category(x), unicodedata.name(x, "").split(" ")[0])
    return "".join(x for x in map(chr, range(ord(c) & ~127, (ord(c) | 127) + 1)) if kind(x) == kind(c))


@functools.lru_cache(1 << 16)
def proper(word: str) -> str:
    """A name's canonical form, the same for all ways to capitalise it."""
    return "".join(x.capitalize() for x in re.split(r"([-'’])", unicodedata.normalize("NFC", word)))


def canonical(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return proper(text) if kind.startswith(("given", "surname")) else text


def _names(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the words that are names by a title or as given names, and of their other mentions."""
    words = [(*m.span(), proper(m[0])) for m in _WORD.finditer(text) if not m[0][0].islower()]
    joined = lambda i, gap: i + 1 < len(words) and gap.fullmatch(text, words[i][1], words[i + 1][0]) is not None
    known, i = {}, 0                 # number of the word -> kind

    def surname(j: int) -> bool:
        if words[j][2] in _COMMON or words[j][2] in _TITLE:
            return False
        known[j] = f"surname-{script(words[j][2])}"
        return True

    while i < len(words):
        w, gender, title = words[i][2], None, None
        while w in _TITLE and joined(i, _AFTER_TITLE):       # "Prof. Dr. Weber"
            title, i = _TITLE[w] if title in (None, "u") else title, i + 1
            w = words[i][2]
        gender = _GENDER.get(w)
        if gender is None and (title is None or w in _COMMON):
            i += 1
            continue
        pair = joined(i, _GAP) and words[i + 1][2] not in _COMMON and words[i + 1][2] not in _TITLE
        if gender is None and not pair:                      # a title and a surname
            surname(i)
            i += 1
            continue
        g = gender or title.replace("u", "f" if w[-1] in "aeаяα" else "m")
        known[i] = f"given-{g}-{script(w)}"
        i += 1
        # middle names, as long as another word follows
        while pair and words[i][2] in _GENDER and joined(i, _GAP) and words[i + 1][2] not in _COMMON and words[i + 1][2] not in _TITLE:
            known[i] = f"given-{_GENDER[words[i][2]]}-{script(words[i][2])}"
            i += 1
        if pair and surname(i):
            i += 1
    kinds, lower = {}, None
    for j, k in sorted(known.items()):
        if k.startswith("surname"):
            lower = set(_LOWER.findall(text)) if lower is None else lower
            if words[j][2] in _ELSE or words[j][2].lower() in lower:
                continue
        kinds.setdefault(words[j][2], k)
        for part in words[j][2].split("-"):                  # "Smith" after "Mary Smith-Miller"
            kinds.setdefault(part, k)
    return [(a, b, known.get(j) or kinds[w]) for j, (a, b, w) in enumerate(words) if j in known or w in kinds]


def find(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order, without overlap. Kinds of
    names carry gender and script: ``given-f-latin``, ``surname-cyrillic``."""
    if not text:
        return []
    got = []
    if _HINT.search(text):
        for kind, rx in _RX:
            for m in rx.finditer(text):
                a, b = m.span(1 if kind == "secret" else 0)
                if kind == "card":
                    d = re.sub(r"\D", "", m[0])
                    if not (luhn(d) or (len(d) == 16 and d[0] in "3456")):
                        continue
                got.append((a, b, kind))
    got += _names(text)
    out, end = [], 0
    for a, b, k in sorted(got, key=lambda x: (x[0], -x[1])):
        if a >= end:
            out.append((a, b, k))
            end = b
    return out


class _Draw:
    """Keyed stream of numbers for an entity and an attempt."""

    def __init__(self, kind: str, canon: str, attempt: int, key: bytes):
        self.base, self.n, self.pool = hmac.new(key, f"{kind}\0{canon}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hashlib.sha256(self.base + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n

    def like(self, c: str, hexes: bool = False) -> str:
        if c.isdigit():
            return "0123456789"[self.below(10)]
        if not c.isalpha():
            return c
        letters = "abcdef" if hexes else "abcdefghijklmnopqrstuvwxyz"
        x = letters[self.below(len(letters))]
        return x.upper() if c.isupper() else x


def iban_check(country: str, account: str) -> str:
    """The check digits, from the remainder modulo 97 with letters as 10 to 35."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def surrogate(kind: str, canon: str, attempt: int, key: bytes) -> str:
    """The entity's candidate, in canonical form."""
    d = _Draw(kind, canon, attempt, key)
    more = 2 * max(0, attempt - PLAIN + 1)                   # characters beyond the entity's own
    if kind == "email":
        head, _, top = canon.rpartition(".")
        return "".join(d.like(c) for c in "a" * more + head) + "." + top
    if kind == "phone":
        keep = max(0, len(canon) - 10)                       # the country code
        return canon[:keep] + "".join(str(d.below(9) + 1) if i == 0 else str(d.below(10)) for i in range(len(canon) - keep + more))
    if kind == "card":
        body = canon[0] + "".join(str(d.below(10)) for _ in canon[2:])
        ok = [c for c in "0123456789" if luhn(body + c) == luhn(canon)]
        return body + ok[d.below(len(ok))]
    if kind == "ip":
        a = [int(x) for x in canon.split(".")]
        keep = 2 if a[0] == 192 and a[1] == 168 else 1 if a[0] in (10, 127) else 0
        if keep == 2 and attempt >= PLAIN:
            a, keep = [10, 0, 0, 0], 1
        if attempt >= 2 * PLAIN:
            a, keep = [240 + d.below(15), 0, 0, 0], 1
        out = a[:keep] + [d.below(254) + 1 for _ in a[keep:]]
        if not keep:
            out[0] = [x for x in range(11, 224) if x not in (127, 169, 172, 192)][d.below(209)]
        return ".".join(map(str, out))
    if kind == "iban":
        body = "".join(d.like(c) for c in canon[4:])
        right = iban_check(canon[:2], canon[4:]) == canon[2:4]
        return canon[:2] + (iban_check(canon[:2], body) if right else "".join(d.like(c) for c in canon[2:4])) + body
    if kind == "ssn":
        return "".join(str(d.below(9) + 1) for _ in range(len(canon) + more))
    if kind == "secret":
        hexes = re.fullmatch(r"[0-9a-fA-F]+", canon) is not None
        return "".join(d.like(c, hexes) for c in canon + "a" * more)
    if kind.endswith("-other"):                              # a script without lists; later candidates are longer
        return "".join((x := _alike(c))[d.below(len(x))] for c in canon + canon[-1] * attempt)
    names = GIVEN[(kind.split("-")[2], kind.split("-")[1])] if kind.startswith("given") else SURNAMES[kind.split("-")[1]]
    name = names[d.below(len(names))]
    if attempt:                                              # a list is short: later candidates are double names
        name += "-" + "-".join(names[d.below(len(names))] for _ in range(attempt))
    return name


def fitted(kind: str, canon: str, found: str, mention: str) -> str:
    """The replacement ``found`` of ``canon`` in the format of ``mention``."""
    if kind in ("phone", "card", "ssn", "iban"):
        it = iter(found)
        return "".join(next(it) if (c.isdigit() or kind == "iban" and c.isalnum()) else c for c in mention) + "".join(it)
    if kind == "email" and mention != canon and len(mention) == len(found):
        return "".join(f.upper() if m.isupper() else f for f, m in zip(found, mention))
    return found.upper() if mention.isupper() and kind.startswith(("given", "surname")) else found


MENTIONS = "doc_id long, t long, start int, end int, kind string, canon string"


def _mentions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ids = pdf["doc_id"].astype("Int64").tolist()
        got = [(i, t, a, b, k, canonical(k, x[a:b])) for i, t, x in zip(ids, pdf["t"], pdf["text"]) for a, b, k in find(x)]
        yield pd.DataFrame(got, columns=["doc_id", "t", "start", "end", "kind", "canon"]).astype({"doc_id": "Int64"})


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's configuration (``KEY_CONF``). Where there is none a random one is drawn and kept for
    the session: nobody can try out entities against it, and another session replaces otherwise."""
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_CONF, key)
    return key.encode()


def assign(entities: DataFrame, key: bytes | None = None) -> DataFrame:
    """(kind, canon, found): a replacement for every (kind, canon), no two alike and none that is an entity."""
    key = key or session_key(entities.sparkSession)

    @F.pandas_udf(T.StringType())
    def candidate(kind: pd.Series, canon: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, c, a, key) for k, c, a in zip(kind, canon, attempt)])

    family = lambda: F.substring_index("kind", "-", 1)  # noqa: E731  names of either gender are told apart, too
    real = entities.select(family().alias("family"), F.col("canon").alias("found")).distinct()
    # what is taken: by the first round, which most entities win, and by all later ones together
    first, later, open_, attempt = None, None, entities.withColumn("family", family()), 0
    while True:
        free = open_.withColumn("found", candidate("kind", "canon", F.lit(attempt)))
        for held in (real, first, later):
            if held is not None:
                free = free.join(held.select("family", "found"), ["family", "found"], "left_anti")
        # of those that want the same, the first in order gets it
        best = free.groupBy("family", "found").agg(F.min(F.struct("kind", "canon")).alias("b"))
        won = C.materialize(best.select("family", "b.kind", "b.canon", "found"), "surrogates")
        if first is None:
            first = won
        else:
            later = won if later is None else C.materialize(later.unionByName(won), "surrogates-later")
        open_ = C.materialize(open_.join(won, ["kind", "canon"], "left_anti"), "surrogates-open")
        attempt += 1
        if not open_.limit(1).count():
            return (first if later is None else first.unionByName(later)).select("kind", "canon", "found")


OUT = "doc_id long, text string, n_entities int, n_distinct int"


def _replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for i, text, marks in zip(pdf["doc_id"].astype("Int64").tolist(), pdf["text"], pdf["marks"]):
            marks = [] if marks is None else sorted(marks, key=lambda m: m["start"])
            parts, at = [], 0
            for m in marks:
                parts += [text[at:m["start"]], fitted(m["kind"], m["canon"], m["found"], text[m["start"]:m["end"]])]
                at = m["end"]
            out.append((i, text if not marks else "".join(parts) + text[at:], len(marks), len({(m["kind"], m["canon"]) for m in marks})))
        yield pd.DataFrame(out, columns=["doc_id", "text", "n_entities", "n_distinct"]).astype({"doc_id": "Int64"})


def replace(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """One row per document: doc_id, the text with surrogates, n_entities, n_distinct."""
    key = key or session_key(docs.sparkSession)
    d = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    found = C.materialize(d.mapInPandas(_mentions, MENTIONS).distinct(), "mentions")
    map_ = assign(found.select("kind", "canon").distinct(), key)
    marks = (found.join(map_, ["kind", "canon"]).groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t"))
             .agg(F.collect_list(F.struct("start", "end", "kind", "canon", "found")).alias("marks")))
    return (d.join(marks, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left")
            .select("doc_id", "text", "marks").mapInPandas(_replace, OUT))
