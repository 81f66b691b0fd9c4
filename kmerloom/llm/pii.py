"""Personal data: keyed surrogates that keep type, format, gender, script and coreference.

Whole texts are searched for e-mail addresses, telephone numbers, payment card and account numbers, social security
numbers, IPv4 and IPv6 addresses, access tokens, and names of persons: one to four words after one or more titles, or a
known given name before a surname, in Latin or Cyrillic letters; the last word is the surname, and particles and initials
stay. A document's further mentions of a name's words count as well, with or without a title, also where a word is an
ordinary one in capitals. Every mention has a canonical key: mentions that differ in case or punctuation, in a title, or in
a country code before the same number, share it; an access token is its own key, letter by letter. A surrogate is drawn from a keyed hash of kind and key: digits stay digits at their places, letters stay letters in
their case, a card number that passes its check digit gets one that does, given names stay within gender and script,
surnames within script; country codes stay. Names are replaced word by word, so that a full name and its surname alone
still agree. A given name's gender is the one the corpus shows for it anywhere.

Collision checks run over the whole corpus: two keys of a kind never share a surrogate, and no surrogate is itself a key
that the corpus holds. What fails is drawn again, in rounds, until nothing is left; draws after the fourth are longer
where the format allows it, and after the sixteenth they are longer in any case: a format too small for its keys is
departed from rather than distinctness.

Defined cases: a null text stays null; a text without mentions stays as it is, byte for byte; repeated rows are changed
alike; texts of any length are searched whole, in time that grows with their mentions; where mentions overlap, the kind
that is searched first has it; without a key, the library's functions raise an error, and the registered query warns and
takes an open one; an empty table gives an empty result; a column ``n_entities`` is replaced, and columns
other than ``text`` and ``n_chars`` are not touched, whatever their names.
"""

from __future__ import annotations

import hmac
import re
import warnings
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The session setting with the secret key. Who has the key can test guesses about the originals.
KEY_SETTING = "spark.kmerloom.surrogateKey"
#: For the registered query and the tests, where the session names none.
OPEN_KEY = b"not a secret"
MAX_ROUNDS = 64
LONGER = 16

# Particles of surnames, titles, given names by gender and script, and syllables of surnames.
PARTICLES = "(?:van|von|vom|der|den|de|del|della|di|da|dos|das|do|du|la|le|ten|ter|zu|zum|zur|af|al|el|bin|ibn|y)"
TITLES = {
    "m": "Mr Mister Herr Señor Sr Monsieur Sir Signor Господин г-н".split(),
    "f": "Mrs Ms Miss Frau Señora Sra Señorita Madame Mme Mademoiselle Mlle Signora Госпожа г-жа".split(),
    "x": "Dr Prof Professor Doctor Docteur Доктор".split(),
}
GIVEN = {
    ("m", "latin"): "James John Robert Michael William David Thomas Peter Paul Andreas Stefan Klaus Jürgen Pierre Jean Michel Luc Carlos José Juan Miguel Antonio".split(),
    ("f", "latin"): "Mary Patricia Jennifer Linda Elizabeth Susan Sarah Anna Maria Petra Sabine Ursula Claire Sophie Camille Julie Carmen Lucía Elena Isabel".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Сергей Дмитрий Андрей Михаил Николай".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
}
SYLLABLES = {"latin": "bar bel cor dan del fen gar hal ken lan mar mor nel par ran ros sal tor van wen".split(), "cyrillic": "бар бел вол гор дан кор лан мар нов пар рос сол тор".split()}

#: Letters of Latin, Greek and Cyrillic words beyond ASCII.
_BEYOND = "À-ÖØ-öø-ɏͰ-ϿЀ-ӿ"
EMAIL = re.compile(rf"(?<![\w.%+\-])[A-Za-z0-9{_BEYOND}._%+\-]+@[\w\-]+(?:\.[\w\-]+)*\.(?:[^\W\d_]{{2,}}|xn--[A-Za-z0-9\-]+)(?!\w)")
SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_\-]{20,})(?![A-Za-z0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
CARD = re.compile(r"(?<![\w+\-])(?<![0-9]\.)(?:[0-9]{4}([ \-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ \-])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![\w\-])")
PHONE = re.compile(
    r"(?<![\w+\-])(?:\+[0-9]{1,3}[ .\-]?\([0-9]{1,4}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}|\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)[ .\-]?)?[0-9]{2,4}(?:[ .\-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-][0-9]{4}|[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4})(?![\w])"
)
SSN = re.compile(r"(?<![\w\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w\-])")
IP = re.compile(r"(?<!\w)(?<![0-9]\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9])")
IPV6 = re.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![\w:])")
_TITLES = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_GIVEN = sorted((g for gs in GIVEN.values() for g in gs), key=len, reverse=True)
TITLE = re.compile(rf"(?<!\w)(?:(?:{_TITLES})(?!\w)\.? ?)+(?<= )")
GIVEN_NAME = re.compile(rf"(?<!\w)(?:{'|'.join(_GIVEN)}|{'|'.join(g.upper() for g in _GIVEN)})(?= )")
_BIG, _SMALL = r"[\p{Lu}&&[\p{Latin}\p{Cyrillic}]]\p{M}*", r"(?:[\p{Ll}&&[\p{Latin}\p{Cyrillic}]]\p{M}*)"
_WORD = rf"(?:{_BIG}['’])?(?:{_BIG}{_SMALL}+)+(?:[\-'’](?:{_BIG}{_SMALL}+)+)*"
_CAPITALS = rf"(?:{_BIG}['’])?(?:{_BIG}){{2,}}(?:[\-'’](?:{_BIG}){{2,}})*"
_BEFORE = rf"(?:(?:{_BIG}\.|{PARTICLES}) )*"
#: Words of a name, with particles and initials before each.
WORDS = regex.compile(rf"{_BEFORE}(?P<word>{_WORD})(?: {_BEFORE}(?P<word>{_WORD})){{0,3}}(?!\w)|{_BEFORE}(?P<word>{_CAPITALS})(?: {_BEFORE}(?P<word>{_CAPITALS})){{0,3}}(?!\w)", regex.V1)
NAME_WORD = regex.compile(rf"(?<!\w)(?:{_WORD}|{_CAPITALS})(?!\w)", regex.V1)
HAS_DIGIT = re.compile("[0-9]")
GENDER = {t: g for g, ts in TITLES.items() for t in ts}
GIVEN_GENDER = {n.casefold(): g for (g, _), ns in GIVEN.items() for n in ns}


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def national(mention: str) -> str:
    """The digits of a telephone number without its country code and without a leading zero.

    A country code ends where the mention parts it; unparted ones are taken for one digit after +1 and +7, else for two.
    """
    digits = _digits(mention)
    if mention[0] == "+":
        head = re.match(r"\+([0-9]{1,3})[ .\-(]", mention)
        digits = digits[len(head[1]) if head else 1 if digits[0] in "17" else 2 :]
    return digits.lstrip("0") or "0"


class _Spans:
    """Spans without overlaps, found by halving."""

    def __init__(self) -> None:
        self.starts: list[int] = []
        self.found: list[tuple[int, int, str, str, str]] = []

    def add(self, start: int, end: int, kind: str, key: str, gender: str = "") -> None:
        at = bisect_left(self.starts, start)
        if (at and self.found[at - 1][1] > start) or (at < len(self.starts) and self.starts[at] < end):
            return
        self.starts.insert(at, start)
        self.found.insert(at, (start, end, kind, key, gender))


def find_entities(text: str | None) -> list[tuple[int, int, str, str, str]]:
    """``(start, end, kind, key, gender)`` of every mention, in order and without overlaps; names word by word."""
    if not text:
        return []
    spans = _Spans()
    add = spans.add
    if "@" in text:
        for m in EMAIL.finditer(text):
            add(*m.span(), "email", m[0].lower())
    if HAS_DIGIT.search(text):
        for m in SECRET.finditer(text):
            if HAS_DIGIT.search(m[0]):
                add(*m.span(), "card" if m[0].isdigit() else "secret", m[0])
        for m in IBAN.finditer(text):
            add(*m.span(), "iban", m[0].replace(" ", ""))
        for m in CARD.finditer(text):
            add(*m.span(), "card", _digits(m[0]))
        for m in PHONE.finditer(text):
            if 7 <= len(_digits(m[0])) <= 15:
                add(*m.span(), "phone", national(m[0]))
        for m in SSN.finditer(text):
            add(*m.span(), "ssn", _digits(m[0]))
        for m in IP.finditer(text):
            if all(int(x) <= 255 for x in m[0].split(".")):
                add(*m.span(), "ip", ".".join(str(int(x)) for x in m[0].split(".")))
        if ":" in text:
            for m in IPV6.finditer(text):
                if HAS_DIGIT.search(m[0]) and m[0].count("::") <= 1:
                    add(*m.span(), "ipv6", m[0].lower())
    names: dict[str, tuple[str, str]] = {}

    def name(found: regex.Match | None, gender: str) -> None:
        words = list(zip(found.captures("word"), found.starts("word"), strict=True)) if found else []
        for k, (word, at) in enumerate(words):
            script = "cyrillic" if re.match("[А-Яа-яЁё]", word) else "latin"
            key, kind, own = word.casefold(), f"surname_{script}", ""
            if k + 1 < len(words):
                kind, own = f"given_{script}", GIVEN_GENDER.get(key, gender)
            add(at, at + len(word), kind, key, own)
            names.setdefault(key, (kind, own))

    for m in TITLE.finditer(text):
        genders = [GENDER[t] for t in re.findall(_TITLES, m[0])]
        name(WORDS.match(text, m.end()), next((g for g in genders if g != "x"), "x"))
    for m in GIVEN_NAME.finditer(text):
        found = WORDS.match(text, m.start())
        # A given name alone is no person yet.
        if found and len(found.captures("word")) > 1:
            name(found, "x")
    if names:
        # The document's other mentions of these words, in the cases that names have.
        for m in NAME_WORD.finditer(text):
            if known := names.get(m[0].casefold()):
                add(*m.span(), known[0], m[0].casefold(), known[1])
    return spans.found


class _Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, secret: bytes, label: str) -> None:
        self.secret, self.label, self.block, self.left = secret, label, 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 8:
            self.left = hmac.digest(self.secret, f"{self.label}\0{self.block}".encode("utf-8", "surrogatepass"), "sha256")
            self.block += 1
        value, self.left = int.from_bytes(self.left[:8], "big"), self.left[8:]
        return value % n

    def shape(self, text: str) -> str:
        letters = "abcdefghijklmnopqrstuvwxyz"
        return "".join(str(self.below(10)) if c.isdigit() else letters[self.below(26)].upper() if c.isupper() else letters[self.below(26)] if c.isalpha() else c for c in text)


def surrogate(kind: str, key: str, attempt: int, secret: bytes, gender: str = "") -> str:
    """The canonical surrogate of a key: the ``attempt``-th draw."""
    d = _Draw(secret, f"{kind}\0{key}\0{attempt}")
    longer = max(0, attempt - 3)
    # Beyond this many draws the format is taken for full.
    more = d.shape("0" * max(0, attempt - LONGER + 1))
    if kind == "email":
        local, domain = key.split("@", 1)
        labels = domain.split(".")
        host = [d.shape(x) for x in labels[:-2]] + ["example", ("com", "net", "org")[d.below(3)]]
        return f"{d.shape(local)}{d.shape('a' * longer)}@{'.'.join(host)}"
    if kind == "phone":
        return str(1 + d.below(9)) + d.shape(key[1:]) + more
    if kind == "card":
        body = str(1 + d.below(9)) + d.shape(key[1:]) + more
        if luhn(key):
            body = next(b for b in (body[:-1] + str(c) for c in range(10)) if luhn(b))
        return body
    if kind == "ssn":
        return d.shape(key) + more
    if kind == "iban":
        return key[:2] + d.shape(key[2:]) + more
    if kind == "ip":
        # Where IPv4 is full, an address of the range for documentation.
        return "2001:db8:" + ":".join(f"{d.below(1 << 16):x}" for _ in range(6)) if more else ".".join(str(1 + d.below(254)) for _ in range(4))
    if kind == "ipv6":
        return ":".join("".join("0123456789abcdef"[d.below(16)] for _ in part) if part else "" for part in key.split(":")) if not more else ":".join(f"{d.below(1 << 16):x}" for _ in range(8))
    if kind == "secret":
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", key):
            own = "".join("0123456789abcdef"[d.below(16)] for _ in key)
            return own.upper() if key.isupper() else own
        head = re.match("AKIA|gh[pousr]_|sk-", key)[0]
        return head + d.shape(key[len(head) :]) + more
    role, script = kind.split("_")
    syllables = SYLLABLES[script]
    extra = "".join(syllables[d.below(len(syllables))] for _ in range(longer))
    if role == "given":
        names = GIVEN[(gender if gender in ("m", "f") else "mf"[d.below(2)], script)]
        tail = "" if attempt == 0 else syllables[d.below(len(syllables))]
        return names[d.below(len(names))].casefold() + tail + extra
    return "".join(syllables[d.below(len(syllables))] for _ in range(3)) + extra


def render(mention: str, kind: str, key: str, canonical: str) -> str:
    """A surrogate in the format of a mention."""
    if kind in ("phone", "card", "ssn", "iban"):
        # The mention's last signs are those of its key; a country code or zero before them stays.
        places = [k for k, c in enumerate(mention) if c.isalnum()][-len(key) :]
        text = list(mention)
        for k, c in zip(places, canonical, strict=False):
            text[k] = c
        return "".join(text) + canonical[len(places) :]
    if kind.startswith(("given", "surname")):
        if mention.isupper():
            return canonical.upper()
        return "-".join(p[:1].upper() + p[1:] for p in canonical.split("-"))
    return canonical.upper() if mention.isupper() and kind != "secret" else canonical


def detect(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with ``column``, the mentions in ``text``."""

    @F.pandas_udf("array<struct<start:int,end:int,kind:string,key:string,gender:string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"start": s, "end": e, "kind": k, "key": v, "gender": g} for s, e, k, v, g in find_entities(t)] for t in texts], dtype=object)

    return docs.withColumn(column, run(F.col("text").cast("string")))


def assign(keys: DataFrame, secret: bytes) -> DataFrame:
    """``(kind, key, surrogate)`` for ``keys (kind, key, gender)``: no surrogate twice in a kind, and none that is a key."""

    @F.pandas_udf("string")
    def draw(kinds: pd.Series, values: pd.Series, attempts: pd.Series, genders: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, v, int(a), secret, g) for k, v, a, g in zip(kinds, values, attempts, genders, strict=True)], dtype=object)

    # "f" and "m" come before "x", which is any.
    keys = common.written(keys.groupBy("kind", "key").agg(F.min("gender").alias("gender")), "keys")
    pending, done = keys.withColumn("attempt", F.lit(0)), None
    for _ in range(MAX_ROUNDS):
        drawn = common.written(pending.withColumn("surrogate", draw("kind", "key", "attempt", "gender")), "drawn")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("key").alias("key"))
        free = first.join(keys.select("kind", F.col("key").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done, ["kind", "surrogate"], "left_anti")
        won = common.written(free.select("kind", "key", "surrogate"), "won")
        done = won if done is None else done.unionByName(won)
        pending = drawn.join(won, ["kind", "key"], "left_anti").select("kind", "key", "gender", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return done
    raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")


def replace_entities(docs: DataFrame, secret: bytes, counted: str | None = "n_entities") -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_chars`` brought up to date where there is one.

    A column ``counted`` with the number of mentions is added, or replaced; None adds none.
    """
    if counted is not None:
        docs = common.without(docs, counted)
    found, row, parts, n = (common.free_name(docs, x) for x in ("found", "found_row", "found_parts", "found_n"))
    # Texts are searched once; what was found is written beside them.
    searched = common.written(detect(docs, found).withColumn(row, F.monotonically_increasing_id()), "searched")
    hit = searched.where(F.size(found) > 0)
    mentions = hit.select(F.col(row).alias("row"), F.explode(found).alias("m")).select("row", "m.*")
    known = mentions.join(assign(mentions, secret), ["kind", "key"])
    gathered = known.groupBy(F.col("row").alias(f"{row}_of")).agg(F.collect_list(F.struct("start", "end", "kind", "key", "surrogate")).alias(parts))

    @F.pandas_udf("string")
    def splice(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, ps in zip(texts, lists, strict=True):
            done, at = [], 0
            for p in sorted(ps, key=lambda p: p["start"]):
                done += [text[at : p["start"]], render(text[p["start"] : p["end"]], p["kind"], p["key"], p["surrogate"])]
                at = p["end"]
            out.append("".join([*done, text[at:]]))
        return pd.Series(out, dtype=object)

    clean = searched.where(F.size(found) == 0).withColumn(n, F.lit(0).cast("long"))
    changed = hit.join(gathered, F.col(row) == F.col(f"{row}_of")).withColumn("text", splice(F.col("text").cast("string"), parts)).withColumn(n, F.size(parts).cast("long"))
    for name in docs.columns:
        if name.lower() == "n_chars":
            changed = changed.withColumn(name, F.length("text").cast(docs.schema[name].dataType))
    names = [*map(common.column, docs.columns), *([] if counted is None else [F.col(n).alias(counted)])]
    return clean.select(*names).unionByName(changed.select(*names))


def session_key(spark: SparkSession, default: bytes | None = None) -> bytes:
    """The key that the session names, or ``default``, with a warning; an error where there is neither."""
    named = spark.conf.get(KEY_SETTING, None)
    if named:
        return named.encode()
    if default is None:
        raise ValueError(f"set {KEY_SETTING} to a secret key")
    warnings.warn(f"{KEY_SETTING} is not set: surrogates are drawn with an open key and can be traced back", stacklevel=2)
    return default


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data, and the number of mentions replaced."""
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, session_key(spark, OPEN_KEY)).select("doc_id", "n_entities", "text")
