"""Personal data in texts: expressions propose spans, checksums and ranges confirm them, words nearby adjust the score.

Every kind has an expression, a validator and a prior. A proposed span that its validator rejects is dropped and not tried
again in part. The score is the prior, raised by a word of the kind's context close to the span, lowered by a word that
speaks of numbers of another sort. Kinds whose form alone is proof (``sure``) stay whatever the score; the others stay from
``LEAST_SCORE`` on: account numbers that pass mod-97, social security numbers, phone numbers written without a plus, and
values assigned to the name of a key, token or password that look random.
Spans of one kind never overlap, leftmost first; spans of different kinds may, except that a phone number without a plus
is not proposed inside a span of another kind.

Cases: a null or empty text has no spans; repeated rows and equal doc_ids give a row each; other columns are ignored; offsets
count code points, end exclusive.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.llm.texts import read_documents
from vacancylake.session import ship_package

LEAST_SCORE = 0.5
#: Characters before and after a span in which context words count.
NEARBY = 48


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Account numbers: the first four characters moved to the end, letters as 10 to 35, must leave 1."""
    plain = account.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


# Characters of an account number by country, as the public registry lists them.
ACCOUNT_LENGTHS = {
    n: codes.split() for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}
_LENGTH_OF = {country: n for n, countries in ACCOUNT_LENGTHS.items() for country in countries}


def account_end(span: str) -> int:
    """Where the account number ends that ``span`` begins with; 0 if there is none.

    A listed country says how long it is; for others every end of a group is tried, the longest first. What follows,
    such as a word in capitals, is not part of it.
    """
    places = [k + 1 for k, c in enumerate(span) if c != " "]
    listed = _LENGTH_OF.get(span[:2])
    if listed:
        ends = places[listed - 1 : listed]
    else:
        ends = [e for e in reversed(places) if e == len(span) or span[e] == " "]
    for end in ends:
        if (end == len(span) or span[end] == " ") and len(span[:end].replace(" ", "")) >= 12 and mod97(span[:end]):
            return end
    return 0


def _entropy(text: str) -> float:
    """Bits per character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def _secret(value: str) -> bool:
    """Letters and digits mixed, without much repetition: not a word, a number or a placeholder."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and _entropy(value) >= 2.8


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _card(span: str) -> bool:
    d = _digits(span)
    return 16 <= len(d) <= 19 and luhn(d)


def _social(span: str) -> bool:
    area, group, serial = span.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


class Kind(NamedTuple):
    name: str
    pattern: re.Pattern
    valid: Callable[[str], bool]
    prior: float
    sure: bool
    needs: str  # a text without this character has no such span; empty: any text may
    context: re.Pattern | None
    before: str = ""  # characters before the match that belong to the span, back to the end of the one before
    group: int = 0  # the group of the pattern that is the span
    after: re.Pattern | None = None  # what must stand right before the match, within ``NEARBY`` characters
    shorter: Callable[[str], int] | None = None  # where the span within a match ends; 0: there is none


def _matches(kind: Kind, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches in time linear in the text, runs of any length included."""
    free = 0
    for m in kind.pattern.finditer(text):
        if kind.after is not None and not kind.after.search(text[max(0, m.start() - NEARBY) : m.start()]):
            continue
        start, end = m.span(kind.group)
        if kind.shorter is not None:
            end = start + kind.shorter(text[start:end])
            if end == start:
                continue
        if kind.before:
            start = free + len(text[free:start].rstrip(kind.before))
            free = m.start() + 1  # no span reaches back over the character that begins the match, and no text is looked at twice
            if start == m.start():
                continue
        yield start, end
        free = end


_LETTERS_DIGITS = string.ascii_letters + string.digits


def _words(words: str) -> re.Pattern:
    return re.compile(rf"\b(?:{words.replace(' ', '|')})\b", re.IGNORECASE)


KINDS = [
    Kind("email", re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), lambda s: True, 0.95, True, "@", _words("mail email e-mail contact correo"), _LETTERS_DIGITS + "._%+-"),
    Kind("ip", re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in s.split(".")), 0.7, True, ".", _words("ip address host server login adresse")),
    Kind("card", re.compile(r"[0-9]([ -]?[0-9])+"), _card, 0.8, True, "", _words("card visa mastercard credit karte carte tarjeta")),
    Kind("phone", re.compile(r"\+[0-9][ ().0-9-]+[0-9]"), lambda s: 8 <= len(_digits(s)) <= 15, 0.8, True, "+", _words("phone tel call fax mobile telefon")),
    Kind("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), mod97, 0.9, False, "", _words("iban account bank konto compte cuenta"), shorter=account_end),
    Kind("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _social, 0.45, False, "-", _words("ssn social security")),
    Kind("local_phone", re.compile(r"(?<![0-9+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"), lambda s: True, 0.35, False, "", _words("phone tel call fax mobile telefon")),
    Kind("secret", re.compile(r"""["']?\s{0,4}[=:]\s{0,4}["']?([A-Za-z0-9_+/.~-]{12,}={0,2})"""), _secret, 0.6, False, "", _words("key token secret password credentials auth config"),
         group=1, after=re.compile(r"(?i)(?:api[_-]?key|access[_-]?key|private[_-]?key|token|secret|passwd|password)$")),
]
_AGAINST = _words("order invoice version isbn part serial")
_DIGIT = re.compile("[0-9]")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def find_spans(text: str | None) -> list[Span]:
    """All confirmed spans, by kind in the order of ``KINDS``, then by start."""
    if not text:
        return []
    has_digit = _DIGIT.search(text) is not None
    found: list[Span] = []
    for kind in KINDS:
        if (kind.needs and kind.needs not in text) or (kind.name != "email" and not has_digit):
            continue
        for start, end in _matches(kind, text):
            if not kind.valid(text[start:end]):
                continue
            if kind.name == "local_phone" and any(s.start < end and start < s.end for s in found):
                continue
            near = f"{text[max(0, start - NEARBY):start]} {text[end:end + NEARBY]}"
            score = kind.prior
            if kind.context is not None and kind.context.search(near):
                score += 0.3
            if _AGAINST.search(near):
                score -= 0.2
            score = min(1.0, max(0.0, score))
            if kind.sure or score >= LEAST_SCORE:
                found.append(Span(kind.name, start, end, round(score, 2)))
    return found


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) reduced to doc_id and ``spans``: kind, start, end and score of each, in the order of ``find_spans``."""
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[s._asdict() for s in find_spans(x.as_py())] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, f"doc_id long, spans {SPANS}")


BASE = ["email", "ip", "card", "phone"]


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents: counts of the base kinds, a digest of the base spans, all spans as text, and how many they are."""
    found = with_spans(read_documents(spark, sf_dir))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(BASE))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


QUERIES = {"op9_personal_data": (op9_personal_data, None)}
