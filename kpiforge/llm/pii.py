"""Personal data and secrets: patterns propose spans, checksums confirm them, and words nearby move a score.

Base kinds are email, ip, card and phone. On top come iban (mod 97), wallet
(base58 with its four check bytes), national_id and secret: keys of known
forms, and values that are assigned to a name. Every span has a score from its
kind, its validator and the whole words near it; of the kinds beyond the base
those below THRESHOLD are left out, so a number in the form of a national_id or
a random value counts only if its neighbours speak for it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import lean

TEXTS, NEAR = 512, 48
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "wallet", "secret")


class Span(NamedTuple):
    """A span in code points, end exclusive."""

    start: int
    order: int
    end: int
    score: float

    @property
    def kind(self) -> str:
        return KINDS[self.order]


def luhn(digits: str) -> bool:
    """Whether the digits' Luhn sum is a multiple of ten."""
    twice = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN's check digits hold: letters count from ten, the first four characters go last."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _ip(text: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in text.split(".")))


def _card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and mod97(plain)


#: The digits of base 58.
_BASE58 = {c: i for i, c in enumerate("123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz")}


def base58check(text: str) -> bool:
    """Whether the last four of 25 bytes in base 58 are the check bytes of the others."""
    if any(c not in _BASE58 for c in text):
        return False
    value = 0
    for c in text:
        value = 58 * value + _BASE58[c]
    if value.bit_length() > 200:
        return False
    raw = value.to_bytes(25, "big")
    return hashlib.sha256(hashlib.sha256(raw[:21]).digest()).digest()[:4] == raw[21:]


def entropy(text: str) -> float:
    """Bits a character, by the text's own characters."""
    return -sum(c / len(text) * math.log2(c / len(text)) for c in Counter(text).values())


def _secret(text: str) -> bool:
    """Random enough for a key: a digit, a letter and three bits a character or more."""
    return any(c.isdigit() for c in text) and any(c.isalpha() for c in text) and entropy(text) >= 3


#: The kinds' patterns. That of ip begins at a run's first digit and never gives digits back, which
#: matches the same as [0-9]+(\.[0-9]+)(\.[0-9]+)(\\.[0-9]+), in a time that is linear in the text.
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "wallet": r"(?<![A-Za-z0-9])[13][1-9A-HJ-NP-Za-km-z]{25,33}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|(?<![_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)(?![A-Za-z0-9])"
    r"""|(?<=[=:\x20"'])(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])""",
}
_VALID: dict[str, Callable[[str], bool]] = {
    "email": lambda t: True,
    "ip": _ip,
    "card": _card,
    "phone": lambda t: 10 <= len(_digits(t)) <= 15,
    "iban": _iban,
    "national_id": lambda t: t[:3] not in ("000", "666") and t[0] != "9" and t[4:6] != "00" and t[7:] != "0000",
    "wallet": base58check,
    "secret": _secret,
}
#: Score before context; below THRESHOLD a span of a kind beyond the base is not kept.
_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national_id": 0.4, "wallet": 0.8, "secret": 0.4}
_CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "server", "host"),
    "card": ("card", "credit", "visa", "pay"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account"),
    "national_id": ("ssn", "social", "security", "tax"),
    "wallet": ("bitcoin", "btc", "wallet", "address"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "credential", "credentials", "bearer", "authorization", "key", "apikey", "api_key", "access_key", "private_key", "secret_key", "client_secret", "access_token", "auth_token"),
}
_AGAINST = ("version", "isbn", "example", "sample", "commit", "checksum", "sha1", "sha256", "md5")
THRESHOLD, STEP = 0.5, 0.2
#: What the form of a key of a known kind adds to a secret's score.
_KNOWN_FORM = re.compile(r"(?:AKIA|ASIA|gh[pousr]_|xox[abprs]-|eyJ)")


def _any_word(words: tuple[str, ...]) -> re.Pattern[str]:
    """Any of some words as a whole, in lower-cased text; parts of an address or a name with dots are none."""
    return re.compile(r"(?<![a-z0-9_.@-])(?:" + "|".join(words) + r")(?![a-z0-9_@-]|\.[a-z0-9])")


_FOR = {kind: _any_word(words) for kind, words in _CONTEXT.items()}
_NOT_FOR = _any_word(_AGAINST)
_COMPILED = {k: re.compile(p) for k, p in _PATTERNS.items()}
_SOME_DIGIT = re.compile("[0-9]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def _iban_end(text: str, start: int, end: int) -> int | None:
    """The last end at which the match holds as an IBAN: its own or, as a word or number may follow, that before a space."""
    while end > start:
        if _iban(text[start:end]):
            return end
        end = text.rfind(" ", start, end)
    return None


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Spans that hold. The next is looked for behind one, and behind the first group of a match that has none."""
    at = 0
    while m := _COMPILED["iban"].search(text, at):
        end = _iban_end(text, *m.span())
        if end is not None:
            yield m.start(), end
        at = end or max(text.find(" ", m.start(), m.end()), 0) or m.end()


def _proposed(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap; of iban, those that hold. An email is looked for from each @, which no other part of it holds."""
    if kind == "iban":
        yield from _ibans(text)
        return
    if kind != "email":
        yield from (m.span() for m in _COMPILED[kind].finditer(text))
        return
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _COMPILED[kind].match(text, start) if start < at else None
        if m:
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def find(text: str | None) -> list[Span]:
    """All confirmed spans of a text, by start and then kind; none for null or empty."""
    if not text:
        return []
    out = []
    digits = _SOME_DIGIT.search(text) is not None
    for order, kind in enumerate(KINDS):
        if kind != "email" and not digits:
            continue
        for start, end in _proposed(kind, text):
            if not _VALID[kind](text[start:end]):
                continue
            score = _score(kind, text, start, end)
            if kind in BASE_KINDS or score >= THRESHOLD:
                out.append(Span(start, order, end, score))
    return sorted(out)


def _score(kind: str, text: str, start: int, end: int) -> float:
    """A confirmed span's score: its kind's, moved by whole words within NEAR characters before and behind it."""
    before = text[max(0, start - NEAR - 1) : start]
    behind = text[end : end + NEAR + 1]
    if len(before) > NEAR:  # a word that the window cuts is none
        before = before[before.find(" ") + 1 :] if " " in before else ""
    if len(behind) > NEAR:
        behind = behind[: max(behind.rfind(" "), 0)]
    near = f"{before}\n{behind}".lower()
    score = _SCORE[kind] + STEP * (_FOR[kind].search(near) is not None) - STEP * (_NOT_FOR.search(near) is not None)
    if kind == "secret" and _KNOWN_FORM.match(text, start):
        score += 2 * STEP
    return round(min(1.0, max(0.0, score)), 6)


def redacted(text: str | None, spans: list[Span] | None = None) -> str | None:
    """The text with <KIND> in place of every span; spans that overlap are one, named by the first."""
    if not text:
        return text
    out, done, name = [], 0, ""
    for span in find(text) if spans is None else spans:
        if span.start >= done:
            out += [text[done : span.start], f"<{span.kind.upper()}>"]
        done = max(done, span.end)
    return "".join(out) + text[done:]


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))
_SPANS_SQL = "array<struct<start:int,end:int,kind:string,score:double>>"


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of each row of docs (doc_id, text); other columns are not looked at; repeated rows stay."""

    @lean
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                part = batch.slice(lo, TEXTS)
                found = [[{"start": s.start, "end": s.end, "kind": s.kind, "score": s.score} for s in find(t)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(make, f"doc_id bigint, spans {_SPANS_SQL}")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """docs, with all its columns and rows, every span in text replaced by its kind, and n_chars, if any, counted anew.

    Null and empty texts stay as they are, repeated rows too; no rows give none.
    """

    @F.pandas_udf("string")
    def clean(text):
        return text.map(redacted, na_action="ignore")

    out = docs.withColumn("text", clean(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def listed(found: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
