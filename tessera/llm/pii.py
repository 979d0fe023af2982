"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Two layers. The base spans are what one pattern per kind finds from the left (email, ip, card, phone)
and its check passes: they always stay. The method's own proposals are wider patterns (spelt-out
addresses, version 6 addresses, cards inside longer runs of digits, national phone numbers, IBANs);
each starts from its pattern's prior, is confirmed by a validator where its kind has one (Luhn for
cards, mod-97 for IBANs, the address rules for version 6), and is raised or lowered by the words
around it. Proposals whose score reaches ``THRESHOLD`` are added, unless a better span or a base span
of the same kind covers some of the same text.

All patterns run in time linear in the text: what could start at any place of a long run of digits or
letters starts only where the run does. A text is one row of one pass without a shuffle.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import text_column

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
THRESHOLD = 0.6
BEFORE, AFTER = 48, 24  # characters of context
CONFIRMED, REFUTED, NEARBY, AGAINST = 0.35, -1.0, 0.25, -0.3  # what a validator and context words add

# ---- fixed values: the base patterns, context words, issuers, IBAN lengths ------------------------
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

CONTEXT = {
    "email": "email mail e-mail contact write correo courriel adresse address",
    "ip": "ip ipv6 ipv4 host server address adresse login from gateway dns",
    "card": "card credit debit visa mastercard amex payment pay carte tarjeta karte kreditkarte cvv cvc expires",
    "phone": "phone tel telephone call mobile cell fax sms whatsapp telefon teléfono téléphone handy anruf appeler llamar",
    "iban": "iban account bank konto bic swift cuenta compte transfer",
}
COUNTER = {
    "ip": "version section chapter release std namespace",
    "card": "isbn order serial tracking timestamp sku",
    "phone": "isbn order serial version invoice pages page",
}
ISSUER = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|35|36|38|6011|64[4-9]|65|62")
IBAN_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31,
    "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "TR": 26,
}

# wider proposals: kind, pattern, prior
SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[\x20]?[\[({<][\x20]?(?:at|AT|@)[\x20]?[\])}>][\x20]?"
    r"[A-Za-z0-9-]{1,63}(?:[\x20]?(?:\.|[\[({<][\x20]?(?:dot|DOT|\.)[\x20]?[\])}>])[\x20]?[A-Za-z0-9-]{1,63}){1,8}"
)
IP6 = re.compile(r"(?<![\w:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f]*:)[0-9A-Fa-f:]{3,39}(?![\w:])")
DIGITS = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<s>[\x20. -])[0-9]{4}(?P=s)[0-9]{4}(?P=s)[0-9]{4}|[0-9]{4}[\x20. -][0-9]{6}[\x20. -][0-9]{5})(?![0-9])")
NATIONAL = re.compile(r"(?<![\w.+-])(?:00[1-9][0-9]{0,2}[\x20./-]?)?(?:\([0-9]{2,5}\)[\x20]?|[0-9]{2,5}[\x20./-])[0-9]{3,4}[\x20./-]?[0-9]{3,5}(?![\w-]|\.[0-9])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}")
WORDS = re.compile(r"[^\W_]+(?:-[^\W_]+)*")

_LISTS = {k: frozenset(v.split()) for k, v in CONTEXT.items()}
_COUNTERS = {k: frozenset(v.split()) for k, v in COUNTER.items()}
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)  # a doubled digit's digit sum


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    d = [ord(c) - 48 for c in reversed(digits)]
    return (sum(d[::2]) + sum([_DOUBLED[x] for x in d[1::2]])) % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without blanks leaves remainder 1, letters read as two-digit numbers."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = int(c, 36)
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _bare(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


# ---- base spans ----------------------------------------------------------------------------------


def base_emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` from the left. The pattern is
    tried once per ``@``: its local part is the run of such characters before it, from the last match on."""
    out, end, at, start = [], 0, text.find("@"), 0
    while at >= 0:
        head = text[start:at]
        first = start + len(head.rstrip(LOCAL))
        if first < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((first, end))
        start = max(at + 1, end)
        at = text.find("@", start)
    return out


def base_ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(len(p := g.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for g in m.groups())]


def base_cards(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CARD.finditer(text) if 16 <= len(d := _bare(m[0])) <= 19 and luhn(d)]


def base_phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(_bare(m[0])) <= 15]


# ---- proposals -----------------------------------------------------------------------------------


def _iban_end(text: str, start: int, end: int) -> int:
    """Where an IBAN that starts here ends, by its country's length (unknown: as far as the pattern
    went); -1 if it is shorter, or goes on without a break."""
    need = IBAN_LENGTH.get(text[start : start + 2])
    if need is None:
        return end
    at, n = start, 0
    while at < end and n < need:
        n += text[at] != " "
        at += 1
    return at if n == need and not text[at : at + 1].isalnum() else -1


def proposals(text: str, has_digit: bool) -> Iterator[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` before context: the pattern's prior and the validator's say."""
    if "at" in text or "AT" in text or "@" in text:
        for m in SPELT.finditer(text):
            yield "email", *m.span(), 0.65
    if ":" in text:
        for m in IP6.finditer(text):
            try:
                ipaddress.IPv6Address(m[0])
            except ValueError:
                continue
            yield "ip", *m.span(), 0.25 + CONFIRMED * (m[0].count(":") > 3)
    if not has_digit:
        return
    for m in DIGITS.finditer(text):
        d = _bare(m[0])
        yield "card", *m.span(), 0.1 + 0.2 * bool(ISSUER.match(d)) + (CONFIRMED if luhn(d) else REFUTED)
    for m in NATIONAL.finditer(text):
        if 8 <= len(_bare(m[0])) <= 15:
            yield "phone", *m.span(), 0.4 + 0.1 * (m[0][0] == "(") + 0.1 * m[0].startswith("00")
    for m in IBAN.finditer(text):
        end = _iban_end(text, *m.span())
        if end > 0:
            bare = text[m.start() : end].replace(" ", "")
            yield "iban", m.start(), end, 0.4 + (CONFIRMED if mod97(bare) else REFUTED)


def context(text: str, kind: str, start: int, end: int) -> float:
    """What the words around a span add for its kind."""
    near = text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]
    words = {w.lower() for w in WORDS.findall(near)}
    return NEARBY * (not words.isdisjoint(_LISTS[kind])) + AGAINST * (not words.isdisjoint(_COUNTERS.get(kind, ())))


def spans(text: str) -> list[tuple[str, int, int, float, bool]]:
    """``(kind, start, end, score, base)`` of a text, by kind as in ``KINDS``, then start; positions are
    code points, ends exclusive. Scores of base spans are at least ``THRESHOLD``."""
    has_digit = any(d in text for d in "0123456789")
    base = [("email", *s) for s in base_emails(text)]
    if has_digit:
        base += [("ip", *s) for s in base_ips(text)] + [("card", *s) for s in base_cards(text)] + [("phone", *s) for s in base_phones(text)]
    sure = {"email": 0.75, "ip": THRESHOLD, "card": 0.1 + CONFIRMED + 0.2, "phone": THRESHOLD}
    out = [(k, a, b, min(1.0, max(THRESHOLD, sure[k] + context(text, k, a, b))), True) for k, a, b in base]
    taken = sorted((a, b, k, score) for k, a, b, score, _ in out)
    added = []
    for k, a, b, prior in proposals(text, has_digit):
        if prior + NEARBY >= THRESHOLD and (score := prior + context(text, k, a, b)) >= THRESHOLD:
            added.append((-min(1.0, score), a, -b, KINDS.index(k)))
    if added:
        covered = Cover([(a, b, k, score) for a, b, k, score in taken])
        for score, a, b, k in sorted(added):
            if covered.allows(a, -b, KINDS[k], -score):
                covered.add(a, -b, KINDS[k], -score)
                out.append((KINDS[k], a, -b, -score, False))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


class Cover:
    """Spans taken so far, by stretches of ``WIDE`` characters, so that a text of many spans isn't
    searched from end to end for each; a span is entered in each stretch it meets."""

    WIDE = 256

    def __init__(self, spans_: list[tuple[int, int, str, float]]):
        self.at: dict[int, list[tuple[int, int, str, float]]] = {}
        for s in spans_:
            self.add(*s)

    def add(self, a: int, b: int, kind: str, score: float) -> None:
        for i in range(a // self.WIDE, b // self.WIDE + 1):
            self.at.setdefault(i, []).append((a, b, kind, score))

    def allows(self, a: int, b: int, kind: str, score: float) -> bool:
        """No span of the same kind, and no other with at least this score, meets [a, b)."""
        return not any(
            x < b and a < y and (k == kind or s >= score) for i in range(a // self.WIDE, b // self.WIDE + 1) for x, y, k, s in self.at.get(i, ())
        )


# ---- on Spark ------------------------------------------------------------------------------------

SPANS = "array<struct<kind string, start int, end int, score double, base boolean>>"


def find_spans(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: bool = False) -> DataFrame:
    """``(*keys, spans)`` per row, with the ``text`` if asked: an array of (kind, start, end, score, base).

    A null text is an empty one and has no spans, as has a text without personal data; rows are
    independent, so repeated rows repeat their spans, whatever other columns there are (only the keys
    and the text are read); an empty table gives an empty result. Texts of any length are searched as a
    whole, in linear time; a worker holds an Arrow batch of them.
    """
    source = documents.select(*keys, text_column(documents).alias("_text"))
    fields = [f"`{k}` {source.schema[k].dataType.simpleString()}" for k in keys]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[[*keys]].copy()
            if text:
                out["text"] = pdf["_text"]
            out["spans"] = [[dict(zip(("kind", "start", "end", "score", "base"), s)) for s in spans(t)] for t in pdf["_text"]]
            yield out

    return source.mapInPandas(run, ", ".join([*fields, *["text string"] * text, f"spans {SPANS}"]))


def joined(found: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined; no span: the empty string."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summaries(found: DataFrame) -> DataFrame:
    """Counts and digests of what ``find_spans`` returned: ``n_<kind>`` counts base spans, ``n_added``
    the others; ``base_sha256`` is the digest of the base spans, ``spans`` lists all."""
    base = F.filter("spans", lambda s: s["base"])

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")

    counts = {f"n_{k}": of_kind(k) for k in BASE_KINDS}
    return found.withColumns(
        {
            **counts,
            "n_added": F.size(F.filter("spans", lambda s: ~s["base"])).cast("bigint"),
            "base_sha256": F.sha2(joined(base).cast("binary"), 256),
            "spans": joined(F.col("spans")),
        }
    )


def redact(documents: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``(*keys, text)`` with each span replaced by its kind in angle brackets; of spans that overlap the
    first one's kind stands for all. Null texts come back empty."""
    found = find_spans(documents, keys, text=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[[*keys]].copy()
            texts = []
            for t, ss in zip(pdf["text"], pdf["spans"]):
                parts, at = [], 0
                for a, b, kind in sorted((s["start"], s["end"], s["kind"]) for s in ss):
                    if a >= at:
                        parts += [t[at:a], f"<{kind}>"]
                    at = max(at, b)
                texts.append("".join([*parts, t[at:]]))
            out["text"] = texts
            yield out

    kinds = [f"`{k}` {found.schema[k].dataType.simpleString()}" for k in keys]
    return found.mapInPandas(run, ", ".join([*kinds, "text string"]))
