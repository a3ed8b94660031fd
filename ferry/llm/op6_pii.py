"""Personal data: regular expressions propose, checksums confirm, context scores.

Four base kinds are always reported when their own check passes: ``email``,
``ip`` (every part at most 255), ``card`` (12 to 19 digits passing Luhn) and
``phone`` (a leading plus and 9 to 15 digits). Two kinds are added:
``iban`` (cut to its country's length, confirmed by mod-97) and ``local_phone``
(a number without a plus, which counts only when words such as "tel" or
"phone" stand close to it). Every span has a score; a checksum and matching
context words, whole words on either side, raise it, and an added span is
reported when its score reaches ``min_score``. A span that a checksum confirms
stays beside whatever it overlaps (the digits of one IBAN in ten are a card
number by Luhn as well); one that only context speaks for gives way to others.

Offsets are code points, end exclusive. Every scan is linear in the text.

Defined results: a null text is an empty one (no spans, the hash of the empty
string); rows are scanned one by one, so repeated rows give repeated rows; a
null id stays null; an empty table gives an empty result; other columns are
ignored. Texts of any length are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map

KINDS = ["email", "ip", "card", "phone", "iban", "local_phone"]
BASE = KINDS[:4]

# The base patterns, as the contract states them. A match of an
# address pattern can only begin where a run of its first class begins, which
# the look-behinds say; they keep the scans linear and change no match.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The added patterns and the words that speak for each kind. An
# IBAN's pattern is its start; its country says how many characters follow.
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}(?=\x20?[A-Z0-9])")
LOCAL_PHONE = re.compile(r"(?<![0-9+./-])\(?0?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}"
                         r"(?![0-9./-])")
# Characters of an IBAN by country, as registered.
IBAN_LENGTH = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 "
    "DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 "
    "IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 "
    "MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
IBAN_REST = {n: re.compile(r"(?:\x20?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (n - 4))
             for n in set(IBAN_LENGTH.values())}
CONTEXT = {kind: re.compile(rf"(?<![^\W_])(?:{words})(?![^\W_])", re.IGNORECASE) for kind, words in {
    "email": "e-?mails?|mail|contact|write to|kontakt|correo|courriel",
    "ip": "ip|ipv4|address|addresses|host|hosts|server|servers",
    "card": "cards?|visa|mastercard|credit|payment|karte|tarjeta|carte",
    "iban": "iban|accounts?|bank|konto|cuenta|compte",
}.items()}
CONTEXT["phone"] = CONTEXT["local_phone"] = re.compile(
    r"(?<![^\W_])(?:tel|telephone|telefon|teléfono|téléphone|phones?|call|calls|mobile|cell|fax|"
    r"handy|móvil)(?![^\W_])", re.IGNORECASE)
# The score of a bare pattern, of a confirmed checksum, of context.
PATTERN_SCORE = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.6, "iban": 0.3,
                 "local_phone": 0.3}
CHECKSUM_BONUS = 0.5
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 40
MIN_SCORE = 0.6


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """``(kind, start, end, checksum_confirmed)`` of every proposal that
    passes its own validator."""
    for s, e in _emails(text):
        yield "email", s, e, False
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-9:]) <= 255 for p in m.groups()):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end(), False
    for m in IBAN.finditer(text):
        rest = m[1] in IBAN_LENGTH and IBAN_REST[IBAN_LENGTH[m[1]]].match(text, m.end())
        if rest and mod97(text[m.start():rest.end()].replace(" ", "")):
            yield "iban", m.start(), rest.end(), True
    for m in LOCAL_PHONE.finditer(text):
        if 7 <= len(_digits(m[0])) <= 13:
            yield "local_phone", m.start(), m.end(), False


def find_spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by start, then kind as listed. A span of
    an added kind without a checksum that overlaps another is dropped."""
    found = []
    for kind, start, end, confirmed in _proposals(text):
        word = CONTEXT[kind].search
        near = (word(text[max(0, start - CONTEXT_CHARS):start])
                or word(text[end:end + CONTEXT_CHARS]))
        score = (PATTERN_SCORE[kind] + CHECKSUM_BONUS * confirmed
                 + CONTEXT_BONUS * (near is not None))
        if kind in BASE or score >= min_score:
            found.append((start, KINDS.index(kind), kind, end, min(1.0, round(score, 2)),
                          confirmed))
    found.sort()
    firm = [(s, e) for s, _, k, e, _, confirmed in found if k in BASE or confirmed]
    out, at, reach, last = [], 0, -1, -1
    for s, _, k, e, score, confirmed in found:
        if k not in BASE and not confirmed:
            while at < len(firm) and firm[at][0] < e:
                reach = max(reach, firm[at][1])
                at += 1
            if reach > s or last > s:
                continue
            last = e
        out.append((k, s, e, score))
    return out


SCHEMA = pa.schema([("id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in BASE]
                   + [("base_sha256", pa.string()), ("spans", pa.string()),
                      ("scores", pa.list_(pa.float64()))])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {f.name: [] for f in SCHEMA}
        for key, text in zip(batch.column(0), batch.column(1), strict=True):
            spans = find_spans(text.as_py() or "")
            mark = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e, _ in xs)
            rows["id"].append(key.as_py())
            for k in BASE:
                rows[f"n_{k}"].append(sum(x[0] == k for x in spans))
            base = mark([x for x in spans if x[0] in BASE])
            rows["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            rows["spans"].append(mark(spans))
            rows["scores"].append([x[3] for x in spans])
        yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts of the base kinds, the digest
    of the base spans, all spans and their scores."""
    out = arrow_map(
        docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.col(f"`{text_col}`").alias("text")),
        _scan, "id long, n_email long, n_ip long, n_card long, n_phone long, "
               "base_sha256 string, spans string, scores array<double>")
    return out.withColumnRenamed("id", id_col)
