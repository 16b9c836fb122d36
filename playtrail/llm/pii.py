"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

The kinds email, ip, card and phone are found by their plain patterns and always stay. The method adds kinds that only a
checksum or a word nearby makes likely: iban (mod 97), ssn, tel (a number without country code) and card_part (a valid
card number inside a longer run of digits). A span is (kind, start, end, score), in code points, end exclusive.
Patterns are anchored where a match can only begin, which finds the same spans in linear time.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, small_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "tel", "card_part")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TEL = re.compile(r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
# What a proposal scores alone, what a checksum adds, and words within NEAR characters that raise or lower it.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.4, "phone": 0.7, "iban": 0.4, "ssn": 0.3, "tel": 0.3, "card_part": 0.2}
CHECKED = {"card": 0.4, "iban": 0.5, "card_part": 0.2}
NEAR, THRESHOLD = 40, 0.5
RAISE = {"email": ("mail", "contact"), "ip": ("ip", "address", "host", "server"), "card": ("card", "visa", "credit", "payment"),
         "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social"),
         "tel": ("phone", "tel", "call", "mobile", "fax"), "card_part": ("card", "visa", "credit", "payment")}
LOWER = {"ip": ("version", "release", "section"), "card": ("order", "isbn", "serial"), "card_part": ("order", "isbn", "serial"),
         "ssn": ("order", "part", "serial"), "tel": ("order", "part", "serial")}
NEARBY = re.compile(r"[A-Za-z]+")


def luhn(digits: str) -> bool:
    """The check digit rule of card numbers."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The check of account numbers: first four characters last, letters as 10 to 35, remainder 1."""
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    """Local part, @ and a dotted domain; the part before an @ never reaches into the match before it."""
    end = 0
    for match in DOMAIN.finditer(text):
        start = at = match.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = match.end()
            yield start, end


def ips(text: str):
    for match in IP.finditer(text):
        parts = (p.lstrip("0") for p in match.group().split("."))
        if all(len(p) < 3 or len(p) == 3 and int(p) <= 255 for p in parts):
            yield match.span()


def cards(text: str, parts: bool):
    """Valid numbers of 13 to 19 digits, or, of runs that are none, the valid ones of whole digit groups and the run."""
    for match in CARD.finditer(text):
        digits = only_digits(match.group())
        valid = 13 <= len(digits) <= 19 and luhn(digits)
        if valid and not parts:
            yield match.span()
        elif parts and not valid and len(digits) > 13:
            for start, end in within(match.group()):
                yield match.start() + start, match.start() + end, *match.span()


def within(run: str) -> list[tuple[int, int]]:
    """Of a run of digit groups, the valid numbers of whole groups that have the most digits together, none overlapping."""
    groups = [m.span() for m in re.finditer("[0-9]+", run)]
    best = [(0, 0)] * (len(groups) + 1)  # from each group on: digits of the numbers, groups of the first (0: no number begins here)
    for i in range(len(groups) - 1, -1, -1):
        best[i], number = (best[i + 1][0], 0), ""
        for j in range(i, len(groups)):
            a, b = groups[j]
            if len(number) + b - a > 19:
                break
            number += run[a:b]
            if len(number) >= 13 and len(number) + best[j + 1][0] >= best[i][0] and luhn(number):
                best[i] = (len(number) + best[j + 1][0], j + 1 - i)
    found, i = [], 0
    while i < len(groups):
        if best[i][1]:
            found.append((groups[i][0], groups[i + best[i][1] - 1][1]))
        i += best[i][1] or 1
    return found


def phones(text: str):
    for match in PHONE.finditer(text):
        if 9 <= len(only_digits(match.group())) <= 15:
            yield match.span()


def ibans(text: str):
    """Account numbers whose checksum holds, cut back at spaces where words in capitals or another number follow.

    The search goes on behind a number, or at the next group of a match that holds none.
    """
    match = IBAN.search(text)
    while match:
        found, at = match.group(), match.start()
        behind = at + found.find(" ") + 1 if " " in found else match.end()
        while found:
            if mod97(found):
                behind = at + len(found)
                yield at, behind
                break
            found = found[:found.rfind(" ")] if " " in found else ""
        match = IBAN.search(text, behind)


def scored(kind: str, text: str, start: int, end: int) -> float:
    """The prior, the checksum's part, and 0.3 for words nearby that speak for or against the kind."""
    around = {w.lower() for w in NEARBY.findall(text[max(0, start - NEAR):start] + "\n" + text[end:end + NEAR])}
    score = PRIOR[kind] + CHECKED.get(kind, 0)
    score += 0.3 * (not around.isdisjoint(RAISE[kind])) - 0.3 * (not around.isdisjoint(LOWER.get(kind, ())))
    return round(min(1.0, max(0.0, score)), 3)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans of a text, by kind in the order of KINDS, then by start. Base kinds stay whatever their score."""
    if not text:
        return []
    digits = len(text.encode("utf-8", "surrogatepass").translate(None, NOT_DIGIT))
    proposed = {"email": emails(text) if "@" in text else (), "phone": phones(text) if "+" in text and digits >= 9 else (),
                "ip": ips(text) if digits >= 4 else (), "card": cards(text, False) if digits >= 13 else (),
                "iban": ibans(text) if digits >= 2 else (), "card_part": cards(text, True) if digits > 13 else (),
                "ssn": ((m.span()) for m in SSN.finditer(text)) if digits >= 9 else (),
                "tel": ((m.span()) for m in TEL.finditer(text)) if digits >= 10 else ()}
    spans = []
    for kind in KINDS:
        for start, end, *run in proposed[kind]:
            score = scored(kind, text, *(run or (start, end)))  # the words near a run stand beside each of its numbers
            if kind in BASE or score >= THRESHOLD:
                spans.append((kind, start, end, score))
    return spans


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def redacted(text: str | None, spans) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its kind in capitals and brackets."""
    out, at, reach = [], 0, -1
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= reach:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = reach = max(reach, end)
    return "".join([*out, text[at:]]) if out else text


FOUND = ("doc_id {key}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
         "found array<struct<kind:string,start:int,end:int,score:double>>")


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key as doc_id, counts per base kind, a digest of base spans, and all spans with scores.

    Null and empty texts have no spans; their digest is that of the empty string. Repeated rows and null keys are kept.
    Other columns are not read. Texts are searched whole, whatever their length.
    """
    def run(batches):
        for batch in batches:
            rows = []
            for doc, value in zip(pieces(batch.column(0)), pieces(batch.column(1))):
                spans = find(value)
                base = [s for s in spans if s[0] in BASE]
                rows.append({"doc_id": doc, **{f"n_{k}": sum(s[0] == k for s in base) for k in BASE},
                             "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans),
                             "found": [dict(zip(("kind", "start", "end", "score"), s)) for s in spans]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kind = docs.schema[key].dataType.simpleString()
    shape = FOUND.format(key=kind)
    schema = pa.schema([("doc_id", pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()),
                        *[(f"n_{k}", pa.int64()) for k in BASE], ("base_sha256", pa.string()), ("spans", pa.string()),
                        ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                                      ("score", pa.float64())])))])
    return small_batches(docs).select(key, text).mapInArrow(run, shape)


def redact(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The same rows and columns with all spans of the text replaced; a column `length` follows the new text.

    Rows without spans come back as they are, null texts stay null.
    """
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new, sizes, changed = [], [], False
            old = pieces(batch.column(counted)) if counted >= 0 else iter(lambda: None, 0)
            for value, size in zip(pieces(batch.column(at)), old):
                spans = find(value)
                changed |= bool(spans)
                new.append(redacted(value, spans))
                sizes.append(len(new[-1]) if spans else size)
            if changed:
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
                if counted >= 0:
                    field = batch.schema.field(counted)
                    batch = batch.set_column(counted, field, pa.array(sizes, field.type))
            yield batch

    counted = docs.columns.index(length) if length in docs.columns else -1
    return small_batches(docs).mapInArrow(run, docs.schema)
