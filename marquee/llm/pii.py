"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton over a text finds the anchors: at-signs, plus
signs, digits, address schemes and identifier cues. Around each anchor a small
deterministic parser expands to the left and right, fixes the boundaries and
validates what it has found; nothing else of the text is looked at. The parsers keep
to the spot where the last one of their kind ended, so the work is linear in the text.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Kinds with a fixed grammar, and those that schemes and cues add, in the order of the results.
BASE, ADDED = ("email", "ip", "card", "phone"), ("address", "account")
KINDS = BASE + ADDED

# Anchors of the automaton.
SCHEMES = ("mailto:", "sip:", "sips:", "xmpp:", "tel:", "://")
CUES = {"iban": "iban", "ssn": "ssn", "social security": "ssn", "account": "number", "acct": "number", "konto": "number", "cuenta": "number",
        "passport": "passport"}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_ADDR = re.compile(r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_TEL = re.compile(r"\+?[0-9](?:[().-]?[0-9])+")
_USER = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s@/?#]*)?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
_V6 = re.compile(r"\[([0-9A-Fa-f:.]{2,45})\]")
_SCHEME = "abcdefghijklmnopqrstuvwxyz0123456789+.-"
#: What may stand between a cue and the identifier.
_GAP = re.compile(r"(?: (?:number|num|no|nr|id))?\.?[ :=#]{0,4}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?!000|666|9)[0-9]{3}([ -])(?!00)[0-9]{2}\1(?!0000)[0-9]{4}(?![0-9])")
_PASSPORT = re.compile(r"[A-Z]{0,2}[0-9]{6,9}(?![A-Za-z0-9])")


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for what, words in (("at", "@"), ("plus", "+"), ("digit", "0123456789"), ("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            found.add_word(word, (what, word))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """The check digit of a card number holds."""
    total = sum(map(int, digits[-1::-2])) + sum(x * 2 - 9 * (x > 4) for x in map(int, digits[-2::-2]))
    return total % 10 == 0


def _iban_end(found: str) -> int:
    """Length of the longest start of ``found`` that ends before a space or at its end and has the right remainder; 0 if none."""
    ends = [len(found), *(i for i in range(len(found) - 1, 0, -1) if found[i] == " ")]
    for end in ends:
        plain = found[:end].replace(" ", "")
        if 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return end
    return 0


def _scheme_address(text: str, low: str, start: int, scheme: str) -> tuple[int, int] | None:
    """Span of the personal address around a scheme: a mail, chat or phone address, a URL with a user or a bare IPv6 host."""
    after = start + len(scheme)
    if scheme == "://":
        begin = start - 16 + len(low[max(0, start - 16):start].rjust(16).rstrip(_SCHEME))
        if begin == start:
            return None
        if m := _USER.match(text, after):
            return begin, m.end()
        if m := _V6.match(text, after):
            try:
                ipaddress.IPv6Address(m[1])
            except ValueError:
                return None
            return begin, m.end()
        return None
    if start and low[start - 1].isalnum():
        return None
    m = (_TEL if scheme == "tel:" else _ADDR).match(text, after)
    if not m or scheme == "tel:" and not 7 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
        return None
    return start, m.end()


def _cued_account(text: str, low: str, start: int, cue: str) -> tuple[int, int] | None:
    """Span of a valid account identifier that follows a cue."""
    end = start + len(cue)
    if start and low[start - 1].isalnum() or low[end:end + 1].isalpha():
        return None
    at = _GAP.match(text, end).end()
    kind = CUES[cue]
    if kind == "iban":
        m = _IBAN.match(text, at)
        size = _iban_end(m[0]) if m else 0
        return (at, at + size) if size else None
    if kind == "number":
        m = _DIGITS.match(text, at)
        return (at, m.end()) if m and 6 <= len(_NOT_DIGIT.sub("", m[0])) <= 18 else None
    m = (_SSN if kind == "ssn" else _PASSPORT).match(text, at)
    return (at, m.end()) if m else None


def find_spans(text: str, automaton=None) -> dict[str, list[tuple[int, int]]]:
    """Spans of every kind in code points, end exclusive, in order of their starts.

    email, ip, card and phone are exactly the leftmost matches, one after another, of their grammars; a match that
    fails its check (parts over 255, digits, Luhn) is left out and not tried again.
    """
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    low = text.encode().lower().decode()        # A-Z only, so places stay
    at_done = dotted_done = digits_done = 0
    for last, (what, word) in (automaton or _automaton()).iter(low):
        start = last - len(word) + 1
        if what == "digit":
            if start >= dotted_done:            # a chain of numbers with dots, in fours
                dotted_done = _DOTTED.match(text, start).end()
                parts, a = text[start:dotted_done].split("."), start
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k:k + 4]
                    b = a + sum(map(len, four)) + 3
                    if all(len(x) <= 3 and int(x) <= 255 or len(z := x.lstrip("0")) <= 3 and int(z or 0) <= 255 for x in four):
                        spans["ip"].append((a, b))
                    a = b + 1
            if start >= digits_done:            # a chain of digits with single spaces or hyphens
                digits_done = _DIGITS.match(text, start).end()
                if 16 <= digits_done - start:
                    digits = _NOT_DIGIT.sub("", text[start:digits_done])
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append((start, digits_done))
        elif what == "plus":
            if (m := _PHONE.match(text, start)) and 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans["phone"].append((start, m.end()))
        elif what == "at":
            name = at_done + len(text[at_done:start].rstrip(_LOCAL))
            if name < start and (m := _DOMAIN.match(text, start + 1)):
                spans["email"].append((name, m.end()))
                at_done = m.end()
            else:
                at_done = start + 1
        else:
            found = (_scheme_address if what == "scheme" else _cued_account)(text, low, start, word)
            kind = ADDED[what == "cue"]
            if found and (not spans[kind] or spans[kind][-1][1] <= found[0]):
                spans[kind].append(found)
    return spans


def _listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row of ``docs``.

    The counts and base_sha256 (of kind:start:end, by kind, then start, joined by commas) cover the kinds with a fixed
    grammar; spans lists these and then the addresses and accounts that schemes and cues add, n_added in number, which
    may overlap base spans. Null and empty texts have no spans, and so the hash of the empty text; texts of any length
    are scanned whole; every row is judged by itself, so repeated rows and null ids stay; an empty table gives an empty
    result. Other columns aren't read.
    """
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string"))
    id_type = rows.schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        names = [key, *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"]
        types = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.int64())
        for batch in batches:
            out = []
            for x in batch.column(1):
                found = find_spans(x.as_py() or "", automaton)
                base = hashlib.sha256(_listed(found, BASE).encode()).hexdigest()
                out.append((*(len(found[k]) for k in BASE), base, _listed(found, KINDS), sum(len(found[k]) for k in ADDED)))
            cols = zip(*out, strict=True) if out else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names)

    counts = ", ".join(f"n_{k} long" for k in BASE)
    return rows.mapInArrow(scan, f"`{key}` {id_type}, {counts}, base_sha256 string, spans string, n_added long")


def redact(text: str | None, spans: dict[str, list[tuple[int, int]]] | None = None) -> str | None:
    """``text`` with every span, or group of overlapping spans, replaced by the name of its first kind in brackets."""
    if not text:
        return text
    found = spans or find_spans(text)
    out, done = [], 0
    for a, order, b in sorted((a, KINDS.index(k), b) for k in KINDS for a, b in found[k]):
        if a >= done:
            out += [text[done:a], f"[{KINDS[order]}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs``, all columns, with personal data in ``text`` replaced by its kind; null stays null."""
    i = docs.columns.index(text)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            new = [redact(x, find_spans(x, automaton)) if x else x for x in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))

    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])      # names may hold dots
    return numbered.mapInArrow(replace, numbered.schema).toDF(*docs.columns)
