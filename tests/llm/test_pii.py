from __future__ import annotations

import hashlib
import random
import re

import pytest

from marquee.llm.pii import KINDS, find_personal_data, find_spans, luhn, redact, redact_documents
from marquee.llm.queries import op13_personal_data
from tests.conftest import SF_SMALL

GRAMMAR = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The grammar, run over the whole text."""
    out = {}
    for kind, pattern in GRAMMAR.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and total % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out[kind].append(m.span())
    return out


def base_hash(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in GRAMMAR for a, b in spans[k]).encode()).hexdigest()


@pytest.mark.parametrize("alphabet", ["0123.", "a1@.-+ ", "+1 ()-.", "45 -", "aé@.漢%", "0012589.- +@a"])
def test_base_spans_equal_the_grammar(alphabet):
    rng = random.Random(alphabet)
    for _ in range(1500):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        found = find_spans(text)
        assert {k: found[k] for k in GRAMMAR} == plain(text), text


def test_cards_in_all_writings():
    rng = random.Random(3)
    for _ in range(300):
        body = "".join(rng.choices("0123456789", k=rng.randint(14, 19)))
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        text = "x" + "".join(c + rng.choice(["", "", " ", "-"]) for c in digits).rstrip(" -") + "é"
        assert find_spans(text)["card"] == plain(text)["card"] == ([(1, len(text) - 1)] if 16 <= len(digits) <= 19 else [])


@pytest.mark.parametrize("text,kind,found", [
    ("write to mailto:a.b@c.org now", "address", "mailto:a.b@c.org"),
    ("call tel:+44-20-7946-0958.", "address", "tel:+44-20-7946-0958"),
    ("hotel:1234567 tel:12", "address", None),
    ("see https://bob:secret@host.example:8080/x", "address", "https://bob:secret@host.example:8080"),
    ("see https://host.example/x@y", "address", None),
    ("at http://[2001:db8::1]/a", "address", "http://[2001:db8::1]"),
    ("at http://[2001:zz::1]/a", "address", None),
    ("IBAN: DE89 3704 0044 0532 0130 00 ALSO", "account", "DE89 3704 0044 0532 0130 00"),
    ("iban DE88370400440532013000", "account", None),
    ("SSN 123-45-6789", "account", "123-45-6789"),
    ("SSN 666-45-6789", "account", None),
    ("Account no. 1234-5678-90 here", "account", "1234-5678-90"),
    ("accounts 1234567890", "account", None),
    ("account 12", "account", None),
    ("passport number X1234567, issued", "account", "X1234567"),
    ("passport number XY1234567, issued", "account", "XY1234567"),
])
def test_schemes_and_cues(text, kind, found):
    assert [text[a:b] for a, b in find_spans(text)[kind]] == ([found] if found else [])


def test_redaction():
    assert redact("a@b.c or mailto:d@e.f!") == "[email] or [address]!"
    assert redact("nothing") == "nothing" and redact("") == "" and redact(None) is None


def test_cases(spark, awkward, make_docs):
    assert find_personal_data(awkward.limit(0)).count() == 0
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = find_personal_data(awkward).collect()
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == sorted((str(d), base_hash(plain(t or ""))) for d, t in rows)
    docs = make_docs([(1, "x a@b.co"), (1, "x a@b.co"), (None, "+1 (203) 555-8282"), (2, None), (3, "1" * 50_000 + " 1.2.3.4" + "@" * 20_000)])
    got = sorted(find_personal_data(docs).collect(), key=lambda r: (str(r.doc_id), r.spans))
    assert [(r.doc_id, r.n_email, r.n_ip, r.n_phone, r.spans) for r in got] == [
        (1, 1, 0, 0, "email:2:8"), (1, 1, 0, 0, "email:2:8"), (2, 0, 0, 0, ""), (3, 0, 1, 0, "ip:50001:50008"), (None, 0, 0, 1, "phone:0:17")]
    assert redact_documents(docs).columns == docs.columns
    assert {r.text for r in redact_documents(docs).where("doc_id < 3").collect()} == {"x [email]", None}


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op13_personal_data(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r.doc_id])
        assert r.base_sha256 == base_hash(want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in GRAMMAR)
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in GRAMMAR] == [f"{k}:{a}:{b}" for k in GRAMMAR for a, b in want[k]]
        assert set(x.split(":")[0] for x in r.spans.split(",") if x) <= set(KINDS)
