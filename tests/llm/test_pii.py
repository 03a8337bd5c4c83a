"""Spans of personal data against plain regular expressions; disclosing terms by counts."""

from __future__ import annotations

import hashlib
import re

from stayspark.llm import pii

SCHEMA = "doc_id bigint, text string, spans string, kind int"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None,
    "",
    "mail a.b+c@x-y.example.org, d@e.fg; bad@host and _x@y.z_x@y.zz @q.r",
    "1.2.3.4.5.6.7.8 256.1.1.1 000255.0.0.1 99.99.99.9999999999999999999999 1..2.3.4 10.20.30.40",
    "cards 4785380592391139 4111 1111 1111 1111 4111-1111-1111-1112 0000 0000 0000 00 1-2-3 12345678901234567890",
    "+1 (555) 010-9999 +49.30.1234567 +1-2 +12345678901234567 é +33 1 23 45 67 89. x",
    "é😀 4111111111111111 😀a@b.cd +4930123456789",
    "9" * 30000,
    "1 " * 20000 + "a@b.cc",
    "a@b.cc " * 400,
]


def by_hand(text):
    text, spans = text or "", []
    for rank, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            v = m[0]
            digits = re.sub("[^0-9]", "", v)
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or 0) > 255 for p in v.split(".")):
                continue
            if kind == "card":
                total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), rank, m.end(), kind))
    return sorted(spans)


def test_base_spans(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "a@b.cc", "x", 1), (2, TEXTS[2], "x", 1)], SCHEMA)
    rows = pii.summary(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        spans = by_hand(TEXTS[r.doc_id] if r.doc_id is not None else "a@b.cc")
        said = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[3] == k for s in spans) for k in RULES]
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and s.split(":")[0] in RULES] == [s for s in said.split(",") if s]


def test_disclosing_terms(spark):
    """A name that stands only by one address is taken out everywhere; common words and rare ones stay."""
    rows = [(i, f"note {i} from Quintessa, write to q@corp.example.com about the number {'abcdefghij'[i]}", "", 0) for i in range(6)]
    rows += [(100 + i, f"the number of things to write about is {i} and not more from word{i}", "", 0) for i in range(200)]
    rows += [(400, "Quintessa was here; quintessa's was not", "", 0), (401, "unseen@else.example.org beside Hapax", "", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    spans = {r.doc_id: r.spans for r in pii.summary(docs).collect()}
    for i in range(6):
        text = rows[i][1]
        at = text.index("Quintessa")
        assert spans[i] == f"generalise:{at}:{at + 9},email:{text.index('q@')}:{text.index('q@') + 18}"
    assert spans[400] == "generalise:0:9" and spans[401] == "email:0:23"
    assert all(spans[100 + i] == "" for i in range(200))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == "note 0 from [term], write to [email] about the number a"
    assert clean[400] == "[term] was here; quintessa's was not" and clean[150] == rows[56][1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert pii.summary(docs).count() == 0 and pii.sanitise(docs).count() == 0
