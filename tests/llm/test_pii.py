"""Operator 2 against the plain patterns."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tidewatch.llm.pii import luhn, mod97, pii_report, redact, with_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn_ok(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = {"email": list(EMAIL.finditer(text)),
             "ip": [m for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
             "card": [m for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn_ok(digits(m[0]))],
             "phone": [m for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]}
    spans = [f"{k}:{m.start()}:{m.end()}" for k, ms in found.items() for m in ms]
    return (*[len(found[k]) for k in ("email", "ip", "card", "phone")],
            hashlib.sha256(",".join(spans).encode()).hexdigest()), spans


def samples():
    r = random.Random(3)
    bits = ["a.b+c@x-y.co.uk", "a@b", "a@b.c_d@e.f", "@x.y", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.0004",
            "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "5500 0000 0000 0004", "0" * 13, "0" * 20,
            "+49 (30) 123-4567", "+1 2", "+123456789012345678", "+44 20 7946 0958.", "é", "日本", "😀", " ", "\n", ".", "-",
            "12", "7", "x", "GB82 WEST 1234 5698 7654 32", "123-45-6789", "ssn 123-45-6789", "...", "a.b.c@d.e."]
    out = ["".join(r.choice(bits) + r.choice(["", " ", "", ", "]) for _ in range(r.randint(1, 14))) for _ in range(600)]
    return out + [None, "", "9" * 30_000, "a" * 60_000, "1." * 20_000, "a@" + "b." * 20_000 + "c", "+" * 9000 + "1 " * 9000]


def test_base_spans_equal_plain_patterns(spark):
    rows = list(enumerate(samples()))
    got = {r.doc_id: r for r in pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        r = got[d]
        want, spans = base(t)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == want, (t, r.spans, spans)
        own = [s for s in r.spans.split(",") if s and s.split(":")[0] not in ("iban", "ssn")]
        assert own == spans


def test_checksums_and_context(spark):
    one = spark.range(1)
    r = one.select(luhn(F.lit("79927398713")).alias("a"), luhn(F.lit("79927398710")).alias("b"),
                   mod97(F.lit("GB82WEST12345698765432")).alias("c"), mod97(F.lit("GB83WEST12345698765432")).alias("d")).first()
    assert tuple(r) == (True, False, True, False)
    df = spark.createDataFrame([("my ssn is 123-45-6789",), ("part 123-45-6789 here",), ("call +49 30 1234567",),
                                ("number +49 30 1234567",)], "text string")
    got = [[(s.kind, s.score) for s in row.pii] for row in with_pii(df).collect()]
    assert got == [[("ssn", 0.6)], [], [("phone", 0.9)], [("phone", 0.6)]]


def test_redaction_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd, or +49 30 123 4567!", "x"), (2, None, "y"), (3, "plain", "z"),
                                (4, "+4111 1111 1111 1111 end", "w")], "doc_id long, text string, pii string")
    got = {r.doc_id: (r.text, r.pii) for r in redact(df).collect()}
    assert got[1] == ("mail [EMAIL], or [PHONE]!", "x")
    assert got[2] == (None, "y") and got[3] == ("plain", "z")
    assert "4111" not in got[4][0] and got[4][0].endswith(" end")


def test_redaction_leaves_no_base_span(spark):
    rows = [(i, f"{w} {v} for x@mail7.example.com") for i, (w, v) in enumerate(
        (w, v) for w in ("order", "invoice", "version", "sample") for v in ("+1 (068) 555-2748", "213.174.22.103", "+49 30 123 4567"))]
    rows += [(len(rows) + i, t) for i, t in enumerate(samples()[:600])]
    rows += [(len(rows) + i, f"example {t} test") for i, t in enumerate(samples()[:100])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.pii for r in with_pii(df).collect()}
    assert any(s.score < 0.5 for found in spans.values() for s in found)
    texts, got = dict(rows), {r.doc_id: r.text for r in redact(df).collect()}
    for d, t in rows:
        gone = [any(s.start <= k < s.end for s in spans[d]) for k in range(len(t))]
        kept = re.sub(r"\[(?:EMAIL|IP|CARD|PHONE|IBAN|SSN)\]", "", got[d])
        assert kept == "".join(c for c, x in zip(texts[d], gone) if not x), t


def test_empty_table_and_no_python(spark):
    df = pii_report(spark.createDataFrame([], "doc_id long, text string, n_email long"))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
