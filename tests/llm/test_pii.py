"""Personal data: base spans against the plain patterns, trees, added spans, redaction."""

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import boosting, pii


def plain(text):
    out = []
    for k, pattern in enumerate((pii.EMAIL, pii.IP, pii.CARD, pii.PHONE)):
        for m in pattern.finditer(text):
            digits = [c for c in m[0] if c in "0123456789"]
            ok = (
                True, k != 1 or all(int(p) <= 255 for p in m[0].split(".")),
                k != 2 or (12 <= len(digits) <= 19 and pii.luhn("".join(digits))), k != 3 or 9 <= len(digits) <= 15)
            if all(ok):
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@-+ ()0123459é%", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_examples():
    text = "x é@a.b a.b@c-d.e.f@g.h 4539578763621486 +1 (961) 555-6946 1.2.3.4.5 0012.3.4.255 4539 5787 6362 1486"
    assert pii.base_spans(text) == plain(text)
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_boosting():
    r = np.random.default_rng(1)
    x = r.uniform(-1, 1, (900, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.2)).astype(float)
    f = boosting.calibrate(boosting.boost(x[:600], y[:600]), x[600:750], y[600:750])
    p = f.probability(x[750:])
    assert ((p > 0.5) == y[750:]).mean() > 0.93
    t = boosting.threshold(p, y[750:], 0.95)
    assert y[750:][p >= t].mean() >= 0.95
    assert boosting.threshold(np.array([0.9, 0.8]), np.array([0.0, 0.0]), 0.9) > 1


def corpus(r):
    word = lambda: "".join(r.choice("etaoinsh") for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(500):
        t = [word() for _ in range(30)]
        t.insert(3, f"call +1 ({r.randint(200, 999)}) 555-{r.randint(1000, 9999)}")
        t.insert(12, f"mail {word()}.{word()}@{word()}.example.com")
        t.insert(20, f"order {r.randint(10**9, 10**10)} version {r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 99)}")
        rows.append((i, " ".join(t), 1))
    return rows


def test_added_spans_and_redaction(spark):
    rows = corpus(random.Random(6))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    detector = pii.fit(docs)
    text = "please call (212) 555-1234 or write john dot doe at mail dot example dot com, order 4998112233"
    base = pii.base_spans(text)
    assert base == []
    found = [text[a:b] for a, _, b in sorted(detector.added(text, base))]
    assert "(212) 555-1234" in found
    assert not any("4998112233" in f for f in found)
    got = {x.doc_id: x for x in pii.find(docs, detector).collect()}
    for i, t, _ in rows:
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(plain(t)).encode()).hexdigest()
        assert set(pii.joined(plain(t)).split(",")) <= set(got[i].spans.split(","))
        assert (got[i].n_email, got[i].n_phone) == (1, 1)
    clean = pii.redact(docs, detector)
    assert clean.columns == docs.columns
    for x in clean.collect():
        assert pii.base_spans(x.text) == [] and "[EMAIL]" in x.text and "[PHONE]" in x.text


def test_edge_cases(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a@b.c", 5), (3, "a@b.c", 5), (None, "x", 5), (4, "9" * 5000 + "@" * 3000 + "a.b" * 2000, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    assert pii.fit(docs) is None
    got = sorted((x.doc_id or 0, x.n_email, x.spans) for x in pii.find(docs, None).collect())
    assert got[:3] == [(0, 0, ""), (1, 0, ""), (2, 0, "")] and got[3] == got[4] == (3, 1, "email:0:5")
    clean = sorted((x.doc_id or 0, x.text or "", x.n_chars) for x in pii.redact(docs, None).collect())
    assert clean[1] == (1, "", 5) and clean[3] == (3, "[EMAIL]", 7)
    assert pii.find(docs.limit(0), None).collect() == [] and pii.redact(docs.limit(0), None).collect() == []
    assert pii.redacted("abcdef", [(1, 0, 4), (2, 3, 5)]) == "a[EMAIL]f"
