import hashlib
import random
import re
from collections import Counter

import numpy as np
from llm_cases import awkward, collected, frame

from quadrille.llm import boosting, pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    spans = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) < 256 for p in m.group().split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append((kind, m.start(), m.end()))
    return spans


CASES = [
    "a@b.c@d.e x@y z.w+1@h-1.co.uk. @a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0000255.1.1.1 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 5 4111  1111",
    "+1 (555) 010-9999 +12 +1234567 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6 ++49 30 1234567 ",
    "é🙂 x@y.zz +49 (30) 123456",
    "1" * 3000 + " " + "a" * 3000 + "@",
]


def test_certain_spans():
    r = random.Random(6)
    texts = CASES + [
        "".join(r.choices("a.@1234567890 -+()b%é", k=r.randint(1, 60))) for _ in range(30000)
    ]
    for text in texts:
        assert pii.base_spans(text) == brute(text), text


def test_documents(spark):
    rows = awkward() + [(200 + k, t) for k, t in enumerate(CASES)]
    rows.append((300, 'the api key: "b44e15e09fd311c3cf3163b66d5a9875b883d8ce" and x@y.zz'))
    out = pii.find_personal_data(frame(spark, rows))
    names = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    expected = Counter()
    for i, text in rows:
        spans = brute(text or "")
        n = Counter(kind for kind, *_ in spans)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode())
        expected[(i, *[n[k] for k in PATTERNS], digest.hexdigest())] += 1
    assert Counter(collected(out, *names)) == expected
    listed = dict(collected(out, "doc_id", "spans"))
    for i, text in rows:
        for kind, a, b in brute(text or ""):
            assert f"{kind}:{a}:{b}" in listed[i].split(",")
    assert listed[300] == "email:60:66,secret:14:54"
    assert listed[4] == ""


def test_short_addresses_and_long_keys():
    r = random.Random(3)
    letters = "".join(r.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=40))
    personal = [
        ("ipv6", "from ", "2001:db8::1"),
        ("ipv6", "address ", "fe80::1ff:fe23:4567:890a"),
        ("ipv6", "address ", "2001:db8:85a3::8a2e:370:7334"),
        ("secret", "the token = ", "".join(r.choices("0123456789abcdef", k=200))),
        ("secret", "the api key: ", "".join(r.choices("0123456789abcdef", k=129))),
        ("secret", "the secret: ", letters),
    ]
    model, thresholds = pii.trained()
    for kind, lead, body in personal:
        text = f"we saw {lead}{body} and more"
        at = 7 + len(lead)
        span = (kind, at, at + len(body))
        assert span in pii.candidates(text, []), body
        assert pii.extra_spans(text, [], model, thresholds) == [span], body
    for text in ["call std::vector and add::face", "a :: b", "12::", "::", "x" * 9000, "-" * 400]:
        assert pii.extra_spans(text, [], model, thresholds) == [], text
    assert not pii.candidates("1:2:3:4:5:6:7::8:9 1::2::3", [])


def test_trees_on_held_out_examples():
    model, thresholds = pii.trained()
    rows = pii._examples(3400, 99)
    scores = model.score(np.array([pii.features(t, s) for t, s, _ in rows]))
    chosen = np.array([p >= thresholds[s[0]] for p, (_, s, _) in zip(scores, rows)])
    right = np.array([bool(y) for *_, y in rows])
    assert right[chosen].mean() > 0.95 and chosen[right].mean() > 0.95


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == (y[2000:] > 0.5)).mean() > 0.95


def test_redaction(spark):
    rows = awkward() + [(300, "mail x@y.zz or 10.0.0.1\nbye"), (301, "é +49 30 1234567!")]
    docs = frame(spark, rows)
    out = pii.redact_documents(docs)
    assert out.schema == docs.schema
    found = dict(collected(out.where("doc_id >= 300"), "doc_id", "text"))
    assert found == {300: "mail [EMAIL] or [IP]\nbye", 301: "é [PHONE]!"}
    small = "doc_id < 300 OR doc_id IS NULL"
    assert Counter(out.where(small).collect()) == Counter(docs.where(small).collect())


def test_overlapping_spans_are_replaced_once():
    assert pii.redact("0123456789", [("ip", 2, 6), ("card", 4, 8)]) == "01[IP]89"


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [])).count() == 0
    assert pii.redact_documents(frame(spark, [])).count() == 0


def test_spans_that_are_taken():
    import random

    r = random.Random(3)
    for _ in range(200):
        taken, spans = pii.Taken(), []
        for a in sorted(r.randrange(60) for _ in range(r.randint(0, 6))):
            b = a + r.randint(1, 9)
            taken.cover(a, b)
            spans.append((a, b))
        for _ in range(20):
            a = r.randrange(70)
            b = a + r.randint(1, 9)
            free = all(b <= c or d <= a for c, d in spans)
            assert taken.is_free(a, b) == free
            if free:
                taken.add(a, b)
                spans.append((a, b))


def test_a_long_list_of_contacts():
    """Three megabytes of contacts take time in proportion to their number."""
    import time

    line = "Ann (030) 1234567, ann.b@example.org, 192.168.2.{0}, +49 30 {1}, IBAN DE89 3704 0044 0532 0130 00\n"
    model, thresholds = pii.trained()

    def seconds(lines):
        text = "".join(line.format(k % 250, 1000000 + k) for k in range(lines))
        start = time.perf_counter()
        known = pii.base_spans(text)
        spans = known + pii.extra_spans(text, known, model, thresholds)
        assert len(known) >= 3 * lines and len(spans) > 3 * lines
        return time.perf_counter() - start

    few, many = seconds(3_000), seconds(30_000)
    assert many < 25 * few + 5
