"""Personal data: candidate spans scored by gradient-boosted trees.

Patterns with checks find four kinds for certain: e-mail addresses, IP addresses, payment
cards and international phone numbers.  Generators of high recall then propose further
spans, which may overlap.  Boosted trees score each from its format and from the words
before it, and a span is selected if its score reaches the threshold of its kind.  The
thresholds are calibrated on examples that the trees have not seen.

The trees are trained on the driver, on examples drawn from templates of public formats
and of look-alikes, a few thousand whatever the input.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, fit
from .common import map_arrow

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ipv6", "secret", "ssn")

Span = tuple[str, int, int]

# --- certain kinds ----------------------------------------------------------------

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# a match begins where a run of digits begins, so that runs are read once
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ the name is read backwards, so that long words are read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(free, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 * (digit > 4)
        total += digit
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Certain spans by kind, then start; leftmost and not overlapping in a kind."""
    spans: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = digits_of(m.group()) if m.end() - m.start() < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


# --- candidates -------------------------------------------------------------------

#: Kind, what a text must hold for a candidate to be there, and the candidates.
_GENERATORS = (
    ("email", re.compile(r"[\[(](?:at|AT)[\])]"), re.compile(r"[\w.+-]{1,64}\s?[\[(](?:at|AT)[\])]\s?[\w-]{1,64}\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[a-z]{2,10}")),
    ("card", _DIGIT, re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])")),
    ("phone", _DIGIT, re.compile(r"(?<![0-9.+-])(?:\(?[0-9]{2,4}\)?[ ./-]){1,4}[0-9]{3,8}(?![0-9.-])")),
    ("phone", _DIGIT, re.compile(r"(?<![0-9])00[1-9][0-9]{7,13}(?![0-9])")),
    ("iban", _DIGIT, re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])")),
    ("ipv6", re.compile(r"(?:[0-9A-Fa-f]{1,4}:){5}"), re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("ipv6", re.compile("::"), re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?![\w:])")),
    ("secret", re.compile("[A-Za-z0-9+/_=-]{16}"), re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")),
    ("ssn", _DIGIT, re.compile(r"(?<![0-9-])[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}(?![0-9-])")),
)

#: Words before a span that speak for or against a kind.
_CONTEXT = (
    re.compile(r"card|visa|credit|debit|karte|carte|tarjeta|payment", re.I),
    re.compile(r"tel|phone|call|fax|mobile|whatsapp|sms|m[óo]vil", re.I),
    re.compile(r"ssn|social|sécurité|tax id", re.I),
    re.compile(r"iban|account|konto|compte|cuenta|bank", re.I),
    re.compile(r"key|token|secret|passw|pwd|auth|bearer|credential", re.I),
    re.compile(r"mail|contact|write", re.I),
    re.compile(r"version|isbn|issn|order|page|no\.|commit|sha|md5|file|doi|serial", re.I),
    re.compile(r"http|www|://|/$", re.I),
)
#: Characters before a span that are searched for such words.
CONTEXT_WIDTH = 32


def mod97(text: str) -> bool:
    plain = text.replace(" ", "")
    turned = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate as numbers."""
    kind, start, end = span
    body = text[start:end]
    digits = digits_of(body)
    letters = sum(c.isalpha() for c in body)
    shares = [body.count(c) / len(body) for c in set(body)]
    before = text[max(0, start - CONTEXT_WIDTH) : start]
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(body, body[1:]))
    last, after = before[-1:], text[end : end + 1]
    return [
        KINDS.index(kind),
        len(body),
        len(digits),
        letters / len(body),
        changes / len(body),
        -sum(s * math.log2(s) for s in shares),
        len(shares),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(kind == "iban" and mod97(body)),
        float(not body.strip("0123456789abcdefABCDEF")),
        sum(c.isupper() for c in body) / len(body),
        sum(not c.isalnum() for c in body),
        float("(" in body or "[" in body),
        float(body.startswith(("0", "(0"))),
        float(last in ('"', "'", "=", ":")),
        float(after in ('"', "'")),
        float(last.isalnum() or after.isalnum()),
        *[float(words.search(before) is not None) for words in _CONTEXT],
    ]


def candidates(text: str, known: list[Span]) -> list[Span]:
    """Proposed spans, overlapping each other but no certain span."""
    found = []
    taken = Taken()
    for _, a, b in sorted(known, key=lambda s: s[1:]):
        taken.cover(a, b)
    for kind, needed, pattern in _GENERATORS:
        if not needed.search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            if kind == "secret" and not _keylike(text, a, b):
                continue
            if kind == "ipv6" and not _address(m.group()):
                continue
            if taken.is_free(a, b):
                found.append((kind, a, b))
    return found


class Taken:
    """Places that are taken: sorted stretches that do not overlap.

    A span is tested against its two neighbours only, whatever the number of stretches.
    """

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def is_free(self, start: int, end: int) -> bool:
        at = bisect_right(self.ends, start)
        return at == len(self.starts) or self.starts[at] >= end

    def add(self, start: int, end: int) -> None:
        """A span that is free."""
        at = bisect_right(self.ends, start)
        self.starts.insert(at, start)
        self.ends.insert(at, end)

    def cover(self, start: int, end: int) -> None:
        """A span that starts after all others did and may overlap the last."""
        if self.ends and start < self.ends[-1]:
            self.ends[-1] = max(self.ends[-1], end)
        else:
            self.starts.append(start)
            self.ends.append(end)


_RISE = re.compile("[a-z][A-Z]")
_ASSIGNED = re.compile(r"(?:key|token|secret|passw\w*|pwd|credentials?)\W{0,2}\s?[=:]\s?[\"']?\Z", re.I)


def _keylike(text: str, start: int, end: int) -> bool:
    """Letters with digits or capitals in turn, or any that are assigned to a key."""
    body = text[start:end]
    if not any(c.isalpha() for c in body):
        return False
    if _DIGIT.search(body) or len(_RISE.findall(body)) >= 3:
        return True
    return bool(_ASSIGNED.search(text[max(0, start - CONTEXT_WIDTH) : start]))


def _address(body: str) -> bool:
    """Whether an address has at most eight groups, or seven where some are left out."""
    groups = len(body.replace("::", ":").strip(":").split(":"))
    return 1 <= groups <= (7 if "::" in body else 8) and body != "::"


# --- training ---------------------------------------------------------------------


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _examples(count: int, seed: int) -> list[tuple[str, Span, int]]:
    """Texts with one marked span each, and whether it is personal data."""
    r = random.Random(seed)

    def number(n: int) -> str:
        return "".join(r.choices("0123456789", k=n))

    def word() -> str:
        return "".join(r.choices("abcdefghijklmnoprstuvwz", k=r.randint(2, 9)))

    def grouped(digits: str, sizes: list[int], gap: str) -> str:
        parts, at = [], 0
        for size in sizes:
            parts.append(digits[at : at + size])
            at += size
        return gap.join(parts)

    def card(good: bool) -> str:
        n = r.choice([13, 14, 15, 16])
        while luhn(digits := str(r.randint(3, 6)) + number(n - 1)) is not good:
            pass
        return r.choice([digits, grouped(digits, [4, 4, 4, n - 12], r.choice(" -."))])

    def iban(good: bool) -> str:
        body = number(r.choice([14, 18, 20]))
        country = r.choice(["DE", "FR", "ES", "GB", "NL"])
        turned = "".join(str(int(c, 36)) for c in body + country) + "00"
        check = 98 - int(turned) % 97
        plain = f"{country}{(check if good else (check + r.randint(1, 90)) % 97):02}{body}"
        return r.choice([plain, " ".join(re.findall(".{1,4}", plain))])

    def key() -> str:
        letters = r.choice(["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"])
        letters = r.choice([letters, letters + "abcdefghijklmnopqrstuvwxyz0123456789"])
        return "".join(r.choices(letters, k=r.choice([20, 24, 32, 40, 64]))) + "a1"

    def long_key() -> str:
        letters = r.choice(["0123456789abcdef", _LETTERS + "0123456789", _LETTERS])
        least = 20 if letters == _LETTERS else 129
        return "".join(r.choices(letters, k=r.choice([least, 160, 200, 256, 512])))

    def camel() -> str:
        return word() + "".join(word().capitalize() for _ in range(r.randint(4, 7)))

    def short_ipv6() -> str:
        def groups(low: int, high: int) -> list[str]:
            n = r.randint(low, high)
            return [f"{r.getrandbits(r.choice([4, 16])):x}" for _ in range(n)]

        head = r.choice(["2001:db8", "2a00:1450", "fe80", "fd00", "2606:4700", ""])
        more = groups(0, 2) if head else []
        tail = groups(0 if head else 1, 4)
        return ":".join([head, *more] if head else []) + "::" + ":".join(tail)

    def scope() -> str:
        names = ["add", "fade", "dead", "beef", "abc", "cafe", "ace", "bad", "face", "fed"]
        return r.choice(["", r.choice(names)]) + "::" + r.choice(names)

    def local() -> str:
        parts = [number(r.choice([3, 4])), number(3), number(r.choice([4, 5]))]
        return r.choice([f"({parts[0]}) {parts[1]}-{parts[2]}", "-".join(parts), " ".join(parts)])

    plans = (
        (1, "card", "card:|credit card|Visa|pay with", lambda: card(True)),
        (0, "card", "order|serial|no.|" + word(), lambda: card(False)),
        (0, "card", word(), lambda: number(r.choice([13, 14, 16, 17]))),
        (1, "phone", "tel|phone:|call|fax", local),
        (0, "phone", "page|version|order|" + word(), local),
        (0, "phone", word(), lambda: f"{number(2)}.{number(2)}.{r.randint(1900, 2030)}"),
        (1, "iban", "IBAN|account|" + word(), lambda: iban(True)),
        (0, "iban", "serial|" + word(), lambda: iban(False)),
        (1, "ssn", "SSN|social security number", lambda: f"{number(3)}-{number(2)}-{number(4)}"),
        (0, "ssn", "order|page|" + word(), lambda: f"{number(3)}-{number(2)}-{number(4)}"),
        (1, "secret", "token =|api key:|password =|secret:", key),
        (0, "secret", "commit|sha|file|http://x.org/", key),
        (0, "secret", word(), lambda: "-".join(word() for _ in range(5)) + number(2)),
        (1, "email", "mail|contact|" + word(), lambda: f"{word()} (at) {word()} (dot) com"),
        (0, "email", word(), lambda: f"{word()} (at) {word()}. {word()}"),
        (1, "ipv6", "from|address|" + word(), lambda: ":".join(key()[:4] for _ in range(8))),
        (0, "ipv6", word(), lambda: ":".join(number(2) for _ in range(6))),
        (1, "ipv6", "from|address|host|" + word(), short_ipv6),
        (0, "ipv6", "call|class|" + word(), scope),
        (1, "secret", "token =|api key:|password =|secret:", long_key),
        (0, "secret", "commit|file|http://x.org/|" + word(), long_key),
        (0, "secret", "call|" + word(), camel),
    )
    out = []
    for i in range(count):
        answer, kind, leads, body = plans[i % len(plans)]
        lead = f"{word()} {word()} {r.choice(leads.split('|'))}"
        quote = r.choice(['"', ""]) if kind == "secret" else ""
        head = f"{lead} {quote}"
        body = body()
        span = (kind, len(head), len(head) + len(body))
        out.append((f"{head}{body}{quote} {word()}", span, answer))
    return out


#: Examples for the trees, and as many again for the thresholds; 400 of each template.
EXAMPLES = 8800
#: Share of the selected spans that must be right among the examples of a kind.
PRECISION = 0.98


@cache
def trained(seed: int = 7) -> tuple[Boosted, dict[str, float]]:
    """The trees and the threshold of each kind."""
    rows = _examples(EXAMPLES, seed)
    model = fit(
        np.array([features(t, s) for t, s, _ in rows]),
        np.array([float(y) for *_, y in rows]),
    )
    held = _examples(EXAMPLES, seed + 1)
    scores = model.score(np.array([features(t, s) for t, s, _ in held]))
    thresholds = {}
    for kind in KINDS:
        own = [(p, y) for p, (_, s, y) in zip(scores, held) if s[0] == kind]
        own.sort(reverse=True)
        right = np.cumsum([y for _, y in own])
        good = [
            p
            for n, (p, _) in enumerate(own, 1)
            if right[n - 1] >= PRECISION * n and p >= 0.5
        ]
        thresholds[kind] = min(good, default=1.1)
    return model, thresholds


def extra_spans(
    text: str, known: list[Span], model: Boosted, thresholds: dict[str, float]
) -> list[Span]:
    """Selected candidates; of overlapping ones the one with the better score."""
    proposed = candidates(text, known)
    if not proposed:
        return []
    scores = model.score(np.array([features(text, span) for span in proposed]))
    chosen: list[Span] = []
    taken = Taken()
    for score, span in sorted(zip((-scores).tolist(), proposed)):
        if -score >= thresholds[span[0]] and taken.is_free(*span[1:]):
            taken.add(*span[1:])
            chosen.append(span)
    return chosen


# --- the operators ----------------------------------------------------------------


def _listed(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in order)


def find_personal_data(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Spans of personal data in each text, in code points.

    One row per input row: the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256`` (of the certain spans as ``kind:start:end``), ``spans`` (certain and
    selected ones, likewise) and ``n_spans``.  A null text counts as empty; null ids and
    repeated rows stay as they are; other columns are not read; an empty table gives no
    rows.  Rows are independent of each other.
    """
    model, thresholds = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {kind: [] for kind in BASE_KINDS}
            digests, listed, numbers = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                base = base_spans(text)
                for kind in BASE_KINDS:
                    counts[kind].append(sum(s[0] == kind for s in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                spans = base + extra_spans(text, base, model, thresholds)
                listed.append(_listed(spans))
                numbers.append(len(spans))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(counts[kind], pa.int64()) for kind in BASE_KINDS],
                    pa.array(digests, pa.string()),
                    pa.array(listed, pa.string()),
                    pa.array(numbers, pa.int64()),
                ],
                [f.split()[0] for f in fields.split(", ")],
            )

    fields = (
        "id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint,"
        " base_sha256 string, spans string, n_spans bigint"
    )
    rows = documents.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    return map_arrow(rows, run, fields).withColumnRenamed("id", id_column)


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans as one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(documents: DataFrame, text_column: str = "text") -> DataFrame:
    """The same rows and columns, with personal data replaced in the texts.

    Null and empty texts stay as they are.
    """
    model, thresholds = trained()
    at = documents.columns.index(text_column)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        base = base_spans(text)
        spans = base + extra_spans(text, base, model, thresholds)
        return redact(text, spans) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            done = pa.array([clean(t.as_py()) for t in texts], texts.type)
            yield batch.set_column(at, batch.schema.field(at), done)

    return map_arrow(documents, run, documents.schema)
