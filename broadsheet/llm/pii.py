"""Personal data by candidate generators and gradient-boosted trees.

Base spans follow fixed patterns and are always kept. Beyond them, generators that
are wide on purpose propose spans of every kind, overlapping ones too: addresses
written out in words, phone numbers without a plus, digit groups with any
separators, colon-separated addresses. Trees over the format and the context of a
candidate give each a calibrated chance, and those above their kind's threshold
that touch no base span are added, the likeliest first.

There are no labels for this, so the trees learn from the corpus itself: base
spans as the base patterns would not know them (without the plus or the at sign, cards
with other separators, an IPv6 address in the place of an IPv4 one) and full IPv6
addresses are positive rows, candidates that look alike but stand for something else
are negative ones. Candidates whose format speaks for the kind are no negative rows:
nothing says that they are not what they seem.
Their number is bounded; thresholds are set on rows held out from boosting.

Null and empty texts have no spans. Without enough rows to learn from only base
spans are found. Rows may repeat and each is answered. An empty table gives an
empty table. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import boosting
from broadsheet.llm.frames import map_batches

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end

#: Documents that candidates are learned from, candidates, and what an added span must reach.
SAMPLE = 6_000
ROWS = 20_000
PRECISION = 0.98
LEAST_ROWS = 60

# The base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The same matches as IP, tried at the start of each run of digits alone.
IP_FROM_START = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
WRITTEN_DOT = re.compile(r"\(dot\)|\[dot\]| dot ", re.I)
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
DIGIT = re.compile("[0-9]")
AT = re.compile("at", re.I)

# Generators beyond the base, by kind. Addresses are grown from what stands for their at sign.
AT_SIGN = re.compile(r" ?(?:\(at\)|\[at\]|\{at\}|@) ?|(?<= )at ", re.I)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
DOTTED = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|(?<= )dot(?= )|\.) ?[A-Za-z0-9-]++)++", re.I)
GENERATORS = (
    (1, re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    (1, re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,5}")),
    (2, re.compile(r"(?<![0-9])[0-9]{3,}(?:[ ./-]?[0-9]+){0,5}(?![0-9])")),
    (3, re.compile(r"(?<![0-9+])\(?[0-9]{1,4}\)?(?:[ ./()-]{1,2}[0-9]{2,5}){1,4}(?![0-9])")),
)
# Words before a span that speak for or against it.
CONTEXT = (
    re.compile(r"mail|contact|write|reach", re.I), re.compile(r"\bip\b|host|server|address|client", re.I),
    re.compile(r"card|visa|credit|pay", re.I), re.compile(r"phone|tel|call|fax|mobile|cell|dial", re.I),
    re.compile(r"order|invoice|isbn|issue|version|\bv\b|ref|\bid\b|token|key|page|date|no\.|#", re.I),
)
BEFORE = 24

# Formats that speak for a kind.
WRITTEN = re.compile(r".*(?:\(at\)|\[at\]|\{at\}|@).*|.* at .*(?: dot |\(dot\)|\[dot\]).*", re.I | re.S)
IPV6 = re.compile(r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}")
CARD_GROUPS = {16: (4, 4, 4, 4), 15: (4, 6, 5), 14: (4, 6, 4), 19: (4, 4, 4, 4, 3)}
WRITTEN_AS = (
    (" at ", " dot "), ("(at)", "."), (" (at) ", "."), (" (at) ", " (dot) "), ("[at]", "."), (" [at] ", " [dot] "), ("{at}", "."), (" @ ", "."), ("@ ", "."),
    (" @", "."), ("(at)", "(dot)"), (" at ", " [dot] "),
)
DIALLED = re.compile(r"\([0-9]{2,4}\)[ ./()-]{0,2}[0-9]+(?:[ ./-][0-9]+)+|[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start and then kind."""
    out: list[Span] = []
    # A match holds exactly one at sign behind the longest run of local characters.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not NOT_LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    if DIGIT.search(text):
        for m in IP_FROM_START.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def addresses(text: str) -> list[Span]:
    """Addresses around everything that may stand for an at sign, in one pass."""
    out, low = [], 0
    for m in AT_SIGN.finditer(text):
        # Separators are no local characters, so no place is walked over twice.
        before = text[low:m.start()].removesuffix(" ")
        end = low + len(before)
        local = LOCAL.match(before[::-1])
        start = end - local.end()
        right = DOTTED.match(text, m.end())
        # A plain "at" before a name with plain dots is mostly prose.
        if start < end and right and (m[0][-3:].lower() != "at " or WRITTEN_DOT.search(right[0])):
            out.append((start, 0, right.end()))
        low = m.end()
    return out


def candidates(text: str) -> list[Span]:
    """All proposals of the generators; they may overlap each other. A card has the digits and the check digit of one."""
    out = set(addresses(text)) if "@" in text or AT.search(text) else set()
    if DIGIT.search(text) or ":" in text:
        for kind, pattern in GENERATORS:
            for m in pattern.finditer(text):
                if kind != 2 or 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                    out.add((m.start(), kind, m.end()))
    return sorted(out)


def features(span: str, kind: int, before: str, after: str) -> list[float]:
    """Format and context of one candidate."""
    digits = _digits(span)
    groups = re.findall("[0-9]+", span)
    letters = sum(c.isalpha() for c in span)
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        len(span), len(digits), letters, len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(groups[-1]) if groups else 0, len(groups[0]) if groups else 0,
        span.count("."), span.count("-"), span.count(" "), span.count("/"), span.count(":"), float("(" in span),
        float(len(digits) >= 12 and luhn(digits)), float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        float(" at " in span or "(at)" in span or "[at]" in span or "{at}" in span), float(" dot " in span or "dot)" in span or "dot]" in span),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "\"'=#/$"), float(after[:1] in "\"'%/"),
        *[float(bool(c.search(before))) for c in CONTEXT],
    ]


def _describe(text: str, start: int, kind: int, end: int) -> list[float]:
    return features(text[start:end], kind, text[max(0, start - BEFORE):start], text[end:end + 4])


def sha256_of(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def _masked(text: str, start: int, kind: int, end: int) -> tuple[str, str] | None:
    """A base span as the base patterns would not know it, and what stands before it then."""
    span = text[start:end]
    if kind == 0:
        # One of the ways to write it that the generator knows, by a digest of the span.
        style = sha256_of(span)[0]
        at, dot = WRITTEN_AS[style % len(WRITTEN_AS)]
        local, domain = span.split("@")
        return local + at + domain.replace(".", dot), text[max(0, start - BEFORE):start]
    if kind == 3:
        return re.sub(r"^\+[0-9]+ ?", "", span) or None, text[max(0, start - BEFORE):start]
    if kind == 2:
        d, at = _digits(span), 0
        groups = []
        for n in CARD_GROUPS.get(len(d), (4,) * -(-len(d) // 4)):
            groups.append(d[at:at + n])
            at += n
        return "./"[int(d[-2]) % 2].join(groups), text[max(0, start - BEFORE):start]
    # The same place with an address of the other version, its groups drawn from the span.
    drawn = sha256_of(span).hex()
    return ":".join(drawn[i:i + 4].lstrip("0") or "0" for i in range(0, 32, 4)), text[max(0, start - BEFORE):start]


def well_formed(span: str, kind: int) -> bool:
    """Whether the format alone speaks for the kind."""
    if kind == 0:
        return bool(WRITTEN.fullmatch(span))
    if kind == 1:
        return bool(IPV6.fullmatch(span))
    digits = _digits(span)
    if kind == 2:
        marks = {c for c in span if not c.isdigit()}
        return len(marks) == 1 and tuple(map(len, re.findall("[0-9]+", span))) == CARD_GROUPS.get(len(digits)) and luhn(digits)
    return 9 <= len(digits) <= 15 and bool(DIALLED.fullmatch(span))


def training_rows(text: str) -> list[tuple[int, list[float]]]:
    """(label, features) rows of a text."""
    base, out = base_spans(text), []
    for start, kind, end in base:
        if (m := _masked(text, start, kind, end)) and m[0]:
            out.append((1, features(m[0], kind, m[1], text[end:end + 4])))
            # It is of one kind alone, whatever other generators propose for it or for parts of it.
            shown, low = m[1] + m[0] + text[end:end + BEFORE], len(m[1])
            out += [(0, _describe(shown, b, k, e)) for b, k, e in candidates(shown) if k != kind and low <= b and e <= low + len(m[0])]
    for start, kind, end in candidates(text):
        if all(end <= a or b <= start for a, _, b in base):
            if not well_formed(text[start:end], kind):
                out.append((0, _describe(text, start, kind, end)))
            elif kind == 1:
                out.append((1, _describe(text, start, kind, end)))
    return out


@dataclass
class Detector:
    forest: boosting.Forest
    thresholds: list[float]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates above their threshold that touch no base span nor a likelier one."""
        free = [c for c in candidates(text) if all(c[2] <= a or b <= c[0] for a, _, b in base)]
        if not free:
            return []
        p = self.forest.probability(np.array([_describe(text, *c) for c in free]))
        out: list[Span] = []
        for i in np.lexsort((np.arange(len(free)), -p)):
            start, kind, end = free[i]
            if p[i] >= self.thresholds[kind] and all(end <= a or b <= start for a, _, b in out):
                out.append((start, kind, end))
        return out


def fit(docs: DataFrame, sample: int = SAMPLE, rows: int = ROWS) -> Detector | None:
    """Learn from the candidates of about ``sample`` documents, those with the least hash of their id."""
    n = docs.count()
    draw = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1 << 30))
    chosen = docs.filter(F.col("text").isNotNull() & (draw < int(min(1.0, sample / max(1, n)) * (1 << 30)))).select("text")

    def make(batch):
        found = [r for t in batch.column("text").to_pylist() for r in training_rows(t)]
        return {"label": [r[0] for r in found], "x": [r[1] for r in found]}

    made = map_batches(chosen, make, "label int, x array<double>")
    kept = made.orderBy(F.xxhash64("label", "x")).limit(rows).collect()
    return learn([r.label for r in kept], [r.x for r in kept])


def learn(labels: list[int], rows: list[list[float]]) -> Detector | None:
    y, x = np.array(labels, float), np.array(rows, float)
    if min(y.sum(), len(y) - y.sum()) < LEAST_ROWS:
        return None
    held = np.arange(len(y)) % 3 == 0
    forest = boosting.calibrate(boosting.boost(x[~held], y[~held]), x[held], y[held])
    p = forest.probability(x[held])
    kinds = x[held][:, :len(KINDS)].argmax(1)
    # A kind without positive rows can't show that it is ever right.
    limits = [boosting.threshold(p[kinds == k], y[held][kinds == k], PRECISION) if y[held][kinds == k].sum() >= 10 else 1.1 for k in range(len(KINDS))]
    return Detector(forest, [max(0.5, t) for t in limits])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def find(docs: DataFrame, detector: Detector | None) -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, spans with the added ones."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)  # some trees

    def make(batch):
        out = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in batch.column("text").to_pylist():
            base = base_spans(text) if text else []
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(s[1] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(base + (shared.value.added(text, base) if text and shared.value else [])))
        return out | {"doc_id": batch.column("doc_id")}

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", "text"), make, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for start, kind, end in sorted(spans):
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, detector: Detector | None) -> DataFrame:
    """The same rows and columns with personal data replaced, and n_chars to match if there is one."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)
    columns = docs.columns

    def make(batch):
        texts = batch.column("text").to_pylist()
        clean = []
        for text in texts:
            base = base_spans(text) if text else []
            spans = base + (shared.value.added(text, base) if text and shared.value else [])
            clean.append(redacted(text, spans) if spans else text)
        out = {c: batch.column(c) for c in columns} | {"text": clean}
        if "n_chars" in columns:
            n = batch.column("n_chars").to_pylist()
            out["n_chars"] = [n[i] if t is texts[i] else len(t) for i, t in enumerate(clean)]
        return out

    return map_batches(docs, make, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
