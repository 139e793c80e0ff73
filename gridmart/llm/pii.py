"""Personal data: generous generators propose spans, boosted trees choose among them, checked formats always stay.

The model is fitted on the driver, on a bounded sample of texts with made-up personal data and look-alikes put in at known
places, so every label is known. Everything after that is one pass over each row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.boosting import BoostedTrees, threshold_for
from gridmart.llm.common import arrow_batch, carried, per_batch

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id")

#: Formats of the base kinds. Look-behinds keep a scan linear and change no match.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_ANY_MARK = re.compile(r"[0-9@]|\(at\)|\[at\]")

#: Generators of the method: they may overlap the base and each other.
_LOOSE_EMAIL = re.compile(r"(?<![^\s\"'<(\[])[A-Za-z0-9._%+-]{1,64} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,5}")
_LOOSE_IP = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Fa-f:])")
_DIGITS = re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}")
_SECRET = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16,}={0,2}")
_WORDS = {
    "email": ("mail", "contact", "write", "e-mail"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "pay", "account"),
    "phone": ("phone", "tel", "call", "fax", "mobile"),
    "secret": ("token", "key", "secret", "password", "auth", "bearer"),
    "id": ("ssn", "passport", "social", "id", "iban"),
}


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    passed, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > passed and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1)
        if start < at and domain:
            yield start, domain.end()
            passed = domain.end()
        at = text.find("@", max(at + 1, passed))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the checked formats: leftmost, without overlap within a kind; a match that fails its check is dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _MARK.search(text):
        return out
    if "." in text:
        # Longer than any part may be, a number is no address, and need not be read as one.
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the method looks at: each proposal under each kind its format allows."""
    if not _ANY_MARK.search(text):
        return []
    out = set()
    if "@" in text or "(at)" in text or "[at]" in text:
        out |= {("email", m.start(), m.end()) for m in _LOOSE_EMAIL.finditer(text)}
    if ":" in text:
        out |= {("ip", m.start(), m.end()) for m in _LOOSE_IP.finditer(text)}
    for m in _DIGITS.finditer(text):
        n = len(_digits(m[0]))
        if n <= 24:
            start = m.start() - (text[m.start() - 1 : m.start()] == "+")
            for kind, least, most in (("phone", 7, 15), ("card", 13, 19), ("id", 8, 24)):
                if least <= n <= most:
                    out.add((kind, start, m.end()))
    for m in _SECRET.finditer(text):
        if any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
            out.add(("secret", m.start(), m.end()))
    return sorted(out)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - 32) : start], text[end : end + 8]
    n = len(span)
    digits = _digits(span)
    counts = np.unique(list(span), return_counts=True)[1] / n
    entropy = float(-(counts * np.log2(counts)).sum())
    lower, low = span.lower(), before.lower()
    groups = re.findall(r"[0-9]+", span)
    words = re.findall(r"[a-z-]+", low)[-3:]
    return [
        float(KINDS.index(kind)), n, len(digits), len(digits) / n, sum(c.isupper() for c in span) / n, entropy,
        len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), sum(not c.isalnum() for c in span),
        float(all(c in "0123456789abcdef" for c in lower)), float(span.startswith("+")), float("(" in span), span.count("-"), span.count("."), span.count(" "),
        float(luhn(digits)) if digits else -1.0, float(bool(words) and any(w.startswith(x) or w.endswith(x) for x in _WORDS[kind] for w in words)),
        float(before.rstrip(" \"'")[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'")), float(before[-1:].isalnum()), float(after[:1].isalnum()),
        float(before[-1:] in ("$", "€", "£")), float(after.lstrip()[:1] == "%"), float(digits[:2] in ("19", "20")), span.count("/"),
    ]


def _made_up(rng: np.random.Generator) -> tuple[str, str, str | None, int, int]:
    """A text to insert, its part that is personal, and its kind; None for a look-alike."""
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    hexed = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    mixed = lambda n: "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"), n))
    name = "".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(3, 9)))
    card = d(15)
    card += next(c for c in "0123456789" if luhn(card + c))
    grouped = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    wrong = card[:15] + str((int(card[15]) + int(rng.integers(1, 10))) % 10)
    true = [
        ("email", f"{name}@{name[::-1]}.com"), ("email", f"{name} (at) {name[::-1]} (dot) org"), ("email", f"{name} @ {name[::-1]}.net"),
        ("ip", f"2001:{hexed(4)}:{hexed(4)}:0:0:{hexed(4)}:{hexed(4)}:{hexed(4)}"), ("ip", f"fe80:{hexed(4)}:{hexed(4)}:{hexed(3)}:{hexed(4)}:{hexed(1)}:{hexed(4)}:{hexed(4)}"),
        ("card", card), ("card", grouped), ("card", grouped.replace(" ", "-")),
        ("phone", f"({d(3)}) 555-{d(4)}"), ("phone", f"{d(3)}-{d(3)}-{d(4)}"), ("phone", f"+{rng.integers(1, 99)} {d(3)} {d(3)} {d(4)}"), ("phone", f"+1 ({d(3)}) {d(3)}-{d(4)}"),
        ("secret", hexed(int(rng.choice([32, 40, 64])))), ("secret", mixed(int(rng.integers(20, 44)))), ("secret", f"sk-{mixed(32)}"),
        ("id", f"{d(3)}-{d(2)}-{d(4)}"), ("id", f"{d(2)} {d(6)} {d(4)}"),
    ]
    false = [
        f"{rng.integers(1, 999)},{d(3)},{d(3)}", f"{rng.integers(1900, 2030)}-{rng.integers(1, 13):02d}-{rng.integers(1, 29):02d}", f"{rng.integers(1900, 2030)}/{rng.integers(1900, 2030)}",
        f"{d(9)}.{d(2)}", f"${d(8)}", f"{d(13)}", f"{d(8)}", f"{rng.integers(0, 24):02d}:{d(2)}:{d(2)}:{d(2)}", f"{name}_{name[::-1]}_{name}_{d(2)}", f"{name}-{name}-{d(4)}-{name[::-1]}",
        wrong, wrong, wrong, " ".join(wrong[i : i + 4] for i in range(0, 16, 4)), f"v{d(1)}.{d(2)}.{d(4)}", f"{d(1)}.{d(8)}", f"ISBN 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"{d(4)} {d(4)}", f"10{d(18)}{d(6)}",
    ]
    if rng.random() < 0.5:
        kind, personal = true[rng.integers(len(true))]
        hint = f"{rng.choice(_WORDS[kind])}{rng.choice([' ', ': ', ' = '])}" if rng.random() < 0.6 or kind in ("id", "secret") else ""
        quote = "\"" if kind == "secret" and rng.random() < 0.5 else ""
        text = f"{hint}{quote}{personal}{quote}"
        begin = len(hint) + len(quote)
        return text, personal, kind, begin, begin + len(personal)
    text = str(false[rng.integers(len(false))])
    return text, "", None, 0, len(text)


@dataclass
class Redactor:
    """The fitted trees and a threshold for each kind, as calibrated on cases the trees have not seen."""

    trees: BoostedTrees
    thresholds: dict[str, float]

    def spans(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Base spans of each text, and the accepted candidates that overlap none of them: the best scored first."""
        base = [base_spans(t) for t in texts]
        proposed = [(i, *c) for i, t in enumerate(texts) for c in candidates(t)]
        scores = self.trees.predict(np.array([features(texts[i], *c) for i, *c in proposed])) if proposed else []
        taken = [sorted((a, b) for _, a, b in spans) for spans in base]
        out = [list(spans) for spans in base]
        for score, (i, kind, a, b) in sorted(zip(scores, proposed), key=lambda x: (-x[0], x[1])):
            if score >= self.thresholds[kind] and all(b <= start or a >= end for start, end in taken[i]):
                taken[i].append((a, b))
                out[i].append((kind, a, b))
        return [sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])) for spans in out]


def fit_redactor(texts: list[str], cases: int = 6000, precision: float = 0.98, seed: int = 7) -> Redactor:
    """Trees fitted on ``cases`` insertions into the given texts; three tenths of them set the thresholds."""
    rng = np.random.default_rng(seed)
    carriers = [t for t in texts if t and not _ANY_MARK.search(t)] or ["a plain line of words that holds nothing personal at all"]
    rows, truth, kinds = [], [], []
    for _ in range(cases):
        words = carriers[rng.integers(len(carriers))].split(" ")
        at = int(rng.integers(0, len(words) + 1))
        before, after = " ".join(words[max(0, at - 8) : at]), " ".join(words[at : at + 8])
        inserted, _, kind, begin, end = _made_up(rng)
        text = f"{before} {inserted} {after}"
        begin, end = begin + len(before) + 1, end + len(before) + 1
        for found, a, b in candidates(text):
            rows.append(features(text, found, a, b))
            truth.append(found == kind and (a, b) == (begin, end))
            kinds.append(found)
    x, y, kinds = np.array(rows), np.array(truth, float), np.array(kinds)
    held = rng.random(len(y)) < 0.3
    trees = BoostedTrees().fit(x[~held], y[~held])
    scores = trees.predict(x[held])
    chosen = {k: threshold_for(scores[kinds[held] == k], y[held][kinds[held] == k], precision) for k in KINDS}
    return Redactor(trees, chosen)


def sample_texts(docs: DataFrame, bound: int) -> list[str]:
    """About ``bound`` texts of at most 4,000 characters, chosen by hash: they only carry the made-up cases."""
    n = docs.count()
    if not n:
        return []
    chosen = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1 << 30)) < F.lit(min(1.0, bound / n) * (1 << 30))
    short = docs.select("text").where(chosen & (F.length("text") <= 4000))
    return [r.text for r in short.orderBy(F.xxhash64("text")).limit(bound).collect()]


RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans")


def personal_data(docs: DataFrame, sample: int = 400, cases: int = 6000, precision: float = 0.98) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone, base_spans and spans.

    Both spans columns are texts, ``kind:start:end`` by kind and start, joined by commas; offsets are code points, the end
    exclusive. spans holds the base spans and the method's own. Kinds are email, ip, card, phone, secret and id. The
    model is fitted on ``cases`` made-up cases in ``sample`` texts, both bounds; thresholds aim at ``precision``.

    A null text is empty and has no spans. Rows are read one by one: repeated rows and null ids change nothing but, by
    the sample, the model's carrier texts. Input columns named like a result are replaced. An empty table gives an empty one.
    """
    redactor = fit_redactor(sample_texts(docs, sample), cases, precision)
    passed = carried(docs, *RESULTS)
    read = docs.select(*passed)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        base, spans = [], redactor.spans(texts)
        counts: dict[str, list[int]] = {k: [] for k in BASE_KINDS}
        for t in texts:
            found = sorted(base_spans(t), key=lambda s: (KINDS.index(s[0]), s[1]))
            base.append(",".join(f"{k}:{a}:{b}" for k, a, b in found))
            for kind in BASE_KINDS:
                counts[kind].append(sum(k == kind for k, _, _ in found))
        every = [",".join(f"{k}:{a}:{b}" for k, a, b in found) for found in spans]
        return arrow_batch(
            **{c: batch.column(c) for c in passed}, **{f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()},
            base_spans=pa.array(base, pa.string()), spans=pa.array(every, pa.string()),
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema)
    return read.mapInArrow(per_batch(scan), f"{fields}, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string")


def redact(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind in brackets; of spans that overlap, the first to begin decides."""
    out, at = [], 0
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s)):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
            at = b
    return "".join([*out, text[at:]])
