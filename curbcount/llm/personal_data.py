"""Personal data: exact patterns, and boosted trees over what looser generators propose beside them."""

from __future__ import annotations

import hashlib
import ipaddress
import re
import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbcount.llm.boosting import BoostedTrees
from curbcount.llm.common import columns, record_of, schema_of, slices

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the training sample: documents, and characters of each.
SAMPLE_DOCS = 400
SAMPLE_CHARS = 4000
EXAMPLES = 12000
#: Held-back share of proposals above a kind's threshold that must be right.
PRECISION = 0.995
CONTEXT = 32
#: With a country's code and an extension.
PHONE_DIGITS = 14

Span = tuple[int, int]

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return sum(own[::2] + [d * 2 - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches found from their @, so that long runs without one cost nothing."""
    found, low, at = [], 0, text.find("@")
    while at >= 0:
        run = text[low:at]
        start = low + len(run.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
        low = match.end() if match else at + 1
        at = text.find("@", low)
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> dict[str, list[Span]]:
    """The exact patterns, leftmost and non-overlapping per kind; failing matches are dropped."""
    found: dict[str, list[Span]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = _emails(text)
    if not _DIGIT.search(text):
        return found
    found["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found["card"].append(m.span())
    found["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


# ---------------------------------------------------------------- proposals

_AT = r"(?:\s?[(\[{<]\s?(?:at|@)\s?[)\]}>]\s?|\sat\s|_at_|-at-|\s@\s?|@\s)"
_DOT = r"(?:\s?[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s?|\sdot\s|_dot_|-dot-|\s\.\s|\.)"
_IP_DOT = r"\s?(?:[(\[{]\s?(?:\.|dot)\s?[)\]}]|\sdot\s)\s?"
_GENERATORS = [
    ("email", re.compile(rf"(?<![\w.%+-])[\w.%+-]{{1,64}}?{_AT}[^\W_][\w-]{{0,62}}?(?:{_DOT}[^\W_][\w-]{{1,62}}?){{1,4}}(?![\w-])", re.I), re.compile(r"(?:[\s(\[{<_-]at[\s)\]}>_-]|@)", re.I)),
    # hex digits and two or more colons, no longer than an address can be; a colon may stand before and after
    ("ip", re.compile(r"(?:(?<![0-9A-Za-z:])|(?<=[A-Za-z]{2}:)|(?<=[G-Zg-z=]:))(?=[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:)(?=:*[0-9A-Fa-f])"
                      r"[0-9A-Fa-f:]{0,40}(?:[0-9A-Fa-f]|::)(?![0-9A-Za-z]|:[0-9A-Za-z:])"), re.compile(r":[0-9A-Fa-f]{0,4}:")),
    ("ip", re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_IP_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.I), re.compile(r"[0-9]\s?[(\[{\s]\s?(?:\.|dot)", re.I)),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}(?:[\s./_·-]?[0-9]{2,7}){2,4}(?![0-9])"), _DIGIT),
    ("phone", re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[\s./_-]?)?\(?0?[0-9]{1,5}\)?(?:[\s./_·-]{1,2}[0-9]{2,7}){1,5}(?:\s?(?:ext\.?|x)\s?[0-9]{1,5})?(?![0-9])"), _DIGIT),
    ("phone", re.compile(r"(?<![0-9+])[0-9]{7,13}(?![0-9])"), _DIGIT),
]

# Frequent top-level domains: fixed values.
_TOP_LEVEL = re.compile(r"\b(?:com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|at|ch|nl|br|mx)$", re.I)

#: A mark in brackets, or words for the marks, as nobody writes them in prose.
_BRACKETED = re.compile(r"[(\[{<]\s?(?:at|dot|@|\.)\s?[)\]}>]|[_-](?:at|dot)[_-]|\sdot\s", re.I)

# Cue words of the contexts: fixed values.
_CUES = [
    re.compile(r"\b(?:tel|phone|call|fax|mobile|cell|whatsapp|dial|telefon|móvil|téléphone)", re.I),
    re.compile(r"\b(?:e-?mail|contact|write to|reach|correo|courriel)", re.I),
    re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|tarjeta|carte|karte)", re.I),
    re.compile(r"\b(?:ip|host|server|address|login from|client)\b", re.I),
    re.compile(r"(?:\b(?:version|isbn|order|invoice|no\.|nr\.|ref|id|total|price|page|section|chapter|copyright|licen[cs]e|doi|sku)\b|[$€£%#])", re.I),
]


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidate spans of all generators, beside the exact ones."""
    found = [(kind, m) for kind, pattern, hint in _GENERATORS if hint.search(text) for m in pattern.finditer(text)]
    # longer numbers are no phones
    return [(kind, *m.span()) for kind, m in found if kind != "phone" or len(_digits(m[0])) <= PHONE_DIGITS]


def _ipv6(own: str) -> bool:
    if own.count(":") < 2:
        return False
    try:
        ipaddress.IPv6Address(own)
    except ValueError:
        return False
    return True


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate. Validity by checksum or range is a feature, not a filter."""
    own, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(own)
    groups = [len(g) for g in re.findall(r"[0-9]+", own)]
    parts = own.split(".")
    return [
        *(float(kind == k) for k in KINDS), float(len(own)), float(len(digits)), float(len(groups)), float(max(groups, default=0)), float(min(groups, default=0)),
        float(len(digits) / len(own)), float(len(set(groups))), float(sum(c.isspace() for c in own)), float(own.count(".")), float(own.count("-")), float(sum(own.count(c) for c in "/_·")), float("(" in own), float(own.startswith("+")),
        float(own.startswith("0")), float(own.startswith("00")), float(luhn(digits) if digits else 0), float(len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)),
        float("@" in own), float(len(groups) == 4 and all(int(g) < 256 for g in re.findall(r"[0-9]{1,9}", own))), float(bool(_BRACKETED.search(own))), float(len(digits) in (15, 16) and luhn(digits)), float(7 <= len(digits) <= 13), float(max(groups, default=0) == len(digits)), float(bool(_TOP_LEVEL.search(own))), float(own.count(":")), float(_ipv6(own)), float("::" in own), float(max(map(len, own.split(":")))), float(bool(re.search(r"\b(?:19|20)[0-9]{2}\b", own))), float(digits[:3] == "555" or digits[3:6] == "555"),
        float(bool(before) and before[-1].isalnum()), float(bool(after) and after[0].isalnum()), float(sum(c.isdigit() for c in before + after)),
        *(float(bool(cue.search(before))) for cue in _CUES), float(bool(re.search(r"[$€£#]\s?$", before))), float(bool(re.match(r"\s?(?:%|€|\$|kg|km|mm|px|ms)", after))),
    ]


# ---------------------------------------------------------------- training

#: Numbers that are surely something else: dates, amounts of money, ISBNs by their prefix, versions, clock times.
_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}([-./])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2})")
_ISBN = re.compile(r"97[89](?:[ -]?[0-9]){10}")
_CLOCK = re.compile(r"(?:[01]?[0-9]|2[0-3])(?::[0-5][0-9]){2}")
_VERSION = re.compile(r"\b(?:version|release|v)\.?\s?$", re.I)
_MONEY_BEFORE, _MONEY_AFTER = re.compile(r"(?:[$€£]|\b(?:USD|EUR|GBP))\s?$"), re.compile(r"(?:[.,][0-9]{2})?\s?(?:[$€£]|(?:USD|EUR|GBP)\b)")


def ordinary(text: str, start: int, end: int) -> bool:
    """Whether a candidate is a date, an amount, an ISBN, a version or a clock time by its form and neighbours."""
    own, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    return bool(
        any(p.fullmatch(own) for p in (_DATE, _ISBN, _CLOCK)) or _VERSION.search(before) or _MONEY_BEFORE.search(before) or _MONEY_AFTER.match(after)
    )


def _made(rng: np.random.Generator, words: list[str]) -> tuple[str, int, int, str, bool]:
    """One invented example in words of the corpus: (text, start, end, kind, personal)."""
    def one(of) -> str:
        return of[int(rng.integers(len(of)))]

    def number(n: int, first: str = "123456789") -> str:
        return one(first) + "".join(map(str, rng.integers(0, 10, n - 1)))

    def some(n: int) -> str:
        return " ".join(one(words) for _ in range(n))

    name, host = some(1).strip(".,").lower() or "anna", some(1).strip(".,").lower() or "mail"
    card = number(15, "3456")
    card += str(next(d for d in range(10) if luhn(card + str(d))))
    amex = "3" + one(["4", "7"]) + number(12, "0123456789")
    amex += str(next(d for d in range(10) if luhn(amex + str(d))))

    def groups(low: int, high: int) -> str:
        return ":".join(f"{int(rng.integers(1, 1 << one([4, 16, 16]))):x}" for _ in range(int(rng.integers(low, high))))

    def marked(mark: str, sign: str) -> str:
        """The word or sign in some brackets, or bare between blanks."""
        left, right = one([("(", ")"), ("[", "]"), ("<", ">")])
        gap = one(["", " "])
        return one([f"{gap}{left}{one([mark, mark.upper(), sign])}{right}{gap}", f"{gap}{left}{mark}{right}{gap}", f" {mark} "])

    def grouped(digits: str, marks: str = " .-/") -> str:
        """Digits in groups of two to five with one mark between them."""
        out, mark = [], one(list(marks))
        while len(digits) > 5 or (len(digits) > 3 and rng.random() < 0.5):
            n = int(rng.integers(2, 5 if len(digits) > 5 else len(digits) - 1))
            out.append(digits[:n])
            digits = digits[n:]
        return mark.join([*out, digits])

    short = one([f"{one(['2001:db8', '2a02:' + groups(1, 2), 'fe80', 'fd' + number(2)])}{one(['', ':' + groups(1, 4)])}::{groups(0, 4)}", f"fe80::{groups(1, 5)}", f"2001:{groups(1, 3)}::{groups(1, 4)}", "::1"])
    clock = f"{rng.integers(0, 24):02d}:{rng.integers(0, 60):02d}:{rng.integers(0, 60):02d}"
    scope = one(["abc", "add", "face", "bad", "dead", "cafe", "fade", "ad", "c", "bed"])
    lines = [
        ("email", f"{name}{one([' at ', ' (at) ', '(at)', ' [at] ', '[at]'])}{host}{one([' dot ', ' (dot) ', '[dot]', '.'])}{one(['com', 'org', 'net', 'de'])}", ["mail", "contact", "write to", ""], True),
        ("email", f"{name}{one(['', '.' + some(1).lower(), number(2)])}{marked('at', '@')}{host}{one(['', '.' + some(1).strip('.,').lower()])}{marked('dot', '.') if rng.random() < 0.6 else '.'}{one(['com', 'org', 'net', 'de', 'co.uk'])}", ["mail", "contact", "write to", "", "e-mail"], True),
        ("email", f"{name}{one(['_at_', '-at-'])}{host}{one(['_dot_', '-dot-', '.'])}{one(['com', 'org', 'net', 'de'])}", ["mail", "contact", "", "e-mail"], True),
        ("phone", one(list(" .-/")).join([f"0{number(1)}", *(number(2) for _ in range(4))]), ["call", "tel", "mobile", "telefon", "fax"], True),
        ("email", f"{name} @ {host}{one(['.', ' . '])}{one(['com', 'org', 'net', 'de'])}", ["mail", "contact", ""], True),
        ("phone", grouped("0" + number(int(rng.integers(8, 11)))), ["call", "tel", "phone:", "telefon", "mobile", "fax", "tel."], True),
        ("phone", grouped(number(int(rng.integers(9, 12)))), ["call", "tel", "phone:", "telefon", "mobile", "dial", "whatsapp"], True),
        ("phone", f"{grouped(number(10))} {one(['ext.', 'ext', 'x'])} {number(int(rng.integers(2, 5)))}", ["call", "tel", "phone", ""], True),
        ("phone", grouped(number(int(rng.integers(8, 12)))), ["total", "order", "ref", "id", "invoice", "no.", "page", "isbn", "sku"], False),
        ("card", one([" ", ".", "/"]).join([card[:4], card[4:8], card[8:12], card[12:]]), ["card", "visa", "", "paid with"], True),
        ("card", one([" ", "-"]).join([amex[:4], amex[4:10], amex[10:]]), ["card", "amex", "", "paid with"], True),
        ("card", one([" ", "-", "."]).join([number(4), number(4), number(4), number(4)]), ["order", "ref", "id", "", "invoice"], False),
        ("ip", marked("dot", ".").join(str(int(x)) for x in rng.integers(1, 255, 4)) if rng.random() < 0.7 else "[.]".join(str(int(x)) for x in rng.integers(1, 255, 4)), ["ip", "host", "server", "from", ""], True),
        ("ip", " dot ".join(str(int(x)) for x in rng.integers(300, 999, 4)), ["total", "", "page"], False),
        ("phone", f"({number(3)}) {number(3)}-{number(4)}", ["call", "tel", "phone:", "fax", ""], True),
        ("phone", f"{number(3)}{one(['-', '.', ' '])}{number(3)}{one(['-', '.', ' '])}{number(4)}", ["call", "tel.", "mobile", "phone"], True),
        ("phone", f"00{number(2)} {number(3)} {number(7)}", ["tel", "telefon", ""], True),
        ("phone", f"0{number(3)}{one(['/', ' ', '-'])}{number(7)}", ["tel", "phone", "fax"], True),
        ("card", f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}", ["card", "visa", ""], True),
        ("card", f"{amex[:4]} {amex[4:10]} {amex[10:]}", ["card", "amex", "credit card"], True),
        ("ip", ":".join(f"{int(rng.integers(1, 65535)):x}" for _ in range(8)), ["ip", "host", "login from", ""], True),
        ("ip", one([short, short, short.upper()]), ["ip", "host", "login from", "address", "ping", "server", ""], True),
        ("ip", one([clock, f"{clock}:{rng.integers(0, 30):02d}", f"{rng.integers(1, 9)}:{rng.integers(1, 9)}:{rng.integers(1, 99)}"]), ["at", "time", "ratio", "until", ""], False),
        ("ip", one([f"{scope}::{one(['add', 'bed', 'c', 'fade', 'dead', 'ace'])}", f"::{scope}", ":".join(f"{int(rng.integers(0, 256)):02x}" for _ in range(6))]), ["call", "class", "mac", "in", ""], False),
        ("phone", f"{rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", ["on", "date", "since", ""], False),
        ("phone", f"{number(3)} {number(3)} {number(3)}", ["total", "price", "$", "order", ""], False),
        ("phone", number(int(rng.integers(7, 13))), ["order", "id", "ref", "no.", "", "invoice"], False),
        ("card", number(16), ["", "id", "ref", "order"], False),
        ("email", f"{name} at {host} dot {one(words)}" if rng.random() < 0.3 else f"{name} at {host}.{some(1).strip('.,').lower() or 'then'}", ["", "look", "was"], False),
        ("card", f"978-{number(1)}-{number(4)}-{number(4)}-{number(1)}", ["isbn", "ISBN:", ""], False),
    ]
    kind, own, cues, personal = one(lines)
    before = f"{some(int(rng.integers(0, 5)))} {one(cues)} "
    return f"{before}{own} {some(int(rng.integers(0, 5)))}", len(before), len(before) + len(own), kind, personal


@dataclass
class SpanModel:
    trees: BoostedTrees
    thresholds: dict[str, float]

    def choose(self, text: str, known: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
        """Proposals above their kind's threshold, best first, none over another or over an exact span."""
        open_ = [(k, a, b) for k, a, b in proposals(text) if not any(a < y and x < b for spans in known.values() for x, y in spans)]
        if not open_:
            return []
        p = self.trees.probability(np.array([describe(text, *c) for c in open_]))
        taken: list[tuple[str, int, int]] = []
        for i in np.argsort(-p, kind="stable"):
            kind, a, b = open_[i]
            if p[i] >= self.thresholds[kind] and not any(a < y and x < b for _, x, y in taken):
                taken.append((kind, a, b))
        return taken


def _some(of: Iterable, n: int, name: Callable[..., str]) -> list:
    """At most ``n`` of them, in the order of a hash of their names."""
    return sorted(of, key=lambda x: hashlib.sha256(name(x).encode("utf-8", "surrogatepass")).digest())[:n]


def train(texts: list[str], examples: int = EXAMPLES, seed: int = 11) -> SpanModel:
    """On invented spans in the sample's words, the sample's own exact spans, and its dates, amounts, ISBNs and versions.

    What else is proposed in the sample may be personal or not, so it has no label and is left out of training
    and calibration. Words and spans are taken in the order of a hash. A quarter is held back; a kind's threshold is the least score from which that part is right as often
    as asked for (never below one half; out of reach if no score is good enough).
    """
    rng = np.random.default_rng(seed)
    words = _some({w for t in texts for w in t.split() if w.isalpha()}, 5000, lambda w: w) or ["the", "of", "and", "to", "in"]
    rows, labels, kinds = [], [], []
    for _ in range(examples):
        text, a, b, kind, personal = _made(rng, words)
        if (kind, a, b) in proposals(text) or personal:
            rows.append(describe(text, kind, a, b))
            labels.append(personal)
            kinds.append(kind)
    for text in texts:
        exact = base_spans(text)
        for kind, spans in exact.items():
            for a, b in _some(spans, 20, lambda s: f"{text[s[0]:s[1]]} {s}"):
                rows.append(describe(text, kind, a, b))
                labels.append(True)
                kinds.append(kind)
        clear = [(k, a, b) for k, a, b in proposals(text) if ordinary(text, a, b) and not any(a < y and x < b for spans in exact.values() for x, y in spans)]
        for kind, a, b in _some(clear, 20, lambda s: f"{text[s[1]:s[2]]} {s}"):
            rows.append(describe(text, kind, a, b))
            labels.append(False)
            kinds.append(kind)
    x, y = np.array(rows), np.array(labels, float)
    held = np.arange(len(y)) % 4 == 0
    model = SpanModel(BoostedTrees().fit(x[~held], y[~held]), {})
    p = model.trees.probability(x[held])
    for kind in KINDS:
        own = np.array(kinds)[held] == kind
        score, truth = p[own], y[held][own]
        order = np.argsort(-score)
        right = np.cumsum(truth[order]) / np.arange(1, own.sum() + 1)
        good = np.flatnonzero(right >= PRECISION)
        model.thresholds[kind] = max(0.5, float(score[order][good[-1]])) if len(good) else 2.0
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> SpanModel:
    """Trained with a bounded sample of whole texts, chosen by a hash of the id."""
    total = docs.count()
    share = min(1.0, 2 * sample_docs / max(1, total))
    chosen = columns(docs, id=id_col, text=text_col).where((F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)) & (F.length("text") <= SAMPLE_CHARS))
    first = chosen.orderBy(F.xxhash64("id"), F.xxhash64("text")).select("text").limit(sample_docs)
    return train(sorted(r["text"] for r in first.collect()))


# ---------------------------------------------------------------- application


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find_personal(docs: DataFrame, model: SpanModel, text_col: str = "text", redacted: bool = True) -> DataFrame:
    """record (all columns but the text), n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted text.

    The counts and the digest are of the exact patterns; ``spans`` lists these and what the model adds, as
    kind:start:end in code points. Null text counts as empty. Rows stay apart whatever their ids.
    """
    frame = record_of(docs, [text_col], text=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["record", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"][: 7 + redacted]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in slices(batches, "text"):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, clean = [], [], []
            for text in part["text"].to_pylist():
                text = text or ""
                exact = base_spans(text)
                base = [(k, a, b) for k in KINDS for a, b in exact[k]]
                for k, kind in enumerate(KINDS):
                    counts[k].append(len(exact[kind]))
                every = base + own.choose(text, exact)
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
                if redacted:
                    clean.append(redact(text, every))
            made = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(clean, pa.string())]
            yield pa.record_batch([part["record"], *made[: 6 + redacted]], names)

    made = [*(f"n_{k} bigint" for k in KINDS), "base_sha256 string", "spans string", "redacted string"]
    return frame.mapInArrow(run, schema_of(frame, "record", ", ".join(made[: 6 + redacted])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind in brackets; spans that overlap are replaced together."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])
