"""Personal data by candidate generation and gradient boosting.

High-recall generators propose overlapping spans: the four base kinds and
looser forms (numbers without a country code, addresses spelled out, national
ids, bank numbers, IPv6, hardware addresses). Boosted trees score each
candidate from its format and the characters around it; probabilities are
calibrated on rows held back from the fit, and each kind's threshold is the
least that reaches ``PRECISION`` on them. Base spans always stay; of the other
candidates, those over their threshold are taken best first where they
overlap no span already taken.

The trees are fit on every document (Spark sums up each level of a tree over
all rows) and on ``PROTOTYPES`` made-up base spans per kind, so a corpus
without base spans has a model too; two texts in five, by a hash of the text,
are held back for calibration and thresholds. Base spans are positive; each is
also written in looser forms (positive) and broken ones (negative) in its own
surroundings. Looser candidates of the corpus are labelled only where
something other than their pattern tells (``verdict``: check digits, number
ranges, groups, words beside them); the rest, which may well be personal data,
are in neither the fit nor the calibration. Every row and every whole text is
then scanned.

Defined results: null text counts as empty; positions are code points; rows
are scanned one by one, repeated ones too; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierone.llm.boosting import ROWS, BoostedTrees, encoded
from tierone.llm.common import discard, materialize

PRECISION = 0.95
SEED = 42
#: Made-up base spans per kind that are rewritten beside those of the corpus.
PROTOTYPES = 150
CONTEXT = 24

#: The base kinds in the order spans list them.
BASE = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Equal to the patterns without look-behind: a run that fails from its start fails from inside.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Looser kinds, after the base kinds.
LOOSE = {
    "phone_local": re.compile(r"(?<![0-9+.(-])(?:\([0-9]{2,4}\)[ ]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
    "email_spelled": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?: at | ?[\[(]at[\])] ?)[A-Za-z0-9-]{1,63}"
        r"(?:(?: dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]{2,63}){1,4}"),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    "ipv6": re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    "mac": re.compile(r"(?<![0-9A-Fa-f:-])(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:-])"),
}
KINDS = (*BASE, *LOOSE)
ORDER = {k: i for i, k in enumerate(KINDS)}
HINTS = re.compile(r"call|phone|tel|fax|mobile|mail|contact|card|visa|pay|ssn|social|account|iban|bank|addr|host|login|from|to\b", re.I)
OTHER = re.compile(r"version|release|order|isbn|page|section|figure|chapter|\bid\b|\bv\b|date|http|www|=", re.I)
_DIGIT = re.compile(r"[0-9]")
#: Words right before or after that tell what a number is.
CALLED = re.compile(r"\b(?:call|phone|tel|telephone|fax|mobile|cell|whatsapp)\b[^0-9]*$", re.I)
COUNTED = re.compile(r"\b(?:version|release|order|isbn|issn|page|section|figure|chapter|part|serial|sku)\b[^0-9]*$", re.I)
INSURED = re.compile(r"\b(?:ssn|social)\b[^0-9]*$", re.I)
DOMAINS = frozenset("com org net edu gov info biz io de fr uk es it nl eu ch at us ca au jp".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, leftmost and not overlapping per kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:                      # linear: a run of local characters has no @
        if at >= done:
            begin = at
            while begin > done and LOCAL.match(text, begin - 1, begin):
                begin -= 1
            match = DOMAIN.match(text, at + 1) if begin < at else None
            if match:
                out.append((begin, match.end(), "email"))
                done = match.end()
            else:
                done = max(done, at + 1)
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (q.lstrip("0") or "0" for q in m.group().split("."))):
                out.append((*m.span(), "ip"))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                    out.append((*m.span(), "phone"))
    return out


def loose_spans(text: str) -> list[tuple[int, int, str]]:
    """Every candidate of the looser kinds; candidates of different kinds may overlap."""
    out = []
    if _DIGIT.search(text):
        for kind in ("phone_local", "national_id", "iban", "ipv6", "mac"):
            out += [(*m.span(), kind) for m in LOOSE[kind].finditer(text)]
    if "dot" in text:
        out += [(*m.span(), "email_spelled") for m in LOOSE["email_spelled"].finditer(text)]
    return out


def iban_ok(body: str) -> bool:
    """ISO 7064 check of the digits and letters."""
    plain = body.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def national_id_ok(body: str) -> bool:
    """Whether area, group and serial are ones that are given out."""
    area, group, serial = body.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def verdict(kind: str, before: str, body: str) -> int | None:
    """1 or 0 where a candidate of a looser kind can be told without its pattern, else None."""
    if kind == "iban":
        return int(iban_ok(body))
    if kind == "national_id":
        return 0 if not national_id_ok(body) or COUNTED.search(before) else 1 if INSURED.search(before) else None
    if kind == "phone_local":
        return 1 if CALLED.search(before) else 0 if COUNTED.search(before) else None
    if kind == "ipv6":
        parts = body.split(":")
        return 0 if len(parts) != 8 else 1 if max(map(len, parts)) > 2 else None
    if kind == "mac":
        return 0 if ":" in body and "-" in body else 1 if re.search("[A-Fa-f]", body) else None
    return 1 if re.split(r"[^A-Za-z0-9-]+", body.strip(" )]"))[-1].lower() in DOMAINS else None


def _checked(body: str) -> int:
    """2 or 1 if the check of its format holds or not, 0 for bodies without one."""
    if LOOSE["iban"].fullmatch(body):
        return 1 + iban_ok(body)
    return 1 + national_id_ok(body) if LOOSE["national_id"].fullmatch(body) else 0


def _around(ch: str) -> int:
    return 0 if not ch else 1 if ch.isspace() else 2 if ch.isalnum() else 3


def features(before: str, body: str, after: str) -> list[float]:
    """Numbers on the format of a candidate and the characters around it."""
    digits = _DIGIT.findall(body)
    groups = re.findall(r"[0-9]+", body)
    near = before + after
    return [
        len(body), len(digits), sum(c.isalpha() for c in body), body.count("."), body.count("-"),
        body.count(" "), body.count(":"), body.count("("), body.count("@"), body.startswith("+"),
        len(groups), max((len(g) for g in groups), default=0), min((len(g) for g in groups), default=0),
        max((int(g[:6]) for g in groups), default=0), len(set(digits)), luhn("".join(digits)) if digits else 0,
        any(len(g) == 4 and g[:2] in ("19", "20") for g in groups), sum(c.isupper() for c in body),
        _around(before[-1:]), _around(after[:1]), sum(c.isdigit() for c in near),
        len(HINTS.findall(near)), len(OTHER.findall(near)), sum(c in "|=<>{}/" for c in near), _checked(body)]


#: Of a training row: its kind and :func:`features`.
FEATURES = 1 + len(features("", "", ""))


def surroundings(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - CONTEXT):start], text[start:end], text[end:end + CONTEXT]


def rewritten(kind: str, body: str) -> list[tuple[str, str, int]]:
    """(kind, body, label) of looser true forms and of broken forms of a base span."""
    digits = "".join(_DIGIT.findall(body))
    if kind == "email":
        user, _, host = body.partition("@")
        return [("email_spelled", f"{user} at {host.replace('.', ' dot ')}", 1),
                ("email_spelled", "look at that dot and", 0), ("email_spelled", "at the dot", 0)]
    if kind == "phone":
        last = digits[-10:]
        return [("phone_local", f"({last[:3]}) {last[3:6]}-{last[6:]}", 1),
                ("phone_local", f"{last[:3]}-{last[3:6]}-{last[6:]}", 1),
                ("phone_local", f"20{last[:2]}-{last[2:5]}-{last[5:8]}", 0),
                ("national_id", f"{int(last[:3]) % 665 + 1:03}-{int(last[3:5]) % 99 + 1:02}-"
                                f"{int(last[5:9]) % 9999 + 1:04}", 1),
                ("national_id", f"9{last[1:3]}-{last[3:5]}-{last[5:9]:0<4}", 0)]
    if kind == "ip":
        parts = body.split(".")
        return [("ipv6", ":".join(f"{int(p) * 257 % 65536:x}" for p in parts * 2), 1),
                ("mac", "-".join(f"{int(p) % 256:02x}" for p in (parts * 2)[:6]), 1),
                ("ipv6", ":".join(["12", "30", "45", "10", "20"]), 0),
                ("phone_local", f"{parts[0][:2]:0>2}.{parts[1]:0>3}.{parts[2]:0>3}", 0)]
    account = f"{digits:0<18}"[:18]
    check = 98 - int(f"{account}131400") % 97           # DE00 as digits
    true, false = ("".join(f"DE{c:02}{account}"[i:i + 4] + " " for i in range(0, 22, 4)).strip()
                   for c in (check, (check + 1 + int(digits[0])) % 97))
    return [("iban", true, 1), ("iban", true.replace(" ", ""), 1), ("iban", false, 0),
            ("iban", "AB12 THIS THAT", 0), ("iban", f"NO{digits[:2]} ITEM {digits[2:6]}", 0),
            ("phone_local", f"{digits[:4]} {digits[4:8]} {digits[8:12]}", 0)]


class Model:
    """Trees and thresholds of one run; small and of fixed size.

    ``rows`` has one row for all training rows that are alike (:data:`~tierone.llm.boosting.ROWS`).
    """

    def __init__(self, rows: DataFrame):
        self.trees, self.least = None, {}
        sums = {r["held"]: (r["n"], r["ones"]) for r in
                rows.groupBy("held").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("ones")).collect()}
        n, ones = sums.get(False, (0, 0))
        if not 0 < ones < n or True not in sums:
            return
        self.trees = BoostedTrees().fit(rows.filter("NOT held"), ones / n, FEATURES)
        steps = self.trees.steps(rows.filter("held"))
        self.trees.calibrate(steps)
        p = self.trees.at_step(steps[:, 1])
        for kind in LOOSE:
            own = steps[:, 0] == ORDER[kind]
            order = np.argsort(-p[own], kind="stable")
            zeros, found = (np.cumsum(steps[own][order, c]) for c in (2, 3))
            fine = np.flatnonzero(found >= PRECISION * (zeros + found))
            if len(fine):
                self.least[kind] = max(0.5, float(p[own][order][fine[-1]]))

    def extra(self, text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Looser candidates over their thresholds, best first, clear of all spans taken."""
        spans = [s for s in loose_spans(text) if s[2] in self.least] if self.trees else []
        if not spans:
            return []
        x = np.array([[ORDER[k], *features(*surroundings(text, a, b))] for a, b, k in spans])
        p = self.trees.probability(encoded(x))
        covered = _merged(taken)
        chosen = []
        for i in np.argsort(-p, kind="stable"):
            a, b, kind = spans[i]
            if p[i] >= self.least[kind] and _clear(covered, a, b):
                chosen.append(spans[i])
                insort(covered, (a, b))
        return chosen


def _merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Disjoint intervals in order that cover the same places; base kinds may overlap each other."""
    out: list[tuple[int, int]] = []
    for a, b, _ in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _clear(covered: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) meets none of the disjoint intervals: the last that begins before b ends by a."""
    at = bisect_left(covered, (b,))
    return not at or covered[at - 1][1] <= a


def training_rows(text: str) -> list[tuple[str, list[float], int]]:
    base = base_spans(text)
    rows = []
    for a, b, kind in base:
        before, body, after = surroundings(text, a, b)
        rows.append((kind, features(before, body, after), 1))
        rows += [(k, features(before, t, after), label) for k, t, label in rewritten(kind, body)]
    covered = _merged(base)
    for a, b, kind in loose_spans(text):
        if _clear(covered, a, b):
            near = surroundings(text, a, b)
            label = verdict(kind, *near[:2])
            if label is not None:
                rows.append((kind, features(*near), label))
    return rows


def prototypes() -> list[str]:
    """Made-up texts with one base span each."""
    rng = random.Random(SEED)

    def word() -> str:
        return "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8)))

    def digits(n: int) -> str:
        return "".join(rng.choices("0123456789", k=n))

    texts = []
    for _ in range(PROTOTYPES):
        card = digits(15)
        bodies = (f"{word()}@{word()}.{rng.choice(sorted(DOMAINS))}", ".".join(str(rng.randrange(256)) for _ in range(4)),
                  next(card + d for d in "0123456789" if luhn(card + d)), f"+1 {digits(3)} {digits(3)} {digits(4)}")
        for body in bodies:
            texts.append(f"{word()} {word()} {word()} {body}{rng.choice((' ', ', ', '. '))}{word()} {word()}")
    return texts


def counted(texts: list[str]) -> list[tuple[bytes, int, bool, int]]:
    """The training rows of ``texts`` (:data:`~tierone.llm.boosting.ROWS`); those alike are counted."""
    seen: Counter = Counter()
    for text in texts:
        rows = training_rows(text)
        if rows:
            codes = encoded(np.array([[ORDER[k], *f] for k, f, _ in rows], dtype=np.float64))
            held = zlib.crc32(text.encode("utf-8", "surrogatepass")) % 5 < 2
            seen.update((c.tobytes(), label, held) for c, (*_, label) in zip(codes, rows, strict=True))
    return [(*row, n) for row, n in seen.items()]


def training_table(docs: DataFrame) -> DataFrame:
    """The training rows of all documents and of the made-up texts, one for all that are alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = counted([t.as_py() for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in
                 enumerate((pa.binary(), pa.int32(), pa.bool_(), pa.int64()))], names=["code", "y", "held", "n"])

    rows = docs.filter(F.rlike("text", F.lit("[0-9@]|dot"))).select("text").mapInArrow(run, ROWS)
    made = docs.sparkSession.createDataFrame(counted(prototypes()), ROWS)
    return rows.unionByName(made).groupBy("code", "y", "held").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model:
    rows = materialize(training_table(docs), "pii-rows")
    model = Model(rows)
    discard(rows)
    return model


def joined(spans: list[tuple[int, int, str]]) -> str:
    spans = sorted(spans, key=lambda s: (s[0], ORDER[s[2]], s[1]))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row: doc_id, counts and digest of the base kinds, and all spans."""
    model = model or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for cell in batch.column("text"):
                text = cell.as_py() or ""
                base = base_spans(text)
                counts.append([sum(s[2] == k for s in base) for k in BASE])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(base + model.extra(text, base)))
            by_kind = np.array(counts, dtype=np.int64).reshape(-1, len(BASE))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(by_kind[:, i]) for i in range(len(BASE))],
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return (docs.select("doc_id", "text")
            .mapInArrow(run, f"doc_id {kind}, {counts}, base_sha256 string, spans string"))


def redact(text: str | None, spans: str) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans merge."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(","))),
                             key=lambda s: s[1:]):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
