"""Personal data in texts, by labelers whose votes are weighed without gold labels.

Strict patterns give the base spans, which always stay. Looser patterns add
candidates. A pattern check, a gazetteer, the words before and the edges of a span
vote on each candidate; expectation-maximisation (Dawid and Skene, 1979) estimates
how reliable each labeler is and how likely each pattern of votes is personal
data. These likelihoods train a logistic classifier over the span's features,
which decides on the looser candidates.

Votes and features of a span pack into one small integer. The corpus is counted
by that integer, so the estimates rest on all spans of all texts while the driver
sees at most ``N_CODES`` rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomcast.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: The base patterns.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A match never starts inside a run of digits: the run's first digit would match too.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Looser patterns for the added spans.
_LOOSE = (
    (
        EMAIL,
        re.compile(
            r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}"
            r"(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{1,63})+"
        ),
    ),
    (IP, re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    (CARD, re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]{1,3}[0-9]{4}){3}(?![0-9])")),
    (PHONE, re.compile(r"(?<![0-9])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")),
)

#: Top-level domains, calling codes and issuer prefixes.
_TLDS = frozenset(
    "com org net edu gov mil int info biz io co de fr es it uk us ca au at ch nl be se no dk fi pl "
    "pt ie eu mx br ar cl jp cn in ru".split()
)
_CALLING = tuple(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
    "64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
_ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[0-9]|6[0245]")
_CUES = (
    re.compile(r"\b(?:e-?mail|mail|contact|kontakt|correo|courriel|write to|address)\b", re.I),
    re.compile(r"\b(?:ip|host|server|address|client|from)\b", re.I),
    re.compile(r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta|payment)\b", re.I),
    re.compile(r"\b(?:tel|phone|call|fax|mobile|cell|telefon|téléphone|teléfono|handy)\b", re.I),
)
_COUNTER_CUES = re.compile(
    r"\b(?:version|isbn|order|invoice|serial|id|nr|no|build|release|section)\b", re.I
)
N_VOTES = 4
N_CODES = 4 * 3**N_VOTES * 8


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        value = int(char)
        if i % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _octets(text: str) -> bool:
    parts = [p.lstrip("0") or "0" for p in text.split(".")]
    return all(len(p) <= 3 and int(p) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from the @ signs outward."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in that order."""
    out = [(start, EMAIL, end) for start, end in _emails(text)]
    out += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if _octets(m.group())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Further candidates that overlap no base span and no earlier candidate."""
    taken = sorted((start, end) for start, _, end in base)
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    out: list[tuple[int, int, int]] = []
    for kind, pattern in _LOOSE:
        if kind == EMAIL and "(at)" not in text and "[at]" not in text:
            continue
        if kind == IP and text.count(":") < 7:
            continue
        for m in pattern.finditer(text):
            before = bisect_right(starts, m.end() - 1)
            if before and reach[before - 1] > m.start():
                continue
            out.append((m.start(), kind, m.end()))
    out.sort()
    apart, end = [], 0
    for span in out:
        if span[0] >= end:
            apart.append(span)
            end = span[2]
    return apart


def span_code(text: str, span: tuple[int, int, int]) -> int:
    """Kind, four votes (0 no, 1 abstain, 2 yes) and three features of a span."""
    start, kind, end = span
    own, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 40) : start]
    if kind == EMAIL:
        form = 2 if own.count("@") == 1 else 1
        known = 2 if re.split(r"[^A-Za-z0-9-]+", own.rstrip("])"))[-1].lower() in _TLDS else 0
    elif kind == IP:
        form = 2 if own.count(".") == 3 and _octets(own) else 1
        first = int((own.split(".")[0].lstrip("0") or "0")) if form == 2 else 1
        known = 2 if 0 < first < 224 else 0
    elif kind == CARD:
        form = 2 if 14 <= len(digits) <= 19 and luhn(digits) else 0
        known = 2 if _ISSUERS.match(digits) else 0
    else:
        form = 2 if own[0] == "+" else 1 if 10 <= len(digits) <= 15 else 0
        known = 2 if digits.startswith(_CALLING) and own[0] == "+" else 1
    cue = 2 if _CUES[kind].search(before) else 0 if _COUNTER_CUES.search(before[-12:]) else 1
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = 0 if left.isalnum() or right.isalnum() else 2
    code = kind
    for vote in (form, known, cue, edges):
        code = code * 3 + vote
    marks = re.sub(r"[A-Za-z0-9]", "", own)
    for flag in (len(set(marks)) > 1, len(digits) >= 10, left in ("", " ") and right in ("", " ")):
        code = code * 2 + bool(flag)
    return code


def unpack(code: int) -> tuple[int, list[int], list[int]]:
    flags = [code >> 2 & 1, code >> 1 & 1, code & 1]
    code >>= 3
    votes = []
    for _ in range(N_VOTES):
        code, vote = divmod(code, 3)
        votes.append(vote)
    return code, votes[::-1], flags


def label_model(codes: np.ndarray, counts: np.ndarray, rounds: int = 20_000) -> np.ndarray:
    """P(personal data) of each code by expectation-maximisation over the votes.

    Raises if the estimates have not settled after ``rounds`` rounds.

    Each labeler has a table P(vote | truth), each kind a prior. The start is the
    share of yes votes; added counts keep every estimate inside (0, 1).
    """
    parts = [unpack(int(c)) for c in codes]
    kinds = np.array([k for k, _, _ in parts])
    votes = np.array([v for _, v, _ in parts]).reshape(-1, N_VOTES)
    p = (1 + (votes == 2).sum(axis=1)) / (2 + (votes != 1).sum(axis=1))
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p])
        log = np.zeros((2, len(codes)))
        for truth in range(2):
            for kind in range(len(KINDS)):
                own = kinds == kind
                log[truth, own] += np.log(
                    (1 + weight[truth, own].sum()) / (2 + counts[own].sum())
                )
            for j in range(N_VOTES):
                # A labeler is better than chance: one added vote on its own side.
                table = np.bincount(votes[:, j], weights=weight[truth], minlength=3) + 0.5
                table[2 * truth] += 1
                table /= table[0] + table[2]
                table[1] = 1.0  # who abstains says nothing
                log[truth] += np.log(table)[votes[:, j]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - p).max() < 1e-9:
            return new
        p = new
    raise RuntimeError(f"the label model did not settle in {rounds} rounds")


def span_classifier(
    codes: np.ndarray, counts: np.ndarray, truth: np.ndarray, rounds: int = 200
) -> np.ndarray:
    """P(personal data) of each code by logistic regression on the soft labels.

    Every span counts as one row, so evidence grows with the corpus against a fixed
    ridge. Raises if the fit has not settled after ``rounds`` Newton steps.
    """
    rows = []
    for code in codes:
        kind, votes, flags = unpack(int(code))
        row = [1.0] + [float(kind == k) for k in range(len(KINDS))]
        row += [float(v == side) for v in votes for side in (0, 2)]
        rows.append(row + [float(f) for f in flags])
    x = np.array(rows).reshape(len(codes), 1 + len(KINDS) + 2 * N_VOTES + 3)
    w = np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        line = x @ w
        return float(counts @ (np.logaddexp(0, line) - truth * line) + 0.05 * w @ w)

    present = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        gradient = x.T @ (counts * (truth - p)) - 0.1 * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        # The loss is convex: a full step that overshoots is halved until it gains.
        while (new := loss(w + step)) > present + 1e-12 * abs(present):
            step /= 2
        w, present = w + step, new
        if np.abs(step).max() < 1e-6:
            return 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
    raise RuntimeError(f"the span classifier did not settle in {rounds} steps")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        base, loose, base_codes, loose_codes = [], [], [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            found = base_spans(text)
            more = loose_spans(text, found)
            base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in found])
            loose.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in more])
            base_codes.append([span_code(text, s) for s in found])
            loose_codes.append([span_code(text, s) for s in more])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(base, pa.list_(span)),
                pa.array(base_codes, pa.list_(pa.int32())),
                pa.array(loose, pa.list_(span)),
                pa.array(loose_codes, pa.list_(pa.int32())),
            ],
            names=["doc_id", "base", "base_codes", "loose", "loose_codes"],
        )


def personal_data(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document.

    doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base
    and added ones as kind:start:end, by start and kind), n_added. Positions are
    code points. Null and empty texts have no spans. Other columns are ignored.
    """
    scratch = Scratch(documents.sparkSession, "pii")
    kind = "array<struct<start:int,kind:int,end:int>>"
    found = scratch.save(
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _spans,
            f"doc_id long, base {kind}, base_codes array<int>, loose {kind}, "
            "loose_codes array<int>",
        ),
        "candidates",
    )
    counted = (
        found.select(F.explode(F.concat("base_codes", "loose_codes")).alias("code"))
        .groupBy("code")
        .agg(F.count("*").alias("n"))
        .orderBy("code")
        .collect()  # at most N_CODES rows
    )
    codes = np.array([r["code"] for r in counted], dtype=np.int64)
    counts = np.array([r["n"] for r in counted], dtype=np.float64)
    accepted: list[int] = []
    if len(codes):
        likely = span_classifier(codes, counts, label_model(codes, counts))
        accepted = codes[likely >= threshold].tolist()
    chosen = F.filter(
        F.arrays_zip("loose", "loose_codes"),
        lambda s: F.array_contains(
            F.lit(accepted) if accepted else F.array().cast("array<int>"), s["loose_codes"]
        ),
    )
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]),
            ),
            ",",
        )

    def counted_as(kind: int):
        # One parameter only: a second one would be the position in the array.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    added = F.transform(chosen, lambda s: s["loose"])
    count = [counted_as(i).alias(f"n_{name}") for i, name in enumerate(KINDS)]
    return found.withColumn("added", added).select(
        "doc_id",
        *count,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
