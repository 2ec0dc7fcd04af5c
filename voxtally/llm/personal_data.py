"""Personal data: fixed forms, and a semi-Markov conditional random field for what is written otherwise.

Addresses, card and telephone numbers in their plain forms are reported by pattern.  People also write them with other
separators, without a country code or with words in place of signs.  For those, every stretch of digit groups and
every spelled-out address is a candidate segment, of bounded length and with several possible ends.  The field scores
whole segments (digits, grouping, check digit, signs, the words before, what goes on beside it) for each type, and the types of
following segments for each other.  A dynamic program over the segments' ends chooses boundaries and types together.

The weights are learned here, from windows of a bounded sample: the plain forms found in them are the truth, and each
is also rewritten in the ways that the patterns miss, or spoiled so that it is none any more.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtally.llm.common import map_batches, present, whole_documents

# The kinds that are reported by pattern, in their order, and their limits.
BASE_KINDS = ("email", "ip", "card", "phone")
CARD_DIGITS, PHONE_DIGITS, MOST_PART = (12, 19), (9, 15), 255
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is taken whole, so a match can only begin where one does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: What the field adds.
ADDED_KINDS = tuple(f"likely_{kind}" for kind in BASE_KINDS)
KINDS = {kind: i for i, kind in enumerate(BASE_KINDS + ADDED_KINDS)}

# Words that announce a kind, and spellings of signs.
CUES = {
    "email": ("email", "e-mail", "mail", "mailto", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr", "address", "node", "ping"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("tel", "phone", "telephone", "call", "fax", "mobile", "cell", "whatsapp", "telefon"),
}
_CUE = {kind: re.compile(rf"(?<![a-z])(?:{'|'.join(words)})(?![a-z])") for kind, words in CUES.items()}
_NUMBER = re.compile(r"(?<![0-9A-Za-z_])[+(]{0,2}[0-9](?:[0-9]|[\x20().\[\]/-]{1,3}(?=[0-9]))*(?![0-9A-Za-z_])")
_GROUP = re.compile(r"[0-9]+")
_DIGIT = re.compile(r"[0-9]")
_AT = r"(?:\x20?@\x20?|\x20?[\[({]\x20?(?:at|@)\x20?[\])}]\x20?|\x20at\x20)"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20dot\x20)"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}+(?:{_DOT}[A-Za-z0-9-]{{1,63}}+){{1,5}}+")
_LABEL_END = re.compile(rf"(?<=[A-Za-z0-9-])(?={_DOT}[A-Za-z0-9-])")
_AT_SIGN, _DOT_SIGN = re.compile(_AT), re.compile(_DOT)
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/.](?:0?[1-9]|1[0-2])[-/.](?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|[12]\d|3[01])[-/.](?:19|20)\d\d)")

#: Bounds of an entity: groups of digits, digits, and code points before it that are searched for a cue.
MOST_GROUPS, DIGITS, REACH = 8, (4, 19), 24

Span = tuple[int, int, str]


# --- plain forms ----------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small_parts(parts: Sequence[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= MOST_PART for p in parts)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the patterns find: start, end, kind.  Every pattern takes time in proportion to the text."""
    found: list[Span] = []
    at, floor = text.find("@"), 0
    while at >= 0:
        # a local part has no "@" in it, so it reaches back from one as far as its characters go
        start = floor + len(text[floor:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            found.append((start, floor, "email"))
        at = text.find("@", floor)
    if _DIGIT.search(text):
        found += [(*m.span(), "ip") for m in _IP.finditer(text) if small_parts(m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= CARD_DIGITS[0]:
                digits = _digits(m[0])
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    found.append((*m.span(), "card"))
        if "+" in text:
            found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return sorted(found, key=_place)


def _place(span: Span) -> tuple[int, int]:
    return span[0], KINDS[span[2]]


# --- candidate segments and their features ------------------------------------------------------------------------------

_NAMES = (
    "number", "address", "luhn", "quad", "plus", "zeros", "bracket", "date", "one_group", "ends_3_4", "fours", "goes_on_left", "goes_on_right",
    "sign_left", "sign_right", "at_word", "at_sign", "at_bracket", "dot_word", "dot_bracket", "dot_plain", "label_short", "label_long", "local_plain",
    *(f"cue_{kind}" for kind in BASE_KINDS), *(f"digits_{n}" for n in range(4, 20)), *(f"groups_{n}" for n in range(1, MOST_GROUPS + 1)),
    *(f"joined_{name}" for name in ("space", "dash", "dot", "slash", "mixed", "spaced_sign", "square")), "luhn_cue", "luhn_grouped", "phone_cue_grouped",
)
FEATURE = {name: i for i, name in enumerate(_NAMES)}


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    features: tuple[int, ...]


def _cues(text: str, start: int) -> list[str]:
    before = text[max(0, start - REACH) : start].lower()
    return [f"cue_{kind}" for kind, pattern in _CUE.items() if pattern.search(before)] if before else []


def _number_features(text: str, start: int, end: int, groups: list[str], between: list[str], left: bool, right: bool) -> tuple[int, ...]:
    digits, names = "".join(groups), ["number", f"groups_{len(groups)}"]
    names.append(f"digits_{len(digits)}")
    cues = _cues(text, start)
    names += cues
    checked = CARD_DIGITS[0] <= len(digits) and luhn(digits)
    grouped = len(groups) > 1
    signs = {b.strip() for b in between}
    if checked:
        names.append("luhn")
        names += ["luhn_cue"] * ("cue_card" in cues) + ["luhn_grouped"] * grouped
    names += ["phone_cue_grouped"] * (grouped and "cue_phone" in cues)
    if len(groups) == 4 and small_parts(groups) and len(signs) == 1 and "." in next(iter(signs)):
        names.append("quad")
    span = text[start:end]
    for name, holds in (
        ("plus", span[0] == "+"), ("zeros", digits.startswith("00")), ("bracket", "(" in span), ("date", _DATE.fullmatch(span) is not None), ("one_group", not grouped),
        ("ends_3_4", [len(g) for g in groups[-2:]] == [3, 4] and (len(groups) == 2 or len(groups[-3]) <= 4)),
        ("fours", grouped and all(len(g) == 4 for g in groups)), ("goes_on_left", left), ("goes_on_right", right),
        ("sign_left", start > 0 and text[start - 1] in "#$€£.,:=-/"), ("sign_right", text[end : end + 2].strip() in ("%", "€", "$") or (text[end : end + 1] in (".", ",", ":") and text[end + 1 : end + 2].isdigit())),
    ):
        if holds:
            names.append(name)
    if grouped:
        kinds = {"": "space", "-": "dash", ".": "dot", "/": "slash"}
        names.append(f"joined_{kinds.get(next(iter(signs)), 'square') if len(signs) == 1 else 'mixed'}")
        if any(b.strip() and b != b.strip() for b in between):
            names.append("joined_spaced_sign")
        if any("[" in b for b in between):
            names.append("joined_square")
    return tuple(sorted({FEATURE[n] for n in names}))


def _address_features(text: str, start: int, end: int, right: bool) -> tuple[int, ...]:
    span = text[start:end]
    at = _AT_SIGN.search(span)
    names, domain = ["address", *_cues(text, start)], span[at.end() :]
    sign = at[0].strip().lower()
    names.append("at_word" if sign == "at" else "at_sign" if sign == "@" else "at_bracket")
    dots = [d.strip().lower() for d in _DOT_SIGN.findall(domain)]
    names += ["dot_word"] * ("dot" in dots) + ["dot_plain"] * ("." in dots) + ["dot_bracket"] * any(d[0] in "[({" for d in dots)
    last = _DOT_SIGN.split(domain)[-1]
    names.append("label_short" if last.isalpha() and len(last) <= 4 else "label_long")
    names += ["local_plain"] * span[: at.start()].isalpha() + ["goes_on_right"] * right
    return tuple(sorted({FEATURE[n] for n in names}))


def candidates(text: str) -> list[Candidate]:
    """Segments that may be personal data, by start and end; their number follows the length of the text."""
    found = []
    if "@" in text or " at " in text or "at)" in text or "at]" in text or "at}" in text:
        for m in _SPELLED.finditer(text):
            at = _AT_SIGN.search(text, m.start())
            ends = [e.start() for e in _LABEL_END.finditer(text, at.end(), m.end()) if e.start() > at.end()]
            for end in [*ends[1:], m.end()]:
                found.append(Candidate(m.start(), end, _address_features(text, m.start(), end, end < m.end())))
    for m in _NUMBER.finditer(text) if _DIGIT.search(text) else ():
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            floor = groups[i - 1][1] if i else m.start()
            while start > floor and text[start - 1] in "+(":
                start -= 1
            count = 0
            for j in range(i, min(len(groups), i + MOST_GROUPS)):
                count += groups[j][1] - groups[j][0]
                if count > DIGITS[1]:
                    break
                if count >= DIGITS[0]:
                    parts = [text[a:b] for a, b in groups[i : j + 1]]
                    between = [text[groups[k][1] : groups[k + 1][0]] for k in range(i, j)]
                    found.append(Candidate(start, groups[j][1], _number_features(text, start, groups[j][1], parts, between, i > 0, j + 1 < len(groups))))
    return found


# --- the field --------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Weights of features for each type, and of a type after the type before it (the last row: after none)."""

    weights: np.ndarray
    following: np.ndarray

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros((len(FEATURE), len(BASE_KINDS))), np.zeros((len(BASE_KINDS) + 1, len(BASE_KINDS))))

    def scores(self, found: Sequence[Candidate]) -> np.ndarray:
        return np.array([self.weights[list(c.features)].sum(axis=0) for c in found]).reshape(len(found), len(BASE_KINDS))


def _points(found: Sequence[Candidate]) -> tuple[list[int], list[int], int]:
    """Numbers of the candidates' starts and ends among all of them."""
    points = sorted({p for c in found for p in (c.start, c.end)})
    number = {p: i for i, p in enumerate(points)}
    return [number[c.start] for c in found], [number[c.end] for c in found], len(points)


def expectations(field: Field, found: Sequence[Candidate]) -> tuple[float, np.ndarray, np.ndarray]:
    """Logarithm of the sum over all segmentations, and how often each candidate has each type and each type follows another."""
    starts, ends, n = _points(found)
    types = len(BASE_KINDS)
    score, follow = field.scores(found), field.following
    by_end: list[list[int]] = [[] for _ in range(n)]
    by_start: list[list[int]] = [[] for _ in range(n)]
    for k, (s, e) in enumerate(zip(starts, ends, strict=True)):
        by_end[e].append(k)
        by_start[s].append(k)
    forward = np.full((n, types + 1), -np.inf)
    entered = np.empty((len(found), types + 1, types))
    forward[0, types] = 0.0
    for p in range(n):
        if p:
            forward[p] = forward[p - 1]
            for k in by_end[p]:
                entered[k] = forward[starts[k]][:, None] + follow + score[k]
                forward[p, :types] = np.logaddexp(forward[p, :types], np.logaddexp.reduce(entered[k], axis=0))
    backward = np.zeros((n, types + 1))
    for p in range(n - 2, -1, -1):
        backward[p] = backward[p + 1]
        for k in by_start[p]:
            ahead = np.logaddexp.reduce(follow + score[k] + backward[ends[k], :types], axis=1)
            backward[p] = np.logaddexp(backward[p], ahead)
    whole = float(np.logaddexp.reduce(forward[-1]))
    expected = np.zeros((len(found), types))
    followed = np.zeros_like(follow)
    for k in range(len(found)):
        part = np.exp(entered[k] + backward[ends[k], :types] - whole)
        expected[k] = part.sum(axis=0)
        followed += part
    return whole, expected, followed


def decode(field: Field, found: Sequence[Candidate], fixed: Sequence[Span] = (), caution: float = 0.0) -> list[tuple[int, int, int]]:
    """The segmentation of the highest score as start, end, type.  ``fixed`` spans are part of any; ``caution`` is taken off each other segment."""
    score = (field.scores(found) - caution).tolist()
    segments = [(c.start, c.end, score[k], False) for k, c in enumerate(found)]
    segments += [(s, e, [1e6 if kind == k else -1e9 for k in BASE_KINDS], True) for s, e, kind in fixed]
    if not segments:
        return []
    follow = field.following.tolist()
    none = len(BASE_KINDS)
    points = sorted({p for s, e, *_ in segments for p in (s, e)})
    number = {p: i for i, p in enumerate(points)}
    by_end: dict[int, list[int]] = {}
    for k, (_, e, *_) in enumerate(segments):
        by_end.setdefault(number[e], []).append(k)
    best: list[list[float]] = []
    back: list[list[tuple[int, int, int] | None]] = []  # point and type before, segment
    for p in range(len(points)):
        here = list(best[-1]) if p else [-1e18] * none + [0.0]
        came: list[tuple[int, int, int] | None] = [None] * (none + 1)
        for k in by_end.get(p, ()):
            s = number[segments[k][0]]
            for y in range(none):
                value, before = max((best[s][x] + follow[x][y], x) for x in range(none + 1))
                value += segments[k][2][y]
                if value > here[y]:
                    here[y], came[y] = value, (s, before, k)
        best.append(here)
        back.append(came)
    p, y = len(points) - 1, max(range(none + 1), key=lambda x: best[-1][x])
    out = []
    while p > 0:
        step = back[p][y]
        if step is None:
            p -= 1
            continue
        before, x, k = step
        if not segments[k][3]:
            out.append((segments[k][0], segments[k][1], y))
        p, y = before, x
    return out[::-1]


def added_spans(text: str, base: list[Span], field: Field, caution: float) -> list[Span]:
    """What the field finds beside the base spans; nothing it adds overlaps one of them."""
    if not field.weights.any():
        return []
    found = candidates(text)
    if not found:
        return []
    starts, ends = np.array([s for s, _, _ in base]), np.maximum.accumulate([e for _, e, _ in base]) if base else np.array([])
    free = []
    for c in found:
        k = int(np.searchsorted(starts, c.end)) - 1 if base else -1
        if k < 0 or ends[k] <= c.start:
            free.append(c)
    return [(s, e, ADDED_KINDS[y]) for s, e, y in decode(field, free, base, caution)] if free else []


def all_spans(text: str, field: Field, caution: float) -> list[Span]:
    base = base_spans(text)
    return sorted([*base, *added_spans(text, base, field, caution)], key=_place)


# --- learning -----------------------------------------------------------------------------------------------------------

#: Code points on either side of a segment that go into a window.
MARGIN = 60
Example = tuple[str, list[Span]]


def windows(text: str, most: int) -> list[str]:
    """Pieces of a text around its first ``most`` stretches with a span or a candidate."""
    places = sorted([(s, e) for s, e, _ in base_spans(text)] + [(c.start, c.end) for c in candidates(text)])
    out: list[tuple[int, int]] = []
    for s, e in places:
        s, e = max(0, s - MARGIN), min(len(text), e + MARGIN)
        if out and s < out[-1][1]:
            if e - out[-1][0] <= 8 * MARGIN:
                out[-1] = (out[-1][0], max(e, out[-1][1]))
        elif len(out) < most:
            out.append((s, e))
    return [text[s:e] for s, e in out]


def sample_windows(documents: DataFrame, most: int, each: int = 3) -> list[str]:
    """At most ``most`` windows, the same ones each time: from documents whose ids hash low enough for a few times as many."""
    docs = whole_documents(documents)
    rows = documents.count()
    share = min(1.0, 8 * most / max(rows, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [w for t in batch.column("text") for w in windows(present(t.as_py()), each)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["window"])

    cut = map_batches(chosen, work, "window string").distinct()
    return cut.orderBy(F.xxhash64("window"), "window").limit(most).toArrow().column("window").to_pylist()


def _rewritten(kind: str, span: str, pick: random.Random) -> str:
    """The same in a form that the patterns miss."""
    if kind == "email":
        local, domain = span.split("@")
        at, dot = pick.choice([(" at ", " dot "), ("(at)", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("@", "[.]"), (" @ ", ".")])
        return local + at + domain.replace(".", dot)
    groups = _GROUP.findall(span)
    if kind == "ip":
        return pick.choice(["[.]", "(.)", " . "]).join(groups)
    digits = "".join(groups)
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return pick.choice([".", "/", " - ", ". "]).join(fours)
    country = groups[0] if len(groups) > 1 and len(groups[0]) <= 3 else digits[:2]
    rest = digits[len(country) :]
    parts = [rest[:3], rest[3:6], rest[6:]]
    national = pick.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}) {} {}", "{}/{}-{}"])
    return pick.choice([f"00{country} {' '.join(p for p in parts if p)}", national.format(*parts), national.format(*parts)]) if len(rest) >= 8 else f"00{country} {rest}"


def _spoiled(kind: str, span: str, pick: random.Random) -> str | None:
    """Something of like shape that is no personal data."""
    digits = _digits(span)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + pick.randint(1, 9)) % 10)
        return pick.choice([wrong, " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), ".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))])
    if kind == "ip":
        groups = _GROUP.findall(span)
        return pick.choice([".".join(groups[:3]), "[.]".join([*groups[:3], str(256 + int(groups[3][-2:]))]), " . ".join([*groups, "1"])])
    if kind == "phone":
        return pick.choice([digits[:6], digits, f"{digits[:4]}-{digits[4:8]}", f"{digits[:2]},{digits[2:5]},{digits[5:8]}.{digits[8:10]}"])
    local, domain = span.split("@")
    return pick.choice([f"{local} at {domain}", f"{local} dot {domain.split('.')[0]}", f"{local} at the {domain.split('.')[0]}. The"])


def _plain_number(pick: random.Random) -> str:
    """Numbers of everyday texts: dates, times, ranges, amounts, versions, counts."""
    n = pick.randrange
    return pick.choice([
        f"{n(1990, 2030)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1990, 2030)}", f"{n(1, 13):02}/{n(1, 29):02}/{n(1990, 2030)}", f"{n(1900, 2000)}-{n(2000, 2030)}",
        f"{n(1, 999)},{n(0, 1000):03},{n(0, 1000):03}", f"{n(0, 99)}.{n(0, 10**6):06}", f"{n(1, 20)}.{n(0, 20)}.{n(0, 20)}", f"{n(1, 20)}.{n(0, 20)}.{n(0, 2000)}", f"{n(10**3, 10**9)}",
        f"{n(10**10, 10**15)}", f"{n(1, 99)} {n(100, 999)} {n(100, 999)}", f"{n(1, 60)}-{n(1, 60)}", f"{n(10, 99)} {n(10, 99)} {n(10, 99)} {n(10, 99)}", f"{n(1000, 9999)} {n(1000, 9999)}",
    ])


def examples(texts: Sequence[str], seed: int = 13) -> list[Example]:
    """Windows with their truth: as found, rewritten, spoiled, and with plain numbers in place of what was found."""
    pick = random.Random(seed)
    out: list[Example] = []
    for text in texts:
        base: list[Span] = []
        for s, e, kind in sorted(base_spans(text), key=lambda x: (x[0], -x[1])):
            if not base or s >= base[-1][1]:
                base.append((s, e, kind))
        out.append((text, base))
        if not base:
            continue
        for way in ("rewritten", "rewritten", "spoiled", "plain"):
            pieces: list[str] = []
            at, truth = 0, []
            for s, e, kind in base:
                pieces.append(text[at:s])
                if pick.random() < {"rewritten": 0.5, "spoiled": 0.1, "plain": 0}[way]:
                    pieces.append(f"{pick.choice(CUES[kind])}{pick.choice([' ', ': '])}")
                new = _rewritten(kind, text[s:e], pick) if way == "rewritten" else _spoiled(kind, text[s:e], pick) if way == "spoiled" else _plain_number(pick)
                begin = sum(map(len, pieces))
                pieces.append(new)
                if way == "rewritten":
                    truth.append((begin, begin + len(new), kind))
                at = e
            out.append(("".join([*pieces, text[at:]]), truth))
    return out


def learn(documents: DataFrame, most_windows: int = 1200, epochs: int = 6, rate: float = 0.4, decay: float = 1e-3) -> Field:
    """Weights of the highest conditional likelihood of the truth in at most ``most_windows`` windows of the documents.

    A table in which the patterns find nothing teaches nothing; the field is empty then and adds nothing.
    """
    return fit(examples(sample_windows(documents, most_windows)), epochs, rate, decay)


def fit(given: Sequence[Example], epochs: int = 6, rate: float = 0.4, decay: float = 1e-3, seed: int = 5) -> Field:
    """Gradient steps of adaptive size over examples, one at a time, in an order that depends on ``seed`` alone."""
    field = Field.empty()
    if not any(truth for _, truth in given):
        return field
    ready = []
    for text, truth in given:
        found = candidates(text)
        types = {(s, e): BASE_KINDS.index(kind) for s, e, kind in truth}
        # of a plain form that is no candidate, or cut by the bounds, nothing can be learned
        target = sorted((c.start, k, types[c.start, c.end]) for k, c in enumerate(found) if (c.start, c.end) in types)
        if found:
            ready.append((found, [(k, y) for _, k, y in target]))
    squares, follow_squares = np.full_like(field.weights, 1e-2), np.full_like(field.following, 1e-2)
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(ready)
        for found, target in ready:
            _, expected, followed = expectations(field, found)
            change = np.zeros_like(field.weights)
            for k, c in enumerate(found):
                change[list(c.features)] -= expected[k]
            follow_change, before = -followed, len(BASE_KINDS)
            for k, y in target:
                change[list(found[k].features), y] += 1
                follow_change[before, y] += 1
                before = y
            for values, step, sums in ((field.weights, change, squares), (field.following, follow_change, follow_squares)):
                step -= decay * values
                sums += step * step
                values += rate * step / np.sqrt(sums)
    return field


# --- over tables --------------------------------------------------------------------------------------------------------

SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
#: Taken off the score of every segment that the field would add.
CAUTION = 2.0


def told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(documents: DataFrame, field: Field, caution: float = CAUTION) -> DataFrame:
    """``doc_id`` and ``spans`` (array of kind, start, end in code points) of every whole text.

    A null or empty text has no spans.  Rows are treated alone: repeated rows give repeated results, null ids stay null, and
    an empty table has no result.  Base spans of different kinds may overlap each other; added ones overlap nothing.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in all_spans(present(t.as_py()), field, caution)] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return map_batches(whole_documents(documents), work, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def digests(documents: DataFrame, field: Field, caution: float = CAUTION) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text; rows as in :func:`scan`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in batch.column("text"):
                spans = all_spans(present(text.as_py()), field, caution)
                base = [s for s in spans if s[2] in BASE_KINDS]
                values = [sum(s[2] == kind for s in base) for kind in BASE_KINDS]
                for column, value in zip(columns, [*values, hashlib.sha256(told(base).encode()).hexdigest(), told(spans)], strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, columns, kinds)], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return map_batches(whole_documents(documents), work, SCHEMA)


def masked(text: str, field: Field, caution: float = CAUTION) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named after the first."""
    out, at = [], 0
    merged: list[list] = []
    for start, end, kind in all_spans(text, field, caution):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind.removeprefix('likely_')}>"]
        at = end
    return "".join([*out, text[at:]])


def mask(documents: DataFrame, field: Field, caution: float = CAUTION) -> DataFrame:
    """All columns of ``documents``, personal data in ``text`` replaced; a null text stays null."""
    names = documents.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else masked(t, field, caution) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in names], list(names))

    return documents.mapInArrow(work, documents.schema)
