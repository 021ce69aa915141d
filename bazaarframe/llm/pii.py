"""Personal data by rules and by a semi-Markov conditional random field over whole spans.

Four patterns give the base spans. The field adds spans in other writings, such as phone numbers without a plus sign or
addresses with "(at)". Its segments are whole candidate spans of one kind, made of at most GROUPS digit groups or labels;
a segment's features look at all of it at once: digits in sum, group lengths, separators, check digit, octets, neighbours.
Everything between segments is a segment of its own with score 0. A forward pass over the ends of the candidates sums up
or maximises over all ways to divide a stretch of text, so boundaries and kinds are chosen together, in a time that grows with
the candidates.

The field is trained here on a bounded sample of stretches of the documents, one of each shape. They are labelled by the
patterns, and by rewriting labelled spans in other ways, or with broken check digits and octets for spans that must not be found.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Digit groups or labels of a candidate, at most.
GROUPS = 8
#: Shapes of stretches that the field learns from, at most; the others are left out by hash.
SAMPLE = 400
#: Characters of a stretch, and beside it, that a sample keeps.
STRETCH, BESIDE = 160, 12
_STEPS, _RATE, _DECAY = 80, 0.5, 0.02

# Fixed patterns of the base spans.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

#: Digit groups with a few separators between them.
_NUMBERS = re.compile(r"[0-9]++(?:[\x20\xa0().\[\]/_-]{1,3}[0-9]++)*+")
#: What stands for the @ sign and for the dots after it.
_AT = re.compile(r"@|[\[({] ?[aA][tT] ?[\])}]|(?<= )[aA][tT](?= )")
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_DOT = re.compile(r" ?(?:\.|[\[({] ?(?:\.|[dD][oO][tT]) ?[\])}]) ?| [dD][oO][tT] ")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the four patterns by kind and start."""
    spans = []
    end = done = 0
    at = text.find("@")
    while at >= 0:
        local = text[done:at]
        start = done + len(local.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append((0, start, match.end()))
            end = match.end()
        done = max(end, at + 1)
        at = text.find("@", at + 1)
    for match in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.group().split(".")):
            spans.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *match.span()))
    for match in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(match.group()))) <= 15:
            spans.append((3, *match.span()))
    return spans


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


@dataclass
class Segment:
    """A candidate span of one kind with its features."""

    start: int
    end: int
    kind: int
    features: list[str]


def _beside(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "none"
    c = text[at]
    return "digit" if c in "0123456789" else "letter" if c.isalpha() else "blank" if c.isspace() else c if c in "+-.@(" else "other"


def _number_segments(text: str, match: re.Match, bare: bool) -> Iterator[Segment]:
    groups = [(m.start(), m.end()) for m in _DIGITS.finditer(text, match.start(), match.end())]
    for i, (start, _) in enumerate(groups):
        while start and text[start - 1] in "+(" and groups[i][0] - start < 2:
            start -= 1
        lead = text[start : groups[i][0]]
        digits = 0
        for j in range(i, min(i + GROUPS, len(groups))):
            digits += groups[j][1] - groups[j][0]
            if digits > 19:
                break
            many, end = j - i + 1, groups[j][1]
            kinds = [k for k, fits in ((1, many == 4 and digits <= 12), (2, digits >= 13), (3, 9 <= digits <= 15)) if fits]
            if not kinds:
                continue
            if bare:
                yield Segment(start, end, kinds[0], [])
                continue
            own = groups[i : j + 1]
            parts = [text[a:b] for a, b in own]
            between = [text[a[1] : b[0]] for a, b in zip(own, own[1:])]
            said = [
                f"digits {digits}",
                f"groups {many}",
                "lead " + ("00" if not lead and parts[0].startswith("00") else lead),
                "between " + "".join(sorted(set("".join(between)))),
                "same between" if len(set(between)) < 2 else "mixed between",
                "lengths " + " ".join(str(len(p)) for p in parts),
                "left " + _beside(text, start - 1),
                "right " + _beside(text, end),
            ]
            said.append("digit group before" if i else "first group")
            said.append("digit group after" if j + 1 < len(groups) else "last group")
            for k in kinds:
                check = ["octets" if all(int(p) <= 255 for p in parts) else "no octets"] if k == 1 else []
                check += ["check digit" if luhn("".join(parts)) else "no check digit"] if k == 2 else []
                yield Segment(start, end, k, [f"{k} {f}" for f in (*said, *check, "any")])


def _address_segments(text: str, match: re.Match, done: int, bare: bool) -> Iterator[Segment]:
    left = match.start() - (match.start() > done and text[match.start() - 1] == " ")
    local = text[max(done, left - 64) : left]
    start = left - (len(local) - len(local.rstrip(_LOCAL)))
    label = _LABEL.match(text, match.end() + (match.end() < len(text) and text[match.end()] == " "))
    if start == left or not label:
        return
    sign = re.sub("[a-zA-Z]+", "at", text[left : label.start()])
    local, dots = text[start:left], []
    for many in range(2, GROUPS + 1):
        dot = _DOT.match(text, label.end())
        label = dot and _LABEL.match(text, dot.end())
        if not label:
            return
        if bare:
            yield Segment(start, label.end(), 0, [])
            continue
        dots.append(re.sub("[a-zA-Z]+", "dot", dot.group()))
        last, more = label.group(), _DOT.match(text, label.end())
        said = [
            f"sign {sign}",
            f"dot {dots[-1]}",
            "same dots" if len(set(dots)) == 1 else "mixed dots",
            f"labels {many}",
            "last " + ("letters" if last.isalpha() and last.islower() else "mixed") + f" {min(len(last), 7)}",
            "local " + ("digit " if re.search("[0-9]", local) else "") + ("dot" if "." in local.strip(".") else ""),
            "more labels" if more and _LABEL.match(text, more.end()) else "last label",
            "left " + _beside(text, start - 1),
            "right " + _beside(text, label.end()),
            "any",
        ]
        yield Segment(start, label.end(), 0, [f"0 {f}" for f in said])


def _addresses(text: str, bare: bool) -> Iterator[Segment]:
    done = 0
    for match in _AT.finditer(text):
        if match.group() == "@" or _DOT.search(text, match.end(), match.end() + 64):
            yield from _address_segments(text, match, done, bare)
        done = match.end()


def _numbers(text: str, bare: bool) -> Iterator[Segment]:
    for match in _NUMBERS.finditer(text):
        if match.end() - match.start() >= 7:
            yield from _number_segments(text, match, bare)


def segments(text: str, bare: bool = False) -> Iterator[Segment]:
    """All candidates of a text by start; bare: without features, one for all kinds of a span."""
    return heapq.merge(_addresses(text, bare), _numbers(text, bare), key=lambda s: s.start)


def stretches(found: Iterator[Segment]) -> Iterator[list[Segment]]:
    """Candidates that overlap one another, stretch by stretch."""
    held, end = [], -1
    for segment in found:
        if held and segment.start >= end:
            yield held
            held = []
        held.append(segment)
        end = max(end, segment.end)
    if held:
        yield held


def _places(found: list[Segment]) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of boundaries, and per candidate by end (end, start, index)."""
    place = {p: i for i, p in enumerate(sorted({p for s in found for p in (s.start, s.end)}))}
    return len(place), sorted((place[s.end], place[s.start], i) for i, s in enumerate(found))


def best_segments(found: Iterable[Segment], weights: dict[str, float]) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the most probable division; candidates come by start, and only open ones are held."""
    best: tuple = (0.0, None)  # score up to here, spans as nested pairs (span, spans before)
    ends: list[tuple] = []  # heap of (end, number, score, spans)
    for number, s in enumerate(found):
        while ends and ends[0][0] <= s.start:
            _, _, score, spans = heapq.heappop(ends)
            if score > best[0]:
                best = (score, spans)
        own = sum(weights.get(f, 0.0) for f in s.features)
        if own > 0:
            heapq.heappush(ends, (s.end, number, best[0] + own, ((s.kind, s.start, s.end), best[1])))
    for _, _, score, spans in sorted(ends):
        if score > best[0]:
            best = (score, spans)
    out, spans = [], best[1]
    while spans:
        out.append(spans[0])
        spans = spans[1]
    return out[::-1]


def _add(x: float, y: float) -> float:
    high, low = (x, y) if x > y else (y, x)
    return high + math.log1p(math.exp(low - high))


def probabilities(n: int, steps: list[tuple[int, int, int]], scores: np.ndarray) -> np.ndarray:
    """Probability of each candidate, by a forward and a backward sum over all divisions of its stretch."""
    own = scores.tolist()
    ahead, at = [0.0] * n, 0
    for b in range(1, n):
        total = ahead[b - 1]
        while at < len(steps) and steps[at][0] == b:
            total = _add(total, ahead[steps[at][1]] + own[steps[at][2]])
            at += 1
        ahead[b] = total
    back = [0.0] * n
    out, by_start = np.zeros(len(own)), sorted(steps, key=lambda s: -s[1])
    at = 0
    for a in reversed(range(n - 1)):
        total = back[a + 1]
        while at < len(by_start) and by_start[at][1] == a:
            total = _add(total, back[by_start[at][0]] + own[by_start[at][2]])
            at += 1
        back[a] = total
    for b, a, i in steps:
        out[i] = math.exp(ahead[a] + own[i] + back[b] - ahead[n - 1])
    return out


def train(examples: list[tuple[list[Segment], set[tuple[int, int, int]]]]) -> dict[str, float]:
    """Weights of the features that make the marked segments of the stretches most probable, with a decay to 0."""
    number: dict[str, int] = {}
    for found, _ in examples:
        for s in found:
            for f in s.features:
                number.setdefault(f, len(number))
    if not number:
        return {}
    rows, columns, cuts, gold, places = [], [], [0], [], []
    for found, marked in examples:
        places.append(_places(found))
        for s in found:
            ids = [number[f] for f in s.features]
            rows += [len(gold)] * len(ids)
            columns += ids
            gold.append((s.kind, s.start, s.end) in marked)
        cuts.append(len(gold))
    rows, columns, gold = np.array(rows), np.array(columns), np.array(gold, float)
    weights, seen = np.zeros(len(number)), np.full(len(number), 1e-6)
    for _ in range(_STEPS):
        scores = np.bincount(rows, weights[columns], len(gold))
        chance = np.concatenate([probabilities(*p, scores[a:b]) for p, a, b in zip(places, cuts, cuts[1:])])
        slope = np.bincount(columns, (gold - chance)[rows], len(number)) - _DECAY * weights
        seen += slope**2
        weights += _RATE * slope / np.sqrt(seen)
    return {f: float(weights[i]) for f, i in number.items()}


def _shape(text: str) -> str:
    return re.sub("[^\\W\\d_]+", "a", re.sub("[0-9]", "0", text))


def rewritten(kind: int, span: str, rng: random.Random) -> list[str]:
    """Other writings of a span."""
    if kind == 0:
        name, domain = span.split("@")
        ways = [(" @ ", "."), ("(at)", "."), (" (at) ", "."), ("[at]", "."), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("{at}", ".")]
        return [name + a + domain.replace(".", d) for a, d in ways]
    groups = _DIGITS.findall(span)
    if kind == 1:
        return [s.join(groups) for s in ("[.]", " . ", "(.)")]
    digits = "".join(groups)
    if kind == 2:
        cut = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [digits, *[s.join(cut) for s in (" ", "-", ".", "/", "\xa0", " - ", "  ", "_")]]
    body = digits[-10:]
    a, b, c, front = body[:3], body[3:6], body[6:], digits[:-10]
    out = [f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"{a}/{b}-{c}"] if len(body) == 10 else []
    for front in sorted({front, "1", "44", "351"} - {""}) if out else ():
        out += [f"{front} ({a}) {b}-{c}", f"00{front} {a} {b} {c}", f"00{front}-{a}-{b}-{c}", f"00{front} ({a}) {b}-{c}", f"{front}-{a}-{b}-{c}", f"+{front}/{a}/{b}/{c}", f"+{front}\xa0{a}\xa0{b}\xa0{c}"]
    return out


def broken(kind: int, span: str) -> str | None:
    """The span with a wrong check digit or octet, or with a common word before a worded sign."""
    if kind == 0:
        return re.sub("^[^ ]*", "look", span) if " at " in span else None
    if kind == 2:
        return span[:-1] + str((int(span[-1]) + 1) % 10)
    if kind == 1:
        return re.sub("[0-9]+$", "999", span)
    return None


#: Writings of numbers that are no personal data; each 0 is a digit.
HARMLESS = (
    "0000-00-00 00:00:00", "0000-00-00", "00.00.0000", "00/00/0000", "000 000 000", "0 000 000 000", "00 000 000 000",
    "0.0000000000", "000.0000000000", "0000-0000", "0000-0000-0000", "000-0-00-000000-0", "00000000000", "000000000",
    "0.0.0", "00.00.00 00", "0000000000000000", "000 00 0000 00", "0000/0000/0000", "(0000) 0000-0000-00",
    "00.00.0000 at 00.00.00", "00.0 at 00.00", "look at example.com", "v0.0 at mail0.example.com", "chapter.0 at 0.0.0",
)


def examples(samples: list[str], seed: int = 12) -> list[tuple[list[Segment], set[tuple[int, int, int]]]]:
    """Labelled stretches from samples of text: as they stand, rewritten and broken, and harmless numbers beside them."""
    rng, texts = random.Random(seed), []
    for sample in samples:
        base = base_spans(sample)
        texts.append((sample, set(base)))
        for k, a, b in base:
            left, span, right = sample[max(0, a - BESIDE) : a], sample[a:b], sample[b : b + BESIDE]
            for way in rewritten(k, span, rng):
                texts.append((left + way + right, {(k, len(left), len(left) + len(way))}))
                if (wrong := broken(k, way)) is not None:
                    texts.append((left + wrong + right, set()))
    if texts:
        for form in HARMLESS:
            for _ in range(6):
                text = "x " + re.sub("0", lambda _: rng.choice("0123456789"), form) + " x"
                texts.append((text, set(base_spans(text))))
    out = []
    for text, marked in texts:
        for found in stretches(segments(text)):
            own = {m for m in marked if found[0].start <= m[1] < max(s.end for s in found)}
            if own <= {(s.kind, s.start, s.end) for s in found}:
                out.append((found, own))
    return out


def _extents(found: Iterator[Segment]) -> Iterator[tuple[int, int]]:
    """Start and end of each stretch."""
    start, end = -1, -1
    for s in found:
        if s.start >= end:
            if end > 0:
                yield start, end
            start = s.start
        end = max(end, s.end)
    if end > 0:
        yield start, end


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {}
        for text in batch.column(0):
            text = text.as_py() or ""
            for start, end in _extents(segments(text, bare=True)):
                if end - start <= STRETCH:
                    piece = text[max(0, start - BESIDE) : end + BESIDE]
                    out.setdefault(_shape(piece), piece)
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.string())], ["shape", "piece"])


def fit(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> dict[str, float]:
    """Weights learned from at most ``sample`` stretches of the documents, one of each shape, the least by hash.

    All documents offer their stretches; only the sample, some 200 characters each, reaches the driver. Without any
    stretch there are no weights, and nothing is added to the base spans.
    """
    text = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = text.mapInArrow(_samples, "shape string, piece string").groupBy("shape").agg(F.min("piece").alias("piece"))
    rows = pieces.orderBy(F.xxhash64("shape"), "shape").limit(sample).collect()
    return train(examples([r["piece"] for r in rows]))


def all_spans(text: str, base: list[tuple[int, int, int]], weights: dict[str, float]) -> list[tuple[int, int, int]]:
    """The base spans, and those of the field that touch none of them."""
    taken: list[list[int]] = []  # stretches of the text that base spans cover
    for start, end in sorted((s, e) for _, s, e in base):
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])

    def free() -> Iterator[Segment]:
        i = 0
        for s in segments(text):
            while i < len(taken) and taken[i][1] <= s.start:
                i += 1
            if i == len(taken) or s.end <= taken[i][0]:
                yield s

    added = best_segments(free(), weights) if weights else []
    return sorted(base + added)


def _found(weights: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [[] for _ in KINDS], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                for k, n in enumerate(counts):
                    n.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(all_spans(text, base, weights)))
            columns = [batch.column(0), *[pa.array(n, pa.int64()) for n in counts], pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return run


def personal_data(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>``, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and base_sha256 (digest of ``kind:start:end``, comma-joined, by kind and start) are those of the base
    patterns, which never depend on the model; spans lists them and what the field adds, in the same form. Places count
    code points, ends are exclusive. Added spans touch no base span and one another.

    A null, empty or blank text has no spans; a text is searched whole, however long. Repeated rows and rows without an id
    are each described by their own text. An empty table gives an empty result; other columns are ignored, whatever
    their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_found(weights), f"id {kind}, {counts}, base_sha256 string, spans string").withColumnRenamed("id", id_col)
