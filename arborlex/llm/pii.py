r"""Operator 12: personal data by a semi-Markov conditional random field.

Base findings come from four patterns (``base_findings``) and always stay.  The field adds what they miss: numbers
that stand side by side and run together in a pattern (``no retries``), telephone numbers without a plus, masked at-signs and
dots.

A *region* is a stretch of text around digits or at-signs.  Its tokens are runs of letters, runs of digits and
single other characters.  A *segment* is a run of at most ``LONGEST`` tokens, and each segment of a kind is scored
as a whole: its shape, groups and number of digits, separators, Luhn's check, the range of address parts, brackets that match, what stands
before and after.  Tokens outside all segments are scored one by one.  Dynamic programming over the region finds
the best segmentation, so boundaries and kinds are chosen together; a segment counts if its
probability under the field reaches ``SURE``.  An added span overlaps no base finding of its kind.

Training.  A sample of regions, at most ``SAMPLE`` of each kind and of regions without findings, is labelled by
its base findings; regions where numbers ran together in a pattern are no examples.  Every sampled region gives its labelled text, and rules (``_variant``) rewrite findings: side by
side, without a plus, with other separators, masked signs.  Decoys (dates, versions, amounts, times, decimal numbers) are
labelled as nothing.  The field is fitted by the gradient of the conditional likelihood, with forward and backward sums
over the same segments.  Samples, rewriting and fitting are seeded: equal input gives equal spans.

Edge cases.  Null and empty texts have no findings.  Places are code points.  Repeated rows get equal results.
Without any base finding in the whole table nothing is trained and nothing added.  Regions of long texts are
cut into parts of at most ``REGION`` characters.  Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, written

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SURE = 60, 0.9
LONGEST, REGION, AROUND = 24, 1024, 24
ROUNDS, RATE, DECAY = 4, 0.1, 1e-4

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Each at-sign with the run of name characters before it; one pass, however long the runs are."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        run = _LOCAL.match(text[end:at][::-1]).end()
        domain = _DOMAIN.match(text, at + 1) if run else None
        if domain:
            out.append((at - run, domain.end()))
            end = domain.end()
        else:
            end = at + 1
        at = text.find("@", end)
    return out


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(a, b, "email") for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(map(_small, m.groups())):
            out.append((*m.span(), "ip"))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((*m.span(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def run_on(text: str) -> bool:
    """Whether a pattern failed for too many digits only: whatever stands there ran together, and is no example of anything."""
    return any(len(_NOT_DIGIT.sub("", m[0])) > most for pattern, most in ((_CARD, 19), (_PHONE, 15)) for m in pattern.finditer(text))


def spans_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


# regions and their segments ------------------------------------------------------------------

_ANCHOR = re.compile(r"[0-9]|@|[\[({<]\s?at\s?[\])}>]|\sat\s(?=\S+\sdot\s)", re.I | re.A)
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
_BEFORE_WORD = re.compile(r"\s(?=[A-Za-z]{2,}[\s.,])")
_AT = re.compile(r"@|[\[({<]\s?at\s?[\])}>]|\sat\s", re.I | re.A)


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around anchors, each with ``AROUND`` characters on both sides; those that touch are one.  A stretch of more
    than ``REGION`` characters is cut before a word of letters, or else at a blank, or else as it is."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    short = []
    for a, b in out:
        while b - a > REGION:
            cut = _BEFORE_WORD.search(text, a + REGION // 2, a + REGION)
            c = cut.start() + 1 if cut else text.rfind(" ", a + REGION // 2, a + REGION) + 1 or a + REGION
            short.append((a, c))
            a = c
        short.append((a, b))
    return short


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _digits(text: str) -> str:
    return _NOT_DIGIT.sub("", text)


def features(text: str, start: int, end: int) -> list[str] | None:
    """Names of what holds for the segment as a whole; None if it can be no finding of any kind."""
    part = text[start:end]
    digits = _digits(part)
    at = _AT.search(part)
    if at:
        head, tail = part[:at.start()], part[at.end():]
        masked = at[0] != "@"
        dots = re.split(r"\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\s?[\[({<]\s?\.\s?[\])}>]\s?|\sdot\s", tail, flags=re.I)
        clean = all(re.fullmatch(r"[A-Za-z0-9-]+", x) for x in dots)
        name = bool(re.fullmatch(r"[A-Za-z0-9._%+-]+", head.rstrip() if masked else head))
        before = text[start - 1:start]
        return ["at", f"at:masked={masked}", f"at:name={name}", f"at:clean={clean}", f"at:dots={min(len(dots), 4)},{clean}",
                f"at:top={2 <= len(dots[-1]) <= 6 and dots[-1].isalpha()}", f"at:whole={name and clean and len(dots) > 1}",
                f"at:starts={bool(re.match('[A-Za-z0-9._%+-]', before))}", f"at:goes={bool(re.match('[A-Za-z0-9-]', text[end:end + 1]))}"]
    if not 4 <= len(digits) <= 19 or not (part[0].isdigit() or part[0] in "+(") or not part[-1].isdigit() or re.search(r"[A-Za-z\n,;:/=\"']", part):
        return None
    groups = re.findall(r"[0-9]+", part)
    between = re.split(r"[0-9]+", part)[1:-1]
    n = len(digits)
    before, after = text[start - 1:start] or " ", text[end:end + 1] or " "
    beyond = text[end + 1:end + 2]
    out = [f"n={n}", f"groups={len(groups)}", f"sizes={'-'.join(str(len(g)) for g in groups[:6])}", f"sep={''.join(sorted(set(''.join(between))))}",
           f"plus={part[0] == '+'}", f"open={part.count('(')},{part.count(')')}",
           f"shape={re.sub('[0-9]+', '9', part)[:20]}", f"luhn={12 <= n <= 19 and luhn(digits)}", f"card={12 <= n <= 19 and luhn(digits) and len({*between}) < 2 and (not between or between[0] in (' ', '-'))}",
           f"before={_side(before)}", f"after={_side(after)}", f"cut={before.isdigit() or after.isdigit()}",
           f"goes={after in '.-' and beyond.isdigit()}", f"came={before in '.-+(' and (before in '+(' or text[start - 2:start - 1].isdigit())}"]
    if len(groups) == 4:
        dots = all(re.fullmatch(r"\.|[\[(]\.[\])]", x) for x in between)
        out.append(f"ip={dots and all(map(_small, groups)) and part[0].isdigit()}")
    ten = n >= 10 and len(groups[-1]) == 4 and len(groups) >= 3 and len(groups[-2]) == 3 and len(groups[-3]) == 3
    out.append(f"ten={ten},{len(groups) if ten else 0},{part[0] if not part[0].isdigit() else 9}")
    return out


def _side(c: str) -> str:
    return "d" if c.isdigit() else "a" if c.isalpha() else "s" if c.isspace() else "p" if c in ".,;:!?)\"'" else c


def segments(text: str, places: list[tuple[int, int]]) -> list[tuple[int, int, list[str]]]:
    """(first token, last token + 1, features) of all segments that could be findings."""
    edge = [text[a].isascii() and (text[a].isalnum() or text[a] in "+(") for a, _ in places]
    marks = [text[a].isdigit() or text[a] == "@" for a, _ in places]
    at = [m.start() for m in _AT.finditer(text)]
    out = []
    for i, (a, _) in enumerate(places):
        if not edge[i] or (text[a].isalpha() and not any(a < x <= a + 64 for x in at)):
            continue
        seen = False
        for j in range(i, min(i + LONGEST, len(places))):
            b, c = places[j]
            if text[b] in "\n\r\t":
                break
            seen = seen or marks[j]
            if text[b].isascii() and text[b].isalnum() and (seen or any(a < x < c for x in at)):
                found = features(text, a, c)
                if found is not None:
                    out.append((i, j + 1, found))
    return out


def _outside(text: str, a: int, b: int) -> int:
    """The class of a token outside all segments."""
    c = text[a]
    return 0 if c.isdigit() and b - a < 4 else 1 if c.isdigit() else 2 if c.isalpha() else 3 if c == "@" else 4 if c == "+" else 5


_OUTSIDE = 6


class Field:
    """Weights of features by kind, and of classes of tokens outside."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.weights = np.zeros((0, len(KINDS)))
        self.outside = np.zeros(_OUTSIDE)

    def lattice(self, text: str, learn: bool = False):
        """(tokens, segments by their end, numbers of the segments' features, classes of tokens outside)."""
        places = tokens(text)
        ends: list[list[int]] = [[] for _ in range(len(places) + 1)]
        spans, numbers = [], []
        for i, j, found in segments(text, places):
            if learn:
                numbers.append([self.number.setdefault(f, len(self.number)) for f in found])
            else:
                numbers.append([self.number[f] for f in found if f in self.number])
            ends[j].append(len(spans))
            spans.append((i, j))
        return places, ends, spans, numbers, [_outside(text, *p) for p in places]

    def scores(self, numbers: list[list[int]]) -> np.ndarray:
        return np.array([self.weights[x].sum(axis=0) for x in numbers]).reshape(-1, len(KINDS))

    def sums(self, lattice, scores: np.ndarray):
        """Forward sums, backward sums and the logarithm of the whole."""
        places, ends, spans, _, out = lattice
        n = len(places)
        whole = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        ahead, back = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            x = ahead[j - 1] + self.outside[out[j - 1]]
            for s in ends[j]:
                x = _add(x, ahead[spans[s][0]] + whole[s])
            ahead[j] = x
        back[:n] = -np.inf
        for j in range(n, 0, -1):
            back[j - 1] = _add(back[j - 1], back[j] + self.outside[out[j - 1]])
            for s in ends[j]:
                i = spans[s][0]
                back[i] = _add(back[i], back[j] + whole[s])
        return ahead, back, ahead[n]

    def probabilities(self, lattice, scores):
        """Of each segment and kind, and of each token to stand outside."""
        places, _, spans, _, out = lattice
        ahead, back, total = self.sums(lattice, scores)
        at = np.array(spans, np.int64).reshape(-1, 2)
        inside = np.exp(ahead[at[:, 0], None] + scores + back[at[:, 1], None] - total)
        n = len(places)
        alone = np.exp(ahead[:n] + self.outside[out] + back[1:] - total) if n else np.zeros(0)
        return inside, alone

    def fit(self, regions_: list[tuple[str, list[tuple[int, int, str]]]], rounds: int = ROUNDS, seed: int = 3) -> None:
        """Adaptive gradient steps, one region at a time, of the conditional likelihood."""
        known = []
        for text, gold in regions_:
            lattice = self.lattice(text, learn=True)
            places, _, spans, _, _ = lattice
            start, end = {a: i for i, (a, _) in enumerate(places)}, {b: i + 1 for i, (_, b) in enumerate(places)}
            at = {s: k for k, s in enumerate(spans)}
            truth = [(at.get((start.get(a), end.get(b))), KINDS.index(kind)) for a, b, kind in gold]
            if all(s is not None for s, _ in truth):  # else a finding is longer than a segment may be
                known.append((lattice, truth))
        self.weights = np.zeros((len(self.number), len(KINDS)))
        power, power_out = np.full(len(self.number), 1e-2), np.full(_OUTSIDE, 1e-2)
        order = list(range(len(known)))
        rng = random.Random(seed)
        for _ in range(rounds):
            rng.shuffle(order)
            for k in order:
                lattice, truth = known[k]
                places, _, spans, numbers, out = lattice
                inside, alone = self.probabilities(lattice, self.scores(numbers))
                grad, free = -inside, -alone
                outside = np.ones(len(places))
                for s, kind in truth:
                    grad[s, kind] += 1
                    outside[slice(*spans[s])] = 0
                free = free + outside
                flat = np.array([f for x in numbers for f in x], np.int64)
                which = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
                used, place = np.unique(flat, return_inverse=True)
                step = np.zeros((len(used), len(KINDS)))
                np.add.at(step, place, grad[which])
                power[used] += (step ** 2).sum(axis=1)
                self.weights[used] += RATE * (step / np.sqrt(power[used])[:, None] - DECAY * self.weights[used])
                free = np.bincount(out, free, _OUTSIDE)
                power_out += free ** 2
                self.outside += RATE * free / np.sqrt(power_out)

    def best(self, text: str, sure: float = SURE) -> list[tuple[int, int, str, float]]:
        """(start, end, kind, probability) of the best segmentation's segments that are sure."""
        lattice = self.lattice(text)
        places, ends, spans, numbers, out = lattice
        if not spans:
            return []
        scores = self.scores(numbers)
        top, kind = scores.max(axis=1), scores.argmax(axis=1)
        value, came = [0.0], [None]
        for j in range(1, len(places) + 1):
            best, by = value[j - 1] + self.outside[out[j - 1]], None
            for s in ends[j]:
                x = value[spans[s][0]] + top[s]
                if x > best:
                    best, by = x, s
            value.append(best)
            came.append(by)
        inside, _ = self.probabilities(lattice, scores)
        found, j = [], len(places)
        while j:
            s = came[j]
            if s is None:
                j -= 1
                continue
            i = spans[s][0]
            if inside[s, kind[s]] >= sure:
                found.append((places[i][0], places[j - 1][1], KINDS[kind[s]], float(inside[s, kind[s]])))
            j = i
        return found[::-1]


def _add(a: float, b: float) -> float:
    if a == -np.inf or b == -np.inf:
        return max(a, b)
    m = max(a, b)
    return m + np.log1p(np.exp(min(a, b) - m))


# training ------------------------------------------------------------------------------------

def _variant(kind: str, part: str, rng: random.Random) -> str:
    """A finding in another form that the patterns miss."""
    if kind == "email":
        name, host = part.split("@", 1)
        a, d = rng.choice(((" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), ("[at]", ".")))
        return name + a + host.replace(".", d)
    if kind == "ip":
        dot = rng.choice(("[.]", "(.)"))
        return part.replace(".", dot)
    digits = _digits(part)
    if kind == "card":
        sep = rng.choice((" ", "-", "."))
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    if len(a) < 3:
        return part
    return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}){b}-{c}", f"+{digits[:-10] or 1}-{a}-{b}-{c}",
                       f"+{digits[:-10] or 1} {a} {b} {c}", f"({a}) {b} {c}"))


def _decoy(rng: random.Random) -> str:
    """A number that is no finding."""
    r = rng.randrange
    return rng.choice((
        f"{1900 + r(140)}-{1 + r(12):02d}-{1 + r(28):02d}", f"{1 + r(28):02d}.{1 + r(12):02d}.{1900 + r(140)}", f"{r(24):02d}:{r(60):02d}:{r(60):02d}",
        f"{r(10)}.{r(20)}.{r(30)}", f"v{r(10)}.{r(20)}", f"{r(100)},{r(1000):03d}.{r(100):02d}", f"{1900 + r(100)}-{2000 + r(40)}", f"{r(10 ** 9)}", f"{r(10 ** 12)}",
        f"{r(1000)} {r(1000)} {r(1000)}", f"{r(100)}.{r(10 ** 6)}", f"{r(10 ** 5):05d}-{r(10 ** 4):04d}", f"{r(10 ** 15, 10 ** 16)}1"[:16],
        f"{r(10)}.{r(20)}.{r(30)}.{256 + r(700)}", f"{r(10)}-{r(1000):03d}-{r(10 ** 5):05d}-{r(10)}"))


def training_regions(sample: list[tuple[str, list[tuple[int, int, str]]]], seed: int = 9):
    """The sampled regions with rewritten findings, findings side by side, and decoys."""
    rng = random.Random(seed)
    parts = [(kind, text[a:b]) for text, gold in sample for a, b, kind in gold]
    out = []
    for text, gold in sample:
        if any(x[1] > y[0] for x, y in zip(gold, gold[1:], strict=False)):
            continue
        out.append((text, gold))
        for times in range(2):
            at, made, spans = 0, "", []
            for a, b, kind in gold:
                made += text[at:a]
                piece = _variant(kind, text[a:b], rng) if (times + rng.randrange(2)) % 2 else text[a:b]
                todo = [(kind, piece)]
                if parts and rng.randrange(2):  # another finding beside it
                    other, more = rng.choice(parts)
                    todo.insert(rng.randrange(2), (other, _variant(other, more, rng) if rng.randrange(3) == 0 else more))
                for k, (what, piece) in enumerate(todo):
                    made += " " * bool(k)
                    spans.append((len(made), len(made) + len(piece), what))
                    made += piece
                at = b
            made += text[at:]
            if rng.randrange(2):
                made += " " + _decoy(rng)
            out.append((made, spans))
        out.append((f"{text[:gold[0][0]] if gold else text} {_decoy(rng)} {text[gold[-1][1]:] if gold else _decoy(rng)}", []))
    return out


def _cut(text: str, gold, a: int, b: int):
    return text[a:b], [(x - a, y - a, k) for x, y, k in gold if a <= x and y <= b]


_SCAN = ("doc_id bigint, base string, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, starts array<int>, "
         "parts array<string>, kinds array<string>, golds array<string>")


def scan(docs: DataFrame) -> DataFrame:
    """Per row: base findings, and the regions with their starts, kinds of findings (for the sample) and findings by place in the region."""
    names = [c.split()[0] for c in _SCAN.split(", ")]
    types = [pa.int64(), pa.string(), *[pa.int64()] * 4, pa.list_(pa.int32()), *[pa.list_(pa.string())] * 3]

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                base = base_findings(text)
                areas = regions(text)
                cuts = [_cut(text, base, a, b) for a, b in areas]
                rows.append((doc_id, spans_text(base), *(sum(k == kind for _, _, k in base) for kind in KINDS), [a for a, _ in areas],
                             [x for x, _ in cuts], ["?" if run_on(x) else "+".join(sorted({k for _, _, k in g})) for x, g in cuts], [spans_text(g) for _, g in cuts]))
            columns = list(zip(*rows, strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return bounded(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SCAN)


def _spans(text: str) -> list[tuple[int, int, str]]:
    return [(int(a), int(b), k) for k, a, b in (x.split(":") for x in text.split(",") if x)]


def train(found: DataFrame, sample: int = SAMPLE) -> Field | None:
    """The field fitted on at most ``sample`` regions of each kind of finding and as many without any; None without findings."""
    areas = found.select(F.explode(F.arrays_zip("parts", "kinds", "golds")).alias("x")).select("x.*").distinct()
    drawn = []
    for kind in (*KINDS, ""):
        rows = areas.where(F.col("kinds") == kind).orderBy(F.xxhash64("parts"), "parts", "golds").limit(sample).collect()
        drawn += [(r.parts, _spans(r.golds)) for r in rows]
    if not any(gold for _, gold in drawn):
        return None
    field = Field()
    field.fit(training_regions(drawn))
    return field


def find(docs: DataFrame, sample: int = SAMPLE, sure: float = SURE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row: ``base`` and ``spans`` as ``kind:start:end`` joined by commas."""
    found = written(scan(docs), "pii")
    field = train(found, sample)

    def run(batches):
        for batch in batches:
            spans, known = [], {}
            for base, starts, parts in zip(*(batch.column(i).to_pylist() for i in (1, 6, 7)), strict=True):
                held = _spans(base)
                more = []
                for start, part in zip(starts, parts, strict=True):
                    if part not in known:
                        known[part] = field.best(part, sure) if field else []
                    for a, b, kind, _ in known[part]:
                        a, b = a + start, b + start
                        if not any(k == kind and x < b and a < y for x, y, k in held):
                            more.append((a, b, kind))
                spans.append(spans_text(sorted(held + more, key=lambda x: (x[0], KINDS.index(x[2])))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(i) for i in range(2, 6)), batch.column(1), pa.array(spans, pa.string())],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return found.select("doc_id", "base", "n_email", "n_ip", "n_card", "n_phone", "starts", "parts").mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, spans string")


def personal_data(docs: DataFrame, sample: int = SAMPLE, sure: float = SURE) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row of ``docs(doc_id, text, ...)``."""
    return find(docs, sample, sure).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def masked(text: str, spans: str) -> str:
    """The text with each span replaced by its kind; spans that overlap are one, named by the first."""
    out, at = [], 0
    for a, b, kind in _spans(spans):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + text[at:]

