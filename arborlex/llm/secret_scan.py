"""Operator 8: secret scans with a character convolutional network over candidates in context.

Base findings come from three patterns (``PATTERNS``).  Candidates are all base findings and all other
runs of token characters with both digits and letters.  Every candidate and its surroundings make a window of
``WIDTH`` characters, a longer one overlapping windows over its whole length; a small convolutional network in numpy
scores them, and the highest score counts.

Training.  No table labels secrets, so the labelled findings are the base findings, all of them, each also in other characters of
the same kinds (``again``), so that few are enough: a label has ``SAMPLE`` rows at least.  The other candidates are what the network has to
judge and have no label.  The second label are plain words (one a text), ordinary tokens (hosts after an at-sign or a scheme, dates, numbers, paths
and names of words), all of them, and such tokens made of the words (``ordinary``).  In half of the training findings the text before is that of a
plain word, so that the network has to know a secret by its characters and not only by the word before it.  The rows are dealt to
shards of a bounded size; in every round each shard goes on from the common weights over its rows, and the results are averaged
by their rows.  Both labels weigh the same.  Scores are calibrated by a logistic curve on findings the training didn't see (counted by margins cut to
steps of ``STEP``).  The highest threshold that still finds ``RECALL`` of those is the
limit; where the ``QUIET`` lowest of the second label's lie below it, the threshold is in the middle of the two.

The network scores every candidate.  Those that reach the threshold and overlap no base finding are added as spans of kind ``cnn``; tokens
of an ordinary form (``ordinary_form``, and hosts after an at-sign) have to score above all of the second label that the limit was set on.
Base findings always stay.

Edge cases.  Null and empty texts have no findings.  Places are code points.  Repeated rows get equal
results.  Without any base finding or any plain word in the whole table nothing is trained and nothing added.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, release
from .common import bounded, written

#: Fixed values of the contract.
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),  # runs are whole as they are, so the length can stand in the pattern
}
KINDS = (*PATTERNS, "cnn")
TOKEN = re.compile(r"[A-Za-z0-9+/_=.-]{16,}")
PLAIN = re.compile(r"[^\W\d_]{5,}")

BEFORE, INSIDE, AFTER = 24, 40, 8
WIDTH = BEFORE + INSIDE + AFTER
SAMPLE = 1000
#: Distinct windows of a shard, rounds of the training, and the windows of a kind that a shard should have: kinds with fewer are given to all shards.
SHARD, ROUNDS, LEAST = 1 << 16, 8, 64
STEP = 1 / 4096
RECALL, QUIET = 0.98, 0.995
#: Forms that tokens of ordinary text have, whatever their characters.
ORDINARY = re.compile(
    r"(?:[A-Za-z]*[.=_/+-]*)*\d{4}-\d\d-\d\d\S*"  # dates
    r"|[0-9][0-9.,/_=+-]*[A-Za-z]{0,3}"  # numbers with a unit
    r"|v?\d+(?:\.\d+)+(?:-[a-z]+[0-9.]*)?"  # versions
    r"|(?:[A-Za-z0-9-]{1,15}\.)+[A-Za-z]{2,6}"  # hosts and files
    r"|(?:(?:[A-Z]?[a-z]+|[A-Z]+|\d{1,4})[._/+=-]*)+", re.A)  # words and short numbers, joined
#: Longest part of the last form that is a word: longer runs that change between letters and digits aren't ordinary.
JOINTS = 6


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in PATTERNS["assign"].finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in PATTERNS["access"].finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in PATTERNS["hex"].finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def other_candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    out = []
    for m in TOKEN.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isalpha() for c in s) and not any(
                a < m.end() and m.start() < b for a, b, _ in base):
            out.append((m.start(), m.end()))
    return out


def ordinary_form(token: str) -> bool:
    """Whether a token is a host, a date, a number or words and short numbers joined."""
    changes = len(re.findall(r"(?<=[A-Za-z])(?=\d)|(?<=\d)(?=[A-Za-z])|(?<=[a-z])(?=[A-Z])", token))
    long = max((len(x) for x in re.findall(r"[A-Za-z0-9]+", token)), default=0)
    return changes <= JOINTS and (changes <= 2 or long <= 15) and ORDINARY.fullmatch(token) is not None and not (
        changes > 2 and re.search(r"[A-Za-z0-9]{12,}", token))


def window(text: str, start: int, end: int) -> str:
    """What stands before, in and after a candidate, each cut or filled up with NUL to its width."""
    before = text[max(0, start - BEFORE):start].rjust(BEFORE, "\0")
    inside = text[start:min(end, start + INSIDE)].ljust(INSIDE, "\0")
    return before + inside + text[end:end + AFTER].ljust(AFTER, "\0")


def pieces(text: str, start: int, end: int) -> list[str]:
    """Windows over the whole candidate, each of ``INSIDE`` characters and half of them in the next one too."""
    last = max(start, end - INSIDE)
    return [window(text, a, min(a + INSIDE, end)) for a in [*range(start, last, INSIDE // 2), last]]


def _value(start: int, end: int, kind: str, text: str) -> tuple[int, int]:
    """A base finding's secret itself: what an assignment assigns."""
    if kind != "assign":
        return start, end
    m = PATTERNS["assign"].match(text, start)
    return m.span(2)


def spans_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_FOUND = ("doc_id bigint, base string, n_assign bigint, n_access bigint, n_hex bigint, starts array<int>, ends array<int>, "
          "n_windows array<int>, windows array<string>, usual array<boolean>, findings array<string>, plain array<string>, word string")


def scan(docs: DataFrame) -> DataFrame:
    """Per row: base findings, other candidates with the number of their windows, all these windows, whether each candidate has an
    ordinary form, windows of the base findings' values, of tokens of an ordinary form, and of one plain word (chosen by a hash of the text's length)."""
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                base = base_findings(text)
                others = other_candidates(text, base)
                usual = [ordinary_form(text[a:b]) or text[max(0, a - 1):a] == "@" for a, b in others]
                wide = [pieces(text, a, b) for a, b in others]
                word = PLAIN.search(text, len(text) * 2654435761 % (len(text) + 1))
                rows.append((doc_id, spans_text(base), *(sum(k == kind for _, _, k in base) for kind in PATTERNS),
                             [a for a, _ in others], [b for _, b in others], [len(w) for w in wide],
                             [x for w in wide for x in w], usual, [x for f in base for x in pieces(text, *_value(*f, text))],
                             [x for w, u in zip(wide, usual, strict=True) if u for x in w], word and window(text, *word.span())))
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()),
                     pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * len(types),
                                                                            types, strict=True)], names=names)

    return bounded(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _FOUND)


def codes(windows: list[str]) -> np.ndarray:
    """Character numbers 0 to 127 of the windows; all beyond ASCII is 127."""
    flat = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(windows), WIDTH)
    return np.minimum(flat, 127).astype(np.uint8)


class Network:
    """Embedding, one convolution, maximum and mean over places, one weighted sum."""

    SIZE, FILTERS, REACH = 8, 24, 5

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.p = {"embed": rng.normal(0, 0.3, (128, self.SIZE)),
                  "conv": rng.normal(0, 0.2, (self.REACH * self.SIZE, self.FILTERS)), "bias": np.zeros(self.FILTERS),
                  "out": rng.normal(0, 0.2, 2 * self.FILTERS), "off": np.zeros(1)}
        self.m, self.v = ({k: np.zeros_like(w) for k, w in self.p.items()} for _ in range(2))
        self.step = 0.0
        self.slope, self.offset, self.threshold, self.usual = 1.0, 0.0, 0.5, 1.0  # usual: limit of tokens of an ordinary form

    def forward(self, x: np.ndarray):
        """Margins, and what the backward pass needs.  The filters see the candidate and its neighbourhood."""
        e = self.p["embed"][x]
        places = WIDTH - self.REACH + 1
        cols = np.lib.stride_tricks.sliding_window_view(e, self.REACH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), places, -1)
        h = np.maximum(cols @ self.p["conv"] + self.p["bias"], 0)
        top = h.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(h, top[:, None, :], 1)[:, 0], h[:, BEFORE:].mean(axis=1)], axis=1)
        return pooled @ self.p["out"] + self.p["off"], (x, cols, h, top, pooled)

    def gradients(self, state, error: np.ndarray) -> dict[str, np.ndarray]:
        x, cols, h, top, pooled = state
        n, places, _ = h.shape
        back = error[:, None] * self.p["out"]
        dh = np.zeros_like(h)
        np.put_along_axis(dh, top[:, None, :], back[:, None, :self.FILTERS], 1)
        dh[:, BEFORE:] += back[:, None, self.FILTERS:] / (places - BEFORE)
        dh *= h > 0
        dcols = (dh @ self.p["conv"].T).reshape(n, places, self.REACH, self.SIZE)
        de = np.zeros((n, WIDTH, self.SIZE))
        for r in range(self.REACH):
            de[:, r:r + places] += dcols[:, :, r]
        at, flat_e = x.ravel(), de.reshape(-1, self.SIZE)
        embed = np.stack([np.bincount(at, flat_e[:, i], len(self.p["embed"])) for i in range(self.SIZE)], axis=1)
        flat = dh.reshape(-1, self.FILTERS)
        return {"embed": embed, "conv": cols.reshape(len(flat), -1).T @ flat, "bias": flat.sum(axis=0),
                "out": pooled.T @ error, "off": np.array([error.sum()])}

    def epoch(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, number: int, batch: int = 64, rate: float = 0.01, seed: int = 5) -> None:
        """Round ``number`` of the training over some rows, from the present weights and moments."""
        rng = np.random.default_rng(seed)
        for _ in range(number + 1):
            order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            rows = order[at:at + batch]
            margin, state = self.forward(x[rows])
            error = (_logistic(margin) - y[rows]) * weight[rows] / len(rows)
            self.step += 1
            for k, g in self.gradients(state, error).items():
                self.m[k] = 0.9 * self.m[k] + 0.1 * g
                self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
                self.p[k] = self.p[k] - rate * (self.m[k] / (1 - 0.9**self.step)) / (np.sqrt(self.v[k] / (1 - 0.999**self.step)) + 1e-8)

    def state(self) -> np.ndarray:
        """Weights, moments and the number of steps in one row."""
        return np.concatenate([*(part[k].ravel() for part in (self.p, self.m, self.v) for k in self.p), [self.step]])

    def take(self, state: np.ndarray) -> None:
        at = 0
        for part in (self.p, self.m, self.v):
            for k, old in self.p.items():
                part[k] = state[at:at + old.size].reshape(old.shape)
                at += old.size
        self.step = float(state[-1])

    def scores(self, windows: list[str]) -> np.ndarray:
        out = np.zeros(len(windows))
        for at in range(0, len(windows), 512):
            out[at:at + 512] = _logistic(self.slope * self.forward(codes(windows[at:at + 512]))[0] + self.offset)
        return out


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def again(x: str, rng: random.Random) -> str:
    """The window with other characters of the same kinds in the candidate."""
    inside = x[BEFORE:BEFORE + INSIDE]
    low = "abcdef" if re.fullmatch(r"[0-9a-f\0]+", inside) else "abcdefghijklmnopqrstuvwxyz"
    made = "".join(rng.choice("0123456789") if c.isdigit() else rng.choice(low) if c.islower() else
                   rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper() else c for c in inside)
    return x[:BEFORE] + made + x[BEFORE + INSIDE:]


def mixed_case(x: str, rng: random.Random) -> str:
    """The window with letters and digits of all kinds in the candidate, and the marks that keys have."""
    kinds = rng.choice(("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyz0123456789",
                        "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"))
    size = len(x[BEFORE:BEFORE + INSIDE].rstrip("\0"))
    made = "".join(rng.choice(kinds) for _ in range(max(20, size)))
    if rng.randrange(2):
        made = "".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 5))) + rng.choice("_-") + made
    return x[:BEFORE] + made[:INSIDE].ljust(INSIDE, "\0") + x[BEFORE + INSIDE:]


def ordinary(x: str, words: list[str], rng: random.Random) -> str:
    """A plain word's window with a token of an ordinary form in its place."""
    r, w = rng.randrange, lambda: rng.choice(words)
    token = rng.choice((
        f"{w()}-{w()}-{r(100)}", f"{w()}_{w()}{r(10)}.txt", f"{w()}.{w()}{r(9)}.com", f"20{r(100):02d}-{1 + r(12):02d}-{1 + r(28):02d}T{r(24):02d}",
        f"{w()}_20{r(100):02d}{1 + r(12):02d}{1 + r(28):02d}.jpg", f"{w()}/{w()}/{w()}/{r(1000)}", f"{w()}{w().title()}{w().title()}{r(99)}",
        f"v{r(9)}.{r(20)}.{r(30)}-{w()}", f"{w().upper()}_{w().upper()}_{r(100)}", f"{w()}={r(10 ** 6)}", f"{w()}-{w()}-{w()}-{w()}{r(9)}", f"{w()}{w()}{w()}{r(9)}"))
    return x[:BEFORE] + token[:INSIDE].ljust(INSIDE, "\0") + x[BEFORE + INSIDE:]


def examples(base: list[str], words: list[str], plain: list[str], sample: int, seed: int = 17) -> tuple[list[str], list[str]]:
    """Windows of the two labels from a shard's distinct windows, all of which are among them; ``sample`` of each label at least.

    Half of the first label are the findings, filled up with their like in other characters to an eighth of the second label's, half such
    in characters of all kinds; the second label are plain words, ordinary tokens, and ordinary tokens made here, half as many as the words at least.
    """
    rng = random.Random(seed)
    half = max(sample // 2, len(base), (len(words) + len(plain)) // 8)
    positive = base + [again(base[i % len(base)], rng) for i in range(half - len(base))]
    positive += [mixed_case(positive[i], rng) for i in range(max(half, sample - half))]
    tokens = [w[BEFORE:BEFORE + INSIDE].rstrip("\0") for w in words]
    negative = words + plain
    negative += [ordinary(words[i % len(words)], tokens, rng) for i in range(max(sample - len(negative), len(words) // 2))]
    for i in range(0, len(positive), 2):
        positive[i] = words[i % len(words)][:BEFORE] + positive[i][BEFORE:]
    return positive, negative


def train(found: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A calibrated network from all findings, words and ordinary tokens of ``found`` (see :func:`examples`); None if there are none."""
    parts = [found.select(F.lit(i).alias("kind"), w.alias("w")).where("w is not null") for i, w in enumerate(
        (F.explode("findings"), F.col("word"), F.explode("plain")))]
    rows = cut_lineage(parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct())
    sizes = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    if 0 not in sizes or 1 not in sizes:
        return None
    made = _dealt(rows, sizes, sample)
    release(rows)
    net = Network()
    for number in range(ROUNDS):
        net.take(_round(made.where("not unseen"), net, number))
    _calibrate(net, _margins(made.where("unseen"), net))
    release(made)
    return net


def _dealt(rows: DataFrame, sizes: dict[int, int], sample: int) -> DataFrame:
    """``(shard, at, y, unseen, x)``: the rows of both labels, made once, by shards."""
    shards = max(1, -(-sum(sizes.values()) // SHARD))
    few = [k for k, n in sizes.items() if n < LEAST * shards]
    everywhere = F.col("kind").isin(*few) if few else F.lit(False)
    own = F.pmod(F.xxhash64("w"), F.lit(shards)).cast("int")
    shard = F.explode(F.when(everywhere, F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array(own)))

    def make(table: pa.Table) -> pa.Table:
        held = sorted(zip(*(table[c].to_pylist() for c in ("kind", "h", "w")), strict=True))
        number = table["shard"][0].as_py()
        base, words, plain = ([w for k, _, w in held if k == kind] for kind in range(3))
        both = examples(base, words, plain, sample, 17 + number) if base and words else (base, words + plain)
        out = [(at, label == 0, at % 5 >= 3, x.tobytes()) for label, ws in enumerate(both) for at, x in enumerate(codes(ws))]
        at, y, unseen, x = zip(*out, strict=True)
        return pa.table({"shard": pa.array([number] * len(out), pa.int32()), "at": pa.array(at, pa.int32()), "y": pa.array(y, pa.bool_()),
                         "unseen": pa.array(unseen, pa.bool_()), "x": pa.array(x, pa.binary())})

    dealt = rows.select("kind", "w", F.xxhash64("w").alias("h"), shard.alias("shard"))
    made = dealt.groupBy("shard").applyInArrow(make, "shard int, at int, y boolean, unseen boolean, x binary")
    # eight partitions a shard, so that hardly any holds several
    return cut_lineage(made.repartition(8 * shards, "shard").sortWithinPartitions("shard", "at"), dealt=True)


def _round(seen: DataFrame, net: Network, number: int) -> np.ndarray:
    """The state after one more round in every shard, averaged by the shards' rows."""
    start = net.state()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("y", "descending"), ("at", "ascending")])
        x = np.frombuffer(b"".join(table["x"].to_pylist()), np.uint8).reshape(-1, WIDTH)
        y = table["y"].to_numpy().astype(float)
        share = max(y.mean(), 1 / len(y)), max(1 - y.mean(), 1 / len(y))
        own = Network()
        own.take(start)
        own.epoch(x, y, np.where(y == 1, 0.5 / share[0], 0.5 / share[1]), number)
        return pa.table({"shard": table["shard"][:1], "n": pa.array([len(y)], pa.int64()), "state": pa.array([own.state().tobytes()], pa.binary())})

    done = seen.groupBy("shard").applyInArrow(run, "shard int, n bigint, state binary")
    total, rows = np.zeros(len(start)), 0
    for r in sorted(done.collect(), key=lambda r: r.shard):
        total += r.n * np.frombuffer(r.state)
        rows += r.n
    return total / rows


def _margins(unseen: DataFrame, net: Network) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, margins and numbers of rows: margins cut to steps, down for findings and up for the second label, so that their
    number is bounded."""
    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(-1, WIDTH)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            margin = np.concatenate([net.forward(x[at:at + 512])[0] for at in range(0, len(x), 512)] or [np.zeros(0)]) / STEP
            yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(np.where(y, np.floor(margin), np.ceil(margin)).astype(np.int64))], names=["y", "step"])

    held = bounded(unseen).select("y", "x").mapInArrow(run, "y boolean, step bigint").groupBy("y", "step").count().collect()
    y, step, n = (np.array(c, float) for c in zip(*sorted((r.y, r.step, r["count"]) for r in held), strict=True))
    return y, step * STEP, n


def _calibrate(net: Network, margins: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """Newton steps for the logistic curve, with smoothed targets, and the limits by it."""
    y, margin, n = margins
    label = np.where(y == 1, 0.5 * n.sum() / n[y == 1].sum(), 0.5 * n.sum() / n[y == 0].sum())  # both labels weigh the same
    half = 0.5 * n.sum()
    target = np.where(y == 1, (half + 1) / (half + 2), 1 / (half + 2))
    z, w = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = _logistic(z @ w)
        step = np.linalg.solve(z.T @ (z * (n * label * np.maximum(p * (1 - p), 1e-9))[:, None]) + 1e-3 * np.eye(2), z.T @ (n * label * (target - p)))
        w = w + step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
    net.slope, net.offset = max(float(w[0]), 0.0), float(w[1])
    line = net.slope * margin + net.offset

    def place(which: int, share: float, less: int) -> float:
        held, rows = line[y == which], np.cumsum(n[y == which])  # sorted by margin
        return float(held[np.searchsorted(rows, int(share * (rows[-1] - less)), side="right")])

    top, most = place(1, 1 - RECALL, 0), place(0, QUIET, 1)
    net.threshold = float(_logistic(np.array(min(top, (top + most) / 2))))
    net.usual = max(net.threshold, float(np.nextafter(_logistic(line[y == 0][-1]), 2)))


def secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs(doc_id, text, ...)``."""
    found = written(scan(docs), "findings")
    net = train(found, sample)

    def run(batches):
        for batch in batches:
            doc_id, base, a, b, c, starts, ends, n, windows, usual = (batch.column(i) for i in range(10))
            flat = [w for ws in windows.to_pylist() for w in ws]
            sizes = [x for ns in n.to_pylist() for x in ns]
            begin = np.cumsum([0, *sizes[:-1]])
            limits = [net.usual if u else net.threshold for us in usual.to_pylist() for u in us] if net else []
            hit = iter(np.maximum.reduceat(net.scores(flat), begin) >= limits if net and flat else [False] * len(sizes))
            spans, digests = [], []
            for text, first, last in zip(base.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True):
                digests.append(hashlib.sha256(text.encode()).hexdigest())
                more = [(s, e, "cnn") for s, e in zip(first, last, strict=True) if next(hit)]
                known = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in text.split(",") if x)]
                spans.append(spans_text(sorted(known + more, key=lambda x: (x[0], KINDS.index(x[2])))) if more else text)
            yield pa.RecordBatch.from_arrays([doc_id, a, b, c, pa.array(digests), pa.array(spans, pa.string())],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return found.select("doc_id", "base", "n_assign", "n_access", "n_hex", "starts", "ends", "n_windows", "windows", "usual").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")
