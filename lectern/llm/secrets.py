"""Secrets in texts: rules, and a character convolutional network that scores every other candidate.

The rules give the base spans. A candidate is a run of letters, digits and ``+/_=-`` of at least
``CANDIDATE_CHARS`` that holds a letter and a digit, or a capital after a small letter; base spans are cut out of runs. The network reads the candidate
and the characters around it: one convolution over character classes, its maximum over the candidate and
over the context, a hidden layer, a logistic output. Of a candidate longer than ``INSIDE`` it reads both ends and windows of ``INSIDE``
that begin every ``STRIDE`` characters, and the highest score counts. It is trained on labelled findings: values that
the rules found in the corpus and text around them, all of them, and findings made from public token formats and from harmless
look-alikes, alone and inside long paths and names. A first lesson is of made findings; then the corpus findings are dealt to slices
by hash, each slice teaches a copy of the network in a task of its own, among made ones, and the copies are averaged. All findings of a
label in the corpus together weigh as much as ``SAMPLE`` made ones, if they are more. Scores are calibrated by Platt scaling
on all findings that were held back, as the candidates that they make in their texts (scores count in steps of ``1 / FINE``), and the
threshold is the highest that
keeps ``RECALL`` of the held-back secrets; those that make no candidate count as missed. ``Network.recall`` is what it keeps.
A threshold of ``LEAST`` stands in where no secret was held back.

All patterns are linear in the text. Null text is empty text and has no spans; repeated rows are scanned each;
an empty table gives no rows. Without any finding in the corpus the made ones alone train the network.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import pieces
from lectern.scratch import Scratch

KINDS = ("assign", "access", "hex", "token")
CANDIDATE_CHARS = 16
BEFORE, INSIDE, AFTER = 24, 48, 8
#: What all findings of a label in the corpus weigh at most, in made ones.
SAMPLE = 1500
MADE = 1500
#: Steps of a score that count, and findings of one slice, of which there are at most ``SLICES``.
FINE = 1024
SLICE, SLICES, SLICE_STEPS, SLICE_RATE = 4096, 64, 200, 0.006
RECALL = 0.98
LEAST = 0.5
FILTERS, WIDTH, UNITS = 24, 5, 16
STEPS, BATCH, RATE = 300, 128, 0.01

Span = tuple[str, int, int]

_ASSIGN = re.compile(r"(?ai)(?:password|passwd|secret|token|api_?key)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}+")
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{CANDIDATE_CHARS},}}+")
_DIGIT, _LETTER, _MIXED = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]"), re.compile(r"[a-z][A-Z]")


def base_matches(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, start of the value, end of the value) by start, then kind."""
    out = [("assign", *m.span(), *m.span(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    out += [("access", *m.span(), *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span(), *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int, int, int]]) -> list[tuple[int, int]]:
    """Runs that may be secrets, and what base spans leave of runs."""
    out, at = [], 0
    taken: list[list[int]] = []  # stretches that base spans cover
    for _, a, b, _, _ in base:
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    for m in _CANDIDATE.finditer(text):
        low, high = m.span()
        while at < len(taken) and taken[at][1] <= low:
            at += 1
        k = at
        while low < high:
            a, b = taken[k] if k < len(taken) else (high, high)
            if min(a, high) - low >= CANDIDATE_CHARS and _may_be_secret(text[low : min(a, high)]):
                out.append((low, min(a, high)))
            low, k = max(low, b), k + 1
    return out


def _may_be_secret(run: str) -> bool:
    return bool(_DIGIT.search(run) and _LETTER.search(run) or _MIXED.search(run))


_CODES = np.full(128, 4, np.uint8)
for _i, _c in enumerate("abcdefghijklmnopqrstuvwxyz"):
    _CODES[ord(_c)] = 8 + _i
    _CODES[ord(_c.upper())] = 34 + _i
for _i, _c in enumerate("0123456789"):
    _CODES[ord(_c)] = 60 + _i
for _i, _c in enumerate("+/_=-.:\"'@ \n"):
    _CODES[ord(_c)] = 70 + _i
CLASSES = 82
BLANK, FOREIGN = 0, 5
SIZE = BEFORE + INSIDE + AFTER
STRIDE = INSIDE // 4
#: Windows of one finding that are trained on.
TRAINED_WINDOWS = 8


def _codes(part: str) -> np.ndarray:
    codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    return np.where(codes < 128, _CODES[np.minimum(codes, 127)], FOREIGN).astype(np.uint8)


def picture(text: str, a: int, b: int) -> np.ndarray:
    """Character classes of the context before, of the candidate and of the context after; of a long candidate both ends."""
    inside = text[a:b]
    if len(inside) > INSIDE:
        inside = inside[: INSIDE // 2] + inside[-(INSIDE // 2) :]
    row = np.full(SIZE, BLANK, np.uint8)
    for place, part in ((BEFORE - min(a, BEFORE), text[max(0, a - BEFORE) : a]), (BEFORE, inside), (BEFORE + INSIDE, text[b : b + AFTER])):
        row[place : place + len(part)] = _codes(part)
    return row


def windows(n: int) -> np.ndarray:
    """Where windows of ``INSIDE`` characters begin that cover a candidate of n."""
    return np.r_[np.arange(0, n - INSIDE, STRIDE), n - INSIDE] if n > INSIDE else np.zeros(0, np.int64)


def views(text: str, a: int, b: int) -> np.ndarray:
    """The picture of a candidate, and of a long one also each of its windows in the same context."""
    whole = picture(text, a, b)[None]
    at = windows(b - a)
    if not len(at):
        return whole
    rows = np.repeat(whole, len(at) + 1, axis=0)
    rows[1:, BEFORE : BEFORE + INSIDE] = np.lib.stride_tricks.sliding_window_view(_codes(text[a:b]), INSIDE)[at]
    return rows


class Network:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.filters = (rng.standard_normal((WIDTH, CLASSES, FILTERS)) * 0.3).astype(np.float32)
        self.offset = np.zeros(FILTERS, np.float32)
        self.hidden = (rng.standard_normal((2 * FILTERS, UNITS)) / np.sqrt(2 * FILTERS)).astype(np.float32)
        self.bias = np.zeros(UNITS, np.float32)
        self.out = (rng.standard_normal(UNITS) / np.sqrt(UNITS)).astype(np.float32)
        self.level = np.zeros(1, np.float32)
        self.scale, self.shift, self.threshold, self.recall = 1.0, 0.0, LEAST, 0.0

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.offset, self.hidden, self.bias, self.out, self.level]

    def _forward(self, rows: np.ndarray):
        places = SIZE - WIDTH + 1
        maps = np.broadcast_to(self.offset, (len(rows), places, FILTERS)).copy()
        for k in range(WIDTH):
            maps += self.filters[k][rows[:, k : k + places]]
        np.maximum(maps, 0, out=maps)
        own = slice(BEFORE - WIDTH + 1, BEFORE + INSIDE)  # filters that touch the candidate
        rest = np.r_[0 : BEFORE - WIDTH + 1, BEFORE + INSIDE : places]
        inner = maps[:, own].argmax(axis=1) + own.start
        outer = rest[maps[:, rest].argmax(axis=1)]
        line = np.arange(len(rows))[:, None], np.arange(FILTERS)[None, :]
        top = np.concatenate([maps[line[0], inner, line[1]], maps[line[0], outer, line[1]]], axis=1)
        mid = np.maximum(top @ self.hidden + self.bias, 0)
        return mid @ self.out + self.level[0], mid, top, inner, outer

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(rows[a : a + 512])[0] for a in range(0, len(rows), 512)]) if len(rows) else np.zeros(0)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return self._scaled(self.scores(rows))

    def _scaled(self, scores: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * scores + self.shift, -30, 30)))

    def best_scores(self, found: list[np.ndarray]) -> np.ndarray:
        """The highest score of the views of each candidate."""
        if not found:
            return np.zeros(0)
        return np.maximum.reduceat(self.scores(np.concatenate(found)), np.cumsum([0, *map(len, found[:-1])]))

    def best(self, found: list[np.ndarray]) -> np.ndarray:
        """The probability of each candidate."""
        return self._scaled(self.best_scores(found))

    def gradients(self, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> list[np.ndarray]:
        score, mid, top, inner, outer = self._forward(rows)
        d = ((1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels) / len(rows)).astype(np.float32)
        if weights is not None:
            d *= weights
        d_mid = d[:, None] * self.out * (mid > 0)
        d_top = (d_mid @ self.hidden.T) * (top > 0)
        filters, offset = np.zeros_like(self.filters), np.zeros_like(self.offset)
        line = np.arange(FILTERS)[None, :]
        for where, grad in ((inner, d_top[:, :FILTERS]), (outer, d_top[:, FILTERS:])):
            offset += grad.sum(axis=0)
            for k in range(WIDTH):
                np.add.at(filters[k], (np.take_along_axis(rows, where + k, axis=1), np.broadcast_to(line, where.shape)), grad)
        return [filters, offset, top.T @ d_mid, d_mid.sum(axis=0), mid.T @ d, d.sum(keepdims=True)]

    def train(self, rows: np.ndarray, labels: np.ndarray, seed: int = 9) -> None:
        rng, teach = np.random.default_rng(seed), Adam(self)
        for _ in range(STEPS):
            pick = rng.integers(0, len(rows), min(BATCH, len(rows)))
            teach.step(rows[pick], labels[pick], RATE, rng)

    def calibrate(self, found: list[np.ndarray], labels: np.ndarray, missed: int = 0, recall: float = RECALL) -> None:
        """Platt scaling by Newton steps, then the threshold that the recall allows, with ``missed`` secrets not found at all."""
        self.fit(self.best_scores(found), labels, np.ones(len(labels)), missed, recall)

    def fit(self, scores: np.ndarray, labels: np.ndarray, weights: np.ndarray, missed: float = 0, recall: float = RECALL) -> None:
        """:meth:`calibrate` by scores that count as often as their weights say."""
        s, labels, mass = scores.astype(np.float64), labels > 0, weights.astype(np.float64)
        positive = max(float(mass[labels].sum()), 1.0)
        target = np.where(labels, (positive + 1) / (positive + 2), 1 / (float(mass.sum()) - positive + 2))
        w = np.array([1.0, 0.0])
        x = np.stack([s, np.ones_like(s)], axis=1)

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float((mass * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * ((w - [1.0, 0.0]) ** 2).sum())

        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            weight = np.maximum(p * (1 - p), 1e-9) * mass
            step = np.linalg.solve((x * weight[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ ((p - target) * mass) + 1e-3 * (w - [1.0, 0.0]))
            pace = next((2.0**-k for k in range(30) if loss(w - 2.0**-k * step) < loss(w)), 0.0)
            if not pace:
                break
            w = w - pace * step
        self.scale, self.shift = float(w[0]), float(w[1])
        secret = self._scaled(s[labels])
        order = np.argsort(secret, kind="stable")
        below = np.cumsum(mass[labels][order])  # of the secrets up to each score
        total = (float(below[-1]) if len(below) else 0.0) + missed
        self.threshold = LEAST
        if len(below):
            lost = int(np.searchsorted(below, max((1 - recall) * total - missed, 0.0), side="right"))
            self.threshold = float(secret[order[min(lost, len(order) - 1)]])
        self.recall = float(mass[labels][secret >= self.threshold].sum() / max(total, 1.0))


class Adam:
    """Steps on one network."""

    def __init__(self, network: Network):
        self.network, self.steps = network, 0
        self.first = [np.zeros_like(p) for p in network.parameters()]
        self.second = [np.zeros_like(p) for p in network.parameters()]

    def step(self, rows: np.ndarray, labels: np.ndarray, rate: float, rng: np.random.Generator, weights: np.ndarray | None = None) -> None:
        self.steps += 1
        batch = rows.copy()
        batch[rng.random(len(rows)) < 0.3, :BEFORE] = BLANK  # a secret is one without its context too
        for p, g, m, v in zip(self.network.parameters(), self.network.gradients(batch, labels, weights), self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-7)).astype(np.float32)


def made_findings(count: int = MADE, seed: int = 3) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label) of findings in public token formats and of harmless look-alikes."""
    rng = np.random.default_rng(seed)
    lower, digits, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    mixed = lower + lower.upper() + digits
    draw = lambda alphabet, n: "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))
    word = lambda: "".join(SYLLABLES[i] for i in rng.integers(0, len(SYLLABLES), rng.integers(1, 5)))
    size = lambda a, b: int(rng.integers(a, b))
    secret = (
        lambda: draw(mixed, size(20, 64)),
        lambda: draw(mixed + "+/", size(24, 80)) + "=" * size(0, 3),
        lambda: draw(mixed + "-_", size(22, 60)),
        lambda: "ghp_" + draw(mixed, 36),
        lambda: "sk_live_" + draw(mixed, 24),
        lambda: "xoxb-" + draw(digits, 12) + "-" + draw(mixed, 24),
        lambda: "AIza" + draw(mixed + "-_", 35),
        lambda: "eyJ" + draw(mixed + "-_", size(30, 90)),
        lambda: draw(hexa.upper(), size(32, 64)),
        lambda: draw(hexa, size(24, 32)),
    )
    harmless = (
        lambda: "-".join(word() for _ in range(size(2, 6))) + "-" + draw(digits, size(1, 4)),
        lambda: "_".join(word() for _ in range(size(2, 5))) + draw(digits, size(1, 3)),
        lambda: "/" + "/".join(word() for _ in range(size(2, 6))) + "/" + draw(digits, size(1, 5)),
        lambda: word() + word() + word() + word() + draw(digits, size(1, 4)),
        lambda: f"{size(1990, 2030)}-{size(10, 13)}-{size(10, 29)}T{size(10, 24)}",
        lambda: "=" * size(14, 40) + word() + draw(digits, 1),
        lambda: "-".join((draw(hexa, 8), draw(hexa, 4), draw(hexa, 4), draw(hexa, 4), draw(hexa, 12))),
        lambda: word().capitalize() + draw(digits, size(1, 3)) + "-" + word() + "-" + word() + draw(digits, 2),
        lambda: "mail" + draw(digits, 1) + "_" + word() + "_" + word() + word(),
        lambda: draw(digits, size(4, 9)) + "-" + draw(digits, size(4, 9)) + word(),
    )
    out = []
    for i in range(count):
        for label, makers in ((1, secret), (0, harmless)):
            value = makers[i % len(makers)]()
            value = value if len(value) >= CANDIDATE_CHARS else value + word() * 4
            before = " ".join(word() for _ in range(size(0, 5)))
            before += ("", " ", ": ", ' = "')[size(0, 4)]
            out.append((f"{before}{value} {word()}", len(before), len(before) + len(value), label))
    return out


SYLLABLES = "the an er on re in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve che ung ment que ción ado".split()


def hidden_findings(count: int = MADE // 2, seed: int = 11) -> list[tuple[str, int, int, int, int, int]]:
    """(text, start, end, label, start and end of the secret) of long paths and names with a secret inside, and without one."""
    rng = np.random.default_rng(seed)
    keys = [t[a:b] for t, a, b, label in made_findings(count, seed) if label]
    word = lambda: "".join(SYLLABLES[i] for i in rng.integers(0, len(SYLLABLES), rng.integers(1, 5)))

    def name(least: int) -> str:
        sign = "/-_"[rng.integers(0, 3)]
        out = word()
        while len(out) < least:
            part = str(rng.integers(1, 3000)) if rng.random() < 0.2 else word()
            out += sign + (part.capitalize() if rng.random() < 0.1 else part)
        return out

    out = []
    for key in keys:
        for label, middle in ((1, key), (0, name(16))):
            first, last = name(int(rng.integers(8, 70))) + "/", "/" + name(int(rng.integers(8, 70))) + "-2024"
            before = " ".join(word() for _ in range(rng.integers(0, 5))) + " "
            a, x = len(before), len(before) + len(first)
            out.append((f"{before}{first}{middle}{last} {word()}", a, x + len(middle) + len(last), label, x, x + len(middle)))
    return out


def wordy_findings(count: int = MADE // 2, seed: int = 13) -> list[tuple[str, int, int, int, int, int]]:
    """Findings without a digit, as in ``hidden_findings``: random letters, and words joined by capitals and signs."""
    rng = np.random.default_rng(seed)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    word = lambda: "".join(SYLLABLES[i] for i in rng.integers(0, len(SYLLABLES), rng.integers(1, 5)))
    out = []
    for _ in range(count):
        name = word()
        while len(name) < CANDIDATE_CHARS or not _MIXED.search(name):
            name += ("", "", "", "-", "_", "/")[rng.integers(0, 6)] + word().capitalize()
        name = name if rng.random() < 0.5 else name[0].upper() + name[1:]
        key = "".join(letters[i] for i in rng.integers(0, len(letters), rng.integers(20, 64)))
        for label, value in ((1, key), (0, name)):
            before = " ".join(word() for _ in range(rng.integers(0, 5))) + (" ", ": ", ' = "')[rng.integers(0, 3)]
            a, b = len(before), len(before) + len(value)
            out.append((f"{before}{value} {word()}", a, b, label, a, b))
    return out


def _findings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the rules found, cut with its context, and words around it as harmless findings."""
    names = ["text", "low", "high", "label", "chance"]
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            base = base_matches(text) if text else []
            for _, _, _, a, b in base:
                low = max(0, a - BEFORE)
                rows.append((text[low : b + AFTER], a - low, b - low, 1))
                for m in re.finditer(r"[A-Za-z]{6,}", text[max(0, a - 200) : low]):
                    x = max(0, a - 200) + m.start()
                    y = max(0, a - 200) + m.end()
                    z = max(0, x - BEFORE)
                    rows.append((text[z : y + AFTER], x - z, y - z, 0))
        if rows:
            chance = [int.from_bytes(hashlib.blake2b(r[0].encode(), digest_size=7).digest()) for r in rows]
            columns = [*zip(*rows, strict=True), chance]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def learn(docs: DataFrame) -> Network:
    """A network trained and calibrated on all findings of ``docs`` and on made ones."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(docs.select("text").mapInArrow(_findings, "text string, low int, high int, label int, chance long").distinct())
    counts = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    weights = {label: min(1.0, SAMPLE / n) for label, n in counts.items()}
    made = [(*r, r[1], r[2]) for r in made_findings()] + hidden_findings() + wordy_findings()
    back = np.random.default_rng(1).random(len(made)) < 0.3
    lessons = _lessons([r for r, h in zip(made, back.tolist(), strict=True) if not h])
    network = Network()
    network.train(*lessons)
    held = F.pmod(F.xxhash64("text", "low", "high", "label"), F.lit(10)) < 3
    slices = min(max(sum(counts.values()) // SLICE, 1), SLICES)
    dealt = found.where(~held).withColumn("slice", F.pmod(F.xxhash64("chance", "low", "high", "label"), F.lit(slices)).cast("int"))
    ordered = dealt.repartition(slices, "slice").sortWithinPartitions("slice", "chance", "low", "high", "label", "text")
    shared = docs.sparkSession.sparkContext.broadcast((network, lessons, weights))
    taught = sorted(ordered.mapInArrow(_lesson(shared), "slice int, seen long, flat binary").collect())  # at most SLICES rows
    seen = sum(r["seen"] for r in taught)
    if seen:
        flat = sum(np.frombuffer(r["flat"], np.float32).astype(np.float64) * (r["seen"] / seen) for r in taught)
        at = 0
        for p in network.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size
    views_of, labels, missed = _judged([r for r, h in zip(made, back.tolist(), strict=True) if h])
    shared = docs.sparkSession.sparkContext.broadcast(network)
    judged = found.where(held).mapInArrow(_judge(shared), "label int, step int").groupBy("label", "step").agg(F.count("*").alias("n"))
    bins = sorted(judged.collect())  # scores in steps: as many as their range holds
    steps = [r for r in bins if r["step"] is not None]
    missed += sum(r["n"] * weights[1] for r in bins if r["step"] is None)
    network.fit(
        np.r_[network.best_scores(views_of), [r["step"] / FINE for r in steps]],
        np.r_[labels, [r["label"] for r in steps]],
        np.r_[np.ones(len(labels)), [r["n"] * weights[r["label"]] for r in steps]],
        missed,
    )
    scratch.close()
    return network


def _rows(batch: pa.RecordBatch) -> list[tuple[str, int, int, int, int, int]]:
    names = ("text", "low", "high", "label", "low", "high")
    return list(zip(*(batch.column(n).to_pylist() for n in names), strict=True))


def _lesson(shared):
    """What each slice makes of the network: its findings in order, as many made ones beside them, again until there were enough steps."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, (made, kinds), mass = shared.value
        size = BATCH // 2
        per_label = np.array([mass.get(0, 0.0), mass.get(1, 0.0)], np.float32)

        def teach(part: tuple[np.ndarray, np.ndarray]) -> None:
            weights = per_label[part[1].astype(int)]
            weights /= max(float(per_label.max()), 1e-9)  # the rarer label counts whole
            pick = rng.integers(0, len(made), size)
            adam.step(np.concatenate([part[0], made[pick]]), np.r_[part[1], kinds[pick]], SLICE_RATE * (1 - 0.9 * min(adam.steps / SLICE_STEPS, 1)), rng, np.r_[weights, np.ones(size, np.float32)])

        def result(number: int) -> pa.RecordBatch:
            nonlocal waiting
            if len(waiting[1]):
                teach(waiting)
                kept.append(waiting)
            again = 0
            while adam.steps < SLICE_STEPS and kept:
                teach(kept[again % len(kept)])
                again += 1
            flat = np.concatenate([p.reshape(-1) for p in own.parameters()]).tobytes()
            return pa.RecordBatch.from_pydict({"slice": pa.array([number], pa.int32()), "seen": pa.array([seen], pa.int64()), "flat": pa.array([flat], pa.binary())})

        at, seen, own, adam, rng = None, 0, network, None, None
        waiting, kept = (np.zeros((0, SIZE), np.uint8), np.zeros(0, np.float32)), []
        for batch in batches:
            slices = batch.column("slice").to_numpy()
            cuts = np.r_[0, np.flatnonzero(slices[1:] != slices[:-1]) + 1, len(slices)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if slices[a] != at:
                    if adam is not None:
                        yield result(at)
                    at, seen, own, rng = int(slices[a]), 0, copy.deepcopy(network), np.random.default_rng(17)
                    adam, waiting, kept = Adam(own), (waiting[0][:0], waiting[1][:0]), []
                pictures, labels = _lessons(_rows(batch.slice(a, b - a)))
                seen += b - a
                waiting = np.concatenate([waiting[0], pictures]), np.concatenate([waiting[1], labels])
                full = len(waiting[1]) // size * size
                for x in range(0, full, size):
                    part = waiting[0][x : x + size], waiting[1][x : x + size]
                    teach(part)
                    if adam.steps < SLICE_STEPS:
                        kept.append(part)
                waiting = waiting[0][full:], waiting[1][full:]
        if adam is not None:
            yield result(at)

    return work


def _judge(shared):
    """The label of each finding and the best score of its candidates in steps; null of a secret that makes no candidate."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            found, labels, missed = _judged(_rows(batch))
            steps = [int(s) for s in np.round(network.best_scores(found) * FINE)]
            kinds = [int(x) for x in labels] + [1] * missed
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(steps + [None] * missed, pa.int32())], ["label", "step"])

    return work


def _judged(rows: list[tuple[str, int, int, int, int, int]]) -> tuple[list[np.ndarray], np.ndarray, int]:
    """Views of the candidates that findings make, their labels, and how many secrets make none.

    A value that the rules find is taken alone, as if they did not; one that is no candidate then is no concern of the network.
    """
    found, labels, missed = [], [], 0
    for text, a, b, label, x, y in rows:
        base = base_matches(text)
        ruled = any(s < y and x < e for _, s, e, _, _ in base)
        if ruled:
            runs = [(a + i, a + j) for i, j in candidates(text[a:b], [])]
        else:
            runs = [(i, j) for i, j in candidates(text, base) if i < y and x < j]
        if runs:
            found.append(np.concatenate([views(text, i, j) for i, j in runs]))
            labels.append(label)
        elif label and not ruled:
            missed += 1
    return found, np.array(labels, np.float32), missed


def _lessons(rows: list[tuple[str, int, int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Views to train on and their labels: a window is a secret when it holds enough of one, and left out when it holds less."""
    pictures, labels = [], []
    for text, a, b, label, x, y in rows:
        seen, at = views(text, a, b), windows(b - a)
        held = np.minimum(at + INSIDE, y - a) - np.maximum(at, x - a)
        # Both ends are a picture of the whole only when the secret is the whole.
        clear = np.r_[(x, y) == (a, b), (label == 0) | (held >= CANDIDATE_CHARS) | (held <= 0)]
        values = np.r_[label, np.where(held > 0, label, 0)]
        pick = np.flatnonzero(clear)
        pick = pick[np.unique(np.linspace(0, len(pick) - 1, min(len(pick), TRAINED_WINDOWS + 1)).astype(int))]
        pictures.append(seen[pick])
        labels.append(values[pick])
    return np.concatenate(pictures), np.concatenate(labels).astype(np.float32)


def find(text: str, network: Network) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans; both by start and kind."""
    matches = base_matches(text)
    base = [m[:3] for m in matches]
    open_ = candidates(text, matches)
    if not open_:
        return base, base
    p = network.best([views(text, a, b) for a, b in open_])
    added = [("token", a, b) for (a, b), s in zip(open_, p.tolist(), strict=True) if s >= network.threshold]
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[Span], sign: str = "[SECRET]") -> str:
    """The text with each stretch covered by spans replaced by ``sign``."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= at:
            out += (text[at:a], sign)
        at = max(at, b)
    return "".join(out) + text[at:]


def _scan(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for part in pieces(batch, "text", 1 << 22):
                found = [find(t or "", network) for t in part.column("text").to_pylist()]
                counts = [pa.array([sum(s[0] == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS[:3]]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
                added = [len(every) - len(base) for base, every in found]
                spans = [written(every) for _, every in found]
                columns = [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(added, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])

    return work


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, their digest, all spans, and how many were added."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"
    return docs.select("doc_id", "text").mapInArrow(_scan(shared), schema)


def _mask(shared, column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            for part in pieces(batch, column, 1 << 22):
                texts = [None if t is None else masked(t, find(t, network)[1]) for t in part.column(column).to_pylist()]
                at = part.schema.get_field_index(column)
                yield part.set_column(at, pa.field(column, pa.string()), pa.array(texts, pa.string()))

    return work


def mask_secrets(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with every secret in ``column`` replaced by a sign; all else stays."""
    network = learn(docs.select(F.col(column).alias("text")))
    return docs.mapInArrow(_mask(docs.sparkSession.sparkContext.broadcast(network), column), docs.schema)
