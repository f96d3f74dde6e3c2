"""Language of texts by a bidirectional gated recurrent network over bytes.

A text is cut into windows of bytes. In each window one gated recurrent layer reads forwards and one backwards;
both states of a byte give its label probabilities, and the mean over all bytes of a document is the document's.
Every byte of every text is labelled. The network is trained by backpropagation through time on every window of every labelled
document, languages weighing the same: a first lesson (windows of documents chosen by a hash of doc_id, about ``LESSON``, in one
task) brings it off its random start, then all windows are dealt to slices by a hash, each slice teaches a copy of the network in
a task of its own, window by window, and the copies are averaged by the windows that they saw. When the first lesson
holds all windows, it is the only one.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when nothing can be learned.
Repeated rows get the same answer each; an empty table gives no rows.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.words import give_back, pieces, utf8

UNKNOWN = "und"
WINDOW = 128
HIDDEN = 8
#: Windows of the first lesson, about; of one document at most ``LESSON // LESSON_DOCS``.
LESSON, LESSON_DOCS = 27_000, 32
STEPS, BATCH, RATE = 140, 192, 0.03
#: Each slice teaches at least ``SLICE`` windows, ``SLICE_BATCH`` at a time; there are no more than ``SLICES``.
SLICE, SLICES, SLICE_BATCH, SLICE_RATE = 16_384, 256, 1024, 0.002
#: Windows that run side by side in a prediction: enough to outweigh the calls, few enough for their state to stay in the processor's cache.
SIDE_BY_SIDE = 2048
PAD = 256
#: Steps whose gradients are summed by byte at once.
TOGETHER = 16


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1


class Room(dict):
    """Arrays that are used again: fresh memory for every batch would cost more than what is done in it."""

    def of(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self or self[name].size < size:
            self[name] = np.empty(size, np.float32)
        return self[name][:size].reshape(shape)


def padding(steps: np.ndarray, units: int) -> list[np.ndarray]:
    """At each step, where padding lies in an array of (units, rows)."""
    at, rows = np.divmod(np.flatnonzero(steps == PAD), steps.shape[1])
    places = rows[:, None] + np.arange(units) * steps.shape[1]
    ends = np.searchsorted(at, np.arange(len(steps) + 1)).tolist()
    return [places[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class Layer:
    """A gated recurrent layer: update gate z, reset gate r, candidate c; h = (1 - z) h + z c.

    Gates are (1 + x / (1 + |x|)) / 2 and c is x / (1 + |x|), which cost a fraction of exponentials. Rows lie side by side in
    memory: arrays are (units, rows), one for each step.
    """

    def __init__(self, hidden: int, rng: np.random.Generator):
        self.hidden = hidden
        self.table = (rng.standard_normal((257, 3 * hidden)) * 0.4).astype(np.float32)  # input weights and bias per byte
        self.table[:, :hidden] -= 1.0  # begin by remembering
        self.inner = (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32)

    def run(self, steps: np.ndarray, pads: list[np.ndarray], room: Room, name: str, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """States after each step for byte codes of shape (time, rows); padding leaves the state at zero.

        With ``keep`` also z, r and c at each step. What ``room`` holds under ``name`` is written over.
        """
        n, k = steps.shape[1], self.hidden
        table, inner = np.ascontiguousarray(self.table.T), np.ascontiguousarray(self.inner.T)
        h = np.zeros((k, n), np.float32)
        states = room.of(f"{name} states", len(steps), k, n)
        saved = room.of(f"{name} saved", len(steps), 3 * k, n) if keep else None
        work, u, scale = room.of("work", 3 * k, n), room.of("u", 3 * k, n), room.of("scale", 2 * k, n)
        more, part, size = u[: 2 * k], u[2 * k :], scale[:k]
        for t, codes in enumerate(steps.astype(np.intp)):
            at = saved[t] if keep else work  # what is to be kept is worked out where it stays
            gates, z, r, c = at[: 2 * k], at[:k], at[k : 2 * k], at[2 * k :]
            np.take(table, codes, axis=1, out=at, mode="clip")
            np.matmul(inner, h, out=u)
            gates += more
            np.abs(gates, out=scale)
            scale += 1
            gates /= scale
            gates *= 0.5
            gates += 0.5
            part *= r
            c += part
            np.abs(c, out=size)
            size += 1
            c /= size
            after = states[t]
            np.subtract(c, h, out=after)
            after *= z
            after += h
            if len(pads[t]):
                after.reshape(-1)[pads[t]] = 0
            h = after
        return states, saved

    def back(self, steps: np.ndarray, pads: list[np.ndarray], states: np.ndarray, saved: np.ndarray, out: np.ndarray, errors: np.ndarray, room: Room) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the table and the inner weights; those of the states are ``out`` times ``errors`` at each step."""
        k, n = self.hidden, steps.shape[1]
        inner, back, again = np.zeros_like(self.inner), self.inner.copy(), np.ascontiguousarray(self.inner.T[2 * k :])
        back[:, : 2 * k] *= 2  # slopes of gates are left halved until they are summed: doubling is exact
        half = -(-3 * k // 2)
        table, sums = np.zeros((2 * half, 257)), np.empty(257, np.complex128)
        d, pair = room.of("gradients", TOGETHER, 2 * half, n), np.empty((TOGETHER, n), np.complex128)
        d[:, 3 * k :] = 0
        u, da, gz, slopes = room.of("u", k, n), *room.of("back", 2, k, n), room.of("scale", 2 * k, n)
        g, carried, start = room.of("carried", 3, k, n)
        carried[...] = start[...] = 0
        for t in range(len(steps) - 1, -1, -1):
            z, r, c = saved[t].reshape(3, k, n)
            h = states[t - 1] if t else start
            np.matmul(out, errors[t], out=g)
            g += carried
            if len(pads[t]):
                g.reshape(-1)[pads[t]] = 0
            np.multiply(g, z, out=gz)
            np.abs(c, out=da)
            np.subtract(1, da, out=da)
            da *= da
            da *= gz
            np.subtract(1, saved[t, : 2 * k], out=slopes)
            np.minimum(slopes, saved[t, : 2 * k], out=slopes)
            slopes *= slopes
            own = d[t % TOGETHER, : 3 * k]
            np.subtract(c, h, out=own[:k])
            own[:k] *= g
            np.matmul(again, h, out=u)
            np.multiply(da, u, out=own[k : 2 * k])
            own[: 2 * k] *= slopes
            np.multiply(da, r, out=own[2 * k :])
            inner += h @ own.T
            np.matmul(back, own, out=carried)
            carried += g
            carried -= gz
            own[2 * k :] = da
            if t % TOGETHER == 0:
                codes = steps[t : t + TOGETHER].astype(np.intp)
                some, both = d[: len(codes)], pair[: len(codes)]
                for j in range(half):  # two sums at once, as parts of complex numbers: both have the same places
                    both.real, both.imag = some[:, j], some[:, half + j]
                    sums[...] = 0
                    np.add.at(sums, codes.reshape(-1), both.reshape(-1))
                    table[j] += sums.real
                    table[half + j] += sums.imag
        table[: 2 * k] *= 2
        inner[:, : 2 * k] *= 2
        return table[: 3 * k].T.astype(np.float32), inner


class Network:
    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.forward, self.backward = Layer(hidden, rng), Layer(hidden, rng)
        self.out = (rng.standard_normal((2 * hidden, len(labels))) * 0.3).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def _told(self, ahead: np.ndarray, behind: np.ndarray, room: Room) -> np.ndarray:
        """Of each label at each byte from the states of both layers: (time, labels, rows)."""
        k = self.forward.hidden
        ours, others = self.out[:k].T.copy(), self.out[k:].T.copy()
        x, more = (room.of(name, steps, len(self.labels), ahead.shape[2]) for name, steps in (("told", len(ahead)), ("more", TOGETHER)))
        for t in range(0, len(ahead), TOGETHER):
            some = x[t : t + TOGETHER]
            np.matmul(ours, ahead[t : t + TOGETHER], out=some)
            some += np.matmul(others, behind[t : t + TOGETHER], out=more[: len(some)])
            some += self.bias[:, None]
            some -= some.max(axis=1, keepdims=True)
            np.exp(some, out=some)
            some /= some.sum(axis=1, keepdims=True)
        return x

    def probabilities(self, steps: np.ndarray, room: Room | None = None) -> np.ndarray:
        """Of each label at each byte: (time, labels, rows); in ``room``, if given, until it is used again."""
        room, pads = Room() if room is None else room, padding(steps, self.forward.hidden)
        ahead, behind = self.forward.run(steps, pads, room, "ahead")[0], self.backward.run(steps[::-1], pads[::-1], room, "behind")[0]
        return self._told(ahead, behind[::-1], room)

    def gradients(self, steps: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, tell: bool = True, room: Room | None = None) -> tuple[float, list[np.ndarray]]:
        """Mean loss of the bytes that are no padding (0 unless ``tell``), and the gradient of each parameter. ``weights`` are of rows."""
        room, pads = Room() if room is None else room, padding(steps, self.forward.hidden)
        ahead, saved = self.forward.run(steps, pads, room, "ahead", True)
        behind, saved_back = self.backward.run(steps[::-1], pads[::-1], room, "behind", True)
        p = self._told(ahead, behind[::-1], room)
        share = (steps != PAD).astype(np.float32)
        share /= max(float(share.sum()), 1.0)
        if weights is not None:
            share *= weights.astype(np.float32)
        right = (np.arange(len(self.labels))[:, None] == labels).astype(np.float32)
        loss = float(-(np.log((p * right).sum(axis=1) + 1e-9) * share).sum()) if tell else 0.0
        p -= right
        p *= share[:, None, :]
        k = self.forward.hidden
        t1, i1 = self.forward.back(steps, pads, ahead, saved, self.out[:k], p, room)
        t2, i2 = self.backward.back(steps[::-1], pads[::-1], behind, saved_back, self.out[k:], p[::-1], room)
        turned = p.transpose(0, 2, 1)
        out = np.concatenate([np.matmul(ahead, turned).sum(axis=0), np.matmul(behind[::-1], turned).sum(axis=0)])
        return loss, [t1, i1, t2, i2, out, p.sum(axis=(0, 2))]

    def parameters(self) -> list[np.ndarray]:
        return [self.forward.table, self.forward.inner, self.backward.table, self.backward.inner, self.out, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.reshape(-1) for p in self.parameters()])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.parameters():
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size


class Lessons:
    """Adam on one copy of a network, a batch of windows after the other."""

    def __init__(self, network: Network, weights: np.ndarray):
        self.network, self.weights = copy.deepcopy(network), weights
        self.first = [np.zeros_like(p) for p in network.parameters()]
        self.second = [np.zeros_like(p) for p in network.parameters()]
        self.steps = self.seen = 0
        self.room = Room()

    def teach(self, windows: np.ndarray, labels: np.ndarray, pace: float) -> None:
        """``windows`` are rows of byte codes."""
        self.steps += 1
        _, grads = self.network.gradients(np.ascontiguousarray(windows.T), labels, self.weights[labels], tell=False, room=self.room)
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grads)))
        for p, g, m, v in zip(self.network.parameters(), grads, self.first, self.second, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (pace * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-7)).astype(np.float32)


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Rows of byte codes, padded, and the text that each is from; every byte is in one window."""
    sizes = np.diff(offsets)
    many = -(-sizes // window)
    owner = np.repeat(np.arange(len(sizes)), many)
    order = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    start = offsets[owner] + order * window
    length = np.minimum(offsets[owner + 1] - start, window)
    padded = np.concatenate([data, np.zeros(window, np.uint8)])
    codes = np.lib.stride_tricks.sliding_window_view(padded, window)[start].astype(np.int16) if len(owner) else np.zeros((0, window), np.int16)
    codes[np.arange(window)[None, :] >= length[:, None]] = PAD
    return codes, owner


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Mean label probabilities of the bytes of each text; zeros for empty ones."""
    codes, owner = windows_of(data, offsets)
    total, room = np.zeros((len(offsets) - 1, len(network.labels))), Room() if room is None else room
    for a in range(0, len(codes), SIDE_BY_SIDE):
        steps = np.ascontiguousarray(codes[a : a + SIDE_BY_SIDE].T)
        p = network.probabilities(steps, room)
        if (steps == PAD).any():
            p *= (steps != PAD)[:, None, :]
        np.add.at(total, owner[a : a + SIDE_BY_SIDE], p.sum(axis=0).T)
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def _draw(limit: int | None = None):
    """Windows of each text in an order given by its chance, with the turn of each: all, or the first ``limit``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, offsets = utf8(part.column("text"))
                many = -(-np.diff(offsets) // WINDOW)
                turns = [np.random.default_rng(c & 0xFFFFFFFFFFFFFFFF).permutation(n)[:limit] for c, n in zip(part.column("chance").to_pylist(), many.tolist(), strict=True)]
                count = [len(t) for t in turns]
                owner = np.repeat(np.arange(len(many)), count)
                low = offsets[owner] + np.concatenate([*turns, np.zeros(0, np.int64)]) * WINDOW
                size = np.minimum(low + WINDOW, offsets[owner + 1]) - low
                ends = np.zeros(len(size) + 1, np.int64)
                np.cumsum(size, out=ends[1:])
                whole = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(WINDOW, np.uint8)]), WINDOW)[low]
                drawn = whole[np.arange(WINDOW) < size[:, None]]
                columns = [
                    part.column("lang").take(pa.array(owner)),
                    pa.array(np.arange(len(owner)) - np.repeat(np.cumsum(count, dtype=np.int64) - count, count), pa.int32()),
                    part.column("chance").take(pa.array(owner)),
                    pa.Array.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(drawn)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "turn", "chance", "bytes"])

    return work


def _lesson(shared, size: int, least: int, rate: Callable[[int], float]):
    """What each slice makes of the network: its windows in order, ``size`` at a time, and again until there were ``least`` steps."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, weights = shared.value
        index = {name: i for i, name in enumerate(network.labels)}
        at, lessons, held, waiting, kept = None, None, 0, [], []

        def teach() -> None:
            nonlocal held, waiting
            windows, labels = (np.concatenate(x) for x in zip(*waiting, strict=True))
            full = len(windows) if at is None else len(windows) // size * size
            for a in range(0, full, size):
                lessons.teach(windows[a : a + size], labels[a : a + size], rate(lessons.steps))
                if lessons.steps < least:
                    kept.append((windows[a : a + size], labels[a : a + size]))
            waiting, held = ([(windows[full:], labels[full:])] if full < len(windows) else []), len(windows) - full

        def result(number: int) -> pa.RecordBatch:
            nonlocal at
            at = None  # the slice is over: its last windows are a batch too
            if held:
                teach()
            if lessons.steps < least and kept:
                windows, labels = (np.concatenate(x) for x in zip(*kept, strict=True))
                rng = np.random.default_rng(11)
                while lessons.steps < least:
                    order = rng.permutation(len(windows))
                    for a in range(0, len(order), size):
                        pick = order[a : a + size]
                        lessons.teach(windows[pick], labels[pick], rate(lessons.steps))
            return pa.RecordBatch.from_pydict(
                {"slice": pa.array([number], pa.int32()), "seen": pa.array([lessons.seen], pa.int64()), "flat": pa.array([lessons.network.flat().tobytes()], pa.binary())}
            )

        for batch in batches:
            slices = batch.column("slice").to_numpy()
            cuts = np.r_[0, np.flatnonzero(slices[1:] != slices[:-1]) + 1, len(slices)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                if slices[a] != at:
                    if lessons is not None:
                        yield result(at)
                    at, lessons, held, waiting, kept = int(slices[a]), Lessons(network, weights), 0, [], []
                some = batch.slice(a, b - a)
                codes, _ = windows_of(*utf8(some.column("bytes")))
                waiting.append((codes, np.array([index[x] for x in some.column("lang").to_pylist()])))
                held += b - a
                lessons.seen += b - a
                if held >= size:
                    teach()
        if lessons is not None:
            yield result(at)
        lessons = None
        give_back()

    return work


def _taught(network: Network, weights: np.ndarray, windows: DataFrame, slices: int, *how: object) -> int:
    """Teach the network all ``windows``, each slice a copy of it, and put the average in its place; how many they were."""
    shared = windows.sparkSession.sparkContext.broadcast((network, weights))
    dealt = windows.withColumn("hash", F.xxhash64("lang", "chance", "turn", "bytes")).withColumn("slice", F.pmod("hash", F.lit(slices)).cast("int"))
    ordered = dealt.repartition(slices, "slice").sortWithinPartitions("slice", "hash", "bytes").select("slice", "lang", "bytes")
    done = sorted(ordered.mapInArrow(_lesson(shared, *how), "slice int, seen long, flat binary").collect())  # at most SLICES rows
    seen = sum(r["seen"] for r in done)
    if seen:
        network.put(sum(np.frombuffer(r["flat"], np.float32).astype(np.float64) * (r["seen"] / seen) for r in done))
    return seen


def learn(labelled: DataFrame) -> Network | None:
    """A network trained on all windows of (doc_id, text, lang); None when there is nothing to learn from."""
    rows = labelled.where("lang is not null and text <> ''").select("lang", F.xxhash64("doc_id", F.lit("sample")).alias("chance"), "text")
    many = F.ceil(F.octet_length("text") / WINDOW)
    counts = {r["lang"]: r for r in rows.groupBy("lang").agg(F.sum(many).alias("windows"), F.count("*").alias("docs")).collect()}  # a row per output
    if not counts:
        return None
    labels = sorted(counts)
    windows = np.array([counts[x]["windows"] for x in labels])
    weights = windows.sum() / (len(labels) * windows)
    network = Network(labels)
    stride = [max(1, min(counts[x]["windows"] * len(labels) // LESSON, counts[x]["docs"] // LESSON_DOCS)) for x in labels]
    every = F.create_map(*[F.lit(v) for pair in zip(labels, stride, strict=True) for v in pair])
    schema = "lang string, turn int, chance long, bytes binary"
    first = rows.where(F.pmod("chance", every[F.col("lang")]) == 0).mapInArrow(_draw(LESSON // LESSON_DOCS), schema)
    seen = _taught(network, weights, first, 1, BATCH, STEPS, lambda step: RATE * (1 - 0.9 * min(step / STEPS, 1)))
    if seen < windows.sum():
        slices = int(min(max(windows.sum() // SLICE, 1), SLICES))
        _taught(network, weights, rows.mapInArrow(_draw(), schema), slices, SLICE_BATCH, 0, lambda _: SLICE_RATE)
    return network


def _predict(shared, text: str, keep: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, room = shared.value, Room()
        for batch in batches:
            for part in pieces(batch, text):
                texts = part.column(text)
                names = [n for n in part.schema.names if keep or n != text]
                letters = [bool(t) and any(map(str.isalpha, t)) for t in texts.to_pylist()]  # category L
                if network is None:
                    found, score = [UNKNOWN] * len(letters), [0.0] * len(letters)
                else:
                    p = pooled(network, *utf8(texts), room)
                    best = p.argmax(axis=1)
                    found = [network.labels[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), letters, strict=True)]
                    score = [min(float(s), 1.0) if ok else 0.0 for s, ok in zip(p.max(axis=1).tolist(), letters, strict=True)]
                told = [pa.array(found, pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *told], [*names, "lang_pred", "score"])
        room.clear()
        give_back()

    return work


def predict(docs: DataFrame, network: Network | None, text: str = "text", keep: bool = True) -> DataFrame:
    """``docs`` with lang_pred and score, in place of columns so named; without ``keep`` the text goes no further."""
    given = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([f for f in given.schema.fields if keep or f.name != text] + added)
    return given.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(network), text, keep), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; documents that are held out teach nothing."""
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    network = learn(docs.where(~out).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", out.alias("held_out"), "text")
    return predict(rows, network, keep=False).select("doc_id", "held_out", "lang_pred", "score")
