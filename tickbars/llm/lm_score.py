"""Log probability of texts by logistic mixing of hashed-context bit predictors.

A text is its words in lower case with one space between them and a line feed
at the end; the model predicts it byte by byte, each byte as eight bits. For
every order from 0 to 5, and for the word so far, a table of fixed size counts zeros
and ones by a hash of these bytes and the bits seen so far. The logits of the
seven predictions are combined by weights that a gate selects, once by the longest
context known and the position of the bit, once by how often each context was
seen; the mean of both is refined by an adaptive probability map.

The counts come from all training texts: n-grams are counted in the tasks,
summed by Spark, and their bits summed into the tables, whose size is fixed.
Weights and map come from all training texts too, each bit left out of its own
counts: a prediction depends on six bytes only, so all occurrences of an n-gram
say the same and count together. The weights of a gate are a logistic
regression of their own. Rounds of Newton's method take them to the best ones:
in each the tasks go through all n-grams and Spark sums slopes and curvatures,
which have a fixed size. One more round fills the map. Weights and map are then
held, so that a score does not depend on the order of tasks; in scoring, tasks
keep what they have worked out. An online pass over some texts may say where the
rounds begin; the best weights are the same from anywhere.

The unigram base needs the count of every token. Tokens that make up a share
of ``frequent`` of all or more, 1 / ``frequent`` of them at most, are sent to
the tasks; the others are joined.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.buffers import Prefix, mix, per_text, slices, words
from tickbars.sources.paths import saved

#: Bytes of a code; contexts have up to one less. The tables are those of orders 0 to 5 and of the word so far.
WIDTH = 6
TABLES = 7
PAD = WIDTH - 1
END = 10
END_TOKEN = np.int64(-7046029254386353131)
#: Slots of a table that travel as one row.
BLOCK = 1 << 12


@dataclass(frozen=True)
class MixSpec:
    """``bits``: log2 of the slots per order; ``sample``: different training texts (about) of an online pass before the
    rounds, and ``sample_bytes`` of them at most; ``batch``: bytes between its updates; ``frequent``: see above; ``tolerance``: the rounds end when the next one can gain less (nats per training bit),
    or after ``rounds``; ``pull``: strength that holds a weight at its first value, in training bits."""

    bits: int = 20
    sample: int = 0
    sample_bytes: int = 1_500_000
    batch: int = 4096
    rate: float = 0.03
    frequent: float = 1e-6
    tolerance: float = 1e-7
    rounds: int = 30
    pull: float = 1.0


def normal(text: str | None) -> bytes:
    return b" ".join((text or "").encode().lower().split())


def _buffer(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded bytes of all texts, places of the bytes to predict, and their offsets per text."""
    made = [normal(t) for t in texts]
    pad = bytes([END]) * PAD
    data = np.frombuffer(b"".join(pad + m + bytes([END]) for m in made), np.uint8)
    sizes = np.array([len(m) + 1 for m in made], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    places = np.arange(offsets[-1]) + np.repeat(np.arange(1, len(made) + 1) * PAD, sizes)
    return data, places, offsets


def _codes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The six bytes that end at each place as one integer, the predicted byte lowest."""
    wide = data.astype(np.uint64)
    code = wide.copy()
    for back in range(1, WIDTH):
        code[back:] |= wide[:-back] << np.uint64(8 * back)
    return code[places].view(np.int64)


def _tokens(data: np.ndarray, places: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, the end of each text included, and offsets per text."""
    body = data[places]
    starts, ends, first = words(body, offsets)
    hashed = Prefix(body).ranges(starts, ends).view(np.int64)
    return np.insert(hashed, first[1:], END_TOKEN), first + np.arange(len(first))


class _Tally:
    """Counts of 64-bit keys, merged as they grow."""

    def __init__(self, limit: int = 1 << 22) -> None:
        self.parts, self.held, self.limit = [], 0, limit

    def add(self, keys: np.ndarray) -> None:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])
        if self.held > self.limit:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) > 1:
            keys, where = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)
            self.parts = [(keys, counts)]
        self.held = len(self.parts[0][0]) if self.parts else 0
        return self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _count(texts: DataFrame) -> DataFrame:
    """(kind, key, n): n-grams of six bytes (kind 0) and tokens (kind 1) per task."""

    def run(batches):
        grams, tokens = _Tally(), _Tally()
        for part in slices(batches, limit=1 << 20):
            data, places, offsets = _buffer(part.column("text").to_pylist())
            grams.add(_codes(data, places))
            tokens.add(_tokens(data, places, offsets)[0])
            for kind, tally in ((0, grams), (1, tokens)):
                if tally.held > tally.limit // 2:  # it did not shrink by merging: pass it on
                    keys, counts = tally.merge()
                    yield from _rows(kind, keys, counts)
                    tally.parts, tally.held = [], 0
        for kind, tally in ((0, grams), (1, tokens)):
            yield from _rows(kind, *tally.merge())

    def _rows(kind, keys, counts):
        for a in range(0, len(keys), 1 << 16):
            k, n = keys[a : a + (1 << 16)], counts[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n)], names=["kind", "key", "n"])

    return texts.select("text").mapInArrow(run, "kind int, key long, n long")


def _slots(codes: np.ndarray, bits: int) -> np.ndarray:
    """Slots of the eight bits of each code's byte in the tables of all orders: (order, bit, code)."""
    wide = codes.view(np.uint64)
    symbol = (wide & np.uint64(255)).astype(np.int64)
    nodes = np.stack([(1 << j) | (symbol >> (8 - j)) for j in range(8)]).astype(np.uint64)
    out = np.empty((TABLES, 8, len(codes)), np.int64)
    for order in range(TABLES):
        context = (wide >> np.uint64(8)) & np.uint64((1 << (8 * order)) - 1) if order < WIDTH else _word(wide >> np.uint64(8))
        seed = mix(context + np.uint64((order + 1) << 56))
        out[order] = (mix(seed ^ (nodes * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(64 - bits)).astype(np.int64) + (order << bits)
    return out


def _word(context: np.ndarray) -> np.ndarray:
    """The bytes of a context since its last white space."""
    out, alive = np.zeros_like(context), np.ones(len(context), bool)
    for k in range(WIDTH - 1):
        byte = (context >> np.uint64(8 * k)) & np.uint64(255)
        alive &= (byte != 32) & (byte != END)
        out |= np.where(alive, byte, np.uint64(0)) << np.uint64(8 * k)
    return out


def _bits_of(codes: np.ndarray) -> np.ndarray:
    symbol = codes & 255
    return np.stack([(symbol >> (7 - j)) & 1 for j in range(8)])


def _tables(grams: DataFrame, bits: int) -> np.ndarray:
    """Zeros and ones per slot, (2, orders * 2**bits), on the driver: a fixed size."""
    size = TABLES << bits

    def add(batches):
        sums = np.zeros((2, size), np.float32)
        for batch in batches:
            codes, counts = (batch.column(k).to_numpy() for k in range(2))
            for a in range(0, len(codes), 1 << 15):
                c, n = codes[a : a + (1 << 15)], counts[a : a + (1 << 15)]
                slots, ones = _slots(c, bits), _bits_of(c)
                for order in range(TABLES):
                    np.add.at(sums, (ones, slots[order]), n)
        for block in np.flatnonzero(sums.reshape(2, -1, BLOCK).any(axis=(0, 2))):
            yield _block_row(block, sums[:, block * BLOCK : (block + 1) * BLOCK])

    def total(batches):
        for batch in batches:
            for block, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _block_row(block, np.sum([np.frombuffer(p, np.float32) for p in parts], axis=0, dtype=np.float64).astype(np.float32))

    made = grams.select("key", "n").mapInArrow(add, "block int, counts binary")
    made = made.groupBy("block").agg(F.collect_list("counts").alias("parts")).mapInArrow(total, "block int, counts binary")
    out = np.zeros((2, size), np.float32)
    for row in made.toLocalIterator():
        out[:, row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.counts, np.float32).reshape(2, BLOCK)
    return out


def _block_row(block: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([int(block)], pa.int32()), pa.array([np.ascontiguousarray(counts).tobytes()], pa.binary())], names=["block", "counts"])


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Mixer:
    """Gated weights over the predictions of all tables, and the map that refines their result."""

    STEPS = 33
    BUCKETS = 14
    #: Added to zeros and ones, so that a logit is finite.
    PRIOR = 0.1
    #: Bits that an entry of the map has before any falls to it.
    HELD = 50

    def __init__(self, counts: np.ndarray, spec: MixSpec) -> None:
        self.counts, self.spec = counts, spec
        self.by_place, self.by_count, self.map = self.first()
        self.squares = [np.zeros_like(self.by_place), np.zeros_like(self.by_count)]

    @classmethod
    def first(cls) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights and map before anything is learned."""
        start = np.array([0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.25], np.float32)
        by_count = np.tile(start[:, None], (WIDTH, 1, cls.BUCKETS))
        return np.tile(start, (WIDTH * 8, 1)), by_count, np.tile(_squash(np.linspace(-8, 8, cls.STEPS)), (256, 1))

    def _inputs(self, slots: np.ndarray, own: np.ndarray | None):
        """Logits (tables, n), the longest context known, and a bucket of every count; ``own``: bits to leave out."""
        zeros, ones = self.counts[0][slots], self.counts[1][slots]
        if own is not None:
            zeros, ones = np.maximum(zeros - (1 - own), 0), np.maximum(ones - own, 0)
        seen = zeros + ones
        logits = np.log((ones + self.PRIOR) / (zeros + self.PRIOR)).astype(np.float32)
        longest = WIDTH - 1 - np.argmax(seen[WIDTH - 1 :: -1] > 0, axis=0)
        return logits, longest, np.minimum(np.log2(seen + 1).astype(np.int64), self.BUCKETS - 1)

    def _mapped(self, node: np.ndarray, logit: np.ndarray):
        at = np.clip((logit + 8) * ((self.STEPS - 1) / 16), 0, self.STEPS - 1.001)
        low = at.astype(np.int64)
        share = at - low
        return low, share, self.map[node, low] * (1 - share) + self.map[node, low + 1] * share

    def bit(self, slots: np.ndarray, bit: int, node: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Probability of a one. Given the bits ``own``, weights and map move towards them."""
        logits, longest, bucket = self._inputs(slots, own)
        place, table = longest * 8 + bit, np.arange(TABLES)[:, None]
        first = np.einsum("kn,nk->n", logits, self.by_place[place])
        second = np.einsum("kn,kn->n", logits, self.by_count[longest[None], table, bucket])
        mixed = (first + second) / 2
        low, share, refined = self._mapped(node, mixed)
        if own is not None:
            step = np.zeros_like(self.by_place)
            np.add.at(step, place, (logits * (own - _squash(first))).T)
            self._move(self.by_place, self.squares[0], step)
            gate = ((longest[None] * TABLES + table) * self.BUCKETS + bucket).ravel()
            step = np.bincount(gate, (logits * (own - _squash(second))).ravel(), self.by_count.size)
            self._move(self.by_count, self.squares[1], step.reshape(self.by_count.shape))
            for k, part in ((low, 1 - share), (low + 1, share)):
                hits = np.bincount(node * self.STEPS + k, part, self.map.size).reshape(self.map.shape)
                ones = np.bincount(node * self.STEPS + k, part * own, self.map.size).reshape(self.map.shape)
                self.map += np.minimum(0.02 * hits, 0.3) * (ones / np.maximum(hits, 1e-9) - self.map) * (hits > 0)
            np.clip(self.map, 1e-5, 1 - 1e-5, out=self.map)
        return np.clip((_squash(mixed) + refined) / 2, 1e-6, 1 - 1e-6)

    def _move(self, weights: np.ndarray, squares: np.ndarray, step: np.ndarray) -> None:
        squares += step * step
        weights += self.spec.rate * step / np.sqrt(squares + 1e-3)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the lowest byte of each code, given the others."""
        out = np.zeros(len(codes))
        for a in range(0, len(codes), 1 << 15):
            part = codes[a : a + (1 << 15)]
            slots, ones = _slots(part, self.spec.bits), _bits_of(part)
            for j in range(8):
                p = self.bit(slots[:, j], j, (1 << j) | ((part & 255) >> (8 - j)))
                out[a : a + (1 << 15)] += np.log10(np.where(ones[j] == 1, p, 1 - p))
        return out

    def learn(self, texts: list[str]) -> None:
        """One pass over texts that are part of the counts."""
        codes = np.concatenate([_codes(*_buffer([t])[:2]) for t in texts]) if texts else np.zeros(0, np.int64)
        for a in range(0, len(codes), self.spec.batch):
            part = codes[a : a + self.spec.batch]
            slots, ones = _slots(part, self.spec.bits), _bits_of(part)
            for j in range(8):
                self.bit(slots[:, j], j, (1 << j) | ((part & 255) >> (8 - j)), ones[j].astype(np.float32))


    def _left_out(self, codes: np.ndarray):
        """Per bit of the codes, which are part of the counts: bit, node, value, and inputs without this one."""
        slots, ones = _slots(codes, self.spec.bits), _bits_of(codes)
        for j in range(8):
            own = ones[j].astype(np.float32)
            yield j, (1 << j) | ((codes & 255) >> (8 - j)), own, *self._inputs(slots[:, j], own)

    #: Shapes of the sums over all training bits: losses, slopes and curvatures of both gates.
    FEATURES = TABLES * BUCKETS
    MOMENTS = ((WIDTH * 8,), (WIDTH * 8, TABLES), (WIDTH * 8, TABLES, TABLES), (WIDTH,), (WIDTH, FEATURES), (WIDTH, FEATURES, FEATURES))

    def moments(self, codes: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
        """``MOMENTS`` at the present weights, of codes that occur ``times``."""
        out = [np.zeros(shape) for shape in self.MOMENTS]
        table = np.arange(TABLES)[:, None]
        left, right = np.triu_indices(TABLES)
        for j, _, own, logits, longest, bucket in self._left_out(codes):
            place, feature = longest * 8 + j, table * self.BUCKETS + bucket
            first = np.einsum("kn,nk->n", logits, self.by_place[place])
            second = np.einsum("kn,kn->n", logits, self.by_count[longest[None], table, bucket])
            off, curve, loss = _logistic(first, own, times)
            np.add.at(out[0], place, loss)
            for k in range(WIDTH):
                mine = longest == k
                x = logits[:, mine].astype(np.float64)
                out[1][k * 8 + j] -= x @ off[mine]
                out[2][k * 8 + j] += (x * curve[mine]) @ x.T
            off, curve, loss = _logistic(second, own, times)
            out[3] += np.bincount(longest, loss, WIDTH)
            out[4] -= np.bincount((longest * self.FEATURES + feature).ravel(), (logits * off).ravel(), out[4].size).reshape(out[4].shape)
            pair = (longest * self.FEATURES + feature[left]) * self.FEATURES + feature[right]
            out[5] += np.bincount(pair.ravel(), (logits[left] * logits[right] * curve).ravel(), out[5].size).reshape(out[5].shape)
        return out

    def mapped(self, codes: np.ndarray, times: np.ndarray) -> list[np.ndarray]:
        """Per entry of the map, the bits that fall to it and the ones among them."""
        hits, found = np.zeros(self.map.size), np.zeros(self.map.size)
        table = np.arange(TABLES)[:, None]
        for j, node, own, logits, longest, bucket in self._left_out(codes):
            first = np.einsum("kn,nk->n", logits, self.by_place[longest * 8 + j])
            second = np.einsum("kn,kn->n", logits, self.by_count[longest[None], table, bucket])
            low, share, _ = self._mapped(node, (first + second) / 2)
            for k, part in ((low, 1 - share), (low + 1, share)):
                hits += np.bincount(node * self.STEPS + k, part * times, self.map.size)
                found += np.bincount(node * self.STEPS + k, part * times * own, self.map.size)
        return [hits, found]


def _logistic(logit: np.ndarray, own: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each logit falls short by, its curvature and its loss in nats, all times ``times``."""
    p = _squash(logit)
    return times * (own - p), times * p * (1 - p), times * (np.logaddexp(0, logit) - own * logit)


def _over_all(grams: DataFrame, shapes: Sequence[tuple[int, ...]], made: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums of what ``made`` gives for all (key, n), on the driver; Spark adds up the tasks' sums block by block."""
    sizes = [int(np.prod(shape)) for shape in shapes]

    def add(batches):
        sums = np.zeros(sum(sizes))
        for batch in batches:
            codes, times = (batch.column(k).to_numpy() for k in range(2))
            for a in range(0, len(codes), 1 << 15):
                parts = made(codes[a : a + (1 << 15)], times[a : a + (1 << 15)].astype(np.float64))
                sums += np.concatenate([p.ravel() for p in parts])
        for a in range(0, len(sums), BLOCK):
            if sums[a : a + BLOCK].any():
                yield _block_row(a // BLOCK, sums[a : a + BLOCK])

    def total(batches):
        for batch in batches:
            for block, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _block_row(block, np.sum([np.frombuffer(p) for p in sorted(parts)], axis=0))

    rows = grams.select("key", "n").mapInArrow(add, "block int, counts binary")
    rows = rows.groupBy("block").agg(F.collect_list("counts").alias("parts")).mapInArrow(total, "block int, counts binary")
    out = np.zeros(sum(sizes))
    for row in rows.toLocalIterator():
        part = np.frombuffer(row.counts)
        out[row.block * BLOCK : row.block * BLOCK + len(part)] = part
    return [p.reshape(shape) for p, shape in zip(np.split(out, np.cumsum(sizes)[:-1]), shapes)]


def _fit(mixer: Mixer, grams: DataFrame) -> None:
    """Weights and map of all training texts, given as n-grams (key, n)."""
    spec, shared = mixer.spec, grams.sparkSession.sparkContext.broadcast(mixer.counts)

    def over_all(shapes, name):
        weights = mixer.by_place, mixer.by_count

        def made(codes, times):
            own = Mixer(shared.value, spec)
            own.by_place, own.by_count = weights
            return getattr(own, name)(codes, times)

        return _over_all(grams, shapes, made)

    first, by_count, blank = Mixer.first()
    rest = [first.astype(np.float64), by_count.reshape(WIDTH, -1).astype(np.float64)]
    tried = [mixer.by_place.astype(np.float64), mixer.by_count.reshape(WIDTH, -1).astype(np.float64)]
    best, least, step, gain = [t.copy() for t in tried], [np.inf, np.inf], [0.0 * t for t in tried], [np.zeros(len(t)) for t in tried]
    bits = 8 * (grams.agg(F.sum("n")).first()[0] or 0)
    for _ in range(spec.rounds):
        mixer.by_place, mixer.by_count = tried[0], tried[1].reshape(by_count.shape)
        sums = over_all(Mixer.MOMENTS, "moments")
        for k in range(2):
            loss, slope, curve = sums[3 * k : 3 * k + 3]
            curve = curve + np.triu(curve, 1).swapaxes(1, 2) if k else curve  # one triangle was summed
            away = tried[k] - rest[k]
            loss, slope = loss + spec.pull / 2 * (away**2).sum(axis=1), slope + spec.pull * away
            good = loss <= least[k]  # of each regression; a step that made it worse is halved
            found = -np.linalg.solve(curve + spec.pull * np.eye(slope.shape[1]), slope[..., None])[..., 0]
            best[k] = np.where(good[:, None], tried[k], best[k])
            least[k] = np.where(good, loss, least[k])
            gain[k] = np.where(good, -(slope * found).sum(axis=1) / 2, gain[k])
            step[k] = np.where(good[:, None], found, step[k] / 2)
            tried[k] = best[k] + step[k]
        if gain[0].sum() + gain[1].sum() <= spec.tolerance * bits:
            break
    mixer.by_place, mixer.by_count = best[0].astype(np.float32), best[1].reshape(by_count.shape).astype(np.float32)
    hits, found = over_all([blank.shape, blank.shape], "mapped")
    mixer.map = np.clip((found + Mixer.HELD * blank) / (hits + Mixer.HELD), 1e-5, 1 - 1e-5)
    shared.unpersist()


@dataclass
class TextModel:
    """``counts``: table (key, n) of all training tokens; the frequent ones also as sorted arrays."""

    mixer: Mixer
    counts: DataFrame
    keys: np.ndarray
    times: np.ndarray
    total: int
    kinds: int


def _drawn(texts: DataFrame, spec: MixSpec) -> list[str]:
    """Texts for the pass before the rounds; copies of a text are drawn as one."""
    rows = texts.where("text IS NOT NULL").select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 30)).alias("draw"))
    size = rows.agg(F.approx_count_distinct(F.xxhash64("text"))).first()[0]
    share = int((1 << 30) * min(1.0, spec.sample / size)) if size else 0
    drawn, used = [], 0
    for row in rows.where(F.col("draw") < share).distinct().orderBy("draw", "text").toLocalIterator():
        used += len(row.text)
        if used > spec.sample_bytes and drawn:
            break
        drawn.append(row.text)
    return drawn


def train(texts: DataFrame, spec: MixSpec = MixSpec()) -> TextModel:
    """A model of all rows of ``texts`` (text); a null text counts as empty."""
    counted = saved(_count(texts).groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    grams, tokens = counted.where("kind = 0"), counted.where("kind = 1").select("key", "n")
    mixer = Mixer(_tables(grams, spec.bits), spec)
    if spec.sample:
        mixer.learn(_drawn(texts, spec))
    _fit(mixer, grams)
    total, kinds = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = tokens.where(F.col("n") >= max(1.0, spec.frequent * total)).toPandas().sort_values("key")
    return TextModel(mixer, tokens, often["key"].to_numpy(np.int64), often["n"].to_numpy(np.int64), total, kinds)


SCORED = "uid long, doc_id long, n_tokens long, known long, base double, score double, n_bytes long, rare array<long>, rare_n array<int>"


def _scored(docs: DataFrame, model: TextModel) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((model.mixer, model.keys, model.times))

    def run(batches):
        mixer, keys, times = shared.value
        logs = np.log10(times + 0.5)
        known, values = np.zeros(0, np.int64), np.zeros(0)
        uid = TaskContext.get().partitionId() << 40
        for part in slices(batches, limit=1 << 20):
            data, places, offsets = _buffer(part.column("text").to_pylist())
            codes, where = np.unique(_codes(data, places), return_inverse=True)
            at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
            old = known[at] == codes if len(known) else np.zeros(len(codes), bool)
            value = np.empty(len(codes))
            value[old] = values[at[old]]
            value[~old] = mixer.log10(codes[~old])
            if len(known) > 1 << 21:
                known, values = codes, value
            else:
                known, order = np.unique(np.concatenate([known, codes[~old]]), return_index=True)
                values = np.concatenate([values, value[~old]])[order]
            score = per_text(value[where], offsets, np.add, 0.0)

            tokens, bounds = _tokens(data, places, offsets)
            at = np.minimum(np.searchsorted(keys, tokens), max(len(keys) - 1, 0))
            hit = keys[at] == tokens if len(keys) else np.zeros(len(tokens), bool)
            base = per_text(np.where(hit, logs[at] if len(keys) else 0.0, 0.0), bounds, np.add, 0.0)
            n_known = per_text(hit.astype(np.int64), bounds, np.add, 0)
            text = np.repeat(np.arange(part.num_rows), np.diff(bounds))[~hit]
            rest = tokens[~hit]
            order = np.lexsort((rest, text))
            text, rest = text[order], rest[order]
            new = np.ones(len(rest), bool)
            new[1:] = (text[1:] != text[:-1]) | (rest[1:] != rest[:-1])
            head = np.flatnonzero(new)
            lists = np.searchsorted(text[head], np.arange(part.num_rows + 1)).astype(np.int32)
            counts = np.diff(np.append(head, len(rest))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(uid + np.arange(part.num_rows)),
                    part.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array(n_known),
                    pa.array(base),
                    pa.array(score),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(lists, pa.array(rest[head])),
                    pa.ListArray.from_arrays(lists, pa.array(counts)),
                ],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )
            uid += part.num_rows

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORED)


def score(docs: DataFrame, model: TextModel) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Scores are log10 probabilities. A null text counts as empty and consists
    of its end.
    """
    made = saved(_scored(docs, model), "scored")
    rare = made.select("uid", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("uid", "x.*").withColumnRenamed("rare", "key")
    rare = rare.join(model.counts.hint("merge"), "key", "left").withColumn("c", F.coalesce("n", F.lit(0)))
    rare = rare.groupBy("uid").agg(
        F.sum(F.col("rare_n") * F.log10(F.col("c") + 0.5)).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("rare_n"))).alias("more_known")
    )
    whole = F.log10(F.lit(model.total + 0.5 * (model.kinds + 1)))
    return made.join(rare.hint("merge"), "uid", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"),
        "score",
        (-F.col("score") * F.log2(F.lit(10.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
