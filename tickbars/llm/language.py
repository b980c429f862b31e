"""Language of a text by character models with interpolated Kneser-Ney smoothing.

One model per language over runs of letters in lower case. All n-grams that
any language has seen lie in one sorted array of hashes per order, beside the
smoothed log probability in every language; an n-gram no language has seen
backs off by the weight of its context. A text goes to the language with the
lowest cross-entropy per character.

Counts come from a bounded sample of labelled texts: about ``sample`` whole
texts per language, drawn by hash; copies of a text are one. A fifth of them
is kept from the counts to calibrate the score and the rejection.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.buffers import mix, per_text, slices, text_bytes

SPACE = 32
#: Bytes of text that a task scores at once; its arrays take some 150 times as much.
SLICE = 1 << 17


@dataclass(frozen=True)
class LanguageSpec:
    """``reject``: how many deviations above its language's mean a cross-entropy may lie."""

    order: int = 4
    sample: int = 1000
    discount: float = 0.75
    reject: float = 12.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to lower-case letter, or to a space."""
    table = np.full(0x110000, SPACE, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as letters with single spaces around words; (code points, offsets)."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    low = _letters()[points]
    # A space in front of each text, and of several spaces one.
    low, bounds = np.insert(low, heads[:-1], SPACE), heads + np.arange(len(heads))
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != SPACE) | (low[:-1] != SPACE)
    keep[bounds[:-1]] = True
    return low[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]


def ngram_hashes(points: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n-gram that ends at each place, whether it lies within one text)."""
    hashed = np.zeros(len(points), np.uint64)
    wide = points.astype(np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.zeros_like(wide)
        shifted[back:] = wide[: len(wide) - back]
        hashed = (hashed ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    place = np.arange(len(points)) - np.repeat(offsets[:-1], np.diff(offsets))
    return hashed, place >= order - 1


@dataclass
class LanguageModel:
    """Sorted hashes of n-grams per order with log probabilities; contexts with back-off weights."""

    languages: list[str]
    spec: LanguageSpec
    grams: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    unseen: float
    scale: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0))
    noise: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def entropies(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(texts x languages: nats per character, scored characters per text)."""
        points, bounds = letters(data, offsets)
        logs = np.zeros((len(points), len(self.languages)), np.float32)
        hashes = [ngram_hashes(points, bounds, n) for n in range(1, self.spec.order + 1)]
        place = np.arange(len(points)) - np.repeat(bounds[:-1], np.diff(bounds))
        at = np.flatnonzero(place >= 1)  # the space in front of a text is only context
        for n in range(self.spec.order, 0, -1):
            known, inside = hashes[n - 1]
            ready = inside[at]
            rest = at[~ready]
            look = at[ready]
            slot = np.minimum(np.searchsorted(self.grams[n - 1], known[look]), len(self.grams[n - 1]) - 1)
            hit = self.grams[n - 1][slot] == known[look]
            logs[look[hit]] += self.logs[n - 1][slot[hit]]
            missed = look[~hit]
            if n > 1 and len(missed):
                context = hashes[n - 2][0][missed - 1]
                slot = np.minimum(np.searchsorted(self.contexts[n - 1], context), len(self.contexts[n - 1]) - 1)
                hit = self.contexts[n - 1][slot] == context
                logs[missed[hit]] += self.weights[n - 1][slot[hit]]
            elif len(missed):
                logs[missed] += self.unseen + self.weights[0][0]
            at = np.concatenate([rest, missed])
        counts = np.maximum(np.diff(bounds) - 1, 0)
        total = np.stack([per_text(logs[:, k].astype(np.float64), bounds, np.add, 0.0) for k in range(len(self.languages))], axis=1)
        has = per_text((points != SPACE).astype(np.int64), bounds, np.add, 0) > 0
        counts = np.where(has, counts, 0)
        return -total / np.maximum(counts, 1)[:, None], counts


def _counts(sample: DataFrame, order: int) -> list[tuple]:
    """(language, n-gram, count) of the highest order, and of text starts."""

    def run(batches):
        for batch in batches:
            found: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                data = np.frombuffer((text or "").encode(), np.uint8)
                points, _ = letters(data, np.array([0, len(data)]))
                line = points.astype("<u4").tobytes().decode("utf-32-le")
                found.update((lang, line[max(0, k - order) : k]) for k in range(2, len(line) + 1))
            keys = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([found[k] for k in keys], pa.int64())],
                names=["lang", "gram", "n"],
            )

    made = sample.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    return [tuple(r) for r in made.groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect()]


def _gram_hash(grams: Iterable[str]) -> np.ndarray:
    out = []
    by_size: dict[int, list[str]] = {}
    grams = list(grams)
    for g in grams:
        by_size.setdefault(len(g), []).append(g)
    known = {}
    for size, items in by_size.items():
        points = np.frombuffer("".join(items).encode("utf-32-le"), np.uint32)
        hashed, _ = ngram_hashes(points, np.array([0, len(points)]), size)
        known.update(zip(items, hashed[size - 1 :: size]))
    out = [known[g] for g in grams]
    return np.array(out, np.uint64)


def _smoothed(rows: list[tuple], languages: list[str], spec: LanguageSpec) -> LanguageModel:
    """Interpolated Kneser-Ney tables of the counts: continuation counts below the highest order."""
    if not rows:
        return LanguageModel([], spec, [], [], [], [], 0.0)
    counts: list[list[Counter]] = [[Counter() for _ in languages] for _ in range(spec.order)]
    where = {lang: k for k, lang in enumerate(languages)}
    for lang, gram, n in rows:
        counts[len(gram) - 1][where[lang]][gram] += n
    for n in range(spec.order - 1, 0, -1):
        for k in range(len(languages)):
            for gram in counts[n][k]:
                counts[n - 1][k][gram[1:]] += 1
    alphabet = {g for k in range(len(languages)) for g in counts[0][k]}
    uniform = 1.0 / (len(alphabet) + 1)
    model = LanguageModel(languages, spec, [], [], [], [], float(np.log(uniform)))
    lower: list[dict[str, float]] = [{} for _ in languages]
    for n in range(spec.order):
        grams = sorted({g for k in range(len(languages)) for g in counts[n][k]})
        contexts = sorted({g[:-1] for g in grams})
        place = {c: i for i, c in enumerate(contexts)}
        logs = np.zeros((len(grams), len(languages)))
        weights = np.zeros((len(contexts), len(languages)))
        for k in range(len(languages)):
            total, kinds = np.zeros(len(contexts)), np.zeros(len(contexts))
            for g, c in counts[n][k].items():
                total[place[g[:-1]]] += c
                kinds[place[g[:-1]]] += 1
            weight = np.where(total > 0, spec.discount * kinds / np.maximum(total, 1), 1.0)
            weights[:, k] = np.log(weight)
            mine, below = {}, lower[k]
            for i, g in enumerate(grams):
                p = place[g[:-1]]
                base = below.get(g[1:], uniform) if n else uniform
                c = counts[n][k].get(g, 0)
                mine[g] = (max(c - spec.discount, 0) / total[p] if total[p] else 0.0) + weight[p] * base
                logs[i, k] = np.log(mine[g])
            lower[k] = mine
        hashed, chashed = _gram_hash(grams), (_gram_hash(contexts) if n else np.zeros(1, np.uint64))
        order, corder = np.argsort(hashed), np.argsort(chashed)
        model.grams.append(hashed[order])
        model.logs.append(logs[order].astype(np.float32))
        model.contexts.append(chashed[corder])
        model.weights.append(weights[corder].astype(np.float32))
    return model


def train(labelled: DataFrame, spec: LanguageSpec = LanguageSpec()) -> LanguageModel:
    """A model from rows (lang, text); rows with a null language or text are left out."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    # All copies of a text have one draw: they count as one text and are merged in the tasks.
    sizes = {r.lang: r["count"] for r in rows.select("lang", "h").distinct().groupBy("lang").count().collect()}
    languages = sorted(sizes)
    share = F.lit(1 << 20)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, int((1 << 20) * min(1.0, spec.sample / size))).otherwise(share)
    drawn = rows.where(F.pmod("h", F.lit(1 << 20)) < share).groupBy("lang", "h").agg(F.min("text").alias("text"))
    held = F.pmod(F.xxhash64(F.lit("held"), "text"), F.lit(5)) == 0
    model = _smoothed(_counts(drawn.where(~held), spec.order), languages, spec)
    _calibrate(model, drawn.where(held))
    return model


def _calibrate(model: LanguageModel, held: DataFrame) -> None:
    """Scale of the scores by least log loss; mean and spread of the entropies per language."""
    n = len(model.languages)
    if not n:
        return
    shared = held.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, limit=SLICE):
            values, counts = shared.value.entropies(*text_bytes(part.column("text")))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), n).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("lang"), lists, pa.array(counts)], names=["lang", "values", "n"])

    rows = held.select("lang", "text").mapInArrow(run, "lang string, values array<double>, n long").where("n > 0").collect()
    model.mean, model.spread, model.noise = np.full(n, 3.0), np.full(n, 0.3), np.full(n, 3.0)
    if not rows:
        return
    values, sizes = np.array([r["values"] for r in rows]), np.array([r["n"] for r in rows])
    truth = np.array([model.languages.index(r["lang"]) for r in rows])
    evidence = -values * np.sqrt(sizes)[:, None]
    losses = []
    for scale in (scales := 2.0 ** np.arange(-2, 7)):
        x = evidence * scale
        losses.append(np.mean(np.logaddexp.reduce(x, axis=1) - x[np.arange(len(x)), truth]))
    model.scale = float(scales[int(np.argmin(losses))])
    for k in range(n):
        mine, size = values[truth == k, k], sizes[truth == k]
        if len(mine) >= 20:
            model.mean[k] = mine.mean()
            long_ = size >= np.median(size)
            model.spread[k] = max(0.02, mine[long_].std())
            model.noise[k] = max(0.5, np.sqrt(np.mean((mine - mine.mean()) ** 2 * size)))


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` with lang_pred, score (0 to 1) and rejected.

    A null text and one without a letter is ``und`` with score 0 and is
    rejected. Any other one gets a learned language; it is rejected where its
    cross-entropy lies too far above what texts of that language have.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], F.col("text").alias("text"))

    def run(batches):
        model = shared.value
        names = pa.array([*model.languages, "und"])
        for part in slices(batches, limit=SLICE):
            if model.languages:
                values, counts = model.entropies(*text_bytes(part.column("text")))
                best = np.where(counts > 0, values.argmin(axis=1), len(model.languages))
                x = -(values - values.min(axis=1, keepdims=True)) * (np.sqrt(counts) * model.scale)[:, None]
                score = np.where(counts > 0, 1.0 / np.exp(x).sum(axis=1), 0.0)
                at = np.minimum(best, len(model.languages) - 1)
                limit = model.mean[at] + model.spec.reject * np.sqrt(model.spread[at] ** 2 + model.noise[at] ** 2 / np.maximum(counts, 1))
                rejected = (counts == 0) | (values.min(axis=1) > limit)
            else:
                best, score, rejected = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows), np.ones(part.num_rows, bool)
            made = [names.take(pa.array(best)), pa.array(score), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*part.schema.names[:-1], "lang_pred", "score", "rejected"])

    kept = ", ".join(f"_{i} {t}" for i, t in enumerate(dict(docs.dtypes)[c] for c in keep))
    out = plain.mapInArrow(run, f"{kept}, lang_pred string, score double, rejected boolean")
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score", "rejected")
