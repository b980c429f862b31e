"""Exact token counts of every prefix of a text, by dynamic programming.

Byte-level BPE gives every prefix of a piece one encoding, and two tokens may
stand side by side in an encoding just if merging the two alone leaves them as
they are. So the encoding of a prefix is that of a shorter prefix and one more
token, the only one that fits: one walk over the piece finds the counts of all
its prefixes (``Vocabulary.prefixes``).

A text is split into pieces by the tokenizer's pattern. The pattern looks
ahead, so a text that ends inside a piece can be split in another way than the
whole text: inside a contraction, and where white space of several characters
ends. These places get the count that the shorter text has. Special strings
count as one token once they are complete, as ordinary text before.

The table of ``prefix_counts`` keeps ``steps``: how much every further
character adds, as little-endian signed 16-bit integers, one per code point.
Its running sum at ``k`` is the count of the first ``k`` characters; with it,
``within_budget`` and ``tokens_before`` answer questions about any limit
without encoding anything again.

Defined cases: a null or empty text has no tokens and no steps. Texts are
counted whole, however long; rows with equal ids or texts are counted each by
itself; further columns are never looked at, those in ``keep`` are carried
along under any name but those of the result.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickbars.llm.bpe import _splitter
from tickbars.llm.buffers import slices

#: Pieces a task remembers; those it meets again cost a look-up.
REMEMBERED = 1 << 20
#: Longer pieces are worked out each time; longer texts are split as a stream.
LONG_PIECE, LONG_TEXT = 64, 1 << 20
SLICE = 1 << 20
#: A beginning of a token that is none itself.
PART = -1


def byte_alphabet() -> dict[str, int]:
    """Character that stands for a byte in vocabulary files: itself if it shows, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Steps(dict):
    """The steps of pieces, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        found = self.vocabulary.steps(piece)
        if len(piece) <= LONG_PIECE:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = found
        return found


class Vocabulary:
    """Tokens and merges of a byte-level BPE file in JSON, with its special strings."""

    def __init__(self, content: bytes, pattern: str) -> None:
        file = json.loads(content)
        alphabet = byte_alphabet()

        def plain(text: str) -> bytes:
            return bytes(alphabet[c] for c in text)

        self.tokens = [b""] * (1 + max(file["model"]["vocab"].values(), default=0))
        for token, k in file["model"]["vocab"].items():
            self.tokens[k] = plain(token)
        pairs = (m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"])
        self.ranks = {(plain(a), plain(b)): k for k, (a, b) in enumerate(pairs)}
        # How a token came about; the parts of a merge are older than the merge.
        self.made = {a + b: (k, a, b) for (a, b), k in self.ranks.items()}
        born = {token: k for token, (k, _, _) in self.made.items()}
        self.ordered = len(self.made) == len(self.ranks) and all(max(born.get(a, -1), born.get(b, -1)) < k for (a, b), k in self.ranks.items())
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        # Every beginning of a token: the id if it is one, else PART.
        self.starts: dict[bytes, int] = {}
        for k, token in enumerate(self.tokens):
            for end in range(1, len(token)):
                self.starts.setdefault(token[:end], PART)
            self.starts[token] = k
        special = [x for x in file.get("added_tokens") or [] if x["content"]]
        if any(x[flag] for x in special for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError("special strings that depend on their surroundings are not supported")
        names = [x["content"] for x in special]
        if any(a != b and a in b for a in names for b in names):
            raise ValueError("special strings within others are not supported")
        self.special = regex.compile("|".join(map(regex.escape, names)) or r"(?!)")
        self.pattern = _splitter(pattern)
        self.runs = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})")
        # Of a pair of tokens, as (first + 1) * number of tokens + second; a first of 0 is the start of a piece.
        self.fitting: dict[int, bool] = {}
        self.known = Steps(self)

    def merged(self, data: bytes) -> list[bytes]:
        """Plain BPE: the merge of lowest rank first, the leftmost of equal ones."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at the left (1) or right (2) end of a token while it is merged, each with the rank that ends it."""
        found = self.edges.get((token, side))
        if found is None:
            found, part, until = [], token, float("inf")
            while part:
                found.append((part, until))
                until, *parts = self.made.get(part, (0, b"", b""))
                part = parts[side - 1]
            self.edges[token, side] = found
        return found

    def fits(self, pair: int) -> bool:
        """Whether the second token of ``pair`` can follow the first in an encoding.

        Merges go by rank, so the tokens stay apart unless two parts that stand
        at the border at the same time have a merge that comes before both of
        theirs; of equal merges the left one is first.
        """
        first, token = divmod(pair, len(self.tokens))
        alone = [self.tokens[k] for k in ([first - 1, token] if first else [token])]
        if first and self.ordered:
            ranks = self.ranks.get
            sides = [(ranks((x, y)), u, v) for x, u in self.edge(alone[0], 2) for y, v in self.edge(alone[1], 1)]
            found = not any(r is not None and r < u and r <= v for r, u, v in sides)
        else:
            found = self.merged(b"".join(alone)) == alone
        if len(self.fitting) >= 2 * REMEMBERED:
            self.fitting.clear()
        self.fitting[pair] = found
        return found

    def prefixes(self, data: bytes) -> list[int]:
        """Token counts of the first 0, 1, 2, ... bytes of one piece."""
        size, width = len(data), len(self.tokens)
        counts, last = [0] + [-1] * size, [0] * (size + 1)
        starts, fitting = self.starts.get, self.fitting.get
        for at in range(size):
            before, n, end = last[at], counts[at] + 1, at + 1
            if not n:
                raise ValueError("the vocabulary has no token for a byte of the text")
            token = starts(data[at:end])
            while token is not None:
                if counts[end] < 0 <= token:
                    ok = fitting(before + token)
                    if self.fits(before + token) if ok is None else ok:
                        counts[end], last[end] = n, (token + 1) * width
                end += 1
                token = starts(data[at:end]) if end <= size else None
        return counts

    def count(self, piece: str) -> int:
        return self.prefixes(piece.encode())[-1]

    def steps(self, piece: str) -> bytes:
        """What every character of a piece adds to the count."""
        if piece[0] == "'" and piece[1:2].isalpha():
            # A contraction: shorter texts end in an apostrophe and letters.
            values = [sum(map(self.count, self.pattern.findall(piece[: k + 1]))) for k in range(len(piece))]
        else:
            data = piece.encode()
            values = self.prefixes(data)[1:]
            if len(data) > len(piece):
                values = [n for n, b in zip(values, [*data[1:], 0]) if b & 0xC0 != 0x80]
        return array("h", [b - a for a, b in zip([0, *values], values)]).tobytes()

    def _ordinary(self, text: str) -> np.ndarray:
        if len(text) <= LONG_TEXT:
            pieces = self.pattern.findall(text)
        else:
            pieces = (m.group() for m in self.pattern.finditer(text))
        out = np.frombuffer(bytearray().join(map(self.known.__getitem__, pieces)), np.int16)
        for run in self.runs.finditer(text):
            # A text that ends here has one piece of white space; the whole text cuts off the last character.
            a, r = run.span()
            here = self.count(text[a:r]) - int(out[a : r - 1].sum())
            out[r] += out[r - 1] - here
            out[r - 1] = here
        return out

    def text_steps(self, text: str) -> np.ndarray:
        """What every character of a whole text adds to the count."""
        out, at = [], 0
        for found in self.special.finditer(text):
            a, b = found.span()
            inside = self._ordinary(text[at : b - 1])
            total = int(inside[: a - at].sum()) + 1 - int(inside.sum())
            out += [inside, np.array([total], np.int16)]
            at = b
        out.append(self._ordinary(text[at:]))
        return np.concatenate(out)


@lru_cache(maxsize=2)
def _vocabulary(content: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(content, pattern)


def fitting_chars(steps: np.ndarray, budget: int) -> int:
    """Length of the longest prefix with at most ``budget`` tokens."""
    counts = np.cumsum(steps, dtype=np.int64)
    if not len(counts) or counts[-1] <= budget:
        return len(counts)
    fitting = np.flatnonzero(counts <= budget)
    return int(fitting[-1]) + 1 if len(fitting) else 0


def prefix_counts(
    docs: DataFrame,
    content: bytes,
    pattern: str,
    column: str = "text",
    keep: Sequence[str] = ("doc_id",),
    budget: int | None = None,
    steps: bool = True,
) -> DataFrame:
    """Columns ``keep``, n_bytes (UTF-8), n_chars (code points), n_tokens and steps of every row.

    ``content`` is that of the vocabulary file. With ``budget`` the same pass
    answers for one limit what ``within_budget`` answers for any. Without
    ``steps`` they are used for the answers and not returned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)
    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value, pattern)
        for part in slices(batches, limit=SLICE):
            made = [vocabulary.text_steps(t) for t in part.column("text").to_pylist()]
            columns = {"n_tokens": pa.array([int(x.sum(dtype=np.int64)) for x in made], pa.int64())}
            if budget is not None:
                columns["fitting"] = pa.array([fitting_chars(x, budget) for x in made], pa.int64())
            if steps:
                columns["steps"] = pa.array([x.astype("<i2").tobytes() for x in made], pa.binary())
            rest = [n for n in part.schema.names if n != "text"]
            sizes = pa.array([len(x) for x in made], pa.int64())
            yield pa.RecordBatch.from_arrays([*map(part.column, rest), sizes, *columns.values()], names=[*rest, "n_chars", *columns])

    plain = plain.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kinds = [f"_{i} {t}" for i, t in enumerate(dict(docs.dtypes)[c] for c in keep)]
    schema = ", ".join([*kinds, "n_bytes long, n_chars long, n_tokens long"] + ["fitting long"] * (budget is not None) + ["steps binary"] * steps)
    out = plain.mapInArrow(run, schema)
    found = out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_chars", "n_tokens", *(["steps"] if steps else []), *(["fitting"] if budget is not None else []))
    if budget is None:
        return found
    return found.withColumn("over_limit", F.col("n_tokens") > budget).withColumnRenamed("fitting", "fitting_chars")


def _from_steps(counted: DataFrame, name: str, answer) -> DataFrame:
    """``counted`` with a long column, the answer to the steps of each row."""

    @F.pandas_udf("long")
    def found(steps, asked):
        return steps.combine(asked, lambda s, k: answer(np.frombuffer(s, "<i2"), k))

    return counted.withColumn(name, found(F.col("steps"), F.col(f"`{name}`")))


def within_budget(counted: DataFrame, budget: int) -> DataFrame:
    """``counted`` with over_limit and fitting_chars, the length of the longest prefix with at most ``budget`` tokens.

    A prefix can have fewer tokens than a shorter one; all are looked at.
    """
    asked = counted.withColumn("fitting_chars", F.lit(budget).cast("long"))
    return _from_steps(asked, "fitting_chars", fitting_chars).withColumn("over_limit", F.col("n_tokens") > budget)


def tokens_before(counted: DataFrame, chars: int) -> DataFrame:
    """``counted`` with prefix_tokens, the token count of the first ``chars`` characters."""
    asked = counted.withColumn("prefix_tokens", F.lit(chars).cast("long"))
    return _from_steps(asked, "prefix_tokens", lambda steps, k: int(steps[: max(0, k)].sum(dtype=np.int64)))


def truncated(docs: DataFrame, counted: DataFrame, budget: int, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with the texts cut to the longest prefix within ``budget``; ``key`` must be unique and not null."""
    limits = within_budget(counted, budget).select(F.col(f"`{key}`").alias("_key"), F.col("fitting_chars").alias("_fitting"))
    joined = docs.join(limits, F.col(f"`{key}`") == F.col("_key"))
    cut = F.substring(F.col(f"`{column}`"), F.lit(1), F.col("_fitting").cast("int"))
    return joined.withColumn(column, cut).drop("_key", "_fitting")
