"""Texts into containers of fixed capacity, in space-filling-curve order.

One pass over the texts counts tokens and projects each text's hashed word
vector to three dimensions; only (id, tokens, three numbers) go on. Rows are
range-sorted by the Hilbert key of the three numbers, so neighbours share
vocabulary, and each range packs its neighbours as they come: best fit, largest
first, among as many as fill a few containers. ``report`` has the stretch of the
curve that a container's texts come from next to what chance would give.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codexmill.llm.tokens import VOCABULARY, WordCodes, encoder
from codexmill.session import materialize

HASH_DIMS = 1024
CURVE_BITS = 10
#: Containers' worth of neighbours along the curve that are fitted together: fewer lie closer, more leave less room.
WINDOW = 32
#: Texts in a range, which one task packs in order, a window at a time.
RANGE_TEXTS = 1_000_000


class _Hashed(WordCodes):
    """Token count and hash dimension in one number."""

    def code(self, word: str) -> int:
        return len(self.encode(word)) * HASH_DIMS + zlib.crc32(word.strip().lower().encode("utf-8", "replace")) % HASH_DIMS


def _projection() -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((HASH_DIMS, 3))


def measured(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, x, y, z) of (doc_id, text)."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, proj = _Hashed(encoder(vocabulary)), _projection()
        for b in batches:
            n = np.zeros(len(b), dtype=np.int64)
            v = np.zeros((len(b), 3))
            for i, text in enumerate(b["text"]):
                if not text:
                    continue
                words = codes.words(text)
                c = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
                n[i] = len(codes.encode(text)) if "  " in text or "\x00" in text else int((c // HASH_DIMS).sum())
                h = np.sqrt(np.bincount(c % HASH_DIMS, minlength=HASH_DIMS))
                v[i] = (h / np.sqrt((h * h).sum())) @ proj
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": n, "x": v[:, 0], "y": v[:, 1], "z": v[:, 2]})

    return docs.select("doc_id", "text").mapInPandas(measure, "doc_id bigint, n_tokens bigint, x double, y double, z double")


def hilbert(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer cells (rows x dimensions)."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the excess rotations from the top bit down
        p = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            flip = np.where(on, p, 0)
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= flip | swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def on_curve(m: DataFrame) -> DataFrame:
    """Add ``curve``: coordinates are centred and scaled by the corpus's own
    mean and deviation (six numbers), cut to three deviations, and quantised."""
    s = m.agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("m", F.avg), ("d", F.stddev_pop))]).collect()[0]
    at = {c: (s[f"m_{c}"] or 0.0, s[f"d_{c}"] or 1.0) for c in "xyz"}

    @F.pandas_udf("bigint")
    def key(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        top = (1 << CURVE_BITS) - 1
        cells = [np.clip(((v.to_numpy() - at[c][0]) / at[c][1] + 3) / 6 * top, 0, top).astype(np.int64) for c, v in zip("xyz", (x, y, z), strict=True)]
        return pd.Series(hilbert(np.stack(cells, axis=1)))

    return m.select("doc_id", "n_tokens", key("x", "y", "z").alias("curve"))


class Packer:
    """Texts in order into containers of one capacity.

    A window of ``window`` containers' worth is fitted at a time, best fit,
    largest first; containers stay open for the next window and are closed
    after it. What waits or is open is a window's worth, whatever comes.
    """

    def __init__(self, capacity: int, window: int = WINDOW) -> None:
        self.capacity, self.window = capacity, window * capacity
        self.n = 0
        self.room: dict[int, list[int]] = {}
        self.mask = 0
        self.closing = 0
        self.waiting: list[np.ndarray] = []
        self.tokens = 0

    def whole(self, count: int) -> np.ndarray:
        """Numbers of ``count`` containers that are full as they are."""
        self.n += count
        return np.arange(self.n - count, self.n)

    def add(self, sizes: np.ndarray) -> np.ndarray:
        """Container numbers of the items, in the order in which they were
        added, that this brings to a full window; the others wait."""
        self.waiting.append(sizes)
        self.tokens += int(sizes.sum())
        return self._fitted(np.concatenate(self.waiting), False) if self.tokens >= self.window else np.zeros(0, dtype=np.int64)

    def rest(self) -> np.ndarray:
        """Container numbers of all that still wait."""
        return self._fitted(np.concatenate([np.zeros(0, dtype=np.int64), *self.waiting]), True)

    def _fitted(self, sizes: np.ndarray, last: bool) -> np.ndarray:
        upto = np.cumsum(sizes)
        out, lo = [], 0
        while lo < len(sizes):
            done = int(upto[lo - 1]) if lo else 0
            hi = int(np.searchsorted(upto, done + self.window)) + 1
            if hi > len(sizes):
                if not last:
                    break
                hi = len(sizes)
            out.append(self._window(sizes[lo:hi]))
            lo = hi
        self.waiting = [sizes[lo:]]
        self.tokens = int(sizes[lo:].sum())
        return np.concatenate([np.zeros(0, dtype=np.int64), *out])

    def _window(self, sizes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(sizes), dtype=np.int64)
        opened, room = self.n, self.room
        for i in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[i])
            if size == 0:
                self.n = max(self.n, 1)
                out[i] = self.n - 1
                continue
            m = self.mask >> size
            if m:
                free = (m & -m).bit_length() - 1 + size
                at = room[free].pop()
                if not room[free]:
                    del room[free]
                    self.mask ^= 1 << free
            else:
                free, at = self.capacity, self.n
                self.n += 1
            out[i] = at
            left = free - size
            if left:
                room.setdefault(left, []).append(at)
                self.mask |= 1 << left
        for free in list(room):
            room[free] = [c for c in room[free] if c >= self.closing]
            if not room[free]:
                del room[free]
                self.mask &= ~(1 << free)
        self.closing = opened
        return out


def fit(sizes: np.ndarray, capacity: int, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """Container number of each item (none above capacity), and how many."""
    p = Packer(capacity, window)
    out = np.concatenate([p.add(np.asarray(sizes, dtype=np.int64)), p.rest()])
    return out, p.n


_PACKED = "container_kind string, container_id bigint, doc_id bigint, piece int, token_start bigint, n_tokens bigint"


class _Kind:
    """One kind of container along one range, and what waits for its number."""

    def __init__(self, kind: str, capacity: int, base: int) -> None:
        self.kind, self.capacity, self.base = kind, capacity, base
        self.packer = Packer(capacity)
        self.waiting = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("doc_id", "curve", "piece", "n_tokens")})

    def _rows(self, number: np.ndarray, x: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "container_kind": self.kind, "container_id": self.base + number, "doc_id": x["doc_id"].to_numpy(), "piece": x["piece"].to_numpy().astype(np.int32),
            "token_start": x["piece"].to_numpy() * self.capacity, "n_tokens": x["n_tokens"].to_numpy(), "curve": x["curve"].to_numpy(),
        })

    def add(self, b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        full, rest = np.divmod(b["n_tokens"].to_numpy(), self.capacity)
        if full.any():
            at = np.repeat(np.arange(len(b)), full)
            piece = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full)
            x = pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[at], "curve": b["curve"].to_numpy()[at], "piece": piece, "n_tokens": self.capacity})
            yield self._rows(self.packer.whole(len(at)), x)
        has = (rest > 0) | (full == 0)
        x = pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[has], "curve": b["curve"].to_numpy()[has], "piece": full[has], "n_tokens": rest[has]})
        self.waiting = pd.concat([self.waiting, x], ignore_index=True)
        yield self._out(self.packer.add(rest[has]))

    def _out(self, number: np.ndarray) -> pd.DataFrame:
        out = self._rows(number, self.waiting.iloc[: len(number)])
        self.waiting = self.waiting.iloc[len(number) :]
        return out

    def rest(self) -> pd.DataFrame:
        return self._out(self.packer.rest())


def placed(docs: DataFrame, capacities: dict[str, int], vocabulary: str = VOCABULARY) -> DataFrame:
    """``pack`` with each text's place on the ``curve``."""
    for kind, cap in capacities.items():
        if cap is None or cap < 1:
            raise ValueError(f"capacity of {kind!r} must be at least 1")
    m = materialize(measured(docs.where("doc_id IS NOT NULL"), vocabulary), "measured")
    ranges = max(1, -(-m.count() // RANGE_TEXTS))
    ranged = on_curve(m).repartitionByRange(ranges, "curve", "doc_id").sortWithinPartitions("curve", "doc_id")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 33
        kinds = [_Kind(kind, cap, base) for kind, cap in capacities.items()]
        for b in batches:
            for k in kinds:
                yield from k.add(b)
        for k in kinds:
            yield k.rest()

    return ranged.mapInPandas(fill, _PACKED + ", curve bigint")


def pack(docs: DataFrame, capacities: dict[str, int], vocabulary: str = VOCABULARY) -> DataFrame:
    """(container_kind, container_id, doc_id, piece, token_start, n_tokens).

    Every text is in one container of each kind; one longer than the capacity
    is cut into full containers and a rest that is packed like a text. Texts
    without tokens (NULL, empty) take no room and join a neighbour's
    container. Repeated doc_ids are packed as often as they occur, rows without
    one are left out. Ties on the curve are cut apart by doc_id, so copies of
    one text can't gather in one range. An empty table needs no containers.
    """
    return placed(docs, capacities, vocabulary).drop("curve")


def report(docs: DataFrame, capacities: dict[str, int], vocabulary: str = VOCABULARY) -> DataFrame:
    """A row a kind: containers, tokens, pieces, fullest, fill (share of the
    room that is used), curve_span (mean stretch of the curve, as a share of
    it, that the texts of a container with several come from) and random_span
    (what as many texts taken at random would cover)."""
    by = placed(docs, capacities, vocabulary).groupBy("container_kind", "container_id").agg(
        F.sum("n_tokens").alias("used"), F.count("*").alias("k"), (F.max("curve") - F.min("curve")).alias("span")
    )
    several = F.col("k") > 1
    by = by.groupBy("container_kind").agg(
        F.count("*").alias("containers"), F.sum("used").alias("tokens"), F.sum("k").alias("pieces"), F.max("used").alias("fullest"),
        F.avg(F.when(several, F.col("span") / float(1 << 3 * CURVE_BITS))).alias("curve_span"), F.avg(F.when(several, (F.col("k") - 1) / (F.col("k") + 1))).alias("random_span"),
    )
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in capacities.items() for x in kv]), F.col("container_kind")) if capacities else F.lit(None).cast("int")
    return by.withColumn("capacity_tokens", cap).withColumn("fill", F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")))
