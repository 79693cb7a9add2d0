"""Quality rules: counts per document, then hashed word and character n-gram logistic regression.

Method: words, word pairs and runs of two to four bytes are hashed into a fixed number of cells; a document is
the shares of its cells. The regression is fitted on a bounded sample of labelled rows (``PER_CLASS`` of each
label), its scores are turned into probabilities on a part of the sample it was not fitted on, and documents are
scored in Arrow batches against a fixed threshold.

Edge cases: null, empty and white-space texts have no words and fail the base rules; any length is read whole;
repeated rows give repeated results; without labels of both kinds the probability is 1 for all; an empty table gives an
empty result. Only key, text and label columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RollingHash, chunks, mix
from .labelled import Rows, calibrate, fit_logistic, sample_labels, sigmoid

#: Cells of each feature family, sampled labelled rows of each label, and the probability of being good from which a text is kept.
CELLS, PER_CLASS, THRESHOLD = 1 << 16, 1_000, 0.5
WINDOW = 5
SYMBOLS = b"#*$%&|<>"
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True
SCALE, PENALTY = 30.0, 1e-5


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more in the text, first occurrences included."""
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    if len(number) == len(ids):
        return 0
    key, room = ids[: len(ids) - window + 1], len(number)
    for k in range(1, window):  # exact: windows are renumbered before the next word would overflow
        if room * len(number) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            room = len(key)
        key, room = key * len(number) + ids[k : k + len(key)], room * len(number)
    order = np.argsort(key)
    equal = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), dtype=bool)
    again[order[1:][equal]] = again[order[:-1][equal]] = True
    if not again.any():
        return 0
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:-window][again] += 1  # window starts
    np.subtract.at(edge, np.flatnonzero(again) + window, 1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()  # bytes are split on the six ASCII white spaces only
    spaces = len(data) - len(data.translate(None, b" \t\n\v\f\r"))
    lines = Counter(x for x in data.split(b"\n") if x.strip())
    return len(words), len(text) - spaces, len(data) - len(data.translate(None, SYMBOLS)), sum(lines.values()) - len(lines), repeated_words(words)


def hashed(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each feature family (runs of 2, 3, 4 bytes, words, word pairs): the cells of all texts in turn, and how many each text has."""
    data = np.frombuffer(b"\n\n\n\n".join([*texts, b""]), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    start = np.concatenate([[0], np.cumsum(sizes + 4)[:-1]]) if len(sizes) else sizes
    out = []
    wide = data.astype(np.uint32)
    owner_ends = start + sizes
    for i, n in enumerate((2, 3, 4)):
        packed = wide[: len(wide) - n + 1].copy()
        for k in range(1, n):
            packed |= wide[k : len(wide) - n + 1 + k] << np.uint32(8 * k)
        cells = (packed * np.uint32(0x9E3779B1)) >> np.uint32(16)
        counts = np.maximum(sizes - n + 1, 0)
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        inside[start[counts > 0]] = 1
        inside[(start + counts)[counts > 0]] -= 1
        out.append((cells[np.cumsum(inside[: len(cells)], dtype=np.int8) > 0].astype(np.int64) + i * CELLS, counts))
    space = SPACES[data]
    first = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    last = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    owner = np.searchsorted(owner_ends, first, side="right")
    h = RollingHash(data).of(first, last)
    out.append(((h >> np.uint64(48)).astype(np.int64) + 3 * CELLS, np.bincount(owner, minlength=len(texts))))
    same = owner[1:] == owner[:-1]
    pairs = mix(h[:-1] * np.uint64(3) + h[1:])[same]
    out.append(((pairs >> np.uint64(48)).astype(np.int64) + 4 * CELLS, np.bincount(owner[1:][same], minlength=len(texts))))
    return out


WIDTH = 5 * CELLS


def shares(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Cells of one text and their shares within their family."""
    cells, values = [], []
    for found, counts in hashed([(text or "").encode()]):
        c, n = np.unique(found, return_counts=True)
        cells.append(c)
        values.append(n / max(int(counts[0]), 1))
    return np.concatenate(cells), np.concatenate(values)


@dataclass
class Model:
    weights: np.ndarray
    offset: float
    slope: float
    shift: float

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        z = np.full(len(texts), float(self.offset))
        for cells, counts in hashed(texts):
            total = np.concatenate([[0.0], np.cumsum(self.weights[cells], dtype=np.float64)])
            ends = np.cumsum(counts)
            z += (total[ends] - total[ends - counts]) / np.maximum(counts, 1)
        return sigmoid(self.slope * z + self.shift)


def fit(documents: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", per_class: int = PER_CLASS) -> Model | None:
    """The model, or None without labels of both kinds. At most 2 * ``per_class`` texts are read for it."""
    chosen, counts = sample_labels(labels, key, label, per_class)
    if not (counts[0] and counts[1]):
        return None
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")  # bounded by per_class

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shares(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(pa.string()), batch.column("label"), pa.array([c.astype(np.int32).tobytes() for c, _ in found], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in found], pa.binary())], names=["key", "label", "cells", "shares"])

    got = sorted(rows.mapInArrow(run, "key string, label int, cells binary, shares binary").collect(), key=lambda r: r["key"])
    if not got:
        return None
    y = np.array([r["label"] for r in got])
    held = np.zeros(len(y), dtype=bool)  # every fourth row of each label calibrates
    for k in (0, 1):
        held[np.flatnonzero(y == k)[3::4]] = True
    data = [(np.frombuffer(r["cells"], np.int32), np.frombuffer(r["shares"], np.float32) * SCALE) for r in got]
    pick = lambda keep: Rows([c for (c, _), k in zip(data, keep) if k], [v for (_, v), k in zip(data, keep) if k])
    weights, offset = fit_logistic(pick(~held), y[~held], WIDTH, PENALTY)
    slope, shift = calibrate(pick(held).dot(weights) + offset, y[held]) if held.any() else (1.0, 0.0)
    # the sample is balanced: back to the shares among all labelled rows
    sampled = np.bincount(y, minlength=2)
    shift += float(np.log((counts[1] / counts[0]) / (max(sampled[1], 1) / max(sampled[0], 1))))
    return Model((weights * SCALE).astype(np.float32), offset, slope, shift)


def quality_table(df: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """key, the five counts, probability of being good, base_failed and kept."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # fixed size: the number of cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for i, j in chunks(batch, "text", 1 << 21):
                part = batch.slice(i, j - i)
                texts = part.column("text").to_pylist()
                counts = np.array([base_counts(t) for t in texts], dtype=np.int64).reshape(len(texts), 5)
                good = known.probabilities([(t or "").encode() for t in texts]) if known else np.ones(len(texts))
                yield pa.RecordBatch.from_arrays([part.column("key"), *[pa.array(counts[:, k]) for k in range(5)], pa.array(good)], names=["key", *NAMES, "p_good"])

    schema = f"key {df.schema[key].dataType.simpleString()}, {', '.join(f'{n} bigint' for n in NAMES)}, p_good double"
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)).withColumnRenamed("key", key)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
