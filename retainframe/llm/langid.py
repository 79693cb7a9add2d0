"""Language identification with hyperdimensional profiles.

Method: every letter (and the space) has a random vector of ``WIDTH`` signs, drawn by hash from its code point. A run of
three symbols is bound into one vector: the product of its letters' vectors, each rotated by its place. A text is the
bundle (sum) of the vectors of its runs; a language's prototype is the bundle of its learned texts, each scaled to length one. A
text takes the language whose prototype has the greatest cosine with it, both taken from the mean of all prototypes,
which carries what the languages share.

Texts are lower-cased; what is not a letter parts words, and a run of it is one space; texts begin and end with a space, so one letter
is enough for a run. Learning covers every labelled text: tasks add up whole numbers, so the sums do not depend on
the order of rows. The model is two vectors of ``WIDTH`` numbers per language, ``LANGUAGES`` at most.

Edge cases: null and empty texts and texts without a letter are ``und`` with score 0, and so is every text where
nothing was learned; texts of any length are read whole; ties go to the smaller language in byte order; repeated rows are learned
each; an empty table gives an empty result. Only key, text and language columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, mix

#: Signs of a vector, symbols of a run, texts of a block and runs of a matrix product, parts of a unit length, languages of a model.
WIDTH, RUN, TEXTS, RUNS, SCALE, LANGUAGES = 1_024, 3, 256, 4_096, 1 << 20, 16_384
UNKNOWN = "und"


def symbol_vectors(points: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A row of ``width`` signs for every code point."""
    cells = points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(-(-width // 64), dtype=np.uint64)[None, :]
    bits = np.unpackbits(mix(mix(cells) + np.uint64(width)).view(np.uint8), axis=1)[:, :width]
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of distinct runs of ``RUN`` symbols (rows), and (text, run) of every place in the texts."""
    parts = [np.frombuffer(f"\n{(t or '').lower()}\n".encode("utf-32-le"), dtype=np.uint32) for t in texts]
    points = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    known, code = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in known.tolist()], dtype=bool)[code] if len(known) else np.zeros(0, bool)
    opens = np.append(True, owner[1:] != owner[:-1]) if len(owner) else np.zeros(0, bool)
    held = letter | opens | np.append(False, letter[:-1]) if len(letter) else letter
    symbols, owner = np.where(letter, points, 32)[held], owner[held]
    known, code = np.unique(symbols, return_inverse=True)
    if len(code) < RUN:
        return np.zeros((0, RUN), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = code[: len(code) - RUN + 1].astype(np.int64)
    for k in range(1, RUN):  # fewer than 2**21 code points exist
        key = key * len(known) + code[k : len(code) - RUN + 1 + k]
    inside = owner[: len(owner) - RUN + 1] == owner[RUN - 1 :]
    found, which = np.unique(key[inside], return_inverse=True)
    places = np.stack([known[found // len(known) ** (RUN - 1 - k) % len(known)] for k in range(RUN)], axis=1)
    return places, owner[: len(owner) - RUN + 1][inside], which


def bundles(texts: list[str | None], width: int = WIDTH) -> np.ndarray:
    """The whole-number vector of every text; zero without a letter."""
    places, owner, which = runs(texts)
    out = np.zeros((len(texts), width), dtype=np.float64)
    if not len(places):
        return out
    known, code = np.unique(places, return_inverse=True)
    code = code.reshape(places.shape)
    rotated = [np.roll(symbol_vectors(known, width), RUN - 1 - k, axis=1) for k in range(RUN)]
    cells, n = np.unique(which * len(texts) + owner, return_counts=True)  # by run, so that a block of runs is a slice
    which, owner = cells // len(texts), cells % len(texts)
    for start in range(0, len(places), RUNS):
        stop = min(start + RUNS, len(places))
        bound = rotated[0][code[start:stop, 0]]
        for k in range(1, RUN):
            bound = bound * rotated[k][code[start:stop, k]]
        i, j = np.searchsorted(which, [start, stop])
        counts = np.zeros((len(texts), stop - start), dtype=np.float32)
        counts[owner[i:j], which[i:j] - start] = n[i:j]
        out += counts @ bound.astype(np.float32)
    return out


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i, j in chunks(batch, "text", 1 << 20):
        for k in range(i, j, TEXTS):
            yield batch.slice(k, min(TEXTS, j - k))


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


@dataclass
class Model:
    langs: list[str]
    mean: np.ndarray
    away: np.ndarray  # unit length, one row per language

    def predict(self, texts: list[str | None], width: int) -> tuple[list[str], np.ndarray]:
        x = bundles(texts, width)
        said = x.any(axis=1)
        near = np.round(_unit(_unit(x) - self.mean) @ self.away.T, 9) if self.langs else np.zeros((len(texts), 0))
        if not near.shape[1]:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = near.argmax(axis=1)
        names = [self.langs[b] if s else UNKNOWN for b, s in zip(best, said)]
        return names, np.where(said, np.clip((1 + near[np.arange(len(best)), best]) / 2, 0, 1), 0.0)


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", width: int = WIDTH) -> Model:
    """Prototypes of the languages of all rows that have one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def give() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))], names=["lang", "v"])

        for batch in batches:
            for part in _blocks(batch):
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                whole = np.rint(_unit(bundles(part.column("text").to_pylist(), width)) * SCALE).astype(np.int64)
                for one in set(langs):
                    sums[one] = sums.get(one, 0) + whole[langs == one].sum(axis=0)
            if len(sums) > 1_000:
                yield give()
                sums.clear()
        if sums:
            yield give()

    rows = documents.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    cells = rows.mapInArrow(run, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
    cells = cells.groupBy("lang", "i").agg(F.sum("x").alias("x"))
    per_lang = cells.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda c: c["x"]).alias("v"))  # ``width`` cells each
    found = sorted(per_lang.limit(LANGUAGES + 1).collect(), key=lambda r: r["lang"].encode())
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    sums = np.array([r["v"] for r in found], dtype=np.float64).reshape(len(found), width)
    sums = sums[(learned := sums.any(axis=1))]
    langs = [r["lang"] for r, ok in zip(found, learned) if ok]
    prototypes = _unit(sums)
    mean = prototypes.mean(axis=0) if len(langs) > 1 else np.zeros(width)
    return Model(langs, mean, _unit(prototypes - mean))


def predict(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """key, lang_pred, score of every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # at most LANGUAGES rows of ``width`` numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                names, scores = shared.value.predict(part.column("text").to_pylist(), width)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(names, pa.string()), pa.array(scores)], names=["key", "lang_pred", "score"])

    schema = f"key {df.schema[key].dataType.simpleString()}, lang_pred string, score double"
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("key", key)
