"""Phrase collocations: phrases of two and three words that occur more often than their parts suggest, per language.

Method: elastic vertical partitioning of the word suffixes, after ERA (Mansour, Allam, Skiadopoulos and Kalnis, 2011).
Every word of a text begins a suffix, cut off after ``DEPTH`` words and at the end of its piece. One pass counts the words
of every language. Prefixes (first words) fall into ``SLOTS`` slots by hash; slots are packed into groups whose occurrences
stay within ``BUDGET``. A slot beyond it is divided by longer prefixes: a second pass counts its two-word
prefixes, and what is still too much goes to groups by all three words. A last pass sends every suffix, equal ones
of a batch as one, to its group; each group builds its depth-truncated suffix subtree by itself, as the sorted array of
its suffixes: leaf totals are the counts of equal suffixes, and an inner node's count is the sum of the leaves below.
Slots with fewer occurrences than a candidate needs hold no candidate and are not sent.

Only the slot totals (at most ``SLOTS`` numbers) reach the driver and are shared with the tasks. The work of a group is bounded
by the budget: a very common word is spread over the groups of its two- and three-word prefixes, and a very common phrase
is one suffix with a count.

Scores are exact: floor(10**6 * a * a / (l * r)) in decimals of 38 digits.

Edge cases: null and empty texts have no words; a null language is ``und``; repeated rows count each; texts of any length
are read whole; languages without candidates give no rows; an empty table gives an empty result. Only the text and
language columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import RollingHash, chunks, keep, mix

#: Words of the longest phrase, occurrences of a candidate, percent of a longer phrase that absorbs it, phrases of each language.
DEPTH, LEAST, INSIDE, TOP = 3, 10, 50, 2_000
#: Slots of prefixes, and suffixes of a group.
SLOTS, BUDGET = 1 << 20, 1 << 21
#: Marks in the table from slots to groups: too few to hold a candidate; too many, divided by longer prefixes.
RARE, HEAVY = -1, -2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.isin(np.arange(256), list(b".,;:!?\n\v\f\r"))
_SPACE = np.isin(np.arange(256), list(b" \t"))


class Words:
    """The words of some texts: ``entry`` numbers distinct (language, word) pairs, ``piece`` the pieces they lie in."""

    def __init__(self, texts: list[str], langs: list[str]):
        parts = [t.encode() + b"\n" for t in texts]
        data = _LOWER[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        apart = _BREAK[data]
        gap = apart | _SPACE[data]
        edge = np.flatnonzero(np.diff(gap.astype(np.int8), prepend=np.int8(1), append=np.int8(1)))
        first, last = edge[0::2], edge[1::2]
        self.piece = np.cumsum(apart, dtype=np.int64)[first] if len(first) else first
        offsets = np.concatenate([[0], np.cumsum(last - first)]).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[~gap])]).dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        width = max(len(coded.dictionary), 1)
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        ends = np.cumsum([len(p) for p in parts])
        spoken = np.array([number[x] for x in langs], dtype=np.int64)[np.searchsorted(ends, first, side="right")] if len(first) else first
        both, self.entry, self.count = np.unique(spoken * width + code, return_inverse=True, return_counts=True)
        self.lang = both // width
        self.words = coded.dictionary.take(pa.array(both % width))
        values = np.frombuffer(self.words.buffers()[2] or b"", dtype=np.uint8)[: np.frombuffer(self.words.buffers()[1], np.int32)[len(self.words)]]
        at = np.frombuffer(self.words.buffers()[1], np.int32)[: len(self.words) + 1].astype(np.int64)
        named = np.frombuffer("\n".join([*self.langs, ""]).encode(), dtype=np.uint8)
        stops = np.cumsum([len(x.encode()) + 1 for x in self.langs])
        salt = RollingHash(named).of(np.concatenate([[0], stops[:-1]]).astype(np.int64), stops.astype(np.int64)) if self.langs else np.zeros(0, np.uint64)
        self.hash = mix(RollingHash(values).of(at[:-1], at[1:]) * np.uint64(3) + salt[self.lang])

    def after(self, k: int) -> np.ndarray:
        """Entry of the word ``k`` places on in the same piece, or -1."""
        out = np.full(len(self.entry), -1, dtype=np.int64)
        if len(out) > k:
            same = self.piece[:-k] == self.piece[k:]
            out[:-k][same] = self.entry[k:][same]
        return out


def _parts(df: DataFrame, text: str, lang: str) -> DataFrame:
    return df.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for i, j in chunks(batch, "text"):
            part = batch.slice(i, j - i)
            yield Words(part.column("text").to_pylist(), part.column("lang").to_pylist())


def word_counts(df: DataFrame, text: str = "text", lang: str = "lang", slots: int = SLOTS) -> DataFrame:
    """lang, word, slot, n of every word of a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in _texts(batches):
            names = pa.array(w.langs, pa.string()).take(pa.array(w.lang))
            slot = (w.hash % np.uint64(slots)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([names, w.words.cast(pa.string()), pa.array(slot), pa.array(w.count)], names=["lang", "word", "slot", "n"])

    counted = _parts(df, text, lang).mapInArrow(run, "lang string, word string, slot int, n long")
    return counted.groupBy("lang", "word", "slot").agg(F.sum("n").alias("n"))


def pack(totals: np.ndarray, least: int, budget: int, start: int = 0) -> tuple[np.ndarray, int]:
    """Group of every slot (or RARE, HEAVY), numbered from ``start``, and the next number; a group has ``budget`` occurrences at most."""
    half = max(budget // 2, 1)
    light = (totals >= least) & (totals <= half)
    group = np.where(totals < least, RARE, HEAVY).astype(np.int32)
    running = np.cumsum(np.where(light, totals, 0))
    group[light] = start + ((running - totals)[light] // half).astype(np.int32)
    return group, int(group.max(initial=start - 1)) + 1


def _totals(rows: DataFrame, slots: int) -> np.ndarray:
    found = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most ``slots`` rows
    out = np.zeros(slots, np.int64)
    out[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return out


def _pair_slot(w: Words, one: np.ndarray, two: np.ndarray, slots: int) -> np.ndarray:
    return (mix(w.hash[one] * np.uint64(5) + w.hash[two]) % np.uint64(slots)).astype(np.int64)


def _prefix_counts(rows: DataFrame, groups, slots: int) -> DataFrame:
    """slot, n of the two-word prefixes whose first word lies in a heavy slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for w in _texts(batches):
            of = groups.value[(w.hash % np.uint64(slots)).astype(np.int64)] if len(w.hash) else np.zeros(0, np.int32)
            two = w.after(1)
            go = (two >= 0) & (of[w.entry] == HEAVY)
            go[go] = of[two[go]] != RARE
            total += np.bincount(_pair_slot(w, w.entry[go], two[go], slots), minlength=slots)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["slot", "n"])

    return rows.mapInArrow(run, "slot int, n long")


def _suffixes(w: Words, one: np.ndarray, two: np.ndarray, spread: int, slots: int, start: int) -> Iterator[tuple]:
    """(group, languages, words, suffixes with their counts) of every group that some texts have suffixes for."""
    if not len(w.hash):
        return
    of = one[(w.hash % np.uint64(slots)).astype(np.int64)]
    b, c = w.after(1), w.after(2)
    go = (b >= 0) & (of[w.entry] != RARE)
    go[go] = of[b[go]] != RARE
    a, b, c = w.entry[go], b[go], c[go]
    c = np.where((c >= 0) & (of[c] != RARE), c, -1)
    # equal suffixes become one, with a count
    width = np.int64(len(w.hash) + 1)
    pair, at = np.unique(a * width + b, return_inverse=True)
    leaf, n = np.unique(at * width + c + 1, return_counts=True)
    pair, c = pair[leaf // width], leaf % width - 1
    a, b = pair // width, pair % width
    group = of[a].astype(np.int64)
    heavy = np.flatnonzero(group == HEAVY)
    if len(heavy):
        group[heavy] = two[_pair_slot(w, a[heavy], b[heavy], slots)]
        heavy = np.flatnonzero(group == HEAVY)
        third = np.where(c[heavy] >= 0, w.hash[c[heavy]], np.uint64(0))
        group[heavy] = start + (mix(mix(w.hash[a[heavy]] * np.uint64(5) + w.hash[b[heavy]]) * np.uint64(7) + third) % np.uint64(max(spread, 1))).astype(np.int64)
    order = np.argsort(group, kind="stable")
    order = order[group[order] >= 0]
    bounds = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
    for i, j in zip(bounds[:-1], bounds[1:]):
        rows = order[i:j]
        used = np.zeros(len(w.hash) + 1, dtype=bool)
        for x in (a, b, c):
            used[x[rows]] = True
        used[-1] = False
        ids = np.flatnonzero(used)
        local = np.full(len(used), -1, dtype=np.int32)
        local[ids] = np.arange(len(ids))
        cells = np.stack([w.lang[a[rows]].astype(np.int32), local[a[rows]], local[b[rows]], local[c[rows]], n[rows].astype(np.int32)])
        yield int(group[rows[0]]), w.langs, b" ".join(w.words.take(pa.array(ids)).to_pylist()), cells


def _subtree(groups: list[tuple], least: int, partial: bool) -> pa.Table:
    """Nodes of two and three words of one group's suffixes: lang, w1, w2, w3 (null in nodes of two words), n.

    Nodes with fewer than ``least`` occurrences are left out; where the group holds only part of the suffixes below a
    node of two words (``partial``), all of those are given.
    """
    names: dict[str, int] = {}
    words, sizes = [], []
    parts = []
    for langs, said, cells in groups:
        spoken = np.array([names.setdefault(x, len(names)) for x in langs], dtype=np.int64)
        words.append(pa.array(said.split(b" "), pa.binary()))
        parts.append((spoken[cells[0]], cells[1:].astype(np.int64)))
        sizes.append(len(words[-1]))
    coded = pa.chunked_array(words, pa.binary()).combine_chunks().dictionary_encode()
    coded = coded if isinstance(coded, pa.DictionaryArray) else coded.combine_chunks()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum([0, *sizes[:-1]])
    lang = np.concatenate([p[0] for p in parts])
    a = np.concatenate([code[p[1][0] + s] for p, s in zip(parts, starts)])
    b = np.concatenate([code[p[1][1] + s] for p, s in zip(parts, starts)])
    c = np.concatenate([np.where(p[1][2] >= 0, code[p[1][2] + s], -1) for p, s in zip(parts, starts)])
    n = np.concatenate([p[1][3] for p in parts])
    order = np.lexsort((c, b, a, lang))
    lang, a, b, c, n = lang[order], a[order], b[order], c[order], n[order]
    upper = np.append(True, (lang[1:] != lang[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    leaf = np.flatnonzero(upper | np.append(True, c[1:] != c[:-1]))
    inner = np.flatnonzero(upper)
    leaf_n, inner_n = np.add.reduceat(n, leaf), np.add.reduceat(n, inner)
    leaf_go = (leaf_n >= least) & (c[leaf] >= 0)
    inner_go = (inner_n >= least) | partial
    at = np.concatenate([inner[inner_go], leaf[leaf_go]])
    third = np.concatenate([np.full(inner_go.sum(), -1), c[leaf[leaf_go]]])
    count = np.concatenate([inner_n[inner_go], leaf_n[leaf_go]])
    said = coded.dictionary.cast(pa.string())
    return pa.table([
        pa.array(list(names), pa.string()).take(pa.array(lang[at])), said.take(pa.array(a[at])), said.take(pa.array(b[at])),
        said.take(pa.array(np.where(third >= 0, third, 0), mask=third < 0)), pa.array(count),
    ], names=["lang", "w1", "w2", "w3", "n"])


def phrase_counts(df: DataFrame, counts: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, slots: int = SLOTS, budget: int = BUDGET) -> DataFrame:
    """lang, w1, w2, w3 (null for two words), n of all phrases with ``least`` occurrences; ``counts`` are the ``word_counts``."""
    context = df.sparkSession.sparkContext
    rows = _parts(df, text, lang)
    one, start = pack(_totals(counts, slots), least, budget)
    two, third, spread = np.zeros(1, np.int32), start, 0
    shared = context.broadcast(one)  # one number for each slot
    if (one == HEAVY).any():
        totals = _totals(_prefix_counts(rows, shared, slots), slots)
        two, third = pack(totals, least, budget, start)
        spread = -(-int(totals[two == HEAVY].sum()) // max(budget // 2, 1))
    longer = context.broadcast(two)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for w in _texts(batches):
            for group, langs, said, cells in _suffixes(w, shared.value, longer.value, spread, slots, third):
                cells = np.ascontiguousarray(cells)
                packed = codec.compress(said, asbytes=True), codec.compress(cells.tobytes(), asbytes=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array([group], pa.int32()), pa.array([langs], pa.list_(pa.string())), pa.array([len(said)]), pa.array([packed[0]], pa.binary()),
                    pa.array([cells.shape[1]]), pa.array([packed[1]], pa.binary()),
                ], names=["grp", "langs", "n_bytes", "said", "n_rows", "cells"])

    def build(table: pa.Table) -> pa.Table:
        codec = pa.Codec("zstd")
        groups = []
        for r in table.to_pylist():
            said = codec.decompress(r["said"], r["n_bytes"], asbytes=True)
            cells = np.frombuffer(codec.decompress(r["cells"], 20 * r["n_rows"], asbytes=True), np.int32).reshape(5, r["n_rows"])
            groups.append((r["langs"], said, cells))
        return _subtree(groups, least, table.column("grp")[0].as_py() >= third)

    sent = rows.mapInArrow(send, "grp int, langs array<string>, n_bytes long, said binary, n_rows long, cells binary")
    nodes = sent.groupBy("grp").applyInArrow(build, "lang string, w1 string, w2 string, w3 string, n long")
    return nodes.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, inside: int = INSIDE, top: int = TOP, slots: int = SLOTS, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language by score, frequency and bytes."""
    counts = keep(word_counts(df, text, lang, slots), "words")
    phrases = keep(phrase_counts(df, counts, text, lang, least, slots, budget), "phrases")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    known = counts.where(F.col("n") >= least).select("lang", "word", "n")
    single = lambda w, n: known.select("lang", F.col("word").alias(w), F.col("n").alias(n))
    pairs = phrases.where("w3 is null").select("lang", "w1", "w2", F.col("n").alias("a"))
    triples = phrases.where("w3 is not null").select("lang", "w1", "w2", "w3", F.col("n").alias("a"))
    # a pair goes where a longer phrase that holds it keeps enough of its occurrences
    around = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
    around = around.groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    short = pairs.join(around, ["lang", "w1", "w2"], "left").where(f"longer is null or 100 * longer < {inside} * a")
    short = short.join(single("w1", "l"), ["lang", "w1"]).join(single("w2", "r"), ["lang", "w2"])
    short = short.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.array(F.struct("l", "r")).alias("cuts"))
    pair = lambda one, two, n: pairs.select("lang", F.col("w1").alias(one), F.col("w2").alias(two), F.col("a").alias(n))
    long = triples.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
    long = long.join(single("w1", "l1"), ["lang", "w1"]).join(single("w3", "r2"), ["lang", "w3"])
    cuts = F.array(F.struct(F.col("l1").alias("l"), F.col("r1").alias("r")), F.struct(F.col("l2").alias("l"), F.col("r2").alias("r")))
    long = long.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", cuts.alias("cuts"))
    scored = F.expr("array_min(transform(cuts, (c, k) -> struct((cast(1000000 as decimal(7,0)) * a * a) div (cast(c.l as decimal(19,0)) * c.r) as score, k, c.l as l, c.r as r)))")
    best = short.unionByName(long).select("lang", "phrase", "a", scored.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
