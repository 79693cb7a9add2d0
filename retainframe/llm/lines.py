"""Fuzzy line deduplication: MinHash bands, exact Jaccard verification, union-find, one line kept per component.

Method: a line's character shingles are hashed under ``BANDS * ROWS`` permutations; lines that agree in a band are
candidates (a pair at the threshold is found with probability 0.998, more alike ones more often). Candidates are
verified by the exact Jaccard similarity of their shingle sets, links are joined to components, and of all
occurrences of a component's lines the first (smallest key, then place) stays.

Equal lines are one node throughout. Members of a band's group are paired out up to ``PAIRED``; in a larger group
all are compared with one member, the pivot. If they are then in one component, they need no more; else groups of the same main
component are joined (``around``) and the others are compared with its most linked member, their new pivot. One still apart
is within the threshold of another member only if both differ from the pivot in the same shingles, rare ones among them
(``differing_rows``): it is compared with those that do. So no link between components is lost, and what all variants share pairs nothing.

Documents are packed into blocks that are written once; only hashes, and the texts of candidate lines, are shuffled
line by line. Hashes of lines are 64 bits wide; lines of which a second hash tells that they share the first
by chance are left alone.

Edge cases: null texts stay null, empty ones empty; blank lines are left alone; lines shorter than a shingle (white space
around not counted) are like equal ones only; a line of any length is read whole; a null key ranks after all others and ties
are broken by place, so repeated rows lose their lines to the first of them; an empty table gives an empty
result. All columns pass through; only the text column changes, and added columns take free names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE, Scratch, chunks, free_name, keep, mix
from .components import components

SHINGLE, THRESHOLD, BANDS, ROWS = 10, 0.8, 12, 4
#: Members of a group that are paired out, bytes of a block, of a hash bucket and of lines that are hashed at once.
PAIRED, BLOCK_BYTES, BUCKET_BYTES, PART_BYTES = 8, 2 << 20, 32 << 20, 1 << 20
#: Pairs that are compared in one sort, and bits of the number of one of their lines.
PAIRS, PAIR_BITS = 1 << 11, 12
#: Counters for the frequency of shingles (4 MB, shared with the tasks), whatever the corpus.
SLOTS = 1 << 20
#: Bits of a difference that are looked up to tell whether another line can meet there (three maps of 2 MB, shared with the tasks), and parts a map is made in.
MAP_BITS, MAP_PARTS = 24, 64
#: Characters of lines that are hashed at once.
CACHE_CHARS = 1 << 18
_SPACE = " \t\n\v\f\r"
LAST = np.iinfo(np.int64).max


def line_hash(line: str) -> tuple[int, int]:
    """Two hashes of a line, as signed and unsigned 64-bit numbers."""
    both = xxhash.xxh3_128_intdigest(line.encode())
    return (both >> 64) - (1 << 64 if both >> 127 else 0), both & (1 << 64) - 1


def lines_of(text: str | None) -> list[str]:
    """Lines as they are compared; one that is left alone is empty."""
    return [x.strip(_SPACE) for x in text.split("\n")] if text else []


def shingles(line: str, size: int = SHINGLE) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def jaccard(a: str, b: str, size: int = SHINGLE) -> float:
    return similarity(shingles(a, size), shingles(b, size))


def similarity(x: set[str], y: set[str]) -> float:
    both = len(x & y)
    return both / (len(x) + len(y) - both)


_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))
_FACTORS, _FLIPS = (_SEEDS[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (_SEEDS[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32)


def _windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` codes: runs are doubled, or lengthened by one, along the binary digits of ``size``."""
    one = codes.astype(np.uint64) + np.uint64(1)
    out, have = one, 1
    for digit in f"{size:b}"[1:]:
        out, have = out[: len(out) - have] + out[have:] * np.uint64(pow(BASE, have, 1 << 64)), 2 * have
        if digit == "1":
            out, have = out[: len(one) - have] + one[have:] * np.uint64(pow(BASE, have, 1 << 64)), have + 1
    return mix(out)


def _shingle_hashes(lines: list[str], size: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of all lines (of ``size`` characters or more) in turn."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(x) for x in lines])
    inside = np.ones(len(codes), dtype=bool)
    for k in range(1, size):  # no shingle starts so near to the end of its line
        inside[ends - k] = False
    return _windows(codes, size)[inside[: len(codes) - size + 1]]


def bands(lines: list[str], size: int = SHINGLE) -> np.ndarray:
    """Band keys of lines of ``size`` characters or more, one row per line; hashed by parts that stay in the processor's cache."""
    part = np.cumsum([len(x) for x in lines]) // CACHE_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(lines)]
    return np.concatenate([np.empty((0, BANDS), dtype=np.uint64), *(_bands(lines[i:j], size) for i, j in zip(cuts, cuts[1:]) if i < j)])


def _bands(lines: list[str], size: int) -> np.ndarray:
    x = (_shingle_hashes(lines, size) >> np.uint64(32)).astype(np.uint32)
    count = np.array([len(x) for x in lines]) - size + 1
    first, work = np.cumsum(count) - count, np.empty_like(x)
    least = np.empty((BANDS * ROWS, len(lines)), dtype=np.uint64)
    for k in range(BANDS * ROWS):
        np.bitwise_xor(x, _FLIPS[k], out=work)
        np.multiply(work, _FACTORS[k], out=work)
        least[k] = np.minimum.reduceat(work, first)
    out = np.empty((len(lines), BANDS), dtype=np.uint64)
    for b in range(BANDS):
        key = np.full(len(lines), b + 1, dtype=np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least[k])
        out[:, b] = key
    return out


# --- blocks --------------------------------------------------------------------------------------------------


def make_blocks(df: DataFrame, text: str) -> DataFrame:
    """(block, body): rows of about BLOCK_BYTES of text, all columns, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pack, task, made = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j in chunks(batch, text, BLOCK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema) as out:
                    out.write_batch(batch.slice(i, j - i))
                yield pa.RecordBatch.from_arrays([pa.array([f"{task}-{made}"]), pa.array([pack(sink.getvalue())], pa.binary())], names=["block", "body"])
                made += 1

    return keep(df.mapInArrow(run, "block string, body binary"), "blocks")


def _open(batch: pa.RecordBatch) -> Iterator[tuple[int, str, pa.RecordBatch]]:
    for i in range(batch.num_rows):
        body = zstandard.decompress(batch.column("body")[i].as_py())
        for rows in pa.ipc.open_stream(body):
            yield i, batch.column("block")[i].as_py(), rows


def _distinct(rows: pa.RecordBatch, text: str) -> dict[str, tuple[int, int]]:
    """Distinct lines of a block with the row and line number of their first occurrence; rows are in the order of their key."""
    found: dict[str, tuple[int, int]] = {}
    for i, t in enumerate(rows.column(text)):
        for n, line in enumerate(lines_of(t.as_py())):
            if line and line not in found:
                found[line] = (i, n)
    return found


# --- candidates ----------------------------------------------------------------------------------------------


def _buckets(blocks: DataFrame) -> int:
    size = blocks.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    return max(1, -(-size * 3 // BUCKET_BYTES))


def candidates(blocks: DataFrame, text: str, buckets: int) -> DataFrame:
    """(kind, x, y, block): pairs of lines to verify (0), members of large groups (1: band, line), and where a line's text is (2)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for _, name, rows in _open(batch):
                lines = [x for x in _distinct(rows, text) if len(x) >= SHINGLE]
                if not lines:
                    continue
                h = np.array([line_hash(x)[0] for x in lines], dtype=np.int64)
                key, line = bands(lines).ravel(), np.repeat(h, BANDS)
                bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
                yield pa.RecordBatch.from_arrays([pa.array([int(bucket[p[0]]) for p in parts], pa.int32()), pa.array([name] * len(parts)), pa.array([pack(key[p].tobytes() + line[p].tobytes()) for p in parts], pa.binary())], names=["bucket", "block", "body"])

    def find(table: pa.Table) -> pa.Table:
        keys, lines, owner = [], [], []
        for i, body in enumerate(table.column("body")):
            raw = zstandard.decompress(body.as_py())
            n = len(raw) // 16
            keys.append(np.frombuffer(raw, "<u8", n))
            lines.append(np.frombuffer(raw, "<i8", n, 8 * n))
            owner.append(np.full(n, i, dtype=np.int32))
        k, h, owner = map(np.concatenate, (keys, lines, owner))
        order = np.lexsort((h, k))
        k, h, owner = k[order], h[order], owner[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (h[1:] != h[:-1])])  # a line once per group
        k, h, owner = k[new], h[new], owner[new]
        head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        sizes = np.diff(np.append(head, len(k)))
        a, b = [], []
        for size in range(2, PAIRED + 1):
            at = head[sizes == size]
            i, j = np.triu_indices(size, 1)
            a.append(h[at[:, None] + i].ravel())
            b.append(h[at[:, None] + j].ravel())
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        large = np.repeat(sizes > PAIRED, sizes)
        several = np.repeat(sizes > 1, sizes)
        line, one = np.unique(h[several], return_index=True)
        names = table.column("block").to_numpy(zero_copy_only=False)
        place = names[owner[several][one]] if len(line) else np.empty(0, object)
        kind = np.concatenate([np.zeros(len(a)), np.ones(large.sum()), np.full(len(line), 2)]).astype(np.int32)
        x = np.concatenate([a, k[large].view(np.int64), line])
        y = np.concatenate([b, h[large], line])
        block = [None] * (len(kind) - len(line)) + list(place)
        return pa.table({"kind": pa.array(kind), "x": pa.array(x), "y": pa.array(y), "block": pa.array(block, pa.string())})

    sent = blocks.mapInArrow(send, "bucket int, block string, body binary")
    return keep(sent.groupBy("bucket").applyInArrow(find, "kind int, x bigint, y bigint, block string"), "candidates")


def texts(blocks: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(h, line): the texts of the lines in ``wanted`` (block, h)."""
    listed = keep(wanted.groupBy("block").agg(F.collect_list("h").alias("lines")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, rows in _open(batch):
                lines = set(batch.column("lines")[i].as_py())
                found = [(h, x) for x in _distinct(rows, text) if (h := line_hash(x)[0]) in lines]
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()), pa.array([x for _, x in found], pa.string())], names=["h", "line"])

    return keep(blocks.join(listed, "block").mapInArrow(run, "h bigint, line string"), "line-texts")


def similarities(x: list[str], y: list[str]) -> np.ndarray:
    """Exact Jaccard similarity of the shingle sets of x[i] and y[i], lines of SHINGLE characters or more.

    Sets are made by one sort of (line, part of the hash) and merged by one of (pair, part of the hash). Only what falls within two
    shingles of the threshold could change by a chance match, and is compared as text.
    """
    out = np.empty(len(x))
    for i in range(0, len(x), PAIRS):
        left, right = x[i : i + PAIRS], y[i : i + PAIRS]
        known = {line: k for k, line in enumerate(dict.fromkeys([*left, *right]))}
        owner, h = _parts(list(known))
        size = np.bincount(owner, minlength=len(known))
        start, at = np.cumsum(size) - size, np.array([[known[line] for line in side] for side in (left, right)])
        n, pairs = size[at], len(left)
        flat = n.ravel()
        place = np.arange(flat.sum()) - np.repeat(np.cumsum(flat) - flat - start[at].ravel(), flat)
        key = np.repeat(np.tile(np.arange(pairs, dtype=np.uint64), 2), flat) << np.uint64(64 - PAIR_BITS) | h[place]
        key.sort()
        both = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(64 - PAIR_BITS)).astype(np.int64), minlength=pairs)
        out[i : i + pairs] = both / (n.sum(axis=0) - both)
        for k in np.flatnonzero(np.abs(both - n.sum(axis=0) * (THRESHOLD / (1 + THRESHOLD))) <= 2):
            out[i + k] = jaccard(left[k], right[k])
    return out


def _parts(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line number, leading 64 - PAIR_BITS bits of the hash) of the distinct shingles of up to 2 * PAIRS lines, ordered by both."""
    count = np.array([len(v) for v in lines]) - SHINGLE + 1
    key = np.repeat(np.arange(len(lines), dtype=np.uint64), count) << np.uint64(64 - PAIR_BITS) | _shingle_hashes(lines) >> np.uint64(PAIR_BITS)
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return (key >> np.uint64(64 - PAIR_BITS)).astype(np.int64), key & np.uint64((1 << 64 - PAIR_BITS) - 1)


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs (a, b) with their exact Jaccard similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [similarities(batch.column("x").slice(i, j - i).to_pylist(), batch.column("y").slice(i, j - i).to_pylist()) for i, j in chunks(batch, "y", PART_BYTES)]
            found = np.concatenate([np.empty(0), *found])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    both = pairs.join(lines.select(F.col("h").alias("a"), F.col("line").alias("x")), "a").join(lines.select(F.col("h").alias("b"), F.col("line").alias("y")), "b")
    return keep(both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint, similarity double"), "verified")


def _distinct_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line number, hash) of each line's distinct shingles, ordered by both."""
    x = _shingle_hashes(lines)
    owner = np.repeat(np.arange(len(lines)), np.array([len(v) for v in lines]) - SHINGLE + 1)
    order = np.lexsort((x, owner))
    x, owner = x[order], owner[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])])
    return owner[new], x[new]


def _slot(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(32)) * np.uint64(SLOTS) >> np.uint64(32)).astype(np.int64)


def slot_counts(df: DataFrame, column: str, hashes: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """How many of the ``hashes`` made of ``column`` fall into each of SLOTS slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for i, j in chunks(batch, "weighed", PART_BYTES):
                np.add.at(counts, _slot(hashes(batch.column(column).slice(i, j - i))), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["slot", "n"])

    rows = df.select(column, F.col(column).cast("binary").alias("weighed"))
    found = rows.mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # at most SLOTS rows
    out = np.zeros(SLOTS, np.uint32)
    out[found["slot"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.uint32).max)
    return out


def _line_shingles(lines: pa.Array) -> np.ndarray:
    return _distinct_shingles(lines.to_pylist())[1]


def weights(lines: DataFrame) -> DataFrame:
    """(h, weight): the mean count of a line's distinct shingles among all ``lines``."""
    counts = slot_counts(lines, "line", _line_shingles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, "line", PART_BYTES):
                owner, x = _distinct_shingles(batch.column("line").slice(i, j - i).to_pylist())
                mean = np.bincount(owner, counts[_slot(x)], j - i) / np.bincount(owner, minlength=j - i)
                yield pa.RecordBatch.from_arrays([batch.column("h").slice(i, j - i), pa.array(mean)], names=["h", "weight"])

    return keep(lines.select("h", "line").mapInArrow(run, "h bigint, weight double"), "weights")


def differences(members: DataFrame, lines: DataFrame) -> DataFrame:
    """``members`` (h, pivot, root, apart) with pivot_size, n_added and n_lost (shingles beyond the pivot's and missing ones) and both as hashes with the pivot."""
    names = members.columns
    schema = T.StructType([*members.schema.fields, *[T.StructField(c, T.LongType()) for c in ("pivot_size", "n_added", "n_lost")], T.StructField("differing", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, "line", PART_BYTES):
                part = batch.slice(i, j - i)
                texts, bases = part.column("line").to_pylist(), part.column("base").to_pylist()
                known = {x: k for k, x in enumerate(dict.fromkeys([*texts, *bases]))}
                owner, h = _distinct_shingles(list(known))
                sets = np.split(h, np.cumsum(np.bincount(owner, minlength=len(known)))[:-1])
                sizes, added, lost, differing = [], [], [], []
                for x, y, p in zip(texts, bases, part.column("pivot").to_pylist()):
                    x, y = sets[known[x]], sets[known[y]]
                    d = np.setxor1d(x, y, assume_unique=True)
                    sizes.append(len(y))
                    added.append((len(d) + len(x) - len(y)) // 2)
                    lost.append(len(d) - added[-1])
                    differing.append(mix(d ^ np.uint64(p & (1 << 64) - 1)).tobytes())
                columns = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.int64()) for c in (sizes, added, lost)], pa.array(differing, pa.binary())], names=[*names, "pivot_size", "n_added", "n_lost", "differing"])

    both = members.join(lines, "h").join(lines.select(F.col("h").alias("pivot"), F.col("line").alias("base")), "pivot")
    return keep(both.select(*names, "line", "base").mapInArrow(run, schema), "differences")


def _differing_hashes(differing: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(differing.to_pylist()), np.uint64)


def _ranked(part: pa.RecordBatch, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(line number, hash, place, first, given) of the differences of some lines, the rarest of each line before its others.

    Let x be below the threshold t with its pivot p, and y within it of x. With c = t / (1 + t), x and y share at least c(|x| + |y|)
    shingles and x and p fewer than c(|x| + |p|), so x and y have more than (1 - c) lost + c added of y's differences from p in
    common. One of the others plus one, in whatever order all lines use, is therefore among those of x: these are ``first``. x and y
    have in common k + (1 - c) lost + c added of y's at least, k being as much of x's less (1 - 2c)|p|. What they share of either kind
    is no more than y's, so c of the lost and 1 - c of the added ones that they share make k at least: so many of x's that are last in order need not
    be ``given``, nor be first if x is y's side of another such pair.
    """
    c = THRESHOLD / (1 + THRESHOLD)
    lost, added, base = (part.column(x).to_numpy() for x in ("n_lost", "n_added", "pivot_size"))
    apart = part.column("apart").to_numpy(zero_copy_only=False)
    x, size = _differing_hashes(part.column("differing")), lost + added
    owner = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((x, counts[_slot(x)], owner))
    x, place = x[order], np.arange(len(x)) - (np.cumsum(size) - size)[owner]
    shared = (1 - c) * lost + c * added - 1e-9
    k = shared - (1 - 2 * c) * base
    least = np.ceil(np.where((1 - c) * added >= k, k / (1 - c), added + (k - (1 - c) * added) / c) - 1e-9)
    most = np.floor(shared) + 1
    first = place <= (size - np.where(apart, np.maximum(most, least), most))[owner]
    return owner, x, place, first, apart[owner] & (place <= (size - least)[owner])


def _map_slot(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - MAP_BITS)).astype(np.uint32)


def _marked(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def meeting_maps(found: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits of the differences given by a line apart, first of a line that is not, and first of two lines apart."""
    names, width = ("given", "others", "two"), (1 << MAP_BITS) // MAP_PARTS
    schema = T.StructType([T.StructField("part", T.IntegerType()), *[T.StructField(x, T.BinaryType()) for x in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, "differing", PART_BYTES):
                part = batch.slice(i, j - i)
                owner, x, _, first, given = _ranked(part, counts)
                apart, slot = part.column("apart").to_numpy(zero_copy_only=False)[owner], _map_slot(x)
                columns = []
                for use in (given, first & ~apart, first & apart):
                    mine = np.sort(slot[use])
                    columns.append(pa.array([y.tobytes() for y in np.split(mine, np.searchsorted(mine, width * np.arange(1, MAP_PARTS)))], pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array(range(MAP_PARTS), pa.int32()), *columns], names=schema.names)

    def fold(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        slots = [np.frombuffer(b"".join(table.column(x).to_pylist()), np.uint32) - np.uint32(part * width) for x in names]
        bits = [np.packbits(np.bincount(x, minlength=width) >= n, bitorder="little").tobytes() for x, n in zip(slots, (1, 1, 2))]
        return pa.table([pa.array([part], pa.int32()), *[pa.array([x], pa.binary()) for x in bits]], names=schema.names)

    made = found.mapInArrow(run, schema).groupBy("part").applyInArrow(fold, schema).toArrow().sort_by("part")  # MAP_PARTS rows, 6 MB
    return tuple(np.frombuffer(b"".join(made.column(x).to_pylist()) or bytes((1 << MAP_BITS) // 8), np.uint8) for x in names)


def differing_rows(found: DataFrame) -> DataFrame:
    """One row per difference at which a line can meet another: ``first`` tells the rarest ones, all of a line apart from its pivot are given, each with its ``place`` (rarest 0).

    A line that is not apart meets those apart at its first differences; of two lines apart both do. A difference that no such line has is left out;
    what shares its bits by chance is not, which costs a row, no link. So rows follow the meetings that can be, not the size of a group.
    """
    counts = slot_counts(found, "differing", _differing_hashes)
    by_apart, by_others, by_two = meeting_maps(found, counts)
    names = [x for x in found.columns if x != "differing"]
    schema = T.StructType([*[found.schema[x] for x in names], T.StructField("difference", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("first", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in chunks(batch, "differing", PART_BYTES):
                part = batch.slice(i, j - i)
                owner, x, place, first, given = _ranked(part, counts)
                apart, slot = part.column("apart").to_numpy(zero_copy_only=False)[owner], _map_slot(x)
                met = given & (_marked(by_others, slot) | first & _marked(by_two, slot))
                use = np.flatnonzero(met | first & ~apart & _marked(by_apart, slot))
                rows = part.select(names).take(pa.array(owner[use]))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(x[use].view(np.int64)), pa.array(place[use].astype(np.int32)), pa.array(first[use])], names=schema.names)

    return keep(found.mapInArrow(run, schema), "differing-rows")


def meetings(rows: DataFrame) -> DataFrame:
    """(a, b): lines apart from their pivot, and other lines of its group, that share a difference from it and may be within the threshold.

    From |x and y| = |p| - lost(x) - lost(y) + shared differences, a pair of the threshold shares at least c(|x| + |y|) - |p| + lost(x) + lost(y).
    The rarest that it shares has all the others behind it in both lines, so a row at whose place too few are left is not that one.
    """
    names = ("h", "root", "apart", "first", "place", "pivot_size", "n_added", "n_lost")
    side = lambda df, x: df.select("difference", *[F.col(n).alias(f"{n}_{x}") for n in names])
    once = ~F.col("apart_b") | (F.col("first_a") & (F.col("h_a") < F.col("h_b")))
    size = [F.col("pivot_size_a") - F.col(f"n_lost_{x}") + F.col(f"n_added_{x}") for x in "ab"]
    needed = (size[0] + size[1]) * F.lit(THRESHOLD / (1 + THRESHOLD)) - F.col("pivot_size_a") + F.col("n_lost_a") + F.col("n_lost_b") - 1e-9
    most = F.least("n_lost_a", "n_lost_b") + F.least("n_added_a", "n_added_b")
    left = F.least(*[F.col(f"n_lost_{x}") + F.col(f"n_added_{x}") - F.col(f"place_{x}") for x in "ab"])
    possible = (F.col("root_a") != F.col("root_b")) & (F.least(most, left) >= needed)
    met = side(rows.where("apart"), "a").join(side(rows.where("first"), "b"), "difference").where(once & possible)
    return met.select(F.least("h_a", "h_b").alias("a"), F.greatest("h_a", "h_b").alias("b")).distinct()


def around(rooted: DataFrame, found: DataFrame) -> DataFrame:
    """(h, root, main, pivot): members of the large groups (band, pivot, h, root) that hold several components, once per main component.

    Main is the component with the most members of a group, so groups of several bands that are about the same text are one. Its
    new pivot is the member with the most links in ``found``; it is not listed itself.
    """
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("n"), F.max(F.col("h") == F.col("pivot")).alias("own"))
    main = sizes.groupBy("band").agg(F.max(F.struct("n", "own", "root"))["root"].alias("main"), F.count("*").alias("roots")).where("roots > 1")
    near = keep(rooted.join(main, "band").select("h", "root", "main").distinct(), "near")
    degree = found.select(F.explode(F.array("a", "b")).alias("h")).groupBy("h").agg(F.count("*").alias("links"))
    pivots = near.where("root = main").join(degree, "h", "left").groupBy("main").agg(F.max(F.struct(F.coalesce("links", F.lit(0)), "h"))["h"].alias("pivot"))
    return keep(near.join(pivots, "main").where("h != pivot").select("h", "root", "main", "pivot"), "around")


def links(blocks: DataFrame, text: str) -> DataFrame:
    """(a, b): links between hashes of lines whose components are those of all verified candidates; lines already in a component are linked to its root."""
    found = candidates(blocks, text, _buckets(blocks))
    wanted = found.where("kind = 2").groupBy(F.col("x").alias("h")).agg(F.min("block").alias("block"))
    lines = texts(blocks, text, wanted)
    alike = F.col("similarity") >= THRESHOLD
    pairs = found.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b"))
    members = keep(found.where("kind = 1").select(F.col("x").alias("band"), F.col("y").alias("h")), "members")
    crowd = keep(lines.join(members.select("h").distinct(), "h", "left_semi"), "crowd")
    # the pivot is the member whose shingles are the most common: the text that the others vary
    pivots = members.join(weights(crowd), "h").groupBy("band").agg(F.max(F.struct("weight", "h"))["h"].alias("pivot"))
    grouped = keep(members.join(pivots, "band").where("h != pivot").select("h", "pivot").distinct(), "grouped")
    first = verified(pairs.unionByName(grouped.select(F.least("h", "pivot").alias("a"), F.greatest("h", "pivot").alias("b"))).distinct(), lines).where(alike).select("a", "b")
    roots = components(first)
    rooted = keep(members.join(pivots, "band").join(roots.withColumnRenamed("node", "h"), "h", "left").withColumn("root", F.coalesce("root", "h")), "rooted")
    near = around(rooted, first)
    second = verified(near.where("root != main").select(F.least("h", "pivot").alias("a"), F.greatest("h", "pivot").alias("b")).distinct(), lines).where(alike).select("a", "b")
    close = near.join(second, (F.least("h", "pivot") == F.col("a")) & (F.greatest("h", "pivot") == F.col("b")), "left")
    close = close.select("h", "pivot", F.when(F.col("a").isNull(), F.col("root")).otherwise(F.col("main")).alias("root"), (F.col("a").isNull() & (F.col("root") != F.col("main"))).alias("apart"))
    close = keep(close, "close")
    open_groups = close.join(close.where("apart").select("pivot").distinct(), "pivot", "left_semi").select(*close.columns)
    rest = meetings(differing_rows(differences(open_groups, crowd)))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second).unionByName(verified(rest, lines).where(alike).select("a", "b"))


# --- decisions -----------------------------------------------------------------------------------------------


def first_places(blocks: DataFrame, text: str, key: str | None) -> DataFrame:
    """(h, second, block, place): each distinct line of a block with the place of its first occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, name, rows in _open(batch):
                found = _distinct(rows, text)
                hashes = [line_hash(x) for x in found]
                keys = rows.column(key).to_pylist() if key else [None] * rows.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array([h for h, _ in hashes], pa.int64()), pa.array([s - (1 << 63) for _, s in hashes], pa.int64()), pa.array([name] * len(found), pa.string()),
                    pa.array([LAST if keys[i] is None else keys[i] for i, _ in found.values()], pa.int64()),
                ], names=["h", "second", "block", "key"])

    return keep(blocks.mapInArrow(run, "h bigint, second bigint, block string, key bigint"), "first-places")


def dedup_lines(df: DataFrame, text: str = "text", key: str | None = "doc_id") -> DataFrame:
    """``df`` with the repeated lines cut from its texts, and n_lines and n_removed (lines looked at, lines cut).

    Within a block rows keep the order of ``key``, so the first occurrence is the one with the smallest key.
    """
    counted, cut = free_name(df, "n_lines"), free_name(df, "n_removed")
    schema = T.StructType([*df.schema.fields, T.StructField(counted, T.LongType(), False), T.StructField(cut, T.LongType(), False)])
    with Scratch(df.sparkSession) as scratch:
        blocks = scratch.hold(make_blocks(df.sortWithinPartitions(F.col(key).asc_nulls_last()) if key else df, text))
        places = first_places(blocks, text, key)
        roots = keep(components(links(blocks, text)).withColumnRenamed("node", "h"), "roots")
        # lines in several blocks or in a component; where a hash stands for two lines, all are left alone
        each = places.groupBy("h").agg(F.min(F.struct("key", "block")).alias("first"), F.count("*").alias("n"), F.min("second").alias("s0"), F.max("second").alias("s1"))
        each = each.join(roots, "h", "left").where("s0 = s1 and (n > 1 or root is not null)").withColumn("root", F.coalesce("root", "h"))
        each = keep(each.select("h", "root", "first"), "repeated-lines")
        winners = each.groupBy("root").agg(F.min(F.struct("first", "h")).alias("w")).select("root", F.col("w.first.block").alias("kept_in"), F.col("w.h").alias("kept"))
        winners = keep(each.join(keep(winners, "winners"), "root").select("h", "kept", "kept_in"), "decisions")
        lost = places.join(winners, "h").where("h != kept or block != kept_in")
        listed = scratch.hold(keep(lost.groupBy("block").agg(F.collect_set("h").alias("lost")), "lost-lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, rows in _open(batch):
                lost, seen = set(batch.column("lost")[i].as_py() or ()), set()
                known: dict[str, bool] = {}
                out, lines_n, cut_n = [], [], []
                for t in rows.column(text).to_pylist():
                    lines, removed, n = lines_of(t), set(), 0
                    for k, line in enumerate(lines):
                        if not line:
                            continue
                        n += 1
                        if line not in known:
                            known[line] = bool(lost) and line_hash(line)[0] in lost
                        if known[line] or line in seen:
                            removed.add(k)
                        seen.add(line)
                    out.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in removed) if removed else t)
                    lines_n.append(n)
                    cut_n.append(len(removed))
                columns = [pa.array(out, pa.string()) if c == text else rows.column(c) for c in rows.schema.names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lines_n, pa.int64()), pa.array(cut_n, pa.int64())], names=schema.names)

    return blocks.join(listed, "block", "left").select("block", "body", "lost").mapInArrow(run, schema)
