"""Repeated byte strings across documents by a hash-compared suffix sort.

Every byte covered by a string of ``length`` bytes that also starts in a document with a smaller key is removed.

Method: suffixes are sorted by mergesort; two suffixes are compared by the binary search of their common
extension on prefix polynomial hashes, and the byte after it. Neighbours that share ``length`` bytes are verified
byte by byte, so a hash collision cannot remove anything. Only suffixes that can have a partner are sorted:

1. Documents are packed into blocks. A window of ``length`` bytes is anchored at the smallest hash of its
   ``GRAM``-byte strings; equal windows have equal anchors at equal offsets. Each block sends its anchors' hashes
   (once per block) to hash buckets, which return those that occur in two documents or more.
2. The blocks send the surroundings of shared anchors, equal ones once, to the buckets. Anchors whose surroundings
   are all equal need no sort; the suffixes of the others are sorted, and every group of suffixes equal in
   their first ``length`` bytes gets the smallest key in it.
3. The blocks get these keys back and mark what is covered.

Texts stay in their blocks; only hashes and the surroundings of shared anchors are shuffled by bucket. A string that
very many documents share is sent once per block, so a bucket holds it as often as there are blocks.

Edge cases: null and empty texts have no bytes; a document shorter than ``length`` keeps all; documents with the
same key do not remove from each other; a null key ranks after all others; texts of any length are read whole; an
empty table gives an empty result. Only the key and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, RollingHash, chunks, keep, mix, powers

LENGTH, GRAM = 50, 20
#: Bytes of text in a block, and of texts per hash bucket (which hold a sixteenth of it as anchors).
BLOCK_BYTES, BUCKET_BYTES = 2 << 20, 16 << 20
LAST = np.iinfo(np.int64).max  # the rank of a null key


# --- suffix sort ---------------------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of ``data`` compared on their first ``length`` bytes (16 or more), within segments.

    Segments are cut finer by the first 16 bytes at the outset; the mergesort orders what these leave equal.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, segment: np.ndarray, length: int):
        self.data, self.at, self.length = data, at, length
        lead = [np.zeros(len(at), dtype=np.uint64) for _ in range(2)]
        for k in range(16):
            lead[k // 8] = lead[k // 8] << np.uint64(8) | data[at + k]
        self.order = np.lexsort((lead[1], lead[0], segment))
        keys = [x[self.order] for x in (segment, *lead)]
        new = np.logical_or.reduce([np.concatenate([[True], k[1:] != k[:-1]]) for k in keys]) if len(at) else np.empty(0, bool)
        self.segment = np.empty(len(at), dtype=np.int64)
        self.segment[self.order] = np.cumsum(new)
        hashes = RollingHash(data)
        self.prefix, self.back = hashes.prefix, hashes.back[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes a and b of one segment: binary search on prefix hashes."""
        x, y, u, v = self.at[a], self.at[b], self.back[a], self.back[b]
        p, q = self.prefix[x], self.prefix[y]
        low, high = np.full(len(a), 16), np.full(len(a), self.length)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = (self.prefix[x + mid] - p) * u == (self.prefix[y + mid] - q) * v
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before suffix b."""
        out = self.segment[a] < self.segment[b]
        tie = np.flatnonzero(self.segment[a] == self.segment[b])
        if len(tie):
            a, b = a[tie], b[tie]
            k = self.common(a, b)
            inside = k < self.length
            k = np.where(inside, k, 0)
            out[tie] = inside & (self.data[self.at[a] + k] < self.data[self.at[b] + k])
        return out

    def _search(self, order: np.ndarray, low: np.ndarray, high: np.ndarray, item: np.ndarray, after_equal: np.ndarray) -> np.ndarray:
        """Place of each item in the sorted run order[low:high], before or after its equals."""
        low, high = low.copy(), high.copy()
        while len(w := np.flatnonzero(low < high)):
            mid = (low[w] + high[w]) // 2
            goes = np.empty(len(w), dtype=bool)
            late = after_equal[w]
            goes[~late] = self.before(order[mid[~late]], item[w][~late])
            goes[late] = ~self.before(item[w][late], order[mid[late]])
            low[w], high[w] = np.where(goes, mid + 1, low[w]), np.where(goes, high[w], mid)
        return low

    def sort(self) -> np.ndarray:
        """Bottom-up mergesort; the runs of one level are merged together, where they overlap, each element by its rank in the other run."""
        order, n, width = self.order.copy(), len(self.at), 1
        while width < n:
            middle = np.arange(width, n, 2 * width)
            middle = middle[self.before(order[middle], order[middle - 1])]  # other runs are in order already
            if len(middle):
                yes = np.ones(len(middle), dtype=bool)
                left = self._search(order, middle - width, middle, order[middle], yes)
                end = self._search(order, middle, np.minimum(middle + width, n), order[middle - 1], ~yes)
                sizes = end - left
                run = np.repeat(np.arange(len(left)), sizes)
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left[run]
                first = place < middle[run]
                rank = self._search(order, np.where(first, middle[run], left[run]), np.where(first, end[run], middle[run]), order[place], ~first)
                target = np.where(first, place + rank - middle[run], place - middle[run] + rank)
                order[target] = order[place]
            width *= 2
        return order

    def groups(self, order: np.ndarray) -> np.ndarray:
        """Number of the group of equal suffixes for each place of ``order``; verified byte by byte."""
        same = np.zeros(len(order), dtype=bool)
        span = np.arange(self.length)
        for i in range(1, len(order), 1 << 16):
            a, b = order[i - 1 : i - 1 + (1 << 16)], order[i : i + (1 << 16)]
            a = a[: len(b)]
            hit = np.flatnonzero(self.segment[a] == self.segment[b])
            hit = hit[self.common(a[hit], b[hit]) == self.length]
            exact = (self.data[self.at[a[hit], None] + span] == self.data[self.at[b[hit], None] + span]).all(axis=1)
            same[i + hit[exact]] = True
        return np.cumsum(~same) - 1


# --- anchors -------------------------------------------------------------------------------------------------


def anchors(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of each anchor and the first and last window it stands for; windows do not cross document ends."""
    none = np.empty(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none
    n = len(data) - gram + 1
    h = RollingHash(data).of(np.arange(n), np.arange(gram, len(data) + 1))
    place = np.arange(n, dtype=np.int64)
    span, width = 1, length - gram + 1
    while span < width:  # leftmost smallest of twice as many, the last step overlapping
        step = min(span, width - span)
        right = h[step:] < h[:-step]
        h, place = np.where(right, h[step:], h[:-step]), np.where(right, place[step:], place[:-step])
        span += step
    starts = np.arange(len(place))
    document = np.searchsorted(ends, starts, side="right")
    whole = starts + length <= ends[np.minimum(document, len(ends) - 1)]
    starts, place = starts[whole], place[whole]
    if not len(starts):
        return none, none, none
    turn = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return place[turn], starts[turn], starts[np.concatenate([turn[1:], [len(starts)]]) - 1]


_POWERS = mix(powers(BASE, GRAM))


def gram_hashes(data: np.ndarray, at: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the gram at each of a few places."""
    out = np.zeros(len(at), dtype=np.uint64)
    weights = _POWERS if gram == GRAM else mix(powers(BASE, gram))
    for k in range(gram):
        out += (data[at + k].astype(np.uint64) + np.uint64(1)) * weights[k]
    return mix(out)


class Block:
    """Texts of a block with their keys' ranks, and their anchors."""

    def __init__(self, text: bytes, ends: bytes, keys: bytes, at: bytes, first: bytes, last: bytes):
        self.text = zstandard.decompress(text)
        self.data = np.frombuffer(self.text, np.uint8)
        self.ends, self.keys = np.frombuffer(ends, np.int64), np.frombuffer(keys, np.int64)
        self.at = np.cumsum(np.frombuffer(zstandard.decompress(at), np.int32).astype(np.int64))
        self.first = self.at - np.frombuffer(zstandard.decompress(first), np.uint8)
        self.last = self.at - np.frombuffer(zstandard.decompress(last), np.uint8)
        self.owner = np.searchsorted(self.ends, self.at, side="right")
        self.hash = gram_hashes(self.data, self.at)

    def surroundings(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of shared anchors (indices), the number of the distinct surrounding of each, those surroundings
        (first and last window offset, then the bytes of all windows, others zero), and an occurrence of each."""
        here = np.flatnonzero(np.isin(self.hash, shared))
        reach = LENGTH - GRAM  # bytes before the anchor that a window can begin at
        rows = np.zeros((len(here), 2 + reach + LENGTH), dtype=np.uint8)
        rows[:, 0], rows[:, 1] = reach - (self.at - self.first)[here], reach - (self.at - self.last)[here]
        column = np.arange(reach + LENGTH)
        inside = (column >= rows[:, :1]) & (column < rows[:, 1:2].astype(np.int64) + LENGTH)
        place = np.clip(self.at[here, None] - reach + column, 0, max(len(self.data) - 1, 0))
        rows[:, 2:] = np.where(inside, self.data[place], 0) if len(here) else 0
        _, one, number = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
        return here, number, rows[one], here[one]


BLOCK = "block string, text binary, ends binary, keys binary, at binary, first binary, last binary"


def make_blocks(df: DataFrame, text: str, key: str) -> DataFrame:
    """Blocks of about BLOCK_BYTES of text, written once so that their numbers and contents stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pack, task, made = zstandard.ZstdCompressor(level=1).compress, TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j in chunks(batch, "text", BLOCK_BYTES):
                part = batch.slice(i, j - i)
                texts = [(t.as_py() or "").encode() for t in part.column("text")]
                data = b"".join(texts)
                ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
                keys = np.array([LAST if k is None else k for k in part.column("key").to_pylist()], dtype=np.int64)
                at, first, last = anchors(np.frombuffer(data, np.uint8), ends)
                row = [f"{task}-{made}", pack(data), ends.tobytes(), keys.tobytes(), pack(np.diff(at, prepend=0).astype(np.int32).tobytes()), pack((at - first).astype(np.uint8).tobytes()), pack((at - last).astype(np.uint8).tobytes())]
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=[c.split()[0] for c in BLOCK.split(", ")])

    return keep(df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, BLOCK), "blocks")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, str, Block]]:
    for i in range(batch.num_rows):
        yield i, batch.column("block")[i].as_py(), Block(*(batch.column(c)[i].as_py() for c in ("text", "ends", "keys", "at", "first", "last")))


def _by_bucket(hashes: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that occurs, with the indices of its hashes."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


_SENT = "bucket int, block string, body binary"


def _rows(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "block": pa.string(), "body": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[c]) for i, c in enumerate(names)], names=names)


# --- 1. shared anchors ---------------------------------------------------------------------------------------

def shared_anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, body): hashes of the block's anchors that occur in documents of two keys or more."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for _, name, block in _blocks(batch):
                key = block.keys[block.owner] if len(block.owner) else block.keys[:0]
                order = np.lexsort((key, block.hash))
                h, k = block.hash[order], key[order]
                head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
                many = np.maximum.reduceat(k, head) != k[head] if len(head) else np.empty(0, bool)
                documents, number = np.unique(k[head], return_inverse=True)
                rows = []
                for bucket, part in _by_bucket(h[head], buckets):
                    used, local = np.unique(number[part], return_inverse=True)
                    body = pack(np.array([len(part), len(used)], "<u4").tobytes() + h[head][part].tobytes() + documents[used].tobytes() + local.astype("<u4").tobytes() + many[part].tobytes())
                    rows.append((bucket, name, body))
                if rows:
                    yield _rows(rows, ("bucket", "block", "body"))

    def find(table: pa.Table) -> pa.Table:
        hashes, keys, many, owner = [], [], [], []
        for i, body in enumerate(table.column("body")):
            raw = zstandard.decompress(body.as_py())
            n, m = np.frombuffer(raw, "<u4", 2)
            hashes.append(np.frombuffer(raw, "<u8", n, 8))
            documents = np.frombuffer(raw, "<i8", m, 8 + 8 * n)
            keys.append(documents[np.frombuffer(raw, "<u4", n, 8 + 8 * (n + m))])
            many.append(np.frombuffer(raw, bool, n, 8 + 8 * (n + m) + 4 * n))
            owner.append(np.full(n, i, dtype=np.int32))
        h, k, more, owner = map(np.concatenate, (hashes, keys, many, owner))
        order = np.argsort(h, kind="stable")
        head = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        low, high = np.minimum.reduceat(k[order], head), np.maximum.reduceat(k[order], head)
        both = (low != high) | np.logical_or.reduceat(more[order], head)
        sizes = np.diff(np.append(head, len(h)))
        kept = np.sort(order[np.repeat(both, sizes)])
        rows = [(table.column("block")[int(owner[part[0]])].as_py(), h[part].tobytes()) for part in np.split(kept, np.flatnonzero(np.diff(owner[kept])) + 1) if len(part)]
        return pa.table({"block": pa.array([r[0] for r in rows], pa.string()), "body": pa.array([r[1] for r in rows], pa.binary())})

    found = blocks.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(find, "block string, body binary")
    return keep(found.groupBy("block").agg(F.collect_list("body").alias("shared")), "shared-anchors")


# --- 2. sorted surroundings ----------------------------------------------------------------------------------

_RUN = np.dtype([("number", "<u4"), ("first", "u1"), ("last", "u1"), ("key", "<i8")])


def smallest_keys(rows: np.ndarray, hashes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct surroundings (bytes after the first two), the smallest key that has each of their windows.

    Returns a table of keys by surrounding and window offset, and the number of the surrounding of each input row.
    """
    width = rows.shape[1] - 2
    wide = np.concatenate([hashes[:, None].astype(">u8").view(np.uint8).reshape(len(rows), 8), rows], axis=1)
    _, one, number = np.unique(np.ascontiguousarray(wide).view(f"V{wide.shape[1]}").ravel(), return_index=True, return_inverse=True)
    best = np.full(len(one), LAST)
    np.minimum.at(best, number, low)
    table = np.repeat(best[:, None], width - LENGTH + 1, axis=1)
    h = hashes[one]  # ascending, as the hash leads the sorted rows
    turn = np.concatenate([[True], h[1:] != h[:-1]])
    anchor = np.cumsum(turn) - 1
    several = np.flatnonzero(np.bincount(anchor)[anchor] > 1)  # one surrounding alone needs no sort
    if len(several):
        spans = rows[one[several]]
        count = spans[:, 1].astype(np.int64) - spans[:, 0] + 1
        row = np.repeat(np.arange(len(several)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + spans[row, 0]
        suffixes = Suffixes(np.ascontiguousarray(spans[:, 2:]).ravel(), row * width + offset, anchor[several][row] * (width - LENGTH + 1) + offset, LENGTH)
        order = suffixes.sort()
        group = suffixes.groups(order)
        least = np.minimum.reduceat(best[several][row[order]], np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
        table[several[row[order]], offset[order]] = least[group]
    return table, number


def smaller_keys(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bodies): for the block's surroundings, runs of window offsets and the smallest key that has these windows."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for i, name, block in _blocks(batch):
                here, number, rows, one = block.surroundings(np.frombuffer(b"".join(batch.column("shared")[i].as_py() or []), "<u8"))
                if not len(here):
                    continue
                key = block.keys[block.owner[here]]
                low, high = np.full(len(one), LAST), np.full(len(one), np.iinfo(np.int64).min)
                np.minimum.at(low, number, key)
                np.maximum.at(high, number, key)
                sent = [(bucket, name, pack(np.uint32(len(part)).tobytes() + part.astype("<u4").tobytes() + block.hash[one[part]].tobytes() + low[part].tobytes() + high[part].tobytes() + rows[part].tobytes())) for bucket, part in _by_bucket(block.hash[one], buckets)]
                yield _rows(sent, ("bucket", "block", "body"))

    def find(table: pa.Table) -> pa.Table:
        numbers, hashes, lows, highs, rows, owner = [], [], [], [], [], []
        for i, body in enumerate(table.column("body")):
            raw = zstandard.decompress(body.as_py())
            n = int(np.frombuffer(raw, "<u4", 1)[0])
            at = 4
            for out, kind in ((numbers, "<u4"), (hashes, "<u8"), (lows, "<i8"), (highs, "<i8")):
                out.append(np.frombuffer(raw, kind, n, at))
                at += n * np.dtype(kind).itemsize
            rows.append(np.frombuffer(raw, np.uint8, offset=at).reshape(n, -1))
            owner.append(np.full(n, i))
        numbers, hashes, lows, highs, rows, owner = map(np.concatenate, (numbers, hashes, lows, highs, rows, owner))
        keys, number = smallest_keys(rows, hashes, lows)
        # runs of offsets with one smallest key, for each row, where some document of the row has a larger key
        first, last = rows[:, 0].astype(np.int64), rows[:, 1].astype(np.int64)
        out = []
        for i in range(0, len(rows), 1 << 16):
            s = slice(i, i + (1 << 16))
            of, column = keys[number[s]], np.arange(keys.shape[1])
            inside = (column >= first[s, None]) & (column <= last[s, None]) & (of < highs[s, None])
            begins = inside & ~np.pad(inside[:, :-1] & (of[:, 1:] == of[:, :-1]), ((0, 0), (1, 0)))
            stops = inside & ~np.pad(inside[:, 1:] & (of[:, 1:] == of[:, :-1]), ((0, 0), (0, 1)))
            (r, a), (_, b) = np.nonzero(begins), np.nonzero(stops)
            found = np.zeros(len(r), dtype=_RUN)
            found["number"], found["first"], found["last"], found["key"] = numbers[s][r], a, b, of[r, a]
            out.append((owner[s][r], found))
        who, runs = np.concatenate([o for o, _ in out]), np.concatenate([f for _, f in out])
        pack = zstandard.ZstdCompressor(level=1).compress
        names = table.column("block")
        sent = [(names[int(who[part[0]])].as_py(), pack(runs[part].tobytes())) for part in np.split(np.arange(len(who)), np.flatnonzero(np.diff(who)) + 1) if len(part)]
        return pa.table({"block": pa.array([r[0] for r in sent], pa.string()), "body": pa.array([r[1] for r in sent], pa.binary())})

    found = blocks.mapInArrow(send, _SENT).groupBy("bucket").applyInArrow(find, "block string, body binary")
    return keep(found.groupBy("block").agg(F.collect_list("body").alias("found")), "smaller-keys")


# --- 3. what is covered --------------------------------------------------------------------------------------


def covered(block: Block, shared: bytes, runs: np.ndarray) -> np.ndarray:
    """Whether each byte of the block lies in a window that a document with a smaller key has."""
    edge = np.zeros(len(block.data) + 1, dtype=np.int32)
    here, number, _, _ = block.surroundings(np.frombuffer(shared, "<u8"))
    if len(here) and len(runs):
        runs = runs[np.argsort(runs["number"], kind="stable")]
        begin, end = np.searchsorted(runs["number"], number, side="left"), np.searchsorted(runs["number"], number, side="right")
        which = np.repeat(np.arange(len(here)), end - begin)
        run = runs[np.arange(len(which)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin) + begin[which]]
        applies = run["key"] < block.keys[block.owner[here[which]]]
        start = block.at[here[which]][applies] - (LENGTH - GRAM)
        np.add.at(edge, start + run["first"][applies], 1)
        np.subtract.at(edge, start + run["last"][applies].astype(np.int64) + LENGTH, 1)
    return np.cumsum(edge[:-1]) > 0


def remove_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", with_bytes: bool = True) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256, the removed spans as (first, end) pairs, and the bytes kept."""
    blocks = make_blocks(df, text, key)
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size * 3 // BUCKET_BYTES))  # texts are packed to a third or so
    shared = shared_anchors(blocks, buckets)
    with_shared = blocks.join(shared, "block")
    found = smaller_keys(with_shared, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, block in _blocks(batch):
                runs = np.frombuffer(b"".join(zstandard.decompress(x) for x in batch.column("found")[i].as_py() or []), _RUN)
                gone = covered(block, b"".join(batch.column("shared")[i].as_py() or []), runs)
                out: dict[str, list] = {c: [] for c in ("key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept")}
                begin = 0
                for k, end in zip(block.keys.tolist(), block.ends.tolist()):
                    own = gone[begin:end]
                    change = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
                    pieces = np.concatenate([[0], change, [end - begin]]).reshape(-1, 2)
                    left = b"".join(block.text[begin + a : begin + b] for a, b in pieces)
                    for c, v in zip(out, (None if k == LAST else k, end - begin, int(own.sum()), len(change) // 2, hashlib.sha256(left).hexdigest(), change.tolist(), left if with_bytes else None)):
                        out[c].append(v)
                    begin = end
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    ready = blocks.join(shared, "block", "left").join(found, "block", "left")
    done = ready.mapInArrow(run, "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<bigint>, kept binary")
    return done.withColumnRenamed("key", key)
