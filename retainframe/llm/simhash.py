"""SimHash near-duplicates by the generalised pigeonhole principle.

Method: the 64 bits are grouped into partitions so that correlated bits come together; each partition gets a
threshold of its own, the thresholds adding up to ``distance - partitions + 1``, chosen by dynamic programming
on candidate counts. Two fingerprints within the distance then agree in at least one partition up to
its threshold (-1: the partition is not probed). Partition values within the threshold are probed, candidates
verified by their Hamming distance, and verified links joined to components.

Bit statistics and candidate counts are taken over all fingerprints. Documents with equal fingerprints are one
node throughout. A bucket with very many fingerprints is not paired out: its fingerprints and those that probe
it are grouped by the points at one flipped bit around them instead. Two fingerprints are at most two bits
apart exactly if they share such a point, so the group links to one member and no link is lost.

Edge cases: a text without words (null, empty, white space) has fingerprint zero and is linked like any other; a
null key is allowed, a component without any key gets a null id; repeated rows give repeated results; an empty
table gives an empty result. Only the key and text columns are read, so other columns cannot clash; ``drop_near_duplicates``
passes all columns of the rows that it keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, keep
from .components import components

BITS, SEED = 64, 42
#: Partitions of the bits, and members beyond which a bucket is grouped by points instead of paired.
PARTS, PAIRED = 3, 64


def shingle_hashes(text: str | None, words_each: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of words, lower-cased in A-Z and joined by one space; repeats included."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    line, n = b" ".join(words), max(1, len(words) - words_each + 1)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    whole, last = xxhash.xxh64_intdigest, min(words_each, len(words)) - 1
    return np.fromiter((whole(line[starts[i] : ends[i + last] - 1], seed) for i in range(n)), dtype=np.uint64, count=n)


def fingerprint(text: str | None, words_each: int, seed: int = SEED) -> int:
    """Bits that are set in over half of the shingle hashes, as a signed 64-bit number."""
    return majority(shingle_hashes(text, words_each, seed))


def majority(hashes: np.ndarray) -> int:
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id", words_each: int = 5) -> DataFrame:
    """(key, fp): the fingerprint of each row's whole text."""
    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), words_each) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.int64())], names=["key", "fp"])

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, fp bigint")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j set, for all i and j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = np.asarray(batch.column("fp")).astype("<i8")
            for i in range(0, len(values), 1 << 14):
                bits = np.unpackbits(values[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                both += bits.T @ bits
                n += len(bits)
        cells = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells.astype(np.int64))], names=["cell", "n"])

    sums = fps.select("fp").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 4,097 rows
    cells = np.zeros(BITS * BITS + 1)
    for r in sums:
        cells[r["cell"]] = r["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal width, each grown from the bit most correlated with the free ones by the bit most correlated with it."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlated = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(correlated, 0)
    free, out = list(range(BITS)), []
    for i in range(parts):
        width = (BITS - sum(map(len, out))) // (parts - i)
        group = [max(free, key=lambda b: (correlated[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            best = max(free, key=lambda b: (correlated[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(sorted(group))
    return out


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds, -1 or more, that add up to ``total`` at the least cost; costs[i][t + 1] is that of t in partition i."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                if spent + t not in grown or cost + more < grown[spent + t][0]:
                    grown[spent + t] = (cost + more, [*chosen, t])
        best = grown
    return best[total][1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(bits: list[int], flips: int) -> list[int]:
    return [_signed(sum(1 << b for b in chosen)) for k in range(flips + 1) for chosen in combinations(bits, k)]


def _mask_of(group: list[int]) -> int:
    return _signed(sum(1 << b for b in group))


def plan(fps: DataFrame, distance: int, parts: int) -> tuple[list[list[int]], list[int]]:
    """Partitions and their thresholds. Candidates of threshold 0 are counted, those beyond follow from the bits' shares."""
    n, both = bit_statistics(fps)
    groups = group_bits(n, both, parts)
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask_of(g))).alias("value")) for i, g in enumerate(groups)]))
    counted = fps.select(values.alias("x")).groupBy("x.part", "x.value").count().groupBy("part").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs"))
    pairs = {r["part"]: r["pairs"] for r in counted.collect()}
    p = np.diag(both) / max(n, 1)
    costs = []
    for i, g in enumerate(groups):
        near = [2 * p[b] * (1 - p[b]) / (p[b] ** 2 + (1 - p[b]) ** 2) for b in g]
        ways = [1.0] + [0.0] * distance  # elementary symmetric sums: pairs at each distance, per pair at none
        for x in near:
            for k in range(distance, 0, -1):
                ways[k] += ways[k - 1] * x
        row = [0.0]
        for t in range(distance + 1):
            row.append((pairs.get(i, 0.0) + 1) * sum(ways[: t + 1]) + n * len(_masks(g, t)))
        costs.append(row)
    return groups, allocate(costs, distance - parts + 1)


def _keys(groups: list[list[int]], flips: list[int]) -> Column:
    """Array of (part, value) of a fingerprint, values with so many flipped bits included; parts below zero are left out."""
    out = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask_of(g))).bitwiseXOR(F.lit(m)).alias("value")) for i, (g, t) in enumerate(zip(groups, flips)) if t >= 0 for m in _masks(g, t)]
    return F.explode(F.array(*out))


def links(fps: DataFrame, distance: int = 2, parts: int = PARTS, paired: int = PAIRED) -> DataFrame:
    """(tab, a, b): links whose components are those of all pairs of different fingerprints within the distance.

    With a column ``tab`` in ``fps``, fingerprints are compared within one value of it only.
    """
    if not 0 <= distance <= 2:
        raise ValueError("distances of 0 to 2 bits are supported")
    fps = keep((fps if "tab" in fps.columns else fps.withColumn("tab", F.lit(0))).select("tab", "fp").distinct(), "fingerprints")
    groups, thresholds = plan(fps, distance, parts)
    probed = any(t > 0 for t in thresholds)
    at = ["tab", "part", "value"]
    index = fps.select("tab", "fp", _keys(groups, [min(t, 0) for t in thresholds]).alias("x")).select("tab", "fp", "x.*")
    probe = fps.select("tab", "fp", _keys(groups, thresholds).alias("x")).select("tab", "fp", "x.*") if probed else index
    sizes = keep(index.groupBy(*at).agg(F.count("*").alias("n")).where("n > 1" if not probed else "n > 0"), "buckets")
    small, hot = sizes.where(F.col("n") <= paired).drop("n"), sizes.where(F.col("n") > paired).drop("n")
    left = keep(index.join(small, at), "bucket-index").select(*at, F.col("fp").alias("a"))
    right = (keep(probe.join(small, at), "bucket-probes") if probed else left.withColumnRenamed("a", "fp")).select(*at, F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = left.join(right, at).where(near & ((F.col("a") < F.col("b")) if not probed else (F.col("a") != F.col("b")))).select("tab", "a", "b")
    crowd = probe.join(hot, at, "left_semi").select("tab", "fp").distinct()
    if distance == 2:
        points = crowd.select("tab", "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in _masks(list(range(BITS)), 1)])).alias("point"))
        points = keep(points.repartition("tab", "point"), "crowd")
        lowest = keep(points.groupBy("tab", "point").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).where("a != last").drop("last"), "points")
        crowded = points.join(lowest, ["tab", "point"]).where("a != fp").select("tab", "a", F.col("fp").alias("b"))
    else:
        points = crowd.select("tab", F.col("fp").alias("a"), F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in _masks(list(range(BITS)), distance)[1:]] or [F.col("fp")])).alias("b"))
        crowded = points.join(fps.withColumnRenamed("fp", "b"), ["tab", "b"], "left_semi").select("tab", "a", "b")
    return found.unionByName(crowded).distinct()


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words_each: int = 5, distance: int = 2) -> DataFrame:
    """(key, fp, component): every row with its fingerprint and the smallest key that its links reach."""
    rows = keep(fingerprints(df, text, key, words_each), "rows")
    nodes = keep(rows.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    roots = components(links(nodes, distance))
    rooted = keep(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = keep(rooted.groupBy("root").agg(F.min("least").alias("component")), "least")
    named = keep(rooted.join(least, "root").select("fp", "component"), "named")
    return rows.join(named, "fp").select(F.col("key").alias(key), "fp", "component")


def drop_near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", words_each: int = 3, distance: int = 2) -> DataFrame:
    """``df`` with one row of each component of ``near_duplicates``: the one with the smallest key (null last), of equal keys any one.

    All columns pass. Texts without words have the fingerprint zero and are one component.
    """
    row = free_name(df, "row")
    with Scratch(df.sparkSession) as scratch:
        numbered = scratch.hold(keep(df.withColumn(row, F.monotonically_increasing_id()), "numbered"))
        found = near_duplicates(numbered, text, row, words_each, distance).select(F.col(row).alias("r"), "component")
        ranked = numbered.select(F.col(row).alias("r"), F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col(row).alias("r")).alias("place"))
        first = found.join(ranked, "r").groupBy("component").agg(F.min("place").alias("first"))
        stays = scratch.hold(keep(first.select(F.col("first.r").alias(row)), "stays"))
    return numbered.join(stays, row, "left_semi").drop(row)
