"""Exact k nearest neighbours by cosine similarity, computed as blocked matrix products."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

# A side is sent to every task only when rows x dimensions x 8 bytes stay below this; every Python worker holds it.
SHARED_SIDE_BYTES = 8 << 20
# Vectors by which pivots are numbered, vectors of either side of a cell of the grid, and cells wanted along each side.
BLOCK_BYTES = 32 << 20
CELL_BYTES = 16 << 20
LEAST_CELLS = 8
# Base rows and similarities held at a time inside a task, and rows whose angles to all pivots are.
ROWS_AT_ONCE = 2048
SCORES_AT_ONCE = 1 << 20
ANGLES_AT_ONCE = 1000
# One row of this many of a scanned base tells how good a query's k-th row is at least.
FLOOR_SHARE = 16
# Pivots are held by every task; the error allowed for an angle computed from a cosine.
MAX_PIVOTS = 1024
ANGLE_ERROR = 1e-6


def nearest_neighbours(
    queries: DataFrame,
    base: DataFrame,
    k: int = 10,
    carry: Sequence[str] = (),
    min_similarity: float | None = None,
    digits: int = 9,
    shared_side_bytes: int = SHARED_SIDE_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` most similar base rows of every query row.

    ``queries``: query_id, vector. ``base``: base_id, vector and the ``carry`` columns. Result:
    query_id, base_id, carry columns, score. Scores are rounded to ``digits`` places and ties go to
    the smaller base_id, so the result does not depend on the partitioning. ``min_similarity``
    leaves out weaker neighbours after the top k are known.

    The strategy follows from counted sizes:

    * base fits ``shared_side_bytes``: every task holds it, a query is answered where it lies, no shuffle;
    * queries fit: every task holds them, scans its part of the base and keeps k rows per query, and
      only those partial results are shuffled;
    * neither fits: the base is divided among pivots, and a query is sent only to the bundles of pivots that can
      hold one of its ``k`` nearest rows, see :func:`_by_pivot`. Cells are of bounded size
      and hold vectors, never pairs; their partial results are merged.
    """
    queries = queries.select("query_id", numbers(queries)).where("vector is not null")
    base = base.select("base_id", numbers(base), *carry).where("vector is not null")
    n_queries, dims, query_extra = _shape(queries)
    n_base, base_dims, base_extra = _shape(base)
    row_bytes = 8 * max(dims, base_dims, 1)
    result = T.StructType(
        [T.StructField("query_id", queries.schema["query_id"].dataType)]
        + [T.StructField(f.name, f.dataType) for f in base.schema if f.name != "vector"]
        + [T.StructField("score", T.DoubleType())]
    )
    if n_base * row_bytes + base_extra <= shared_side_bytes:
        found = _scan_queries(queries, base, k, digits, result)
    else:
        if n_queries * row_bytes + query_extra <= shared_side_bytes:
            partial = _scan_base(queries, base, k, digits, result)
        else:
            partial = _by_pivot(queries, base, k, digits, result, n_base, max(1, block_bytes // row_bytes), max(1, CELL_BYTES // row_bytes))
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "base_id")
        found = partial.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")
    return found if min_similarity is None else found.where(F.col("score") >= min_similarity)


def numbers(side: DataFrame) -> Column:
    """``vector`` as doubles; floats stay as narrow as they are until they are compared."""
    kind = side.schema["vector"].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col("vector").cast("array<float>" if narrow else "array<double>").alias("vector")


def _shape(side: DataFrame) -> tuple[int, int, int]:
    """Rows, dimensions, and bytes of all columns beside the vector."""
    others = F.octet_length(F.to_json(F.struct(*(c for c in side.columns if c != "vector"))))
    row = side.agg(F.count(F.lit(1)), F.min(F.size("vector")), F.max(F.size("vector")), F.sum(others)).first()
    if row[1] != row[2]:
        raise ValueError(f"vectors of {row[1]} and {row[2]} dimensions in one column")
    return row[0], row[2] or 0, row[3] or 0


def _matrix(table: pa.Table) -> np.ndarray:
    """Unit rows; zero rows stay zero and so are similar to nothing."""
    if not table.num_rows:
        return np.zeros((0, 1))
    flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64, copy=False).reshape(table.num_rows, -1)
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(lengths > 0, lengths, 1.0)


def _prepared(table: pa.Table, id_column: str) -> tuple[pa.Table, np.ndarray]:
    """Rows in id order without their vectors, and the unit vectors."""
    table = table.sort_by(id_column)
    return table.drop_columns("vector"), _matrix(table)


def _top(
    queries: tuple[pa.Table, np.ndarray], base: tuple[pa.Table, np.ndarray], k: int, digits: int, schema: pa.Schema,
    floors: np.ndarray | None = None,
) -> pa.Table:
    """Top k rows of one base block for each query of one query block, without those below the query's floor."""
    (query_rows, q), (base_rows, b) = queries, base
    if not query_rows.num_rows or not base_rows.num_rows:
        return schema.empty_table()
    best = _Best(q, k, digits, floors)
    for start in range(0, len(b), ROWS_AT_ONCE):
        best.add(b[start:start + ROWS_AT_ONCE], np.arange(start, min(start + ROWS_AT_ONCE, len(b))))
    return best.table(query_rows, base_rows, schema)


class _Best:
    """The k best base rows of every query of a block, among those added so far.

    Products are first taken in single precision. What they leave within their error of a query's limit, which is its k-th best score
    so far or its floor, is scored again in double precision, so limits, scores and ties are those of double precision.
    """

    def __init__(self, q: np.ndarray, k: int, digits: int, floors: np.ndarray | None = None):
        self.q, self.k, self.digits = q, k, digits
        self.narrow = q.astype(np.float32)
        self.limit = np.full(len(q), -np.inf) if floors is None else floors.astype(np.float64)
        self.score = np.full((len(q), k), -np.inf)
        self.place = np.full((len(q), k), np.iinfo(np.int64).max)
        self.error = (q.shape[1] + 8) * 2.0 ** -23 + 10.0 ** -digits

    def add(self, b: np.ndarray, places: np.ndarray, only: np.ndarray | None = None) -> None:
        """Base rows with their places in base_id order, ascending; for the queries numbered ``only``, or all."""
        if not len(b):
            return
        only = np.arange(len(self.q)) if only is None else only
        narrow, step = b.astype(np.float32).T, max(1, SCORES_AT_ONCE // len(b))
        for start in range(0, len(only), step):
            rows = only[start:start + step]
            hits = np.flatnonzero(self.narrow[rows] @ narrow >= (self.limit[rows] - self.error).astype(np.float32)[:, None])
            if not len(hits):
                continue
            i, j = hits // len(b), hits % len(b)
            crowded = np.bincount(i, minlength=len(rows)) > 4 * self.k + 16
            if crowded.any():
                self._crowded(rows[crowded], b, places)
                few = ~crowded[i]
                i, j = i[few], j[few]
            i = rows[i]
            score = np.round(np.einsum("ij,ij->i", self.q[i], b[j]), self.digits)
            good = score >= self.limit[i]
            self._settle(i[good], places[j[good]], score[good])

    def _crowded(self, rows: np.ndarray, b: np.ndarray, places: np.ndarray) -> None:
        """Queries that many rows reach: the k best of the block by partition, ties in order of place."""
        block = np.round(self.q[rows] @ b.T, self.digits)
        block[np.isnan(block)] = -np.inf
        limit = self.limit[rows]
        if len(b) > self.k:
            limit = np.maximum(limit, np.partition(block, len(b) - self.k, axis=1)[:, len(b) - self.k])
        hits = np.flatnonzero((block >= limit[:, None]) & (block > -np.inf))
        i, j = hits // len(b), hits % len(b)
        score = block.ravel()[hits]
        tied = score == limit[i]
        before = np.cumsum(tied) - tied
        first = np.searchsorted(i, np.arange(len(rows)))
        nth = before - before[np.minimum(first, max(len(before) - 1, 0))][i] if len(before) else before
        use = ~tied | (nth < self.k)
        self._settle(rows[i[use]], places[j[use]], score[use])

    def _settle(self, rows: np.ndarray, places: np.ndarray, score: np.ndarray) -> None:
        if not len(rows):
            return
        touched = np.unique(rows)
        rows = np.r_[np.repeat(touched, self.k), rows]
        places = np.r_[self.place[touched].ravel(), places]
        score = np.r_[self.score[touched].ravel(), score]
        order = np.lexsort((places, -score, rows))
        starts = np.searchsorted(rows[order], touched)
        chosen = order[starts[:, None] + np.arange(self.k)]
        self.score[touched], self.place[touched] = score[chosen], places[chosen]
        self.limit[touched] = np.maximum(self.limit[touched], score[chosen[:, -1]])

    def table(self, query_rows: pa.Table, base_rows: pa.Table, schema: pa.Schema) -> pa.Table:
        known = self.score > -np.inf
        picked = base_rows.take(pa.array(self.place[known]))
        query_ids = query_rows.column("query_id").take(pa.array(np.nonzero(known)[0]))
        return pa.table([query_ids, *picked.columns, pa.array(self.score[known])], schema=schema)


def _merge(parts: list[pa.Table], k: int) -> pa.Table:
    """Best k rows per query out of several partial results."""
    rows = pa.concat_tables(parts).sort_by([("query_id", "ascending"), ("score", "descending"), ("base_id", "ascending")])
    ids = rows.column("query_id").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    places = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
    return rows.filter(pa.array(places < k))


def _arrow_schema(result: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(result)


def _scan_queries(queries: DataFrame, base: DataFrame, k: int, digits: int, result: T.StructType) -> DataFrame:
    shared, schema = base.toArrow(), _arrow_schema(result)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = _prepared(shared, "base_id")
        for batch in batches:
            asked = _prepared(pa.Table.from_batches([batch]), "query_id")
            yield from _top(asked, prepared, k, digits, schema).to_batches()

    return queries.mapInArrow(answer, result)


def _scan_base(queries: DataFrame, base: DataFrame, k: int, digits: int, result: T.StructType, floor_share: int = FLOOR_SHARE) -> DataFrame:
    """Partial results of a scan: about ``floor_share`` * k rows per query in all, however many tasks scan the base.

    The k-th best row among a hashed share of the base is a floor under a query's k-th best row of all, so tasks
    give back only rows that reach it.
    """
    shared, schema = queries.toArrow(), _arrow_schema(result)

    def scan(rows: DataFrame, floors: np.ndarray | None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best, asked = schema.empty_table(), _prepared(shared, "query_id")
            for batch in batches:
                rows = _prepared(pa.Table.from_batches([batch]), "base_id")
                best = _merge([best, _top(asked, rows, k, digits, schema, floors)], k)
            yield from best.to_batches()

        return rows.mapInArrow(run, result)

    part = scan(base.where(F.pmod(F.xxhash64("base_id"), F.lit(floor_share)) == 0), None)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    kth = part.select("query_id", "score", place.alias("place")).where(F.col("place") == k).select("query_id", "score")
    known = {r["query_id"]: r["score"] for r in kth.collect()}  # a number per query; the queries themselves fit a task
    floors = np.array([known.get(q, -np.inf) for q in shared.sort_by("query_id").column("query_id").to_pylist()])
    return scan(base, floors)


def _by_pivot(
    queries: DataFrame, base: DataFrame, k: int, digits: int, result: T.StructType, n_base: int, block_rows: int, cell_rows: int
) -> DataFrame:
    """Exact k-nearest join by pivots (Lu et al., VLDB 2012), on the angle between vectors.

    Every base row belongs to its nearest pivot, and neighbouring pivots are bundled up to ``cell_rows`` rows. A query is first
    compared with the bundle of its own nearest pivot, which gives a floor under its k-th score. By the triangle
    inequality the rows of a pivot lie between two angles from a query, known from the pivot's nearest and farthest
    row; a bundle all of whose rows lie below the floor is skipped, and so is a pivot inside a bundle. The
    choice of pivots and bundles changes the work, not the result.

    A bundle with many rows, or many queries, is cut into blocks by key, so a large group of equal
    vectors is spread over many cells too. A vector is sent once per cell, not once per pivot.
    """
    wanted = min(MAX_PIVOTS, max(2, 4 * math.ceil(n_base / block_rows)))
    sample = base.orderBy(F.xxhash64("base_id"), "base_id").limit(wanted).select("vector").toArrow()
    if not sample.num_rows:
        return queries.sparkSession.createDataFrame([], result)
    pivots = np.unique(_matrix(sample), axis=0)
    pivots = pivots[np.linalg.norm(pivots, axis=1) > 0]

    assigned = materialize(base.mapInArrow(
        _assigner(pivots), T.StructType([*base.schema, T.StructField("pivot", T.IntegerType()), T.StructField("angle", T.DoubleType())])
    ), "assigned")
    rings = assigned.groupBy("pivot").agg(
        F.count(F.lit(1)).alias("n"), F.min("angle").alias("near"), F.max("angle").alias("far")
    ).collect()
    cell_rows = max(1, min(cell_rows, max(block_rows, n_base // LEAST_CELLS)))
    rings, bundles = _bundled(pivots, rings, cell_rows)
    bundle_of = np.full(len(pivots) + 1, -1, dtype=np.int32)
    bundle_of[[r["pivot"] for r in rings]] = bundles
    rows_of = np.bincount(bundles, [r["n"] for r in rings]).astype(int)
    placed = T.StructType([*queries.schema, T.StructField("bundle", T.IntegerType())])
    homes = materialize(queries.mapInArrow(_homes(pivots, rings, bundles), placed), "homes")
    # at most MAX_PIVOTS + 1 rows
    numbered = queries.sparkSession.createDataFrame([(p, int(n)) for p, n in enumerate(bundle_of)], "pivot int, bundle int")
    held = assigned.drop("angle").join(F.broadcast(numbered), "pivot")

    def compared(asked: DataFrame) -> DataFrame:
        """Partial results of queries (query_id, vector, floor, bundle), each against the whole of its bundle."""
        counts = {r["bundle"]: r["n"] for r in asked.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()}
        blocks = queries.sparkSession.createDataFrame(
            [(b, math.ceil(n / cell_rows), math.ceil(int(rows_of[b]) / cell_rows)) for b, n in counts.items()],
            "bundle int, query_blocks int, base_blocks int",
        )

        def own(id_column: str, count: str):
            return F.pmod(F.xxhash64(id_column), F.col(count)).cast("int")

        def each(count: str):
            return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

        keys = ["bundle", "query_block", "base_block"]
        left = asked.join(F.broadcast(blocks), "bundle").withColumn("query_block", own("query_id", "query_blocks"))
        left = left.withColumn("base_block", each("base_blocks")).select("query_id", "vector", "floor", *keys)
        right = held.join(F.broadcast(blocks), "bundle").withColumn("base_block", own("base_id", "base_blocks"))
        right = right.withColumn("query_block", each("query_blocks")).select(*base.columns, "pivot", *keys)
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_cell(pivots, rings, keys, k, digits, _arrow_schema(result)), result)

    first = materialize(compared(homes.withColumn("floor", F.lit(None).cast("double"))), "nearest")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    floors = first.select("query_id", F.col("score").alias("floor"), place.alias("place")).where(F.col("place") == k).drop("place")
    asked = homes.join(floors, "query_id", "left").withColumnRenamed("bundle", "home")
    routed = asked.mapInArrow(
        _bundle_router(_router(pivots, rings, k, digits), bundle_of), T.StructType([*asked.schema, T.StructField("bundles", T.ArrayType(T.IntegerType()))])
    )
    routed = materialize(routed.where(F.size("bundles") > 0), "routed")
    return first.unionByName(compared(routed.select("query_id", "vector", "floor", F.explode("bundles").alias("bundle"))))


def _bundled(pivots: np.ndarray, rings: list, cell_rows: int) -> tuple[list, np.ndarray]:
    """The rings in an order in which near pivots follow each other, and the number of each one's bundle."""
    centres = np.r_[pivots, np.zeros((1, pivots.shape[1]))][[r["pivot"] for r in rings]]
    left, order = np.ones(len(rings), dtype=bool), [0]
    left[0] = False
    while left.any():
        order.append(int(np.where(left, centres @ centres[order[-1]], -np.inf).argmax()))
        left[order[-1]] = False
    rings, bundles, held = [rings[i] for i in order], [0], rings[order[0]]["n"]
    for r in rings[1:]:
        new = held + r["n"] > cell_rows
        bundles.append(bundles[-1] + new)
        held = r["n"] if new else held + r["n"]
    return rings, np.array(bundles, dtype=np.int32)


def _cell(pivots: np.ndarray, rings: list, keys: list[str], k: int, digits: int, schema: pa.Schema):
    """Top k rows of a block of a bundle for a block of queries; pivots out of a query's reach are passed over."""
    known = {r["pivot"]: (r["near"], r["far"]) for r in rings}

    def cell(q: pa.Table, b: pa.Table) -> pa.Table:
        if not q.num_rows or not b.num_rows:
            return schema.empty_table()
        floors = q.column("floor").fill_null(-math.inf).to_numpy()
        order = pc.sort_indices(q, [("query_id", "ascending")])
        asked = _prepared(q.drop_columns([*keys, "floor"]), "query_id")
        best = _Best(asked[1], k, digits, floors[order.to_numpy()])
        pivot = b.column("pivot").to_numpy()[pc.sort_indices(b, [("base_id", "ascending")]).to_numpy()]
        rows, vectors = _prepared(b.drop_columns([*keys, "pivot"]), "base_id")
        order = np.argsort(pivot, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(pivot[order])) + 1):
            number = pivot[places[0]]
            centre = pivots[number] if number < len(pivots) else np.zeros(vectors.shape[1])
            reach = _reach(_angles(asked[1], centre[None, :]), *(np.array([x]) for x in known[number]))
            reach[~asked[1].any(axis=1)] = np.pi / 2
            # no limit yet: every pivot may hold a row
            only = np.flatnonzero(np.cos(np.maximum(reach[:, 0] - ANGLE_ERROR, 0.0)) >= best.limit - 10.0 ** -digits - ANGLE_ERROR)
            for start in range(0, len(places), ROWS_AT_ONCE):
                some = places[start:start + ROWS_AT_ONCE]
                best.add(vectors[some], some, only)
        return best.table(asked[0], rows, schema)

    return cell


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _reach(angles: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The least angle between a query and the rows of a pivot."""
    return np.maximum(np.maximum(angles - far, near - angles), 0.0)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = ANGLES_AT_ONCE) -> Iterator[pa.Table]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield pa.Table.from_batches([batch.slice(start, rows)])


def _assigner(pivots: np.ndarray):
    """Nearest pivot of each row. Zero vectors, which have no angle, share a pivot number of their own."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches):
            vectors = _matrix(table)
            # the zero vector itself stands for the last number: at a right angle to everything; NaN is similar to nothing either
            angles = _angles(vectors, np.r_[pivots, np.zeros((1, vectors.shape[1]))])
            zero = ~vectors.any(axis=1) | np.isnan(vectors).any(axis=1)
            angles[np.isnan(angles)] = np.pi / 2
            angles[:, -1] = np.where(zero, 0.0, np.inf)
            nearest = angles.argmin(axis=1)
            table = table.append_column("pivot", pa.array(nearest.astype(np.int32)))
            table = table.append_column("angle", pa.array(angles[np.arange(len(angles)), nearest]))
            yield from table.to_batches()

    return assign


def _homes(pivots: np.ndarray, rings: list, bundles: np.ndarray):
    """The bundle of the nearest pivot that has rows."""
    centres = np.r_[pivots, np.zeros((1, pivots.shape[1]))][[r["pivot"] for r in rings]]

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches):
            nearest = np.argmax(_matrix(table) @ centres.T, axis=1)
            yield from table.append_column("bundle", pa.array(bundles[nearest])).to_batches()

    return home


def _bundle_router(router, bundle_of: np.ndarray):
    """The bundles, other than its home, of the pivots that a query is sent to; pivots of a bundle follow each other."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in router(batches):
            lists, home = batch.column("pivots"), batch.column("home").to_numpy()
            bundles = bundle_of[lists.flatten().to_numpy()]
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            new = np.ones(len(bundles), dtype=bool)
            new[1:] = (bundles[1:] != bundles[:-1]) | (owner[1:] != owner[:-1])
            new &= bundles != home[owner]
            offsets = np.r_[0, np.bincount(owner[new], minlength=batch.num_rows).cumsum()].astype(np.int32)
            table = pa.Table.from_batches([batch]).drop_columns("pivots")
            yield from table.append_column("bundles", pa.ListArray.from_arrays(pa.array(offsets), pa.array(bundles[new]))).to_batches()

    return route


def _router(pivots: np.ndarray, rings: list, k: int, digits: int):
    """The pivots that can hold one of the k nearest rows of each query, given its ``floor`` if there is one."""
    numbers = np.array([r["pivot"] for r in rings], dtype=np.int32)
    counts, near, far = (np.array([r[name] for r in rings]) for name in ("n", "near", "far"))
    slack = 10.0 ** -digits + ANGLE_ERROR

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _slices(batches):
            vectors = _matrix(table)
            centres = np.r_[pivots, np.zeros((1, vectors.shape[1]))][numbers]
            angles = _angles(vectors, centres)
            least = _reach(angles, near, far)
            most = np.minimum(angles + far, np.pi)
            least[~vectors.any(axis=1)] = most[~vectors.any(axis=1)] = np.pi / 2
            order = most.argsort(axis=1)
            reached = counts[order].cumsum(axis=1) >= k
            last = np.take_along_axis(order, reached.argmax(axis=1)[:, None], axis=1)
            bound = np.where(reached.any(axis=1), np.take_along_axis(most, last, axis=1)[:, 0], np.pi)
            worst = np.cos(np.minimum(bound + ANGLE_ERROR, np.pi)) - slack
            if "floor" in table.column_names:
                worst = np.maximum(worst, table.column("floor").fill_null(-math.inf).to_numpy() - slack)
            kept = np.cos(np.maximum(least - ANGLE_ERROR, 0.0)) >= worst[:, None]
            offsets = np.r_[0, kept.sum(axis=1).cumsum()].astype(np.int32)
            chosen = pa.ListArray.from_arrays(pa.array(offsets), pa.array(numbers[np.nonzero(kept)[1]]))
            yield from table.append_column("pivots", chosen).to_batches()

    return route
