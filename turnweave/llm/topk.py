"""Exact top-k search by inner product, by selection on score histograms.

Vectors are packed into blocks of whole numbers. Each block of queries meets every block of vectors
once a round, and each such pair is scored as one matrix product. A round narrows, for every query,
the interval that holds its k-th highest score: pairs send counts of scores per bin, summed over all
of them, and the bin with the k-th score is the next interval. When it is one score wide, a last
round keeps the scores from there on, and ties at the k-th go to the smaller ids.

Of a pair's histogram only the bins are sent that hold its own k highest scores: the k-th score of
all pairs cannot lie lower. So a pair sends a few rows a query, however many vectors it compares.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches
from turnweave.session import materialize

K, STEP = 5, 50
SCALE = 256
#: Vectors with a larger scaled component take no part: their products need not fit a long.
LARGEST = 1 << 24
#: Vectors of a block, and queries of a block; both are cut smaller where vectors are long.
BLOCK, QUERY_BLOCK, BLOCK_BYTES = 8192, 1024, 8 << 20
#: Blocks of vectors that a copy of the queries is sent to.
GROUP_BLOCKS = 4
#: A round divides the interval of a query into 2**ROUND_BITS bins.
ROUND_BITS = 10
#: Scores looked at together.
SCORES = 1 << 20
#: Below any score, and far enough from the least long.
NEVER = -(1 << 62)

_LONG, _INT, _BIN = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BLOCKS = _schema(dims=_INT, ids=_BIN, known=_BIN, values=_BIN, largest=_LONG)
PAIR = ("dims", "q_ids", "q_mark", "q_values", "low", "need", "ids", "known", "values", "bits", "width")
COUNTS = _schema(query_id=_LONG, mark=_LONG, bin=_LONG, n=_LONG, need=_LONG)
FOUND = _schema(query_id=_LONG, mark=_LONG, vec_id=_LONG, score=_LONG)


def is_query(vec_id: Column, step: int = STEP) -> Column:
    return F.coalesce(vec_id % step == 0, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """The components times ``SCALE``, rounded down; null if the vector takes no part."""
    def fits(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) * SCALE < LARGEST, F.lit(False))

    usable = F.forall(vector, lambda x: ~F.isnan(x) & fits(x)) & (F.size(vector) > 0)
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int")))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows ``(id, values)`` packed by length of the vectors, in the order they are read."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            values = batch.column("values")
            flat = values.flatten().to_numpy(zero_copy_only=False)
            dims = np.diff(values.offsets.to_numpy())
            first = np.cumsum(dims) - dims
            ids = batch.column("id")
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy()
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                part = (ids[rows], known[rows], flat[(first[rows][:, None] + np.arange(d)).reshape(-1)].astype(np.int32).reshape(-1, d))
                most = max(1, min(size, BLOCK_BYTES // (4 * d)))
                held[d] = [np.concatenate(x) for x in zip(held[d], part)] if d in held else list(part)
                while len(held[d][0]) >= most:
                    yield packed(*(x[:most] for x in held[d]))
                    held[d] = [x[most:] for x in held[d]]
        for d in held:
            if len(held[d][0]):
                yield packed(*held[d])

    def packed(ids, known, values) -> pa.RecordBatch:
        parts = (ids.astype(np.int64), known.astype(np.uint8), values)
        row = [pa.array([x.tobytes()], pa.binary()) for x in parts]
        dims, largest = pa.array([values.shape[1]], pa.int32()), pa.array([np.abs(values).max()], pa.int64())
        return pa.RecordBatch.from_arrays([dims, *row, largest], BLOCKS.names)

    return bounded_batches(vectors).mapInArrow(pack, BLOCKS)


class Pair:
    """A block of queries and a block of vectors, scored slice by slice."""

    def __init__(self, row: dict):
        self.q_ids, self.ids, self.marks, self.low, self.need = (np.frombuffer(row[c], np.int64) for c in ("q_ids", "ids", "q_mark", "low", "need"))
        self.known = np.frombuffer(row["known"], np.uint8).astype(bool)
        self.bits, self.width, d = row["bits"], row["width"], row["dims"]
        q, v = (np.frombuffer(row[c], np.int32).reshape(-1, d) for c in ("q_values", "values"))
        # Doubles hold the sums exactly where they fit 53 bits.
        exact = float(np.abs(q).max()) * float(np.abs(v).max()) * d < 2**53
        kind = np.float64 if exact else np.int64
        self.q, self.v = q.astype(kind), np.ascontiguousarray(v.T).astype(kind)

    def scores(self) -> Iterator[tuple[slice, np.ndarray]]:
        """Some queries at a time and their scores; those of their own rows are ``NEVER``."""
        step = max(1, SCORES // max(1, len(self.ids)))
        for at in range(0, len(self.q_ids), step):
            some = slice(at, at + step)
            scores = (self.q[some] @ self.v).astype(np.int64)
            own = np.flatnonzero(np.isin(self.ids, self.q_ids[some]) & self.known)
            query, place = np.nonzero(self.q_ids[some][:, None] == self.ids[own][None, :])
            scores[query, own[place]] = NEVER
            yield some, scores

    def counts(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries, bins and how many scores are there, from the bins of the highest ``need`` ones."""
        for some, scores in self.scores():
            rows, none = len(scores), self.width
            bins = (scores - self.low[some, None]) >> self.bits
            bins[(bins < 0) | (bins >= self.width)] = none
            bins += np.arange(rows)[:, None] * (none + 1)
            grid = np.bincount(bins.reshape(-1), minlength=rows * (none + 1)).reshape(rows, -1)[:, :none]
            above = np.cumsum(grid[:, ::-1], axis=1)[:, ::-1] - grid
            query, found = np.nonzero((grid > 0) & (above < self.need[some, None]))
            yield some.start + query, found, grid[query, found]

    def first(self, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Queries, places of vectors and scores: the ``k`` first ones of each query from its ``low`` on."""
        order = np.lexsort((self.ids, ~self.known))
        for some, scores in self.scores():
            # In order of ids, so that of equal scores the smaller ids come first.
            query, place = np.nonzero((scores >= self.low[some, None])[:, order])
            score = scores[query, order[place]]
            ranked = np.lexsort((place, -score, query))
            query, place, score = query[ranked], order[place[ranked]], score[ranked]
            top = np.arange(len(query)) - np.searchsorted(query, query) < k
            yield some.start + query[top], place[top], score[top]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pair]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Pair(batch.slice(i, 1).to_pylist()[0])


def counted(pairs: DataFrame) -> DataFrame:
    """Rows ``(query_id, mark, bin, n, need)``: how many scores a pair has in the bins of a query's interval."""

    def count(batches):
        for pair in _pairs(batches):
            place, found, n = (np.concatenate(x) for x in zip(*pair.counts()))
            columns = (pair.q_ids[place], pair.marks[place], found, n, pair.need[place])
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], COUNTS.names)

    return bounded_batches(pairs).mapInArrow(count, COUNTS)


def kept(pairs: DataFrame, k: int) -> DataFrame:
    """Rows ``(query_id, mark, vec_id, score)`` of scores from the query's k-th on; of each pair at most
    its ``k`` first in the final order, as no other ones of it can be among the ``k`` first of all."""

    def keep(batches):
        for pair in _pairs(batches):
            place, vector, score = (np.concatenate(x) for x in zip(*pair.first(k)))
            ids = pa.array(pair.ids[vector], pa.int64(), mask=~pair.known[vector])
            yield pa.RecordBatch.from_arrays([pa.array(pair.q_ids[place]), pa.array(pair.marks[place]), ids, pa.array(score)], FOUND.names)

    return bounded_batches(pairs).mapInArrow(keep, FOUND)


def query_blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of queries ``(dims, q_ids, q_mark, q_values, low, need)``; rows of ``vectors`` carry their interval."""
    schema = _schema(dims=_INT, q_ids=_BIN, q_mark=_BIN, q_values=_BIN, low=_BIN, need=_BIN)

    def pack(batches):
        for batch in batches:
            ids, marks, low, need = (batch.column(c).to_numpy() for c in ("id", "mark", "low", "need"))
            values = batch.column("values")
            dims = np.diff(values.offsets.to_numpy())
            flat, first = values.flatten().to_numpy(zero_copy_only=False), np.cumsum(dims) - dims
            for d in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == d)
                most = max(1, min(size, BLOCK_BYTES // (4 * d)))
                for at in range(0, len(rows), most):
                    some = rows[at : at + most]
                    matrix = flat[(first[some][:, None] + np.arange(d)).reshape(-1)].astype(np.int32)
                    row = (d, ids[some].tobytes(), marks[some].tobytes(), matrix.tobytes(), low[some].tobytes(), need[some].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.int32()) if isinstance(x, int) else pa.array([x], pa.binary()) for x in row], schema.names)

    return bounded_batches(vectors).select("id", "mark", "values", "low", "need").mapInArrow(pack, schema)


def met(queries: DataFrame, held: DataFrame, groups: int, bits: int = 0, width: int = 1) -> DataFrame:
    """Every block of queries beside every block of vectors of the same length.

    Blocks of vectors stay where their group is; a copy of the queries goes to each group.
    """
    copies = query_blocks(queries, QUERY_BLOCK).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return held.join(copies, ["dims", "group"]).withColumns({"bits": F.lit(bits), "width": F.lit(width)}).select(*PAIR)


def narrowed(queries: DataFrame, counts: DataFrame, bits: int) -> DataFrame:
    """The queries with the interval and the number of scores still to find in it.

    The next interval is the bin of the k-th score, or the lowest one if there are fewer scores.
    """
    sums = counts.groupBy("query_id", "mark", "need", "bin").agg(F.sum("n").alias("n"))
    downwards = Window.partitionBy("query_id", "mark").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    upto = sums.withColumn("upto", F.sum("n").over(downwards))
    reached = F.when(F.col("upto") >= F.col("need"), F.struct("bin", (F.col("upto") - F.col("n")).alias("above")))
    spots = upto.groupBy(F.col("query_id").alias("id"), "mark").agg(F.max(reached).alias("spot"))
    low = F.col("low") + F.shiftleft(F.coalesce("spot.bin", F.lit(0)).cast("bigint"), bits)
    need = F.col("need") - F.coalesce("spot.above", F.lit(0))
    return queries.join(spots, ["id", "mark"], "left").select("id", "mark", "values", low.alias("low"), need.alias("need"))


def top_k(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = K, step: int = STEP) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: for each vector whose id is divisible by ``step`` the ``k``
    others of the highest inner product, all of them if there are fewer; ties go to the smaller id.

    Vectors that are null, empty, or hold a component that is null, not finite or scaled beyond
    ``LARGEST`` take no part; vectors of different length do not meet. All rows of a query's id
    count as its own. Rows repeated with one id and vector are one query; one id with several
    vectors is as many queries, each with its ranks. A vector with a null id is found, after all
    others of its score, and is no query. An empty table gives no rows; other columns are left out.
    """
    numbers = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), whole_numbers(F.col(f"`{vector}`")).alias("values")).where("values IS NOT NULL")
    held = materialize(blocks(numbers, BLOCK), "vector-blocks")
    size = held.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.max("largest").alias("largest")).collect()  # a row for each length of vector
    groups = max(1, -(-sum(r.n for r in size) // GROUP_BLOCKS))
    held = held.withColumn("group", F.pmod(F.xxhash64("ids", "values"), F.lit(groups)).cast("int"))
    largest = max((r.largest for r in size), default=0)

    mark = F.xxhash64(F.concat_ws(",", F.transform("values", lambda x: x.cast("string"))))
    bound = F.aggregate("values", F.lit(0).cast("bigint"), lambda s, x: s + F.abs(x).cast("bigint")) * F.lit(largest)
    queries = (
        numbers.where(is_query(F.col("id"), step))
        .dropDuplicates(["id", "values"])
        .withColumns({"mark": mark, "low": -bound, "need": F.lit(k).cast("bigint")})
    )
    queries = materialize(queries.withColumn("bound", bound), "queries")
    bits = (2 * (queries.agg(F.max("bound")).first()[0] or 0) + 1).bit_length()
    while bits > 0:
        step_bits = min(bits, ROUND_BITS)
        bits -= step_bits
        counts = counted(met(queries, held, groups, bits, 1 << step_bits))
        queries = materialize(narrowed(queries, counts, bits), "queries")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = kept(met(queries, held, groups), k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
