"""Exact top-k search by inner product: an impact-ordered index that is read score at a time.

Components become whole numbers, floor(1024 * x). Vectors are dealt to blocks by hash. A block's index holds, for every
dimension, posting segments: the rows whose component lies in one step of `STEP`, with the least and the largest of
their values. For a query all segments are put in order of descending impact, the largest size that query component
times value can have, and their middle contributions are added to accumulators, one bincount per phase.

What an accumulator lacks is bounded: half a segment's width for what was read, and for what was not read the product
of the lengths of the rest of query and vector (Cauchy-Schwarz). Reading stops only on proof: when all rows but a few are below
the k-th best lower bound, and looking at those few exactly costs less than the postings left. Possible members are then
rescored on the whole numbers. So results are exact, ties included.

Queries first search their own block. Its k-th score is a floor for all other blocks, which stop earlier and return
nothing below it. Blocks meet query slices by block number; a task holds one block and one slice at a time.

Defined results: a vector that is null, or holds a null, NaN or infinite component takes no part; shorter vectors are
filled up with zeros, so an empty one scores 0 everywhere; a null id is a candidate, after all others on ties, and no
query; a row is no candidate for queries of its own id; equal queries (id and vector) are one query, equal candidates
count one by one, and queries of one id with other vectors have ranks of their own; scores beyond 2^62 raise; an empty
table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume.llm.common import discard, query, stored, table

K = 10
EVERY = 100       # rows whose id is divisible by this are queries
SCALE = 1024
STEP = 32         # values of one posting segment
BLOCK = 8192      # rows of a block
SLICE = 1024      # queries of a slice
PHASES = (0.125, 0.25, 0.375, 0.5, 0.75)  # shares of the postings after which bounds are looked at

INDEX = "block int, ids array<long>, width int, vals binary, posts binary, dims binary, ends binary, least binary, most binary"


def whole_numbers(vectors: DataFrame, scale=SCALE) -> DataFrame:
    """vec_id and v, the components as whole numbers, of the vectors that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))  # NaN is above all
    return vectors.where(finite).select("vec_id", F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"))


def matrix(rows: pa.ListArray) -> np.ndarray:
    """Rows of one length; shorter ones get zeros."""
    lengths = np.asarray(rows.value_lengths().fill_null(0), np.int64)
    width = int(lengths.max(initial=0))
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = np.asarray(rows.flatten(), np.int64)
    return out


def segments(values: np.ndarray) -> dict[str, np.ndarray]:
    """A block's postings: rows by dimension and step; of each segment its dimension, end, and least and largest value."""
    posts, dims, ends, least, most, end = [], [], [], [], [], 0
    for d in range(values.shape[1]):
        column = values[:, d]
        order = np.argsort(column, kind="stable")
        level = column[order] // STEP
        cuts = np.flatnonzero(np.r_[level[1:] != level[:-1], True]) + 1
        posts.append(order)
        dims.append(np.full(len(cuts), d))
        ends.append(end + cuts)
        least.append(column[order[np.r_[0, cuts[:-1]]]])
        most.append(column[order[cuts - 1]])
        end += len(order)
    joined = lambda parts, kind: np.concatenate([*parts, np.zeros(0, np.int64)]).astype(kind)
    return {"posts": joined(posts, np.int32), "dims": joined(dims, np.int32), "ends": joined(ends, np.int64), "least": joined(least, np.int64), "most": joined(most, np.int64)}


def indexed(vectors: DataFrame, blocks: int) -> DataFrame:
    """A row per block with its index; a block of more than BLOCK rows has several."""

    def row(block, ids, values):
        made = segments(values)
        cells = [[block], [ids], [values.shape[1]], [values.astype(np.int64).tobytes()], *[[made[c].tobytes()] for c in ("posts", "dims", "ends", "least", "most")]]
        kinds = [pa.int32(), pa.list_(pa.int64()), pa.int32(), *[pa.binary()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cells, kinds)],
                                          ["block", "ids", "width", "vals", "posts", "dims", "ends", "least", "most"])

    def run(batches):
        now, ids, parts, held = None, [], [], 0

        def made():
            width = max(p.shape[1] for p in parts)
            return row(now, ids, np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]))

        for batch in batches:
            block = np.asarray(batch.column("block"))
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for a, b in zip(cuts[:-1], cuts[1:]):
                for k in range(a, b, BLOCK):
                    part = batch.slice(k, min(b, k + BLOCK) - k)
                    if held and (block[a] != now or held + len(part) > BLOCK):
                        yield made()
                        ids, parts, held = [], [], 0
                    now = int(block[a])
                    ids = ids + part.column("vec_id").to_pylist()
                    parts.append(matrix(part.column("v")))
                    held += len(part)
        if held:
            yield made()

    return vectors.repartition(blocks, "block").sortWithinPartitions("block").select("block", "vec_id", "v").mapInArrow(run, INDEX)


class Block:
    """One block's index."""

    def __init__(self, r: dict):
        self.ids = np.array([np.iinfo(np.int64).max if x is None else x for x in r["ids"]], np.int64)
        self.blank = np.array([x is None for x in r["ids"]], bool)
        self.values = np.frombuffer(r["vals"], np.int64).reshape(len(self.ids), r["width"])
        self.posts, self.dims = np.frombuffer(r["posts"], np.int32), np.frombuffer(r["dims"], np.int32)
        self.ends, self.least, self.most = (np.frombuffer(r[c], np.int64) for c in ("ends", "least", "most"))
        self.starts = np.r_[0, self.ends[:-1]] if len(self.ends) else self.ends
        self.square = (self.values.astype(float) ** 2).sum(1)
        self.largest = int(np.abs(self.values).max(initial=0))

    def search(self, own: int, q: np.ndarray, k: int, floor: int | None):
        """Rows and scores of the k best rows that are not below `floor`, own rows left out; and the share of postings read."""
        n, width = self.values.shape
        whole, q = q, np.pad(q, (0, max(0, width - len(q))))[:width]
        if int(np.abs(whole).max(initial=0)) * self.largest * max(width, 1) >= 1 << 62:
            raise OverflowError("a score would be beyond 2^62")
        out_of_it = (self.ids == own) & ~self.blank
        possible, read = np.flatnonzero(~out_of_it), 0
        if width and len(self.ends):
            possible, read = self.possible(out_of_it, q, k, floor)
        scores = self.values[possible] @ q
        if floor is not None:
            possible, scores = possible[scores >= floor], scores[scores >= floor]
        best = np.lexsort((self.ids[possible], self.blank[possible], -scores))[:k]
        return possible[best], scores[best], read

    def possible(self, out_of_it, q, k, floor):
        """Rows that may be among the best, and how many postings were read to tell."""
        n, total, at = len(self.ids), len(self.posts), q[self.dims]
        low, high = np.minimum(at * self.least, at * self.most), np.maximum(at * self.least, at * self.most)
        middle, half = (low + high) / 2, (high - low) / 2
        inner = np.where((self.least < 0) & (self.most > 0), 0, np.minimum(np.abs(self.least), np.abs(self.most))).astype(float) ** 2
        order = np.argsort(-np.maximum(np.abs(low), np.abs(high)), kind="stable")
        sizes = (self.ends - self.starts)[order]
        upto = np.cumsum(sizes)
        added, error = np.zeros(n), np.zeros(n)
        length = float(q.astype(float) @ q)
        rest_q, rest_v = np.full(n, length), self.square.copy()
        rounding = 1 + 1e-9 * np.sqrt(length * self.square)
        done = 0
        for share in (*PHASES, 1.0):
            stop = len(order) if share == 1.0 else int(np.searchsorted(upto, share * total)) + 1
            part = order[done:stop]
            if len(part):
                rows = np.concatenate([self.posts[a:b] for a, b in zip(self.starts[part], self.ends[part])])
                times = sizes[done:stop]
                for into, what, sign in ((added, middle, 1), (error, half, 1), (rest_q, at.astype(float) ** 2, -1), (rest_v, inner, -1)):
                    into += sign * np.bincount(rows, np.repeat(what[part], times), n)
                done = stop
            spare = error + np.sqrt(np.maximum(rest_q, 0) * np.maximum(rest_v, 0)) * (done < len(order)) + rounding
            lower = np.where(out_of_it, -np.inf, added - spare)
            least = -np.inf if n < k else np.partition(lower, n - k)[n - k]
            if floor is not None:
                least = max(least, floor)
            found = np.flatnonzero(~out_of_it & (added + spare >= least))
            left = total - int(upto[done - 1])
            if len(found) * len(q) <= left or done == len(order):
                return found, total - left


FOUND = "query_id long, q_key long, vec_id long, score long"


def searched(index: DataFrame, queries: DataFrame, blocks: int, k: int) -> DataFrame:
    """FOUND rows: the best of each block for the queries (block, vec_id, q_key, v, floor) that are sent to it."""
    sliced = queries.groupBy("block", "slice").agg(F.collect_list(F.struct("vec_id", "q_key", "floor", "v")).alias("queries"))  # about SLICE
    met = sliced.repartition(blocks, "block").join(index.repartition(blocks, "block"), "block")

    def run(batches):
        last, here = None, None
        for batch in batches:
            for i in range(len(batch)):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                data = r["vals"].as_py(), r["ids"].as_py()
                if data != last:
                    here, last = Block({c: x.as_py() for c, x in r.items() if c != "queries"}), data
                qs = r["queries"].values
                floors, values = qs.field("floor").to_pylist(), matrix(qs.field("v"))
                out = [[], [], [], []]
                for own, key, floor, q in zip(qs.field("vec_id").to_pylist(), qs.field("q_key").to_pylist(), floors, values):
                    rows, scores, _ = here.search(own, q, k, floor)
                    for c, x in zip(out, ([own] * len(rows), [key] * len(rows), [None if here.blank[p] else int(here.ids[p]) for p in rows], scores.tolist())):
                        c += x
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "q_key", "vec_id", "score"])

    return met.select("queries", *[c.split()[0] for c in INDEX.split(", ")]).mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, k=K, every=EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the highest scores for every query."""
    kept = stored(whole_numbers(vectors).withColumn("q_key", F.xxhash64("v")), "search-vectors")
    blocks = max(1, math.ceil(kept.count() / BLOCK))
    rows = kept.withColumn("block", F.pmod(F.xxhash64("vec_id", "q_key"), F.lit(blocks)).cast("int"))
    index = stored(indexed(rows, blocks), "search-index")
    asked = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "q_key", "v"])
    home = asked.select("block", F.lit(0).alias("slice"), "vec_id", "q_key", "v", F.lit(None).cast("long").alias("floor"))
    first = searched(index, home, blocks, k).groupBy("query_id", "q_key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    floors = stored(first.select("query_id", F.col("q_key").alias("f_key"), F.when(F.col("n") >= k, F.col("least")).alias("floor")), "search-floors")
    slices = max(1, math.ceil(floors.count() / SLICE))
    to_all = asked.join(floors, (F.col("vec_id") == F.col("query_id")) & (F.col("q_key") == F.col("f_key")), "left").select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("vec_id", "q_key"), F.lit(slices)).alias("slice"),
        "vec_id", "q_key", "v", "floor")
    found = stored(searched(index, to_all, blocks, k), "search-found")
    discard(kept, index, floors)
    best = Window.partitionBy("query_id", "q_key").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op13_exact_top_k", SQL)
def op13_exact_top_k(spark, folder):
    return top_k(table(spark, folder, "embeddings", "vec_id", "embedding"))
