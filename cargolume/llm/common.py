"""What the operators of this subpackage share: the registry, the word rule and readers."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume.session import fresh_path

REGISTRY: dict = {}

# A word: a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None):
    """Register a callable (spark, folder) -> DataFrame, with SQL where SQL can express it."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = (fn, sql)
        return fn
    return wrap


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` to the shared folder and reads it back; then hints that the steps before are over.

    Spark keeps a finished step's shuffle files until the driver's garbage collector finds its plan unused, which may
    take half an hour. Every step here ends in a stored table, so nothing needs them; a collection frees their disk.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.stored_path = path
    spark.sparkContext._jvm.System.gc()
    return kept


def discard(*tables: DataFrame) -> None:
    """Removes stored tables, once all that was made from them is stored itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def summed_blocks(rows: DataFrame, kind: str) -> np.ndarray:
    """Adds up arrays that tasks emitted as (block int, data binary) rows, and returns the whole array.

    Blocks are added while a partition is read, so that no task holds more than its share of the array, however many
    tasks emitted one. The array's length is fixed by its maker, and so is what the driver gets.
    """

    def add(batches):
        sums = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(data.as_buffer(), kind)  # not copied: a batch may hold a block of every task
                if block in sums:
                    sums[block] += values
                else:
                    sums[block] = values.copy()
        if sums:
            yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "data": [v.tobytes() for v in sums.values()]})

    found = rows.repartition("block").mapInArrow(add, "block int, data binary").collect()
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(r.data, kind) for r in sorted(found, key=lambda r: r.block))])


def blocks(values: np.ndarray, count: int) -> pa.RecordBatch:
    """A task's array cut into `count` rows for `summed_blocks`."""
    parts = values.reshape(count, -1)
    return pa.RecordBatch.from_pydict({"block": pa.array(range(count), pa.int32()), "data": [p.tobytes() for p in parts]})


def text_slices(batch: pa.RecordBatch, most=2_000_000):
    """Cuts a batch with columns (key, text) so that Python holds about `most` characters at once: (keys, texts)."""
    start, held, texts = 0, 0, []
    column = batch.column(1)
    for i in range(len(batch)):
        texts.append(column[i].as_py() or "")
        held += len(texts[-1])
        if held > most:
            yield batch.column(0).slice(start, i + 1 - start), texts
            start, held, texts = i + 1, 0, []
    if texts:
        yield batch.column(0).slice(start), texts


def held_out(divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder, F.lit(False))


def pack_repeats(held: list[np.ndarray]) -> pa.RecordBatch:
    """Tokens of a task (non-negative longs) as sorted blocks: the block is what stands above 32 bits.

    A token is sent twice at most, since all that is asked is which tokens are repeated.
    """
    tokens = np.sort(np.concatenate(held))
    more = np.zeros(len(tokens), bool)
    more[2:] = tokens[2:] == tokens[:-2]
    tokens = tokens[~more]
    block = tokens >> 32
    cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(tokens) else np.zeros(1, np.int64)
    return pa.RecordBatch.from_pydict({
        "block": pa.array(block[cuts[:-1]], pa.int32()),
        "data": pa.array([(tokens[a:b] & 0xFFFFFFFF).astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())})


def merge_repeats(batches):
    """Blocks in order -> the tokens that are there more than once."""
    now, held = None, []

    def flush():
        tokens = np.sort(np.concatenate(held))
        found = np.unique(tokens[1:][tokens[1:] == tokens[:-1]]).astype(np.int64) | (now << 32)
        return pa.RecordBatch.from_pydict({"token": pa.array(found, pa.int64())})

    for batch in batches:
        for block, data in zip(*(c.to_pylist() for c in batch.columns)):
            if block != now and held:
                yield flush()
                held = []
            now = block
            held.append(np.frombuffer(data, np.uint32))
    if held:
        yield flush()


def repeated_tokens(packed: DataFrame) -> DataFrame:
    """Of `pack_repeats` rows of all tasks: the tokens that occur more than once in all."""
    return packed.repartition("block").sortWithinPartitions("block").mapInArrow(merge_repeats, "token long")


def stored_tokens(texts: DataFrame, maker, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(k, tokens) of every row (k, text), the tokens that stand in the column more than once, and the table of both.

    `maker` gives, once per task, a function from texts to their tokens (non-negative longs). One pass writes both
    the tokens by row and each task's tokens packed in sorted blocks.
    """
    names, kind = ["k", "tokens", "block", "data"], texts.schema[0].dataType.simpleString()

    def packed(held, k_type):
        rows = pack_repeats(held)
        return pa.RecordBatch.from_arrays([pa.nulls(len(rows), k_type), pa.nulls(len(rows), pa.list_(pa.int64())), rows.column(0), rows.column(1)], names)

    def run(batches):
        make, held, size, k_type = maker(), [], 0, None
        for batch in batches:
            k_type = batch.schema.field(0).type
            for keys, part in text_slices(batch):
                tokens = make(part)
                offsets, n = pa.array(np.cumsum([0] + [len(t) for t in tokens]).astype(np.int32)), len(part)
                flat = np.concatenate(tokens).astype(np.int64)
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
                held.append(flat)
                size += len(flat)
                if size > 2_000_000:
                    yield packed(held, k_type)
                    held, size = [], 0
        if size:
            yield packed(held, k_type)

    rows = stored(texts.mapInArrow(run, f"k {kind}, tokens array<long>, block int, data binary"), label)
    return rows.where("block IS NULL").select("k", "tokens"), repeated_tokens(rows.where("block IS NOT NULL").select("block", "data")), rows
