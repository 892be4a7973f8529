"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Random indexing gives every word (hashed to one of `WORDS` rows) a sparse ternary index vector that follows from its
row alone, and a context vector: its own index vectors plus those of its neighbours, added up over all documents,
labelled or not, but those held out. A document is pooled to the mean of its words' normalised context vectors, that mean's length and the
logarithm of its word count. A network of one hidden layer is trained on those in numpy, and its logits are divided
by a temperature fitted on rows that training did not see.

The network and the temperature are fitted on at most `TRAIN_ROWS` labelled documents, those with the smallest seeded
hashes; everything that grows with the corpus (context vectors, pooling, scoring) runs in Spark tasks, and context
vectors are added up in blocks. Sums are whole numbers, so that a fit does not depend on the order of tasks.

Defined results: null and empty texts are documents without words, scored like any other; several labels of one id
count as their mean, null labels not at all; with no labelled row, or one class only, the score is the share of label
1 (0.5 without any); rows with equal doc_id are scored one by one, and in the sample those with equal text count once; an empty table gives no rows.
"""

import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import blocks, held_out, query, stored, summed_blocks, table, text_slices

TRAIN_ROWS = 20_000
WORDS = 1 << 15        # rows of the word table
DIMENSIONS = 64
NONZERO = 4            # of an index vector
WINDOW = 2             # neighbours on each side
HIDDEN = 32
EPOCHS = 40
BATCH = 64
RATE = 2e-3
DECAY = 1e-4
CALIBRATION = 5        # one row in so many fits the temperature
SEED = 20
SLICE = 500_000        # characters that a worker cuts into words at once
CHUNK = 100_000        # words that a worker counts at once
MOST_COUNTED = 1 << 26  # words after which counts go out, so that none of them leaves 32 bits

TOKEN = re.compile(r"\w+|[^\w\s]+")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries, (WORDS, NONZERO) each."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMENSIONS, (WORDS, NONZERO)), rng.choice(np.array([-1, 1]), (WORDS, NONZERO))


class Seen(dict):
    """Word -> its row of the word table, remembered."""

    def __missing__(self, word):
        self[word] = row = zlib.crc32(word.encode()) & (WORDS - 1)
        return row


class Words:
    """Texts to rows of the word table; remembers the words that a worker has seen."""

    def __init__(self):
        self.seen = Seen()

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words of the texts in order, and where each text begins (one more for the end)."""
        if len(self.seen) > 100_000:
            self.seen.clear()
        found = [TOKEN.findall(t) for t in texts]
        ends = np.cumsum([0] + [len(f) for f in found])
        return np.fromiter(map(self.seen.__getitem__, chain.from_iterable(found)), np.int64, int(ends[-1])), ends


def context_sums(docs: DataFrame) -> np.ndarray:
    """(WORDS, DIMENSIONS) whole numbers: for each word, the index vectors of itself and its neighbours, added up."""

    def run(batches):
        at, sign = index_vectors()
        # A row of counts has a slot per dimension for each sign, so that one unweighted count serves both.
        wide = 2 * DIMENSIONS
        slot = [np.ascontiguousarray(at[:, k] + DIMENSIONS * (sign[:, k] < 0)) for k in range(NONZERO)]
        words, counts, counted = Words(), np.zeros(WORDS * wide, np.int32), 0
        keys = np.empty(CHUNK * (2 * WINDOW + 1) * NONZERO, np.int64)

        def summed():
            each = counts.reshape(WORDS, 2, DIMENSIONS)
            return blocks((each[:, 0].astype(np.int64) - each[:, 1]).ravel(), 64)

        for batch in batches:
            for _, texts in text_slices(batch, SLICE):
                rows, ends = words.rows(texts)
                text, base = np.repeat(np.arange(len(texts)), np.diff(ends)), rows * wide
                for k in range(0, len(rows), CHUNK):  # bounded, also for one very long document
                    if counted > MOST_COUNTED:
                        yield summed()
                        counts[:], counted = 0, 0
                    counted += CHUNK
                    filled = 0
                    for shift in range(WINDOW + 1):
                        to = min(k + CHUNK, len(rows) - shift)
                        x, y = slice(k, max(to, k)), slice(k + shift, max(to, k) + shift)
                        inside = text[x] == text[y]
                        for a, b in ((x, y), (y, x))[:1 if shift == 0 else 2]:
                            first, second = base[a][inside], rows[b][inside]
                            for s in slot:
                                np.add(first, s[second], out=keys[filled:filled + len(first)])
                                filled += len(first)
                    np.add(counts, np.bincount(keys[:filled], minlength=len(counts)), out=counts, casting="unsafe")
        yield summed()

    sums = summed_blocks(docs.select("doc_id", "text").mapInArrow(run, "block int, data binary"), "int64")
    return (sums if len(sums) else np.zeros(WORDS * DIMENSIONS, np.int64)).reshape(WORDS, DIMENSIONS)


def word_table(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors; a word that no counted document holds keeps its index vector."""
    at, sign = index_vectors()
    values = sums.astype(np.float32)
    alone = np.flatnonzero(~sums.any(axis=1))
    for k in range(NONZERO):
        np.add.at(values, (alone, at[alone, k]), sign[alone, k])
    return values / np.maximum(np.linalg.norm(values, axis=1, keepdims=True), 1e-9)


def pooled(rows: np.ndarray, ends: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(documents, DIMENSIONS + 2) features."""
    n = np.diff(ends)
    mean = np.zeros((len(n), vectors.shape[1]), np.float64)
    for k in range(0, len(rows), 200_000):  # bounded, also for one very long document
        part = vectors[rows[k:k + 200_000]]
        first = np.searchsorted(ends, k, "right") - 1
        last = np.searchsorted(ends, k + len(part), "left")
        for d in range(first, last):
            if n[d]:
                mean[d] += part[max(int(ends[d]) - k, 0):max(int(ends[d + 1]) - k, 0)].sum(axis=0, dtype=np.float64)
    mean /= np.maximum(n, 1)[:, None]
    return np.hstack([mean, np.linalg.norm(mean, axis=1, keepdims=True), np.log1p(n)[:, None] / 10]).astype(np.float32)


class Network:
    """Two layers with tanh between them, trained with Adam on cross-entropy."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        fits = np.arange(len(y)) % CALIBRATION != 0
        self.temperature, self.constant = 1.0, None
        if len(np.unique(y[fits])) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x[fits].mean(axis=0), x[fits].std(axis=0) + 1e-6
        self.layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        self.train((x[fits] - self.mean) / self.scale, y[fits], rng)
        if not fits.all():
            z, t = self.logits(x[~fits]), y[~fits]
            options = np.geomspace(0.25, 8, 60)
            loss = [np.mean(np.logaddexp(0, np.where(t == 1, -z, z) / k)) for k in options]
            self.temperature = float(options[int(np.argmin(loss))])

    def train(self, x, y, rng):
        first, second = [np.zeros_like(w) for w in self.layers], [np.zeros_like(w) for w in self.layers]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for k in range(0, len(y), BATCH):
                rows, step = order[k:k + BATCH], step + 1
                w1, b1, w2, b2 = self.layers
                hidden = np.tanh(x[rows] @ w1 + b1)
                error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y[rows]) / len(rows)
                back = np.outer(error, w2) * (1 - hidden ** 2)
                slopes = [x[rows].T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ error + DECAY * w2, error.sum(keepdims=True)]
                for w, g, m, v in zip(self.layers, slopes, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def logits(self, x):
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, most=TRAIN_ROWS) -> DataFrame:
    """doc_id, text and label of the sample: at most `most` rows, those with equal id and text count once."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = known.where(~held_out(3, 1)).orderBy(F.xxhash64(F.col("doc_id"), F.lit(SEED)), "doc_id").limit(most)
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    keys = rows.select("doc_id", "t").join(F.broadcast(chosen), "doc_id").distinct()
    keys = keys.orderBy(F.xxhash64(F.col("doc_id"), F.col("t"), F.lit(SEED)), "doc_id", "t").limit(most)
    return rows.join(F.broadcast(keys), ["doc_id", "t"]).groupBy("doc_id", "t").agg(F.min("text").alias("text"), F.min("label").alias("label")).drop("t")


class Classifier:
    def __init__(self, vectors: np.ndarray, network: Network):
        self.vectors, self.network = vectors, network


def fit(docs: DataFrame, labels: DataFrame) -> Classifier:
    sample = stored(training_rows(docs, labels), "quality-sample")
    vectors = word_table(context_sums(docs.where(~held_out(3, 1))))
    shared = sample.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        words = Words()
        for batch in batches:
            for keys, texts in text_slices(batch, SLICE):
                x = pooled(*words.rows(texts), shared.value)
                yield pa.RecordBatch.from_arrays([keys, pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, x binary").collect()
    rows = sorted(rows, key=lambda r: (zlib.crc32(r.x), r.x, r.label))  # any fixed order that says nothing of the label
    x = np.array([np.frombuffer(r.x, np.float32) for r in rows], np.float64).reshape(len(rows), DIMENSIONS + 2)
    return Classifier(vectors, Network(x, np.array([r.label for r in rows], np.float64)))


def scored(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        words, use = Words(), shared.value
        for batch in batches:
            for keys, texts in text_slices(batch, SLICE):
                s = use.network.scores(pooled(*words.rows(texts), use.vectors).astype(np.float64))
                yield pa.RecordBatch.from_arrays([keys, pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: Classifier) -> DataFrame:
    """The rows of `docs`, all their columns, that the classifier takes for good."""
    shared, text_at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        words, use = Words(), shared.value
        for batch in batches:
            done = 0
            for keys, texts in text_slices(pa.RecordBatch.from_arrays([batch.column(text_at), batch.column(text_at)], ["k", "text"]), SLICE):
                good = use.network.scores(pooled(*words.rows(texts), use.vectors).astype(np.float64)) >= 0.5
                yield batch.slice(done, len(keys)).filter(pa.array(good))
                done += len(keys)

    return docs.mapInArrow(run, docs.schema)


@query("op7_quality_classifier")
def op7_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    model = fit(docs, table(spark, folder, "labels", "doc_id", "quality"))
    return scored(docs, model).select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
