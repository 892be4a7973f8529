"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; runs of one to three code points are hashed to `GRAMS` features. A feature's value is its
share of the text's n-grams times its inverse document frequency, which is counted over every document that may be
learnt from. Training is online: follow-the-regularised-leader with elastic-net penalties, one document at a time,
streamed from a stored sample of at most `TRAIN_PER_LANG` documents of each language (smallest seeded hashes of id and
text; rows with equal id and text count once). The L1 penalty keeps weights at exactly zero unless a feature earns them. Logits are divided by a temperature fitted on
rows that training did not see.

Scoring adds up weights over the n-grams of a text, so a text's length costs time but no memory beyond a slice.

Defined results: a text that is null or has no letter is `und` with score 0, as is every text if nothing could be
learnt; with one known language that language has score 1; rows with equal doc_id are judged one by one; an empty
table gives no rows.
"""

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume.llm.common import blocks, held_out, query, stored, summed_blocks, table, text_slices

GRAMS = 1 << 16
ORDERS = 3
TRAIN_PER_LANG = 1_500
EPOCHS = 3
SCALE = 50.0                            # of feature values, which are shares
ALPHA, BETA, L1, L2 = 0.2, 1.0, 0.05, 1e-3
CALIBRATION = 5                         # one row in so many fits the temperature
SEED = 2

# Odd multipliers of the hash, one for each order of n-gram.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
LETTER = regex.compile(r"\p{L}")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-gram features of the texts, and the text each belongs to."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in lowered])
    features, owners = [], []
    for order in range(1, ORDERS + 1):
        n = len(codes) - order + 1
        if n <= 0:
            break
        h = np.zeros(n, np.uint32)
        for k in range(order):
            h = (h ^ codes[k:k + n]) * np.uint32(MULTIPLIERS[k])
            h ^= h >> np.uint32(15)
        h = (h * np.uint32(MULTIPLIERS[order - 1])) >> np.uint32(16)
        inside = text[:n] == text[order - 1:]
        features.append(h[inside].astype(np.int32))
        owners.append(text[:n][inside])
    if not features:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(features), np.concatenate(owners)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each feature, and how many documents there are."""

    def run(batches):
        counts = np.zeros(GRAMS + 1024, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch, 400_000):
                feature, owner = grams(texts)
                there = np.zeros((min(len(texts), 256), GRAMS), bool)
                for k in range(0, len(texts), 256):
                    there[:] = False
                    part = (owner >= k) & (owner < k + 256) if len(texts) > 256 else slice(None)
                    there[owner[part] - k, feature[part]] = True
                    counts[:GRAMS] += there.sum(axis=0)
                counts[GRAMS] += len(texts)
        yield blocks(counts, 65)

    sums = summed_blocks(docs.select("doc_id", "text").mapInArrow(run, "block int, data binary"), "int64")
    return (sums[:GRAMS], int(sums[GRAMS])) if len(sums) else (np.zeros(GRAMS, np.int64), 0)


def draws(docs: DataFrame) -> DataFrame:
    """lang, text and the seeded draw of every row with a language: a hash of id and text."""
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit(SEED)), 1)
    return docs.where(F.col("lang").isNotNull()).select("lang", "text", draw.alias("draw"))


def training_rows(docs: DataFrame, most=TRAIN_PER_LANG) -> DataFrame:
    """draw, lang and the counts of features of at most `most` documents a language."""
    ids = stored(draws(docs).select("lang", "draw").distinct(), "language-draws")
    # Cells of draws grow in width with the draw (eight for each power of two), so the last one needed holds about a tenth
    # of `most`, whatever the input: what is ranked by language is little more than what is kept.
    ids = ids.withColumn("cell", F.floor(F.log2(F.col("draw") + F.lit(1.0)) * 8).cast("int"))
    counts = ids.groupBy("lang", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("cell")) - F.col("n")
    cells = counts.withColumn("before", before).where(F.col("before") < most).select("lang", "cell")
    ids = ids.join(F.broadcast(cells), ["lang", "cell"])
    ids = ids.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).where(F.col("place") <= most)

    def run(batches):
        for batch in batches:
            for keys, texts in text_slices(batch, 400_000):
                feature, owner = grams(texts)
                ends = np.searchsorted(np.sort(owner), np.arange(len(texts) + 1))
                feature = feature[np.argsort(owner, kind="stable")]
                rows = [np.unique(feature[a:b], return_counts=True) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_pydict({
                    "key": keys, "features": [i.astype(np.int32).tobytes() for i, _ in rows], "counts": [c.astype(np.int32).tobytes() for _, c in rows]})

    sample = draws(docs).join(F.broadcast(ids.select("lang", "draw")), ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    rows = sample.select(F.to_json(F.struct("draw", "lang")).alias("key"), "text").mapInArrow(run, "key string, features binary, counts binary")
    return rows.select(F.from_json("key", "draw long, lang string").alias("k"), "features", "counts").select("k.*", "features", "counts")


class Model:
    """Weights by feature and language, trained row by row."""

    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf, self.temperature = langs, idf, 1.0
        self.z, self.n = np.zeros((GRAMS, len(langs))), np.zeros((GRAMS, len(langs)))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def values(self, features, counts):
        return SCALE * counts / counts.sum() * self.idf[features]

    def learn(self, features, counts, label: int):
        x, w = self.values(features, counts), self.weights(features)
        p = softmax(x @ w)
        p[label] -= 1
        g = np.outer(x, p)
        n = self.n[features]
        self.z[features] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[features] = n + g * g

    def finish(self) -> "Model":
        """What scoring needs: weights times idf, in single precision."""
        self.table = (SCALE * self.idf[:, None] * self.weights(slice(None))).astype(np.float32)
        del self.z, self.n
        return self

    def probabilities(self, texts: list[str]) -> np.ndarray:
        feature, owner = grams(texts)
        total = np.zeros((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            total[:, j] = np.bincount(owner, self.table[feature, j], len(texts))
        count = np.bincount(owner, minlength=len(texts))
        return softmax(total / np.maximum(count, 1)[:, None] / self.temperature)


def softmax(z):
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(docs: DataFrame) -> Model | None:
    """A model of the languages in `docs` (doc_id, text, lang); None if there is none."""
    rows = stored(training_rows(docs), "language-sample")
    rows = rows.orderBy("draw", "lang")
    langs = sorted(r.lang for r in rows.select("lang").distinct().collect())
    if not langs:
        return None
    frequency, total = document_frequencies(docs)
    model = Model(langs, np.log((1 + total) / (1 + frequency)) + 1)
    place = {lang: k for k, lang in enumerate(langs)}
    kept = []
    for epoch in range(EPOCHS):
        for k, r in enumerate(rows.toLocalIterator()):
            features, counts = np.frombuffer(r.features, np.int32), np.frombuffer(r.counts, np.int32)
            if not len(features):
                continue
            if k % CALIBRATION:
                model.learn(features, counts, place[r.lang])
            elif epoch == EPOCHS - 1:
                kept.append((features, counts, place[r.lang]))
    logits = np.array([model.values(f, c) @ model.weights(f) for f, c, _ in kept]).reshape(len(kept), len(langs))
    if kept:
        labels = np.array([y for _, _, y in kept])
        options = np.geomspace(0.25, 8, 60)
        loss = [-np.mean(np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12))) for t in options]
        model.temperature = float(options[int(np.argmin(loss))])
    return model.finish()


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for keys, texts in text_slices(batch, 400_000):
                langs, scores = ["und"] * len(texts), [0.0] * len(texts)
                written = [i for i, t in enumerate(texts) if LETTER.search(t)]
                if shared.value is not None and written:
                    p = shared.value.probabilities([texts[i] for i in written])
                    for i, best, s in zip(written, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                        langs[i], scores[i] = shared.value.langs[best], min(s, 1.0)
                yield pa.RecordBatch.from_arrays([keys, pa.array(langs), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


@query("op2_language_id")
def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    model = fit(docs.where(~held_out(5, 0) & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    return identified(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "lang_pred", "score")
