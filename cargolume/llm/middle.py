"""Fill-in-middle: texts are cut in three by code points and written in another order between marker strings.

To find a cut, a text's code points have to be counted. Texts share passages, so they are cut into chunks by content: a
rolling hash over the last `WINDOW` bytes decides where a chunk ends, and equal passages give equal chunks wherever they
stand. A chunk's summary (code points that begin in it, whether it holds a marker, its first and last bytes) is kept in
a cache by content; a hit is verified byte by byte. Summaries of a text's chunks add up: sums of counts tell which chunk
a cut falls in, and only that chunk is looked into. A marker across chunks shows in their ends. The cache is held in
bounds by bytes and ends with its task.

Python gets the texts and gives back three numbers and a flag for each; forms, pieces, output and the way back are
column expressions. Nothing is shuffled.

Defined results: a null text is empty; an empty text is plain; a text that holds a marker is plain, whatever its draw; a
null id draws as the empty string does; rows with equal doc_id draw alike; a very long text is chunked in blocks of
`BLOCK` bytes and cut the same way; an empty table gives no rows.
"""

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import query, table

# Markers of prefix, suffix and middle; percent of texts that are cut, and of those in the spm form.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_PERCENT, SPM_PERCENT = 90, 20
SEED = "1"

WINDOW = 16           # bytes, a power of two
CHUNK_BITS = 8        # chunks of 2^8 bytes on average beyond the least
LEAST, MOST = 64, 4096
BLOCK = 1 << 20
CACHE_BYTES = 16 << 20
ODD = 0x9E3779B97F4A7C15

CONTINUATION = bytes(range(0x80, 0xC0))


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks of a text: where the rolling hash of the last WINDOW bytes is 0 in its top CHUNK_BITS.

    An end depends on the bytes since the chunk's beginning only: the hash's window, LEAST and MOST.
    """
    found = []
    for start in range(0, len(data), BLOCK):
        low = max(0, start - WINDOW + 1)
        h = np.frombuffer(data, np.uint8, min(start + BLOCK, len(data)) - low, low).astype(np.uint64) + np.uint64(1)
        size, factor = 1, ODD
        while size < WINDOW:  # hashes of windows twice as long, from two halves
            h[size:] += h[:-size] * np.uint64(factor)
            size, factor = 2 * size, factor * factor % 2**64
        h = (h ^ (h >> np.uint64(29))) * np.uint64(ODD)
        hits = np.flatnonzero(h >> np.uint64(64 - CHUNK_BITS) == 0) + low + 1
        found.append(hits[hits > start])
    ends, last = [], 0
    for hit in (np.concatenate(found).tolist() if found else []):
        while hit - last > MOST:
            last += MOST
            ends.append(last)
        if hit - last >= LEAST:
            ends.append(hit)
            last = hit
    while len(data) - last > MOST:
        last += MOST
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


class Chunks:
    """Summaries by content: (code points that begin in the chunk, whether it holds a marker)."""

    def __init__(self, markers: tuple[str, ...]):
        self.marker = re.compile(b"|".join(re.escape(m.encode()) for m in markers))
        self.reach = max(len(m.encode()) for m in markers) - 1
        self.cache, self.held = {}, 0

    def summary(self, chunk: bytes) -> tuple[int, bool]:
        key = xxhash.xxh3_64_intdigest(chunk)
        known = self.cache.get(key)
        if known is not None and known[0] == chunk:  # another chunk may have the same hash
            return known[1]
        made = len(chunk.translate(None, CONTINUATION)), self.marker.search(chunk) is not None
        if known is None:
            if self.held > CACHE_BYTES:
                self.cache.clear()
                self.held = 0
            self.cache[key] = chunk, made
            self.held += len(chunk) + 200
        return made

    def cut(self, data: bytes, h1: int, h2: int) -> tuple[int, int, int, int, int, bool]:
        """Code points of the text; those before either cut; bytes before either cut; whether the text holds a marker."""
        ends = boundaries(data)
        starts = [0, *ends[:-1]]
        found = [self.summary(data[a:b]) for a, b in zip(starts, ends)]
        marked = any(m for _, m in found) or any(self.marker.search(data, max(e - self.reach, 0), e + self.reach) for e in ends[:-1])
        upto = list(accumulate((n for n, _ in found), initial=0))
        n = upto[-1]
        first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
        return n, first, second, *(self.place(data, starts, ends, upto, c) for c in (first, second)), marked

    @staticmethod
    def place(data: bytes, starts: list[int], ends: list[int], upto: list[int], count: int) -> int:
        """The byte at which code point `count` begins; the text's end for the last."""
        if count == upto[-1]:
            return len(data)
        k = bisect_right(upto, count) - 1
        begins = np.flatnonzero(np.frombuffer(data, np.uint8, ends[k] - starts[k], starts[k]) & 0xC0 != 0x80)
        return starts[k] + int(begins[count - upto[k]])


def draw(k: int, seed=SEED) -> Column:
    """The k-th group of 8 hex digits of the hash of seed and id, as a whole number."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def placed(docs: DataFrame, markers=(PREFIX, SUFFIX, MIDDLE), seed=SEED) -> DataFrame:
    """doc_id, text (as bytes), draws h3 and h4, n, code points and bytes before either cut, and `marked`."""

    def run(batches):
        chunks = Chunks(markers)
        for batch in batches:
            rows = []
            for text, h1, h2 in zip(batch.column("text"), batch.column("h1").to_pylist(), batch.column("h2").to_pylist()):
                rows.append(chunks.cut(text.as_py(), h1, h2))
            made = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), batch.column("h3"), batch.column("h4"),
                 *[pa.array(x, pa.int64()) for x in made[:5]], pa.array(made[5], pa.bool_())],
                ["doc_id", "text", "h3", "h4", "n", "first", "second", "at", "to", "marked"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"), *[draw(k, seed).alias(f"h{k}") for k in (1, 2, 3, 4)])
    return rows.mapInArrow(run, f"doc_id {kind}, text binary, h3 long, h4 long, n long, first long, second long, at long, to long, marked boolean")


def fill_in_middle(docs: DataFrame, seed=SEED, cut_percent=CUT_PERCENT, spm_percent=SPM_PERCENT) -> DataFrame:
    """doc_id, n, form (plain, psm or spm), prefix_chars and middle_chars (null: plain) and `output`, the new text."""
    d = placed(docs, seed=seed)
    plain = (F.col("n") == 0) | F.col("marked") | (F.col("h3") % 100 >= cut_percent)
    d = d.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm"))

    def piece(start, size):
        return F.substring(F.col("text"), (start + 1).cast("int"), size.cast("int"))

    def mark(m):
        return F.lit(m).cast("binary")

    at, to = F.col("at"), F.col("to")
    p, m, s = piece(F.lit(0), at), piece(at, to - at), piece(to, F.octet_length("text") - to)
    output = F.when(F.col("form") == "plain", F.col("text")).when(
        F.col("form") == "psm", F.concat(mark(PREFIX), p, mark(SUFFIX), s, mark(MIDDLE), m)).otherwise(
        F.concat(mark(SUFFIX), s, mark(PREFIX), p, mark(MIDDLE), m))
    cut = F.col("form") != "plain"
    return d.select("doc_id", "n", "form", F.when(cut, F.col("first")).alias("prefix_chars"),
                    F.when(cut, F.col("second") - F.col("first")).alias("middle_chars"), output.cast("string").alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text from which `output` was made. Texts that are cut hold no marker, so the markers tell the pieces."""
    pieces = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # before the first marker there is nothing
    psm, spm = F.concat(F.get(pieces, F.lit(1)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(2))), F.concat(F.get(pieces, F.lit(2)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


@query("op11_fill_in_middle", SQL)
def op11_fill_in_middle(spark, folder):
    made = fill_in_middle(table(spark, folder, "documents", "doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))
