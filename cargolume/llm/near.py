"""Near duplicates: an exact n-gram Jaccard join on word shingles, and the components of its links.

Texts with equal shingle sets are one node. Two nodes of Jaccard similarity 0.75 or more share a token of their
prefixes: the first quarter (and one) of their shingles in any order that is common to all. The order here puts
shingles last that are frequent in the corpus, by a count sketch of fixed size over all documents, and is random
otherwise. So a passage that many documents share makes no bucket.

1. One pass writes node, size and hashed bitmap of every document, and the sketch.
2. Tokens that occur once are found by merging packed sorted blocks, and dropped before anything is joined.
3. Hubs: in each bucket (token and size band) every node meets the most central node only. Verified links give
   components, so a group of thousands of copies is joined by that many pairs.
4. Tiles: where a bucket still holds several components, its nodes are compared by size and bitmap. Buckets of more
   than `TILE` rows are laid out in size-banded tiles (a band and the next), and those again in pairs of blocks. Only
   pairs of different components are compared.

Pairs of 3 and 4 are screened by bitmaps: every bit set in one only is a shingle that the other lacks, which bounds the
overlap from above. At two bits and more a shingle, few pairs pass that share less than three quarters of either. What is
left is verified on sorted arrays of all shingles. Nothing is dropped but by those bounds.

Defined results: words as in `common.WORD` with A-Z in lower case; a text of one to four words has one shingle; null,
empty and blank texts have none and link with nothing; rows with equal doc_id are separate texts, as are those with
a null id; null ids count in no component's smallest id, unless all are null; a very long text is one set like any other;
an empty table gives no rows.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import discard, pack_repeats, query, repeated_tokens, stored, summed_blocks, table, text_slices

SHINGLE = 5
PERCENT = 75
SKETCH_BITS = 20
SKETCH_BLOCKS = 256
LEAST_BITS, MOST_BITS = 512, 16384
TILE = 512
HUBS = 2             # hubs that a node is verified against
BLOCK_TOKENS = 1 << 16

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Bytes of a word -> 64-bit hash, remembered."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def shingles(text: str, hashes: WordHashes) -> np.ndarray:
    """The text's distinct shingles as sorted 64-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: lowers A-Z, splits at ASCII white space
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = out * ODD + h[k:len(h) - size + 1 + k]
    return np.unique(mixed(out))


def node_of(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def width(n: int) -> int:
    """Bits of the bitmap of a set of n shingles: sets of one size band have the same width, or the next."""
    return min(max(LEAST_BITS, 2 << (n - 1).bit_length()), MOST_BITS) if n else LEAST_BITS


def bitmap(s: np.ndarray) -> bytes:
    size = width(len(s))
    bits = np.zeros(size, bool)
    bits[(s % np.uint64(size)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(x: int, size: int, to: int) -> int:
    """A bitmap of `size` bits brought down to `to`: the hash's low bits stay its place."""
    while size > to:
        size //= 2
        x = (x & ((1 << size) - 1)) | (x >> size)
    return x


def may_link(n: int, x: int, m: int, y: int) -> bool:
    """Whether bitmaps x and y of sets of n and m shingles allow the similarity.

    A bit set on one side only is a shingle that the other side lacks.
    """
    wide, narrow = width(n), width(m)
    if wide != narrow:
        to = min(wide, narrow)
        x, y = folded(x, wide, to), folded(y, narrow, to)
    most = min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count())
    return (100 + PERCENT) * most >= PERCENT * (n + m)  # 100 * overlap >= 75 * (n + m - overlap)


def prefix(s: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
    """Tokens (top `bits` of the hash) of the shingles that come first in the common order."""
    late = frequent[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    ordered = np.concatenate([s[~late], s[late]])
    return (ordered[:len(s) - -(-PERCENT * len(s) // 100) + 1] >> np.uint64(64 - bits)).astype(np.int64)


def text_hash() -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


SIGNED = ["doc_id", "t", "node", "n", "bitmap", "block", "data"]


def signed(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, t, node, n, bitmap) of every document, stored; and which sketch cells are frequent."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes, counts, id_type = WordHashes(), np.zeros(1 << SKETCH_BITS, np.int64), None
        for batch in batches:
            id_type = batch.schema.field(0).type
            at = 0
            for keys, texts in text_slices(batch):
                sets = [shingles(x, hashes) for x in texts]
                counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                none = pa.nulls(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [keys, batch.column(2).slice(at, len(texts)), pa.array([node_of(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                     pa.array([bitmap(s) for s in sets], pa.binary()), none.cast(pa.int32()), none.cast(pa.binary())], SIGNED)
                at += len(texts)
        if id_type is not None:
            parts = counts.reshape(SKETCH_BLOCKS, -1)
            none = pa.nulls(len(parts))
            yield pa.RecordBatch.from_arrays(
                [none.cast(id_type), none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.int32()), none.cast(pa.binary()),
                 pa.array(range(len(parts)), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], SIGNED)

    schema = f"doc_id {kind}, t long, node binary, n int, bitmap binary, block int, data binary"
    rows = stored(docs.select("doc_id", "text", text_hash().alias("t")).mapInArrow(run, schema), "near-signatures")
    counts = summed_blocks(rows.where("block IS NOT NULL").select("block", "data"), "int64")
    mean = counts.mean() if len(counts) else 0.0
    frequent = counts > mean + 6 * math.sqrt(mean) + 16 if len(counts) else np.zeros(1 << SKETCH_BITS, bool)
    return rows.where("block IS NULL").select(*SIGNED[:5]), frequent


def tokens_of(docs: DataFrame, shared, block_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(node, n, tokens): every document's set and prefix; the tokens that two documents have at least; the table of both."""
    bits, names = 32 + block_bits, ["node", "n", "tokens", "block", "data"]

    def packed(held):
        rows = pack_repeats(held)
        none = pa.nulls(len(rows))
        return pa.RecordBatch.from_arrays([none.cast(pa.binary()), none.cast(pa.int32()), none.cast(pa.list_(pa.int64())), rows.column(0), rows.column(1)], names)

    def run(batches):
        hashes, held, size = WordHashes(), [], 0
        for batch in batches:
            for _, texts in text_slices(batch):
                sets = [s for s in (shingles(x, hashes) for x in texts) if len(s)]
                if not sets:
                    continue
                tokens = [prefix(s, shared.value, bits) for s in sets]
                offsets, none = pa.array(np.cumsum([0] + [len(x) for x in tokens]).astype(np.int32)), pa.nulls(len(sets))
                flat = np.concatenate(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                     pa.ListArray.from_arrays(offsets, pa.array(flat)), none.cast(pa.int32()), none.cast(pa.binary())], names)
                held.append(flat)
                size += len(flat)
                if size > 2_000_000:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    rows = stored(docs.select("doc_id", "text").mapInArrow(run, "node binary, n int, tokens array<long>, block int, data binary"), "near-prefixes")
    return rows.where("block IS NULL").select("node", "n", "tokens"), repeated_tokens(rows.where("block IS NOT NULL").select("block", "data")), rows


def fits(a: str, b: str):
    """Whether two sizes allow the similarity at all."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def screened(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose bitmaps allow the similarity."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bitmap").alias("bits_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bitmap").alias("bits_b"))

    def run(batches):
        for batch in batches:
            n, x, m, y = (batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b"))
            keep = [may_link(i, int.from_bytes(u, "little"), j, int.from_bytes(v, "little")) for i, u, j, v in zip(n, x, m, y)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a binary, b binary")


def packed_texts(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """node and compressed text of the nodes in `pairs`, stored; `nodes` names a document (doc_id, t) for each."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    nodes = nodes.join(wanted, "node").select("node", "of.doc_id", "of.t")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            at = 0
            for keys, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays([keys, batch.column(2).slice(at, len(texts)), pa.array([press.compress(x.encode("utf-8", "surrogatepass")) for x in texts], pa.binary())], ["t_id", "t_t", "packed"])
                at += len(texts)

    texts = docs.select(F.col("doc_id").alias("t_id"), "text", text_hash().alias("t_t")).mapInArrow(pack, f"t_id {kind}, t_t long, packed binary")
    met = texts.join(nodes, F.col("t_id").eqNullSafe(F.col("doc_id")) & (F.col("t_t") == F.col("t"))).select("node", "packed")
    return stored(met.dropDuplicates(["node"]), "near-texts")  # rows of equal id and text


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets have the similarity, by exact intersection; stored."""
    pairs = stored(pairs, "near-pairs")
    texts = packed_texts(docs, nodes, pairs)

    def run(batches):
        hashes, unpack, sets = WordHashes(), zstandard.ZstdDecompressor(), {}

        def set_of(node, packed):
            if node not in sets:
                if len(sets) > 200:
                    sets.clear()
                sets[node] = shingles(unpack.decompress(packed).decode("utf-8", "surrogatepass"), hashes)
            return sets[node]

        for batch in batches:
            for k in range(0, len(batch), 500):
                part, keep = batch.slice(k, 500), []
                for a, b, p, q in zip(*(c.to_pylist() for c in part.columns)):
                    x, y = set_of(a, p), set_of(b, q)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = texts.select(F.col("node").alias("a"), F.col("packed").alias("p"))
    b = texts.select(F.col("node").alias("b"), F.col("packed").alias("q"))
    met = pairs.join(a, "a").join(b, "b").select("a", "b", "p", "q")
    links = stored(met.mapInArrow(run, "a binary, b binary"), "near-links")
    discard(pairs, texts)
    return links


def components(links: DataFrame) -> DataFrame:
    """node and comp (the component's smallest node) of every node with a link, by min-label steps and jumps."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "near-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "near-labels")
    while True:
        old = labels.select("node", "comp")
        near = both.join(old, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("next"))
        new = old.join(near, F.col("node") == F.col("a")).select("node", F.col("comp").alias("was"), F.least("comp", "next").alias("comp"))
        jump = old.select(F.col("node").alias("j"), F.col("comp").alias("jump"))
        new = new.join(jump, F.col("comp") == F.col("j")).select("node", "was", F.least("comp", "jump").alias("comp"))
        labels = stored(new, "near-labels")
        if labels.where(F.col("was") != F.col("comp")).limit(1).count() == 0:
            return labels.select("node", "comp")


def hub_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): each node with the hubs of most of its buckets.

    A bucket's hub is its most central node, the one whose tokens are shared most. In a group of near copies that is
    the text they come from, or the least changed one, so that most of the group links to it.
    """
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    met = rows.join(shared, "token")
    central = met.groupBy("node").agg(F.sum("k").alias("weight"))
    banded = stored(met.join(central, "node").select("token", band("n").alias("band"), "node", "weight"), "near-buckets")
    hubs = banded.groupBy("token", "band").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    met = banded.join(hubs, ["token", "band"]).where(F.col("node") != F.col("hub"))
    counted = met.groupBy("node", "hub").agg(F.count(F.lit(1)).alias("k"))
    best = counted.groupBy("node").agg(F.slice(F.sort_array(F.collect_list(F.struct("k", "hub")), asc=False), 1, HUBS).alias("best"))
    return best.select(F.explode("best").alias("x"), "node").select(F.col("x.hub").alias("a"), F.col("node").alias("b"))


def band(size: str):
    """Sizes in one or adjacent bands allow the similarity; others don't."""
    return F.floor(F.log(F.col(size)) / math.log(100 / PERCENT) + 1e-9).cast("int")


def open_rows(rows: DataFrame) -> DataFrame:
    """The rows of buckets with several components, with the bucket's size and the node's band; stored.

    `at` is the token's place in the node's order. A link's first common token leaves n - at shingles to share at most, so
    a row goes for which that is too little even with the bucket's smallest node; it is not the first of any link.
    """
    buckets = rows.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("n").alias("least"))
    buckets = buckets.where(F.col("low") != F.col("high")).select("token", "rows", "least")
    met = rows.join(buckets, "token").where((100 + PERCENT) * (F.col("n") - F.col("at")) >= PERCENT * (F.col("n") + F.col("least"))).drop("least")
    return stored(met.withColumn("own", band("n")), "near-open")


def tile_pairs(open_: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that share a token, where sizes and bitmaps allow the similarity.

    A bucket of up to TILE rows is one tile. A larger one is dealt to a tile for each size band, with the nodes of the
    band as owners and those of the next as guests; and a tile that is still larger is cut into blocks by node, every
    pair of blocks being a tile of its own.
    """
    whole = F.array(F.struct(F.lit(-1).alias("tile"), F.lit(True).alias("owner")))
    banded = F.array(F.struct(F.col("own").alias("tile"), F.lit(True).alias("owner")), F.struct((F.col("own") - 1).alias("tile"), F.lit(False).alias("owner")))
    tiled = open_.select("token", "rows", "node", "n", "at", "comp", F.explode(F.when(F.col("rows") <= TILE, whole).otherwise(banded)).alias("x"))
    tiled = tiled.select("token", "rows", "node", "n", "at", "comp", "x.*")
    small = tiled.where("tile = -1").select("token", "tile", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "owner", "n", "node", "comp", "at")
    large = tiled.where("tile <> -1")
    cuts = large.groupBy("token", "tile").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("cuts"))
    large = large.join(cuts, ["token", "tile"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), lambda j: F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j")))
    large = large.select("token", "tile", "block", "owner", "n", "node", "comp", "at", F.explode(others).alias("x")).select(
        "token", "tile", "x.i", "x.j", "block", "owner", "n", "node", "comp", "at")
    bits = nodes.select(F.col("node").alias("b_node"), "bitmap")
    key = ["token", "tile", "i", "j"]
    tiles = small.unionByName(large).join(bits, F.col("node") == F.col("b_node")).drop("b_node")

    def pairs_of(group):
        """Of rows (i, j, block, owner, n, node, comp, at, bitmap), by size. What follows the first common token bounds the overlap."""
        group.sort(key=lambda r: r[4])
        crossed = group[0][0] != group[0][1]
        for k, (_, _, block, owner, n, node, comp, at, bits) in enumerate(group):
            for _, _, block2, owner2, m, node2, comp2, at2, bits2 in group[k + 1:]:
                if 100 * n < PERCENT * m:
                    break
                if comp != comp2 and (100 + PERCENT) * min(n - at, m - at2) >= PERCENT * (n + m) and (owner or owner2) and (not crossed or block != block2) and may_link(n, bits, m, bits2):
                    yield (node, node2) if node < node2 else (node2, node)

    def as_batch(found):
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())], ["a", "b"])

    def run(batches):
        held, out, now = [], set(), None
        for batch in batches:
            for k in range(0, len(batch), 2_000):
                for token, tile, *row in zip(*(c.to_pylist() for c in batch.slice(k, 2_000).columns)):
                    if (token, tile, row[0], row[1]) != now:
                        if len(held) > 1:
                            out.update(pairs_of(held))
                        held, now = [], (token, tile, row[0], row[1])
                        if len(out) > 50_000:
                            yield as_batch(list(out))
                            out = set()
                    row[8] = int.from_bytes(row[8], "little")
                    held.append(row)
        if len(held) > 1:
            out.update(pairs_of(held))
        yield as_batch(list(out))

    return tiles.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a binary, b binary").distinct()


def linked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, n) of every document, and (node, comp) of every node with a link."""
    spark = docs.sparkSession
    signatures, frequent = signed(docs)
    shared = spark.sparkContext.broadcast(frequent)
    total = signatures.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    block_bits = max(2, math.ceil(math.log2(max(total // 4, 1) / BLOCK_TOKENS + 1)))
    nodes = stored(signatures.where("n > 0").groupBy("node").agg(
        F.min("n").alias("n"), F.min(F.struct("doc_id", "t")).alias("of"), F.min("bitmap").alias("bitmap")), "near-nodes")
    tokens, again, both = tokens_of(docs, shared, block_bits)
    met = tokens.select("node", "n", F.posexplode("tokens").alias("at", "token")).join(again, "token")
    rows = stored(met.groupBy("token", "node").agg(F.min("n").alias("n"), F.min("at").alias("at")), "near-rows")
    discard(both)
    links = verified(screened(hub_pairs(rows), nodes), nodes, docs)
    first = components(links).withColumnRenamed("node", "c_node")
    placed = rows.join(first, F.col("node") == F.col("c_node"), "left").select("token", "node", "n", "at", F.coalesce("comp", "node").alias("comp"))
    placed = stored(placed, "near-placed")
    discard(rows)
    open_ = open_rows(placed)
    discard(placed)
    more = verified(tile_pairs(open_, nodes), nodes, docs)
    discard(open_)
    return signatures.select("doc_id", "node", "n"), components(links.union(more))


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links reach)."""
    signatures, comps = linked(docs)
    comps = comps.withColumnRenamed("node", "c_node")
    group = F.coalesce("comp", "node")
    by_node = signatures.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    by_node = by_node.join(comps, F.col("node") == F.col("c_node"), "left").select("node", group.alias("comp"), "doc_id")
    smallest = by_node.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = by_node.join(smallest, "comp").select(F.col("node").alias("m_node"), "component_id")
    return signatures.join(named, F.col("node") == F.col("m_node"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


@query("op8_ngram_jaccard")
def op8_ngram_jaccard(spark, folder):
    return near_groups(table(spark, folder, "documents", "doc_id", "text"))
