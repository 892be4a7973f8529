"""Suffix-array dedup: bytes that lie in a string of `LENGTH` bytes which also starts elsewhere.

A longest-previous-factor array says for every position how long a match begins there that also begins earlier. In
suffix order that match is with the nearest smaller position before or after (`previous_factors`); longest next factors
come likewise from larger positions. Only matches of LENGTH bytes count here, so suffixes are cut at LENGTH bytes, and
shorter matches are not followed. A position begins a repeated string if its previous or next factor reaches LENGTH,
and holds the first occurrence if its previous factor does not.

The suffix array is built in parts that cannot share a run. Every window of LENGTH bytes names an anchor: its leftmost
64-byte gram of least hash. Equal windows have equal anchors, so windows are dealt by anchor.

1. Equal texts are found by digest; all but one of each go through no further step.
2. Anchors that occur once are found by merging packed sorted blocks, and dropped.
3. The windows of one anchor form a context (the bytes they cover). Contexts are compared by digest first; only where
   one anchor has several contexts are their bytes gathered, and factors taken over their windows in suffix order.
4. An anchor with more than `MOST` contexts is dealt again by hashes of its windows: repeated ones are found by merging
   packed blocks and joined back, so that no task gets all its contexts.

`keep="none"` removes every occurrence of a repeated string, `keep="first"` keeps the bytes of the first.

Defined results: texts are UTF-8 bytes, a null text has none; matches do not cross documents; what is repeated is
judged on the input; rows with equal doc_id and text are two occurrences; null ids count as smallest; an empty table
gives no rows. Windows beyond `MOST` are compared by 128-bit hashes.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import discard, query, stored, stored_tokens, table, text_slices

LENGTH = 200
GRAM = 64            # a power of two
MOST = 2_000         # contexts of one anchor whose windows one task sorts
PART = 1 << 19       # window starts handled at once
WINDOWS = 20_000     # windows sorted at once
BLOCK_TOKENS = 1 << 16

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_values() -> np.ndarray:
    x = (np.arange(1, 257, dtype=np.uint64) * ODD)
    return (x ^ (x >> np.uint64(31))) * MIX


BYTES = byte_values()


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each gram, by doubling."""
    h, size, factor = BYTES[data], 1, ODD
    while size < GRAM:
        h = h[:-size] * factor + h[size:]
        size, factor = 2 * size, factor * factor + np.uint64(2)
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def least(keys: np.ndarray, span: int) -> np.ndarray:
    """For each place, where the leftmost least key of the next `span` stands."""
    low, at, size = keys, np.arange(len(keys), dtype=np.int32), 1
    while size < span:
        step = min(size, span - size)
        later = low[step:] < low[:len(low) - step]
        at = np.where(later, at[step:], at[:len(at) - step])
        low = np.where(later, low[step:], low[:len(low) - step])
        size += step
    return at


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in concatenated texts that end at `ends`: first start, count, token."""
    found = []
    for a in range(0, len(data) - LENGTH + 1, PART):
        part = data[a:a + PART + LENGTH - 1]
        h = gram_hashes(part)
        at = least((h >> np.uint64(32)).astype(np.uint32), LENGTH - GRAM + 1)
        start = np.arange(a, a + len(at))
        text_end = ends[np.searchsorted(ends, start, "right")]
        inside = start + LENGTH <= text_end
        start, at, text_end = start[inside], at[inside], text_end[inside]
        if len(start):
            first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (text_end[1:] != text_end[:-1])])
            found.append((start[first], np.diff(np.r_[first, len(start)]), (h[at[first]] >> np.uint64(1)).astype(np.int64)))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])


def per_text(start: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cuts into runs by text: len(ends) + 1 places."""
    return np.r_[np.searchsorted(start, np.r_[0, ends[:-1]]), len(start)] if len(ends) else np.zeros(1, np.int64)


def encoded(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and t, which tells texts of one id apart."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))


def anchors_of(docs: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(k, tokens): every text's anchors, each twice at most; the anchors that stand somewhere else too; the table of both."""
    def tokens_of(texts):
        data, ends = joined(encoded(texts))
        start, _, token = anchors(data, ends)
        cuts = per_text(start, ends)
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            x = np.sort(token[a:b] >> (63 - bits))
            more = np.zeros(len(x), bool)
            more[2:] = x[2:] == x[:-2]
            out.append(x[~more])
        return out

    return stored_tokens(docs.select(F.struct("doc_id", "t").alias("k"), "text"), lambda: tokens_of, "repeat-tokens")


def key_type(docs: DataFrame) -> str:
    return f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},t:bigint>"


def with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (doc_id, t, tokens) with the packed text of each; stored."""
    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for keys, texts in text_slices(batch):
                yield pa.RecordBatch.from_arrays([keys, pa.array([press.compress(t) for t in encoded(texts)], pa.binary())], ["k", "packed"])

    long = docs.where(F.octet_length("text") >= LENGTH)
    texts = long.select(F.struct("doc_id", "t").alias("k"), "text").mapInArrow(pack, f"k {key_type(docs)}, packed binary")
    texts = texts.select(F.col("k.doc_id").alias("x_id"), F.col("k.t").alias("x_t"), "packed")
    met = wanted.join(texts, F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("t") == F.col("x_t")))
    return stored(met.select("doc_id", "t", "tokens", "packed").dropDuplicates(["doc_id", "t"]), "repeat-texts")


def rows_of(batches, step=100):
    """Rows of Arrow batches as Python values, a few at a time."""
    for batch in batches:
        for k in range(0, len(batch), step):
            yield from zip(*(c.to_pylist() for c in batch.slice(k, step).columns))


def batch_of(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names)


def contexts(texts: DataFrame, bits: int) -> DataFrame:
    """token, cid (digest of the context's bytes), count (its windows), doc_id, t, starts (packed) and s, the first; stored.

    Equal contexts of one text are one row.
    """
    names = ["k", "token", "cid", "count", "s", "starts"]

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kinds, out = [batch.schema.field(0).type, pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()], []
            for key, tokens, packed in rows_of([batch]):
                raw = unpack.decompress(packed)
                start, count, token = anchors(np.frombuffer(raw, np.uint8), np.array([len(raw)]))
                token = token >> (63 - bits)
                found = {}
                for k in np.flatnonzero(np.isin(token, np.array(tokens))).tolist():
                    s, c = int(start[k]), int(count[k])
                    found.setdefault((int(token[k]), xxhash.xxh3_128_digest(raw[s:s + c - 1 + LENGTH]), c), []).append(s)
                out += [(key, *x, at[0], np.array(at, np.int32).tobytes()) for x, at in found.items()]
                if len(out) > 2_000:
                    yield batch_of(out, names, kinds)
                    out = []
            yield batch_of(out, names, kinds)

    rows = texts.select(F.struct("doc_id", "t").alias("k"), "tokens", "packed").mapInArrow(
        run, f"k {key_type(texts)}, token long, cid binary, count int, s int, starts binary")
    return stored(rows.select("token", "cid", "count", "k.doc_id", "k.t", "s", "starts"), "repeat-contexts")


EXAMPLE = {"token": pa.int64(), "cid": pa.binary(), "count": pa.int32(), "copies": pa.int64(), "place": pa.string(), "k": pa.int64(), "bytes": pa.binary()}


def context_bytes(texts: DataFrame, distinct: DataFrame) -> DataFrame:
    """The first example of each context (token, cid, count, copies, k) with its bytes and its place in text order."""
    def run(batches):
        unpack, out = zstandard.ZstdDecompressor(), []
        for asked, packed in rows_of(batches):
            raw = unpack.decompress(packed)
            out += [(a["token"], a["cid"], a["count"], a["copies"], a["place"], a["k"], raw[a["s"]:a["s"] + a["count"] - 1 + LENGTH]) for a in asked]
            if len(out) > 2_000:
                yield batch_of(out, list(EXAMPLE), list(EXAMPLE.values()))
                out = []
        yield batch_of(out, list(EXAMPLE), list(EXAMPLE.values()))

    # Places as text of equal length, in the order of (doc_id, t, start): a null id first, then negative ids.
    doc = F.col("first.doc_id")
    place = F.format_string(
        "%s%020d|%020d|%012d", F.when(doc.isNull(), "0").when(doc < 0, "1").otherwise("2"),
        F.coalesce(F.when(doc < 0, doc + F.lit(2**63 - 1)).otherwise(doc), F.lit(0)), F.shiftright("first.t", 1) + F.lit(2**62), F.col("first.s"))
    asked = distinct.select(
        F.col("first.doc_id").alias("a_id"), F.col("first.t").alias("a_t"),
        F.struct(F.col("first.s").alias("s"), "token", "cid", "count", "copies", "k", place.alias("place")).alias("ask"))
    asked = asked.groupBy("a_id", "a_t").agg(F.collect_list("ask").alias("asked"))
    met = asked.join(texts, F.col("a_id").eqNullSafe(F.col("doc_id")) & (F.col("a_t") == F.col("t")))
    return met.select("asked", "packed").mapInArrow(
        run, "token long, cid binary, count int, copies long, place string, k long, bytes binary")


FLAGS = "token long, cid binary, count int, repeated binary, owned binary"


def suffix_order(raw: list[bytes], counts: list[int], places: list[str]) -> tuple[np.ndarray, ...]:
    """The windows of contexts in suffix order.

    Gives for each window in that order: its context, its number in the context, its position in text order, and the
    bytes it has in common with the window before it.
    """
    data = np.frombuffer(b"".join(raw), np.uint8)
    base = np.cumsum([0] + [len(r) for r in raw[:-1]])
    rank = np.argsort(np.argsort(np.array(places), kind="stable"), kind="stable")
    count = np.array(counts)
    context = np.repeat(np.arange(len(raw)), count)
    number = np.arange(len(context)) - np.repeat(np.cumsum(count) - count, count)
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, LENGTH)[base[context] + number])
    order = np.argsort(windows.view(f"S{LENGTH}")[:, 0], kind="stable")
    context, number = context[order], number[order]
    return context, number, rank[context] * count.max() + number, common_prefixes(windows.view(">u8")[order])


def common_prefixes(windows: np.ndarray) -> np.ndarray:
    """How many bytes each row of 8-byte words has in common with the row before it (the first row: 0)."""
    if len(windows) < 2:
        return np.zeros(len(windows), np.int64)
    rows, at = np.arange(len(windows) - 1), (windows[1:] != windows[:-1]).argmax(axis=1)
    gap = (windows[1:][rows, at] ^ windows[:-1][rows, at]).astype(np.uint64)
    equal = sum((gap < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8))
    return np.r_[0, np.where(gap == 0, 8 * windows.shape[1], 8 * at + equal)]


def nearest_smaller(position: np.ndarray, common: np.ndarray, least: int) -> np.ndarray:
    """For each suffix in order: the bytes it shares with the nearest one before it whose position is smaller.

    All suffixes look at once: one whose neighbour's position is larger goes on to where that neighbour looks, and what
    it shares is the least on the way. Shares below `least` are not followed any further, and are 0.
    """
    near, shared = np.arange(-1, len(position) - 1), common.copy()

    def larger(i):
        return i[(near[i] >= 0) & (shared[i] >= least) & (position[near[i]] > position[i])]

    looking = larger(np.arange(len(position)))
    while len(looking):
        via = near[looking]
        further, less = near[via], np.minimum(shared[looking], shared[via])
        near[looking], shared[looking] = further, less
        looking = larger(looking)
    return np.where((near >= 0) & (shared >= least), shared, 0)


def previous_factors(position: np.ndarray, common: np.ndarray, least=1) -> np.ndarray:
    """The longest-previous-factor array in suffix order: the longest match of each suffix with one that stands earlier.

    Of all earlier ones, the nearest in suffix order on either side shares most. With negated positions these are the
    longest next factors. Matches below `least` bytes are 0.
    """
    before = nearest_smaller(position, common, least)
    after = nearest_smaller(position[::-1], np.r_[common[1:], 0][::-1], least)[::-1]
    return np.maximum(before, after)


def flagged(rows: DataFrame) -> DataFrame:
    """For contexts dealt by token: which of their windows are repeated, and of which they hold the first occurrence."""
    def flush(held):
        token, cid, count, copies, place, raw = zip(*held)
        context, number, position, common = suffix_order(list(raw), list(count), list(place))
        earlier = previous_factors(position, common, LENGTH) >= LENGTH
        later = previous_factors(-position, common, LENGTH) >= LENGTH
        base = np.cumsum([0, *count])
        repeated, owned = np.zeros(base[-1], bool), np.zeros(base[-1], bool)
        repeated[base[context] + number] = earlier | later | (np.array(copies)[context] > 1)
        owned[base[context] + number] = ~earlier
        return pa.RecordBatch.from_arrays([
            pa.array(token, pa.int64()), pa.array(cid, pa.binary()), pa.array(count, pa.int32()),
            *(pa.array([np.packbits(m[a:b]).tobytes() for a, b in zip(base[:-1], base[1:])], pa.binary()) for m in (repeated, owned))],
            ["token", "cid", "count", "repeated", "owned"])

    def run(batches):
        held, size, now = [], 0, None
        for row in rows_of(batches, 1_000):
            if row[0] != now and size > WINDOWS:
                yield flush(held)
                held, size = [], 0
            now = row[0]
            held.append(row)
            size += row[2]
        if held:
            yield flush(held)

    parts = rows.select("token", "cid", "count", "copies", "place", "bytes").repartition("token").sortWithinPartitions("token")
    return parts.mapInArrow(run, FLAGS)


def flagged_by_window(rows: DataFrame, most: int) -> DataFrame:
    """The same for anchors with many contexts, dealt by (token, part of the windows' hashes).

    A task sends each different window once, with its count and first place. What is repeated goes back to the contexts
    by (token, part).
    """
    names = ["token", "part", "cid", "count", "copies", "place", "at", "hashes"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def windows_of(at, hashes, place):
        """(hash, number in the context, place) of each window in a row."""
        for j, o in enumerate(np.frombuffer(at, np.int16).tolist()):
            yield hashes[16 * j:16 * j + 16], o, f"{place[:-12]}{int(place[-12:]) + o:012d}"

    def split(batches):
        out = []
        for token, cid, count, copies, place, k, raw in rows_of(batches):
            parts, cuts = {}, k // most + 1
            for o in range(count):
                h = xxhash.xxh3_128_digest(raw[o:o + LENGTH])
                parts.setdefault(int.from_bytes(h[:4], "big") % cuts, []).append((o, h))
            out += [(token, part, cid, count, copies, place, np.array([o for o, _ in p], np.int16).tobytes(), b"".join(h for _, h in p)) for part, p in parts.items()]
            if len(out) > 2_000:
                yield batch_of(out, names, kinds)
                out = []
        yield batch_of(out, names, kinds)

    def partial(batches):
        found = {}

        def emit():
            return batch_of([(*key, *v) for key, v in found.items()], ["token", "part", "hash", "copies", "place"], [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string()])

        for token, part, copies, place, at, hashes in rows_of(batches):
            for h, _, p in windows_of(at, hashes, place):
                n, first = found.get((token, part, h), (0, p))
                found[token, part, h] = (n + copies, min(first, p))
            if len(found) > 100_000:
                yield emit()
                found = {}
        yield emit()

    def mark(batches):
        """Rows by (token, part, salt): first what is known of the group, then its contexts."""
        names, kinds, out, first = ["token", "cid", "count", "repeated", "owned"], [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()], [], {}
        for token, cid, count, place, at, hashes, known in rows_of(batches, 20):
            if known is not None:
                first = {x["hash"]: x["first"] for x in known}
                continue
            repeated, owned = np.zeros(count, bool), np.zeros(count, bool)
            for h, o, p in windows_of(at, hashes, place):
                repeated[o], owned[o] = h in first, first.get(h) == p
            out.append((token, cid, count, np.packbits(repeated).tobytes(), np.packbits(owned).tobytes()))
            if len(out) > 2_000:
                yield batch_of(out, names, kinds)
                out = []
        yield batch_of(out, names, kinds)

    kept = stored(rows.select(*EXAMPLE).mapInArrow(
        split, "token long, part int, cid binary, count int, copies long, place string, at binary, hashes binary"), "repeat-windows")
    windows = kept.select("token", "part", "copies", "place", "at", "hashes").mapInArrow(
        partial, "token long, part int, hash binary, copies long, place string")
    again = windows.groupBy("token", "part", "hash").agg(F.sum("copies").alias("times"), F.min("place").alias("first")).where("times > 1")
    again = again.groupBy("token", "part").agg(F.collect_list(F.struct("hash", "first")).alias("known"))
    # A part's contexts are dealt by salt, about `most` to a task; each of these gets what is known of the part.
    salts = kept.groupBy("token", "part").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("salts"))
    known = stored(again.join(salts, ["token", "part"]), "repeat-known")
    none = F.lit(None)
    heads = known.select("token", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), none.cast("binary").alias("cid"), none.cast("int").alias("count"),
                         none.cast("string").alias("place"), none.cast("binary").alias("at"), none.cast("binary").alias("hashes"), "known", F.lit(0).alias("kind"))
    tails = kept.join(known.select("token", "part", "salts"), ["token", "part"]).select(
        "token", "part", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int").alias("salt"), "cid", "count", "place", "at", "hashes",
        none.cast(known.schema["known"].dataType).alias("known"), F.lit(1).alias("kind"))
    key = ["token", "part", "salt"]
    dealt = heads.unionByName(tails).repartition(*key).sortWithinPartitions(*key, "kind")
    return dealt.select("token", "cid", "count", "place", "at", "hashes", "known").mapInArrow(mark, FLAGS)


def copies_of(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, t, n_bytes, digest, copies (rows with that text) and whether it is the first of them."""
    rows = keyed(docs).select("doc_id", "t", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "t")).alias("top"))
    return rows.join(groups, "digest").withColumn("is_first", F.struct("doc_id", "t").eqNullSafe(F.col("top"))).drop("top")


def covered(size: int, marks: list[dict]) -> np.ndarray:
    """Begin and end, in turn, of the maximal runs of bytes that repeated windows cover."""
    change = np.zeros(size + 1, np.int64)
    for m in marks:
        starts, count = np.frombuffer(m["starts"], np.int32).astype(np.int64), m["count"]
        whole = np.ones(count, bool)
        repeated = whole if m["repeated"] is None else np.unpackbits(np.frombuffer(m["repeated"], np.uint8), count=count).astype(bool)
        owned = whole if m["owned"] is None else np.unpackbits(np.frombuffer(m["owned"], np.uint8), count=count).astype(bool)
        parts = [(starts, repeated)] if not m["is_first"] else [(starts[:1], repeated & ~owned), (starts[1:], repeated)]
        for at, flags in parts:
            begin = (at[:, None] + np.flatnonzero(flags)[None, :]).ravel()
            np.add.at(change, begin, 1)
            np.add.at(change, begin + LENGTH, -1)
    inside = np.cumsum(change) > 0
    return np.flatnonzero(np.diff(np.r_[False, inside]))


def remaining(raw: bytes, spans: np.ndarray) -> bytes:
    edges = np.r_[0, spans, len(raw)].tolist()
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def removals(docs: DataFrame, keep="none", most=MOST) -> DataFrame:
    """doc_id, t, spans (begin, end of each removed run as packed integers) and kept (the remaining bytes).

    Only texts that share a string with another text, or with themselves, have a row; of equal texts, only the first.
    """
    d = keyed(docs)
    total = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = 32 + max(2, math.ceil(math.log2(total / 70 / BLOCK_TOKENS + 1)))  # an anchor in about 70 bytes
    sources = copies_of(docs).where("is_first").select(F.col("doc_id").alias("r_id"), F.col("t").alias("r_t")).distinct()
    tokens, again, both = anchors_of(d, bits)
    kept = tokens.select("k.doc_id", "k.t", F.explode("tokens").alias("token")).join(again, "token")
    kept = kept.join(sources, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("t") == F.col("r_t")))
    anchored = stored(kept.select("doc_id", "t", "token"), "repeat-anchors")
    discard(both)
    kept = anchored.groupBy("doc_id", "t", "token").agg(F.count(F.lit(1)).alias("m"))
    several = kept.groupBy("token").agg(F.sum("m").alias("m")).where("m > 1").select("token")
    texts = with_texts(d, kept.join(several, "token").groupBy("doc_id", "t").agg(F.collect_list("token").alias("tokens")))
    discard(anchored)

    found, place = contexts(texts, bits), F.struct("doc_id", "t", "s")
    distinct = stored(found.groupBy("token", "cid", "count").agg(
        F.min(place).alias("first"), F.sum(F.octet_length("starts") / 4).cast("long").alias("copies")), "repeat-distinct")
    dealt = distinct.join(distinct.groupBy("token").agg(F.count(F.lit(1)).alias("k")), "token")
    nothing = F.lit(None).cast("binary")
    alone = dealt.where("k = 1 AND copies > 1").select("token", "cid", "count", nothing.alias("repeated"), nothing.alias("owned"))
    some = flagged(context_bytes(texts, dealt.where(F.col("k").between(2, most))))
    many = flagged_by_window(context_bytes(texts, dealt.where(F.col("k") > max(most, 1))), most)
    marked = found.join(alone.unionByName(some).unionByName(many), ["token", "cid", "count"])
    if keep == "first":
        marked = marked.join(distinct.select("token", "cid", "count", "first"), ["token", "cid", "count"]).withColumn("is_first", place.eqNullSafe(F.col("first")))
    else:
        marked = marked.withColumn("is_first", F.lit(False))
    by_text = marked.groupBy(F.col("doc_id").alias("b_id"), F.col("t").alias("b_t")).agg(
        F.collect_list(F.struct("starts", "count", "repeated", "owned", "is_first")).alias("marks"))

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kinds = [batch.schema.field(0).type, pa.binary(), pa.binary()]
            for k in range(0, len(batch), 50):
                out = []
                for key, marks, packed in zip(*(c.to_pylist() for c in batch.slice(k, 50).columns)):
                    raw = unpack.decompress(packed)
                    spans = covered(len(raw), marks)
                    out.append((key, spans.astype(np.int32).tobytes(), remaining(raw, spans)))
                yield batch_of(out, ["k", "spans", "kept"], kinds)

    met = by_text.join(texts, F.col("b_id").eqNullSafe(F.col("doc_id")) & (F.col("b_t") == F.col("t")))
    out = met.select(F.struct("doc_id", "t").alias("k"), "marks", "packed").mapInArrow(cut, f"k {key_type(d)}, spans binary, kept binary")
    return out.select("k.doc_id", "k.t", "spans", "kept")


def deduplicated(docs: DataFrame, keep="none", most=MOST) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, spans (packed begin, end) and kept (bytes; null: the whole text), kept_sha256."""
    cuts = removals(docs, keep, most).select(F.col("doc_id").alias("c_id"), F.col("t").alias("c_t"), "spans", F.col("kept").alias("left"))
    rows = copies_of(docs)
    rows = rows.join(cuts, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("t") == F.col("c_t")), "left")
    other = F.col("copies") > 1 if keep == "none" else ~F.col("is_first")
    whole, zero = other & (F.col("n_bytes") >= LENGTH), F.lit(0).cast("long")
    kept = F.when(whole, F.lit("").cast("binary")).otherwise(F.col("left"))
    return rows.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).when(F.col("left").isNull(), zero).otherwise(F.col("n_bytes") - F.octet_length("left")).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).when(F.col("left").isNull(), zero).otherwise((F.octet_length("spans") / 8).cast("long")).alias("n_spans"),
        "spans", kept.alias("kept"), F.coalesce(F.sha2(kept, 256), "digest").alias("kept_sha256"))


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark, folder):
    return deduplicated(table(spark, folder, "documents", "doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
