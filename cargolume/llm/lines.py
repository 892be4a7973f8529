"""Line dedup: a line goes if an equal line, or one within one word edit, stands earlier in the corpus.

A line is its words; earlier means smaller (doc_id, line number). Equal lines are found by a digest of the words. Lines
of at least `NEAR_WORDS` words are also compared by word edit distance (insert, delete or replace one word; the longer
of the two counts), with the deletion neighbourhood: a line's variants are the line itself and the line without any one of its words, as hashed
keys. Two lines are within the bound if one equals a variant of the other, or if both lack the word at the same place
and are equal otherwise. So for every variant it is enough to know the earliest line in each role; the lines that
share a variant are never paired with each other, however many they are. The distance to the earliest partner is then
verified on the words.

Before variants are made, lines are screened: an edit leaves the first or the last words up to a power of two (at
least a quarter of the line) as they are, so a line that shares neither with any other line has no near line. A line
that shares its first words only can differ behind them only, and loses words there only; likewise for its last words.

Defined results: a null text has no lines; lines without words always stay; a line counts as a copy by its words, so
white space does not matter; what is earlier is judged on the input, also when the earlier line goes itself; rows with
equal doc_id and text are one document and get the same result; null ids count as smallest; an emptied document stays
with the text that is left; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import SPACES, discard, query, stored, table, words

NEAR_WORDS = 8
MODULUS = 2**61 - 1
BLANKS = " \t\n\x0b\x0c\r"


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and t, which tells texts of one id apart."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """A row per line with words, stored: doc_id, t, line, key (digest of the words) and screens."""
    rows = keyed(docs).select("doc_id", "t", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    uneven = F.startswith("raw", F.lit(" ")) | F.endswith("raw", F.lit(" ")) | F.contains("raw", F.lit("  "))
    for c in BLANKS.strip(" \n"):
        uneven |= F.contains("raw", F.lit(c))
    # Words are parted by single spaces in most lines; the others are made so. Trimming every line costs more than all the rest.
    even = F.when(uneven, F.btrim(F.regexp_replace("raw", SPACES, " "))).otherwise(F.col("raw"))
    rows = rows.select("doc_id", "t", "line", even.alias("even"))
    rows = rows.withColumn("n", F.octet_length("even") - F.octet_length(F.replace("even", F.lit(" "), F.lit(""))) + 1)
    # A condition here would be moved below the words and cut every line twice; read back, it costs nothing.
    key = F.when(F.col("even") != "", F.unhex(F.md5("even")))
    return stored(rows.select("doc_id", "t", "line", key.alias("key"), screens("even", "n").alias("screens")), "lines").where("key IS NOT NULL")


def half_of(n: Column) -> Column:
    """The power of two that is at most half of n."""
    return F.pow(F.lit(2), F.floor(F.log2(n / 2))).cast("int")


def screens(even: str, words_in: str) -> Column:
    """Hashes of the first and of the last words of a line with single spaces, up to the power of two that is at most half the line.

    A line of 2^k words also gives those for half that, which a line with one word less uses.
    """
    n, half = F.col(words_in), half_of(F.col(words_in))

    def ends(size):
        return [F.xxhash64(F.lit(k), size, F.call_function("substring_index", F.col(even), F.lit(" "), -size if k else size)) for k in (0, 1)]

    quarter = (half / 2).cast("int")
    return F.when(n < NEAR_WORDS - 1, F.array().cast("array<long>")).when(n == 2 * half, F.array(*ends(half), *ends(quarter))).otherwise(F.array(*ends(half)))


def first_lines(rows: DataFrame) -> DataFrame:
    """The earliest of equal lines: key, doc_id, line, t, screens."""
    rows = rows.select("key", F.struct("doc_id", "line", "t", "screens").alias("place"))
    return rows.groupBy("key").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies")).select("key", "place.*", "copies")


def near_candidates(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """Lines that share a screen with another: doc_id, line, key, `hits` (a bit for each of its screens) and their words."""
    screened = firsts.select("key", "doc_id", "line", "t", F.posexplode("screens").alias("at", "screen"))
    shared = screened.groupBy("screen").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("screen")
    chosen = screened.join(shared, "screen").groupBy("key", "doc_id", "line", "t").agg(F.bit_or(F.expr("shiftleft(1, at)")).alias("hits"))
    by_doc = chosen.groupBy(F.col("doc_id").alias("c_id"), F.col("t").alias("c_t")).agg(F.collect_list(F.struct("line", "key", "hits")).alias("found"))
    d = keyed(docs)
    texts = d.join(by_doc, d.doc_id.eqNullSafe(F.col("c_id")) & d.t.eqNullSafe(F.col("c_t")))
    at = texts.select("doc_id", F.split("text", "\n").alias("raw"), F.explode("found").alias("f"))
    rows = at.select("doc_id", "f.line", "f.key", "f.hits", words(F.get("raw", F.col("f.line"))).alias("w"))
    return rows.dropDuplicates(["key"])  # rows with equal id and text give the same line twice


def running_sums(d: DataFrame, values: str, into: str) -> DataFrame:
    """Adds the running sums, modulo MODULUS, of an array of longs below it: chunk sums first, so n times root of n steps."""
    v, c, s = F.col(values), F.col("chunk"), F.col("sums")

    def total(x):
        return F.aggregate(x, F.lit(0).cast("long"), lambda a, b: (a + b) % MODULUS)

    d = d.withColumn("chunk", F.ceil(F.sqrt(F.greatest(F.size(v), F.lit(1)))).cast("int"))
    d = d.withColumn("sums", F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / c).cast("int")), lambda j: total(F.slice(v, j * c + 1, c))))
    d = d.withColumn("sums", F.when(F.size(s) > 0, F.transform(s, lambda x, j: total(F.slice(s, 1, j)))))
    running = F.transform(v, lambda x, i: (F.get(s, F.floor(i / c).cast("int")) + total(F.slice(v, F.floor(i / c).cast("int") * c + 1, i % c + 1))) % MODULUS)
    return d.withColumn(into, F.when(F.size(s) > 0, running)).drop("chunk", "sums")


def variants(lines: DataFrame) -> DataFrame:
    """A row per variant: doc_id, line, variant and `without`, the place of the word left out (-1: none).

    A variant's hash adds up hashes of (word, place); leaving a word out moves the later ones up by one place. Equal
    hashes of other words do no harm, since partners are verified, but for a chance of about lines^2 / 2^61 that one
    hides a later partner.
    """
    def h(word, place):
        return F.pmod(F.xxhash64(word, place), F.lit(MODULUS))

    here, moved, n = F.col("here"), F.col("moved"), F.col("n")
    d = lines.select("doc_id", "line", "hits", F.size("w").alias("n"), F.transform("w", lambda x, i: h(x, i)).alias("here"), F.transform("w", lambda x, i: h(x, i - 1)).alias("moved"))
    # The sum without word i is (words before i in place) + (words after i moved up): `start` for the first word,
    # then a step from each word to the next. Nothing that takes a pass may stand alone inside a lambda.
    d = d.withColumn("start", F.aggregate(F.slice(moved, 2, F.greatest(F.size(moved) - 1, F.lit(0))), F.lit(0).cast("long"), lambda a, b: (a + b) % MODULUS))
    step = lambda x, i: F.when(i == 0, F.col("start")).otherwise((F.get(here, i - 1) - F.get(moved, i) + MODULUS) % MODULUS)
    d = running_sums(d.withColumn("steps", F.transform(here, step)), "steps", "run")
    whole = F.aggregate(here, F.lit(0).cast("long"), lambda a, b: (a + b) % MODULUS)
    half = half_of(n)
    quarter, hit = (half / 2).cast("int"), lambda k: F.col("hits").bitwiseAND(1 << k) > 0
    first = F.when(hit(2), quarter).when(hit(0), half).otherwise(n)
    last = n - F.when(hit(3), quarter).when(hit(1), half).otherwise(n)
    each = d.select("doc_id", "line", "n", first.alias("first"), last.alias("last"), F.posexplode(F.concat("run", F.array(whole))).alias("i", "v"))
    i, out = F.col("i"), F.col("i") < n
    kept = each.where(~out | ((n >= NEAR_WORDS) & ((i >= F.col("first")) | (i < F.col("last")))))
    return kept.select(
        "doc_id", "line", F.xxhash64("v", F.when(out, n - 1).otherwise(n)).alias("variant"), F.when(out, i).otherwise(-1).alias("without"))


def earliest_partners(rows: DataFrame) -> DataFrame:
    """doc_id, line and p, the place of the earliest line with which it shares a variant in a way that bounds the edits.

    `rows` is a stored table, since it is read twice.
    """
    place = F.struct("doc_id", "line")
    roles = rows.groupBy("variant", "without").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    whole = F.col("without") == -1
    by_variant = roles.groupBy("variant").agg(
        F.min(F.when(whole, F.col("first"))).alias("whole"), F.min(F.when(~whole, F.col("first"))).alias("cut"), F.sum("n").alias("n")
    ).where("n > 1").drop("n")
    same = roles.where(~whole & (F.col("n") > 1)).select("variant", "without", "first")
    met = rows.join(by_variant, "variant").join(same, ["variant", "without"], "left")
    partner = F.when(whole, F.col("cut")).otherwise(F.least(F.col("whole"), F.col("first")))
    return met.withColumn("p", partner).where(F.col("p") < place).groupBy("doc_id", "line").agg(F.min("p").alias("p"))


def within_one_edit(a: Column, b: Column) -> Column:
    def common(x, y):
        return F.array_position(F.zip_with(x, y, lambda s, t: s.eqNullSafe(t)), F.lit(False)) - 1

    longer, shorter = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))
    front, back = common(a, b), common(F.reverse(a), F.reverse(b))
    return (longer - shorter <= 1) & ((front < 0) | (front + back >= longer - 1))


def near_lines(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """key of every line with an earlier line within the bound, stored."""
    lines = stored(near_candidates(firsts, docs), "line-candidates")
    rows = stored(variants(lines), "line-variants")
    found = earliest_partners(rows)
    x = lines.select("doc_id", "line", "key", "w")
    y = lines.select(F.col("doc_id").alias("y_id"), F.col("line").alias("y_line"), F.col("w").alias("y_w"))
    f = found.select(F.col("doc_id").alias("f_id"), F.col("line").alias("f_line"), "p")
    both = x.join(f, x.doc_id.eqNullSafe(F.col("f_id")) & (x.line == F.col("f_line"))).join(
        y, F.col("p.doc_id").eqNullSafe(F.col("y_id")) & (F.col("p.line") == F.col("y_line")))
    near = stored(both.where(within_one_edit(F.col("w"), F.col("y_w"))).select("key").distinct(), "line-near")
    discard(lines, rows)
    return near


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id, t and `gone`, the numbers of the lines to remove, for documents that lose any."""
    rows = lines_of(docs)
    firsts = stored(first_lines(rows), "line-firsts")
    near = near_lines(firsts, docs).withColumn("near", F.lit(True))
    known = firsts.join(near, "key", "left").where((F.col("copies") > 1) | F.col("near"))
    known = stored(known.select("key", F.struct("doc_id", "line").alias("first"), F.coalesce("near", F.lit(False)).alias("near")), "line-known")
    discard(firsts)
    hits = rows.select("doc_id", "t", "line", "key").join(known, "key")
    hits = hits.where(F.col("near") | (F.struct("doc_id", "line") > F.col("first")))
    return hits.groupBy("doc_id", "t").agg(F.collect_set("line").alias("gone"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Every row of `docs`, all its columns, with the text that is left; also l_lines and l_removed."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("l_id"), F.col("t").alias("l_t"), "gone")
    row = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("l_key"))
    cut = row.join(gone, F.col("row.doc_id").eqNullSafe(F.col("l_id")) & (F.col("l_key") == F.col("l_t")), "left")
    # The lines are a column of their own: inside a lambda the text would be cut again for every line.
    cut = cut.withColumn("cut", F.split(F.col("row.text"), "\n"))
    lines = F.col("cut")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    cut = cut.withColumn("left", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left))
    columns = [F.col("left").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return cut.select(*columns, F.coalesce(F.when(F.col("row.text").isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias("l_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("l_removed"))


@query("op9_line_dedup")
def op9_line_dedup(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return without_repeated_lines(docs).select(
        "doc_id", F.col("l_lines").alias("n_lines"), F.col("l_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
