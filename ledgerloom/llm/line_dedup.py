"""Line deduplication by an exact set-similarity join, in DataFrame operations.

A line is the set of its words. Lines with a Jaccard similarity of at least
num / den to an earlier line (by doc_id, then line number) are removed.

1. Words get a global order by rarity: a fixed-size count sketch of all words
   of all lines (one byte per hash bucket, a logarithm of its count) followed
   by the word's hash. Any total order is exact; rarity makes it fast.
2. Equal lines are grouped by two hashes (96 bits) of their text, with the
   place of the first and what the join needs of the line: its number of words,
   a parity bitmap and its prefix. This table gives each distinct line an id,
   in the order of the places.
3. Each line is filed under its prefix, its n - ceil(t n) + ``SHARED`` rarest
   words: two lines that similar share ``SHARED`` prefix words (or all words
   that they must share, if fewer). A word where two lines meet counts if the
   lengths allow the similarity (length filter), if enough words follow both
   positions (positional filter), and if the lines' parity bitmaps differ in no
   more bits than the sets may differ in words (bitmap filter; 64 bits, and 128
   between lines of ``LONG`` words or more, as many words fill 64 bits); a pair
   that meets in ``SHARED`` words survives. Two random lines may share one rare
   word, hardly ever two.
4. Survivors are verified on their whole word sets, each line against its
   earliest candidate first.
5. Before the join, a line is verified against its hubs, the earliest lines with
   the same two neighbours among the words of its prefix, then against a few more
   lines that have hubs. Lines found there do not look for further partners, so
   that a crowd of near copies is not joined all with all.

A hot line is one distinct line; words that very many lines share come last in
the order and are hardly ever in a prefix.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.graph import stored
from ledgerloom.operators.attributes import quote_name

NUM, DEN = 4, 5  # similarity of at least 0.8
SKETCH_BITS = 18
# ASCII white space besides the space and the line feed.
OTHER_SPACE = "\t\x0b\x0c\r"
#: Prefix words that two lines must share to be verified.
SHARED = 2
#: Words from which a line has the second half of the bitmap.
LONG = 64
#: Words at either end of a prefix whose pairs name a line's hubs, and bits of the map of lines whose texts are needed.
RAREST, NEEDED_BITS = 4, 1 << 22
#: Lines of a crowd that are looked at for one that is like none of its hubs, by key, and of them those verified.
CROWD_HUBS, TRIES = 32, 24


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, line_no, line)``: the text cut at line feeds, from 0."""
    return docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"))


def words_of(line: Column) -> Column:
    """The line's words (runs of anything but ASCII white space)."""
    odd = F.contains(line, F.lit(OTHER_SPACE[0]))
    for c in OTHER_SPACE[1:]:
        odd = odd | F.contains(line, F.lit(c))
    spaced = F.when(odd, F.translate(line, OTHER_SPACE, " " * len(OTHER_SPACE))).otherwise(line)
    return F.array_remove(F.split(spaced, " "), "")


def word_set(line: str) -> Column:
    """The line's distinct words as 64-bit hashes."""
    return F.array_distinct(F.transform(words_of(F.col(line)), lambda w: F.xxhash64(w)))


def place(doc_id: str = "doc_id", line_no: str = "line_no") -> Column:
    """One sortable number for (doc_id, line_no)."""
    return (F.col(doc_id).cast("decimal(20,0)") * F.lit(10_000_000_000).cast("decimal(11,0)")
            + F.col(line_no).cast("decimal(10,0)")).cast("decimal(32,0)")


def rarity_sketch(docs: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One row, one array ``s`` of 2 ** bits numbers: a logarithm of the number
    of words in each hash bucket, over all lines, in the upper six bits."""
    size = 1 << bits
    spark = docs.sparkSession
    one_line = docs.select(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")).alias("line"))
    words = one_line.select(F.explode(words_of(F.col("line"))).alias("w")).select(
        F.xxhash64("w").bitwiseAND(F.lit(size - 1)).alias("b"))
    counted = words.groupBy("b").agg(F.count("*").alias("n"))
    every = counted.unionByName(spark.range(size).select(F.col("id").alias("b"), F.lit(0).cast("long").alias("n")))
    level = F.shiftleft(F.least(F.lit(31), F.floor(F.log2(F.sum("n") + 1) * 1.5)).cast("long"), 58)
    dense = every.groupBy("b").agg(level.alias("c"))
    chunks = dense.groupBy(F.shiftright("b", 10).alias("g")).agg(
        F.array_sort(F.collect_list(F.struct("b", "c"))).getField("c").alias("a"))
    return chunks.agg(F.flatten(F.array_sort(F.collect_list(F.struct("g", "a"))).getField("a")).alias("s"))


def _prefix_of(n: Column, overlap: Column) -> Column:
    """Words of a set of n that must hold ``SHARED`` of ``overlap`` common words."""
    return F.least(n, n - overlap + SHARED).cast("int")


def _ceil(n: Column, num: int, den: int) -> Column:
    return F.floor((n * num + (den - 1)) / den)


def _size_class(n: Column, num: int, den: int) -> Column:
    """Sizes that are similar enough lie in the same class or neighbouring ones."""
    return F.floor(F.log(n) / F.log(F.lit(den / num)) + 1e-9).cast("int")


def line_table(docs: DataFrame, num: int = NUM, den: int = DEN, bits: int = SKETCH_BITS) -> DataFrame:
    """``(k1, k2, first, n, mask, wide, pre, id)``: one row per distinct line.

    ``first`` is where it occurs first (null: only in documents without id),
    ``n`` its number of words, ``mask`` their parity bitmap, ``wide`` that of half
    of them (by a further bit; 0 below ``LONG`` words), ``pre`` its prefix,
    rarest word first (null: no words). A word is a number there: its bucket's
    level and the upper 58 bits of its hash. Only these, never the text, are
    exchanged. ``id`` grows with ``first`` (nulls last), so that of two lines the
    one with the smaller id is the earlier; write the table before using it."""
    lines = lines_of(docs).select(F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"), place().alias("p"),
                                  F.transform(words_of(F.col("line")), lambda w: F.xxhash64(w)).alias("w"))
    seen = lines.select("k1", "k2", "p", "w", rarity_sketch(docs, bits).scalar().alias("s"))
    number = lambda h: F.coalesce(F.get("s", h.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")).bitwiseOR(
        F.shiftrightunsigned(h, 6)), F.lit(0).cast("long"))
    ranked = seen.select("k1", "k2", "p", F.sort_array(F.array_distinct(F.transform("w", number))).alias("ws"))
    size = F.size("ws")
    one = F.lit(1).cast("long")
    parity = lambda bit: F.aggregate("ws", F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(
        F.call_function("shiftleft", bit(w), w.bitwiseAND(F.lit(63)).cast("int"))))
    wide = F.when(size >= LONG, parity(lambda w: F.shiftrightunsigned(w, 6).bitwiseAND(one))).otherwise(F.lit(0).cast("long"))
    sized = ranked.select("k1", "k2", "p", size.alias("n"), parity(lambda w: one).alias("mask"), wide.alias("wide"), F.when(
        size > 0, F.slice("ws", F.lit(1), _prefix_of(size, _ceil(size, num, den)))).alias("pre"))
    order = [F.col("first").asc_nulls_last(), F.col("k1")]
    return (sized.groupBy("k1", "k2").agg(F.min("p").alias("first"), F.first("n").alias("n"),
                                          F.first("mask").alias("mask"), F.first("wide").alias("wide"), F.first("pre").alias("pre"))
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("id", F.monotonically_increasing_id()))


def _hub_keys() -> Column:
    """Hashes of pairs of prefix words that name a line's hubs.

    The rarest words of a near copy are often its own changes. So beside the
    neighbouring pairs at the front of the prefix those at its end count, where
    the words lie that it shares; of a short prefix, all pairs."""
    size = F.size("pre")
    pair = lambda i, j: F.xxhash64(F.get("pre", i), F.get("pre", j))
    every = [F.when(size > j, pair(F.lit(i), F.lit(j))) for i in range(RAREST) for j in range(i + 1, RAREST)]
    front = [pair(F.lit(i), F.lit(i + 1)) for i in range(RAREST - 1)]
    end = [pair(size - i - 1, size - i) for i in range(1, RAREST + 1)]
    return (F.when(size == 1, F.array(F.xxhash64(F.get("pre", F.lit(0))))).when(size <= RAREST, F.array_compact(F.array(*every)))
            .otherwise(F.array_distinct(F.array(*front, *end))))


def hub_pairs(table: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(l, e)``: at most three earlier lines for each line, its likeliest hubs.

    The hub of two words is the earliest line that has both among the words of
    its ``_hub_keys``. Members of a crowd of near copies mostly share two of
    these, and so their hub: a few pairs a member find them, where a join would
    pair all with all. Of the hubs that pass the length and bitmap filters the
    one whose bitmap is nearest is taken, the first and the last; ``e`` is null
    if only hubs of crowds are near that fail the latter by less than half."""
    # no column is null, so that both sides of the join read one exchange
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    filed = (table.where("n > 0").select("id", "n", "mask", F.explode(_hub_keys()).alias("w"))
             .select(long(F.col("id")).alias("id"), F.coalesce("n", F.lit(0)).alias("n"), long(F.col("mask")).alias("mask"),
                     long(F.col("w")).alias("w")).repartition("w"))
    hubs = filed.groupBy("w").agg(F.min("id").alias("e"), F.min_by("n", "id").alias("e_n"),
                                  F.min_by("mask", "id").alias("e_mask"), F.count("*").alias("lines"))
    total = F.col("n") + F.col("e_n")
    apart = F.bit_count(F.col("mask").bitwiseXOR(F.col("e_mask")))
    most = total - 2 * _ceil(total, num, num + den)
    met = filed.join(hubs.where("lines > 1").hint("shuffle_hash"), "w").where(
        (F.col("e") < F.col("id")) & (F.greatest("n", "e_n") * num <= F.least("n", "e_n") * den)
        & (apart <= F.when(F.col("lines") < CROWD_HUBS, most).otherwise(F.floor(most * 1.5))))
    near = met.select("id", "e", apart.alias("apart"), F.when(apart <= most, F.col("e")).alias("hub"))
    picked = near.groupBy(F.col("id").alias("l")).agg(
        F.min_by("hub", F.when(F.col("hub").isNotNull(), F.col("apart"))).alias("near"), F.min("hub").alias("first"), F.max("hub").alias("last"))
    return picked.select("l", F.explode(F.array_distinct(F.array("near", "first", "last"))).alias("e"))


def crowd_pairs(table: DataFrame, hubs: DataFrame, copies: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(l, e)``: for each line of ``hubs`` that is like none of its hubs, at most
    ``TRIES`` other earlier lines of ``hubs``, those with the nearest bitmaps.

    Lines of one crowd may be like each other and not like its first. Each key's
    lines are dealt by a hash over ``CROWD_HUBS`` parts, and the earliest of each
    part is looked at: a fixed number for a line, however large the crowd."""
    members = hubs.select(F.col("l").alias("id")).distinct().join(
        copies.select(F.col("l").alias("id"), F.lit(1).alias("found")), "id", "left")
    rows = table.join(members, "id").select("id", "n", "mask", "found", F.explode(_hub_keys()).alias("w"))
    part = F.pmod(F.xxhash64("id"), F.lit(CROWD_HUBS))
    firsts = rows.groupBy("w", part.alias("part")).agg(F.min("id").alias("e"), F.min_by("n", "id").alias("e_n"),
                                                       F.min_by("mask", "id").alias("e_mask"))
    total = F.col("n") + F.col("e_n")
    apart = F.bit_count(F.col("mask").bitwiseXOR(F.col("e_mask")))
    met = rows.where("found is null").join(firsts, "w").where(
        (F.col("e") < F.col("id")) & (F.greatest("n", "e_n") * num <= F.least("n", "e_n") * den)
        & (apart <= total - 2 * _ceil(total, num, num + den)))
    nearest = met.groupBy(F.col("id").alias("l")).agg(F.slice(F.array_sort(F.collect_set(F.struct(apart.alias("apart"), "e"))), 1, TRIES).alias("es"))
    return nearest.select("l", F.explode(F.col("es").getField("e")).alias("e"))


def meetings(table: DataFrame, done: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(l, e, need)`` for each prefix word in which two lines pass all three
    filters, the later one first, but for lines ``l`` in ``done``; ``need`` is in
    how many words they must meet. One exchange by prefix word serves both sides."""
    table = table.join(done.select(F.col("l").alias("id"), F.lit(1).alias("done")), "id", "left")
    # five longs a row: the size, the position and whether the line is done share one. As no column is null, no side
    # of the joins gets filters of its own below the exchange
    long = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    packed = F.shiftleft(long("n"), 32).bitwiseOR(F.shiftleft(long("i"), 1)).bitwiseOR(long("done"))
    filed = (table.select("id", "n", "mask", "wide", "done", F.posexplode_outer("pre").alias("i", "w")).where("w is not null and i is not null")
             .select(long("id").alias("id"), long("mask").alias("mask"), long("wide").alias("wide"), packed.alias("x"), "w")
             .repartition(F.hash("w")))

    n = F.shiftrightunsigned("x", 32).cast("int")
    i = F.shiftrightunsigned(F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)), 1).cast("int")
    late = F.col("x").bitwiseAND(F.lit(1)).cast("int")

    def side(p: str, classes: Column) -> DataFrame:
        return filed.select(F.col("id").alias(p + "id"), F.col("mask").alias(p + "mask"), F.col("wide").alias(p + "wide"),
                            F.col("w").alias(p + "w"), n.alias(p + "n"), i.alias(p + "i"), (late == 1).alias(p + "done"),
                            F.explode(classes).alias(p + "c"))

    # the larger set looks up its own size class and the next smaller one: even numbers hold the lines not done, odd
    # ones those done, which only the former look up. Word and class, two int keys, are joined as one long
    own = F.coalesce(_size_class(n, num, den), F.lit(0)) * 2
    larger = side("a_", F.when(late == 1, F.array(own, own - 2)).otherwise(F.array(own, own - 2, own + 1, own - 1)))
    # the smaller of two similar sets has its common words even earlier: only those places are looked up
    early = i < _prefix_of(n, _ceil(n, 2 * num, num + den))
    smaller = side("b_", F.when(early, F.array(own + late)).otherwise(F.array().cast("array<int>")))
    total = F.col("a_n") + F.col("b_n")
    least = _ceil(total, num, num + den)
    # equal words are told by their difference: an equality would be a third key.
    # Of the common words, the SHARED-th still has this many after it on both sides
    rest = least - (SHARED - 1)
    # the bitmap of the other half of a long line's words is the difference of its two
    apart, half = F.col("a_mask").bitwiseXOR(F.col("b_mask")), F.col("a_wide").bitwiseXOR(F.col("b_wide"))
    fit = ((F.hash("a_w") == F.hash("b_w")) & (F.col("a_c") == F.col("b_c")) & (F.col("a_w").bitwiseXOR(F.col("b_w")) == 0)
           & ((F.col("a_n") > F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_id") > F.col("b_id"))))
           & (F.col("b_n") * den >= F.col("a_n") * num)
           & (F.col("a_n") - F.col("a_i") >= rest) & (F.col("b_n") - F.col("b_i") >= rest)
           & ~F.when(F.col("a_id") > F.col("b_id"), F.col("a_done")).otherwise(F.col("b_done"))
           & (F.bit_count(apart) <= total - 2 * least)
           & ((F.col("b_n") < LONG) | (F.bit_count(half) + F.bit_count(apart.bitwiseXOR(half)) <= total - 2 * least)))
    met = larger.join(smaller.hint("shuffle_hash"), fit)
    return met.select(F.greatest("a_id", "b_id").alias("l"), F.least("a_id", "b_id").alias("e"),
                      F.least(F.lit(SHARED).cast("long"), least).alias("need"))


def candidate_pairs(table: DataFrame, done: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(l, e)``: ids of lines that meet in ``SHARED`` prefix words."""
    pairs = meetings(table, done, num, den).groupBy("l", "e").agg(F.count("*").alias("met"), F.min("need").alias("need"))
    return pairs.where("met >= need").select("l", "e")


@contextmanager
def _joins_on_part_of_the_key(spark: SparkSession):
    """Joins on (word, size class) may use an exchange by word alone."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bit_map(keys: DataFrame, key: str, bits: int = NEEDED_BITS) -> Column:
    """An array of 64-bit words with a bit set for each of ``keys``, as a scalar."""
    words = keys.select((F.pmod(F.col(key), F.lit(bits)) / 64).cast("int").alias("g"), F.call_function(
        "shiftleft", F.lit(1).cast("long"), F.pmod(F.col(key), F.lit(64)).cast("int")).alias("b"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("g"), F.lit(0).cast("long").alias("b"))
    dense = words.groupBy("g").agg(F.bit_or("b").alias("b")).unionByName(every).groupBy("g").agg(F.bit_or("b").alias("b"))
    chunks = dense.groupBy(F.shiftright("g", 10).alias("h")).agg(
        F.array_sort(F.collect_list(F.struct("g", "b"))).getField("b").alias("a"))
    return chunks.agg(F.flatten(F.array_sort(F.collect_list(F.struct("h", "a"))).getField("a")).alias("s")).scalar()


def candidate_texts(spark: SparkSession, docs: DataFrame, table: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(id, first, line)`` of the lines that occur in ``pairs``. Only lines
    whose hash meets the bit of one that is needed are grouped."""
    needed = pairs.select(F.col("l").alias("id")).distinct().unionByName(pairs.select(F.col("e").alias("id")).distinct()).distinct()
    keys = stored(spark, table.select("id", "first", "k1", "k2").join(needed, "id", "left_semi"), "needed")
    lines = lines_of(docs).select(F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"), "line",
                                  _bit_map(keys, "k1").alias("s"))
    word = F.get("s", (F.pmod(F.col("k1"), F.lit(NEEDED_BITS)) / 64).cast("int"))
    some = lines.where(F.getbit(word, F.pmod(F.col("k1"), F.lit(64)).cast("int")) == 1)
    texts = some.groupBy("k1", "k2").agg(F.first("line").alias("line"))
    return keys.join(texts, ["k1", "k2"]).select("id", "first", "line")


def _alike(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """``l`` of those ``pairs`` (later and earlier id) whose word sets are
    similar. Texts travel rather than sets of hashes, which are larger. Lines
    at the same place (documents that share an id, or have none) are neither
    earlier nor later."""
    at = lambda side: texts.select(F.col("id").alias(side), F.col("first").alias(side + "_first"),
                                   F.col("line").alias(side + "_line"))
    both = pairs.join(at("l"), "l").join(at("e"), "e").where(~F.col("l_first").eqNullSafe(F.col("e_first")))
    both = both.select("l", word_set("l_line").alias("a"), word_set("e_line").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return both.where(common * den >= (F.size("a") + F.size("b") - common) * num).select("l")


def later_matches(spark: SparkSession, docs: DataFrame, table: DataFrame, num: int = NUM,
                  den: int = DEN) -> DataFrame:
    """``id`` of the distinct lines of the written line ``table`` that are
    similar to an earlier one, as a written table.

    One earlier match removes a line, so each line is first verified against
    its hubs alone, and if it is like none of them against a few more of their
    crowd. Those found there need no other partner, though they stay partners of
    the others. Lines left are verified against their earliest
    candidate, and those that fail there against all others."""
    hubs = stored(spark, hub_pairs(table, num, den), "hubs")
    texts = stored(spark, candidate_texts(spark, docs, table, hubs), "hub-texts")
    first = stored(spark, _alike(hubs, texts, num, den).distinct(), "copies-of-hubs")
    more = stored(spark, crowd_pairs(table, hubs, first, num, den), "crowd")
    copies = stored(spark, first.unionByName(_alike(more, texts, num, den).distinct()), "copies")
    with _joins_on_part_of_the_key(spark):
        pairs = stored(spark, candidate_pairs(table, copies, num, den), "candidates")
    texts = stored(spark, candidate_texts(spark, docs, table, pairs), "texts")
    earliest = pairs.groupBy("l").agg(F.min("e").alias("e"))
    found = stored(spark, _alike(earliest, texts, num, den), "found")
    open_lines = earliest.join(found, "l", "left_anti").withColumnRenamed("e", "tried")
    rest = pairs.join(open_lines, "l").where("e > tried").select("l", "e")
    later = copies.unionByName(found).unionByName(_alike(rest, texts, num, den).distinct())
    return stored(spark, later.withColumnRenamed("l", "id"), "later")


def removed_lines(spark: SparkSession, docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed)`` per distinct doc_id.

    ``removed`` lists the numbers (from 0) of the lines with a Jaccard
    similarity of num / den or more to an earlier line, in the order of doc_id
    and line number. Lines without words are never removed. A null text has no
    lines, an empty one a single blank line. Rows that share a doc_id are the
    same document. Documents without id come after all others, as one
    document, and are not told apart: a line they alone hold stays wherever it
    is. Tokens are compared by 64-bit hashes. An empty table gives no rows. Ids
    are whole numbers of up to 20 digits; others fail in the cast. Further columns
    are ignored, whatever their names."""
    table = stored(spark, line_table(docs, num, den), "lines")
    similar = later_matches(spark, docs, table, num, den).withColumn("similar", F.lit(True))
    lines = docs.select(F.col("doc_id"), F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line")).select(
        "doc_id", "line_no", F.xxhash64("line").alias("k1"), F.hash("line").alias("k2"), place().alias("p"))
    worded = table.where("n > 0").select("id", "k1", "k2", "first", F.lit(True).alias("worded"))
    known = worded.join(similar, "id", "left").drop("id")
    judged = lines.join(known, ["k1", "k2"], "left")
    copy = F.coalesce(F.col("p") > F.col("first"), F.col("p").isNull() & F.col("first").isNotNull())
    gone = F.coalesce(F.col("worded") & (copy | F.coalesce("similar", F.lit(False))), F.lit(False))
    return judged.groupBy("doc_id").agg(
        (F.coalesce(F.max("line_no"), F.lit(-1)) + 1).cast("int").alias("n_lines"),
        F.array_sort(F.collect_set(F.when(gone, F.col("line_no")))).alias("removed")).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed")


def drop_similar_lines(spark: SparkSession, docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` without the removed lines; a document that loses all of its
    words that way goes. Documents without an id are not changed. All columns
    but text are kept as they are, whatever their names."""
    removed = stored(spark, removed_lines(spark, docs, num, den).where("n_removed > 0").select("doc_id", "removed"), "removed")
    rows = docs.select(F.struct(*[F.col(quote_name(c)) for c in docs.columns]).alias("row"), F.col("doc_id").alias("of"),
                       F.col("text"), F.split("text", "\n").alias("parts"))
    joined = rows.join(removed, F.col("of") == F.col("doc_id"), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("removed"))
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("parts"), i)), "\n")
    done = joined.select("row", "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")).otherwise(text).alias("text"))
    worded = F.rlike(F.col("text"), F.lit(r"[^\x20\x09-\x0D]"))
    return done.where(F.col("doc_id").isNull() | worded).select(
        *[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
