"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact similarity.

Words are runs of anything but ASCII white space, in lower case; a shingle is five words in a row (a shorter text has one
shingle, all its words). An item of m shingles is compared with every window of m shingles of a document (with the whole
document if that is shorter). All steps are DataFrame operations:

1. A window is made only if it holds as many shingles of items of its size as the least similarity takes; no other window
   can reach it.
2. A window has ``PRINTS`` fingerprints, from as many hashes of its shingles: the 64 majority bits of each, counted in packed
   lanes by plain sums.
3. A fingerprint is cut into ``BLOCKS`` blocks. If two fingerprints differ in at most ``RADIUS`` bits, then in some block
   they differ in at most RADIUS // BLOCKS; items are filed under all such block values, windows under their own,
   so that the join finds every pair that is within the radius by any of its fingerprints.
4. Fingerprints follow the cosine of the shingle counts. Where neither side repeats a shingle, a similarity of 0.8 means a
   cosine of 0.89, by which one fingerprint is beyond the radius for 1 to 3 pairs in a hundred and all four for less than
   one in a million. A repeated shingle lowers the cosine without such a bound, so the radius would be too wide: windows
   and items with repeated shingles, and only these, are paired by an exact join instead. A window that is like an item has
   one of the item's rarest shingles, of which as many are kept as the least similarity lets a window miss, and one more.
5. All these pairs are compared exactly: shingles shared over shingles in either, repeats counted.
6. An item of under five words is one run of words; it is looked for among the documents' runs of as many words.

Texts are told apart by a 128-bit hash, so equal texts are worked on once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import load, stage
from changeflow.llm.sketches import SHINGLE, shingle_hashes, words_of

SIMILARITY = 0.8
RADIUS = 15
PRINTS = 4
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
# Rows of (hash, size) that the items may have to be broadcast to the scan of the documents: 16 MB.
BROADCAST_ROWS = 1_000_000
KEY = ["k1", "k2"]


def _hashed(df: DataFrame, text: Column, *columns: str | Column) -> DataFrame:
    """``columns`` and ``h``, the hashes of the text's shingles (none for a text without words).

    Don't filter on ``h`` or explode it other than by the ``_outer`` functions before it is stored or joined: the filter
    would be moved below the projection, where the words are cut anew for each shingle.
    """
    split = df.select(*columns, words_of(F.lower(text)).alias("h"))
    return split.withColumn("h", shingle_hashes(F.col("h")))


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def fingerprints(df: DataFrame, by: list[str], hashes: str) -> DataFrame:
    """(by, fp): for each distinct ``by``, the 64 bits that are set in over half of ``hashes`` (array<bigint>).

    Two 32-bit counters share each of 32 sums, so that a row costs 32 additions and no row is expanded by bit.
    """
    lanes = (1 << 32) + 1
    each = df.select(*by, F.explode(hashes).alias("x"))
    sums = [F.sum(F.shiftrightunsigned("x", b).bitwiseAND(F.lit(lanes))).alias(f"s{b}") for b in range(32)]
    counted = each.groupBy(*by).agg(F.count("*").alias("m_"), *sums)
    fp = F.lit(0).cast("bigint")
    for b in range(32):
        low, high = F.col(f"s{b}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"s{b}", 32)
        bit = (1 << (b + 32)) - (1 << 64 if b == 31 else 0)
        fp = fp.bitwiseOR(F.when(low * 2 > F.col("m_"), F.lit(1 << b)).otherwise(F.lit(0)))
        fp = fp.bitwiseOR(F.when(high * 2 > F.col("m_"), F.lit(bit)).otherwise(F.lit(0)))
    return counted.select(*by, fp.alias("fp"))


def printed(df: DataFrame, by: list[str], hashes: str) -> DataFrame:
    """(by, f, fp): the fingerprints of each distinct ``by``, told by the number f of their hash."""
    each = df.select(*by, hashes, F.explode(F.array(*map(F.lit, range(PRINTS)))).alias("f"))
    other = F.transform(hashes, lambda x: F.xxhash64(F.col("f"), x))
    return fingerprints(each.withColumn(hashes, F.when(F.col("f") == 0, F.col(hashes)).otherwise(other)), [*by, "f"], hashes)


def plain(hashes: Column) -> Column:
    """Whether no shingle is repeated."""
    return F.size(F.array_distinct(hashes)) == F.size(hashes)


def block_values(fp: Column) -> Column:
    """(block, value) of a fingerprint's blocks."""
    mask = F.lit((1 << BLOCK_BITS) - 1)
    return F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(mask).cast("int").alias("value"))
        for b in range(BLOCKS)
    ])


def _near_values(value: Column) -> Column:
    """All block values that differ from ``value`` in at most RADIUS // BLOCKS bits."""
    masks = [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= RADIUS // BLOCKS]
    masks = F.split(F.lit(" ".join(map(str, masks))), " ").cast("array<int>")
    return F.transform(masks, lambda m: m.bitwiseXOR(value))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of hashes: a repeated shingle weighs as often as it occurs."""

    def times(x: Column, hashes: Column) -> Column:
        return F.size(F.filter(hashes, lambda y: y == x))

    repeats = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda total, x: total + F.least(times(x, a), times(x, b))
    )
    shared = F.when(plain(a) & plain(b), F.size(F.array_intersect(a, b))).otherwise(repeats)
    return shared / (F.size(a) + F.size(b) - shared)


def shared_needed(n: Column, m: Column, least: float) -> Column:
    """How many shingles, repeats counted, texts of ``n`` and ``m`` must share to have a similarity of ``least``."""
    return F.greatest(F.lit(1), F.ceil(least / (1 + least) * (n + m) - 1e-9).cast("int"))


def window_starts(hits: DataFrame, least: float) -> DataFrame:
    """(k1, k2, m, start) of the windows of m shingles that hold enough of the ``hits`` (KEY, n, at, m), the places of
    shingles of items of that size. A text's places are gathered: as many as it has shingles, at most."""
    held = hits.groupBy(*KEY, "m").agg(F.max("n").alias("n"), F.sort_array(F.collect_set("at")).alias("at"))
    held = held.withColumn("size", F.least("n", "m"))
    held = held.withColumn("need", shared_needed(F.col("size"), F.col("m"), least)).where(F.size("at") >= F.col("need"))

    def starts(far: Column, i: Column) -> Column:
        # Windows whose first hit is the i-th and that reach as far as the one which makes them enough.
        begin = F.greatest(F.lit(0), far - F.col("size") + 1, F.coalesce(F.get("at", i - 1) + 1, F.lit(0)))
        return F.struct(begin.alias("begin"), F.least(F.get("at", i), F.col("n") - F.col("size")).alias("end"))

    runs = F.transform(F.slice("at", F.col("need"), F.size("at")), starts)
    runs = held.select(*KEY, "m", F.inline(F.filter(runs, lambda r: r["begin"] <= r["end"])))
    return runs.select(*KEY, "m", F.explode(F.sequence("begin", "end")).alias("start"))


def rarest(wanted: DataFrame, least: float) -> DataFrame:
    """(item, m, x): so many of each item's shingles, those in the fewest items first, that a window without any of them
    is less alike than ``least``."""
    each = wanted.select("item", "m", F.explode("h").alias("x"))
    spread = each.groupBy("x", "m").agg(F.count_distinct("item").alias("items"))
    order = F.row_number().over(Window.partitionBy("item").orderBy("items", "x"))
    missed = F.col("m") - F.ceil(least * F.col("m") - 1e-9)
    return each.join(spread, ["x", "m"]).withColumn("order", order).where(F.col("order") <= missed + 1).select("item", "m", "x").distinct()


def matches(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    least: float = SIMILARITY,
) -> DataFrame:
    """(k1, k2, item_id, similarity, distance, start_word, n_words): for each text, by its hash, and item that are
    alike, the most similar window, the earliest among equals; ``distance`` is that of the fingerprints.

    NULL and empty texts and items match nothing; repeated items match each; an empty table on either side gives no rows.
    """
    every = items.select(F.col(item_id).alias("item_id"), words_of(F.lower(F.col(item_text))).alias("words"))
    every = stage(every.where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()))
    wanted = every.where(F.size("words") >= SHINGLE).withColumn("h", shingle_hashes(F.col("words"))).drop("words")
    wanted = stage(wanted.withColumn("m", F.size("h")).withColumn("plain", plain(F.col("h"))))
    grams = stage(wanted.select(F.explode("h").alias("x"), "m").distinct())
    rare = stage(rarest(wanted, least))
    if grams.count() <= BROADCAST_ROWS:
        grams = F.broadcast(grams)
    if rare.count() <= BROADCAST_ROWS:
        rare = F.broadcast(rare)

    source = docs.select(F.col(text).alias("text"), *_keys(F.col(text)))
    spread = _hashed(source, F.col("text"), *KEY).select(*KEY, F.size("h").alias("n"), F.posexplode_outer("h").alias("at", "x"))
    hits = spread.join(grams, "x").select(*KEY, "n", "at", "m")
    starts = stage(window_starts(hits, least))

    # The keys grow with the corpus, so this join shuffles at every size. Both what it reads and what it makes are stored, so
    # that it can split a text with very many copies, and each task keeps one of them.
    found = stage(starts.select(*KEY).distinct())
    texts = stage(source.join(found.hint("merge"), KEY, "left_semi"))
    texts = texts.groupBy(*KEY).agg(F.min("text").alias("text"))
    texts = _hashed(texts, F.col("text"), *KEY)
    window = ["k1", "k2", "m", "start"]
    windows = starts.join(texts, KEY).select(*window, F.slice("h", F.col("start") + 1, F.col("m")).alias("w"))
    windows = stage(windows.withColumn("plain", plain(F.col("w"))))

    own = stage(printed(windows, [*window, "plain"], "w"))
    filed = own.where("plain").select(*window, "f", "fp", F.inline(block_values(F.col("fp"))))
    items_own = stage(printed(wanted, ["item", "m", "plain"], "h").withColumnRenamed("fp", "item_fp"))
    theirs = items_own.where("plain").select("item", "m", "f", "item_fp", F.inline(block_values(F.col("item_fp"))))
    theirs = theirs.select("item", "m", "f", "item_fp", "block", F.explode(_near_values(F.col("value"))).alias("value"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # Items are filed under thousands of values each, so this side isn't broadcast.
    close = filed.join(theirs.hint("merge"), ["f", "m", "block", "value"]).where(distance <= RADIUS).select(*window, "item")
    theirs = rare.join(wanted.select("item", F.col("plain").alias("item_plain")), "item")
    shared = windows.select(*window, "plain", F.explode("w").alias("x")).join(theirs, ["m", "x"])
    shared = shared.where("NOT (plain AND item_plain)").select(*window, "item")
    pairs = close.unionByName(shared).distinct()
    own, items_own = own.where("f = 0").drop("f", "plain"), items_own.where("f = 0").drop("f", "plain")
    windows, wanted = windows.drop("plain"), wanted.drop("plain")

    compared = pairs.join(windows, window).join(own, window).join(wanted.drop("m"), "item")
    compared = compared.join(items_own.drop("m"), "item").withColumn("distance", distance)
    compared = compared.withColumn("similarity", similarity(F.col("w"), F.col("h"))).where(F.col("similarity") >= least)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "distance", F.size("w").alias("size"), "item_id"))
    found = compared.groupBy(*KEY, "item").agg(best.alias("best"))
    found = found.select(
        *KEY,
        "best.item_id",
        "best.similarity",
        "best.distance",
        (-F.col("best.s")).cast("bigint").alias("start_word"),
        (F.col("best.size") + SHINGLE - 1).cast("bigint").alias("n_words"),
    )
    short = every.where(F.size("words") < SHINGLE)
    for n in sorted(r[0] for r in short.select(F.size("words")).distinct().collect()):
        found = found.unionByName(_short_matches(source, short.where(F.size("words") == n), n))
    return found


def _short_matches(source: DataFrame, short: DataFrame, n: int) -> DataFrame:
    """The first run of ``n`` words of each text that is one of the items of ``n`` words."""
    words = source.select(*KEY, words_of(F.lower(F.col("text"))).alias("words"))
    starts = F.slice("words", 1, F.greatest(F.size("words") - (n - 1), F.lit(0)))
    runs = F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get("words", i + j) for j in range(1, n)]))
    runs = words.select(*KEY, runs.alias("runs")).select(*KEY, F.posexplode_outer("runs").alias("at", "run"))
    met = runs.join(short.select("item_id", "item", F.concat_ws(" ", "words").alias("run")), "run")
    first = met.groupBy(*KEY, "item").agg(F.min("at").alias("at"), F.min("item_id").alias("item_id"))
    return first.select(
        *KEY, "item_id", F.lit(1.0).alias("similarity"), F.lit(0).alias("distance"), F.col("at").cast("bigint").alias("start_word"),
        F.lit(n).cast("bigint").alias("n_words"),
    )


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document row and item that it holds: doc_id and the columns of :func:`matches`."""
    found = stage(matches(docs, items, text, **options))
    named = docs.select(F.col(doc_id).alias("doc_id"), *_keys(F.col(text)))
    return named.join(found, KEY).drop(*KEY)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents that hold no item. All columns are kept, whatever their names."""
    found = stage(matches(docs, items, text, **options).select(*KEY).distinct())
    k1, k2 = _keys(docs[text])
    return docs.join(found.hint("merge"), (k1 == found.k1) & (k2 == found.k2), "left_anti")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
