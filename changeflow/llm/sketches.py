"""Document fingerprints: the k least hashes of a text's distinct word shingles (a bottom-k sketch).

Words are runs of anything but ASCII white space, case kept; a shingle is five words in a row (a shorter text has one
shingle, all its words; a text without words has none, and an empty sketch). All of it is column expressions: sketches
are sorted arrays of bigint, so those of the parts of a text or corpus can be merged, and estimates come from the arrays
alone. With k = 128 an estimated resemblance r has a standard error of sqrt(r (1 - r) / 128), at most 0.045.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import fresh_name, load, stage

K = 128
SHINGLE = 5
SPACE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def shingle_hashes(words: Column, shingle: int = SHINGLE) -> Column:
    """The hash of each shingle, repeats included. ``words`` must be a column, not an expression: it is read often."""
    n = F.size(words)
    starts = F.slice(words, 1, F.greatest(n - (shingle - 1), F.lit(0)))
    rolled = F.transform(starts, lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, shingle)]))
    whole = F.array(F.xxhash64(F.array_join(words, " ")))
    return F.when(n >= shingle, rolled).when(n > 0, whole).otherwise(F.array().cast("array<bigint>"))


def sketch_of(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, by: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """(by, sketch): one merged sketch per group. No group is gathered: the k least hashes are kept from the map side
    on. Groups whose sketches are all empty or NULL have an empty sketch; a NULL group is a group."""
    hashes = df.select(F.col(by).alias("g"), F.explode(sketch).alias("h")).distinct()
    least = Window.partitionBy("g").orderBy("h")
    top = hashes.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k)
    found = top.groupBy("g").agg(F.sort_array(F.collect_list("h")).alias("s"))
    groups = df.select(F.col(by).alias("group")).distinct()
    empty = F.array().cast("array<bigint>")
    return groups.join(found, F.col("group").eqNullSafe(F.col("g")), "left").select(
        F.col("group").alias(by), F.coalesce("s", empty).alias("sketch")
    )


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard resemblance, 0 to 1; exact while the union has at most k shingles. Two empty sketches
    resemble each other fully, an empty and another one not at all."""
    union = merged(a, b, k)
    shared = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(sketch, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; an empty a is contained in anything."""
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits per hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def sketches(docs: DataFrame, text: str, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the sketch of a text column as ``name``; a NULL text counts as empty."""
    (words,) = fresh_name(docs, "words")
    split = docs.withColumn(words, words_of(F.col(text)))
    hashed = split.withColumn(words, shingle_hashes(F.col(words), shingle))
    return hashed.withColumn(name, sketch_of(F.col(words), k)).drop(words)


def _neighbours(docs: DataFrame) -> DataFrame:
    """(id, before, need, n): each distinct id, the id before it in ascending order (before the first: the last), how
    many characters the rows of that one may need at most, and how often the id occurs.

    Ids alone are ordered, in ranges; ranges meet through one row each.
    """
    ids = docs.groupBy("id").agg(F.max(F.floor(F.length("text") / 2)).alias("half"), F.count("*").alias("n"))
    ranges = stage(ids.repartitionByRange("id").withColumn("range", F.spark_partition_id()))
    last = F.max(F.struct(F.col("id").isNotNull(), "id", "half"))
    order = Window.orderBy("range")  # one row per range
    ends = ranges.groupBy("range").agg(last.alias("last"))
    ends = ends.select(
        "range", F.coalesce(F.lag("last").over(order), F.max_by("last", "range").over(Window.partitionBy())).alias("last")
    )
    inside = Window.partitionBy("range").orderBy("id")
    rows = ranges.select(
        "id", "n", "range", F.row_number().over(inside).alias("at"),
        F.lag("id").over(inside).alias("lag_id"), F.lag("half").over(inside).alias("lag_half"),
    ).join(ends, "range")
    first = F.col("at") == 1
    return stage(rows.select(
        "id",
        "n",
        F.when(first, F.col("last.id")).otherwise(F.col("lag_id")).alias("before"),
        F.when(first, F.col("last.half")).otherwise(F.col("lag_half")).alias("need"),
    ))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text, next_start, next_sketch): each document with the sketch of the next one by ascending id, and as much
    of the start of that one's text as replaces its own second half.

    After the last document comes the first. Rows that share an id have the same next one; of the rows of the next id,
    the least text counts. NULL texts are empty; a NULL id comes first, as one id. Texts are shuffled once, their
    starts once more.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    beside = _neighbours(rows).withColumnRenamed("id", "own")
    placed = rows.join(beside.hint("merge"), F.col("id").eqNullSafe(F.col("own"))).drop("own")
    again = placed.where("n > 1").groupBy("id").agg(
        F.min("text").alias("text"), F.first("before").alias("before"), F.first("need").alias("need")
    )
    columns = ["before", "need", "text"]
    starts = sketches(placed.where("n = 1").select(*columns).unionByName(again.select(*columns)), "text", "next_sketch")
    starts = starts.select("before", F.left("text", F.col("need").cast("int")).alias("next_start"), "next_sketch")
    return rows.join(starts, F.col("id").eqNullSafe(F.col("before"))).drop("before")


def op2_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(load(spark, sf_dir, "documents"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_start", half))
    rows = rows.withColumn("edited", edited)
    rows = sketches(sketches(rows, "text", "own_sketch"), "edited", "edited_sketch")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own_sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("own_sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("own_sketch"), F.col("next_sketch")).alias("near_next"),
    )
