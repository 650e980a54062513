"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A document's words are runs of anything but ASCII white space, A-Z in lower case; its shingles are ``shingle``
words in a row, repeats included, joined by a space (fewer words: all of them). A bit of the fingerprint is 1 if
it is set in over half of the shingles' XXH64 values. Texts without words, NULL among them, have fingerprint 0.

Two fingerprints are linked if at most ``max_bits`` bits differ. They are cut into ``max_bits + 3`` blocks, of which
such a pair shares at least three; so each fingerprint is filed under every choice of three blocks, and only those
that share a key are compared. Keys of three blocks are wide, so that few unrelated fingerprints meet, and no close
pair can be missed. Equal fingerprints are one node, so copies add no pairs. Ties, repeated rows and rows without
id are described at each function.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import fresh_name, load, short_batches, stage, unstage
from changeflow.llm.components import connected_components

SEED = 42
SHARED_BLOCKS = 3
# Shingles whose bits are counted at a time: bounds a task's memory on very long texts.
CHUNK = 1 << 16


def _fingerprint(text: str | None, shingle: int) -> int:
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at:at + CHUNK], stops[at:at + CHUNK])
        hashes = np.array([xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans], ">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The fingerprint as a bigint."""

    @pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


def block_keys(fp: Column, max_bits: int) -> Column:
    """The keys of a fingerprint: one for each choice of blocks that a close pair may share."""
    n = max_bits + SHARED_BLOCKS
    edges = [64 * i // n for i in range(n + 1)]

    def block(i: int) -> Column:
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1)

    keys = []
    for index, chosen in enumerate(combinations(range(n), SHARED_BLOCKS)):
        key, bits = F.lit(index).cast("bigint"), 0
        for i in chosen:
            bits = edges[i + 1] - edges[i]
            key = F.shiftleft(key, bits).bitwiseOR(block(i))
        keys.append(key)
    return F.array(*keys)


def close_pairs(nodes: DataFrame, max_bits: int) -> DataFrame:
    """(u, v) for all distinct fingerprints ``nodes(fp)`` at most ``max_bits`` bits apart, u < v."""
    filed = nodes.select("fp", F.explode(block_keys(F.col("fp"), max_bits)).alias("key"))
    a, b = filed.select("key", F.col("fp").alias("u")), filed.select("key", F.col("fp").alias("v"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
    return a.join(b, "key").where(near).select("u", "v").distinct()


def named(rows: DataFrame, max_bits: int) -> DataFrame:
    """For each fingerprint of the stored ``rows(doc_id, fp)``: component_id and kept_fp (see ``components``)."""
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = connected_components(close_pairs(nodes, max_bits))  # stored already
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "fp"))
    groups = rooted.groupBy("root").agg(first.alias("first"))
    found = rooted.join(groups, "root")
    found = stage(found.select("fp", F.col("first.least_id").alias("component_id"), F.col("first.fp").alias("kept_fp")))
    unstage(nodes)
    unstage(roots)
    return found


def components(rows: DataFrame, max_bits: int = 4) -> DataFrame:
    """``rows(doc_id, fp)`` with ``component_id``, the least doc_id reachable, and ``kept_fp``, the fingerprint
    of the one row of the component to keep. NULL ids are linked like others but name a component only if it
    has no other id (then component_id is NULL). Repeated rows stay repeated."""
    rows = stage(rows)
    return rows.join(named(rows, max_bits), "fp")


def fingerprinted(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    fp = fingerprint(F.col(text), shingle)
    return short_batches(docs).select(F.col(doc_id).alias("doc_id"), fp.alias("fp"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per document: doc_id, fp (bigint), component_id, kept_fp. An empty table gives no rows."""
    return components(fingerprinted(docs, doc_id, text, shingle), max_bits)


def deduplicate(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """The documents without near-duplicates: one row of each component stays, that with the least id.

    Rows with the same id and fingerprint count as repeats of each other, of which the one with the least
    text stays. All columns are kept, whatever their names.
    """
    fp, component, kept, rank = fresh_name(docs, "fp", "component_id", "kept_fp", "rank")
    rows = stage(fingerprinted(docs, doc_id, text, shingle))
    # Counted before the join: after it, the rows of a fingerprint would be grouped where the join has brought them together.
    counts = rows.groupBy("doc_id", "fp").agg(F.count("*").alias("n"))
    loser = ~(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("kept_fp")))
    marks = counts.join(named(rows, max_bits), "fp").select("doc_id", "fp", "n", loser.alias("loser"))
    marks = stage(marks.where("loser OR n > 1"))
    unstage(rows)

    def marked(part: DataFrame, which: str, how: str) -> DataFrame:
        few = marks.where(which).select(F.col("doc_id").alias(component), F.col("fp").alias(kept))
        part = part.withColumn(fp, fingerprint(F.col(text), shingle))
        return part.join(few.hint("merge"), part[doc_id].eqNullSafe(few[component]) & (part[fp] == few[kept]), how)

    single = marked(docs, "loser OR n > 1", "left_anti").select(*docs.columns)
    # Texts with a repeated id and fingerprint are few as a rule: only texts of their ids are hashed and moved again.
    ids = marks.where("NOT loser AND n > 1").select(F.col("doc_id").alias(component))
    repeated = docs.join(ids, docs[doc_id].eqNullSafe(ids[component]), "left_semi")
    first = Window.partitionBy(doc_id, fp).orderBy(text)
    repeated = marked(repeated, "NOT loser AND n > 1", "left_semi").withColumn(rank, F.row_number().over(first))
    return single.unionByName(repeated.where(F.col(rank) == 1).select(*docs.columns))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
