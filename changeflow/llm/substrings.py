"""Substring dedup: word passages that a document with a smaller id has too are found with FM-indexes and cut.

Words are runs of anything but ASCII white space, unchanged. A window is ``window`` words in a row. To compare only
windows that can be equal, each is filed under its anchor, the four-word run in it that comes first in a fixed order
(longest first, so that it is rarely a run of common words); equal windows have equal anchors.

1. Anchors are gathered with the ids of their documents, pre-aggregated per chunk of texts, and kept if two documents share
   one. A chunk with very many documents of an anchor knows that itself: their ids go on without meeting those of other
   chunks, and a note of the anchor, one a task, tells the others.
2. The texts are cut into passages, runs of windows with one shared anchor. Equal passages of a chunk become one row with
   the places where they stand in the document with the least id; the places in all others are known to be repeats, and go
   on as intervals that are dealt out by document. An anchor that very many documents share would still bring many passages
   together (the text around it differs); its windows are dealt out one by one, by all their words, and a task sends a window
   again only for a smaller id. So a shard gets a few rows a task of any passage, however many documents have it.
3. Each shard of anchors gets a compressed FM-index over the words of its passages: bit vectors and counts, no suffix array.
   The passages are streamed past it, and backward search over its wavelet matrix gives the matching statistic of every
   window's end: the length of the longest part before it that stands elsewhere, too. Where that reaches the threshold, the
   windows with one interval of suffixes are equal, and the least document id among them tells which are repeats.
4. Per document the covered words are joined to intervals.

Ids are compared, but places belong to a row: an id and a 128-bit hash of the text. Rows that share an id and not the text
have their own intervals each.

A shard's size is set by its number of passages, so that index and passages fit in one task at any size of the corpus. What a
chunk sends where depends on the order of its rows: texts are sorted before they are cut, and the documents given should come
from storage, so that a task done again sends the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import fresh_name, load, numbered, release, short_batches, stage
from changeflow.llm.fm_index import FMIndex

WINDOW = 13
ANCHOR = 4
# Passages per shard, the number of documents (of all, or of one chunk) from which an anchor's windows are dealt out singly,
# characters of text that a task turns into rows at a time, anchors or windows that a task remembers to have sent.
SHARD_PASSAGES = 20_000
COMMON_ANCHOR = 2_000
CROWDED_ANCHOR = 64
CHUNK_CHARS = 3_000_000
REMEMBERED = 200_000
ODD = np.uint64(0x9E3779B97F4A7C15)
# What tells the row of a place: id and text hash.
ROW = ["id", "k1", "k2"]


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _anchors(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the rank of its anchor (equal for equal anchors only) and where the anchor stands."""
    n, size = len(words), min(ANCHOR, window)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    runs, total = np.zeros(n - size + 1, np.uint64), np.zeros(n - size + 1, np.int64)
    for i in range(size):
        runs = (runs ^ hashes[i:n - size + 1 + i]) * ODD
        runs ^= runs >> np.uint64(29)
        total += lengths[i:n - size + 1 + i]
    ranks = ((63 - np.minimum(total, 63)).astype(np.uint64) << np.uint64(57)) | (runs >> np.uint64(7))
    views = np.lib.stride_tricks.sliding_window_view(ranks, window - size + 1)
    at = np.concatenate([views[i:i + (1 << 18)].argmin(axis=1) for i in range(0, len(views), 1 << 18)])
    at += np.arange(len(at))
    return ranks[at].view(np.int64), at


def _gathered(window: int):
    """Distinct anchors of a chunk of documents with the ids of the documents that have them. Rows of one anchor and ``salt`` 0
    are to meet; lists of crowded anchors have another one, and their anchors' notes no ids."""

    def rows(anchors: list[np.ndarray], ids: list[int], told: set[int]) -> pa.RecordBatch:
        every = np.concatenate([np.empty(0, np.int64), *anchors])
        owners = np.repeat(np.array(ids, np.int64), [len(a) for a in anchors])
        order = np.lexsort((owners, every))
        every, owners = every[order], owners[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (owners[1:] != owners[:-1])
        every, owners = every[new], owners[new]
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, int)
        offsets = np.append(first, len(every))
        crowded = np.diff(offsets) >= CROWDED_ANCHOR
        notes = [a for a in every[first[crowded]].tolist() if a not in told]
        if len(told) > REMEMBERED:
            told.clear()
        told.update(notes)
        anchor = np.append(every[first], np.array(notes, np.int64))
        salt = np.zeros(len(anchor), np.int64)
        salt[:len(first)][crowded] = 1 + (ids[0] & (1 << 62) - 1) if ids else 0
        crowded = np.append(crowded, np.ones(len(notes), bool))
        offsets = np.append(offsets, np.full(len(notes), len(every)))
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(owners))
        columns = [pa.array(anchor), pa.array(salt), lists, pa.array(crowded)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "ids", "crowded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, ids, chars, told = [], [], 0, set()
        for batch in batches:
            for doc, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist()):
                words = text.encode("utf-8").split() if doc is not None and text else []
                if len(words) >= window:
                    anchors.append(np.unique(_anchors(words, window)[0]))
                    ids.append(doc)
                    chars += len(text)
                if chars > CHUNK_CHARS:
                    yield rows(anchors, ids, told)
                    anchors, ids, chars = [], [], 0
                    release()
        yield rows(anchors, ids, told)

    return run


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """(id, anchor, common) of anchors that at least two document ids have."""
    rows = docs.mapInArrow(_gathered(window), "anchor long, salt long, ids array<long>, crowded boolean")
    every = Window.partitionBy("anchor", "salt")
    rows = rows.select(
        "anchor",
        "ids",
        F.min(F.array_min("ids")).over(every).alias("low"),
        F.max(F.array_max("ids")).over(every).alias("high"),
        F.sum(F.size("ids")).over(every).alias("n"),
        F.max("crowded").over(every).alias("crowded"),
    )
    rows = rows.where("crowded OR low < high")
    common = F.col("crowded") | (F.col("n") > COMMON_ANCHOR)
    return rows.select(F.explode("ids").alias("id"), "anchor", common.alias("common"))


def _merged(places: np.ndarray) -> np.ndarray:
    """Rows (number, begin, end) joined where they touch."""
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    begins, ends = (places[:, 0] << 40) + places[:, 1], np.maximum.accumulate((places[:, 0] << 40) + places[:, 2])
    first = np.flatnonzero(np.append(True, begins[1:] > ends[:-1]))
    stops = np.append(first[1:], len(places)) - 1
    return np.column_stack([places[first, 0], places[first, 1], ends[stops] & (1 << 40) - 1])


def _passages(window: int, shards: int):
    """Rows for the shards: passages with the places (row, start) where they stand, and, with empty ``words``, intervals (row;
    begin, end) that are repeats already."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[int, bytes], tuple[list[int], list[int]]] = {}
        owners: list[tuple[int, int, int]] = []
        singles: set[tuple[int, bytes]] = set()
        sent: dict[bytes, int] = {}  # the least id with which a single window went on
        chars = 0

        def flush() -> Iterator[pd.DataFrame]:
            if not found:
                return
            sizes = np.fromiter((len(numbers) for numbers, _ in found.values()), np.int64, len(found))
            numbers = np.fromiter(chain.from_iterable(n for n, _ in found.values()), np.int64, sizes.sum())
            starts = np.fromiter(chain.from_iterable(s for _, s in found.values()), np.int64, sizes.sum())
            rows = np.array(owners, np.int64).reshape(-1, len(ROW))
            at, ids = np.repeat(np.arange(len(found)), sizes), rows[numbers, 0]
            least = np.minimum.reduceat(ids, np.cumsum(sizes) - sizes)
            if len(sent) > REMEMBERED:
                sent.clear()
            for k, key in enumerate(found if singles else ()):
                if key in singles:
                    least[k] = sent[key[1]] = min(int(least[k]), sent.get(key[1], int(least[k])))
            gone = ids > least[at]
            if gone.any():
                lengths = np.zeros(len(found), np.int64)
                some = set(at[gone].tolist())
                for k, key in enumerate(found):
                    if k in some:
                        lengths[k] = key[1].count(b" ") + 1
                places = _merged(np.column_stack([numbers[gone], starts[gone], starts[gone] + lengths[at[gone]]]))
                row = rows[places[:, 0]]
                shard = ((row[:, 0] ^ row[:, 1]).view(np.uint64) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                shard, row, places = shard[order], row[order].astype("<i8"), places[order, 1:].astype("<i8")
                edges = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)).tolist()
                yield pd.DataFrame({
                    "shard": shard[edges[:-1]],
                    "words": [b""] * (len(edges) - 1),
                    "owners": [row[i:j].tobytes() for i, j in zip(edges, edges[1:])],
                    "starts": [places[i:j].tobytes() for i, j in zip(edges, edges[1:])],
                })
            stay = np.bincount(at[~gone], minlength=len(found))
            ends = np.cumsum(stay).tolist()
            cuts = list(zip([0, *ends], ends))
            row, start = rows[numbers[~gone]].astype("<i8").tobytes(), starts[~gone].astype("<i8").tobytes()
            size = 8 * len(ROW)
            out = pd.DataFrame({
                "shard": [key[0] for key in found],
                "words": [key[1] for key in found],
                "owners": [row[size * i:size * j] for i, j in cuts],
                "starts": [start[8 * i:8 * j] for i, j in cuts],
            })
            yield out[stay > 0]
            found.clear()
            owners.clear()
            singles.clear()

        def note(shard: int, words: list[bytes], start: int, single: bool = False) -> None:
            key = (shard, b" ".join(words))
            numbers, starts = found.setdefault(key, ([], []))
            numbers.append(len(owners) - 1)
            starts.append(start)
            if single:
                singles.add(key)

        for batch in batches:
            columns = (batch[c] for c in [*ROW, "text", "anchors", "common"])
            for doc, k1, k2, text, anchors, common in zip(*columns):
                if anchors is None or not text:
                    continue
                owners.append((int(doc), k1, k2))
                words = text.encode("utf-8").split()
                ranks, at = _anchors(words, window)
                order = np.argsort(anchors)
                anchors, common = np.asarray(anchors, np.int64)[order], np.asarray(common, bool)[order]
                place = np.minimum(np.searchsorted(anchors, ranks), len(anchors) - 1)
                shared = anchors[place] == ranks
                edge = np.ones(len(at) + 1, bool)  # where a run of windows with one anchor begins
                edge[1:-1] = at[1:] != at[:-1]
                edge = np.flatnonzero(edge).tolist()
                for i, j in zip(edge, edge[1:]):
                    if not shared[i]:
                        continue
                    if common[place[i]]:
                        for k in range(i, j):
                            each = words[k:k + window]
                            note(xxhash.xxh64_intdigest(b" ".join(each)) % shards, each, k, single=True)
                    else:
                        shard = int(ranks[i]) * int(ODD) % (1 << 64) % shards
                        note(shard, words[i:j + window - 1], i)
                chars += len(text)
                if chars > CHUNK_CHARS:
                    yield from flush()
                    chars = 0
                    release()
        yield from flush()

    return run


def least_owner(passages: list[bytes], owners: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of each passage (words joined by a space; one passage after the other), the least owner of a
    passage that has it; and the number of windows of each passage. Found by backward search in an FM-index of the
    passages."""
    numbers = numbered()
    numbers[b""]  # the first number: what stands between two passages
    words = (b"  ".join(passages) + b" ").split(b" ")
    text = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) + 1
    lengths = np.fromiter((p.count(b" ") for p in passages), np.int64, len(passages)) + 2
    counts = lengths - window
    starts = np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    index = FMIndex(text, window)
    patterns = np.lib.stride_tricks.sliding_window_view(text, window)[starts]
    # An interval of one suffix holds the window's own place alone, whatever words come before.
    low, high, length = index.search(patterns, stop_at=1)
    elsewhere = np.where(high - low > 1, length, length - 1)  # the matching statistics, a window's own place left out
    least = np.repeat(owners, counts)
    many = elsewhere >= window
    if many.any():
        # Every place in an interval is that of a window streamed past, so the owners are at hand without suffixes.
        where = np.unique(low[many], return_inverse=True)[1]
        lowest = np.full(where.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, where, least[many])
        least[many] = lowest[where]
    return least, counts


def _repeats(window: int):
    """The covered intervals of the rows of one shard."""

    def known(rows: pd.DataFrame) -> np.ndarray:
        places, bounds = (np.frombuffer(b"".join(rows[c]), "<i8") for c in ("owners", "starts"))
        return np.column_stack([places.reshape(-1, len(ROW)), bounds.reshape(-1, 2)])

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        cut = rows["words"].map(len) == 0
        out = [known(rows[cut]), searched(rows[~cut])] if not cut.all() else [known(rows)]
        release()
        return pd.DataFrame(np.concatenate(out), columns=[*ROW, "begin", "end"])

    def searched(rows: pd.DataFrame) -> np.ndarray:
        passages = numbered()
        at = np.fromiter(map(passages.__getitem__, rows["words"]), np.int64, len(rows))
        at = np.repeat(at, rows["starts"].map(len).to_numpy(np.int64) // 8)
        places, begins = (np.frombuffer(b"".join(rows[c]), "<i8") for c in ("owners", "starts"))
        places = places.reshape(-1, len(ROW))
        docs = places[:, 0].copy()
        owners = np.full(len(passages), np.iinfo(np.int64).max)
        np.minimum.at(owners, at, docs)
        least, counts = least_owner(list(passages), owners, window)
        first = np.cumsum(counts) - counts
        whole = docs > np.maximum.reduceat(least, first)[at]
        out = [np.column_stack([places[whole], begins[whole], begins[whole] + counts[at[whole]] + window - 1])]
        for k in np.flatnonzero(~whole & (docs > np.minimum.reduceat(least, first)[at])):
            own = least[first[at[k]]:first[at[k]] + counts[at[k]]]
            hits = np.flatnonzero(own < docs[k])
            for part in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
                out.append(np.array([[*places[k], begins[k] + part[0], begins[k] + part[-1] + window]]))
        return np.concatenate(out)

    return run


def repeated_intervals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, k1, k2, spans): for rows with words to cut, told by their id and the hash of their text, the intervals
    [begin, end) of word numbers, from 0, that windows cover which also start in a row with a smaller id; intervals may
    overlap.

    Rows that share an id don't repeat each other. Rows without id, NULL or shorter texts have no intervals and cause none.
    """
    rows = short_batches(docs).select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    anchors = stage(shared_anchors(rows, window))
    passages = anchors.agg(F.sum(F.when(F.col("common"), 10).otherwise(1))).first()[0] or 0
    shards = passages // SHARD_PASSAGES + 1
    # Each id's anchors are collected: as many as its texts have, at most.
    own = anchors.groupBy("id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("common").alias("common"))
    own = own.withColumnRenamed("id", "owner")
    found = rows.join(own.hint("merge"), F.col("id") == F.col("owner"), "left")
    found = found.select("id", *_keys(F.col("text")), "text", "anchors", "common").sortWithinPartitions(*ROW)
    found = found.mapInPandas(_passages(window, shards), "shard long, words binary, owners binary, starts binary")
    spans = found.groupBy("shard").applyInPandas(_repeats(window), "id long, k1 long, k2 long, begin long, end long")
    return spans.groupBy(*ROW).agg(F.collect_set(F.struct("begin", "end")).alias("spans"))


def _cut(text: str | None, spans) -> tuple[int, int, str | None]:
    words = (text or "").encode("utf-8").split()
    if spans is None or not len(spans):
        return len(words), 0, None
    gone = np.zeros(len(words) + 1, np.int64)
    for span in spans:
        gone[span["begin"]] += 1
        gone[span["end"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    kept = [w for w, k in zip(words, keep) if k]
    return len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8")


def cut(text: Column, spans: Column) -> Column:
    """struct(n_words, n_removed, kept): what is left of a text without its spans, its words joined by a space;
    ``kept`` is NULL where nothing is removed."""

    @pandas_udf("n_words long, n_removed long, kept string")
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_cut(t, s) for t, s in zip(texts, lists)], columns=["n_words", "n_removed", "kept"])

    return of(text, spans)


def _digests(texts: Column, spans: Column) -> Column:
    @pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        rows = []
        for text, each in zip(texts, lists):
            n, removed, kept = _cut(text, each)
            kept = b" ".join((text or "").encode("utf-8").split()) if kept is None else kept.encode("utf-8")
            rows.append((n, removed, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    return of(texts, spans)


def with_spans(docs: DataFrame, doc_id: str, text: str, name: str, window: int = WINDOW) -> DataFrame:
    """``docs`` with the intervals to cut from each text as column ``name``."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the documents have a column {name} already")
    row = fresh_name(docs, *ROW)
    spans = repeated_intervals(docs, doc_id, text, window).toDF(*row, name)
    # Equal ids alone deal out the texts, so that this join reads the shuffled texts of the anchors' join again.
    same = docs[doc_id] == spans[row[0]]
    for mine, theirs in zip(_keys(docs[text]), row[1:]):
        same &= mine.bitwiseXOR(spans[theirs]) == 0
    return docs.join(spans.hint("merge"), same, "left").drop(*row)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    cuts = with_spans(docs, "id", "text", "spans").select(
        F.col("id").alias("doc_id"), _digests(F.col("text"), F.col("spans")).alias("cut")
    )
    return cuts.select("doc_id", "cut.n_words", "cut.n_removed", "cut.kept_sha256")


# Passages of 13 words as DuckDB sees them: every window, with the least document that has it.
OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS low FROM g) WHERE low < doc_id
), c AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM r) GROUP BY doc_id
), k AS (
  SELECT w.doc_id, len(ws) AS n, coalesce(len(gone), 0) AS removed,
         CASE WHEN gone IS NULL THEN ws
              ELSE list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: NOT list_contains(gone, z[2])),
                                  lambda z: z[1]) END AS kept
  FROM w LEFT JOIN c ON w.doc_id = c.doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
"""
