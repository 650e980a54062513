"""Sampled segmentation into the pieces of a SentencePiece vocabulary, and lossless decoding.

All ways to cut a text into pieces form a lattice. Forward filtering sums, for each position, the weight of all ways to get
there; backward sampling then draws one way from the end, each piece with its probability given what follows. The draws are
hashes of the row's key, so the same row is always cut alike, on any cluster and after any retry.

A piece has a space only in front, so the lattice falls apart at spaces into words, and the lattice of a word is the same
wherever it stands: it is filtered once per distinct word of a chunk of texts, and all words are sampled together, one piece
of each at a time. Characters that no piece has become their UTF-8 bytes, and so does the character that stands for the space
where a text has it itself; so decoding gives back every text.

A vocabulary made by merges has ranks and no probabilities; a piece of rank r weighs 1 / (r + 2), as word frequencies fall
with rank. ``alpha`` sharpens (above 1) or flattens (below 1) the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType

from changeflow.llm.common import fresh_name, load, numbered, release, short_batches

SPACE = "▁"
ALPHA = 1.0
SEED = 3
CHUNK_CHARS = 2_000_000
GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Pieces, their log weights, and a trie of them over character numbers."""

    def __init__(self, path: str, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes: list[bytes] = []
        self.byte_ids = np.zeros(256, np.int64)
        children: dict[tuple[int, int], int] = {}
        ends: dict[int, tuple[int, float]] = {}
        chars: dict[str, int] = {}
        nodes, total = 1, 0.0
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
                continue
            self.bytes.append(piece.replace(SPACE, " ").encode("utf-8"))
            if SPACE in piece[1:]:
                continue  # runs of spaces are cut space by space
            weight = 1.0 / (2.0 - model.get_score(i))
            total += weight
            node = 0
            for c in piece:
                step = (node, chars.setdefault(c, len(chars)))
                if step not in children:
                    children[step], nodes = nodes, nodes + 1
                node = children[step]
            ends[node] = (i, weight)
        self.char_numbers = np.full(0x110000, -1, np.int32)
        self.char_numbers[[ord(c) for c in chars]] = list(chars.values())
        self.space = chars[SPACE]
        self.char_numbers[ord(SPACE)] = -1  # in a text, it isn't the space
        self.width = len(chars)
        keys = np.array([node * self.width + c for node, c in children], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(children.values()), np.int64)[order]
        self.piece_at = np.full(nodes, -1, np.int64)
        self.weight_at = np.zeros(nodes)
        for node, (i, weight) in ends.items():
            self.piece_at[node], self.weight_at[node] = i, alpha * np.log(weight / total)
        self.byte_weight = alpha * np.log(1.0 / (2.0 + self.size) / total)

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, words)


class Lattice:
    """The filtered lattices of several words, each with a space in front.

    A node is a position between characters; ``base`` and ``stop`` are a word's first and last node. The edges into a node
    are neighbours, the likeliest first, with their cumulated probabilities.
    """

    def __init__(self, vocabulary: Vocabulary, words: list[str]):
        v = vocabulary
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.base = np.cumsum(lengths + 1) - lengths - 1
        self.stop = self.base + lengths
        n = int(self.stop[-1]) + 1 if len(words) else 0
        chars, points = np.full(n, -2, np.int64), np.zeros(n, np.int64)  # -2: the end of a word
        inner = np.ones(n, bool)
        inner[self.base], inner[self.stop] = False, False
        chars[inner], points[inner] = v.char_numbers[codes], codes
        chars[self.base] = v.space
        starts, ends, pieces, weights = [], [], [], []
        begin = np.flatnonzero(chars != -2)
        at, state = begin, np.zeros(len(begin), np.int64)
        single = np.zeros(n, bool)
        while len(begin):
            char = chars[at]
            known = char >= 0
            begin, at, key = begin[known], at[known], state[known] * v.width + char[known]
            place = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            found = v.keys[place] == key
            begin, at, state = begin[found], at[found] + 1, v.next[place[found]]
            whole = v.piece_at[state] >= 0
            starts.append(begin[whole].astype(np.int32))
            ends.append(at[whole].astype(np.int32))
            pieces.append(v.piece_at[state[whole]].astype(np.int32))
            weights.append(v.weight_at[state[whole]])
            single[begin[whole & (at == begin + 1)]] = True
        # A character that isn't a piece goes by its bytes; its number stands above those of the pieces.
        other = np.flatnonzero((chars != -2) & ~single)
        size = 1 + (points[other] > 0x7F) + (points[other] > 0x7FF) + (points[other] > 0xFFFF)
        starts.append(other.astype(np.int32))
        ends.append((other + 1).astype(np.int32))
        pieces.append((v.size + points[other]).astype(np.int32))
        weights.append(size * v.byte_weight)
        # By end; of the edges into a node, the longest first, which is most often the likeliest.
        end = np.concatenate(ends[::-1])
        order = np.argsort(end, kind="stable")
        end, start = end[order], np.concatenate(starts[::-1])[order]
        self.start, self.piece = start, np.concatenate(pieces[::-1])[order]
        weight = np.concatenate(weights[::-1])[order]
        del starts, ends, pieces, weights, begin, at, state
        self.first = np.searchsorted(end, np.arange(n + 1))

        # Forward filtering, all words at a time, from one position to the next.
        depth = end - np.repeat(self.base, lengths + 1)[end]
        deepest = int(depth.max(initial=0))
        order = np.argsort(depth.astype(np.uint16) if deepest < 1 << 16 else depth, kind="stable")
        steps = np.concatenate([[0], np.cumsum(np.bincount(depth, minlength=deepest + 1)[1:])])
        sums, total = np.zeros(n), np.empty(len(end))
        for i, j in zip(steps, steps[1:]):
            edges = order[i:j]
            way, into = sums[start[edges]] + weight[edges], end[edges]
            first = np.flatnonzero(np.concatenate([[True], into[1:] != into[:-1]]))
            top = np.maximum.reduceat(way, first)
            counts = np.diff(np.append(first, j - i))
            each = np.exp(way - np.repeat(top, counts))
            summed = np.add.reduceat(each, first)
            sums[into[first]] = top + np.log(summed)
            total[edges] = each / np.repeat(summed, counts)
        run = np.concatenate([[0.0], np.cumsum(total)])
        self.cumulated = run[1:] - run[self.first[end]]
        last = self.first[1:][self.first[1:] > self.first[:-1]] - 1
        self.cumulated[last] = 2.0  # above any draw
        self.evidence = sums[self.stop] if len(words) else np.empty(0)


def sample(lattice: Lattice, vocabulary: Vocabulary, words: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of a sampled segmentation of each of ``words`` (numbers in the lattice), one after the other, and how
    many each word has. ``keys`` (uint64) seed the draws of each word."""
    live, node = np.arange(len(words)), lattice.stop[words]
    counts, taken, step = np.zeros(len(words), np.int64), [], 0
    while len(live):
        draw = (_mixed(keys[live] + np.uint64(step * int(GOLD) % (1 << 64))) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = lattice.first[node]
        todo = np.flatnonzero(lattice.cumulated[edge] <= draw)
        while len(todo):
            edge[todo] += 1
            todo = todo[lattice.cumulated[edge[todo]] <= draw[todo]]
        piece = lattice.piece[edge]
        point = piece - vocabulary.size
        size = np.where(point < 0, 1, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF))
        counts[live] += size
        taken.append((live, piece, size))
        node = lattice.start[edge]
        more = node > lattice.base[words[live]]
        live, node, step = live[more], node[more], step + 1
    end = np.cumsum(counts)
    out = np.empty(int(counts.sum()), np.int32)
    for live, piece, size in taken:
        end[live] -= size
        at, plain = end[live], piece < vocabulary.size
        out[at[plain]] = piece[plain]
        for i in np.flatnonzero(~plain):
            raw = chr(int(piece[i]) - vocabulary.size).encode("utf-8")
            out[at[i]:at[i] + len(raw)] = vocabulary.byte_ids[np.frombuffer(raw, np.uint8)]
    return out, counts


def segment(texts: list[str | None], keys: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts, one after the other, and how many each has. NULL and empty texts have none."""
    index = numbered()
    codes, places, counts = [], [], []
    for text in texts:
        words = text.split(" ") if text else []
        codes.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
        places.append(np.arange(len(words), dtype=np.uint64))
        counts.append(len(words))
    words = np.concatenate([np.empty(0, np.int64), *codes])
    if not len(words):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    seeds = _mixed(np.repeat(keys, counts) + _mixed(np.concatenate(places) * GOLD + np.uint64(1)))
    ids, sizes = sample(vocabulary.lattice(list(index)), vocabulary, words, seeds)
    owner = np.repeat(np.arange(len(texts)), counts)
    return ids, np.bincount(owner, sizes, len(texts)).astype(np.int64)


def _chunks(batch: pa.RecordBatch, text: str, most: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    at, chars, held = 0, 0, []
    for i, t in enumerate(batch[text].to_pylist()):
        held.append(t)
        chars += len(t or "")
        if chars >= most:
            yield batch.slice(at, i + 1 - at), held
            at, chars, held = i + 1, 0, []
    if held:
        yield batch.slice(at), held


def encode(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", name: str = "ids", seed: int = SEED,
    alpha: float = ALPHA, keep: list[str] | None = None, check: str | None = None, chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """``docs``, or its columns ``keep``, with the piece ids of a sampled segmentation of each text as ``name``
    (array<int>) and, if ``check`` is given, whether the ids decode to the text as a column of that name.

    Texts are cut up to ``chunk_chars`` characters at a time, or one longer text: fewer need less memory and more time, and
    the result is the same. The row's key is its id; rows with equal id and text are cut alike, and so are rows without id. A NULL text has NULL
    ids, an empty one none. ``path`` is a SentencePiece model with byte pieces that every executor has.
    """
    keep = docs.columns if keep is None else keep
    added = [name] + ([check] if check else [])
    if {c.lower() for c in keep} & {c.lower() for c in added}:
        raise ValueError(f"the documents have a column of {added} already")
    key, source = fresh_name(docs.select(*keep), "key", "source")
    rows = short_batches(docs).select(*keep, F.xxhash64(F.col(doc_id), F.lit(seed)).alias(key), F.col(text).alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path, alpha)
        for batch in batches:
            for part, texts in _chunks(batch, source, chunk_chars):
                keys = np.asarray(part[key]).astype(np.int64).view(np.uint64)
                ids, counts = segment(texts, keys, vocabulary)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                null = pa.array([t is None for t in texts])
                out = [part[c] for c in keep] + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids), mask=null)]
                if check:
                    cuts = [ids[i:j] for i, j in zip(offsets, offsets[1:])]
                    out.append(pa.array([t is None or _decoded(x, vocabulary.bytes) == t for t, x in zip(texts, cuts)]))
                yield pa.RecordBatch.from_arrays(out, [*keep, *added])
                del out, ids, offsets
                release()

    schema = docs.select(*keep).schema.add(name, ArrayType(IntegerType()))
    return rows.mapInArrow(run, schema.add(check, BooleanType()) if check else schema)


def decode(ids: Column, path: str) -> Column:
    """The text of piece ids. Control pieces give nothing; ids that don't come from ``encode`` may give bytes that aren't
    UTF-8, which become replacement characters. NULL ids give NULL."""

    @pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = Vocabulary(path).bytes
        for batch in batches:
            yield pd.Series([None if x is None else _decoded(x, table) for x in batch], dtype=object)

    return of(ids)


def _decoded(ids: np.ndarray, table: list[bytes]) -> str:
    raw = b"".join([table[i] for i in ids.tolist()])
    return raw[1:].decode("utf-8", "replace")  # without the space in front of the first word


def model_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = model_path()
    encoded = encode(load(spark, sf_dir, "documents"), path, keep=["doc_id"], check="lossless")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", "lossless")
