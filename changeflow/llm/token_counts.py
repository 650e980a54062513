"""Token counts by pre-token frequencies: no token ids are made for a document.

1. Every distinct pre-token of the corpus is encoded once and its number of pieces noted.
2. Each block of documents is turned into its pre-token frequencies, one row per distinct pre-token of the block
   with the documents that hold it, so that a frequent word costs a row per block and not one per document.
3. These rows are joined to the piece counts by pre-token and summed per document.

Both sides of the join grow with the corpus; neither is broadcast by this module. The sides are plain shuffles of
a staged vocabulary and of frequency rows, so adaptive execution may split a very frequent word.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import load, numbered, release, short_batches, stage

LIMIT = 2048
# A block of documents ends with the document that brings it to so many characters; documents stay whole.
BLOCK_CHARS = 8_000_000
BLOCK_DOCS = 60_000
# Partial sums held by a task at most, before they are handed on.
HELD_SUMS = 4_000_000
# Frequency rows added up at a time.
JOINED_ROWS = 10_000
# Code points on which Python and the tokenizer library agree about letters, white space and lower case (their Unicode
# versions differ on others, and a capital sigma is lowered by context): a text of these alone, if it is in normal form,
# is cut word by word. With any other character in a text, the library itself cuts it.
AGREED = r"[^\x00-\x1b\x20-\u03a2\u03a4-\u0557\u2000-\u206f\u3000-\u30ff\u4e00-\u9fff\uac00-\ud7a3]"
# The ASCII ones among the others.
OTHER_ASCII = "\x1c\x1d\x1e\x1f"


class PreTokens:
    """Pre-tokens of a text as a tokenizer file defines them: added special tokens split the raw text, the rest
    is normalised by the file's own normaliser and cut by its split pattern."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        splits = [s for s in settings["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"]
        if len(splits) != 1 or not splits[0]["invert"] or splits[0]["behavior"] != "Removed":
            raise ValueError(f"{path}: its pre-tokens aren't the matches of one pattern")
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"])
        self.other = re.compile(AGREED)
        special = sorted((t["content"] for t in settings["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.opening = commonprefix(special)  # a text without it holds none of them
        self.path = path

    def words(self, text: str) -> list[str]:
        """Parts of a text whose pre-tokens, taken together, are those of the text: its words in lower case where the
        text is plain, and else the pre-tokens themselves. Added tokens have a space in front."""
        if self.opening not in text or self.special.search(text) is None:
            return self._plain_words(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._plain_words(text[at:m.start()])
            out.append(" " + m.group())  # no word starts with a space
            at = m.end()
        return out + self._plain_words(text[at:])

    def _plain_words(self, text: str) -> list[str]:
        if text.isascii():
            plain = not any(c in text for c in OTHER_ASCII)
        else:
            plain = self.other.search(text) is None and unicodedata.is_normalized("NFC", text)
        if plain:
            return text.lower().split()
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def cut(self, word: str) -> list[str]:
        """The pre-tokens of one of ``words``; those that the library has cut stay whole."""
        if word[0] == " ":
            return [word[1:]]
        if self.other.search(word):
            return [word]
        return self.pattern.findall(word)

    @cached_property
    def plain(self):
        """The tokenizer for text that is normalised already."""
        from tokenizers import Tokenizer

        with open(self.path, encoding="utf-8") as file:
            return Tokenizer.from_str(json.dumps(json.load(file) | {"normalizer": None}))

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        return [len(e) for e in self.plain.encode_batch_fast(pre_tokens, add_special_tokens=False)]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    held, chars = [], 0
    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            held.append(row)
            chars += len(row[1] or "")
            if chars >= BLOCK_CHARS or len(held) >= BLOCK_DOCS:
                yield held
                held, chars = [], 0
    if held:
        yield held


def _pairs(block: list[tuple], pre: PreTokens) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct pre-tokens; for each pair of a pre-token and a document that holds it, in this order,
    the two numbers and how often."""
    index = numbered()
    codes = []
    for _, text in block:
        found = pre.words(text) if text else []
        codes.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
    docs = np.repeat(np.arange(len(block)), [len(c) for c in codes])
    words = np.concatenate(codes)
    # From words to pre-tokens: each distinct word of the block is cut once.
    tokens = numbered()
    cuts = [[tokens[t] for t in pre.cut(word)] for word in index]
    sizes = np.array([len(c) for c in cuts], np.int64)
    flat = np.fromiter((t for c in cuts for t in c), np.int64, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    times = sizes[words]
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    codes = flat[np.repeat(first[words], times) + inside]
    pairs, counts = np.unique(codes * len(block) + np.repeat(docs, times), return_counts=True)
    return list(tokens), *np.divmod(pairs, len(block)), counts


def _distinct(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pre = PreTokens(path)
        for block in _blocks(batches):
            seen: set[str] = set()
            for _, text in block:
                seen.update(pre.words(text) if text else ())
            # Of a stated type, for a block may have no words.
            yield pd.DataFrame({"token": pd.Series(sorted({t for word in seen for t in pre.cut(word)}), dtype=object)})

    return run


# A document's number in its block and the times that it holds the row's pre-token; more times than fit in a byte make
# several postings, which add up.
POSTING = np.dtype([("doc", "<u2"), ("times", "u1")])


def _frequencies(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pre, task = PreTokens(path), TaskContext.get().partitionId()
        for number, block in enumerate(_blocks(batches)):
            tokens, codes, docs, counts = _pairs(block, pre)
            parts = (counts + 254) // 255
            last = np.cumsum(parts) - 1
            postings = np.empty(int(parts.sum()), POSTING)
            postings["doc"], postings["times"] = np.repeat(docs, parts), 255
            postings["times"][last] = counts - 255 * (parts - 1)
            codes = np.repeat(codes, parts)
            first = np.searchsorted(codes, np.arange(len(tokens) + 1)).tolist()
            packed = [postings[i:j].tobytes() for i, j in zip(first, first[1:])]
            name = (task << 32) + number
            ids = np.array([[0 if pd.isna(i) else int(i), pd.isna(i), len((t or "").encode())] for i, t in block], "<i8")
            # The block's list of documents takes part in the join under a name of its own, so that it is dealt out evenly.
            yield pd.DataFrame({"block": name, "head": True, "token": [f"block {name}"], "packed": [ids.tobytes()]})
            for at in range(0, len(tokens), 50_000):
                part = slice(at, at + 50_000)
                yield pd.DataFrame({"block": name, "head": False, "token": tokens[part], "packed": packed[part]})
            del tokens, codes, docs, counts, postings, packed
            release()

    return run


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fewer and longer batches, of short rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= JOINED_ROWS:
            yield pd.concat(held)
            held, rows = [], 0
    if held:
        yield pd.concat(held)


def _partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces per document of each block, as far as this task has seen its pre-tokens."""
    sums: dict[int, np.ndarray] = {}

    def flush() -> pd.DataFrame:
        packed = []
        for total in sums.values():
            docs = np.flatnonzero(total)
            packed.append(docs.astype("<u2").tobytes() + total[docs].astype("<u8").tobytes())
        out = pd.DataFrame({"block": list(sums), "head": False, "packed": packed})
        sums.clear()
        return out

    for batch in _joined(batches):
        head = batch[batch["head"]]
        if len(head):
            yield pd.DataFrame({"block": head.block, "head": True, "packed": head.packed})
        body = batch[~batch["head"]]
        if not len(body):
            continue
        sizes = body.packed.map(len).to_numpy(np.int64) // POSTING.itemsize
        postings = np.frombuffer(b"".join(body.packed), POSTING)
        pieces = np.repeat(body.pieces.to_numpy(np.int64), sizes) * postings["times"].astype(np.int64)
        blocks, at = np.unique(body.block.to_numpy(np.int64), return_inverse=True)
        keys, where = np.unique((np.repeat(at, sizes) << 16) + postings["doc"].astype(np.int64), return_inverse=True)
        found = np.bincount(where, pieces, len(keys)).astype(np.int64)
        for i, (start, end) in enumerate(zip(edges := np.searchsorted(keys >> 16, np.arange(len(blocks) + 1)), edges[1:])):
            docs, block = keys[start:end] & 0xFFFF, int(blocks[i])
            total = sums.get(block)
            if total is None or len(total) <= docs[-1]:
                grown = np.zeros(max(int(docs[-1]) + 1, 256 if total is None else 2 * len(total)), np.int64)
                if total is not None:
                    grown[:len(total)] = total
                sums[block] = total = grown
            total[docs] += found[start:end]
        if sum(map(len, sums.values())) > HELD_SUMS:
            yield flush()
    if sums:
        yield flush()


def _per_document(rows: pd.DataFrame) -> pd.DataFrame:
    """The documents of one block: its list of documents and the partial sums of all tasks."""
    ids = np.frombuffer(rows.packed[rows["head"]].iloc[0], "<i8").reshape(-1, 3)
    total = np.zeros(len(ids), np.int64)
    for packed in rows.packed[~rows["head"]]:
        n = len(packed) // 10
        total[np.frombuffer(packed, "<u2", n)] += np.frombuffer(packed, "<u8", n, 2 * n).astype(np.int64)
    doc_id = pd.array(ids[:, 0], "Int64")
    doc_id[ids[:, 1] == 1] = pd.NA
    return pd.DataFrame({"doc_id": doc_id, "n_bytes": ids[:, 2], "n_tokens": total})


def piece_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(token, pieces) for each distinct pre-token of the texts."""

    @pandas_udf("long")
    def pieces(tokens: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pre = PreTokens(path)
        for batch in tokens:
            yield pd.Series(pre.pieces(batch.tolist()), dtype="int64")

    texts = short_batches(docs).select(F.lit(0).alias("none"), F.col(text).alias("text"))
    tokens = texts.mapInPandas(_distinct(path), "token string").distinct()
    return tokens.select("token", pieces("token").alias("pieces"))


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, repeated rows included: doc_id (bigint, may be NULL), n_bytes, n_tokens (0 for NULL
    and empty texts). ``path`` is a tokenizer file that every executor has. An empty table gives no rows."""
    vocabulary = stage(piece_counts(docs, path, text))
    texts = short_batches(docs).select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = texts.mapInPandas(_frequencies(path), "block long, head boolean, token string, packed binary")
    joined = rows.join(vocabulary, "token", "left").select("block", "head", "pieces", "packed")
    sums = joined.mapInPandas(_partial_sums, "block long, head boolean, packed binary")
    return sums.groupBy("block").applyInPandas(_per_document, "doc_id long, n_bytes long, n_tokens long")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    counts = token_counts(load(spark, sf_dir, "documents"), str(path))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
