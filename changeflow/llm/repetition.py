"""Quality rules on repetition: how many of a text's characters lie inside n-grams and lines that occur more than once.

Words are runs of anything but ASCII white space. Every word and line has a hash from prefix sums over the text's bytes;
the hashes of n-grams roll from those of n - 1 words, for all windows at once in numpy. Equal hashes within one text are
found by sorting, and the words that such windows cover are counted once each, with their code points. Hashes have 64 bits and
are compared within a text only: a text of w words is misjudged with a chance of about w * w / 2 ** 64.

A text is kept unless it fails the base rule (fewer than MIN_WORDS words, or over REPEAT_PERCENT percent of its words in
repeated windows of BASE_LENGTH words), or a share of its word characters above LIMITS lies in repeated n-grams, or above
LINE_LIMIT in lines equal to an earlier line. All is measured per text, whole; nothing is shuffled.

NULL and empty texts, and those of white space alone, have no words: all counts are 0, and they fail the base rule. Repeated
rows and ties are measured each. Texts are taken GROUP_BYTES at a time; one longer text needs some 20 bytes of memory a byte.
Other columns, whatever their names, come along; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from changeflow.llm.common import load, release, short_batches

MIN_WORDS, BASE_LENGTH, REPEAT_PERCENT = 20, 8, 30
# Greatest share of characters inside repeated n-grams, by n, and inside repeated lines.
LIMITS = {5: 0.4, 8: 0.35, 10: 0.3}
LINE_LIMIT = 0.3
GROUP_BYTES = 1 << 22
SLICE = 1 << 18  # bytes of a text hashed at a time

SPACES, SYMBOLS, NEWLINE = b" \t\n\x0b\x0c\r", b"#*$%&|<>", 10
BYTE, STEP, MIX, SPREAD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")
MEASURES = (*COUNTS, *[f"dup_chars_{n}" for n in LIMITS])


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


IS_SPACE, IS_SYMBOL = _table(SPACES), _table(SYMBOLS)
INVERSE = pow(int(BYTE), -1, 1 << 64)
UP, DOWN = _powers(int(BYTE), SLICE), _powers(INVERSE, SLICE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * SPREAD
    return x ^ (x >> np.uint64(31))


def _prefixes(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places in a text, ascending: the byte hash and the number of code points before them."""
    hashes, points = np.empty(len(places), np.uint64), np.empty(len(places), np.int64)
    carry, passed, scale = np.uint64(0), 0, 1
    for at in range(0, len(data) + 1, SLICE):
        part = data[at:at + SLICE]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * UP[:len(part)], out=sums[1:])
        sums = sums * np.uint64(scale) + carry
        chars = np.zeros(len(part) + 1, np.int64)
        np.cumsum((part & 0xC0) != 0x80, out=chars[1:])
        low, high = np.searchsorted(places, (at, at + SLICE))
        here = places[low:high] - at
        hashes[low:high], points[low:high] = sums[here], chars[here] + passed
        carry, passed, scale = sums[-1], passed + int(chars[-1]), scale * pow(int(BYTE), SLICE, 1 << 64) % (1 << 64)
    return hashes, points


def _spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and code points of spans of a text that don't overlap, in order."""
    (before, first), (after, last) = _prefixes(data, begins), _prefixes(data, ends)
    leaps = _powers(pow(INVERSE, SLICE, 1 << 64), len(data) // SLICE + 1)
    found = (after - before) * DOWN[begins % SLICE] * leaps[begins // SLICE]
    return _mixed(found ^ (ends - begins).astype(np.uint64)), last - first


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each key, whether it occurs more than once, and whether an equal one comes before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    any_, earlier = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    earlier[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, earlier


def _measured(data: np.ndarray, bounds: np.ndarray, lengths: tuple[int, ...]) -> Iterator[np.ndarray]:
    """The measures, each for all texts ``data[bounds[k]:bounds[k + 1]]``."""
    n = len(bounds) - 1
    first_byte = np.zeros(len(data) + 1, bool)
    first_byte[bounds] = True
    gap = np.ones(len(data) + 1, bool)
    gap[1:] = IS_SPACE[data]
    inside = ~gap[1:]
    begins = np.flatnonzero(inside & (gap[:-1] | first_byte[:-1]))
    gap[:-1], gap[-1] = gap[1:], True
    ends = np.flatnonzero(inside & (gap[1:] | first_byte[1:])) + 1
    owner = np.searchsorted(bounds, begins, "right") - 1
    hashes, chars = _spans(data, begins, ends)
    summed = np.concatenate(([0], np.cumsum(chars)))

    breaks = np.flatnonzero(data == NEWLINE)
    line_begins = np.union1d(breaks + 1, bounds[:-1])
    line_begins = line_begins[line_begins < len(data)]
    line_ends = np.concatenate((line_begins[1:], [len(data)]))[:len(line_begins)]
    line_ends = line_ends - ((line_ends > line_begins) & (data[line_ends - 1] == NEWLINE))
    low, high = np.searchsorted(begins, line_begins), np.searchsorted(begins, line_ends)
    worded = high > low
    line_begins, line_ends, low, high = (x[worded] for x in (line_begins, line_ends, low, high))
    line_owner = owner[low]
    line_hashes, _ = _spans(data, line_begins, line_ends)
    salt = _mixed(np.arange(1, n + 1, dtype=np.uint64) * STEP)
    _, again = _repeated(line_hashes + salt[line_owner])

    def per_text(owners: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        # Sums of whole numbers, below the 2 ** 53 that doubles hold.
        return np.bincount(owners, weights, n).astype(np.int64)

    covered, rolled = {}, hashes
    for length in range(2, max((*lengths, BASE_LENGTH)) + 1):
        rolled = rolled[:-1] * STEP + hashes[length - 1:] if len(rolled) else rolled
        if length in lengths or length == BASE_LENGTH:
            whole = owner[:len(rolled)] == owner[length - 1:] if len(rolled) else np.zeros(0, bool)
            found, at = np.zeros(len(owner) + 1, np.int64), np.flatnonzero(whole)
            twice, _ = _repeated(_mixed(rolled[at]) + salt[owner[at]])
            np.add.at(found, at[twice], 1)
            np.subtract.at(found, at[twice] + length, 1)
            covered[length] = np.cumsum(found[:-1]) > 0
    yield per_text(owner)
    yield per_text(owner, chars)
    yield per_text(np.searchsorted(bounds, np.flatnonzero(IS_SYMBOL[data]), "right") - 1)
    yield per_text(line_owner[again])
    yield per_text(owner[covered[BASE_LENGTH]])
    yield per_text(line_owner[again], (summed[high] - summed[low])[again])
    for length in lengths:
        yield per_text(owner[covered[length]], chars[covered[length]])


def _groups(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of up to GROUP_BYTES together, or of one text."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + GROUP_BYTES, "right")) - 1)
        yield at, to
        at = to


def measures(text: Column, lengths: tuple[int, ...] = tuple(LIMITS)) -> Column:
    """COUNTS and, for each of ``lengths``, the code points inside n-grams of so many words that occur more than once."""
    names = [*COUNTS, *[f"dup_chars_{n}" for n in lengths]]

    @arrow_udf("struct<" + ", ".join(f"{name}: bigint" for name in names) + ">")
    def of(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, places, held = texts.buffers()
        bounds = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(held or b"", np.uint8)
        parts = [
            list(_measured(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], lengths)) for a, b in _groups(bounds)
        ]
        release()
        columns = [np.concatenate([np.zeros(0, np.int64), *column]) for column in zip(*parts)] or [np.zeros(0, np.int64)] * len(names)
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names)

    return of(text)


def base_failed(found: Column) -> Column:
    repeats = found.n_repeat_words * 100 > found.n_words * REPEAT_PERCENT
    return (found.n_words < MIN_WORDS) | repeats


def kept(found: Column) -> Column:
    """The verdict on measures for all of LIMITS."""
    much = found.dup_line_chars > found.word_chars * LINE_LIMIT
    for length, limit in LIMITS.items():
        much = much | (found[f"dup_chars_{length}"] > found.word_chars * limit)
    return ~(base_failed(found) | much)


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""
    return short_batches(docs).where(kept(measures(F.col(text))))


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = short_batches(load(spark, sf_dir, "documents")).select("doc_id", measures(F.col("text")).alias("found"))
    found = F.col("found")
    return docs.select(
        "doc_id", "found.n_words", "found.word_chars", "found.n_symbols", "found.n_dup_lines", "found.n_repeat_words",
        base_failed(found).alias("base_failed"), kept(found).alias("kept"), *[f"found.{m}" for m in MEASURES[5:]],
    )
