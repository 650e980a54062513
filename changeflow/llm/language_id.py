"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a distribution over languages by forward-backward, so that code-switched text is labelled word by
word; a document's language is the one with the largest sum. A word's features are its affixes and character n-grams (hashed
2- to 4-grams of the word between marks for its ends; those with a mark are prefixes and suffixes) and, if it is in the
lexicon, the word itself. Transitions between languages are learned too, from sequences in which stretches of several
languages follow each other.

The model is fitted to a bounded sample: ``SAMPLE_DOCS`` documents of each language (those with the least hash of their id), of
which ``STRETCHES`` stretches of ``LENGTH`` words each at random places. Predictions read whole texts and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import held_out, load, release, short_batches, stage

HASH_BITS = 52  # of a hash, below those that number its bin
SAMPLE_DOCS = 400
STRETCHES = 4
LENGTH = 32
# Words per language in the lexicon; hashed n-gram features; rounds over the sample.
LEXICON = 2000
BUCKETS = 1 << 16
ROUNDS = 4
SEED = 6
FOLDS, FOLD = 4, 2
# Characters of text that a task labels at a time.
CHUNK_CHARS = 3_000_000
UNKNOWN = "und"
MARK = np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)
EVEN = np.uint64(0xC2B2AE3D27D4EB4F)


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """The words of several texts, as arrays: how many each text has, the hash of each word, and the hashed n-grams
    of all words one after the other, with where each word's begin."""

    counts: np.ndarray
    hashes: np.ndarray
    grams: np.ndarray
    first: np.ndarray


def words_of(texts: list[str | None], letters: np.ndarray) -> Words:
    """Words are runs of letters, in lower case."""
    joined = "\n".join((t or "").lower() for t in texts).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, np.uint32)
    ends_of_texts = np.cumsum([len((t or "").lower()) + 1 for t in texts])
    is_letter = letters[codes]
    begin = np.flatnonzero(is_letter & ~np.concatenate([[False], is_letter[:-1]]))
    stop = np.flatnonzero(is_letter & ~np.concatenate([is_letter[1:], [False]])) + 1
    counts = np.diff(np.searchsorted(begin, ends_of_texts), prepend=0)
    if not len(begin):
        return Words(counts, np.empty(0, np.uint64), np.empty((0, 3), np.int64), np.empty(0, np.int64))
    # Each word between two marks.
    sizes = stop - begin + 2
    first = np.cumsum(sizes) - sizes
    framed = np.full(int(sizes.sum()), MARK, np.uint64)
    inside = np.arange(len(framed)) - np.repeat(first, sizes)
    body = (inside > 0) & (inside < np.repeat(sizes, sizes) - 1)
    framed[body] = codes[is_letter]
    framed = _mixed(framed * EVEN)
    hashes = np.add.reduceat(_mixed(framed + inside.astype(np.uint64)), first)
    left = np.repeat(first + sizes, sizes) - np.arange(len(framed))  # characters from here to the word's end
    grams, rolled = [], framed
    for n in (2, 3, 4):
        after = np.concatenate([framed[n - 1:], np.zeros(n - 1, np.uint64)])
        rolled = _mixed(rolled * EVEN + after)
        # A word has fewer n-grams than characters; the places left over share one bucket that weighs nothing.
        grams.append(np.where(left >= n, (rolled >> np.uint64(48)).astype(np.int64) % (BUCKETS - 1) + 1, 0))
    return Words(counts, hashes, np.stack(grams, axis=1), first)


@dataclass
class Crf:
    languages: list[str]
    grams: np.ndarray  # weights of the hashed n-grams, by language
    lexicon: np.ndarray  # hashes of the words in it, ascending
    entries: np.ndarray  # their weights; the last row, all zero, is for words that aren't in it
    transitions: np.ndarray

    def entry(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.lexicon, hashes), max(len(self.lexicon) - 1, 0))
        known = self.lexicon[at] == hashes if len(self.lexicon) else np.zeros(len(hashes), bool)
        return np.where(known, at, len(self.lexicon))

    def emissions(self, words: Words) -> np.ndarray:
        """The score of each language for each word."""
        k = len(self.languages)
        out = np.empty((len(words.hashes), k), np.float32)
        for i in range(k):  # column by column: less memory
            table = self.grams[:, i]
            each = table[words.grams[:, 0]]
            for n in (1, 2):
                each = each + table[words.grams[:, n]]
            out[:, i] = np.add.reduceat(each, words.first)
        return out + self.entries[self.entry(words.hashes)]


def forward_backward(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The distribution over labels of each item of several sequences, one after the other in ``scores``.

    All sequences advance together, longest first, so that a step works on as many as are still going on.
    """
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    steps = int(lengths[0]) if len(lengths) else 0
    going = np.searchsorted(-lengths, -np.arange(steps), side="left")  # sequences longer than t
    offset = np.concatenate([[0], np.cumsum(going)])
    rank = np.empty(len(counts), np.int64)
    rank[order] = np.arange(len(counts))
    start = np.cumsum(counts) - counts
    time = np.arange(len(scores)) - np.repeat(start, counts)
    place = offset[time] + np.repeat(rank, counts)
    by_time = np.empty_like(scores)
    by_time[place] = np.exp(scores - scores.max(axis=1, keepdims=True))
    moves = np.exp(transitions - transitions.max()).astype(scores.dtype)
    forward = np.empty_like(scores)
    state = np.ones((len(counts), scores.shape[1]), scores.dtype)
    for t in range(steps):
        i, j = offset[t], offset[t + 1]
        state = state[:j - i]
        state = (state @ moves if t else state) * by_time[i:j]
        state /= state.sum(axis=1, keepdims=True)
        forward[i:j] = state
    both = forward
    later = np.ones((going[-1] if steps else 0, scores.shape[1]), scores.dtype)
    for t in range(steps - 2, -1, -1):
        i, j, k = offset[t], offset[t + 1], offset[t + 2]
        here = np.ones((j - i, scores.shape[1]), scores.dtype)
        here[:k - j] = (later * by_time[j:k]) @ moves.T
        here /= here.sum(axis=1, keepdims=True)
        later = here
        both[i:j] *= here
    both /= both.sum(axis=1, keepdims=True)
    return both[place]


def _pair_sums(scores: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of equal length (sequence, time, label): the label distributions and, summed over all steps,
    those of neighbouring labels."""
    n, steps, k = scores.shape
    emit = np.exp(scores - scores.max(axis=2, keepdims=True))
    moves = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    state = emit[:, 0]
    for t in range(steps):
        state = emit[:, t] if t == 0 else (state @ moves) * emit[:, t]
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, t] = state
    for t in range(steps - 2, -1, -1):
        here = (backward[:, t + 1] * emit[:, t + 1]) @ moves.T
        backward[:, t] = here / here.sum(axis=1, keepdims=True)
    both = forward * backward
    both /= both.sum(axis=2, keepdims=True)
    pairs = forward[:, :-1, :, None] * moves * (emit * backward)[:, 1:, None, :]
    pairs /= pairs.sum(axis=(2, 3), keepdims=True)
    return both, pairs.sum(axis=(0, 1))


def _mixed_sequences(words: list[np.ndarray], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Sequences of LENGTH word numbers with their labels: half of one language, half of stretches of several."""
    total = sum(map(len, words))
    n = max(1, total // LENGTH)
    picks, labels = np.empty((n, LENGTH), np.int64), np.empty((n, LENGTH), np.int64)
    for row in range(n):
        at, single = 0, row % 2 == 0
        while at < LENGTH:
            label = int(rng.integers(len(words)))
            size = LENGTH if single else int(rng.integers(3, 17))
            size = min(size, LENGTH - at)
            begin = int(rng.integers(len(words[label])))
            own = np.arange(begin, begin + size) % len(words[label])
            picks[row, at:at + size], labels[row, at:at + size] = words[label][own], label
            at += size
    return picks, labels


def fit(samples: list[tuple[str, str]]) -> Crf:
    """A model from (language, text) rows; languages without any word are left out."""
    letters = letter_table()
    samples = sorted(samples)
    words = words_of([text for _, text in samples], letters)
    owner = np.repeat(np.arange(len(samples)), words.counts)
    languages = sorted({samples[i][0] for i in set(owner.tolist())})
    k = len(languages)
    label = np.array([languages.index(lang) if lang in languages else -1 for lang, _ in samples], np.int64)
    own = [np.flatnonzero(label[owner] == i) for i in range(k)]
    common = []
    for places in own:
        found, times = np.unique(words.hashes[places], return_counts=True)
        common.append(found[np.lexsort((found, -times))][:LEXICON])
    lexicon = np.unique(np.concatenate([np.empty(0, np.uint64), *common]))
    model = Crf(
        languages, np.zeros((BUCKETS, k), np.float32), lexicon, np.zeros((len(lexicon) + 1, k), np.float32), np.zeros((k, k))
    )
    if k < 2:
        return model
    rng = np.random.default_rng(SEED)
    picks, labels = _mixed_sequences(own, rng)
    last = np.append(words.first[1:], len(words.grams))
    seen = [np.full(x.shape, 1e-6) for x in (model.grams, model.entries, model.transitions)]

    def step(table: np.ndarray, squares: np.ndarray, gradient: np.ndarray) -> None:  # AdaGrad with a little decay
        gradient = gradient + 1e-6 * table
        squares += gradient * gradient
        table -= 0.3 * gradient / np.sqrt(squares)

    for _ in range(ROUNDS):
        order = rng.permutation(len(picks))
        for at in range(0, len(order), 128):
            batch = order[at:at + 128]
            chosen, gold = picks[batch].ravel(), labels[batch]
            sizes = last[chosen] - words.first[chosen]
            rows = np.repeat(words.first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            grams = words.grams[rows]
            part = Words(np.empty(0), words.hashes[chosen], grams, np.cumsum(sizes) - sizes)
            scores = model.emissions(part).reshape(len(batch), LENGTH, k).astype(np.float64)
            both, pairs = _pair_sums(scores, model.transitions)
            true = np.eye(k)[gold]
            error = (both - true).reshape(-1, k)
            spread = np.repeat(error, sizes, axis=0)
            entry = model.entry(part.hashes)
            gradients = [np.zeros_like(x) for x in seen[:2]]
            for i in range(k):
                for n in range(3):
                    gradients[0][:, i] += np.bincount(grams[:, n], spread[:, i], BUCKETS)
                gradients[1][:, i] = np.bincount(entry, error[:, i], len(lexicon) + 1)
            gradients[0][0] = 0
            gradients[1][-1] = 0
            counted = np.einsum("nti,ntj->ij", true[:, :-1], true[:, 1:])
            step(model.grams, seen[0], gradients[0])
            step(model.entries, seen[1], gradients[1])
            step(model.transitions, seen[2], pairs - counted)
            model.grams[0] = 0
            model.entries[-1] = 0
    return model


def _stretches(text: str | None, seed: int) -> str:
    """STRETCHES stretches of LENGTH words each (white space cut) from seeded places of a text; a short text whole."""
    words = (text or "").split()
    if len(words) <= STRETCHES * LENGTH:
        return " ".join(words)
    starts = np.random.default_rng(seed & 0x7FFFFFFF).integers(0, len(words) - LENGTH, STRETCHES)
    return " ".join(w for i in sorted(starts.tolist()) for w in words[i:i + LENGTH])


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Crf:
    """A model from documents outside the held-out fold that have a text and a language. At most SAMPLE_DOCS rows of a
    language reach the driver, each of at most STRETCHES * LENGTH words; repeated rows count each. They are those of the
    least hashes. A histogram of the hashes tells up to which one a language's sample reaches, so that few other rows are
    cut and sorted, however large the language; it is broadcast as one row per language, as the model is."""

    @pandas_udf("string")
    def sampled(texts: pd.Series, seeds: pd.Series) -> pd.Series:
        return pd.Series([_stretches(t, s) for t, s in zip(texts, seeds)])

    rows = short_batches(docs).where(~held_out(doc_id, FOLDS, FOLD)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(doc_id)).alias("h")
    )
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("bin", F.shiftrightunsigned("h", HASH_BITS))
    upto = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("lang", "bin").count().withColumn("before", F.coalesce(F.sum("count").over(upto), F.lit(0)))
    last = stage(bins.where(F.col("before") < SAMPLE_DOCS).groupBy("lang").agg(F.max("bin").alias("last")))
    rows = rows.join(F.broadcast(last), "lang").where("bin <= last").withColumn("text", sampled("text", "h"))
    least = Window.partitionBy("lang").orderBy("h", "text")
    rows = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= SAMPLE_DOCS)
    return fit([(r.lang, r.text) for r in rows.select("lang", "text").collect()])


def _labelled(texts: list[str | None], model: Crf, letters: np.ndarray) -> tuple[Words, np.ndarray]:
    words = words_of(texts, letters)
    if not len(words.hashes):
        return words, np.empty((0, len(model.languages)), np.float32)
    return words, forward_backward(model.emissions(words), words.counts, model.transitions)


def _predicted(texts: list[str | None], model: Crf, letters: np.ndarray) -> pd.DataFrame:
    out = pd.DataFrame({"lang": UNKNOWN, "score": 0.0}, index=range(len(texts)))
    if not model.languages:
        return out
    words, found = _labelled(texts, model, letters)
    some = np.flatnonzero(words.counts)
    if len(found):
        sums = np.add.reduceat(found, (np.cumsum(words.counts) - words.counts)[some], dtype=np.float64)
        best = sums.argmax(axis=1)
        out.loc[some, "lang"] = np.array(model.languages, object)[best]
        out.loc[some, "score"] = np.clip(sums[np.arange(len(some)), best] / words.counts[some], 0, 1)
    return out


def predict(text: Column, model: Crf) -> Column:
    """struct(lang, score) from a whole text alone: its language, and the share that this language has of the words'
    distributions. NULL texts and texts without a letter are ``und`` with score 0, as is all with an empty model."""

    @pandas_udf("lang string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        letters = letter_table()
        held, chars = [], 0
        for batch in batches:
            held.append([t if isinstance(t, str) else None for t in batch])
            chars += sum(len(t or "") for t in held[-1])
            if chars >= CHUNK_CHARS:
                yield from answers(held, letters)
                held, chars = [], 0
        yield from answers(held, letters)

    def answers(batches: list[list[str | None]], letters: np.ndarray) -> Iterator[pd.DataFrame]:
        """Several batches labelled together: their texts advance together."""
        found = _predicted([t for texts in batches for t in texts], model, letters)
        at = 0
        for texts in batches:
            yield found.iloc[at:at + len(texts)]
            at += len(texts)
        release()

    return of(text)


def label_words(text: str, model: Crf) -> list[str]:
    """The language of each word of a text."""
    _, found = _labelled([text], model, letter_table())
    return [model.languages[i] for i in found.argmax(axis=1)]


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    found = docs.select(
        "doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), predict(F.col("text"), model).alias("p")
    )
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
