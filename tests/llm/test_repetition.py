"""Repetition measures against plain counting, over given tables and odd texts."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import repetition
from changeflow.llm.common import load

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def covered(words, n):
    windows = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    counts, found = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            found.update(range(i, i + n))
    return found


def brute(text, lengths=tuple(repetition.LIMITS)):
    text = text or ""
    words = WORD.findall(text)
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    inside = [sum(len(words[i]) for i in covered(words, n)) for n in lengths]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, dup_lines, len(covered(words, 8)), dup_chars, *inside)


def odd_texts():
    rng = np.random.default_rng(13)
    some = ["a", "bb", "é", "日本", "x#y", "<$>", "a b", "\x1c", "end."]
    texts = [None, "", " \t\n\x0b\x0c\r", "one", "a a a a a a a a a", "l\nl\n\nl\n \n \nl ", "x" * 600_000 + " " + "x" * 600_000, "\n\n\n"]
    for n in (5, 12, 40, 200, 3000):
        for _ in range(6):
            words = rng.choice(some, n)
            gaps = rng.choice([" ", "\n", "  ", "\t", "\n\n"], n, p=[0.6, 0.2, 0.1, 0.05, 0.05])
            text = "".join(w + g for w, g in zip(words, gaps))
            texts += [text, text + text[:len(text) // 3]]
    words = [f"w{i}" for i in rng.integers(0, 5000, 60_000)]
    return texts + [" ".join(words) + "\n" + " ".join(words[100:400]), " ".join(words)]


@pytest.mark.parametrize("group_bytes", [1 << 22, 200])
def test_measures_equal_counting(group_bytes, monkeypatch):
    monkeypatch.setattr(repetition, "GROUP_BYTES", group_bytes)
    texts = odd_texts()
    raw = [(t or "").encode() for t in texts]
    bounds, data = np.concatenate(([0], np.cumsum([len(r) for r in raw]))), np.frombuffer(b"".join(raw), np.uint8)
    found = []
    for a, b in repetition._groups(bounds):
        assert b == a + 1 or bounds[b] - bounds[a] <= group_bytes
        columns = repetition._measured(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], tuple(repetition.LIMITS))
        found += list(zip(*[c.tolist() for c in columns]))
    assert found == [brute(t) for t in texts]


def test_odd_rows_and_clashing_names(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, found string, n_words int")
    docs = docs.union(docs.where("doc_id < 9")).repartition(3)
    rows = docs.select("doc_id", "found", "n_words", repetition.measures(F.col("text")).alias("m")).collect()
    assert len(rows) == len(texts) + 9
    for row in rows:
        assert tuple(row.m) == brute(texts[row.doc_id])
    assert repetition.clean(docs).columns == docs.columns
    none = docs.where("doc_id < 0")
    assert repetition.clean(none).count() == 0
    assert none.select(repetition.measures(F.col("text"))).count() == 0


def test_query_equals_counting(spark):
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    rows = repetition.op11_repetition(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        m = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m[:5]
        assert r.base_failed == (m[0] < 20 or 100 * m[4] > 30 * m[0])
        much = m[5] > 0.3 * m[1] or any(x > y * m[1] for x, y in zip(m[6:], repetition.LIMITS.values()))
        assert r.kept == (not r.base_failed and not much)


def test_good_documents_are_kept_and_repetitive_ones_go(spark):
    sf = "/root/testdata/sf0.01"
    found = repetition.op11_repetition(spark, sf).join(load(spark, sf, "labels"), "doc_id")
    share = found.where("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert share == 1.0
    words = "alpha beta gamma delta epsilon zeta eta".split()
    looped = " ".join(f"{words[i % 7]} {words[(i + 1) % 7]} {words[(i + 2) % 7]} here now {i}" for i in range(60))
    stanza = "\n".join(f"Chorus comes once more\n{i} verse {i}" for i in range(30))
    rows = spark.createDataFrame([(looped,), (stanza,)], "text string")
    measured = rows.select(repetition.measures(F.col("text")).alias("m"))
    assert measured.select(repetition.base_failed(F.col("m")), repetition.kept(F.col("m"))).collect() == [(False, False)] * 2
