"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names, on small fixtures."""

import hashlib
import os
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changeflow.llm import (
    decontamination,
    language_id,
    license_scan,
    pieces,
    quality,
    simhash,
    sketches,
    substrings,
    token_counts,
    warc,
)
from changeflow.llm.components import connected_components
from changeflow.llm.fm_index import FMIndex

RNG = np.random.default_rng(11)
VOCABULARY = [f"{a}{b}" for a in ("al", "be", "cu", "do", "é", "fi") for b in ("ra", "so", "ti", "un", "x")]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY, n))


COPY = prose(60)
TEXTS = [
    (1, prose(120)),
    (2, COPY),
    (3, COPY),
    (3, COPY),  # a repeated row
    (4, COPY + " " + prose(40)),
    (5, None),
    (6, ""),
    (7, " \t\n"),
    (None, COPY),  # no id
    (8, "one"),
    (9, prose(20000)),  # very long
    (10, "Licensed under CC BY. All rights reserved; cc by\n" + prose(30)),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Columns whose names the operators use themselves come along."""
    rows = [(i, t, "en", "src", len(t or ""), 1, "x", 2) for i, t in TEXTS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, fp int, spans string, k1 int"
    ).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = -1")


def split(text):
    return (text or "").encode().split()


def grams(words, k):
    return [tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


# -- license scan ----------------------------------------------------------------------------


def test_license_places_are_all_found(docs, none):
    templates = license_scan.BASE
    found = license_scan.scan(docs, templates)
    assert found.columns == [*docs.columns, "scan"]
    for row in found.collect():
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (row.text or "").lower())
        places = [
            (n, i, i + len(sought)) for n, t in enumerate(templates) for sought in [t.text.split()]
            for i in range(len(words)) if words[i:i + len(sought)] == sought
        ]
        assert row.scan.n_words == len(words)
        assert [(p.template, p.begin, p.stop) for p in row.scan.places] == sorted(places)
    assert license_scan.scan(none, templates).count() == 0


def test_license_with_changed_words(spark):
    text = "foo this work licensed under a creative commons attribution 4 0 intl international license bar"
    row = license_scan.scan(spark.createDataFrame([(text,)], "text string"), license_scan.NOTICES).first()
    labels = {license_scan.NOTICES[p.template].label: p.share for p in row.scan.places}
    assert 0.8 <= labels["cc-by"] < 1


def best_share(words, template):
    """The greatest share over all runs of words with few enough others between."""
    m, best = len(template), 0
    for i in range(len(words)):
        last = [0] * (m + 1)
        for j in range(i, min(len(words), i + m + license_scan.put_in(m))):
            now = [0]
            for n, word in enumerate(template):
                now.append(last[n] + 1 if words[j] == word else max(now[-1], last[n + 1]))
            last = now
            if j + 1 - i - last[m] <= license_scan.put_in(m):
                best = max(best, last[m])
    return best


def test_every_notice_is_found_with_words_changed_and_put_in(spark):
    """Notices with words missing, changed and put in, up to and over the limits, against all runs of words."""
    rng, texts = np.random.default_rng(14), []
    for number, notice in enumerate(license_scan.NOTICES):
        words = license_scan._words(notice.text)
        m = len(words)
        lost = m - license_scan.needed(m)
        for trial in range(24):
            changed, gone = list(words), rng.choice(m, min(m, lost + trial % 3 // 2), replace=False)
            for i in sorted(gone.tolist(), reverse=True):
                changed[i:i + 1] = [] if trial % 2 else [b"changed"]
            for _ in range(trial % (license_scan.put_in(m) + 2) if trial > 3 else 0):
                changed.insert(int(rng.integers(1, len(changed) + 1)), b"other")
            around = [w.decode() for w in changed]
            texts.append((number, f"{prose(9, rng)} {' '.join(around)} {prose(9, rng)} of the {prose(5, rng)}"))
    extra = ["Released under the MIT licence", "Released under a MIT License", "Released under the new MIT License",
             "Licensed under the new Apache License , dated Version 2.0", "of the " * 400 + "released under the mit license"]
    texts += [(-1, t) for t in extra]
    rows = spark.createDataFrame(texts, "number int, text string")
    found = {r.text: {p.template: p for p in r.scan.places} for r in license_scan.scan(rows, license_scan.NOTICES).collect()}
    accepted = 0
    for _, text in texts:
        words = license_scan._words(text)
        for n, notice in enumerate(license_scan.NOTICES):
            template = license_scan._words(notice.text)
            best = best_share(words, template)
            place = found[text].get(n)
            assert (place is not None) == (best >= license_scan.needed(len(template))), (text, notice.text)
            if place is not None:
                accepted += 1
                assert round(place.share * len(template)) == best_share(words[place.begin:place.stop], template)
    assert accepted > 120
    labels = [{license_scan.NOTICES[n].label for n in found[t]} for t in extra]
    assert labels == [{"mit"}, {"mit"}, {"mit"}, {"apache"}, {"mit"}]


def test_many_templates_and_a_column_of_the_same_name(spark, monkeypatch):
    rows = spark.createDataFrame([("all rights reserved cc by", 1)], "text string, scan int")
    plain = license_scan.scan(rows, license_scan.BASE).first()
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", 0)
    assert license_scan.scan(rows, license_scan.BASE).first() == plain
    assert plain.scan == 1 and [p.template for p in plain["_scan"].places] == [0, 2]


# -- sketches --------------------------------------------------------------------------------


def test_next_text_and_edited_text(spark, docs, none):
    rows = {r.id: r for r in sketches.with_next(docs).where("id IS NOT NULL").collect()}
    ids = sorted({i for i, _ in TEXTS if i is not None})
    text_of = {i: t or "" for i, t in TEXTS}
    for i, after in zip(ids, ids[1:] + [None]):
        need = len(text_of[i]) // 2
        expected = text_of[after] if after else COPY  # after the last comes the row without id
        assert rows[i].next_start[:need] == expected[:need]
    assert sketches.with_next(docs).count() == len(TEXTS)
    assert sketches.with_next(none).count() == 0
    one = sketches.with_next(docs.where("doc_id = 1")).first()
    assert one.text.startswith(one.next_start)


def test_sketch_estimates(spark):
    a, b = [prose(500) for _ in range(2)]
    half = " ".join(a.split()[:250])
    rows = spark.createDataFrame([(a, b, half, a, None, "")], "a string, b string, half string, a2 string, n string, e string")
    for c in ("a", "b", "half", "a2", "n", "e"):
        rows = sketches.sketches(rows, c, f"s_{c}")
    r = rows.select(
        sketches.resemblance(F.col("s_a"), F.col("s_half")).alias("half"),
        sketches.containment(F.col("s_half"), F.col("s_a")).alias("inside"),
        sketches.resemblance(F.col("s_a"), F.col("s_b")).alias("other"),
        sketches.resemblance(F.col("s_n"), F.col("s_e")).alias("empty"),
        sketches.resemblance(F.col("s_a"), F.col("s_e")).alias("one_empty"),
        sketches.distinct_shingles(F.col("s_a")).alias("n"),
        (sketches.as_text(F.col("s_a")) == sketches.as_text(F.col("s_a2"))).alias("same"),
    ).first()
    assert abs(r.half - 0.5) < 0.2 and r.inside > 0.8 and r.other < 0.1
    assert (r.empty, r.one_empty, r.same) == (1.0, 0.0, True)
    assert abs(r.n - 496) < 130


def test_sketches_merge_over_parts(spark):
    rows = spark.createDataFrame([(1, prose(90)), (1, prose(90)), (2, None), (None, prose(9))], "g int, text string")
    parts = sketches.sketches(rows, "text", "sketch", k=50)
    merged = {r.g: r.sketch for r in sketches.merge_groups(parts, "g", k=50).collect()}
    for g in (1, 2, None):
        expected = sorted({h for r in parts.collect() if r.g == g for h in r.sketch})[:50]
        assert merged[g] == expected


# -- pieces ----------------------------------------------------------------------------------

ODD_TEXTS = ["a  b", " lead", "tail ", "▁x y▁", "\n\t new", "漢字 é \U0001f600 z", " ", "x" * 3000, "", None, "\x00 nul"]


def test_pieces_round_trip(spark, docs, none):
    path = pieces.model_path()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string").unionByName(
        docs.select("doc_id", "text")
    )
    found = pieces.encode(rows, path).withColumn("back", pieces.decode(F.col("ids"), path)).collect()
    assert len(found) == len(ODD_TEXTS) + len(TEXTS)
    assert all(r.back == r.text for r in found)
    assert all((r.ids is None) == (r.text is None) for r in found)
    assert pieces.encode(none, path).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(docs, path, name="spans")


def test_pieces_are_reproducible_and_vary_with_the_key(spark):
    path, text = pieces.model_path(), prose(400)
    rows = spark.createDataFrame([(1, text), (2, text), (1, text)], "doc_id long, text string")
    first = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(rows, path).collect()}
    again = {(r.doc_id, tuple(r.ids)) for r in pieces.encode(rows.repartition(3), path).collect()}
    assert first == again and len(first) == 2


def test_sampling_follows_the_weights():
    vocabulary = pieces.Vocabulary(pieces.model_path())
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.model_path())
    known = {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not model.is_unused(i)}
    word, weights = "▁hello", {}
    for n in range(len(word)):
        for cut in combinations(range(1, len(word)), n):
            parts = [word[i:j] for i, j in zip((0, *cut), (*cut, len(word)))]
            if all(p in known for p in parts):
                ids = tuple(known[p] for p in parts)
                weights[ids] = np.exp(sum(vocabulary.weight_at[vocabulary.piece_at == i][0] for i in ids))
    lattice, n = vocabulary.lattice(["hello"]), 50_000
    assert lattice.evidence[0] == pytest.approx(np.log(sum(weights.values())))
    ids, counts = pieces.sample(lattice, vocabulary, np.zeros(n, np.int64), np.arange(n, dtype=np.uint64))
    drawn = Counter(tuple(x.tolist()) for x in np.split(ids, np.cumsum(counts)[:-1]))
    assert set(drawn) <= set(weights)
    for way, weight in weights.items():
        assert drawn[way] / n == pytest.approx(weight / sum(weights.values()), abs=0.01)


# -- WARC ------------------------------------------------------------------------------------


def test_warc_round_trip(spark, root):
    big = "x" * 50_000
    tricky = "é\r\n\r\nWARC/1.1\r\n" * 3000
    rows = [(1, "u", big), (2, "u", None), (2, "u", big), (2, "u", big), (None, None, big), (None, "a\r\nb", tricky), (5, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_warc(pages, f"{root}/a", segment_bytes=999, chunk_bytes=77)
    found = warc.read_warc(spark, f"{root}/a").collect()
    assert len(found) == len(rows) and all(r.sound for r in found)
    payloads = Counter(bytes(r.payload).decode() for r in found if r.type == "response")
    assert payloads == Counter([big, big, tricky, "", ""])
    assert Counter(r.type for r in found) == {"response": 5, "revisit": 2}
    records = warc.read_records(spark, f"{root}/a")
    gap = records.where("segment IS NULL OR segment != 3")
    broken = warc.reassemble(gap).where("NOT complete")
    assert broken.count() == 3 and broken.where("block IS NOT NULL").count() == 0
    doubled = records.unionByName(records.where("type = 'continuation'"))
    assert warc.reassemble(doubled).where("NOT complete").count() == 0


def test_warc_of_no_pages(spark, root):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(pages, f"{root}/b")
    assert warc.read_warc(spark, f"{root}/b").count() == 0


def test_warc_damage_is_reported(spark, root):
    whole = warc._record("response", "x", b"HTTP/1.1 200 OK\r\n\r\nabc") + b"\r\n\r\n"
    parser = warc._Parser("f")
    assert [r["block"][-3:] for i in range(len(whole)) for r in parser.feed(whole[i:i + 1])] == [b"abc"]
    parser.close()
    with pytest.raises(ValueError):
        list(warc._Parser("f").feed(b"no record\r\n\r\n"))
    cut = warc._Parser("f")
    list(cut.feed(whole[:-8]))
    with pytest.raises(ValueError):
        cut.close()
    assert warc._payload(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc\r\n") is None


# -- SimHash ---------------------------------------------------------------------------------


def test_simhash_against_brute_force(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    by_text = {}
    for _, text in TEXTS:
        words = [w for w in (text or "").encode().lower().split()]
        import xxhash

        hashes = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams(words, 4)]
        by_text[text] = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))
    assert {(r.doc_id, r.fp % (1 << 64)) for r in rows} == {(i, by_text[t]) for i, t in TEXTS}
    # Components by repeated passes over all pairs.
    fps = sorted(set(by_text.values()))
    group = {f: f for f in fps}
    for _ in fps:
        for a, b in combinations(fps, 2):
            if bin(a ^ b).count("1") <= 4:
                group[a] = group[b] = min(group[a], group[b])
    least = {}
    for i, t in TEXTS:
        if i is not None:
            least[group[by_text[t]]] = min(i, least.get(group[by_text[t]], i))
    assert all(r.component_id == least[group[r.fp % (1 << 64)]] for r in rows)
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_keeps_one_of_each_group(docs):
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    expected = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_near_duplicates_leave_little_scratch(spark, docs):
    """What nothing reads any more is freed; without repeated ids, texts are shuffled once."""
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    kept = simhash.deduplicate(docs)
    # Marks and components; texts are never stored.
    assert len(set(os.listdir(folder)) - before) == 2
    assert kept.count() == len({r.component_id for r in simhash.near_duplicates(docs).collect()})
    rows = [(i, prose(40)) for i in range(40)]
    plain = simhash.deduplicate(spark.createDataFrame(rows + [(99, rows[0][1])], "doc_id long, text string"))
    assert sorted(r.doc_id for r in plain.collect()) == list(range(40))
    again = simhash.deduplicate(spark.createDataFrame(rows + rows[:5] + [(None, rows[7][1])], "doc_id long, text string"))
    assert sorted(r.doc_id for r in again.collect()) == list(range(40))


def test_close_pairs_are_complete(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(-(1 << 63), 1 << 63, 60)]
    near = [x ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(1, 7)), replace=False)) for x in base]
    fps = sorted(set(base + near))
    found = simhash.close_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), 4).collect()
    assert {tuple(r) for r in found} == {(a, b) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= 4 or ((a ^ b) + (1 << 64)).bit_count() <= 4 and (a ^ b) < 0}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(links).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


# -- language --------------------------------------------------------------------------------


def test_language_of_mixed_text(spark):
    rng = np.random.default_rng(2)
    words = {"aa": ["than", "thing", "whoth", "the"], "bb": ["élan", "çédé", "éta", "né"], "cc": ["ungen", "schaft", "keit"]}
    rows = [(i, " ".join(rng.choice(words[lang], 30)), lang) for i in range(60) for lang in [list(words)[i % 3]]]
    rows += [(100, None, "aa"), (101, "12 !", "bb"), (102, "than the", None), (None, "élan", "bb")]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb", "cc"]
    labels = language_id.label_words("than the thing whoth élan né çédé éta", model)
    assert labels == ["aa"] * 4 + ["bb"] * 4
    texts = spark.createDataFrame([(None,), ("",), ("12 !",), ("ungen keit",)], "text string")
    found = [tuple(r.p) for r in texts.select(language_id.predict(F.col("text"), model).alias("p")).collect()]
    assert [lang for lang, _ in found] == ["und", "und", "und", "cc"]
    assert all(0 <= s <= 1 for _, s in found)
    empty = language_id.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert texts.select(language_id.predict(F.col("text"), empty).alias("p")).where("p.lang != 'und'").count() == 0


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(3)
    counts, k = np.array([3, 0, 1, 4]), 3
    scores, moves = rng.normal(size=(8, k)), rng.normal(size=(k, k))
    found, at = language_id.forward_backward(scores, counts, moves), 0
    for n in counts:
        expected, total = np.zeros((n, k)), 0.0
        for path in np.ndindex(*[k] * n):
            w = np.exp(sum(scores[at + i, s] for i, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            total += w
            for i, s in enumerate(path):
                expected[i, s] += w
        assert np.allclose(found[at:at + n], expected / total)
        at += n


# -- substring dedup -------------------------------------------------------------------------


def brute_cuts(rows, window):
    low = {}
    for i, t in rows:
        if i is not None:
            words = split(t)
            for k in range(len(words) - window + 1):
                g = tuple(words[k:k + window])
                low[g] = min(i, low.get(g, i))
    out = []
    for i, t in rows:
        words = split(t)
        keep = [True] * len(words)
        for k in range(len(words) - window + 1):
            if i is not None and low[tuple(words[k:k + window])] < i:
                keep[k:k + window] = [False] * window
        out.append((i, len(words), len(words) - sum(keep), b" ".join(w for w, x in zip(words, keep) if x)))
    return out


@pytest.mark.parametrize("window", [13, 5])
def test_substrings_against_brute_force(docs, none, window, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", 7)  # many shards
    monkeypatch.setattr(substrings, "COMMON_ANCHOR", 3)  # anchors dealt out window by window
    found = substrings.with_spans(docs.drop("spans"), "doc_id", "text", "spans", window)
    found = found.select("doc_id", "text", substrings.cut(F.col("text"), F.col("spans")).alias("c")).collect()
    got = [(r.doc_id, r.c.n_words, r.c.n_removed, " ".join((r.text or "").split()) if r.c.kept is None else r.c.kept) for r in found]
    expected = [(i, n, gone, kept.decode()) for i, n, gone, kept in brute_cuts(TEXTS, window)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert substrings.repeated_intervals(none).count() == 0


def test_substrings_of_rows_that_share_an_id(spark):
    text = prose(40)
    rows = [
        (1, text), (2, prose(50) + " " + text), (2, text), (2, prose(6)), (2, None), (2, ""), (2, prose(90)),
        (3, text + " " + prose(20)), (3, prose(30)), (3, text + " " + prose(20)), (None, text), (None, None),
    ]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substrings.with_spans(texts, "doc_id", "text", "spans")
    found = found.select("doc_id", "text", substrings.cut(F.col("text"), F.col("spans")).alias("c")).collect()
    got = [(r.doc_id, r.c.n_words, r.c.n_removed, " ".join((r.text or "").split()) if r.c.kept is None else r.c.kept) for r in found]
    expected = [(i, n, gone, kept.decode()) for i, n, gone, kept in brute_cuts(rows, 13)]
    assert sorted(got, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("crowded, chunk", [(2, 500), (3, 2000), (64, 3_000_000)])
def test_substrings_of_crowded_anchors(spark, crowded, chunk, monkeypatch):
    """Copies, near copies and a passage in most documents, in chunks of a few documents, whose notes are soon forgotten."""
    monkeypatch.setattr(substrings, "SHARD_PASSAGES", 50)
    monkeypatch.setattr(substrings, "CROWDED_ANCHOR", crowded)
    monkeypatch.setattr(substrings, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(substrings, "REMEMBERED", 5)
    rng = np.random.default_rng(5)
    passage, copy = prose(20, rng), prose(45, rng)
    rows = []
    for i in rng.permutation(120).tolist():
        near = copy.split()
        near[int(rng.integers(45))] = f"other{i}"
        own = prose(int(rng.integers(5, 25)), rng)
        rows.append((i, [copy, " ".join(near), f"{own} {passage} {own}", f"{passage} {passage}", own][i % 5]))
    rows += [(7, copy), (7, passage + " " + copy), (-3, passage), (None, copy)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = substrings.with_spans(texts, "doc_id", "text", "spans")
    found = found.select("doc_id", "text", substrings.cut(F.col("text"), F.col("spans")).alias("c")).collect()
    got = [(r.doc_id, r.c.n_words, r.c.n_removed, " ".join((r.text or "").split()) if r.c.kept is None else r.c.kept) for r in found]
    expected = [(i, n, gone, kept.decode()) for i, n, gone, kept in brute_cuts(rows, 13)]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_substrings_send_a_hot_window_once_a_task(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_CHARS", 1000)
    text, n = prose(20), 500
    anchors = np.unique(substrings._anchors(text.encode().split(), 13)[0])

    def sent(common):
        batches = [pd.DataFrame({
            "id": range(i, i + 50), "k1": 1, "k2": 2, "text": text,
            "anchors": [anchors] * 50, "common": [np.full(len(anchors), common)] * 50,
        }) for i in range(0, n, 50)]
        rows = pd.concat(substrings._passages(13, 4)(iter(batches)))
        places = rows["starts"].map(len) // 8
        return places[rows["words"].map(len) > 0].sum(), rows[rows["words"].map(len) == 0]

    chunks = -(-n // (1000 // len(text) + 1))
    searched, known = sent(True)
    assert searched == 8  # its windows, once
    assert known["starts"].map(len).sum() == 16 * (n - 1)  # one interval for each other document
    assert sent(False)[0] <= chunks * len(anchors)


def test_anchor_lists_of_a_crowded_anchor_dont_meet(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK_CHARS", 1000)
    monkeypatch.setattr(substrings, "CROWDED_ANCHOR", 5)
    text, n = prose(20), 200
    batch = pa.RecordBatch.from_pydict({"id": list(range(n)), "text": [text] * n})
    rows = pd.concat(b.to_pandas() for b in substrings._gathered(13)(iter([batch])))
    notes, lists = rows[rows["ids"].map(len) == 0], rows[rows["ids"].map(len) > 0]
    assert notes["anchor"].is_unique and notes["crowded"].all() and (notes["salt"] == 0).all()
    assert set(notes["anchor"]) == set(lists["anchor"])
    for _, of_one in lists.groupby("anchor"):
        assert sorted(i for ids in of_one["ids"] for i in ids) == list(range(n))
        crowded = of_one["ids"].map(len) >= 5
        assert (of_one["crowded"] == crowded).all() and (of_one["salt"].ne(0) == crowded).all()
        assert of_one["salt"][crowded].is_unique and crowded.sum() >= len(of_one) - 1  # the last chunk is short


def test_matching_statistics_leave_out_the_own_place():
    a, b, c = prose(13), prose(15), prose(14)
    least, counts = substrings.least_owner([s.encode() for s in (a, f"{b} {a}", c)], np.array([5, 3, 4]), 13)
    assert counts.tolist() == [1, 16, 2]
    assert least.tolist() == [3] + [3] * 16 + [4] * 2


def test_fm_index_finds_all_occurrences():
    rng = np.random.default_rng(1)
    for _ in range(10):
        text = rng.integers(1, int(rng.integers(3, 30)), int(rng.integers(20, 300)))
        depth = int(rng.integers(1, 14))
        patterns = np.lib.stride_tricks.sliding_window_view(text, depth)[rng.integers(0, len(text) - depth + 1, 20)].copy()
        changed = rng.random(patterns.shape) < 0.1
        patterns[changed] = rng.integers(1, text.max() + 1, changed.sum())
        for p, low, high, length in zip(patterns, *FMIndex(text, depth).search(patterns)):
            times = [sum((text[i:i + k] == p[depth - k:]).all() for i in range(len(text) - k + 1)) for k in range(1, depth + 1)]
            longest = next((k for k, n in enumerate(times) if n == 0), depth)
            assert length == longest
            if longest:
                assert high - low == times[longest - 1]


# -- quality ---------------------------------------------------------------------------------


def test_quality_learns_and_covers_odd_input(spark, docs, none):
    rng = np.random.default_rng(4)
    rows = [(i, prose(50, rng) if i % 4 else "BUY!!! " * 40) for i in range(200)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i, _ in rows] + [(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.train(texts, labels)
    found = texts.select("doc_id", quality.score(F.col("text"), model).alias("s")).collect()
    assert all((r.s >= 0.5) == (r.doc_id % 4 > 0) for r in found)
    odd = docs.select(quality.score(F.col("text"), model).alias("s")).collect()
    assert len(odd) == len(TEXTS) and all(0 <= r.s <= 1 for r in odd)
    for marks in (labels.where("quality = 1"), labels.where("quality = 9")):
        level = quality.train(texts, marks)
        assert texts.where(quality.score(F.col("text"), level) < 0.5).count() == 0
    assert none.select(quality.score(F.col("text"), model)).count() == 0


def test_pooled_levels_never_fall():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 5, 50).astype(float)
    levels = quality._pooled(np.array([rng.integers(0, r + 1) for r in rows], float), rows)
    assert len(levels) == 50 and (np.diff(levels) >= 0).all() and 0 <= levels[0] and levels[-1] <= 1


def test_pooled_levels_are_the_closest_ones():
    """Each level is the greatest over starts of the least over ends of the mean between, which is the monotone fit."""
    rng = np.random.default_rng(3)
    for _ in range(20):
        rows = rng.integers(1, 6, 30).astype(float)
        ones = np.array([rng.integers(0, r + 1) for r in rows], float)
        expected = [
            max(min(ones[a:b + 1].sum() / rows[a:b + 1].sum() for b in range(i, 30)) for a in range(i + 1)) for i in range(30)
        ]
        assert np.allclose(quality._pooled(ones, rows), expected)


def test_quality_query_against_one_solve_over_all_rows(spark):
    """Every score, from normal equations over all labelled rows at once."""
    import zlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    marks = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    marks = [(i, q) for i, q in marks if q is not None and i in texts and zlib.crc32(str(i).encode()) % 3 != 1]
    x, y = np.array([quality._statistics(texts[i]) for i, _ in marks]), np.array([float(q) for _, q in marks])
    mean, scale = x.mean(0), np.sqrt(np.maximum((x * x).mean(0) - x.mean(0) ** 2, 1e-6))
    z, n, ones = quality._features(x, mean, scale), len(y), y.sum()
    weight = np.where(y == 1, n / (2 * ones), n / (2 * (n - ones)))
    penalty = np.eye(z.shape[1]) * quality.RIDGE * n
    penalty[-1, -1] = 0
    weights = np.linalg.solve(z.T @ (z * weight[:, None]) + penalty, z.T @ (weight * y))
    at = quality._bin(z @ weights, (-0.5, 1.5))
    levels = quality._pooled(np.bincount(at, y, quality.BINS), np.bincount(at, minlength=quality.BINS).astype(float))
    rows = quality.op8_quality(spark, sf).collect()
    raw = quality._features(np.array([quality._statistics(texts[r.doc_id]) for r in rows]), mean, scale) @ weights
    low, high = (levels[quality._bin(raw + d, (-0.5, 1.5))] for d in (-1e-6, 1e-6))
    assert len(rows) == len(texts) and len(marks) > 40
    for r, a, b in zip(rows, low, high):
        assert a - 1e-9 <= r.score <= b + 1e-9 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_training_on_texts_gives_the_scores_of_the_query(spark):
    sf = "/root/testdata/sf0.001"
    texts, marks = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = texts.select("doc_id", quality.score(F.col("text"), quality.train(texts, marks)).alias("again"))
    both = quality.op8_quality(spark, sf).join(found, "doc_id").collect()
    # Sums over differently cut partitions may move an output by one bin.
    assert len(both) == texts.count() and sum(abs(r.score - r.again) > 1e-6 for r in both) <= 2


# -- decontamination -------------------------------------------------------------------------


def test_matches_against_brute_force(spark, docs, none):
    item = prose(30)
    words = item.split()
    changed = " ".join([*words[:28], "other", words[29]])
    mine = [(20, prose(50) + " " + item.upper() + " " + prose(9)), (21, prose(5) + "\n" + changed), (22, "in short"), (22, item),
            (23, prose(8) + " in  Short " + prose(8) + " in short"), (24, "brief In\tshort")]
    texts = docs.select("doc_id", "text").unionByName(spark.createDataFrame(mine, "doc_id long, text string"))
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "In short"), (5, item), (6, "al" * 9)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontamination.contaminated(texts, items).collect()}
    expected = {}
    for i, t in [*TEXTS, *mine]:
        shingles = grams((t or "").lower().split(), 5)
        for j, text in [(r.item_id, r.text) for r in items.collect()]:
            few = (text or "").lower().split()
            if 0 < len(few) < 5:
                words = (t or "").lower().split()
                at = next((k for k in range(len(words)) if words[k:k + len(few)] == few), None)
                if at is not None:
                    expected[i, j] = (1.0, at)
                continue
            sought = grams((text or "").lower().split(), 5)
            best = (0, 0)
            for k in range(max(1, len(shingles) - len(sought) + 1)) if sought and shingles else ():
                a, b = Counter(shingles[k:k + len(sought)]), Counter(sought)
                best = max(best, (sum((a & b).values()) / sum((a | b).values()), -k))
            if best[0] >= 0.8:
                expected[i, j] = (best[0], -best[1])
    assert {k: (pytest.approx(s), at) for k, (s, at) in expected.items()} == found and len(expected) == 9
    clean = decontamination.decontaminate(texts, items)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in TEXTS}
    assert clean.count() == len(TEXTS)
    assert decontamination.contaminated(none, items).count() == 0
    assert decontamination.decontaminate(docs, items.where("item_id < 0")).count() == len(TEXTS)


def test_matches_with_repeated_shingles_against_brute_force(spark):
    """Windows that differ from an item in one shingle said over and over: near by count, far by fingerprint."""
    rng = np.random.default_rng(5)
    mine, sought = [], []
    for j in range(30):
        same, times = int(rng.integers(30, 90)), int(rng.integers(1, 14))
        words = [f"w{j}x{i}" for i in range(same + 4)]
        said, other = words + [f"y{j}"] * (times + 4), words + [f"z{j}x{i}" for i in range(times + 4)]
        mine.append((j, " ".join(["start"] * int(rng.integers(0, 9)) + (said if j % 2 else other) + ["end"] * 3)))
        sought.append((j, " ".join(other if j % 2 else said)))
    texts = spark.createDataFrame(mine, "doc_id long, text string")
    items = spark.createDataFrame(sought, "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.similarity, r.start_word) for r in decontamination.contaminated(texts, items).collect()}
    expected = {}
    for (i, t), (_, item) in zip(mine, sought):
        a, b = grams(t.split(), 5), grams(item.split(), 5)
        best = (0, 0)
        for k in range(max(1, len(a) - len(b) + 1)):
            x, y = Counter(a[k:k + len(b)]), Counter(b)
            best = max(best, (sum((x & y).values()) / sum((x | y).values()), -k))
        if best[0] >= 0.8:
            expected[i, i] = (pytest.approx(best[0]), -best[1])
    assert found == expected and len(expected) >= 8


def test_the_blocks_alone_bring_items_without_repeats(spark, monkeypatch):
    """Items and documents without repeated shingles, similarities of 0.8 to 1: found without the exact join."""
    monkeypatch.setattr(decontamination, "rarest", lambda wanted, least: wanted.select("item", "m", F.lit(0).cast("bigint").alias("x")).limit(0))
    rng = np.random.default_rng(6)
    mine, sought = [], []
    for j in range(120):
        words = [f"w{j}x{i}" for i in range(int(rng.integers(12, 140)))]
        other = list(words)
        for i in rng.integers(0, len(words), int(rng.integers(0, 3))).tolist():
            other[i] = f"changed{j}x{i}"
        cut = int(rng.integers(0, 1 + len(words) // 8))
        mine.append((j, " ".join([f"before{j}"] * (j % 3) + other[:len(other) - cut] + [f"after{j}x{i}" for i in range(cut + 2)])))
        sought.append((j, " ".join(words)))
    texts = spark.createDataFrame(mine, "doc_id long, text string")
    items = spark.createDataFrame(sought, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(texts, items).collect()}
    expected = {}
    for (i, t), (_, item) in zip(mine, sought):
        a, b = grams(t.split(), 5), Counter(grams(item.split(), 5))
        size = sum(b.values())
        shares = [(x := Counter(a[k:k + size])) and sum((x & b).values()) / sum((x | b).values()) for k in range(max(1, len(a) - size + 1))]
        if max(shares) >= 0.8:
            expected[i, i] = pytest.approx(max(shares))
    assert found == expected and 30 < len(expected) and sum(v.expected < 0.9 for v in expected.values()) > 8


def test_near_values_cover_the_radius(spark):
    a, bits = 0x123456789ABCDEF, [0, 1, 2, 16, 17, 18, 32, 33, 34, 48, 49, 50, 51, 52, 53]
    b = a ^ sum(1 << x for x in bits)
    rows = spark.createDataFrame([(a, b)], "a long, b long")
    mine = rows.select(F.inline(decontamination.block_values(F.col("a"))))
    theirs = rows.select(F.inline(decontamination.block_values(F.col("b"))))
    theirs = theirs.select("block", F.explode(decontamination._near_values(F.col("value"))).alias("value"))
    assert len(bits) == decontamination.RADIUS and mine.join(theirs, ["block", "value"]).count() >= 1


# -- token counts ----------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    odd = [
        "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|>", "it's don't 'S we'LL", "Σίσυφος ΣΑΣ İi", "é<|endoftext|>́x",
        "é ẛ̣", "\x1c\x1d a\x85b c", "12³½Ⅷ", "՘ ׋ ₝ 𐥀", "漢字か가", "“quoted” — ok…", "﻿bom",
    ]
    rows = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    )
    library = Tokenizer.from_file(path)
    expected = Counter(
        (r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False))) for r in rows.collect()
    )
    assert Counter(tuple(r) for r in token_counts.token_counts(rows, path).collect()) == expected
    assert token_counts.token_counts(none, path).count() == 0


def test_edited_digest(spark):
    rows = spark.createDataFrame([(1, "abcdé"), (2, "xy"), (3, None)], "doc_id long, text string")
    rows.createOrReplaceTempView("none")
    found = {r.id: (r.text, r.next_start) for r in sketches.with_next(rows).collect()}
    assert found == {1: ("abcdé", "xy"), 2: ("xy", ""), 3: ("", "")}


def test_sketch_query_against_brute_force(spark):
    """All rows of the query: digests, and estimates from sketches made in Python."""
    import xxhash

    def sketch(text):
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
        hashes = set()
        for i in range(len(words) - 4):
            h = 42
            for w in words[i:i + 5]:
                h = xxhash.xxh64_intdigest(w.encode(), h)
            hashes.add(h)
        if 0 < len(words) < 5:
            hashes = {xxhash.xxh64_intdigest(" ".join(words).encode(), 42)}
        return sorted(h - (1 << 64) if h >> 63 else h for h in hashes)[:128]

    def alike(a, b):
        union = sorted({*a, *b})[:128]
        return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0

    sf = "/root/testdata/sf0.001"
    texts = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    rows = {r.doc_id: r for r in sketches.op2_sketches(spark, sf).collect()}
    assert len(rows) == len(texts)
    for (i, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = sketch(text)
        assert (rows[i].near_edited, rows[i].near_next) == (alike(own, sketch(edited)), alike(own, sketch(after)))


def test_unsound_records_end_the_query(spark):
    rows = spark.createDataFrame([("a", "response", True), ("b", "response", False)], "record_id string, type string, sound boolean")
    kind = warc.checked(F.col("type")).alias("record_type")
    assert [r.record_type for r in rows.where("sound").select(kind).where("record_type = 'response'").collect()] == ["response"]
    with pytest.raises(Exception, match="unsound record b"):
        rows.select(kind).where("record_type = 'response'").collect()


def test_token_counts_of_a_task_without_words(spark):
    import public_tokenizers

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    for texts in ([None, ""], [None], ["", " \n"]):
        rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        found = sorted(map(tuple, token_counts.token_counts(rows, path).collect()))
        assert found == [(i, len(t or ""), 0) for i, t in enumerate(texts)]
    rows = spark.createDataFrame([(1, "block 0"), (2, "block 8589934592 block"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(rows.repartition(3), path).collect()}
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    assert found == {1: len(plain.encode("block 0", add_special_tokens=False).ids),
                     2: len(plain.encode("block 8589934592 block", add_special_tokens=False).ids), 3: 0}


def test_plain_ascii_texts_are_not_searched_by_patterns():
    import public_tokenizers

    from changeflow.llm.token_counts import PreTokens

    pre = PreTokens(str(public_tokenizers.path("word_bpe_49k.json")))
    want = [pre.words(t) for t in ("a\x1cb", "x<|endoftext|>y\x1f", "<| a", "É e")]
    assert want == [["a", "\x1c", "b"], ["x", " <|endoftext|>", "y", "\x1f"], ["<|", "a"], ["é", "e"]]
    pre.special = pre.other = None
    assert pre.words("Plain < text,\tof ASCII") == ["plain", "<", "text,", "of", "ascii"]
