"""The manifest against a plain tree per language, over given tables and odd rows."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from changeflow.llm import merkle
from changeflow.llm.common import load

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, node string, i int, G string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    text = row["text"]
    if tampered and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][j:j + 8])) for j in range(0, len(levels[-1]), 8)])
    return levels


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {x: levels_of([leaf(r) for r in groups[x]]) for x in langs}
    top, out = levels_of([trees[x][-1][0] for x in langs]), []
    for at, lang in enumerate(langs):
        for i, row in enumerate(groups[lang]):
            key, path = row["doc_id"], []
            for levels, place in ((trees[lang], i), (top, at)):
                for level in levels[:-1]:
                    first = place - place % 8
                    path.append(("".join(level[first:place]), "".join(level[place + 1:first + 8])))
                    place //= 8
            folded = leaf(row, key is not None and zlib.crc32(str(key).encode()) % 3 == 0)
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join(b + a for b, a in path))
            out.append((key, leaf(row), trees[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def odd_rows(n, langs):
    rows = [(i, "s", f"l{i % langs}", i, f"Text {i}", "x", 1, "y") for i in range(n)]
    rows += [(5, "s", "l0", 5, "Text 5", "x", 1, "y")] * 3  # repeated rows
    rows += [(6, None, "l0", None, None, "x", 1, "y"), (6, "", "l0", 0, "", "x", 1, "y")]  # ties on the id, NULLs, empty
    rows += [(None, "s", None, 1, "No Id É", "x", 1, "y"), (-3, "s", None, 1, "A" * 300_000 + "É", "x", 1, "y"), (None,) * 8]
    return rows + [(7000, "s", "only", 2, "Ab", "x", 1, "y"), (7001, "s", "", 2, "Ab", "x", 1, "y")]


def proven(docs, depth):
    fields = [F.col(c) for c in merkle.FIELDS]
    tampered = merkle.leaf([*fields[:-1], merkle.ascii_lower(F.col("text"))])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, F.col("lang"), F.col("doc_id"), merkle.leaf(fields), F.when(hit, tampered), depth)


@pytest.mark.parametrize("n, langs, depth", [(0, 1, 1), (30, 1, 1), (300, 2, 1), (700, 80, 1), (700, 3, 2), (8, 8, 3)])
def test_odd_rows_equal_brute_force(spark, n, langs, depth):
    docs = spark.createDataFrame(odd_rows(n, langs), COLUMNS).repartition(5)
    expected = brute([r.asDict() for r in docs.collect()])
    assert sorted(map(tuple, proven(docs, depth).collect()), key=str) == expected
    assert {len(r[1]) for r in expected} == {64}


def test_one_row_and_no_row(spark):
    docs = spark.createDataFrame(odd_rows(1, 1)[:1], COLUMNS)
    row = proven(docs, 3).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == digest("")
    assert proven(docs.where("doc_id = 9"), 3).count() == 0


def test_query_equals_brute_force(spark):
    found = merkle.op13_merkle(spark, SF)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=str) == brute([r.asDict() for r in load(spark, SF, "documents").collect()])


def test_a_group_with_most_rows_spans_many_ranges(spark):
    rows = spark.range(4000).selectExpr("IF(id % 3 > 0, 'en', 'fr') AS grp", "id AS key", "string(id) AS node", "id AS row")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # they are small here
    try:
        dealt = merkle.in_order(rows.repartition(8), "grp", "key", "node", "row")
        assert dealt.where("grp = 'en'").select("p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
