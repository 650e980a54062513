"""Merkle manifest of a dataset: every row a leaf, a tree per group of rows, a tree over the groups' roots.

Leaves are hashed where the rows are read; texts are never moved. They are put in order by ranges, so that a group with
most of all rows spans many tasks, and numbered within their group. A superblock is ``FAN ** DEPTH`` consecutive nodes. Going
up, each superblock is reduced to one node, round by round, until a group has one. Going down, the nodes of a superblock
and the outer nodes that its proofs need (the path of the superblock itself) are cogrouped by superblock; one function then
finishes the local reduction, joins the proofs and folds the leaves. A task holds one superblock and one path at a time.

A digest is the lower-case hex SHA-256 of its inputs' concatenation, with digests as hex text. While a level has more than
one node, each run of ``FAN`` nodes, the last one maybe shorter, even a single node, becomes one node of the next level.

NULL is a group of its own and comes first; a NULL field is a ``-``, unlike an empty one (``0:``). Rows with equal keys in a
group are ordered by their leaf, so repeated rows, which have equal leaves, can't be told apart. A NULL key comes first in
its group and is never tampered with. An empty table gives no rows. Names of other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.common import load, stage

FAN = 8
DEPTH = 3  # levels of a superblock
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "g bigint, i bigint, n bigint, node string"
LEVEL = "struct<before: string, after: string>"
PATHS = f"g bigint, i bigint, path array<{LEVEL}>, subroot string, root string"
PROVEN = "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (65, 97))
IN_PARTITION = (1 << 33) - 1


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, each with its length, so that no two rows share their input."""
    texts = [c.cast("string") for c in fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else unchanged; the quick way where there is nothing but ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def in_order(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``p``, the number of a range of the order, and ``at``, the place in the range. Rows should be stored,
    for they are read twice (once for the ranges' bounds)."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return dealt.withColumn("p", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(IN_PARTITION))


def positions(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place from 0 in the order. The driver gets one count per range."""
    dealt = stage(in_order(rows, *order))
    sizes = sorted(tuple(r) for r in dealt.groupBy("p").count().collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    starts = rows.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "p int, start bigint")
    return dealt.join(starts, "p").withColumn("pos", F.col("start") + F.col("at")).drop("p", "at", "start")


def numbered_leaves(rows: DataFrame) -> DataFrame:
    """``rows(grp, key, node, changed)`` as nodes: g, the number of the group in the groups' order, i, the place in the
    group, and n, the size of the group. What tells the place is known per range and group: one small row for each."""
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))
    dealt = stage(in_order(rows, "grp", "key", "node", "row").drop("row"))
    counts = stage(dealt.groupBy("p", "grp").agg(F.count("*").alias("c"), F.min("at").alias("first")))
    groups = stage(positions(stage(counts.select("grp").distinct()), "grp"))
    whole = Window.partitionBy("grp")
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "p", "grp", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("first")).alias("offset"), F.sum("c").over(whole).alias("n")
    )
    groups = groups.withColumnRenamed("grp", "named")
    offsets = offsets.join(groups, F.col("grp").eqNullSafe(F.col("named"))).select(
        F.col("p").alias("range"), F.col("grp").alias("named"), "offset", "n", F.col("pos").alias("g")
    )
    same = (F.col("p") == F.col("range")) & F.col("grp").eqNullSafe(F.col("named"))
    found = dealt.join(stage(offsets), same).withColumn("i", F.col("at") + F.col("offset"))
    return found.select("g", "i", "n", "node", "key", "changed")


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], n: int, depth: int) -> list[list[str]]:
    """The levels of a superblock, its nodes first; those of a group that fits into one end with its root."""
    levels = [nodes]
    while len(levels[-1]) > 1 if n <= FAN**depth else len(levels) <= depth:
        last = levels[-1]
        levels.append([_hash("".join(last[j:j + FAN])) for j in range(0, len(last), FAN)])
    return levels


def _siblings(level: list[str], at: int) -> tuple[str, str]:
    first = at - at % FAN
    return "".join(level[first:at]), "".join(level[at + 1:first + FAN])


def _paths(levels: list[list[str]], outer: list[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    """Per node of a superblock its siblings, level by level up to the root."""
    above = {0: outer}
    for level in reversed(levels[1:-1]):
        above = {at: [_siblings(level, at), *above[at // FAN]] for at in range(len(level))}
    below = levels[0]
    for at in range(len(below)):
        yield [_siblings(below, at), *above[at // FAN]] if len(levels) > 1 else outer


def _block(depth: int) -> Column:
    return F.expr(f"i div {FAN**depth}")


def reduced(nodes: DataFrame, depth: int) -> DataFrame:
    """One node per superblock."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block, size = block.sort_values("i"), FAN**depth
        g, i, n = (int(block[c].iloc[0]) for c in ("g", "i", "n"))
        root = _levels(block["node"].tolist(), n, depth)[-1][0]
        return pd.DataFrame({"g": [g], "i": [i // size], "n": [-(-n // size)], "node": [root]})

    return nodes.select("g", "i", "n", "node").groupBy("g", _block(depth)).applyInPandas(reduce, NODES)


def rounds(nodes: DataFrame, most: int, depth: int) -> list[DataFrame]:
    """``nodes`` and, round by round, what they are reduced to, down to one node per group of at most ``most``."""
    found = [nodes]
    while True:
        found.append(stage(reduced(found[-1], depth)))
        most = -(-most // FAN**depth)
        if most <= 1:
            return found


def exchange(nodes: DataFrame, outer: DataFrame, depth: int, proven: bool = False) -> DataFrame:
    """The paths of ``nodes``, or with ``proven`` the result rows of leaves, from the paths of their superblocks."""

    def join(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, above = block.sort_values("i"), above.iloc[0]
        levels = _levels(block["node"].tolist(), int(block["n"].iloc[0]), depth)
        paths = _paths(levels, [(x["before"], x["after"]) for x in above["path"]])
        if not proven:
            listed = [[{"before": b, "after": a} for b, a in path] for path in paths]
            return block[["g", "i"]].assign(path=listed, subroot=above["subroot"], root=above["root"])
        out = []
        for key, node, changed, path in zip(block["key"], block["node"], block["changed"], paths):
            proof = _hash("".join(b + a for b, a in path))
            folded = changed or node
            for before, after in path:
                folded = _hash(before + folded + after)
            out.append((key, node, above["subroot"], above["root"], proof, folded, folded == above["root"]))
        names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pd.DataFrame(out, columns=names).astype({"key": "Int64"})

    left = nodes.groupBy("g", _block(depth).alias("b"))
    return left.cogroup(outer.groupBy("g", F.col("i").alias("b"))).applyInPandas(join, PROVEN if proven else PATHS)


def manifest(
    rows: DataFrame, group: Column, key: Column, node: Column, changed: Column, depth: int = DEPTH
) -> DataFrame:
    """One row per row: key, leaf, the root of its group's tree, the root of all, the digest of its proof, and the root to
    which its leaf (``changed`` in its place, unless NULL) and its proof fold.

    ``node`` and ``changed`` are leaves, ``key`` is a bigint. Digests of levels above are those of unchanged leaves.
    """
    leaves = stage(numbered_leaves(rows.select(group.alias("grp"), key.alias("key"), node.alias("node"), changed.alias("changed"))))
    most, groups = leaves.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("g") + 1, F.lit(0))).first()
    below = rounds(leaves, most, depth)
    roots = below[-1].select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("i"), F.lit(groups).cast("bigint").alias("n"), "node")
    above = rounds(stage(roots), groups, depth)
    paths = above[-1].select(
        "g", "i", F.array().cast(f"array<{LEVEL}>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root")
    )
    for nodes in reversed(above[:-1]):
        paths = stage(exchange(nodes, paths, depth))
    own = below[-1].select("g", "node")
    paths = paths.select(F.col("i").alias("g"), "path", "root").join(own, "g").select(
        "g", F.lit(0).cast("bigint").alias("i"), "path", F.col("node").alias("subroot"), "root"
    )
    for nodes in reversed(below[1:-1]):
        paths = stage(exchange(nodes, paths, depth))
    return exchange(leaves, paths, depth, proven=True)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    plain = [F.col(c) for c in FIELDS]
    tampered = leaf([ascii_lower(c) if name == "text" else c for name, c in zip(FIELDS, plain)])
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    proven = manifest(docs, F.col("lang"), F.col("doc_id"), leaf(plain), F.when(hit, tampered))
    return proven.withColumnRenamed("key", "doc_id")


DOC_LEVELS, GROUP_LEVELS = 8, 3  # of the SQL: enough for 8 ** 8 documents a language and 512 languages


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of ASCII text: bytes one by one, bits one by one."""
    taken = f"list_transform(range(1, strlen({text}) + 1), lambda p: CAST(ascii(substr({text}, p, 1)) AS BIGINT))"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda t, z: xor(t >> 1, 3988292384 * (t & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {taken}), lambda c, b: {bits}), 4294967295)"


def _sql() -> str:
    def digest(**other: str) -> str:
        texts = [other.get(name, f"CAST({name} AS VARCHAR)") for name in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"

    def tree(name: str, levels: int) -> list[str]:
        run = "OVER (PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
        found = []
        for k in range(levels):
            found.append(f"""{name}{k + 1} AS (
    SELECT g, i // 8 AS i, (any_value(n) + 7) // 8 AS n,
           CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
    FROM {name}{k} GROUP BY g, i // 8)""")
            found.append(f"""{name}s{k} AS (
    SELECT g, i, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
           coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {name}{k})""")
        return found

    def folds(name: str, trees: str, levels: int, first: int) -> list[str]:
        return [f"""f{first + k + 1} AS (
    SELECT f.* REPLACE (CASE WHEN s.n = 1 THEN f.h ELSE sha256(s.b || f.h || s.a) END AS h, f.proof || s.b || s.a AS proof,
                        f.{name} // 8 AS {name})
    FROM f{first + k} f JOIN {trees}s{k} s ON s.g = f.{'g' if trees == 'd' else 'o'} AND s.i = f.{name})""" for k in range(levels)]

    parts = [
        f"""leaves AS (SELECT doc_id, lang, {digest()} AS leaf,
    CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
         THEN {digest(text=f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed FROM documents)""",
        """placed AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)""",
        "d0 AS (SELECT g, i, n, leaf AS h FROM placed)",
        *tree("d", DOC_LEVELS),
        f"t0 AS (SELECT 0 AS g, g AS i, count(*) OVER () AS n, h FROM d{DOC_LEVELS})",
        *tree("t", GROUP_LEVELS),
        "f0 AS (SELECT doc_id, leaf, g, g AS q, 0 AS o, i AS p, coalesce(changed, leaf) AS h, '' AS proof FROM placed)",
        *folds("p", "d", DOC_LEVELS, 0),
        *folds("q", "t", GROUP_LEVELS, DOC_LEVELS),
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT f.doc_id, f.leaf, d.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM f{DOC_LEVELS + GROUP_LEVELS} f JOIN d{DOC_LEVELS} d ON d.g = f.g CROSS JOIN t{GROUP_LEVELS} t"""


OP13_SQL = _sql()
