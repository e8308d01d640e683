"""The manifest and its proofs against a plain Merkle tree."""

import collections
import hashlib
import zlib

from pyspark.sql import functions as F

from moorline.llm import merkle as M

from . import helpers as H

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def fold(nodes):
    """Root of a list of hashes and, per leaf, its siblings level by level as (before, after)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 3] for i in range(0, len(nodes), 3)]
        for way, i in zip(ways, at):
            way.append((runs[i // 3][:i % 3], runs[i // 3][i % 3 + 1:]))
        at, nodes = [i // 3 for i in at], [sha("".join(r)) for r in runs]
    return nodes[0], ways


def brute(rows):
    def bare(r):
        lost = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
        return r[:4] + (r[4].replace("\n", ""),) if lost else r
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        of = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((of, *fold([leaf(r) for r in of])))
    root, upper = fold([t[1] for t in trees])
    out = []
    for (of, subroot, ways), top in zip(trees, upper):
        for r, way in zip(of, ways):
            h = leaf(bare(r))
            for before, after in way + top:
                h = sha("".join(before) + h + "".join(after))
            proof = sha("".join("".join(b) + "".join(a) for b, a in way + top))
            out.append((r[0], leaf(r), subroot, root, proof, h, h == root))
    return sorted(out, key=str)


def _got(df):
    lost = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
                  F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proved = M.verify(M.build(df, COLUMNS, claim={"text": lost}))
    proof = F.sha2(F.array_join(F.transform("siblings", lambda x: F.lower(F.hex(x))), ""), 256)
    return sorted(map(tuple, proved.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified").collect()), key=str)


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def test_equals_the_plain_tree(spark):
    sources = [None, "", "b", "a", "é", "Z"] + [f"s{i}" for i in range(8)]
    rows = [(i * 7 % 101 if i % 9 else None, sources[(i * i + i // 14) % len(sources)], "en" if i % 3 else None, i if i % 4 else None,
             [None, "", "one\ntwo", f"text {i}", "é日\n"][i % 5]) for i in range(300)]
    got = _got(_table(spark, rows + rows[:5]).repartition(5))
    assert got == brute(rows + rows[:5])
    assert {r[6] for r in got} == {True, False} and len({r[2] for r in got}) == len(sources)


def test_single_leaf_and_single_group(spark):
    for rows in ([(1, "a", None, 2, "x\ny")], [(2, "a", None, 2, "x\ny"), (3, "a", None, 2, "x\ny")],
                 [(i, "a", None, i, "t\n") for i in range(10)], [(i, f"g{i}", None, i, "t\n") for i in range(4)]):
        assert _got(_table(spark, rows)) == brute(rows)


def test_edges(spark):
    rows = [(i, None, None, None, t) for i, t in H.EDGES]
    assert _got(H.edges(spark)) == brute(rows)
    assert M.verify(M.build(H.empty(spark), COLUMNS)).collect() == []


def test_levels_are_linked_to_the_root(spark):
    rows = [(i, f"s{i % 4}", "en", i, f"text {i}") for i in range(50)]
    built = M.build(_table(spark, rows), COLUMNS)
    nodes = {r.node: r for r in built.nodes.collect()}
    for r in built.leaves.collect():
        node, h = r.node, bytes(r.leaf).hex()
        while node in nodes:
            assert bytes(nodes[node].hash).hex() == h
            h, node = bytes(nodes[node].up).hex(), nodes[node].parent
        assert h == built.root.hex()
