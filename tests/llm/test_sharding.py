import collections
import zlib

from moorline.llm import sharding as S
from moorline.llm.common import work_uri

from . import helpers as H


def _check(rows, docs, shards=24):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    held = collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        held[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in held.values())


def test_sizes_are_near_equal(spark):
    docs = [(i, t) for i, t, _ in H.documents()] * 1
    docs += [(10 ** 6 + i, "copy of one text, many times over") for i in range(3000)]
    rows = S.assign(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    _check(rows, docs)
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) <= 1.02 * min(load.values())


def test_edges(spark):
    _check(S.assign(H.edges(spark)).collect(), H.EDGES)
    assert S.assign(H.empty(spark)).collect() == []


def test_map_versions_and_small_edits(spark):
    store = S.SlotMap(spark, work_uri(spark, "test-map"), slots=64)
    first = store.create(4)
    assert store.load(0) == first
    sizes = [100 + s % 7 for s in range(64)]
    sizes[3] = 900
    second = store.save(1, S.rebalance(first, sizes, 4))
    load = [sum(z for z, k in zip(sizes, second) if k == x) for x in range(4)]
    assert max(load) - min(load) <= 4 and sum(a != b for a, b in zip(first, second)) <= 24
    assert S.rebalance(second, sizes, 4) == second and store.load(1) == second


def test_written_shards_hold_every_row(spark):
    docs = H.edges(spark)
    path = work_uri(spark, "test-shards")
    where = S.write_shards(docs, path, shards=3)
    back = spark.read.parquet(path)
    assert back.count() == where.count() == len(H.EDGES)
    by = {(r.doc_id, r.shard) for r in where.collect()}
    assert {(r.doc_id, r.shard) for r in back.collect()} == by


def _shards_of(rows):
    held = collections.defaultdict(set)
    for r in rows:
        held[(r.text_crc32, r.size)].add(r.shard)
    return held


def test_groups_that_fit_into_a_shard_are_not_split(spark):
    for folder in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
        rows = S.assign(docs).collect()
        total, bytes_of = collections.Counter(), collections.Counter()
        for r in rows:
            bytes_of[(r.text_crc32, r.size)] += r.size
            total[r.shard] += r.size
        share = sum(total.values()) / 24
        split = [g for g, s in _shards_of(rows).items() if len(s) > 1]
        assert all(bytes_of[g] > share for g in split)
        assert sum(n > 1 for n in collections.Counter((r.text_crc32, r.size) for r in rows).values()) > 5
        assert max(total.values()) <= 1.1 * share


def test_a_group_larger_than_a_shard_and_repeated_identifiers(spark):
    docs = [(7, "one text under one identifier")] * 900 + [(i, f"text {i} " * 30) for i in range(300)] + [(i, "") for i in range(600)]
    rows = S.assign(spark.createDataFrame(docs, "doc_id bigint, text string"), slots=512, shards=6).collect()
    _check(rows, docs, shards=6)
    load = collections.Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) <= 1.1 * min(load.values())
    slots = collections.Counter(r.vslot for r in rows if r.text_crc32 == zlib.crc32(b"one text under one identifier"))
    assert len(slots) == 1 or max(slots.values()) < 300


def test_a_hot_slot_is_numbered_in_many_pieces(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN '' ELSE concat('text ', id, repeat(' x', 2000)) END AS text")
    out = S.assign(docs, slots=64, shards=4)
    rows = out.collect()
    assert len({r.vslot for r in rows if r.size == 8}) == 1         # one group, far smaller than a shard
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(vslot" in plan and "piece" in plan.split("windowspecdefinition(")[1][:40]
    held = collections.defaultdict(list)
    for r in rows:
        held[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
