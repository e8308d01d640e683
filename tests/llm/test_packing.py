import collections
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from moorline.llm import packing as K
from moorline.llm.queries import QUERIES, byte_bpe

from . import helpers as H


def _plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def _check(rows, expected, capacity):
    """Pieces put together are the documents; sequences have no gap and little padding."""
    sequences = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        pieces[r.doc_id].append(r)
    for doc_id, ids in expected.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == capacity or at & (at - 1) == 0


def test_round_trip(spark):
    docs = [(i, t) for i, t, _ in H.documents()]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    rows = K.pack(df, byte_bpe(), merge_tokens=5000).collect()
    plain = _plain()
    _check(rows, {i: plain(t) + [1] for i, t in docs}, 2048)
    for r in rows:
        assert zlib.crc32(bytes(r["ids"])) == r.ids_crc32


def test_edges(spark):
    plain = _plain()
    docs = [(i, t) for i, t in H.EDGES if i not in (5, None)] + [(20, "<|endoftext|> a"), (21, "a" + "\n" * 300000 + "b")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    _check(K.pack(df, byte_bpe(), with_ids=False).collect(), {i: plain(t or "") + [1] for i, t in docs}, 2048)
    rows = K.pack(H.edges(spark), byte_bpe(), with_ids=False).collect()
    assert sum(r.length for r in rows if r.doc_id is None) == len(plain("Mit License")) + 2
    assert K.pack(H.empty(spark), byte_bpe()).collect() == []


def test_segments_keep_the_ids():
    encode = byte_bpe()()
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choice(["a", "Bc", " ", "  ", "\n", "'s", "1", "é", "!", "\t"]) for _ in range(rng.randint(0, 80)))
        parts = list(K.segments(text, 7))
        assert "".join(parts) == text
        assert [x for p in parts for x in encode(p)] == encode(text)


def test_query_takes_its_columns_from_stored_ids(spark, monkeypatch):
    docs = [(i, t) for i, t, _ in H.documents()]
    held, pack = [], K.pack
    monkeypatch.setattr(K, "pack", lambda *a, **b: held.append(pack(*a, **b)) or held[-1])
    rows = QUERIES["op7_packing"](spark, H.SMALL)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert "ids" in held[0].columns and held[0].where("ids is null").count() == 0
    plain = _plain()
    _check(rows.collect(), {i: plain(t) + [1] for i, t in docs}, 2048)
