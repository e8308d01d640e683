import numpy as np
import pyarrow as pa

from moorline.llm import langid as L

from . import helpers as H


def test_gradients_are_those_of_the_loss():
    net = L.Network.new(["a", "b", "c"], hidden=4)
    for p in net.parameters():
        p[...] = p.astype("f4")
    rng = np.random.default_rng(3)
    x = rng.integers(0, 5, (6, 8))
    x[4:, 2] = L.PAD
    y = rng.integers(0, 3, 8)
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 0.01
        up, _ = net.gradients(x, y)
        p[at] = old - 0.01
        down, _ = net.gradients(x, y)
        p[at] = old
        assert abs((up - down) / 0.02 - g[at]) < 0.02 * max(1, abs(g[at])) + 1e-3


def test_pooling_equals_the_training_pass():
    net = L.Network.new(["a", "b"], hidden=4)
    x = np.random.default_rng(4).integers(0, 256, (10, 5))
    x[7:, 1] = L.PAD
    pooled = net.pooled(x)
    assert np.allclose(pooled.sum(axis=1), (x != L.PAD).sum(axis=0), atol=1e-3)


def _plain(net, text):
    """Mean distribution over all positions of a text, one byte at a time."""
    raw, total = text.encode(), np.zeros(len(net.languages))
    at = 0
    while at < len(raw):
        # The chunk ends at the next multiple of CHUNK, or before the character that lies across it.
        end = min(len(raw), (at // L.CHUNK + (2 if at % L.CHUNK > L.CHUNK - 4 and at else 1)) * L.CHUNK)
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        states = []
        for gru, order in ((net.ahead, range(at, end)), (net.back, range(end - 1, at - 1, -1))):
            h, own = np.zeros(len(gru.ur)), {}
            for i in order:
                r, z = (1 / (1 + np.exp(-(x[raw[i]] + h @ u))) for x, u in ((gru.xr, gru.ur), (gru.xz, gru.uz)))
                c = np.tanh(gru.xc[raw[i]] + r * (h @ gru.uc))
                h = z * h + (1 - z) * c
                own[i] = h
            states.append(own)
        for i in range(at, end):
            e = np.exp(np.concatenate([s[i] for s in states]) @ net.out + net.bias)
            total += e / e.sum()
        at = end
    return total / len(raw)


def test_judging_equals_a_plain_loop():
    net = L.train([("le chat noir".encode(), "fr"), ("the black cat".encode(), "en"), ("日本語の文章".encode(), "ja")] * 3, epochs=2, hidden=5)
    texts = ["the cat " * 40, "é" * 100 + "x", "日本語の文章です" * 30, "a", "x" * 95 + "日本", "mixed é日 text " * 13 + "🙂" * 40]
    lang, score = L.judge(net, pa.array([*texts, None, "skipped"]), np.array([True] * len(texts) + [True, False]))
    for t, y, p in zip(texts, lang, score):
        want = _plain(net, t)
        assert y == net.languages[int(want.argmax())] and abs(p - want.max()) < 1e-4, t[:20]
    assert lang[-1] == L.UNKNOWN and score[-1] == 0


def test_chunks_end_between_characters():
    raw = np.frombuffer(("a" + "日" * 200).encode(), np.uint8)
    row, start, size = L.chunks(raw, np.array([0, 10]), np.array([len(raw), 0]))
    assert row.tolist() == [0] * len(row) and size.sum() == len(raw) and (start[1:] == start[:-1] + size[:-1]).all()
    assert all(raw[i:i + n].tobytes().decode() for i, n in zip(start, size)) and max(size) <= L.CHUNK + 3


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.fit_identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    net = L.train(L.sample(spark.createDataFrame([(i, t, lang) for i, t, lang in H.documents()],
                                                 "doc_id bigint, text string, lang string"), per_language=20), epochs=1)
    rows = L.identify(H.edges(spark), net).collect()
    assert len(rows) == len(H.EDGES)
    by = {r.doc_id: r for r in rows}
    for i in (1, 2, 3, 9, 13):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert by[6].lang_pred in net.languages and by[6].lang_pred == by[7].lang_pred and by[6].score == by[7].score
    assert L.identify(H.empty(spark), net).collect() == []
    assert {r.lang_pred for r in L.fit_identify(H.edges(spark)).collect()} == {"und"}
    kept = L.keep_rows(H.edges(spark), net)
    assert kept.columns == H.edges(spark).columns
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3, 9, 13}
