import random

from moorline.llm import decontam as D

from . import helpers as H


def brute(docs, items, window=13):
    win = {}
    for i, t in items:
        w = H.words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            win.setdefault(tuple(w[s:s + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, names = H.words(t), set(), set()
        for n in {len(x) for x in win}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in win:
                    hit.update(range(s, s + n))
                    names |= win[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def _got(spark, docs, items, **how):
    df = docs if not isinstance(docs, list) else spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated)
                   for r in D.decontaminate(df, bench, **how).collect()), key=str)


def test_random_texts_and_short_items(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice("abcde") + rng.choice("xyzé") for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 20]))) for i in range(12)] + [(3, text(4)), (None, text(2)), (50, None), (51, "")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)] + [(90, items[3][1].upper()), (91, " - ".join(items[4][1].split()))]
    expected = brute(docs, items)
    assert any(x[4] for x in expected) and any(x[2] and not x[4] for x in expected) is not None
    assert _got(spark, docs, items) == expected
    assert _got(spark, docs, items, block=5) == expected


def test_windows_overlap_inside_an_item(spark):
    rng = random.Random(2)
    item = " ".join(f"w{rng.randint(0, 9)}" for _ in range(40))
    docs = [(1, "a b " + " ".join(item.split()[5:25]) + " c"), (2, " ".join(item.split()[:12])), (3, item + " " + item)]
    assert _got(spark, docs, [(7, item), (8, item)]) == brute(docs, [(7, item), (8, item)])


def test_edges(spark):
    items = [(1, "mit license"), (2, None)]
    assert _got(spark, H.edges(spark), items) == brute(H.EDGES, items)
    assert _got(spark, H.empty(spark), items) == []
    clean = D.decontaminate(H.edges(spark), spark.createDataFrame([], "item_id bigint, text string"))
    assert clean.where("n_hit > 0 or contaminated").count() == 0 and clean.count() == len(H.EDGES)
    kept = D.keep_rows(H.edges(spark), spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == H.edges(spark).columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 6, 7, 8, 9, 10, 11, 12, 13, None}


def test_words_that_collide_in_polynomial_hashes_are_told_apart(spark):
    one, other = H.thue_morse(11)
    docs = [(1, one), (2, other), (3, f"x {one} y"), (4, f"x {other} y")]
    assert _got(spark, docs, [(7, one)]) == brute(docs, [(7, one)])
    assert [r[2] for r in brute(docs, [(7, one)])] == [1, 0, 1, 0]


def test_rows_keep_their_verdict_when_a_lost_executor_changes_the_split(spark, monkeypatch):
    items = [(i, f"word{i} other{i} third{i}") for i in range(12)]
    docs = [(i, f"a{i} " + items[i % 12][1] + f" {items[(i + 1) % 12][1]}" if i % 3 else "clean text") for i in range(200)]
    with H.moving(spark, monkeypatch, D, docs, "doc_id bigint, text string") as table:
        assert _got(spark, table, items, block=4) == brute(docs, items)


def test_rows_are_judged_by_their_text(spark):
    bad = "mit license"
    docs = spark.createDataFrame([(None, bad), (1, bad), (1, "clean words only"), (None, "clean"), (2, None)], "doc_id bigint, text string")
    kept = D.keep_rows(docs, spark.createDataFrame([(1, bad)], "item_id bigint, text string"))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, "clean words only"), (None, "clean"), (2, None)], key=str)
