import numpy as np

from moorline.llm import setsketch as S

from . import helpers as H


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    for j in (0.5, 0.85):
        n = 600
        common = int(round(2 * n * j / (1 + j)))
        pool = rng.integers(0, 2 ** 63, 2 * n, dtype=np.uint64)
        a, b = pool[:n], pool[n - common:2 * n - common]
        ra, rb = S.registers(a), S.registers(b)
        assert (S.registers(np.union1d(a, b)) == np.maximum(ra, rb)).all()
        at, _, _ = S.estimate(ra[None], rb[None], np.array([float(n)]), np.array([float(n)]))
        assert abs(at[0] - j) < 0.12
        assert (S.band_registers(S.band_keys(ra[None]))[0] == ra).all()


def test_equal_register_count_in_sql(spark):
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 4, (20, S.BANDS * S.ROWS)).astype(np.uint8) * 85 for _ in range(2))
    rows = [(x.tolist(), y.tolist()) for x, y in zip(S.band_keys(a), S.band_keys(b))]
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = [r[0] for r in df.select(S._equal_registers(df.a, df.b)).collect()]
    assert got == [int((x == y).sum()) for x, y in zip(a, b)]


def _check(spark, docs, **how):
    rows = S.near_dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), **how).collect()
    root, size = H.components(docs, how["k"], how["num"], how["den"])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == \
        {i: (size[i], root[i], root[i] == i) for i in root}


def test_equals_brute_force(spark):
    docs = [(i, t) for i, t, _ in H.documents()]
    _check(spark, docs, k=3, num=85, den=100)
    _check(spark, docs, k=5, num=4, den=5)


def test_clusters_of_near_copies(spark):
    """Groups whose members are linked by way of others only, in blocks of few members."""
    rng = np.random.default_rng(3)
    docs = []
    for g in range(3):
        centre = [f"w{x}" for x in rng.integers(0, 5000, 150)]
        for c in range(70):
            text = list(centre)
            for at in rng.integers(0, 150, rng.integers(1, 9)):
                text[at] = f"e{rng.integers(0, 10 ** 6)}"
            docs.append((1000 * g + c, " ".join(text)))
    _check(spark, docs, k=3, num=85, den=100)


def test_rest_links_find_all_pairs_in_blocks(spark):
    rng = np.random.default_rng(4)
    sets = {i: np.unique(rng.integers(0, 40, 25).astype(np.uint64)) for i in range(60)}
    members = spark.createDataFrame([(1, i, i, i % 3 == 0) for i in sets], "grp bigint, cid bigint, label bigint, rest boolean")
    full = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "id bigint, s binary")
    got = {(r.u, r.v) for r in S._rest_links(members, full, 1, 2, block=7).collect()}
    expected = set()
    for a in sets:
        for b in sets:
            both = len(np.intersect1d(sets[a], sets[b]))
            if a < b and (a % 3 == 0 or b % 3 == 0) and 2 * both >= len(sets[a]) + len(sets[b]) - both:
                expected.add((a, b))
    assert got == expected and expected


def test_edges(spark):
    rows = S.near_dedup(H.edges(spark)).collect()
    assert len(rows) == len(H.EDGES)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_shingles == 0 and by[1][0].component_id == 1 and by[1][0].kept
    assert by[4][0].kept and [r.component_id for r in by[5]] == [4, 4] and not by[5][0].kept
    assert by[7][0].component_id == 6 and by[6][0].kept
    assert S.near_dedup(H.empty(spark)).collect() == []
    assert S.keep_rows(H.edges(spark)).columns == H.edges(spark).columns


def test_words_that_collide_in_polynomial_hashes_are_told_apart(spark):
    one, other = H.thue_morse(11)
    _check(spark, [(1, one), (2, other), (3, f"{one} a b"), (4, f"{other} a b")], k=3, num=85, den=100)


def test_rows_without_an_identifier_of_their_own(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(None, base), (4, base + " x"), (4, "something else entirely, six words long"), (None, "another text of quite some words"),
            (9, "another text of quite some words end"), (None, None)]
    kept = S.keep_rows(spark.createDataFrame(docs, "doc_id bigint, text string"), k=3, num=4, den=5).collect()
    texts = [r.text for r in kept]
    assert sum(t is not None and t.startswith("w0") for t in texts) == 1
    assert (4, "something else entirely, six words long") in [tuple(r) for r in kept]
    assert [r.doc_id for r in kept if r.text and r.text.startswith("another")] == [9] and None in texts
