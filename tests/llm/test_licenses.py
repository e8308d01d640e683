import random

from moorline.llm import licenses as L

from . import helpers as H

PHRASES = [(t.label, t.words) for t in L.TEMPLATES if t.base]


def brute(text):
    w = H.words(text)
    places = sorted((s, label) for label, p in PHRASES for s in range(len(w)) if w[s:s + len(p)] == p)
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({x for _, x in places})))


def _check(rows, docs):
    got = sorted((tuple(r)[:6] for r in rows), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in docs), key=str)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in rows if r.base_labels)


def test_edges_and_documents(spark):
    _check(L.labelled(L.scan(H.edges(spark))).collect(), H.EDGES)
    assert L.scan(H.empty(spark)).collect() == []
    docs = [(i, t) for i, t, _ in H.documents()]
    _check(L.labelled(L.scan(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_random_phrases(spark):
    rng = random.Random(8)
    parts = ["MIT", "License", "license", "gnu", "general", "public", "cc", "BY", "apache", "x", "é", "ÉCC", "mit-license", "CC-BY", "K"]
    docs = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))) for i in range(400)]
    _check(L.labelled(L.scan(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect(), docs)


def test_passages_are_found_with_a_word_changed_but_not_without_key_phrase(spark):
    mit = next(t for t in L.TEMPLATES if t.label == "mit" and not t.base)
    changed = mit.text.replace("any person", "each person")
    without = mit.text.replace("associated documentation files", "associated documentation papers")
    docs = [(1, "a b " + mit.text.upper() + " c"), (2, changed), (3, without), (4, "permission is hereby granted")]
    rows = {r.doc_id: r for r in L.labelled(L.scan(spark.createDataFrame(docs, "doc_id bigint, text string"))).collect()}
    assert rows[1].labels == "mit" and rows[1].score == 1.0 and rows[1].n_base == 0
    assert rows[2].labels == "mit" and 0.6 < rows[2].score < 1
    assert rows[3].labels == "" and rows[4].labels == "" and rows[4].score == 0


def test_published_mit_notice(spark):
    notice = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
              'documentation files (the "Software"), to deal\nin the Software without restriction, including without '
              "limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies")
    row = L.labelled(L.scan(spark.createDataFrame([(1, notice)], "doc_id bigint, text string"))).first()
    assert row.labels == "mit" and row.score == 1.0


def _altered(template, rng, share):
    """The passage with words outside its key phrases replaced."""
    keys = set(template.key_positions())
    return [w if j in keys or rng.random() >= share else f"altered{rng.randrange(50)}" for j, w in enumerate(template.words)]


def test_recall_of_altered_passages_of_every_template(spark):
    rng = random.Random(12)
    docs, meant = [], {}
    for n, t in enumerate(L.TEMPLATES):
        for copy in range(12 if not t.base and len(t.words) > len(t.key_positions()) else 0):
            words = _altered(t, rng, rng.choice([0.1, 0.25, 0.4]))
            filler = [rng.choice("lorem ipsum software the license of any copy".split()) for _ in range(rng.randint(0, 40))]
            docs.append((len(docs), " ".join(filler + words + filler[::-1])))
            meant[docs[-1][0]] = (n, words, len(filler))
    table = spark.createDataFrame(docs + [(10 ** 6 + i, "plain words of no licence at all") for i in range(300)], "doc_id bigint, text string")
    idf = L.inverse_frequencies(table, sorted({w for t in L.TEMPLATES for w in t.words}))
    found = {r.doc_id: {(m.template, m.start) for m in r.matches} for r in L.scan(table).collect()}
    due = hit = 0
    for doc, (n, words, start) in meant.items():
        t = L.TEMPLATES[n]
        score = sum(idf[w] for w, x in zip(t.words, words) if w == x) / sum(idf[w] for w in t.words)
        if score >= L.LEAST_SCORE + 1e-6:
            due += 1
            hit += (n, start) in found[doc]
        else:
            assert (n, start) not in found[doc]
    assert due > 80 and hit >= 0.9 * due, (hit, due)
    assert not any(found[10 ** 6 + i] for i in range(300))


def test_passages_whose_rarest_words_are_damaged(spark):
    t = next(t for t in L.TEMPLATES if t.label == "isc")
    docs = [(1, t.text)] + [(10 + i, "unrelated words") for i in range(50)]
    idf = L.inverse_frequencies(spark.createDataFrame(docs, "doc_id bigint, text string"), sorted(set(t.words)))
    keys = set(t.key_positions())
    rarest = sorted((j for j in range(len(t.words)) if j not in keys), key=lambda j: -idf[t.words[j]])[:4]
    damaged = " ".join("damaged" if j in rarest else w for j, w in enumerate(t.words))
    row = L.labelled(L.scan(spark.createDataFrame([*docs, (2, damaged)], "doc_id bigint, text string"))).where("doc_id = 2").first()
    assert row.labels == "isc" and 0.6 <= row.score < 1
