import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeromill.llm import toxicity as tox


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    r = random.Random(4)
    terms = [tox.Term(t, whole, rate, 1e-4) for t, whole, rate in [("abcab", True, 0.1), ("bacaba", False, 0.2), ("ccb", True, 0.3), ("abca", False, 0.05), ("cabbac", True, 0.4)]]
    lexicon = tox.Lexicon(terms)
    for _ in range(4000):
        token = "".join(r.choices("abcd", k=r.randrange(1, 10)))
        found = []
        for t in terms:
            d = distance(token, t.text) if t.whole else min(distance(token[:k], t.text) for k in range(len(token) + 1))
            if d <= t.edits:
                found.append((d, -t.weight))
        got = lexicon.match(token)
        assert (None if got is None else (got[1], -terms[got[0]].weight)) == (min(found) if found else None), token


def test_context_separates_quotation():
    lexicon = tox.Lexicon([tox.Term("idiot", True, 1e-2, 1e-5)])
    f = lambda t: dict(zip(tox.FEATURES, tox.features(t, lexicon), strict=True))
    assert f("you are an idiot")["addressed"] > 0 and f("an idiot")["addressed"] == 0
    assert f("He wrote that the word idiot is old")["hits"] == 0 and f("He wrote that the word idiot is old")["reported"] > 0
    assert f('the “idiot plays on” review')["hits"] == 0
    assert f("you idoit")["slips"] == 0 and f("you idiiot")["misspelled"] > 0
    assert f(None)["length"] == f("")["length"] == 0


def planted(n, seed):
    r = random.Random(seed)
    stems, clean = ["grumbl", "slurkel"], ["w%s" % "".join(r.choices("abcdefgh", k=5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = r.choices(clean, k=r.randrange(20, 200))
        toxic = r.random() < 0.25
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words[r.randrange(len(words))] = r.choice(stems) + r.choice(["en", "ost", "", "ache"])
        docs.append((i, " ".join(words)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_learned_stems_and_held_out_accuracy(spark):
    docs, labels = planted(1500, 2)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("toxic", F.lit(0))
    truth = {i: t for i, _, t in labels}
    out = tox.op9(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_are_never_read(spark):
    docs, labels = planted(300, 3)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    scores = [sorted((r.doc_id, r.score) for r in tox.op9(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_edges(spark):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "you stupid idiot, you worthless moron"), (4, "fine " * 50_000)], "doc_id long, text string")
    out = tox.op9(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert max(out, key=lambda r: r.score).doc_id is None
    assert tox.op9(docs.limit(0), labels).count() == 0
    model = tox.learn(docs, labels)
    kept = tox.keep_clean(docs.withColumn("Score", F.lit(1)), model)
    assert kept.columns == ["doc_id", "text", "Score"] and kept.count() == 4


def test_misspelled_hits_in_context():
    lexicon = tox.Lexicon([tox.Term("idiot", True, 1e-2, 1e-5), tox.Term("worthless", True, 1e-2, 1e-5)], spelled=["idiom"])
    f = lambda t: dict(zip(tox.FEATURES, tox.features(t, lexicon), strict=True))
    assert f("you id1ot, you w*rthless idiiot")["slips"] > 1 and f("you id1ot")["addressed"] > 0 and f("you id1ot")["hits"] == 0
    assert f("he wrote that id1ot is a word")["slips"] == 0 and f("he wrote that id1ot is a word")["reported"] > 0
    assert f('“you id1ot” it says')["slips"] == 0 and f("an idiom of ours")["slips"] == 0
    other = tox.misspelled("An idiot is worthless, and idle", lexicon)
    assert f(other)["hits"] == 0 and f(other)["slips"] == f("id1ot w0rthless")["slips"] and other.endswith(", and idle")


def test_misspelled_toxic_texts_are_found(spark):
    docs, labels = planted(1500, 5)
    truth = {i: t for i, _, t in labels}
    model = tox.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    lexicon = model.lexicon()
    held = [(i, t) for i, t in docs if i in truth and zlib.crc32(str(i).encode()) % 3 == 1]
    slipped = [tox.misspelled(t, lexicon) for i, t in held if truth[i]]
    assert np.mean([model.score(tox.features(t, lexicon)) >= 0.7 for t in slipped]) > 0.9
    assert np.mean([model.score(tox.features(t, lexicon)) < 0.7 for i, t in held if not truth[i]]) > 0.97
    plain = tox.learn(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert plain.score(tox.features("you idiiot, you worthles m0ron", plain.lexicon())) > plain.score(tox.features("you, and the others too", plain.lexicon()))


def test_equal_texts_with_other_labels(spark):
    docs, labels = planted(300, 7)
    docs += [(10_000 + i, t) for i, t in docs[:40]]
    labels += [(10_000 + i, 1, 1 - t) for i, _, t in labels if i < 40]
    runs = [
        sorted((r.doc_id, r.score) for r in tox.op9(spark.createDataFrame(docs, "doc_id long, text string").repartition(n), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())
        for n in (1, 5)
    ]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("ridge", [0.1, 1.0])
def test_logistic(ridge):
    r = np.random.default_rng(0)
    x = r.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.1 * r.normal(size=400) > 0).astype(float)
    mean, scale, w, b = tox.fit_logistic(x, y, ridge)
    assert (((x - mean) / scale @ w + b > 0) == (y > 0)).mean() > 0.95
