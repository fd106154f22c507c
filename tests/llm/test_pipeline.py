import random
import zlib

import numpy as np
from pyspark.sql.functions import lit

import corpus_pipeline
from aeromill.llm import mixing, packing, secrets, simhash
from aeromill.llm import toxicity as tox


def documents(seed=1, n=240):
    r = random.Random(seed)
    vocabulary = ["w" + "".join(r.choices("abcdefghij", k=4)) for _ in range(500)]
    rows = []
    for i in range(n):
        words = r.choices(vocabulary, k=r.randrange(20, 120))
        if i % 6 == 0:
            for _ in range(5):
                words[r.randrange(len(words))] = r.choice(["idiot", "moron", "scum", "worthless"])
        if i % 11 == 0:
            words.append('token = "' + "".join(r.choices("0123456789abcdef", k=40)) + '"')
        rows.append((i, " ".join(words), "en", f"src{i % 3}"))
    for i in range(n, n + 40):
        words = rows[r.randrange(n)][1].split()
        if i % 2:
            words[r.randrange(len(words))] = "other"
        rows.append((i, " ".join(words), "de", "src0"))
    rows += [(n + 50, None, None, None), (n + 51, "", "en", None)]
    return [(*row, len(row[1] or "")) for row in rows]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_against_plain_python(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d, 1, int(d % 6 == 0)) for d, *_ in rows if d < 240 and d % 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secrets", "mixing", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    schema, out = docs.schema, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        out.append(docs.collect())
        assert k == 4 or docs.schema == schema

    # Toxicity: what the model scores high goes; here that is every planted text and no other.
    model = tox.learn(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    lexicon = model.lexicon()
    clean = {row[0]: row for row in rows if model.score(tox.features(row[1], lexicon)) < corpus_pipeline.TOXIC}
    assert {r.doc_id for r in out[0]} == set(clean)
    assert all(("idiot" in (t or "") or "moron" in (t or "") or "scum" in (t or "") or "worthless" in (t or "")) != (d in clean) for d, t, *_ in rows)

    # Near-duplicates: the least id of each group stays; links are texts whose sets of five-word
    # shingles have a Jaccard similarity of 0.8 or more.
    ids = sorted(clean)
    shingles = {d: set(zip(*[(clean[d][1] or "").lower().split()[k:] for k in range(5)], strict=False)) or {tuple((clean[d][1] or "").split())} for d in ids}
    group = {d: d for d in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if group[b] < group[a] and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                    group[a], changed = group[b], True
    assert sorted(r.doc_id for r in out[1]) == sorted(set(group.values()))
    assert len(out[1]) < len(out[0])

    # Secrets: the same documents, texts redacted.
    assert {r.doc_id: (r.text, r.n_chars) for r in out[2]} == {r.doc_id: (secrets.redact(r.text), len(secrets.redact(r.text) or "")) for r in out[1]}

    # Mixing: as many uses as the operator gives.
    uses = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(out[2], schema)).collect()}
    got: dict = {}
    for r in out[3]:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in uses.items() if n}

    # Packing: every use's pieces once, gapless sequences.
    tokeniser = packing.Tokeniser(packing.vocabulary())
    want = sorted((r.doc_id, zlib.crc32(tokeniser.ids(r.text or "") + np.zeros(1, "<u4").tobytes())) for r in out[3])
    assert sorted((r.doc_id, r.ids_crc32) for r in out[4]) == want
    fill: dict = {}
    for r in sorted(out[4], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, (r[:5] for r in whole))) == sorted(map(tuple, (r[:5] for r in out[4])))


def test_keep_first_of_repeated_rows(spark):
    rows = [(3, "a b c d", 1), (3, "a b c d", 2), (1, "A B C D", 3), (None, "a b c d", 4), (9, "x y z w", 5), (None, "only null", 6)]
    out = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, Row int")).collect()
    assert sorted((r.doc_id or -1, r.text) for r in out) == [(-1, "only null"), (1, "A B C D"), (9, "x y z w")]


CLASHING = ("row", "kept", "position", "fp", "size", "target", "component", "score", "toxic", "l_id", "part", "digest", "first", "keys", "length", "ids")


def test_stages_on_odd_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, "you idiot", None, None, 9), (2, None, None, "a", None), (2, None, None, "a", None), (None, "", "en", "b", 0), (None, "word " * 30_000, None, "b", 150_000), (5, "same", "x", "a", 4), (6, "same", "x", None, 4)]
    odd = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING:
        odd = odd.withColumn(name, lit("x"))
    for start in (odd, odd.limit(0)):
        docs, counts = start, []
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{start is odd}-{k}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            counts.append(docs.count())
            assert k == 4 or docs.columns == start.columns
        assert all(counts) if start is odd else not any(counts)
