import hashlib
import random

from pyspark.sql import functions as F

from aeromill.llm import line_dedup

ROWS = [
    (1, "one two three four five.\nshort line\nThis is a sentence of at least eight words. Tail."),
    (2, "ONE  two three four   five.\nelse where to be found\n"),
    (3, "before it stands some text and more. This is a sentence of at least eight words. after"),
    (4, None),
    (5, ""),
    (6, "short line\nshort line"),
    (7, "rep eat ed line here\nrep eat ed line here\nrep eat ed line here"),
]


def in_order(rows, min_words=line_dedup.MIN_WORDS):
    """The same by one ordered pass over unique ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        text, spans, found = text or "", [], line_dedup.units(text or "", min_words)
        for unit, start, end in sorted(found, key=lambda u: u[1:]):
            if unit in seen:
                spans.append((start, end))
            seen.add(unit)
        cut = line_dedup.closed(text, spans)
        out[doc_id] = (len(found), len(spans), ",".join(f"{a}:{b}" for a, b in cut), hashlib.sha256(line_dedup.without(text, cut).encode()).hexdigest())
    return out


def naive_units(text, least):
    """Every run of whole lines or sentences that would be too short without its first or its last one."""
    found, at = [], 0
    for line in text.split("\n"):
        start = 0
        for k in range(len(line) + 1):
            if k == len(line) or (line[k].isspace() and k and line[k - 1] in ".!?"):
                piece = line[start:k]
                if piece.split():
                    lead = len(piece) - len(piece.lstrip())
                    found.append((at + start + lead, at + start + len(piece.rstrip()), piece.lower().split()))
                start = k
        at += len(line) + 1
    out = set()
    for i in range(len(found)):
        for j in range(i + 1, len(found) + 1):
            words = [w for p in found[i:j] for w in p[2]]
            if len(words) >= least > min(len(words) - len(found[i][2]), len(words) - len(found[j - 1][2])):
                out.add((" ".join(words), found[i][0], found[j - 1][1]))
    return out


def test_units_against_all_runs():
    r = random.Random(6)
    for _ in range(300):
        text = "".join("".join(r.choices(["ab ", "c ", "D. ", "e! ", "f?", " ", "x.y "], k=r.randrange(5))) + r.choice(["\n", ". ", "\n\n", ""]) for _ in range(r.randrange(12)))
        for least in (1, 3, 5):
            got = line_dedup.units(text, least)
            # A run that is shortest from one side only; those from neither side are no units.
            assert set(got) == {u for u in naive_units(text, least)} and len(got) == len(set(got)), text


def collected(df):
    return {r.doc_id: (r.n_units, r.n_removed, r.removed_spans, r.kept_sha256) for r in df.collect()}


def test_examples(spark):
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(ROWS, "doc_id long, text string"), min_words=4).collect()}
    assert out[1].n_removed == 0 and out[1].kept_text == ROWS[0][1]
    assert out[2].kept_text == "else where to be found\n"
    assert out[3].kept_text == "before it stands some text and more. after"
    assert (out[4].kept_text, out[5].kept_text) == ("", "")
    assert out[6].n_removed == 0
    assert out[7].kept_text == "rep eat ed line here\n"


def test_against_one_ordered_pass(spark):
    r = random.Random(5)
    sentences = [" ".join(r.choices("abcdefghij", k=r.randrange(1, 12))) + "." for _ in range(30)]
    rows = [(i, "".join(r.choice(sentences) + r.choice([" ", "\n", "  "]) for _ in range(r.randrange(9)))) for i in range(60)] + ROWS[3:5]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit(0)).withColumn("high", F.lit("x"))
    assert collected(line_dedup.op4(docs.repartition(7))) == in_order(rows)


def test_no_rows_and_repeated_ids(spark):
    assert line_dedup.op4(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a line of four words"), (None, "a line of four words"), (3, "a line of four words"), (3, "another line of more words")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_words=4).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in out) == [(0, 0), (0, 0), (3, 0), (3, 1)]


def test_passage_without_sentences(spark):
    r = random.Random(3)
    words = ["w%d" % i for i in range(5000)]
    passage = " ".join(r.choices(words, k=60))
    rows = [(i, " ".join([*r.choices(words, k=r.randrange(40)), passage, *r.choices(words, k=r.randrange(40))])) for i in range(30)] + [(99, " ".join(r.choices(words, k=300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {x.doc_id: x.n_removed for x in line_dedup.op4(docs).collect()}
    assert out[0] == 0 and out[99] == 0 and all(out[i] > 0 for i in range(1, 30))
    assert collected(line_dedup.op4(docs)) == in_order(rows)


def test_nearly_all_of_a_passage_in_the_middle_of_lines():
    r = random.Random(11)
    words = ["w%d" % i for i in range(5000)]
    shares = []
    for _ in range(200):
        passage = r.choices(words, k=50)
        for k in range(5, 50, 6):  # short sentences
            passage[k] += "."
        passage = " ".join(passage)
        texts = [f"{' '.join(r.choices(words, k=20))} {passage} {' '.join(r.choices(words, k=20))}" for _ in range(2)]
        spans = in_order(list(enumerate(texts)))[1][2]
        left = [int(x) for s in spans.split(",") if s for x in s.split(":")]
        at = texts[1].index(passage)
        assert all(at <= x <= at + len(passage) for x in left)
        shares.append(sum(len(texts[1][a:b].split()) for a, b in zip(left[::2], left[1::2], strict=True)) / 50)
    assert sum(shares) / len(shares) > 0.8 and min(shares) > 0.3


def test_runs_cross_lines_and_need_no_spaces():
    r = random.Random(12)
    hard = "\n".join(" ".join("v%d" % r.randrange(900) for _ in range(3)) for _ in range(20))
    han = "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(120))
    token = "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=400))
    for passage in (hard, han, token):
        rows = [(i, f"{i} other {passage}{'.' * i} tail {i}") for i in range(2)]
        spans = in_order(rows)[1][2]
        gone = sum(int(b) - int(a) for a, b in (s.split(":") for s in spans.split(",") if s))
        assert 0.6 * len(passage) < gone <= len(passage) + 8
    assert in_order([(0, han), (1, f"x\n{han}\ny")])[1][2] == "2:123"
    short = [(0, "天地玄黄"), (1, "天地玄黄")]
    assert in_order(short)[1][1] == 0
