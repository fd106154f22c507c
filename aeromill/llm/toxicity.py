"""Toxicity: Levenshtein automata intersected with a lexicon trie, scored in context.

The lexicon is learned from labelled texts: word stems and whole words whose share of toxic texts
is reliably above their share of clean ones, with their rates per word in either class; a short
list of fixed terms is always in it. Terms form a trie. A token runs through the intersection of
the trie with the Levenshtein automaton of radius 1: a state is the set of (trie node, edits so
far) that the characters read can have reached, built when first needed; most tokens reach the
empty state after a few characters.

A text's hits give a Poisson log-likelihood ratio of the two classes (so that a long clean text
may hold a few chance hits). Hits in a quotation, or near a word that reports speech, count
apart from direct ones, and so do hits near a word of address. Misspelled hits go through the same
windows; direct ones have sums of their own, whose weights are learned from copies of the toxic
texts in which every hit is misspelled by one letter. Words that clean texts of the sample hold are
spelled as meant: they never count as misspelled. A logistic model of these sums gives the score.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeromill.llm.arrow import map_batches, map_rows, place_of
from aeromill.llm.common import materialise

#: About so many labelled rows at most are used for learning (a hash of the id picks them).
SAMPLE = 8000
#: Terms that are learned at most.
MAX_TERMS = 256
#: Stems have so many letters.
STEMS = range(3, 8)
#: Tokens on either side of a hit that count as its context.
WINDOW = 6
#: How much a misspelled copy of a toxic text counts beside the text itself.
SLIP_WEIGHT = 0.2
#: Tokens that a worker remembers.
MEMO = 400_000

#: Terms of abuse that are in the lexicon whether or not the sample holds them (fixed values).
FIXED_TERMS = (
    "idiot", "moron", "stupid", "scum", "worthless", "pathetic", "loser", "trash", "disgusting", "clown",
    "imbecile", "vermin", "bastard", "bitch", "asshole", "dumbass", "retard", "whore", "wanker", "dickhead",
)
#: Words of address (fixed values).
ADDRESS = frozenset("you your youre u ur yourself du dein deine dich dir ihr euch tu te ti tus usted vos toi ton ta tes vous votre".split())
#: Words that report speech or mention a word as a word (fixed values).
REPORT = frozenset(
    "said says say wrote writes called calls quoted quote quotes word words term terms phrase insult insults slur slurs"
    " sagte schrieb nannte wort wörter dijo escribió llamó palabra palabras término dit écrit appelé mot mots terme".split()
)
#: Rates per word in toxic and clean texts that a fixed term has before any is learned.
PRIOR_RATES = (1e-4, 1e-7)

#: Letters, and single digits or signs between them, as in "id1ot" and "st*pid".
TOKEN = re.compile(r"[^\W\d_]+(?:[\d_@$*][^\W\d_]+)*")
QUOTED = re.compile(r"“[^“”]{1,400}”|„[^„“”]{1,400}[“”]|«[^«»]{1,400}»|(?<!\w)\"[^\"\n]{1,400}\"(?!\w)|(?<!\w)‘[^‘’\n]{1,400}’(?!\w)")


@dataclass(frozen=True)
class Term:
    text: str
    whole: bool  # a whole word, else a stem
    toxic_rate: float
    clean_rate: float

    @property
    def weight(self) -> float:
        return math.log(self.toxic_rate / self.clean_rate)

    @property
    def edits(self) -> int:
        return int(len(self.text) >= (5 if self.whole else 6))


class Lexicon:
    """The trie of the terms and its intersection with the Levenshtein automaton."""

    def __init__(self, terms: Iterable[Term], spelled: Iterable[str] = (), slip_rate: float = 0.0):
        """``spelled`` words never match with an edit; ``slip_rate``: weight of such matches per word of clean text."""
        self.terms = tuple(terms)
        self.spelled, self.slip_rate = frozenset(spelled), slip_rate
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.fuzzy: list[bool] = [False]  # whether a term below allows an edit
        for t, term in enumerate(self.terms):
            node = 0
            self.fuzzy[0] |= bool(term.edits)
            for c in term.text:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.fuzzy.append(False)
                node = self.children[node][c]
                self.fuzzy[node] |= bool(term.edits)
            self.ends[node].append(t)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stem_hit: list[tuple[int, int] | None] = []
        self.word_hit: list[tuple[int, int] | None] = []
        self.dead = self._state(frozenset())
        self.start = self._state(self._closed({(0, 0)}))
        self.memo: dict[str, tuple[int, int] | None] = {}

    def _closed(self, nodes: set[tuple[int, int]]) -> frozenset:
        """With the nodes that skipping one letter of a term reaches; fewer edits win."""
        found = set(nodes)
        for node, edits in nodes:
            if not edits:
                found |= {(child, 1) for child in self.children[node].values() if self.fuzzy[child]}
        return frozenset((n, e) for n, e in found if not e or (n, 0) not in found)

    def _state(self, nodes: frozenset) -> int:
        if nodes not in self.states:
            self.states[nodes] = len(self.sets)
            self.sets.append(nodes)
            self.steps.append({})
            self.stem_hit.append(self._hit(nodes, False))
            self.word_hit.append(self._hit(nodes, True))
        return self.states[nodes]

    def _hit(self, nodes: frozenset, whole: bool) -> tuple[int, int] | None:
        """The best (term, edits) that ends in the state: fewest edits, then most weight."""
        found = [
            (edits, -self.terms[t].weight, t)
            for node, edits in nodes
            for t in self.ends[node]
            if self.terms[t].whole == whole and edits <= self.terms[t].edits
        ]
        return (min(found)[2], min(found)[0]) if found else None

    def _step(self, state: int, c: str) -> int:
        reached: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            if c in self.children[node]:
                reached.add((self.children[node][c], edits))
            if not edits and self.fuzzy[node]:
                reached.add((node, 1))  # an extra letter
                reached |= {(child, 1) for child in self.children[node].values() if self.fuzzy[child]}  # another letter
        self.steps[state][c] = found = self._state(self._closed(reached))
        return found

    def match(self, token: str) -> tuple[int, int] | None:
        """(term, edits) of the best term that the lower-case token is or starts with, or None."""
        if token in self.memo:
            return self.memo[token]
        best, state = self.stem_hit[self.start], self.start
        for c in token:
            after = self.steps[state].get(c)
            state = self._step(state, c) if after is None else after
            if state == self.dead:
                break
            best = self._better(best, self.stem_hit[state])
        best = self._better(best, self.word_hit[state])
        if best is not None and best[1] and token in self.spelled:
            best = None
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[token] = best
        return best

    def _better(self, a, b):
        if a is None or b is None:
            return a or b
        return min(a, b, key=lambda x: (x[1], -self.terms[x[0]].weight))


FEATURES = ("direct", "reported", "addressed", "misspelled", "hits", "rate", "kinds", "heaviest", "length", "slips", "slip_rate", "slip_kinds")


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The sums that the model weighs; a text without words has a length of 0 and no hits."""
    lower = (text or "").lower()
    tokens = TOKEN.findall(lower)
    n, match = len(tokens), lexicon.match
    found = {w for w in set(tokens) if match(w) is not None}
    hits = [0, 0]  # direct ones, as spelled and misspelled
    sums = [0.0, 0.0]
    reported = addressed = 0.0
    kinds: tuple[set[int], set[int]] = (set(), set())
    heaviest = 0.0
    if found:
        quotes = [m.span() for m in QUOTED.finditer(lower)]
        places = [m.start() for m in TOKEN.finditer(lower)] if quotes else []
        begins = [a for a, _ in quotes]
        for i, w in enumerate(tokens):
            if w not in found:
                continue
            term, edits = match(w)
            weight = lexicon.terms[term].weight
            near = tokens[max(0, i - WINDOW) : i + WINDOW + 1]
            k = bisect_right(begins, places[i]) - 1 if quotes else -1
            if (k >= 0 and places[i] < quotes[k][1]) or not REPORT.isdisjoint(near):
                reported += weight
                continue
            sums[edits] += weight
            hits[edits] += 1
            kinds[edits].add(term)
            if not edits:
                heaviest = max(heaviest, weight)
            if not ADDRESS.isdisjoint(near):
                addressed += weight
    expected = n * sum(t.toxic_rate - t.clean_rate for t in lexicon.terms)
    return [
        math.asinh(sums[0] - expected),
        math.asinh(reported),
        math.asinh(addressed),
        math.asinh(sums[1] - n * lexicon.slip_rate),
        math.log1p(hits[0]),
        100.0 * hits[0] / max(n, 20),
        float(min(len(kinds[0]), 5)),
        heaviest,
        math.log1p(n),
        math.log1p(hits[1]),
        100.0 * hits[1] / max(n, 20),
        float(min(len(kinds[1]), 5)),
    ]


def misspelled(text: str, lexicon: Lexicon) -> str:
    """The text with each word that matches a term as spelled changed by one letter, so that it still matches."""

    def slip(m: re.Match) -> str:
        word = m[0]
        hit = lexicon.match(word.lower())
        if hit is None or hit[1]:
            return word
        size = len(lexicon.terms[hit[0]].text)
        seed = zlib.crc32(word.lower().encode())
        for turn in range(3 * size):
            at, kind = 1 + (seed + turn) % max(size - 1, 1), (seed + turn) % 3
            other = "aeiouxz1"[(seed >> 8) % 8]
            changed = word[:at] + (word[at - 1] if kind == 0 else "" if kind == 1 else other) + word[at + (kind != 0) :]
            again = lexicon.match(changed.lower())
            if again is not None and again[1]:
                return changed
        return word

    return TOKEN.sub(slip, text)


@dataclass(frozen=True)
class Model:
    terms: tuple[Term, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    bias: float
    spelled: tuple[str, ...] = ()
    slip_rate: float = 0.0

    def lexicon(self) -> Lexicon:
        return Lexicon(self.terms, self.spelled, self.slip_rate)

    def score(self, values: list[float]) -> float:
        z = self.bias + sum(w * (v - m) / s for w, v, m, s in zip(self.weights, values, self.mean, self.scale, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Ridge logistic regression by Newton steps on standardised columns: mean, scale, weights, bias.

    ``counts`` says how much each row counts.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = np.hstack(((x - mean) / scale, np.ones((len(x), 1))))
    w = np.zeros(z.shape[1])
    counts = np.ones(len(x)) if counts is None else counts
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ ((p - y) * counts) + penalty * w
        hessian = (z * (p * (1 - p) * counts)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w[:-1], float(w[-1])


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_COUNTS = T.StructType([T.StructField("term", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("toxic_docs", "clean_docs", "toxic_hits", "clean_hits")]])


def term_counts(sample: DataFrame) -> DataFrame:
    """Texts and tokens by class of every stem (``ab``) and whole word (``ab$``); sums per text batch first."""

    def run(batches):
        import pyarrow as pa

        names = _COUNTS.names
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own: Counter[str] = Counter()
                for w, k in Counter(TOKEN.findall((text or "").lower())).items():
                    own[w + "$"] += k
                    for n in STEMS:
                        if len(w) > n:
                            own[w[:n]] += k
                for term, k in own.items():
                    row = counts.setdefault(term, [0, 0, 0, 0])
                    row[0 if toxic else 1] += 1
                    row[2 if toxic else 3] += k
            columns = [pa.array(list(counts), pa.string()), *[pa.array([r[i] for r in counts.values()], pa.int64()) for i in range(4)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return sample.select("text", "toxic").mapInArrow(run, _COUNTS).groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS.names[1:]])


def choose(rows: list) -> list:
    """The most telling term of each family of stems and words; order is kept.

    A stem goes if one longer term has most of its toxic texts and no lower odds ("los" for
    "loser"); a longer term goes if a stem that stays has about its odds ("loweihr" for "lowei").
    """
    by = {r["term"]: r for r in rows}
    family: dict[str, list] = {}
    for r in rows:
        text = r["term"].rstrip("$")
        for k in range(1, len(text) + (r["term"][-1] == "$")):
            if text[:k] in by:
                family.setdefault(text[:k], []).append(r)
    gone = {
        stem for stem, longer in family.items()
        if any(x["toxic_docs"] >= 0.8 * by[stem]["toxic_docs"] and x["odds"] >= by[stem]["odds"] - 0.2 for x in longer)
    }
    covered = {x["term"] for stem, longer in family.items() if stem not in gone for x in longer if x["odds"] <= by[stem]["odds"] + 0.7}
    return [r for r in rows if r["term"] not in gone and r["term"] not in covered]


def learn_terms(sample: DataFrame, z: float = 3.0, least: float = 0.3) -> list[Term]:
    """Terms whose log odds between classes are above ``least`` at ``z`` standard errors, and the fixed ones."""
    words = F.size(F.split("text", r"\s+"))
    row = sample.agg(
        F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"), F.sum(F.col("toxic") * words).alias("tp"), F.sum((1 - F.col("toxic")) * words).alias("tn")
    ).first()
    toxic, clean, toxic_words, clean_words = (int(v or 0) for v in row)
    terms = {t + "$": Term(t, True, *PRIOR_RATES) for t in FIXED_TERMS}
    if toxic and clean:
        a, b = F.col("toxic_docs") + 0.5, F.col("clean_docs") + 0.5
        odds = F.log(a / (toxic + 1.0)) - F.log(b / (clean + 1.0))
        sure = odds - z * F.sqrt(1 / a + 1 / b)
        # Clean hits are taken to be at least one, so that no term alone settles a text.
        rows = (
            term_counts(sample).where("toxic_docs >= 3").withColumn("odds", odds).withColumn("sure", sure)
            .where(F.col("sure") > least).orderBy(F.desc("sure"), F.desc(F.length("term")), "term").limit(16 * MAX_TERMS).collect()
        )
        chosen = [r for r in choose(rows) if r["sure"] is not None][:MAX_TERMS]
        for r in chosen:
            text, whole = r["term"].rstrip("$"), r["term"][-1] == "$"
            terms[r["term"]] = Term(text, whole, (r["toxic_hits"] + 0.5) / (toxic_words + 1.0), (r["clean_hits"] + 1.0) / (clean_words + 1.0))
    return sorted((t for t in terms.values() if t.weight > 0), key=lambda t: (t.text, t.whole))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> Model:
    """Learn lexicon and weights from at most about ``sample_rows`` labelled rows that are not held out.

    An id with several labels counts as toxic if one says so; null labels are left out. Without
    toxic or clean rows the model has the fixed terms and preset weights.
    """
    known = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    )
    total = known.count()
    share = min(1.0, sample_rows / max(total, 1))
    picked = known.where(F.pmod(F.xxhash64("l_id", F.lit(9)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    # At most about sample_rows small rows: safe to broadcast. Equal texts are toxic if one is.
    sample = materialise(
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))
        .groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled",
    )
    terms = learn_terms(sample)
    spelled, slip_rate = learn_spelling(sample, terms)
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("copy", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType()))])

    def make():
        lexicon = Lexicon(terms, spelled, slip_rate)

        def one(text, toxic):
            out = [(toxic, 0, features(text, lexicon))]
            if toxic and (other := misspelled(text, lexicon)) != text:
                out.append((toxic, 1, features(other, lexicon)))
            return out

        return one

    rows = map_rows(sample.select("text", "toxic"), make, schema).collect()
    # Sums do not hang on the order in which the rows come in.
    rows.sort(key=lambda r: (r["toxic"], r["copy"], r["values"]))
    x = np.array([r["values"] for r in rows], float).reshape(-1, len(FEATURES))
    y = np.array([r["toxic"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        preset = dict.fromkeys(FEATURES, 0.0) | {"direct": 1.0, "hits": 2.0, "rate": 1.0, "addressed": 0.5, "misspelled": 0.5, "slips": 1.0}
        return Model(tuple(terms), (0.0,) * len(FEATURES), (1.0,) * len(FEATURES), tuple(preset.values()), -4.0)
    mean, scale, weights, bias = fit_logistic(x, y, counts=np.array([SLIP_WEIGHT if r["copy"] else 1.0 for r in rows]))
    return Model(tuple(terms), tuple(mean.tolist()), tuple(scale.tolist()), tuple(weights.tolist()), bias, tuple(spelled), slip_rate)


def learn_spelling(sample: DataFrame, terms: list[Term]) -> tuple[list[str], float]:
    """Words of clean texts that are an edit away from a term, in at least two texts of the sample, and
    the weight of the other such matches per word of clean text. Both are bounded by the sample."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("weight", T.DoubleType())])

    def make():
        lexicon = Lexicon(terms)

        def one(text):
            tokens = Counter(TOKEN.findall(text.lower()))
            out = [("", sum(tokens.values()), 0.0)]
            for w, k in tokens.items():
                hit = lexicon.match(w)
                if hit is not None and hit[1]:
                    out.append((w, k, k * lexicon.terms[hit[0]].weight))
            return out

        return one

    counted = map_rows(sample.where("toxic = 0").select("text"), make, schema).groupBy("word").agg(F.count("*").alias("texts"), F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    rows = counted.orderBy("word").collect()
    words = sum(r["n"] for r in rows if not r["word"])
    spelled = [r["word"] for r in rows if r["word"] and r["texts"] > 1]
    return spelled, sum(r["weight"] for r in rows if r["word"] and r["texts"] < 2) / max(words, 1)


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every whole text: one row per row of ``docs`` (doc_id, text), no shuffle.

    A null or empty text has no hits and the low score that goes with it. Repeated rows give
    repeated results; other columns are ignored. The score sees the text alone.
    """

    def make():
        lexicon = model.lexicon()
        return lambda doc_id, out, text: [(doc_id, out, model.score(features(text, lexicon)))]

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")), make, SCORES)


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores under ``threshold``. No shuffle."""
    at = place_of(docs, "text")

    def make():
        import pyarrow as pa

        lexicon = model.lexicon()

        def clean(batch):
            return batch.filter(pa.array([model.score(features(t, lexicon)) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

        return clean

    return map_batches(docs, make, docs.schema)


def op9(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Toxicity of every row of ``docs``, by a model of those labelled rows that are not held out.

    Null and empty texts have no hits and a low score. Null labels and ids are left out; of several
    labels of an id or of one text, toxic wins. Repeated rows give repeated results, no rows none; no
    labels give preset weights. Other columns are ignored, whatever their names.
    """
    return score(docs, learn(docs, labels)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
