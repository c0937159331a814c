"""Toxicity by a weighted finite-state pattern grammar.

Words become class symbols. Transducers for target, negation and reported speech are composed into a machine that runs over each clause and rewrites insults and threats into what they are there (at someone, negated, reported); transducers for targets and reports that follow, and for weights, are composed into a second one that reads the first one's output from its end. Weights add up: what a word is, and what its contexts change, each with its sign held: a target never makes milder, negation and report never worse. A clause scores what the machine gives its kinds of match, each kind once, so a clause is bounded however often it repeats itself; a text scores the sum of its clauses, against its length.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import map_batches, materialize

#: DOUBTFUL words insult most of the time, INSULT words nearly always.
NONE, INSULT, THREAT, DOUBTFUL, TARGET, NEGATION, REPORT = range(7)
#: A match is (kind, at a target, negated, reported).
KINDS = (INSULT, THREAT, DOUBTFUL)
MATCHES = [(k, t, n, r) for k, t, n, r in product(KINDS, (0, 1), (0, 1), (0, 1))]
#: Labelled rows that weights and lexicon are fitted to, at most; those of the least hash of their id.
MOST_TRAINED = 20_000
#: Of the stems that are learned, this share may be there by chance (false-discovery rate).
FALSE_STEMS = 0.05
#: Least share of toxic documents among those with a stem: of a DOUBTFUL one, and of an INSULT.
SHARES = (0.8, 0.98)

# Closed word classes of the four languages.
WORDS = {
    TARGET: "you your yours u he she they him her them du dich dir dein deine ihr euch er sie tu te toi ton ta vous votre il elle ils elles tú te ti usted ustedes él ella ellos ellas",
    NEGATION: "not never no n't isn't aren't don't nicht kein keine nie pas jamais ne aucun nunca jamás ningún",
    REPORT: "said says say reported claims wrote quoted sagte sagt meldete schrieb dit écrit déclaré dijo dice escribió según selon laut",
    INSULT: "idiot moron stupid scum trash worthless pathetic loser disgusting dumb fool imbecile",
    THREAT: "kill hurt destroy murder beat stab shoot töten umbringen tuer frapper matar golpear",
}


#: What weights are the sum of: the kind of word, being at a target, a threat at a target, negated, reported.
PARTS = ["insult", "threat", "doubtful", "target", "threat at target", "negated", "reported"]
#: Parts of each match, in the order of MATCHES.
DESIGN = np.array([[k == INSULT, k == THREAT, k == DOUBTFUL, t, t * (k == THREAT), n, r] for k, t, n, r in MATCHES], float)
#: Weights before any label is seen, and the least and the greatest they may be.
PRIOR = np.array([3.0, 1.0, 1.5, 0.5, 2.5, -3.0, -1.5])
LEAST = np.array([0.0, 0.0, 0.0, 0.25, 0.25, -np.inf, -np.inf])
GREATEST = np.array([np.inf, np.inf, np.inf, np.inf, np.inf, -0.25, -0.25])
#: Clauses whose reading is known (match, toxic): labels tell too little of contexts. Each counts as KNOWN_SHARE of the training rows, KNOWN_LEAST at least.
KNOWN = [((INSULT, 1, 0, 0), 1), ((INSULT, 1, 1, 0), 0), ((INSULT, 0, 1, 0), 0), ((THREAT, 1, 0, 0), 1), ((THREAT, 0, 0, 0), 0), ((THREAT, 1, 1, 0), 0), ((THREAT, 1, 0, 1), 0)]
KNOWN_SHARE, KNOWN_LEAST = 0.01, 10


@dataclass
class Transducer:
    """Deterministic, letter to letter: step[state][symbol] is (state after, symbol out, weight); a symbol without an arc passes and leads to rest[state]."""

    step: dict[object, dict[object, tuple[object, object, float]]]
    rest: dict[object, object]
    start: object = 0

    def arc(self, state: object, symbol: object) -> tuple[object, object, float]:
        return self.step.get(state, {}).get(symbol) or (self.rest[state], symbol, 0.0)

    def then(self, other: Transducer, alphabet: set) -> Transducer:
        """Composition: other reads what this one writes. Only the states that can be reached are built."""
        begin = (self.start, other.start)
        step, rest, todo = {}, {}, [begin]
        while todo:
            p, q = state = todo.pop()
            if state in step:
                continue
            step[state] = {}
            for symbol in alphabet:
                p2, between, w1 = self.arc(p, symbol)
                q2, out, w2 = other.arc(q, between)
                step[state][symbol] = ((p2, q2), out, w1 + w2)
                todo.append((p2, q2))
            rest[state] = step[state][NONE][0]
        return Transducer(step, rest, begin)


def lexer() -> Transducer:
    """Insult and threat words become plain matches."""
    return Transducer({0: {k: (0, (k, 0, 0, 0), 0.0) for k in KINDS}}, {0: 0})


def context(trigger: int, place: int, reach: int | None) -> Transducer:
    """Marks a match at the given place if the trigger stands at most reach words before it (None: anywhere before it in the clause)."""
    far = 1 if reach is None else reach
    step, rest = {}, {}
    for state in range(far + 1):
        after = state if reach is None else max(0, state - 1)
        step[state] = {trigger: (far, trigger, 0.0)}
        if state:
            step[state] |= {m: (after, (*m[:place], 1, *m[place + 1 :]), 0.0) for m in MATCHES}
        rest[state] = after
    return Transducer(step, rest)


def weigher(weights: dict) -> Transducer:
    return Transducer({0: {m: (0, m, w) for m, w in weights.items()}}, {0: 0})


@dataclass
class Grammar:
    """forward reads a clause's symbols from its start, backward reads what forward wrote from the clause's end: together they see what stands on either side of a match."""

    forward: Transducer
    backward: Transducer


def grammar(weights: dict) -> Grammar:
    """Forward: lexer, target (four words before), negation (three words before), reported speech (before, in the clause). Backward: target (four words after), reported speech (after, in the clause), weights."""
    forward, backward = lexer(), context(TARGET, 1, 4)
    for part in (context(TARGET, 1, 4), context(NEGATION, 2, 3), context(REPORT, 3, None)):
        forward = forward.then(part, set(range(7)))
    for part in (context(REPORT, 3, None), weigher(weights)):
        backward = backward.then(part, {*range(7), *MATCHES})
    return Grammar(forward, backward)


def weights_of(parts: np.ndarray) -> dict:
    """The weight of each match: the sum of its parts."""
    return dict(zip(MATCHES, map(float, DESIGN @ parts), strict=True))


def prior() -> dict:
    """Weights before any label is seen."""
    return weights_of(PRIOR)


def stems_of(word: str) -> list[str]:
    """Its beginnings of four to eight letters, and the whole word, marked by its end."""
    return [word[:n] for n in range(4, min(8, len(word)) + 1)] + [word + "$"]


class Classifier:
    """Word (bytes) -> (symbol, does a clause end after it), remembered for words seen."""

    def __init__(self, stems: dict[str, int]):
        self.fixed = {w: k for k, words in WORDS.items() for w in words.split()}
        self.stems, self.memo, self.answers = stems, {}, {}

    def __call__(self, word: bytes) -> tuple[int, bool]:
        found = self.memo.get(word)
        if found is None:
            text = word.decode("utf-8", "replace").lower()
            bare = text.strip("".join(c for c in text if not c.isalpha()) or " ")
            kind = self.fixed.get(bare, NONE)
            if kind == NONE and bare:
                kind = min((self.stems[s] for s in stems_of(bare) if s in self.stems), default=NONE)
            if kind == NONE and text[:1] in '"“«„':
                kind = REPORT
            found = (kind, text[-1:] in ".!?;:")
            if len(self.memo) > 500_000:
                self.memo.clear()
            # the few answers there are, each kept once
            self.memo[word] = found = self.answers.setdefault(found, found)
        return found


def clauses(machine: Grammar, classify: Classifier, text: str | None) -> Iterator[tuple[list, float]]:
    """The matches of each clause that has one, and its score: the machine's weights of its kinds of match, each kind once. Clauses end at . ! ? ; : after a word, and with the text."""
    words = (text or "").encode().split()
    tags = list(map(classify, words))
    if not any(k in KINDS for k, _ in set(tags)):
        return
    forward, state, read, any_ = machine.forward, machine.forward.start, [], False
    for i, (kind, ends) in enumerate(tags):
        state, out, _ = forward.step[state][kind]
        read.append(out)
        any_ = any_ or kind in KINDS
        if ends or i == len(tags) - 1:
            if any_:
                yield from_end(machine.backward, read)
            state, read, any_ = forward.start, [], False


def from_end(machine: Transducer, read: list) -> tuple[list, float]:
    """What the machine makes of a clause read from its end: the matches in the clause's order, and the weights of their kinds."""
    state, found, score = machine.start, [], 0.0
    for symbol in reversed(read):
        state, out, weight = machine.step[state][symbol]
        if type(out) is tuple:
            score += 0.0 if out in found else weight
            found.append(out)
    return found[::-1], score


def length(text: str | None) -> int:
    """Tenths of the logarithm of the number of words: chance matches grow with a text."""
    return round(10 * math.log1p(len((text or "").encode().split())))


def counts(machine: Grammar, classify: Classifier, text: str | None) -> list[int]:
    """Clauses with each kind of match."""
    n: dict = defaultdict(int)
    for found, _ in clauses(machine, classify, text):
        for m in set(found):
            n[m] += 1
    return [n[m] for m in MATCHES]


@dataclass
class Model:
    stems: dict[str, int]
    weights: dict
    bias: float
    a_length: float = 0.0


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED) -> DataFrame:
    """text and toxic of at most `most` labelled documents with crc32(doc_id as text) mod 5 not 0. A document labelled more than once is toxic if any label says so."""
    open_ = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    sample = open_.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def learn_stems(rows: DataFrame) -> dict[str, int]:
    """Stems that mark toxic documents: counted by document, kept where the share of toxic documents is that of DOUBTFUL or INSULT words and the evidence against chance is high enough.

    exp(-evidence) bounds the chance of such a count from above; the least evidence is taken under which at most FALSE_STEMS of the stems kept would be there by chance (Benjamini and Hochberg's rule, in steps of a nat). All stems are tested, none is cut off by a number; how many there can be is bounded by the training rows.
    """
    schema = T.StructType([T.StructField("stem", T.StringType()), T.StructField("bad", T.LongType()), T.StructField("good", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array([v[1] for v in n.values()], pa.int64()), pa.array([v[0] for v in n.values()], pa.int64())], names=schema.names)
            n.clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = {w.strip(".,;:!?\"'()|#*$%&<>") for w in (text or "").lower().split()}
                for stem in {s for w in words if w.isalpha() for s in stems_of(w)}:
                    n.setdefault(stem, [0, 0])[toxic] += 1
                if len(n) > 200_000:
                    yield flush()
        yield flush()

    totals = rows.agg(F.sum("toxic"), F.count("toxic")).first()
    bad, all_ = totals[0] or 0, totals[1]
    if not 0 < bad < all_:
        return {}
    base = bad / all_
    n = F.col("bad") + F.col("good")
    share = F.col("bad") / n
    less = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    evidence = n * (share * F.log(share / base) + less)
    counted = rows.mapInArrow(count, schema).groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    tested = materialize(counted.select("stem", "bad", F.when((F.col("bad") >= 3) & (share >= SHARES[0]), evidence).otherwise(0.0).alias("evidence"), F.when(share >= SHARES[1], INSULT).otherwise(DOUBTFUL).alias("kind")), "stems")
    steps = sorted(((r["nats"], r["n"]) for r in tested.groupBy(F.floor("evidence").alias("nats")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    all_stems, kept, least = sum(n for _, n in steps), 0, None
    for nats, n in steps:
        kept += n
        if nats > 0 and all_stems * math.exp(-nats) <= FALSE_STEMS * kept:
            least = nats
    rows_ = tested.where(F.col("evidence") >= least).orderBy("stem").collect() if least else []
    bad_of = {r["stem"]: r["bad"] for r in rows_}
    # a beginning that has hardly more toxic documents than a longer one of its own only adds chance matches
    vague = {stem[:n] for stem in bad_of for n in range(4, len(stem)) if 10 * bad_of[stem] >= 9 * bad_of.get(stem[:n], math.inf)}
    return {r["stem"]: r["kind"] for r in rows_ if r["stem"] not in vague}


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED) -> Model:
    """Stems and weights from the training rows: logistic regression on the parts of the matches of each clause (PARTS) and on the length, within the parts' bounds, with KNOWN clauses beside the rows, drawn toward the prior. Without rows: the prior."""
    rows = training_rows(docs, labels, most)
    stems = learn_stems(rows)
    machine = grammar(prior())
    fields = [("counts", T.ArrayType(T.IntegerType())), ("size", T.IntegerType())]
    counted = map_batches(rows, lambda classify, text: (counts(machine, classify, text), length(text)), ["text"], fields, setup=lambda: Classifier(stems)).groupBy("toxic", "counts", "size").count().collect()
    begin = np.array([*PRIOR, 0.0, -3.0])
    least, most_ = np.array([*LEAST, -np.inf, -np.inf]), np.array([*GREATEST, np.inf, np.inf])
    w = begin.copy()
    if counted:
        n_rows = sum(r["count"] for r in counted)
        once = np.eye(len(MATCHES))
        given = [([*(np.array(r["counts"]) @ DESIGN), r["size"] / 10, 1], r["toxic"], r["count"]) for r in counted]
        given += [([*(once[MATCHES.index(m)] @ DESIGN), math.log1p(4), 1], toxic, max(KNOWN_LEAST, KNOWN_SHARE * n_rows)) for m, toxic in KNOWN]
        x, y, times = (np.array(c, float) for c in zip(*given, strict=True))
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (times * (p - y)) + (w - begin)
            # weights at a bound that the gradient pushes further out stay there
            free = ~(((w <= least) & (gradient > 0)) | ((w >= most_) & (gradient < 0)))
            bend = (x * (times * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(w))
            step = np.zeros(len(w))
            step[free] = np.linalg.solve(bend[np.ix_(free, free)], gradient[free])
            new = np.clip(w - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12)), least, most_)
            moved, w = np.abs(new - w).max(), new
            if moved < 1e-8:
                break
    return Model(stems, weights_of(w[: len(PARTS)]), float(w[-1]), float(w[-2]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds score (double, 0 to 1), predicted (int, 1 from 0.5) and clauses (int, those with a match) from the whole text alone.

    Null and empty texts, and texts without a match, get the score of the bias and their length. Repeated rows score alike. An empty table gives no rows. Very long texts are read whole, word by word. Columns of these names are replaced, all others stay.
    """
    machine = grammar(model.weights)

    def one(classify: Classifier, text: str | None) -> tuple[float, int, int]:
        found = list(clauses(machine, classify, text))
        total = model.bias + model.a_length * length(text) / 10 + sum(of_clause for _, of_clause in found)
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
        return p, int(p >= 0.5), len(found)

    return map_batches(docs, one, ["text"], [("score", T.DoubleType()), ("predicted", T.IntegerType()), ("clauses", T.IntegerType())], setup=lambda: Classifier(model.stems))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
