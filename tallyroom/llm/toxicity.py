"""Toxicity by a weighted finite-state grammar of clauses.

A lexical transducer reads words as insults, threats, targets, negations and
reporting words.  Insults are learned: a word, or a stem that several words
share, is one if clauses of documents labelled toxic hold it far more often
than others do; its weight is its smoothed log odds.  The other classes are
short lists of English, German, French and Spanish words.  Three more
transducers, composed into one, walk through a clause: negation and reported
speech lessen what follows, a target near an insult raises it, and a threat
counts only with a target.  What the matches of a clause weigh is its score; a
document's evidence is the sum of its clauses' scores, and a logistic curve
fitted to the labels turns evidence and its density into a score from 0 to 1.

Fitting uses at most ``MAX_DOCUMENTS`` different texts of each label, the ones
with the smallest hashes; each different clause counts once, so copies do not
weigh.  The curve is fitted to evidence found with insults learned from the
other half of the texts.

Defined results: a null, empty or wordless text has no evidence and gets the
curve's lowest score, which is below 0.5 unless most labels are toxic; without
labels the curve is a fixed one.  A null ``doc_id`` is in no fold: it is neither
learned from nor held out.  Labels other than 0 and 1 are ignored; a document with both is
learned as both.  Texts are read whole, however long.  Repeated rows each get a
row; repeated labels count once.  Equal weights need no rule, as all matches
count.  Extra columns are ignored, whatever their names; empty tables give an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, WordTable, column_slices, fold_of, per_list, settle

FOLDS, HELD_OUT = 5, 0
MAX_DOCUMENTS = 10_000
#: Stems have so many letters, and so many words of toxic clauses share one.
STEM_LETTERS, STEM_WORDS = (3, 8), 4
#: An insult is in so many toxic clauses, is toxic in this share of its clauses, and has a log-likelihood ratio of at least this.
LEAST_CLAUSES, LEAST_SHARE, LEAST_RATIO = 3, 0.6, 15.0
SMOOTHING = 0.5

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = ".", "insult", "threat", "target", "negation", "report", "end"
AIMED_INSULT, AIMED_THREAT, AIM = "aimed insult", "aimed threat", "aim"
CLASSES = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END)

WORDS = {
    TARGET: "you your yourself they them those these people du dich dir dein deine ihr euch tu te toi ton ta vous votre eux ti usted ustedes vosotros ellos ellas",
    NEGATION: "not no never nobody without hardly isn aren wasn weren don doesn didn nicht kein keine nie niemals ohne ne pas jamais sans aucun nunca sin ninguno",
    REPORT: "said says say saying wrote writes called quoted according reported claimed sagte sagt schrieb nannte laut dit disait selon dijo dice según",
    THREAT: "kill hurt beat stab shoot destroy strangle smash töten umbringen schlagen verprügeln tuer frapper matar golpear disparar",
}

#: What a match weighs; an insult's own weight takes the place of 1.
VALUES = {INSULT: 1.0, AIMED_INSULT: 1.5, AIM: 1.0, AIMED_THREAT: 3.0}
NEGATED, REPORTED = 0.25, 0.5
NEGATION_REACH, TARGET_REACH, THREAT_REACH = 3, 4, 3

#: The curve's slopes (evidence, density) and intercept that the labels have to argue against.
PRIOR_SLOPES, PRIOR_INTERCEPT, PRIOR_WEIGHT = (1.0, 0.5), -3.0, 1.0


class Transducer:
    """Reads a symbol, writes a symbol, with a factor: ``arcs[state, symbol] = (next state, symbol written, factor)``; it starts in state 0."""

    def __init__(self, arcs: dict[tuple[int, str], tuple[int, str, float]]):
        self.arcs = arcs

    @classmethod
    def of_rule(cls, states: range, rule) -> Transducer:
        return cls({(state, symbol): rule(state, symbol) for state in states for symbol in CLASSES})

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes."""
        numbers, arcs, waiting = {(0, 0): 0}, {}, [(0, 0)]
        while waiting:
            pair = waiting.pop()
            for symbol in CLASSES:
                first, written, factor = self.arcs[pair[0], symbol]
                second, out, more = other.arcs[pair[1], written]
                if (first, second) not in numbers:
                    numbers[first, second] = len(numbers)
                    waiting.append((first, second))
                arcs[numbers[pair], symbol] = (numbers[first, second], out, factor * more)
        return Transducer(arcs)


def _negation(state: int, symbol: str) -> tuple[int, str, float]:
    """The state is how many more words a negation reaches."""
    if symbol == NEGATION:
        return NEGATION_REACH, OTHER, 1.0
    lessened = NEGATED if state and symbol in (INSULT, THREAT) else 1.0
    return max(0, state - 1), symbol, lessened


def _report(state: int, symbol: str) -> tuple[int, str, float]:
    """State 1: what is said here is another's."""
    if symbol == REPORT:
        return 1, OTHER, 1.0
    return state, symbol, REPORTED if state and symbol in (INSULT, THREAT) else 1.0


def _aim(state: int, symbol: str) -> tuple[int, str, float]:
    """States 1 to 4: words since a target; 5 to 7 and 8 to 10: an insult or a threat waits for one; 0: nothing is open."""
    waits_insult, waits_threat = TARGET_REACH + 1, TARGET_REACH + 1 + THREAT_REACH
    if symbol == TARGET:
        written = OTHER if state < waits_insult else AIM if state < waits_threat else AIMED_THREAT
        return 1, written, 1.0
    aimed = 1 <= state <= TARGET_REACH
    if symbol == INSULT:
        return (state if aimed else waits_insult), AIMED_INSULT if aimed else INSULT, 1.0
    if symbol == THREAT:
        return (state, AIMED_THREAT, 1.0) if aimed else (waits_threat, OTHER, 1.0)
    last = state in (0, TARGET_REACH, waits_threat - 1, waits_threat + THREAT_REACH - 1)
    return 0 if last else state + 1, OTHER, 1.0


def grammar() -> Transducer:
    """Negation, then reported speech, then targets, as one transducer."""
    negation = Transducer.of_rule(range(NEGATION_REACH + 1), _negation)
    report = Transducer.of_rule(range(2), _report)
    return negation.then(report).then(Transducer.of_rule(range(TARGET_REACH + 2 * THREAT_REACH + 1), _aim))


def tokens_of(text: str | None) -> list[str]:
    """Words of a text in lower case, and the marks that end clauses."""
    return regex.findall(r"\p{L}+|[.!?;\n]", (text or "").lower())


class Toxicity:
    """Learned insults, by word and by stem, and the curve."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], curve: tuple[float, ...] = (PRIOR_INTERCEPT, *PRIOR_SLOPES)):
        self.words, self.stems, self.curve = words, stems, curve

    @cached_property
    def classes(self) -> dict[str, str]:
        return {word: kind for kind, words in WORDS.items() for word in words.split()} | {mark: END for mark in ".!?;\n"}

    @cached_property
    def table(self) -> list[list[tuple[int, float, float]]]:
        """By state and class: next state, what is added, and by how much the insult's own weight is multiplied."""
        arcs = grammar().arcs
        rows = [[(0, 0.0, 0.0)] * len(CLASSES) for _ in {state for state, _ in arcs}]
        for (state, kind), (after, out, factor) in arcs.items():
            value, own = VALUES.get(out, 0.0) * factor, out in (INSULT, AIMED_INSULT)
            rows[state][CLASSES.index(kind)] = (after, 0.0 if own else value, value if own else 0.0)
        return rows

    def insult(self, word: str) -> float:
        """The largest weight of a word or its stems; 0 if it is no insult."""
        low, high = STEM_LETTERS
        return max([self.words.get(word, 0.0), *(self.stems.get(word[:k], 0.0) for k in range(low, min(high, len(word)) + 1))])

    def read(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The lexical transducer: each word's class and weight, one after the other."""
        weights = [self.insult(w) for w in words]
        kinds = [INSULT if x else self.classes.get(w, OTHER) for w, x in zip(words, weights, strict=True)]
        flat = np.array([[CLASSES.index(k), x] for k, x in zip(kinds, weights, strict=True)], np.float32)
        return flat.ravel(), np.full(len(words), 2)

    @cached_property
    def seen(self) -> WordTable:
        """The classes of words met so far; it lives as long as the worker keeps the model."""
        return WordTable(self.read, dtype=np.float32)

    def clause(self, kinds: list[int], weights: list[float]) -> float:
        """What the matches of one clause weigh."""
        state, score = 0, 0.0
        for kind, weight in zip(kinds, weights, strict=True):
            state, fixed, own = self.table[state][kind]
            score += fixed + own * weight
        return score

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of its clauses' scores, and its number of words."""
        tokens = [tokens_of(t) for t in texts]
        lengths = np.array([len(t) for t in tokens], np.int64)
        total = np.zeros(len(texts))
        if not lengths.sum():
            return total, lengths
        index = self.seen.index(list(chain.from_iterable(tokens)))
        read = self.seen.flat.reshape(-1, 2)[index]
        kinds, weights = read[:, 0].astype(np.int8), read[:, 1]
        ends = kinds == CLASSES.index(END)
        text_of = np.repeat(np.arange(len(texts)), lengths)
        begins = np.flatnonzero(np.concatenate([[True], ends[:-1] | (text_of[1:] != text_of[:-1])]))
        hits = np.flatnonzero((kinds == CLASSES.index(INSULT)) | (kinds == CLASSES.index(THREAT)))
        stops = np.append(begins[1:], len(kinds))
        for clause in np.unique(np.searchsorted(begins, hits, side="right") - 1).tolist():
            part = slice(begins[clause], stops[clause])
            total[text_of[begins[clause]]] += self.clause(kinds[part].tolist(), weights[part].tolist())
        return total, lengths - per_list(ends.astype(np.int64), lengths)

    def scores(self, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(evidence, words) @ np.array(self.curve), -30, 30)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        return self.scores(*self.evidence(texts))


def features(evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    """1, the evidence and its density, both dampened."""
    return np.stack([np.ones(len(evidence)), np.log1p(evidence), np.log1p(100 * evidence / (words + 20))], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression by Newton's steps, held to the prior by a few rows' worth; slopes are not negative."""
    prior = np.array([PRIOR_INTERCEPT, *PRIOR_SLOPES])
    beta, hold = prior.copy(), np.diag([0.01, PRIOR_WEIGHT, PRIOR_WEIGHT])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - hold @ (beta - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, gradient)
        beta = beta + step
        beta[1:] = np.maximum(beta[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(beta.tolist())


def sample(docs: DataFrame, labels: DataFrame, most: int = MAX_DOCUMENTS) -> DataFrame:
    """``text``, ``toxic`` and ``half`` (0 or 1) of at most ``most`` different texts of each label, stored."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    learnable = keyed.filter(F.col("text").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    pairs = learnable.select("doc_id", "text_hash").join(marked, "doc_id").groupBy("text_hash", "toxic").agg(F.min("doc_id").alias("doc_id"))
    pairs = settle(pairs)
    of_label = lambda toxic: pairs.filter(F.col("toxic") == toxic).orderBy("text_hash").limit(most)
    chosen = F.broadcast(of_label(0).union(of_label(1)))
    texts = learnable.join(chosen, ["doc_id", "text_hash"]).groupBy("text_hash", "toxic").agg(F.min("text").alias("text"))
    return settle(texts.select("text", "toxic", F.pmod("text_hash", F.lit(2)).cast("int").alias("half")))


def _weight(pos: Column, neg: Column, all_pos: Column, all_neg: Column) -> Column:
    """The weight of something that ``pos`` toxic and ``neg`` other clauses hold; null if it is no insult."""
    rate = all_pos / (all_pos + all_neg)
    part = lambda x, p: F.when(x > 0, x * F.log(x / ((pos + neg) * p))).otherwise(0.0)
    ratio = 2 * (part(pos, rate) + part(neg, 1 - rate))
    weight = F.log((pos + SMOOTHING) / (neg + SMOOTHING)) - F.log((all_pos + SMOOTHING) / (all_neg + SMOOTHING))
    good = (pos >= LEAST_CLAUSES) & (pos >= LEAST_SHARE * (pos + neg)) & (ratio >= LEAST_RATIO) & (weight > 0)
    return F.when(good, weight)


def _lexicons(texts: DataFrame) -> list[Toxicity]:
    """Insults learned from half 0, from half 1 and from both."""
    clauses = texts.select("toxic", "half", F.explode(F.split(F.lower("text"), r"[.!?;\n]")).alias("clause")).filter(F.length("clause") > 0)
    clauses = clauses.groupBy("toxic", F.xxhash64("clause").alias("hash")).agg(F.min("half").alias("half"), F.min("clause").alias("clause"))
    word = F.explode(F.array_distinct(F.regexp_extract_all("clause", F.lit(r"\p{L}+"), F.lit(0))))
    count = lambda half, toxic: F.count_if((F.col("half") == half) & (F.col("toxic") == toxic))
    counts = [count(half, toxic).alias(f"{name}{half}") for half in (0, 1) for toxic, name in ((1, "p"), (0, "n"))]
    names = ["p0", "n0", "p1", "n1"]
    clauses = settle(clauses.select("toxic", "half", "clause"))
    totals = clauses.agg(*counts).first()
    words = settle(clauses.select("toxic", "half", word.alias("unit")).groupBy("unit").agg(*counts))
    lengths = F.sequence(F.lit(STEM_LETTERS[0]), F.least(F.lit(STEM_LETTERS[1]), F.length("unit")))
    prefixes = F.when(F.length("unit") >= STEM_LETTERS[0], F.transform(lengths, lambda k: F.substring("unit", F.lit(1), k)))
    stems = (
        words.select(F.explode(prefixes).alias("stem"), *names)
        .groupBy("stem")
        .agg(*(F.sum(n).alias(n) for n in names), F.count_if(F.col("p0") + F.col("p1") > 0).alias("words"))
        .filter(F.col("words") >= STEM_WORDS)
        .withColumnRenamed("stem", "unit")
    )
    found = []
    for halves in ((0,), (1,), (0, 1)):
        pos, neg = (sum(F.col(f"{n}{h}") for h in halves).cast("double") for n in "pn")
        all_pos, all_neg = (F.lit(float(sum(totals[f"{n}{h}"] for h in halves))) for n in "pn")
        weight = _weight(pos, neg, all_pos, all_neg)
        learned = [u.select("unit", weight.alias("weight")).filter("weight is not null").toArrow().to_pylist() for u in (words, stems)]
        found.append(Toxicity(*({r["unit"]: r["weight"] for r in rows} for rows in learned)))
    return found


def _evidence(shares: list[Shared]):
    """Evidence of a text found with the insults of the other half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, half = (batch.column(n).to_numpy() for n in ("toxic", "half"))
            first = 0
            for texts in column_slices(batch.column("text")):
                part = slice(first, first + len(texts))
                first += len(texts)
                found = [shared.value.evidence(texts) for shared in shares]
                evidence, words = (np.where(half[part] == 0, found[1][k], found[0][k]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(toxic[part]), pa.array(evidence), pa.array(words)], ["toxic", "evidence", "words"])

    return run


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_DOCUMENTS) -> Toxicity:
    """A model from ``docs`` (``doc_id``, ``text``) outside the held-out fold and ``labels`` (``doc_id``, ``toxic``)."""
    texts = sample(docs, labels, most)
    *halves, model = _lexicons(texts)
    measured = texts.mapInArrow(_evidence([Shared(docs.sparkSession, h) for h in halves]), "toxic int, evidence double, words long").toArrow()
    toxic, evidence, words = (measured.column(n).to_numpy() for n in ("toxic", "evidence", "words"))
    if len(toxic):
        model.curve = fit_curve(features(evidence, words), toxic)
    return model


def scorer(spark, model: Toxicity):
    """A column function: a whole text to its score from 0 to 1."""
    shared = Shared(spark, model)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array(np.concatenate([np.zeros(0), *(shared.value.score(texts) for texts in column_slices(column))]))

    return score


def toxicity(docs: DataFrame, model: Toxicity) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    scored = docs.select("doc_id", scorer(docs.sparkSession, model)("text").alias("score"))
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
