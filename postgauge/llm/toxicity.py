"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, or other. A first
transducer reads a clause from its end and rewrites threats that a target follows into aimed
ones. Six more read what it wrote from the beginning, pass symbols on unchanged and put weights
on insults and threats: after a negation a match weighs less, after a verb of reporting too,
near a target it weighs more, a threat counts little without a target. They are composed into
one machine: its states are tuples of theirs, its arc weights the products. A match scores what
it weighs on the machine's path, and nothing else of a text scores.

Insults and threats are learned: distinct words and word beginnings of all labelled documents
are counted by label over Spark, and those that lean to toxic documents beyond chance are kept
with their log odds; those that targets follow more than precede, in toxic documents, are
threats. A few known threats and insults have prior weights, which labels correct. The document
score is a logistic function, with weights not below zero, of four sums of path weights, fitted
on labelled documents that the lexicon has not seen. Language, source and id are no inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postgauge.llm.tables import map_beside, materialise, small, small_batches

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, AIMED = range(7)
MATCHES = (INSULT, THREAT, AIMED)

# Function words of English, German, French and Spanish.
TARGETS = frozenset("you your u he she they them his her their du dich dir ihr euch er sie tu te toi vous il elle ils tú ti usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never isn't aren't don't won't nicht kein keine nie ne pas jamais non no nunca jamás".split())
REPORTS = frozenset("said says say wrote called calls quoted claimed sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt beat destroy punch burn hunt töten schlagen tuer frapper matar golpear".split())
INSULTS = frozenset("idiot idiots moron morons stupid dumb worthless pathetic scum loser trottel dumm wertlos abschaum crétin débile imbécile idiota estúpido imbécil inútil".split())
PRIOR_WORDS, PRIOR = THREATS | INSULTS, 2.0  # log odds of a threat or an insult that no label shows

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[^.!?;:,\n]+")
STEMS = range(4, 8)  # lengths of word beginnings
AIM = 3  # words after a threat in which a target makes it an aimed one
FEATURES = 4


class Transducer:
    """Identity on symbols with log weights: step(state, symbol) gives (state, log weight)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def compose(self, other: Transducer) -> Transducer:
        def step(state, symbol):
            a, x = self.step(state[0], symbol)
            b, y = other.step(state[1], symbol)
            return (a, b), x + y

        return Transducer((self.start, other.start), step)


def after(trigger: int, reach: int, factor: float, symbols=MATCHES) -> Transducer:
    """Weighs `symbols` by `factor` if they come at most `reach` words after a trigger."""

    def step(left, symbol):
        if symbol == trigger:
            return reach, 0.0
        return max(0, left - 1), math.log(factor) if left and symbol in symbols else 0.0

    return Transducer(0, step)


def unless_after(trigger: int, reach: int, factor: float, symbol_: int) -> Transducer:
    """Weighs a symbol by `factor` unless a trigger came at most `reach` words before."""

    def step(left, symbol):
        if symbol == trigger:
            return reach, 0.0
        return max(0, left - 1), math.log(factor) if symbol == symbol_ and not left else 0.0

    return Transducer(0, step)


def aimed(left: int, symbol: int) -> tuple[int, int]:
    """The transducer that reads from the end: a state and a symbol give a state and a symbol."""
    if symbol == TARGET:
        return AIM, symbol
    return max(0, left - 1), AIMED if symbol == THREAT and left else symbol


def grammar(negated: float = 0.3, reported: float = 0.5, targeted: float = 1.5, idle_threat: float = 0.2, late_target: float = 0.8) -> Transducer:
    parts = [
        after(NEGATION, 3, negated),
        after(REPORT, 12, reported),
        after(TARGET, 4, targeted, (INSULT,)),
        unless_after(TARGET, 4, idle_threat, THREAT),
        unless_after(TARGET, 4, late_target, AIMED),
        after(INSULT, 3, 1.2, (INSULT,)),  # insults in a row
    ]
    machine = parts[0]
    for part in parts[1:]:
        machine = machine.compose(part)
    return machine


class Machine:
    """A transducer made into numbered states and an arc table, as far as it is used."""

    def __init__(self, transducer: Transducer):
        self.step, self.numbers, self.states, self.arcs = transducer.step, {transducer.start: 0}, [transducer.start], {}

    def arc(self, state: int, symbol: int) -> tuple[int, float]:
        found = self.arcs.get((state, symbol))
        if found is None:
            then, weight = self.step(self.states[state], symbol)
            if then not in self.numbers:
                self.numbers[then] = len(self.states)
                self.states.append(then)
            found = self.arcs[state, symbol] = self.numbers[then], math.exp(weight)
        return found

    def path(self, symbols: list[int]) -> list[float]:
        """The weight of every arc on a clause's path."""
        if THREAT in symbols:
            symbols, left = symbols[:], 0
            for k in range(len(symbols) - 1, -1, -1):
                left, symbols[k] = aimed(left, symbols[k])
        state, factors = 0, []
        for symbol in symbols:
            state, factor = self.arc(state, symbol)
            factors.append(factor)
        return factors


class Words(dict):
    """(symbol, weight) of words, remembered up to a bound."""

    def __init__(self, lexicon: dict[str, float], threats: frozenset[str] = frozenset()):
        super().__init__()
        self.lexicon, self.threats = lexicon, threats | THREATS

    def __missing__(self, word: str):
        forms = features_of(word)
        weight = max(0.0, *(self.lexicon.get(f, 0.0) for f in forms))
        if word in PRIOR_WORDS:  # labels that know the word have corrected its weight
            weight = max(weight, self.lexicon.get(word, PRIOR))
        if weight > 0:
            found = (INSULT if self.threats.isdisjoint(forms) else THREAT, weight)
        else:
            kinds = ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT))
            found = (next((kind for words, kind in kinds if word in words), OTHER), 0.0)
        if len(self) >= 1 << 18:
            self.clear()
        self[word] = found
        return found


def features_of(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends in a star."""
    return [word, *(f"{word[:n]}*" for n in STEMS if n < len(word))]


def clause_features(text: str | None, words: Words, machine: Machine) -> list[float]:
    """Sums of what the matches of a text weigh on their clauses' paths; zeros without a match.

    Of the strongest clause; of all (its log); of different matches, each where it weighs most
    (its log); and of all for each hundred words (its log).
    """
    text = (text or "").lower()
    found = WORD.findall(text)
    if not any(w for _, w in map(words.__getitem__, found)):
        return [0.0] * FEATURES
    strongest, total, kinds = 0.0, 0.0, {}
    for clause in CLAUSE.findall(text):
        read = WORD.findall(clause)
        known = [words[w] for w in read]
        if not any(w for _, w in known):
            continue
        score = 0.0
        for word, (_, weight), factor in zip(read, known, machine.path([s for s, _ in known]), strict=True):
            if weight:
                weight *= factor
                score += weight
                kinds[word] = max(weight, kinds.get(word, 0.0))
        strongest, total = max(strongest, score), total + score
    density = 100 * total / max(20, len(found))
    return [strongest, math.log1p(total), math.log1p(sum(kinds.values())), math.log1p(density)]


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]  # the last is the intercept
    threats: frozenset[str] = frozenset()  # forms of the lexicon

    def words(self) -> Words:
        return Words(self.lexicon, self.threats)

    def score(self, features: Iterable[float]) -> float:
        z = sum(w * x for w, x in zip(self.weights, features)) + self.weights[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def induce_lexicon(rows: DataFrame, least: int = 4, z: float = 4.0, size: int = 20_000) -> dict[str, float]:
    """Words and beginnings that lean to label 1 in rows of (text, label), all of them counted.

    Counts are of documents. Kept is what occurs in `least` toxic documents and has smoothed log
    odds more than `z` standard errors above zero, at most the `size` most certain ones (a
    parameter of the model). Besides, threats and insults that occur at all are kept with the
    mean of their prior (a normal one of spread 1) and their log odds, weighed by certainty.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, toxic, forms = Counter(), Counter(), {}

        def taken() -> pa.RecordBatch:
            columns = [list(every), [toxic[f] for f in every], list(every.values())]
            types = pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["f", "a", "t"])

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found: set[str] = set()
                for word in set(WORD.findall((text.as_py() or "").lower())):
                    if word not in forms:
                        forms[word] = features_of(word)
                    found.update(forms[word])
                every.update(found)
                if label:
                    toxic.update(found)
                if len(every) > 200_000 or len(forms) > 200_000:
                    yield taken()
                    every, toxic, forms = Counter(), Counter(), {}
        if every:
            yield taken()

    totals = rows.agg(F.sum("label"), F.count(F.lit(1))).first()
    ones, n = float(totals[0] or 0), float(totals[1])
    if not ones or ones == n:
        return {}
    read = small_batches(rows).select("text", "label").mapInArrow(count, "f string, a bigint, t bigint")
    counted = read.groupBy("f").agg(F.sum("a").alias("a"), F.sum("t").alias("t"))
    b = F.col("t") - F.col("a")
    odds = F.log((F.col("a") + 0.5) / (ones - F.col("a") + 0.5)) - F.log((b + 0.5) / (n - ones - b + 0.5))
    error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (b + 0.5))
    weighed = materialise(
        counted.where((F.col("a") >= least) | F.col("f").isin(*sorted(PRIOR_WORDS)))
        .select("f", "a", odds.alias("w"), error.alias("e"), (odds / error).alias("z"))
    )
    leaning = weighed.where((F.col("a") >= least) & (F.col("z") > z)).orderBy(F.desc("z"), "f").limit(size).collect()
    lexicon = {r["f"]: r["w"] for r in leaning}
    for r in weighed.where(F.col("f").isin(*sorted(PRIOR_WORDS))).collect():  # at most as many as there are prior words
        lexicon.setdefault(r["f"], (PRIOR + r["w"] / r["e"] ** 2) / (1 + 1 / r["e"] ** 2))
    return lexicon


def induce_threats(rows: DataFrame, lexicon: dict[str, float], least: int = 4, z: float = 4.0) -> frozenset[str]:
    """Forms of the lexicon that targets follow and don't precede, in rows of (text).

    Occurrences are counted that have a target among the next `AIM` words of their clause, and those
    that have one among as many before. A threat has `least` of the former, twice as many as
    of the latter, and more by `z` standard errors than even chances give. The sums are at most
    two rows a form and no more than the lexicon.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, before, forms = Counter(), Counter(), {}
        for batch in batches:
            for text in batch.column(0):
                for clause in CLAUSE.findall((text.as_py() or "").lower()):
                    read = WORD.findall(clause)
                    at = {k for k, word in enumerate(read) if word in TARGETS}
                    for k, word in enumerate(read if at else ()):
                        if word not in forms:
                            if len(forms) > 200_000:
                                forms.clear()
                            forms[word] = [f for f in features_of(word) if f in lexicon]
                        if forms[word]:
                            if any(k + n in at for n in range(1, AIM + 1)):
                                after.update(forms[word])
                            if any(k - n in at for n in range(1, AIM + 1)):
                                before.update(forms[word])
        found = sorted(after.keys() | before.keys())
        columns = found, [after[f] for f in found], [before[f] for f in found]
        types = pa.string(), pa.int64(), pa.int64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["f", "a", "b"])

    if not lexicon:
        return frozenset()
    counted = small_batches(rows).select("text").mapInArrow(count, "f string, a bigint, b bigint")
    sums = counted.groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    sure = (F.col("a") >= least) & (F.col("a") >= 2 * F.col("b")) & (F.col("a") - F.col("b") > z * F.sqrt(F.col("a") + F.col("b")))
    return frozenset(r["f"] for r in sums.where(sure).select("f").collect())


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 2000) -> tuple[float, ...]:
    """Ridge logistic weights, none but the intercept (the last) below zero.

    One weight after the other takes a Newton step, cut at zero: the sum is convex and its bounds
    are each weight's own, so that this ends at the best weights there are.
    """
    x = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge * max(1, len(y)) / 100)
    penalty[-1] = 1e-6
    z = x @ w
    for _ in range(steps):
        largest = 0.0
        for j in range(len(w)):
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            bend = max(1e-9, x[:, j] ** 2 @ (p * (1 - p)) + penalty[j])
            step = np.clip((x[:, j] @ (y - p) - penalty[j] * w[j]) / bend, -2.0, 2.0)
            new = w[j] + step if j == len(w) - 1 else max(0.0, w[j] + step)
            z += (new - w[j]) * x[:, j]
            largest, w[j] = max(largest, abs(new - w[j])), new
        if largest < 1e-6:
            break
    return tuple(map(float, w))


def features(rows: DataFrame, words_of: Callable[[], Words], carry: list[str] | None, text: str = "text") -> DataFrame:
    def start():
        words, machine = words_of(), Machine(grammar())

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            return [pa.array([clause_features(x.as_py(), words, machine) for x in columns[0]], pa.list_(pa.float64()))]

        return work

    return map_beside(rows, [F.col(text)], start, "x array<double>", carry)


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, max_rows: int = 20_000, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from labelled documents for whose id `may_learn` holds.

    The weights are fitted on three in ten documents of each label, but about 0.15 `max_rows` at
    most, chosen by a hash of the id; the lexicon is counted over all others. The intercept is
    corrected for the shares drawn. Rows without id or label, and labels that disagree about an
    id, don't count.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isin(0, 1) & may_learn)
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).alias("label"), F.max(label).alias("_hi")).where("label = _hi")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {y: min(0.3, 0.15 * max_rows / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64("_id", F.lit(8)), F.lit(1_000_000))
    least = F.when(F.col("label") == 1, int(share.get(1, 0) * 1_000_000)).otherwise(int(share.get(0, 0) * 1_000_000))
    known = materialise(known.select("_id", "label", (draw >= least).alias("early")))
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    early = rows.join(small(known), "_id").where("early")
    lexicon = induce_lexicon(early)
    plain = Model(lexicon, (1.0,) + (0.0,) * (FEATURES - 1) + (-4.0,), induce_threats(early.where("label = 1"), lexicon))
    drawn = rows.join(F.broadcast(known.where("not early")), "_id")  # at most about 0.3 max_rows
    late = features(drawn, plain.words, ["label"]).select("row.label", "x").collect()
    if not late or len({r["label"] for r in late}) < 2:
        return plain
    *weights, intercept = fit_logistic(np.array([r["x"] for r in late]), np.array([r["label"] for r in late], float))
    return replace(plain, weights=(*weights, intercept - math.log(share[1] / share[0])))


def score(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """`row` and its score from 0 to 1 (higher: more likely toxic).

    Null and empty texts score what a text without matches does. Every row is scored by itself.
    """

    def start():
        words, machine = model.words(), Machine(grammar())

        def work(columns: list[pa.Array]) -> list[pa.Array]:
            return [pa.array([model.score(clause_features(x.as_py(), words, machine)) for x in columns[0]], pa.float64())]

        return work

    return map_beside(docs, [F.col(text)], start, "score double", carry)


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score below `least`, with all their columns."""
    return score(docs, model).where(F.col("score") < least).select("row.*")


def held_out(doc_id: Column) -> Column:
    """Whether an id is never learned from: crc32 of its digits modulo 5 is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
