"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a sequence of word classes: insult, threat, target, negation,
reported speech, comma, other. Small transducers rewrite and weigh it:

* ``negation`` marks insults and threats within three words of a negator as denied;
* ``reporting`` marks what follows a verb of saying as reported, to the clause's end;
* ``scoring`` gives the marked words weights, more next to a target.

They are composed into one transducer, and a clause weighs what its path weighs: each
arc's factor times the term's own weight. Isolated words of other classes weigh
nothing. The lexicon of insults is learned: terms whose odds in toxic texts are higher
with confidence, and which occur in several contexts (so that copies of one text do not
make terms of its words). A term is a word, or a stem (``worthl*``) whose inflections are
too rare one by one; a stem is weighed by how much denser it stands in toxic texts. Threats,
targets, negators and verbs of saying are fixed lists. A logistic curve over the document's
weight, and its weight for a thousand words, gives its score: a long clean text may hold a
stem by chance, but not densely.

How sure a term must be, and the curve, are chosen on the quarter of the sample that the
lexicon has not seen. Lexicon and curve are learned from a bounded sample of labelled rows (``sample``), and
the lexicon has at most ``terms`` entries; every row is scored over its whole text.
Null and empty texts weigh 0. Without toxic labels nothing is learned: the fixed lists
alone score, on a fixed curve.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.tables import prepare

SAMPLE = 20000
TERMS = 4000
STEMS = range(3, 9)  # lengths of stems in characters
SAME_STEM = 0.9      # share of a stem's words that a longer one has, for it to stand in its place
CLEAN_WORDS = 50     # words added to a text's own for its density, so that one word of few is no dense text
BARS = (1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0)  # lower bounds of the log odds ratio to choose from

# Word classes in English, French, German and Spanish.
THREATS = "kill murder hurt destroy strangle tuer frapper détruire töten schlagen zerstören matar golpear destruir".split()
TARGETS = ("you your yours yourself he him she her they them these those tu toi vous ton votre ils elles du dich dir ihr "
           "euch sie tú usted ustedes vosotros ellos ellas").split()
NEGATORS = "not no never neither nor without isn't aren't don't non jamais aucun nicht kein keine nie ohne nunca jamás sin".split()
REPORTERS = ("said says say told tells called wrote reported quoted claimed alleged dit disait disent écrit selon sagte sagt "
             "schrieb laut dijo dice dicen escribió según").split()
THREAT_WEIGHT = 2.0

CLASSES = ("insult", "threat", "target", "negation", "reporting", "comma", "word")
CLAUSE = re.compile(r"[.;:!?\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|,")


@dataclass
class Transducer:
    """Arcs from (state, input) to (state, output, factor); other input passes unchanged."""

    start: str
    arcs: dict = field(default_factory=dict)
    fallback: dict = field(default_factory=dict)  # state -> next state for input without an arc

    def step(self, state, symbol):
        if (state, symbol) in self.arcs:
            return self.arcs[state, symbol]
        return self.fallback.get(state, state), symbol, 1.0


def compose(first: Transducer, second: Transducer, alphabet=CLASSES) -> Transducer:
    """The transducer that feeds the output of ``first`` to ``second``; factors multiply."""
    made = Transducer((first.start, second.start))
    todo, seen = [made.start], {made.start}
    while todo:
        a, b = todo.pop()
        for symbol in alphabet:
            a2, middle, f = first.step(a, symbol)
            b2, out, g = second.step(b, middle)
            made.arcs[(a, b), symbol] = ((a2, b2), out, f * g)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return made


def negation(scope: int = 3) -> Transducer:
    made = Transducer("n0")
    for left in range(scope + 1):
        made.arcs[f"n{left}", "negation"] = (f"n{scope}", "word", 1.0)
        made.arcs[f"n{left}", "comma"] = ("n0", "comma", 1.0)
        made.fallback[f"n{left}"] = f"n{max(0, left - 1)}"
        for kind in ("insult", "threat"):
            if left:
                made.arcs[f"n{left}", kind] = (f"n{left - 1}", f"denied {kind}", 1.0)
    return made


def reporting() -> Transducer:
    made = Transducer("own")
    made.arcs["own", "reporting"] = ("reported", "word", 1.0)
    made.arcs["reported", "reporting"] = ("reported", "word", 1.0)
    for kind in ("insult", "threat", "denied insult", "denied threat"):
        made.arcs["reported", kind] = ("reported", kind, 0.5)
    return made


def scoring(near: int = 3) -> Transducer:
    """Output ``hit`` with a factor for what weighs; a target counts for ``near`` words."""
    made = Transducer("t0")
    for left in range(near + 1):
        state, after = f"t{left}", f"t{max(0, left - 1)}"
        made.fallback[state] = after
        made.arcs[state, "target"] = (f"t{near}", "word", 1.0)
        aimed = left > 0
        for kind, factor in (("insult", 1.5 if aimed else 1.0), ("threat", 1.5 if aimed else 0.25),
                             ("denied insult", 0.3), ("denied threat", 0.1)):
            made.arcs[state, kind] = (after, "hit", factor)
    return made


def grammar() -> Transducer:
    return compose(compose(negation(), reporting()), scoring())


@dataclass
class Model:
    lexicon: dict  # term, a stem with ``*`` -> (class, weight)
    slope: float = 1.0           # for the logarithm of the weight
    density_slope: float = 0.0   # for that of the weight for a thousand words
    offset: float = -3.0

    def __post_init__(self):
        self.arcs = {}
        for (state, symbol), (after, out, factor) in grammar().arcs.items():
            self.arcs.setdefault(state, {})[symbol] = (after, factor if out == "hit" else 0.0)
        self.start = grammar().start
        heavy = [term.removesuffix("*") for term, (kind, _) in self.lexicon.items() if kind in ("insult", "threat")]
        # what no term of weight begins with is not looked up as a stem
        self.heads = {term[:STEMS[0]] for term in heavy}
        self.stems = [k for k in STEMS if any(len(t) == k + 1 and t[-1] == "*" for t in self.lexicon)]

    def entry(self, token: str) -> tuple[str, float]:
        """Class and weight of a word: its own, or those of the weightiest of its stems."""
        own = self.lexicon.get(token, ("word", 0.0))
        if own[0] in ("word", "insult") and token[:STEMS[0]] in self.heads:
            for k in self.stems:
                stem = self.lexicon.get(token[:k] + "*")
                if stem and stem[1] > own[1] and len(token) >= k:
                    own = stem
        return own

    def weigh(self, text: str) -> tuple[float, int]:
        """The sum over the text's clauses of what their matched patterns weigh, and its words."""
        lowered = text.lower()
        heads, width = self.heads, STEMS[0]
        total, words = 0.0, 0
        for clause in CLAUSE.split(lowered):
            tokens = TOKEN.findall(clause)
            words += len(tokens) - tokens.count(",")
            if heads.isdisjoint([token[:width] for token in tokens]):
                continue
            state = self.start
            for token in tokens:
                kind, own = ("comma", 0.0) if token == "," else self.entry(token)
                state, factor = self.arcs[state][kind]
                total += factor * own
        return total, words


def fixed_lexicon() -> dict:
    lists = (("threat", THREATS, THREAT_WEIGHT), ("target", TARGETS, 0.0), ("negation", NEGATORS, 0.0),
             ("reporting", REPORTERS, 0.0))
    return {term: (kind, weight) for kind, terms, weight in lists for term in terms}


def learned_terms(rows: DataFrame, terms: int = TERMS, contexts: int = 3, confidence: float = 1.64) -> dict:
    """``term -> (log odds ratio, its lower bound)`` for terms with higher odds in toxic texts.

    A word's odds are those of the texts that have it. A stem's are those of its occurrences,
    as confident as its texts are many, and it must be twice as likely in a toxic text as well.
    """
    def run(batches):
        for batch in batches:
            seen: dict = {}  # (term, around, label) -> texts whose first occurrence it is, occurrences
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = TOKEN.findall((text or "").lower())
                own: dict = {}
                for i, token in enumerate(tokens):
                    if len(token) < 2:
                        continue
                    for term in (token, *[token[:k] + "*" for k in STEMS if k <= len(token)]):
                        if term not in own:
                            around = f"{tokens[i - 1] if i else ''} {tokens[i + 1] if i + 1 < len(tokens) else ''}" if label else ""
                            own[term] = [around, 0]
                        own[term][1] += 1
                for term, (around, n) in own.items():
                    counts = seen.setdefault((term, around, label), [0, 0])
                    counts[0] += 1
                    counts[1] += n
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([
                pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                pa.array([k[2] for k in keys], pa.int32()), pa.array([seen[k][0] for k in keys], pa.int64()),
                pa.array([seen[k][1] for k in keys], pa.int64())], names=["term", "around", "label", "n", "hits"])

    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # two rows
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return {}
    def total(column: str, label: int) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col(column)).otherwise(0))

    counted = rows.select("text", "label").mapInArrow(run, "term string, around string, label int, n bigint, hits bigint") \
        .groupBy("term", "around", "label").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")) \
        .groupBy("term").agg(total("n", 1).alias("pos"), total("n", 0).alias("neg"), total("hits", 1).alias("pos_hits"),
                             total("hits", 0).alias("neg_hits"), F.count(F.when(F.col("label") == 1, True)).alias("contexts"))

    def ratio(pos: str, neg: str) -> Column:
        return F.log((F.col(pos) + 0.5) / (toxic + 1.0)) - F.log((F.col(neg) + 0.5) / (clean + 1.0))

    stem, spread = F.col("term").endswith("*"), confidence * F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    odds = F.when(stem, ratio("pos_hits", "neg_hits")).otherwise(ratio("pos", "neg"))
    found = counted.where(F.col("contexts") >= contexts).where(~stem | (ratio("pos", "neg") - spread > math.log(2))) \
        .select("term", odds.alias("odds"), (odds - spread).alias("least"), "pos_hits") \
        .where(F.col("least") > BARS[0]).orderBy(F.desc("least"), "term").limit(terms).collect()  # ``terms`` rows at most
    # of stems that stand for the same words the longest is the closest
    hits = {r["term"]: r["pos_hits"] for r in found}
    loose = {term[:k] + "*" for term in hits if term.endswith("*") for k in range(STEMS[0], len(term) - 1)
             if hits[term] >= SAME_STEM * hits.get(term[:k] + "*", math.inf)}
    return {r["term"]: (r["odds"], r["least"]) for r in found if r["term"] not in loose}


def curve(features: np.ndarray, y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Slopes of the two features, none negative, and the offset of a logistic curve, by Newton steps."""
    used = [k for k in range(len(features)) if features[k].any()]
    while True:
        design = np.stack([*features[used], np.ones(len(y))])
        beta, ridge = np.zeros(len(design)), 1e-2 * np.eye(len(design))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(beta @ design, -35, 35)))
            step = np.linalg.solve((design * (p * (1 - p) + 1e-9)) @ design.T + ridge, design @ (p - y) + ridge @ beta)
            beta = beta - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if not used or beta[:-1].min() >= 0:
            found = np.zeros(len(features) + 1)
            found[[*used, -1]] = beta
            return found
        used.pop(int(beta[:-1].argmin()))


def train(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE, terms: int = TERMS) -> Model:
    """Learn from at most ``sample`` of the rows of ``labels``, the first by a hash of the key."""
    prepare(docs.sparkSession)
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")) \
        .agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)
    # the chosen labels are at most ``sample`` rows of two numbers
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
    learning = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(4)) != 0
    found = learned_terms(rows.where(learning), terms)
    models = [Model({**{t: ("insult", odds) for t, (odds, least) in found.items() if least > bar}, **fixed_lexicon()})
              for bar in BARS]
    rest = _weighed(rows.where(~learning).select(F.col("label").alias("id"), "text"), models, "int").toArrow()
    y, best, chosen_model = rest["id"].to_numpy(), math.inf, models[0]
    if len(set(y.tolist())) < 2:
        return chosen_model
    per_thousand = 1000 / (rest["words"].to_numpy() + CLEAN_WORDS)
    for i, model in enumerate(models):
        weight = rest["weights"].combine_chunks().values.to_numpy()[i::len(models)]
        x = np.log1p(np.stack([weight, weight * per_thousand]))
        slopes = curve(x, y)
        p = np.clip(1 / (1 + np.exp(-np.clip(slopes @ np.stack([*x, np.ones(len(y))]), -35, 35))), 1e-9, 1 - 1e-9)
        share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))  # both classes weigh the same
        loss = float((share * -np.where(y == 1, np.log(p), np.log(1 - p))).mean())
        if loss < best - 1e-3:
            best, chosen_model = loss, Model(model.lexicon, *map(float, slopes))
    return chosen_model


def _weighed(rows: DataFrame, models: list[Model], kind: str) -> DataFrame:
    """``id, weights, words``: what the document weighs by each model, and its words."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        own = shared.value
        for batch in batches:
            found = [m.weigh(text or "") for text in batch.column(1).to_pylist() for m in own]
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * len(own)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array([f[0] for f in found], pa.float64())),
                pa.array([f[1] for f in found[::len(own)]], pa.int64()),
            ], names=["id", "weights", "words"])

    return rows.select("id", "text").mapInArrow(run, f"id {kind}, weights array<double>, words bigint")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, weight, score`` for each row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    weight = F.col("weights")[0]
    density = weight * 1000 / (F.col("words") + CLEAN_WORDS)
    margin = F.log1p(weight) * model.slope + F.log1p(density) * model.density_slope + model.offset
    return _weighed(rows, [model], dict(docs.dtypes)[key]).select(
        F.col("id").alias(key), weight.alias("weight"), (1 / (1 + F.exp(-margin))).alias("score"))
