"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words map to a small alphabet: insult, threat, target, negation, reported
speech, clause end, sentence end, other.  Five transducers read it:

* insult and threat remember that a clause holds one,
* target remembers that somebody is addressed or named by a pronoun,
* negation turns on until the clause ends,
* reported speech turns on until the sentence ends.

Their composition (the reachable product states, with the clause's class as
output) is compiled once; reading a text with it yields matched clauses,
each of a class such as "insult, aimed at a target, reported".  A text's
score is logistic in the summed strengths of its clauses by class, so a
lone word counts only through the clause that it stands in.

Learnt from labelled rows: the insult lexicon (words, and stems that begin
longer words) with strengths, and the weights of the clause classes, which
are drawn towards the grammar's own weights.  The fit reads at most
``FIT_ROWS`` labelled rows, drawn by hash of their id; equal texts count
once.  Language, source and id are never inputs of a score.

Defined cases: null and empty texts get the score of a text without a
match; rows whose id is null or not labelled are scored alike; without
labels the lexicon is empty and the grammar's own weights hold; repeated rows
and equal texts get equal scores (in the fit, equal texts count once, toxic if
one of them is); very long texts are read whole, a clause at a time; an empty
table gives no rows; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import columns_of, cut, drawn, prepare, steady, table
from ledgerloom.llm.pieces import released

#: Labelled rows that the fit reads at most.
FIT_ROWS = 20_000
#: An entry must be this unlikely to be toxic so often by chance.
CHANCE = 1e-6
PRECISION = 0.7
STEMS = range(4, 9)
#: Words whose class a worker remembers before it starts anew.
MEMO = 200_000

# Function words and threat verbs of the four languages.
THREATS = {
    "kill", "murder", "hurt", "destroy", "strangle", "shoot", "stab", "tuer", "frapper", "étrangler",
    "töten", "umbringen", "verletzen", "erschießen", "matar", "golpear", "destruir", "estrangular",
}
TARGETS = {
    "you", "your", "he", "she", "they", "them", "him", "her", "tu", "toi", "vous", "ils", "elles",
    "du", "dich", "dir", "ihr", "euch", "usted", "ustedes", "tú", "ellos", "ellas",
}
NEGATIONS = {"not", "never", "no", "nor", "pas", "jamais", "ni", "nicht", "kein", "keine", "nie", "nunca", "jamás"}
REPORTS = {
    "said", "says", "quoted", "reported", "called", "wrote", "dit", "disait", "écrit", "sagte", "sagt", "schrieb",
    "dijo", "dice", "escribió",
}

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, CLAUSE, SENTENCE = range(8)
_TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]|[,;:()\"|]")
_LETTERS = re.compile(r"[^\W\d_]+")


def _remember(on: int, off: set[int]):
    """A transducer of two states: turned on by one symbol, off by others."""
    return lambda state, symbol: 1 if symbol == on else 0 if symbol in off else state


#: In the order of a product state's bits.
TRANSDUCERS = {
    "insult": _remember(INSULT, {CLAUSE, SENTENCE}),
    "threat": _remember(THREAT, {CLAUSE, SENTENCE}),
    "target": _remember(TARGET, {CLAUSE, SENTENCE}),
    "negated": _remember(NEGATION, {CLAUSE, SENTENCE}),
    "reported": _remember(REPORT, {SENTENCE}),
}


def compose() -> tuple[list[list[int]], list[list[int]], list[tuple[int, ...]]]:
    """``step[state][symbol]``, ``emit[state][symbol]`` (a clause class or
    -1) and the clause classes as tuples of transducer states."""
    machines = list(TRANSDUCERS.values())
    states, classes = [(0,) * len(machines)], []
    number, step, emit = {states[0]: 0}, [], []
    for s in states:  # grows while it is read
        step.append([])
        emit.append([])
        for symbol in range(8):
            t = tuple(m(x, symbol) for m, x in zip(machines, s))
            if t not in number:
                number[t] = len(states)
                states.append(t)
            step[-1].append(number[t])
            matched = symbol in (CLAUSE, SENTENCE) and (s[0] or s[1])
            if matched and s not in classes:
                classes.append(s)
            emit[-1].append(classes.index(s) if matched else -1)
    return step, emit, classes


STEP, EMIT, CLASSES = compose()


def grammar_weights() -> np.ndarray:
    """The weight of each clause class before any label is seen."""
    insult, threat, target, negated, reported = np.array(CLASSES, float).T
    return 2.0 * insult + 2.0 * threat + 0.5 * target - 0.75 * negated - 0.5 * reported


class Grammar:
    """The compiled automaton with a lexicon; scores texts."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], weights: np.ndarray | None = None, bias: float = -2.0):
        self.words, self.stems = words, stems
        self.weights, self.bias = grammar_weights() if weights is None else weights, bias
        self.lengths = sorted({len(s) for s in stems})
        self.memo: dict[str, tuple[int, float]] = {}

    def symbol(self, word: str) -> tuple[int, float]:
        if (w := self.words.get(word)) is not None:
            return INSULT, w
        for k in self.lengths:
            if len(word) > k and (w := self.stems.get(word[:k])) is not None:
                return INSULT, w
        if word in THREATS:
            return THREAT, 1.0
        return (TARGET if word in TARGETS else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER), 0.0

    def clauses(self, text: str) -> np.ndarray:
        """Summed strengths of the matched clauses, by class."""
        out = np.zeros(len(CLASSES))
        text = text.lower()
        memo = self.memo
        distinct = set(_LETTERS.findall(text))
        if len(memo) > MEMO:
            memo.clear()
        for w in distinct.difference(memo):
            memo[w] = self.symbol(w)
        if not any(memo[w][0] in (INSULT, THREAT) for w in distinct):
            return out
        state, strength = 0, 0.0
        for m in _TOKENS.finditer(text + "\n"):
            token = m.group()
            symbol, w = (SENTENCE, 0.0) if token in ".!?\n" else memo[token] if token in memo else (CLAUSE, 0.0)
            strength += w
            if symbol in (CLAUSE, SENTENCE):
                if (c := EMIT[state][symbol]) >= 0:
                    out[c] += strength
                strength = 0.0
            state = STEP[state][symbol]
        return out

    def score(self, text: str | None) -> float:
        x = np.log1p(self.clauses(text or ""))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + float(self.weights @ x)))))


def held_out(doc_id: Column) -> Column:
    """Rows the labels are never learnt from: crc32 of the id's text
    divisible by five (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled rows outside the held-out
    part, drawn by hash of the id; equal texts once."""
    known = columns_of(labels, {"_id": "doc_id", "y": "toxic"}).where(F.col("y").isNotNull() & ~held_out(F.col("_id")))
    known = cut(known.groupBy("_id").agg(F.max("y").alias("y")))
    # Few more than wanted are drawn before the exact choice among them.
    known = drawn(known, "_id", known.count(), 2 * rows).orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(rows)
    known = F.broadcast(cut(known))  # at most ``rows`` rows
    picked = docs.join(known, docs["doc_id"] == known["_id"]).select("text", "y").where(F.col("text").isNotNull())
    return picked.groupBy("text").agg(F.max("y").alias("y"))


def features(text: str) -> set[str]:
    """Words, and stems (marked by a star) of longer words."""
    words = set(_LETTERS.findall(text.lower()))
    return words | {w[:k] + "*" for k in STEMS for w in words if len(w) > k}


def learn_lexicon(known: DataFrame, rows: int, toxic: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with strengths; counted in Spark over the sample."""
    if not toxic or toxic == rows:
        return {}, {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[str, list[int]] = {}
            for t, y in zip(b.column("text"), b.column("y").to_pylist()):
                for f in features(t.as_py()):
                    counts.setdefault(f, [0, 0])[1 if y else 0] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], ["f", "clean", "toxic"])

    p = toxic / rows
    counts = known.mapInArrow(run, "f string, clean long, toxic long").groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = F.col("clean") + F.col("toxic")
    # Chernoff bound of the chance that a neutral entry is toxic so often.
    q = F.col("toxic") / n
    other = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
    counts = counts.where((F.length(F.regexp_replace("f", r"\*", "")) >= 3) & (q >= PRECISION) & (q > p))
    counts = counts.withColumn("chance", -n * (q * F.log(q / p) + other)).where(F.col("chance") < math.log(CHANCE))
    counts = counts.withColumn("strength", F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (rows - toxic + 1.0)))
    # All entries that pass: words of at most ``FIT_ROWS`` texts, each in several.
    top = counts.orderBy("chance", "f").select("f", "strength", "toxic").collect()
    found = {r["f"]: min(1.0, max(0.1, r["strength"] / 6)) for r in top}
    # A stem that only repeats one of its words adds nothing but risk.
    seen: dict[str, int] = {}
    for r in top:
        if not r["f"].endswith("*"):
            for k in STEMS:
                seen[r["f"][:k]] = max(seen.get(r["f"][:k], 0), r["toxic"])
    stems = {r["f"][:-1]: found[r["f"]] for r in top if r["f"].endswith("*") and r["toxic"] > 1.2 * seen.get(r["f"][:-1], 0)}
    short = {s: w for s, w in stems.items() if not any(s[:k] in stems for k in STEMS if k < len(s))}
    return {f: s for f, s in found.items() if not f.endswith("*")}, short


def fit_weights(x: np.ndarray, y: np.ndarray, prior: np.ndarray, pull: float = 1.0, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps, drawn towards ``prior``."""
    a = np.c_[x, np.ones(len(x))]
    start = np.r_[prior, -2.0]
    ridge = np.diag(np.r_[np.full(len(prior), pull), 1e-3])
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + ridge @ (w - start)
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Grammar:
    """Learn lexicon and weights; ``docs`` has ``doc_id`` and ``text``."""
    prepare(docs.sparkSession)
    known = cut(sample(docs, labels, rows))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    words, stems = learn_lexicon(known, n, toxic)
    plain = Grammar(words, stems)
    if not toxic or toxic == n:
        return plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(words, stems)
        for b in batches:
            x = [np.log1p(grammar.clauses(t.as_py())).tolist() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("y").cast(pa.int32())], ["x", "y"])

    # At most FIT_ROWS rows of a few numbers each.
    got = known.mapInArrow(run, "x array<double>, y int").groupBy("x", "y").count().orderBy("x", "y").toPandas()
    x = np.repeat(np.array(got["x"].tolist()), got["count"], axis=0)
    weights, bias = fit_weights(x, np.repeat(got["y"].to_numpy(float), got["count"]), grammar_weights())
    return Grammar(words, stems, weights, bias)


def score(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__score``; one pass, no shuffle."""
    model = (grammar.words, grammar.stems, grammar.weights, grammar.bias)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grammar(*model)
        for b in batches:
            s = [own.score(t.as_py()) for t in b.column(text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], [*b.schema.names, "__score"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "__score double"])
    return docs.mapInArrow(released(steady(run)), schema)


def clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that the fitted grammar rejects."""
    grammar = fit(columns_of(docs, {"doc_id": id_col, "text": text_col}), labels)
    return score(docs, grammar, text_col).where("__score < 0.5").drop("__score")


def query(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = columns_of(table(spark, sf_dir, "documents"), {"doc_id": "doc_id", "text": "text"})
    grammar = fit(docs, table(spark, sf_dir, "labels"))
    # Only the id and the score leave the workers.
    out = score(docs, grammar)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))
