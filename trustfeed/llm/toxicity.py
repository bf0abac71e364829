"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses (at sentence signs, unless a quotation mark follows, and at line ends), a clause into tokens, and a
token into the symbol that the lexicon gives it: insult (with a weight), threat, target (a person spoken to or of),
negation, report (a word of saying), or other; the clause's end is a symbol too. Five transducers, written as tables of
(state, symbol, next state, symbol out, factor), read these symbols one behind the other:

* negation: an insult within ``SCOPE`` tokens behind a negation has the factor ``NEGATED``, a threat there is none;
* target: an insult behind a named person has the factor ``AIMED``;
* threat: the end of a clause that holds a threat and a target, in any order, becomes a threatening end;
* report: the end of a clause with a word of saying, before or behind what is said, has the factor ``REPORTED``;
* insult: an insult adds its weight times its factor to the clause, a threatening end adds ``THREAT``, and an end multiplies the
  clause by its factor.

They are composed once to one machine, whose states are tuples of their states, and a text runs through that. The sums of
the clauses, not isolated words, are what the document's score is made of: a logistic function of the total, the strongest
clause, the number of matched clauses per clause and of different insults.

The grammar's word lists are fixed for four languages. Insults of the corpus are learned besides: word beginnings that occur
in toxic training documents far more often than in others (log-odds, and a G statistic against chance; of near copies one
counts). The lexicon is
learned on all training documents; the logistic weights are fitted to features of either half with the lexicon of the other
half, so that chance words in a lexicon are weighed for what they are worth. Training documents are a bounded sample: at most
``MAX_TRAIN`` of each label, those with the smallest hash of doc_id. A sampled row weighs as many rows as it stands for, in
the logistic fit and in the lexicon's counts, so that scores don't depend on how many rows of a label the input has beyond
the sample. Weights have the mean 1: the chance of a word is judged by what was sampled, not by what it stands for.

The fit is pulled towards a fixed scale by ``PRIOR_ROWS`` pseudo-rows (some feature vectors, each with both labels, weighed by the
fixed scale's probability), so few labels move it little, none leave it, and there is no number of labels at which another rule
begins.

Edge cases: null and empty texts have no clauses and get the score of an unmatched text; repeated rows get equal scores;
rows without label aren't trained on; labels of one kind, of unknown documents, or none at all are few labels; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import SPACE, arrow_rows, texts_of
from trustfeed.session import materialize

MAX_TRAIN = 10_000
THRESHOLD = 0.3
NEGATED, REPORTED, AIMED, THREAT = 0.5, 0.6, 1.25, 3.0
SCOPE = 3
# Lexicon: beginnings of this many letters, at least so many standard deviations and such log-odds.
PREFIX = range(3, 13)
MIN_Z, MIN_ODDS = 4.5, 1.5

# The grammar's words in English, German, French and Spanish.
INSULTS = frozenset("""idiot idiots moron morons stupid scum trash loser losers pathetic disgusting worthless clown imbecile dumbass bastard
    bitch asshole retard trottel arschloch dummkopf schwachkopf abschaum versager hurensohn missgeburt connard connasse salaud
    salope crétin débile ordure imbécile estúpido gilipollas pendejo cabrón basura perdedor asqueroso""".split())
THREATS = frozenset("""kill murder hurt destroy shoot stab strangle beat burn umbringen töten verletzen schlagen erschießen vernichten
    tuer tuerai frapper détruire brûler matar mataré golpear destruir quemar""".split())
TARGETS = frozenset("""you your yours u ya him her them he she they du dich dir ihr euch sie er tu toi te vous il ils eux lui vosotros tú ti
    usted ustedes ellos ella""".split())
NEGATIONS = frozenset("""not no never nobody neither without isn aren wasn weren don doesn didn nicht kein keine keinen nie niemals pas
    jamais aucun aucune sin nunca jamás ningún ninguna tampoco""".split())
REPORTS = frozenset("""said says say told tells wrote writes quoted quote called claimed reported according sagte sagt schrieb behauptete
    zitierte nannte laut dit disait écrit prétend cite appelle selon dijo dice escribió afirmó citó llamó según""".split())

# Words and clause ends; a sign before a closing quotation mark ends no clause, as what follows may say whose words they are.
_TOKENS = re.compile("[^\\W\\d_]+|\\n|[.!?;:](?![\"\u201c\u201d\u00bb\u2019])")
_ENDS = frozenset(".!?;:\n")
FEATURES = ("total", "strongest", "density", "kinds")
# The fixed scale, and the pseudo-rows that stand for it: their weight in all, and their features.
FIXED_WEIGHTS, FIXED_BIAS = (0.6, 0.6, 0.4, 0.4), -2.5
PRIOR_ROWS = 20.0
PRIOR_POINTS = ((0.0, 0.0, 0.0, 0.0), (2.0, 0.0, 0.0, 0.0), (0.0, 2.0, 0.0, 0.0), (0.0, 0.0, 2.0, 0.0), (0.0, 0.0, 0.0, 2.0),
                (1.5, 1.0, 0.5, 0.7), (2.5, 2.0, 1.0, 1.1), (4.0, 2.5, 2.0, 2.0))

# A transducer's rows: (state, symbol, next state, symbol out, factor). "*" stands for any symbol without a row of its own, "=" for
# the symbol that was read.
Rows = list[tuple[int, str, int, str, float]]
SYMBOLS = ("other", "insult", "threat", "target", "negation", "report", "end")
NEGATION: Rows = [row for s in range(SCOPE + 1) for row in (
    (s, "negation", SCOPE, "=", 1.0), (s, "end", 0, "=", 1.0),
    (s, "insult", max(s - 1, 0), "=", NEGATED if s else 1.0), (s, "threat", max(s - 1, 0), "other" if s else "=", 1.0),
    (s, "*", max(s - 1, 0), "=", 1.0))]
TARGET: Rows = [(0, "target", 1, "=", 1.0), (0, "*", 0, "=", 1.0),
                (1, "insult", 1, "=", AIMED), (1, "end", 0, "=", 1.0), (1, "*", 1, "=", 1.0)]
# 0: neither, 1: threat, 2: target, 3: both
THREATENING: Rows = [(0, "threat", 1, "=", 1.0), (0, "target", 2, "=", 1.0), (0, "*", 0, "=", 1.0),
                     (1, "target", 3, "=", 1.0), (1, "end", 0, "=", 1.0), (1, "*", 1, "=", 1.0),
                     (2, "threat", 3, "=", 1.0), (2, "end", 0, "=", 1.0), (2, "*", 2, "=", 1.0),
                     (3, "end", 0, "threatening end", 1.0), (3, "*", 3, "=", 1.0)]
REPORT: Rows = [(0, "report", 1, "=", 1.0), (0, "*", 0, "=", 1.0),
                (1, "end", 0, "=", REPORTED), (1, "threatening end", 0, "=", REPORTED), (1, "*", 1, "=", 1.0)]
INSULT: Rows = [(0, "insult", 0, "add", 1.0), (0, "end", 0, "close", 1.0), (0, "threatening end", 0, "close threat", 1.0),
                (0, "*", 0, "pass", 1.0)]
CASCADE = (NEGATION, TARGET, THREATENING, REPORT, INSULT)


def step(rows: dict[tuple[int, str], tuple[int, str, float]], state: int, symbol: str) -> tuple[int, str, float]:
    """One transducer's (next state, symbol out, factor)."""
    after, out, factor = rows[state, symbol] if (state, symbol) in rows else rows[state, "*"]
    return after, symbol if out == "=" else out, factor


def keyed(rows: Rows) -> dict[tuple[int, str], tuple[int, str, float]]:
    return {(state, symbol): rest for state, symbol, *rest in rows}


def compose(cascade: tuple[Rows, ...]) -> list[dict[str, tuple[int, str, float]]]:
    """One machine: per state, the start being 0, symbol -> (next state, symbol out of the last transducer, product of factors)."""
    tables, start = [keyed(rows) for rows in cascade], (0,) * len(cascade)
    numbers, waiting, machine = {start: 0}, [start], []
    while waiting:
        states = waiting.pop(0)
        arcs = {}
        for symbol in SYMBOLS:
            after, out, product = [], symbol, 1.0
            for table, state in zip(tables, states):
                nxt, out, factor = step(table, state, out)
                after.append(nxt)
                product *= factor
            after = tuple(after)
            if after not in numbers:
                numbers[after] = len(numbers)
                waiting.append(after)
            arcs[symbol] = (numbers[after], out, product)
        machine.append(arcs)
    return machine


MACHINE = compose(CASCADE)


@dataclass
class Grammar:
    """Token symbols and insult weights; ``classify`` gives a token's symbol and, for insults, weight and entry."""

    insults: dict[str, float] = field(default_factory=dict)
    cache: dict = field(default_factory=dict)

    def classify(self, token: str) -> tuple[str, float, str]:
        if token in _ENDS:
            return "end", 0.0, ""
        best, entry = 0.0, ""
        for n in range(min(len(token), PREFIX[-1]), PREFIX[0] - 1, -1):
            if (w := self.insults.get(token[:n], 0.0)) > best:
                best, entry = w, token[:n]
        if token in INSULTS and best < 3.0:
            best, entry = 3.0, token
        if best:
            return "insult", best, entry
        for name, words in (("threat", THREATS), ("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)):
            if token in words:
                return name, 0.0, token
        return "other", 0.0, ""

    def arc(self, token: str) -> tuple[str, float, str]:
        try:
            return self.cache[token]
        except KeyError:
            if len(self.cache) > 300_000:
                self.cache.clear()
            out = self.cache[token] = self.classify(token)
            return out

    def symbols(self, text: str) -> list[tuple[str, float, str]]:
        """The text's symbols; the last clause ends too."""
        return [*map(self.arc, _TOKENS.findall(text.lower())), ("end", 0.0, "")]

    def clauses(self, text: str) -> tuple[list[tuple[float, list[str]]], int]:
        """((weight, entries) of each matched clause, number of clauses)."""
        matched, n, state, weight, entries, empty = [], 0, 0, 0.0, [], True
        for symbol, w, entry in self.symbols(text):
            state, out, factor = MACHINE[state][symbol]
            if out == "pass":
                empty = False
            elif out == "add":
                weight += w * factor
                entries.append(entry)
                empty = False
            elif not empty:
                n += 1
                if out == "close threat":
                    weight += THREAT
                if weight:
                    matched.append((weight * factor, entries))
                weight, entries, empty = 0.0, [], True
        return matched, n

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        matched, n = self.clauses(text or "")
        if not matched:
            return 0.0, 0.0, 0.0, 0.0
        total = sum(w for w, _ in matched)
        kinds = {e for _, es in matched for e in es}
        return (float(np.log1p(total)), float(np.log1p(max(w for w, _ in matched))), total / n, float(np.log1p(len(kinds))))


@dataclass
class Model:
    grammar: Grammar
    weights: tuple[float, ...] = FIXED_WEIGHTS
    bias: float = FIXED_BIAS

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.grammar.features(text)))
        return float(1.0 / (1.0 + np.exp(-z)))


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def labelled_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows to train on."""
    return labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")


def known_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows to train on that have a document."""
    return labelled_rows(labels).join(docs.select("doc_id"), "doc_id", "left_semi")


def label_weights(known: DataFrame, max_train: int = MAX_TRAIN) -> dict[int, float]:
    """Label -> labelled rows that a sampled row of it stands for, scaled to a mean of 1 over the sample."""
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sampled = {t: min(n, max_train) for t, n in counts.items() if max_train > 0}
    return {t: counts[t] / n * sum(sampled.values()) / sum(counts.values()) for t, n in sampled.items()}


def training_rows(docs: DataFrame, known: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, text, toxic, part) of a bounded sample of labelled rows, in two halves (part 0, 1)."""
    rows = known.withColumn("h", F.xxhash64("doc_id"))
    few = [rows.where(F.col("toxic") == t).orderBy("h", "doc_id").limit(max_train) for t in (0, 1)]
    # at most 2 * max_train ids
    chosen = materialize(few[0].unionByName(few[1]), "toxicity-sample").withColumnRenamed("doc_id", "id_")
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id_"))
    return joined.select("doc_id", "text", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("part"))


def one_of_each(rows: DataFrame, size: int = 5) -> DataFrame:
    """One row of those whose smallest hash of ``size`` neighbouring words agrees: copies would count as many witnesses."""
    words = rows.select("text", "toxic", F.split(F.lower(F.coalesce("text", F.lit(""))), SPACE).alias("words"))
    places = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    least = F.array_min(F.transform(places, lambda i: F.xxhash64(F.slice("words", i, size))))
    return words.select("text", "toxic", least.alias("least")).groupBy("toxic", "least").agg(F.min("text").alias("text"))


def learn_lexicon(rows: DataFrame, min_z: float = MIN_Z, weights: dict[int, float] | None = None) -> dict[str, float]:
    """Insult beginnings -> weight, from (text, toxic) rows, which count as much as ``weights`` gives their label (1).

    Counted are documents' different words, first per word, then per beginning; the sample is bounded, so is this.
    """
    clean, toxic = ((weights or {}).get(k, 1.0) for k in (0, 1))
    words = one_of_each(rows).select("toxic", F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1)))).alias("word"))
    by_word = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    by_word = materialize(by_word, "toxicity-words")
    all_t, all_n = (x or 0 for x in by_word.agg(F.sum("t"), F.sum("n")).first())
    all_t, all_n = toxic * all_t, toxic * all_t + clean * (all_n - all_t)
    starts = by_word.select(F.explode(F.expr(
        f"transform(filter(sequence({PREFIX[0]}, {PREFIX[-1]}), k -> k <= length(word)), k -> left(word, k))")).alias("start"),
        "t", "n").groupBy("start").agg(F.sum("t").alias("t"), F.sum("n").alias("n")) \
        .select("start", (toxic * F.col("t")).alias("t"), (toxic * F.col("t") + clean * (F.col("n") - F.col("t"))).alias("n"))
    # log-odds of toxic against other documents, with half a count as prior
    a, b = F.col("t") + 0.5, F.col("n") - F.col("t") + 0.5
    odds = F.log(a / (all_t + 1)) - F.log(b / (all_n - all_t + 1))
    # the signed root of the G statistic of "toxic documents have no larger share here than overall"
    share = min(max(all_t / max(all_n, 1), 1e-9), 1 - 1e-9)
    t, c, n = F.col("t"), F.col("n") - F.col("t"), F.col("n")
    g = F.when(t > 0, t * F.log(t / (n * share))).otherwise(0.0) + F.when(c > 0, c * F.log(c / (n * (1 - share)))).otherwise(0.0)
    scored = starts.select("start", "t", odds.alias("odds"), F.sqrt(F.greatest(2 * g, F.lit(0.0))).alias("z"))
    best = scored.where((F.col("z") >= min_z) & (F.col("odds") >= MIN_ODDS)) \
        .orderBy(F.col("z").desc(), F.length("start").desc(), "start").collect()
    lexicon: dict[str, float] = {}
    starts_of_entries: set[str] = set()
    for r in best:  # of a word's beginnings the most telling one
        start = r["start"]
        own = {start[:n] for n in range(1, len(start) + 1)}
        if start not in starts_of_entries and not any(x in lexicon for x in own):
            lexicon[start] = float(r["odds"])
            starts_of_entries |= own
    return lexicon


def clause_features(rows: DataFrame, grammar: Grammar) -> DataFrame:
    """Label and clause features of (text, toxic) rows."""
    schema = pa.schema([("toxic", pa.int32()), *((f, pa.float64()) for f in FEATURES)])

    def measure(batches):
        for batch in batches:
            yield arrow_rows([(t, *grammar.features(x)) for x, t in texts_of(batch, "text", "toxic")], schema)
    return rows.select("text", "toxic").mapInArrow(measure, "toxic int, " + ", ".join(f"{f} double" for f in FEATURES))


def prior_rows(weight: float = PRIOR_ROWS) -> list[tuple]:
    """(features, y, w): each point with either label, weighed by the fixed scale's probability."""
    rows = []
    for x in PRIOR_POINTS:
        p = 1.0 / (1.0 + math.exp(-FIXED_BIAS - sum(a * b for a, b in zip(FIXED_WEIGHTS, x))))
        rows += [(*x, y, weight / len(PRIOR_POINTS) * q) for y, q in ((1.0, p), (0.0, 1.0 - p))]
    return rows


def fit_scale(table: DataFrame, weights: dict[int, float] | None = None) -> tuple[tuple[float, ...], float]:
    """Logistic weights and bias of the clause features, of rows that weigh as their label, beside the prior's pseudo-rows."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    clean, toxic = ((weights or {}).get(k, 1.0) for k in (0, 1))
    rows = table.select(*FEATURES, F.col("toxic").cast("double").alias("y"), F.when(F.col("toxic") == 1, toxic).otherwise(clean).alias("w"))
    prior = table.sparkSession.createDataFrame(prior_rows(), rows.schema)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.unionByName(prior))
    fit = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w", regParam=1e-3, maxIter=50).fit(data)
    return tuple(float(w) for w in fit.coefficients), float(fit.intercept)


def train_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    known = materialize(known_labels(docs, labels), "toxicity-labels")
    rows = materialize(training_rows(docs, known, max_train), "toxicity-rows")
    weights = label_weights(known, max_train)
    halves = [rows.where(F.col("part") == k) for k in (0, 1)]
    crossed = [clause_features(halves[1 - k], Grammar(learn_lexicon(halves[k], weights=weights))) for k in (0, 1)]
    scale = fit_scale(materialize(crossed[0].unionByName(crossed[1]), "toxicity-features"), weights)
    return Model(Grammar(learn_lexicon(rows, weights=weights)), *scale)


def score_column(model: Model):
    """A function text column -> score column."""
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([model.score(x) for x in batch], dtype="float64")
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    score = score_column(train_toxicity(docs, labels, max_train))
    scored = docs.select("doc_id", "text").select("doc_id", score("text").alias("score"))
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold."""
    score = score_column(train_toxicity(docs, labels, max_train))
    return docs.where(score(F.col("text")) < threshold)
