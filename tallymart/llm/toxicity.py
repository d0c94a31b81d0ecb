"""Toxicity by a weighted finite-state pattern grammar.

An Aho-Corasick automaton finds insult and threat stems in the text. Each clause with a hit is rewritten as a string over
{insult, threat, target, negation, report}, and five weighted transducers read it: an insult counts more where a target was
seen before it, and gains when one follows; a threat counts whole only with a target; a hit counts little behind a negation
and less inside reported speech. They are composed into one machine, whose states are the reachable tuples of theirs and
whose weights are the products of theirs, so negated and reported, or reported and targeted, are states of their own.
A document's score is a logistic function of its clause weights. Stems, their weights and the logistic coefficients are
learned from labelled rows only; the function words (targets, negations, reports, threats) are a fixed list.

A null or empty text has no clause and scores what a text without hits scores. Repeated rows score alike; of several texts
under one labelled id the largest is learned from. A null id is not held out and nothing is learned from it. Without any
labelled row the lexicon holds the threat stems alone and the default coefficients stand.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import drop, fold, shared_dir, text_steps, written

# Function words of the grammar in the four languages.
TARGETS = frozenset("you your yours u he she they them him her his their who people man woman du dich dir dein ihr euch sie er vous tu toi ton votre il elle ils elles eux usted ustedes tú tu vosotros él ella ellos ellas".split())
NEGATIONS = frozenset("not no never n't don't isn't wasn't aren't nor without nicht kein keine nie ohne ne pas jamais sans aucun ningún ninguna nunca sin".split())
REPORTS = frozenset("said says say claimed claims wrote called quoted reported alleged sagte sagt nannte behauptete schrieb dit disait appelait écrit rapporté dijo dice llamó escribió".split())
THREATS = frozenset("kill murder hurt shoot stab strangle destroy töten umbringen erschießen tuer assassiner frapper matar asesinar golpear".split())

#: Beginnings of words of this many characters are tried as stems; a word that is shorter, only whole.
STEM_MIN, STEM_MAX = 4, 9
#: A stem enters the lexicon with this many toxic documents, and at most this share of clean ones among its documents.
MIN_SUPPORT, MAX_CLEAN = 6, 0.02
#: Bound of what is learned from: labelled rows (the first by hash of the id).
MAX_FIT_ROWS = 40_000
CLAUSE = re.compile(r"[.!?;:\n,|]")
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
FEATURES = 6
INSULT, THREAT, TARGET, NEGATION, REPORT = "itTNR"


@dataclass(frozen=True)
class Transducer:
    """arcs: (state, symbol) -> (next state, factor of the symbol's own weight, factor of the last hit's weight that is added).
    A symbol without an arc changes nothing: it stays in the state with factors 1 and 0."""

    arcs: dict

    def step(self, state, symbol: str) -> tuple:
        return self.arcs.get((state, symbol), (state, 1.0, 0.0))


#: An insult behind a target is aimed at it; a target that follows a free insult adds half of it, once.
INSULTS = Transducer({("", INSULT): ("free", 1.0, 0.0), ("free", INSULT): ("free", 1.0, 0.0), ("aimed", INSULT): ("aimed", 1.5, 0.0), ("", TARGET): ("aimed", 1.0, 0.0), ("free", TARGET): ("aimed", 1.0, 0.5)})
#: A threat that is aimed at no one counts half.
THREATENED = Transducer({("", THREAT): ("free", 0.5, 0.0), ("free", THREAT): ("free", 0.5, 0.0), ("aimed", THREAT): ("aimed", 1.5, 0.0), ("", TARGET): ("aimed", 1.0, 0.0), ("free", TARGET): ("aimed", 1.0, 0.5)})
#: Counts whether hits have a target, whatever their kind.
AIMED = Transducer({("", TARGET): ("aimed", 1.0, 0.0)})
NEGATED = Transducer({("", NEGATION): ("negated", 1.0, 0.0), ("negated", INSULT): ("negated", 0.3, 0.0), ("negated", THREAT): ("negated", 0.3, 0.0)})
REPORTED = Transducer({("", REPORT): ("reported", 1.0, 0.0), ("reported", INSULT): ("reported", 0.6, 0.0), ("reported", THREAT): ("reported", 0.6, 0.0)})
GRAMMAR = (INSULTS, THREATENED, AIMED, NEGATED, REPORTED)


def composed(parts: tuple[Transducer, ...]) -> Transducer:
    """The machine that runs all parts at once: tuples of states, own factors multiplied, of later gains the largest."""
    start = ("",) * len(parts)
    arcs, todo = {}, [start]
    seen = {start}
    while todo:
        state = todo.pop()
        for symbol in (INSULT, THREAT, TARGET, NEGATION, REPORT):
            steps = [t.step(s, symbol) for t, s in zip(parts, state)]
            after = tuple(s[0] for s in steps)
            arcs[state, symbol] = (after, math.prod(s[1] for s in steps), max(s[2] for s in steps))
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return Transducer(arcs)


MACHINE = composed(GRAMMAR)
START = ("",) * len(GRAMMAR)


def clause_weight(symbols: list[tuple[str, float]], machine: Transducer = MACHINE) -> tuple[float, int, int]:
    """Weight of one clause, and its hits that had a target, and that were negated or reported."""
    state, total, targeted, softened, last = START, 0.0, 0, 0, 0.0
    for symbol, weight in symbols:
        after, own, later = machine.arcs[state, symbol]
        if symbol in (INSULT, THREAT):
            last = weight * own
            total += last
            targeted += state[2] == "aimed"
            softened += state[3] == "negated" or state[4] == "reported"
        elif later:
            total += later * last
            targeted += last > 0
        state = after
    return total, targeted, softened


@dataclass
class Grammar:
    stems: dict[str, float] = field(default_factory=dict)
    coef: list[float] = field(default_factory=lambda: [-3.0, 2.0, 1.0, 0.5, 1.5, -0.5])

    def automaton(self):
        """Stems to (length, weight, symbol, whole word only)."""
        import ahocorasick

        a = ahocorasick.Automaton()
        for s, w in self.stems.items():
            a.add_word(s, (len(s), w, INSULT, len(s) < STEM_MIN))
        for s in THREATS:
            if s not in self.stems:
                a.add_word(s, (len(s), 1.0, THREAT, True))
        a.make_automaton()
        return a


def features(text: str, automaton) -> list[float]:
    """Intercept, strongest clause, number of hits, total weight, targeted hits and softened hits (the last four damped by log)."""
    low = text.lower()
    hits: dict[int, tuple[float, str]] = {}
    for end, (n, w, symbol, whole) in automaton.iter(low):
        at = end - n + 1
        if (at == 0 or not low[at - 1].isalnum()) and (not whole or end + 1 == len(low) or not low[end + 1].isalnum()):
            if at not in hits or hits[at][0] < w:
                hits[at] = (w, symbol)
    if not hits:
        return [1.0] + [0.0] * (FEATURES - 1)
    top = total = 0.0
    n = targeted = softened = 0
    cuts = [m.start() for m in CLAUSE.finditer(low)]
    for clause, members in groupby(sorted(hits), key=lambda at: bisect_left(cuts, at)):
        begin = cuts[clause - 1] + 1 if clause else 0
        end = cuts[clause] if clause < len(cuts) else len(low)
        n += len(list(members))
        symbols = []
        for t in TOKEN.finditer(low, begin, end):
            if t.start() in hits:
                w, symbol = hits[t.start()]
                symbols.append((symbol, w))
            elif (word := t.group()) in TARGETS:
                symbols.append((TARGET, 0.0))
            elif word in NEGATIONS:
                symbols.append((NEGATION, 0.0))
            elif word in REPORTS:
                symbols.append((REPORT, 0.0))
        w, a, b = clause_weight(symbols)
        top, total, targeted, softened = max(top, w), total + w, targeted + a, softened + b
    return [1.0, min(top, 8.0), math.log1p(n), math.log1p(total), math.log1p(targeted), math.log1p(softened)]


def stems_of(text: str) -> set[str]:
    """Beginnings of the words of a text that may become stems; words too short for one stand whole."""
    found = set()
    for w in set(TOKEN.findall(text.lower())):
        if not w.isdigit():
            found.update([w[:k] for k in range(STEM_MIN, min(len(w), STEM_MAX) + 1)] or [w])
    return found


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold each stem."""
    toxic, clean = Counter(), Counter()

    def out():
        keys = list(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_pydict({"stem": pa.array(keys, pa.string()), "toxic": pa.array([toxic[k] for k in keys], pa.int64()), "clean": pa.array([clean[k] for k in keys], pa.int64())})

    for labels, texts in text_steps(batches, "label"):
        for y, t in zip(labels, texts):
            (toxic if y else clean).update(stems_of(t))
        if len(toxic) + len(clean) > 400_000:
            yield out()
            toxic.clear(), clean.clear()
    yield out()


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    pen = ridge * np.eye(x.shape[1])
    pen[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + pen @ w / 10
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x / len(y) + pen / 10
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(labelled: DataFrame) -> Grammar:
    """labelled: doc_id, text, label (0 or 1), a written table of bounded size.

    Exactly equal texts count once, so that a large group of copies does not make its rare words look like signs."""
    once = labelled.groupBy(F.xxhash64("text"), "label").agg(F.min("doc_id").alias("doc_id"))
    rows = labelled.join(F.broadcast(once.select("doc_id")), "doc_id", "left_semi").select("text", "label")
    counts = rows.mapInArrow(_stem_counts, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    good = counts.where((F.col("a") >= MIN_SUPPORT) & (F.col("b") <= MAX_CLEAN * (F.col("a") + F.col("b"))))
    found = {r["stem"]: (r["a"], r["b"]) for r in good.collect()}  # each has MIN_SUPPORT of the bounded rows
    grammar = Grammar({s: min(4.0, math.log((a + 0.5) / (b + 0.5))) for s, (a, b) in found.items() if not any(s[:k] in found for k in range(STEM_MIN, len(s)))})

    def features_of(batches):
        automaton = grammar.automaton()
        for labels, texts in text_steps(batches, "label"):
            yield pa.RecordBatch.from_pydict({"x": pa.array([features(t, automaton) for t in texts], pa.list_(pa.float64())), "y": pa.array(labels, pa.int32())})

    sample = rows.mapInArrow(features_of, "x array<double>, y int").toPandas()
    y = sample["y"].to_numpy(dtype=float)
    if 0 < y.sum() < len(y):
        grammar.coef = _fit_logistic(np.array(sample["x"].tolist()), y).tolist()
    return grammar


def scored(df: DataFrame, grammar: Grammar, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score (0 to 1) and n_hits for every row of df."""

    def rows(batches):
        a, w = grammar.automaton(), np.array(grammar.coef)
        for ids, texts in text_steps(batches, key, text=text):
            x = np.array([features(t, a) for t in texts])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_pydict({key: pa.array(ids, pa.int64()), "score": pa.array(p, pa.float64()), "n_hits": pa.array(np.rint(np.expm1(x[:, 2])).astype(np.int64))})

    return df.select(F.col(key).cast("long"), text).mapInArrow(rows, f"{key} long, score double, n_hits long")


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """labels: doc_id, toxic. A bounded sample of the labelled rows outside fold 0, in hash order of their ids, trains the grammar."""
    spark = documents.sparkSession
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_FIT_ROWS)
    at = shared_dir(spark)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    grammar = fit(written(texts.groupBy("doc_id", "label").agg(F.max("text").alias("text")), at))
    drop(spark, at)
    out = scored(documents, grammar)
    held = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits")
