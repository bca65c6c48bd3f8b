"""Toxicity by a weighted finite-state pattern grammar.

Transducers compose into the machine that reads a clause:

* the lexicon reads a word letter by letter and accepts stems: insults, threats, targets, negations,
  reporting verbs.  Insult and threat stems carry weights; besides a seed list they are learned from
  labelled rows, as the log odds of the documents that hold the stem.  A learned stem that begins with a
  threat seed is a threat, any other an insult;
* reported speech, negation and target transducers mark a match as reported (up to the clause's end),
  negated (a few words on) or aimed (the clause names someone, before the match or after it);
* the threat and insult transducers write what a marked match counts for; a threat is one only if aimed.

compose() makes one machine of the five, and a clause scores by what its accepted path writes: matches
told apart as plain, negated, reported and aimed, and threats besides.  What each kind counts is learned
too, by a small logistic regression over the clause scores.

Defined results: null and empty texts score as texts without a match; texts are read whole; rows
with null ids are scored and never learned from; null labels are skipped, and of repeated labels of
one id the greatest counts; with no labels the seed list and the prior weights decide; an empty table
gives an empty result; label, language, source and id columns are never read as inputs of a score;
other columns pass through whatever their names, but for one named like the score, which is replaced.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import broadcast_if_small, fresh, saved, small_batches, worker_state

#: Labelled rows learned from, at most: those of the least id hash.
TRAIN_ROWS = 40_000
#: Stems are word beginnings of these lengths, and whole words (closed by '$').
STEM_LENGTHS = (4, 5, 6, 7, 8)
#: A stem is learned from at least so many toxic documents and different words before it (copies of one
#: document repeat its words with what stands before them), with this weight and deviations from chance.
LEAST_DOCS, LEAST_WEIGHT, LEAST_Z = 3, 2.5, 4.0
REJECT = 0.7

# Seed stems by class.
SEED = {
    "insult": "idiot moron stupid pathetic worthless loser$ scum$ trash$ clown$ disgusting imbecile bastard$ dumbass$ retard".split(),
    "threat": "kill$ murder$ hurt$ destroy$ strangle$ shoot$ stab$ behead$ töten$ töte$ umbringen$ ermorden$ erschießen$ tuer$ tuerai$ égorger$ étrangler$ matar$ mataré$ asesinar$ degollar$".split(),
    "target": "you your$ yours$ he$ she$ they$ him$ her$ them$ vous$ tu$ toi$ du$ dich$ ihr$ sie$ usted$ ustedes$ ellos$".split(),
    "negation": "not$ never$ no$ isn$ aren$ wasn$ nicht$ kein nie$ pas$ jamais$ nunca$ tampoco$".split(),
    "report": "said$ says$ quoted$ wrote$ claimed$ according$ sagte$ schrieb$ dit$ disait$ dijo$ escribió$".split(),
}
#: The weight of a threat seed is that without a target in its clause; with one it is THREAT_WEIGHT.
SEED_WEIGHT = {"insult": 4.0, "threat": 0.25}
THREAT_WEIGHT = 4.0
#: What the kinds count before anything is learned: bias, then the features in order, then the threats.
#: A negated or reported match counts for a small part of a plain one.
FEATURES = ("plain", "aimed", "negated", "reported", "clauses")
THREATS = ("threat",)
PRIOR = (-3.0, 2.2, 0.4, 0.4, 0.4, 0.2, 1.6)
#: Strength of that prior, as a penalty on the distance from it.
RIDGE = 0.5
NEGATION_REACH = 3
#: Classes of words that say how a match is meant.
CONTEXT = ("target", "negation", "report")

_clause_end = re.compile(r"[.!?;:\n]")
_word = re.compile(r"\w+")


class Transducer(NamedTuple):
    """States with arcs: by state and symbol read, the next states with the symbols written."""

    starts: tuple
    finals: frozenset
    arcs: dict[tuple, list[tuple]]


def transducer(starts: tuple, finals: Callable, alphabet: Iterable, step: Callable) -> Transducer:
    """The states that step reaches from starts: step(state, symbol) gives (next state, symbol written) pairs."""
    seen, todo, arcs = set(starts), list(starts), {}
    while todo:
        state = todo.pop()
        for symbol in alphabet:
            if found := list(step(state, symbol)):
                arcs[state, symbol] = found
                new = {s for s, _ in found} - seen
                seen |= new
                todo += new
    return Transducer(starts, frozenset(s for s in seen if finals(s)), arcs)


def written(t: Transducer) -> list:
    """The symbols that t writes: the alphabet of the one after it."""
    return sorted({symbol for found in t.arcs.values() for _, symbol in found}, key=repr)


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The transducer that reads what a reads and writes what b writes on what a writes."""
    def step(state, symbol):
        return [((p, q), z) for p, y in a.arcs.get((state[0], symbol), ()) for q, z in b.arcs.get((state[1], y), ())]

    starts = tuple((p, q) for p in a.starts for q in b.starts)
    return transducer(starts, lambda s: s[0] in a.finals and s[1] in b.finals, sorted({symbol for _, symbol in a.arcs}, key=repr), step)


@lru_cache(1)
def clause_machine() -> Transducer:
    """Reported speech, negation, target, threat and insult composed: word classes in, what a word counts for out.

    A symbol read is (match, class): match is "insult", "threat" or "", class one of CONTEXT or "".  A symbol
    written is (features, which of the word's two weights), or None for a word that counts for nothing.
    """
    classes = [(match, kind) for match in ("insult", "threat", "") for kind in (*CONTEXT, "")]
    # Reported speech begins after a reporting verb and lasts to the clause's end.
    report = transducer((False,), lambda s: True, classes, lambda s, x: [(s or x[1] == "report", (f"reported {x[0]}" if s and x[0] else x[0], x[1]))])
    # A negation reaches a few words ahead; what is reported stays so.
    negation = transducer(
        (0,), lambda s: True, written(report),
        lambda s, x: [(NEGATION_REACH if x[1] == "negation" else max(s - 1, 0), (f"negated {x[0]}" if s and x[0] in ("insult", "threat") else x[0], x[1]))],
    )
    # Whether the clause names someone is guessed at its start; the guess that does not come true is not accepted.
    target = transducer(
        ("sought", "none"), lambda s: s != "sought", written(negation),
        lambda s, x: [] if s == "none" and x[1] == "target" else [("met" if x[1] == "target" else s, (x[0], s != "none"))],
    )

    def context_of(match: str) -> str:
        return match.partition(" ")[0] if " " in match else "plain"

    # A threat is one only if the clause names someone: then it has its other weight and counts as a threat too.
    threat = transducer(
        (0,), lambda s: True, written(target),
        lambda s, x: [(0, ((context_of(x[0]), *(("aimed", "threat") if x[1] and x[0] == "threat" else ())), int(x[1])) if x[0].endswith("threat") else x)],
    )
    insult = transducer(
        (0,), lambda s: True, written(threat),
        lambda s, x: [(0, x if isinstance(x[0], tuple) else ((context_of(x[0]), *(("aimed",) if x[1] and x[0] == "insult" else ())), 0) if x[0] else None)],
    )
    machine = report
    for t in (negation, target, threat, insult):
        machine = compose(machine, t)
    return machine


def accepted_path(machine: Transducer, symbols: list) -> list:
    """What the machine writes on its one accepted path.  A path is its last symbol and the path before, so a word costs the same at any place."""
    paths = [(s, None) for s in machine.starts]
    for x in symbols:
        paths = [(s, (out, y)) for state, out in paths for s, y in machine.arcs.get((state, x), ())]
    path, said = next(out for s, out in paths if s in machine.finals), []
    while path is not None:
        path, y = path
        said.append(y)
    return said[::-1]


class Grammar:
    """The lexicon transducer, an automaton that reads words letter by letter, before the machine of a clause.

    threats has the stems that are threats, and their weights where the clause names someone.
    """

    def __init__(self, stems: dict[str, float], threats: dict[str, float] | None = None):
        import ahocorasick

        threats = threats or {}
        both = {s: (stems.get(s, 0.0), threats.get(s, 0.0)) for s in {**stems, **threats}}
        self.find = ahocorasick.Automaton()
        for stem in both:
            self.find.add_word(stem.rstrip("$"), (stem.rstrip("$"), []))
        self.any = bool(both)
        for stem, weights in both.items():
            self.find.get(stem.rstrip("$"))[1].append((stem.endswith("$"), *weights))
        if self.any:
            self.find.make_automaton()
        self.machine = clause_machine()
        self.context = [(kind, stem.rstrip("$"), stem.endswith("$")) for kind in CONTEXT for stem in SEED[kind]]
        self.classes: dict[str, str] = {}

    def word_class(self, word: str) -> str:
        if word not in self.classes:
            if len(self.classes) > 20_000:
                self.classes.clear()
            self.classes[word] = next((k for k, s, whole in self.context if (word == s if whole else word.startswith(s))), "")
        return self.classes[word]

    def accepted(self, low: str) -> dict[int, tuple[float, float]]:
        """Start of each word that the lexicon accepts, with its best weight and its best as a threat."""
        out: dict[int, tuple[float, float]] = {}
        if self.any:
            for end, (stem, readings) in self.find.iter(low):
                start = end + 1 - len(stem)
                if start and (low[start - 1].isalnum() or low[start - 1] == "_"):
                    continue
                after = low[end + 1:end + 2]
                for whole, weight, threat in readings:
                    if not (whole and after and (after.isalnum() or after == "_")):
                        best = out.get(start, (0.0, 0.0))
                        out[start] = max(weight, best[0]), max(threat, best[1])
        return out

    def features(self, text: str) -> list[float]:
        """Sums over the accepted paths of all clauses, dampened, and the clauses with a match."""
        low = text.lower()
        total = dict.fromkeys(FEATURES + THREATS, 0.0)
        hits = self.accepted(low)
        done = 0
        for first in sorted(hits):
            if first < done:
                continue
            before = max(low.rfind(c, done, first) for c in ".!?;:\n") + 1  # the mark that ended the clause before is at done
            done = m.start() if (m := _clause_end.search(low, first)) else len(low)
            symbols, weights = [], []
            for w in _word.finditer(low, before, done):
                weight, threat = hits.get(w.start(), (0.0, 0.0))
                symbols.append(("threat" if threat else "insult" if weight else "", self.word_class(w[0])))
                weights.append((weight, max(weight, threat)))
            for counts, own in zip(accepted_path(self.machine, symbols), weights, strict=True):
                for feature in counts[0] if counts else ():
                    total[feature] += own[counts[1]]
            total["clauses"] += 1
        return [math.log1p(total[k]) for k in FEATURES + THREATS]


def grammar(stems: str) -> Grammar:
    """One grammar a worker process and model."""
    weights = json.loads(stems)
    return worker_state(("grammar", stems), lambda: Grammar(weights, threats_of(weights)))


def threats_of(stems: dict[str, float]) -> dict[str, float]:
    """The threats among stems, seeds and learned ones: those that begin with a threat seed."""
    seeds = tuple(s.rstrip("$") for s in SEED["threat"])
    return {s: max(w, THREAT_WEIGHT) for s, w in stems.items() if s.startswith(seeds)}


def held_out(doc_id: str) -> Column:
    """Rows never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, limit: int) -> DataFrame:
    """(doc_id, text, toxic): at most about limit labelled rows outside the held-out third, saved.

    The ids are few, so the texts of all other documents stay where they are.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > limit:  # the share of ids with the least hashes
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * limit / n))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = broadcast_if_small(saved(known.select("doc_id", F.col("toxic").cast("int").alias("toxic"))), F.lit(16))
    return saved(own.join(known, "doc_id").select("doc_id", "text", "toxic"))


def stems_of(word: Column) -> Column:
    """The stems of a word: its beginnings, and the whole of it."""
    begins = F.array(*[F.when(F.length(word) >= k, F.substring(word, 1, k)) for k in STEM_LENGTHS])
    return F.concat(F.array(F.concat(word, F.lit("$"))), F.filter(begins, lambda x: x.isNotNull()))


def learned_stems(rows: DataFrame) -> dict[str, float]:
    """Seed stems, and those whose documents are toxic far more often than chance has it."""
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    stems = {s: SEED_WEIGHT[k] for k in SEED_WEIGHT for s in SEED[k]}
    n, p = totals["n"], totals["p"]
    if not p or p == n:
        return stems
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    # Of clean rows only stems of toxic ones matter, so their stems meet a table of those.
    pairs = F.array_distinct(F.zip_with(F.concat(F.array(F.lit("")), words), F.concat(words, F.array(F.lit(""))), lambda a, b: F.struct(a.alias("before"), b.alias("word"))))
    toxic = rows.where("toxic = 1").select("doc_id", F.inline(pairs)).where("word <> ''").select("doc_id", "before", F.explode(stems_of(F.col("word"))).alias("stem"))
    seen = toxic.groupBy("stem").agg(F.least(F.countDistinct("doc_id"), F.countDistinct("before")).alias("pos")).where(F.col("pos") >= LEAST_DOCS)
    own = F.array_distinct(F.flatten(F.transform(F.array_distinct(words), stems_of)))
    clean = rows.where("toxic = 0").select(F.explode(own).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("neg"))
    both = seen.join(clean, "stem", "left").withColumn("neg", F.coalesce("neg", F.lit(0)))
    weight = F.log((F.col("pos") + 0.5) / (p + 1.0)) - F.log((F.col("neg") + 0.5) / (n - p + 1.0))
    share = (F.col("pos") + F.col("neg")) / n
    z = (F.col("pos") / p - F.col("neg") / (n - p)) / F.sqrt(share * (1 - share) * (1 / p + 1 / (n - p)))
    best = both.withColumn("weight", weight).where((F.col("weight") >= LEAST_WEIGHT) & (z >= LEAST_Z))  # as many as the bounded sample gives
    for r in best.select("stem", "weight").collect():
        stems[r["stem"]] = max(stems.get(r["stem"], 0.0), float(r["weight"]))
    return stems


def features_of(stems: str):
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def features(texts: pa.Array) -> pa.Array:
        g = grammar(stems)
        return pa.array((g.features(t.as_py() or "") for t in texts), pa.list_(pa.float64()), size=len(texts))

    return features


def regression(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression held near PRIOR: Newton's steps, halved until the loss falls, so that none overshoots."""
    x = np.column_stack([np.ones(len(x)), x]) if len(x) else np.zeros((0, len(PRIOR)))
    prior = np.array(PRIOR[:x.shape[1]])  # x may end before the threats

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + RIDGE / 2 * ((w - prior) ** 2).sum())

    w, now = prior.copy(), loss(prior)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), x.T @ (p - y) + RIDGE * (w - prior))
        size = 1.0
        while size > 1e-6 and not loss(w - size * step) < now:
            size /= 2
        if size <= 1e-6 or np.abs(step).max() < 1e-8:
            break
        w = w - size * step
        now = loss(w)
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = TRAIN_ROWS) -> dict:
    """The model: stems with weights, and the regression's coefficients.

    Stems for the regression come from one half of the rows and its features from the other, so a
    stem that fits its own rows by chance is not trusted; the model's stems come from all rows.
    """
    rows = training_rows(small_batches(docs), labels, doc_id, text, limit)
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0
    trial = json.dumps(learned_stems(rows.where(half)), sort_keys=True)
    seen = sorted(tuple(r) for r in rows.where(~half).select("toxic", features_of(trial)("text").alias("x")).collect())
    coefficients = regression(np.array([x for _, x in seen]), np.array([y for y, _ in seen], float))
    return {"stems": json.dumps(learned_stems(rows), sort_keys=True), "coefficients": coefficients}


def scored(docs: DataFrame, model: dict, text: str = "text", score: str = "score") -> DataFrame:
    """docs with score: from 0 to 1, higher for likelier toxic."""
    x = features_of(model["stems"])(F.coalesce(F.col(text), F.lit("")))
    bias, *weights = model["coefficients"]
    (held,) = fresh(docs, "el_x")
    logit = F.aggregate(F.zip_with(held, F.array(*map(F.lit, weights)), lambda a, b: a * b), F.lit(float(bias)), lambda s, v: s + v)
    return small_batches(docs).withColumn(held, x).withColumn(score, 1 / (1 + F.exp(-logit))).drop(held)
