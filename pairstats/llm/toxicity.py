"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Terms (words, and stems that begin words) that mark toxic text are mined from a bounded sample of
   labelled documents by a likelihood-ratio test.
2. Voters look at each whole text: lexicon voters at terms of one kind and strength, pattern voters
   at shouting, exclamation and symbols. Each votes toxic (1), clean (0) or abstains (2).
3. The label model is a mixture of two tree-shaped distributions over the votes: beside its class,
   each voter depends on the one other voter it is most correlated with. EM estimates the
   accuracies and correlations from how often each combination of votes occurs in all documents.
4. A logistic regression on the terms and patterns is trained on posterior labels, and scores.
"""

from __future__ import annotations

import math
import re
from functools import partial
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairstats.llm.common import bounded_sample, labelled, map_texts
from pairstats.sinks.stage import materialize

#: Labelled documents that terms are mined from and the classifier is fitted on, at most.
SAMPLE = 24_000
#: Terms at most, and the test value (about chi-squared, 1 degree of freedom) each must reach.
TERMS, LEAST_G2 = 400, 36.0
STEMS = (3, 4, 5, 6, 7)
EM_ROUNDS = 40
VOTERS = (
    "strong_word", "strong_words", "some_terms", "several_terms", "dense_terms",
    "shouting", "exclamation", "symbols",
)
#: Share of toxic documents from which a term is strong.
STRONG = 0.97
VALUES = 10

_LETTERS = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"[A-ZÀ-Þ]{3,}")

def terms_of(text: str) -> set[str]:
    """Words and the stems that begin them; a word ends with ``$``."""
    found = set()
    for word in set(_LETTERS.findall(text.lower())):
        found.add(word + "$")
        found.update(word[:n] for n in STEMS if n < len(word))
    return found


def _counted(sample: DataFrame, known: set[str] | None) -> DataFrame:
    """(term, label, n): documents of each label that hold a term, counted first in each batch."""
    import pyarrow as pa

    def run(batches):
        from collections import Counter

        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            for text, label in zip(texts, labels, strict=True):
                terms = terms_of(text)
                counts[label].update(terms if known is None else terms & known)
            for label, c in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.string()), pa.array([label] * len(c), pa.int32()),
                     pa.array(list(c.values()), pa.int64())],
                    names=["term", "label", "n"],
                )

    counted = sample.mapInArrow(run, "term string, label int, n bigint")
    return counted.groupBy("term", "label").agg(F.sum("n").alias("n"))


def g2(k1, n1, k0, n0) -> float:
    """Likelihood ratio of two rates against one; 0 unless the first rate is larger."""
    if k1 * n0 <= k0 * n1:
        return 0.0
    p = (k1 + k0) / (n1 + n0)
    part = lambda k, n, q: (k and k * math.log(k / n / q)) + (
        (n - k) and (n - k) * math.log((n - k) / n / (1 - q))
    )
    return 2 * (part(k1, n1, p) + part(k0, n0, p)) if 0 < p < 1 else 0.0


def mine_terms(sample: DataFrame) -> list[tuple[str, float]]:
    """(term, share of toxic documents among those that hold it, both labels weighing the same)."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    # A term found in k toxic documents and in no other reaches 2 k ln((n1 + n0) / n1) or so.
    least = max(2, int(LEAST_G2 / 2 / math.log((n1 + n0) / n1 + 1)))
    toxic = _counted(sample.where("label = 1"), None).where(F.col("n") >= least)
    # Bounded by the sample: each of its toxic documents has so many terms.
    held = {r["term"]: r["n"] for r in toxic.select("term", "n").collect()}
    clean = {
        r["term"]: r["n"]
        for r in _counted(sample.where("label = 0"), set(held)).select("term", "n").collect()
    }
    found = []
    for term, k1 in held.items():
        k0 = clean.get(term, 0)
        value, rate1, rate0 = g2(k1, n1, k0, n0), k1 / n1, (k0 + 0.5) / n0
        if value >= LEAST_G2 and rate1 >= 4 * rate0:
            found.append((value, term, rate1 / (rate1 + rate0)))
    found.sort(key=lambda x: (-x[0], x[1]))
    return [(term, share) for _, term, share in found[:TERMS]]


def is_letter(sign: str) -> bool:
    """Whether a sign belongs to a word, as in ``_LETTERS``."""
    return sign.isalnum() and not sign.isdecimal()


def finder(terms: list[tuple[str, float]]):
    """(automaton over the terms' spellings, terms): made once for each task."""
    import ahocorasick

    # A word and a stem may be spelled alike: the spelling leads to both.
    alike: dict[str, list[int]] = {}
    for k, (term, _) in enumerate(terms):
        alike.setdefault(term.removesuffix("$"), []).append(k)
    automaton = ahocorasick.Automaton()
    for spelling, numbers in alike.items():
        automaton.add_word(spelling, (len(spelling), numbers))
    automaton.make_automaton()
    return automaton if alike else None, terms


def look(texts: list[str], found_by) -> list[list]:
    """For each text the terms it holds and how often, its voters' votes, and pattern values.

    A term counts wherever a word begins with it, or is it, just where ``terms_of`` takes terms from.
    """
    automaton, terms = found_by
    hits, times, votes, values = [], [], [], []
    for text in texts:
        found: dict[int, int] = {}
        places: set[int] = set()
        whole: set[int] = set()
        if automaton is not None and text:
            lower = text.lower()
            last = len(lower) - 1
            for end, (length, numbers) in automaton.iter(lower):
                start = end - length + 1
                if start and is_letter(lower[start - 1]):
                    continue
                ends = end == last or not is_letter(lower[end + 1])
                for j in numbers:
                    if ends == terms[j][0].endswith("$"):
                        found[j] = found.get(j, 0) + 1
                        places.add(start)
                        if ends and terms[j][1] >= STRONG:
                            whole.add(start)
        n_words = text.count(" ") + 1
        shout = len(_SHOUT.findall(text)) / n_words
        bang = text.count("!") / n_words
        symbols = sum(map(text.count, "$%&*#")) / n_words
        order = sorted(found)
        hits.append(order)
        times.append([found[j] for j in order])
        n, w = len(places), len(whole)
        values.append([
            math.log2(n + 1), float(n > 1), float(n > 2), float(n > 4), math.log2(w + 1),
            min(n / n_words, 0.2) * 10, min(shout, 2.0), min(bang, 2.0), min(symbols, 2.0),
            math.log2(n_words + 1) / 10,
        ])
        votes.append(vote(n, w, n_words, shout, bang, symbols))
    return [hits, times, votes, values]


def vote(n: int, whole: int, n_words: int, shout: float, bang: float, symbols: float) -> str:
    """One digit for each of ``VOTERS``: 1 toxic, 0 clean, 2 abstains.

    ``n`` places of the text hold a term, ``whole`` of them a strong one that is a whole word.
    """
    if not n:
        lexicon = "00000"
    else:
        lexicon = "".join(
            "1" if yes else other
            for yes, other in (
                (whole > 0, "2"), (whole > 1, "2"), (n > 1, "0"), (n > 2, "2"),
                (n * 100 >= n_words, "2"),
            )
        )
    return lexicon + "".join("1" if yes else "2" for yes in (shout > 0.3, bang > 0.1, symbols > 0.5))


def label_model(counts: list[tuple[str, int, float]], prior: float) -> dict[str, float]:
    """P(toxic | votes) for each combination of votes.

    ``counts`` has (votes, label, documents), label -1 where it is unknown. Known labels stay
    fixed; EM fills in the others. Each round finds the tree of the strongest correlations given
    the class (Chow and Liu) and the vote tables along it.
    """
    if not counts:
        return {}
    votes = np.array([[int(c) for c in v] for v, _, _ in counts])
    label = np.array([x for _, x, _ in counts])
    weight = np.array([float(n) for _, _, n in counts])
    n, m = votes.shape
    one = np.eye(3)[votes]  # rows x voters x votes
    post = np.where(label >= 0, label, np.clip(((votes[:, [0, 3]] == 1).any(1)) * 0.9, prior / 2, 1.0))
    for _ in range(EM_ROUNDS):
        w = np.stack([weight * (1 - post), weight * post])
        total = w.sum(1) + 1e-9
        single = np.einsum("cr,rjv->cjv", w, one) + 0.5
        single /= single.sum(2, keepdims=True)
        strength = np.zeros((m, m))
        pair = {}
        for j, k in combinations(range(m), 2):
            p = np.einsum("cr,ru,rv->cuv", w, one[:, j], one[:, k]) + 0.05
            p /= p.sum((1, 2), keepdims=True)
            pair[j, k] = p
            free = p.sum(2, keepdims=True) * p.sum(1, keepdims=True)
            strength[j, k] = strength[k, j] = (total[:, None, None] * p * np.log(p / free)).sum()
        parent, left = {0: None}, set(range(1, m))
        while left:
            j, k = max(((j, k) for j in parent for k in left), key=lambda x: (strength[x], -x[1]))
            parent[k] = j
            left.remove(k)
        log = np.tile(np.log([[1 - prior], [prior]]), (1, n))
        for k, j in parent.items():
            if j is None:
                log += np.log(single[:, k, :])[:, votes[:, k]]
                continue
            p = pair[min(j, k), max(j, k)]
            p = p if j < k else p.transpose(0, 2, 1)
            given = p / p.sum(2, keepdims=True)
            log += np.log(given)[:, votes[:, j], votes[:, k]]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        post = np.where(label >= 0, label, new)
        known = weight[label >= 0].sum()
        prior = float(np.clip((weight * post).sum() / weight.sum() if known else prior, 1e-4, 0.5))
    return {v: float(x) for (v, _, _), x in zip(counts, new, strict=True)}


def fit(rows: list[list[float]], target: list[float], penalty: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft labels, the last one the constant, by Newton."""
    x = np.column_stack([np.array(rows, float), np.ones(len(rows))])
    y, w = np.array(target, float), np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w
        )
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """``docs`` (doc_id, text and any columns but hits, times, votes and values) without text, with
    ``score`` in [0, 1].

    ``learn`` says which labels may be learned from, by doc_id. Every row gets a score of its own,
    repeated rows and rows without id too; a null or empty text holds no term and gets the score
    of that. Without labels of both kinds there are no terms, and every score is the prior.
    """
    good = labelled(labels, "toxic", learn)
    rates = good.agg(F.avg("label").alias("p"), F.count("*").alias("n")).collect()[0]
    prior = min(max(rates["p"] or 0.01, 1e-3), 0.5)
    sample = materialize(bounded_sample(good, SAMPLE), "toxicity_sample")
    texts = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    # The sample is bounded: SAMPLE ids and labels.
    held = texts.join(F.broadcast(sample), "doc_id")
    terms = mine_terms(materialize(held.select("text", "label"), "toxicity_texts"))
    plain = docs.withColumn("text", F.coalesce("text", F.lit("")))
    seen = map_texts(
        plain,
        "hits array<int>, times array<int>, votes string, values array<double>",
        lambda: partial(look, found_by=finder(terms)),
        per_task=True,
    )
    seen = materialize(seen, "toxicity_votes")
    # At most 3 to the number of voters, times 3, combinations over all documents.
    known = seen.select("doc_id", "votes").join(good, "doc_id", "left")
    counts = known.groupBy("votes", F.coalesce("label", F.lit(-1)).alias("label")).count()
    posterior = label_model([tuple(r) for r in counts.orderBy("votes", "label").collect()], prior)
    # At most SAMPLE rows of at most TERMS numbers.
    fields = ["hits", "times", "votes", "values"]
    rows = seen.select("doc_id", *fields).join(F.broadcast(sample), "doc_id").select(fields).collect()
    n = len(terms)
    if rows and terms:
        x = np.zeros((len(rows), n + VALUES))
        for k, r in enumerate(rows):
            x[k, r["hits"]] = np.log2(np.array(r["times"]) + 1)
            x[k, n:] = r["values"]
        weights = fit(x, [posterior[r["votes"]] for r in rows])
    else:
        weights = np.array([0.0] * (n + VALUES) + [math.log(prior / (1 - prior))])
    table = F.array(*[F.lit(float(x)) for x in weights[:n]]) if n else F.array(F.lit(0.0))
    total = F.aggregate(
        F.arrays_zip("hits", "times"),
        F.lit(float(weights[-1])),
        lambda s, x: s + table[x["hits"]] * F.log2(x["times"] + 1),
    )
    for k in range(VALUES):
        total = total + F.col("values")[k] * F.lit(float(weights[n + k]))
    return seen.withColumn("score", 1 / (1 + F.exp(-total))).drop(*fields)
