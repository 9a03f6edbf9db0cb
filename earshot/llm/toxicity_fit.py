"""How the field of problem 7 is learned from labels of documents."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from earshot.functions.text import plain_table
from earshot.llm.toxicity import _WORD, BOUND, Chains, Model, Tagger, features, tidy
from earshot.llm.toxicity_words import EXPLICIT
from earshot.session import cut

START = (-2.0, -2.0, -1.0, 0.5)  # moves and bias before learning
START_BIAS = -3.0
FADE = 0.5  # by this a run with label 1 gets less likely with each word that is unknown, so that long unknown texts count for nothing
# What begins with a weight: documents labelled 1 that hold it at least, and its log odds above that. Among the unexplained ones most labels are wrong, so more is asked.
FIRST_SEEDS, SEEDS = (3, 1.0), (5, 2.5)


def _log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """How much more documents labelled 1 hold something than those labelled 0."""
    return np.log((toxic + 0.05) / max(1, n_toxic)) - np.log((clean + 0.5) / max(1, n_clean))


def _by_documents(documents: np.ndarray, things: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents labelled 1, labelled 0) that hold each of n things."""
    pairs = np.unique(np.stack([documents, things], 1), axis=0)
    return np.bincount(pairs[:, 1], y[pairs[:, 0]], n), np.bincount(pairs[:, 1], ~y[pairs[:, 0]], n)


def telling_words(docs: list[tuple[str, int, int]], table: dict, least: int = 3, odds: float = 1.5) -> frozenset[str]:
    """The words, as written, that at least `least` documents labelled 1 hold and that tell for label 1."""
    toxic: Counter[str] = Counter()
    clean: Counter[str] = Counter()
    y = [a > b for _, a, b in docs]
    for (text, _, _), one in zip(docs, y, strict=True):
        (toxic if one else clean).update({w for w in _WORD.findall(tidy(text, table)) if w.isalpha()})
    some = [w for w, n in toxic.items() if n >= least]
    told = _log_odds(np.array([toxic[w] for w in some]), np.array([clean[w] for w in some]), sum(y), len(y) - sum(y))
    return frozenset(w for w, x in zip(some, told, strict=True) if x > odds)


def train(docs: list[tuple[str, int, int]], table: dict, *, error: float = 0.04, listed: frozenset[str] = frozenset(), rounds: int = 2, steps: int = 40, rate: float = 0.1, decay: float = 1.5, letters_decay: float = 3.0, plain_utterances: int = 20_000) -> Model:
    """The field fitted to (text, votes for label 1, votes for label 0).

    The labels are of documents and some are wrong, so the labels of tokens are hidden. A document is toxic if one of its tokens has label 1, which the field gives probability
    1 - P(all tokens 0); each vote tells this rightly but for the share `error`. The log likelihood of all votes is climbed by Adam: its gradient by a token is the expected label given the votes
    less the marginal. That learns emissions, pairs and moves alike, under Gaussian priors around 0 (`decay`; `letters_decay` for runs of letters), for the moves and the bias around START.
    No word list is needed; whether `listed` has a word (a trailing * stands for any ending) is one feature like others.
    Each of `rounds` rounds of `steps` steps begins by giving a weight to words and pairs that tell among the documents labelled 1 that the field doesn't explain yet (at first all): the log
    odds of documents that hold them. Few steps keep the field from learning wrong labels by heart. Utterances without a telling or listed word are alike to the field; of these every k-th
    in order of length stands for k, so that about `plain_utterances` are left. Without votes for both labels nothing can be learned, and the model calls nothing toxic."""
    docs = [d for d in docs if d[1] != d[2]]
    y = np.array([a > b for _, a, b in docs], bool)
    if not y.any() or y.all():
        return Model()
    votes = np.array([[a, b] for _, a, b in docs], float)
    log_right, log_wrong = np.log(1 - error), np.log(error)
    given_toxic, given_clean = np.exp(votes @ [log_right, log_wrong]), np.exp(votes @ [log_wrong, log_right])
    n_toxic, n_clean, n_docs = int(y.sum()), int((~y).sum()), len(docs)

    tagger = Tagger(Model(known=telling_words(docs, table), listed=listed), table)
    ids, starts = tagger.batch([t for t, _, _ in docs])
    words, n_types = tagger.words, len(tagger.words)
    numbers: dict[str, int] = {}
    number = np.array([numbers.setdefault(w.reading, len(numbers)) for w in words])  # of a type's reading
    readings, n_readings = list(numbers), len(numbers)
    names = [features(w) if i else [] for i, w in enumerate(words)]
    vocabulary = {f: i for i, f in enumerate(sorted({f for x in names for f in x}))}
    rows, cols = np.array([i for i, x in enumerate(names) for _ in x]), np.array([vocabulary[f] for x in names for f in x])
    n_features = len(vocabulary)

    firsts = np.flatnonzero(ids == BOUND)
    segment = np.cumsum(ids == BOUND) - 1
    doc_of = np.searchsorted(starts, firsts, side="right") - 1
    lengths = np.diff(np.append(firsts, len(ids))) - 1
    told = _by_documents(doc_of[segment], number[ids], y, n_readings)
    odds = np.where(told[0] >= 3, _log_odds(*told, n_toxic, n_clean), 0.0)
    odds[numbers[""]] = 0.0
    marks = (odds > 1)[number] | np.array([w.listed for w in words])
    plain = np.flatnonzero((np.add.reduceat(marks[ids].astype(int), firsts) == 0) & (lengths > 0))
    every = max(1, len(plain) // plain_utterances)
    stands = np.where(lengths > 0, 1.0, 0.0)
    stands[plain] = 0.0
    stands[plain[np.argsort(lengths[plain], kind="stable")][::every]] = every
    ids, doc_of, stands = np.append(ids[(stands > 0)[segment]], BOUND).astype(np.int32), doc_of[stands > 0], stands[stands > 0]

    chains = Chains(ids)
    inside = ids != BOUND
    chain_of_segment = np.zeros(len(stands) + 1, np.int64)
    chain_of_segment[chains.segment] = np.arange(len(chains.segment))
    chain_of = chain_of_segment[np.cumsum(~inside) - 1]
    doc, weight = doc_of[chains.segment], stands[chains.segment]
    word = number[ids]
    joined = inside[1:] & inside[:-1]
    keys, pair, often = np.unique(word[:-1][joined].astype(np.int64) * n_readings + word[1:][joined], return_inverse=True, return_counts=True)
    words_held, pairs_held = np.unique(np.stack([doc[chain_of[inside]], word[inside]], 1), axis=0), np.unique(np.stack([doc[chain_of[1:][joined]], pair], 1), axis=0)
    some = often[pair] >= 2
    paired, pair = np.flatnonzero(joined)[some] + 1, pair[some]  # a pair counts for its second word

    is_listed = np.array([w.listed for w in words])[ids] & inside
    own_of = np.array([vocabulary.get("w=" + r, -1) for r in readings])
    params = [np.zeros(n_features), np.zeros(n_readings), np.zeros(n_readings), np.zeros(len(keys)), np.array(START), np.array([START_BIAS])]
    runs = np.array([not f.startswith("w=") for f in vocabulary])
    few = np.array([f == "listed" for f in vocabulary])  # a weight that many words share: little is needed to learn it
    strength = [np.where(few, 0.1, np.where(runs, letters_decay, decay)), decay, decay, decay, 0.01, 0.01]
    prior = [0.0, 0.0, 0.0, 0.0, np.array(START), np.array([START_BIAS])]
    unexplained = y
    for step in range(rounds * steps):
        if step % steps == 0:
            for held, k, n, most in ((words_held, 0, n_readings, 3.0), (pairs_held, 3, len(keys), 2.0)):
                for_one, for_zero = np.bincount(held[:, 1], unexplained[held[:, 0]], n), np.bincount(held[:, 1], ~y[held[:, 0]], n)
                least, above = SEEDS if step else FIRST_SEEDS
                odds = np.where(for_one >= least, _log_odds(for_one, for_zero, int(unexplained.sum()), n_clean), 0.0)
                new = np.where(odds > above, np.minimum(most, odds), 0.0)
                if k:
                    params[k] = np.maximum(params[k], new)
                else:
                    some_words = own_of >= 0
                    params[k][own_of[some_words]] = np.maximum(params[k][own_of[some_words]], new[some_words])
            if "listed" in vocabulary:
                held = np.unique(doc[chain_of[is_listed]])
                one, zero = unexplained[held].sum(), (~y[held]).sum()
                weight_ = _log_odds(np.array([one]), np.array([zero]), int(unexplained.sum()), n_clean)[0]
                params[0][vocabulary["listed"]] = max(params[0][vocabulary["listed"]], min(4.0, weight_) if one >= least and weight_ > above else 0.0)
            m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        u = np.bincount(rows, params[0][cols], n_types)[ids] + params[5][0]
        u[1:] += np.where(inside[:-1], params[1][word[:-1]], 0.0)
        u[:-1] += np.where(inside[1:], params[2][word[1:]], 0.0)
        u[paired] += params[3][pair]
        p, total, moves = chains.run(u, params[4], moves=True)
        log_none = -np.bincount(doc, total * weight, n_docs)
        toxic = np.clip(-np.expm1(log_none), 1e-9, 1.0)
        unexplained = y & (toxic < 0.5)
        believed = given_toxic * toxic / (given_toxic * toxic + given_clean * np.exp(log_none))
        by_chain = (believed / toxic - 1)[doc] * weight  # expected label given the votes, less the marginal, is the marginal times this
        g = np.where(inside, p * by_chain[chain_of], 0.0)
        grads = [
            np.bincount(cols, np.bincount(ids, g, n_types)[rows], n_features), np.bincount(word[:-1], g[1:] * inside[:-1], n_readings), np.bincount(word[1:], g[:-1] * inside[1:], n_readings),
            np.bincount(pair, g[paired], len(keys)), by_chain @ moves, np.array([g.sum()]),
        ]
        for k, grad in enumerate(grads):
            grad = grad - strength[k] * (params[k] - prior[k])
            m[k], v[k] = 0.9 * m[k] + 0.1 * grad, 0.99 * v[k] + 0.01 * grad * grad
            params[k] = params[k] + rate * (m[k] / (1 - 0.9 ** (step % steps + 1))) / (np.sqrt(v[k] / (1 - 0.99 ** (step % steps + 1))) + 1e-6)
        params[4][3] = min(params[4][3], -params[5][0] - FADE)
    large = lambda x: np.flatnonzero(np.abs(x) > 1e-3)
    features_ = list(vocabulary)
    return Model(
        own={features_[i]: float(params[0][i]) for i in large(params[0])}, before={readings[i]: float(params[1][i]) for i in large(params[1])}, behind={readings[i]: float(params[2][i]) for i in large(params[2])},
        pair={(readings[keys[i] // n_readings], readings[keys[i] % n_readings]): float(params[3][i]) for i in large(params[3])},
        bias=float(params[5][0]), move=tuple(map(float, params[4])), known=tagger.model.known, listed=listed,
    )


# ---- over tables

def votes(labels: DataFrame, *, doc_id: str, label: str) -> DataFrame:
    """(_id, _a, _b): the votes for label 1 and label 0 of each document. Null ids and other labels than 0 and 1 are none."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    return known.groupBy(F.col(doc_id).cast("bigint").alias("_id")).agg(F.count_if(F.col(label) == 1).cast("int").alias("_a"), F.count_if(F.col(label) == 0).cast("int").alias("_b"))


def label_error(counted: DataFrame, least: int = 30, default: float = 0.04) -> float:
    """The share of wrong votes, by how often two votes on one document differ: they do so in 2 e (1 - e) of all cases. `default` with fewer than `least` documents of several votes."""
    n = F.col("_a") + F.col("_b")
    row = counted.where(n > 1).agg(F.count(F.lit(1)).alias("n"), F.avg(2 * F.col("_a") * F.col("_b") / (n * (n - 1))).alias("differ")).first()
    if row["n"] < least:
        return default
    return float(min(0.2, max(0.005, (1 - max(0.0, 1 - 2 * row["differ"]) ** 0.5) / 2)))


def labelled_sample(documents: DataFrame, labels: DataFrame, *, doc_id: str, text: str, label: str, most_toxic: int, most_clean: int, most_chars: int) -> tuple[list[tuple[str, int, int]], float]:
    """((text, votes for 1, votes for 0) of at most `most_toxic` and `most_clean` documents, the first by a hash, of at most `most_chars` characters in all; the share of wrong votes).

    Documents with as many votes for as against are left out, and so is a text that is longer than what is left of `most_chars`: none is cut."""
    counted = votes(labels, doc_id=doc_id, label=label)
    pick = lambda which, n: counted.where(which).orderBy(F.xxhash64("_id"), "_id").limit(n)
    chosen = cut(pick(F.col("_a") > F.col("_b"), most_toxic).unionByName(pick(F.col("_a") < F.col("_b"), most_clean)), "labels")
    texts = documents.select(F.col(doc_id).cast("bigint").alias("_key"), F.col(text).alias("_t")).where(F.length("_t") > 0)
    held = cut(texts.join(F.broadcast(chosen), F.col("_key") == F.col("_id")).select("_id", "_a", "_b", "_t"), "sample")  # most_toxic + most_clean rows at most
    # The rows of the sample by their lengths: as many as it has documents, and copies of these.
    sizes = held.groupBy("_id").agg(F.sum(F.length("_t")).alias("_n"))
    so_far = F.sum("_n").over(Window.orderBy(F.xxhash64("_id"), "_id").rowsBetween(Window.unboundedPreceding, 0))
    fits = sizes.where(F.col("_n") <= most_chars).withColumn("_sum", so_far).where(F.col("_sum") <= most_chars).select("_id")
    rows = held.join(F.broadcast(fits), "_id").collect()
    return [(r["_t"], r["_a"], r["_b"]) for r in sorted(rows, key=lambda r: (r["_id"], r["_t"]))], label_error(counted)


def fit(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most_toxic: int = 3000, most_clean: int = 7000, most_chars: int = 64_000_000, listed: frozenset[str] = EXPLICIT) -> Model:
    """The field fitted to a bounded sample of labelled documents. Without labels of both kinds it calls nothing toxic."""
    docs, error = labelled_sample(documents, labels, doc_id=doc_id, text=text, label=label, most_toxic=most_toxic, most_clean=most_clean, most_chars=most_chars)
    return train(docs, plain_table(), error=error, listed=listed)
