"""Toxicity by multiple-instance learning (operator 4).

A document is a bag of sentences. Each sentence has a logistic score; the
document is toxic unless no sentence is: P = 1 - prod(1 - p_s), the noisy-or.
Only documents bear labels, so the sentence weights are trained through it.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows

#: a document is rejected from this score on
THRESHOLD = 0.7
#: the classifier is fitted on about so many labelled documents, chosen by a hash of doc_id
MAX_TRAIN = 6000
#: at most so many features (the most frequent) have a weight, which bounds the model
MAX_FEATURES = 1 << 16
MIN_DOCS = 4
CACHE = 200_000
UNTRAINED = -30.0  # bias when no toxic document is known: every score is 0
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n (null as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % n


def word_features(w: str) -> list[str]:
    out = ["=" + w]
    if len(w) > 4:
        out += ["<" + w[:4], w[-4:] + ">"]
        if len(w) > 5:
            out.append("<" + w[:5])
    return out


def fit(texts: list[str], labels: list[int], rounds: int = 160) -> tuple[dict[str, float], float]:
    """Feature weights and bias that maximise the likelihood of document labels under the noisy-or.

    Weights are not negative: as a clean sentence can't make up for a toxic one,
    harmless words can't make up for an offending word of their sentence.
    """
    if not texts or len(set(labels)) < 2:
        return {}, 4.0 if sum(labels) else UNTRAINED
    index: dict[str, int] = {}
    words: dict[str, list[int]] = {}
    seen: list[int] = []  # documents that have a feature
    feats: list[int] = []
    sent_sizes: list[int] = []
    sents_of: list[int] = []
    for t in texts:
        in_doc: set[int] = set()
        n = 0
        for m in _SENTENCE.finditer(t):
            bag: set[int] = set()
            for w in set(_WORD.findall(m.group().lower())):
                ids = words.get(w)
                if ids is None:
                    ids = words[w] = [index.setdefault(f, len(index)) for f in word_features(w)]
                bag.update(ids)
            if len(index) > len(seen):
                seen.extend([0] * (len(index) - len(seen)))
            in_doc |= bag
            feats.extend(bag)
            sent_sizes.append(len(bag))
            n += 1
        for f in in_doc:
            seen[f] += 1
        sents_of.append(max(n, 1))
        if n == 0:
            sent_sizes.append(0)
    df = np.array(seen)
    kept = np.flatnonzero(df >= MIN_DOCS)
    kept = kept[np.argsort(-df[kept], kind="stable")][:MAX_FEATURES]
    to = np.full(len(df), -1, np.int32)
    to[kept] = np.arange(len(kept), dtype=np.int32)
    f = to[np.array(feats, np.int64)]
    s = np.repeat(np.arange(len(sent_sizes), dtype=np.int32), sent_sizes)
    f, s = f[f >= 0], s[f >= 0]
    doc = np.repeat(np.arange(len(texts)), sents_of)
    y = np.array(labels, float)
    w, b = np.zeros(len(kept)), -4.0
    mom, var = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    weight = np.where(y > 0, min(4.0, (1 - y).sum() / y.sum()), 1.0)
    for step in range(1, rounds + 1):
        z = np.bincount(s, w[f], len(doc)) + b
        p = 1 / (1 + np.exp(-z))
        clean = np.exp(-np.bincount(doc, np.logaddexp(0, z), len(texts)))  # P(no sentence is toxic)
        pull = np.where(y > 0, clean / np.maximum(1 - clean, 1e-9), -1.0) * weight
        g = pull[doc] * p  # gradient of the log likelihood by z
        grad = np.append(np.bincount(f, g[s], len(kept)), g.sum()) / len(texts)
        grad[:-1] -= 2e-5 * w
        mom = 0.9 * mom + 0.1 * grad
        var = 0.99 * var + 0.01 * grad * grad
        move = 0.15 * (mom / (1 - 0.9 ** step)) / (np.sqrt(var / (1 - 0.99 ** step)) + 1e-8)
        w = np.maximum(w + move[:-1], 0.0)
        b += move[-1]
    names = {i: n for n, i in index.items()}
    return {names[k]: float(x) for k, x in zip(kept.tolist(), w) if abs(x) > 1e-3}, float(b)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[dict[str, float], float]:
    """Fit on labelled documents of the training folds (fold 1 of 3 is held out).

    About ``max_train`` of them are used, chosen by a hash of doc_id; they are
    fitted in one task, and the model (at most MAX_FEATURES weights) comes to
    the driver. A doc_id labelled more than once counts as toxic if any of its
    labels says so. Rows with null label, doc_id or text teach nothing.
    """
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold(F.col("doc_id"), 3) != 1)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    share = min(1.0, max_train / max(known.count(), 1))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = (docs.where("doc_id IS NOT NULL AND text IS NOT NULL").where(chosen).where(fold(F.col("doc_id"), 3) != 1)
            .select("doc_id", "text").join(known.where(chosen), "doc_id"))

    def fit_all(batches):
        texts, ys = [], []
        for t, y in batches:
            texts += t
            ys += y
        weights, bias = fit(texts, ys)
        yield [["", *weights], [bias, *weights.values()]]

    # sorted, so that a rerun sums in the same order
    one = rows.select("text", "toxic", "doc_id").repartition(1).sortWithinPartitions("doc_id", "text").select("text", "toxic")
    model = {r["feature"]: r["weight"] for r in map_rows(one, "feature string, weight double", fit_all).collect()}
    bias = model.pop("", UNTRAINED)
    return model, bias


class Scorer:
    def __init__(self, model: dict[str, float], bias: float):
        self.model, self.bias, self.words = model, bias, {}

    def word(self, w: str) -> tuple[float, tuple[str, ...]]:
        """Sum of a word's weights, and the features that have one."""
        heavy = tuple([f for f in word_features(w) if f in self.model])
        x = self.words[w] = sum([self.model[f] for f in heavy]), heavy
        return x

    def score(self, text: str | None, locate: float = 0.5) -> tuple[float, list[dict]]:
        """Score of the document, and its sentences (first, end, score) that score ``locate`` or more.

        Offsets count code points. A feature counts once in a sentence, as in training.
        """
        words, get, weight = self.words, self.words.get, self.model
        total, spans = 0.0, []
        for m in _SENTENCE.finditer(text or ""):
            bag = set(_WORD.findall(m.group().lower()))
            z, bearing = self.bias, []
            for w in bag:
                x, heavy = get(w) or self.word(w)
                if heavy:
                    z += x
                    bearing.append(heavy)
            if len(bearing) > 1:
                features = {f for heavy in bearing for f in heavy}
                if len(features) < sum(map(len, bearing)):  # two words share a feature
                    z = self.bias + sum([weight[f] for f in features])
            if z > UNTRAINED:
                total += math.log1p(math.exp(z)) if z < 30 else z
                if z >= 0 and 1 / (1 + math.exp(-z)) >= locate:
                    spans.append({"first": m.start(), "end": m.end(), "score": 1 / (1 + math.exp(-z))})
        if len(words) > CACHE:
            words.clear()
        return 1 - math.exp(-total), spans


def score(docs: DataFrame, model: dict[str, float], bias: float, keep: list[str] | None = None) -> DataFrame:
    """``doc_id, text, score, offending``; null and empty texts have no sentence and score 0.

    Further columns named in ``keep`` come out as ``keep_<name>``.
    """
    cells = docs.select("doc_id", "text", *[F.col(c).alias(f"keep_{c}") for c in keep or [] if c not in ("doc_id", "text")])

    def work(batches):
        scorer = Scorer(model, bias)
        for columns in batches:
            found = [scorer.score(t) for t in columns[1]]
            yield [*columns, [x for x, _ in found], [x for _, x in found]]

    schema = ", ".join(f"`{c}` {kind}" for c, kind in cells.dtypes)
    return map_rows(cells, schema + ", score double, offending array<struct<first:int,end:int,score:double>>", work)


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted, offending`` for every row of ``docs(doc_id, text)``.

    Repeated rows come out repeatedly, an empty table gives an empty result;
    further columns are ignored.
    """
    out = score(docs.select("doc_id", "text"), *train(docs, labels, max_train))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
