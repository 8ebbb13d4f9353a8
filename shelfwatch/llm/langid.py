"""Language of words and documents by a linear-chain conditional random field (operator 9)."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows
from shelfwatch.llm.toxicity import fold

#: the field is fitted on about so many documents, chosen by a hash of doc_id
MAX_TRAIN = 3000
MAX_FEATURES = 1 << 16
SEQUENCES = 3000
LEXICON = 2000
CHUNK = 256
WORDS_AT_ONCE = 400_000
CACHE = 400_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


def word_features(w: str) -> list[str]:
    """Affixes and n-grams; lexicon features are added by the model."""
    b = f"<{w}>"
    return [b[:2], b[:3], b[:4], b[-2:], b[-3:], b[-4:], *{b[i:i + 2] for i in range(1, len(b) - 2)},
            *{b[i:i + 3] for i in range(1, len(b) - 3)}]


class Field:
    """Weights of a fitted field: ``rows`` per feature, ``move`` between languages, ``start``."""

    def __init__(self, langs: list[str], feats: list[str], rows: np.ndarray, move: np.ndarray, start: np.ndarray, lexicon: dict[str, list[int]]):
        self.langs, self.lexicon = langs, lexicon
        self.rows = {f: i for i, f in enumerate(feats)}
        self.weights = np.vstack([np.asarray(rows, float).reshape(-1, len(langs)), np.zeros(len(langs))])  # the last: no feature
        self.move, self.start = np.exp(move), np.exp(start - start.max())
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(langs)))

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission score per word and language; each different word is worked out once."""
        if len(self.index) > CACHE:
            self.index, self.table = {}, self.table[:0]
        index, get, none, lexicon = self.index, self.rows.get, len(self.rows), self.lexicon
        flat, starts = [], []
        for w in set(words).difference(index):
            index[w] = len(index)
            starts.append(len(flat))
            flat += [get(f, none) for f in word_features(w)]
            if w in lexicon:
                flat += [get(f"lex{i}", none) for i in lexicon[w]]
        if starts:
            self.table = np.vstack([self.table, np.add.reduceat(self.weights[flat], starts, axis=0)])
        return self.table[np.fromiter(map(index.__getitem__, words), np.int64, len(words))]


def marginals(scores: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Posterior of every language at every word by forward-backward."""
    return posteriors(scores, first, move, start)[0]


def posteriors(scores: np.ndarray, first: np.ndarray, move: np.ndarray, start: np.ndarray,
               pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of every language at every word, and (with ``pairs``) the expected number of each move, by forward-backward.

    A move's posterior is forward message x move x emission x backward message,
    summed here over all neighbouring words of a text.

    ``scores`` (words, languages) of many texts in a row, ``first`` marks where
    a text begins. The row of words is cut into chunks that advance together;
    what a chunk does to a message is a matrix, so messages are first passed
    from chunk to chunk and then inside all chunks at once. A text's first word
    takes nothing from the word before it, so cuts and lengths of texts don't matter.
    """
    n, k = scores.shape
    size = min(CHUNK, n)
    chunks = -(-n // size)
    psi = np.ones((chunks * size, k))
    psi[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    new = np.ones(chunks * size, bool)
    new[:n] = first
    psi, new = psi.reshape(chunks, size, k), new.reshape(chunks, size)
    step = np.broadcast_to(np.eye(k), (chunks, k, k)).copy()
    for t in range(size):
        fresh = step.sum(axis=2, keepdims=True) * start
        step = np.where(new[:, t, None, None], fresh, step @ move) * psi[:, t, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
    into, out_of = np.ones((chunks, k)), np.ones((chunks, k))
    for c in range(chunks - 1):
        v = into[c] @ step[c]
        into[c + 1] = v / v.sum()
    for c in range(chunks - 1, 0, -1):
        v = step[c] @ out_of[c]
        out_of[c - 1] = v / v.sum()
    post, before, moves = np.empty_like(psi), np.empty_like(psi) if pairs else None, np.zeros((k, k))
    a = into
    for t in range(size):
        if pairs:
            before[:, t] = a
        a = np.where(new[:, t, None], a.sum(axis=1, keepdims=True) * start, a @ move) * psi[:, t]
        a = a / a.sum(axis=1, keepdims=True)
        post[:, t] = a
    b = out_of
    for t in range(size - 1, -1, -1):
        post[:, t] *= b
        later = psi[:, t] * b
        if pairs:
            joint = before[:, t, :, None] * move * later[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            moves += joint[~new[:, t]].sum(axis=0)
        b = np.where(new[:, t, None], (later @ start)[:, None], later @ move.T)
        b = b / b.sum(axis=1, keepdims=True)
    post = post.reshape(-1, k)[:n]
    return post / post.sum(axis=1, keepdims=True), moves


def slopes(theta: list[np.ndarray], f: np.ndarray, at: np.ndarray, new: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradient of the log likelihood of the languages ``y``, per word, by feature weights, moves and starts.

    Word ``at[i]`` bears feature ``f[i]``; ``new`` marks where a text begins."""
    rows, start = theta[0], theta[2]
    n, (m, k) = len(y), rows.shape
    scores = np.stack([np.bincount(at, rows[f, j], n) for j in range(k)], axis=1)
    post, moves = posteriors(scores, new, np.exp(theta[1]), np.exp(start - start.max()), pairs=True)
    inner = ~new[1:]
    seen = np.bincount(y[:-1][inner] * k + y[1:][inner], minlength=k * k).reshape(k, k)
    miss = np.eye(k)[y] - post
    return [np.stack([np.bincount(f, miss[at, j], m) for j in range(k)], axis=1) / n, (seen - moves) / n, miss[new].sum(axis=0) / n]


def fit(texts: list[str], langs_of: list[str], rounds: int = 60, ridge: float = 1e-3, seed: int = 7) -> Field:
    """Fit on sequences put together from runs of words of documents of any language, so that moves between languages are learned."""
    langs = sorted(set(langs_of))
    docs = [(langs.index(g), ws) for t, g in zip(texts, langs_of) if (ws := words_of(t))]
    counts = [Counter() for _ in langs]
    for g, ws in docs:
        counts[g].update(ws)
    lexicon: dict[str, list[int]] = {}
    for g, c in enumerate(counts):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon.setdefault(w, []).append(g)
    k = len(langs)
    if not docs:
        return Field(langs or ["und"], [], np.zeros((0, max(k, 1))), np.zeros((max(k, 1),) * 2), np.zeros(max(k, 1)), {})
    rng = random.Random(seed)
    by = [[ws for g, ws in docs if g == i] for i in range(k)]
    present = [i for i in range(k) if by[i]]
    words, gold, first = [], [], []
    for _ in range(SEQUENCES):
        for part in range(rng.choice((1, 1, 2, 3))):
            g = rng.choice(present)
            ws = rng.choice(by[g])
            at, n = rng.randrange(len(ws)), rng.randint(4, 30)
            run = ws[at:at + n]
            first += [part == 0] + [False] * (len(run) - 1)
            words += run
            gold += [g] * len(run)
    index: dict[str, int] = {}
    cache: dict[str, list[int]] = {}
    flat, sizes = [], []
    for w in words:
        ids = cache.get(w)
        if ids is None:
            ids = cache[w] = [index.setdefault(f, len(index)) for f in (*word_features(w), *[f"lex{i}" for i in lexicon.get(w, ())])]
        flat += ids
        sizes.append(len(ids))
    f = np.array(flat, np.int64)
    common = np.argsort(-np.bincount(f, minlength=len(index)), kind="stable")[:MAX_FEATURES]
    to = np.full(len(index), -1, np.int64)
    to[common] = np.arange(len(common))
    at = np.repeat(np.arange(len(words)), sizes)
    f, at = to[f], at[to[f] >= 0]
    f = f[f >= 0]
    new, y = np.array(first), np.array(gold)
    theta = [np.zeros((len(common), k)), np.zeros((k, k)), np.zeros(k)]
    mom, var = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for r in range(1, rounds + 1):
        grads = [g - ridge * t for g, t in zip(slopes(theta, f, at, new, y), theta)]
        for i, g in enumerate(grads):
            mom[i] = 0.9 * mom[i] + 0.1 * g
            var[i] = 0.99 * var[i] + 0.01 * g * g
            theta[i] = theta[i] + 0.1 * (mom[i] / (1 - 0.9 ** r)) / (np.sqrt(var[i] / (1 - 0.99 ** r)) + 1e-10)
    names = {i: n for n, i in index.items()}
    return Field(langs, [names[i] for i in common.tolist()], theta[0], theta[1], theta[2], lexicon)


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> Field:
    """Fit on about ``max_train`` documents of the training folds (fold 2 of 4 is held out) with known language, in one task."""
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(fold(F.col("doc_id"), 4) != 2)
    share = min(1.0, max_train / max(usable.select("doc_id").count(), 1))
    rows = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("doc_id", "text", "lang")

    def fit_all(batches):
        import pickle
        texts, langs = [], []
        for t, g in batches:
            texts += t
            langs += g
        field = fit(texts, langs)
        yield [[pickle.dumps((field.langs, list(field.rows), field.weights[:-1].astype(np.float32), np.log(field.move),
                              np.log(field.start), field.lexicon))]]

    import pickle
    one = rows.repartition(1).sortWithinPartitions("doc_id", "text", "lang").select("text", "lang")
    got = map_rows(one, "model binary", fit_all).collect()  # at most MAX_FEATURES weights per language
    return Field(*pickle.loads(bytes(got[0]["model"]))) if got else fit([], [])


def predict(docs: DataFrame, field: Field, segments: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, words`` and, if asked for, ``segments``: runs of words of one language.

    The language of a text is the one with most letters, each word's letters
    shared out by its posterior; score is its share. Null texts and texts
    without letters are ``und`` with score 0.
    """
    def flush(texts, field):
        starts = np.cumsum([0, *map(len, texts)])
        flat = [w for ws in texts for w in ws]
        if not flat:
            return [("und", 0.0, 0, [])] * len(texts)
        first = np.zeros(len(flat) + 1, bool)
        first[starts] = True
        post = marginals(field.scores(flat), first[:-1], field.move, field.start)
        best = post.argmax(axis=1) if segments else None
        mass = np.vstack([np.zeros(post.shape[1]), np.cumsum(post * np.fromiter(map(len, flat), float, len(flat))[:, None], axis=0)])
        mass = mass[starts[1:]] - mass[starts[:-1]]
        out = []
        for ws, m, s in zip(texts, mass, starts):
            if not ws:
                out.append(("und", 0.0, 0, []))
                continue
            runs = []
            if segments:
                y = best[s:s + len(ws)]
                cut = [0, *(np.flatnonzero(np.diff(y)) + 1).tolist(), len(ws)]
                runs = [{"first": a, "end": b, "lang": field.langs[y[a]]} for a, b in zip(cut, cut[1:])]
            j = int(m.argmax())
            out.append((field.langs[j], min(1.0, float(m[j] / m.sum())), len(ws), runs))
        return out

    def work(batches):
        for ids, texts in batches:
            at = 0
            while at < len(ids):  # bounded pieces of a batch, whole texts each
                group, n = [], 0
                while at + len(group) < len(ids) and (not group or n < WORDS_AT_ONCE):
                    group.append(words_of(texts[at + len(group)]))
                    n += len(group[-1])
                found = flush(group, field)
                yield [ids[at:at + len(group)], *[list(c) for c in zip(*found)]]
                at += len(group)

    out = map_rows(docs.select("doc_id", "text"),
                   "doc_id bigint, lang_pred string, score double, words bigint, segments array<struct<first:int,end:int,lang:string>>", work)
    return out if segments else out.drop("segments")


def languages(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, words`` for every row of ``docs(doc_id, text, lang)``.

    Repeated rows come out repeatedly, an empty table gives an empty result;
    further columns are ignored.
    """
    out = predict(docs, train(docs, max_train))
    return out.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "words")
