"""Language of each word and text by a linear-chain conditional random field.

Words are observed through hashed affixes, character n-grams and a lexicon of the
words met in training; learned transitions tie neighbours together, so a text
may switch language within a line. A text's language is the one its words most
probably are in, by forward-backward over the whole text as one chain.

The chain is worked out in pieces of equal length, many at a time: each piece is
first reduced to the matrix that carries a message across it, messages then pass
from piece to piece in both directions, and last every piece is filled in between
the two that reach it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.llm.common import held_out, text_batches
from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

UNKNOWN = "und"


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and of the optimisation."""

    texts: int = 600  # labelled texts, at most
    longest: int = 20_000  # characters; longer texts are not trained on
    chain: int = 32  # words of a training chain; texts are labelled as one chain of any length
    mixed: float = 0.3  # share of training chains whose second half is another text's
    buckets: int = 1 << 15
    lexicon: int = 4000  # words with a weight of their own, at most
    steps: int = 40
    rate: float = 0.15
    decay: float = 1e-3
    seed: int = 3


def _hash(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def features(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Word number and feature number of every affix (1 to 3) and n-gram (2, 3) of the words."""
    rows, found = [], []
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        width = max(4, 1 << int(lengths[order[at]]).bit_length())
        end = at + int(np.searchsorted(lengths[order[at:]], width, side="right"))
        end = min(end, at + max(1, (1 << 20) // width))
        part = order[at:end]
        codes = np.array([words[i] for i in part], f"U{width}").view(np.uint32).reshape(len(part), width)
        codes, n = codes.astype(np.uint64), lengths[part]
        edge = np.uint64(1)
        back = np.take_along_axis(codes, np.maximum(n[:, None] - 1 - np.arange(3), 0), axis=1)
        ahead = behind = np.zeros(len(part), np.uint64)
        for k in range(3):
            ok = np.flatnonzero(n > k)
            ahead = _hash(ahead * np.uint64(31) + codes[:, k], 11 + k)
            behind = _hash(behind * np.uint64(31) + back[:, k], 21 + k)
            rows += [part[ok], part[ok]]
            found += [ahead[ok], behind[ok]]
        padded = np.concatenate([np.full((len(part), 1), edge), codes, np.zeros((len(part), 2), np.uint64)], axis=1)
        np.put_along_axis(padded, n[:, None] + 1, edge, axis=1)
        for size in (2, 3):
            gram = np.zeros((len(part), width + 1), np.uint64)
            for k in range(size):
                gram = _hash(gram * np.uint64(31) + padded[:, k : k + width + 1], 30 + size)
            r, c = np.nonzero(np.arange(width + 1)[None, :] <= (n + 2 - size)[:, None])
            rows.append(part[r])
            found.append(gram[r, c])
        at = end
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    number = (np.concatenate(found) >> np.uint64(20)) % np.uint64(buckets)
    return np.concatenate(rows), number.astype(np.int64)


def _evidence(emit: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each word says of each label, 1 beyond the end, and which words there are."""
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    inside = np.arange(emit.shape[1])[None, :] < length[:, None]
    e[~inside] = 1.0
    return e, inside


def forward_backward(
    emit: np.ndarray, length: np.ndarray, move: np.ndarray, start: np.ndarray, beyond: np.ndarray | None = None
):
    """Posteriors (chains, steps, labels) and, for training, expected transitions.

    ``start`` is one row for all chains or one for each. ``beyond`` is what follows
    the end of each chain and says of its last label, nothing by default.
    """
    steps = emit.shape[1]
    e, inside = _evidence(emit, length)
    t = np.exp(move)
    ahead = np.empty_like(e)
    ahead[:, 0] = np.exp(start) * e[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for k in range(1, steps):
        a = (ahead[:, k - 1] @ t) * e[:, k]
        a = np.where(inside[:, k, None], a, ahead[:, k - 1])
        ahead[:, k] = a / a.sum(axis=1, keepdims=True)
    behind = np.ones_like(e)
    if beyond is not None:
        behind[:, -1] = beyond
    for k in range(steps - 2, -1, -1):
        b = (behind[:, k + 1] * e[:, k + 1]) @ t.T
        b = np.where(inside[:, k + 1, None], b, behind[:, k + 1])
        behind[:, k] = b / b.sum(axis=1, keepdims=True)
    after = ahead * behind
    after /= after.sum(axis=2, keepdims=True)
    return after, (ahead, behind * e, inside, t)


def crossings(emit: np.ndarray, length: np.ndarray, move: np.ndarray) -> np.ndarray:
    """For each piece the matrix from what arrives at its first word to what leaves its last, up to a factor."""
    e, inside = _evidence(emit, length)
    t = np.exp(move)
    out = e[:, 0, :, None] * np.eye(emit.shape[2])
    for k in range(1, emit.shape[1]):
        here = np.flatnonzero(inside[:, k])
        x = (out[here] @ t) * e[here, k, None, :]
        out[here] = x / x.sum(axis=(1, 2), keepdims=True)
    return out


def messages(cross: np.ndarray, pieces: np.ndarray, move: np.ndarray, start: np.ndarray):
    """For each piece what arrives from its text's words before and from those behind.

    The pieces of a text stand side by side, ``pieces`` of them. Texts move along
    together, one piece a step.
    """
    t = np.exp(move)
    before = np.empty(cross.shape[:2])
    behind = np.ones(cross.shape[:2])
    order = np.argsort(-pieces, kind="stable")
    first = (np.cumsum(pieces) - pieces)[order]
    live = np.searchsorted(-pieces[order], -np.arange(1, int(pieces.max(initial=0)) + 1), side="right")
    before[first[: live[0]] if len(live) else first[:0]] = np.exp(start - start.max())
    for k in range(1, len(live)):
        at = first[: live[k]] + k
        x = (before[at - 1][:, None, :] @ cross[at - 1])[:, 0] @ t
        before[at] = x / x.sum(axis=1, keepdims=True)
    for k in range(len(live) - 1, 0, -1):
        at = first[: live[k]] + k
        x = (cross[at] @ behind[at][:, :, None])[:, :, 0] @ t.T
        behind[at - 1] = x / x.sum(axis=1, keepdims=True)
    return before, behind


def _expected_moves(parts) -> np.ndarray:
    ahead, behind, inside, t = parts
    x, y = ahead[:, :-1], behind[:, 1:]
    pair = x[..., :, None] * t * y[..., None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return pair[inside[:, 1:]].sum(axis=0)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (buckets + lexicon, labels)
    lexicon: dict[str, int]
    move: np.ndarray
    start: np.ndarray
    buckets: int
    chain: int

    def emissions(self, words: list[str]) -> np.ndarray:
        rows, found = features(words, self.buckets)
        known = [(i, self.buckets + self.lexicon[w]) for i, w in enumerate(words) if w in self.lexicon]
        if known:
            extra = np.array(known)
            rows, found = np.append(rows, extra[:, 0]), np.append(found, extra[:, 1])
        out = np.empty((len(words), len(self.labels)))
        for k in range(len(self.labels)):
            out[:, k] = np.bincount(rows, self.weights[found, k], len(words))
        return out


class Labeller:
    """Word posteriors of texts; emissions of words are remembered up to a bound."""

    def __init__(self, model: Model, remembered: int = 200_000):
        self.model, self.remembered = model, remembered
        self.known: dict[str, int] = {}
        self.table = np.empty((0, len(model.labels)))

    def _numbers(self, texts: list[list[str]]) -> list[np.ndarray]:
        fresh = list(dict.fromkeys(w for t in texts for w in t if w not in self.known))
        if len(self.known) + len(fresh) > self.remembered:
            self.known, self.table = {}, self.table[:0]
            fresh = list(dict.fromkeys(w for t in texts for w in t))
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.table = np.concatenate([self.table, self.model.emissions(fresh)])
        get = self.known.__getitem__
        return [np.fromiter(map(get, t), np.int64, len(t)) for t in texts]

    def _pieces(self, texts: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Text number, word number over all texts and posteriors of every word, some pieces at a time."""
        m = self.model
        labels = len(m.labels)
        width = max(m.chain, 4 * labels)  # so that crossings weigh less than emissions
        numbers = self._numbers(texts)
        flat = np.concatenate([np.empty(0, np.int64), *numbers])
        lengths = np.array([len(x) for x in numbers], np.int64)
        pieces = -(-lengths // width)
        own = np.repeat(np.arange(len(texts)), pieces)
        within = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = (np.cumsum(lengths) - lengths)[own] + within * width
        size = np.minimum(width, lengths[own] - within * width)

        def emit(at: np.ndarray):
            inside = np.arange(width)[None, :] < size[at, None]
            place = begin[at, None] + np.arange(width)[None, :]
            return self.table[flat[np.where(inside, place, begin[at, None])]], place, inside

        step = max(1, (1 << 20) // (width * labels))
        cross = np.empty((len(own), labels, labels))
        several = np.flatnonzero(pieces[own] > 1)
        for at in np.split(several, range(step, len(several), step)):
            if len(at):
                cross[at] = crossings(emit(at)[0], size[at], m.move)
        before, behind = messages(cross, pieces, m.move, m.start)
        with np.errstate(divide="ignore"):
            before = np.log(before)
        for i in range(0, len(own), step):
            at = np.arange(i, min(i + step, len(own)))
            e, place, inside = emit(at)
            after, _ = forward_backward(e, size[at], m.move, before[at], behind[at])
            yield np.repeat(own[at], size[at]), place[inside], after[inside]

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text, given as words, the probability of each label for each word."""
        lengths = [len(t) for t in texts]
        out = np.empty((sum(lengths), len(self.model.labels)))
        for _, place, after in self._pieces(texts):
            out[place] = after
        return np.split(out, np.cumsum(lengths)[:-1]) if lengths else []

    def means(self, texts: list[list[str]]) -> np.ndarray:
        """For each text the mean over its words of the probability of each label; zeros without words."""
        out = np.zeros((len(texts), len(self.model.labels)))
        for own, _, after in self._pieces(texts):
            for k in range(out.shape[1]):
                out[:, k] += np.bincount(own, after[:, k], len(texts))
        return out / np.maximum([[len(t)] for t in texts], 1) if texts else out


def words_of(text: str | None) -> list[str]:
    """The words that hold a letter, in lower case."""
    return [w for w in (text or "").lower().split() if not w.isascii() and any(map(str.isalpha, w)) or w.isascii() and w.upper() != w]


def train(docs: DataFrame, fit: Fit = Fit()) -> Model | None:
    """Fit on texts with a language whose crc32(doc_id) mod 5 is not 0; None without any.

    The sample is bounded (``fit``) and chosen by a hash of doc_id, evenly over languages; it is
    the same for every layout of the rows.
    """
    learn = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    counts = {r["lang"]: r["count"] for r in learn.groupBy("lang").count().collect()}
    if not counts:
        return None
    most = -(-fit.texts // len(counts))
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, int(1_000_000 * min(1.0, 2 * most / n))).otherwise(share)
    picked = (
        learn.where((F.length("text") <= fit.longest) & (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share))
        .select(F.xxhash64("doc_id").alias("k"), "lang", "text")
        .orderBy("k", "lang", F.xxhash64("text"))
        .limit(4 * fit.texts + 4 * len(counts))
        .toArrow()
        .sort_by([("k", "ascending"), ("lang", "ascending"), ("text", "ascending")])
    )
    labels = sorted(counts)
    taken = dict.fromkeys(labels, 0)
    texts, tags = [], []
    for lang, text in zip(picked.column("lang").to_pylist(), picked.column("text").to_pylist()):
        words = words_of(text)
        if words and taken[lang] < most:
            taken[lang] += 1
            texts.append(words)
            tags.append(labels.index(lang))
    return descend(texts, tags, labels, fit) if texts else None


def _chains(texts, tags, fit: Fit, rng) -> tuple[list[list[str]], list[list[int]]]:
    """Training chains; some take their second half from another text, as code-switching does."""
    parts = [(t[i : i + fit.chain], g) for t, g in zip(texts, tags) for i in range(0, len(t), fit.chain)]
    words, truth = [], []
    for w, g in parts:
        if rng.random() < fit.mixed:
            v, h = parts[rng.integers(len(parts))]
            a, b = w[: len(w) // 2], v[: fit.chain // 2]
            words.append(a + b)
            truth.append([g] * len(a) + [h] * len(b))
        else:
            words.append(w)
            truth.append([g] * len(w))
    return words, truth


def descend(texts, tags, labels: list[str], fit: Fit) -> Model:
    """Weights of greatest likelihood, by Adam on all chains."""
    rng = np.random.default_rng(fit.seed)
    chains, truth = _chains(texts, tags, fit, rng)
    times: dict[str, int] = {}
    for c in chains:
        for w in c:
            times[w] = times.get(w, 0) + 1
    words = list(times)
    number = {w: i for i, w in enumerate(words)}
    common = sorted((w for w in words if times[w] >= 3), key=lambda w: (-times[w], w))[: fit.lexicon]
    n = len(labels)
    model = Model(
        labels, np.zeros((fit.buckets + len(common), n)), {w: i for i, w in enumerate(common)},
        np.zeros((n, n)), np.zeros(n), fit.buckets, fit.chain,
    )
    rows, found = features(words, fit.buckets)
    rows = np.append(rows, [number[w] for w in common]).astype(np.int64)
    found = np.append(found, fit.buckets + np.arange(len(common))).astype(np.int64)
    length = np.array([len(c) for c in chains])
    at = np.zeros((len(chains), fit.chain), np.int64)
    tag = np.zeros((len(chains), fit.chain), np.int64)
    for i, (c, g) in enumerate(zip(chains, truth)):
        at[i, : len(c)] = [number[w] for w in c]
        tag[i, : len(g)] = g
    inside = np.arange(fit.chain)[None, :] < length[:, None]
    sure = np.eye(n)[tag]
    seen_moves = np.zeros((n, n))
    np.add.at(seen_moves, (tag[:, :-1][inside[:, 1:]], tag[:, 1:][inside[:, 1:]]), 1)
    total = inside.sum()
    state = [(x, np.zeros_like(x), np.zeros_like(x)) for x in (model.weights, model.move, model.start)]
    for step in range(1, fit.steps + 1):
        emit = np.stack(
            [np.bincount(rows, model.weights[found, k], len(words)) for k in range(n)], axis=1
        )
        after, parts = forward_backward(emit[at], length, model.move, model.start)
        off = (after - sure)[inside]
        by_word = np.stack([np.bincount(at[inside], off[:, k], len(words)) for k in range(n)], axis=1)
        slope = np.stack(
            [np.bincount(found, by_word[rows, k], len(model.weights)) for k in range(n)], axis=1
        )
        slopes = (slope / total, (_expected_moves(parts) - seen_moves) / total, (after[:, 0] - sure[:, 0]).mean(axis=0))
        for (x, m, v), g in zip(state, slopes):
            g = g + fit.decay * x / total
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= fit.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return model


def predict(docs: DataFrame, model: Model | None, lang: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """``docs`` with the columns ``lang`` and ``score``: the language most words of the text are in.

    ``score`` is the mean probability of that language over the words. Texts that
    are null or hold no letter are ``und`` with score 0; ties go to the first label
    by name. Columns of these names are replaced; all others and all rows stay.
    Repeated rows are labelled alike, an empty table gives an empty one, and of a
    long text only the words and messages between its pieces are held at once.
    """
    docs = docs.drop(lang, score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model else None
        for batch in text_batches(batches, 1 << 20):
            texts = [words_of(t.as_py()) for t in batch.column("text")]
            names, scores = [], []
            means = labeller.means(texts) if labeller else texts
            for words, mean in zip(texts, means):
                if labeller and words:
                    names.append(model.labels[int(mean.argmax())])
                    scores.append(float(min(1.0, mean.max())))
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, lang, score],
            )

    schema = T.StructType(
        [*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)
