"""Toxicity from subword bags.

A text in lower case is cut into words of letters and digits.  A word is the bag
of its hashed character n-grams (``SHORTEST`` to ``LONGEST``, with marks at both
ends) and of itself, so that a misspelling nobody learned shares most of its
n-grams with the word.  The embeddings of all n-grams of a passage are averaged
and go into a linear softmax; embeddings and softmax are trained jointly, by
mini-batch descent in numpy, on passages of a bounded sample of labelled documents
(see ``trained``).  The softmax is linear, so at scoring time every n-gram stands
for one number, its embedding times the difference of the two outputs.

A text is scored whole, in passages of ``PASSAGE`` words that overlap by half: its
evidence is that of its most toxic passage, which a long clean text around it
cannot water down.  A logistic curve over the evidence, fitted on learned
documents that no passage was drawn from, gives the score.

Null and empty texts and texts without a word are one empty passage, which scores
low where most labels are 0.  Without labels of both kinds every text gets the
share of label 1, or 0.5 without any label.  Ids labelled both ways count as toxic;
null ids and labels are not learned from.  Rows are scored independently and
repeated rows alike; nothing is shuffled for scoring, an empty table gives no rows,
and a lost executor costs its own tasks.  Other columns pass through; columns of a
result's name are replaced.

Fitting takes at most ``PER_LABEL`` documents of each label (those of the smallest
hash, found by a top-k that combines within tasks).  Three quarters teach with at
most ``PASSAGES`` passages each, of which ``PASSAGE_CHARS`` characters are read; a
quarter calibrates, whole.  The driver holds those passages and ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycast.llm.words import Words, mixed, row_slices, words_of

PER_LABEL = 2000
PASSAGES = 100
PASSAGE_CHARS = 512
PASSAGE = 4
SHORTEST, LONGEST = 3, 5
BUCKETS = 1 << 18
DIMENSIONS = 10
EPOCHS = 3
ROUNDS = 4
BATCH = 256
STEP = 0.1
DECAY = 1e-3
LEAST_DOCS = 6
SEED = 12


@dataclass(frozen=True)
class ToxicityModel:
    """One number per n-gram bucket, the softmax offset, and the curve (slope, offset)."""

    weights: np.ndarray
    offset: float
    curve: tuple[float, float]


def cleaned(text: Column) -> Column:
    """A text in lower case with one space for whatever is no letter or digit."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram and whole word, and the word each belongs to."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer("".join(f"<{word}>" for word in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    size = np.array([len(word) + 2 for word in words])
    owner = np.repeat(np.arange(len(words)), size)
    key = np.zeros(len(codes), dtype=np.uint64)
    places, owners = [], []
    for n in range(1, LONGEST + 1):
        key = key[:len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1:] + np.uint64(n)
        if n >= SHORTEST:
            inside = owner[:len(key)] == owner[n - 1:]
            places.append(mixed(key[inside]))
            owners.append(owner[:len(key)][inside])
    place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
    whole = np.add.reduceat((codes + np.uint64(7)) * mixed(place.astype(np.uint64) + np.uint64(1)), np.cumsum(size) - size)
    places.append(mixed(whole))
    owners.append(np.arange(len(words)))
    return (np.concatenate(places) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


class Softmax:
    """Embeddings of ``width`` n-grams, the two outputs over them and their offsets,
    with the squared gradients so far (one per embedding), which shorten the steps."""

    def __init__(self, width: int, random: np.random.Generator) -> None:
        self.random = random
        self.embeddings = random.uniform(-1, 1, (width, DIMENSIONS)) / DIMENSIONS
        self.outputs, self.offsets = np.zeros((DIMENSIONS, 2)), np.zeros(2)
        self.seen = [np.full((width, 1), 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)]

    def folded(self) -> tuple[np.ndarray, float]:
        """The odds of label 1 per n-gram, and their offset."""
        return self.embeddings @ (self.outputs[:, 1] - self.outputs[:, 0]), float(self.offsets[1] - self.offsets[0])

    def descend(self, bags: list[tuple[np.ndarray, int]], labels: np.ndarray, step: float) -> None:
        """One pass over bags (n-grams and size) in random order; both labels weigh alike."""
        own = 0.5 * len(labels) / np.maximum(np.bincount(labels, minlength=2), 1)
        order, place = self.random.permutation(len(bags)), np.zeros(len(self.embeddings), np.int64)
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            flat = np.concatenate([bags[one][0] for one in chosen])
            place[flat] = 1
            ids = np.flatnonzero(place)
            place[ids] = np.arange(len(ids))
            row = np.repeat(np.arange(len(chosen)), [len(bags[one][0]) for one in chosen])
            share = np.bincount(row * len(ids) + place[flat], minlength=len(chosen) * len(ids)).reshape(
                len(chosen), len(ids)) / np.array([max(bags[one][1], 1) for one in chosen])[:, None]
            place[ids] = 0
            mean = share @ self.embeddings[ids]
            value = mean @ self.outputs + self.offsets
            odds = np.exp(value - value.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error *= own[labels[chosen]][:, None] / len(chosen)
            slopes = [share.T @ (error @ self.outputs.T), mean.T @ error, error.sum(axis=0)]
            self.seen[0][ids] += (slopes[0] ** 2).mean(axis=1, keepdims=True)
            self.embeddings[ids] -= step * (slopes[0] / np.sqrt(self.seen[0][ids]) + DECAY * self.embeddings[ids])
            for held, slope, seen in zip((self.outputs, self.offsets), slopes[1:], self.seen[1:]):
                seen += slope ** 2
                held -= step * slope / np.sqrt(seen)


class Passages:
    """Passages of teaching documents as places in a vocabulary of their words.

    N-grams of fewer than ``LEAST_DOCS`` documents are not learned; they count for
    the size of a bag alone.
    """

    def __init__(self, texts: list[str], doc: np.ndarray) -> None:
        place: dict[str, int] = {}
        self.words = [np.array([place.setdefault(word, len(place)) for word in text.split()], np.int64) for text in texts]
        self.doc = doc
        buckets, owner = grams(list(place))
        self.sizes = np.bincount(owner, minlength=len(place))
        # Documents of a word, then of a bucket; a document counts once for each bucket.
        held = np.unique(np.concatenate([words + len(place) * own for words, own in zip(self.words, doc.tolist())]))
        order = np.argsort(owner, kind="stable")
        buckets, first = buckets[order], np.concatenate([[0], np.cumsum(self.sizes)])
        docs = np.zeros(BUCKETS, np.int64)
        for own in np.split(held, np.flatnonzero(np.diff(held // len(place))) + 1):
            docs[np.unique(buckets[_ranges(first, own % len(place))])] += 1
        self.kept = np.flatnonzero(docs >= LEAST_DOCS)
        self.compact = np.full(BUCKETS, -1)
        self.compact[self.kept] = np.arange(len(self.kept))
        learned = self.compact[buckets] >= 0
        self.grams = self.compact[buckets[learned]]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(owner[order][learned], minlength=len(place)))])

    def bag(self, numbers: np.ndarray) -> tuple[np.ndarray, int]:
        """N-grams and size of some passages together."""
        words = np.concatenate([self.words[one] for one in numbers])
        return self.grams[_ranges(self.first, words)], int(self.sizes[words].sum())

    def most_toxic(self, weights: np.ndarray, offset: float) -> tuple[np.ndarray, np.ndarray]:
        """Number and value of the passage of the largest value of each document, in their order."""
        sums = np.diff(np.concatenate([[0.0], np.cumsum(weights[self.grams])])[self.first])
        value = np.array([sums[words].sum() / max(self.sizes[words].sum(), 1) for words in self.words]) + offset
        order = np.lexsort((value, self.doc))
        last = np.append(np.flatnonzero(np.diff(self.doc[order])), len(order) - 1)
        return order[last], value[order[last]]


def _ranges(first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """All places of the runs ``first[k]`` to ``first[k + 1]`` of the chosen k."""
    size = first[chosen + 1] - first[chosen]
    return np.repeat(first[chosen] - np.cumsum(size) + size, size) + np.arange(size.sum())


def trained(passages: Passages, labels: np.ndarray, *, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights per bucket and offset; ``labels`` has the label of each document.

    Two models begin with whole documents, one half each.  In every round each
    names the most toxic passage of the documents it does not learn from, so that
    none can learn a label by heart, and the other goes on with those passages:
    of toxic documents the present one, unless it looks clean (the label has no
    visible reason), of clean ones those of all rounds.  The model returned learns
    from the passages named last.
    """
    random = np.random.default_rng(seed)
    half = random.permutation(len(labels)) % 2
    models = [Softmax(len(passages.kept), random) for _ in range(2)]
    bags = [passages.bag(np.array([one])) for one in range(len(passages.words))]
    for own, model in enumerate(models):
        number = np.flatnonzero(half[passages.doc] == own)
        for _ in range(2):
            model.descend([bags[one] for one in number], labels[passages.doc[number]], STEP)
    clean: set[int] = set()
    toxic = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        named = [passages.most_toxic(*model.folded()) for model in models]
        number, value = (np.where(half == 0, second, first) for first, second in zip(*named))
        clean.update(number[labels == 0].tolist())
        toxic = number[(labels == 1) & (value > 0)]
        for own, model in enumerate(models):
            _taught(model, passages, [one for one in toxic.tolist() if half[passages.doc[one]] == own],
                    [one for one in sorted(clean) if half[passages.doc[one]] == own])
    last = Softmax(len(passages.kept), random)
    _taught(last, passages, toxic.tolist(), sorted(clean), 2)
    weights, offset = last.folded()
    out = np.zeros(BUCKETS)
    out[passages.kept] = weights
    return out, offset


def _taught(model: Softmax, passages: Passages, toxic: list[int], clean: list[int], times: int = 1) -> None:
    """The model after some epochs over given passages, if there are both kinds."""
    if toxic and clean:
        bags = [passages.bag(np.array([one])) for one in (*toxic, *clean)]
        for _ in range(times * EPOCHS):
            model.descend(bags, np.array([1] * len(toxic) + [0] * len(clean)), STEP)


class Scorer:
    """Evidence of texts; words already seen keep their sums until ``CACHE`` is reached."""

    CACHE = 200_000

    def __init__(self, weights: np.ndarray, offset: float) -> None:
        self.weights, self.offset = weights, offset
        self.known = np.zeros(0, np.uint64)
        self.sums, self.counts = np.zeros(0), np.zeros(0)

    def _of_words(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Sum of weights and number of n-grams of every word."""
        unique, first, inverse = np.unique(words.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, unique)
        new = np.ones(len(unique), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != unique[inside]
        if new.any():
            raw = words.data.tobytes()
            buckets, owner = grams([raw[words.start[k]:words.end[k]].decode() for k in first[new]])
            sums = np.bincount(owner, self.weights[buckets], minlength=int(new.sum()))
            counts = np.bincount(owner, minlength=int(new.sum())).astype(float)
            if len(self.known) > self.CACHE:
                self.known, self.sums, self.counts = self.known[:0], self.sums[:0], self.counts[:0]
                return self._of_words(words)
            both = np.concatenate([self.known, unique[new]])
            order = np.argsort(both)
            self.known = both[order]
            self.sums = np.concatenate([self.sums, sums])[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            place = np.searchsorted(self.known, unique)
        return self.sums[place][inverse], self.counts[place][inverse]

    def evidence(self, column: pa.Array) -> np.ndarray:
        """The largest passage value of each text."""
        words = words_of(column)
        if not len(words.hashes):
            return np.full(len(column), self.offset)
        sums, counts = (np.concatenate([[0.0], np.cumsum(one)]) for one in self._of_words(words))
        size = np.diff(words.first)
        half = PASSAGE // 2
        passages = np.maximum(1, -(-(size - half) // half))
        row = np.repeat(np.arange(len(size)), passages)
        turn = np.arange(len(row)) - np.repeat(np.cumsum(passages) - passages, passages)
        start = words.first[:-1][row] + turn * half
        end = np.minimum(start + PASSAGE, words.first[1:][row])
        value = (sums[end] - sums[start]) / np.maximum(counts[end] - counts[start], 1) + self.offset
        return np.maximum.reduceat(value, np.cumsum(passages) - passages)


def sampled_labels(labels: DataFrame, per_label: int = PER_LABEL, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``label`` and ``part`` (0 calibrates, others teach) of at most ``per_label``
    documents of each label.  Ids are brought together first, one row each."""
    one = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max(F.col("label").cast("int")).alias("label"))
    turn = F.xxhash64("doc_id", F.lit(seed))
    parts = [one.where(F.col("label") == label).orderBy(turn, "doc_id").limit(per_label) for label in (0, 1)]
    return parts[0].unionByName(parts[1]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4)))


def _passages(rows: DataFrame, seed: int) -> DataFrame:
    """Passages of ``PASSAGE`` words without overlap; of a document with more than
    ``PASSAGES`` a draw that its id decides."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                out: list[tuple] = []
                for doc, label, text in zip(*(part.column(name).to_pylist() for name in ("doc_id", "label", "text"))):
                    words = text.split()
                    count = max(1, -(-len(words) // PASSAGE))
                    chosen = range(count)
                    if count > PASSAGES:
                        draw = np.random.default_rng([doc % (1 << 64), seed])
                        chosen = np.sort(draw.choice(count, PASSAGES, replace=False)).tolist()
                    out += [(doc, label, n, " ".join(words[n * PASSAGE:(n + 1) * PASSAGE])[:PASSAGE_CHARS]) for n in chosen]
                columns = list(zip(*out)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in
                     zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.string()))],
                    names=["doc_id", "label", "n", "text"])

    return rows.select("doc_id", "label", "text").mapInArrow(cut, "doc_id long, label int, n long, text string")


def _curve(value: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one value by Newton steps with a small ridge."""
    rows, beta = np.column_stack([value, np.ones(len(value))]), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        gradient = rows.T @ (weight * (p - label)) + 1e-3 * beta
        hessian = (rows * (weight * p * (1 - p))[:, None]).T @ rows + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(learned: DataFrame, labels: DataFrame, *, per_label: int = PER_LABEL, seed: int = SEED) -> ToxicityModel:
    """Fits on texts (``doc_id``, ``text``) and labels (``doc_id``, ``label``, 0 or 1)."""
    chosen = sampled_labels(labels, per_label, seed).collect()
    totals = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max(F.col("label").cast("int")).alias("label")).groupBy("label").count().collect()
    counts = {row["label"]: row["count"] for row in totals}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    constant = ToxicityModel(np.zeros(BUCKETS), 0.0, (0.0, float(np.log(prior / (1 - prior)))))
    if len(counts) < 2:
        return constant
    spark = learned.sparkSession
    sample = spark.createDataFrame(chosen, "doc_id long, label int, part long")
    # At most per_label rows of each label.
    rows = learned.select(F.col("doc_id").cast("long"), cleaned(F.col("text")).alias("text")).join(
        F.broadcast(sample), "doc_id")
    passages = _passages(rows.where("part > 0"), seed).collect()
    passages.sort(key=lambda row: (row["doc_id"], row["n"], row["text"]))
    names, doc = np.unique([row["doc_id"] for row in passages], return_inverse=True)
    marks = np.zeros(len(names), np.int64)
    marks[doc] = [row["label"] for row in passages]
    if len(set(marks.tolist())) < 2:
        return constant
    weights, offset = trained(Passages([row["text"] for row in passages], doc), marks, seed=seed)
    found = evidence(rows.where("part = 0").select("doc_id", "label", "text"), weights, offset).collect()
    if len({row["label"] for row in found}) < 2:
        return constant
    # In one order whatever task a row came from; labels count as often as they occur.
    values = np.array(sorted((row["label"], row["evidence"]) for row in found))
    share = np.array([counts[label] for label in (0, 1)]) / np.bincount(values[:, 0].astype(int))
    weight = share[values[:, 0].astype(int)]
    return ToxicityModel(weights, offset, _curve(values[:, 1], values[:, 0], weight / weight.mean()))


def evidence(rows: DataFrame, weights: np.ndarray, offset: float) -> DataFrame:
    """``rows`` with cleaned ``text`` replaced by ``evidence``."""
    others = [name for name in rows.columns if name not in {"text", "evidence"}]
    fields = [f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in others]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, offset)
        for batch in batches:
            for part in row_slices(batch, "text"):
                found = pa.array(scorer.evidence(part.column("text")), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.select(others).columns, found], names=[*others, "evidence"])

    return rows.select(*[F.col(f"`{name}`") for name in others], "text").mapInArrow(
        scored, ", ".join([*fields, "evidence double"]))


def score(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` without ``text``, with ``evidence`` and ``score`` (0 to 1, higher is more toxic)."""
    others = [F.col(f"`{name}`") for name in rows.columns if name not in {"text", "evidence", "score"}]
    found = evidence(rows.select(*others, cleaned(F.col("text")).alias("text")), model.weights, model.offset)
    slope, start = model.curve
    return found.withColumn("score", 1 / (1 + F.exp(-(F.lit(slope) * F.col("evidence") + F.lit(start)))))
