"""Toxicity by subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, with marks at both ends, and a
text is the mean of its distinct words and of ``PADDING`` zero vectors, which keep texts of
a few words from extreme scores; a softmax over two classes stands on top. Vectors and weights
are learned together by Adam in a task on a bounded sample of labelled rows, under a group lasso that sets the vectors
of n-grams which tell nothing to zero; a kept-out fifth chooses its strength and when to stop.
N-grams of a single text are not learned. A misspelling never seen
shares most n-grams with the word it comes from, and so its vector.

Once trained the model is linear in the text, so what a text costs is one number per
distinct word: the difference of the two class scores of its mean vector.

Defined results: null and empty texts, and texts without a word, get the score of the bias
alone; rows are scored each for itself, and of an id that repeats the smallest text is learned from; without labelled rows every score is 0; labels that
are neither 0 nor 1 are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import extended, held_out, lowered, mixed, prefix_sums, slices, span_hashes, words

#: Rows of each label that are learned from at most, those of smallest id hash, and the bytes
#: of their texts at most; a text that no longer fits is passed over.
SAMPLE, SAMPLE_BYTES = 3000, 1 << 25
BUCKETS = 1 << 18
DIMENSIONS = 8
SHORTEST, LONGEST = 3, 6
#: Steps in all, and those after which vectors that are zero leave.
STEPS, SETTLED = 120, 20
RATE = 0.2
#: Strengths of the group lasso that are tried.
LASSO = (1e-4, 3e-4, 1e-3)
#: Share of the learning texts that chooses among them, and texts of a label below which all are learned from.
KEPT_OUT, FEW = 0.2, 8
#: Mean vectors are scaled by this before the softmax, as a text has hundreds of words.
SCALE = 300.0
THRESHOLD = 0.7
#: Zero vectors in the mean of a text.
PADDING = 50
#: N-grams or words that are summed at a time.
BLOCK = 1 << 20


@dataclass(frozen=True)
class Model:
    """``weight[b]``: what n-gram bucket b adds to the score; None: nothing was learned."""

    weight: np.ndarray | None
    bias: float


def grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram buckets of distinct words, and where each word's begin."""
    size = ends - starts + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(begin[-1], ord("<"), np.uint8)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    padded[begin[row] + 1 + inner] = data[starts[row] + inner]
    padded[begin[1:] - 1] = ord(">")
    sums = prefix_sums(padded)
    found, owner = [], []
    for n in range(SHORTEST, LONGEST + 1):
        made = np.maximum(size - n + 1, 0)
        made = np.where((size < SHORTEST) & (n == SHORTEST), 1, made)
        word = np.repeat(np.arange(len(size)), made)
        at = begin[word] + np.arange(len(word)) - np.repeat(np.cumsum(made) - made, made)
        found.append(span_hashes(sums, at, np.minimum(at + n, begin[word + 1])))
        owner.append(word)
    found.append(mixed(span_hashes(sums, begin[:-1], begin[1:])))
    owner.append(np.arange(len(size)))
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(BUCKETS)).astype(np.int64), np.searchsorted(
        owners[order], np.arange(len(size) + 1)
    )


def bags(data: np.ndarray, bounds: np.ndarray):
    """Hashes of the distinct words, the distinct words of each row as indexes of them, and n-grams."""
    starts, ends, at = words(data, bounds)
    kinds, first, index = np.unique(span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    once = np.unique(row * max(len(kinds), 1) + index)
    at = np.searchsorted(once, np.arange(len(at)) * max(len(kinds), 1))
    return kinds, once % max(len(kinds), 1), at, *grams(data, starts[first], ends[first])


def _means(values: np.ndarray, begin: np.ndarray, padding: int = 0) -> np.ndarray:
    """Means of the stretches of ``values`` and of so many zeros; 0 where a stretch is empty."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return (sums[begin[1:]] - sums[begin[:-1]]) / np.maximum(np.diff(begin) + padding, 1)


def _gathered(values: np.ndarray, source: np.ndarray, into: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``values[source]`` by ``into``, one after the other, with memory for a block of them."""
    sums, values = np.zeros(size), values.astype(np.float64)
    for first in range(0, len(source), BLOCK):
        part = slice(first, first + BLOCK)
        np.add.at(sums, into[part].astype(np.intp), values[source[part]])
    return sums


@dataclass(frozen=True)
class Bags:
    """Texts as bags of distinct words, words as bags of n-gram buckets.

    ``bucket`` lists the buckets that occur in more than one text; ``gram`` points into it.
    Other n-grams count as zero vectors, but still count in a word's mean.
    """

    bucket: np.ndarray
    gram: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray
    token: np.ndarray
    counts: np.ndarray


def all_bags(texts: pa.Array) -> Bags:
    seen = np.empty(0, np.uint64)
    kinds, gram, sizes, token, counts = [], [], [], [], []
    for _, _, data, bounds in slices(lowered(texts)):
        found, index, at, of_word, begin = bags(data, bounds)
        new = ~np.isin(found, seen)
        kinds.append(found[new])
        seen = np.union1d(seen, found)
        gram.append(of_word[np.repeat(new, np.diff(begin))].astype(np.int32))
        sizes.append(np.diff(begin)[new])
        token.append(found[index])
        counts.append(np.diff(at))
    order = np.argsort(np.concatenate(kinds))
    token = order[np.searchsorted(seen, np.concatenate(token))].astype(np.int32)
    gram, sizes, counts = np.concatenate(gram), np.concatenate(sizes), np.concatenate(counts)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    # A bucket of one text can only tell that text by heart. Words of one text may share it.
    texts_of = np.bincount(token, minlength=len(sizes))
    many = _gathered(texts_of, owner, gram, BUCKETS) > 1
    known = many[gram]
    place = (np.cumsum(many) - 1).astype(np.int32)
    return Bags(np.flatnonzero(many), place[gram[known]], owner[known], sizes, token, counts)


def _learned(
    bag: Bags, labels: np.ndarray, tuned: np.ndarray, lasso: float, seed: int, stop: int = 0
) -> tuple[float, int, Model]:
    """Loss, step and model where the kept-out texts, those not ``tuned``, had the least loss.

    With ``stop`` it is the model of that step.
    """
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.01, (len(bag.bucket), DIMENSIONS)).astype(np.float32)
    out, bias = random.normal(0, 1, DIMENSIONS).astype(np.float32), np.zeros(1, np.float32)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (vectors, out, bias)]
    share = SCALE / (bag.counts + PADDING)
    sides = [tuned, ~tuned] if (~tuned).any() else [tuned, tuned]
    weights = []
    for side in sides:
        n = [max(1, int((side & (labels == y)).sum())) for y in (0, 1)]
        weights.append(np.where(labels == 1, 0.5 / n[1], 0.5 / n[0]) * side)
    least, best = np.inf, (1, Model(np.zeros(BUCKETS, np.float32), 0.0))
    bucket, gram, owner, token = bag.bucket, bag.gram, bag.owner, bag.token
    text = np.repeat(np.arange(len(labels), dtype=np.int32), bag.counts)
    for step in range(1, STEPS + 1):
        if step > SETTLED and step % 10 == 1:
            # Vectors that are zero by now stay so, and words of nothing else are passed over.
            alive = vectors.any(axis=1)
            here = alive[gram]
            gram, owner, bucket = (np.cumsum(alive) - 1).astype(np.int32)[gram[here]], owner[here], bucket[alive]
            vectors, state[0] = vectors[alive], (state[0][0][alive], state[0][1][alive])
            told = np.zeros(len(bag.sizes), bool)
            told[owner] = True
            told = told[token]
            token, text = token[told], text[told]
        weight = vectors @ out
        per_word = _gathered(weight, gram, owner, len(bag.sizes)) / bag.sizes
        logits = np.clip(_gathered(per_word, token, text, len(labels)) * share + bias[0], -500, 500)
        chance = 1 / (1 + np.exp(-logits))
        loss = float((np.logaddexp(0, np.where(labels == 1, -logits, logits)) * weights[1]).sum())
        if step == stop if stop else loss < least:
            whole = np.zeros(BUCKETS, np.float32)
            whole[bucket] = weight * np.float32(SCALE)
            least, best = loss, (step, Model(whole, float(bias[0])))
            if stop:
                break
        error = (chance - labels) * weights[0]
        of_word = _gathered(error * share, text, token, len(bag.sizes)) / bag.sizes
        of_gram = _gathered(of_word, owner, gram, len(bucket)).astype(np.float32)
        gradients = (of_gram[:, None] * out, vectors.T @ of_gram, np.array([error.sum()], np.float32))
        rate = RATE * (1 - (step - 1) / STEPS)
        for parameter, (m, v), g in zip((vectors, out, bias), state, gradients, strict=True):
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            parameter -= np.float32(rate / (1 - 0.9**step)) * m / (np.sqrt(v * np.float32(1 / (1 - 0.999**step))) + np.float32(1e-12))
        # The lasso's step in the scale of Adam's: a vector the data don't call for becomes zero.
        spread = np.sqrt(state[0][1] / (1 - 0.999**step)).mean(1) + 1e-12
        length = np.sqrt((vectors**2).sum(1))
        vectors *= np.maximum(0, 1 - rate * lasso / spread / (length + 1e-20))[:, None]
    return least, *best


def train(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> Model:
    """Learns from whole texts, all of them in each step.

    With two classes a softmax sees only the difference of its two columns, so gradients
    need one number per text, word and n-gram; the vectors are updated from those. A fifth of
    the texts is kept out: it chooses the strength of the group lasso that clears n-grams
    which tell nothing, and the step to stop at. Then all texts are learned from that way.
    """
    if not len(labels):
        return Model(None, 0.0)
    bag = all_bags(texts)
    tuned = np.random.default_rng(seed).random(len(labels)) >= KEPT_OUT
    for y in (0, 1):
        # Few texts of a label: learn from all of them.
        if (tuned & (labels == y)).sum() < FEW or (~tuned & (labels == y)).sum() == 0:
            tuned |= labels == y
    found = [(*_learned(bag, labels, tuned, lasso, seed)[:2], lasso) for lasso in LASSO]
    _, step, lasso = min(found)
    return _learned(bag, labels, np.ones(len(labels), bool), lasso, seed, step)[2]


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, limit: int = SAMPLE_BYTES) -> DataFrame:
    """At most ``sample`` whole texts of each label, and ``limit`` bytes of them, outside the held-out third."""
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null")
    known = known.where(~held_out(3, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    drawn = [known.where(F.col("toxic") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    # At most two samples of ids, so the broadcast is bounded. Of an id that repeats the smallest text counts.
    chosen = docs.select("doc_id", "text").join(F.broadcast(drawn[0].unionByName(drawn[1])), "doc_id")
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    sized = Window.partitionBy("toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.octet_length("text")
    fits = F.sum(F.when(size <= limit, size).otherwise(0)).over(sized)
    return chosen.withColumn("upto", fits).where((F.col("upto") <= limit) & (size <= limit)).drop("upto")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model learned by a task from the bounded sample; the driver sees the model alone."""

    def run(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order)).combine_chunks()
        model = train(rows.column("text").combine_chunks(), rows.column("toxic").to_numpy().astype(np.int64))
        if model.weight is not None:
            yield pa.RecordBatch.from_pydict({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    # At most two samples of texts, whose size is bounded, so one task holds them.
    learned = labelled(docs, labels, sample).select("doc_id", "toxic", "text").repartition(1)
    found = learned.mapInArrow(run, "weight binary, bias double").collect()
    return Model(np.frombuffer(found[0].weight, np.float32), found[0].bias) if found else Model(None, 0.0)


def score_texts(texts: pa.Array, model: Model) -> np.ndarray:
    """Probabilities that whole texts are toxic."""
    total = np.full(len(texts), model.bias)
    if model.weight is None:
        return np.zeros(len(texts))
    for first, last, data, bounds in slices(lowered(texts)):
        _, index, at, gram, begin = bags(data, bounds)
        per_word = _means(model.weight[gram].astype(np.float64), begin)
        total[first:last] += _means(per_word[index], at, PADDING)
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability; a column of that name is replaced."""
    kept = docs.drop(into)
    names = kept.columns
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score_texts(texts, shared.value))], [*names, into]
            )

    return kept.mapInArrow(run, extended(kept, (into, T.DoubleType())))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document the score and the decision at the threshold."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        held_out(3, 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
