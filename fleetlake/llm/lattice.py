"""Document likelihood over all segmentations of a subword vocabulary.

The pieces of an existing vocabulary get unigram probabilities from the training documents
(their counts in the vocabulary's own segmentation, plus one). A text is its words, lower
case, each behind the vocabulary's word mark, and one end. The probability of a word is the
sum over all ways to cut it into pieces, computed by the forward recursion in log space;
single bytes are pieces too, so every word has one. As no piece crosses a word's start, the
text's probability is the product over its words and the end.

Word counts for the base score grow with the corpus, so they are never in one place: a block
of neighbouring documents asks a table that is spread by word for the counts of its words,
once each, and gets them back in front of its texts. Tasks then stream through the texts.

Defined results: null counts as empty, and an empty text is its end alone; rows are scored
each for itself, and a missing doc_id is never held out; with nothing to learn from, all
counts are 0.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import held_out, prefix_sums, slices, span_hashes
from fleetlake.session import scratch_path, staged

#: Documents of neighbouring ids whose words are looked up together.
BLOCK = 4096
MARK = "▁"
#: Stands for the word mark in front of a word's bytes; it can't occur inside a word's lattice.
MARK_BYTE = 0
#: What the end of a text is filed under, in place of a word's hash, and rows of piece counts.
END, PIECES = -(2**62), -(2**61)
#: Longer words are walked through one by one.
SHORT = 64

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between white space, and where each row's begin."""
    flag = ~_SPACE[data]
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    inner = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(data))]
    first[inner] = flag[inner]
    last[inner - 1] = flag[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def distinct_words(data: np.ndarray, bounds: np.ndarray):
    """Hashes of the distinct words with a place each, and the rows' words as indexes of them."""
    starts, ends, at = tokens(data, bounds)
    hashes, first, index = np.unique(
        span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True
    )
    # Hashes are filed as signed numbers, apart from the two reserved ones.
    return hashes.view(np.int64), starts[first], ends[first], index, at


class Pieces:
    """The vocabulary: its pieces as bytes, its own segmentation, and learned scores."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes | None] = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.bytes_of.append(None)
            else:
                marked = piece.startswith(MARK)
                raw = (piece[1:] if marked else piece).encode()
                self.bytes_of.append(None if MARK in piece[1:] else bytes([MARK_BYTE]) * marked + raw)

    def counts(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """How often each piece occurs in words that occur so often."""
        out = np.zeros(len(self.bytes_of), np.int64)
        for first in range(0, len(words), 20_000):
            lists = self.model.encode(words[first : first + 20_000], out_type=int, num_threads=1)
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for one in lists for i in one), np.int64, int(sizes.sum()))
            out += np.bincount(flat, np.repeat(weights[first : first + 20_000], sizes), len(out)).astype(np.int64)
        return out


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    """Log probabilities of words under piece scores."""

    def __init__(self, strings: list[bytes], log_p: np.ndarray):
        """Pieces of equal bytes add up."""
        together: dict[bytes, float] = {}
        for string, score in zip(strings, log_p.tolist(), strict=True):
            together[string] = np.logaddexp(together[string], score) if string in together else score
        data = np.frombuffer(b"".join(together), np.uint8)
        ends = np.cumsum([len(s) for s in together])
        self.longest = max(map(len, together))
        hashes = span_hashes(prefix_sums(data), np.concatenate([[0], ends[:-1]]), ends)
        scores = np.array(list(together.values()))
        # A few tables: the first piece of each slot, the second, and so on.
        self.tables = []
        self.bits = 18
        while len(hashes):
            slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            keys, values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -np.inf)
            keys[slot[first]], values[slot[first]] = hashes[first], scores[first]
            self.tables.append((keys, values))
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            hashes, scores = hashes[rest], scores[rest]

    def scores(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(hashes), -np.inf)
        for keys, values in self.tables:
            hit = np.flatnonzero(keys[slot] == hashes)
            out[hit] = values[slot[hit]]
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log probability of each word, summed over its segmentations."""
        size = ends - starts
        out = np.zeros(len(starts))
        for n in np.unique(size).tolist():
            members = np.flatnonzero(size == n)
            if n > SHORT:
                for k in members.tolist():
                    out[k] = self._long(data[starts[k] : ends[k]])
                continue
            for part in np.array_split(members, max(1, len(members) * (n + 1) // 1_000_000)):
                block = np.empty((len(part), n + 1), np.uint8)
                block[:, 0] = MARK_BYTE
                block[:, 1:] = data[starts[part][:, None] + np.arange(n)]
                out[part] = self._forward(block)
        return out

    def _forward(self, block: np.ndarray) -> np.ndarray:
        rows, width = block.shape
        sums = prefix_sums(block.ravel())
        at = np.arange(rows) * width
        alpha = np.full((width + 1, rows), -np.inf)
        alpha[0] = 0
        for end in range(1, width + 1):
            for begin in range(max(0, end - self.longest), end):
                score = self.scores(span_hashes(sums, at + begin, at + end))
                hit = np.flatnonzero(score > -np.inf)
                alpha[end, hit] = np.logaddexp(alpha[end, hit], alpha[begin, hit] + score[hit])
        return alpha[width]

    def _long(self, word: np.ndarray) -> float:
        data = np.concatenate([np.array([MARK_BYTE], np.uint8), word])
        sums, n = prefix_sums(data), len(data)
        ends = np.arange(1, n + 1)
        score = np.full((n + 1, self.longest + 1), -np.inf)
        for size in range(1, min(self.longest, n) + 1):
            score[size:, size] = self.scores(span_hashes(sums, ends[size - 1 :] - size, ends[size - 1 :]))
        alpha = np.full(n + 1, -np.inf)
        alpha[0] = 0
        for end in range(1, n + 1):
            reach = min(self.longest, end)
            ways = alpha[end - reach : end] + score[end, reach:0:-1]
            top = ways.max()
            if top > -np.inf:
                alpha[end] = top + np.log(np.exp(ways - top).sum())
        return float(alpha[n])


def _gathered(path: str):
    """Rows ``block, word, n``: words of neighbouring documents with their counts in training."""

    def emit(block, words_, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words_), block)), pa.array(words_), pa.array(counts)], ["block", "word", "n"]
        )

    def run(batches):
        vocabulary = pieces(path)
        piece_counts = np.zeros(len(vocabulary.bytes_of), np.int64)
        own: dict[int, list] = {}
        held = 0
        for batch in batches:
            block, skip, text = (batch.column(batch.schema.get_field_index(c)) for c in ("block", "held_out", "text"))
            block, skip = block.to_numpy(), skip.to_numpy(zero_copy_only=False)
            for first, last, data, bounds in slices(text):
                data = _LOWER[data]
                hashes, starts, ends, index, at = distinct_words(data, bounds)
                row = np.repeat(np.arange(first, last), np.diff(at))
                learned = np.bincount(index, ~skip[row], len(hashes)).astype(np.int64)
                raw = data.tobytes()
                some = np.flatnonzero(learned)
                strings = [raw[a:b].decode() for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]
                piece_counts += vocabulary.counts(strings, learned[some])
                for b in np.unique(block[first:last]).tolist():
                    mine = block[row] == b
                    n = np.bincount(index[mine], ~skip[row[mine]], len(hashes)).astype(np.int64)
                    seen = np.bincount(index[mine], minlength=len(hashes)) > 0
                    texts = int((~skip[first:last][block[first:last] == b]).sum())
                    own.setdefault(b, []).append(
                        (np.append(hashes[seen], END), np.append(n[seen], texts))
                    )
                    held += int(seen.sum())
            if held > 1_500_000:
                for b, parts in own.items():
                    yield emit(b, *_together(parts))
                own, held = {}, 0
        for b, parts in own.items():
            yield emit(b, *_together(parts))
        if piece_counts.any():
            used = np.flatnonzero(piece_counts)
            yield emit(PIECES, used, piece_counts[used])

    return run


def _together(parts: list) -> tuple[np.ndarray, np.ndarray]:
    words_, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    kinds, index = np.unique(words_, return_inverse=True)
    return kinds, np.bincount(index, counts, len(kinds)).astype(np.int64)


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scored(shared):
    """Streams blocks: first the rows with counts, then the texts."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lattice = Lattice(model["strings"], model["log_p"])
        n, denominator = model["n"], model["n"] + model["v"] + 1
        block, words_, counts = None, [], []
        table: tuple[np.ndarray, np.ndarray] | None = None
        cache = (np.empty(0, np.int64), np.empty(0))
        for batch in batches:
            get = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            blocks, texts = get("block").to_numpy(), get("is_text").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((blocks[1:] != blocks[:-1]) | (texts[1:] != texts[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(blocks)], strict=True):
                if blocks[a] != block:
                    block, words_, counts, table = blocks[a], [], [], None
                    cache = (np.empty(0, np.int64), np.empty(0))
                if not texts[a]:
                    words_.append(get("word").slice(a, b - a).to_numpy())
                    counts.append(get("n").slice(a, b - a).to_numpy())
                    continue
                if table is None:
                    keys = np.concatenate(words_)
                    order = np.argsort(keys, kind="stable")
                    table = keys[order], np.concatenate(counts)[order]
                at_end = table[1][np.searchsorted(table[0], END)]
                for first, last, data, bounds in slices(get("text").slice(a, b - a)):
                    data = _LOWER[data]
                    hashes, starts, ends, index, at = distinct_words(data, bounds)
                    count = table[1][np.searchsorted(table[0], hashes)]
                    cache, own = _looked_up(cache, hashes, lattice, data, starts, ends)
                    begin = at[:-1]
                    per_word = np.stack([np.log10((count + 1) / denominator), own / np.log(10), count > 0])
                    sums = np.concatenate([np.zeros((3, 1)), np.cumsum(per_word[:, index], axis=1)], axis=1)
                    total = sums[:, at[1:]] - sums[:, begin]
                    rows = slice(a + first, a + last)
                    yield pa.RecordBatch.from_arrays(
                        [
                            get("doc_id").slice(rows.start, last - first),
                            get("held_out").slice(rows.start, last - first),
                            pa.array((np.diff(at) + 1).astype(np.int64)),
                            pa.array(np.rint(total[2]).astype(np.int64) + int(at_end > 0)),
                            pa.array(np.full(last - first, n, np.int64)),
                            pa.array(total[0] + np.log10((at_end + 1) / denominator)),
                            pa.array(total[1] + model["end"] / np.log(10)),
                        ],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

    return run


def _looked_up(cache, hashes, lattice, data, starts, ends):
    """Word scores from the block's cache, which takes in the new ones."""
    keys, values = cache
    place = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
    known = keys[place] == hashes if len(keys) else np.zeros(len(hashes), bool)
    own = np.zeros(len(hashes))
    own[known] = values[place[known]] if known.any() else 0
    own[~known] = lattice.words(data, starts[~known], ends[~known])
    # Sums over a text don't cancel: a word's score is at most 0.
    keys = np.concatenate([keys, hashes[~known]])
    values = np.concatenate([values, own[~known]])
    order = np.argsort(keys, kind="stable")
    return (keys[order], values[order]), own


def likelihoods(docs: DataFrame, path: str, modulus: int = 7, remainder: int = 2) -> DataFrame:
    """``RESULT`` for every row of ``docs`` (``doc_id, text``)."""
    spark = docs.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(BLOCK))).otherwise(
        F.floor(F.col("doc_id") / BLOCK) + BLOCK
    )
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        held_out(modulus, remainder).alias("held_out"), block.cast("long").alias("block"),
    )
    gathered = keyed.select("block", "held_out", "text").mapInArrow(_gathered(path), "block long, word long, n long")
    gathered = staged(gathered, scratch_path(spark, "words"))
    asked = gathered.where(F.col("block") != PIECES)
    counted = asked.groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted, scratch_path(spark, "counts"))
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    texts = counted.where(F.col("word") == END).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # As many rows as the vocabulary has pieces, at most.
    found = gathered.where(F.col("block") == PIECES).groupBy("word").agg(F.sum("n").alias("n")).collect()
    vocabulary = pieces(path)
    counts = np.zeros(len(vocabulary.bytes_of))
    for row in found:
        counts[row["word"]] = row["n"]
    usable = [i for i, b in enumerate(vocabulary.bytes_of) if b is not None]
    total = counts.sum() + texts + len(counts) + 1
    model = {
        "strings": [vocabulary.bytes_of[i] for i in usable],
        "log_p": np.log((counts[usable] + 1) / total),
        "end": float(np.log((texts + 1) / total)),
        "n": int(n),
        "v": int(v),
    }
    shared = spark.sparkContext.broadcast(model)
    answers = asked.select("block", "word").join(counted, "word").select(
        "block", F.lit(False).alias("is_text"), "word", "n",
        F.lit(None).cast("long").alias("doc_id"), F.lit(False).alias("held_out"), F.lit(None).cast("string").alias("text"),
    )
    rows = keyed.select(
        "block", F.lit(True).alias("is_text"), F.lit(0).cast("long").alias("word"), F.lit(0).cast("long").alias("n"),
        "doc_id", "held_out", "text",
    )
    streamed = answers.unionByName(rows).repartition(n_parts, "block").sortWithinPartitions("block", "is_text")
    return streamed.mapInArrow(_scored(shared), RESULT)
