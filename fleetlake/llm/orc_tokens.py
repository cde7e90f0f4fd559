"""Token ids in ORC files: integer run lengths, row indexes, Bloom filters on document ids.

Documents are dealt out by ranges of their id and sorted, so that file k holds smaller ids
than file k + 1 and the row indexes of a file skip what a filter on the id does not want.
Stripes are read in parallel by Spark's own splits. Each row keeps the number of ids before
it in its file; a small table of file totals turns that into the place in the whole stream.

Defined results: null and empty texts hold the end id alone; rows without a doc_id come
first; rows of one doc_id are ordered by their texts' hashes, so equal rows follow each other and which of
them comes first does not show; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlake.llm.bpe import byte_alphabet
from fleetlake.llm.common import as_long, chunks, text_buffer
from fleetlake.session import scratch_path

#: Distinct words, and distinct pieces of them, in each of a worker's two generations of memory.
WORDS, PIECES = 300_000, 500_000
#: Bytes of text (or one text) whose distinct words are looked up together.
PART = 4 << 20
SCHEMA = "doc_id long, file int, place long, n int, ids array<int>"

# Fixed value: the file's split pattern.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters that the normalizer changes to lower case and in no other way.
SIMPLE = regex.compile("[!-~\u00a1-\u012f\u0131-\u0148\u014a-\u017f]*")


class WordEncoder:
    """The tokenizers library on distinct words.

    The normalizer turns white space into spaces and the splitter drops it, so what stands
    between two spaces or line ends is encoded the same wherever it occurs. Each distinct
    one is normalized and split, and each distinct piece goes through the library's merges
    once; ids are kept as little-endian bytes. Texts that hold the string of an added token
    go through the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        alphabet = {byte: char for char, byte in byte_alphabet().items()}
        self.byte_chars = [alphabet[b] for b in range(256)]
        # What is used again moves from the older generation to the newer one.
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        """Ids of a normalized piece, one character per byte."""
        ids = self.pieces.get(piece)
        if ids is None and (ids := self.older_pieces.get(piece)) is not None:
            self.pieces[piece] = ids
        elif ids is None:
            found = [t.id for t in self.library.model.tokenize(piece)]
            ids = self.pieces[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids

    def _word(self, word: str) -> bytes:
        if word.isascii():
            # A run of letters with at most one other character behind it is split there.
            if word.isalpha():
                return self._piece(word.lower())
            if word[:-1].isalpha() and "!" <= word[-1] <= "~":
                return self._piece(word[:-1].lower()) + self._piece(word[-1])
        if SIMPLE.fullmatch(word):
            chars = self.byte_chars
            parts = SPLIT.findall(word.lower())
            return b"".join([self._piece(p if p.isascii() else "".join([chars[b] for b in p.encode()])) for p in parts])
        normal = self.library.normalizer.normalize_str(word)
        return b"".join([self._piece(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)])

    def _all_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, packed."""
        if len(self.known) > WORDS:
            self.older, self.known = self.known, {"": b""}
        if len(self.pieces) > PIECES:
            self.older_pieces, self.pieces = self.pieces, {}
        known, older = self.known, self.older
        found = list(map(known.get, words))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            ids = older.get(word)
            if ids is None:
                ids = self._word(word)
            if len(word) <= 64:
                known[word] = ids
            found[i] = ids
        return found

    def encode_column(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids end; null counts as empty.

        Arrow splits the texts and finds the distinct words of the column, whose ids are
        then dealt out to all places by their numbers.
        """
        text = pc.fill_null(text, "")
        special = np.zeros(len(text), bool)
        for added in self.added:
            special |= pc.match_substring(text, added).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(special), "", text) if special.any() else text
        parts = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        flat = parts.flatten().dictionary_encode()
        # By way of numpy, as Arrow's own lists are made by a scalar for each word.
        lists = self._all_words(flat.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.cumsum([0, *map(len, lists)]) // 4
        of_word = pa.ListArray.from_arrays(
            pa.array(sizes.astype(np.int32)), pa.array(np.frombuffer(b"".join(lists), "<i4"))
        )
        placed = of_word.take(flat.indices)
        bounds = np.asarray(placed.offsets)[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        ids = np.asarray(placed.values)[bounds[0] : bounds[-1]]
        ends = (bounds[1:] - bounds[0]).astype(np.int64)
        if not special.any():
            return ids, ends
        whole = [
            self.library.encode(text[i].as_py(), add_special_tokens=False).ids if s else ids[first:last]
            for i, (s, first, last) in enumerate(zip(special, [0, *ends[:-1]], ends, strict=True))
        ]
        return np.concatenate([np.asarray(x, np.int32) for x in whole]), np.cumsum([len(x) for x in whole])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed."""
        if not texts:
            return []
        ids, ends = self.encode_column(pa.array(texts, pa.large_string()))
        return [packed(one) for one in np.split(ids, ends[:-1])]


def packed(ids: list[int] | np.ndarray) -> bytes:
    return np.array(ids, "<u4").tobytes()


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int, files: int | None = None) -> None:
    """Encodes ``doc_id, text`` and writes ``SCHEMA`` as ORC below ``folder``."""
    spark = docs.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Rows of one doc_id may be many, so ranges go on by their texts' hashes.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = placed.repartitionByRange(n, *order).sortWithinPartitions(*order, F.col("text").asc_nulls_first())
    placed = placed.withColumn("file", F.spark_partition_id())

    def run(batches):
        encoder, place = load(path), 0
        for batch in batches:
            ids, text, file = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text", "file"))
            _, bounds = text_buffer(text)
            for first, last in chunks(bounds, PART):
                found, ends = encoder.encode_column(text.slice(first, last - first))
                sizes = np.diff(ends, prepend=0) + 1
                flat = pa.array(np.insert(found, ends, end_id).astype(np.int32, copy=False))
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, last - first),
                        file.slice(first, last - first),
                        pa.array(place + ends - sizes),
                        pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), flat),
                    ],
                    ["doc_id", "file", "place", "n", "ids"],
                )
                place += int(ends[-1])

    (
        placed.mapInArrow(run, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "10000")
        .option("orc.stripe.size", str(64 << 20))
        .orc(folder)
    )


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows with ``start``, the number of ids of all rows before each."""
    rows = spark.read.schema(SCHEMA).orc(folder)
    totals = rows.groupBy("file").agg(F.sum("n").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file that was written, so this window and the broadcast stay small.
    starts = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.join(F.broadcast(starts), "file").select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "ids"
    )


def checksums(rows: DataFrame) -> DataFrame:
    """Per stored row the number of ids and the crc32 of them as little-endian 32-bit integers."""

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            bounds = np.asarray(ids.offsets)
            flat = np.ascontiguousarray(np.asarray(ids.values), "<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "start")),
                    as_long(np.diff(bounds).astype(np.int64)),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_tokens(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Writes the ids of all documents to the shared folder and reads them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(docs, path, folder, end_id)
    return checksums(read_tokens(spark, folder))
