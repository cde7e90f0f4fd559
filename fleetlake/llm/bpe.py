"""BPE encoding and decoding with a contiguous rank array.

A word is held as an array of part ids with the rank of each adjacent pair beside it. The
smallest rank is found by scanning, its right boundary is deleted, and the two neighbouring
ranks are looked up again. All new words of a chunk go through this together, as the rows
of one matrix per length class. A word of more than ``SHORT`` bytes keeps its ranks in a
heap, since scanning would cost the square of its length.

Defined results: null and empty texts have no ids and decode to the empty text; every row
is encoded for itself, so repeated rows give repeated results; the strings of the file's
added tokens become their ids wherever they occur, as in the library.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections import ChainMap
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import CHUNK, chunks, extended, text_buffer

#: Words up to this many bytes are merged in matrices.
SHORT = 64
#: Distinct words a worker remembers before it starts anew.
REMEMBERED = 500_000
NONE = np.int32(2**31 - 1)

# The published split pattern of byte-level BPE, and the letters and numbers
# that are newer than the library's Unicode tables; the library takes them for symbols.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD"
    r"\uA7E2\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7"
    r"\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1"
    r"\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8"
    r"\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2"
    r"\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81"
    r"\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2"
    r"\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF"
    r"\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)
WHITE_RUN = regex.compile(r"\s\s")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(shifted)}


class ByteBpe:
    """A byte-level BPE vocabulary read from a tokenizers JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
        self.bytes_of = [b""] * (max(names) + 1)
        for i, token in names.items():
            self.bytes_of[i] = (
                bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
            )
        self.first_id = np.zeros(256, np.int32)
        for char, byte in alphabet.items():
            self.first_id[byte] = vocab[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([(vocab[a] << 20) | vocab[b] for a, b in pairs], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys)), strict=True))
        self.table_bits = int(len(keys)).bit_length() + 2
        self.slots, self.slot_rank, self.probes = self._hashed(keys)
        self.added = added
        self.splits_at = (
            regex.compile("|".join(f"({regex.escape(t)})" for t in sorted(added, key=len, reverse=True)))
            if added
            else None
        )
        self.pattern = regex.compile(SPLIT)
        self.newer = regex.compile(f"[{NEWER}]")
        careful = SPLIT.replace(r"\p{L}+", f"[\\p{{L}}--[{NEWER}]]+").replace(r"\p{N}+", f"[\\p{{N}}--[{NEWER}]]+")
        careful = careful.replace(r"[^\s\p{L}\p{N}]+", f"[[^\\s\\p{{L}}\\p{{N}}]||[{NEWER}]]+")
        self.careful = regex.compile(careful, regex.V1)
        self.numbers = list(range(len(self.bytes_of)))
        self.known: dict[str, tuple[int, ...]] = {}

    def _hashed(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Open addressing over the pairs; also the most probes a stored pair needs."""
        size = 1 << self.table_bits
        slots, ranks, longest = np.full(size, -1, np.int64), np.full(size, NONE, np.int32), 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            steps = 1
            while slots[slot] >= 0:
                slot, steps = (slot + 1) & (size - 1), steps + 1
            slots[slot], ranks[slot], longest = key, rank, max(longest, steps)
        return slots, ranks, longest

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        scrambled = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (scrambled >> np.uint64(64 - self.table_bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left.astype(np.int64) << 20) | right
        slot = self._slot(keys)
        out = np.where(self.slots[slot] == keys, self.slot_rank[slot], NONE)
        open_ = np.flatnonzero((self.slots[slot] != keys) & (self.slots[slot] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            found = self.slots[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.slot_rank[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def keys(self, left: np.ndarray, right: np.ndarray, column) -> np.ndarray:
        rank = self.ranks(left, right)
        return np.where(rank == NONE, NONE, rank * SHORT + column).astype(np.int32)

    def merge_all(self, words: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(words)
        by_class: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            if len(word) > SHORT:
                out[k] = self.merge_long(word)
            elif word:
                by_class.setdefault((len(word) + 3) // 4 * 4, []).append(k)
        for width, members in by_class.items():
            self._merge_class(words, members, width, out)
        return out

    def _merge_class(self, words: list[bytes], members: list[int], width: int, out: list) -> None:
        """Column c of word k is ``ids[c, k]``; ``key`` holds rank * SHORT + c, so a minimum gives both."""
        index = np.array(members)
        sizes = np.array([len(words[k]) for k in members], np.int32)
        padded = b"".join(words[k].ljust(width, b"\0") for k in members)
        ids = self.first_id[np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(-1, width).T)]
        key = np.full(ids.shape, NONE, np.int32)
        for c in range(width - 1):
            key[c] = np.where(c + 1 < sizes, self.keys(ids[c], ids[c + 1], c), NONE)
        while len(index):
            best = key.min(axis=0)
            done = best == NONE
            if done.any():
                for k, n, row in zip(index[done].tolist(), sizes[done].tolist(), ids[:, done].T.tolist(), strict=True):
                    out[k] = tuple(map(self.numbers.__getitem__, row[:n]))
                live = ~done
                index, sizes, best = index[live], sizes[live], best[live]
                if not len(index):
                    break
                width = int(sizes.max())
                ids, key = ids[:width, live], key[:width, live]
            at = best & (SHORT - 1)
            for c in range(width - 1):
                after = c > at
                ids[c] = np.where(after, ids[c + 1], ids[c])
                key[c] = np.where(after & (key[c + 1] != NONE), key[c + 1] - 1, np.where(after, NONE, key[c]))
            key[width - 1] = NONE
            sizes -= 1
            rows = np.arange(len(index))
            made = self.merged[best // SHORT]
            ids[at, rows] = made
            follows = np.minimum(at + 1, width - 1)
            key[at, rows] = np.where(at + 1 < sizes, self.keys(made, ids[follows, rows], at), NONE)
            behind = np.flatnonzero(at > 0)
            left = at[behind] - 1
            key[left, behind] = self.keys(ids[left, behind], made[behind], left)

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        ids = self.first_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] >= 0:
                rank = self.rank_of.get((ids[left] << 20) | ids[after[left]])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, ids[left], ids[after[left]]))

        for k in range(len(ids) - 1):
            offer(k)
        while heap:
            rank, left, a, b = heapq.heappop(heap)
            right = after[left]
            if ids[left] != a or right < 0 or ids[right] != b:
                continue
            ids[left], ids[right] = int(self.merged[rank]), -1
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            after[right] = -1
            offer(before[left])
            offer(left)
        return tuple(i for i in ids if i >= 0)

    def has_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def pieces(self, text: str, pattern: regex.Pattern) -> list[str | int]:
        """Words, and the ids of added tokens between them."""
        if not self.has_added(text):
            return pattern.findall(text)
        out: list[str | int] = []
        for part in self.splits_at.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out.extend(pattern.findall(part))
        return out

    def spaced(self, text: str) -> list[str]:
        """The parts of ``text`` that can be split for themselves.

        No word spans a single space from left to right: it can only begin with it. Only
        runs of white space need what stands around them.
        """
        if WHITE_RUN.search(text) or "\0" in text or self.has_added(text):
            return [text]
        return text.replace(" ", "\0 ").split("\0")

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text; its new parts are split and merged together first."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        split = [self.spaced(t) for t in texts]
        new = list(set(chain.from_iterable(split)).difference(self.known))
        joined = "".join(new)
        newer = not joined.isascii() and self.newer.search(joined)
        pattern = self.careful if newer else self.pattern
        cut = [self.pieces(p, pattern) for p in new] if self.has_added(joined) else [*map(pattern.findall, new)]
        words = [w for w in set(chain.from_iterable(cut)) if isinstance(w, str)]
        ids: dict[str | int, tuple[int, ...]] = dict(
            zip(words, self.merge_all([w.encode() for w in words]), strict=True)
        )
        ids |= {i: (i,) for i in self.added.values()}
        whole = {}
        for part, piece in zip(new, cut, strict=True):
            made = ids[piece[0]] if len(piece) == 1 else tuple(chain.from_iterable(map(ids.__getitem__, piece)))
            (self.known if len(part) <= SHORT else whole)[part] = made
        known = ChainMap(self.known, whole) if whole else self.known
        for k, parts in enumerate(split):
            split[k] = []
            yield list(chain.from_iterable(map(known.__getitem__, parts)))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with an array of token ids, and with the text decoded from them if named.

    Columns of these names are replaced.
    """
    made = [c for c in (ids, decoded) if c]
    kept = docs.drop(*(c for c in made if c != text))
    if decoded == text:
        kept = kept.withColumnRenamed(text, "__text")
    source = "__text" if decoded == text else text
    names = [c for c in kept.columns if c != "__text"]

    def run(batches):
        bpe = load(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source))
            kept_columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            _, bounds = text_buffer(column)
            for first, last in chunks(bounds, CHUNK):
                texts = [t or "" for t in column.slice(first, last - first).to_pylist()]
                lists, back = [], []
                for one in bpe.encode_all(texts):
                    if decoded:
                        back.append(bpe.decode(one))
                    lists.append(np.array(one, np.int32))
                sizes = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                arrays = [c.slice(first, last - first) for c in kept_columns]
                arrays.append(pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate(lists))))
                if decoded:
                    arrays.append(pa.array(back, pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, [*names, *made])

    fields = [(ids, T.ArrayType(T.IntegerType())), *([(decoded, T.StringType())] if decoded else [])]
    return kept.mapInArrow(run, extended(kept.select(*(F.col(f"`{c}`") for c in names)), *fields))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``df`` with the text that its ids stand for; null ids give the empty text."""
    kept = df.drop(text)
    names = kept.columns

    def run(batches):
        bpe = load(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([bpe.decode(x or []) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, text])

    return kept.mapInArrow(run, extended(kept, (text, T.StringType())))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and digests of the ids and of the text decoded from them."""
    coded = encode(docs.select("doc_id", "text"), path, decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
