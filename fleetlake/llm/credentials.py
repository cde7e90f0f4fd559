"""Secrets in texts: three patterns, and strings that a tokenizer finds hard to spell.

A run of letters, digits and ``+/_-`` that a byte-pair vocabulary of natural text cuts into
tokens of few characters each is likely random: the vocabulary holds the pieces of words and of
names, so those come out at three characters a token and more, random strings at 1.1 to 2.
Before the test, runs that say what they are leave: digests (hexadecimal of a digest's
length, base64 behind ``sha256-`` and its like), UUIDs, and names, that is, runs whose
parts between ``+/_-`` are all one word or one number.

The patterns are matched on the UTF-8 bytes of each text, in which every character of
theirs is one byte; places are given in code points, the end exclusive. Matches never
cross texts, whole texts are searched, and no count is capped.

Defined results: null and empty texts have no spans; every row is kept, rows that repeat
give the same spans each; a column that already has the result's name is replaced; an
empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.llm.common import extended, slices

#: The kinds of spans, in the order in which those of one start are listed.
KINDS = ("assign", "access", "hex", "random")
#: Fewest characters of an assigned value, of an access key and of a hexadecimal string.
ASSIGNED, ACCESS, HEX = 8, 16, 32
#: Fewest characters of a run that is put to the token test, and the ratio it must stay below.
RUN, CHARACTERS_A_TOKEN = 16, 2.1

_ASSIGN = re.compile(
    rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX_DIGITS = frozenset(b"0123456789abcdefABCDEF")
#: Lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal.
_DIGESTS = frozenset((32, 40, 56, 64, 96, 128))
_BEFORE_DIGEST = re.compile(rb"(?:md5|sha1|sha224|sha256|sha384|sha512)[-:=/]$")
_UUID = re.compile(rb"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PART = re.compile(rb"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_BETWEEN = re.compile(rb"[+/_-]+")

Span = tuple[int, int, int]
SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tiktoken.Encoding:
    """The vocabulary of a ``.tiktoken`` file without special tokens."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("runs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _members(characters: bytes) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[*characters]] = True
    return flags


_LOWER_HEX = _members(b"0123456789abcdef")
_RUN_BYTES = _members(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def runs(data: np.ndarray, bounds: np.ndarray, members: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of the longest runs of ``members`` of at least ``least`` bytes."""
    flag = np.concatenate([[False], members[data], [False]])
    starts = np.flatnonzero(flag[1:] & ~flag[:-1])
    ends = np.flatnonzero(flag[:-1] & ~flag[1:])
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    # A run that goes on into the next row is one run in each.
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends, "left") - 1
    run = np.repeat(np.arange(len(starts)), last - first + 1)
    row = first[run] + np.arange(len(run)) - np.searchsorted(run, run)
    starts, ends = np.maximum(starts[run], bounds[row]), np.minimum(ends[run], bounds[row + 1])
    long = ends - starts >= least
    return row[long], starts[long], ends[long]


def explained(run: bytes, before: bytes) -> bool:
    """Whether a run is a known digest or an identifier; ``before``: the bytes in front of it."""
    if len(run) in _DIGESTS and _HEX_DIGITS.issuperset(run):
        return True
    if _BEFORE_DIGEST.search(before) or _BEFORE_DIGEST.match(run[: run.find(b"-") + 1]):
        return True
    return bool(_UUID.fullmatch(run)) or all(_PART.fullmatch(part) for part in _BETWEEN.split(run) if part)


def random_run(run: bytes, before: bytes, coding: tiktoken.Encoding) -> bool:
    """Whether a run fails the token test."""
    if explained(run, before):
        return False
    return len(run) < CHARACTERS_A_TOKEN * len(coding.encode_ordinary(run.decode()))


def chunk_spans(data: np.ndarray, bounds: np.ndarray, coding: tiktoken.Encoding) -> list[list[Span]]:
    """Spans of each row as (start, kind, end) in bytes of the chunk, in order."""
    found: list[list[Span]] = [[] for _ in range(len(bounds) - 1)]
    whole = data.tobytes()
    keyed = b"AKIA" in whole
    for row, (first, last) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        found[row] += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(whole, first, last) if m.end() - m.start(2) >= ASSIGNED]
        if keyed:
            found[row] += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(whole, first, last) if m.end() - m.start() >= ACCESS]
    for row, start, end in zip(*(x.tolist() for x in runs(data, bounds, _LOWER_HEX, HEX)), strict=True):
        found[row].append((start, 2, end))
    base = [sorted(one) for one in found]
    for row, start, end in zip(*(x.tolist() for x in runs(data, bounds, _RUN_BYTES, RUN)), strict=True):
        if any(a < end and start < b for a, _, b in base[row]):
            continue
        if random_run(whole[start:end], whole[max(int(bounds[row]), start - 8) : start], coding):
            found[row].append((start, 3, end))
    return [sorted(one) for one in found]


def text_spans(texts: pa.Array, coding: tiktoken.Encoding) -> Iterator[list[dict]]:
    """Spans of whole texts in code points."""
    for _, _, data, bounds in slices(texts):
        place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for row, spans in enumerate(chunk_spans(data, bounds, coding)):
            origin = place[bounds[row]]
            yield [{"kind": KINDS[k], "start": int(place[a] - origin), "end": int(place[b] - origin)} for a, k, b in spans]


def find(docs: DataFrame, path: str, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with the secrets of each text; ``path`` names the vocabulary's file."""
    kept = docs.drop(into) if into != text else docs
    names = kept.columns

    def run(batches):
        coding = vocabulary(path)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(text_spans(texts, coding)), kind)], [*names, into])

    return kept.mapInArrow(run, extended(kept, (into, SPANS)))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the counts and digest of the patterns' spans, and all spans as text."""
    found = find(docs.select("doc_id", "text"), path)

    def listed(kinds: tuple[str, ...]):
        chosen = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(number(kind) for kind in KINDS[:3]),
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
    )
