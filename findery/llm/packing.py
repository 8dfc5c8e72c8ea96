"""Cost-balanced packing of tokenized documents into sequences of a fixed length.

A document is its token ids and an end id. Within a group of documents the longest go first; full-length pieces of a long
document are sequences of their own, and each other piece goes to the sequence of the lowest estimated cost
(``linear`` * tokens + ``quadratic`` * sum of squared piece lengths, as attention stays within a piece) that has room. A
piece that does not fit is cut and its rest goes on in the same way. The sequences of a group are as many full ones as its
tokens fill, and powers of two for the rest, so nothing is padded.

A group is a bounded run of documents within an input partition: tokenizing and packing are one pass without a shuffle,
a task holds one group, and a lost task is simply run again with the same result.

Defined results: the string of a special token is that token's id; a null or empty text is the end id alone; repeated rows are packed each on its own; any length of text is
tokenized whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import read_table, slices

LENGTH = 1024
END = 0
GROUP_TOKENS = 1 << 21
MEMO_ENTRIES = 300_000
LINEAR, QUADRATIC = 1.0, 1.0 / 512

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_cost double"
)


class _Apart(Exception):
    """A chunk that cannot be encoded apart from its neighbours."""


class _Memo(dict):
    """Encoded chunks of text between single blanks; entries beyond the limit are computed but not kept."""

    def __init__(self, encode: Callable[[str], list[int]], limit: int):
        self.encode, self.limit = encode, limit

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise _Apart
        ids = np.array(self.encode(" " + chunk), dtype="<u4").tobytes()
        if len(self) < self.limit:
            self[chunk] = ids
        return ids


def special_tokens(path: str) -> dict[str, int]:
    """The strings that the vocabulary's JSON file gives ids of their own, wherever they stand in a text."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("only special tokens that are found as they are")
    return {t["content"]: t["id"] for t in added}


def encoder(path: str, special: Mapping[str, int]) -> Callable[[str], np.ndarray]:
    """Text -> ids of the byte-level vocabulary whose ranks the file holds; a special string is its id, what stands between
    such strings is encoded apart.

    No piece of the vocabulary's splitting pattern crosses a single blank between two visible characters, so a text is
    encoded chunk by chunk there; a text with other white space around a blank is encoded as a whole.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    memo = _Memo(encoding.encode_ordinary, MEMO_ENTRIES)

    def encode(text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        try:
            if first and first[-1].isspace():
                raise _Apart
            tail = b"".join(map(memo.__getitem__, rest))
        except _Apart:
            return np.array(encoding.encode_ordinary(text), dtype="<u4")
        return np.frombuffer(np.array(encoding.encode_ordinary(first), dtype="<u4").tobytes() + tail, dtype="<u4")

    if not special:
        return encode
    # Of special strings that begin at one place the longest counts.
    strings = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    def encode_parts(text: str) -> np.ndarray:
        parts = strings.split(text)
        if len(parts) == 1:
            return encode(text)
        return np.concatenate([np.array([special[p]], dtype="<u4") if k % 2 else encode(p) for k, p in enumerate(parts)])

    return encode_parts


def place(lengths: list[int], size: int = LENGTH, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """(document number, start, length, sequence, offset) of all pieces, and the cost of each sequence."""
    total = sum(lengths)
    full, rest = divmod(total, size)
    tails = [1 << b for b in reversed(range(size.bit_length())) if rest >> b & 1]
    costs, pieces, sequence = [0.0] * (full + len(tails)), [], 0
    left = []
    for number, length in enumerate(lengths):
        start = 0
        while length - start >= size:
            pieces.append((number, start, size, sequence, 0))
            costs[sequence] = linear * size + quadratic * size * size
            sequence, start = sequence + 1, start + size
        if length > start:
            left.append((start - length, number, start))
    left.sort()
    room = [size] * full + tails
    open_ = [(0.0, s) for s in range(sequence, full)]
    tail = full
    for negative, number, start in left:
        length = -negative
        while length:
            if open_:
                cost, s = heapq.heappop(open_)
            else:
                cost, s = costs[tail], tail
            take = min(length, room[s])
            capacity = size if s < full else tails[s - full]
            pieces.append((number, start, take, s, capacity - room[s]))
            room[s] -= take
            costs[s] = cost + linear * take + quadratic * take * take
            if room[s]:
                if s < full:
                    heapq.heappush(open_, (costs[s], s))
            elif s >= full:
                tail += 1
            length, start = length - take, start + take
    return pieces, costs


def _flush(group: list[tuple[object, np.ndarray]], first: int, id_type: pa.DataType) -> tuple[pa.RecordBatch, int]:
    pieces, costs = place([len(ids) for _, ids in group])
    columns = list(zip(*pieces, strict=True)) if pieces else [()] * 5
    crcs = [zlib.crc32(group[n][1][start : start + length]) for n, start, length, _, _ in pieces]
    long = pa.int64()
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([group[n][0] for n in columns[0]], type=id_type), pa.array(columns[1], type=long),
            pa.array(columns[2], type=long), pa.array(crcs, type=long),
            pa.array([len(group[n][1]) for n in columns[0]], type=long),
            pa.array([first + s for s in columns[3]], type=long), pa.array(columns[4], type=long),
            pa.array([costs[s] for s in columns[3]], type=pa.float64()),
        ],
        names=[field.split()[0] for field in SCHEMA.split(", ")],
    )
    return batch, len(costs)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, json_path: str | None = None
) -> DataFrame:
    """One row per piece, columns as in ``SCHEMA``; a sequence's pieces lie side by side from offset 0.

    ``path`` is the vocabulary's rank file and ``json_path`` the JSON file of the same vocabulary, which names its special tokens.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        special = special_tokens(json_path or public_tokenizers.path("byte_bpe_50k.json"))
        encode = encoder(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), special)
        end = np.array([END], dtype="<u4")
        sequence = TaskContext.get().partitionId() << 36
        group, tokens = [], 0
        for batch in slices(batches, "text"):
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.concatenate([encode(text or ""), end])
                group.append((key, ids))
                tokens += len(ids)
                if tokens >= GROUP_TOKENS:
                    out, used = _flush(group, sequence, pa.int64())
                    yield out
                    group, tokens, sequence = [], 0, sequence + used
        if group:
            yield _flush(group, sequence, pa.int64())[0]

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"))
