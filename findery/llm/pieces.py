"""SentencePiece encoding and decoding that keeps track of the original bytes.

The model file gives the normaliser and the pieces. A text is normalised by longest prefix: at each place the longest key of the
compiled character map (a double-array trie) is replaced, else one character stands for itself. Every normalised character
records the byte it comes from, so each piece is projected to the span of original bytes that it stands for. Normalised text
is merged pair by pair, best score first, leftmost first of equal ones; characters without a piece become byte pieces, whose last
one has the character's span and whose others are empty.

No piece of a model holds a space after another character (checked when it is read; a model where one does is merged text by
text), so text is merged apart before each run of spaces, and the ids of frequent parts are remembered.

Each row is encoded on its own, a bounded slice of texts at a time and a longer single text whole; there is no shuffle. Defined
results: a null or empty text has the begin and end ids only and decodes to the empty text; nulls, repeated rows and
clashing names in other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.common import read_table, slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
MEMO_ENTRIES = 400_000
MEMO_LENGTH = 64
SHORT = 40
SLICE_BYTES = 2 << 20

# Fixed values of the model file's format.
BPE = 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
WIRE_VARINT, WIRE_64, WIRE_BYTES, WIRE_32 = 0, 1, 2, 5

SCHEMA = "doc_id long, n_tokens long, ids binary, begins binary, ends binary, decoded string"


# --- the model file --------------------------------------------------------------------------------------------------


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        wire = key & 7
        if wire == WIRE_VARINT:
            yield key >> 3, varint()
            continue
        size = {WIRE_64: 8, WIRE_32: 4}.get(wire)
        if size is None:
            if wire != WIRE_BYTES:
                raise ValueError(f"wire type {wire}")
            size = varint()
        yield key >> 3, message[at : at + size]
        at += size


@dataclass(frozen=True)
class Model:
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    byte_fallback: bool
    unknown_surface: str
    normalizer: Normalizer

    @staticmethod
    def parsed(data: bytes) -> Model:
        pieces, scores, kinds, trainer, normal = [], [], [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                kinds.append(own.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3) != BPE or trainer.get(24, 0) or USER in kinds or UNUSED in kinds:
            raise ValueError("only byte-pair models without user-defined or unused pieces and with spaces as prefixes")
        normalizer = Normalizer(normal.get(2, b""), bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(normal.get(5, 1)))
        return Model(
            tuple(pieces), tuple(scores), tuple(kinds), bool(trainer.get(35, 0)),
            trainer.get(44, " ⁇ ".encode()).decode(), normalizer,
        )


class Normalizer:
    """Replaces by longest prefix and keeps the source of each character."""

    def __init__(self, char_map: bytes = b"", dummy_prefix: bool = True, remove_extra_spaces: bool = True, escape_spaces: bool = True):
        self.dummy_prefix, self.remove_extra_spaces = dummy_prefix, remove_extra_spaces
        self.space = SPACE if escape_spaces else " "
        self.units, self.strings = np.zeros(0, dtype=np.uint32), b""
        if char_map:
            size = struct.unpack("<I", char_map[:4])[0]
            self.units = np.frombuffer(char_map[4 : 4 + size], dtype="<u4")
            self.strings = char_map[4 + size :]
        self._known: dict[str, bool] = {}

    def _longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, bytes replaced) of the longest key that the text has at ``at``."""
        units, node, found = self.units, 0, None
        unit = int(units[0])
        node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units):
                break
            unit = int(units[node])
            if unit & ((1 << 31) | 255) != text[k]:
                break
            node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
            if unit >> 8 & 1:
                found = int(units[node]) & ((1 << 31) - 1), k + 1 - at
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(0, found[0])], found[1]

    def _steps(self, text: bytes) -> Iterator[tuple[str, int, int]]:
        """(normalised, begin, end) of each piece of the source."""
        at = 0
        while at < len(text):
            found = self._longest(text, at) if len(self.units) else None
            if found is not None:
                yield found[0].decode(), at, at + found[1]
                at += found[1]
                continue
            first = text[at]
            size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            yield text[at : at + size].decode(), at, at + size
            at += size

    def normalized(self, text: str) -> tuple[str, np.ndarray]:
        """The text and, for each of its characters and for its end, the place in the UTF-8 source."""
        out: list[str] = []
        places: list[int] = []
        done, started = 0, not self.remove_extra_spaces
        after_space = self.remove_extra_spaces
        prefixed = not self.dummy_prefix
        for new, begin, end in self._steps(text.encode()):
            if not started:
                if new == " ":
                    done = end
                    continue
                started = True
            if not prefixed:
                out.append(self.space)
                places.append(begin)
                prefixed = True
            if after_space:
                new = new.lstrip(" ")
            for character in new:
                out.append(self.space if character == " " else character)
                places.append(begin)
            if new:
                after_space = new.endswith(" ") and self.remove_extra_spaces
            done = end
        if not started:
            done = 0
        if self.remove_extra_spaces:
            while out and out[-1] == self.space:
                out.pop()
                done = places.pop()
        return "".join(out), np.array([*places, done], dtype=np.int64)


# --- merging ---------------------------------------------------------------------------------------------------------


class Codec:
    """Encodes and decodes; holds the memory of frequent parts."""

    def __init__(self, model: Model):
        self.model = model
        self.ids = {p: k for k, p in enumerate(model.pieces)}
        self.merged = {p: k for k, p in enumerate(model.pieces) if model.kinds[k] == NORMAL}
        order = {score: rank for rank, score in enumerate(sorted({model.scores[k] for k in self.merged.values()}, reverse=True))}
        self._ranks, self._none = {p: order[model.scores[k]] for p, k in self.merged.items()}, len(order)
        self.begin, self.end = self.ids.get("<s>"), self.ids.get("</s>")
        self.bytes = {int(p[1:-1], 16): k for k, p in enumerate(model.pieces) if model.kinds[k] == BYTE}
        if not model.byte_fallback or len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        apart = model.normalizer.space == SPACE and not any(regex.search(f"[^{SPACE}]{SPACE}", p) for p in self.merged)
        self._parts = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else r"(?s).+")
        # A text's own spaces and the model's signs for them differ only where the normaliser does more than to replace them.
        self.plain = not len(model.normalizer.units) and not model.normalizer.remove_extra_spaces and model.normalizer.space == SPACE
        self._memo: dict[str, tuple[bytes, bytes]] = {}
        surfaces = []
        for piece, kind in zip(model.pieces, model.kinds, strict=True):
            surface = "" if kind == CONTROL else model.unknown_surface if kind == UNKNOWN else piece.replace(SPACE, " ")
            surfaces.append(surface)
        self._surfaces = surfaces
        self._byte_of = {k: b for b, k in self.bytes.items()}

    def _merge(self, part: str) -> list[str]:
        """The part cut into symbols, neighbours merged by score, best first, leftmost of equal ones first."""
        if len(part) > SHORT:
            return self._merge_long(list(part))
        ranks, none = self._ranks, self._none
        symbols = list(part)
        pairs = [ranks.get(a + b, none) for a, b in pairwise(symbols)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            at = pairs.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(symbols[at] + symbols[at + 1], none)
            if at:
                pairs[at - 1] = ranks.get(symbols[at - 1] + symbols[at], none)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a queue of pairs, for parts where going through all pairs again and again would be too slow."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        scores, merged = self.model.scores, self.merged
        queue: list[tuple[float, int, int, str]] = []

        def offer(a: int, b: int) -> None:
            joined = symbols[a] + symbols[b]
            k = merged.get(joined)
            if k is not None:
                heapq.heappush(queue, (-scores[k], a, b, joined))

        for k in range(n - 1):
            offer(k, k + 1)
        while queue:
            _, a, b, joined = heapq.heappop(queue)
            if not symbols[a] or not symbols[b] or symbols[a] + symbols[b] != joined or after[a] != b:
                continue
            symbols[a], symbols[b] = joined, ""
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
                offer(a, after[b])
            if before[a] >= 0:
                offer(before[a], a)
        return [s for s in symbols if s]

    def _spelt(self, character: str) -> tuple[list[int], list[int]]:
        own = character.encode()
        return [self.bytes[b] for b in own], [0] * (len(own) - 1) + [1]

    def _part(self, part: str) -> tuple[bytes, bytes]:
        """(ids, normalised characters that each of them ends) of a part, packed; a byte piece that is not its character's
        last one ends none."""
        found = self._memo.get(part)
        if found is not None:
            return found
        symbols = self._merge(part)
        ids = [self.merged.get(symbol, -1) for symbol in symbols]
        sizes = [len(symbol) for symbol in symbols]
        if -1 in ids:
            spelt = [([k], [n]) if k >= 0 else self._spelt(symbol) for symbol, k, n in zip(symbols, ids, sizes, strict=True)]
            ids, sizes = [k for own, _ in spelt for k in own], [n for _, own in spelt for n in own]
        found = array("I", ids).tobytes(), array("I", sizes).tobytes()
        if len(part) <= MEMO_LENGTH and len(self._memo) < MEMO_ENTRIES:
            self._memo[part] = found
        return found

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends): the pieces' ids and the spans of the UTF-8 source they stand for, without begin and end ids."""
        normalizer = self.model.normalizer
        if self.plain and text:
            normal = (SPACE if normalizer.dummy_prefix else "") + text.replace(" ", SPACE)
            places = _byte_places(text)
            if normalizer.dummy_prefix:
                places = np.concatenate([[0], places])
        else:
            normal, places = normalizer.normalized(text)
        if not normal:
            nothing = np.zeros(0, dtype="<u4")
            return nothing, nothing, nothing
        memo, part_of = self._memo, self._part
        found = [memo.get(part) or part_of(part) for part in self._parts.findall(normal)]
        ids = np.frombuffer(b"".join([f[0] for f in found]), dtype=np.uint32)
        sizes = np.frombuffer(b"".join([f[1] for f in found]), dtype=np.uint32)
        until = np.cumsum(sizes, dtype=np.int64)
        begins, ends = places[until - sizes], places[until]
        inside = np.flatnonzero(sizes == 0)
        ends[inside] = begins[inside]
        return ids, begins.astype("<u4"), ends.astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the model's own first space is left out, broken runs of byte pieces become replacement characters."""
        surfaces = self._surfaces
        listed = ids.tolist()
        first = next((k for k in listed if self.model.kinds[k] != CONTROL), None)
        if not self._byte_of.keys().isdisjoint(listed):
            parts, run = [], bytearray()
            for k in [*listed, None]:
                byte = self._byte_of.get(k)
                if byte is not None:
                    run.append(byte)
                    continue
                if run:
                    parts.append(_characters(bytes(run)))
                    run = bytearray()
                if k is not None:
                    parts.append(surfaces[k])
        else:
            parts = [surfaces[k] for k in listed]
        text = "".join(parts)
        normalizer = self.model.normalizer
        if first is not None and self.model.pieces[first].startswith(SPACE) and (normalizer.dummy_prefix or normalizer.remove_extra_spaces):
            text = text.lstrip(" ") if normalizer.remove_extra_spaces else text[1:]
        return text


def _characters(data: bytes) -> str:
    """UTF-8 where it is whole; each byte that is not part of a character is a replacement character."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def _byte_places(text: str) -> np.ndarray:
    """The place in UTF-8 of each character and of the end."""
    if text.isascii():
        return np.arange(len(text) + 1)
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))


@lru_cache(maxsize=1)
def codec(path: str | None = None) -> Codec:
    """The codec of a model file; a worker keeps it from task to task."""
    import public_tokenizers

    with open(path or public_tokenizers.path(MODEL), "rb") as file:
        return Codec(Model.parsed(file.read()))


# --- the operator ----------------------------------------------------------------------------------------------------


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Each text's ids with begin and end ids, the spans of original bytes, and what the ids decode to, as in ``SCHEMA``.

    ``ids``, ``begins`` and ``ends`` are packed as little-endian unsigned 32-bit integers; :func:`pieces` unfolds them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        head, tail = np.array([own.begin], dtype="<u4"), np.array([own.end], dtype="<u4")
        for batch in slices(batches, "text", SLICE_BYTES):
            columns: tuple[list, ...] = ([], [], [], [], [])
            for text in batch.column("text").to_pylist():
                text = text or ""
                ids, begins, ends = own.encode(text)
                ids = np.concatenate([head, ids, tail])
                last = np.array([len(text.encode())], dtype="<u4")
                none = np.zeros(1, dtype="<u4")
                row = (
                    len(ids), ids.tobytes(), np.concatenate([none, begins, last]).astype("<u4").tobytes(),
                    np.concatenate([none, ends, last]).astype("<u4").tobytes(), own.decode(ids),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, type=t) for c, t in zip(columns, types, strict=True)]],
                names=["doc_id", "n_tokens", "ids", "begins", "ends", "decoded"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def pieces(encoded: DataFrame) -> DataFrame:
    """``(doc_id, place, id, begin, end)``: one row per id of an encoded table, with its span of original bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, begins, ends = (np.frombuffer(row[c], dtype="<u4").astype(np.int64) for c in ("ids", "begins", "ends"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_id"]] * len(ids), type=pa.int64()), *[pa.array(x) for x in (np.arange(len(ids)), ids, begins, ends)]],
                    names=["doc_id", "place", "id", "begin", "end"],
                )

    return encoded.select("doc_id", "ids", "begins", "ends").mapInArrow(run, "doc_id long, place long, id long, begin long, end long")


def op12_pieces(spark: SparkSession, folder: str) -> DataFrame:
    encoded = encode(read_table(spark, folder, "documents"))
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
