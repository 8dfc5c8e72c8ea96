"""Spark's ``xxhash64`` of strings, for whole Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
SEED = 42


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(v: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turned(v + word * _P2, 31) * _P1


def _of_width(rows: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Hashes of texts of one width, a row of bytes each."""
    n, width = rows.shape
    at = width // 32 * 32
    lanes = np.ascontiguousarray(rows[:, : width // 8 * 8]).view("<u8").astype(np.uint64)
    if at:
        v = [seed + _P1 + _P2, seed + _P2, seed.copy(), seed - _P1]
        for k in range(at // 8):
            v[k % 4] = _round(v[k % 4], lanes[:, k])
        out = _turned(v[0], 1) + _turned(v[1], 7) + _turned(v[2], 12) + _turned(v[3], 18)
        for own in v:
            out = (out ^ _round(np.zeros(n, dtype=np.uint64), own)) * _P1 + _P4
    else:
        out = seed + _P5
    out = out + np.uint64(width)
    for k in range(at // 8, width // 8):
        out = _turned(out ^ _round(np.zeros(n, dtype=np.uint64), lanes[:, k]), 27) * _P1 + _P4
    at = width // 8 * 8
    if width - at >= 4:
        out = _turned(out ^ (np.ascontiguousarray(rows[:, at : at + 4]).view("<u4")[:, 0].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at += 4
    for k in range(at, width):
        out = _turned(out ^ (rows[:, k].astype(np.uint64) * _P5), 11) * _P1
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    return out ^ (out >> np.uint64(32))


def xxhash64(texts: pa.Array, seed: np.ndarray | None = None) -> np.ndarray:
    """``xxhash64`` of each text, as unsigned numbers; with ``seed``, those of the columns before."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    widths = np.diff(offsets)
    out = np.full(len(texts), SEED, dtype=np.uint64) if seed is None else seed.astype(np.uint64)
    order = np.argsort(widths, kind="stable")
    cuts = [0, *(np.flatnonzero(np.diff(widths[order])) + 1).tolist(), len(order)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = order[a:b]
        if len(own):
            rows = data[offsets[own][:, None] + np.arange(widths[own[0]])]
            out[own] = _of_width(rows.reshape(len(own), -1), out[own])
    return out
