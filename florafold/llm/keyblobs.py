"""Hash keys and their owners, packed for the shuffle.

Most of a corpus's n-gram hashes stand in one text only, and finding those that
several texts share means one exchange of them all. Sorted and cut by key range
into a few blobs for each map task and bucket, a key costs about eight bytes on
disk instead of a row, and the work on either side is done by sorting arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

UNIT = 1 << 20  # entries that a map task holds before it packs them


def planes(x: np.ndarray) -> bytes:
    """Bytes of an array, all first bytes first: sorted keys compress well that way."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of 64-bit keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


SCHEMA = "bucket int, keys binary, idx binary, owners binary, extra binary"


def pack(keys: np.ndarray, owner: np.ndarray, extra: np.ndarray, buckets: int, by: np.ndarray | None = None) -> pa.RecordBatch:
    """Entries (key, owner, extra) as one row for each bucket of the keys (or of ``by``).

    ``extra`` belongs to the entry when ``by`` is given, else to the owner.
    """
    of_entry = by is not None
    order = np.lexsort((keys, by)) if of_entry else np.argsort(keys, kind="stable")
    bucket = bucket_of((by if of_entry else keys)[order], buckets)
    keys, owner, extra = keys[order], owner[order], extra[order]
    cut = np.searchsorted(bucket, np.arange(buckets + 1))
    rows = []
    for b in np.unique(bucket).astype(int).tolist():
        part = slice(cut[b], cut[b + 1])
        names, first, idx = np.unique(owner[part], return_index=True, return_inverse=True)
        more = extra[part] if of_entry else extra[part][first]
        rows.append((b, planes(keys[part]), planes(idx.astype(np.uint32)), names.tobytes(), planes(more.astype(np.uint32))))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=["bucket", "keys", "idx", "owners", "extra"])


class Packer:
    """Collects entries and gives a batch of blobs for every ``UNIT`` of them."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.size = buckets, [], 0

    def add(self, keys: np.ndarray, owner: np.ndarray, extra: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, owner, extra))
        self.size += len(keys)
        if self.size >= UNIT:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            yield pack(*(np.concatenate(x) for x in zip(*self.parts)), self.buckets)
        self.parts, self.size = [], 0


def unpack(table: pa.Table, extra_of_owner: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries (key, owner, extra) of a group of blobs."""
    out = []
    for row in zip(*(table.column(c).to_pylist() for c in ("keys", "idx", "owners", "extra"))):
        idx, extra = unplanes(row[1], np.uint32), unplanes(row[3], np.uint32)
        out.append((unplanes(row[0], np.uint64), np.frombuffer(row[2], np.uint64)[idx],
                    extra[idx] if extra_of_owner else extra))
    return tuple(np.concatenate(x) for x in zip(*out))


def shared_only(keys: np.ndarray, owner: np.ndarray, extra: np.ndarray):
    """Distinct (key, owner) entries whose key has two owners or more, and the key's number of owners."""
    order = np.lexsort((owner, keys))
    keys, owner, extra = keys[order], owner[order], extra[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner, extra = keys[new], owner[new], extra[new]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(keys)))
    number = np.repeat(count, count)
    some = number > 1
    return keys[some], owner[some], extra[some], number[some]
