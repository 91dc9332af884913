"""Best-fit packing of tokenised documents by the sum-of-squares rule.

Documents become token ids and an end id; only documents longer than a sequence
are cut, into pieces of a whole sequence and a rest. Pieces are dealt by a hash
into groups of about ``group_rows``, each packed in one task: longest first, a
piece goes where the sum over all residual gaps of the squared count of open
sequences with that gap becomes smallest (a new sequence is one of the choices;
the smaller gap wins a tie). The rule needs only the counts for each gap, one
array of ``capacity`` numbers, whatever the number of pieces. What a group
leaves open is at most a few sequences, so the total stays within one or two
per group of the least possible.

Token ids are only counted and check-summed by default; ``with_ids`` returns them.

Edge cases: a null text is empty, and an empty text is the end id alone. Rows
that repeat an id are packed each, and their pieces can't be told apart. An
empty table gives an empty result.
"""

from __future__ import annotations

import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import slices

CACHE_WORDS = 500_000
CACHE_PARTS = 200_000
_cache: dict[str, "WordIds"] = {}

#: Fixed values of byte-level vocabularies: the character that stands for each byte.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_CHAR = {b: chr(b) for b in _KEPT} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _KEPT)}


class WordIds(dict):
    """Token ids of words between white space, as little-endian 32-bit numbers.

    A dictionary that fills itself: ``b"".join(map(words.__getitem__, split))`` are
    the ids of a text. Valid for tokenizers whose tokens never hold ASCII white
    space. Words of characters below U+0250 are cut by the tokenizer's own pattern
    (after lower-casing) and each part goes to the tokenizer's model; any other
    word, and any that may hold a special token, goes through the whole
    tokenizer. Words and parts start anew at ``CACHE_WORDS`` and ``CACHE_PARTS``
    entries, so a worker holds about 150 MB at most.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lowers = "Lowercase" in [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = [x["pattern"]["Regex"] for x in steps if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]]
        self.fast = lowers and len(cuts) == 1 and [x["type"] for x in steps] == ["Split", "ByteLevel"]
        self.cut = regex.compile(cuts[0]).findall if self.fast else None
        # whether the pattern keeps a run of letters whole: no earlier choice of it starts with a letter
        choices = cuts[0].split("|") if self.fast else []
        self.letters = r"[\p{L}]+" in choices and all(x[0] == "'" for x in choices[:choices.index(r"[\p{L}]+")])
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            self.clear()
        text = word.decode()
        if self.fast and b"<|" not in word and (text.isascii() or max(text) < "\u0250"):
            text = text.lower()
            cut = [text] if self.letters and text.isalpha() else self.cut(text)
            ids = b"".join([self.parts.get(x) or self._part(x) for x in cut])
        else:
            ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        plain = part if part.isascii() and part.isalnum() else part.encode().decode("latin-1").translate(_CHAR)
        if len(self.parts) >= CACHE_PARTS:
            self.parts.clear()
        ids = self.parts[part] = _packed([t.id for t in self.model.tokenize(plain)])
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        return b"".join(map(self.__getitem__, text.encode().split()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _tokenizer(path: str) -> WordIds:
    if path not in _cache:
        _cache[path] = WordIds(path)
    return _cache[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32 (and ids)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""

    end, width = _packed([end_id]), 4 * capacity

    def pieces(batches):
        words = _tokenizer(tokenizer_path)
        for batch in chain.from_iterable(slices(b, text_col) for b in batches):
            out: list[list] = [[] for _ in range(6)]
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = words.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at:at + width]
                    for column, value in zip(out, (i, k, at // 4, len(part) // 4, zlib.crc32(part),
                                                   np.frombuffer(part, "<i4") if with_ids else None)):
                        column.append(value)
            columns = [batch.column(0).take(pa.array(out[0], pa.int64())), pa.array(out[1], pa.int32()),
                       *(pa.array(x, pa.int64()) for x in out[2:5])]
            columns += [pa.array(out[5], pa.list_(pa.int32()))] if with_ids else []
            names = [id_col, "piece", "start", "length", "ids_crc32", "ids"][:len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(pieces, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (numbered from 0) and offset of each length, packed in the order given."""
    count = np.zeros(capacity + 1, dtype=np.int64)  # open sequences by gap; full ones are not counted
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    total = 0
    for i, size in enumerate(lengths.tolist()):
        # change of the sum when a sequence goes from gap g to gap g - size
        change = 2 * (count[:capacity + 1 - size] - count[size:]) + 2
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = np.iinfo(np.int64).max
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        gap = int(np.argmin(change))
        if change[gap] <= fresh:
            at = open_by_gap[gap + size].pop()
            count[gap + size] -= 1
            offset[i] = capacity - gap - size
        else:
            at, gap, total = total, capacity - size, total + 1
        sequence[i] = at
        if gap:
            open_by_gap[gap].append(at)
            count[gap] += 1
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 4096, group_rows: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    pieces = pieces.drop("sequence_id", "offset")
    n = max(1, -(-pieces.count() // group_rows))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(id_col, "piece"), F.lit(n)).cast("int"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), (id_col, "ascending"), ("piece", "ascending")])
        group = table.column("_group")[0].as_py()
        sequence, offset = sum_of_squares(table.column("length").to_numpy(), capacity)
        table = table.drop_columns(["_group"])
        return (table.append_column("sequence_id", pa.array(sequence * n + group, pa.int64()))
                .append_column("offset", pa.array(offset, pa.int64())))

    return dealt.groupBy("_group").applyInArrow(fill, schema + ", sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text", group_rows: int = 20_000) -> DataFrame:
    """Tokenise once into a checkpointed narrow table of pieces, then pack it."""
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    return pack(pieces.checkpoint(), capacity, group_rows, id_col)
