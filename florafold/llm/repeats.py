"""Substring dedup: passages that a document of smaller id holds already.

A window is ``window`` consecutive words of one document. A word goes when a
window over it also starts in a document with a smaller id. All windows are
judged on the input.

The reference is the corpus itself, cut into shards, and each shard has a suffix
automaton. Sending every shard to every document would cost shards x documents,
so a passage goes only to the shard that can match it:

1. Documents with equal word sequences are one class; all but the one of the
   smallest id lose every word that a window covers.
2. Each window is named by its anchor, the k-word gram in it of the smallest
   hash, so equal windows have equal anchors. All anchors meet once, packed
   (``keyblobs``); those of one class alone are dropped. An anchor with
   ``HOT_CLASSES`` classes or more in a part of a map task goes to the meeting as
   one entry, since those classes know already that it is shared.
3. The spans of text around the remaining anchors (the windows that the anchor
   names, 20 words at most) go to the shard of their anchor. Equal spans count once,
   with their smallest id. Spans of a hot anchor, one of ``HOT_CLASSES`` classes or
   more, are cut into their windows first, and each goes to the shard of its own
   hash: equal windows still meet, and no shard holds all texts around one line. A shard inserts its spans into suffix automata whose
   states know the smallest id of their occurrences, then streams the spans and
   reads at each word the state of the last ``window`` words.
4. The smallest ids of a span's windows go back to its places by an equi-join
   on the span's hash; the texts take part in one exchange, by id.

Words are runs between ASCII white space, unchanged. Anchors and spans are
64-bit hashes, the words within a span 32-bit hashes.

Edge cases: null and empty texts have no words. A text without a window keeps
all words. Rows that repeat an id are the same document and take nothing from
each other. Rows with a null id neither lose words nor count for others. Ids are
integers. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .hot import group_facts, per_salt, salt
from .keyblobs import SCHEMA, Packer, bucket_of, pack, shared_only, unpack
from .words import _BASE, Words, _power_tables, grams, inside, mix, slices

ANCHOR = 8  # words of an anchor
HOT_CLASSES = 1000  # from so many classes on, the windows of an anchor are dealt one by one
BUCKET_BYTES = 1 << 28  # of input for each bucket, where that makes more buckets than shuffle partitions
SHARD_WORDS = 50_000  # an automaton takes whole groups of one anchor until it has so many words

_none = np.zeros(0, np.int64)


def sequences(h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch ``h[start:end]``."""
    base, inverse = _power_tables(len(h) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h + np.uint64(3)) * base[:len(h)])])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(_BASE))


def anchored(words: Words, h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor place: first window, number of windows, anchor."""
    ok = inside(words, window)
    at = np.flatnonzero(ok)
    if not len(at):
        return _none, _none, np.zeros(0, np.uint64)
    g = grams(h, ANCHOR)
    view = np.lib.stride_tricks.sliding_window_view(mix(g + np.uint64(5)), window - ANCHOR + 1)
    place = at + view[at].argmin(axis=1)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return at[first], np.diff(np.append(first, len(at))), g[place[first]]


class Automaton:
    """A suffix automaton of several word sequences; states know the smallest id of their occurrences."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [np.iinfo(np.int64).max]

    def add(self, sequence: list[int], who: int) -> None:
        nxt, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for w in sequence:
            q = nxt[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q  # an earlier sequence has been here
            else:
                p, old = last, q
                if old is None:
                    last = len(nxt)
                    nxt.append({})
                    length.append(length[p] + 1)
                    link.append(0)
                    least.append(who)
                    while p >= 0 and w not in nxt[p]:
                        nxt[p][w] = last
                        p = link[p]
                    q = nxt[p][w] if p >= 0 else None
                if q is not None and q != last:
                    if length[q] == length[p] + 1:
                        link[last] = q
                    else:
                        copy = len(nxt)
                        nxt.append(dict(nxt[q]))
                        length.append(length[p] + 1)
                        link.append(link[q])
                        least.append(least[q])
                        while p >= 0 and nxt[p].get(w) == q:
                            nxt[p][w] = copy
                            p = link[p]
                        link[q] = copy
                        if old is None:
                            link[last] = copy
                        else:
                            last = copy
            if who < least[last]:
                least[last] = who

    def finish(self) -> None:
        """Give each state the smallest id of all states whose sequences end with its own."""
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[v]
            if self.least[v] < self.least[up]:
                self.least[up] = self.least[v]

    def windows(self, sequence: list[int], window: int) -> list[int]:
        """Matching statistics cut to the window: the smallest id for each window of an added sequence."""
        out, at = [], 0
        nxt, link, length, least = self.next, self.link, self.length, self.least
        for i, w in enumerate(sequence):
            at = nxt[at][w]
            while length[link[at]] >= window:
                at = link[at]
            if i >= window - 1:
                out.append(least[at])
        return out


def span_minima(anchor: np.ndarray, sequences_: list[list[int]], who: np.ndarray, window: int) -> list[list[int]]:
    """For each span (sorted by anchor) the smallest id of each of its windows among the spans of its anchor."""
    out: list[list[int]] = []
    cut = np.append(np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])), len(anchor)).tolist()
    at = 0
    while at < len(cut) - 1:
        lo, size, to = cut[at], 0, at
        if cut[at + 1] - lo == 1:  # alone with its anchor: no other text has one of its windows
            out.append([int(who[lo])] * (len(sequences_[lo]) - window + 1))
            at += 1
            continue
        while to < len(cut) - 1 and (to == at or size < SHARD_WORDS) and cut[to + 1] - cut[to] > 1:
            size += sum(map(len, sequences_[cut[to]:cut[to + 1]]))
            to += 1
        automaton = Automaton()
        for i in range(lo, cut[to]):
            automaton.add(sequences_[i], int(who[i]))
        automaton.finish()
        out += [automaton.windows(sequences_[i], window) for i in range(lo, cut[to])]
        at = to
    return out


def _names(words: Words, h: np.ndarray) -> np.ndarray:
    return sequences(h, words.first[:-1], words.first[1:])


class _Anchors(Packer):
    """Entries (anchor, class); those of anchors that are hot in a unit alone skip the meeting.

    Their blobs are in the buckets of their classes, numbered from ``buckets`` on.
    The meeting gets one entry for them: the anchor as its own owner, extra 1.
    """

    def __init__(self, buckets: int, hot: int):
        super().__init__(buckets)
        self.hot = hot

    def flush(self):
        if self.size:
            key, name, _ = (np.concatenate(x) for x in zip(*self.parts))
            order = np.lexsort((name, key))
            key, name = key[order], name[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            key, name = key[new], name[new]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(first, len(key)))
            hot = np.repeat(count >= self.hot, count)
            some = key[first][count >= self.hot]
            yield pack(np.concatenate([key[~hot], some]), np.concatenate([name[~hot], some]),
                       np.concatenate([np.zeros(int((~hot).sum()), np.uint32), np.ones(len(some), np.uint32)]), self.buckets)
            if len(some):
                direct = pack(key[hot], name[hot], np.ones(int(hot.sum()), np.uint32), self.buckets, name[hot])
                yield direct.set_column(0, "bucket", pc.add(direct.column(0), pa.scalar(self.buckets, pa.int32())))
        self.parts, self.size = [], 0


def _shared_anchors(docs: DataFrame, text_col: str, window: int, buckets: int) -> DataFrame:
    """(class, anchors, hot): the anchors of a class that another class has too, sorted, and the hot ones of them."""
    hot_classes = HOT_CLASSES

    def entries(batches):
        packer, known = _Anchors(buckets, hot_classes), set()
        for b in batches:
            for s in slices(b, text_col):
                words = Words(s.column(0))
                h = words.hashes()
                name = _names(words, h)
                first = np.zeros(s.num_rows, dtype=bool)
                for i in np.flatnonzero(words.count >= window).tolist():
                    if (c := int(name[i])) not in known:
                        known.add(c)
                        first[i] = True
                start, _, anchor = anchored(words, h, window)
                own = words.doc[start]
                some = first[own]
                yield from packer.add(anchor[some], name[own[some]], np.zeros(int(some.sum()), np.uint32))
            if len(known) > 1_000_000:  # only saves work: equal texts meet again in the buckets
                known.clear()
        yield from packer.flush()

    def shared(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")
        if bucket[0].as_py() >= buckets:  # known as shared already
            return table.set_column(0, "bucket", pc.subtract(bucket, pa.scalar(buckets, pa.int32())))
        key, name, told, number = shared_only(*unpack(table, True))
        hot = (number >= hot_classes) | np.isin(key, key[told > 0])
        # an anchor that one unit alone holds, and told of, has no other entry here
        key, name, hot = key[told == 0], name[told == 0], hot[told == 0]
        batches = [pack(key, name, hot.astype(np.uint32), buckets, name)] if len(key) else []
        return pa.Table.from_batches(batches, table.schema)

    def gather(table: pa.Table) -> pa.Table:
        key, name, hot = unpack(table, False)
        order = np.lexsort((key, name))
        key, name, hot = key[order], name[order], hot[order] > 0
        cut = np.append(np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]])), len(name)).tolist()
        parts = list(zip(cut[:-1], cut[1:]))
        return pa.table({"_class": pa.array(name[cut[:-1]].view(np.int64)),
                         "_anchors": pa.array([key[a:b].tobytes() for a, b in parts], pa.binary()),
                         "_hot": pa.array([key[a:b][hot[a:b]].tobytes() for a, b in parts], pa.binary())})

    blobs = docs.select(text_col).mapInArrow(entries, SCHEMA)
    back = blobs.groupBy("bucket").applyInArrow(shared, SCHEMA)
    return back.groupBy("bucket").applyInArrow(gather, "_class bigint, _anchors binary, _hot binary")


def _listed(anchor: np.ndarray, doc: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which anchors stand in the list of their text."""
    arrays = [np.frombuffer(a or b"", np.uint64) for a in lists.to_pylist()]
    salts = mix(np.arange(len(arrays), dtype=np.uint64) + np.uint64(1))
    wanted = np.concatenate([mix(a ^ salts[i]) for i, a in enumerate(arrays)]) if arrays else np.zeros(0, np.uint64)
    return np.isin(mix(anchor ^ salts[doc]), wanted) if len(anchor) else np.zeros(0, dtype=bool)


def _spans(s: pa.RecordBatch, window: int):
    """The spans of shared anchors in a slice of (id, text, anchors, hot anchors).

    A hot anchor gives a span for each window, dealt by the window's hash.
    """
    words = Words(s.column(1))
    h = words.hashes()
    start, count, anchor = anchored(words, h, window)
    some = _listed(anchor, words.doc[start], s.column(2))
    start, count, anchor = start[some], count[some], anchor[some]
    hot = _listed(anchor, words.doc[start], s.column(3))
    if hot.any():
        number = np.where(hot, count, 1)
        step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        start, anchor, count = np.repeat(start, number) + step, np.repeat(anchor, number), np.repeat(np.where(hot, 1, count), number)
        hot = np.repeat(hot, number)
    key = sequences(h, start, start + count + window - 1)
    return words, h, start, count, np.where(hot, key, anchor), key


_SPAN = "bucket int, anchors binary, keys binary, sizes binary, least binary, many binary, words binary"


def _distinct_spans(joined: DataFrame, window: int, buckets: int) -> DataFrame:
    """Distinct spans of each slice with their smallest id, packed by anchor."""

    def spans(batches):
        for b in batches:
            for s in slices(b, b.schema.names[1], 1 << 20):
                words, h, start, count, anchor, key = _spans(s, window)
                if not len(start):
                    continue
                who = s.column(0).to_numpy(zero_copy_only=False)[words.doc[start]].astype(np.int64)
                order = np.lexsort((who, key, anchor))
                start, count, anchor, key, who = (x[order] for x in (start, count, anchor, key, who))
                first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1])]))
                last = np.append(first[1:], len(key)) - 1
                many = who[first] != who[last]
                start, count, anchor, key, who = (x[first] for x in (start, count, anchor, key, who))
                size = count + window - 1
                small = (h >> np.uint64(32)).astype(np.uint32)
                end = np.cumsum(size)
                body = small[np.arange(end[-1]) + np.repeat(start - (end - size), size)]
                bucket = bucket_of(anchor, buckets).astype(np.int64)
                cut = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
                at = np.concatenate([[0], end])
                rows = [(k, anchor[a:b_].tobytes(), key[a:b_].tobytes(), size[a:b_].astype(np.uint8).tobytes(),
                         who[a:b_].tobytes(), many[a:b_].tobytes(), body[at[a]:at[b_]].tobytes())
                        for k in np.unique(bucket).tolist() for a, b_ in [(cut[k], cut[k + 1])]]
                kinds = [pa.int32()] + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 names=[x.split()[0] for x in _SPAN.split(", ")])

    return joined.mapInArrow(spans, _SPAN)


def _minima(spans: DataFrame, window: int) -> DataFrame:
    """(key, least): the smallest id of each window of a span, for spans that may lose words somewhere."""

    def shard(table: pa.Table) -> pa.Table:
        column = lambda name, kind: np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        anchor, key, size = column("anchors", np.uint64), column("keys", np.uint64), column("sizes", np.uint8).astype(np.int64)
        who, many, body = column("least", np.int64), column("many", bool), column("words", np.uint32)
        place = np.cumsum(size) - size
        order = np.lexsort((who, key, anchor))
        anchor, key, size, who, many, place = (x[order] for x in (anchor, key, size, who, many, place))
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (anchor[1:] != anchor[:-1])]))
        many = np.logical_or.reduceat(many, first) | (who[first] != who[np.append(first[1:], len(who)) - 1])
        anchor, key, size, who, place = (x[first] for x in (anchor, key, size, who, place))
        texts = [body[a:a + n].tolist() for a, n in zip(place.tolist(), size.tolist())]
        least = span_minima(anchor, texts, who, window)
        some = [i for i in range(len(key)) if many[i] or min(least[i]) < who[i]]
        return pa.table({"_key": pa.array(key[some].view(np.int64)), "_least": pa.array([least[i] for i in some], pa.list_(pa.int64()))})

    return spans.groupBy("bucket").applyInArrow(shard, "_key bigint, _least array<bigint>")


def _places(joined: DataFrame, window: int, id_type: str) -> DataFrame:
    """(key, id, class, start): where each span stands."""

    def places(batches):
        for b in batches:
            for s in slices(b, b.schema.names[1]):
                words, h, start, _, _, key = _spans(s, window)
                own = words.doc[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), s.column(0).take(pa.array(own)), pa.array(_names(words, h)[own].view(np.int64)),
                     pa.array((start - words.first[own]).astype(np.int32))], names=["_key", "_id", "_class", "_start"])

    return joined.mapInArrow(places, f"_key bigint, _id {id_type}, _class bigint, _start int")


def _buckets(docs: DataFrame) -> int:
    """As many as shuffle partitions, more for an input of a known and larger size."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES if size < 1 << 60 else 0)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   digest: bool = False) -> DataFrame:
    """One row for each document: id, n_words, n_removed and kept_text, or its kept_sha256 with ``digest``."""
    buckets = _buckets(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    every = docs.select(id_col, text_col)
    docs = every.where(F.col(id_col).isNotNull())

    def names(batches):
        for b in batches:
            for s in slices(b, text_col):
                words = Words(s.column(1))
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array(_names(words, words.hashes()).view(np.int64), mask=words.count < window)],
                    names=[id_col, "_class"])

    rows = salt(docs.mapInArrow(names, f"`{id_col}` {id_type}, _class bigint").where("_class is not null"), id_col).checkpoint()
    facts = group_facts(rows, ["_class"], id_col)
    copies = rows.join(per_salt(facts.where("group_size > 1")), ["_class", "_salt"]).where(F.col("least_id") < F.col(id_col))
    copies = copies.select(F.col(id_col).alias("_id"), "_class", F.lit(-1).alias("_start"), F.array(F.col("least_id").cast("bigint")).alias("_least"))

    anchors = _shared_anchors(docs, text_col, window, buckets)
    wanted = (anchors.join(facts.select("_class", "least_id"), "_class").groupBy(F.col("least_id").alias(id_col))
              .agg(F.collect_list("_anchors").alias("_anchors"), F.collect_list("_hot").alias("_hot")))
    wanted = wanted.select(id_col, *[F.unhex(F.array_join(F.transform(c, F.hex), "")).alias(c) for c in ("_anchors", "_hot")]).hint("shuffle_hash")
    joined = docs.join(wanted, id_col).select(id_col, text_col, "_anchors", "_hot")
    minima = _minima(_distinct_spans(joined, window, buckets), window)
    found = (_places(joined, window, id_type).join(minima, "_key").where(F.exists("_least", lambda x: x < F.col("_id")))
             .select("_id", "_class", "_start", "_least"))
    lost = found.unionByName(copies).groupBy(F.col("_id").alias(id_col)).agg(
        F.collect_list(F.struct("_class", "_start", "_least")).alias("_lost")).hint("shuffle_hash")
    whole = docs.join(lost, id_col, "left").select(id_col, text_col, "_lost")
    nameless = every.where(F.col(id_col).isNull()).select(id_col, text_col, F.lit(None).cast(whole.schema["_lost"].dataType).alias("_lost"))
    kept = "kept_sha256" if digest else "kept_text"

    def cut(batches):
        for b in batches:
            for s in slices(b, text_col):
                n, gone, out = [], [], []
                ids, lists = s.column(0).to_pylist(), s.column(2).to_pylist()
                name = None
                for d, text in enumerate(s.column(1).to_pylist()):
                    words = (text or "").encode().split()
                    n.append(len(words))
                    if lists[d] and len(words) >= window:
                        if name is None:
                            slice_words = Words(s.column(1))
                            name = _names(slice_words, slice_words.hashes()).view(np.int64)
                        lose = np.zeros(len(words), dtype=bool)
                        for x in lists[d]:
                            if x["_class"] == name[d]:
                                if x["_start"] < 0:
                                    lose[:] = True
                                else:
                                    for k, other in enumerate(x["_least"], x["_start"]):
                                        if other < ids[d]:
                                            lose[k:k + window] = True
                        words = [w for w, x in zip(words, lose.tolist()) if not x]
                    gone.append(n[-1] - len(words))
                    text = b" ".join(words)
                    out.append(hashlib.sha256(text).hexdigest() if digest else text.decode())
                yield pa.RecordBatch.from_arrays([s.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                                  pa.array(out, pa.string())], names=[id_col, "n_words", "n_removed", kept])

    return whole.unionByName(nameless).mapInArrow(cut, f"`{id_col}` {id_type}, n_words bigint, n_removed bigint, {kept} string")
