"""Suffix-array dedup: bytes of passages that an earlier document has are removed.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document of a
smaller id.  Every such string (a window) holds one smallest ``GRAM``-byte gram, by hash.
Windows that follow each other and have the same smallest gram are one region; regions are
dealt to partitions by that gram, so equal windows always meet, and each window is
dealt once.

In a partition documents come in batches of rising ids.  A batch gets a sparse suffix array:
the suffixes that start at its regions' grams, by their first bytes.  It is merge-scanned against
the suffix array of each level of a logarithmic family; suffixes that agree in the gram
are matched on both sides of it, window by window, byte by byte.  The batch then becomes a
level of size 1, without the regions that earlier ones hold whole, and levels of equal size
merge until all sizes differ.

Copies of a text, and of a region, within one task's buffer are decided there, so a group of
copies leaves one region a buffer.  Grams that a sample of the documents finds in very many
different regions (the ends of a common passage) are dealt by whole windows instead; the
sample decides only where windows meet, never which are equal.

Defined results: a null text counts as empty in the number of bytes and stays null; a null
id is not smaller or larger than any, so such rows keep all bytes and remove none; rows of
the same id do not remove from each other, and are told apart by their texts; repeated rows
get the same result; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfacts.llm.common import ship, staged
from callfacts.llm.quality_rules import free_name

LENGTH = 50
GRAM = 12
BATCHES = 4
PART_BYTES = 12 << 20  # text whose regions one partition holds
BUFFER_BYTES = 12 << 20  # text that a task deals at a time
MATCH_REGIONS = 20_000  # regions whose windows are compared at a time
HOT_REGIONS = 100_000  # different regions of one gram that a partition takes
SAMPLE = 512  # one document in so many is looked at for such grams

_SPAN = np.dtype([("doc", "<i8"), ("hash", "<i4"), ("start", "<u4"), ("end", "<u4")])
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _eights(buf) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.ndarray(max(0, len(buf) - 7), "<u8", buf, strides=(1,))


def _gram_hashes(buf) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    eight = _eights(buf)
    h = eight[: len(eight) - GRAM + 8] * _M1
    h ^= h >> np.uint64(29)
    h += eight[GRAM - 8 :]
    h *= _M2
    h ^= h >> np.uint64(32)
    h *= _M3
    h ^= h >> np.uint64(31)
    return h


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        h = np.minimum(h[:-step], h[step:])
        done += step
    return h


def regions_of(buf: bytes, sizes: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(document, first byte, end, gram hash)`` of the regions of texts that follow each other in ``buf``."""
    none = np.empty(0, np.int64)
    if len(buf) < length:
        return none, none, none, none.astype(np.uint64)
    least = _sliding_least(_gram_hashes(buf), length - GRAM + 1)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    whole = np.arange(len(least)) + length <= ends[text]
    fresh = np.empty(len(least), bool)
    fresh[0] = True
    np.not_equal(least[1:], least[:-1], out=fresh[1:])
    fresh[1:] |= text[1:] != text[:-1]
    first = np.flatnonzero(fresh & whole)  # windows that cross a text's end come last in it
    after = np.flatnonzero((fresh | ~whole)[1:]) + 1
    stop = np.append(after, len(least))[np.searchsorted(after, first, side="right")]
    return text[first], first - (ends - sizes)[text[first]], stop - 1 + length - (ends - sizes)[text[first]], least[first]


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, which compresses better than number by number."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unplanes(data: bytes, dtype: str, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(dtype).ravel() if n else np.empty(0, dtype)


def _packed(docs: np.ndarray, hashes: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, text: bytes) -> bytes:
    parts = [_planes(x) for x in (np.diff(docs, prepend=0).astype("<i8"), hashes.astype("<i4"), np.diff(doc, prepend=0).astype("<i4"), start.astype("<u4"), size.astype("<u4"))]
    return zstandard.compress(struct.pack("<II", len(docs), len(doc)) + b"".join(parts) + text, 3)


def _unpacked(blob: bytes) -> tuple:
    raw = zstandard.decompress(blob)
    n, m = struct.unpack_from("<II", raw)
    at, out = 8, []
    for dtype, k in (("<i8", n), ("<i4", n), ("<i4", m), ("<u4", m), ("<u4", m)):
        end = at + int(dtype[-1]) * k
        out.append(_unplanes(raw[at:end], dtype, k))
        at = end
    docs, hashes, doc, start, size = out
    doc = np.cumsum(doc)
    return np.cumsum(docs)[doc], hashes[doc], start.astype(np.int64), size.astype(np.int64), raw[at:]


class Dealer:
    """Regions of a task's documents as blobs for partitions and batches, and the spans decided here."""

    def __init__(self, parts: int, cuts: list[int], hot: np.ndarray):
        self.parts, self.cuts, self.hot = parts, cuts, hot

    def deal(self, rows: list[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, bytes]]:
        """``rows``: id, hash of the text, text.  Yields ``(partition, batch, blob)``; spans have batch -1."""
        rows = sorted(set(rows))
        first = {text: i for i, _, text in reversed(rows)}
        copies = [(i, h, 0, len(text)) for i, h, text in rows if first[text] < i]
        rows = [r for r in rows if first[r[2]] == r[0]]
        ids = np.fromiter((i for i, _, _ in rows), np.int64, len(rows))
        hashes = np.fromiter((h for _, h, _ in rows), np.int32, len(rows))
        found, regions = [], []
        at = 0
        while at < len(rows):  # a few texts at a time, for the sake of memory
            end, size = at, 0
            while end < len(rows) and (size == 0 or size + len(rows[end][2]) <= 2 << 20):
                size += len(rows[end][2])
                end += 1
            doc, start, part, own = self._regions([text for _, _, text in rows[at:end]])
            found.append((doc + at, start, part))
            regions += own
            at = end
        doc, start, part = (np.concatenate(x) for x in zip(*found)) if found else [np.empty(0, np.int64)] * 3
        n = len(regions)
        size = np.fromiter(map(len, regions), np.int64, n)
        place = dict(zip(reversed(regions), range(n - 1, -1, -1)))  # the first of equal regions, which has the least id
        head = np.fromiter(map(place.__getitem__, regions), np.int64, n)
        later = ids[doc[head]] < ids[doc]
        spans = np.empty(int(later.sum()) + len(copies), _SPAN)
        spans[len(spans) - len(copies) :] = copies
        gone = doc[later]
        for name, values in (("doc", ids[gone]), ("hash", hashes[gone]), ("start", start[later]), ("end", start[later] + size[later])):
            spans[name][: len(gone)] = values
        left = np.flatnonzero(~later)
        batch = np.searchsorted(np.array(self.cuts, np.int64), ids)[doc[left]]
        order = np.lexsort((batch, part[left]))
        left, key = left[order], (part[left] * (len(self.cuts) + 1) + batch)[order]
        edges = np.flatnonzero(np.diff(key, prepend=-1, append=-1)) if len(key) else []
        for a, b in zip(edges[:-1], edges[1:]):
            mine = left[a:b]
            own, number = np.unique(doc[mine], return_inverse=True)
            text = b"".join([regions[i] for i in mine.tolist()])
            p, k = divmod(int(key[a]), len(self.cuts) + 1)
            yield p, k, _packed(ids[own], hashes[own], number, start[mine], size[mine], text)
        yield from span_blobs(spans, self.parts)

    def _regions(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Document, first byte, partition and bytes of each region; windows of hot grams are regions of their own."""
        buf, sizes = b"".join(texts), np.array([len(t) for t in texts])
        doc, start, stop, gram = regions_of(buf, sizes)
        part = ((gram >> np.uint64(20)) % np.uint64(self.parts)).astype(np.int64)
        before = (np.cumsum(sizes) - sizes)[doc]
        hot = np.isin(gram, self.hot)
        if hot.any():
            count = stop[hot] - start[hot] - LENGTH + 1
            at = _ranges(start[hot], count)
            rest = ~hot
            doc, before = (np.concatenate([x[rest], np.repeat(x[hot], count)]) for x in (doc, before))
            start, stop = np.concatenate([start[rest], at]), np.concatenate([stop[rest], at + LENGTH])
            own = [buf[a:b] for a, b in zip((before + start).tolist(), (before + stop).tolist())]
            new = [xxhash.xxh3_64_intdigest(r) % self.parts for r in own[int(rest.sum()) :]]
            return doc, start, np.concatenate([part[rest], np.array(new, np.int64)]), own
        return doc, start, part, [buf[a:b] for a, b in zip((before + start).tolist(), (before + stop).tolist())]


def span_blobs(spans: np.ndarray, parts: int) -> Iterator[tuple[int, int, bytes]]:
    """Spans by document, as ``(partition, -1, blob)``."""
    spans = spans.astype(_SPAN, copy=False)
    where = ((spans["doc"].astype(np.uint64) * _M1) >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(where, kind="stable")
    where, spans = where[order], spans[order]
    edges = np.flatnonzero(np.diff(where, prepend=parts + 1, append=parts + 1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(where[a]), -1, zstandard.compress(spans[a:b].tobytes(), 3)


class Level:
    """A sparse suffix array: regions in the order of the suffixes from their grams on.

    ``key`` is the first four bytes of the suffix and then a hash of its gram, so suffixes
    stand in byte order as far as that, and equal grams beside each other.
    """

    def __init__(self, size: int, key: np.ndarray, doc: np.ndarray, at: np.ndarray, length: np.ndarray, text: bytes):
        self.size, self.key, self.doc, self.at, self.length, self.text = size, key, doc, at, length, text

    @classmethod
    def of(cls, doc: np.ndarray, length: np.ndarray, text: bytes) -> tuple[Level, np.ndarray]:
        """A level of size 1 of regions that follow each other in ``text``, and the order they have in it."""
        ends = np.cumsum(length)
        at = ends - length
        key = np.empty(len(at), np.uint64)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(ends, at[a] + (2 << 20), "right")))
            part = text[at[a] : ends[b - 1]]
            h, own = _gram_hashes(part), at[a:b] - at[a]
            place = own + h[own[:, None] + np.arange(LENGTH - GRAM + 1)].argmin(1)
            lead = np.ndarray(len(part) - 3, ">u4", part, strides=(1,))[place].astype(np.uint64)
            key[a:b] = lead << np.uint64(32) | h[place] >> np.uint64(32)
            a = b
        order = np.argsort(key, kind="stable")
        return cls(1, key[order], doc[order], at[order], length[order], text), order

    def merged(self, other: Level) -> Level:
        """Both levels' suffixes in one order."""
        key = np.concatenate([self.key, other.key])
        order = np.argsort(key, kind="stable")
        pick = lambda a, b: np.concatenate([a, b])[order]
        return Level(
            self.size + other.size, key[order], pick(self.doc, other.doc), pick(self.at, other.at + len(self.text)),
            pick(self.length, other.length), self.text + other.text,
        )

    def bytes_of(self, some: np.ndarray) -> bytes:
        text = self.text
        return b"".join([text[a:b] for a, b in zip(self.at[some].tolist(), (self.at[some] + self.length[some]).tolist())])

    def kept(self, mask: np.ndarray) -> Level:
        """Only the regions of ``mask``; the bytes of the others go once they are a quarter of all."""
        at, length, text = self.at[mask], self.length[mask], self.text
        if int(length.sum()) * 4 < len(text) * 3:
            text = self.bytes_of(np.flatnonzero(mask))
            at = np.cumsum(length) - length
        return Level(self.size, self.key[mask], self.doc[mask], at, length, text)


def _ranges(at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions ``at[i]`` to ``at[i] + length[i]``."""
    total = int(length.sum())
    return np.arange(total) + np.repeat(at - (np.cumsum(length) - length), length)


def first_documents(text: bytes, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Per window that starts at ``at`` the smallest document that has the same bytes."""
    eight = _eights(text)
    steps = [*range(0, LENGTH - 8, 8), LENGTH - 8]
    h = np.zeros(len(at), np.uint64)
    for s in steps:
        h ^= eight[at + s]
        h *= _M2
        h ^= h >> np.uint64(29)
    order = np.argsort(h)
    same = np.diff(h[order], prepend=h[order[:1]] ^ np.uint64(1)) == 0
    pairs = np.flatnonzero(same)
    a, b = at[order[pairs]], at[order[pairs - 1]]
    if any((eight[a + s] != eight[b + s]).any() for s in steps):  # equal hashes of unequal bytes
        order = np.array(sorted(range(len(at)), key=lambda i: text[at[i] : at[i] + LENGTH]))
        windows = [text[i : i + LENGTH] for i in at[order].tolist()]
        same = np.array([False, *(x == y for x, y in zip(windows, windows[1:]))])
    heads = np.flatnonzero(~same)
    out = np.empty(len(at), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(doc[order], heads), np.diff(heads, append=len(at)))
    return out


class Family:
    """Levels of falling sizes, each a power of two of batches."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, doc: np.ndarray, length: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes in a batch of larger ids; returns ``(region, start, end)`` of what earlier documents have."""
        new, order = Level.of(doc, length, text)
        heads = np.flatnonzero(np.append(True, new.key[1:] != new.key[:-1]))
        tails = np.append(heads[1:], len(order))
        known = np.minimum.reduceat(new.doc, heads) < np.maximum.reduceat(new.doc, heads)
        keys, within = new.key[heads], [(new, heads, tails)]
        for level in self.levels:  # merge scan: both sides are sorted
            low = np.searchsorted(level.key, keys, "left")
            hit = np.flatnonzero(np.append(level.key, np.uint64(0))[low] == keys) if len(level.key) else np.empty(0, np.int64)
            hit = hit[low[hit] < len(level.key)]
            high = low.copy()
            high[hit] = np.searchsorted(level.key, keys[hit], "right")
            known[hit] = True
            within.append((level, low, high))
        # groups of equal grams, some at a time: about MATCH_REGIONS regions, each group whole
        groups = np.flatnonzero(known)
        sizes = sum((high - low)[groups] for _, low, high in within)
        chunk = np.cumsum(sizes) // MATCH_REGIONS
        left = np.ones(len(order), bool)
        out = [[np.empty(0, np.int64)] * 3]
        for some in np.split(groups, np.flatnonzero(np.diff(chunk)) + 1) if len(groups) else []:
            parts = [(lv, _ranges(low[some], (high - low)[some])) for lv, low, high in within]
            out.append(self._matched(parts, left))
        self.levels.append(new.kept(left))
        while len(self.levels) > 1 and self.levels[-1].size == self.levels[-2].size:
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(large.merged(small))
        region, start, end = (np.concatenate(x) for x in zip(*out))
        return order[region], start, end

    @staticmethod
    def _matched(parts: list[tuple[Level, np.ndarray]], left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches of the first part's regions among all; those held whole by earlier documents leave ``left``."""
        hit = parts[0][1]
        joint = b"".join([*(lv.bytes_of(i) for lv, i in parts), bytes(8)])
        lengths = np.concatenate([lv.length[i] for lv, i in parts])
        count = lengths - LENGTH + 1
        at = _ranges(np.cumsum(lengths) - lengths, count)
        whose = np.repeat(np.concatenate([lv.doc[i] for lv, i in parts]), count)
        mine = int(count[: len(hit)].sum())
        covered = first_documents(joint, at, whose)[:mine] < whose[:mine]
        own, region = count[: len(hit)], np.repeat(hit, count[: len(hit)])
        begins = np.cumsum(own) - own
        left[hit[np.logical_and.reduceat(covered, begins)]] = False
        fresh = np.zeros(mine, bool)
        fresh[begins] = True
        before = np.append(False, covered[:-1]) & ~fresh
        after = np.append(covered[1:], False) & ~np.append(fresh[1:], True)
        place = np.arange(mine) - np.repeat(begins, own)
        first, last = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after)
        return region[first], place[first], place[last] + LENGTH


def _by_group(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[bytes]]]:
    """Runs of rows that are equal in all but the last column, with the values of that."""
    key, held = None, []
    for b in batches:
        for *k, blob in zip(*(c.to_pylist() for c in b.columns)):
            if tuple(k) != key:
                if held:
                    yield key, held
                key, held = tuple(k), []
            held.append(blob)
    if held:
        yield key, held


_BLOBS = "part int, batch int, blob binary"


def _blob_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * 3
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()))], names=["part", "batch", "blob"])


def _rows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[tuple]]:
    """Rows in lists of about ``limit`` bytes of text, which stands last."""
    held, size = [], 0
    for whole in batches:
        for cut in range(0, whole.num_rows, 200):
            for row in zip(*(c.to_pylist() for c in whole.slice(cut, 200).columns)):
                held.append(row)
                size += len(row[-1])
                if size >= limit:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def hot_grams(texts: DataFrame, hot_regions: int, sample: int) -> list[int]:
    """Grams of more than ``hot_regions`` different regions, by a sample of the documents.

    At most one gram for every ``hot_regions`` regions of the corpus can be one of these.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows(batches, 2 << 20):
            found = [t for (t,) in rows]
            doc, start, stop, gram = regions_of(b"".join(found), np.array([len(t) for t in found]))
            own = {(found[d][s:e], g) for d, s, e, g in zip(doc.tolist(), start.tolist(), stop.tolist(), gram.view(np.int64).tolist())}
            grams, n = np.unique(np.fromiter((g for _, g in own), np.int64, len(own)), return_counts=True)
            yield pa.record_batch([pa.array(grams), pa.array(n)], names=["gram", "n"])

    chosen = texts.where(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(sample)) == 0).select("text")
    counts = chosen.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return [r[0] for r in counts.where(F.col("n") * sample > hot_regions).select("gram").collect()]


def spans(texts: DataFrame, parts: int, cuts: list[int], hot: list[int]) -> DataFrame:
    """``(id, hash, spans)`` of the documents that lose bytes; ``texts``: id, hash and binary text."""
    held = texts.sparkSession.sparkContext.broadcast(np.array(hot, np.int64).view(np.uint64))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = Dealer(parts, cuts, held.value)
        for rows in _rows(batches, BUFFER_BYTES):
            out, size = [], 0
            for row in dealer.deal(rows):
                out.append(row)
                size += len(row[2])
                if size > 4 << 20:
                    yield _blob_batch(out)
                    out, size = [], 0
            yield _blob_batch(out)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, family = None, Family()
        for (p, batch), blobs in _by_group(batches, 2):
            if batch < 0:  # spans pass through, to their documents
                yield _blob_batch([(p, -1, b) for b in blobs])
                continue
            if p != part:
                part, family = p, Family()
            doc, hashed, start, size, text = zip(*map(_unpacked, blobs))
            doc, hashed, start, size = (np.concatenate(x) for x in (doc, hashed, start, size))
            region, a, b = family.add(doc, size, b"".join(text))
            found = np.empty(len(region), _SPAN)
            found["doc"], found["hash"] = doc[region], hashed[region]
            found["start"], found["end"] = start[region] + a, start[region] + b
            yield _blob_batch(list(span_blobs(found, parts)))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_group(batches, 1):
            s = np.frombuffer(b"".join(map(zstandard.decompress, blobs)), _SPAN)
            s = np.sort(s, order=["doc", "hash", "start", "end"])
            fresh = np.append(True, (s["doc"][1:] != s["doc"][:-1]) | (s["hash"][1:] != s["hash"][:-1]))
            # the furthest end so far in the document: documents are set apart by an offset
            base = np.cumsum(fresh).astype(np.int64) << 32
            reach = np.maximum.accumulate(base + s["end"])
            first = np.flatnonzero(fresh | np.append(True, base[1:] + s["start"][1:] > reach[:-1]))
            last = np.append(first[1:], len(s)) - 1
            runs = np.column_stack([s["start"][first], reach[last] - base[last]]).astype("<u4")
            heads = np.flatnonzero(fresh[first])
            tails = np.append(heads[1:], len(first))
            data = [runs[x:y].tobytes() for x, y in zip(heads.tolist(), tails.tolist())]
            owner = s[first[heads]]
            yield pa.record_batch(
                [pa.array(owner["doc"]), pa.array(owner["hash"]), pa.array(data, pa.binary())], names=["id", "hash", "spans"]
            )

    dealt = texts.mapInArrow(deal, _BLOBS).repartition(parts, "part").sortWithinPartitions("part", "batch")
    matched = dealt.mapInArrow(match, _BLOBS).select("part", "blob").repartition(parts, "part").sortWithinPartitions("part")
    return matched.mapInArrow(join, "id long, hash int, spans binary")


def without(text: bytes | None, runs: bytes | None) -> bytes | None:
    """The text without the bytes of its spans."""
    if text is None or not runs:
        return text
    out, at = [], 0
    for a, b in np.frombuffer(runs, "<u4").reshape(-1, 2).tolist():
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: int = BATCHES,
    part_bytes: int = PART_BYTES,
    hot_regions: int = HOT_REGIONS,
    sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary) last.

    ``kept`` is the whole text where nothing was removed; cuts may fall within a letter.
    """
    ship(docs.sparkSession)
    i, h, s, out = (free_name(docs, x) for x in ("_id", "_hash", "_spans", "_cut"))
    keyed = docs.withColumn(i, F.col(id_col).cast("long")).withColumn(h, F.hash(text_col))
    slim = keyed.select(F.col(i).alias("id"), F.col(h).alias("hash"), F.col(text_col).cast("binary").alias("text"))
    slim = slim.where(F.col("id").isNotNull() & (F.octet_length("text") >= LENGTH))
    at = [k / batches for k in range(1, batches)]
    facts = slim.agg(F.sum(F.octet_length("text")), F.percentile_approx("id", at, 1000)).first()
    parts, cuts = max(1, (facts[0] or 0) // part_bytes + 1), sorted(set(facts[1] or []))
    found = staged(spans(slim, parts, cuts, hot_grams(slim, hot_regions, sample)), "byte_spans")
    found = found.select(F.col("id").alias(i), F.col("hash").alias(h), F.col("spans").alias(s))
    joined = keyed.join(found, [i, h], "left")

    def cut(texts: pa.Array, runs: pa.Array) -> pa.Array:
        return pa.array([without(t.as_py(), r.as_py()) for t, r in zip(texts, runs)], pa.binary())

    text = F.col(text_col).cast("binary")
    kept = F.when(F.col(s).isNull(), text).otherwise(F.arrow_udf(cut, "binary")(text, F.col(s)))
    n = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    done = joined.withColumn(out, kept).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        n.alias(free_name(docs, "n_bytes")),
        (n - F.coalesce(F.octet_length(out), F.lit(0))).alias(free_name(docs, "n_removed")),
        F.coalesce(F.octet_length(s) / 8, F.lit(0)).cast("long").alias(free_name(docs, "n_spans")),
        F.col(out).alias(free_name(docs, "kept")),
    )
    return done
