"""Repeated passages: bytes covered by a ``WIDTH``-byte string that also
starts in a document with a smaller doc_id.

Every window of WIDTH bytes has a key, the least hash of its ``GRAM``-byte
strings, so equal windows have equal keys; a run of windows with one key is a
segment.  Keys that occur in one document only cannot repeat and are set
aside; the segments of the other keys are dealt out by key, so that equal
windows meet in one bucket.  There the Burrows-Wheeler transforms of shards of
segments are merged (``bwt_merge``), and the blocks of suffixes with WIDTH
common characters give the least document of every window.  Keys, segments and
spans travel in compressed blocks, one from a task to a part, and a part is as
much as a few MB of texts make.

Skew: equal segments are combined to the least document before they are
shuffled, so a passage held by a third of all documents costs one row a batch;
a key with over ``hot`` documents is dealt out window by window instead, as
the text around a common passage differs from document to document.

Defined results: null text is empty; texts shorter than WIDTH bytes keep all;
rows with the same doc_id never remove bytes of each other; a row with a null
doc_id neither loses nor removes bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bwt_merge import least_owners
from .common import frugal, partitions_for, persist, plan_bytes, table

WIDTH = 50
GRAM = 24
BATCH_BYTES = 1 << 20       # text bytes handled at once in a task
BUCKET_SYMBOLS = 1 << 20    # segment bytes merged at once
HOT_DOCS = 5_000            # documents of a key before it is dealt out by window
HOT_KEYS = 1_000_000        # the threshold rises so that at most so many keys can be hot
SEEN_KEYS = 200_000
HELD_ROWS = 4_000_000       # keys, and bytes of segments, that a task holds before it sends them
HELD_BYTES = 64 << 20
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(flat: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Polynomial hashes (mod 2^64, mixed) of all strings of ``gram`` bytes,
    put together from those of power-of-two length."""
    h, size, total, at = flat.astype(np.uint64) + np.uint64(1), 1, None, 0
    n = len(flat) - gram + 1
    left = gram
    while left:
        if left & size:
            part = h[at:at + n]
            step = np.uint64(pow(BASE, size, 1 << 64))
            total = part.copy() if total is None else total * step + part
            at += size
            left -= size
        if left:
            step = np.uint64(pow(BASE, size, 1 << 64))
            h = h[:-size] * step + h[size:]
            size *= 2
    total ^= total >> np.uint64(32)
    total *= MIX
    return total ^ (total >> np.uint64(29))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    size, m = 1, a
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def segments(texts: list[bytes], width: int = WIDTH, gram: int = GRAM):
    """(row, start, end, key) arrays of the segments of all texts; start and
    end are byte offsets in the row's text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - width + 1, 0)
    none = np.zeros(0, np.int64)
    if not windows.sum():
        return none, none, none, none.astype(np.uint64)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    keys = sliding_min(gram_hashes(flat, gram), width - gram + 1)
    row = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    key = keys[first[row] + offset]
    new = np.ones(len(row), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    s = np.flatnonzero(new)
    last = np.append(s[1:], len(row)) - 1
    return row[s], offset[s], offset[last] + width, key[s]


def text_batches(batch: pa.RecordBatch, column: str, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``size`` bytes together."""
    lengths = np.array([len(v) if v is not None else 0 for v in
                        (x.as_buffer() if x.is_valid else None for x in batch.column(column))], np.int64)
    part = np.cumsum(lengths) // size
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield batch.slice(a, b - a)


# -- rows in blocks ----------------------------------------------------------------

BLOCK = "part int, kind byte, blob binary"


def parts_of(x: np.ndarray, parts: int) -> np.ndarray:
    """The part, of 0 to parts - 1, of each of some integers."""
    mixed = (x.astype(np.int64).view(np.uint64) * np.uint64(BASE)) >> np.uint64(32)
    return ((mixed * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)


def blocks(rows: pa.RecordBatch, part: np.ndarray, parts: int, kind: int = 1) -> Iterator[pa.RecordBatch]:
    """``rows`` as one row (part, kind, blob) a part that has any: what a task
    sends grows with its rows in bytes, not in rows for the JVM to sort."""
    order = np.argsort(part, kind="stable")
    rows = rows.take(pa.array(order))
    at = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(at))
    for i in range(0, len(full), 64):
        blobs = []
        for k in full[i:i + 64].tolist():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(rows.slice(at[k], at[k + 1] - at[k]))
            blobs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(full[i:i + 64], pa.int32()), pa.array(np.full(len(blobs), kind, np.int8)), pa.array(blobs, pa.binary())],
            names=["part", "kind", "blob"])


def unblocked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(kind, rows) of ``blocks``."""
    for batch in batches:
        for kind, blob in zip(batch.column("kind").to_pylist(), batch.column("blob")):
            for rows in pa.ipc.open_stream(blob.as_buffer()):
                yield kind, rows


def one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


# -- keys that occur in several documents ---------------------------------------

def _keys(width: int, gram: int, parts: int):
    """Blocks of (key, doc_id, docs): one row with the number of documents a
    key has in the batch, dealt out by key, and rows with docs = 0 for the other
    documents, whose key is known to repeat, dealt out by document."""
    names = ["key", "doc_id", "docs"]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}       # keys this task has told to repeat, with documents not counted yet
        held, total = [], 0

        def told():
            k = np.fromiter((k for k, n in seen.items() if n), np.int64)
            n = np.fromiter((n for n in seen.values() if n), np.int32)
            seen.clear()
            return k, np.full(len(k), np.iinfo(np.int64).min), n

        def sent():
            key, doc, docs = (np.concatenate(c) for c in zip(*held))
            held.clear()
            route = np.where(docs > 0, key, doc)
            yield from blocks(pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(docs)], names=names),
                              parts_of(route, parts), parts)

        for batch in batches:
            for b in text_batches(batch, "text"):
                doc = b.column("doc_id").to_numpy()
                row, _, _, key = segments([x.as_buffer().to_pybytes() for x in b.column("text")], width, gram)
                if not len(row):
                    continue
                key = key.view(np.int64)
                order = np.lexsort((doc[row], key))
                k, d = key[order], doc[row][order]
                keep = np.ones(len(k), bool)
                keep[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
                k, d = k[keep], d[keep]
                lead = np.ones(len(k), bool)
                lead[1:] = k[1:] != k[:-1]
                count = np.diff(np.append(np.flatnonzero(lead), len(k))).astype(np.int32)
                docs = np.zeros(len(k), np.int32)
                docs[lead] = count
                if seen:
                    at = np.flatnonzero(lead)
                    for i in at[np.isin(k[at], np.fromiter(seen, np.int64, len(seen)))].tolist():
                        seen[int(k[i])] += int(docs[i])
                        docs[i] = 0
                for i in np.flatnonzero(docs > 1).tolist():
                    seen[int(k[i])] = 0
                held.append((k, d, docs))
                total += len(k)
                if len(seen) > SEEN_KEYS:
                    held.append(told())
                if total > HELD_ROWS:
                    yield from sent()
                    total = 0
        if seen:
            held.append(told())
        if held:
            yield from sent()

    return run


def short_key(key: np.ndarray) -> np.ndarray:
    """32 bits of a key: two keys that share them only meet needlessly."""
    return (key >> 32).astype(np.int32)


def _repeated(hot: int):
    """Rows of keys with several documents; docs becomes -1 on one row of
    each hot key."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [tuple(b.column(c).to_numpy() for c in ("key", "doc_id", "docs")) for _, b in unblocked(batches)]
        if not got:
            return
        key, doc, docs = (np.concatenate(c) for c in zip(*got))
        got.clear()
        known = docs == 0
        yield pa.RecordBatch.from_arrays([pa.array(doc[known]), pa.array(short_key(key[known])),
                                          pa.array(np.zeros(int(known.sum()), np.int8))], names=["doc_id", "key", "hot"])
        key, doc, docs = key[~known], doc[~known], docs[~known]
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key, doc, docs = key[order], doc[order], docs[order]
        lead = np.ones(len(key), bool)
        lead[1:] = key[1:] != key[:-1]
        group = np.cumsum(lead) - 1
        total = np.bincount(group, docs)
        keep = total[group] > 1
        hot_row = lead & (total[group] >= hot)
        yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(short_key(key[keep])),
                                          pa.array(hot_row[keep].astype(np.int8))], names=["doc_id", "key", "hot"])

    return run


# -- segments of those keys -------------------------------------------------------

def slices(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """The strings of some places of a text, as a binary array."""
    ends = np.cumsum(length)
    at = np.repeat(start - (ends - length), length) + np.arange(int(ends[-1]) if len(ends) else 0)
    offsets = np.concatenate(([0], ends)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(flat[at])])


def windows_of(flat: np.ndarray, start: np.ndarray, width: int) -> pa.Array:
    """The same for strings of one length."""
    if not len(start):
        return pa.array([], pa.binary(width))
    rows = np.lib.stride_tricks.sliding_window_view(flat, width)[start]
    return pa.Array.from_buffers(pa.binary(width), len(start), [None, pa.py_buffer(rows)])


def least_holders(strings: pa.Array, doc: np.ndarray):
    """(distinct strings, code of each, least document of each distinct one)."""
    coded = strings.dictionary_encode()
    code = coded.indices.to_numpy()
    least = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, code, doc)
    return coded.dictionary.cast(pa.binary()), code, least


def lists_by(code: np.ndarray, n: int, *values: np.ndarray) -> list[pa.ListArray]:
    """Per value array the list of each of n codes."""
    order = np.argsort(code, kind="stable")
    bounds = pa.array(np.concatenate(([0], np.cumsum(np.bincount(code, minlength=n)))).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, pa.array(v[order])) for v in values]


def _segment_blocks(hot_keys, width: int, gram: int, versions: bool, parts: int):
    """Blocks of kind 1: distinct segments (route, content, doc_id, ths,
    starts) with the least document of a text batch that holds them, by route;
    of kind 0: spans (doc_id, th, start, end) already known to be covered by a
    smaller document of the batch, by document."""
    names = ["route", "content", "doc_id", "ths", "starts"]

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_keys.value
        held, known, total = [], [], 0

        def sent():
            if held:
                rows = one_batch(held)
                held.clear()
                yield from blocks(rows, parts_of(rows.column("route").to_numpy(), parts), parts)
            if known:
                spans = union_spans(*(np.concatenate(x) for x in zip(*known)))
                known.clear()
                yield from blocks(span_batch(*spans), parts_of(spans[0], parts), parts, 0)

        for batch in batches:
            for b in text_batches(batch, "text"):
                texts = [x.as_buffer().to_pybytes() for x in b.column("text")]
                doc = b.column("doc_id").to_numpy()
                th = np.array([text_version(t, versions) for t in texts], np.int64)
                row, start, end, key = segments(texts, width, gram)
                key = short_key(key.view(np.int64))
                lists = b.column("keys")
                owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
                pair = lambda r, k: (r.astype(np.int64) << 32) + k
                wanted = pair(owner, lists.flatten().to_numpy())
                keep = np.isin(pair(row, key), wanted)
                row, start, end, key = row[keep], start[keep], end[keep], key[keep]
                by_window = np.isin(key, hot) if len(hot) else np.zeros(len(key), bool)
                flat = np.frombuffer(b"".join(texts), np.uint8)
                lengths = np.fromiter(map(len, texts), np.int64, len(texts))
                first = np.cumsum(lengths) - lengths
                n = (end - start - width + 1)[by_window]
                at = np.repeat(start[by_window] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                wide = ~by_window
                for r, a, z, k in ((row[wide], start[wide], end[wide], key[wide]),
                                   (np.repeat(row[by_window], n), at, at + width, None)):
                    if not len(r):
                        continue
                    found = windows_of(flat, first[r] + a, width) if k is None else slices(flat, first[r] + a, z - a)
                    content, code, least = least_holders(found, doc[r])
                    route = np.empty(len(content), np.int32)
                    if k is None:
                        route[:] = [xxhash.xxh32_intdigest(c) - (1 << 31) for c in content.to_pylist()]
                    else:
                        route[code] = k
                    own = doc[r] == least[code]
                    ths, starts = lists_by(code[own], len(content), th[r[own]], a[own].astype(np.int32))
                    held.append(pa.RecordBatch.from_arrays([pa.array(route), content, pa.array(least), ths, starts], names=names))
                    total += held[-1].nbytes
                    if not own.all():
                        r, a, z = r[~own], a[~own], z[~own]
                        known.append(union_spans(doc[r], th[r], a, z))
                if total > HELD_BYTES:
                    yield from sent()
                    total = 0
        yield from sent()

    return run


def text_version(text: bytes, versions: bool) -> int:
    """Tells rows with one doc_id apart by their text; 0 where none repeats."""
    return xxhash.xxh64_intdigest(text) - (1 << 63) if versions else 0


def merge_spans(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans; touching ones become one."""
    starts, ends = [], []
    for a, z in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], z)
        else:
            starts.append(a)
            ends.append(z)
    return starts, ends


def union_spans(doc: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans of ``merge_spans`` for every (doc, th), sorted."""
    if not len(doc):
        return doc, th, start.astype(np.int32), end.astype(np.int32)
    order = np.lexsort((start, th, doc))
    doc, th, start, end = doc[order], th[order], start[order].astype(np.int64), end[order].astype(np.int64)
    base = (np.cumsum(changes(doc, th)) - 1) * (int(end.max()) + 1)     # spans of two texts never touch
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(doc), bool)
    new[1:] = (base + start)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], th[at], start[at].astype(np.int32), (reach - base)[last].astype(np.int32)


def changes(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before it."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def span_batch(doc: np.ndarray, th: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(th), pa.array(start), pa.array(end)],
                                      names=["doc_id", "th", "start", "end"])


def route_chunks(batches: Iterator[pa.RecordBatch], size: int = BUCKET_SYMBOLS) -> Iterator[pa.Table]:
    """Rows sorted by route in tables of about ``size`` content bytes that hold
    whole routes."""
    held, total, last = [], 0, None
    for batch in batches:
        route = batch.column("route").to_numpy()
        ends = np.append(np.flatnonzero(route[1:] != route[:-1]) + 1, len(route))
        length = np.asarray(pc.binary_length(batch.column("content")), np.int64)
        bytes_to = np.concatenate(([0], np.cumsum(length)))
        at = 0
        if held and route[0] != last and total >= size:
            yield pa.Table.from_batches(held)
            held, total = [], 0
        while at < len(route):
            # the first end of a route at which the chunk is full, else all the rest
            z = ends[min(np.searchsorted(bytes_to[ends], bytes_to[at] + max(size - total, 1)), len(ends) - 1)]
            held.append(batch.slice(at, z - at))
            total += int(bytes_to[z] - bytes_to[at])
            if z < len(route) and total >= size:
                yield pa.Table.from_batches(held)
                held, total = [], 0
            at = int(z)
        last = route[-1]
    if held:
        yield pa.Table.from_batches(held)


def may_share(strings: pa.Array, width: int) -> np.ndarray:
    """Whether a string may share a window with another one: False only where
    the hashes of all its windows are its own."""
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    flat = np.frombuffer(strings.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    windows = np.diff(offsets) - width + 1
    of = np.repeat(np.arange(len(strings)), windows)
    h = gram_hashes(flat, width)[np.arange(len(of)) + of * (width - 1)]
    order = np.argsort(h, kind="stable")
    h, of = h[order], of[order]
    met = np.flatnonzero((h[1:] == h[:-1]) & (of[1:] != of[:-1]))
    out = np.zeros(len(strings), bool)
    out[of[met]] = out[of[met + 1]] = True
    return out


def _merged(rows: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    """(doc_id, th, start, end) of covered bytes from the segments of some
    whole routes.

    Equal segments are one string with the least document that holds it.  The
    strings of a route are merged; a string alone under its route, or alone
    with the hash of each of its windows, has no other to share one with."""
    rows = rows.combine_chunks()
    doc, route = (rows.column(c).to_numpy() for c in ("doc_id", "route"))
    ths, starts = (rows.column(c).combine_chunks() for c in ("ths", "starts"))
    strings, code, owner = least_holders(rows.column("content").combine_chunks(), doc)
    of = np.zeros(len(strings), np.int64)
    of[code] = route
    length = pc.binary_length(strings).to_numpy().astype(np.int64)
    order = np.argsort(of, kind="stable")
    lead = np.flatnonzero(changes(of[order]))
    several = np.zeros(len(strings), bool)
    size = np.diff(np.append(lead, len(order)))
    several[order] = np.repeat(size > 1, size)
    todo = order[several[order]]
    if len(todo):
        lone = todo[~may_share(strings.take(pa.array(todo)), width)]
        several[lone] = False
        todo = todo[several[todo]]
    # occurrences: covered as a whole where a smaller document has the string
    at = np.repeat(np.arange(len(doc)), np.diff(starts.offsets.to_numpy()))
    doc, th, start, code = doc[at], ths.flatten().to_numpy(), starts.flatten().to_numpy(), code[at]
    whole = doc > owner[code]
    found = [(doc[whole], th[whole], start[whole], start[whole] + length[code[whole]])]
    if len(todo):
        # the others, window by window
        least, windows = least_owners(strings.take(pa.array(todo)).to_pylist(), owner[todo], width)
        first = np.zeros(len(strings), np.int64)
        first[todo] = np.cumsum(windows) - windows
        rest = np.flatnonzero(~whole & several[code])
        n = length[code[rest]] - width + 1
        to = np.cumsum(n)
        place = np.arange(int(to[-1]) if len(to) else 0) - np.repeat(to - n, n)
        occurrence = np.repeat(rest, n)
        hit = np.flatnonzero(least[first[code[occurrence]] + place] < doc[occurrence])
        o, a = occurrence[hit], start[occurrence[hit]] + place[hit]
        found.append((doc[o], th[o], a, a + width))
    return union_spans(*(np.concatenate(x) for x in zip(*found)))


def _merge_buckets(width: int, parts: int):
    """Blocks of spans (doc_id, th, start, end), by document, from the segments
    of a part, merged some routes at a time."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, found = [], []
        for kind, rows in unblocked(batches):
            if kind:
                held.append(rows)
            else:
                found.append(tuple(rows.column(c).to_numpy() for c in ("doc_id", "th", "start", "end")))
        if held:
            rows = one_batch(held)
            held.clear()
            rows = rows.take(pa.array(np.argsort(rows.column("route").to_numpy(), kind="stable")))
            found += [_merged(chunk, width) for chunk in route_chunks(iter([rows]))]
        if found:
            spans = union_spans(*(np.concatenate(x) for x in zip(*found)))
            found.clear()
            yield from blocks(span_batch(*spans), parts_of(spans[0], parts), parts, 0)

    return run


SPANS = "doc_id long, spans array<struct<th:long,starts:array<int>,ends:array<int>>>"


@frugal
def _doc_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document from the blocks of its part: per text version the
    starts and ends of its spans."""
    got = [tuple(rows.column(c).to_numpy() for c in ("doc_id", "th", "start", "end")) for _, rows in unblocked(batches)]
    if not got:
        return
    doc, th, start, end = union_spans(*(np.concatenate(x) for x in zip(*got)))
    text = np.flatnonzero(changes(doc, th))
    top = np.flatnonzero(changes(doc[text]))
    bounds = pa.array(np.append(text, len(doc)).astype(np.int32))
    spans = pa.StructArray.from_arrays([pa.array(th[text]), *(pa.ListArray.from_arrays(bounds, pa.array(v)) for v in (start, end))],
                                       names=["th", "starts", "ends"])
    out = pa.RecordBatch.from_arrays(
        [pa.array(doc[text][top]), pa.ListArray.from_arrays(pa.array(np.append(top, len(text)).astype(np.int32)), spans)],
        names=["doc_id", "spans"])
    for a in range(0, out.num_rows, 5000):
        yield out.slice(a, 5000)


def _cut(extra: list[str], as_text: bool, versions: bool):
    """Rows with their covered bytes removed."""
    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in text_batches(batch, "text"):
                removed, spans_n, size, kept = [], [], [], []
                for t, got in zip(b.column("text"), b.column("spans").to_pylist()):
                    raw = t.as_buffer().to_pybytes()
                    th = text_version(raw, versions)
                    own = [(a, z) for g in got or () if g["th"] == th for a, z in zip(g["starts"], g["ends"])]
                    starts, ends = merge_spans(own)
                    rest = b"".join(raw[z:a] for z, a in zip([0, *ends], [*starts, len(raw)])) if starts else raw
                    removed.append(len(raw) - len(rest))
                    spans_n.append(len(starts))
                    size.append(len(raw))
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in extra), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans_n, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                     pa.array([k.decode("utf-8", "ignore") for k in kept] if as_text else kept,
                              pa.string() if as_text else pa.binary())],
                    names=[*extra, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, width: int = WIDTH, gram: int = GRAM,
                   as_text: bool = False) -> DataFrame:
    """``docs`` without its column text, with n_bytes, n_removed, n_spans,
    kept_sha256 and the remaining bytes ``kept`` (``as_text``: as a string,
    without the bytes of characters that were cut in two); helper columns of ``docs``
    named like these are replaced."""
    made = {"n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans", "keys", "text"}
    extra = [c for c in docs.columns if c not in made]
    rows = docs.select(*(F.col(f"`{c}`").cast("long").alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in extra),
                       F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8").alias("text"))
    size = plan_bytes(docs)
    n = partitions_for(spark, size)
    able = rows.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= width)).select("doc_id", "text")
    hot = max(HOT_DOCS, 4 * size // (width - gram) // HOT_KEYS)
    refs = persist(spark, able.mapInArrow(_keys(width, gram, n), BLOCK).repartitionById(n, "part")
                   .mapInArrow(_repeated(hot), "doc_id long, key int, hot byte"), "repeated-keys")
    hot_keys = np.array([r["key"] for r in refs.where("hot = 1").select("key").collect()], np.int32)  # <= HOT_KEYS
    versions = not rows.groupBy("doc_id").count().where("doc_id is not null and count > 1").isEmpty()
    by_doc = refs.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    whole = rows.select(*extra, "text").repartition(n, "doc_id")
    found = (whole.select("doc_id", "text").join(by_doc, "doc_id").where(F.octet_length("text") >= width)
             .mapInArrow(_segment_blocks(spark.sparkContext.broadcast(np.sort(hot_keys)), width, gram, versions, n), BLOCK)
             .repartitionById(n, "part").mapInArrow(_merge_buckets(width, n), BLOCK))
    spans = persist(spark, found.repartitionById(n, "part").mapInArrow(_doc_spans, SPANS), "repeat-spans")
    out = whole.join(spans, "doc_id", "left")
    made_types = [("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()),
                  ("kept_sha256", T.StringType()), ("kept", T.StringType() if as_text else T.BinaryType())]
    schema = T.StructType([rows.schema[c] for c in extra] + [T.StructField(n, t) for n, t in made_types])
    return out.mapInArrow(_cut(extra, as_text, versions), schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(spark, docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
