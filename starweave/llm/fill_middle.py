"""Fill-in-middle by displacement scatter.

A batch of texts is one byte buffer.  A scan over it finds the token starts and
turns the drawn cuts into byte positions.  Prefix, middle and suffix each move
by one distance, so the moves are written as a difference array over the
buffer; its cumulative sum gives every byte its displacement and one scatter
builds all outputs.  ``restore`` finds the markers in the outputs and gathers
the bytes back through the inverse displacements.

Buffers are walked in windows of fixed size and batches are cut into chunks of
bounded bytes, so memory follows the longest text, not the batch.

Defined results: a null text is empty; a null doc_id draws its cuts from ``1:``
followed by nothing; an empty text is plain with n = 0; a very long text is a
chunk of its own and is treated whole; repeated rows give repeated results
(there are no ties to break); an empty table gives no rows; further columns are
left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 1 << 20
CHUNK = 4 << 20
PLAIN_FROM = 90     # h3 % 100 from which a text stays plain
SPM_BELOW = 20      # h4 % 100 below which the suffix comes first
PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], dtype=object)
MARK = 3            # bytes of a marker
MARKS = {PSM: b"<P><S><M>", SPM: b"<S><P><M>"}
MARK_KEYS = np.frombuffer(b"PSM", np.uint8)
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


# ------------------------------------------------------------------ buffers
def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows holding at most
    ``limit`` bytes; a longer row is a run of its own.  Nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def windows(total: int) -> Iterator[tuple[int, int]]:
    for a in range(0, total, WINDOW):
        yield a, min(a + WINDOW, total)


def text_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Strings over a byte buffer, without a copy of each row."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)).cast(pa.string())


# ------------------------------------------------------------------ scan
def token_starts(data: np.ndarray, heads: np.ndarray) -> Iterator[np.ndarray]:
    """Byte positions where a token begins, by window: a run of ASCII letters
    or one other code point.  ``heads`` are the first bytes of the texts."""
    for a, b in windows(len(data)):
        back = min(a, 1)
        part = data[a - back:b]
        folded = part | 32
        letter = (folded >= 97) & (folded <= 122)
        start = (part & 0xC0) != 0x80
        start[1:] &= ~(letter[1:] & letter[:-1])
        start = start[back:]
        lo, hi = np.searchsorted(heads, (a, b))
        start[heads[lo:hi] - a] = True
        yield np.flatnonzero(start) + a


def lead_bytes(data: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Code points before each of the byte positions ``edges``."""
    before = np.zeros(len(edges), np.int64)
    for a, b in windows(len(data)):
        before += np.searchsorted(np.flatnonzero((data[a:b] & 0xC0) != 0x80) + a, edges)
    return before


def token_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens before each row, and tokens of each row."""
    heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
    before = np.zeros(len(offsets), np.int64)
    for starts in token_starts(data, heads):
        before += np.searchsorted(starts, offsets)
    return before[:-1], np.diff(before)


def cut_bytes(data: np.ndarray, offsets: np.ndarray, before: np.ndarray, n: np.ndarray, cuts: list[np.ndarray]):
    """Byte position behind the first k tokens of each row, for each array of
    k in ``cuts``: the start of token k, or the end of the row."""
    heads = np.unique(offsets[:-1][np.diff(offsets) > 0])
    found = [np.where(k == n, offsets[1:], -1) for k in cuts]
    base = 0
    for starts in token_starts(data, heads):
        for k, at in zip(cuts, found):
            rank = before + k - base
            here = (k < n) & (rank >= 0) & (rank < len(starts))
            at[here] = starts[rank[here]]
        base += len(starts)
    return found


def draws(doc_ids: list) -> np.ndarray:
    """h1..h4 of each document, as rows of four unsigned integers."""
    raw = b"".join(hashlib.sha256(b"1:" + (b"" if i is None else b"%d" % i)).digest()[:16] for i in doc_ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


def has_marker(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that contain one of the markers."""
    out = np.zeros(len(offsets) - 1, bool)
    at = marker_positions(data, offsets)
    out[np.searchsorted(offsets, at, "right") - 1] = True
    return out


def marker_positions(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions of the markers that lie inside one row."""
    found = []
    for a, b in windows(len(data)):
        part = data[a:b + MARK - 1]
        if len(part) >= MARK:
            hit = (part[:-2] == 60) & (part[2:] == 62) & np.isin(part[1:-1], MARK_KEYS)
            found.append(np.flatnonzero(hit) + a)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    end = offsets[np.minimum(np.searchsorted(offsets, at, "right"), len(offsets) - 1)]
    return at[at + MARK <= end]


# ------------------------------------------------------------------ displacement
def displacements(starts: np.ndarray, moves: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(a, b, distance of each byte a..b): segment i begins at ``starts[i]``
    (ascending) and moves by ``moves[i]``.  A difference array holds the change
    of distance at each start; its running sum is the distance."""
    steps = np.diff(moves, prepend=0)
    carry = 0
    for a, b in windows(total):
        lo, hi = np.searchsorted(starts, (a, b))
        shift = np.zeros(b - a, np.int64)
        np.add.at(shift, starts[lo:hi] - a, steps[lo:hi])
        shift[0] += carry
        np.cumsum(shift, out=shift)
        carry = int(shift[-1])
        yield a, b, shift


def by_row(*columns: np.ndarray) -> np.ndarray:
    """Columns of per-row values as one array, row after row."""
    return np.stack(columns, 1).ravel()


def scatter(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, c1: np.ndarray, c2: np.ndarray):
    """(output bytes, output offsets) of all rows."""
    s, e = offsets[:-1], offsets[1:]
    prefix, middle, suffix = c1 - s, c2 - c1, e - c2
    made = form != PLAIN
    out_offsets = np.concatenate([[0], np.cumsum(e - s + np.where(made, 3 * MARK, 0))])
    o, spm = out_offsets[:-1], form == SPM
    p_at = np.where(made, o + np.where(spm, 2 * MARK + suffix, MARK), o)
    s_at = np.where(made, o + np.where(spm, MARK, 2 * MARK + prefix), o + prefix + middle)
    m_at = np.where(made, o + 3 * MARK + prefix + suffix, o + prefix)
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for a, b, shift in displacements(by_row(s, c1, c2), by_row(p_at - s, m_at - c1, s_at - c2), len(data)):
        shift += np.arange(a, b)
        out[shift] = data[a:b]
    for f, marks in MARKS.items():
        here = form == f
        first = o[here]
        second = np.where(f == PSM, s_at[here], p_at[here]) - MARK
        for at, i in ((first, 0), (second, 1), (m_at[here] - MARK, 2)):
            mark = np.frombuffer(marks, np.uint8)[MARK * i:MARK * (i + 1)]
            out[(at[:, None] + np.arange(MARK)).ravel()] = np.tile(mark, len(at))
    return out, out_offsets


def gather(out: np.ndarray, offsets: np.ndarray, form: np.ndarray):
    """(bytes, offsets) of the texts that gave the outputs.  No marker can
    arise across a seam, so a row that is not plain holds exactly three."""
    o, e = offsets[:-1], offsets[1:]
    made = form != PLAIN
    at = marker_positions(out, offsets)
    at = at[made[np.searchsorted(offsets, at, "right") - 1]]
    if len(at) != 3 * int(made.sum()):
        raise ValueError("an output does not hold its three markers")
    at = at.reshape(-1, 3)
    first, second, third = o.copy(), e.copy(), e.copy()
    begin, stop = first.copy(), second.copy()      # plain: one segment, the row
    begin[made] = at[:, 0] + MARK
    stop[made] = at[:, 1]
    second[made] = at[:, 1] + MARK
    third[made] = at[:, 2] + MARK
    len_1, len_3 = stop - begin, e - third
    len_2 = np.where(made, third - MARK - second, 0)
    back = np.concatenate([[0], np.cumsum(e - o - np.where(made, 3 * MARK, 0))])
    r, spm = back[:-1], form == SPM
    prefix_from, prefix = np.where(spm, second, begin), np.where(spm, len_2, len_1)
    suffix_from = np.where(spm, begin, second)
    starts = by_row(r, r + prefix, r + prefix + len_3)
    moves = by_row(prefix_from, third, suffix_from) - starts
    text = np.empty(int(back[-1]), np.uint8)
    for a, b, shift in displacements(starts, moves, len(text)):
        shift += np.arange(a, b)
        text[a:b] = out[shift]
    return text, back


# ------------------------------------------------------------------ Spark
def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            ids = batch.column(0).slice(lo, hi - lo)
            before, n = token_counts(data, offsets)
            h = draws(ids.to_pylist())
            one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
            plain = (n == 0) | has_marker(data, offsets) | (h[:, 2] % 100 >= PLAIN_FROM)
            form = np.where(plain, PLAIN, np.where(h[:, 3] % 100 < SPM_BELOW, SPM, PSM))
            c1, c2 = cut_bytes(data, offsets, before, n, [np.minimum(one, two), np.maximum(one, two)])
            chars = [lead_bytes(data, x) for x in (offsets[:-1], c1, c2)]
            out, out_offsets = scatter(data, offsets, form, c1, c2)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n), pa.array(FORMS[form], pa.string()),
                 pa.array(chars[1] - chars[0], mask=plain), pa.array(chars[2] - chars[1], mask=plain),
                 text_array(out, out_offsets)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        forms = np.array([0 if f is None else list(FORMS).index(f) for f in batch.column("form").to_pylist()], np.int64)
        for lo, hi, out, offsets in chunks(batch.column("output")):
            text, back = gather(out, offsets, forms[lo:hi])
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([*part.columns, text_array(text, back)], names=[*part.schema.names, "restored"])


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_transform, RESULT)


def restore(made: DataFrame) -> DataFrame:
    """``made`` (columns form and output among others) with the text that each
    output was made of, as ``restored``; a null form is plain."""
    kept = [c for c in made.columns if c != "restored"]
    rows = made.select(*[F.col(f"`{c}`") for c in kept])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_restore, f"{fields}, restored string")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), u AS (
  SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d
), c AS (
  SELECT doc_id, text, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:n], '') AS suf
  FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
