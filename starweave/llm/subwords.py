"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into words where no piece of the vocabulary can cross (before a
run of spaces).  Each distinct word is encoded once: its substrings of bounded
length are exploded and equi-joined with the piece table (a few ten thousand
rows, fixed by the vocabulary), the matching edges are grouped by word, and a
fold with Spark's higher-order ``aggregate`` finds the pieces.  Two rules:

* ``viterbi``, the registered one: per position the best score of a path and
  its last edge, so the pieces with the largest sum of scores.  The only rule of
  a unigram vocabulary.  A word is a row of segments of ``SEGMENT`` symbols, so
  words of any length take the same fold;
* ``merge``, for the library's own pieces of a BPE vocabulary: each step joins the
  neighbouring pair whose edge scores highest, the leftmost of equals.  Its fold
  takes ``FOLD_SYMBOLS`` symbols, longer words the same rule with a priority queue.

``lattice=False`` applies a rule word by word in Python instead.  Documents are
packed into compressed blocks; a block fetches the encodings of its own distinct
words, so neither the positions of words nor the whole dictionary are ever shuffled.

Defined results: null and empty texts have no pieces and decode to the empty
text; symbols outside the vocabulary become byte pieces; repeated rows are
encoded alike; a null doc_id is kept.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions_for, persist, plan_bytes, table

SPACE = "▁"
BLOCK_BYTES = 8 << 20       # input bytes of one block of documents
FOLD_SYMBOLS = 48
SEGMENT = 64                # symbols of a word folded together
BLOCKS_A_ROW = 1024         # blocks of a word listed in one row
WORD_ROWS = 256 << 10       # bytes of words of one partition of the lattice
UNKNOWN = -1e4              # score of a symbol outside the vocabulary
PACK_ROWS = 2048
UNIGRAM, BPE = 1, 2
RULES = {UNIGRAM: "viterbi", BPE: "merge"}
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces of a model file: (piece, id, score) of the ordinary ones, the
    first byte piece's id, and the kind of model."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto.FromString(m.serialized_model_proto())
        self.kind = spec.trainer_spec.model_type
        n = m.get_piece_size()
        special = [m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
        self.pieces = [(m.id_to_piece(i), i, m.get_score(i)) for i in range(n) if not special[i]]
        first = [i for i in range(n) if m.is_byte(i)]
        self.first_byte = first[0] if len(first) == 256 else None
        if self.first_byte is None or spec.normalizer_spec.name != "identity":
            raise ValueError("the vocabulary needs byte pieces and the identity normaliser")
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces):
            raise ValueError("a piece crosses the start of a word")
        self.longest = max(len(p) for p, _, _ in self.pieces)


def words_of(text: str) -> list[str]:
    """The words of a text; joined they are the text with the leading mark."""
    return _WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []


def merge_word(word: str, score: dict[str, float]) -> list[str]:
    """BPE merges with a priority queue: highest score first, leftmost of
    equals.  The rule of the fold, for words of any length."""
    syms: list[str | None] = list(word)
    nxt, prv = list(range(1, len(syms) + 1)), list(range(-1, len(syms) - 1))
    heap = [(-score[syms[i] + syms[i + 1]], i, syms[i], syms[i + 1])
            for i in range(len(syms) - 1) if syms[i] + syms[i + 1] in score]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = nxt[i]
        if syms[i] != a or j >= len(syms) or syms[j] != b:
            continue
        syms[i], syms[j] = a + b, None
        nxt[i] = nxt[j]
        if nxt[j] < len(syms):
            prv[nxt[j]] = i
        for x, y in ((prv[i], i), (i, nxt[i])):
            if x >= 0 and y < len(syms) and syms[x] + syms[y] in score:
                heapq.heappush(heap, (-score[syms[x] + syms[y]], x, syms[x], syms[y]))
    return [s for s in syms if s is not None]


# -- the lattice ------------------------------------------------------------------

def edges(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(word, score, id): per word maps from its substrings that are pieces to
    their score and id; null maps for a word without any."""
    subs = F.flatten(F.transform(
        F.sequence(F.lit(1), F.length("word")),
        lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - i + 1)),
                              lambda n: F.substring(F.col("word"), i, n))))
    exploded = words.select("word", F.explode(F.array_distinct(subs)).alias("piece"))
    found = exploded.join(F.broadcast(pieces), "piece", "left")
    entry = F.when(F.col("id").isNotNull(), F.struct("piece", "score"))
    ids = F.when(F.col("id").isNotNull(), F.struct("piece", "id"))
    return found.groupBy("word").agg(F.map_from_entries(F.collect_list(entry)).alias("score"),
                                     F.map_from_entries(F.collect_list(ids)).alias("id"))


def let(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def merge_fold(word: Column, score: Column) -> Column:
    """Pieces of a word by BPE merges over its edges."""
    letters = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.substring(word, i, F.lit(1)))

    def join(syms: Column, best: Column) -> Column:
        at = -best["i"]
        return F.when(best.isNull(), syms).otherwise(F.concat(
            F.slice(syms, F.lit(1), at - 1), F.array(best["p"]),
            F.slice(syms, at + 2, F.greatest(F.size(syms) - at - 1, F.lit(0)))))

    def step(syms: Column, _: Column) -> Column:
        # (score, -position, joined) of every neighbouring pair; max is the best, leftmost of equals
        pairs = F.transform(F.slice(syms, F.lit(1), F.size(syms) - 1), lambda left, i: let(
            F.concat(left, F.element_at(syms, i + 2)),
            lambda p: F.when(score[p].isNotNull(), F.struct(score[p].alias("s"), (-i - 1).alias("i"), p.alias("p")))))
        return F.when(F.size(syms) < 2, syms).otherwise(let(F.array_max(pairs), lambda best: join(syms, best)))

    return F.when(F.length(word) > 1, F.aggregate(F.sequence(F.lit(2), F.length(word)), letters, step)).otherwise(letters)


def word_edges(words: DataFrame, pieces: DataFrame, longest: int, partitions: int) -> DataFrame:
    """(key, segs) of distinct words, key the MD5 of the word.  The words are
    shuffled once by key; their edges never leave the partition.  Per segment
    (s, own, edges) its own symbols and the pieces that end there, each
    (end, n, score, id) with n symbols, by end and n.  A symbol outside the
    vocabulary is an edge too, its id -1 - code point."""
    back = F.least(F.col("s") * SEGMENT, F.lit(longest - 1))    # symbols before the segment where a piece may start
    segs = (words.select(F.unhex(F.md5("word")).alias("key"), "word").repartition(partitions, "key")
            .select("key", "word", F.explode(F.sequence(F.lit(0), F.expr(f"int((length(word) - 1) div {SEGMENT})"))).alias("s"))
            .withColumn("back", back)
            .select("key", "s", "back", F.substring(F.col("word"), F.col("s") * SEGMENT - F.col("back") + 1,
                                                    F.col("back") + SEGMENT).alias("sub")))
    ends = segs.select("*", F.explode(F.sequence(F.lit(1), F.length("sub") - F.col("back"))).alias("end"))
    subs = ends.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("back") + F.col("end")))).alias("n"))
    subs = subs.withColumn("piece", F.substring(F.col("sub"), F.col("back") + F.col("end") - F.col("n") + 1, F.col("n")))
    found = subs.join(F.broadcast(pieces), "piece", "left").where(F.col("id").isNotNull() | (F.col("n") == 1))
    first = (F.col("end") == 1) & (F.col("n") == 1)
    own = F.when(first, F.expr("substring(sub, back + 1)"))
    edge = F.struct("end", "n", F.coalesce("score", F.lit(UNKNOWN)).alias("score"),
                    F.coalesce(F.col("id"), -F.ascii("piece") - 1).alias("id"))
    by_seg = (found.select("key", "s", own.alias("own"), edge.alias("edge"))
              .groupBy("key", "s").agg(F.max("own").alias("own"), F.array_sort(F.collect_list("edge")).alias("edges")))
    return by_seg.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("s", "own", "edges"))).alias("segs"))


def viterbi_fold(segs: Column, longest: int) -> Column:
    """Ids of the path with the largest sum of scores over the segments of
    ``word_edges``; of equal paths that with the longest last edge."""
    none = F.array().cast("array<struct<n:int,id:int>>")

    def put(old: Column, new: Column) -> Column:
        return F.concat(F.slice(old, F.lit(1), F.size(old) - 1), F.array(new))

    def step(acc: Column, e: Column) -> Column:
        # the edge of one symbol opens its position, longer ones may better it
        opens, last = e["n"] == 1, F.struct(e["n"].alias("n"), e["id"].alias("id"))
        total = F.element_at(acc["total"], F.when(opens, F.lit(-1)).otherwise(-e["n"] - 1)) + e["score"]
        return let(total, lambda t: F.when(opens, F.struct(
            F.concat(acc["total"], F.array(t)).alias("total"), F.concat(acc["path"], F.array(last)).alias("path"),
        )).when(t >= F.element_at(acc["total"], -1), F.struct(
            put(acc["total"], t).alias("total"), put(acc["path"], last).alias("path"))).otherwise(acc))

    def segment(acc: Column, seg: Column) -> Column:
        start = F.struct(acc["total"].alias("total"), none.alias("path"))
        return let(F.aggregate(seg["edges"], start, step), lambda r: F.struct(
            F.slice(r["total"], F.greatest(F.size(r["total"]) - longest, F.lit(0)) + 1, F.lit(longest)).alias("total"),
            F.concat(acc["paths"], F.array(r["path"])).alias("paths")))

    start = F.struct(F.array(F.lit(0.0)).alias("total"), F.array().cast("array<array<struct<n:int,id:int>>>").alias("paths"))
    paths = F.aggregate(segs, start, segment, lambda acc: acc["paths"])

    def walk(acc: Column, x: Column) -> Column:
        return F.when(acc["skip"] > 0, F.struct((acc["skip"] - 1).alias("skip"), acc["out"].alias("out"))).otherwise(
            F.struct((x["n"] - 1).alias("skip"), F.concat(acc["out"], F.array(x["id"])).alias("out")))

    def back(acc: Column, path: Column) -> Column:
        begin = F.struct(acc["skip"].alias("skip"), F.array().cast("array<int>").alias("out"))
        return let(F.aggregate(F.reverse(path), begin, walk), lambda r: F.struct(
            r["skip"].alias("skip"), F.concat(acc["outs"], F.array(r["out"])).alias("outs")))

    end = F.struct(F.lit(0).alias("skip"), F.array().cast("array<array<int>>").alias("outs"))
    return F.aggregate(F.reverse(paths), end, back, lambda acc: F.reverse(F.flatten(acc["outs"])))


def spelled(ids: Column, first_byte: int) -> Column:
    """``ids`` with every symbol outside the vocabulary as the ids of its UTF-8 bytes."""
    def one(x: Column) -> Column:
        c = -x - 1
        tail = [F.lit(first_byte + 128) + F.shiftright(c, 6 * k) % 64 for k in range(3)]
        return (F.when(x >= 0, F.array(x)).when(c < 1 << 7, F.array(c + first_byte))
                .when(c < 1 << 11, F.array(F.shiftright(c, 6) + (0xC0 + first_byte), tail[0]))
                .when(c < 1 << 16, F.array(F.shiftright(c, 12) + (0xE0 + first_byte), tail[1], tail[0]))
                .otherwise(F.array(F.shiftright(c, 18) + (0xF0 + first_byte), tail[2], tail[1], tail[0])))

    return F.when(F.exists(ids, lambda x: x < 0), F.flatten(F.transform(ids, one))).otherwise(ids)


def piece_ids(pieces: Column, ids: Column, first_byte: int) -> Column:
    """Ids of pieces; a symbol without one becomes the ids of its bytes."""
    def one(p: Column) -> Column:
        code = F.hex(F.encode(p, "UTF-8"))
        raw = F.transform(F.sequence(F.lit(1), F.length(code), F.lit(2)),
                          lambda i: (F.conv(F.substring(code, i, F.lit(2)), 16, 10).cast("int") + first_byte))
        return F.when(ids[p].isNotNull(), F.array(ids[p])).otherwise(raw)

    return F.flatten(F.transform(pieces, one))


def encode_words(spark: SparkSession, words: DataFrame, path: str | None = None, lattice: bool = True,
                 rule: str | None = None) -> DataFrame:
    """(word, ids array<int>) of distinct words by ``rule`` (None: that of the
    library for this kind of vocabulary), over the relational lattice or word
    by word inside the tasks."""
    vocab = Vocabulary(path or default_model())
    rule = rule or RULES.get(vocab.kind)
    if rule not in RULES.values() or (rule == "merge" and vocab.kind != BPE):
        raise ValueError("unigram vocabularies are encoded by the rule viterbi, BPE ones by viterbi or merge")
    alone = _alone(vocab.pieces, vocab.first_byte, rule)
    if not lattice:
        return words.select("word").mapInArrow(alone, "word string, ids array<int>")
    pieces = spark.createDataFrame([(p, i, float(s)) for p, i, s in vocab.pieces], "piece string, id int, score double")
    if rule == "viterbi":
        got = word_edges(words, pieces, vocab.longest, partitions_for(spark, plan_bytes(words), WORD_ROWS))
        text = F.concat_ws("", F.transform("segs", lambda g: g["own"]))
        return got.select(text.alias("word"), viterbi_fold(F.col("segs"), vocab.longest).alias("ids")).select(
            "word", spelled(F.col("ids"), vocab.first_byte).alias("ids"))
    short = words.select("word").where(F.length("word") <= FOLD_SYMBOLS)
    grouped = edges(short, pieces, vocab.longest)
    none_s, none_i = F.create_map().cast("map<string,double>"), F.create_map().cast("map<string,int>")
    grouped = grouped.withColumns({"score": F.coalesce("score", none_s), "id": F.coalesce("id", none_i)})
    fold = merge_fold(F.col("word"), F.col("score"))
    got = grouped.withColumn("pieces", fold).select("word", piece_ids(F.col("pieces"), F.col("id"), vocab.first_byte).alias("ids"))
    long = (words.select("word").where(F.length("word") > FOLD_SYMBOLS)
            .mapInArrow(alone, "word string, ids array<int>"))
    return got.unionByName(long)


def _alone(pieces, first_byte: int, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = {p: s for p, _, s in pieces}
        ids = {p: i for p, i, _ in pieces}
        for b in batches:
            out = []
            for w in b.column(0).to_pylist():
                syms = merge_word(w, score) if rule == "merge" else best_path(w, score)
                out.append([x for s in syms for x in ([ids[s]] if s in ids else [first_byte + c for c in s.encode()])])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["word", "ids"])

    return run


def best_path(word: str, score: dict[str, float], unknown: float = UNKNOWN) -> list[str]:
    """The Viterbi path of the fold, for words of any length."""
    longest = max(map(len, score), default=1)
    table_: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = []
        for n in range(1, min(end, longest) + 1):
            own = score.get(word[end - n:end], unknown if n == 1 else None)
            if own is not None:
                options.append((table_[end - n][0] + own, n))
        table_.append(max(options))
    out, at = [], len(word)
    while at:
        n = table_[at][1]
        out.append(word[at - n:at])
        at -= n
    return out[::-1]


# -- documents in blocks ---------------------------------------------------------

def _pack(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blk = batch.column("blk").to_numpy()
            for k in np.unique(blk).tolist():
                at = np.flatnonzero(blk == k)
                for a in range(0, len(at), PACK_ROWS):
                    rows = batch.select(["doc_id", "text"]).take(pa.array(at[a:a + PACK_ROWS]))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                        w.write_batch(rows)
                    yield pa.RecordBatch.from_pydict({"blk": pa.array([k], pa.int64()),
                                                      "blob": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    return run


def unpack(blob: bytes) -> Iterator[tuple[int | None, str]]:
    for rows in pa.ipc.open_stream(blob):
        for a in range(0, rows.num_rows, 128):
            part = rows.slice(a, 128)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def _block_words(key, blobs):
    """Distinct words of a block."""
    seen: set[str] = set()
    for blob in blobs.column("blob"):
        for _, text in unpack(blob.as_py()):
            seen.update(words_of(text or ""))
    return pa.table({"word": pa.array(sorted(seen), pa.string()), "blk": pa.array([key[0].as_py()] * len(seen), pa.int64())})


def byte_table(pieces, first_byte: int, size: int) -> list[bytes]:
    """Bytes of every id: of its piece, with spaces, or the byte itself."""
    out = [b""] * size
    for p, i, _ in pieces:
        out[i] = p.replace(SPACE, " ").encode()
    for c in range(256):
        out[first_byte + c] = bytes([c])
    return out


def decode(ids, table_: list[bytes]) -> str:
    """Text of ids; the leading mark is dropped."""
    raw = b"".join(map(table_.__getitem__, ids))
    return raw.decode("utf-8", "replace").removeprefix(" ")


def _block_rows(pieces, first_byte: int, with_ids: bool):
    size = max([first_byte + 256, *[i + 1 for _, i, _ in pieces]])
    names = ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.list_(pa.int32())] * with_ids

    def run(key, blobs, words):
        bytes_of = byte_table(pieces, first_byte, size)
        code, text_of = {}, {}
        ids = words.column("ids").combine_chunks()
        offsets, flat = ids.offsets.to_numpy(), ids.flatten().to_numpy().astype("<u4")
        offsets = offsets - (offsets[0] if len(offsets) else 0)
        for w, a, z in zip(words.column("word").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            own = flat[a:z]
            code[w] = own.tobytes()
            text_of[w] = b"".join(map(bytes_of.__getitem__, own.tolist()))
        out = []
        for blob in blobs.column("blob"):
            for doc, text in unpack(blob.as_py()):
                w = words_of(text or "")
                raw = b"".join(map(code.__getitem__, w))
                back = b"".join(map(text_of.__getitem__, w)).removeprefix(b" ")
                row = (doc, len(raw) // 4, zlib.crc32(raw), hashlib.sha256(back).hexdigest())
                out.append(row + ((np.frombuffer(raw, "<i4"),) if with_ids else ()))
        cols = zip(*out) if out else [[]] * len(names)
        return pa.table({n: pa.array(list(c), t) for n, c, t in zip(names, cols, types)})

    return run


def encode_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, with_ids: bool = False,
                     lattice: bool = False, rule: str | None = None) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded_sha256[, ids]) of whole texts:
    ids little-endian unsigned 32-bit, the text decoded from them hashed."""
    vocab = Vocabulary(path or default_model())
    blocks = partitions_for(spark, plan_bytes(docs), BLOCK_BYTES)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    packed = rows.mapInArrow(_pack(blocks), "blk long, blob binary").repartition(blocks, "blk")
    words = (packed.groupBy("blk").applyInArrow(_block_words, "word string, blk long")
             .groupBy("word", F.expr(f"blk div {BLOCKS_A_ROW}").alias("part")).agg(F.collect_list("blk").alias("blks")))
    words = persist(spark, words, "words")
    distinct = words.select("word").distinct() if blocks > BLOCKS_A_ROW else words.select("word")
    coded = persist(spark, encode_words(spark, distinct, path, lattice, rule), "coded-words")
    coded = words.join(coded, "word").select(F.explode("blks").alias("blk"), "word", "ids")
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return (packed.groupBy("blk").cogroup(coded.repartition(blocks, "blk").groupBy("blk"))
            .applyInArrow(_block_rows(vocab.pieces, vocab.first_byte, with_ids), schema))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) with the decoded text; null ids give null."""
    vocab = Vocabulary(path or default_model())
    pieces, first = vocab.pieces, vocab.first_byte
    size = max([first + 256, *[i + 1 for _, i, _ in pieces]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = byte_table(pieces, first, size)
        for b in batches:
            text = [None if x is None else decode(x, bytes_of) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(spark, table(spark, sf_dir, "documents"), lattice=True, rule="viterbi")
