"""Token ids in files of independently coded, checksummed blocks (operator 11).

``write_token_files`` encodes texts with a tokenizer of the tokenizers library,
ends each document with an end id and writes the ids in ascending document
order. A folder holds one file per task of the write. A file is a Parquet part
(so that Spark's commit protocol covers lost and repeated tasks, on any file
system) whose rows are blocks; ``data`` is a block on its own:

    magic 'IDB2', vocabulary size, number of ids, number of documents, place of
    the first one in its file, sizes of the two parts below, flags (4 bytes
    each, little endian); for each document its id (8 bytes) and how many of
    its ids lie in this block (4 bytes), deflated; the ids, coded by the
    context-mixing range coder (``rangecoder``); crc32 of all bytes before it.

The model of the coder starts anew in each block, so a block is read alone and
damage stays in it; ``read_token_files`` and ``decode`` raise on a wrong
checksum. Every block but a file's last holds BLOCK ids.

Encoding takes the tokenizer's own result for each white-space separated piece
of a text (this tokenizer drops white space and no token crosses it; the
distinct pieces of a batch are encoded once). Other tokenizers, for which that
doesn't hold, get whole texts (``by_piece=False``).

Defined cases: a null or empty text has the end id only; a null doc_id comes
first and stays null; documents with equal doc_id stay separate rows, in the
order of their text's hash; very long texts go over as many blocks as they
need; an empty table gives no rows; other columns are not read. doc_id is an
integer of up to 64 bits. A hot doc_id is spread by its texts' hashes and row
positions, so no task needs all rows of one.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from deskpulse.llm.io import scratch_folder, small_batches, table
from deskpulse.llm.rangecoder import decode_blocks, encode_blocks
from deskpulse.llm.textvec import arrow_buffers, slices
from deskpulse.llm.tokenwords import Pieces, picked, sums

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END = 1
BLOCK = 2048  # ids of a block
LANES = 4000  # blocks that a task codes, or decodes, side by side; no power of two, whose rows share their places in the cache
GATHERED = 256  # blocks whose rows are handed on together
SLICE = 8 << 20  # bytes of text tokenized at a time (one text at least)
HEAD = struct.Struct("<4s7I")
MAGIC = b"IDB2"
NULL_ID = -(1 << 63)
HAS_NULL, GOES_ON, UNFINISHED = 1, 2, 4  # flags: NULL_ID means null; the first document began earlier; the last one ends later
SCHEMA = "file int, block int, n_ids int, data binary"
PIECES = "file int, block int, doc_id long, place long, at int, n int, crc long, first boolean, last boolean"


class WordCoder:
    """Ids of texts by a tokenizer that drops white space and ends every word with a word-end token."""

    MOST_WORDS = 600_000  # kept by a task

    def __init__(self, blob: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks run side by side already
        self.tokenizer = Tokenizer.from_buffer(blob)
        vocab = self.tokenizer.get_vocab()
        self.size = max(vocab.values()) + 1
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # the same model for words that are lower-cased, cut and written in the model's byte signs already
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.atoms, self.odd = Pieces(lambda p: [self.words(p)], most=self.MOST_WORDS), Pieces(lambda p: [self.whole(p.to_pylist())])

    def whole(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.array([len(x) for x in ids], np.int64)
        return np.array([i for x in ids for i in x], np.int32), lengths

    def words(self, atoms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one unit of the tokenizer each: encoded side by side, cut after word-end tokens."""
        offsets = np.append(np.arange(0, len(atoms), 100), len(atoms)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), byte_signs(atoms)), " ").to_pylist()
        flat = np.concatenate([np.array(e.ids, np.int32) for e in self.bare.encode_batch_fast(texts, add_special_tokens=False)])
        ends = np.flatnonzero(self.closes[flat]) + 1
        if len(ends) != len(atoms) or ends[-1] != len(flat):
            return self.whole(atoms.to_pylist())
        return flat, np.diff(ends, prepend=0)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids) of each text."""
        listed = pc.ascii_split_whitespace(texts)
        pieces, offsets = listed.flatten(), listed.offsets.to_numpy() - listed.offsets[0].as_py()
        if not len(pieces):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pieces.dictionary_encode()
        which, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        plain, atoms, parts = units(distinct)
        flat, n = self.atoms.ids(atoms)
        lengths = sums(n, parts)
        if not plain.all():
            odd, n = self.odd.ids(distinct.filter(pa.array(~plain)))
            flat, lengths = np.concatenate([flat, odd]), np.concatenate([lengths, n])
            place = np.empty(len(distinct), np.int64)  # plain pieces come first
            place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(distinct))
            which = place[which]
        flat, begins = picked(flat, lengths, which)
        return flat, np.diff(begins[offsets])


#: What a byte is in a plain piece, whose borders the tokenizer's own splitting has too: a letter (ASCII, or a byte of
#: U+00C0 to U+00FF), a digit, one of the signs; 0 is none of these.
LETTER, DIGIT, SIGN = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"]] = SIGN
_CLASS[[*b"0123456789"]] = DIGIT
_CLASS[[0xC3, *range(0x80, 0xC0), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 32
_TAIL_SMALL = np.arange(256, dtype=np.uint8)  # of the byte after 0xC3
_TAIL_SMALL[0x80:0x9F] += 32
_NO_TAIL = np.ones(256, bool)  # what can't follow 0xC3 in a letter: the rest, U+00D7, U+00DF (it grows) and U+00F7
_NO_TAIL[[x for x in range(0x80, 0xC0) if x not in (0x97, 0x9F, 0xB7)]] = False


def units(pieces: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Which pieces are plain; the units of those (runs of letters, single digits, runs of signs; lower case), one
    after the other; and per plain piece the index of its first unit (length: plain pieces + 1)."""
    data, offsets = arrow_buffers(pieces)
    raw = data.tobytes()
    kind, low = np.frombuffer(raw.translate(_CLASS.tobytes()), np.uint8), np.frombuffer(bytearray(raw).translate(_SMALL.tobytes()), np.uint8)
    tails = np.flatnonzero(data[:-1] == 0xC3) + 1
    low[tails] = _TAIL_SMALL[data[tails]]
    bad = kind == 0
    high = data >= 0x80
    if high.any():  # letters above ASCII are 0xC3 and one byte
        bad[tails] = _NO_TAIL[data[tails]]
        high[tails] = False
        bad |= high & (data != 0xC3)
    plain = np.ones(len(pieces), bool)
    plain[np.searchsorted(offsets, bad.nonzero()[0], side="right") - 1] = False
    sizes = np.diff(offsets)
    if not plain.all():
        keep = np.repeat(plain, sizes)
        low, kind, sizes = low[keep], kind[keep], sizes[plain]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    first = kind == DIGIT
    first[1:] |= kind[1:] != kind[:-1]
    first[offsets[:-1][sizes > 0]] = True
    begins = np.append(np.flatnonzero(first), len(low)).astype(np.int32)
    atoms = pa.StringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(low))
    return plain, atoms, np.searchsorted(begins, offsets.astype(np.int32))


@lru_cache(maxsize=1)
def _signs() -> tuple[np.ndarray, np.ndarray]:
    """The two bytes of the library's sign for each byte that U+00C0 to U+00FF have in UTF-8."""
    signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    head, tail = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
    for c in map(chr, range(0xC0, 0x100)):
        for byte, sign in zip(c.encode(), signs.pre_tokenize_str(c)[0][0], strict=True):
            head[byte], tail[byte] = sign.encode()
    return head, tail


def byte_signs(atoms: pa.Array) -> pa.Array:
    """``units`` as the library's byte-level step writes them: other bytes than ASCII become a sign of two bytes."""
    data, offsets = arrow_buffers(atoms)
    high = data >= 0x80
    if not high.any():
        return atoms
    head, tail = _signs()
    width = high + np.int64(1)
    ends = np.cumsum(width)
    out = np.repeat(data, width)
    out[ends[high] - 2], out[ends[high] - 1] = head[data[high]], tail[data[high]]
    offsets = np.concatenate([[0], ends])[offsets].astype(np.int32)
    return pa.StringArray.from_buffers(len(atoms), pa.py_buffer(offsets), pa.py_buffer(out))


@lru_cache(maxsize=2)
def word_coder(blob: bytes) -> WordCoder:
    return WordCoder(blob)


def pack(ids: np.ndarray, docs: np.ndarray, counts: np.ndarray, place: int, flags: int, coded: bytes, vocabulary: int) -> bytes:
    """One block's bytes."""
    index = zlib.compress(docs.astype("<i8").tobytes() + counts.astype("<u4").tobytes(), 1)
    head = HEAD.pack(MAGIC, vocabulary, len(ids), len(docs), place & 0xFFFFFFFF, len(index), len(coded), flags | (place >> 32) << 8)
    body = head + index + coded
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block's header and index; ``ids`` come from ``decode``."""

    def __init__(self, data: bytes):
        if len(data) < HEAD.size + 4 or data[:4] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged block")
        _, self.vocabulary, self.n, k, place, n_index, n_coded, flags = HEAD.unpack_from(data)
        index = zlib.decompress(data[HEAD.size : HEAD.size + n_index])
        self.docs = np.frombuffer(index, "<i8", k)
        self.counts = np.frombuffer(index, "<u4", k, 8 * k).astype(np.int64)
        self.place, self.flags = place | (flags >> 8) << 32, flags & 0xFF
        self.coded = data[HEAD.size + n_index : HEAD.size + n_index + n_coded]


def decode(data: list[bytes]) -> list[tuple[Block, np.ndarray]]:
    """Blocks with their ids, read side by side; raises on a wrong checksum."""
    blocks = [Block(d) for d in data]
    out = [None] * len(blocks)
    for v in {b.vocabulary for b in blocks}:
        mine = [i for i, b in enumerate(blocks) if b.vocabulary == v]
        for i, ids in zip(mine, decode_blocks([blocks[i].coded for i in mine], [blocks[i].n for i in mine], v)):
            out[i] = (blocks[i], ids)
    return out


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end: int = END, by_piece: bool = True) -> None:
    """Writes the ids of ``docs`` (doc_id, text) under ``path`` in ascending doc_id order."""
    with open(tokenizer, "rb") as f:
        blob = f.read()

    def run(batches):
        coder = word_coder(blob)
        out = Writer(TaskContext.get().partitionId(), coder.size)
        for batch in gathered(batches, SLICE):
            for b in slices(batch, "text", SLICE):
                texts = pc.fill_null(b.column("text"), "")
                flat, n = coder.texts(texts) if by_piece else coder.whole(texts.to_pylist())
                ends = np.cumsum(n)
                ids = b.column("doc_id")
                out.add(np.insert(flat, ends, end), n + 1, pc.fill_null(ids, NULL_ID).to_numpy(zero_copy_only=False), ids.null_count)
                yield from out.full()
        yield from out.rest()

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    d = d.withColumn("_h", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = ["doc_id", "_h", "_row"]
    d = d.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    d.mapInArrow(run, SCHEMA).write.parquet(path)


def gathered(batches, size: int):
    """The rows of all ``batches`` in batches of ``size`` bytes or somewhat less, where Spark's own are smaller."""
    held, n = [], 0
    for b in batches:
        if held and n + b.nbytes > size:
            yield pa.concat_batches(held)
            held, n = [], 0
        held.append(b)
        n += b.nbytes
    if held:
        yield pa.concat_batches(held)


class Writer:
    """Cuts a task's ids into blocks and codes LANES of them at a time."""

    def __init__(self, file: int, vocabulary: int):
        self.file, self.vocabulary, self.block, self.place, self.open = file, vocabulary, 0, 0, False
        self.parts, self.ids, self.counts, self.nulls, self.held = [], [], [], False, 0

    def add(self, flat: np.ndarray, counts: np.ndarray, ids: np.ndarray, nulls: int) -> None:
        self.parts.append(flat)
        self.counts.append(counts)
        self.ids.append(ids)
        self.nulls |= nulls > 0
        self.held += len(flat)

    def full(self):
        while self.held >= LANES * BLOCK:
            yield self.code(LANES * BLOCK)

    def rest(self):
        yield from self.full()
        if self.held:
            yield self.code(self.held)

    def code(self, n: int) -> pa.RecordBatch:
        """Blocks of the first ``n`` ids that are held; the rest stays."""
        flat, counts, docs = np.concatenate(self.parts), np.concatenate(self.counts), np.concatenate(self.ids)
        ends = np.cumsum(counts)
        cuts = np.arange(0, n, BLOCK)
        coded = encode_blocks([flat[c : min(c + BLOCK, n)] for c in cuts], self.vocabulary)
        rows = []
        for c, bits in zip(cuts, coded):
            stop = min(c + BLOCK, n)
            i, j = np.searchsorted(ends, c, side="right"), np.searchsorted(ends, stop, side="left") + 1
            inside = np.minimum(ends[i:j], stop) - np.maximum(ends[i:j] - counts[i:j], c)
            goes_on = self.open if c == 0 else bool(ends[i] - counts[i] < c)
            flags = HAS_NULL * self.nulls | GOES_ON * goes_on | UNFINISHED * bool(ends[j - 1] > stop)
            rows.append(pack(flat[c:stop], docs[i:j], inside, self.place + int(i), flags, bits, self.vocabulary))
        j = int(np.searchsorted(ends, n, side="right"))  # documents that are complete
        left = counts[j:].copy()
        before = n - (ends[j - 1] if j else 0)
        self.open = before > 0
        if len(left):
            left[0] -= before
        self.parts, self.counts, self.ids, self.place, self.held = [flat[n:]], [left], [docs[j:]], self.place + j, len(flat) - n
        first, self.block = self.block, self.block + len(rows)
        sizes = np.minimum(BLOCK, n - cuts).astype(np.int32)
        return pa.record_batch(
            [pa.array([self.file] * len(rows), pa.int32()), pa.array(range(first, self.block), pa.int32()), pa.array(sizes), pa.array(rows, pa.binary())],
            names=["file", "block", "n_ids", "data"],
        )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document's part of each block: the columns of PIECES and ``ids`` (array of long).
    A document is (file, place); its parts follow each other by ``block``."""
    return _pieces(spark.read.schema(SCHEMA).parquet(path), True)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files under ``path``: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32, from the decoded blocks."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    # ids before each file, in two levels, so that no task sees more than 1024 files or groups of files
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n")).withColumn("g", F.expr("file div 1024"))
    groups = files.groupBy("g").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select("g", earlier(Window.orderBy("g")).alias("group_start"))
    files = files.select("file", "g", earlier(Window.partitionBy("g").orderBy("file")).alias("file_start"))
    files = files.join(groups, "g").select("file", (F.col("group_start") + F.col("file_start")).alias("file_start"))

    parts = _pieces(blocks, False).withColumn("at", F.col("block").cast("long") * BLOCK + F.col("at"))
    docs = (
        parts.groupBy("file", "place", "doc_id")
        .agg(F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("parts"))
        .drop("place")
        .mapInArrow(_joined, "file int, doc_id long, at long, n_tokens long, ids_crc32 long")
    )
    docs = docs.join(files, "file")
    return docs.select("doc_id", (F.col("file_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _joined(batches):
    """Checksums of documents from those of their parts."""
    for b in batches:
        parts = b.column("parts")
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        flat = parts.flatten()
        n = 4 * flat.field("n").to_numpy().astype(np.int64)
        if not len(n):
            continue
        done = np.cumsum(n)
        last = np.repeat(done[offsets[1:] - 1], np.diff(offsets))
        moved = shifted_crc(flat.field("crc").to_numpy().astype(np.uint64), last - done)
        crc = np.bitwise_xor.reduceat(moved, offsets[:-1]).astype(np.int64)
        cols = [b.column(c) for c in ("file", "doc_id", "at", "n_tokens")]
        yield pa.record_batch([*cols, pa.array(crc)], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])


def shifted_crc(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What each crc32 adds to the crc32 of a text in which ``zeros`` bytes follow: crc(a + b) is
    shifted_crc(crc(a), len(b)) ^ crc(b). Each bit of the length is one linear map of 32 bits."""
    out = crc.copy()
    bit = np.arange(32, dtype=np.uint64)
    one = np.where(bit == 0, np.uint64(0xEDB88320), np.uint64(1) << (np.maximum(bit, 1) - np.uint64(1)))  # one zero bit

    def apply(matrix, v):
        res = np.zeros_like(v)
        for k in range(32):
            res ^= np.where((v >> np.uint64(k)) & np.uint64(1) == 1, matrix[k], np.uint64(0))
        return res

    for _ in range(3):
        one = apply(one, one)  # 8 zero bits
    left = zeros.copy()
    while left.any():
        out = np.where(left & 1 == 1, apply(one, out), out)
        one, left = apply(one, one), left >> 1
    return out


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the token files of all documents, read back from them: doc_id, start, n_tokens, ids_crc32."""
    small_batches(spark)
    path = f"{scratch_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)


def _pieces(blocks: DataFrame, with_ids: bool) -> DataFrame:
    def run(batches):
        for b in side_by_side(batches, LANES):
            decoded = decode(b.column("data").to_pylist())
            for k in range(0, b.num_rows, GATHERED):
                part = b.slice(k, GATHERED)
                yield _rows(part.column("file"), part.column("block"), decoded[k : k + GATHERED], with_ids)

    return blocks.mapInArrow(run, PIECES + (", ids array<long>" if with_ids else ""))


def side_by_side(batches, rows: int):
    """The rows of all ``batches`` in batches of ``rows``, but for the last: Spark's own may be smaller."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        while n >= rows:
            whole = pa.concat_batches(held)
            yield whole.slice(0, rows)
            held, n = [whole.slice(rows)], n - rows
    if n:
        yield pa.concat_batches(held)


def _rows(files: pa.Array, numbers: pa.Array, decoded: list[tuple[Block, np.ndarray]], with_ids: bool) -> pa.RecordBatch:
    blocks, ids = [b for b, _ in decoded], np.concatenate([i for _, i in decoded])
    k = np.array([len(b.docs) for b in blocks])
    block_of, counts, docs = np.repeat(np.arange(len(blocks)), k), np.concatenate([b.counts for b in blocks]), np.concatenate([b.docs for b in blocks])
    ends = np.cumsum(counts)
    begins, of_block = ends - counts, np.cumsum([b.n for b in blocks]) - [b.n for b in blocks]
    place = np.concatenate([b.place + np.arange(n) for b, n in zip(blocks, k)])
    flags = np.array([b.flags for b in blocks])
    first, last, until = np.ones(len(docs), bool), np.ones(len(docs), bool), np.cumsum(k)
    first[until - k], last[until - 1] = flags & GOES_ON == 0, flags & UNFINISHED == 0
    raw = memoryview(ids.astype("<u4").tobytes())
    crc = [zlib.crc32(raw[a:e]) for a, e in zip((4 * begins).tolist(), (4 * ends).tolist())]
    cols = [
        files.take(pa.array(block_of)), numbers.take(pa.array(block_of)), pa.array(docs, mask=(docs == NULL_ID) & (flags & HAS_NULL > 0)[block_of]), pa.array(place),
        pa.array((begins - of_block[block_of]).astype(np.int32)), pa.array(counts.astype(np.int32)),
        pa.array(crc, pa.int64()), pa.array(first), pa.array(last),
    ]
    names = ["file", "block", "doc_id", "place", "at", "n", "crc", "first", "last"]
    if with_ids:
        cols.append(pa.ListArray.from_arrays(pa.array(np.append(begins, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int64))))
        names.append("ids")
    return pa.record_batch(cols, names=names)
