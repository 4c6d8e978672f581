"""SentencePiece encoding and decoding with a parallel scan for giant documents (operator 5).

Documents of up to GIANT characters are one chunk. They are encoded by the
SentencePiece library, word by word: where no piece of the vocabulary goes on
from another character into a space sign (checked when the model is loaded),
no merge crosses the start of a word, so a document's ids are its words' ids,
and a task looks a word up that it has met before. For other vocabularies the
library gets the document whole. A longer document is cut into chunks of
CHUNK characters that are encoded independently, by a max-plus scan:

* The model merges by rank. A sequence of pieces is its encoding exactly if
  every two neighbours are what the merges make of their joint text (merges
  that would cross a border between two pieces show already in those two).
  So a path of pieces over a text has weight 0 if all its neighbours are
  such pairs and minus infinity otherwise, and exactly one path over the
  whole text has weight 0.
* The state at a chunk border is the piece that reaches or crosses it. A
  chunk yields the transfer matrix from the states at its left border to
  those at its right border: the largest path weight, 0 or minus infinity,
  kept as one bit per left state. Products of such matrices (max and plus)
  are associative: neighbours are multiplied in rounds, FAN of them in a
  group, until a document is one matrix; then the states around each group
  give the states at the borders inside it, down to the chunks.
* With its two border states each chunk is backtraced on its own, on any
  executor, and the chunks' pieces are put together in order.

The results are the library's own for every document. A chunk needs its own
text and one piece's length around it; a group of a round holds FAN matrices
of a few bits, however long the document is.

Decoding is the library's. Texts come back exactly, but for texts that hold
U+2581 (the model's space sign), which the model reads as a space; the
``exact`` column of the query tells.

Defined cases: a null text stays null (no ids); an empty text has no ids;
repeated rows each get their ids; null ids decode to null; very long texts
are encoded whole; an empty table gives no rows; other columns are untouched
(names that clash with helper columns are avoided).

The vocabulary file is a parameter; its bytes are sent to the tasks (a
fixed size), so executors need no file of their own.
"""

from __future__ import annotations

import hashlib
from array import array
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from deskpulse.llm.io import cut, free_name, table, tidy
from deskpulse.llm.textvec import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GIANT = 65_536  # characters up to which a document is one chunk
CHUNK = 32_768
FAN = 16  # neighbours whose matrices are multiplied in one group
TASK_CHUNKS = 4  # per task, about
SPACE = "▁"


@lru_cache(maxsize=2)
def processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Pieces:
    return Pieces(processor(model))


class Pieces:
    """The model's pieces and merge ranks, for the scan."""

    def __init__(self, sp):
        self.id = {}
        self.score = {}
        self.byte = [0] * 256
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.id[p] = i
                self.score[p] = sp.get_score(i)
        self.longest = max(map(len, self.id))
        self.prefixes = {p[:k] for p in self.id for k in range(1, len(p) + 1)}
        self.valid: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merges of a short text: the best-ranked neighbours first, leftmost first among equals."""
        s = list(text)
        while True:
            best, at = None, -1
            for k in range(len(s) - 1):
                v = self.score.get(s[k] + s[k + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, k
            if best is None:
                return s
            s[at : at + 2] = [s[at] + s[at + 1]]

    def pair(self, a: str, b: str) -> bool:
        """Weight 0 (True) or minus infinity (False) of two neighbours."""
        v = self.valid.get((a, b))
        if v is None:
            if len(self.valid) > 1_000_000:
                self.valid.clear()
            v = self.valid[a, b] = self.merged(a + b) == [a, b]
        return v

    def starting(self, text: str, at: int) -> list[str]:
        """Pieces of the vocabulary that the text has at a position, and the character itself."""
        out = [text[at]]
        for k in range(at + 2, min(len(text), at + self.longest) + 1):
            p = text[at:k]
            if p not in self.prefixes:
                break
            if p in self.id:
                out.append(p)
        return out

    def states(self, text: str, border: int) -> list[tuple[int, int]]:
        """Spans (start, end) of pieces with start < border <= end."""
        out = []
        for s in range(max(0, border - self.longest), border):
            out += [(s, s + len(p)) for p in self.starting(text, s) if s + len(p) >= border]
        return sorted(out)

    def reach(self, text: str, entry: dict[tuple[int, int], int], end: int, back: dict | None = None) -> dict[tuple[int, int], int]:
        """States at ``end`` and, in bits, the entry states from which a path of
        weight 0 leads there. ``entry``: span -> bits; (0, 0) is the start of the
        text. ``back`` takes the span before each span."""
        live: dict[int, dict[int, int]] = {}
        for (s, e), bits in entry.items():
            live.setdefault(e, {})[s] = bits
        out: dict[tuple[int, int], int] = {}
        for at in range(min(live), end):
            here = live.pop(at, None)
            if not here:
                continue
            for p in self.starting(text, at):
                bits = 0
                for s, b in here.items():
                    if s == at or self.pair(text[s:at], p):  # s == at: the start of the text
                        bits |= b
                        if back is not None:
                            back[at, at + len(p)] = (s, at)
                if not bits:
                    continue
                e = at + len(p)
                if e >= end:
                    out[at, e] = out.get((at, e), 0) | bits
                else:
                    d = live.setdefault(e, {})
                    d[at] = d.get(at, 0) | bits
        return out

    def ids(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        return [i] if i is not None else [self.byte[b] for b in piece.encode()]


class Words(dict):
    """Ids (as bytes of int32) of words with one space sign before them; a word
    that is missing is encoded by the library. Holds MOST words at most."""

    MOST = 300_000

    def __init__(self, sp):
        super().__init__()
        self.sp = sp
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)))
        self.bare = np.array([sp.piece_to_id(SPACE)], np.int32).tobytes()
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces) and sp.encode("a b") == sp.encode("a") + sp.encode("b")

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self.sp.encode(word)).tobytes()
        if len(word) <= 64:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = ids
        return ids

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of several texts; the words that are new in them are encoded in one call."""
        if self.apart:
            new = {w for t in texts if t for w in t.replace(SPACE, " ").split(" ")}
            new.difference_update(self)
            new = [w for w in new if 0 < len(w) <= 64]
            if len(self) + len(new) > self.MOST:
                self.clear()
            for w, ids in zip(new, self.sp.encode(new, num_threads=1), strict=True):
                self[w] = array("i", ids).tobytes()
        return [b"" if t is None else self.encode(t) for t in texts]

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.apart:
            return np.array(self.sp.encode(text), np.int32).tobytes()
        parts = text.replace(SPACE, " ").split(" ")  # each has one space sign before it
        if all(parts):
            return b"".join(map(self.__getitem__, parts))
        out, spaces = [], ""
        for p in parts:  # further space signs belong to the word after them
            if p:
                out.append(self[spaces + p])
                spaces = ""
            else:
                spaces += " "
        if spaces:  # the text ends in them
            out.append(self[spaces[:-1]] if len(spaces) > 1 else self.bare)
        return b"".join(out)


@lru_cache(maxsize=2)
def words(model: bytes) -> Words:
    return Words(processor(model))


def _shared_model(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _chunks(batches, longest: int, size: int):
    """The chunks (of ``size`` characters) of normalised texts with one piece's length around them."""
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            norm = SPACE + text.replace(" ", SPACE)
            chunks = -(-len(norm) // size)
            for k in range(chunks):
                left, stop = max(0, k * size - longest), min((k + 1) * size, len(norm))
                row = {"key": key, "k": k, "chunks": chunks, "part": norm[left : stop + longest], "lead": k * size - left, "stop": stop - left}
                yield pa.RecordBatch.from_pylist([row], schema=_CHUNK)


_CHUNK = pa.schema([("key", pa.string()), ("k", pa.int32()), ("chunks", pa.int32()), ("part", pa.string()), ("lead", pa.int32()), ("stop", pa.int32())])
_CHUNK_SQL = "key string, k int, chunks int, part string, lead int, stop int"


def _transfer(batches, model):
    """Per chunk: its entry and exit states, relative to the borders, and the bits between them."""
    for b in batches:
        for r in b.to_pylist():
            v = vocabulary(model.value)
            text, lead, stop = r["part"], r["lead"], r["stop"]
            entry = [(0, 0)] if r["k"] == 0 else v.states(text, lead)
            out = v.reach(text, {s: 1 << i for i, s in enumerate(entry)}, stop)
            if r["k"] == r["chunks"] - 1:
                out = {s: m for s, m in out.items() if s[1] == len(text)}
            yield pa.RecordBatch.from_pylist([{
                "key": r["key"], "k": r["k"],
                "left": [[s - lead, e - lead] for s, e in entry],
                "right": [[s - stop, e - stop] for s, e in out],
                "bits": [hex(m) for m in out.values()],
            }], schema=_TRANSFER)


_SPANS = pa.list_(pa.list_(pa.int32()))
_TRANSFER = pa.schema([("key", pa.string()), ("k", pa.int32()), ("left", _SPANS), ("right", _SPANS), ("bits", pa.list_(pa.string()))])
_TRANSFER_SQL = "key string, k int, left array<array<int>>, right array<array<int>>, bits array<string>"


def _matrix(r: dict) -> tuple[list, dict]:
    """A row's transfer matrix: its left states, and the bits of each right state."""
    return [tuple(x) for x in r["left"]], {tuple(x): int(bits, 16) for x, bits in zip(r["right"], r["bits"], strict=True)}


def multiply(a: tuple[list, dict], b: tuple[list, dict]) -> tuple[list, dict]:
    """Max-plus product of two neighbours' matrices over weights 0 and minus infinity: a right
    state of ``b`` is reached from the left states of ``a`` that reach one of its own left states."""
    out = {}
    for state, bits in b[1].items():
        got = 0
        for i, border in enumerate(b[0]):
            if bits >> i & 1:
                got |= a[1].get(border, 0)
        if got:
            out[state] = got
    return a[0], out


def _product(t: pa.Table) -> pa.Table:
    """The matrix of up to FAN neighbours, as one row of the next level."""
    rows = sorted(t.to_pylist(), key=lambda r: r["k"])
    left, right = reduce(multiply, map(_matrix, rows))
    return pa.Table.from_pylist([{"key": rows[0]["key"], "k": rows[0]["above"], "left": left, "right": list(right), "bits": [hex(m) for m in right.values()]}], schema=_TRANSFER)


def _inside(t: pa.Table) -> pa.Table:
    """The states at the borders of up to FAN neighbours, from those around all of them (exactly one path has weight 0)."""
    rows = sorted(t.to_pylist(), key=lambda r: r["k"])
    mats = [_matrix(r) for r in rows]
    reached = [{tuple(rows[0]["enter"])}]
    for left, right in mats:
        bits = sum(1 << i for i, x in enumerate(left) if x in reached[-1])
        reached.append({x for x, m in right.items() if m & bits})
    state = [tuple(rows[0]["leave"])]
    for (left, right), before in zip(reversed(mats), reversed(reached[:-1]), strict=True):
        bits = right[state[-1]]
        state.append(next(x for i, x in enumerate(left) if bits >> i & 1 and x in before))
    state.reverse()
    return pa.table({
        "key": [r["key"] for r in rows], "k": pa.array([r["k"] for r in rows], pa.int32()),
        "enter": pa.array([list(x) for x in state[:-1]], pa.list_(pa.int32())),
        "leave": pa.array([list(x) for x in state[1:]], pa.list_(pa.int32())),
    })


def borders(transfer: DataFrame, chunks: int) -> DataFrame:
    """(key, k, enter, leave): the states around every chunk, for documents of up to ``chunks`` chunks.

    Up: neighbours' matrices are multiplied in rounds, FAN of them in a group keyed (key, k div FAN),
    until a document is one matrix. Down: the states around a group give those inside it."""
    above = F.floor(F.col("k") / FAN).cast("int")
    levels = [transfer]
    while chunks > 1:
        grouped = levels[-1].withColumn("above", above)
        levels.append(cut(grouped.groupBy("key", "above").applyInArrow(_product, _TRANSFER_SQL)))
        chunks = -(-chunks // FAN)
    around = levels.pop().select("key", "k", F.get("left", F.lit(0)).alias("enter"), F.get("right", F.lit(0)).alias("leave"))
    for level in reversed(levels):
        up = around.withColumnRenamed("k", "above")
        within = level.withColumn("above", above).join(up, ["key", "above"])
        around = within.groupBy("key", "above").applyInArrow(_inside, "key string, k int, enter array<int>, leave array<int>")
    return around


def _backtrace(batches, model):
    for b in batches:
        for r in b.to_pylist():
            v = vocabulary(model.value)
            text, lead, stop = r["part"], r["lead"], r["stop"]
            enter = (r["enter"][0] + lead, r["enter"][1] + lead) if r["k"] else (0, 0)
            at = (r["leave"][0] + stop, r["leave"][1] + stop)
            back: dict = {}
            v.reach(text, {enter: 1}, stop, back)
            pieces = []
            while at != enter:
                pieces.append(text[at[0] : at[1]])
                at = back[at]
            ids = [i for p in reversed(pieces) for i in v.ids(p)]
            yield pa.record_batch([pa.array([r["key"]]), pa.array([r["k"]], pa.int32()), pa.array([ids], pa.list_(pa.int32()))], names=["key", "k", "ids"])


def giant_ids(giants: DataFrame, key: str, text: str, model) -> DataFrame:
    """(key, ids) of giant texts, one row per key, by the scan."""
    longest, length = vocabulary(model.value).longest, CHUNK
    parts = cut(giants.select(key, text).mapInArrow(lambda it: _chunks(it, longest, length), _CHUNK_SQL))
    size = parts.agg(F.count("*").alias("n"), F.max("chunks").alias("most")).first()
    # a fixed number of tasks, which adaptive execution leaves alone: chunks are small but take long
    tasks = max(1, -(-size["n"] // TASK_CHUNKS))
    spread = parts.repartition(tasks, "key", "k")
    transfer = cut(spread.mapInArrow(lambda it: _transfer(it, model), _TRANSFER_SQL))
    around = borders(transfer, size["most"] or 0)
    traced = spread.join(around, ["key", "k"]).repartition(tasks, "key", "k").mapInArrow(lambda it: _backtrace(it, model), "key string, k int, ids array<int>")
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"]))
    return traced.groupBy("key").agg(whole.alias("ids"))


def _lists(ids: list[bytes], null: list[bool] | None = None) -> pa.ListArray:
    """A list array from the ids of several texts."""
    ends = np.cumsum([0, *[len(i) // 4 for i in ids]]).astype(np.int32)
    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(null) if null else None)


def encode(docs: DataFrame, out: str = "ids", text: str = "text", path: str = MODEL) -> DataFrame:
    """``docs`` plus ``out``: the ids of each whole text."""
    model = _shared_model(docs, path)
    schema = StructType([*docs.schema.fields, StructField(out, ArrayType(IntegerType()))])
    names = docs.columns

    def run(batches):
        for whole in batches:
            for b in slices(whole, text):
                texts = b.column(text).to_pylist()
                lists = _lists(words(model.value).encode_all(texts), [t is None for t in texts])
                yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*names, out])

    big = F.coalesce(F.char_length(text) > GIANT, F.lit(False))
    small = docs.where(~big).mapInArrow(tidy(run), schema)
    key = free_name(docs, "text_key")
    giants = docs.where(big).withColumn(key, F.sha2(F.col(text), 256))
    ids = giant_ids(giants.dropDuplicates([key]), key, text, model).select(F.col("key").alias(key), F.col("ids").alias(out))
    return small.unionByName(giants.join(ids, key).select(*names, out))


def decode(df: DataFrame, out: str = "decoded", ids: str = "ids", path: str = MODEL) -> DataFrame:
    """``df`` plus ``out``: the text of each row's ids."""
    model = _shared_model(df, path)
    schema = StructType([*df.schema.fields, StructField(out, StringType())])
    names = df.columns

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                col = part.column(ids)
                flat, ends = col.values.to_numpy(), col.offsets.to_numpy()
                lists = [flat[x:y].tolist() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                texts = [t if ok else None for t, ok in zip(processor(model.value).decode(lists), col.is_valid().to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, out])

    return df.mapInArrow(tidy(run), schema)


def tokenized(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, text_sha256, exact) of every document: encoded
    and decoded again, with the digest of the decoded text and whether it is
    the text itself; null texts count as empty. Documents of one chunk make
    the round trip within one task."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    big = F.char_length("text") > GIANT
    model = _shared_model(d, path)

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                texts = b.column("text").to_pylist()
                ids = words(model.value).encode_all(texts)
                back = processor(model.value).decode([np.frombuffer(i, np.int32).tolist() for i in ids])
                lists = _lists(ids)
                sha = [hashlib.sha256(t.encode()).hexdigest() for t in back]
                yield pa.record_batch([b.column("doc_id"), lists, pa.array(sha), pa.array([x == y for x, y in zip(back, texts, strict=True)])], names=["doc_id", "ids", "text_sha256", "exact"])

    id_type = dict(d.dtypes)["doc_id"]
    small = d.where(~big).mapInArrow(tidy(run), f"doc_id {id_type}, ids array<int>, text_sha256 string, exact boolean")
    g = d.where(big).withColumn("text_key", F.sha2("text", 256))
    found = giant_ids(g.dropDuplicates(["text_key"]), "text_key", "text", model)
    back = decode(found, path=path)  # one row per giant text
    got = F.sha2(F.col("decoded"), 256)
    back = back.select(F.col("key").alias("text_key"), "ids", got.alias("text_sha256"), (got == F.col("key")).alias("exact"))
    out = small.unionByName(g.select("doc_id", "text_key").join(back, "text_key").drop("text_key"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text_sha256", "exact")


def token_digest(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``tokenized`` with the ids as a digest of their comma-joined numbers."""
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return tokenized(docs, path).select("doc_id", "n_tokens", digest.alias("ids_sha256"), "text_sha256", "exact")


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """All documents, encoded and decoded again."""
    return token_digest(table(spark, sf_dir, "documents"))
