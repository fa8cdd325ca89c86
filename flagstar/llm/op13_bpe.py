"""Byte-level BPE over a table of distinct words, and back.

Encoding
* Spark cuts texts into *words* (the pieces that a byte-level BPE never merges
  across: a contraction's end, letters, digits or other characters with one
  space before, white space) by one JVM regular expression that puts ``SEP``
  behind each word.
* A *block* is one Arrow batch of documents (64 MB by Spark's default). It is
  written as its distinct words and, per document, the positions of its words in
  them; most frequent words first, so positions take little more than a byte. The
  table is bucketed by block, so its documents stay where they are from here on.
* The distinct words of all blocks are hashed to tasks by word and sorted, so
  equal words meet and each distinct word is encoded once.
* The ids go back to their blocks, and there, by position, into the documents.

What travels, there and back, is one row per block and distinct word: a word that
fills a third of all texts is one row per block, and copies of a text are spread
over blocks as they lie. A block and its words must fit a task.

Texts with a special token's string, with ``SEP`` itself or with a character
that the JVM's Unicode tables don't know are cut by the tokenizer's own splitter
instead, into the same table.

Decoding joins ids with the vocabulary's pieces: ids are dense, so the join is
one Arrow ``take`` per batch. The pieces (at most VOCABULARY_BOUND, checked) are
the only thing every task holds.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flagstar.llm.common import bucketed, ship, table

ship(__name__)

SEP = "\0"
SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"  # Unicode White_Space
WORDS = rf"'(?:[stmd]|re|ve|ll)| ?(?:\p{{L}}++|\p{{N}}++|[^{SPACE}\p{{L}}\p{{N}}]++)|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]++"
VOCABULARY_BOUND = 1 << 22
CUT_ROWS = 512  # documents cut at once
HELD_WORDS = 1 << 17  # encoded words packed at once
JOINED_WORDS = 1 << 18  # words replaced by ids at once, or one document's
DECODE_IDS = 1 << 18  # ids decoded at once, or one document's

# ------------------------------------------------------------ the vocabulary


def _load(path: str) -> dict:
    """The tokenizer's description, if its words are those of WORDS."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    pre, known = told["pre_tokenizer"] or {}, told["model"]
    own = {"continuing_subword_prefix", "end_of_word_suffix", "dropout"}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    if known["type"] != "BPE" or told["normalizer"] or not plain or any(known.get(k) for k in own):
        raise ValueError(f"{path} is no plain byte-level BPE")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in told["added_tokens"]):
        raise ValueError(f"{path} has special tokens that take blanks beside them")
    return told


def special_tokens(path: str) -> list[str]:
    return [t["content"] for t in _load(path)["added_tokens"]]


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the
    others as the code points from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def pieces(path: str) -> pa.Array:
    """The bytes of every id, by id; none for ids without a piece."""
    told, byte = _load(path), _byte_of_char()
    named = dict(told["model"]["vocab"]) | {t["content"]: t["id"] for t in told["added_tokens"]}
    top = max(named.values(), default=-1) + 1
    if top > VOCABULARY_BOUND:
        raise ValueError(f"{top} ids: more than a task may hold")
    out = [b""] * top
    for token, k in named.items():
        out[k] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
    return pa.array(out, pa.large_binary())


def _tokenizer(path: str, cache: dict = {}):  # noqa: B006 - one per Python worker
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
    if path not in cache:
        from tokenizers import Tokenizer

        cache[path] = Tokenizer.from_file(path)
        cache[path].no_truncation()
        cache[path].no_padding()
    return cache[path]


# ------------------------------------------------------------ blocks of words


def _own_words(text: str, path: str, special: list[str]) -> list[str]:
    """Words by the tokenizer's own splitter, special tokens as words."""
    import re

    cut = _tokenizer(path).pre_tokenizer.pre_tokenize_str
    parts = re.split(f"({'|'.join(map(re.escape, special))})", text) if special else [text]
    out = []
    for part in parts:
        out += [part] if part in special else [part[a:b] for _, (a, b) in cut(part)]
    return out


def _pack(positions: np.ndarray) -> bytes:
    """Positions as four planes of bytes, compressed: high ones are nearly all 0."""
    return zstandard.compress(positions.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


_BLOCK = pa.schema([("block", pa.int64()), ("word", pa.string()), ("at", pa.int32()), ("doc_id", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("positions", pa.binary())])
_BLOCK_SQL = "block long, word string, at int, doc_id array<long>, ends array<long>, positions binary"


def _cut(marked: pa.Array, own: pa.Array, path: str, special: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words of some documents in a row, and how many each has. Texts marked by
    Spark end with an empty word."""
    lists = pc.split_pattern(marked, SEP)
    flat, sizes = lists.flatten(), pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if own.null_count < len(own):
        words, sizes, starts = [], sizes.copy(), np.cumsum(sizes) - sizes
        for i, text in enumerate(own.to_pylist()):
            if text is None:
                words.append(flat.slice(starts[i], sizes[i]))
            else:
                words.append(pa.array(_own_words(text, path, special), pa.string()))
                sizes[i] = len(words[-1])
        flat = pa.concat_arrays(words)
    return flat, sizes


def _blocks(path: str, special: list[str]):
    """Per batch one row of its documents and one row per distinct word."""

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            parts, sizes = [], []
            for at in range(0, b.num_rows, CUT_ROWS):
                marked, own = (b.column(k).slice(at, CUT_ROWS) for k in (1, 2))
                words, size = _cut(marked, own, path, special)
                parts.append(words.dictionary_encode())
                sizes.append(size)
            del b
            # common numbers for the words of all parts, most frequent word first
            coded = pa.chunked_array(parts).unify_dictionaries()
            distinct, at = coded.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in coded.chunks])
            del parts, coded
            order = np.argsort(-np.bincount(at, minlength=len(distinct)), kind="stable")
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order))
            docs = [block, None, None, doc_ids, np.cumsum(np.concatenate(sizes)).tolist(), _pack(place[at])]
            yield pa.RecordBatch.from_arrays([pa.array([v], _BLOCK.field(k).type) for k, v in enumerate(docs)], schema=_BLOCK)
            for k in range(0, len(order), 10_000):
                some = distinct.take(pa.array(order[k : k + 10_000]))
                n = len(some)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), some, pa.array(np.arange(k, k + n, dtype=np.int32)), *(pa.nulls(n, _BLOCK.field(c).type) for c in (3, 4, 5))], schema=_BLOCK)
            del distinct, at, docs
            pa.default_memory_pool().release_unused()
            block += 1

    return run


_IDS = ["block", "at", "sizes", "ids"]
_IDS_SQL = "block long, at binary, sizes binary, ids binary"


def _packed(block: np.ndarray, at: np.ndarray, ids: list[bytes], width: str) -> pa.RecordBatch:
    """One row per block: places of its words, number of ids of each, all ids."""
    by = np.lexsort((at, block))
    cuts = np.flatnonzero(np.diff(block[by], prepend=-1))
    rows = []
    for some in np.split(by, cuts[1:]):
        own = [ids[k] for k in some.tolist()]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // np.dtype(width).itemsize
        rows.append((int(block[some[0]]), _pack(np.diff(at[some], prepend=0)), _pack(sizes), zstandard.compress(b"".join(own), 3)))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=_IDS)


def _encode_words(path: str, width: str):
    """Ids of words that come sorted: equal words stand together, each is encoded
    once. Packed by block, as many words at a time as HELD_WORDS."""

    def run(batches):
        tokenizer, last, last_ids = _tokenizer(path), None, b""
        block, at, ids = [], [], []
        for b in batches:
            words = b.column(1).to_pylist()
            new = [w for k, w in enumerate(words) if w != (words[k - 1] if k else last)]
            codes = (np.array(e.ids, dtype=width).tobytes() for e in tokenizer.encode_batch_fast(new, add_special_tokens=False))
            for w in words:
                if w != last:
                    last, last_ids = w, next(codes)
                ids.append(last_ids)
            block.append(b.column(0).to_numpy())
            at.append(b.column(2).to_numpy())
            if len(ids) >= HELD_WORDS:
                yield _packed(np.concatenate(block), np.concatenate(at), ids, width)
                block, at, ids = [], [], []
        if ids:
            yield _packed(np.concatenate(block), np.concatenate(at), ids, width)

    return run


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_ENCODED_SQL = "doc_id long, ids array<int>"


def _id_width(path: str) -> str:
    """Two bytes an id where the vocabulary allows it."""
    return "<u2" if len(pieces(path)) <= 1 << 16 else "<u4"


def _join_back(docs: pa.Table, words: pa.Table, width: str, of_id: pa.Array | None) -> pa.Table:
    """A block's documents as ids: its words' ids, by position; with the pieces of
    ids also as texts."""
    if not docs.num_rows:
        raise ValueError("words of a block without its documents")
    unpacked = [[f(x.as_py()) for x in words.column(c)] for c, f in zip(_IDS[1:], (_unpack, _unpack, zstandard.decompress))]
    at = np.concatenate([np.cumsum(x) for x in unpacked[0]])
    sizes, flat = np.concatenate(unpacked[1]), np.frombuffer(b"".join(unpacked[2]), dtype=width)
    if len(at) != int(at.max()) + 1:
        raise ValueError("a block lacks words")
    start, size = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    start[at], size[at] = np.cumsum(sizes) - sizes, sizes
    positions = _unpack(docs.column("positions")[0].as_py())
    word_ends = docs.column("ends")[0].values.to_numpy()
    schema = _ENCODED if of_id is None else _ENCODED.append(pa.field("text", pa.string()))
    batches, done = [], 0
    while done < len(word_ends):  # some documents at a time: the work arrays stay small
        first = word_ends[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(word_ends, first + JOINED_WORDS)))
        some = positions[first : word_ends[upto - 1]]
        each = size[some]
        ends = np.concatenate(([0], np.cumsum(each)))
        values = flat[np.repeat(start[some] - ends[:-1], each) + np.arange(ends[-1])].astype(np.int32)
        offsets = np.concatenate(([0], ends[word_ends[done:upto] - first])).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        own = [docs.column("doc_id")[0].values.slice(done, upto - done), ids, *([] if of_id is None else [_texts(ids, of_id)])]
        batches.append(pa.RecordBatch.from_arrays(own, schema=schema))
        done = upto
    return pa.Table.from_batches(batches, schema=schema)


def cut_by_spark(text: Column, special: list[str]) -> tuple[Column, Column]:
    """(marked, own): the text with SEP behind each word, or, where the JVM
    can't tell its words, the text itself in the second column."""
    odd = text.rlike("|".join([r"\p{Cn}", r"\x00", *(rf"\Q{t}\E" for t in special)]))
    return F.when(~odd, F.regexp_replace(text, f"({WORDS})", f"$1{SEP}")), F.when(odd, text)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per row: doc_id and its token ids (array<int>), as the tokenizer encodes
    the whole text without adding special tokens; strings of special tokens in
    a text become these tokens, as with the library's defaults. ``with_text``
    adds what :func:`decode` makes of the ids, without another pass.

    A null text counts as empty: no ids. Rows are kept one by one, so repeated
    rows and ids, also null ones, give as many rows. Extra columns are ignored;
    an empty table gives no rows. A text must fit a task, and its ids 2 GB.
    """
    spark, special, width = docs.sparkSession, special_tokens(tokenizer_path), _id_width(tokenizer_path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked, own = cut_by_spark(text, special)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), marked.alias("marked"), own.alias("own"))
    blocks = bucketed(spark, rows.mapInArrow(_blocks(tokenizer_path, special), _BLOCK_SQL), "op13-blocks", "block")
    words = blocks.where("word IS NOT NULL").select("block", "word", "at")
    words = words.repartition("word").sortWithinPartitions("word").mapInArrow(_encode_words(tokenizer_path, width), _IDS_SQL)
    docs_of = blocks.where("word IS NULL").select("block", "doc_id", "ends", "positions")
    of_id, schema = (pieces(tokenizer_path), f"{_ENCODED_SQL}, text string") if with_text else (None, _ENCODED_SQL)
    join_back = lambda docs, words: _join_back(docs, words, width, of_id)
    return docs_of.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join_back, schema)


# ------------------------------------------------------------------ decoding


def _texts(ids: pa.ListArray, of_id: pa.Array) -> pa.Array:
    """Texts of some documents' ids: the ids joined with their pieces at once."""
    sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = ids.flatten()
    known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(of_id)))
    joined = of_id.take(pc.if_else(known, flat, None)).fill_null(b"")
    ends = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = memoryview(joined.buffers()[2] or b"")
    cuts = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
    return pa.array([str(data[x:y], "utf-8", "replace") if v else None for x, y, v in zip(cuts, cuts[1:], ids.is_valid().to_pylist())], pa.string())


def _decode(of_id: pa.Array, names: list[str], ids_at: int):
    def run(batches):
        for b in batches:
            sizes = pc.list_value_length(b.column(ids_at)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            filled, at = np.cumsum(sizes), 0
            while at < b.num_rows:  # as many documents as hold DECODE_IDS ids, one at least
                upto = max(at + 1, int(np.searchsorted(filled, filled[at] - sizes[at] + DECODE_IDS, side="right")))
                part = b.slice(at, upto - at)
                yield pa.RecordBatch.from_arrays([*part.columns, _texts(part.column(ids_at), of_id)], names=[*names, "text"])
                at = upto

    return run


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column text: what the ids stand for, special tokens
    included. Bytes that are no UTF-8 become U+FFFD; ids without a piece are
    skipped; null ids give null. A column of that name is replaced."""
    given = encoded.drop("text")
    schema = StructType([*given.schema.fields, StructField("text", StringType())])
    return given.mapInArrow(_decode(pieces(tokenizer_path), given.columns, given.columns.index(ids_col)), schema)


def op13_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` encoded, and the ids decoded where they arise."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    both = encode(table(spark, sf_dir, "documents"), path, with_text=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
