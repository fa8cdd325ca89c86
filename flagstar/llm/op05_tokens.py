"""Token ids in files: frequency-ranked ids, byte-aligned variable-length codes.

File format. Ids are first replaced by their rank in the whole corpus (0: most
frequent; ties by id), so that frequent ids get one byte. A document's ranks
are cut into groups of four; each group has one *control byte* (two bits a
value: bytes - 1, first value in the low bits) and 1-4 little-endian *data
bytes* a value. All control bytes of a document stand together, before and
apart from its data bytes. A folder holds

* ``ids``: Spark-committed Parquet files of (doc_id, n_tokens, control, data)
  rows, files and rows in ascending doc_id order. The code itself compresses,
  so Parquet's own compression is off. Torn files cannot occur when an
  executor is lost, and any store that Spark can write will do;
* ``ranks``: (id, rank, n) of every id in the corpus, at most one row per id
  of the vocabulary.

Decoding looks every control byte up in a 256-row table of lengths, gets all
offsets from one cumulative sum and gathers the bytes with numpy.

Texts are cut at blanks, across which the tokenizer never joins, and the distinct
words of an Arrow batch of documents (64 MB by Spark's default) into the tokenizer's
pieces. Each distinct piece is looked up once, in what its Python worker remembers of
earlier batches, and encoded if it isn't there. The batch's ids are counted where
they arise.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flagstar.llm.common import Saved, ship, table, worker_cache
from flagstar.session import scratch_dir

ship(__name__)

END_ID = 1
CACHE_WORDS = 300_000  # a Python worker remembers twice as many distinct words at most
VOCABULARY_BOUND = 1 << 22  # largest vocabulary whose rank table is broadcast
CUT_ROWS = 512  # documents cut at once

# ---------------------------------------------------------------- the code

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.int64)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _padded_places(n: np.ndarray) -> np.ndarray:
    """Where values stand when each of several lists, of ``n`` values, is filled
    up to whole groups of four."""
    return np.repeat(4 * _starts(-(-n // 4)) - _starts(n), n) + np.arange(n.sum())


def encode_lists(ranks: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of several lists of unsigned 32-bit values that
    stand behind each other, and the number of data bytes of every list."""
    ranks = ranks.astype("<u4", copy=False)
    lengths = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(4 * int((-(-n // 4)).sum()), dtype=np.uint8)
    codes[_padded_places(n)] = lengths - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < lengths[:, None]]
    ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    return control, data, np.diff(ends[np.concatenate(([0], np.cumsum(n)))])


def decode_lists(control: bytes, data: bytes, n: np.ndarray) -> np.ndarray:
    """The values of :func:`encode_lists`, behind each other."""
    lengths = _LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[_padded_places(n)]
    starts = _starts(lengths)
    raw = np.frombuffer(data, dtype=np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    control, data, _ = encode_lists(ranks, np.array([len(ranks)]))
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode_ranks`."""
    return decode_lists(control, data, np.array([n]))


# ------------------------------------------------------------ tokenization

# The tokenizer's own cut (fixed value)
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII and letters that NFC leaves alone and that lower-case one to one,
# whatever stands beside them; and what the cut comes to within these, lower-cased
LETTERS = "À-ÖØ-öø-įıĲ-ſЀ-џ"
PLAIN = f"^[!-~{LETTERS}]+$"
PIECE = f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LETTERS}]+|[0-9]|[!-/:-@\\[-`{{-~]+"


def _described(path: str) -> dict:
    """The tokenizer's description, if it drops white space and cuts as CUT does
    after lower-casing; only then may texts be cut at blanks first."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    steps = [x["type"] for x in (told["normalizer"] or {}).get("normalizers", [])]
    cuts = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    by_cut = len(cuts) == 2 and cuts[0].get("pattern") == {"Regex": CUT} and cuts[0].get("invert") and cuts[1]["type"] == "ByteLevel"
    if steps != ["NFC", "Replace", "Lowercase"] or not by_cut or cuts[1].get("add_prefix_space") or told["model"]["type"] != "BPE":
        raise ValueError(f"{path} is no lower-casing BPE that drops white space")
    return told


def _byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [c for c in range(256) if c not in shown]
    return [chr(c if c in shown else 256 + hidden.index(c)) for c in range(256)]


def _gather(flat: np.ndarray, width: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists at ``places`` among lists of ``width`` values that stand behind
    each other in ``flat``, behind each other, and where each ends, from 0 on."""
    each = width[places]
    ends = np.concatenate(([0], np.cumsum(each)))
    return flat[np.repeat(_starts(width)[places] - ends[:-1], each) + np.arange(ends[-1])], ends


class PieceEncoder:
    """Token ids of words without blanks.

    Plain words are lower-cased and cut here, for many words at once, and their
    pieces given to the tokenizer's model (no other step changes them but the one
    that shows bytes as characters); all other words, and those with a special
    token's string, go to the library whole. Pieces and such words are remembered
    in two generations of at most about ``limit``; when the younger is full, the
    older is forgotten, but for what was met since. One encoder serves all tasks of
    a Python worker.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        from tokenizers import Tokenizer

        self.special = [t["content"].lower() for t in _described(path)["added_tokens"]]
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.shown = self.tokenizer.model, dict(enumerate(_byte_characters()))
        self.known, self.older = {}, {}

    def _fit(self, words: pa.Array, low: pa.Array, pattern: str) -> pa.Array:
        """Which words match the pattern and hold no special token's string."""
        fit = pc.match_substring_regex(words, pattern)
        for t in self.special:
            fit = pc.and_not(fit, pc.match_substring(low, t))
        return fit

    def _pieces(self, words: pa.Array) -> pa.Array:
        """The pieces of each plain word, every other word as it is."""
        low = pc.utf8_lower(words)
        cut = pc.utf8_rtrim(pc.replace_substring_regex(low, f"({PIECE})", r"\1 "), " ")
        return pc.split_pattern(pc.if_else(self._fit(words, low, PLAIN), cut, words), " ")

    def _encode(self, units: list[str]) -> Iterator[tuple[str, bytes]]:
        other, tokenize, given = [], self.model.tokenize, pa.array(units, pa.string())
        for unit, is_piece in zip(units, self._fit(given, pc.utf8_lower(given), f"^(?:{PIECE})$").to_pylist()):
            if is_piece:
                shown = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.shown)
                yield unit, array("I", [t.id for t in tokenize(shown)]).tobytes()
            else:
                other.append(unit)
        for unit, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            yield unit, array("I", e.ids).tobytes()

    def _known(self, units: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        lacking = [u for u in units if u not in known]
        known.update((u, older[u]) for u in lacking if u in older)
        new = [u for u in lacking if u not in older]
        for at in range(0, len(new), 20_000):
            known.update(self._encode(new[at : at + 20_000]))
        return [known[u] for u in units]

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words behind each other, and their number for every word."""
        lists = self._pieces(words)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        width = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, ends = _gather(np.frombuffer(b"".join(known), dtype="<u4"), width, coded.indices.to_numpy())
        return flat, np.diff(ends[np.concatenate(([0], np.cumsum(n)))])

    def ids(self, words: list[str]) -> list[bytes]:
        flat, width = self.encoded(pa.array(words, pa.string()))
        return [part.tobytes() for part in np.split(flat, np.cumsum(width)[:-1])] if words else []


def _words(texts: pa.Array) -> tuple[list[pa.Array], list[np.ndarray], pa.Array]:
    """Texts as positions in their distinct words (some texts at a time), the
    number of words of each text, and the distinct words."""
    parts, sizes = [], []
    for at in range(0, len(texts), CUT_ROWS):
        some = pc.replace_substring(pc.replace_substring(texts.slice(at, CUT_ROWS), "\n", " "), "\t", " ")
        lists = pc.split_pattern(some, " ")
        sizes.append(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        parts.append(lists.flatten().dictionary_encode())
    coded = pa.chunked_array(parts).unify_dictionaries()
    return [c.indices for c in coded.chunks], sizes, coded.chunk(0).dictionary


def _tokenize(path: str, end_id: int):
    """Rows (doc_id, ids, null) of documents, and per batch a row (null, null, counts)."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        encoders = worker_cache("op5-encoders")
        if path not in encoders:
            encoders[path] = PieceEncoder(path)
        for b in batches:
            if not b.num_rows:
                continue
            doc_ids, total = b.column(0), np.zeros(0, dtype=np.int64)
            parts, sizes, distinct = _words(b.column(1))
            del b
            (flat, width), done = encoders[path].encoded(distinct), 0
            del distinct
            for part, size in zip(parts, sizes):  # some documents at a time: the work arrays stay small
                found, ends = _gather(flat, width, part.to_numpy())
                n = np.diff(ends[np.concatenate(([0], np.cumsum(size)))]) + 1  # with the end id
                ids = np.full(int(n.sum()), end_id, dtype="<u4")
                own = np.ones(len(ids), dtype=bool)
                own[np.cumsum(n) - 1] = False
                ids[own] = found
                count = np.bincount(ids, minlength=len(total))
                count[: len(total)] += total
                total = count
                yield pa.RecordBatch.from_arrays([doc_ids.slice(done, len(n)), _binary(ids.view(np.uint8), 4 * n), pa.nulls(len(n), pa.binary())], schema=schema)
                done += len(n)
            seen = np.flatnonzero(total)
            told = np.stack((seen, total[seen])).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([told], pa.binary())], schema=schema)

    return run


def _count_ids(batches):
    for b in batches:
        for told in b.column(0).to_pylist():
            seen, n = np.frombuffer(told, dtype="<i8").reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n)], names=["id", "n"])


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _checksums(ids: np.ndarray, n: np.ndarray) -> list[int]:
    raw, cuts = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * np.concatenate(([0], np.cumsum(n)))).tolist()
    return [zlib.crc32(raw[x:y]) for x, y in zip(cuts, cuts[1:])]


def _encode(rank_of: np.ndarray):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                n = pc.binary_length(some.column(1)).to_numpy().astype(np.int64) // 4
                ids = np.frombuffer(b"".join(some.column(1).to_pylist()), dtype="<u4")
                control, data, bytes_of = encode_lists(rank_of[ids], n)
                columns = [some.column(0), pa.array(n), pa.array(_checksums(ids, n), pa.int64()), _binary(control, -(-n // 4)), _binary(data, bytes_of)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "tie", "control", "data"])

    return run


def _decode(id_of: np.ndarray):
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                n = some.column(1).to_numpy().astype(np.int64)
                control, data = (b"".join(some.column(k).to_pylist()) for k in (2, 3))
                sums = _checksums(id_of[decode_lists(control, data, n)], n)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(4), pa.array(sums, pa.int64())], names=["doc_id", "n_tokens", "file", "ids_crc32"])

    return run


def _rank_arrays(ranks: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """id -> rank and rank -> id. One row per id of the vocabulary, checked."""
    top = ranks.agg(F.coalesce(F.max("id"), F.lit(-1)).alias("m")).first()["m"]
    if top >= VOCABULARY_BOUND:
        raise ValueError(f"token ids up to {top}: more than a broadcast table may hold")
    rows = ranks.select("id", "rank").toPandas()
    rank_of, id_of = np.zeros(top + 1, dtype=np.uint32), np.zeros(len(rows), dtype=np.uint32)
    rank_of[rows["id"]], id_of[rows["rank"]] = rows["rank"], rows["id"]
    return rank_of, id_of


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text (null: empty) and write the files described above.

    Each document ends with ``end_id``, so an empty text is that id alone.
    Null ids come first; rows that share an id follow each other. An empty
    table writes files without rows. Extra columns are ignored.
    """
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    ids = Saved(spark, rows.mapInArrow(_tokenize(tokenizer_path, end_id), "doc_id long, ids binary, counts binary"), "op5-ids")
    counts = ids.df.select("counts").where("counts IS NOT NULL").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    order = W.orderBy(F.col("n").desc(), "id")  # one row per id of the vocabulary
    ranked = counts.select("id", (F.row_number().over(order) - 1).cast("long").alias("rank"), "n")
    ranked.coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of, _ = _rank_arrays(spark.read.parquet(f"{folder}/ranks"))
    documents = ids.df.where("ids IS NOT NULL").select("doc_id", "ids")
    # written before the sort, whose sampling would else encode all a second time
    coded = Saved(spark, documents.mapInArrow(_encode(rank_of), "doc_id long, n_tokens long, tie long, control binary, data binary"), "op5-coded")
    ids.drop()
    coded.df.orderBy("doc_id", "n_tokens", "tie").drop("tie").write.option("compression", "uncompressed").parquet(f"{folder}/ids")
    coded.drop()


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """What the files hold, per document: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 of its decoded ids."""
    _, id_of = _rank_arrays(spark.read.parquet(f"{folder}/ranks"))
    rows = spark.read.schema("doc_id long, n_tokens long, control binary, data binary").parquet(f"{folder}/ids")
    named = rows.select("doc_id", "n_tokens", "control", "data", F.col("_metadata.file_name").alias("file"))
    decoded = Saved(spark, named.mapInArrow(_decode(id_of), "doc_id long, n_tokens long, file string, ids_crc32 long"), "op5-decoded").df
    # a file's place is that of its first row (names sort otherwise: part-100000 before part-99999)
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "n_tokens", "ids_crc32")
    files = decoded.groupBy("file").agg(F.sum("n_tokens").alias("_sum"), F.min(place).alias("_first"))
    before = W.orderBy("_first").rowsBetween(W.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids_crc32").rowsBetween(W.unboundedPreceding, -1)
    return (
        decoded.withColumn("_within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(offsets, "file")
        .select("doc_id", (F.col("_offset") + F.col("_within")).alias("start"), "n_tokens", "ids_crc32")
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all of ``documents`` as token files, read them back."""
    import public_tokenizers

    folder = scratch_dir(spark, "op5-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, folder)
