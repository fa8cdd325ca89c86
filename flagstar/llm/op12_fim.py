"""Fill-in-middle transformation: texts cut in three at token borders.

A *token* here is a word with the blanks before it, or a run of blanks that no
word follows. One ``fullmatch`` of ``(token)*`` by the ``regex`` library keeps
every repetition of its group, so ``match.ends(1)`` is the list of all token
ends: its length is n, and both cuts are entries of it. No loop over tokens.

The library's memory for repetitions is bounded, so a text of more than
``WINDOW`` characters is matched in windows. Each window ends where a word ends
before a blank, which is a token end whatever precedes it; the ends are those of
one match over the whole text.

Cuts and form come from a hash of the document's id: reruns, other partitions
and lost executors give the same result. A text that holds a marker itself stays
plain, so every output can be undone (:func:`restored`).
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flagstar.llm.common import ship, table

ship(__name__)

TOKENS = regex.compile(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*")
WORD_END = regex.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
WINDOW = 1 << 20  # characters; at most as many repetitions in one match
BATCH_CHARS = 1 << 23  # characters of output held at once, or one text

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Fim:
    """Percentages of texts transformed and, of these, in suffix-first form."""

    rate: int = 50
    spm: int = 80
    seed: int = 42
    markers: tuple[str, str, str] = ("<P>", "<S>", "<M>")

    def __post_init__(self):
        first = {m[:1] for m in self.markers}
        if len(set(self.markers)) != 3 or len(first) != 1 or "" in first or any(m.count(m[0]) != 1 for m in self.markers):
            raise ValueError("markers must differ, start with one common character and have it nowhere else")


def token_ends(text: str, window: int = WINDOW) -> list[int]:
    """Where each token of ``text`` ends, in code points."""
    if len(text) <= window:
        return TOKENS.fullmatch(text).ends(1)
    ends, at = [], 0
    while at < len(text):
        border = WORD_END.search(text, min(at + window, len(text)))
        stop = border.start() if border else len(text)
        ends += TOKENS.fullmatch(text, at, stop).ends(1)
        at = stop
    return ends


def draws(doc_id: int | None, seed: int) -> list[int]:
    """The four numbers of a document; without an id, those of an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]


def transform(doc_id: int | None, text: str, how: Fim) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars and the output of one text."""
    ends = token_ends(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, how.seed)
    if not text or h3 % 100 >= how.rate or any(m in text for m in how.markers):
        return n, "plain", None, None, text
    one, two = (ends[k - 1] if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    p, s, m = how.markers
    parts = {p: text[:one], m: text[one:two], s: text[two:]}
    form, order = ("spm", (s, p, m)) if h4 % 100 < how.spm else ("psm", (p, s, m))
    return n, form, one, two - one, "".join(x for mark in order for x in (mark, parts[mark]))


def _transform(how: Fim):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        rows, held = [], 0

        def batch():
            out = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(out, names=names)

        for b in batches:
            for i in range(b.num_rows):
                doc_id, text = b.column(0)[i].as_py(), b.column(1)[i].as_py() or ""
                rows.append((doc_id, *transform(doc_id, text, how)))
                held += len(text)
                if held >= BATCH_CHARS or len(rows) >= 4096:
                    yield batch()
                    rows.clear()
                    held = 0
        if rows:
            yield batch()

    return run


def fill_in_middle(docs: DataFrame, how: Fim = Fim(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n (tokens), form (plain, psm or spm), prefix_chars,
    middle_chars (code points, null if plain) and the output text.

    A null text counts as empty, and an empty one is plain. Rows are looked at
    one by one: repeated rows give the same output, a null id is hashed as an
    empty one, extra columns are ignored, an empty table gives no rows. A task
    holds BATCH_CHARS characters of output, or one text that is longer.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_transform(how), OUTPUT)


def restored(output: str, form: str, how: Fim = Fim()) -> Column:
    """The original text, from the columns ``output`` and ``form`` alone.

    Exact: no transformed text holds a marker, and a marker can't arise across
    the borders of parts, as each starts with a character it has nowhere else.
    """
    alternatives = "|".join(rf"\Q{m}\E" for m in how.markers)
    part = lambda k: F.element_at(F.split(F.col(output), alternatives), k)
    whole = F.when(F.col(form) == "psm", F.concat(part(2), part(4), part(3)))
    return whole.when(F.col(form) == "spm", F.concat(part(3), part(4), part(2))).otherwise(F.col(output))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``: cuts, digests of the output and of what it restores to."""
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


_PATTERN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"

ORACLE = re.sub(r"\n\s*", "\n", rf"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_PATTERN}') AS t,
             sha256('42:' || CAST(doc_id AS VARCHAR)) AS h
      FROM documents
    ), u AS (
      SELECT *, len(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
             CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
      FROM d
    ), c AS (
      SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM u
    ), p AS (
      SELECT *, array_to_string(t[1:a], '') AS pre, array_to_string(t[a + 1:b], '') AS mid, array_to_string(t[b + 1:], '') AS suf
      FROM c
    )
    SELECT doc_id, n, form,
           CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
""").strip()
