"""Chat formatting with schema fingerprints.

Records of unlike layouts (prompt/completion, instruction/input/output, message
lists under several names) arrive as JSON strings or as struct columns. The
nested field paths of a record, sorted and hashed, are its *fingerprint*; a
declarative table maps fingerprints to the paths of roles and texts. The turns
found that way are written in one template:

    <s>[role]text</s>[role]text</s>...

Inside roles and texts the characters that marks are made of are escaped
(``& < [ ]`` as ``&a &l &b &c``), so no text can forge a mark, a formatted
conversation splits only at real marks, and unescaping restores every text.
The loss mask holds the code-point spans of assistant texts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flagstar.llm.common import table
from flagstar.session import scratch_dir

# Marks and escapes of the template (fixed values).
OPEN, TURN_END, ROLE_OPEN, ROLE_CLOSE = "<s>", "</s>", "[", "]"
ESCAPES = (("&", "&a"), ("<", "&l"), ("[", "&b"), ("]", "&c"))
LOSS_ROLE = "assistant"
# Names for the same role in common layouts (fixed values).
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

# ------------------------------------------------- fingerprints and mappings
# A mapping lists turns in order. ("role", "path") is one turn of a fixed role;
# ("*", "list path", "role field", "text field") is a list of turns.
LAYOUTS: tuple[tuple[tuple[str, ...], tuple[tuple[str, ...], ...]], ...] = (
    (("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    (("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    (("system", "prompt", "response"), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    (("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    (("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    (("instruction", "input", "output"), (("user", "instruction\ninput"), ("assistant", "output"))),
    (("messages", "messages[].role", "messages[].content"), (("*", "messages", "role", "content"),)),
    (("conversations", "conversations[].from", "conversations[].value"), (("*", "conversations", "from", "value"),)),
    (("turns", "turns[].role", "turns[].text"), (("*", "turns", "role", "text"),)),
)


def fingerprint(paths: tuple[str, ...] | list[str]) -> str:
    """Hash of a set of nested field paths, independent of their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Field paths of a Spark type; ``[]`` stands for a list's elements."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            path = f"{at}.{f.name}" if at else f.name
            out += [path, *schema_paths(f.dataType, path)]
        return out
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{at}[]")
    return []


MAPPINGS = {fingerprint(paths): mapping for paths, mapping in LAYOUTS}


def json_fingerprint(record: Column) -> Column:
    """:func:`fingerprint` of a JSON object's paths (lists: first element's
    fields); null where the string is no JSON object."""
    top = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    inner = F.flatten(
        F.transform(
            top,
            lambda k: F.transform(
                F.coalesce(F.json_object_keys(F.call_function("get_json_object", record, F.concat(F.lit("$['"), k, F.lit("'][0]")))), F.array().cast("array<string>")),
                lambda f: F.concat(k, F.lit("[]."), f),
            ),
        )
    )
    paths = F.array_sort(F.array_distinct(F.concat(top, inner)))
    return F.when(F.json_object_keys(record).isNotNull(), F.substring(F.sha2(F.array_join(paths, "\n"), 256), 1, 16))


TURNS = "array<struct<role:string,text:string>>"


def _canonical(role: Column) -> Column:
    out = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    return F.coalesce(F.element_at(names, out), out)


def _joined(parts: list[Column]) -> Column:
    """Non-empty parts, a newline between."""
    return F.array_join(F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda p: p != ""), "\n")


def _listed(items: Column, role: str, text: str) -> Column:
    return F.transform(items, lambda x: F.struct(_canonical(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))


def json_turns(record: Column) -> Column:
    """Canonical turns of a JSON record, by its fingerprint; null if unknown."""
    found = json_fingerprint(record)
    out: Column = F.lit(None).cast(TURNS)
    for print_, mapping in MAPPINGS.items():
        step = mapping[0]
        if step[0] == "*":
            _, path, role, text = step
            items = F.from_json(F.get_json_object(record, f"$.{path}"), f"array<struct<`{role}`:string,`{text}`:string>>")
            turns = _listed(items, role, text)
        else:
            turns = F.array(
                *[
                    F.struct(F.lit(role).alias("role"), _joined([F.get_json_object(record, f"$.{p}") for p in path.split("\n")]).alias("text"))
                    for role, path in mapping
                ]
            )
        out = F.when(found == print_, turns.cast(TURNS)).otherwise(out)
    return out


def struct_turns(df: DataFrame, record: str) -> Column:
    """Canonical turns of a struct column, whose type has one fingerprint."""
    mapping = MAPPINGS.get(fingerprint(schema_paths(df.schema[record].dataType)))
    if mapping is None:
        raise ValueError(f"no mapping for the layout of column {record}: {schema_paths(df.schema[record].dataType)}")
    col = F.col(f"`{record}`")
    if mapping[0][0] == "*":
        _, path, role, text = mapping[0]
        turns = F.transform(col[path], lambda x: F.struct(x[role].alias("role"), F.coalesce(x[text], F.lit("")).alias("text")))
    else:
        turns = F.array(*[F.struct(F.lit(r).alias("role"), _joined([col[p] for p in path.split("\n")]).alias("text")) for r, path in mapping])
    return turns.cast(TURNS)


# ------------------------------------------------------------------ template


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _piece(turn: Column) -> Column:
    head = F.concat(F.lit(ROLE_OPEN), escape(F.coalesce(turn["role"], F.lit(""))), F.lit(ROLE_CLOSE))
    return F.struct(head.alias("head"), escape(F.coalesce(turn["text"], F.lit(""))).alias("body"), (turn["role"].eqNullSafe(F.lit(LOSS_ROLE))).alias("loss"))


def _mask(pieces: Column) -> Column:
    """Spans [start, end) of loss texts; offsets run in blocks of 64 turns, so
    a conversation of very many turns copies little."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    state = lambda at, spans: F.struct(at.cast("bigint").alias("at"), spans.alias("spans"))

    def one(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
        return state(end + len(TURN_END), F.when(p["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]))

    def block(acc: Column, i: Column) -> Column:
        done = F.aggregate(F.slice(pieces, i * 64 + 1, F.lit(64)), state(acc["at"], none), one)
        return F.struct(done["at"].alias("at"), F.concat(acc["spans"], F.array(done["spans"])).alias("spans"))

    blocks = F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / 64).cast("int"))
    nested = F.struct(F.lit(len(OPEN)).cast("bigint").alias("at"), F.array().cast("array<array<struct<start:bigint,end:bigint>>>").alias("spans"))
    return F.when(F.size(pieces) == 0, none).otherwise(F.flatten(F.aggregate(blocks, nested, block, lambda acc: acc["spans"])))


def format_turns(df: DataFrame, turns: Column, formatted: str = "formatted", mask: str = "loss_mask") -> DataFrame:
    """Add the formatted text and its loss mask (array of start/end code points).

    Null turns count as none, null roles and texts as empty.
    """
    pieces = df.withColumn("_pieces", F.transform(F.coalesce(turns, F.array().cast(TURNS)), _piece))
    text = F.concat(F.lit(OPEN), F.array_join(F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), ""))
    return pieces.withColumn(formatted, text).withColumn(mask, _mask(F.col("_pieces"))).drop("_pieces")


def parse_formatted(formatted: Column) -> Column:
    """Turns of a formatted conversation, texts restored."""
    body = F.split(F.substr(formatted, F.lit(len(OPEN) + 1)), TURN_END)
    whole = F.slice(body, 1, F.size(body) - 1)

    def turn(piece: Column) -> Column:
        close = F.locate(ROLE_CLOSE, piece)
        return F.struct(
            unescape(F.substr(piece, F.lit(2), close - 2)).alias("role"),
            unescape(F.substr(piece, close + 1)).alias("text"),
        )

    return F.transform(whole, turn)


# --------------------------------------------------------------------- query

TEST_CONVERSATION = ((0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all of ``conversations`` and conversation -7, write, read back.

    Rows of a conversation in order of turn (nulls first), then role and text;
    repeated rows are turns of their own; a null conv_id is a conversation.
    """
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    extra = spark.createDataFrame([(-7, t, r, x) for t, r, x in TEST_CONVERSATION], "conv_id long, turn long, role string, text string")
    grouped = rows.unionByName(extra).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("_rows"))
    # the table's own layout, turns[].role and turns[].text, as a record
    turns = F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    records = grouped.select("conv_id", F.struct(turns.alias("turns")).alias("record"))
    out = format_turns(records, struct_turns(records, "record")).select("conv_id", "formatted", "loss_mask")
    folder = scratch_dir(spark, "op10-formatted")
    out.write.parquet(folder)
    back = spark.read.schema(out.schema).parquet(folder)
    parsed = back.withColumn("_turns", parse_formatted(F.col("formatted")))
    masked = F.transform("loss_mask", lambda s: F.substr("formatted", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))
    parsed = parsed.withColumn("_loss", unescape(F.array_join(masked, "")))
    digest = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH all_rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), coded AS (
  SELECT *, coalesce(role, '') AS shown,
    length(text) + (length(text) - length(translate(text, '&<[]', ''))) AS text_chars,
    length(coalesce(role, '')) + (length(coalesce(role, '')) - length(translate(coalesce(role, ''), '&<[]', ''))) AS role_chars
  FROM all_rows
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(shown || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(text_chars + role_chars + 6) AS BIGINT) AS formatted_chars
FROM coded GROUP BY conv_id
"""
