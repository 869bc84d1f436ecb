"""Chat formatting from event logs.

A log holds events (conv_id, seq, ref, kind, role, text), with one sequence a conversation: `start` opens a message, which is named by
its seq, `delta` appends to the message that ref names, `edit` replaces its text, `regenerate` empties it, however much has been
said since. Events are grouped by conversation and message, sorted by sequence and folded; messages stand in the order in which
the log starts them. Every final message is rendered as one piece of its conversation's formatted text, which is the concatenation of
its pieces in order. A conversation of any length is thus spread over tasks; only the reader that digests a whole conversation
passes through it in order, piece by piece, without holding it.

Defined results: null texts and roles are empty; events that name a message without a start make one without a role, in the place of
its name (none: first). Of tables of turns (as_events): a null turn sorts first; rows of one turn sort by role and a hash of the text, rows
repeated as a whole stay repeated; a null conv_id is a conversation of its own; columns beyond conv_id, turn, role and text
are neither read nor in the way; texts and conversations of any length are taken whole; an empty table has no conversations; turns beyond
2**40 either way are an error.

Only the digests of a whole conversation are bound to one task each: SHA-256 can't be divided. Pieces pass through it as a
stream, so a hot conversation costs that task time, not memory; without digests (format_chats) nothing is bound so.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Control strings of the template and of common chat formats, which texts may not contain bare.
CONTROL = ("<|start|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\x1b"
CODES = {ESCAPE: "0", "\n": "n"} | {c: chr(ord("A") + i) for i, c in enumerate(CONTROL)}
EVENTS = "conv_id long, seq long, ref long, kind string, role string, text string"
PLACES, LATER = 1 << 20, 1 << 62  # of as_events: rows and events of one turn; what is said again after all turns


def escape(text: Column, newline: bool = False) -> Column:
    """Each control string becomes the escape character and a letter; the escape character itself is written first."""
    for string, code in CODES.items():
        if string != "\n" or newline:
            text = F.replace(text, F.lit(string), F.lit(ESCAPE + code))
    return text


def unescape(text: str) -> str:
    if ESCAPE not in text:
        return text
    back = {v: k for k, v in CODES.items()}
    first, *rest = text.split(ESCAPE)
    return first + "".join(back[x[0]] + x[1:] for x in rest)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, ref, role, text): the final messages of a log, in the order of ref in their conversation."""
    said = events.select("conv_id", F.coalesce("ref", F.when(F.col("kind") == "start", F.col("seq"))).alias("ref"), "seq", "kind", *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
    message = said.groupBy("conv_id", "ref").agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"))
    text = F.aggregate("log", F.lit(""), lambda done, e: F.when(e.kind == "delta", F.concat(done, e.text)).when(e.kind == "edit", e.text).when(e.kind == "regenerate", F.lit("")).otherwise(done))
    role = F.get(F.filter("log", lambda e: e.kind == "start"), 0).role
    return message.select("conv_id", "ref", F.coalesce(role, F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """Adds the message's piece of formatted text, and where in it (code points) the loss mask is on."""
    head = F.concat(F.lit("<|start|>"), escape(F.col("role"), newline=True), F.lit("\n"))
    inner = escape(F.col("text"))
    on = F.col("role") == "assistant"
    return messages.select(
        "conv_id", "ref", "role",
        F.concat(head, inner, F.lit("<|end|>\n")).alias("piece"),
        F.when(on, F.length(head)).alias("loss_from"),
        F.when(on, F.length(head) + F.length(inner)).alias("loss_to"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    return render(fold(events))


def _digests(batches):
    """Rows sorted by conversation and turn -> one row per conversation, read back from the pieces."""
    now, state = None, None

    def row():
        n, turns, chars, loss, total = state
        return {"conv_id": now[0], "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": total}

    for batch in batches:
        done = []
        for conv, piece, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_from", "loss_to"))):
            if state is None or now != (conv,):
                if state is not None:
                    done.append(row())
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            head, _, rest = piece.removeprefix("<|start|>").partition("\n")
            text = unescape(rest.removesuffix("<|end|>\n"))
            state[0] += 1
            state[1].update(f"{unescape(head)}\n{text}\n".encode())
            if a is not None:
                under = unescape(piece[a:b])
                state[2] += len(under)
                state[3].update(under.encode())
            state[4] += len(piece)
        yield pa.RecordBatch.from_pylist(done, _DIGESTS)
    if state is not None:
        yield pa.RecordBatch.from_pylist([row()], _DIGESTS)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def conversation_digests(pieces: DataFrame) -> DataFrame:
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    n = pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = pieces.repartition(int(n), "conv_id").sortWithinPartitions("conv_id", "ref")
    return rows.select("conv_id", "piece", "loss_from", "loss_to").mapInArrow(_digests, schema)


def as_events(conversations: DataFrame) -> DataFrame:
    """A log whose folding gives these rows back: messages are started in order of turns, as plain deltas, or as drafts that are
    regenerated or edited only after all turns of the conversation, by events that name them.
    """
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn = F.col("turn").cast("long")
    turn = F.when(turn.isNull(), -(1 << 40)).when(F.abs(turn) < (1 << 40), turn).otherwise(F.raise_error(F.lit("a turn beyond 2**40")).cast("long"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("conv_id", "turn").orderBy("role", F.xxhash64("text"), "text").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("up_to", up_to).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    rows = rows.withColumn("first", F.col("turn") * PLACES + (F.col("up_to") - F.col("copy")) * 4)
    half = F.floor(F.length("text") / 2).cast("int")
    head, tail = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))

    def event(step, kind, content):
        return F.struct((F.col("first") + step).alias("seq"), F.lit(kind).alias("kind"), content.alias("text"))

    start, whole = event(0, "start", F.lit("")), event(LATER + 1, "delta", F.col("text"))
    kinds = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))
    log = (
        F.when(kinds == 0, F.array(start, event(1, "delta", head), event(2, "delta", tail)))
        .when(kinds == 1, F.array(start, event(1, "delta", F.reverse(head)), event(LATER, "regenerate", F.lit("")), whole))
        .when(kinds == 2, F.array(start, event(1, "delta", head), event(LATER, "edit", F.col("text"))))
        .otherwise(F.array(start, event(1, "delta", F.col("text"))))
    )
    return rows.select("conv_id", "first", "role", F.explode(log).alias("e")).select("conv_id", "e.seq", F.col("first").alias("ref"), "e.kind", "role", "e.text")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose two texts hold control strings, turned into a log, folded and rendered."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_chats(as_events(rows.unionByName(extra))))


# The fold gives the table's own rows back, so the digests can be computed from them; formatted_chars follows the template.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
      chr(27), chr(27) || '0'), '<|start|>', chr(27) || 'A'), '<|end|>', chr(27) || 'B'), '<s>', chr(27) || 'C'), '</s>', chr(27) || 'D'),
      '[INST]', chr(27) || 'E'), '[/INST]', chr(27) || 'F'), '<<SYS>>', chr(27) || 'G'), '<</SYS>>', chr(27) || 'H')) AS n
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(9 + length(role) + 1 + n + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
