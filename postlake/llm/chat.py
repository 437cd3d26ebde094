"""Chat formatting with a grammar round trip. DataFrame functions only.

One row per conversation: the turns in order, rendered as

    formatted := turn*  (what follows the last "</s>" is empty: text there would hold no turn)
    turn      := ("<s>" | "<s!>") role "\\n" wrapped "</s>"
    wrapped   := "[INST]" body "[/INST]" for user, "<<SYS>>" body "<</SYS>>" for system, body for any other role

A role or body that holds a control string is not in the grammar. Each conversation is rendered as it is, parsed again and
compared with its source; if the turns differ, those that hold conflicting content are escaped (and opened by "<s!>"), and
if they still differed, all of them. In an escaped turn "~" is written "~0", "<" "~1", "[" "~2" and, in the role, a new line
"~3", which leaves no control string and reads back exactly.

Defined results: null role and text count as empty; turns are ordered by turn (null first), then role, then text, and
repeated rows stay repeated; null conversation ids form one conversation; an empty table gives no rows. A conversation is
one training example and so one row; its turns are gathered after a shuffle on the id alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
CONTROL = ("<s>", "<s!>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, OPEN_ESCAPED, CLOSE = "<s>", "<s!>", "</s>"
WRAP = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "~3"))

LEVELS = ("as_is", "conflicts", "all")


def escape(value: Column, pairs=ESCAPES) -> Column:
    for plain, coded in pairs:
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def unescape(value: Column, pairs=ESCAPES) -> Column:
    for plain, coded in reversed(pairs):
        value = F.replace(value, F.lit(coded), F.lit(plain))
    return value


def holds_control(value: Column) -> Column:
    found = F.lit(False)
    for control in CONTROL:
        found = found | value.contains(control)
    return found


def wrapping(role: Column, end: int) -> Column:
    chosen = F.lit("")
    for name, marks in WRAP.items():
        chosen = F.when(role == name, marks[end]).otherwise(chosen)
    return chosen


def turn_pieces(turn: Column, level: str) -> Column:
    """head, body and tail of one rendered turn, and whether it is escaped."""
    role, text = turn["role"], turn["text"]
    escaped = {
        "as_is": F.lit(False),
        "conflicts": holds_control(text) | holds_control(role) | role.contains("\n"),
        "all": F.lit(True),
    }[level]
    shown_role = F.when(escaped, escape(role, ROLE_ESCAPES)).otherwise(role)
    opening = F.when(escaped, OPEN_ESCAPED).otherwise(OPEN)
    return F.struct(
        F.concat(opening, shown_role, F.lit("\n"), wrapping(role, 0)).alias("head"),
        F.when(escaped, escape(text)).otherwise(text).alias("body"),
        F.concat(wrapping(role, 1), F.lit(CLOSE)).alias("tail"),
        escaped.alias("escaped"),
        (role == "assistant").alias("learned"),
    )


def joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["body"], p["tail"])), "")


def opened(shown: Column) -> Column:
    escaped = shown.startswith(OPEN_ESCAPED)
    inner = F.when(escaped, F.substr(shown, F.lit(len(OPEN_ESCAPED) + 1))).when(
        shown.startswith(OPEN), F.substr(shown, F.lit(len(OPEN) + 1))
    )
    return F.struct(escaped.alias("escaped"), inner.alias("inner"), F.locate("\n", inner).alias("line_end"))


def headed(part: Column) -> Column:
    shown = F.when(part["line_end"] > 0, F.substr(part["inner"], F.lit(1), part["line_end"] - 1))
    role = F.when(part["escaped"], unescape(shown, ROLE_ESCAPES)).otherwise(shown)
    return F.struct(
        part["escaped"].alias("escaped"),
        role.alias("role"),
        holds_control(shown).alias("broken"),
        F.substr(part["inner"], part["line_end"] + 1).alias("wrapped"),
    )


def unwrapped(part: Column) -> Column:
    body = part["wrapped"]
    for name, (before, after) in WRAP.items():
        kept = F.length(part["wrapped"]) - len(before) - len(after)
        fits = (kept >= 0) & part["wrapped"].startswith(before) & part["wrapped"].endswith(after)
        inside = F.when(fits, F.substr(part["wrapped"], F.lit(len(before) + 1), kept))
        body = F.when(part["role"] == name, inside).otherwise(body)
    return F.struct(part["escaped"].alias("escaped"), part["role"].alias("role"), part["broken"].alias("broken"), body.alias("body"))


def recovered(part: Column) -> Column:
    text = F.when(part["escaped"], unescape(part["body"])).otherwise(part["body"])
    turn = F.struct(part["role"].alias("role"), text.alias("text"))
    return F.when(~part["broken"] & ~holds_control(part["body"]), turn)


def parse(formatted: Column) -> Column:
    """The turns of a rendered conversation, by the grammar alone; a null element is a part outside the grammar.

    Each step is a pass over the turns, so that nothing inside a turn is worked out twice.
    """
    parts = F.split(formatted, CLOSE, -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    for step in (opened, headed, unwrapped, recovered):
        turns = F.transform(turns, step)
    return turns


def loss_spans(pieces: Column) -> Column:
    """Start (code points), length and escape flag of every assistant body in the rendered text."""
    first = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint,escaped:boolean>>").alias("spans"),
    )

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["head"])
        length = F.length(piece["body"]).cast("long")
        span = F.struct(start.alias("start"), length.alias("length"), piece["escaped"].alias("escaped"))
        return F.struct(
            (start + length + F.length(piece["tail"])).alias("at"),
            F.when(piece["learned"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(pieces, first, step, lambda state: state["spans"])


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, formatted, loss_spans, escaping (the level that made the round trip identical)."""
    empty = F.lit("")
    turns = (
        rows.select(
            F.col(conv_id).alias("conv_id"),
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role), empty).alias("role"),
                F.coalesce(F.col(text), empty).alias("text"),
            ).alias("said"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("said")).alias("said"))
        .select("conv_id", F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    )

    def pieces(level: str) -> Column:
        return F.transform("source", lambda t: turn_pieces(t, level))

    def identical(level: str) -> Column:
        return parse(joined(pieces(level))) == F.col("source")

    level = F.lit(LEVELS[-1])
    for name in reversed(LEVELS[:-1]):
        level = F.when(F.coalesce(identical(name), F.lit(False)), name).otherwise(level)
    chosen = pieces(LEVELS[-1])
    for name in reversed(LEVELS[:-1]):
        chosen = F.when(F.col("escaping") == name, pieces(name)).otherwise(chosen)
    return (
        turns.withColumn("escaping", level)
        .select("conv_id", "escaping", chosen.alias("pieces"))
        .select("conv_id", joined(F.col("pieces")).alias("formatted"), loss_spans(F.col("pieces")).alias("loss_spans"), "escaping")
    )


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read from the rendered text and unescaped."""

    def part(span: Column) -> Column:
        shown = F.substr(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
        return F.when(span["escaped"], unescape(shown)).otherwise(shown)

    return F.array_join(F.transform(spans, part), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from the rendered conversations."""
    turns = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return formatted.select(
        "conv_id",
        parse(F.col("formatted")).alias("turns"),
        learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, regexp_matches(text, '<s>|<s!>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>') AS conflict FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + 8 + length(text)
                + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 ELSE 0 END
                + CASE WHEN conflict THEN 1 + length(text) - length(replace(replace(replace(text, '~', ''), '<', ''), '[', ''))
                       ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
