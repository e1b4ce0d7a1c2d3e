"""Chat formatting: any layout of prompts and messages to one template and back, in DataFrame functions only.

*Schema fingerprinting.* A table's nested field paths (names without lists, sorted) are hashed; the fingerprint selects
a declarative mapping to canonical turns: where the list of messages is, and which fields hold role and text, or which
columns are a prompt's parts and the roles they speak for. A table that no mapping knows is refused with its paths.

*Template.* Turn by turn: ``[TURN]role[TEXT]text[END]``. In roles and texts the control strings cannot occur, as their
opening bracket is escaped: ``~`` becomes ``~0`` and ``[`` becomes ``~1``. Undoing ``~1`` first and ``~0`` then gives back
every text: in an escaped text ``~1`` only ever stands for a bracket. Text under the loss mask is what stands between
``[TEXT]`` and ``[END]`` of an assistant's turn.

Rows by turn are put together in two steps, blocks of turns first, so a very long conversation is not sorted whole.

Defined results: null text and null role are empty; turns that are equal in number are ordered by role, then text; a
null turn number comes first; rows with a null conversation id are one conversation; a conversation without turns (an
empty list) has none; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's control strings and the escapes.
TURN, TEXT, END = "[TURN]", "[TEXT]", "[END]"
ESCAPES = [("~", "~0"), ("[", "~1")]

#: Turns of one block.
BLOCK = 64


def escaped(text: Column) -> Column:
    text = F.coalesce(text.cast("string"), F.lit(""))
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


# ---- layouts ------------------------------------------------------------------------------


def paths(schema: T.StructType, columns: list[str] | None = None) -> list[str]:
    """All field paths of a schema; lists add nothing to a path."""

    def below(kind: T.DataType, path: str) -> list[str]:
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            return [x for f in kind for x in below(f.dataType, f"{path}.{f.name}")]
        return [path]

    return sorted(x for f in schema if columns is None or f.name in columns for x in below(f.dataType, f.name))


def fingerprint(found: list[str]) -> str:
    return hashlib.sha256("\n".join(found).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """How a layout becomes turns: a list of messages (``messages``, with fields ``role`` and ``text``), columns that
    speak for a role (``parts``: role to columns joined by a blank line), or rows by turn (``turn``)."""

    name: str
    columns: tuple[str, ...]
    messages: str = ""
    role: str = ""
    text: str = ""
    turn: str = ""
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


# Known layouts by their field paths.
MAPPINGS = {
    fingerprint(sorted(p)): mapping
    for p, mapping in [
        (["role", "text", "turn"], Mapping("rows", ("turn", "role", "text"), role="role", text="text", turn="turn")),
        (["messages.content", "messages.role"], Mapping("messages", ("messages",), "messages", "role", "content")),
        (["messages.role", "messages.text"], Mapping("messages", ("messages",), "messages", "role", "text")),
        (["conversations.from", "conversations.value"], Mapping("shared", ("conversations",), "conversations", "from", "value", roles={"human": "user", "gpt": "assistant"})),
        (["prompt", "response"], Mapping("prompt", ("prompt", "response"), parts=(("user", ("prompt",)), ("assistant", ("response",))))),
        (["instruction", "output"], Mapping("instruction", ("instruction", "output"), parts=(("user", ("instruction",)), ("assistant", ("output",))))),
        (["input", "instruction", "output"], Mapping("instruction", ("instruction", "input", "output"), parts=(("user", ("instruction", "input")), ("assistant", ("output",))))),
        (["instruction", "output", "system"], Mapping("instruction", ("system", "instruction", "output"), parts=(("system", ("system",)), ("user", ("instruction",)), ("assistant", ("output",))))),
    ]
}


def mapping_for(df: DataFrame, ignore: list[str]) -> Mapping:
    """The mapping of a table's layout. Columns besides a known layout do not matter; of several layouts that a table
    has, the one with most columns is taken."""
    found = [f.name for f in df.schema if f.name not in ignore]
    fits = [m for key, m in MAPPINGS.items() if set(m.columns) <= set(found) and fingerprint(paths(df.schema, list(m.columns))) == key]
    if not fits:
        raise ValueError(f"no mapping for the fields {', '.join(paths(df.schema, found))}")
    return max(fits, key=lambda m: len(m.columns))


def formatted(df: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Rows ``id_column``, ``formatted``: one string per conversation, whatever the layout of ``df``."""
    mapping = mapping_for(df, [id_column])

    def marked(role: Column, text: Column) -> Column:
        for theirs, ours in mapping.roles.items():
            role = F.when(role == theirs, ours).otherwise(role)
        return F.concat(F.lit(TURN), escaped(role), F.lit(TEXT), escaped(text), F.lit(END))

    if mapping.turn:
        turn = F.col(mapping.turn)
        entry = F.struct(turn.alias("turn"), F.coalesce(mapping.role, F.lit("")).alias("role"), F.coalesce(mapping.text, F.lit("")).alias("text"))
        rows = df.select(F.col(id_column).alias("id"), F.floor(turn / BLOCK).alias("block"), entry.alias("entry"))
        blocks = rows.groupBy("id", "block").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
        joined = F.array_join(F.transform("entries", lambda e: marked(e["role"], e["text"])), "")
        blocks = blocks.select("id", F.struct("block", joined.alias("part")).alias("part"))
        whole = blocks.groupBy("id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
        return whole.select(F.col("id").alias(id_column), F.array_join("parts.part", "").alias("formatted"))
    if mapping.messages:
        turns = F.transform(F.coalesce(mapping.messages, F.array()), lambda m: marked(m[mapping.role], m[mapping.text]))
        return df.select(id_column, F.array_join(turns, "").alias("formatted"))
    said = []
    for role, columns in mapping.parts:
        present = F.filter(F.array(*[F.col(c).cast("string") for c in columns]), lambda x: x != "")
        text = F.array_join(present, "\n\n")
        # A system text or input that is not there is no turn; what is asked and answered always is.
        said.append(F.when(F.lit(role != "system") | (F.size(present) > 0), marked(F.lit(role), text)).otherwise(""))
    return df.select(id_column, F.concat(*said).alias("formatted"))


def parsed(df: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Rows ``id_column``, ``turns`` (a list of role, text, loss): read back from ``formatted``."""
    pieces = F.split("formatted", r"\[END\]")
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = unescaped(F.substring_index(F.substring(piece, len(TURN) + 1, 2**31 - 1), TEXT, 1))
        text = unescaped(F.substring_index(piece, TEXT, -1))
        return F.struct(role.alias("role"), text.alias("text"), (role == "assistant").alias("loss"))

    return df.select(id_column, "formatted", F.transform(whole, turn).alias("turns"))


def digest(df: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Per conversation, from its formatted text: turns, text under the loss mask, and lengths."""
    back = parsed(formatted(df, id_column), id_column)
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return back.select(
        id_column,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(every, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
