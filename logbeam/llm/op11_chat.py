"""Operator 11: chat formatting by schema fingerprints.

Records of many layouts lie in one table, as ``spark.read.json`` gives it: one
wide schema, and in each row only the fields of its own layout.  The nested
paths of the fields a row fills are its schema; their hash, the fingerprint,
selects a declarative mapping (``Layout``) which says where roles and texts
stand.  The mapping gives canonical turns (key, order, role, text), and a
template writes each conversation as one string with a loss mask.

Paths: ``a.b`` for a field of a struct, ``a[]`` for an array that is there,
``a[].b`` for a field that any of its elements fills.  Only fields under the
first names of the layouts' paths count, so foreign columns change nothing;
a row whose paths fit no layout is given with ``layout`` null and no turns,
never guessed at.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  Inside
roles and texts every ``<``, backslashes, ``|`` gets one more backslash, so no
content holds ``<|``, and reading takes one away again; a line break in a role
is written ``<n>``, by the same rule.  The mask has one entry per turn: the
characters [start, end) of the string whose loss counts, empty for turns that
are not the assistant's.

Turns are numbered and measured as rows by window functions; only the string
of a conversation, which is the result, is put together in one row.

Edge cases: a null text or role is empty; turns are ordered by their order
column (null first), repeats of it by role and text, so ties and repeated rows
have one result; records of nested layouts that share a key follow one
another; rows without a key are one conversation; very long texts are cut
nowhere; an empty table gives no conversations; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


@dataclass(frozen=True)
class Say:
    """One turn: a fixed role and the texts of ``paths`` that are filled,
    joined by ``joint``; no turn where none is."""

    role: str
    paths: tuple[str, ...]
    joint: str = "\n\n"


@dataclass(frozen=True)
class Each:
    """One turn per element of an array; ``roles`` renames what a layout calls its speakers."""

    array: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Row:
    """The record is one turn of a conversation."""

    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    """Paths a record must fill, paths it may fill, and its turns."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: tuple[Say | Each | Row, ...]

    def fingerprints(self) -> Iterator[str]:
        """Of every schema the layout accepts."""
        for n in range(len(self.optional) + 1):
            for more in combinations(self.optional, n):
                yield fingerprint_of([*self.required, *more])


# Names that public chat and instruction data give their fields and speakers.
SPEAKERS = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
SYSTEM = Say("system", ("system",))
LAYOUTS = (
    Layout("rows", ("role",), ("text",), (Row("role", "text"),)),
    Layout("text_rows", ("text",), (), (Row("role", "text"),)),
    Layout("prompt", ("prompt",), ("system", "response"), (SYSTEM, Say("user", ("prompt",)), Say("assistant", ("response",)))),
    Layout("completion", ("prompt", "completion"), ("system",), (SYSTEM, Say("user", ("prompt",)), Say("assistant", ("completion",)))),
    Layout("instruction", ("instruction",), ("system", "input", "output"),
           (SYSTEM, Say("user", ("instruction", "input")), Say("assistant", ("output",)))),
    Layout("question", ("question",), ("system", "answer"), (SYSTEM, Say("user", ("question",)), Say("assistant", ("answer",)))),
    Layout("messages", ("messages[]",), ("system", "messages[].role", "messages[].content"),
           (SYSTEM, Each("messages[]", "role", "content", SPEAKERS))),
    Layout("conversations", ("conversations[]",), ("system", "conversations[].from", "conversations[].value"),
           (SYSTEM, Each("conversations[]", "from", "value", SPEAKERS))),
    Layout("exchange", ("exchange.user",), ("exchange.system", "exchange.assistant"),
           (Say("system", ("exchange.system",)), Say("user", ("exchange.user",)), Say("assistant", ("exchange.assistant",)))),
)
#: A table of turns, any of whose fields may be null.
TURN_ROWS = (Layout("rows", (), ("role", "text"), (Row("role", "text"),)),)


def fingerprint_of(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _first_name(path: str) -> str:
    return path.split(".")[0].removesuffix("[]")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def schema_paths(kind: DataType, value: Column, path: str) -> list[tuple[str, Column]]:
    """Every path of a field and whether the row fills it."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, value[f.name], f"{path}.{f.name}")]
    if isinstance(kind, ArrayType):
        found = [(f"{path}[]", value.isNotNull())]
        if isinstance(kind.elementType, (StructType, ArrayType)):
            def filled(i: int) -> Column:
                return F.exists(value, lambda x: schema_paths(kind.elementType, x, "")[i][1])

            names = [p for p, _ in schema_paths(kind.elementType, value, f"{path}[]")]
            found += [(p, F.coalesce(filled(i), F.lit(False))) for i, p in enumerate(names)]
        return found
    return [(path, value.isNotNull())]


def fingerprint(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS, apart: Sequence[str] = ()) -> Column:
    """Hash of the paths a row fills, sorted; the columns ``apart`` (key and
    order) belong to no layout."""
    roots = {_first_name(p) for lay in layouts for p in (*lay.required, *lay.optional)} - set(apart)
    found = [p for f in records.schema.fields if f.name in roots for p in schema_paths(f.dataType, F.col(_quoted(f.name)), f.name)]
    filled = F.array(*(F.when(there, F.lit(path)) for path, there in sorted(found, key=lambda p: p[0])), F.lit(None).cast("string"))
    return F.sha2(F.array_join(F.array_compact(filled), "\n"), 256)


def _value(records: DataFrame, path: str) -> Column | None:
    """The text at a path of struct fields; None where the schema has no such path."""
    kind, value = records.schema, None
    for name in path.split("."):
        if not isinstance(kind, StructType) or name not in kind.names:
            return None
        value = F.col(_quoted(name)) if value is None else value[name]
        kind = kind[name].dataType
    return None if isinstance(kind, (StructType, ArrayType)) else value.cast("string")


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _said(records: DataFrame, turn: Say | Each | Row) -> Column | None:
    """The turns one part of a mapping gives: array<struct<role, text>>."""
    if isinstance(turn, Row):
        role, text = _value(records, turn.role), _value(records, turn.text)
        empty = F.lit(None).cast("string")
        return F.array(_turn(empty if role is None else role, empty if text is None else text))
    if isinstance(turn, Say):
        parts = [v for v in (_value(records, p) for p in turn.paths) if v is not None]
        if not parts:
            return None
        some = F.coalesce(*parts).isNotNull()
        return F.filter(F.array(F.when(some, _turn(F.lit(turn.role), F.concat_ws(turn.joint, *parts)))), lambda x: x.isNotNull())
    name = turn.array.removesuffix("[]")
    kind = records.schema[name].dataType if name in records.columns else None
    if not isinstance(kind, ArrayType) or not isinstance(kind.elementType, StructType):
        return None

    def one(x: Column) -> Column:
        have = kind.elementType.names
        role = x[turn.role].cast("string") if turn.role in have else F.lit(None).cast("string")
        text = x[turn.text].cast("string") if turn.text in have else F.lit(None).cast("string")
        for theirs, ours in turn.roles:
            role = F.when(role == theirs, F.lit(ours)).otherwise(role)
        return _turn(role, text)

    return F.transform(F.filter(F.col(_quoted(name)), lambda x: x.isNotNull()), one)


NO_TURNS = "cast(array() as array<struct<role:string,text:string>>)"


def canonical_records(records: DataFrame, key: str, order: str | None = None, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(key, order, fingerprint, layout, turns) of every record."""
    keyed = records.select("*", fingerprint(records, layouts, [c for c in (key, order) if c]).alias("__fingerprint"))
    named = [(print_, lay.name) for lay in layouts for print_ in lay.fingerprints()]
    table = F.create_map(*(F.lit(x) for pair in dict(reversed(named)).items() for x in pair))
    chosen = keyed.select("*", F.try_element_at(table, F.col("__fingerprint")).alias("__layout"))
    turns = F.expr(NO_TURNS)
    for lay in layouts:
        parts = [p for p in (_said(records, t) for t in lay.turns) if p is not None]
        if parts:
            turns = F.when(F.col("__layout") == lay.name, F.concat(*parts)).otherwise(turns)
    place = F.col(_quoted(order)).cast("long") if order and order in records.columns else F.lit(None).cast("long")
    return chosen.select(
        F.col(_quoted(key)).alias("key"), place.alias("order"), F.col("__fingerprint").alias("fingerprint"), F.col("__layout").alias("layout"),
        turns.alias("turns"))


def canonical_turns(records: DataFrame, key: str, order: str | None = None, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Canonical turns (key, order, record, pos, role, text): a row's turns
    follow one another (``record``, ``pos``)."""
    found = canonical_records(records, key, order, layouts)
    whole = F.when(F.size("turns") != 1, F.xxhash64("turns"))
    return found.select("key", "order", whole.alias("record"), F.posexplode("turns").alias("pos", "turn")).select(
        "key", "order", "record", "pos", "turn.role", "turn.text")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.regexp_replace(role, r"<(\\*)n>", r"<$1\\n>"), F.lit("\n"), F.lit("<n>")))


def unescaped_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(unescaped(role), F.lit("<n>"), F.lit("\n")), r"<(\\*)\\n>", "<$1n>")


def formatted(turns: DataFrame) -> DataFrame:
    """Canonical turns to (key, n_turns, formatted, mask), one row per
    conversation; ``mask`` has an entry (start, end) per turn."""
    head = F.concat(F.lit(START), escaped_role(F.col("role")), F.lit("\n"))
    pieces = turns.select(
        "key", "order", "record", "pos", "role", "text", (F.col("role") == LEARNED_ROLE).alias("learned"),
        head.alias("head"), escaped(F.col("text")).alias("body"))
    size = F.length("head") + F.length("body") + F.lit(len(END))
    ordered = Window.partitionBy("key").orderBy(F.col("order").asc_nulls_first(), "record", "pos", "role", "text")
    measured = pieces.withColumn("start", F.sum(size.cast("long")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - size)
    first = F.col("start") + F.length("head")
    span = F.struct(first.alias("start"), F.when(F.col("learned"), first + F.length("body")).otherwise(first).alias("end"))
    piece = F.struct("start", F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span"))
    held = measured.groupBy("key").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return held.select(
        "key", F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.col("pieces.piece"), "").alias("formatted"), F.col("pieces.span").alias("mask"))


def read_back(chats: DataFrame) -> DataFrame:
    """``formatted``'s rows to their turns (key, chars, pos, role, text, loss):
    what the string and the mask say, unescaped; ``chars``: the string's length."""
    split = F.split("formatted", r"<\|im_end\|>\n", -1)
    rows = chats.select("key", F.length("formatted").cast("long").alias("chars"), F.arrays_zip(F.slice(split, 1, F.size(split) - 1).alias("piece"), F.col("mask").alias("span")).alias("z"))
    rows = rows.select("key", "chars", F.posexplode("z").alias("pos", "z")).select("key", "chars", "pos", "z.piece", "z.span")
    upto = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum((F.length("piece") + len(END)).cast("long")).over(upto) - F.length("piece") - len(END)
    body = rows.withColumn("at", start).withColumn("body", F.substring("piece", len(START) + 1, 2**31 - 1 - len(START)))
    role = F.substring_index("body", "\n", 1)
    said = F.col("body").substr(F.length(role) + 2, F.length("body"))
    loss = F.col("piece").substr((F.col("span.start") - F.col("at") + 1).cast("int"), (F.col("span.end") - F.col("span.start")).cast("int"))
    return body.select("key", "chars", "pos", unescaped_role(role).alias("role"), unescaped(said).alias("text"), unescaped(loss).alias("loss"))


def digests(chats: DataFrame, key: str) -> DataFrame:
    """Per conversation what is read back from its string: ``key``, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    one = F.struct("pos", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("turn"), "loss")
    held = read_back(chats).groupBy("key").agg(
        F.sort_array(F.collect_list(one)).alias("turns"), F.sum(F.length("loss").cast("long")).alias("loss_chars"),
        F.max("chars").alias("formatted_chars"))
    return held.select(
        F.col("key").alias(key), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.col("turns.turn"), ""), 256).alias("turns_sha256"), "loss_chars",
        F.sha2(F.array_join(F.col("turns.loss"), ""), 256).alias("loss_sha256"), "formatted_chars")


def format_conversations(records: DataFrame, key: str, order: str | None = None, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """(key, n_turns, formatted, mask) of every conversation."""
    return formatted(canonical_turns(records, key, order, layouts))
