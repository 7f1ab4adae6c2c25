"""Chat formatting with DataFrame operations only.

Layouts are told apart by *schema fingerprints*, record by record.  A record is a
JSON object (a typed row is written as one); its nested field paths are listed,
and a mapping fits if the hash of the paths that the record shares with it is the
hash of all the mapping's paths.  Of the mappings that fit, turn rows come first,
then the one with the most paths, then the first in ``MAPPINGS`` (``ORDER``); so
further fields, known to other layouts or not, change nothing.  A mapping says
declaratively where turns, roles and texts lie and makes canonical turns
``(conv_id, turn, role, text)``.  Records that no mapping fits come back with a
null mapping instead of being guessed at (``json_to_turns``); a table whose schema
no mapping fits is an error (``to_turns``).

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  In roles and
texts a backslash is put before every backslash and between ``<`` and ``|``
(and a role's line feed becomes ``\\n``), so no text can hold a control string,
and unescaping restores it exactly.

Defined results: a null role or text is empty; turns that share a number are
ordered by role and text; a null turn comes first; repeated rows are turns of
their own; a null conv_id is a conversation of its own; further columns play no
part, whatever their names; a list of turns has the paths that all its elements
have, so an empty list, or one whose elements share no layout, fits no mapping; a
null prompt, answer or the like makes no turn."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``fields``: (role, path) of single turns in their order; ``turns``: path of an
    array of turn objects behind these, with ``role`` and ``text`` paths in each;
    or ``rows``: each record is one turn."""
    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    rows: bool = False

    def paths(self) -> list[str]:
        if self.rows:
            return ["turn", self.role, self.text]
        listed = [f"{self.turns}[].{self.role}", f"{self.turns}[].{self.text}"] if self.turns else []
        return [path for _, path in self.fields] + listed


#: The layouts that are known.
MAPPINGS = (
    Mapping("turn rows", rows=True, role="role", text="text"),
    Mapping("messages", turns="messages", role="role", text="content"),
    Mapping("messages with text", turns="messages", role="role", text="text"),
    Mapping("system and messages", fields=(("system", "system"),), turns="messages", role="role", text="content"),
    Mapping("conversations", turns="conversations", role="from", text="value"),
    Mapping("system and conversations", fields=(("system", "system"),), turns="conversations", role="from", text="value"),
    Mapping("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt and response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("system, prompt and response",
            fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("instruction and output", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction, input and output",
            fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
)
#: Canonical names of roles that layouts spell differently (turn rows are
#: canonical already, their roles stay as they are).
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


#: The order in which mappings are tried.
ORDER = tuple(sorted(MAPPINGS, key=lambda m: (not m.rows, -len(m.paths()))))
_LISTS = sorted({m.turns for m in MAPPINGS if m.turns})
_TOP = sorted({p.split("[")[0] for m in MAPPINGS for p in m.paths()})
TURN = "struct<turn:bigint,role:string,text:string>"


def schema_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks an array's elements."""
    out = []
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        if isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out += schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else [path]
    return out


def to_turns(df: DataFrame) -> DataFrame:
    """Canonical turns (conv_id, turn, role, text) of a typed DataFrame, each row
    by its own fingerprint; rows that no mapping fits have none.  Raises
    ``ValueError`` if no mapping fits the schema."""
    have = set(schema_paths(df.schema))
    if not any(have.issuperset(m.paths()) for m in MAPPINGS):
        raise ValueError(f"no mapping for the fields {sorted(have)}")
    known = F.struct(*(F.col(c) for c in df.columns if c in _TOP))
    records = df.select("conv_id", F.to_json(known, {"ignoreNullFields": "false"}).alias("record"))
    return json_to_turns(records).filter("mapping IS NOT NULL").drop("mapping")


def record_paths(record: Column) -> Column:
    """The field paths of a JSON record, and of the lists that some layout uses
    those that all their elements have."""
    none = F.array().cast("array<string>")
    paths = [F.coalesce(F.json_object_keys(record), none)]
    for name in _LISTS:
        each = F.from_json(record, f"struct<`{name}`:array<string>>")[name]
        keys = F.transform(each, lambda e: F.coalesce(F.json_object_keys(e), none))
        shared = F.aggregate(F.slice(keys, 2, F.greatest(F.size(keys) - 1, F.lit(0))), F.get(keys, F.lit(0)), F.array_intersect)
        paths.append(F.transform(F.coalesce(shared, none), lambda k: F.concat(F.lit(f"{name}[]."), k)))
    return F.concat(*paths)


def fits(paths: Column, m: Mapping) -> Column:
    """Whether what a record shares with a mapping has the mapping's fingerprint."""
    shared = F.array_intersect(F.array(*map(F.lit, sorted(m.paths()))), paths)
    return F.sha2(F.array_join(shared, "\n"), 256) == F.lit(fingerprint(m.paths()))


def _turns(record: Column, m: Mapping) -> Column:
    """The turns of a record by a mapping that fits it."""
    text = lambda c: F.coalesce(c, F.lit(""))
    names = ["turn", m.role, m.text] if m.rows else [path for _, path in m.fields]
    kinds = [f"`{n}`:string" for n in names]
    if m.turns:
        kinds.append(f"`{m.turns}`:array<struct<`{m.role}`:string,`{m.text}`:string>>")
    read = F.from_json(record, f"struct<{','.join(kinds)}>")
    if m.rows:
        return F.array(F.struct(read["turn"].cast("long").alias("turn"), text(read[m.role]).alias("role"),
                                text(read[m.text]).alias("text")))
    named = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    single = F.filter(F.array(*(F.when(read[path].isNotNull(), F.struct(F.lit(role).alias("role"), read[path].alias("text")))
                                for role, path in m.fields)), lambda t: t.isNotNull()) if m.fields else None
    listed = F.transform(read[m.turns], lambda t: F.struct(
        F.coalesce(F.element_at(named, t[m.role]), t[m.role], F.lit("")).alias("role"), text(t[m.text]).alias("text"))) \
        if m.turns else None
    kind = "array<struct<role:string,text:string>>"
    turns = F.concat(*(x.cast(kind) for x in (single, listed) if x is not None))
    return F.transform(turns, lambda t, i: F.struct(i.cast("long").alias("turn"), t["role"].alias("role"), t["text"].alias("text")))


def json_to_turns(df: DataFrame, record: str = "record") -> DataFrame:
    """Canonical turns of JSON records of mixed layouts, with ``mapping``, the
    name of the layout used; a record of no known layout is one row with a null
    mapping, turn, role and text."""
    rows = df.select("conv_id", F.col(record).alias("r"), record_paths(F.col(record)).alias("paths"))
    name = F.lit(None).cast("string")
    for m in reversed(ORDER):
        name = F.when(fits(F.col("paths"), m), F.lit(m.name)).otherwise(name)
    rows = rows.select("conv_id", "r", name.alias("mapping"))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for m in ORDER:
        turns = F.when(F.col("mapping") == m.name, _turns(F.col("r"), m).cast(f"array<{TURN}>")).otherwise(turns)
    each = rows.select("conv_id", "mapping", F.explode_outer(turns).alias("t"))
    return each.select("conv_id", "mapping", "t.turn", "t.role", "t.text")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    """A line feed is ``\\n`` after an even number of backslashes."""
    return unescape(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def format_turns(turns: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` and ``loss``: the (start, length) character spans
    of the assistant texts in it.  A conversation's window and its group use
    one shuffle; a conversation is one text, so its turns meet in one task."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    cut = turns.select("conv_id", "turn", "role", "text", opened.alias("opened"), body.alias("body"))
    cut = cut.withColumn("segment", F.concat("opened", "body", F.lit(END + "\n")))
    placed = cut.withColumn("before", F.coalesce(F.sum(F.length("segment")).over(order), F.lit(0)))
    span = F.when(F.col("role") == ASSISTANT, F.struct((F.col("before") + F.length("opened")).alias("start"),
                                                       F.length("body").cast("long").alias("length")))
    made = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("before", "segment"))).alias("parts"),
        F.sort_array(F.collect_list(span)).alias("loss"))
    return made.select("conv_id", F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("formatted"), "loss")


def read_formatted(formatted: DataFrame) -> DataFrame:
    """conv_id, ``turns`` (role, text) and ``loss_texts`` parsed from the
    formatted text and its loss spans."""
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda _, i: i > 0)

    def turn(p):
        cut = F.instr(p, "\n")
        whole = F.substring(p, cut + F.lit(1), F.length(p) - cut - F.lit(len(END) + 1))
        return F.struct(_unescape_role(F.substring(p, F.lit(1), cut - F.lit(1))).alias("role"),
                        unescape(whole).alias("text"))
    masked = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"),
                                                                s["length"].cast("int"))))
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), masked.alias("loss_texts"))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_formatted`` reads back."""
    read = read_formatted(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
