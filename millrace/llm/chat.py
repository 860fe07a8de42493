"""Chat formatting: layouts found by schema fingerprints, canonical turns, one reversible template.

A record's fingerprint is a hash of its nested field paths, whatever its values and
scalar types are.  Layouts declare which paths hold the turns of a prompt, an
instruction or a list of messages; each registers the fingerprints of all its
forms, with and without its optional fields.  Records in JSON are told apart row by
row, tables once by their schema; both give the canonical turns
``conv_id, turn, role, text``.

The template puts each text between control strings of its role.  A control string
inside a text gets a backslash after its first character, and one that already has
backslashes there gets one more, so every text comes back as it was.  A
conversation is written in parts of about ``PART_CHARS`` characters, each with the
spans that count for the loss: the assistant's texts without their control strings.
Turns are dealt by ranges of conversation and turn, so a conversation of any length
is formatted by many tasks; reading a digest back streams it, turn by turn.

Turns of a conversation are ordered by turn, role and text, null turns first; equal
rows are turns of their own.  A null role or text is empty, and rows without a
conversation are one conversation with a null id.  Empty texts make turns, empty
tables give no rows.  A record whose fingerprint is unknown, or that isn't JSON,
has no turns; ``unmapped`` returns it.  Other columns are read only where a layout names them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

PART_CHARS = 1_000_000
#: Characters of a text that take part in dealing turns to tasks.
KEY_CHARS = 64

#: Control strings before and after a text, by role; other roles are written out.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("[SYS]", "[/SYS]")}
OTHER = ("[ROLE]", "[SEP]", "[/ROLE]")
#: What follows the first character of a control string; no control string holds a further < or [.
_REST = r"/?s>|/?INST\]|/?SYS\]|/?ROLE\]|SEP\]"
ESCAPE = (rf"([<\[])(\\*)({_REST})", r"$1\\$2$3")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_REST})")
_TURN = re.compile(r"\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>|\[SYS\](?P<system>.*?)\[/SYS\]|\[ROLE\](?P<role>.*?)\[SEP\](?P<other>.*?)\[/ROLE\]", re.DOTALL)


# ---- fingerprints

_SCALARS = r"(: )?\b(VOID|BOOLEAN|BIGINT|FLOAT|DOUBLE|STRING|BINARY|DATE|TIMESTAMP|TIMESTAMP_NTZ|UUID|DECIMAL\(\d+,\d+\))(?=[,>]|$)"


def fingerprint(form: str) -> str:
    return hashlib.sha256(form.encode()).hexdigest()


def form_of(kind: DataType) -> str:
    """The nested field paths of a type, as ``form`` gives those of a record."""
    if isinstance(kind, StructType):
        return f"OBJECT<{', '.join(_field(f.name, form_of(f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name))}>"
    return f"ARRAY<{form_of(kind.elementType)}>" if isinstance(kind, ArrayType) else ""


def _field(name: str, inner: str) -> str:
    name = name if re.fullmatch(r"\w+", name) else f"`{name}`"
    return f"{name}: {inner}" if inner else name


def form(record: Column) -> Column:
    """The nested field paths of a VARIANT, without scalar types."""
    return F.regexp_replace(F.schema_of_variant(record), _SCALARS, "")


# ---- layouts


@dataclass(frozen=True)
class Fields:
    """Turns from single fields: (role, paths whose texts are joined by a blank line); optional fields may be absent."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    optional: frozenset[str] = frozenset()

    def forms(self) -> Iterator[str]:
        every = {p for _, paths in self.turns for p in paths}
        for absent in _subsets(self.optional):
            yield f"OBJECT<{', '.join(sorted(every - absent))}>"

    def read(self, record: Column) -> Column:
        found = [F.struct(F.lit(role).alias("role"), _joined(record, paths).alias("text"), F.lit(not self.optional.issuperset(paths)).alias("needed")) for role, paths in self.turns]
        return F.transform(F.filter(F.array(*found), lambda t: t["needed"] | t["text"].isNotNull()), lambda t: _turn(t["role"], t["text"]))


@dataclass(frozen=True)
class Messages:
    """Turns from a list of messages; a message's text is a field, or the joined ``field`` of a list of parts."""

    name: str
    path: str
    role: str
    text: str
    parts: str | None = None  #: field of a part that holds text
    roles: tuple[tuple[str, str], ...] = ()  #: other names of roles
    optional: frozenset[str] = frozenset()  #: fields of a message that are not used
    system: str | None = None  #: an optional field beside the list

    def forms(self) -> Iterator[str]:
        content = f": ARRAY<OBJECT<{', '.join(sorted((self.parts, 'type')))}>>" if self.parts else ""
        for absent in _subsets(self.optional):
            names = sorted({self.role, self.text, *self.optional} - absent)
            inner = f"OBJECT<{', '.join(n + content if n == self.text else n for n in names)}>"
            for held in (inner, ""):
                whole = {self.path: f"{self.path}: ARRAY<{held}>"}
                yield f"OBJECT<{whole[self.path]}>"
                if self.system:
                    yield f"OBJECT<{', '.join(v for _, v in sorted((whole | {self.system: self.system}).items()))}>"

    def read(self, record: Column) -> Column:
        kind = f"array<struct<`{self.parts}`: string>>" if self.parts else "string"
        held = F.coalesce(F.try_variant_get(record, f"$.{self.path}", f"array<struct<`{self.role}`: string, `{self.text}`: {kind}>>"), F.array())
        known = F.create_map(*[F.lit(x) for pair in self.roles for x in pair]) if self.roles else None

        def turn(m: Column) -> Column:
            text = F.array_join(F.transform(m[self.text], lambda p: p[self.parts]), "") if self.parts else m[self.text]
            return _turn(m[self.role] if known is None else F.coalesce(F.try_element_at(known, F.coalesce(m[self.role], F.lit(""))), m[self.role]), text)

        turns = F.transform(held, turn)
        if not self.system:
            return turns
        first = F.try_variant_get(record, f"$.{self.system}", "string")
        return F.when(first.isNull(), turns).otherwise(F.concat(F.array(_turn(F.lit("system"), first)), turns))


@dataclass(frozen=True)
class Rows:
    """A table with one row per turn."""

    name: str
    conv: str
    turn: str
    role: str
    text: str

    def forms(self) -> Iterator[str]:
        yield f"OBJECT<{', '.join(sorted((self.conv, self.turn, self.role, self.text)))}>"


def _subsets(names: frozenset[str]) -> Iterator[set[str]]:
    for n in range(len(names) + 1):
        yield from map(set, combinations(sorted(names), n))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _joined(record: Column, paths: Sequence[str]) -> Column:
    texts = [F.try_variant_get(record, f"$.{p}", "string") for p in paths]
    return texts[0] if len(texts) == 1 else F.when(F.coalesce(*texts).isNotNull(), F.concat_ws("\n\n", *[F.nullif(t, F.lit("")) for t in texts]))


_PEOPLE = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))
LAYOUTS: tuple[Fields | Messages | Rows, ...] = (
    Rows("turn rows", "conv_id", "turn", "role", "text"),
    Fields("prompt and completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), frozenset({"system"})),
    Fields("prompt and response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), frozenset({"system"})),
    Fields("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), frozenset({"system", "input"})),
    Fields("question", (("user", ("context", "question")), ("assistant", ("answer",))), frozenset({"context"})),
    Messages("messages", "messages", "role", "content", optional=frozenset({"name"}), system="system"),
    Messages("messages of parts", "messages", "role", "content", parts="text", optional=frozenset({"name"}), system="system"),
    Messages("conversations", "conversations", "from", "value", roles=_PEOPLE, system="system"),
)


def registry(layouts: Sequence[Fields | Messages | Rows] = LAYOUTS) -> dict[str, Fields | Messages | Rows]:
    """Layouts by fingerprint; of two layouts with one form the first counts."""
    found: dict[str, Fields | Messages | Rows] = {}
    for layout in layouts:
        for f in layout.forms():
            found.setdefault(fingerprint(f), layout)
    return found


def _read(records: DataFrame, id_col: str, body_col: str) -> DataFrame:
    body = F.col(body_col) if records.schema[body_col].dataType.typeName() == "variant" else F.try_parse_json(body_col)
    read = records.select(F.col(id_col).alias("conv_id"), body.alias("body"))
    return read.withColumn("form", form(F.col("body"))).withColumn("fingerprint", F.sha2("form", 256))


def _by_layout(layouts: Sequence) -> dict:
    by: dict = {}
    for mark, layout in registry(layouts).items():
        if not isinstance(layout, Rows):
            by.setdefault(layout, []).append(mark)
    return by


def record_turns(records: DataFrame, id_col: str, body_col: str, layouts: Sequence[Fields | Messages | Rows] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) of records in JSON text or VARIANT, by each record's fingerprint."""
    turns = None
    for layout, marks in _by_layout(layouts).items():
        fits, read = F.col("fingerprint").isin(marks), layout.read(F.col("body"))
        turns = F.when(fits, read) if turns is None else turns.when(fits, read)
    return _read(records, id_col, body_col).select("conv_id", F.posexplode(turns).alias("turn", "t")).select("conv_id", F.col("turn").cast("long"), "t.role", "t.text")


def unmapped(records: DataFrame, id_col: str, body_col: str, layouts: Sequence[Fields | Messages | Rows] = LAYOUTS) -> DataFrame:
    """(conv_id, form, fingerprint) of records that no layout reads; form is null for what isn't JSON."""
    marks = [m for found in _by_layout(layouts).values() for m in found]
    return _read(records, id_col, body_col).where(F.col("fingerprint").isNull() | ~F.col("fingerprint").isin(marks)).select("conv_id", "form", "fingerprint")


def table_turns(df: DataFrame, id_col: str | None = None, layouts: Sequence[Fields | Messages | Rows] = LAYOUTS) -> DataFrame:
    """(conv_id, turn, role, text) of a table, by the fingerprint of its schema.

    Without turn rows, ``id_col`` names the conversation and the other columns make up the record.
    """
    kind = df.schema if id_col is None else StructType([f for f in df.schema if f.name != id_col])
    layout = registry(layouts).get(fingerprint(form_of(kind)))
    if layout is None or isinstance(layout, Rows) != (id_col is None):
        raise ValueError(f"no layout reads {form_of(kind)}")
    if isinstance(layout, Rows):
        return df.select(F.col(layout.conv).alias("conv_id"), F.col(layout.turn).cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((layout.role, "role"), (layout.text, "text"))))
    body = F.to_variant_object(F.struct(*kind.names))
    return record_turns(df.select(F.col(id_col).alias("conv_id"), body.alias("body")), "conv_id", "body", layouts)


# ---- template


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss) of canonical turns; loss holds spans of the part in characters, end exclusive."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    before, after = (F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for r, m in MARKS.items() for x in (r, m[i])]), role), other) for i, other in ((0, F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))), (1, F.lit(OTHER[2]))))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("head", F.left("text", F.lit(KEY_CHARS)))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", "head").sortWithinPartitions("conv_id", "turn", "role", "text")
    marked = dealt.select("conv_id", before.alias("before"), escape(F.col("text")).alias("middle"), after.alias("after"), (F.col("role") == "assistant").alias("learned"))
    id_type = turns.schema["conv_id"].dataType.simpleString()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size, loss, conv = TaskContext.get().partitionId() << 33, [], 0, [], None

        def part(kind: pa.DataType) -> pa.RecordBatch:
            spans = pa.array([loss], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([number], pa.int64()), pa.array(["".join(held)]), spans], ["conv_id", "part", "formatted", "loss"])

        kind = None
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row, before, middle, after, learned in zip(*(batch.column(c) for c in ("conv_id", "before", "middle", "after", "learned"))):
                row, before, middle, after = row.as_py(), before.as_py(), middle.as_py(), after.as_py()
                if held and (row != conv or size >= PART_CHARS):
                    yield part(kind)
                    number, held, size, loss = number + 1, [], 0, []
                conv = row
                if learned.as_py():
                    loss.append({"start": size + len(before), "end": size + len(before) + len(middle)})
                held += (before, middle, after)
                size += len(before) + len(middle) + len(after)
        if held:
            yield part(kind)

    return marked.mapInArrow(join, f"conv_id {id_type}, part long, formatted string, loss array<struct<start: long, end: long>>")


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a part."""
    for m in _TURN.finditer(formatted):
        yield (unescape(m["role"]), unescape(m["other"])) if m["role"] is not None else (m.lastgroup, unescape(m[m.lastgroup]))


def read_digests(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of each conversation, from its parts alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    id_type = parts.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, turns, loss, conv, open_, n, learned, size, kind = [], hashlib.sha256(), hashlib.sha256(), None, False, 0, 0, 0, None

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names)

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for here, text, spans in zip(*(batch.column(c) for c in ("conv_id", "formatted", "loss"))):
                here, text = here.as_py(), text.as_py()
                if open_ and here != conv:
                    out.append((conv, n, turns.hexdigest(), learned, loss.hexdigest(), size))
                    turns, loss, n, learned, size = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                conv, open_ = here, True
                for role, said in parse(text):
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for span in spans.as_py():
                    said = unescape(text[span["start"] : span["end"]])
                    loss.update(said.encode())
                    learned += len(said)
                size += len(text)
            if out:
                yield rows()
                out = []
        if open_:
            out = [(conv, n, turns.hexdigest(), learned, loss.hexdigest(), size)]
            yield rows()

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(read, f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
